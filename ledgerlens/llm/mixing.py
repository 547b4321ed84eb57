"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a seeded hash. A copy of a document has as virtual finish time the tokens of its source up to
and including it, divided by the source's target; so a source with twice the target advances half as fast. All copies in the order of
these times, cut where the budget is used up, are the mix. A source may be gone through `max_epochs` times, and its target is limited
accordingly; what is over is shared again by weight (the level solves itself from one sorted pass over the sources).

Running sums over a source of any size: hashes are cut into `slices` ranges, the ranges are summed, and rows are added up within a range
only. The global cut takes a histogram of the times, and a finer one of the bin in which the budget ends, until the bin has few rows, which are sorted.

Within a source the rows that are taken once more than others are those before some place of its queue. So mixed_rows needs one row a source, not one a
document: texts stay where they lie, but for sources behind the 1000 largest.

Defined cases: null text and text without words have size 0 and are never taken; a null source is a source, last in order; ties in time
are broken by source, epoch and place; rows of null ids are told apart by text; rows that repeat id, text and source have one place together and are taken equally
often; an empty table, or one without words, gives targets of 0; other columns pass through mixed_rows, whatever their names.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, free_name, lookup, row_keys, written

BINS = 16384


def source_targets(sizes: DataFrame, weights: list[int], max_epochs: int) -> DataFrame:
    """sizes: source_key, source_size. Adds target: weights repeat over the sources in order of source_key; limited to max_epochs sizes.

    target = min(weight * level, max_epochs * size) with the level for which the targets add up to all sizes. One row per source runs
    through the windows here, never a document.
    """
    rank = F.row_number().over(Window.orderBy("source_key")) - 1
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    with_weight = sizes.withColumn("weight", pick).withColumn("limit", F.col("source_size") * float(max_epochs))
    order = Window.orderBy((F.col("limit") / F.col("weight")), "source_key")
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy("source_key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stepped = with_weight.withColumns({
        "whole": F.sum("source_size").over(everything).cast("double"),
        "full": F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
        "open_weight": F.sum("weight").over(rest),
    })
    # at the first source (by limit a weight) that its limit does not hold back, all before it are at their limits
    level = F.max(F.when((F.col("whole") - F.col("full")) / F.col("open_weight") <= F.col("limit") / F.col("weight"), (F.col("whole") - F.col("full")) / F.col("open_weight"))).over(everything)
    found = stepped.withColumn("level", level)
    return found.select("source_key", "source_size", F.least(F.col("limit"), F.coalesce(F.col("weight") * F.col("level"), F.col("limit"))).alias("target"))


def _source_key(source: Column) -> Column:
    """The source as a string, null sources last: every other key starts with a 0."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _place(row_id: Column, row_hash: Column, slices: int, seed: int) -> Column:
    """A row's place in its source's queue: the slice of its hash first."""
    h = F.xxhash64(row_id, row_hash, F.lit(seed))
    return F.struct(F.pmod(h, F.lit(slices)).cast("long").alias("slice"), h.alias("h"), row_id.alias("row_id"), row_hash.alias("row_hash"))


def queue(rows: DataFrame, weights: list[int] | None = None, max_epochs: int = 3, seed: int = 42, slices: int = 1024, few: int = 100_000) -> DataFrame:
    """rows: row_id, row_hash, source, size and others. Returns them with source_key, place, source_size, target and times (how often the mix takes the row)."""
    weights = weights or [1, 2, 3]
    keyed = rows.withColumns({"source_key": _source_key(F.col("source")), "place": _place(F.col("row_id"), F.col("row_hash"), slices, seed)}).withColumn("slice", F.col("place.slice"))
    sums = written(keyed.groupBy("source_key", "slice").agg(F.sum("size").alias("n")), "slices", narrow=True)
    targets = source_targets(sums.groupBy("source_key").agg(F.sum("n").alias("source_size")), weights, max_epochs)
    earlier = Window.partitionBy("source_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n").join(targets, "source_key")
    # equal places share their sum
    own = Window.partitionBy("source_key", "slice").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    placed = keyed.withColumn("cum", F.sum("size").over(own)).join(starts, ["source_key", "slice"])
    placed = written(placed.withColumn("cum", F.col("cum") + F.col("start")).drop("start", "slice"), "queued", narrow=True)

    # a copy's place in the mix; times are in units of targets, so the cut is at 1, give or take a document for each source
    def key(epoch):
        finish = (epoch * F.col("source_size") + F.col("cum")) / F.col("target")
        return F.struct(finish.alias("finish"), F.col("source_key").alias("source_key"), epoch.cast("long").alias("epoch"), F.col("cum").alias("cum"))

    def bins(finish, depth):
        """The bin of a time among BINS from 0 to 4, its bin among as many of that bin, and so on."""
        out, at = [], finish * (BINS / 4)
        for _ in range(depth):
            out.append(F.least(F.floor(at), F.lit(BINS)))
            at = (at - out[-1]) * BINS
        return out

    able = (F.col("size") > 0) & (F.col("target") > 0)
    copies = placed.filter(able).select("size", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch"), "source_key", "source_size", "target", "cum")
    copies = copies.select("size", key(F.col("epoch")).alias("key"))
    left, edge = sums.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], []
    inside = copies
    while True:
        held = inside.withColumn("bin", bins(F.col("key.finish"), len(edge) + 1)[-1]).groupBy("bin").agg(F.sum("size").alias("n"), F.count("*").alias("rows"))
        upto = held.select("bin", "n", "rows", F.sum("n").over(Window.orderBy("bin")).alias("upto"))  # BINS + 1 rows at most
        found = upto.filter(F.col("upto") > left).orderBy("bin").first()
        if found is None:
            break
        left -= found["upto"] - found["n"]
        edge.append(found["bin"])
        same = [b == e for b, e in zip(bins(F.col("key.finish"), len(edge)), edge)]
        inside = copies.filter(functools.reduce(lambda a, b: a & b, same))
        if found["rows"] <= few or found["bin"] == BINS or len(edge) == 4:
            break
    if not edge:
        count = F.lit(max_epochs)
    else:
        run = F.sum("size").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
        last = inside.withColumn("run", run).filter(F.col("run") <= left).orderBy(F.col("key").desc()).select("key.*").first()
        if last is None:  # the bin's first copy is over the budget already
            before = F.struct(*[F.lit(e).cast("long").alias(f"b{i}") for i, e in enumerate(edge)])
            count = sum((F.struct(*[b.cast("long").alias(f"b{i}") for i, b in enumerate(bins(key(F.lit(e))["finish"], len(edge)))]) < before).cast("long") for e in range(max_epochs))
        else:
            cut = F.struct(F.lit(last["finish"]).alias("finish"), F.lit(last["source_key"]).alias("source_key"), F.lit(last["epoch"]).cast("long").alias("epoch"), F.lit(last["cum"]).cast("long").alias("cum"))
            count = sum((key(F.lit(e)) <= cut).cast("long") for e in range(max_epochs))
    return placed.withColumn("times", F.when(able, count).otherwise(F.lit(0)).cast("long")).drop("cum")


def word_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, row_id, row_hash, source, size in words for every row."""
    size = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD))
    row_id, row_hash = row_keys(docs)
    return docs.select("doc_id", row_id.alias("row_id"), row_hash.alias("row_hash"), "source", size.cast("long").alias("size"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words the mix takes, repeats counted) of every row."""
    queued = queue(written(word_sizes(docs), "word-sizes"), **options)
    return queued.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed_rows(docs: DataFrame, seed: int = 42, slices: int = 1024, **options) -> DataFrame:
    """docs as the mix has them: a row as often as it is taken, all columns kept."""
    queued = queue(written(word_sizes(docs).drop("doc_id"), "word-sizes"), seed=seed, slices=slices, **options).filter("size > 0")
    least = queued.groupBy("source_key").agg(F.min("times").alias("least"), F.max("times").alias("most"), F.max(F.struct("times", "place")).alias("last"), F.count("*").alias("n"))
    # rows up to the last place of those taken most often are taken as often, the others once less
    own, place, times = free_name(docs, "source_key"), free_name(docs, "queue_place"), free_name(docs, "times")
    bounds = least.select(F.col("source_key").alias(own), F.struct("least", "most", F.col("last.place").alias("place")).alias(times), F.col("n").alias(free_name(docs, "n_rows")))
    rows = docs.withColumns({own: _source_key(F.col("source")), place: _place(*row_keys(docs), slices, seed)})
    found = lookup(rows, written(bounds, "queue-ends", narrow=True), own, free_name(docs, "n_rows"))
    often = F.when(F.col(place) <= F.col(f"{times}.place"), F.col(f"{times}.most")).otherwise(F.col(f"{times}.least"))
    has_words = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(WORD)
    counted = found.withColumn(times, F.when(has_words, often).otherwise(F.lit(0))).filter(F.col(times) > 0)
    return counted.withColumn(times, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*docs.columns)
