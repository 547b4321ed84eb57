"""Exact dedup: two passes over hashes with a blocked Bloom filter; only rows that may repeat are shuffled.

Pass one hashes each normalised text and counts how often each bit of a blocked Bloom filter is hit; bits hit twice or more make the
filter of possibly repeated hashes. Pass two tests each row's bits: a row with a bit that was hit once is unique and passes straight
through, without a shuffle. The others are grouped by their full SHA-256, so the filter's false positives cost a few shuffled rows and
never a wrong result. Native throughout: no Python runs on the executors.

The filter has 16 bits a row. Up to `max_mb` it is broadcast. A larger one stays a table, in ranges of the hash, and rows (hash and id, never text)
are brought to their range's block, the heaviest blocks excepted, which come to the rows. So it never fills, however many rows there are.

Defined cases: null text counts as empty; texts that are equal after white space is reduced are equal; of equal texts the smallest
doc_id stays (null ids come last; rows that repeat id and text are one document, and one of them stays in drop_copies); empty tables give
empty tables; other columns pass through drop_copies and drop_rows, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, free_name, heaviest, lookup, row_keys, written

BLOCK_BITS = 32768  # of one bitmap_construct_agg value
PROBES = 3


def text_sha256(column: Column) -> Column:
    """SHA-256 of the text with each run of white space replaced by one space."""
    return F.sha2(F.regexp_replace(F.coalesce(column.cast("string"), F.lit("")), SPACE, " "), 256)


def _block(sha: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(sha)), F.lit(blocks)).cast("long")


def _probes(sha: str) -> list[Column]:
    h = F.xxhash64(F.col(sha), F.lit(1))
    return [F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PROBES)]


def _packed(hits: DataFrame) -> DataFrame:
    """block, bits and weight (how many of its bits are set) from distinct (block, bit)."""
    return hits.groupBy("block").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bits"), F.count("*").alias("weight"))


def repeat_filter(hashes: DataFrame, sha: str, bits_per_row: int = 16) -> tuple[DataFrame, int]:
    """The bits that two or more rows hit, as (block, bits, weight), and the number of blocks. Counting is a partial aggregation over small integers."""
    blocks = max(1, -(-hashes.count() * bits_per_row // BLOCK_BITS))
    hits = hashes.select(_block(sha, blocks).alias("block"), F.explode(F.array(*_probes(sha))).alias("bit"))
    twice = hits.groupBy("block", "bit").agg(F.count("*").alias("n")).filter("n > 1")
    return written(_packed(twice), "repeat-filter", narrow=True), blocks


def membership_filter(ids: DataFrame, column: str, bits_per_row: int = 16, max_mb: int = 32) -> tuple[DataFrame, int]:
    """A Bloom filter of all values of a column, of max_mb MB at most (256 blocks a MB): it is for rows with texts, which must not travel to the filter. Beyond
    that size it clears fewer rows, and what it does not clear is joined."""
    blocks = min(max_mb * 256, max(1, -(-ids.count() * bits_per_row // BLOCK_BITS)))
    hits = ids.select(_block(column, blocks).alias("block"), F.explode(F.array(*_probes(column))).alias("bit")).distinct()
    return written(_packed(hits), "id-filter", narrow=True), blocks


def split_by_filter(rows: DataFrame, sha: str, bits: DataFrame, blocks: int, max_mb: int = 32) -> tuple[DataFrame, DataFrame]:
    """(rows that may repeat, rows that are unique). A filter of max_mb MB at most is broadcast; rows travel to the blocks of a larger one, so they should be narrow."""
    block, field = free_name(rows, "filter_block"), free_name(rows, "filter_bits")
    weight = free_name(rows, "filter_weight")
    held = bits.select(F.col("block").alias(block), F.col("bits").alias(field), F.col("weight").alias(weight))
    placed = rows.withColumn(block, _block(sha, blocks))
    tested = placed.join(F.broadcast(held), block, "left") if blocks <= max_mb * 256 else lookup(placed, held, block, weight)
    hit = F.lit(True)
    for p in _probes(sha):
        byte = F.conv(F.hex(F.substring(F.col(field), (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
        hit = hit & (F.getbit(byte, F.pmod(p, F.lit(8)).cast("int")) == 1)
    maybe = F.col(field).isNotNull() & hit
    return tested.filter(maybe).select(*rows.columns), tested.filter(~maybe).select(*rows.columns)


def drop_rows(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows whose keys (common.row_keys) are in gone (row_id, row_hash). A row goes by id and text, so another row of its id stays. Rows that a
    bounded filter of the hashes clears are not shuffled."""
    own_id, own_hash, mark = (free_name(docs, x) for x in ("row_id", "row_hash", "is_gone"))
    gone = written(gone.select(F.col("row_id").alias(own_id), F.col("row_hash").alias(own_hash)).distinct(), "gone-rows", narrow=True)
    bits, blocks = membership_filter(gone, own_hash)
    keys = row_keys(docs, id_col, text_col)
    keyed = docs.withColumns({own_id: keys[0], own_hash: keys[1]})
    maybe, rest = split_by_filter(keyed, own_hash, bits, blocks)
    # an outer join and a test, as Spark would move an anti join, and with it the shuffle of all texts, below the filter
    left = maybe.join(gone.withColumn(mark, F.lit(True)), [own_id, own_hash], "left").filter(F.col(mark).isNull())
    return rest.select(*docs.columns).unionByName(left.select(*docs.columns))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    narrow = written(docs.select(F.col(id_col).alias("doc_id"), text_sha256(F.col(text_col)).alias("text_sha256")), "hashes")
    bits, blocks = repeat_filter(narrow, "text_sha256")
    maybe, unique = split_by_filter(narrow, "text_sha256", bits, blocks)
    groups = written(maybe.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups", narrow=True)
    found = lookup(maybe, groups, "text_sha256", "group_size")
    alone = unique.withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long")})
    out = alone.unionByName(found)
    return out.select(F.col("doc_id").alias(id_col), "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the later copies, all columns kept. The copies are found among hashes; texts of rows that stay are not shuffled, but for the few that the
    filter of the copies' hashes does not clear, and copies of the 1000 most frequent texts go where they lie."""
    row_id, row_hash = row_keys(docs, id_col, text_col)
    narrow = written(docs.select(row_id.alias("row_id"), row_hash.alias("row_hash"), text_sha256(F.col(text_col)).alias("sha")), "hashes")
    bits, blocks = repeat_filter(narrow, "sha")
    maybe, _ = split_by_filter(narrow, "sha", bits, blocks)
    # null ids, whose hashes are odd, come last; of rows of one id whose texts differ in white space, that of the least hash stays
    place = F.struct(F.col("row_hash").bitwiseAND(F.lit(1)).alias("is_null"), "row_id", "row_hash")
    groups = written(maybe.groupBy("sha").agg(F.min(place).alias("keep"), F.count("*").alias("n")).filter("n > 1"), "copy-groups", narrow=True)
    later = written(lookup(maybe, groups, "sha", "n").filter("keep is not null").withColumn("stays", (F.col("row_id") == F.col("keep.row_id")) & (F.col("row_hash") == F.col("keep.row_hash"))), "copies", narrow=True)
    # a text of many copies: its rows are told by hash, against a broadcast of 1000 rows at most
    hot = heaviest(later.groupBy("row_hash").agg(F.count("*").alias("n"), F.max(F.when(F.col("stays"), F.col("row_id"))).alias("own")).filter("n > 100"), "n")
    hot = written(hot, "hot-copies")
    mark, own, is_hot = (free_name(docs, x) for x in ("row_hash", "own_id", "is_hot"))
    held = F.broadcast(hot.select(F.col("row_hash").alias(mark), F.col("own").alias(own), F.lit(True).alias(is_hot)))
    out = docs.withColumn(mark, row_hash).join(held, mark, "left").filter(F.col(is_hot).isNull() | F.col(own).eqNullSafe(row_id)).select(*docs.columns)
    cold = later.filter("not stays").join(F.broadcast(hot.select("row_hash")), "row_hash", "left_anti")
    out = drop_rows(out, cold.select("row_id", "row_hash"), id_col, text_col)
    # rows that repeat id and text have equal keys: one of them stays
    twins = written(later.filter("stays").groupBy("row_id", "row_hash").count().filter("count > 1"), "twins", narrow=True)
    if not twins.limit(1).count():
        return out
    single = drop_rows(out, twins, id_col, text_col)
    t_id, t_hash, is_twin = (free_name(docs, x) for x in ("twin_id", "twin_hash", "is_twin"))
    named = twins.select(F.col("row_id").alias(t_id), F.col("row_hash").alias(t_hash), F.lit(True).alias(is_twin))
    bits, blocks = membership_filter(twins, "row_hash")
    likely, _ = split_by_filter(out.withColumns({t_id: row_id, t_hash: row_hash}), t_hash, bits, blocks)
    one = likely.join(named, [t_id, t_hash], "left").filter(F.col(is_twin)).dropDuplicates([t_id, t_hash])
    return single.unionByName(one.select(*docs.columns))


__all__ = ["drop_copies", "drop_rows", "mark_copies", "membership_filter", "repeat_filter", "split_by_filter", "text_sha256"]
