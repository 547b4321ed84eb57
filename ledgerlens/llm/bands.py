"""Search for links among classes of equal documents by bands of their signatures: what MinHash and the edit embedding have in common.

A class is a row: node (a number written down with it), row_id and row_hash (common.row_keys of its first row), signature (numbers of one kind). Classes
that share a band of the signature meet in a bucket. Each is compared with the bucket's least one, by signature first, then by an exact test on the texts; then components are
built, and buckets whose members fell into several are searched for links between those, in blocks. So every pair that shares a bucket is connected already or
compared, and no pairs are written out but links. Nothing here drops or caps candidates; a table without classes gives none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_text, lookup, row_keys, written
from .components import components
from .exact_dedup import membership_filter, split_by_filter
from .textops import groups_of, in_chunks

def keyed(docs: DataFrame) -> DataFrame:
    row_id, row_hash = row_keys(docs)
    return docs.select(row_id.alias("row_id"), row_hash.alias("row_hash"), as_text(docs, "text").alias("text"))


def class_texts(docs: DataFrame, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, text of the nodes, one row each: the text of each class's first row. Other rows are kept from the shuffle by a bounded filter."""
    wanted = written(classes.select("node", "row_id", "row_hash").join(nodes.select("node").distinct(), "node"), "wanted-texts", narrow=True)
    bits, blocks = membership_filter(wanted, "row_id")
    likely, _ = split_by_filter(keyed(docs), "row_id", bits, blocks)
    found = likely.join(wanted, ["row_id", "row_hash"]).select("node", "text")
    return found.dropDuplicates(["node"])  # rows that repeat id and text


def _buckets(banded: DataFrame, name: str) -> DataFrame:
    """banded with head (the least node) and n (how many) of each bucket of two or more."""
    heads = written(banded.groupBy("band").agg(F.min("node").alias("head"), F.count("*").alias("n")).filter("n > 1"), name, narrow=True)
    return written(lookup(banded, heads, "band", "n").filter("head is not null"), f"{name}-members", narrow=True)


def _split(members: DataFrame, labels: DataFrame) -> DataFrame:
    """members (index, band, node, n) of the buckets that hold several components, with component. labels: node, component."""
    named = members.join(labels, "node")
    split = named.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("band")
    return written(named.join(split, "band", "left_semi"), "split-buckets", narrow=True)


def renamed(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, component) after links (v, u) between components; a hot component is renamed by broadcast."""
    if not links.limit(1).count():
        return labels
    sizes = labels.groupBy("component").agg(F.count("*").alias("size"))
    joined = components(links).select(F.col("node").alias("component"), F.col("component").alias("whole")).join(sizes, "component")
    out = lookup(labels, written(joined, "joined-components", narrow=True), "component", "size")
    return written(out.select("node", F.coalesce("whole", "component").alias("component")), "labels", narrow=True)


GROUP = ["band", "i", "j"]


def _groups(frame: pd.DataFrame) -> Iterator[tuple[int, int, bool]]:
    """Where each group of a sorted frame begins and ends, and whether it is a pair of blocks."""
    keys = frame[GROUP].to_numpy()
    cut = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1), True]).tolist()
    for a, b in zip(cut, cut[1:]):
        yield a, b, bool(keys[a, 1] != keys[a, 2])


def _first_band(same: np.ndarray, rows: int) -> np.ndarray:
    """The first band whose numbers are all equal; one row of equalities a pair."""
    return same[:, : same.shape[1] // rows * rows].reshape(len(same), -1, rows).all(axis=2).argmax(axis=1)


class Search:
    """kind: of a signature's numbers; rows: how many make a band; least: the share of equal numbers below which a pair is not tested.

    prepare: what the test needs of each of a list of texts (UTF-8); same: the exact test of two of these; across: the links (index pairs) that join components among the texts of a
    group, given their components, for a pair of blocks their sides, and a function that tells which of the texts after the x-th have a signature like its and share this band with it first.
    cells: an array of each class; only classes that have a cell in common meet in a bucket.
    """

    def __init__(self, docs: DataFrame, kind: type, rows: int, least: float, prepare: Callable, same: Callable, across: Callable, cells: Column | None = None) -> None:
        self.docs, self.kind, self.rows, self.least, self.cells = docs, kind, rows, least, cells
        self.prepare, self.same, self.across = prepare, same, across

    def bands(self, classes: DataFrame, numbers: int) -> DataFrame:
        """node, index, band: a key for each `rows` numbers in a row."""
        size = np.dtype(self.kind).itemsize * self.rows
        cell = [] if self.cells is None else [F.col("cell")]
        placed = classes if self.cells is None else classes.select("node", "signature", F.explode(self.cells).alias("cell"))
        keys = F.array(*[F.xxhash64(F.substring("signature", i * size + 1, size), F.lit(i), *cell) for i in range(numbers // self.rows)])
        return placed.select("node", F.posexplode(keys).alias("index", "band"))

    def labels(self, classes: DataFrame, numbers: int) -> tuple[DataFrame, DataFrame]:
        """(node, component of every class after the comparison with heads, the members of buckets that hold several components)."""
        members = _buckets(self.bands(classes, numbers), "buckets")
        first = written(self.by_signature(members.filter("node <> head").select("head", F.col("node").alias("other")).distinct(), classes), "pairs")
        links = written(self.confirm(first, classes), "links").select(F.col("head").alias("v"), F.col("other").alias("u"))
        found = components(links)
        labels = written(classes.select("node").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "labels", narrow=True)
        return labels, _split(members.select("index", "band", "node", "n"), labels)

    def split(self, classes: DataFrame, numbers: int, labels: DataFrame) -> DataFrame:
        """The members of buckets that hold several components, under the components that labels has."""
        return _split(_buckets(self.bands(classes, numbers), "further-buckets").select("index", "band", "node", "n"), labels)

    def by_signature(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs whose signatures agree in at least the share `least` of their numbers."""
        both = pairs.join(classes.select(F.col("node").alias("other"), F.col("signature").alias("a")), "other").join(classes.select(F.col("node").alias("head"), F.col("signature").alias("b")), "head")
        kind, least = self.kind, self.least

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    a, b = (np.frombuffer(b"".join(pdf[c]), kind).reshape(len(pdf), -1) for c in "ab")
                    yield pdf.loc[(a == b).mean(axis=1) >= least, ["head", "other"]]

        return both.select("head", "other", "a", "b").mapInPandas(run, "head long, other long")

    def confirm(self, pairs: DataFrame, classes: DataFrame, share: int = 200) -> DataFrame:
        """The pairs (head, other) that pass the test. Texts of the nodes in question go to the pairs. A head with many pairs is dealt over several groups,
        `share` pairs each, and comes to each of them once."""
        parts = pairs.groupBy("head").agg(F.count("*").alias("n")).select("head", (F.floor(F.col("n") / share) + 1).alias("parts"), "n")
        dealt = lookup(pairs, written(parts, "heads", narrow=True), "head", "n").select("head", "other", F.pmod(F.xxhash64("other"), F.col("parts")).alias("part"))
        dealt = written(dealt, "dealt-pairs", narrow=True)
        units = dealt.select("head", "part", F.col("other").alias("node")).unionByName(dealt.select("head", "part", F.col("head").alias("node")).distinct())
        placed = units.join(class_texts(self.docs, classes, units), "node").select("head", "part", (F.col("node") != F.col("head")).alias("later"), "node", "text")
        placed = placed.repartition("head", "part").sortWithinPartitions("head", "part", "later")
        prepare, same = self.prepare, self.same

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own, mine = None, None
            for pdf, texts in in_chunks(batches, "text"):
                found = []
                for head, part, later, node, here in zip(pdf["head"], pdf["part"], pdf["later"], pdf["node"], prepare(texts)):
                    if not later:
                        own, mine = (head, part), here
                    elif own == (head, part) and same(mine, here):
                        found.append((head, node))
                yield pd.DataFrame(found, columns=["head", "other"], dtype="int64")

        return placed.mapInPandas(run, "head long, other long")

    def wanted(self, members: DataFrame, classes: DataFrame, block: int = 1000) -> DataFrame:
        """band, i, j, node, component, own: the members of buckets that have a partner in another component with a signature alike, where this bucket is the
        first that both share. members: index, band, node, component, n. A bucket of many members is cut into blocks; each pair of blocks is a group."""
        blocks = (F.floor(F.col("n") / block) + 1).cast("long")
        own = members.withColumn("own", F.pmod(F.xxhash64("node"), blocks)).withColumn("second", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        own = own.select("index", "band", "node", "component", F.least("own", "second").alias("i"), F.greatest("own", "second").alias("j"), "own")
        placed = own.join(classes.select("node", "signature"), "node").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "node")

        kind, least, rows = self.kind, self.least, self.rows

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in groups_of(batches, GROUP, 4096):
                signatures = np.frombuffer(b"".join(frame["signature"]), kind).reshape(len(frame), -1)
                component, own, index = (frame[c].to_numpy() for c in ("component", "own", "index"))
                needed = np.zeros(len(frame), bool)
                for a, b, two in _groups(frame):
                    sig, comp, side = signatures[a:b], component[a:b], own[a:b]
                    for x in range(b - a - 1):
                        apart = comp[x + 1 :] != comp[x]
                        at = x + 1 + np.flatnonzero(apart & (side[x + 1 :] != side[x]) if two else apart)
                        if not len(at):
                            continue
                        same = sig[at] == sig[x]
                        close = same.mean(axis=1) >= least
                        if close.any():
                            here = at[close][_first_band(same[close], rows) == index[a]]
                            needed[a + here] = True
                            needed[a + x] |= len(here) > 0
                yield frame.loc[needed, [*GROUP, "node", "component", "own", "index", "signature"]]

        return placed.mapInPandas(run, "band long, i long, j long, node long, component long, own long, index int, signature binary")

    def links_across(self, members: DataFrame, classes: DataFrame) -> DataFrame:
        """v, u: components that a link joins, passing the test, within the groups of wanted. classes: those with the texts' rows; members: of buckets, with their components."""
        units = written(self.wanted(members, classes), "wanted")
        placed = units.join(class_texts(self.docs, classes, units), "node").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "node")

        across, kind, least, rows = self.across, self.kind, self.least, self.rows

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in groups_of(batches, GROUP, 1024):
                signatures = np.frombuffer(b"".join(frame["signature"]), kind).reshape(len(frame), -1)
                component, own, index = (frame[c].to_numpy() for c in ("component", "own", "index"))
                texts = [t.encode() for t in frame["text"]]
                v, u = [], []
                for a, b, two in _groups(frame):

                    def alike(x: int, sig: np.ndarray = signatures[a:b], index: int = index[a]) -> np.ndarray:
                        same = sig[x + 1 :] == sig[x]
                        return (same.mean(axis=1) >= least) & (_first_band(same, rows) == index)

                    if b - a > 1:
                        for x, y in across(texts[a:b], component[a:b], own[a:b] if two else None, alike):
                            v.append(component[a + x])
                            u.append(component[a + y])
                yield pd.DataFrame({"v": v, "u": u}, dtype="int64")

        return placed.select("band", "i", "j", "node", "component", "own", "index", "signature", "text").mapInPandas(run, "v long, u long")
