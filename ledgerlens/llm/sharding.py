"""Sharding: best-fit-decreasing bin packing of indivisible groups.

`best_fit_decreasing` packs sizes into as few bins of one capacity as it can: sizes in falling order, each into the open bin with the least
remaining capacity that still holds it, which a balanced tree of remaining capacities finds. `shard` deals a table of any size into a
fixed number of shards by it: the groups too large to be rounded away (at most n_shards * grain of them) are items of their own, all
other groups are bundled by their hash into a bounded number of bundles of graded sizes, and the smallest capacity that best-fit-decreasing
packs into n_shards bins is found by bisection. What the driver holds is bounded by the parameters, not by the table.

Defined cases: null text is a group of its own with size 1; equal texts (one group) stay together even if they outweigh a shard; an empty
table gives an empty table; repeated rows are rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

CLASSES, WIDTH, SLICES = 7, 512, 256


class _Node:
    __slots__ = ("key", "left", "level", "right")

    def __init__(self, key: tuple[int, int]) -> None:
        self.key, self.left, self.right, self.level = key, None, None, 1


class CapacityTree:
    """A balanced (Arne Andersson) tree of (remaining capacity, bin) with a search for the tightest bin that holds a size."""

    def __init__(self) -> None:
        self.root: _Node | None = None

    @staticmethod
    def _skew(t: _Node) -> _Node:
        if t.left and t.left.level == t.level:
            l = t.left
            t.left, l.right = l.right, t
            return l
        return t

    @staticmethod
    def _split(t: _Node) -> _Node:
        if t.right and t.right.right and t.right.right.level == t.level:
            r = t.right
            t.right, r.left = r.left, t
            r.level += 1
            return r
        return t

    def add(self, key: tuple[int, int]) -> None:
        self.root = self._add(self.root, key)

    def _add(self, t: _Node | None, key: tuple[int, int]) -> _Node:
        if t is None:
            return _Node(key)
        if key < t.key:
            t.left = self._add(t.left, key)
        else:
            t.right = self._add(t.right, key)
        return self._split(self._skew(t))

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    def _remove(self, t: _Node | None, key: tuple[int, int]) -> _Node | None:
        if t is None:
            return None
        if key < t.key:
            t.left = self._remove(t.left, key)
        elif key > t.key:
            t.right = self._remove(t.right, key)
        elif t.left is None and t.right is None:
            return None
        elif t.left is None:
            n = t.right
            while n.left:
                n = n.left
            t.key, t.right = n.key, self._remove(t.right, n.key)
        else:
            n = t.left
            while n.right:
                n = n.right
            t.key, t.left = n.key, self._remove(t.left, n.key)
        low = 1 + min(t.left.level if t.left else 0, t.right.level if t.right else 0)
        if low < t.level:
            t.level = low
            if t.right and t.right.level > low:
                t.right.level = low
        t = self._skew(t)
        if t.right:
            t.right = self._skew(t.right)
            if t.right.right:
                t.right.right = self._skew(t.right.right)
        t = self._split(t)
        if t.right:
            t.right = self._split(t.right)
        return t

    def tightest(self, size: int) -> tuple[int, int] | None:
        t, found = self.root, None
        while t:
            if t.key[0] >= size:
                found, t = t.key, t.left
            else:
                t = t.right
        return found


def best_fit_decreasing(sizes: Iterable[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each size, in the order given. A size over the capacity has a bin to itself. None if over `most` bins are needed."""
    sizes = list(sizes)
    tree, bins, out = CapacityTree(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda j: (-sizes[j], j)):
        at = tree.tightest(sizes[i])
        if at is None:
            if most is not None and bins >= most:
                return None
            at, bins = (max(capacity, sizes[i]), bins), bins + 1
        else:
            tree.remove(at)
        out[i] = at[1]
        tree.add((at[0] - sizes[i], at[1]))
    return out


def even_bins(sizes: list[int], bins: int) -> list[int]:
    """The bin of each size under the least capacity for which best-fit-decreasing needs at most `bins` bins."""
    if not sizes:
        return []
    low, high = max(-(-sum(sizes) // bins), max(sizes)), None
    step = max(1, low // 4096)
    while high is None:
        if (found := best_fit_decreasing(sizes, low + step, bins)) is not None:
            high, best = low + step, found
        else:
            step *= 4
    while low < high:
        mid = (low + high) // 2
        if (found := best_fit_decreasing(sizes, mid, bins)) is not None:
            high, best = mid, found
        else:
            low = mid + 1
    return best


def shard(rows: DataFrame, group: str, size: str, n_shards: int = 8, grain: int = 500) -> DataFrame:
    """rows with `shard`: groups whole, the shards' summed sizes near equal.

    The driver holds one row for each group over total / (n_shards * grain), so n_shards * grain at most, and CLASSES * WIDTH bundles.
    """
    spark = rows.sparkSession
    groups = written(rows.groupBy(group).agg(F.sum(size).alias("total")), "shard-groups")
    total = groups.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    limit = max(1, total // (n_shards * grain))
    h = F.xxhash64(F.col(group))
    # the number of trailing one bits halves the bundles' weight from class to class, so that the last to be packed are small
    kind = F.lit(CLASSES - 1)
    for c in reversed(range(CLASSES - 1)):
        kind = F.when(h.bitwiseAND(F.lit((1 << (c + 1)) - 1)) == (1 << c) - 1, F.lit(c)).otherwise(kind)
    bundle = kind * WIDTH + F.shiftrightunsigned(h, 20).bitwiseAND(F.lit(WIDTH - 1))
    large = [(r[0], r[1]) for r in groups.filter(F.col("total") > limit).collect()]
    small = [(r[0], r[1]) for r in groups.filter(F.col("total") <= limit).groupBy(bundle.alias("b")).agg(F.sum("total")).collect()]
    large.sort()
    small.sort()
    bins = even_bins([s for _, s in large] + [s for _, s in small], n_shards)
    kinds = rows.schema[group].dataType.simpleString()
    own = spark.createDataFrame([(g, b) for (g, _), b in zip(large, bins)], f"`{group}` {kinds}, own_shard int")
    dealt = spark.createDataFrame([(int(g), b) for (g, _), b in zip(small, bins[len(large) :])], "bundle long, bundle_shard int")
    out = rows.withColumn("bundle", bundle.cast("long")).join(F.broadcast(own), group, "left").join(F.broadcast(dealt), "bundle", "left")
    return out.select(*rows.columns, F.coalesce("own_shard", "bundle_shard").alias("shard"))


def with_slots(rows: DataFrame, shard_col: str, order: list[str]) -> DataFrame:
    """rows with `slot`: 0, 1, ... within each shard. Each shard is numbered in SLICES slices, which are added up in a table of SLICES rows a shard."""
    cut = rows.withColumn("slice", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(SLICES)))
    counts = cut.groupBy(shard_col, "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy(shard_col).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard_col, "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy(shard_col, "slice").orderBy(*order)
    placed = cut.withColumn("own", F.row_number().over(own) - 1)
    return placed.join(F.broadcast(offsets), [shard_col, "slice"]).withColumn("slot", (F.col("offset") + F.col("own")).cast("long")).drop("slice", "own", "offset")


def shard_documents(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row, by the law `bytes`."""
    text = F.col("text").cast("string")
    narrow = docs.select(
        F.col("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"), F.coalesce(F.md5(F.encode(text, "UTF-8")), F.lit("null")).alias("text_group"),
    )
    dealt = written(shard(written(narrow, "sizes"), "text_group", "size", n_shards), "sharded")
    out = with_slots(dealt, "shard", ["doc_id", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
