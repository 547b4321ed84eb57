"""Samples that are exact in size and the same on every run: rows are ranked by a hash of seed and id."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

METHODS = ("none", "class_weight", "under_sample", "smote")


def draw(key: str, seed: int = 42) -> Column:
    """A pseudo-random order of rows that any engine can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def sample_fraction(df: DataFrame, fraction: float, key: str = "txn_id", seed: int = 42) -> DataFrame:
    return sample_rows(df, round(df.count() * fraction), key, seed)


def sample_rows(df: DataFrame, n: int, key: str = "txn_id", seed: int = 42) -> DataFrame:
    """n rows without replacement (top-k per partition, then of those)."""
    return df.orderBy(draw(key, seed), key).limit(n)


def keep_positives(df: DataFrame, label: str, max_rows: int, key: str = "txn_id", seed: int = 42) -> DataFrame:
    """All positives and as many negatives as max_rows leaves room for."""
    positives = df.filter(F.col(label) == 1)
    return positives.unionByName(sample_rows(df.filter(F.col(label) != 1), max(0, max_rows - positives.count()), key, seed))


def class_counts(df: DataFrame, label: str) -> dict:
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}


def _ranked(df: DataFrame, label: str, key: str, seed: int, most: dict | None = None) -> DataFrame:
    """rank_in_class: 1, 2, ... in the order of draw. A class is cut by the first three digits of its draws, which are counted, so 4096 slices are sorted, never a class.
    most: how many rows of each class are wanted; slices that begin behind them, and classes not named, are left out."""
    cut = df.withColumn("drawn", draw(key, seed)).withColumn("slice", F.substring("drawn", 1, 3))
    counts = cut.groupBy(label, "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy(label).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # 4096 rows a class
    starts = counts.select(F.col(label).alias("its_label"), F.col("slice").alias("its_slice"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    if most is not None:
        starts = starts.filter(F.col("start") < _of_class("its_label", most))
    placed = cut.join(starts, (F.col("slice") == F.col("its_slice")) & F.col(label).eqNullSafe(F.col("its_label")))
    own = F.row_number().over(Window.partitionBy(label, "slice").orderBy("drawn", key))
    return placed.select(*df.columns, (F.col("start") + own).alias("rank_in_class"))


def _of_class(label: str, values: dict) -> Column:
    """values of the row's class, 0 for classes not named."""
    out = F.lit(0)
    for c, n in values.items():
        out = F.when(F.col(label).eqNullSafe(F.lit(c)), n).otherwise(out)
    return out


def per_class(df: DataFrame, label: str, wanted: dict, key: str = "txn_id", seed: int = 42) -> DataFrame:
    """As many rows of each class as wanted says, those of the least hashes; a class is never sorted in one task, nor is a sample gathered in one."""
    ranked = _ranked(df, label, key, seed, wanted)
    return ranked.filter(F.col("rank_in_class") <= _of_class(label, wanted)).drop("rank_in_class")


def stratified_split(df: DataFrame, label: str, test_size: float = 0.2, key: str = "txn_id", seed: int = 42) -> DataFrame:
    """part: test for the first round(test_size * n) of each class by hash, else train."""
    sizes = df.groupBy(label).agg(F.count("*").alias("class_size"))
    ranked = _ranked(df, label, key, seed).join(F.broadcast(sizes), label)
    return ranked.withColumn("part", F.when(F.col("rank_in_class") <= F.round(F.col("class_size") * test_size), "test").otherwise("train")).drop("rank_in_class", "class_size")


def stratified_folds(df: DataFrame, label: str, folds: int = 5, key: str = "txn_id", seed: int = 42) -> DataFrame:
    return _ranked(df, label, key, seed).withColumn("fold", F.pmod(F.col("rank_in_class"), F.lit(folds))).drop("rank_in_class")


def equal_class_sample(df: DataFrame, label: str, fraction: float = 0.001, cap: int | None = 50_000, key: str = "txn_id", seed: int = 42) -> DataFrame:
    """The same number of rows of both classes: half of min(fraction * n, cap), or what a class has. cap None: no cap."""
    size = int(fraction * df.count())
    half = (size if cap is None else min(size, cap)) // 2
    return per_class(df, label, {0: half, 1: half}, key, seed)


def under_sample(df: DataFrame, label: str, ratio: float = 1.0, key: str = "txn_id", seed: int = 42) -> DataFrame:
    """The smaller class whole, of the larger min(int(smaller * ratio), larger) rows."""
    counts = class_counts(df, label)
    if len(counts) < 2:
        return df
    small = min(counts, key=lambda c: (counts[c], c))
    return per_class(df, label, {c: n if c == small else min(int(counts[small] * ratio), n) for c, n in counts.items()}, key, seed)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """label, weight = n / (classes * n of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("all"), F.count("*").alias("k"))
    return counts.join(F.broadcast(total)).select(label, (F.col("all") / (F.col("k") * F.col("n"))).alias("weight"))


def top_and_borderline(df: DataFrame, probability: str = "probability", key: str = "txn_id", top: int = 100, borderline: int = 50, middle: float = 0.5, width: float = 0.05) -> DataFrame:
    """The `top` most probable rows and up to `borderline` next to `middle`, each once, with case_type."""
    p, far = F.col(probability), F.abs(F.col(probability) - middle)
    high = df.orderBy(p.desc(), key).limit(top)
    near = df.filter(far <= width).orderBy(far, key).limit(borderline)
    kind = F.when(far <= width, "borderline").when(p > middle, "high_risk").otherwise("normal")
    return high.unionByName(near).dropDuplicates([key]).withColumn("case_type", kind)


def draw_combinations(grid: dict[str, list], n: int = 10, seed: int = 42) -> list[dict]:
    """n settings of a grid, drawn without replacement."""
    every = [{}]
    for name, values in grid.items():
        every = [{**e, name: v} for e in every for v in values]
    return random.Random(seed).sample(every, min(n, len(every)))


def nearest(points: DataFrame, k: int, block: int = 8192) -> DataFrame:
    """points: id (0, 1, ...), point (array). Returns id, near: the points of the k nearest other rows, nearest first, ties by id.

    Every row is compared with every other, a pair of blocks at a time; a task holds two blocks.
    """
    import numpy as np
    import pandas as pd

    blocks = -(-points.count() // block)
    others = F.explode(F.sequence(F.lit(0), F.lit(max(0, blocks - 1))))
    own = points.withColumn("own", F.pmod("id", F.lit(max(1, blocks))).cast("int"))
    asked, told = own.withColumn("other", others).withColumn("asks", F.lit(True)), own.withColumnRenamed("own", "other").withColumn("own", others).withColumn("asks", F.lit(False))

    def search(part: pd.DataFrame) -> pd.DataFrame:
        one, two = part[part["asks"]], part[~part["asks"]]
        out = {"id": [], "distance": [], "other_id": [], "point": []}
        if len(one) and len(two):
            x, y = np.stack(one["point"]), np.stack(two["point"])
            ids, names = one["id"].to_numpy(), two["id"].to_numpy()
            for start in range(0, len(x), 256):
                here = slice(start, start + 256)
                d = sum((x[here, f, None] - y[None, :, f]) ** 2 for f in range(x.shape[1]))
                d[np.isnan(d)] = np.inf
                d[ids[here, None] == names[None]] = -1.0  # the row itself
                least = np.partition(d, min(k, len(y) - 1), axis=1)[:, min(k, len(y) - 1), None]
                row, col = np.nonzero((d <= least) & (d >= 0))
                order = np.lexsort((names[col], d[row, col], row))
                row, col = row[order], col[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row)
                row, col = row[rank < k], col[rank < k]
                out["id"].extend(ids[here][row]), out["distance"].extend(d[row, col]), out["other_id"].extend(names[col]), out["point"].extend(y[col])
        return pd.DataFrame(out)

    found = asked.unionByName(told).groupBy("own", "other").applyInPandas(search, "id long, distance double, other_id long, point array<double>")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("id").orderBy("distance", "other_id"))).filter(F.col("rank") <= k)
    return ranked.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "point"))), lambda p: p["point"]).alias("near"))


def smote(df: DataFrame, label: str, columns: list[str], ratio: float = 1.0, k: int = 5, key: str = "txn_id", seed: int = 42) -> DataFrame:
    """Synthetic rows of the smaller class, each between a row and one of its k nearest neighbours (Chawla et al. 2002).

    Every row of that class is a base point, as often as any other give or take one, and neighbours are searched exactly among all of them; the work grows with
    the square of their number. Columns other than label, key and features are null in synthetic rows, and their keys are negative.
    """
    import numpy as np
    import pandas as pd

    counts = class_counts(df, label)
    if len(counts) < 2:
        return df
    small = min(counts, key=lambda c: (counts[c], c))
    n = counts[small]
    wanted = int(max(counts.values()) * ratio) - n
    if wanted <= 0:
        return df
    point = F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))) for c in columns])
    minority = df.filter(F.col(label).eqNullSafe(F.lit(small))).orderBy(draw(key, seed), key).select(point.alias("point"))
    points = df.sparkSession.createDataFrame(minority.rdd.zipWithIndex().map(lambda r: (r[1], r[0]["point"])), "id long, point array<double>").persist()
    # synthetic row i has base row i % n
    turns = F.sequence(F.col("id"), F.lit(wanted - 1).cast("long"), F.lit(n).cast("long"))
    dealt = points.filter(F.col("id") < wanted).join(nearest(points, k), "id", "left").withColumn("i", F.explode(turns))

    def run(batches):
        for pdf in batches:
            out = []
            for i, here, near in zip(pdf["i"], pdf["point"], pdf["near"]):
                rng = np.random.default_rng(seed * 1_000_003 + i)
                other = near[rng.integers(len(near))] if near is not None else here
                out.append((-(i + 1), *(here + rng.random() * (other - here))))
            yield pd.DataFrame(out, columns=["id", *columns])

    made = dealt.select("i", "point", "near").mapInPandas(run, f"id long, {', '.join(f'`{c}` double' for c in columns)}")
    kinds = dict(df.dtypes)
    made = made.select(F.col("id").cast(kinds[key]).alias(key), F.lit(small).cast(kinds[label]).alias(label), *[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in columns])
    return df.unionByName(made, allowMissingColumns=True)


def balance_data(df: DataFrame, label: str, method: str = "none", columns: list[str] | None = None, **options) -> DataFrame:
    """df by one of METHODS, with a column `weight`."""
    if method not in METHODS:
        raise ValueError(f"unknown balancing method {method!r}; valid: {', '.join(METHODS)}")
    if method == "class_weight":
        return df.join(F.broadcast(class_weights(df, label)), label)
    if method == "under_sample":
        df = under_sample(df, label, **options)
    elif method == "smote":
        import warnings

        warnings.warn("synthetic rows may leak patterns of the training rows; measure on real rows only", UserWarning, stacklevel=2)
        df = smote(df, label, columns or [], **options)
    return df.withColumn("weight", F.lit(1.0))
