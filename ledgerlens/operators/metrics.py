"""Metrics of scored rows (label, score): every one is an aggregate over the table, exact with tied scores.

A curve has a row for each distinct score; running sums over it are taken within ranges of the score and added up, so no task gets the whole curve.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RANGES = 256


def confusion(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """tp, fp, tn, fn, precision, recall, f1 at a threshold; 0 for 0 / 0."""
    y, p = F.col(label) == 1, F.col(score) >= threshold
    g = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))
    part = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return g.withColumns({"precision": part(tp, tp + fp), "recall": part(tp, tp + fn), "f1": part(2 * tp, 2 * tp + fp + fn)})


def curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """score, tp, fp (rows at or above it), positives, negatives, tpr, fpr, precision: one row a distinct score."""
    by = df.groupBy(F.col(score).alias("score")).agg(F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg"))
    edges = sorted(set(by.agg(F.percentile_approx("score", [i / RANGES for i in range(1, RANGES)], 10_000)).first()[0] or []))
    by = by.withColumn("part", F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e <= F.col("score"))) if edges else F.lit(0))
    sums = by.groupBy("part").agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    after, every = Window.orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = lambda c: F.coalesce(c, F.lit(0))
    tops = sums.select("part", zero(F.sum("p").over(after)).alias("p0"), zero(F.sum("n").over(after)).alias("n0"), F.sum("p").over(every).alias("positives"), F.sum("n").over(every).alias("negatives"))
    down = Window.partitionBy("part").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    at = by.withColumns({"tp": F.sum("pos").over(down), "fp": F.sum("neg").over(down)}).join(F.broadcast(tops), "part")
    at = at.withColumns({"tp": F.col("tp") + F.col("p0"), "fp": F.col("fp") + F.col("n0")})
    return at.select("score", "pos", "neg", "tp", "fp", "positives", "negatives", F.try_divide("tp", "positives").alias("tpr"), F.try_divide("fp", "negatives").alias("fpr"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"))


def roc_auc(points: DataFrame) -> DataFrame:
    """From curve(): the area, NaN if there is one class. A step from the point before is a trapezium, so a point's own sums suffice."""
    tp, fp, pos, neg = F.col("tp"), F.col("fp"), F.col("pos"), F.col("neg")
    area = F.sum(neg * (2 * tp - pos) / 2.0)
    whole = F.max(F.col("positives") * F.col("negatives"))
    return points.agg(F.coalesce(F.try_divide(area, F.nullif(whole, F.lit(0))), F.lit(float("nan"))).alias("roc_auc"))


def average_precision(points: DataFrame) -> DataFrame:
    """Sum of precision times the recall gained at each score."""
    return points.agg(F.coalesce(F.try_divide(F.sum(F.col("precision") * F.col("pos")), F.max("positives")), F.lit(0.0)).alias("average_precision"))


def pr_auc_trapezoid(points: DataFrame) -> DataFrame:
    """Area under the precision-recall polygon, from recall 0 with precision 1. The point before has tp - pos and fp - neg."""
    before_tp, before_fp = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    before = F.coalesce(F.try_divide(before_tp, before_tp + before_fp), F.lit(1.0))
    return points.agg(F.coalesce(F.try_divide(F.sum(F.col("pos") * (F.col("precision") + before) / 2), F.max("positives")), F.lit(0.0)).alias("pr_auc"))


def recall_at_precision(points: DataFrame, levels: tuple[float, ...] = (0.8, 0.9, 0.95)) -> DataFrame:
    """Largest recall at a precision of each level or more, 0 where none reaches it."""
    return points.agg(*[F.coalesce(F.max(F.when(F.col("precision") >= x, F.col("tpr"))), F.lit(0.0)).alias(f"recall_at_{round(x * 100)}_precision") for x in levels])


def recall_at_fpr(points: DataFrame, target: float = 0.01) -> DataFrame:
    """Recall at a false positive rate, between the two points around it linearly (the last point of equal rates counts)."""
    p = F.col("fpr")
    low = F.max(F.when(p <= target, F.struct("fpr", "tpr")))
    high = F.min(F.when(p > target, F.struct("fpr", "tpr")))
    g = points.agg(low.alias("a"), high.alias("b")).select(F.coalesce("a.fpr", F.lit(0.0)).alias("x0"), F.coalesce("a.tpr", F.lit(0.0)).alias("y0"), F.col("b.fpr").alias("x1"), F.col("b.tpr").alias("y1"))
    return g.select(F.coalesce(F.col("y0") + (F.col("y1") - F.col("y0")) * F.try_divide(F.lit(target) - F.col("x0"), F.col("x1") - F.col("x0")), F.col("y0")).alias("recall_at_fpr"))


def optimal_threshold(points: DataFrame, target: float = 0.01) -> DataFrame:
    """The score of the largest recall at a false positive rate within the target (of equal ones the highest score), else 0.5."""
    best = F.max_by("score", F.when(F.col("fpr") <= target, F.struct("tpr", "score")))
    return points.agg(F.coalesce(best, F.lit(0.5)).alias("threshold"))


def all_metrics(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> dict[str, float]:
    """The metrics of one model as numbers; the curve is computed once."""
    points = curve(df, label, score).persist()
    try:
        out: dict[str, float] = {}
        for part in (confusion(df, label, score, threshold), roc_auc(points), average_precision(points), pr_auc_trapezoid(points), recall_at_precision(points), recall_at_fpr(points), optimal_threshold(points)):
            out |= part.first().asDict()
        return out
    finally:
        points.unpersist()


def quantile_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """Distinct exact quantiles with interpolation, from the least value to the largest."""
    found = df.agg(F.percentile(F.col(column), F.array(*[F.lit(i / bins) for i in range(bins + 1)]))).first()[0]
    return sorted({float(x) for x in found or [] if x is not None and not math.isnan(x)})


def in_bins(column, edges: list[float]):
    """Number of the bin [edge, next edge); the last bin holds its end too; null outside."""
    out = F.lit(None).cast("int")
    for i in range(len(edges) - 1):
        inside = (column >= edges[i]) & ((column <= edges[i + 1]) if i == len(edges) - 2 else (column < edges[i + 1]))
        out = F.when(inside, F.lit(i)).otherwise(out)
    return out


def calibration_curve(df: DataFrame, label: str = "label", score: str = "score", bins: int = 10) -> DataFrame:
    """Per quantile bin of the score: rows, mean score, share of positives, their distance."""
    edges = quantile_edges(df, score, bins)
    g = df.withColumn("bin", in_bins(F.col(score), edges)).filter("bin is not null").groupBy("bin").agg(F.count("*").alias("rows"), F.avg(score).alias("mean_score"), F.avg(label).alias("positive_share"))
    return g.withColumn("gap", F.abs(F.col("mean_score") - F.col("positive_share")))


def calibration_error(df: DataFrame, label: str = "label", score: str = "score", bins: int = 10) -> DataFrame:
    return calibration_curve(df, label, score, bins).agg(F.avg("gap").alias("calibration_error"))


def psi(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """feature, psi: population stability over quantile bins of the reference. Both tables are unpivoted, so that one job does all features."""
    edges = {c: quantile_edges(reference, f"`{c}`", bins) for c in columns}

    def counted(df: DataFrame, name: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), in_bins(F.col(f"`{c}`"), edges[c]).alias("bin")) for c in columns])
        rows = df.select(F.explode(pairs).alias("p")).select("p.*").groupBy("feature", "bin").agg(F.count("*").alias(name))
        return rows

    a, b = counted(reference, "a"), counted(current, "b")
    n = reference.agg(F.count("*").alias("na")).join(F.broadcast(current.agg(F.count("*").alias("nb"))))
    # a bin that a table has no row in counts too
    grid = [(c, i) for c in columns for i in range(max(0, len(edges[c]) - 1))]
    every = reference.sparkSession.createDataFrame(grid or [("", 0)], "feature string, bin int").limit(len(grid))
    both = every.join(a, ["feature", "bin"], "left").join(b, ["feature", "bin"], "left").join(F.broadcast(n))
    p, q = F.greatest(F.coalesce("a", F.lit(0)) / F.col("na"), F.lit(eps)), F.greatest(F.coalesce("b", F.lit(0)) / F.col("nb"), F.lit(eps))
    return both.groupBy("feature").agg(F.sum((q - p) * F.log(q / p)).alias("psi"))


def psi_band(value):
    return F.when(value < 0.10, "stable").when(value <= 0.25, "moderate").otherwise("significant")


FUSION_GRID = [(h, l, a) for h in (0.4, 0.5, 0.6) for l in (0.15, 0.2, 0.25) for a in (0.6, 0.7, 0.8)]
FUSION_DEFAULT = (0.5, 0.2, 0.7)


def fuse(df: DataFrame, high: float, low: float, anomaly: float, probability: str = "score", anomaly_score: str = "anomaly_score") -> DataFrame:
    """fused (alarm) and fused_score: sure by probability, or likely and anomalous."""
    p, a = F.col(probability), F.col(anomaly_score)
    sure, both = p >= high, (p >= low) & (a >= anomaly)
    return df.withColumns({"fused": (sure | both).cast("int"), "fused_score": F.when(sure, 0.95).when(both, 0.75).otherwise(0.5 * p)})


def fusion_grid(df: DataFrame, label: str = "label", probability: str = "score", anomaly_score: str = "anomaly_score", grid: list[tuple] | None = None) -> DataFrame:
    """high, low, anomaly, tpr, fpr for each setting: one pass over the rows with three conditional sums a setting."""
    grid = grid or FUSION_GRID
    y, p, a = F.col(label) == 1, F.col(probability), F.col(anomaly_score)
    sums = [F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")]
    for i, (h, l, t) in enumerate(grid):
        alarm = (p >= h) | ((p >= l) & (a >= t))
        sums += [F.count_if(y & alarm).alias(f"tp{i}"), F.count_if(~y & alarm).alias(f"fp{i}")]
    rows = F.array(*[F.struct(F.lit(h).alias("high"), F.lit(l).alias("low"), F.lit(t).alias("anomaly"), F.try_divide(f"tp{i}", "pos").alias("tpr"), F.try_divide(f"fp{i}", "neg").alias("fpr")) for i, (h, l, t) in enumerate(grid)])
    return df.agg(*sums).select(F.explode(rows).alias("r")).select("r.*")


def best_fusion(grid: DataFrame, most_fpr: float = 0.02) -> tuple[float, float, float]:
    row = grid.filter(F.col("fpr") <= most_fpr).orderBy(F.col("tpr").desc(), "fpr", "high", "low", "anomaly").first()
    return (row["high"], row["low"], row["anomaly"]) if row else FUSION_DEFAULT
