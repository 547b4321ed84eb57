"""Splits by time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.windows import DAY_US, TIE, TIME, micros


def create_temporal_splits(df: DataFrame) -> DataFrame:
    """split by day of month: test 14-16, val 12-13, train the rest."""
    day = F.dayofmonth(TIME)
    return df.withColumn("split", F.when(day.between(12, 13), "val").when(day.between(14, 16), "test").when((day <= 11) | (day > 16), "train"))


def create_last_days_split(df: DataFrame, days: int = 7) -> DataFrame:
    """split by the last time stamp: test the last `days`, val as many before, train the rest. One pass for the bound, one row broadcast."""
    last = df.agg(F.max(micros()).alias("last_us"))
    age = F.col("last_us") - micros()
    split = F.when(age <= days * DAY_US, "test").when(age <= 2 * days * DAY_US, "val").otherwise("train")
    return df.join(F.broadcast(last)).withColumn("split", split).drop("last_us")


def split_statistics(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("rows"), F.sum("Is Laundering").alias("fraud"), F.min(F.dayofmonth(TIME)).alias("min_day"), F.max(F.dayofmonth(TIME)).alias("max_day"))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("rows"))


def with_history(df: DataFrame, split: str, earlier: str, keys: str = "Account") -> DataFrame:
    """The rows of a split and, as history, the rows of an earlier split of its accounts; is_history tells them apart."""
    here = df.filter(F.col("split") == split)
    past = df.filter(F.col("split") == earlier).join(here.select(keys).distinct(), keys, "left_semi")
    return here.withColumn("is_history", F.lit(False)).unionByName(past.withColumn("is_history", F.lit(True)))


def numbered(df: DataFrame, slices: int = 256) -> DataFrame:
    """row: 0, 1, ... by time and txn_id over the whole table. Rows are numbered within `slices` ranges of time, whose counts (a bounded table) are added up."""
    bounds = [x for x in df.agg(F.percentile_approx(micros(), [i / slices for i in range(1, slices)], 10_000)).first()[0] or []]
    edges = sorted(set(bounds))
    if not edges:
        return df.withColumn("row", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(TIME, TIE)) - 1)
    values = F.array(*[F.lit(x) for x in edges])
    cut = df.withColumn("slice", F.size(F.filter(values, lambda x: x <= micros())))
    counts = cut.groupBy("slice").agg(F.count("*").alias("n"))
    first = counts.select("slice", F.coalesce(F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    own = F.row_number().over(Window.partitionBy("slice").orderBy(TIME, TIE)) - 1
    return cut.withColumn("own", own).join(F.broadcast(first), "slice").withColumn("row", F.col("first") + F.col("own")).drop("slice", "own", "first")


def walk_forward_folds(df: DataFrame, folds: int = 5, val_share: float = 0.1) -> DataFrame:
    """fold, part, and the rows: for each fold an expanding train part and the next `val_share` of rows as val. A row is in several folds."""
    n = df.count()
    size = int(n * val_share)
    if size < 1 or n - folds * size < 1:
        raise ValueError(f"{n} rows are too few for {folds} folds")
    rows = numbered(df)
    starts = F.array(*[F.struct(F.lit(k).alias("fold"), F.lit(n - (folds - k) * size).alias("start")) for k in range(folds)])
    out = rows.withColumn("f", F.explode(starts)).filter(F.col("row") < F.col("f.start") + size)
    return out.withColumns({"fold": F.col("f.fold"), "part": F.when(F.col("row") < F.col("f.start"), "train").otherwise("val")}).drop("f")
