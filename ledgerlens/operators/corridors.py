"""Toxic bank corridors: derived from labelled dealings, applied to any."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ratio
from ..functions.windows import REFERENCE, WindowProfile, before, full, lag1, within

KEYS = ["From Bank", "To Bank"]
BROADCAST_ROWS = 200_000


def derive_toxic_corridors(train: DataFrame, threshold: float = 0.02, min_txns: int = 100) -> DataFrame:
    """Corridors of min_txns dealings or more, with fraud_rate and the flag. Use the training split only."""
    rows = train.groupBy(*KEYS).agg(F.count("*").alias("total_txns"), F.sum("Is Laundering").alias("fraud_txns")).filter(F.col("total_txns") >= min_txns)
    rate = F.col("fraud_txns") / F.col("total_txns")
    return rows.withColumns({"fraud_rate": rate, "is_toxic_corridor": (rate >= threshold).cast("byte")})


def derive_corridor_volumes(train: DataFrame, threshold: float = 0.05, min_txns: int = 1000) -> DataFrame:
    """The variant with volumes: corridors of min_txns or more whose fraud rate reaches the threshold."""
    paid = F.col("`Amount Paid`")
    rows = train.groupBy(*KEYS).agg(
        F.count("*").alias("total_txns"), F.sum("Is Laundering").alias("fraud_txns"), F.sum(paid).alias("total_volume"), F.coalesce(F.sum(F.when(F.col("Is Laundering") == 1, paid)), F.lit(0.0)).alias("fraud_volume")
    )
    rows = rows.withColumns({"fraud_rate": F.col("fraud_txns") / F.col("total_txns"), "volume_fraud_rate": ratio(F.col("fraud_volume"), F.col("total_volume"))})
    return rows.filter((F.col("total_txns") >= min_txns) & (F.col("fraud_rate") >= threshold))


def dominant_receivers(corridors: DataFrame, share: float = 0.10) -> DataFrame:
    """Receiving banks with more than `share` of the corridors."""
    counts = corridors.groupBy("To Bank").agg(F.count("*").alias("corridors"))
    total = counts.agg(F.sum("corridors").alias("all"))
    return counts.join(F.broadcast(total), F.col("corridors") > F.col("all") * share).select("To Bank", "corridors", (F.col("corridors") / F.col("all")).alias("share"))


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint where it is known to have at most `rows` rows; one limited count finds out."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def apply_toxic_corridor_features(df: DataFrame, corridors: DataFrame | None = None, profile: WindowProfile = REFERENCE) -> DataFrame:
    """Flag and rate of the row's corridor, the account's dealings and volume over toxic corridors before it. Constants where no usable corridors are given."""
    if corridors is None or not set(KEYS) <= set(corridors.columns):
        return df.withColumns({"is_toxic_corridor": F.lit(0).cast("byte"), "corridor_risk_score": F.lit(0.0), "toxic_corridor_count_28d": F.lit(0).cast("long"), "toxic_corridor_volume_28d": F.lit(0.0), "pct_volume_via_toxic_corridors": F.lit(0.0)})
    held = small(corridors.select(*KEYS, F.col("is_toxic_corridor").alias("toxic"), F.col("fraud_rate").alias("rate")))
    df = df.join(held, KEYS, "left").withColumns({"is_toxic_corridor": F.coalesce("toxic", F.lit(0)).cast("byte"), "corridor_risk_score": F.coalesce("rate", F.lit(0.0))}).drop("toxic", "rate")
    flag, n, frame = F.col("is_toxic_corridor").cast("long"), profile.n500, before(profile.n500)
    volume = F.when(flag == 1, F.col("`Amount Paid`")).otherwise(0.0)
    df = df.withColumns({"toxic_corridor_count_28d": F.coalesce(full(n, F.sum(flag), flag, frame), F.lit(0)), "toxic_corridor_volume_28d": F.coalesce(full(n, F.sum(volume), volume, frame), F.lit(0.0))})
    paid = F.col("total_amount_paid_28d")
    return df.withColumn("pct_volume_via_toxic_corridors", F.col("toxic_corridor_volume_28d") / F.when(paid > 0, paid).otherwise(1.0))


def apply_toxic_corridor_time_features(df: DataFrame, corridors: DataFrame, days: int = 28) -> DataFrame:
    """The flag of the row's corridor, and the account's dealings and volume over toxic corridors in the `days` days up to its row before, 0 for its first row."""
    held = small(corridors.select(*KEYS, F.col("is_toxic_corridor").alias("toxic")))
    df = df.join(held, KEYS, "left").withColumn("is_toxic_corridor", F.coalesce("toxic", F.lit(0)).cast("byte")).drop("toxic")
    flag = F.col("is_toxic_corridor").cast("long")
    df = df.withColumns({"toxic_corridor_count_28d": F.sum(flag).over(within(days)), "toxic_corridor_volume_28d": F.sum(F.col("`Amount Paid`") * flag).over(within(days))})
    return df.withColumns({"toxic_corridor_count_28d": F.coalesce(lag1("toxic_corridor_count_28d"), F.lit(0)), "toxic_corridor_volume_28d": F.coalesce(lag1("toxic_corridor_volume_28d"), F.lit(0.0))})
