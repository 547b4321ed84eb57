"""Sources and sinks: CSV, Parquet and JSON on any path that Spark opens, a Parquet cache of CSV files, and a JSON-lines log of runs."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import ACCOUNTS_CSV, TRANSACTIONS_CSV

STAMPS = ("yyyy/MM/dd HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_transactions_csv(spark: SparkSession, path: str, formats: tuple[str, ...] = STAMPS) -> DataFrame:
    """Transactions with banks as text (leading zeros stay) and time stamps of any of the formats. txn_id: one for each row, unique but not dense."""
    text = TRANSACTIONS_CSV.fieldNames()
    raw = spark.read.option("header", True).schema(", ".join(f"`{c}` string" for c in text)).csv(path)
    kinds = {f.name: f.dataType for f in TRANSACTIONS_CSV}
    stamp = F.coalesce(*[F.try_to_timestamp(F.col("Timestamp"), F.lit(f)) for f in formats])
    columns = [stamp.alias("Timestamp") if c == "Timestamp" else F.col(f"`{c}`").try_cast(kinds[c]).alias(c) for c in text]
    return raw.select(F.monotonically_increasing_id().alias("txn_id"), *columns)


def read_accounts_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(ACCOUNTS_CSV).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ensure_parquet(spark: SparkSession, csv_path: str, read, parquet_path: str | None = None, refresh: bool = False) -> DataFrame:
    """The Parquet copy of a CSV file, made at the first call (or anew with refresh) by read(spark, csv_path). Ids that read gives are kept in it."""
    target = parquet_path or csv_path.removesuffix(".csv") + ".parquet"
    if refresh or not exists(spark, target):
        read(spark, csv_path).write.mode("overwrite").option("compression", "snappy").parquet(target)
    return spark.read.parquet(target)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, one_file: bool = False) -> None:
    out = (df.coalesce(1) if one_file else df).write.mode("overwrite").option("compression", "snappy")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """For reports of few rows: one file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def narrowed(df: DataFrame) -> DataFrame:
    """Doubles as floats, for sinks: half the bytes."""
    return df.select(*[F.col(f"`{f.name}`").cast("float").alias(f.name) if f.dataType == T.DoubleType() else F.col(f"`{f.name}`") for f in df.schema])


def write_splits(features: DataFrame, folder: str) -> None:
    """<split>_features.parquet for each split, doubles as floats."""
    features = narrowed(features)
    for split in ("train", "val", "test"):
        write_parquet(features.filter(F.col("split") == split).drop("split"), f"{folder}/{split}_features.parquet")


class RunLog:
    """Runs with parameters and metrics as JSON lines, in one file a run, on any path that Spark opens. What goes wrong here stops nothing."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def log(self, name: str, params: dict, metrics: dict) -> bool:
        row = json.dumps({"run": name, "time": time.time(), "params": params, "metrics": metrics}, default=str)
        try:
            self.spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("append").text(self.folder)
        except Exception:  # noqa: BLE001
            return False
        return True


def describe(df: DataFrame) -> DataFrame:
    return df.summary("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")
