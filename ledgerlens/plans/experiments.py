"""Command line of the three-phase experiment runner."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import learning, sampling
from ..sources import io
from ..sources.schemas import require_columns


def main(args: list[str] | None = None) -> list[dict]:
    p = argparse.ArgumentParser(description="Compare balancing methods, models and settings")
    p.add_argument("--data_path", required=True)
    p.add_argument("--output_path", required=True)
    p.add_argument("--target_col", default="Is Laundering")
    p.add_argument("--test_size", type=float, default=0.2)
    p.add_argument("--random_state", type=int, default=42)
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("experiments").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    df = spark.read.parquet(a.data_path)
    require_columns(df, [a.target_col], a.data_path)
    columns = learning.feature_columns(df, a.target_col)
    rows = df.withColumn("label", F.col(f"`{a.target_col}`").cast("int"))
    rows = rows if "txn_id" in df.columns else rows.withColumn("txn_id", F.xxhash64(*df.columns))
    parts = sampling.stratified_split(rows, "label", a.test_size, seed=a.random_state)
    filled = learning.fill_non_finite(parts, learning.impute_values(parts.filter("part = 'train'"), columns)).select("txn_id", "label", "part", *columns).persist()
    log = learning.experiments(filled.filter("part = 'train'"), filled.filter("part = 'test'"), columns, seed=a.random_state)
    io.write_csv(spark.createDataFrame(log), a.output_path)
    for r in learning.top_experiments(log):
        print(r["phase"], r["balancing_method"], r["model_name"], r["params"], r["pr_auc"])
    return log


if __name__ == "__main__":
    main()
