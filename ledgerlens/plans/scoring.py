"""Command line of the anomaly stage: fits an isolation forest on lawful training rows, keeps it, and adds anomaly_score to every split."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import iforest, learning
from ..sources import io

SPLITS = ("train", "val", "test")


def run(spark: SparkSession, folder: str, model: str, label: str = "Is Laundering", fit: bool = True, **options) -> None:
    """folder: <split>_features.parquet; writes <split>_scored.parquet beside them. fit: anew from the training rows, else the forest kept at `model` is used."""
    splits = {s: spark.read.parquet(f"{folder}/{s}_features.parquet") for s in SPLITS if io.exists(spark, f"{folder}/{s}_features.parquet")}
    if fit:
        columns = learning.feature_columns(splits["train"], label)
        medians = learning.legit_medians(splits["train"], columns, label)
        lawful = learning.fill_non_finite(splits["train"].filter(F.col(f"`{label}`") == 0), medians)
        iforest.save(spark, iforest.fit(lawful, columns, **options), model)
        io.write_parquet(spark.createDataFrame(list(medians.items()), "feature string, value double"), f"{model}/medians", one_file=True)
    forest = iforest.load(spark, model)
    medians = {r["feature"]: r["value"] for r in spark.read.parquet(f"{model}/medians").collect()}  # one row a feature
    for name, df in splits.items():
        io.write_parquet(iforest.score(learning.fill_non_finite(df, medians), forest), f"{folder}/{name}_scored.parquet")


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Score the splits by an isolation forest")
    p.add_argument("--features-dir", required=True)
    p.add_argument("--model-dir", required=True)
    p.add_argument("--keep-model", action="store_true", help="use the forest that is there")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("scoring").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run(spark, a.features_dir, a.model_dir, fit=not a.keep_model)


if __name__ == "__main__":
    main()
