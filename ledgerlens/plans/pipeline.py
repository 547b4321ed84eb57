"""The feature pipeline end to end: splits, corridors of the training rows, all features per split, written as one file set per split."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import hash_pii_column
from ..functions.windows import REFERENCE, WindowProfile
from ..operators import corridors, eda, features, graph, sampling, splits
from ..sources import io


def build_split_features(rows: DataFrame, accounts: DataFrame, toxic: DataFrame | None, profile: WindowProfile = REFERENCE) -> DataFrame:
    """All derived columns of one split. Bank graph and centralities are those of the split's rows."""
    df = features.add_entity_features(features.add_base_features(rows), accounts)
    df = features.compute_derived_features(features.compute_advanced_features(features.compute_rolling_features(df, profile)))
    df = features.add_counterparty_entropy_features(features.add_advanced_rolling_features(df, profile), profile, rows)
    df = graph.compute_bank_centrality_features(df, rows)
    df = features.compute_corridor_risk_score(features.compute_account_network_features(df, profile), profile)
    return corridors.apply_toxic_corridor_features(df, toxic, profile).drop("is_bank_switch")


def build_training_features(transactions: DataFrame, accounts: DataFrame, profile: WindowProfile = REFERENCE, threshold: float = 0.02, min_txns: int = 100, history: bool = False, by: str = "day_of_month") -> DataFrame:
    """The features of all three splits with `split`. Corridors come from the training rows only. history: val and test rows see their accounts' training rows before them."""
    marked = splits.create_temporal_splits(transactions) if by == "day_of_month" else splits.create_last_days_split(transactions)
    toxic = corridors.derive_toxic_corridors(marked.filter("split = 'train'"), threshold, min_txns)
    out = None
    for split in ("train", "val", "test"):
        rows = marked.filter(F.col("split") == split)
        if history and split != "train":
            rows = splits.with_history(marked, split, "train").withColumn("split", F.lit(split))
        made = build_split_features(rows, accounts, toxic, profile)
        if history:
            made = made.filter("not is_history").drop("is_history") if split != "train" else made
        out = made if out is None else out.unionByName(made)
    return out


def build_all_features(spark: SparkSession, transactions_csv: str, accounts_csv: str, output_dir: str, sample: float | None = None, profile: WindowProfile = REFERENCE, history: bool = False) -> DataFrame:
    """Reads (through the Parquet cache), builds, writes <split>_features.parquet and returns the report on the training split."""
    t = io.ensure_parquet(spark, transactions_csv, io.read_transactions_csv)
    a = io.ensure_parquet(spark, accounts_csv, io.read_accounts_csv)
    if sample:
        t = sampling.sample_fraction(t, sample)
    made = build_training_features(hash_pii_column(t, "Account"), a, profile, history=history)
    io.write_splits(made, output_dir)
    return eda.validate_features(spark.read.parquet(f"{output_dir}/train_features.parquet"))


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Build features for fraud detection")
    p.add_argument("--trans-path", required=True)
    p.add_argument("--accounts-path", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--sample", type=float)
    p.add_argument("--history", action="store_true")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("features").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for path in (a.trans_path, a.accounts_path):
        if not io.exists(spark, path):
            raise SystemExit(f"no such file: {path}")
    build_all_features(spark, a.trans_path, a.accounts_path, a.output_dir, a.sample, history=a.history).show()


if __name__ == "__main__":
    main()
