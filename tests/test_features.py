"""Micro-fixtures with results worked out by hand, and properties of the features."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import scalars
from ledgerlens.functions.windows import SMALL, WindowProfile
from ledgerlens.operators import corridors, features, graph, splits
from ledgerlens.plans import pipeline
from ledgerlens.sources import io, views

SF = "/root/testdata/sf0.001"
DAY = datetime(2024, 1, 1)
COLUMNS = "txn_id long, Timestamp timestamp, `From Bank` string, Account string, `To Bank` string, Account_duplicated_0 string, `Amount Paid` double, `Amount Received` double, `Is Laundering` int"


def table(spark, rows):
    """rows: (id, hours, account, to bank, receiver, paid)."""
    made = [(i, DAY + timedelta(hours=h), "1", a, b, r, p, p, 0) for i, h, a, b, r, p in rows]
    return scalars.hash_pii_column(spark.createDataFrame(made, COLUMNS), "Account")


def column(df, name, key="txn_id"):
    return [r[name] for r in df.orderBy(key).select(name).collect()]


def test_warm_up_wants_a_full_window_before_the_row(spark):
    df = table(spark, [(i, i, "a", "1", "x", float(i)) for i in range(7)])
    out = features.compute_rolling_features(df, WindowProfile(n24=2, n168=3, n500=5))
    assert column(out, "mean_amount_paid_28d") == [0, 0, 0, 0, 0, 2.0, 3.0]
    assert column(out, "median_amount_paid_28d") == [0, 0, 0, 0, 0, 2.0, 3.0]
    assert column(out, "txn_count_24h") == [0, 1, 2, 2, 2, 2, 2] and column(out, "txn_count_28d") == [0, 1, 2, 3, 4, 5, 5]
    assert column(out, "amount_vs_baseline_ratio")[:2] == pytest.approx([0, 1], abs=1e-5)


def test_accounts_do_not_bleed(spark):
    df = table(spark, [(i, i, "ab"[i % 2], str(i % 3), f"r{i}", 10.0 * i) for i in range(12)])
    out = features.compute_advanced_features(features.compute_rolling_features(df, WindowProfile(n500=3)))
    assert column(out, "prev_amount_paid")[:4] == [None, None, 0.0, 10.0]
    assert column(out, "counterparty_diversity_7d")[:2] == [0, 0] and column(out, "is_bank_switch")[:2] == [0, 0]


def test_ties_are_broken_by_id(spark):
    df = table(spark, [(i, 0, "a", "1", "x", float(i)) for i in (3, 1, 2)])
    assert column(features.add_base_features(df), "txn_rank_in_account_history") == [1, 2, 3]


def test_far_end_of_a_time_window_is_open(spark):
    rows = [(1, 0, "a", "1", "x", 1.0), (2, 168, "a", "1", "x", 1.0)]
    assert column(features.compute_time_window_features(table(spark, rows)), "txn_count_7d") == [1, 1]
    near = table(spark, rows).withColumn("Timestamp", F.when(F.col("txn_id") == 1, F.expr("Timestamp + interval 1 microsecond")).otherwise(F.col("Timestamp")))
    assert column(features.compute_time_window_features(near), "txn_count_7d") == [1, 2]


def test_null_receivers(spark):
    df = table(spark, [(1, 1, "a", "1", None, 1.0), (2, 2, "a", "1", None, 1.0), (3, 3, "a", "1", "x", 1.0)])
    out = features.compute_network_centrality_proxy(features.compute_relationship_asymmetry(df))
    assert column(out, "account_pair_directed")[0] is None and column(out, "out_degree_approximation") == [2, 2, 2]
    assert column(features.compute_counterparty_entropy(df), "counterparty_entropy_28d")[0] == pytest.approx(-(2 / 3 * math.log(2 / 3) + 1 / 3 * math.log(1 / 3)))
    assert out.count() == 3


def test_digits_and_multiples(spark):
    df = table(spark, [(i, i, "a", "1", "x", v) for i, v in enumerate([0.0, 0.053, 100.0, 500.0, 1000.0, -2500.0, 1.2e8])])
    out = features.add_base_features(df)
    assert column(out, "first_digit") == [None, 5, 1, 5, 1, 2, 1] and column(out, "is_round_1000") == [1, 0, 0, 0, 1, 0, 1]


def test_cascade_is_null_where_a_flag_is(spark):
    df = table(spark, [(i, i, "a", "1", "x", 1000.0) for i in range(6)])
    out = features.add_advanced_rolling_features(df, WindowProfile(n5=2, n24=2, n50=4, n100=2, n120=2, n500=3))
    assert [x is None for x in column(out, "anomaly_cascade_score")] == [True] * 3 + [False] * 3


def test_both_directions_share_an_undirected_pair(spark):
    df = table(spark, [(1, 1, "a", "1", "b", 1.0), (2, 2, "b", "1", "a", 1.0)])
    a, b = column(features.compute_relationship_asymmetry(df), "account_pair_undirected")
    assert a == b


def test_corridor_bounds(spark):
    rows = [(i, i % 20, "a", "1" if i < 99 else "2", "x", 1.0) for i in range(199)]
    df = table(spark, rows).withColumn("Is Laundering", F.when(F.col("txn_id").isin(100, 101), 1).otherwise(0))
    found = corridors.derive_toxic_corridors(df).collect()
    assert [(r["To Bank"], r["total_txns"], r["is_toxic_corridor"]) for r in found] == [("2", 100, 1)]
    plain = corridors.apply_toxic_corridor_features(df, None)
    assert column(plain, "corridor_risk_score") == [0.0] * 199


def test_pagerank_against_numpy(spark):
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "a", 1), ("c", "c", 3), ("d", "a", 1), ("d", "e", 1)]
    df = spark.createDataFrame(edges, "src string, dst string, weight long")
    nodes = "abcde"
    m = np.zeros((5, 5))
    for s, d, w in edges:
        m[nodes.index(d), nodes.index(s)] = w
    out = m.sum(0)
    r = np.full(5, 0.2)
    for _ in range(200):
        r = 0.03 + 0.85 * (m @ np.where(out > 0, r / np.where(out > 0, out, 1), 0) + r[out == 0].sum() / 5)
    got = {x["node"]: x["pagerank"] for x in graph.pagerank(df, tolerance=1e-12).collect()}
    assert [got[n] for n in nodes] == pytest.approx(r.tolist(), abs=1e-6) and sum(got.values()) == pytest.approx(1)
    assert {x["node"]: (x["out_degree"], x["in_degree"]) for x in graph.degrees(df).collect()}["c"] == (1, 2)


def test_large_graphs_are_ranked_by_joins(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    edges = spark.createDataFrame([("a", "b", 2), ("b", "a", 1), ("c", "c", 3), ("c", "a", 1), ("a", "d", 1)], "src string, dst string, weight long")
    here, there = ({x["node"]: x["pagerank"] for x in graph.pagerank(edges, driver_edges=k, most=20).collect()} for k in (100, 1))
    assert here == pytest.approx(there, abs=1e-5)


def test_splits(spark):
    t = views.transactions(spark, SF)
    assert {r["split"]: r["rows"] for r in splits.split_counts(splits.create_temporal_splits(t)).collect()} == {"train": 828, "val": 87, "test": 85}
    numbers = sorted(r["row"] for r in splits.numbered(t, slices=8).select("row").collect())
    assert numbers == list(range(1000))
    with pytest.raises(ValueError, match="too few"):
        splits.walk_forward_folds(t.limit(5))


def test_csv_with_a_doubled_header(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,Amount Paid,Payment Currency,Payment Format,Is Laundering\n2022/09/01 00:20,010,A1,020,B2,5.5,USD,5.5,USD,Wire,1\n2022-09-01 00:21:00,011,A1,020,B3,,USD,x,USD,Wire,0\n")
    rows = io.ensure_parquet(spark, str(path), io.read_transactions_csv).orderBy("Timestamp").collect()
    assert [(r["From Bank"], r["Account_duplicated_0"], r["Amount Paid"]) for r in rows] == [("010", "B2", 5.5), ("011", "B3", None)]
    assert (tmp_path / "t.parquet").exists()


def test_whole_pipeline(spark):
    t, a = views.transactions(spark, SF), views.accounts(spark, SF)
    out = pipeline.build_split_features(splits.create_temporal_splits(t).filter("split = 'val'"), a, None, SMALL)
    assert out.count() == 87 and len(out.columns) == len(set(out.columns))
    for name in ("hour_sin", "txn_count_28d", "anomaly_cascade_score", "counterparty_entropy_28d", "pagerank_to_bank", "corridor_std_amount_28d", "pct_volume_via_toxic_corridors", "entity_bank_count"):
        assert name in out.columns
