"""Samples, metrics, forests, explanations and streams."""

from __future__ import annotations

import hashlib
import random
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import explain, iforest, learning, metrics, sampling
from ledgerlens.plans import catalogue
from ledgerlens.streaming import accounts as streams


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(1)
    rows = [(i, y := int(rng.random() < 0.2), round(min(1.0, max(0.0, rng.gauss(0.4 + 0.3 * y, 0.2))), 2), rng.random()) for i in range(2000)]
    return spark.createDataFrame(rows, "txn_id long, label int, score double, anomaly_score double").cache()


def test_curve_metrics_against_numpy(spark, scored):
    rows = scored.toPandas()
    y, s = rows["label"].to_numpy(), rows["score"].to_numpy()
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean((pos[:, None] > neg[None]) + 0.5 * (pos[:, None] == neg[None]))
    points = metrics.curve(scored)
    assert metrics.roc_auc(points).first()[0] == pytest.approx(auc)
    cuts = np.unique(s)[::-1]
    tp, fp = np.array([(pos >= c).sum() for c in cuts]), np.array([(neg >= c).sum() for c in cuts])
    ap = np.sum(np.diff(np.r_[0, tp / len(pos)]) * tp / (tp + fp))
    assert metrics.average_precision(points).first()[0] == pytest.approx(ap)
    assert metrics.recall_at_fpr(points, 0.05).first()[0] == pytest.approx(np.interp(0.05, np.r_[0, fp / len(neg)], np.r_[0, tp / len(pos)]), abs=0.02)
    # a monotone change of the score changes nothing
    assert metrics.roc_auc(metrics.curve(scored.withColumn("score", F.exp("score")))).first()[0] == pytest.approx(auc)
    one = metrics.roc_auc(metrics.curve(scored.filter("label = 1"))).first()[0]
    assert one != one
    assert metrics.optimal_threshold(metrics.curve(scored.filter("label = 0").withColumn("score", F.lit(1.0)))).first()[0] == 0.5


def test_psi(spark, scored):
    same = metrics.psi(scored, scored, ["score"]).first()["psi"]
    moved = metrics.psi(scored, scored.withColumn("score", F.col("score") + 0.3), ["score"]).first()["psi"]
    assert same == pytest.approx(0) and moved > 0.25
    d = explain.Drift(["score"], rows=1000)
    with pytest.raises(RuntimeError):
        d.measure(scored)
    with pytest.warns(UserWarning, match="drifted"):
        assert d.summary(d.fit(scored).measure(scored.withColumn("score", F.col("score") + 0.3)))["drifted_features"] == 1


def test_samples(spark, scored):
    counts = sampling.class_counts(scored, "label")
    assert sampling.class_counts(sampling.under_sample(scored, "label", 0.5), "label") == {1: counts[1], 0: counts[1] // 2}
    assert sampling.class_counts(sampling.equal_class_sample(scored, "label", 0.1), "label") == {0: 100, 1: 100}
    assert sampling.keep_positives(scored, "label", 900).count() == 900
    a, b = (sorted(r[0] for r in sampling.sample_rows(scored.repartition(n), 50).select("txn_id").collect()) for n in (2, 7))
    assert a == b
    w = {r["label"]: r["weight"] for r in sampling.class_weights(scored, "label").collect()}
    assert w[1] == pytest.approx(2000 / (2 * counts[1]))
    with pytest.raises(ValueError, match="smote"):
        sampling.balance_data(scored, "label", "other")
    with pytest.warns(UserWarning):
        made = sampling.balance_data(scored, "label", "smote", ["score", "anomaly_score"])
    found = sampling.class_counts(made, "label")
    assert found[0] == found[1]
    bounds = scored.filter("label = 1").agg(F.min("score"), F.max("score")).first()
    assert made.filter("txn_id < 0").filter(~F.col("score").between(*bounds)).count() == 0


def test_smote_uses_every_row(spark):
    """20,500 rows in groups of five, far apart: each group gets as many synthetic rows as it has rows, all inside it."""
    few = spark.range(20_500).selectExpr("id AS txn_id", "1 AS label", "(id div 5) * 1000.0 + id % 5 AS x")
    df = few.unionByName(spark.range(20_500, 61_500).selectExpr("id AS txn_id", "0 AS label", "-1.0 AS x"))
    made = sampling.smote(df, "label", ["x"], k=4).filter("txn_id < 0").toPandas()
    inside = made["x"] % 1000
    assert inside.between(0, 4).all() and ((made["x"] // 1000).value_counts() == 5).all() and len(made) == 20_500
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(60, 2)), 1)
    got = sampling.nearest(spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], "id long, point array<double>"), 3, block=7).collect()
    for r in got:
        d = ((x - x[r["id"]]) ** 2).sum(1)
        d[r["id"]] = np.inf
        assert np.array(r["near"]) == pytest.approx(x[np.lexsort((np.arange(60), d))[:3]])
    assert len(got) == 60


def test_shap_importance_explains_the_whole_test_part(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(explain, "shap_values", lambda df, *a, values=explain.shap_values: seen.append(df.count()) or values(df, *a))
    catalogue.queries()["shap_importance"](spark, "/root/testdata/sf0.01")
    counts = sampling.class_counts(catalogue.transactions(spark, "/root/testdata/sf0.01"), "Is Laundering")
    assert seen == [sum(int(n * 0.3 + 0.5) for n in counts.values())]


def test_registered_models_have_the_published_settings(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(iforest, "score", lambda df, forest: seen.update(forest=forest) or df.withColumn("anomaly_score", F.lit(0.5)))
    monkeypatch.setattr(learning, "experiments", lambda train, test, columns, **options: seen.update(options=options) or [])
    catalogue.queries()["iforest_score"](spark, "/root/testdata/sf0.01")
    catalogue.queries()["model_compare"](spark, "/root/testdata/sf0.01")
    legit = sampling.class_counts(catalogue.transactions(spark, "/root/testdata/sf0.01"), "Is Laundering")[0]
    assert len(seen["forest"].trees) == 200 and seen["forest"].samples == min(10_050, legit) and seen["options"] == {}


def test_fusion(spark, scored):
    best = metrics.best_fusion(metrics.fusion_grid(scored), 0.3)
    assert len(best) == 3 and metrics.best_fusion(metrics.fusion_grid(scored), -1) == metrics.FUSION_DEFAULT


def test_isolation_forest_finds_outliers(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(600, 2)))] + [(1000 + i, 8.0 + i, -9.0) for i in range(5)]
    df = spark.createDataFrame(rows, "txn_id long, a double, b double")
    f = iforest.fit(df, ["a", "b"], trees=40, max_samples=128)
    out = iforest.score(df, f).orderBy(F.col("anomaly_score").desc()).limit(5).collect()
    assert {r["txn_id"] for r in out} == {1000, 1001, 1002, 1003, 1004}
    scores = iforest.score(df, f).agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert 0 < scores[0] < scores[1] <= 1


def test_shapley_values_add_up(spark, scored):
    rows = scored.withColumns({"x": F.col("score") * 2, "weight": F.lit(1.0)})
    for name in ("random_forest", "gradient_boosting"):
        model = learning.build(learning.make(name, trees=4, depth=3), ["score", "anomaly_score", "x"]).fit(rows).stages[-1]
        values = explain.shap_values(rows.limit(50), model, ["score", "anomaly_score", "x"]).toPandas()
        x = rows.limit(50).toPandas()[["score", "anomaly_score", "x"]].to_numpy()
        want = [sum(w * next(v for path, v in leaves if all((r[f] <= t) == left for f, t, left, _ in path)) for w, leaves in explain.export_trees(model)) for r in x]
        total = values["shap_base"] + values[["shap_score", "shap_anomaly_score", "shap_x"]].sum(axis=1)
        assert total.to_numpy() == pytest.approx(np.array(want))
    with pytest.raises(ValueError, match="tree"):
        explain.export_trees(learning.build(learning.make("logistic_regression"), ["score"]).fit(rows).stages[-1])


def test_supervised_stage(spark):
    t = catalogue.transactions(spark, "/root/testdata/sf0.01")
    rows, columns = catalogue.model_rows(t)
    rows = rows.withColumn("anomaly_score", F.rand(1)).cache()
    parts = [rows.filter(F.pmod(F.xxhash64("txn_id"), F.lit(3)) == k) for k in range(3)]
    small = {"forest": (learning.forest, {"trees": 5, "depth": 3}, 1.0, None), "line": (learning.logistic, {"c": 0.1}, 1.0, "robust")}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        out = learning.supervised(*parts, columns, small, folds=3)
    assert out["best"] in small and out["test"]["roc_auc"] > 0.6 and 0 <= out["calibration_error"] < 0.2 and len(out["fusion"]) == 3


def test_contracts(spark, scored):
    with pytest.raises(ValueError, match="valid"):
        learning.make("nothing")
    with pytest.raises(ValueError, match="positive"):
        learning.check_positives(scored.filter("label = 0"))
    with pytest.raises(ValueError):
        learning.select_best({"a": {}})
    with pytest.warns(UserWarning):
        assert learning.misaligned(0.9, 0.5)
    assert learning.record(1, "none", "x", {}, {}, 0.0, 0, "error: y")["status"] == "error: y"


def test_streams(spark, tmp_path):
    from pyspark.sql import types as T

    t = catalogue.transactions(spark, "/root/testdata/sf0.001").drop("Account_HASHED")
    t.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(T.StructType(t.schema.fields)).parquet(str(tmp_path / "in"))
    for name, made, mode in (("hours", streams.hourly_counts(stream), "complete"), ("rows", streams.sequence_features(stream), "append")):
        q = made.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start()
        q.awaitTermination(120)
        q.stop()
    assert spark.sql("select sum(txn_in_hour) from hours").first()[0] == 1000
    assert spark.sql("select count(*), count(prev_amount_paid) from rows").first()[:] == (1000, 985)


def test_forest_is_kept_and_loaded(spark, tmp_path):
    """A scoring run in another session gives the same scores; floats at the sink."""
    from ledgerlens.plans import scoring
    from ledgerlens.sources import io

    rows = spark.createDataFrame([(i, i % 7, float(i % 13), float(i * 37 % 101), int(i % 29 == 0)) for i in range(400)], "txn_id long, a int, b double, c double, `Is Laundering` int")
    io.write_splits(rows.withColumn("split", F.when(F.col("txn_id") < 300, "train").otherwise("test")), str(tmp_path))
    assert dict(spark.read.parquet(f"{tmp_path}/train_features.parquet").dtypes)["b"] == "float"
    out = []
    for fit in (True, False):
        scoring.run(spark, str(tmp_path), f"{tmp_path}/model", fit=fit, trees=20, max_samples=64)
        out.append({r["txn_id"]: r["anomaly_score"] for r in spark.read.parquet(f"{tmp_path}/test_scored.parquet").collect()})
    assert out[0] == out[1] and len(out[0]) == 100 and all(0 < v < 1 for v in out[0].values())


def test_settings(spark, tmp_path):
    from ledgerlens.plans import settings

    (tmp_path / "s.json").write_text('{"cap": 10, "threshold": 0.2}')
    assert settings.load(spark, str(tmp_path / "s.json")) == settings.Settings(cap=10, threshold=0.2)
    for text in ('{"cap": 0}', '{"no_such": 1}'):
        (tmp_path / "s.json").write_text(text)
        with pytest.raises(ValueError):
            settings.load(spark, str(tmp_path / "s.json"))


def test_ranks_in_class(spark):
    """Ranks of slices are those of one sort."""
    rows = [(i, i % 3 if i % 10 else None) for i in range(9000)]
    got = sampling._ranked(spark.createDataFrame(rows, "txn_id long, label int"), "label", "txn_id", 5).collect()
    for label in (0, 1, 2, None):
        mine = sorted((r for r in got if r["label"] == label), key=lambda r: r["rank_in_class"])
        want = sorted((i for i, y in rows if y == label), key=lambda i: (hashlib.md5(f"5:{i}".encode()).hexdigest(), i))
        assert [r["txn_id"] for r in mine] == want and [r["rank_in_class"] for r in mine] == list(range(1, len(want) + 1))


def test_shap_drift(spark):
    """The same table does not drift; one whose feature the model leans on is shifted does."""
    from ledgerlens.operators import explain, learning

    rows = spark.createDataFrame([(i, float(i % 97), float(i * 7 % 31), int(i % 97 > 60)) for i in range(1500)], "txn_id long, a double, b double, label int")
    model = learning.build(learning.make("random_forest", trees=5, depth=4), ["a", "b"]).fit(learning.with_weights(rows, 5.0)).stages[-1]
    drift = explain.ShapDrift(model, ["a", "b"]).fit(rows)
    same = {r["feature"]: r["psi"] for r in drift.measure(rows).collect()}
    moved = {r["feature"]: r["psi"] for r in drift.measure(rows.withColumn("a", F.col("a") / 2)).collect()}
    assert max(same.values()) < 1e-6 and moved["a"] > 0.1
