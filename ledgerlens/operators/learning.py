"""Feature selection, imputation, models, validation, calibration and the three-phase experiment runner on pyspark.ml."""

from __future__ import annotations

import math
import time
import warnings
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import RobustScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import finite
from ..sources.schemas import numeric_columns
from . import metrics, sampling, splits

#: Columns whose names hold one of these, in any case, are no features.
NOT_FEATURES = ["Is Laundering", "is_laundering", "Account_HASHED", "Account", "account_id", "transaction_id", "tx_id", "Timestamp", "timestamp", "Date", "date"]
#: Our own tie-breaker is no feature either.
OWN_IDS = ["txn_id"]
#: Columns that are 0, not average, where they are missing.
ZERO_FILLED = [
    "burst_score_1h", "burst_count_24h", "txn_in_hour", "toxic_corridor_count_28d", "toxic_corridor_volume_28d", "txn_count_28d", "txn_count_total", "total_amount_paid_28d", "total_amount_received_28d",
    "amount_paid_last_100", "flag_high_burst", "flag_large_gap", "flag_extreme_consistency", "flag_high_concentration", "flag_heavy_structuring", "anomaly_cascade_score", "cascade_frequency_28d",
]


def feature_columns(df: DataFrame, label: str = "Is Laundering") -> list[str]:
    found = numeric_columns(df, [label], NOT_FEATURES + OWN_IDS)
    if not found:
        raise ValueError("no usable numeric feature")
    return found


def legit_medians(df: DataFrame, columns: list[str], label: str = "Is Laundering") -> dict[str, float]:
    """Exact medians of the lawful rows, all columns in one pass; 0 for a column without values."""
    row = df.filter(F.col(label) == 0).agg(*[F.percentile(finite(F.col(f"`{c}`").cast("double")), F.lit(0.5)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c: float(row[i]) if row[i] is not None else 0.0 for i, c in enumerate(columns)}


def fill_non_finite(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """Null, NaN and infinity become the given values."""
    return df.withColumns({c: F.coalesce(finite(F.col(f"`{c}`").cast("double")), F.lit(v)) for c, v in values.items()})


def variances(df: DataFrame, columns: list[str]) -> dict[str, float]:
    row = df.agg(*[F.var_pop(F.col(f"`{c}`").cast("double")).alias(f"v{i}") for i, c in enumerate(columns)]).first()
    return {c: float(row[i] or 0.0) for i, c in enumerate(columns)}


def variance_filter(df: DataFrame, columns: list[str], least: float = 0.001) -> list[str]:
    """Columns whose population variance is over `least` on this table; use the same list for the other splits."""
    found = variances(df, columns)
    return [c for c in columns if found[c] > least]


def impute_values(df: DataFrame, columns: list[str], zero: list[str] | None = None) -> dict[str, float]:
    """0 for the named columns, the mean for the others. Fit on train, apply to all splits."""
    zero = ZERO_FILLED if zero is None else zero
    row = df.agg(*[F.avg(finite(F.col(f"`{c}`").cast("double"))).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c: 0.0 if c in zero else float(row[i] or 0.0) for i, c in enumerate(columns)}


def check_positives(df: DataFrame, label: str = "label", least: int = 1, few: int = 10) -> int:
    n = df.filter(F.col(label) == 1).count()
    if n <= least:
        raise ValueError(f"{n} positive rows; more than {least} are needed")
    if n < few:
        warnings.warn(f"only {n} positive rows", UserWarning, stacklevel=2)
    return n


# --- models


def logistic(c: float = 1.0, rows: int = 1000, iterations: int = 1000, **_):
    return LogisticRegression(labelCol="label", weightCol="weight", maxIter=min(iterations, 200), regParam=1.0 / (c * max(rows, 1)), elasticNetParam=0.0)


def forest(trees: int = 100, depth: int | None = 10, min_split: int = 2, seed: int = 42, **_):
    return RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=trees, maxDepth=min(depth or 20, 30), minInstancesPerNode=max(1, min_split // 2), seed=seed)


def boosted(trees: int = 100, depth: int = 5, rate: float = 0.1, share: float = 1.0, seed: int = 42, **_):
    return GBTClassifier(labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=share, seed=seed)


#: The registry: name -> maker of an estimator. Add a maker to add a model.
REGISTRY: dict[str, Callable] = {"logistic_regression": logistic, "random_forest": forest, "gradient_boosting": boosted}
#: The candidates of the supervised stage: maker, settings, weight of positives as a share of the imbalance, scaler.
CANDIDATES = {
    "boosted_deep": (boosted, {"trees": 300, "depth": 5, "rate": 0.05, "share": 0.8}, 0.8, None), "boosted_wide": (boosted, {"trees": 400, "depth": 6, "rate": 0.05}, 0.6, None),
    "random_forest": (forest, {"trees": 200, "depth": 10, "min_split": 50}, 1.0, None), "logistic_regression": (logistic, {"c": 0.1}, 1.0, "robust"),
}
GRIDS = {"logistic_regression": {"c": [0.001, 0.01, 0.1, 1.0, 10.0]}, "random_forest": {"trees": [50, 100, 200], "depth": [5, 10, 20, None], "min_split": [2, 5, 10]}}


def make(name: str, **settings):
    if name not in REGISTRY:
        raise ValueError(f"unknown model {name!r}; valid: {', '.join(REGISTRY)}")
    return REGISTRY[name](**settings)


def build(estimator, columns: list[str], scaler: str | None = None) -> Pipeline:
    stages = [VectorAssembler(inputCols=columns, outputCol="raw_features" if scaler else "features", handleInvalid="keep")]
    if scaler:
        kind = RobustScaler if scaler == "robust" else StandardScaler
        stages.append(kind(inputCol="raw_features", outputCol="features"))
    return Pipeline(stages=[*stages, estimator])


def predict(model, df: DataFrame, name: str = "score") -> DataFrame:
    """df with the probability of a positive."""
    out = model.transform(df).withColumn(name, vector_to_array("probability")[1])
    return out.drop("features", "raw_features", "rawPrediction", "probability", "prediction")


def with_weights(df: DataFrame, positive: float = 1.0) -> DataFrame:
    return df.withColumn("weight", F.when(F.col("label") == 1, float(positive)).otherwise(1.0))


def train_and_evaluate(estimator, columns: list[str], train: DataFrame, test: DataFrame, scaler: str | None = None) -> tuple[object, dict]:
    """train: label, weight, features. The fitted pipeline and its metrics on test."""
    if "weight" not in train.columns:
        train = train.withColumn("weight", F.lit(1.0))
    elif not hasattr(estimator, "getWeightCol"):
        warnings.warn("the estimator takes no weights; they are ignored", UserWarning, stacklevel=2)
    model = build(estimator, columns, scaler).fit(train)
    found = metrics.all_metrics(predict(model, test))
    if math.isnan(found["roc_auc"]):
        warnings.warn("one class only: no ROC-AUC", UserWarning, stacklevel=2)
    return model, found


def cross_validate(make_estimator: Callable, columns: list[str], df: DataFrame, folds: int = 5, key: str = "txn_id", seed: int = 42) -> dict[str, float]:
    """Mean and population standard deviation of each metric over stratified folds, NaN left out."""
    rows = sampling.stratified_folds(df, "label", folds, key, seed).persist()
    found = [train_and_evaluate(make_estimator(), columns, rows.filter(F.col("fold") != k), rows.filter(F.col("fold") == k))[1] for k in range(folds)]
    rows.unpersist()
    return summarise(found)


def summarise(found: list[dict]) -> dict[str, float]:
    out = {}
    for name in found[0] if found else []:
        v = [f[name] for f in found if f[name] is not None and not math.isnan(f[name])]
        if v:
            mean = sum(v) / len(v)
            out |= {f"{name}_mean": mean, f"{name}_std": math.sqrt(sum((x - mean) ** 2 for x in v) / len(v))}
    return out


def walk_forward(make_estimator: Callable, columns: list[str], df: DataFrame, folds: int = 5, least_positives: int = 10, least_folds: int = 3) -> dict[str, float]:
    """Recall at 1% false positives over expanding folds: mean, std, conservative (mean - 2 std). Folds with too few positives are passed over."""
    rows = splits.walk_forward_folds(df, folds).persist()
    found = []
    for k in range(folds):
        train, val = (rows.filter((F.col("fold") == k) & (F.col("part") == p)) for p in ("train", "val"))
        if min(train.filter("label = 1").count(), val.filter("label = 1").count()) < least_positives:
            continue
        found.append({"recall": train_and_evaluate(make_estimator(), columns, train, val)[1]["recall_at_fpr"]})
    rows.unpersist()
    if len(found) < least_folds:
        raise ValueError(f"{len(found)} valid folds; {least_folds} are needed")
    s = summarise(found)
    return s | {"conservative": s["recall_mean"] - 2 * s["recall_std"]}


def select_best(results: dict[str, dict]) -> str:
    """The model of the best conservative score."""
    valid = {k: v for k, v in results.items() if "conservative" in v}
    if not valid:
        raise ValueError("no valid model")
    return max(valid, key=lambda k: (valid[k]["conservative"], k))


def misaligned(cross_validated: float, validated: float, tolerance: float = 0.02) -> bool:
    """Whether the two recalls differ by more than the tolerance; warns."""
    if abs(cross_validated - validated) > tolerance:
        warnings.warn(f"recall {cross_validated:.4f} in folds, {validated:.4f} on validation", UserWarning, stacklevel=2)
        return True
    return False


def platt_fit(df: DataFrame, score: str = "score"):
    """A logistic model of the label on the score (L2, C = 1)."""
    return build(LogisticRegression(labelCol="label", regParam=1.0 / max(1, df.count()), standardization=False), [score]).fit(df.select("label", score))


def platt_apply(model, df: DataFrame, score: str = "score", name: str = "calibrated") -> DataFrame:
    return predict(model, df, name)


def supervised(train: DataFrame, val: DataFrame, test: DataFrame, columns: list[str], candidates: dict | None = None, folds: int = 5, seed: int = 42) -> dict:
    """The whole supervised stage: filter, impute, compare by walk-forward folds, fit, calibrate on one half of val, threshold and fusion on the other, test.

    Tables: label, txn_id, Timestamp, features, and anomaly_score where there is one. Returns model, scaler of scores, features, threshold, fusion, metrics.
    """
    check_positives(train)
    kept = variance_filter(train, columns)
    values = impute_values(train, kept)
    train, val, test = (fill_non_finite(x, values) for x in (train, val, test))
    counts = sampling.class_counts(train, "label")
    imbalance = counts.get(0, 0) / max(1, counts.get(1, 0))
    results, failures = {}, {}
    for name, (maker, settings, share, scaler) in (candidates or CANDIDATES).items():
        try:
            results[name] = walk_forward(lambda m=maker, s=settings: m(**s), kept, with_weights(train, share * imbalance), folds)
        except Exception as e:  # noqa: BLE001 - one model that fails must not end the comparison
            failures[name] = str(e)
    best = select_best(results)
    maker, settings, share, scaler = (candidates or CANDIDATES)[best]
    halves = splits.numbered(val)
    n = val.count()
    calibration, evaluation = halves.filter(F.col("row") < n // 2).drop("row"), halves.filter(F.col("row") >= n // 2).drop("row")
    model = build(maker(**settings), kept, scaler).fit(with_weights(train, share * imbalance))
    platt = platt_fit(predict(model, calibration))
    rescaled = lambda x: platt_apply(platt, predict(model, x)).drop("score").withColumnRenamed("calibrated", "score")
    evaluated = rescaled(evaluation).persist()
    found = metrics.all_metrics(evaluated)
    out = {"best": best, "model": model, "platt": platt, "features": kept, "fill": values, "comparison": results, "failures": failures, "evaluation": found, "threshold": found["threshold"]}
    out["calibration_error"] = metrics.calibration_error(evaluated).first()[0]
    out["aligned"] = not misaligned(results[best]["recall_mean"], found["recall_at_fpr"])
    if "anomaly_score" in evaluated.columns:
        out["fusion"] = metrics.best_fusion(metrics.fusion_grid(evaluated))
    else:
        warnings.warn("no anomaly score: no fusion", UserWarning, stacklevel=2)
        out["fusion"] = None
    evaluated.unpersist()
    out["test"] = metrics.all_metrics(rescaled(test))
    return out


# --- experiments


def record(phase: int, balancing: str, model: str, params: dict, found: dict, seconds: float, rows: int, status: str = "ok") -> dict:
    import json

    names = {"pr_auc": "average_precision", "roc_auc": "roc_auc", "precision": "precision", "recall": "recall", "f1": "f1"}
    recalls = {f"recall_at_{k}%_precision": found.get(f"recall_at_{k}_precision") for k in (80, 90, 95)}
    return {"timestamp": time.strftime("%Y-%m-%dT%H:%M:%S"), "phase": phase, "balancing_method": balancing, "model_name": model, "params": json.dumps(params), **{k: found.get(v) for k, v in names.items()},
            "wall_time_seconds": seconds, "n_train_samples": rows, "status": status, **recalls}


def experiments(train: DataFrame, test: DataFrame, columns: list[str], balancing: list[str] | None = None, models: list[str] | None = None, draws: int = 10, seed: int = 42, settings: dict | None = None) -> list[dict]:
    """Phase 1 varies the balancing under logistic regression, phase 2 the model, phase 3 the settings of the best model. A run that fails is a row with its error."""
    log: list[dict] = []
    settings = settings or {}

    def run(phase: int, method: str, name: str, params: dict) -> dict:
        began, rows = time.time(), 0
        try:
            balanced = sampling.balance_data(train, "label", method, columns).persist()
            rows = balanced.count()
            found = train_and_evaluate(make(name, rows=rows, **{**settings.get(name, {}), **params}), columns, balanced, test)[1]
            row = record(phase, method, name, params, found, time.time() - began, rows)
        except Exception as e:  # noqa: BLE001
            row = record(phase, method, name, params, {}, time.time() - began, rows, f"error: {e}")
        log.append(row)
        return row

    good = lambda rows: [r for r in rows if r["status"] == "ok" and r["pr_auc"] is not None]
    best = lambda rows: max(rows, key=lambda r: r["pr_auc"])
    first = good([run(1, m, "logistic_regression", {}) for m in balancing or ["none", "class_weight", "under_sample"]])
    method = best(first)["balancing_method"] if first else "none"
    second = good([run(2, method, m, {}) for m in models or ["logistic_regression", "random_forest"]])
    if not second:
        raise RuntimeError("all models failed")
    winner = best(second)["model_name"]
    if winner in GRIDS:
        for params in sampling.draw_combinations(GRIDS[winner], draws, seed):
            run(3, method, winner, params)
    return log


def top_experiments(log: list[dict], n: int = 5) -> list[dict]:
    return sorted((r for r in log if r["pr_auc"] is not None), key=lambda r: -r["pr_auc"])[:n]
