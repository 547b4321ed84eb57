"""Shapley values of tree ensembles (path-dependent, exact), global and local explanations, drift.

For one leaf, the path's features S have Shapley weights that depend on two numbers each: whether the row goes the path's way at all its splits (0 or 1) and the share of training
rows that do. The sum over subsets is read off the coefficients of a product of linear terms, so a leaf costs d^2 vector operations for d features on its path, for all rows
of a batch at once.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import metrics, sampling


def _leaves(node, path: tuple, regression: bool) -> list[tuple[list, float]]:
    """(path of (feature, threshold, goes left, share), value) for each leaf below a JVM node."""
    if node.getClass().getSimpleName() == "LeafNode":
        if regression:
            return [(list(path), float(node.prediction()))]
        stats = list(node.impurityStats().stats())
        return [(list(path), stats[1] / max(sum(stats), 1e-300))]
    split, count = node.split(), float(node.impurityStats().count())
    out = []
    for child, left in ((node.leftChild(), True), (node.rightChild(), False)):
        share = float(child.impurityStats().count()) / max(count, 1e-300)
        out += _leaves(child, (*path, (int(split.featureIndex()), float(split.threshold()), left, share)), regression)
    return out


def export_trees(model) -> list[tuple[float, list]]:
    """(weight, leaves) of each tree of a fitted random forest or boosted trees. Their size is the model's."""
    kind = type(model).__name__
    if kind == "RandomForestClassificationModel":
        trees, weights, regression = model.trees, [1.0 / model.getNumTrees] * model.getNumTrees, False
    elif kind == "GBTClassificationModel":
        trees, weights, regression = model.trees, list(model.treeWeights), True
    else:
        raise ValueError(f"{kind} is no tree ensemble; valid: random forest, gradient boosting")
    return [(w, _leaves(t._java_obj.rootNode(), (), regression)) for w, t in zip(weights, trees)]


def shapley(trees: list[tuple[float, list]], x: np.ndarray) -> tuple[np.ndarray, float]:
    """Values for each row and feature, and the base value they start from."""
    phi, base = np.zeros(x.shape), 0.0
    for weight, leaves in trees:
        for path, value in leaves:
            share, goes = {}, {}
            for f, threshold, left, s in path:
                share[f] = share.get(f, 1.0) * s
                way = x[:, f] <= threshold if left else x[:, f] > threshold
                goes[f] = goes[f] & way if f in goes else way
            base += weight * value * math.prod(share.values())
            d = len(share)
            for j in share:
                # coefficients of the product over the other features of (share + goes * t)
                coefficients = np.zeros((d, len(x)))
                coefficients[0] = 1.0
                for n, k in enumerate((k for k in share if k != j), 1):
                    coefficients[1 : n + 1] = coefficients[1 : n + 1] * share[k] + coefficients[:n] * goes[k]
                    coefficients[0] *= share[k]
                total = sum(coefficients[s] * (math.factorial(s) * math.factorial(d - s - 1) / math.factorial(d)) for s in range(d))
                phi[:, j] += weight * value * total * (goes[j].astype(float) - share[j])
    return phi, base


def shap_values(df: DataFrame, model, columns: list[str], key: str = "txn_id") -> DataFrame:
    """key, shap_base and one column shap_<feature> for each row."""
    trees = export_trees(model)
    held = df.sparkSession.sparkContext.broadcast(trees)
    kinds = dict(df.dtypes)
    schema = f"`{key}` {kinds[key]}, shap_base double, " + ", ".join(f"`shap_{c}` double" for c in columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            phi, base = shapley(held.value, pdf[columns].to_numpy(float))
            yield pd.DataFrame({key: pdf[key], "shap_base": base, **{f"shap_{c}": phi[:, i] for i, c in enumerate(columns)}})

    return df.select(key, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns]).mapInPandas(run, schema)


def global_importance(values: DataFrame, columns: list[str]) -> DataFrame:
    """feature, mean_abs_shap, std_shap, rank."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`shap_{c}`").alias("v")) for c in columns])
    g = values.select(F.explode(pairs).alias("p")).groupBy("p.feature").agg(F.avg(F.abs("p.v")).alias("mean_abs_shap"), F.stddev_pop("p.v").alias("std_shap"))
    from pyspark.sql.window import Window

    return g.withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_abs_shap").desc(), "feature")))


def importance_or_ones(df: DataFrame, model, columns: list[str], key: str = "txn_id") -> dict[str, float]:
    """Mean absolute values, or ones where they cannot be computed."""
    try:
        return {r["feature"]: r["mean_abs_shap"] for r in global_importance(shap_values(df, model, columns, key), columns).collect()}
    except Exception as e:  # noqa: BLE001
        warnings.warn(f"no Shapley values: {e}", UserWarning, stacklevel=2)
        return dict.fromkeys(columns, 1.0)


def select_important(importance: dict[str, float], least: float = 0.001) -> list[str]:
    return [c for c, v in importance.items() if v >= least]


def local_explanations(scored: DataFrame, model, columns: list[str], probability: str = "score", key: str = "txn_id", **options) -> DataFrame:
    """The most probable and the borderline rows: probability, shap_sum, shap_base, case_type and a column per feature."""
    cases = sampling.top_and_borderline(scored, probability, key, **options)
    values = shap_values(cases, model, columns, key)
    total = sum(F.col(f"`shap_{c}`") for c in columns)
    return cases.select(key, F.col(probability).alias("probability"), "case_type").join(values.withColumn("shap_sum", total), key).withColumnsRenamed({f"shap_{c}": c for c in columns})


class Drift:
    """Population stability of features against a reference table."""

    def __init__(self, columns: list[str], threshold: float = 0.10, rows: int = 10_000, key: str = "txn_id") -> None:
        self.columns, self.threshold, self.rows, self.key = columns, threshold, rows, key
        self.reference: DataFrame | None = None

    def fit(self, df: DataFrame) -> Drift:
        self.reference = sampling.sample_rows(df, self.rows, self.key)
        return self

    def measure(self, df: DataFrame) -> DataFrame:
        """feature, psi, band, drifted."""
        if self.reference is None:
            raise RuntimeError("drift needs a reference: call fit first")
        out = metrics.psi(self.reference, sampling.sample_rows(df, self.rows, self.key), self.columns)
        return out.withColumns({"band": metrics.psi_band(F.col("psi")), "drifted": F.col("psi") > self.threshold})

    def summary(self, measured: DataFrame) -> dict:
        row = measured.agg(F.count_if("drifted").alias("drifted_features"), F.max("psi").alias("max_psi"), F.avg("psi").alias("mean_psi")).first().asDict()
        if row["drifted_features"]:
            names = [r[0] for r in measured.filter("drifted").orderBy(F.col("psi").desc()).select("feature").limit(10).collect()]
            warnings.warn(f"drifted features: {', '.join(names)}", UserWarning, stacklevel=2)
        return row


class ShapDrift(Drift):
    """Population stability of a model's Shapley values, against those of a reference table."""

    def __init__(self, model, columns: list[str], **options) -> None:
        super().__init__(columns, **options)
        self.model = model

    def _values(self, df: DataFrame) -> DataFrame:
        values = shap_values(sampling.sample_rows(df, self.rows, self.key), self.model, self.columns, self.key)
        return values.select(self.key, *[F.col(f"`shap_{c}`").alias(c) for c in self.columns])

    def fit(self, df: DataFrame) -> ShapDrift:
        self.reference = self._values(df).persist()
        return self

    def measure(self, df: DataFrame) -> DataFrame:
        if self.reference is None:
            raise RuntimeError("drift needs a reference: call fit first")
        out = metrics.psi(self.reference, self._values(df).persist(), self.columns)
        return out.withColumns({"band": metrics.psi_band(F.col("psi")), "drifted": F.col("psi") > self.threshold})
