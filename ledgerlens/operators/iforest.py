"""Isolation forest (Liu, Ting and Zhou 2008): trees are grown in parallel on samples drawn by hash, rows are scored in batches of vector operations."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sampling import sample_rows

NODES = "tree int, node int, feature int, threshold double, below int, above int, length double"


def average_path(n) -> np.ndarray:
    """Expected path length of an unsuccessful search among n values."""
    n = np.asarray(n, float)
    out = np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))
    return out


def grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (number, feature, threshold, below, above, length): leaves have feature -1 and the path length that their size adds."""
    nodes: list = []
    todo = [(0, np.arange(len(x)), 0)]
    nodes.append(None)
    while todo:
        number, rows, depth = todo.pop()
        low, high = (x[rows].min(0), x[rows].max(0)) if len(rows) else (np.zeros(x.shape[1]), np.zeros(x.shape[1]))
        split = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(split):
            nodes[number] = (number, -1, 0.0, -1, -1, depth + float(average_path(len(rows))))
            continue
        f = int(split[rng.integers(len(split))])
        at = float(rng.uniform(low[f], high[f]))
        a, b = len(nodes), len(nodes) + 1
        nodes += [None, None]
        nodes[number] = (number, f, at, a, b, 0.0)
        inside = x[rows, f] < at
        todo += [(a, rows[inside], depth + 1), (b, rows[~inside], depth + 1)]
    return nodes


@dataclass
class Forest:
    """Nodes of all trees side by side; its size is bounded by trees * 2 * max_samples."""

    columns: list[str]
    samples: int
    trees: list[dict]

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 for anomalies."""
        total = np.zeros(len(x))
        for t in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                f = t["feature"][at]
                open_ = np.flatnonzero(f >= 0)
                if not len(open_):
                    break
                here = at[open_]
                at[open_] = np.where(x[open_, f[open_]] < t["threshold"][here], t["below"][here], t["above"][here])
            total += t["length"][at]
        return 2.0 ** (-(total / max(1, len(self.trees))) / max(float(average_path(self.samples)), 1e-9))


def fit(df: DataFrame, columns: list[str], trees: int = 200, max_samples: int = 10_050, max_rows: int = 2_500_000, key: str = "txn_id", seed: int = 42) -> Forest:
    """df: rows to learn from (those known to be lawful). Each tree gets max_samples rows of at most max_rows, drawn by hash: a tree's group is that many rows."""
    base = sample_rows(df, max_rows, key, seed).select(key, *[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"f{i}") for i, c in enumerate(columns)]).persist()
    n = base.count()
    samples = min(max_samples, n)
    if not n:
        raise ValueError("no rows to learn from")
    # a row belongs to a tree with the chance samples / n, so that no row is copied to trees that do not want it
    chance = min(1.0, 1.2 * samples / n)
    wanted = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.pmod(F.xxhash64(F.col(key), t, F.lit(seed)), F.lit(1 << 20)) < int(chance * (1 << 20)) + 1)
    dealt = base.withColumn("tree", F.explode(wanted))
    limit = max(1, math.ceil(math.log2(max(samples, 2))))

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["tree"].iloc[0])
        x = pdf.sort_values(key)[[f"f{i}" for i in range(len(columns))]].to_numpy(float)
        rng = np.random.default_rng([seed, number])
        x = x[rng.permutation(len(x))[:samples]]
        out = pd.DataFrame(grow(x, rng, limit), columns=["node", "feature", "threshold", "below", "above", "length"])
        return out.assign(tree=number)[["tree", "node", "feature", "threshold", "below", "above", "length"]]

    grown = dealt.groupBy("tree").applyInPandas(tree, NODES).toPandas()  # at most trees * 2 * max_samples nodes
    base.unpersist()
    parts = [g.sort_values("node") for _, g in grown.groupby("tree")]
    return Forest(columns, samples, [{c: g[c].to_numpy() for c in ("feature", "threshold", "below", "above", "length")} for g in parts])


def score(df: DataFrame, forest: Forest, name: str = "anomaly_score") -> DataFrame:
    """df with the anomaly score; the forest is broadcast once, rows come in Arrow batches."""
    held = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def scored(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        f = held.value
        for parts in batches:
            x = np.column_stack([p.to_numpy(float) for p in parts])
            yield pd.Series(f.score(np.nan_to_num(x, posinf=0.0, neginf=0.0)))

    return df.withColumn(name, scored(*[F.col(f"`{c}`").cast("double") for c in forest.columns]))


def save(spark: SparkSession, forest: Forest, path: str) -> None:
    """The forest as Parquet: a row for each node, and one with the columns and the sample size."""
    rows = [(i, n, *[x[n].item() for x in (t["feature"], t["threshold"], t["below"], t["above"], t["length"])]) for i, t in enumerate(forest.trees) for n in range(len(t["feature"]))]
    spark.createDataFrame(rows, NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(forest.columns, forest.samples)], "columns array<string>, samples long").coalesce(1).write.mode("overwrite").parquet(f"{path}/forest")


def load(spark: SparkSession, path: str) -> Forest:
    facts = spark.read.parquet(f"{path}/forest").first()
    grown = spark.read.parquet(f"{path}/nodes").toPandas()  # at most trees * 2 * max_samples nodes
    parts = [g.sort_values("node") for _, g in grown.groupby("tree")]
    return Forest(list(facts["columns"]), facts["samples"], [{c: g[c].to_numpy() for c in ("feature", "threshold", "below", "above", "length")} for g in parts])
