"""The directed graph of banks: edges weighted by dealings, degrees, PageRank."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .corridors import small

DRIVER_EDGES = 500_000


def bank_edges(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("`From Bank`").alias("src"), F.col("`To Bank`").alias("dst")).agg(F.count("*").alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    """node, out_degree, in_degree: distinct neighbours, loops counted, 0 where there are none."""
    ends = edges.select(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return ends.groupBy("node").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))


def _ranks_here(rows: list, damping: float, most: int, tolerance: float) -> list[tuple]:
    nodes = sorted({x for r in rows for x in (r["src"], r["dst"])}, key=lambda x: (x is None, x))
    at = {x: i for i, x in enumerate(nodes)}
    src, dst, w = (np.array(x) for x in ([at[r["src"]] for r in rows], [at[r["dst"]] for r in rows], [float(r["weight"]) for r in rows]))
    n = len(nodes)
    out = np.bincount(src, w, n)
    share, dangling, rank = w / out[src], out == 0, np.full(n, 1 / n)
    for _ in range(most):
        last, rank = rank, (1 - damping) / n + damping * (np.bincount(dst, share * rank[src], n) + rank[dangling].sum() / n)
        if np.abs(rank - last).sum() < n * tolerance:
            break
    return [(x, float(v)) for x, v in zip(nodes, rank)]


def pagerank(edges: DataFrame, damping: float = 0.85, most: int = 100, tolerance: float = 1e-6, driver_edges: int = DRIVER_EDGES) -> DataFrame:
    """node, pagerank. A graph of at most driver_edges edges is ranked by the driver; a larger one by joins, with the lineage cut every few rounds."""
    spark = edges.sparkSession
    kind = edges.schema["src"].dataType.simpleString()
    if (n := edges.limit(driver_edges + 1).count()) <= driver_edges:
        rows = edges.collect() if n else []
        return spark.createDataFrame(_ranks_here(rows, damping, most, tolerance) if rows else [], f"node {kind}, pagerank double")
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    shares = edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share")).persist()
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct().join(out.select(F.col("src").alias("node"), F.lit(True).alias("has_out")), "node", "left").persist()
    count = nodes.count()
    rank = nodes.select("node", "has_out", F.lit(1.0 / count).alias("pagerank"))
    for i in range(most):
        loose = rank.filter("has_out is null").agg(F.coalesce(F.sum("pagerank"), F.lit(0.0))).first()[0]
        got = shares.join(rank, shares["src"] == rank["node"]).groupBy("dst").agg(F.sum(F.col("share") * F.col("pagerank")).alias("got"))
        new = nodes.join(got, nodes["node"] == got["dst"], "left").select("node", "has_out", ((1 - damping) / count + damping * (F.coalesce("got", F.lit(0.0)) + loose / count)).alias("pagerank"))
        if i % 5 == 4:
            new = new.checkpoint()
            moved = new.join(rank.select("node", F.col("pagerank").alias("last")), "node").agg(F.sum(F.abs(F.col("pagerank") - F.col("last")))).first()[0]
            rank = new
            if moved < count * tolerance:
                break
        rank = new
    return rank.select("node", "pagerank")


def compute_bank_centrality_features(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """from_bank_out_degree, pagerank_from_bank, to_bank_in_degree, pagerank_to_bank, over all rows given (or the plain rows that they were made from)."""
    edges = bank_edges(source or df).persist()
    known = degrees(edges).join(pagerank(edges), "node")
    start = known.select(F.col("node").alias("From Bank"), F.col("out_degree").alias("from_bank_out_degree"), F.col("pagerank").alias("pagerank_from_bank"))
    end = known.select(F.col("node").alias("To Bank"), F.col("in_degree").alias("to_bank_in_degree"), F.col("pagerank").alias("pagerank_to_bank"))
    return df.join(small(start), "From Bank", "left").join(small(end), "To Bank", "left")
