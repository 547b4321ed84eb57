"""Quality classifier by importance resampling.

Generative models of hashed n-grams are fitted to target text and to raw text, and a document's log importance weight is the summed log ratio
target / raw of the n-grams it has (Xie, Santurkar, Ma and Liang, 2023). There are two targets: rows labelled good, and rows labelled not toxic. The raw model
counts every document of the table. The smaller of the two weights counts, so that fair prose does not make up for abuse. Documents are drawn by Gumbel
top-k: weight / temperature plus Gumbel noise seeded by the id, the k largest stay. Each weight is measured from the threshold that held-out labels
set, and k is the number of documents at or above it: an estimate of how many are like the target.

N-grams: tokens are runs of letters (lower case), digits or marks. Words, pairs of words and 6 bytes of a word (with the space before it) tell
content; runs of three and of five forms tell shape: a token's form is its case and kind, a mark itself, or, for a token that came up to 8 tokens
before, how far back that was. Raw counts are scaled to the target's size and both are smoothed alike (`smooth`). An n-gram has a ratio of its own, for or
against the target, where the models differ by a factor of exp(`least_effect`) and beyond chance, by a deviate of `least_z`. Chance is judged by
documents, where one that has an n-gram c times counts 1 + floor(log2 c) times, so that one long or repetitive document does not make a model. All other
n-grams are one class, the rest, with one ratio, so that a long document may have an odd n-gram now and then.

Bounded: the target models take at most `max_labelled` labelled rows, those of the smallest hashes of doc_id; models have fixed sizes (BUCKETS). The raw model and everything
else cover all rows. Defined cases: null and empty texts have no n-grams and weight 0, so they are kept; rows without labels, with null labels or repeated labels
(the least quality, the largest toxic) do not hurt; without good labels and others nothing is rejected; rows of null ids are weighed like others; rows of one id are told
apart by text; an empty table gives an empty table; extra columns pass through select_documents whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, null_again, row_keys, written
from .exact_dedup import drop_rows
from .textops import RangeHash, in_chunks, mix

CONTENT, SHAPE, PIECE = 1 << 20, 1 << 16, 6
BUCKETS = CONTENT + SHAPE
BACK = 8  # tokens that a repeated token is looked for behind it
TARGETS = ("good", "harmless")

#: Kinds of bytes: 0 white space, 1 letters (all bytes beyond ASCII too), 2 digits, 3 marks and the rest.
_kind = np.full(256, 3, np.uint8)
_kind[[0x20, *range(0x09, 0x0E)]] = 0
_kind[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_kind[48:58] = 2
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def _runs_of(values: np.ndarray, owner: np.ndarray, n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n values in a row within one text, and the text of each."""
    if len(values) < n:
        return np.zeros(0, np.uint64), owner[:0]
    h = np.full(len(values) - n + 1, salt, np.uint64)
    for k in range(n):
        h = _pair(h, values[k : len(values) - n + 1 + k])
    whole = owner[: len(h)] == owner[n - 1 :]
    return h[whole], owner[: len(h)][whole]


def grams(texts: list[bytes], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of each text, in order: text number, bucket and how often it comes; and how many n-grams each text has. known: the buckets that matter."""
    data = np.frombuffer(b" " + b"\n".join(texts) + b"\n", np.uint8)
    kind, low = _kind[data], _lower[data]
    edge = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1], True])
    start, end = edge[:-1], edge[1:]
    token = kind[start] > 0
    start, end = start[token], end[token]
    at = np.r_[0, 1 + np.cumsum([len(t) + 1 for t in texts])]
    owner = np.searchsorted(at, start, side="right") - 1
    word = RangeHash(low)(start, end)
    upper = data != low
    capitals = np.r_[0, np.cumsum(upper)]
    n_upper = capitals[end] - capitals[start]
    k = kind[start].astype(np.uint64)
    form = np.where(n_upper == 0, 0, np.where(n_upper == end - start, 2, np.where(upper[start] & (n_upper == 1), 1, 3))).astype(np.uint64)
    form = np.where(k == 3, word, k << np.uint64(8) | form)
    for back in range(min(BACK, len(word) - 1), 0, -1):
        same = np.flatnonzero((word[back:] == word[:-back]) & (owner[back:] == owner[:-back])) + back
        form[same] = np.uint64(1 << 16 | back)
    # pieces of words: PIECE bytes that end inside a word and begin in it or at the byte before
    letters = np.flatnonzero(k == 1)
    n = np.maximum(end[letters] - start[letters] + 2 - PIECE, 0)
    first = np.repeat(start[letters] - 1, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    flat = np.where(kind == 1, low, 32).astype(np.uint64)
    piece = np.zeros(len(first), np.uint64)
    for i in range(PIECE):
        piece = piece << np.uint64(8) | flat[first + i]
    streams = [(*_runs_of(word, owner, 1, 1), 0, CONTENT), (*_runs_of(word, owner, 2, 2), 0, CONTENT), (mix(piece), np.repeat(owner[letters], n), 0, CONTENT)]
    streams += [(*_runs_of(form, owner, i, i), CONTENT, SHAPE) for i in (3, 5)]
    parts, total = [], np.zeros(len(texts), np.int64)
    for h, o, base, size in streams:
        total += np.bincount(o, minlength=len(texts))
        bucket = (h % np.uint64(size)).astype(np.int64) + base
        if known is not None:
            keep = known[bucket]
            bucket, o = bucket[keep], o[keep]
        parts.append(o.astype(np.int64) * BUCKETS + bucket)
    both, count = np.unique(np.concatenate(parts), return_counts=True)
    return both // BUCKETS, both % BUCKETS, count, total


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int, seed: int) -> DataFrame:
    """text, good, harmless, held of at most `most` labelled rows. held: a quarter for the thresholds; rows that share the least hash of their first words are on one side."""
    one = labels.filter("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg((F.min("quality") == 1).alias("fair"), (F.max("toxic") == 0).alias("harmless"))
    picked = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", as_text(docs, "text").alias("text")).join(F.broadcast(picked), "doc_id")
    return written(rows.select("text", (F.col("fair") & F.col("harmless")).alias("good"), "harmless", (F.pmod(F.xxhash64(F.substring("text", 1, 40), F.lit(seed)), F.lit(4)) == 0).alias("held")), "labelled")


def gram_counts(rows: DataFrame, *flags: str) -> DataFrame:
    """bucket and, for all rows and for those of each flag, the documents that have it, each 1 + floor(log2) of its count there (n_all, n_flag), and its count (c_all, c_flag); bucket -1: all documents and n-grams. rows: text and the flags."""
    names = ("all", *flags)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, c = (np.zeros((len(names), BUCKETS + 1), kind) for kind in (np.int32, np.int64))
        for pdf, texts in in_chunks(batches, "text"):
            owner, bucket, count, total = grams(texts)
            for i, told in enumerate([np.ones(len(texts), bool), *[pdf[f].to_numpy(bool) for f in flags]]):
                mine = told[owner]
                n[i, :BUCKETS] += np.bincount(bucket[mine], np.frexp(count[mine])[1], BUCKETS).astype(np.int32)
                c[i, :BUCKETS] += np.bincount(bucket[mine], count[mine], BUCKETS).astype(np.int64)
                n[i, BUCKETS] += told.sum()
                c[i, BUCKETS] += total[told].sum()
        some = np.flatnonzero(n[0])
        for at in np.array_split(some, 1 + len(some) // 100_000):
            yield pd.DataFrame({"bucket": np.where(at == BUCKETS, -1, at).astype(np.int32), **{f"n_{x}": v[at] for x, v in zip(names, n)}, **{f"c_{x}": v[at] for x, v in zip(names, c)}})

    # a task gives up to BUCKETS rows whatever it reads, so it takes four splits
    rows = rows.select("text", *flags)
    rows = rows.coalesce(max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions() // 4))
    columns = [f"{k}_{x}" for k in "nc" for x in names]
    schema = ", ".join(["bucket int", *[f"{c} {'int' if c[0] == 'n' else 'long'}" for c in columns]])
    return rows.mapInPandas(run, schema).groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns])


def fit(docs: DataFrame, sample: DataFrame, smooth: float = 0.5, least_z: float = 5.0, least_effect: float = 0.7) -> dict[str, tuple[np.ndarray, np.ndarray, float]]:
    """For each target the buckets with a ratio of their own, these log ratios, and that of the rest. The driver gets these alone, BUCKETS at most."""
    raw = written(gram_counts(docs.select(as_text(docs, "text").alias("text"))), "raw-grams", narrow=True)
    near = written(gram_counts(sample, *TARGETS).drop("n_all", "c_all"), "target-grams", narrow=True)
    both = raw.join(near, "bucket", "left").fillna(0)
    sizes = both.filter("bucket < 0").first()
    out = {}
    for t in TARGETS:
        out[t] = np.zeros(0, np.int64), np.zeros(0), 0.0
        if sizes is None or not sizes[f"c_{t}"]:
            continue
        target, whole = float(sizes[f"c_{t}"]), float(sizes["c_all"])
        scale = min(1.0, target / whole)
        ratio = F.log((F.col(f"c_{t}") + smooth) / target) - F.log((F.col("c_all") * scale + smooth) / (whole * scale))
        # twice the log likelihood ratio of two shares of documents against one: a squared normal deviate by chance
        near_n, all_n, pooled = F.col(f"n_{t}"), F.col("n_all"), (F.col(f"n_{t}") + F.col("n_all")) / float(sizes[f"n_{t}"] + sizes["n_all"])
        told = F.coalesce(near_n * F.log(near_n / (pooled * float(sizes[f"n_{t}"]))), F.lit(0.0)) + all_n * F.log(all_n / (pooled * float(sizes["n_all"])))
        told = both.filter("bucket >= 0").select("bucket", ratio.alias("ratio"), f"c_{t}", "c_all", told.alias("told")).filter((F.abs("ratio") >= least_effect) & (2 * F.col("told") >= least_z**2))
        rows = told.orderBy("bucket").collect()
        rest = np.log(max(1.0, target - sum(r[f"c_{t}"] for r in rows)) / target) - np.log(max(1.0, whole - sum(r["c_all"] for r in rows)) / whole)
        out[t] = np.array([r["bucket"] for r in rows], np.int64), np.array([r["ratio"] for r in rows]), float(rest)
    return out


def weigh(rows: DataFrame, model: dict[str, tuple[np.ndarray, np.ndarray, float]], *keep: str) -> DataFrame:
    """The columns of keep and the log weight for each target. rows: text and the columns of keep, none of them null."""
    held = rows.sparkSession.sparkContext.broadcast(model)  # BUCKETS values a target at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, ratio = np.zeros(BUCKETS, bool), {}
        for t, (at, values, rest) in held.value.items():
            known[at] = True
            ratio[t] = np.zeros(BUCKETS)
            ratio[t][at] = values - rest
        for pdf, texts in in_chunks(batches, "text"):
            owner, bucket, count, total = grams(texts, known)
            yield pdf[list(keep)].assign(**{t: np.bincount(owner, v[bucket] * count, len(texts)) + total * held.value[t][2] for t, v in ratio.items()})

    kinds = dict(rows.dtypes)
    return rows.select("text", *keep).mapInPandas(run, ", ".join([*[f"{c} {kinds[c]}" for c in keep], *[f"{t} double" for t in model]]))


def threshold(scores: np.ndarray, bad: np.ndarray, price: float = 1.0) -> float:
    """The score below which a document is rejected: least (missed bad + price * rejected good), in the middle of the gap."""
    order = np.argsort(scores, kind="stable")
    s, b = scores[order], bad[order]
    missed, lost = b.sum() - np.cumsum(b), np.cumsum(~b)
    cost = np.r_[b.sum(), missed + price * lost]
    ends = np.r_[True, s[1:] != s[:-1], True]  # a cut falls between different scores
    cost = np.where(ends, cost, np.inf)
    i = int(np.argmin(cost))
    if i == 0:
        return float(s[0]) - 1.0 if len(s) else -1.0
    return float(s[i - 1] + s[i]) / 2 if i < len(s) else float(s[-1])


def limits(held_out: DataFrame, model: dict[str, tuple[np.ndarray, np.ndarray, float]]) -> dict[str, float]:
    """For each target the weight below which a document is rejected; without rows on both sides there is none."""
    pdf = weigh(held_out.withColumnsRenamed({t: f"is_{t}" for t in TARGETS}), model, *[f"is_{t}" for t in TARGETS]).toPandas()  # part of the bounded sample
    out = {}
    for t in TARGETS:
        bad = ~pdf[f"is_{t}"].to_numpy(bool)
        out[t] = min(-1e-6, threshold(pdf[t].to_numpy(), bad)) if bad.any() and not bad.all() else -1e30
    return out


def marked(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, temperature: float = 0.25, seed: int = 42, **options) -> DataFrame:
    """row_id, row_hash (common.row_keys), weight, key, kept for every row of docs."""
    sample = labelled_rows(docs, labels, max_labelled, seed)
    model = fit(docs, sample.filter("not held"), **options)
    least = limits(sample.filter("held"), model)
    row_id, row_hash = row_keys(docs)
    scored = weigh(docs.select(as_text(docs, "text").alias("text"), row_id.alias("row_id"), row_hash.alias("row_hash")), model, "row_id", "row_hash")
    weight = F.least(*[F.col(t) - least[t] for t in TARGETS])
    uniform = (F.pmod(F.xxhash64("row_id", "row_hash", F.lit(seed + 1)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = scored.select("row_id", "row_hash", weight.alias("weight")).withColumn("key", F.col("weight") / temperature - F.log(-F.log(uniform)))
    rows = written(rows, "weights")
    return rows.withColumn("kept", _top(rows, "key", rows.filter("weight >= 0").count()))


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, weight, key, kept for every row of docs."""
    return marked(docs, labels, **options).select(null_again("row_id", "row_hash").alias("doc_id"), "weight", "key", "kept")


def _top(rows: DataFrame, column: str, k: int, bins: int = 4096, ids: tuple[str, ...] = ("row_id", "row_hash")):
    """Whether a row is among the k largest of column, ties by ids: a histogram finds the k-th value's bin, again and again until it is small."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None or k <= 0:
        return F.lit(False)
    left = k
    for _ in range(12):
        width = (high - low) / bins
        inside = rows.filter((F.col(column) >= low) & (F.col(column) <= high))
        if width <= 0 or low + width <= low or inside.count() <= 10_000:
            break
        counts = dict(inside.groupBy(F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).alias("b")).count().collect())  # bins rows
        for b in sorted(counts, reverse=True):
            if counts[b] >= left:
                break
            left -= counts[b]
        # a hair wider than the bin, so that rounding loses no row; rows over it are counted anew
        new_low, new_high = low + b * width - width * 1e-6, low + (b + 1) * width + width * 1e-6
        low, high = max(low, new_low), min(high, new_high)
        left = k - rows.filter(F.col(column) > high).count()
    last = rows.filter((F.col(column) >= low) & (F.col(column) <= high)).orderBy(F.col(column).desc(), *ids).limit(left).orderBy(column, *[F.col(i).desc() for i in ids]).first()
    if last is None:
        return F.col(column) > high
    return (F.col(column) > last[column]) | ((F.col(column) == last[column]) & (F.struct(*ids) <= F.struct(*[F.lit(last[i]).alias(i) for i in ids])))


def select_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """docs without the rows that the classifier rejects, all columns kept."""
    return drop_rows(docs, marked(docs, labels, **options).filter("not kept").select("row_id", "row_hash"))
