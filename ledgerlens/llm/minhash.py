"""MinHash near-dedup: universal hash minima, banding, signature verification, exact confirmation, star components.

Texts of one shingle set are one class first, so exact copies cost one row. Each class has `hashes` minima; `hashes / rows` bands of `rows` minima
each bring together classes that share a band. With 32 bands of 4, a pair of similarity 0.8 shares none with a chance of 5e-8. Within a bucket every
class is compared with the bucket's least one, not with every other; then components are built, and buckets whose members fell into
several components are searched for links between different components, in blocks, inside the task that has the block's texts. Members of split buckets of over
`many` classes, such as texts that share a template, are told apart by further minima first: 64 bands of 8, which part texts of similarity 0.5
sixteen times better and miss a pair of 0.8 with a chance of 8e-6. So every pair that
shares a bucket is either connected already or compared, and no pairs are written out but links.
A pair is compared by its signatures first and confirmed on the two full shingle sets.

Defined cases: null and empty texts and those without words have no shingles and no links; texts of fewer than `words` words have one
shingle, the whole sequence; rows with a null id are left alone (component null, kept); rows are told apart by id and text: of rows of one id with different
texts each has the component of its own text, and those of one id and one text stand or fall together; an empty table gives an empty table; extra columns
pass through drop_near_copies whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exact_dedup
from .bands import Search, class_texts, keyed, renamed
from .common import lookup, null_again, written
from .textops import Words, in_chunks, mix

SETS = "row_id long, row_hash long, n_shingles long, set_key binary, signature binary"


def shingle_sets(texts: list[bytes], words: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, text by text and sorted, and where each text's begin."""
    w = Words(texts, lower)
    counts = np.diff(w.first)
    h, n = w.hash, len(w.hash)
    s = np.zeros(n, np.uint64)
    owner = np.repeat(np.arange(len(texts)), counts)
    whole = np.zeros(n, bool)
    if n >= words:
        run = np.zeros(n - words + 1, np.uint64)
        for i in range(words):
            run = mix(run * np.uint64(0x9E3779B97F4A7C15) + h[i : n - words + 1 + i])
        s[: len(run)] = run
        whole[: len(run)] = owner[: len(run)] == owner[words - 1 :]
    for i in np.flatnonzero((counts > 0) & (counts < words)):  # short texts: the whole sequence, told apart by its length
        first, v = w.first[i], np.zeros(1, np.uint64)
        for x in range(first, w.first[i + 1]):
            v = mix(v * np.uint64(0x9E3779B97F4A7C15) + h[x : x + 1])
        s[first : first + 1], whole[first] = mix(v + np.uint64(counts[i])), True
    s, owner = s[whole], owner[whole]
    order = np.lexsort((s, owner))
    s, owner = s[order], owner[order]
    new = np.r_[True, (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])] if len(s) else np.zeros(0, bool)
    s, owner = s[new], owner[new]
    return s, np.searchsorted(owner, np.arange(len(texts) + 1))


def signatures(sets: np.ndarray, first: np.ndarray, hashes: int, seed: int) -> np.ndarray:
    """The minima of `hashes` multiply-shift functions for each non-empty set, one row a set."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 64, hashes, dtype=np.uint64)
    full = np.flatnonzero(np.diff(first))
    out = np.zeros((len(first) - 1, hashes), np.uint32)
    if len(full):
        v = np.empty_like(sets)
        for i in range(hashes):
            np.multiply(sets, a[i], out=v)
            np.add(v, b[i], out=v)
            out[full, i] = np.minimum.reduceat(v, first[full]) >> np.uint64(32)
    return out


def _sketched(rows: DataFrame, words: int, hashes: int, seed: int) -> DataFrame:
    """row_id, row_hash, n_shingles, set_key (equal for equal sets), signature of row_id, row_hash, text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, texts in in_chunks(batches, "text"):
            sets, first = shingle_sets(texts, words)
            sizes, sig = np.diff(first), signatures(sets, first, hashes, seed)
            keys = np.zeros((len(texts), 2), np.uint64)
            for k, part in enumerate((mix(sets), mix(sets ^ np.uint64(0xA5A5A5A5A5A5A5A5)))):
                keys[:, k] = np.diff(np.r_[np.uint64(0), np.cumsum(part)][first])
            yield pd.DataFrame({"row_id": pdf["row_id"].to_numpy(), "row_hash": pdf["row_hash"].to_numpy(), "n_shingles": sizes, "set_key": [k.tobytes() + int(n).to_bytes(8, "little") for k, n in zip(keys, sizes)], "signature": [x.tobytes() for x in sig]})

    return rows.mapInPandas(run, SETS)


def linked_across(texts: list[bytes], component: np.ndarray, side: np.ndarray | None, words: int, percent: int) -> list[tuple[int, int]]:
    """Links that join components: shared shingles are counted through an inverted index, against all texts that are not yet connected."""
    sets, first = shingle_sets(texts, words)
    sizes = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), sizes)
    by = np.argsort(sets, kind="stable")
    posted, postings = sets[by], owner[by]
    low, high = np.searchsorted(posted, sets, "left"), np.searchsorted(posted, sets, "right")
    root = component.copy()
    out = []
    for x in range(len(texts)):
        open_ = root != root[x]
        if side is not None:
            open_ &= side != side[x]
        if not open_.any():
            continue
        a, b = low[first[x] : first[x + 1]], high[first[x] : first[x + 1]]
        n = b - a
        at = np.repeat(a - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)
        both = np.bincount(postings[at], minlength=len(texts))
        for y in np.flatnonzero(open_ & (100 * both >= percent * (sizes + sizes[x] - both)) & (both > 0)):
            if root[y] != root[x]:
                out.append((x, int(y)))
                root[root == root[y]] = root[x]
    return out


def mark_rows(docs: DataFrame, words: int = 5, percent: int = 80, hashes: int = 128, rows: int = 4, slack: float = 0.2, seed: int = 42, many: int = 1000, fine: tuple[int, int] = (512, 8)) -> DataFrame:
    """row_id, row_hash, n_shingles, and of the row that stands for its component keep_id, keep_hash (null for rows without a component)."""
    sets = written(_sketched(keyed(docs), words, hashes, seed), "sets")
    is_linked = "n_shingles > 0 and row_hash & 1 = 0"
    linked = sets.filter(is_linked)
    grouped = linked.groupBy("set_key").agg(F.min(F.struct("row_id", "row_hash", "signature")).alias("m"), F.count("*").alias("copies"))
    # written down, so a node's number is the same for all that read it
    classes = written(grouped.select(F.monotonically_increasing_id().alias("node"), "set_key", "m.*", "copies"), "classes", narrow=True)

    def prepare(texts: list[bytes]) -> list[np.ndarray]:
        sets, first = shingle_sets(texts, words)
        return np.split(sets, first[1:-1])

    def same(a: np.ndarray, b: np.ndarray) -> bool:
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= percent * (len(a) + len(b) - both)

    def across(texts: list[bytes], component: np.ndarray, side: np.ndarray | None, alike: Callable) -> list[tuple[int, int]]:
        return linked_across(texts, component, side, words, percent)

    search = Search(docs, np.uint32, rows, percent / 100 - slack, prepare, same, across)
    labels, split = search.labels(classes, hashes)
    labels = renamed(labels, written(search.links_across(split.filter(F.col("n") <= many), classes), "more-links"))
    # members of large split buckets have further minima, with longer bands, so that texts that share but a template part
    large = written(split.filter(F.col("n") > many).select("node").distinct(), "crowded", narrow=True)
    if large.limit(1).count():
        search.rows = fine[1]
        again = class_texts(docs, classes, large).select(F.col("node").alias("row_id"), F.lit(0).cast("long").alias("row_hash"), "text")
        signatures_ = _sketched(again, words, fine[0], seed + 1).select(F.col("row_id").alias("node"), "signature")
        finer = written(signatures_.join(classes.select("node", "row_id", "row_hash"), "node"), "fine-signatures")
        labels = renamed(labels, written(search.links_across(search.split(finer, fine[0], labels), finer), "fine-links"))
    whole = labels.join(classes.select("node", "set_key", "row_id", "row_hash", "copies"), "node")
    heads = written(whole.groupBy("component").agg(F.min(F.struct("row_id", "row_hash")).alias("head"), F.count("*").alias("size")), "heads", narrow=True)
    named = lookup(whole.select("component", "set_key", "copies"), heads, "component", "size").select("set_key", "copies", F.col("head.row_id").alias("keep_id"), F.col("head.row_hash").alias("keep_hash"))
    placed = lookup(linked.drop("signature"), written(named, "class-components", narrow=True), "set_key", "copies").select("row_id", "row_hash", "n_shingles", "keep_id", "keep_hash")
    none = F.lit(None).cast("long")
    alone = sets.filter(f"not ({is_linked})").select("row_id", "row_hash", "n_shingles", none.alias("keep_id"), none.alias("keep_hash"))
    return placed.unionByName(alone)


def near_copies(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    own = null_again("row_id", "row_hash")
    marks = mark_rows(docs, **options).select(own.alias("doc_id"), "n_shingles", F.coalesce("keep_id", own).alias("component_id"))
    return marks.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """docs without the rows that another of their component stands for, all columns kept. A row goes by id and text: another text of its id stays."""
    later = mark_rows(docs, **options).filter("keep_id <> row_id or keep_hash <> row_hash")
    return exact_dedup.drop_rows(docs, later.select("row_id", "row_hash"))
