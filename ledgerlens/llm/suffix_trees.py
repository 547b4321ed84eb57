"""Substring dedup over words with prefix-partitioned suffix trees.

A window is `window` consecutive words of one document. Each word of a window whose word sequence starts earlier too (smaller doc_id, or the same
document and an earlier start) is removed; windows are judged on the input.

Suffixes that may repeat (see anchors) are dealt to groups that a task can hold. Where few segments share an anchor, the group is that of the anchor. Where many do, each window's suffix goes by its own
prefix, which is lengthened by half, from the anchor's length to the whole window, until few enough share it. A task takes groups `local` rows at a
time and builds the deep part of their suffix tree: suffixes are sorted by prefix doubling, common prefixes of neighbours are read off the doubling's ranks, and
their intervals of `window` words or more are the internal nodes, with depth, leaves and parent. A node is a maximal repeat to the right;
the leaves below a topmost deep node are the places of one repeated window, of which the first stays. A passage that more rows than a task holds share in full is
one leaf each way: such windows are grouped by their text itself and joined with the least place, so it is never gathered.

Defined cases: null text has no words; fewer words than a window, nothing to remove; null ids come last; rows that repeat id and text are one
document; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import SEGMENT, count_slots, packed, segments, unpacked
from .common import as_text, lookup, null_again, row_keys, written
from .exact_dedup import membership_filter, split_by_filter
from .textops import RangeHash, Words, groups_of, in_chunks

RUN = "doc_id long, row_hash long, start long, windows int"


def row_key(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash (common.row_keys: a null id is 0, with an odd hash), text: what tells rows apart."""
    row_id, row_hash = row_keys(docs)
    return docs.select(row_id.alias("doc_id"), row_hash.alias("row_hash"), as_text(docs, "text").alias("text"))


class WordSegments:
    def __init__(self, window: int, gram: int) -> None:
        self.window, self.gram = window, gram

    def __call__(self, texts: list[bytes]) -> tuple:
        w = Words(texts)
        n = len(w.hash)
        if n < self.window:
            return (*segments(np.zeros(0, np.uint64), self.window, self.gram, np.zeros(len(texts) + 1, np.int64)), np.zeros(0, np.uint64), w)
        at = np.arange(n - self.gram + 1)
        ranges = RangeHash(w.hash, values=True)
        text, start, k, key, lead = segments(ranges(at, at + self.gram), self.window, self.gram, w.first)
        return text, start, k, key, lead, ranges(start, start + k - 1 + self.window), w


def word_codes(w: Words) -> np.ndarray:
    """A number from 1 for each word, equal for equal words: hashes group them, their bytes decide."""
    _, first, code = np.unique(w.hash, return_index=True, return_inverse=True)
    size = w.end - w.start
    twin = first[code]
    flat = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    if (size == size[twin]).all() and (w.data[np.repeat(w.start, size) + flat] == w.data[np.repeat(w.start[twin], size) + flat]).all():
        return code + 1
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w.data[a:b].tobytes(), len(known) + 1) for a, b in zip(w.start, w.end)], np.int64)


class DeepTree:
    """The nodes of `least` symbols or more of the suffix tree of some suffixes.

    codes: symbols from 1; end: for each symbol where its text ends; at: the suffixes' places. order: the suffixes (as numbers in `at`) in the order of the tree's leaves. left, right, depth,
    parent: an internal node's first and last leaf, its length and the node above it (-1: none of `least` symbols), parents first.
    """

    def __init__(self, codes: np.ndarray, end: np.ndarray, at: np.ndarray, least: int) -> None:
        levels, h, n = [codes.astype(np.int64)], 1, len(codes)
        longest = int((end - np.arange(n)).max()) if n else 0
        while h < longest:
            rank = levels[-1]
            more = np.zeros(n, np.int64)
            inside = np.flatnonzero(np.arange(n) + h < end)
            more[inside] = rank[inside + h]
            key, rank = np.unique(rank << 32 | more, return_inverse=True)
            levels.append(rank.astype(np.int64) + 1)
            h *= 2
            if len(key) == n:
                break
        self.order = np.argsort(levels[-1][at], kind="stable") if len(at) else np.zeros(0, np.int64)
        place = at[self.order]
        a, b = place[:-1], place[1:]
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            x, y = a + common, b + common
            open_ = (x < end[a]) & (y < end[b])
            same = open_ & (levels[k][np.where(open_, x, 0)] == levels[k][np.where(open_, y, 0)])
            common += np.where(same, np.minimum(1 << k, end[a] - x), 0)
        self.common = common
        left, right, depth, parent = [], [], [], []
        above, known = np.full(len(at), -1), 0
        for d in range(least, int(common.max()) + 1 if len(common) else 0):
            deep = np.r_[False, common >= d, False]
            edge = np.flatnonzero(deep[1:] != deep[:-1])
            first, last = edge[::2], edge[1::2]  # leaves
            if not len(first):
                break
            here = np.minimum.reduceat(np.r_[common, 0], np.stack([first, last], 1).reshape(-1))[::2] == d
            first, last = first[here], last[here]
            left.append(first)
            right.append(last)
            depth.append(np.full(len(first), d))
            parent.append(above[first])
            size = last - first + 1
            leaves = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            above[leaves] = np.repeat(known + np.arange(len(first)), size)
            known += len(first)
        none = [np.zeros(0, np.int64)]
        self.left, self.right, self.depth, self.parent = (np.concatenate(x or none) for x in (left, right, depth, parent))

    def tops(self) -> np.ndarray:
        """For each suffix its topmost deep node, or a number of its own: equal for suffixes that share `least` symbols."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.arange(len(self.order)) + len(self.depth)
        for i in np.flatnonzero(self.parent < 0).tolist():
            out[self.order[self.left[i] : self.right[i] + 1]] = i
        return out


def maximal_repeats(texts: list[str], least: int) -> dict[tuple[str, ...], int]:
    """The word sequences of `least` words or more that two places of the texts share and that cannot be lengthened to either side for all their places, and how many places have them."""
    w = Words([t.encode() for t in texts])
    end = np.repeat(w.first[1:], np.diff(w.first))
    codes = word_codes(w)
    tree = DeepTree(codes, end, np.arange(len(codes)), least)
    before = np.r_[0, codes[:-1]]
    before[w.first[:-1][np.diff(w.first) > 0]] = 0
    out = {}
    for a, b, d in zip(tree.left, tree.right, tree.depth):
        places = tree.order[a : b + 1]
        if len(set(before[places].tolist())) > 1 or not before[places[0]]:
            p = int(places[0])
            out[tuple(w.data[x:y].tobytes().decode() for x, y in zip(w.start[p : p + d], w.end[p : p + d]))] = len(places)
    return out


PLACED = "content binary, places binary, n long, is_null long, doc long, start long"


def _by_prefix(todo: DataFrame, window: int, gram: int, hot: int) -> tuple[list[DataFrame], DataFrame]:
    """todo: PLACED, a window each. Groups of equal prefixes that a task can hold, as SEGMENT rows, and runs of the windows that too many share in full."""
    small, length = [], gram
    while length < window:
        prefix = F.substring_index(F.col("content").cast("string"), " ", length)
        keyed = todo.withColumn("prefix", prefix)
        counts = keyed.groupBy("prefix").agg(F.count("*").alias("m"), F.sum("n").alias("k")).filter("k > 1")
        known = lookup(keyed, written(counts, "prefixes"), "prefix", "m").filter("m is not null")
        small.append(known.filter(F.col("m") <= hot).select(F.xxhash64("prefix").alias("key"), F.lit(1).alias("windows"), F.lit(0).alias("lead"), "content", "places"))
        todo = written(known.filter(F.col("m") > hot).select(*todo.columns), "long-prefixes")
        if not todo.limit(1).count():
            break
        length = min(window, length + max(1, length // 2))

    def later(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            places, row_of = unpacked(list(pdf["places"]))
            head = pdf[["is_null", "doc", "start"]].to_numpy(np.int64)[row_of]
            rest = ((places[:, 1] & 1) != head[:, 0]) | (places[:, 0] != head[:, 1]) | (places[:, 2] != head[:, 2])
            yield pd.DataFrame({"doc_id": places[rest, 0], "row_hash": places[rest, 1], "start": places[rest, 2], "windows": np.ones(int(rest.sum()), np.int32)})

    heads = todo.groupBy("content").agg(F.min(F.struct("is_null", "doc", "start")).alias("head"), F.count("*").alias("m"), F.sum("n").alias("k")).filter("k > 1").drop("k")
    joined = lookup(todo.select("content", "places"), written(heads, "window-heads"), "content", "m").filter("m is not null")
    return small, joined.select("places", "head.*").mapInPandas(later, RUN)


def repeated_runs(rows: DataFrame, window: int, gram: int, hot: int = 4000, max_bits: int = 28, local: int = 1 << 13) -> DataFrame:
    """doc_id, row_hash, start, windows: runs of windows that start earlier elsewhere. rows: as row_key gives them."""
    find = WordSegments(window, gram)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    held = count_slots(rows, find, hot, max_bits, size // 5 * 2 // (window - gram + 2))

    def cold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, texts in in_chunks(batches, "text"):
            *parts, w = find(texts)
            keep = np.flatnonzero(held.test("twice", parts[3]) & ~held.test("hot", parts[3]))
            text, start, n, key, lead, content = (x[keep] for x in parts)
            raw, a, b = w.data.tobytes(), w.start[start].tolist(), w.end[start + n + window - 2].tolist()
            yield packed(pdf, text, start - w.first[text], n, key, lead, content, lambda i: raw[a[i] : b[i]])

    def tree(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows_ in groups_of(batches, ["key"], local):
            w = Words(list(rows_["content"]))
            n = rows_["windows"].to_numpy().astype(np.int64)
            places, row_of = unpacked(list(rows_["places"]))
            # a row's own first place comes before its others window by window, so only that can hold a node's first
            order = np.lexsort((places[:, 1], places[:, 2], places[:, 0], places[:, 1] & 1, row_of))
            places, row_of = places[order], row_of[order]
            own = np.flatnonzero(np.r_[True, row_of[1:] != row_of[:-1]])
            owner = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            node = DeepTree(word_codes(w), np.repeat(w.first[1:], np.diff(w.first)), w.first[owner] + at, window).tops()
            doc, row, begin = places[own, 0][owner], places[own, 1][owner], places[own, 2][owner] + at
            order = np.lexsort((row, begin, doc, row & 1, node))
            head = order[np.flatnonzero(np.r_[True, node[order][1:] != node[order][:-1]])]
            first = np.empty(int(node.max()) + 1, np.int64)
            first[node[head]] = head
            # repeated rows of one document share its first place
            later = (doc != doc[first[node]]) | (begin != begin[first[node]]) | ((row & 1) != (row[first[node]] & 1))
            yield _runs(doc, row, begin, later)
            others = np.ones(len(places), bool)
            others[own] = False
            mine = places[own][row_of]
            same = (places[:, 0] == mine[:, 0]) & (places[:, 2] == mine[:, 2]) & ((places[:, 1] & 1) == (mine[:, 1] & 1))
            # a repeated row at the first place itself goes as that does
            twin = np.flatnonzero(others & same)
            if len(twin):
                length = n[row_of[twin]]
                spot = np.repeat((np.cumsum(n) - n)[row_of[twin]], length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                yield _runs(doc[spot], np.repeat(places[twin, 1], length), begin[spot], later[spot])
            rest = np.flatnonzero(others & ~same)
            yield pd.DataFrame({"doc_id": places[rest, 0], "row_hash": places[rest, 1], "start": places[rest, 2], "windows": n[row_of[rest]].astype(np.int32)})

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The windows of hot anchors, each different one of a chunk once, words joined by one space."""
        for pdf, texts in in_chunks(batches, "text"):
            text, start, n, key, _, _, w = find(texts)
            keep = np.flatnonzero(held.test("hot", key))
            text, start, n = np.repeat(text[keep], n[keep]), start[keep], n[keep]
            at = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            raw, a, b = w.data.tobytes(), w.start[at].tolist(), w.end[at + window - 1].tolist()
            doc, row = pdf["doc_id"].to_numpy()[text], pdf["row_hash"].to_numpy()[text]
            found: dict[bytes, list] = {}
            for x, y, d, r, p in zip(a, b, doc.tolist(), row.tolist(), (at - w.first[text]).tolist()):
                found.setdefault(b" ".join(raw[x:y].split()), []).append((d, r, p))
            firsts = np.array([min((r & 1, d, p) for d, r, p in of) for of in found.values()], np.int64).reshape(-1, 3)
            yield pd.DataFrame({"content": list(found), "places": [np.array(of, np.int64).tobytes() for of in found.values()], "n": np.array([len(of) for of in found.values()], np.int64), "is_null": firsts[:, 0], "doc": firsts[:, 1], "start": firsts[:, 2]})

    dealt, runs = rows.mapInPandas(cold, SEGMENT), None
    if held.any_hot:
        small, runs = _by_prefix(written(rows.mapInPandas(single, PLACED), "hot-windows"), window, gram, hot)
        for part in small:
            dealt = dealt.unionByName(part)
    found = dealt.repartition("key").sortWithinPartitions("key").mapInPandas(tree, RUN)
    return found if runs is None else found.unionByName(runs)


def _runs(doc: np.ndarray, row: np.ndarray, begin: np.ndarray, later: np.ndarray) -> pd.DataFrame:
    """The windows that are later ones, neighbours joined (their order is that of the segments)."""
    at = np.flatnonzero(later)
    d, r, b = doc[at], row[at], begin[at]
    new = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (r[1:] != r[:-1]) | (b[1:] != b[:-1] + 1)]) if len(at) else at
    return pd.DataFrame({"doc_id": d[new], "row_hash": r[new], "start": b[new], "windows": np.diff(np.r_[new, len(at)]).astype(np.int32)})


def with_runs(rows: DataFrame, runs: DataFrame, run, schema: str) -> DataFrame:
    """Applies run, which hands doc_id and row_hash on, to rows with `starts` and `windows`, lists of their runs. Rows without runs are not shuffled; a document's runs are as many as it is long at most."""
    runs = written(runs, "runs")
    listed = runs.groupBy("doc_id", "row_hash").agg(F.collect_list("start").alias("starts"), F.collect_list("windows").alias("windows"))
    bits, blocks = membership_filter(runs.select("row_hash").distinct(), "row_hash")
    likely, clean = split_by_filter(rows, "row_hash", bits, blocks)
    joined = likely.join(listed, ["doc_id", "row_hash"], "left")
    plain = clean.withColumns({"starts": F.lit(None).cast("array<long>"), "windows": F.lit(None).cast("array<int>")})
    out = plain.mapInPandas(run, schema).unionByName(joined.select(*plain.columns).mapInPandas(run, schema))
    return out.withColumn("doc_id", null_again("doc_id", "row_hash")).drop("row_hash")


def covered(starts, windows, n: int, window: int) -> np.ndarray:
    """Which of n symbols the windows of the runs cover."""
    change = np.zeros(n + 1, np.int32)
    if starts is not None and len(starts):
        np.add.at(change, np.asarray(starts), 1)
        np.add.at(change, np.asarray(starts) + np.asarray(windows) - 1 + window, -1)
    return np.cumsum(change[:-1]) > 0


def dedup_words(docs: DataFrame, window: int = 20, gram: int = 6, text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and, if asked for, the kept text, words joined by one space) of every row."""
    rows = row_key(docs)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, row_hash, words, starts, windows in zip(pdf["doc_id"], pdf["row_hash"], pdf["text"], pdf["starts"], pdf["windows"]):
                words = words.encode().split()
                gone = covered(starts, windows, len(words), window)
                kept = b" ".join(w for w, g in zip(words, gone.tolist()) if not g) if gone.any() else b" ".join(words)
                out.append((doc_id, row_hash, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if text else None))
            yield pd.DataFrame(out, columns=["doc_id", "row_hash", "n_words", "n_removed", "kept_sha256", "text"])

    out = with_runs(rows, repeated_runs(rows, window, gram), cut, "doc_id long, row_hash long, n_words long, n_removed long, kept_sha256 string, text string")
    return out if text else out.drop("text")
