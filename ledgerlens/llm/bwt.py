"""Suffix-array dedup over bytes: threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every byte covered by a `window`-byte string that also starts anywhere else is removed (same document included); strings are judged on the input and
never cross documents. Strings that may repeat (see anchors) are gathered by anchor; equal segments of an anchor are one text with a count. Tasks concatenate the different texts of whole
groups, up to `local` bytes, sort the suffixes, and take the BWT. From there common prefixes are derived as Beller, Gog, Ohlebusch and Schnattinger (2013) do:
the interval of a string w is extended backward by each byte; the extension's right edge gets the length of w as common prefix if it has none yet, and is expanded
further only then. So values come in increasing order, level by level, and the expansion stops at `window`: an edge without a value by then parts suffixes that
share `window` bytes. Levels below the bytes packed for the first sort are read off that sort.

Segments of hot anchors, of more than `hot` different ones, are divided until each division's own common part tells them apart, or a single window is left, whose occurrences
need only be counted; so no group outgrows a task.

Defined cases: null text is empty; texts shorter than a window have nothing to remove; of a character's bytes some may go (kept bytes are hashed as they are; `dedup_texts`
decodes them with replacement marks); rows that repeat id and text are copies of each other; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import SEGMENT, count_slots, packed, segments, unpacked
from .common import lookup, written
from .suffix_trees import covered, row_key, with_runs
from .textops import RangeHash, groups_of, in_chunks

RUN = "doc_id long, row_hash long, start long, windows int"
PACKED = 7  # bytes of the first sort; a symbol takes 9 bits


class ByteSegments:
    def __init__(self, window: int, gram: int) -> None:
        self.window, self.gram = window, gram

    def __call__(self, texts: list[bytes]) -> tuple:
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        at = np.r_[0, np.cumsum(sizes)]
        # a text's part ends before its separator, so its length counts one less
        ends = at[1:] - 1
        if len(data) < self.window:
            return (*segments(np.zeros(0, np.uint64), self.window, self.gram, np.zeros(len(texts) + 1, np.int64)), np.zeros(0, np.uint64), data, at)
        p = np.arange(len(data) - self.gram + 1)
        ranges = RangeHash(data)
        grams = ranges(p, p + self.gram)
        bounds = np.stack([at[:-1], ends], 1).reshape(-1)  # texts and separators alternate; separators are too short for a window
        text, start, n, key, lead = segments(grams, self.window, self.gram, np.r_[bounds, len(data)])
        return text // 2, start, n, key, lead, ranges(start, start + n - 1 + self.window), data, at


def suffix_order(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of symbols (less than 512; the last, 0, is unique) in the order of their first `depth` symbols, and the first sort's keys.

    Prefix doubling over the suffixes still tied. Those tied at that depth stay in any order: they lie in the same intervals of all shorter strings, so the
    expansion does not tell them apart.
    """
    n = len(symbols)
    keys = np.zeros(n, np.uint64)
    padded = np.r_[symbols, np.zeros(PACKED, symbols.dtype)].astype(np.uint64)
    for k in range(PACKED):
        keys = keys << np.uint64(9) | padded[k : k + n]
    order = np.argsort(keys).astype(np.int32)
    sorted_keys = keys[order]
    new = np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]
    first_keys = sorted_keys
    group = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), np.int32(0)))
    rank = np.empty(n, np.int32)
    rank[order] = group
    tied = np.flatnonzero(~(new & np.r_[new[1:], True])).astype(np.int32)
    h = PACKED
    while len(tied) and h < depth:
        at = order[tied]
        key = group[tied].astype(np.int64) << 32 | rank[np.minimum(at + h, n - 1)]
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[tied] = at
        new = np.r_[True, key[1:] != key[:-1]]
        g = np.maximum.accumulate(np.where(new, tied, np.int32(0)))
        group[tied] = g
        rank[at] = g
        tied = tied[~(new & np.r_[new[1:], True])]
        h *= 2
    return order, first_keys


def shared_prefixes(symbols: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array and, for each of its places, whether the suffix there shares `window` symbols with the one before."""
    n = len(symbols)
    order, keys = suffix_order(symbols, window)
    bwt = symbols[order - 1]
    lf = np.empty(n, np.int32)  # from a suffix's place to that of the suffix one longer
    lf[np.argsort(bwt, kind="stable")] = np.arange(n, dtype=np.int32)
    # common prefixes below PACKED, from the keys; unset: -1
    differ = keys[1:] ^ keys[:-1]
    some = differ != 0
    common = sum(((differ >> np.uint64(9 * k)) == 0).astype(np.int32) for k in range(PACKED))
    lcp = np.full(n + 1, -1, np.int32)
    lcp[0] = lcp[n] = 0
    lcp[1:n][some] = common[some]
    if window <= PACKED:
        return order, (lcp[:n] < 0) | (lcp[:n] >= window)
    # intervals of PACKED symbols whose right edge has just got PACKED - 1; the last one of all has no edge
    starts = np.flatnonzero(np.r_[True, some])
    left, right = starts, np.r_[starts[1:], n] - 1
    fresh = lcp[right + 1] == PACKED - 1
    left, right = left[fresh], right[fresh]
    owner_at, level = np.zeros(n, np.int32), PACKED
    while len(left) and level < window:
        sizes = right - left + 1
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(left - np.r_[0, ends[:-1]], sizes)
        owner = np.repeat(np.arange(1, len(left) + 1, dtype=np.int32), sizes)
        to = lf[at]
        if len(to) * 20 > n:
            owner_at[to] = owner
            to = np.flatnonzero(owner_at)
            owner = owner_at[to]
            owner_at[to] = 0
        else:
            by = np.argsort(to, kind="stable")
            to, owner = to[by], owner[by]
        # extensions by one symbol: places next to each other, of one interval and one first symbol
        first = symbols[order[to]]
        cut = np.r_[True, (owner[1:] != owner[:-1]) | (first[1:] != first[:-1]) | (to[1:] != to[:-1] + 1)]
        at = np.flatnonzero(cut)
        left, right = to[at], to[np.r_[at[1:], len(to)] - 1]
        fresh = lcp[right + 1] < 0
        left, right = left[fresh], right[fresh]
        lcp[right + 1] = level
        level += 1
    return order, lcp[:n] < 0


def repeated_windows(texts: list[bytes], counts: list[int], window: int) -> list[np.ndarray]:
    """For each of different texts, which of its windows also start elsewhere. counts: how often each text occurs. One BWT for all texts, each once: all
    windows of a text that occurs twice are repeats, and what others share with it is seen in one copy too."""
    at = np.r_[0, np.cumsum([len(t) + 1 for t in texts])]
    flat = np.frombuffer(b"\0".join(texts) + b"\0\0", np.uint8)
    symbols = flat.astype(np.uint16) + np.uint16(2)
    symbols[at[1:] - 1] = 1
    symbols[-1] = 0
    order, same = shared_prefixes(symbols, window)
    hit = np.zeros(len(symbols), bool)
    i = np.flatnonzero(same)
    hit[order[i]] = True
    hit[order[i - 1]] = True
    spans = [max(0, len(t) - window + 1) for t in texts]
    return [np.ones(n, bool) if c > 1 else hit[a : a + n] for a, n, c in zip(at.tolist(), spans, counts)]


def _solve(frame: pd.DataFrame, window: int, local: int) -> Iterator[pd.DataFrame]:
    """Runs of repeated windows for whole groups of keys."""
    frame = frame.sort_values("key", kind="stable")
    code, distinct = pd.factorize(pd.MultiIndex.from_arrays([frame["key"], frame["content"]]))
    places, row_of = unpacked(list(frame["places"]))
    text_of = code[row_of]
    counts = np.bincount(text_of, minlength=len(distinct))
    texts, keys = [x[1] for x in distinct], np.array([x[0] for x in distinct], np.int64)
    sizes = pd.Series(counts).groupby(keys).transform("sum").to_numpy()
    order = np.argsort(text_of, kind="stable")
    bounds = np.searchsorted(text_of[order], np.arange(len(texts) + 1))

    def runs(chosen: list[int], hits: list[np.ndarray]) -> pd.DataFrame:
        doc, row, start, n = [], [], [], []
        for i, hit in zip(chosen, hits):
            edge = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
            at = places[order[bounds[i] : bounds[i + 1]]]
            for a, b in zip(edge[::2], edge[1::2]):
                doc.append(at[:, 0])
                row.append(at[:, 1])
                start.append(at[:, 2] + a)
                n.append(np.full(len(at), b - a, np.int32))
        none = [np.zeros(0, np.int64)]
        return pd.DataFrame({"doc_id": np.concatenate(doc or none), "row_hash": np.concatenate(row or none), "start": np.concatenate(start or none), "windows": np.concatenate(n or none).astype(np.int32)})

    # a key of one place has no repeat; whole keys go into a transform
    batch: list[int] = []
    total = 0
    for i in np.flatnonzero(sizes > 1).tolist():
        if total >= local and keys[i] != keys[batch[-1]]:
            yield runs(batch, repeated_windows([texts[j] for j in batch], [int(counts[j]) for j in batch], window))
            batch, total = [], 0
        batch.append(i)
        total += len(texts[i])
    if batch:
        yield runs(batch, repeated_windows([texts[j] for j in batch], [int(counts[j]) for j in batch], window))


HALF = SEGMENT + ", low int, high int"
PARTS = 4


def _parted(batches: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    """Each segment's windows of low <= symbols before the anchor < high as PARTS of a part of that range, keyed by what all windows of such a part have in common."""
    for pdf, texts in in_chunks(batches, "content"):
        out = []
        for n, lead, low, high, content, places in zip(pdf["windows"].tolist(), pdf["lead"].tolist(), pdf["low"].tolist(), pdf["high"].tolist(), texts, pdf["places"]):
            edges = sorted({low + (high - low) * i // PARTS for i in range(PARTS + 1)})
            for a, b in zip(edges, edges[1:]):
                # the segment has the windows of lead, lead - 1, ... lead - n + 1 symbols before the anchor
                first, last = min(lead, b - 1), max(lead - n + 1, a)
                if first < last:
                    continue
                skip, k = lead - first, first - last + 1
                shared = content[lead - a : lead - b + 1 + window]
                key = hashlib.blake2b(shared, digest_size=8, person=a.to_bytes(4, "little") + b.to_bytes(4, "little")).digest()
                moved = np.frombuffer(places, np.int64).reshape(-1, 3) + np.array([0, 0, skip])
                out.append((int.from_bytes(key, "little", signed=True), k, first, content[skip : skip + k - 1 + window], moved.tobytes(), a, b))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in HALF.split(", ")])


def _spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A run for each place."""
    for pdf in batches:
        places, row_of = unpacked(list(pdf["places"]))
        yield pd.DataFrame({"doc_id": places[:, 0], "row_hash": places[:, 1], "start": places[:, 2], "windows": pdf["windows"].to_numpy()[row_of].astype(np.int32)})


def _part_hot(rows: DataFrame, cut, window: int, gram: int, most: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Segments of groups small enough for a task, and runs of single windows that repeat. cut: gives the segments of hot anchors of batches of rows."""
    small, runs = [], []
    names = [x.split()[0] for x in SEGMENT.split(", ")]
    todo = None
    while True:
        # a task that cuts and parts does both in one Python worker: two would stay to the end of the job, for they are taken in turn
        divided = rows.mapInPandas(lambda b: _parted((x.assign(low=0, high=window - gram + 1) for x in cut(b)), window), HALF) if todo is None else todo.mapInPandas(lambda b: _parted(b, window), HALF)
        parts = written(divided, "parts")
        counts = parts.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.octet_length("places") / 24).alias("k")).filter("k > 1")
        known = lookup(parts, written(counts, "part-counts"), "key", "n").filter("n is not null")
        # a range of one window shares all of it, bytes told by themselves: its occurrences are repeats
        single = written(known.filter("high - low = 1").select(*names), "single-windows")
        often = single.groupBy("content").agg(F.count("*").alias("m"), F.sum(F.octet_length("places") / 24).alias("k")).filter("k > 1").drop("k")
        runs.append(lookup(single, written(often, "often"), "content", "m").filter("m is not null").select(*names).mapInPandas(_spread, RUN))
        small.append(known.filter(f"high - low > 1 and n <= {most}").select(*names))
        todo = written(known.filter(f"high - low > 1 and n > {most}").select(*names, "low", "high"), "still-hot")
        if not todo.limit(1).count():
            return small, runs


def repeated_runs(rows: DataFrame, window: int, gram: int, hot: int = 1000, max_bits: int = 27, local: int = 1 << 18) -> DataFrame:
    """doc_id, row_hash, start, windows: runs of windows that start elsewhere too. rows: as suffix_trees.row_key gives them."""
    find = ByteSegments(window, gram)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    held = count_slots(rows, find, hot, max_bits, size * 2 // (window - gram + 2))

    def cut(hot_ones: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf, texts in in_chunks(batches, "text"):
                *parts, data, at = find(texts)
                is_hot = held.test("hot", parts[3])
                keep = np.flatnonzero(is_hot if hot_ones else held.test("twice", parts[3]) & ~is_hot)
                text, start, n, key, lead, content = (x[keep] for x in parts)
                raw, a, b = data.tobytes(), start.tolist(), (start + n - 1 + window).tolist()
                yield packed(pdf, text, start - at[text], n, key, lead, content, lambda i: raw[a[i] : b[i]])

        return run

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in groups_of(batches, ["key"], 2048):
            yield from _solve(frame, window, local)

    cold = rows.mapInPandas(cut(False), SEGMENT)
    runs: list[DataFrame] = []
    if held.any_hot:
        small, runs = _part_hot(rows, cut(True), window, gram, hot)
        for part in small:
            cold = cold.unionByName(part)
    found = cold.repartition("key").sortWithinPartitions("key").mapInPandas(solve, RUN)
    for run in runs:
        found = found.unionByName(run)
    return found


def dedup_bytes(docs: DataFrame, window: int = 400, gram: int = 64, kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and, if asked for, the kept bytes) of every row."""
    rows = row_key(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, row_hash, text, starts, windows in zip(pdf["doc_id"], pdf["row_hash"], pdf["text"], pdf["starts"], pdf["windows"]):
                data = text.encode()
                if starts is None or not len(starts):
                    left, removed, spans = data, 0, 0
                else:
                    gone = covered(starts, windows, len(data), window)
                    left = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    removed, spans = int(gone.sum()), int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum())
                out.append((doc_id, row_hash, len(data), removed, spans, hashlib.sha256(left).hexdigest(), left if kept else None))
            yield pd.DataFrame(out, columns=["doc_id", "row_hash", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = with_runs(rows, repeated_runs(rows, window, gram), run, "doc_id long, row_hash long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if kept else out.drop("kept")


__all__ = ["dedup_bytes", "repeated_runs", "repeated_windows", "shared_prefixes", "suffix_order"]
