"""Where repeats may be: every window of a fixed length picks one of its grams as anchor, the same wherever the window stands.

A window of `window` symbols (bytes or words) has window - gram + 1 grams; that of the least hash, the first of several, is its anchor. Neighbouring
windows mostly share an anchor; such a run of windows is a segment. Each window lies in one segment only, and equal windows have equal anchors, so repeats are found
among the segments of one anchor. A first pass counts anchors in a table of slots; anchors of slots that were hit once cannot repeat and never leave
their task. What the counts tell is kept as two bitmaps of a fixed size (at most 2**max_bits bits each) however large the input is: slots hit twice or more,
and hot slots. A too small bitmap costs shuffled bytes, never a repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .textops import in_chunks, mix

BLOCK = 32768


def sliding_anchor(grams: np.ndarray, width: int) -> np.ndarray:
    """For each start, the position of the least of `width` consecutive gram hashes, the first of equal ones."""
    m = (mix(grams) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while 2 * step <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    if step < width:
        m = np.minimum(m[: len(m) - (width - step)], m[width - step :])
    return (m & np.uint64(0xFFFFFFFF)).astype(np.int64)


def segments(grams: np.ndarray, window: int, gram: int, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """first: where each text's symbols begin, and the end. Returns text, first window, number of windows, anchor hash and lead (symbols of the first window
    before the anchor) of each segment."""
    sizes = np.diff(first) - window + 1
    have = np.flatnonzero(sizes > 0)
    if not len(have):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), none
    at = sliding_anchor(grams, window - gram + 1)
    ends = np.cumsum(sizes[have])
    starts = np.arange(ends[-1]) + np.repeat(first[have] - np.r_[0, ends[:-1]], sizes[have])
    anchor = at[starts]
    new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    n = np.diff(np.r_[new, len(starts)])
    return np.repeat(have, sizes[have])[new], starts[new], n, mix(grams[anchor[new]] ^ np.uint64(0x5851F42D4C957F2D)), anchor[new] - starts[new]


Find = Callable[[list], tuple]


class Slots:
    """Bitmaps over slots, from the counts of a first pass: n places, m distinct segments."""

    def __init__(self, spark, counts: DataFrame, bits: int, hot: int) -> None:
        self.bits = bits
        maps = {}
        for name, column, least in (("twice", "n", 2), ("hot", "m", hot + 1)):
            packed = counts.filter(F.col(column) >= least).groupBy(F.floor(F.col("slot") / BLOCK).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.pmod("slot", F.lit(BLOCK)) + 1)).alias("bits"))
            rows = packed.collect()  # 2**bits bits at most
            if rows or name == "twice":
                maps[name] = np.zeros(max(1, (1 << bits) // 8), np.uint8)
                for r in rows:
                    maps[name][r["block"] * BLOCK // 8 : r["block"] * BLOCK // 8 + BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)[: len(maps[name])]
        self.any_hot = "hot" in maps
        self.held = spark.sparkContext.broadcast(maps)

    def test(self, name: str, keys: np.ndarray) -> np.ndarray:
        bitmap = self.held.value.get(name)
        if bitmap is None:
            return np.zeros(len(keys), bool)
        slot = slots(keys, self.bits)
        return (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


SEGMENT = "key long, windows int, lead int, content binary, places binary"


def distinct_segments(key: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The segments in an order that brings equal ones (anchor and content hash) together, and where in it each distinct one begins."""
    order = np.lexsort((content, key))
    k, c = key[order], content[order]
    return order, np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])]) if len(k) else np.zeros(0, np.int64)


def packed(pdf: pd.DataFrame, text: np.ndarray, start: np.ndarray, n: np.ndarray, key: np.ndarray, lead: np.ndarray, content: np.ndarray, cut) -> pd.DataFrame:
    """SEGMENT rows: each distinct segment of a chunk once, with all its places (doc_id, row_hash, first window) as one array of int64. A text that
    repeats a phrase over and over costs a few rows. cut(i) gives the bytes of segment i; start counts from the text's own beginning."""
    order, first = distinct_segments(key, content)
    one = order[first] if len(order) else order
    places = np.stack([pdf["doc_id"].to_numpy()[text[order]].astype(np.int64), pdf["row_hash"].to_numpy()[text[order]].astype(np.int64), start[order].astype(np.int64)], 1).tobytes()
    ends = np.r_[first[1:], len(order)] * 24
    return pd.DataFrame({"key": key[one].view(np.int64), "windows": n[one].astype(np.int32), "lead": lead[one].astype(np.int32), "content": [cut(i) for i in one.tolist()], "places": [places[a:b] for a, b in zip((first * 24).tolist(), ends.tolist())]})


def unpacked(places: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All places of many rows, and the row of each."""
    flat = np.frombuffer(b"".join(places), np.int64).reshape(-1, 3)
    return flat, np.repeat(np.arange(len(places)), [len(x) // 24 for x in places])


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def count_slots(rows: DataFrame, find: Find, hot: int, max_bits: int, expected: int) -> Slots:
    """rows: text. find gives text, start, n, key, lead and content hash of the segments of a list of texts. A slot is hot for over `hot` distinct segments (of each chunk). expected: about how many segments there are."""
    bits = min(max_bits, max(16, int(expected * 16).bit_length()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, texts in in_chunks(batches, "text"):
            _, _, _, key, _, content = find(texts)[:6]
            order, first = distinct_segments(key, content)
            slot, kinds = np.unique(slots(key[order[first]], bits), return_counts=True)
            places = np.bincount(np.searchsorted(slot, slots(key, bits)), minlength=len(slot))
            yield pd.DataFrame({"slot": slot.astype(np.int32), "n": places.astype(np.int32), "m": kinds.astype(np.int32)})

    counts = rows.select("text").mapInPandas(run, "slot int, n int, m int").groupBy("slot").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).filter("n > 1")
    return Slots(rows.sparkSession, written(counts, "slots"), bits, hot)
