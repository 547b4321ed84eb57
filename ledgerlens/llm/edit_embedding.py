"""Document fingerprints by a randomised edit embedding.

Every text is walked by one shared random walk: at step j the walker reads the symbol under it and moves on by one place or none, as a random bit that
depends on j and the symbol says. Two texts at a small edit distance meet again after each edit, so the strings that the walks read differ in few
places (Chakraborty, Goldenberg and Koucky, STOC 2016). Symbols are hashes of `GRAM` code points. A walk is over when the text is, after 3 steps a symbol at most. Texts of over
`PIECE` symbols are cut where their own symbols say so, and each piece is walked from its start: no walk is long, and an edit puts only its piece out of step.

The fingerprint samples the embedding at `samples` places: place k is the step with the least priority k among the steps at which the walk still reads, so
texts of like length share most places. Each sample gives two hex digits; likeness is the share of equal samples.

`near_copies` searches near copies by bands of sampled digits (see bands and `sketches`): pairs that share a band and whose samples are alike are verified by edit
distance. What it finds is limited by the embedding: edits scattered over a text put its walk out of step again and again, so half of the samples are of walks over short pieces.
Measured against brute force (tests), it finds 0.9 or more of the pairs whose edit distance is at most `share` = 1 % of the longer text, of long texts too.

Walks of a batch go in step, from symbol to symbol, by a table of how long a walk stays at a symbol (`Walks`). Defined cases: null text is empty; empty texts share one fingerprint; a table of
one row has itself as the next document; rows follow each other by id (null first), those of one id by the hash of their text; in near copies rows of null ids are left alone, and rows of one id are
told apart by text; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import random
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bands import Search, renamed
from .common import as_text, lookup, null_again, partitions_for, row_keys, shuffles_cleared, written
from .textops import Cache, mix

GRAM, PERIOD, SAMPLES = 3, 4096, 128
PIECE = 1 << 13
FINE = 192  # PIECE of sketches
STRIDE = 3 * 2 * PIECE  # steps set aside for a piece
LONG = 1 << 16
WIDE = 200
RESULT = "row_id long, row_hash long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
PRINTS = RESULT + ", sketch binary"
EDGED = PRINTS + ", part int, edge string, body binary"


_made = Cache()


def _walk_bits(seed: int) -> np.ndarray:
    """Bit of each step (they repeat after PERIOD steps) and symbol class; class 0, the text's end, never moves."""
    if ("bits", seed) not in _made:
        bits = np.random.default_rng(seed).integers(0, 2, (PERIOD, 256), dtype=np.uint8)
        bits[:, 0] = 0
        _made["bits", seed] = bits
    return _made["bits", seed]


def _places(samples: int, seed: int, longest: int) -> list[np.ndarray]:
    """For each sample the steps below `longest` at which its least priority so far falls again.

    Priorities are uniform; the wait for one below the least so far is geometric, so the falls are drawn one after the other, from the left.
    """
    out = []
    for k in range(samples):
        draw = random.Random(seed * 1_000_003 + k)
        step, least, falls = 0, draw.random(), []
        while step < longest:
            falls.append(step)
            step += 1 + int(math.log(1.0 - draw.random()) / math.log1p(-least)) if least > 1e-12 else longest
            least *= draw.random()
        out.append(np.array(falls, np.int64))
    return out


def symbols(texts: list[str], block: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all texts' symbols, a 0 after each text, and where each text begins."""
    first = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=first[1:])
    c = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)

    def hashed(grams: list[np.ndarray]) -> np.ndarray:
        h = np.full(len(grams[0]), 2166136261, np.uint32)
        for x in grams:
            if len(x):
                h[: len(x)] ^= x
                h[: len(x)] *= np.uint32(16777619)
            h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h |= np.uint32(1)
        return h

    out = np.empty(len(c), np.uint32)
    for a in range(0, len(c), block):
        out[a : a + block] = hashed([c[a + k : a + k + block] for k in range(GRAM)])
    marks, none = first[1:] - 1, c[:0]
    for d in range(1, GRAM):  # the d-th last code point of a text has d only from there on
        at = (marks - d)[np.diff(first) > d]
        out[at] = hashed([c[at + k] if k < d else none for k in range(GRAM)])
    out[marks] = 0
    return out, first


def _rare(sym: np.ndarray, piece: int, block: int = 1 << 16) -> np.ndarray:
    """Where a hash of 16 symbols is rare, one in piece / 2."""
    out, every = [np.zeros(0, np.int64)], piece // 2
    twos = every & -every
    for a in range(0, len(sym) - 15, block):
        n = min(block, len(sym) - 15 - a)
        h = np.zeros(n, np.uint32)
        for k in range(0, 16, 3):
            h ^= sym[a + k : a + n + k]
            h *= np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(13)
        at = np.flatnonzero(h & np.uint32(twos - 1) == 0)
        out.append(a + at[h[at] % np.uint32(every) == 0])
    return np.concatenate(out)


def _cut(begin: int, end: int, rare: list[int], piece: int) -> list[int]:
    """Where the pieces of the symbols from begin to end begin."""
    out, i = [begin], 0
    if end - begin <= piece:
        return out
    while end - out[-1] > 2 * piece:
        i = bisect_left(rare, out[-1] + piece // 4, i)
        out.append(min(rare[i], out[-1] + 2 * piece) if i < len(rare) else out[-1] + 2 * piece)
    return out


def cuts(sym: np.ndarray, piece: int | None = None) -> list[int]:
    """Where the pieces of one text's symbols begin: at 0 and, in a text of over `piece` (PIECE) symbols, where a hash of 16 symbols is rare, piece / 4 to 2 * piece apart."""
    piece = piece or PIECE
    return _cut(0, len(sym), _rare(sym, piece).tolist(), piece) if len(sym) > 2 * piece else [0]


def _pieces(sym: np.ndarray, first: np.ndarray, piece: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the pieces of all texts begin and end, their texts, and their numbers in these."""
    piece, marks = piece or PIECE, first[1:] - 1
    begin, counts = [], []
    if piece > 1024:  # few texts are cut
        for a, e in zip(first[:-1].tolist(), marks.tolist()):
            at = [a] if e - a <= 2 * piece else [a + x for x in cuts(sym[a:e], piece)]
            begin += at
            counts.append(len(at))
    else:
        rare = _rare(sym, piece)
        low, high = np.searchsorted(rare, first[:-1]).tolist(), np.searchsorted(rare, marks - 15).tolist()  # 16 symbols of one text
        rare = rare.tolist()
        for a, e, x, y in zip(first[:-1].tolist(), marks.tolist(), low, high):
            at = [a] if e - a <= 2 * piece else _cut(a, e, rare[x:y], piece)
            begin += at
            counts.append(len(at))
    begin, counts = np.array(begin, np.int64), np.array(counts, np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    head = np.cumsum(counts) - counts
    end = np.r_[begin[1:], len(sym)] if len(begin) else begin  # a text's last piece ends before its mark
    last = np.r_[owner[1:] != owner[:-1], True] if len(owner) else np.zeros(0, bool)
    return begin, end - last, owner, np.arange(len(begin)) - head[owner]


def _kinds(sym: np.ndarray) -> np.ndarray:
    kind = (sym >> np.uint32(24)).astype(np.uint8)
    kind[(kind == 0) & (sym != 0)] = 1
    return kind


def _waits(seed: int) -> np.ndarray:
    """The steps that a walk takes at a symbol, the one that moves on included, by its class and the step of the period at which the walk comes there: PERIOD for each class. The class that never moves has 0."""
    if ("waits", seed) not in _made:
        bits = _walk_bits(seed)
        waits, wait = np.zeros((256, PERIOD), np.uint8), np.full(256, 254)
        for j in reversed(range(2 * PERIOD)):
            wait = np.where(bits[j % PERIOD] == 1, 1, np.minimum(wait, 254) + 1)
            waits[:, j % PERIOD] = wait
        waits[0] = 0
        _made["waits", seed] = waits.reshape(-1)
    return _made["waits", seed]


class Walks:
    """The walks of pieces from `begin` to `end` of symbols of the classes `kind`, a symbol of `block` pieces of like length at a time. stop: the step at which each walk is over."""

    def __init__(self, kind: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int, block: int = 1 << 12, rows: int = 64) -> None:
        self.begin, self.size = begin, end - begin
        self.came = np.empty(len(kind) + rows, np.int32)  # the step at which a walk comes to a symbol
        self.stop = np.empty(len(begin), np.int64)
        order, kind = np.argsort(-self.size, kind="stable"), np.r_[kind, np.zeros(rows, np.uint8)]
        for a in range(0, len(order), block):
            these = order[a : a + block]
            self.stop[these] = self._walk(kind, begin[these], self.size[these], _waits(seed), rows)

    def _walk(self, kind: np.ndarray, begin: np.ndarray, size: np.ndarray, waits: np.ndarray, rows: int) -> np.ndarray:
        step, at, wait = np.zeros(len(size), np.int64), np.empty(len(size), np.int64), np.zeros((rows, len(size)), np.uint8)
        ahead, came = (np.lib.stride_tricks.sliding_window_view(x, rows, writeable=x is self.came) for x in (kind, self.came))
        longest, mask, places, w = int(size[0]), np.array(PERIOD - 1), np.arange(rows), -1
        # how many pieces have a symbol at each place: those that are longer, which come first
        width = np.searchsorted(-size, -np.arange(longest), side="left").tolist()
        for a in range(0, longest, rows):
            most, whole = width[a], width[a + rows - 1] if a + rows <= longest else 0
            classes = ahead[begin[:most] + a].T.astype(np.int64, order="C")
            classes *= PERIOD
            steps = np.zeros((rows, most), np.int32)
            steps[0] = step[:most]
            for r, now in enumerate(width[a : a + rows]):
                if now != w:
                    w = now
                    s, x = step[:w], at[:w]
                y = wait[r, :w]
                np.bitwise_and(s, mask, out=x)
                np.bitwise_or(x, classes[r, :w], out=x)
                waits.take(x, out=y, mode="clip")
                np.add(s, y, out=s)
            steps[1:] = wait[:-1, :most]
            np.cumsum(steps, axis=0, out=steps)
            came[begin[:whole] + a] = steps[:, :whole].T
            if whole < most:
                here = places < (size[whole:most] - a)[:, None]
                self.came[((begin[whole:most] + a)[:, None] + places)[here]] = steps[:, whole:].T[here]
        return np.minimum(3 * size, step)

    def read(self, piece: np.ndarray, step: np.ndarray) -> np.ndarray:
        """Where the symbols are that the walks of some pieces read at some steps, before they are over."""
        low, top = self.begin[piece], self.size[piece]
        high = low + np.minimum(top, step + 1)
        for _ in range(int(top.max(initial=0)).bit_length()):
            middle = (low + high) >> 1
            there = self.came[middle] <= step
            low, high = np.where(there, middle, low), np.where(there, high, middle)
        return low


def _digits(value: np.ndarray, chosen: np.ndarray, k: np.ndarray) -> np.ndarray:
    return (mix(value.astype(np.uint64) + mix(chosen.astype(np.uint64) + (k.astype(np.uint64) << np.uint64(40)))) >> np.uint64(56)).astype(np.uint8)


def fingerprints(texts: list[str], samples: int = SAMPLES, seed: int = 7) -> np.ndarray:
    """One row of `samples` bytes for each text."""
    sym, first = symbols(texts)
    return _fingerprints(sym, first, _kinds(sym), samples, seed)


def _fingerprints(sym: np.ndarray, first: np.ndarray, kind: np.ndarray, samples: int = SAMPLES, seed: int = 7) -> np.ndarray:
    begin, end, _, ordinal = _pieces(sym, first)
    out = np.zeros((len(first) - 1, samples), np.uint8)
    if not len(begin):
        return out
    walks, pieces = Walks(kind, begin, end, seed), int(ordinal.max()) + 1
    places = _places(samples, seed, pieces * STRIDE if pieces > 1 else 3 * int((end - begin).max()))
    head = np.flatnonzero(ordinal == 0)
    number = np.diff(np.r_[head, len(begin)])
    full = end[head] > begin[head]
    head, number = head[full], number[full]
    cut = np.flatnonzero(number > 1)
    chosen = np.empty((len(head), samples), np.int64)
    for k, falls in enumerate(places):
        # the last fall at which the walk still reads, in the first piece and then in those after it
        chosen[:, k] = falls[np.searchsorted(falls, walks.stop[head]) - 1]
        for fall in falls[np.searchsorted(falls, STRIDE) :].tolist():
            piece, step = divmod(fall, STRIDE)
            here = cut[number[cut] > piece]
            chosen[here[walks.stop[head[here] + piece] > step], k] = fall
    piece, step = np.divmod(chosen.reshape(-1), STRIDE)
    value = sym[walks.read(np.repeat(head, samples) + piece, step)].reshape(chosen.shape)
    out[full] = _digits(value, chosen, np.arange(samples))
    return out


def sketches(texts: list[str], prints: np.ndarray, seed: int = 7, block: int = 1 << 12) -> np.ndarray:
    """What near copies are searched by, one row for each text, as wide as the fingerprints `prints`: half of these, and samples of the same walk over pieces of some FINE symbols, each from
    the piece whose beginning has the least hash. Edits put short walks out of step only, and pieces are told by what they begin with, not by their numbers, so the share of
    equal samples hardly falls with a text's length; the fingerprint's half serves texts of few pieces. Of a text of one piece all is the fingerprint."""
    sym, first = symbols(texts)
    return _sketches(sym, first, _kinds(sym), prints, seed, block)


def _sketches(sym: np.ndarray, first: np.ndarray, kind: np.ndarray, prints: np.ndarray, seed: int = 7, block: int = 1 << 12) -> np.ndarray:
    begin, end, _, ordinal = _pieces(sym, first, FINE)
    out, samples = prints.copy(), prints.shape[1]
    own = np.arange(samples // 2 - samples // 2 % 3 if samples > 5 else 0, samples)  # whole bands of three
    if not len(begin):
        return out
    name = np.zeros(len(begin), np.uint64)
    for k in range(0, 16, 3):
        name = mix(name + sym[np.minimum(begin + k, end)])
    head, low = np.flatnonzero(ordinal == 0), np.uint64((1 << 32) - 1)
    index = np.arange(len(begin), dtype=np.uint64)
    piece = np.stack([np.minimum.reduceat(mix(name + np.uint64(k + 1)) & ~low | index, head) & low for k in own.tolist()], axis=1).astype(np.int64)
    full = end[head] > begin[head]
    piece = piece[full]
    used = np.zeros(len(begin), bool)  # only pieces that a sample is of are walked
    used[piece] = True
    piece, used = (np.cumsum(used) - 1)[piece], np.flatnonzero(used)
    walks = Walks(kind, begin[used], end[used], seed, block)
    chosen = np.empty(piece.shape, np.int64)
    for k, falls in enumerate(_places(samples, seed, 3 * 2 * FINE)[own[0] :]):
        chosen[:, k] = falls[np.searchsorted(falls, walks.stop[piece[:, k]]) - 1]
    value = sym[walks.read(piece.reshape(-1), chosen.reshape(-1))].reshape(piece.shape)
    out[np.ix_(full, own)] = _digits(value, chosen, own)
    return out


def prints_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and sketches."""
    sym, first = symbols(texts)
    kind = _kinds(sym)
    prints = _fingerprints(sym, first, kind)
    return prints, _sketches(sym, first, kind, prints)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=-1)


def half_replaced(text: str, following: str) -> str:
    """The text with its last floor(n / 2) code points replaced by the first as many of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _results(keys: list[tuple[int, int]], texts: list[str], prints: np.ndarray, searched: np.ndarray) -> dict:
    """PRINTS columns of all rows but the last, which is the next of the one before."""
    edited = [half_replaced(a, b) for a, b in zip(texts, texts[1:])]
    changed, own = fingerprints(edited), prints[:-1]
    return {
        "row_id": [k[0] for k in keys[:-1]], "row_hash": [k[1] for k in keys[:-1]], "n_chars": [len(t) for t in texts[:-1]],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
        "fingerprint": [x.tobytes().hex() for x in own], "edited_fingerprint": [x.tobytes().hex() for x in changed],
        "near_edited": likeness(own, changed), "near_next": likeness(own, prints[1:]), "sketch": [x.tobytes() for x in searched[:-1]],
    }


def _laid_out(part: dict) -> pd.DataFrame:
    of = {"long": "int64", "int": "int32", "double": "float64", "string": object, "binary": object}
    n = len(part["row_id"])
    blank = {"long": 0, "int": 0, "double": 0.0, "string": None, "binary": None}
    return pd.DataFrame({c: pd.Series(list(part[c]) if c in part else [blank[kind]] * n, dtype=of[kind]) for c, kind in (x.split() for x in EDGED.split(", "))})


def _packed_texts(rows: DataFrame) -> DataFrame:
    """row_id, row_hash, body: the text in zstd, as every text is moved once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for pdf in batches:
            yield pd.DataFrame({"row_id": pdf["row_id"], "row_hash": pdf["row_hash"], "body": [pack(t.encode("utf-8", "surrogatepass")) for t in pdf["text"]]})

    return rows.mapInPandas(run, "row_id long, row_hash long, body binary")


def _unpacked(bodies, most: int) -> Iterator[tuple[int, int, list[str]]]:
    """The texts of some rows in runs of about `most` bytes, with the first row's number and the next one's."""
    texts, total, start = [], 0, 0
    for i, body in enumerate(bodies):
        data = zstandard.ZstdDecompressor().decompress(body) if len(body) else b""
        texts.append(data.decode("utf-8", "surrogatepass"))
        total += len(data)
        if total >= most or i == len(bodies) - 1:
            yield start, i + 1, texts
            texts, total, start = [], 0, i + 1


def followed(docs: DataFrame, part_bytes: int = 24 << 20, most_parts: int = 20_000, chunk: int = 4_000_000) -> DataFrame:
    """PRINTS of every row. The rows are shuffled once, into ranges of doc_id, and streamed; what crosses the ranges' edges, two rows a range, is
    done afterwards, an edge at a time."""
    row_id, row_hash = row_keys(docs)
    rows = docs.select(row_id.alias("row_id"), row_hash.alias("row_hash"), as_text(docs, "text").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = min(most_parts, partitions_for(total, part_bytes))
    order = [F.col("row_hash").bitwiseAND(F.lit(1)).desc(), F.col("row_id"), F.col("row_hash")]
    ranged = _packed_texts(rows).repartitionByRange(parts, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, last = TaskContext.get().partitionId(), None

        def edge(kind: str, key: tuple[int, int], body: bytes) -> pd.DataFrame:
            return _laid_out({"row_id": [key[0]], "row_hash": [key[1]], "part": [here], "edge": [kind], "body": [body]})

        for pdf in batches:
            keys, bodies = list(zip(pdf["row_id"].tolist(), pdf["row_hash"].tolist())), list(pdf["body"])
            for a, b, texts in _unpacked(bodies, chunk):
                if last is None:
                    yield edge("first", keys[a], bodies[a])
                    mine, (prints, searched) = keys[a:b], prints_of(texts)
                else:
                    mine, (prints, searched) = [last[0], *keys[a:b]], (np.vstack([x[None], y]) for x, y in zip(last[2], prints_of(texts)))
                    texts = [last[1], *texts]
                yield _laid_out(_results(mine, texts, prints, searched))
                last = mine[-1], texts[-1], (prints[-1], searched[-1]), bodies[b - 1]
        if last is not None:
            yield edge("last", last[0], last[3])

    def join_edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None
        for pdf in batches:
            for to, kind, row_id, row_hash, body in zip(pdf["to"], pdf["edge"], pdf["row_id"], pdf["row_hash"], pdf["body"]):
                here = (to, (row_id, row_hash), next(_unpacked([body], 1))[2][0])
                if kind == "last":
                    before = here
                elif before is not None and before[0] == to:
                    texts = [before[2], here[2]]
                    yield pd.DataFrame(_results([before[1], here[1]], texts, *prints_of(texts)))

    done = written(ranged.mapInPandas(run, EDGED), "followed")
    edges = done.filter("edge is not null").select("part", "edge", "row_id", "row_hash", "body")
    # the next range that has rows, after the last one the first: a row for each range, most_parts at most
    ranges = edges.filter("edge = 'last'").select("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = ranges.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(whole)).alias("to"))
    joined = edges.filter("edge = 'last'").join(F.broadcast(following), "part").unionByName(edges.filter("edge = 'first'").withColumn("to", F.col("part")))
    met = joined.repartition(F.col("to")).sortWithinPartitions("to", F.col("edge").desc()).select("to", "edge", "row_id", "row_hash", "body")
    crossing = written(met.mapInPandas(join_edges, PRINTS), "followed-across")
    return done.filter("edge is null").drop("part", "edge", "body").unionByName(crossing)


def follow(docs: DataFrame, near: bool = True, **options) -> DataFrame:
    """doc_id, the columns of RESULT and, if asked for, component_id: the least id of the near copies that a document is linked with."""
    columns = [F.col(x.split()[0]) for x in RESULT.split(", ")[2:]]
    with shuffles_cleared(docs.sparkSession):
        found = followed(docs, **options)
        if near:
            found = linked_rows(docs, found)
            columns += [F.col("component_id")]
    return found.select(null_again("row_id", "row_hash").alias("doc_id"), *columns)


def within(a: str, b: str, most: int, checks: int = 16) -> bool:
    """Whether the edit distance of two texts is at most `most`: bit-parallel columns (Myers 1999), left where no way on can stay within it."""
    if a == b or abs(len(a) - len(b)) > most:
        return a == b
    if not a or not b:
        return True
    x = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
    at = {chr(c): int.from_bytes(np.packbits(x == c, bitorder="little").tobytes(), "little") for c in np.unique(x)}
    m, n = len(a), len(b)
    whole, top = (1 << m) - 1, 1 << (m - 1)
    up, down, last = whole, 0, m
    rows, every = np.arange(m + 1), max(32, n // checks)
    for j, c in enumerate(b, 1):
        eq = at.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq
        rise, fall = down | (~(across | up) & whole), up & across
        last += bool(rise & top) - bool(fall & top)
        rise, fall, eq = (rise << 1) | 1, fall << 1, eq | down
        up, down = (fall | ~(eq | rise)) & whole, rise & eq & whole
        if j % every == 0:
            bits = [np.unpackbits(np.frombuffer(v.to_bytes(m // 8 + 1, "little"), np.uint8), bitorder="little")[:m] for v in (up, down)]
            column = j + np.r_[0, np.cumsum(bits[0].astype(np.int64) - bits[1])]
            if (column + np.abs((m - rows) - (n - j))).min() > most:
                return False
    return last <= most


def _alike(a: str, b: str, i: int, j: int) -> int:
    """How many characters a[i:] and b[j:] begin with in common."""
    n, step = 0, 16
    while (x := a[i + n : i + n + step]) == b[j + n : j + n + step] and len(x) == step:
        n, step = n + step, 2 * step
    while step:
        if (x := a[i + n : i + n + step]) == b[j + n : j + n + step] and len(x) == step:
            n += step
        step //= 2
    return n


def _reached(reach: list[int], low: int, first: int, last: int, a: str, b: str) -> list[int]:
    """How far the diagonals first..last get with one edit more than reach, those of the diagonals from low on."""
    m, n = len(a), len(b)
    row, wider, k = [-2, -2, *reach, -2, -2], [], first - low + 2
    for d in range(first, last + 1):
        i, x, y = row[k] + 1, row[k - 1], row[k + 1] + 1
        k += 1
        if x > i:
            i = x
        if y > i:
            i = y
        if i > m or i + d > n:
            i = min(m, n - d)
        if i < 0 or i + d < 0:
            i = -2
        elif i < m and i + d < n and a[i] == b[i + d]:
            i += _alike(a, b, i, i + d)
        wider.append(i)
    return wider


def _reached_at_once(reach: list[int] | np.ndarray, low: int, first: int, last: int, a: str, b: str, codes: list[np.ndarray]) -> np.ndarray:
    """_reached for many diagonals. codes: the code points of both texts, with end marks that differ. What is still alike after some steps together goes on by itself."""
    row, k, w = np.r_[-2, -2, reach, -2, -2], first - low + 2, last - first + 1
    d = np.arange(first, last + 1)
    at = np.maximum(np.maximum(row[k : k + w], row[k + 1 : k + 1 + w]) + 1, row[k - 1 : k - 1 + w])
    at = np.minimum(at, np.minimum(len(a), len(b) - d))
    at[(at < 0) | (at + d < 0)] = -2
    x, y = codes
    on = np.flatnonzero(at >= 0)
    i, j = at[on], at[on] + d[on]
    for _ in range(16):
        same = x[i] == y[j]
        on, i, j = on[same], i[same] + 1, j[same] + 1
        at[on] = i
        if not len(on):
            break
    for k, i, j in zip(on.tolist(), i.tolist(), j.tolist()):
        at[k] += _alike(a, b, i, j)
    return at


def distance(a: str, b: str, most: int, wide: int = WIDE) -> int:
    """The edit distance, or most + 1 if it is over `most`: how far each diagonal gets with 0, 1, 2, ... edits (Landau and Vishkin 1989), over `wide` of them in
    vector operations. It takes some `most` ** 2 / 2 steps and memory for `most` diagonals at most."""
    m, n = len(a), len(b)
    if abs(m - n) > most:
        return most + 1
    gap, low, reach, codes = n - m, 0, [_alike(a, b, 0, 0)], []  # reach: place in a, for each diagonal (place in b less place in a) from low on; -2: none
    for edits in range(most + 1):
        if 0 <= gap - low < len(reach) and reach[gap - low] >= m:
            return edits
        left = most - edits - 1  # diagonals from which the end is farther are given up
        first, last = max(-m, -edits - 1, gap - left), min(n, edits + 1, gap + left)
        if last - first < wide:
            reach = _reached(reach if isinstance(reach, list) else reach.tolist(), low, first, last, a, b)
        else:
            codes = codes or [np.frombuffer(t.encode("utf-32-le", "surrogatepass") + mark, np.uint32) for t, mark in ((a, b"\xff\xff\xff\xff"), (b, b"\xfe\xff\xff\xff"))]
            reach = _reached_at_once(reach, low, first, last, a, b, codes)
        low = first
    return most + 1


def near(a: str, b: str, share: float) -> bool:
    """Whether the edit distance of two texts is at most `share` of the longer one, whatever their lengths and wherever the edits are."""
    most = int(share * max(len(a), len(b)))
    if abs(len(a) - len(b)) > most:
        return False
    if max(len(a), len(b)) > LONG or 400 * most * most <= len(a) * len(b):  # `within` holds a text's length in bits for each of its characters
        return distance(a, b, most) <= most
    return within(a, b, most)


def _bag(text: str) -> np.ndarray:
    """Counts of the text's symbols by the first 10 bits of their hashes."""
    return np.bincount(symbols([text])[0][:-1] >> np.uint32(22), minlength=1024).astype(np.int32)


def linked(texts: list[str], component: np.ndarray, side: np.ndarray | None, alike: Callable, share: float) -> list[tuple[int, int]]:
    """Links that join components, of the pairs (of different sides) that are alike and not yet connected.

    An edit changes GRAM symbols at most, so texts whose counts of symbols differ by more than GRAM times the edits allowed are not compared.
    """
    counts = np.stack([_bag(t) for t in texts])
    lengths, root, out = np.array([len(t) for t in texts]), component.copy(), []
    for x in range(len(texts) - 1):
        open_ = root[x + 1 :] != root[x]
        if side is not None:
            open_ &= side[x + 1 :] != side[x]
        apart = np.abs(lengths[x + 1 :] - lengths[x])
        most = np.floor(share * np.maximum(lengths[x + 1 :], lengths[x]))
        close = np.flatnonzero(open_ & (apart <= most) & alike(x))
        close = close[np.abs(counts[x + 1 + close] - counts[x]).sum(axis=1) + apart[close] <= 2 * GRAM * most[close]]
        for y in x + 1 + close:
            if root[y] != root[x] and near(texts[x], texts[y], share):
                out.append((x, int(y)))
                root[root == root[y]] = root[x]
    return out


def length_cells(n_chars: str, share: float) -> Column | None:
    """The cells of a text's length, in powers of 1 + 10 * share, up to the cell of the longest text that may be near it. Near texts have one in common, and chance matches of a band, which
    grow with the square of the table, are left to texts of like length."""
    if not 0 < share < 1:
        return None
    cell = lambda n: F.floor(F.log(n) / math.log(1 + 10 * share))
    return F.sequence(cell(F.col(n_chars)), cell(F.col(n_chars) * ((1 + 1e-9) / (1 - share))))


def linked_rows(docs: DataFrame, prints: DataFrame, band: int = 3, likely: float = 0.2, share: float = 0.01) -> DataFrame:
    """prints (row_id, row_hash, n_chars, sketch and others) with component_id. Bands of `band` samples, each pair of alike sketches verified by edit distance."""
    named = "n_chars > 0 and row_hash & 1 = 0"
    # equal texts have equal hashes and sketches; what else is equal in both is one text but for a chance of 2**-63
    grouped = prints.filter(named).groupBy("row_hash", "n_chars", "sketch").agg(F.min("row_id").alias("row_id"), F.count("*").alias("copies"))
    classes = written(grouped.select(F.monotonically_increasing_id().alias("node"), "row_id", "row_hash", "n_chars", F.col("sketch").alias("signature"), "copies"), "text-classes")

    def decoded(texts: list[bytes]) -> list[str]:
        return [t.decode("utf-8", "surrogatepass") for t in texts]

    def prepare(texts: list[bytes]) -> list[tuple[str, np.ndarray]]:
        return [(t, _bag(t)) for t in decoded(texts)]

    def same(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> bool:
        # an edit changes GRAM symbols at most
        most = int(share * max(len(a[0]), len(b[0])))
        return int(np.abs(a[1] - b[1]).sum()) <= 2 * GRAM * most and near(a[0], b[0], share)

    def across(texts: list[bytes], component: np.ndarray, side: np.ndarray | None, alike: Callable) -> list[tuple[int, int]]:
        return linked(decoded(texts), component, side, alike, share)

    search = Search(docs, np.uint8, band, likely, prepare, same, across, length_cells("n_chars", share))
    labels, split = search.labels(classes, SAMPLES)
    labels = renamed(labels, written(search.links_across(split, classes), "more-links"))
    whole = labels.join(classes.select("node", "row_id", "row_hash", "copies"), "node")
    least = written(whole.groupBy("component").agg(F.min("row_id").alias("component_id"), F.count("*").alias("size")), "least-ids")
    of_class = written(lookup(whole, least, "component", "size").select("row_hash", "component_id", "copies"), "class-components")
    found = lookup(prints.filter(named), of_class, "row_hash", "copies")
    alone = prints.filter(f"not ({named})").withColumn("component_id", null_again("row_id", "row_hash"))
    return found.drop("copies").unionByName(alone)


def near_copies(docs: DataFrame, **options) -> DataFrame:
    """doc_id, component_id: documents linked by an edit distance of at most `share` of the longer text, as far as the embedding shows it."""
    row_id, row_hash = row_keys(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = list(pdf["text"])
            yield pd.DataFrame({"row_id": pdf["row_id"], "row_hash": pdf["row_hash"], "n_chars": [len(t) for t in texts], "sketch": [x.tobytes() for x in prints_of(texts)[1]]})

    rows = docs.select(row_id.alias("row_id"), row_hash.alias("row_hash"), as_text(docs, "text").alias("text"))
    with shuffles_cleared(docs.sparkSession):
        prints = written(rows.mapInPandas(run, "row_id long, row_hash long, n_chars long, sketch binary"), "fingerprints")
        found = linked_rows(docs, prints, **options)
    return found.select(null_again("row_id", "row_hash").alias("doc_id"), "component_id")
