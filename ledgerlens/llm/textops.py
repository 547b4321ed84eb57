"""Vectorised work on batches of texts: bytes, words and their 64-bit hashes, without a Python step per word.

Hashes of byte ranges come from one running sum: sum of T[byte] * B**i over a range, times B**-start, all modulo 2**64, is the same wherever the
range lies. T is a fixed random table, B is odd; results are mixed before use.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd

_BASE = 0x9E3779B97F4A7C17
_INVERSE = pow(_BASE, -1, 1 << 64)


class Cache(dict):
    """A dictionary that travels empty: what it holds is made anew in each process."""

    def __reduce__(self):
        return Cache, ()


_tables = Cache()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """B**i, B**-i for i up to n, and the table T."""
    if len(_tables.get("up", ())) <= n:
        size = max(n + 1, 1 << 19)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _tables[name] = np.multiply.accumulate(row)
        _tables["t"] = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64)
    return _tables["up"], _tables["down"], _tables["t"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class RangeHash:
    """Hashes of any ranges of a byte array (or of an array of 64-bit values)."""

    def __init__(self, data: np.ndarray, values: bool = False) -> None:
        up, self.down, t = _powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data if values else t[data]) * up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


#: Bytes that part words: space and \x09 to \x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of one byte array."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


class Words:
    """The words of many texts. start, end: bytes; first: the number of the first word of each text, and the number of all; hash: of each word."""

    def __init__(self, texts: list[bytes], lower: bool = False) -> None:
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            self.data = _LOWER[self.data]
        self.at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=self.at[1:])
        self.start, self.end = word_bounds(self.data)
        self.first = np.searchsorted(self.start, self.at)
        self.hash = RangeHash(self.data)(self.start, self.end)


def in_chunks(batches: Iterable[pd.DataFrame], column: str, most: int = 1 << 19) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Rows in chunks of about `most` bytes of text (one row at least), with their texts as UTF-8; null is empty. One chunk is encoded at a time."""
    for pdf in batches:
        start, total, texts = 0, 0, []
        for i, t in enumerate(pdf[column]):
            data = t.encode() if isinstance(t, str) else bytes(t) if t is not None else b""
            if texts and total + len(data) > most:
                yield pdf.iloc[start:i], texts
                start, total, texts = i, 0, []
            texts.append(data)
            total += len(data) + 1
        if texts:
            yield pdf.iloc[start:], texts


def groups_of(batches: Iterable[pd.DataFrame], keys: list[str], most: int = 1 << 16) -> Iterator[pd.DataFrame]:
    """Sorted rows in frames that hold whole groups of keys, several at once, `most` rows or one group."""
    held: list[pd.DataFrame] = []
    rows = 0
    for pdf in batches:
        if not len(pdf):
            continue
        held.append(pdf)
        rows += len(pdf)
        if rows < most:
            continue
        whole = pd.concat(held, ignore_index=True)
        k = whole[keys]
        change = np.flatnonzero((k.to_numpy()[1:] != k.to_numpy()[:-1]).any(axis=1))
        if len(change):
            cut = int(change[-1]) + 1
            yield whole.iloc[:cut].reset_index(drop=True)
            whole = whole.iloc[cut:]
        held, rows = [whole], 0 if len(change) else rows
        if not len(change):
            most *= 2
        rows = len(whole)
    if held:
        yield pd.concat(held, ignore_index=True)


