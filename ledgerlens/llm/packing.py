"""Best-fit packing of documents into training sequences by hierarchical residual packing.

Documents become token ids and an end mark; those longer than a sequence are cut from their end, so that the first piece may be shorter.
Full pieces are sequences. The others are packed in rounds: each partition packs its units best-fit-decreasing; bins that are nearly full
are done, the rest are units of the next round, dealt anew. Rounds end when one partition packed all that was open or when a round no
longer lessens them, so no task gets more than `local` units and nothing is collected.

Ids are those of the `tokenizers` library for the given file, computed by tiktoken over the same vocabulary, which is three times as fast
(tests hold the two against each other); the marks of special tokens in a text become their ids as there.

Defined cases: null or empty text is one piece with the end mark alone; empty table, empty result; rows of null ids and
repeated rows are packed each on its own;
very long texts are cut like others; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, null_again, row_keys, written

PIECES = "row_id long, row_hash long, piece int, start long, length long, ids_crc32 long, unit long"
BINS = "unit long, bin long, place long, fill long, open boolean"


def tokenizer_paths(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """The vocabulary's two files: for `tokenizers` and as ranks."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")


def load_encoder(json_path: str, ranks_path: str):
    """A function from text to the ids that the tokenizer in json_path gives."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    with open(json_path) as f:
        special = {x["content"]: x["id"] for x in json.load(f)["added_tokens"] if x["special"]}
    encoding = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        if any(mark in text for mark in special):
            return encoding.encode(text, allowed_special="all")
        return encoding.encode_ordinary(text)

    return encode


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    first = n % size
    starts = ([0] if first else []) + list(range(first, n, size))
    return [(s, (first if first and not s else size)) for s in starts]


def pieces(docs: DataFrame, size: int = 1024, end_id: int = 2, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """The pieces of every document, each with a unit number of its own."""
    paths = tokenizer_paths(tokenizer)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load_encoder(*paths)
        unit = TaskContext.get().partitionId() << 40
        for pdf in batches:
            rows = []
            for row_id, row_hash, text in zip(pdf["row_id"], pdf["row_hash"], pdf["text"]):
                ids = np.array(encode(text) + [end_id], dtype="<u4")
                for k, (start, length) in enumerate(cut(len(ids), size)):
                    rows.append((row_id, row_hash, k, start, length, zlib.crc32(ids[start : start + length].tobytes()), unit))
                    unit += 1
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in PIECES.split(", ")])

    row_id, row_hash = row_keys(docs)
    out = docs.select(row_id.alias("row_id"), row_hash.alias("row_hash"), as_text(docs, "text").alias("text")).mapInPandas(run, PIECES)
    return out.select(null_again("row_id", "row_hash").alias("doc_id"), *out.columns[2:])


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit-decreasing for integer sizes: bin of each unit, its place there, fill of each bin. Open bins are kept by remaining room,
    the non-empty ones in a bit mask, so that the tightest that fits is one shift away."""
    order = np.argsort(-lengths, kind="stable")
    bins, place, fill = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    mask = 0
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask &= ~(1 << room)
        else:
            b, room = len(fill), size
            fill.append(0)
        bins[i], place[i] = b, fill[b]
        fill[b] += n
        if room > n:
            by_room[room - n].append(b)
            mask |= 1 << (room - n)
    return bins, place, np.array(fill, np.int64)


def pack(units: DataFrame, size: int = 1024, local: int = 50_000, slack: int = 16, rounds: int = 12) -> DataFrame:
    """units: unit, length. Returns unit, sequence_id, offset."""

    def level(number: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            base, count = (number + 1) << 56 | TaskContext.get().partitionId() << 32, 0
            held: list[pd.DataFrame] = []

            def flush() -> pd.DataFrame:
                nonlocal count
                pdf = pd.concat(held)
                held.clear()
                bins, place, fill = best_fit(pdf["length"].to_numpy(), size)
                out = pd.DataFrame({"unit": pdf["unit"].to_numpy(), "bin": base + count + bins, "place": place, "fill": fill[bins], "open": fill[bins] < size - slack})
                count += len(fill)
                return out

            for pdf in batches:
                held.append(pdf)
                if sum(map(len, held)) >= 2 * local:
                    yield flush()
            if held:
                yield flush()

        return run

    full = units.filter(F.col("length") >= size).select("unit", F.col("unit").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo = units.filter(F.col("length") < size).select("unit", "length")
    n, levels = todo.count(), []
    for number in range(rounds):
        if not n:
            break
        parts = -(-n // local)
        dealt = todo.repartition(parts, F.xxhash64("unit", F.lit(number)))
        levels.append(written(dealt.mapInPandas(level(number), BINS), f"bins-{number}"))
        todo = levels[-1].filter("open").select(F.col("bin").alias("unit"), F.col("fill").alias("length")).distinct()
        before, n = n, todo.count()
        if parts == 1 or n > 0.99 * before:
            break
    # each unit's bin, then that bin's own bin if it stayed open, and so on; a bin holds a few units, so no key is hot
    out = None
    for bins in reversed(levels):
        here = bins.select("unit", F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))
        if out is not None:
            above = out.select(F.col("unit").alias("sequence_id"), F.col("sequence_id").alias("top"), F.col("offset").alias("more"))
            here = here.join(above, "sequence_id", "left").select("unit", F.coalesce("top", "sequence_id").alias("sequence_id"), (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"))
        out = here
    return full if out is None else full.unionByName(out)


def pack_documents(docs: DataFrame, size: int = 1024, end_id: int = 2, tokenizer: str = "byte_bpe_50k") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cuts = written(pieces(docs, size, end_id, tokenizer), "pieces")
    placed = pack(cuts.select("unit", "length"), size)
    return cuts.join(placed, "unit").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
