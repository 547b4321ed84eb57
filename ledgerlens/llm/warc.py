"""WARC archives with the index first: write records and their index, then read selected records by coalesced, sorted byte ranges.

`write_archives` writes one gzip member per record, so that each can be read alone, and returns the index: archive, offset, length, URL and
digest per record. `read_records` takes any rows of an index, sorts them by archive and offset, joins ranges that lie close together into
one read, and parses the records. Archives are written below spark.checkpoint.dir or a given folder that all executors share; pyarrow opens
it by its URI. Each attempt of a task writes files of its own; the index of the attempt that Spark commits points to them, and files of lost attempts are in no index.

Of records with equal payloads of at least `least` bytes, that with the largest page_id is the response and the others are revisits of it;
smaller payloads are always responses. A revisit has the HTTP head only, whose Content-Length is that of the full payload.

Defined cases: null html is an empty payload, null URL an empty one; control characters and spaces in a URL are percent-encoded; a null
page_id is never a response that others refer to unless all copies have null ids (then all are responses); repeated rows with one page_id
give a record each, by its own payload; an empty table gives an empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_text, lookup, new_path, partitions_for, row_keys, written
from .exact_dedup import membership_filter, split_by_filter

INDEX = "page_id long, url string, archive string, offset long, length long, payload_digest string, payload_bytes long, record_type string, refers_to long"
WRITTEN = "page long, null_page int, url string, archive string, offset long, length long, payload_digest string, payload_bytes long, record_type string, refers_to long"
READ = "page long, null_page boolean, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def decide(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page, page_key (common.row_keys of page_id and html), refers_to for the pages that are revisits. Only digests are shuffled; a hot digest is looked up by broadcast."""
    page, key = row_keys(pages, "page_id", "html")
    html = F.encode(as_text(pages, "html"), "UTF-8")
    narrow = written(pages.select(page.alias("page"), key.alias("page_key"), "page_id", F.sha1(html).alias("payload_digest"), F.octet_length(html).alias("n")).filter(F.col("n") >= least).drop("n"), "digests")
    groups = written(narrow.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies")).filter("copies > 1"), "digest-groups")
    found = lookup(narrow, groups, "payload_digest", "copies")
    return found.filter("refers_to is not null and not (page_id <=> refers_to)").select("page", "page_key", "refers_to").distinct()


def _url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> tuple[bytes, str]:
    """The record's bytes, not compressed, and the payload's SHA-1 in hex."""
    sha = hashlib.sha1(payload)  # noqa: S324 - the format's digest
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {_url(url)}",
             f"WARC-Payload-Digest: sha1:{base64.b32encode(sha.digest()).decode()}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", sha.hexdigest()


def parse_record(data: bytes) -> dict:
    """A record's fields; the payload is None for revisits. Raises where lengths or the digest do not hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    block, end = rest[: (n := int(fields["Content-Length"]))], rest[n:]
    if version != "WARC/1.1" or len(block) != n or end != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    number = lambda x: int(x[len("<urn:page:") : -1]) if x and x != "<urn:page:>" else None
    out = {"page_id": number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To")), "payload_bytes": size, "payload_digest": digest, "payload": None}
    if out["record_type"] == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:  # noqa: S324
            raise ValueError(f"the payload of page {out['page_id']} does not match its digest")
        out["payload"] = payload
    return out


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 1000, archive_bytes: int = 1 << 30, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes every page (page_id, url, html) and returns the index, written beside the archives. Pages are written where they lie: what is brought to them is the
    decision, for pages that a bounded filter of the revisits' keys does not clear."""
    folder = folder or new_path(pages.sparkSession, "warc")
    # a decision is of a page and its payload: rows of one page_id may differ in html
    page, key = row_keys(pages, "page_id", "html")
    rows = pages.select(page.alias("page"), key.alias("page_key"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    revisits = written(decide(pages, least), "revisits")
    bits, blocks = membership_filter(revisits, "page_key")
    likely, clear = split_by_filter(rows, "page_key", bits, blocks)
    columns = ["page", "page_key", "url", "html", "refers_to", "revisits"]
    told = likely.join(revisits, ["page", "page_key"], "left").withColumns({"revisits": F.col("refers_to").isNotNull(), "refers_to": F.coalesce("refers_to", F.lit(0).cast("long"))})
    alone = clear.withColumns({"refers_to": F.lit(0).cast("long"), "revisits": F.lit(False)})

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        task, own = TaskContext.get(), uuid.uuid4().hex
        sink, number, offset, name = None, 0, 0, ""
        for pdf in batches:
            index = []
            for page, key, url, html, refers_to, revisit in zip(*[pdf[c] for c in columns]):
                if sink is None:
                    # an attempt has names of its own, which its index rows point to: another attempt's rows and files never mix with them
                    name, offset = f"pages-{task.partitionId():06d}-{own}-{number:04d}.warc.gz", 0
                    sink = system.open_output_stream(f"{base}/{name}", compression=None)  # records are compressed one by one
                payload, to = (html or "").encode(), int(refers_to) if revisit else None
                record, digest = build_record(None if key & 1 else int(page), url, payload, to, date)
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = pack.compress(record) + pack.flush()
                sink.write(data)
                index.append((page, key & 1, url, name, offset, len(data), digest, len(payload), "revisit" if revisit else "response", refers_to))
                offset += len(data)
                if offset >= archive_bytes:
                    sink.close()
                    sink, number = None, number + 1
            yield pd.DataFrame(index, columns=[x.split()[0] for x in WRITTEN.split(", ")])
        if sink is not None:
            sink.close()

    out = alone.select(*columns).mapInPandas(write, WRITTEN).unionByName(told.select(*columns).mapInPandas(write, WRITTEN))
    index = out.select(F.when(F.col("null_page") == 0, F.col("page")).alias("page_id"), "url", "archive", "offset", "length", "payload_digest", "payload_bytes", "record_type", F.when(F.col("record_type") == "revisit", F.col("refers_to")).alias("refers_to"))
    path = f"{folder}/index"
    index.write.parquet(path)
    return pages.sparkSession.read.schema(INDEX).parquet(path).withColumn("archive", F.concat(F.lit(f"{folder}/"), "archive"))


def coalesce_ranges(ranges: list[tuple[int, int]], gap: int, most: int) -> list[list[int]]:
    """Indexes of (offset, length), sorted by offset, in runs that one read fetches: gaps up to `gap`, `most` bytes unless one record is larger."""
    runs: list[list[int]] = []
    for i, (offset, length) in enumerate(ranges):
        if runs and offset - sum(ranges[i - 1]) <= gap and offset + length - ranges[runs[-1][0]][0] <= most:
            runs[-1].append(i)
        else:
            runs.append([i])
    return runs


def read_records(index: DataFrame, gap: int = 64 << 10, most: int = 4 << 20, payload: bool = True, slice_bytes: int = 32 << 20) -> DataFrame:
    """The records of the index rows. Each slice of an archive goes to one task, in order of offset; there are as many tasks as the index has slices, 8 of them to a task at most."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for pdf in batches:
            for archive, part in pdf.groupby("archive", sort=False):
                system, path = fs.FileSystem.from_uri(archive)
                ranges = list(zip(part["offset"].tolist(), part["length"].tolist()))
                with system.open_input_file(path) as source:
                    for run in coalesce_ranges(ranges, gap, most):
                        start = ranges[run[0]][0]
                        data = source.read_at(sum(ranges[run[-1]]) - start, start)
                        found = [parse_record(zlib.decompress(data[ranges[i][0] - start : sum(ranges[i]) - start], 31)) for i in run]
                        rows = [(r["page_id"] or 0, r["page_id"] is None, r["url"], r["record_type"], r["refers_to"] or 0, r["payload_bytes"], r["payload_digest"], r["payload"] if payload else None) for r in found]
                        yield pd.DataFrame(rows, columns=[x.split()[0] for x in READ.split(", ")])

    rows = index.select("archive", "offset", "length", F.floor(F.col("offset") / slice_bytes).alias("slice"))
    parts = partitions_for(rows.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0], slice_bytes // 8)
    # a number of partitions of its own, as the index is small beside what its rows make tasks read
    sorted_rows = rows.repartition(parts, "archive", "slice").sortWithinPartitions("archive", "offset").drop("slice")
    out = sorted_rows.mapInPandas(read, READ)
    return out.select(F.when(~F.col("null_page"), F.col("page")).alias("page_id"), "url", "record_type", F.when(F.col("record_type") == "revisit", F.col("refers_to")).alias("refers_to"), "payload_bytes", "payload_digest", "payload")


def round_trip(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, as read back from its archive."""
    return read_records(write_archives(pages, least=least), payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
