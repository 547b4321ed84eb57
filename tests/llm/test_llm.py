"""Small tests of each training-data operator against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import bwt, common, components, edit_embedding, exact_dedup, minhash, mixing, packing, quality, queries, sharding, suffix_trees, warc
from ledgerlens.llm.common import BATCH, CLEANUP

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed: int = 0, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(300)]
    make = lambda k: " ".join(rng.choices(vocabulary, k=k))
    shared, texts = make(90), []
    for i in range(n):
        kind = i % 6
        if kind == 0 or not texts:
            texts.append(make(rng.randint(30, 200)))
        elif kind == 1:
            texts.append(rng.choice(texts))
        elif kind == 2:
            words = (rng.choice([t for t in texts if t]) or "a").split()
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
        elif kind == 3:
            texts.append(make(20) + "\n" + shared + "\t" + make(15))
        elif kind == 4:
            texts.append(make(2) + " " + " ".join([rng.choice(vocabulary)] * rng.randint(1, 300)))
        else:
            texts.append(rng.choice(["", "x", "two words", "  \n", make(5)]))
    texts += [None, None, make(6000)]
    rows = [(i * 3, t, "en", f"s{i % 4}" if i % 9 else None, 0) for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}


# --- exact dedup


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_dedup(docs, rows, empty):
    got = by_id(exact_dedup.mark_copies(docs))
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(normal(t), []).append(i)
    for i, t, *_ in rows:
        g = groups[normal(t)]
        assert tuple(got[i])[1:] == (min(g), len(g), i == min(g), hashlib.sha256(normal(t).encode()).hexdigest())
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(min(g) for g in groups.values())
    assert exact_dedup.mark_copies(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0


def test_exact_dedup_repeated_rows_null_ids_and_clashing_names(spark):
    rows = [(1, "a b", 1, 2, 3), (1, "a b", 1, 2, 3), (None, "a  b", 1, 2, 3), (None, "c", 1, 2, 3), (2, "d", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, text_sha256 int, filter_block int, filter_bits int")
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in exact_dedup.drop_copies(df).collect() if r["doc_id"] is not None) == [(False, 1, "a b"), (False, 2, "d")]
    assert exact_dedup.drop_copies(df).filter("text = 'c'").count() == 1
    assert exact_dedup.mark_copies(df).filter("group_size = 3").count() == 3


def test_exact_dedup_is_native(docs, capsys):
    exact_dedup.mark_copies(docs).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_drop_copies_shuffles_no_text_that_stays(spark, docs, capsys, tmp_path):
    """Texts that are dealt have passed the filter of the copies' hashes first."""
    docs.write.parquet(str(tmp_path / "d"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    exact_dedup.drop_copies(spark.read.parquet(str(tmp_path / "d"))).explain()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = capsys.readouterr().out.splitlines()
    assert not re.search("Pandas|Arrow|BatchEval", "".join(lines))
    depth = [re.search(r"[A-Za-z]|$", x).start() for x in lines]
    dealt = 0
    for i, x in enumerate(lines):
        if "Exchange hashpartitioning" in x:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            below = lines[i + 1 : end]
            if any("FileScan" in b and "text" in b for b in below):
                dealt += 1
                assert any("BroadcastHashJoin [filter_block" in b and "Inner" in b for b in below), below
    assert dealt


def test_filters_beyond_the_broadcast_bound(spark):
    """A filter too large to broadcast gives the same split."""
    df = spark.range(30_000).select((F.col("id") % 29_000).cast("string").alias("sha")).repartition(5)
    bits, blocks = exact_dedup.repeat_filter(df, "sha")
    assert blocks > 4
    for mb in (32, 0):
        maybe, unique = exact_dedup.split_by_filter(df, "sha", bits, blocks, max_mb=mb)
        assert maybe.count() + unique.count() == 30_000 and unique.groupBy("sha").count().filter("count > 1").count() == 0
        assert 2000 <= maybe.count() < 3000


def test_drop_rows_by_id_and_text(spark):
    rows = [(1, "a", 1), (1, "b", 2), (None, "a", 3), (0, "a", 4), (1, None, 5), (1, "", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_hash int")
    keys = exact_dedup.row_keys(df.filter("row_hash in (1, 3, 5)"))
    gone = df.filter("row_hash in (1, 3, 5)").select(keys[0].alias("row_id"), keys[1].alias("row_hash"))
    assert sorted(r[2] for r in exact_dedup.drop_rows(df, gone).collect()) == [2, 4]


def test_drop_copies_of_hot_and_repeated_rows(spark):
    """A text of many copies goes where its rows lie; of rows that repeat id and text one stays."""
    rows = [(i, "hot text", i) for i in range(300)] + [(0, "hot text", 300), (None, "hot  text", 301)] + [(1000 + i % 4, f"t{i % 4}", 400 + i) for i in range(8)] + [(2000, "alone", 500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, is_hot int").repartition(3)
    assert sorted(r[0] for r in exact_dedup.drop_copies(df).collect()) == [0, 1000, 1001, 1002, 1003, 2000]


BIG = [1152921504606846977, 1152921504606846979, 1152921504606846981, 4611686018427387904, 9223372036854775807]


def test_large_ids_beside_a_null(spark):
    """Ids over 2**53 stay exact where a null id is in the same batch, in every operator."""
    rows = [(i, f"text number {k} " + " ".join(f"w{j}" for j in range(30)) * (k + 1)) for k, i in enumerate([*BIG, None])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    ids = sorted(BIG) + [None]
    name = lambda out: sorted((r["doc_id"] for r in out.collect()), key=lambda i: (i is None, i))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert name(minhash.near_copies(df)) == name(edit_embedding.follow(df)) == name(quality.classify(df, none)) == ids
    assert name(bwt.dedup_bytes(df)) == name(suffix_trees.dedup_words(df)) == ids
    assert name(packing.pack_documents(df).filter("piece = 0")) == ids
    pages = df.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.repeat("text", 20).alias("html")).union(spark.createDataFrame([(7, "u", rows[0][1] * 20)], "page_id long, url string, html string"))
    back = {r["page_id"]: r["refers_to"] for r in warc.round_trip(pages.coalesce(1)).collect()}
    assert back == {**dict.fromkeys(ids), 7: BIG[0]}


# --- sharding


def test_best_fit_decreasing_takes_the_tightest_bin():
    rng = random.Random(1)
    for _ in range(30):
        sizes, capacity = [rng.randint(1, 60) for _ in range(rng.randint(0, 80))], 60
        got = sharding.best_fit_decreasing(sizes, capacity)
        room, want = [], {}
        for i in sorted(range(len(sizes)), key=lambda j: (-sizes[j], j)):
            fit = [(r, b) for b, r in enumerate(room) if r >= sizes[i]]
            b = min(fit)[1] if fit else len(room)
            if not fit:
                room.append(capacity)
            room[b] -= sizes[i]
            want[i] = b
        assert got == [want[i] for i in range(len(sizes))]


def test_shards(docs, rows, empty):
    got = by_id(sharding.shard_documents(docs))
    totals, where, slots = Counter(), {}, {}
    for i, t, *_ in rows:
        r = got[i]
        assert r["size"] == len((t or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((t or "").encode())
        assert where.setdefault(t, r["shard"]) == r["shard"]
        totals[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    group = max(Counter({t: sum(got[i]["size"] for i, u, *_ in rows if u == t) for _, t, *_ in rows}).values())
    assert max(totals.values()) <= max(group, sum(totals.values()) / 8 * 1.05)
    assert sharding.shard_documents(empty).count() == 0


# --- substring dedup


def removed_bytes(texts: list[bytes], window: int):
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = True
        yield gone


@pytest.mark.parametrize(("window", "gram", "hot"), [(60, 12, 2000), (60, 12, 1), (33, 33, 2)])
def test_bytes_against_brute_force(docs, rows, window, gram, hot, monkeypatch):
    run = bwt.repeated_runs
    monkeypatch.setattr(bwt, "repeated_runs", lambda r, w, g: run(r, w, g, hot=hot, max_bits=16, local=3000))
    got = by_id(bwt.dedup_bytes(docs, window, gram, kept=True))
    texts = [(t or "").encode() for _, t, *_ in rows]
    for (i, *_), t, gone in zip(rows, texts, removed_bytes(texts, window)):
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        assert tuple(got[i])[1:5] == (len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
        assert bytes(got[i]["kept"]) == kept


def test_hot_segments_are_cut_and_parted_in_one_worker(docs, monkeypatch):
    """A second Python step in a task makes twice as many workers, which stay."""
    write, steps = bwt.written, []

    def seen(df, name):
        if name == "parts":
            steps.append(df._jdf.queryExecution().optimizedPlan().toString().count("MapInPandas"))
        return write(df, name)

    monkeypatch.setattr(bwt, "written", seen)
    assert bwt.repeated_runs(suffix_trees.row_key(docs), 60, 12, hot=1, max_bits=16, local=3000).count()
    assert len(steps) > 1 and set(steps) == {1}


def test_bwt_prefixes_against_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        window = rng.choice([2, 7, 8, 15])
        texts = list({bytes(rng.choices(b"ab\0", k=rng.randint(0, 70))) for _ in range(5)})
        counts = [rng.choice([1, 1, 3]) for _ in texts]
        seen = Counter()
        for t, c in zip(texts, counts):
            for i in range(len(t) - window + 1):
                seen[t[i : i + window]] += c
        for t, hit in zip(texts, bwt.repeated_windows(texts, counts, window)):
            assert hit.tolist() == [seen[t[i : i + window]] > 1 for i in range(len(t) - window + 1)]


def test_deep_tree_against_brute_force():
    """Nodes are the sequences that two or more suffixes share and that their next symbols part; parents hold their children."""
    rng = random.Random(21)
    for _ in range(80):
        texts, least = [rng.choices("ab", k=rng.randint(0, 12)) for _ in range(rng.randint(1, 6))], rng.randint(1, 4)
        codes = np.array([ord(c) - 96 for t in texts for c in t], np.int64)
        end = np.repeat(np.cumsum([len(t) for t in texts]), [len(t) for t in texts])
        tree = suffix_trees.DeepTree(codes, end, np.arange(len(codes)), least)
        suffix = ["".join(chr(96 + c) for c in codes[i : end[i]]) for i in range(len(codes))]
        assert [suffix[i] for i in tree.order] == sorted(suffix)
        want = set()
        for p in {s[:k] for s in suffix for k in range(least, len(s) + 1)}:
            below = [s for s in suffix if s.startswith(p)]
            if len(below) > 1 and len({s[len(p) : len(p) + 1] for s in below}) + (below.count(p) > 1) > 1:
                want.add((p, len(below)))
        got = [(suffix[tree.order[a]][:d], b - a + 1) for a, b, d in zip(tree.left, tree.right, tree.depth)]
        assert len(got) == len(set(got)) and set(got) == want
        for i, up in enumerate(tree.parent.tolist()):
            if up >= 0:
                assert tree.left[up] <= tree.left[i] <= tree.right[i] <= tree.right[up] and tree.depth[up] < tree.depth[i]
        tops = tree.tops()
        for i, s in enumerate(suffix):
            for j, t in enumerate(suffix):
                if i != j:
                    assert (tops[i] == tops[j]) == (len(s) >= least and len(t) >= least and s[:least] == t[:least])


def test_maximal_repeats():
    texts = ["x a b c d y", "z a b c d w", "q b c d r", "a  b\tc d"]
    assert suffix_trees.maximal_repeats(texts, 3) == {("a", "b", "c", "d"): 3, ("b", "c", "d"): 4}


@pytest.mark.parametrize("hot", [40_000, 5, 1])
def test_words_against_brute_force(docs, rows, hot, monkeypatch):
    run = suffix_trees.repeated_runs
    monkeypatch.setattr(suffix_trees, "repeated_runs", lambda r, w, g: run(r, w, g, hot=hot, max_bits=16))
    window = 8
    got = by_id(suffix_trees.dedup_words(docs, window, 3, text=True))
    first = {}
    words = {i: WORD.findall(t or "") for i, t, *_ in rows}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), (i, k))
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] != (i, k):
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert tuple(got[i])[1:4] == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()) and got[i]["text"] == kept


def test_bytes_at_the_production_window(spark):
    """The query's own window and gram against all 400-byte strings of a table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = by_id(bwt.dedup_bytes(docs))
    texts = [(r["text"] or "").encode() for r in rows]
    for r, t, gone in zip(rows, texts, removed_bytes(texts, 400)):
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        assert tuple(got[r["doc_id"]])[1:] == (len(t), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest())


def test_words_where_few_documents_have_the_hot_passage(spark, monkeypatch):
    """Most chunks have no hot window; rows of null ids come last."""
    run = suffix_trees.repeated_runs
    monkeypatch.setattr(suffix_trees, "repeated_runs", lambda r, w, g: run(r, w, g, hot=2, max_bits=16))
    rng = random.Random(31)
    passage = " ".join(f"p{i}" for i in range(12))
    rows = [(i, f"{rng.random()} {passage} {rng.random()}" if i % 10 == 0 else " ".join(str(rng.random()) for _ in range(15))) for i in range(1, 61)] + [(None, passage)]
    got = {r["doc_id"]: r["n_removed"] for r in suffix_trees.dedup_words(spark.createDataFrame(rows, "doc_id long, text string").repartition(12), 8, 3).collect()}
    assert got == {i: 12 if i is None or (i % 10 == 0 and i > 10) else 0 for i, _ in rows}


def test_substring_dedup_edges(spark, empty):
    assert bwt.dedup_bytes(empty).count() == 0 and suffix_trees.dedup_words(empty).count() == 0
    long = "é" + " ".join(f"w{i}" for i in range(400))
    df = spark.createDataFrame([(5, long), (5, long), (None, long), (6, None)], "doc_id long, text string")
    got = bwt.dedup_bytes(df).collect()
    assert sorted((r["n_removed"], r["n_bytes"]) for r in got) == [(0, 0)] + [(len(long.encode()),) * 2] * 3
    words = {(r["doc_id"], r["n_removed"]) for r in suffix_trees.dedup_words(df).collect()}
    assert words == {(5, 0), (None, 400), (6, 0)}


# --- mixing


def test_mix(docs, rows, empty):
    got = by_id(mixing.mix_documents(docs))
    sizes = {i: len(WORD.findall(t or "")) for i, t, *_ in rows}
    source = {i: s for i, _, _, s, _ in rows}
    total = sum(sizes.values())
    names = sorted({s for s in source.values() if s is not None}) + [None]
    own = {s: sum(n for i, n in sizes.items() if source[i] == s) for s in names}
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        rest, open_ = total - sum(3 * own[s] for s in capped), [s for s in names if s not in capped]
        target = {s: 3 * own[s] for s in capped} | {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if target[s] > 3 * own[s]}
        if not over:
            break
        capped |= over
    taken = Counter()
    for i in sizes:
        assert got[i]["size"] == sizes[i] and got[i]["source_size"] == own[source[i]] and abs(got[i]["target"] - target[source[i]]) < 1e-6 * total
        assert 0 <= got[i]["taken"] <= 3 * sizes[i] and (not sizes[i] or got[i]["taken"] % sizes[i] == 0)
        taken[source[i]] += got[i]["taken"]
    assert all(abs(taken[s] - target[s]) <= 2 * max(sizes.values()) for s in names) and sum(taken.values()) <= total
    assert by_id(mixing.mix_documents(docs.repartition(5))) == got
    assert mixing.mix_documents(empty).count() == 0
    mixed = Counter(r["doc_id"] for r in mixing.mixed_rows(docs).collect())
    assert mixed == Counter({i: got[i]["taken"] // sizes[i] for i in sizes if got[i]["taken"]})


def test_mixed_rows_keep_null_ids(spark):
    """Rows of null ids come out as often as the mix takes them, with their own columns."""
    rows = [(None, f"word {'x ' * i}", f"s{i % 2}", i) for i in range(1, 9)] + [(None, "twice over", "s0", 50), (None, "twice over", "s0", 51)] + [(i, "a b c", "s1", 100 + i) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(3)
    out = mixing.mixed_rows(df)
    got, taken = out.collect(), mixing.mix_documents(df).collect()
    size = {r[3]: len(WORD.findall(r[1])) for r in rows}
    assert out.columns == df.columns and {tuple(r) for r in got} <= set(rows)
    for null in (True, False):
        assert sum(size[r["n_chars"]] for r in got if (r["doc_id"] is None) == null) == sum(r["taken"] for r in taken if (r["doc_id"] is None) == null) > 0


# --- WARC


def test_warc_round_trip(spark):
    long = "é" * 600
    pages = [(1, "http://a/ b", long), (2, None, long), (9, "http://c", long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "x\r\ny", "WARC/1.1\r\n\r\nContent-Length: 3"), (8, "y", "z" * 300_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    index = warc.write_archives(df, archive_bytes=2000)
    got = {r["page_id"]: r for r in warc.read_records(index).collect()}
    for i, _, html in pages:
        data = (html or "").encode()
        revisit = i in (1, 2)
        assert got[i]["payload_bytes"] == len(data) and got[i]["payload_digest"] == hashlib.sha1(data).hexdigest()
        assert got[i]["record_type"] == ("revisit" if revisit else "response") and got[i]["refers_to"] == (9 if revisit else None)
        assert (got[i]["payload"] is None) if revisit else bytes(got[i]["payload"]) == data
    assert got[1]["url"] == "http://a/%20b" and got[7]["url"] == "x%0D%0Ay"
    some = warc.read_records(index.filter("page_id in (4, 8)")).collect()
    assert sorted(r["page_id"] for r in some) == [4, 8]
    assert warc.round_trip(df.limit(0)).count() == 0


def test_warc_keeps_both_payloads_of_a_repeated_page(spark):
    """Two rows of page 1: one copies page 9, the other's payload is found nowhere else and must be in an archive."""
    pages = [(1, "u", "x" * 2000), (1, "u", "y" * 2000), (9, "v", "x" * 2000)]
    read = warc.read_records(warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"))).collect()
    got = sorted((r["page_id"], r["record_type"], r["refers_to"] or 0, bytes(r["payload"] or b"")[:1]) for r in read)
    assert got == [(1, "response", 0, b"y"), (1, "revisit", 9, b""), (9, "response", 0, b"x")]


def test_ranges_are_coalesced():
    assert warc.coalesce_ranges([(0, 10), (10, 5), (30, 5), (1000, 50)], gap=20, most=100) == [[0, 1, 2], [3]]
    assert warc.coalesce_ranges([(0, 90), (90, 90)], gap=20, most=100) == [[0], [1]]


# --- MinHash


def shingles(t, n):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return set() if not w else {tuple(w)} if len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def components_of(sets: dict, percent: int) -> dict:
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_minhash(spark, docs, rows, empty):
    got = by_id(minhash.near_copies(docs, words=4))
    sets = {i: shingles(t, 4) for i, t, *_ in rows}
    want = components_of(sets, 80)
    for i in sets:
        assert tuple(got[i])[1:] == (len(sets[i]), want[i], want[i] == i)
    assert minhash.near_copies(empty).count() == 0
    kept = minhash.drop_near_copies(docs, words=4)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in sets if want[i] == i}


def test_minhash_chain_of_edits(spark):
    """Each text is near its neighbours only: links between those that are not near the bucket's head must not be lost."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        rows.append((i * 7 % 40, " ".join(words)))
        for _ in range(2):
            words[rng.randrange(len(words))] = f"n{i}{rng.random()}"
    got = by_id(minhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), words=4))
    want = components_of({i: shingles(t, 4) for i, t in rows}, 80)
    assert {i: r["component_id"] for i, r in got.items()} == want


def test_minhash_writes_few_files(spark, docs, rows, monkeypatch):
    """Shuffle partitions do not become a file each, as files cost executors child processes; the result is the same."""
    few = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, paths, make = {k: spark.conf.get(k) for k in few}, [], common.new_path
    monkeypatch.setattr(common, "new_path", lambda *a: (paths.append(make(*a)), paths[-1])[1])
    try:
        for k, v in few.items():
            spark.conf.set(k, v)
        got = by_id(minhash.near_copies(docs, words=4))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = components_of({i: shingles(t, 4) for i, t, *_ in rows}, 80)
    assert {i: r["component_id"] for i, r in got.items()} == want
    files = {p: len(list(Path(p.removeprefix("file:")).glob("part-*"))) for p in paths}
    narrow = {p: n for p, n in files.items() if re.search(r"/(classes|buckets|labels|edges|star|large-star|small-star|heads|id-filter)-", p)}
    assert len(narrow) >= 9 and max(narrow.values()) <= 2 * spark.sparkContext.defaultParallelism


def test_python_gets_small_batches(spark):
    def sizes(batches):
        for pdf in batches:
            yield pdf.assign(n=len(pdf))[["n"]]

    wide = spark.range(8000, numPartitions=1).selectExpr("repeat('x', 4000) as text")
    got = common.written(wide.mapInPandas(sizes, "n long"), "batch-sizes")
    assert got.count() == 8000 and got.agg(F.max("n")).first()[0] < 2000
    assert spark.conf.get(BATCH, None) is None


def test_minhash_rows_of_one_id(spark):
    """A row goes by id and text: what shares its id with a copy, but not its text, stays."""
    long, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    df = spark.createDataFrame([(1, long, 1), (2, long, 2), (2, other, 3), (None, long, 4), (5, other + " x", 5)], "doc_id long, text string, node int")
    assert sorted(r[2] for r in minhash.drop_near_copies(df).collect()) == [1, 3, 4]
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in minhash.near_copies(df).collect())
    assert got == [(0, 0, True), (1, 1, True), (2, 1, False), (2, 2, True), (5, 2, False)]


def test_minhash_crowded_buckets(spark):
    """Texts that share a template part: crowded buckets are told apart by finer bands, and the links among them are found."""
    rng, part, rows = random.Random(12), [f"t{i}" for i in range(40)], []
    for i in range(60):
        own = [f"w{rng.randrange(10**9)}" for _ in range(25)]
        rows.append((2 * i, " ".join(part + own)))
        if i % 3 == 0:
            own[rng.randrange(25)] = "changed"
            rows.append((2 * i + 1, " ".join(part + own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = components_of({i: shingles(t, 4) for i, t in rows}, 80)
    for many in (1000, 3):
        assert {r["doc_id"]: r["component_id"] for r in minhash.near_copies(df, words=4, many=many).collect()} == want


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(30)] + [(200, 200 + i) for i in range(50)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- fingerprints


def test_fingerprints(docs, rows, empty):
    got = by_id(edit_embedding.follow(docs, near=False, part_bytes=2000))
    order = sorted(rows)
    prints = {}
    for (i, t, *_), (_, u, *_) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        h = len(t) // 2
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - h] + u[:h]).encode()).hexdigest()
        assert prints.setdefault(t, got[i]["fingerprint"]) == got[i]["fingerprint"]
        a, b = (bytes.fromhex(got[i][c]) for c in ("fingerprint", "edited_fingerprint"))
        assert got[i]["near_edited"] == sum(x == y for x, y in zip(a, b)) / len(a)
    assert edit_embedding.follow(empty).count() == 0


def test_fingerprint_query_bands_and_verifies(spark, tmp_path):
    rng = random.Random(3)
    make = lambda: "".join(rng.choices("abcdefgh ", k=3000))
    a, b = make(), make()
    texts = [a, b, a[:1500] + "Z" + a[1501:], b, "", None]
    path = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA).write.parquet(path)
    got = by_id(queries.op7_edit_embedding(spark, str(tmp_path)))
    plain = by_id(edit_embedding.follow(spark.read.parquet(path), near=False))
    assert {i: r["component_id"] for i, r in got.items()} == {0: 0, 1: 1, 2: 0, 3: 1, 4: 4, 5: 5}
    assert {i: tuple(r)[:-1] for i, r in got.items()} == {i: tuple(r) for i, r in plain.items()}


@pytest.mark.parametrize("piece", [1 << 16, 64])
def test_walk_matches_a_plain_one(piece, monkeypatch):
    """The walks that go in step read the same places as one walk after the other, in pieces too."""
    monkeypatch.setattr(edit_embedding, "PIECE", piece)
    monkeypatch.setattr(edit_embedding, "STRIDE", 6 * piece)
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcé", k=k)) for k in (0, 1, 2, 50, 333, 129)]
    got = edit_embedding.fingerprints(texts, samples=16, seed=3)
    bits, stride = edit_embedding._walk_bits(3), 6 * piece
    for t, g in zip(texts, got):
        sym = edit_embedding.symbols([t])[0][:-1]
        begin = [*edit_embedding.cuts(sym), len(sym)]
        assert all(y - x <= 2 * piece for x, y in zip(begin, begin[1:]))
        reads = {}
        for p, (at, end) in enumerate(zip(begin, begin[1:])):
            for j in range(3 * (end - at)):
                if at == end:
                    break
                reads[p * stride + j] = int(sym[at])
                at += int(bits[j % edit_embedding.PERIOD, max(1, int(sym[at]) >> 24)])
        for k, falls in enumerate(edit_embedding._places(16, 3, len(begin) * stride)):
            place = max((f for f in falls.tolist() if f in reads), default=None)
            if place is not None:
                value = edit_embedding.mix(np.array([reads[place]], np.uint64) + edit_embedding.mix(np.array([place + (k << 40)], np.uint64)))
                assert g[k] == int(value[0]) >> 56
    assert edit_embedding.fingerprints([]).shape[0] == 0


def test_walks_go_one_round_a_symbol(monkeypatch):
    """One vector operation of a kind for each symbol of the longest piece, not for each of its three steps; where the walks come to every symbol is as in a plain one."""
    rng, rounds = random.Random(5), []

    class Table(np.ndarray):
        def take(self, *args, **options):
            rounds.append(1)
            return super().take(*args, **options)

    table = edit_embedding._waits(3).view(Table)
    monkeypatch.setattr(edit_embedding, "_waits", lambda seed: table)
    bits = edit_embedding._walk_bits(3)
    kind = np.array(rng.choices(range(1, 256), k=9000), np.uint8)
    begin = np.array([0, 5000, 5000, 5001, 5100])
    end = np.r_[begin[1:], 9000]
    walks = edit_embedding.Walks(kind, begin, end, 3)
    assert len(rounds) == 5000
    for piece, (a, b) in enumerate(zip(begin.tolist(), end.tolist())):
        at, reads = a, []
        while at < b and len(reads) < 3 * (b - a):
            reads.append(at)
            at += int(bits[len(reads) % edit_embedding.PERIOD - 1, kind[at]])
        assert walks.stop[piece] == len(reads)
        assert walks.read(np.full(len(reads), piece), np.arange(len(reads))).tolist() == reads
    for block, rows in ((1, 7), (2, 64)):
        again = edit_embedding.Walks(kind, begin, end, 3, block, rows)
        assert (again.stop == walks.stop).all() and (again.came[:9000] == walks.came[:9000]).all()


def test_long_texts_are_cut_where_their_symbols_say_so():
    rng = random.Random(14)
    text = "".join(rng.choices("abcdefgh ", k=900_000))
    near = text[:100_000] + "inserted" + text[100_000:700_000] + text[700_050:]
    a, b, c = edit_embedding.fingerprints([text, near, "".join(rng.choices("abcdefgh ", k=900_000))])
    assert edit_embedding.likeness(a, b) > 0.6 > 0.1 > edit_embedding.likeness(a, c)
    assert edit_embedding.near(text, near, 0.001) and not edit_embedding.near(text, near[::-1], 0.01) and not edit_embedding.near(text, near, 0.00001)


def test_fingerprints_keep_small_edits_close(spark):
    rng = random.Random(9)
    text = " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(120))
    near, far = text[:300] + "ZZ" + text[302:], " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(120))
    a, b, c = edit_embedding.fingerprints([text, near, far])
    assert edit_embedding.likeness(a, b) > 0.6 > 0.1 > edit_embedding.likeness(a, c)
    df = spark.createDataFrame([(1, text), (2, near), (3, far), (4, text), (3, near), (None, text), (8, ""), (9, None)], "doc_id long, text string")
    want = [(None, None), (1, 1), (2, 1), (3, 1), (3, 3), (4, 1), (8, 8), (9, 9)]
    for out in (edit_embedding.near_copies(df), edit_embedding.follow(df, part_bytes=500)):
        assert sorted(((r["doc_id"], r["component_id"]) for r in out.collect()), key=lambda x: (x[0] or 0, x[1] or 0)) == want


def shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {b for b in blocks.mkString(" ").split() if b.startswith("shuffle_")}


def test_edit_embedding_leaves_no_shuffle_files(spark, docs, monkeypatch):
    """Texts and bands are shuffled several times over: what one step has shuffled is gone when a later one writes, without a garbage collection. Fingerprints are written once."""
    before, names, write = shuffle_files(spark), [], edit_embedding.written
    monkeypatch.setattr(edit_embedding, "written", lambda df, name: (names.append(name), write(df, name))[1])
    rows = edit_embedding.follow(docs, part_bytes=2000)
    assert names.count("followed") == 1 and "fingerprints" not in names
    until = time.time() + 20  # files are removed by a message to the executors
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(CLEANUP, "false") == "false" and rows.count() == docs.count()


def edits(text: str, n: int, rng: random.Random) -> str:
    """The text after n edits at places drawn over the whole of it."""
    out = list(text)
    for _ in range(n):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        out[at : at + (kind < 2)] = [rng.choice("xyzé")] if kind else []
    return "".join(out)


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edit_components(rows: list[tuple], share: float) -> dict:
    name = {i: i for i, _ in rows}
    for i, a in rows:
        for j, b in rows:
            if i < j and edit_distance(a, b) <= share * max(len(a), len(b)):
                low, high = sorted((name[i], name[j]))
                name = {k: low if v == high else v for k, v in name.items()}
    return name


def test_near_copies_recall_against_brute_force(spark):
    """Of all pairs up to the promised distance, edits scattered over the text, nine in ten are linked; none beyond it is."""
    rng, rows = random.Random(5), []
    for k in range(120):
        text = "".join(rng.choices("abcdefgh ", k=rng.randint(300, 900)))
        part = (0.002, 0.005, 0.01, 0.05)[k % 4]
        rows += [(2 * k, text), (2 * k + 1, edits(text, max(1, int(part * len(text))), rng))]
    close = {i for i in range(0, 240, 2) if edit_distance(rows[i][1], rows[i + 1][1]) <= 0.01 * max(len(rows[i][1]), len(rows[i + 1][1]))}
    got = {r["doc_id"]: r["component_id"] for r in edit_embedding.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = {i for i in range(0, 240, 2) if got[i] == got[i + 1]}
    assert found <= close and len(found) >= 0.9 * len(close) and len(close) >= 60
    assert all(got[i] in (i, i - i % 2) for i in got)
    for _ in range(300):
        a, b = ("".join(rng.choices("abé", k=rng.randrange(90))) for _ in range(2))
        most = rng.randrange(60)
        assert edit_embedding.within(a, b, most) == (edit_distance(a, b) <= most)
        assert edit_embedding.distance(a, b, most) == min(edit_distance(a, b), most + 1)


def test_long_texts_are_verified_by_their_whole_distance(spark):
    """Edits of more than 2000 characters in one passage, and edits in every piece of a text, count as they do in short texts."""
    rng = random.Random(21)
    a = "".join(rng.choices("abcdefgh ", k=250_000))
    b, c = a[:100_000] + "".join(rng.choices("xyz", k=2300)) + a[102_300:], edits(a, 2400, rng)
    assert edit_embedding.near(a, b, 0.01) and not edit_embedding.near(a, b, 0.009) and edit_embedding.distance(a, b, 2500) == 2300
    assert edit_embedding.near(a, c, 0.01) and not edit_embedding.near(a, edits(a, 3500, rng), 0.01)
    df = spark.createDataFrame([(0, a), (1, b), (2, a[::-1])], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in edit_embedding.near_copies(df).collect()} == {0: 0, 1: 0, 2: 2}
    for _ in range(300):
        a, b = ("".join(rng.choices("abé", k=rng.randrange(90))) for _ in range(2))
        most, wide = rng.randrange(60), rng.choice((0, 5, 20))
        assert edit_embedding.distance(a, b, most, wide) == min(edit_distance(a, b), most + 1)


def test_near_copies_recall_on_long_texts(spark):
    """Walks over long texts are put out of step for good by edits all over them; nine in ten pairs are linked all the same."""
    rng, rows = random.Random(17), []
    for k, n in enumerate([8_000] * 20 + [20_000] * 20 + [100_000] * 10):
        text = "".join(rng.choices("abcdefgh ", k=n))
        rows += [(2 * k, text), (2 * k + 1, edits(text, n * 9 // 1000, rng))]
    got = {r["doc_id"]: r["component_id"] for r in edit_embedding.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    assert all(got[i] in (i, i - i % 2) for i in got)
    for pairs in (range(20), range(20, 40), range(40, 50)):
        assert sum(got[2 * k + 1] == 2 * k for k in pairs) >= 0.9 * len(pairs)


def test_sketches_do_not_depend_on_the_batch():
    rng = random.Random(18)
    texts = ["", "a", "x" * 3000, "ab" * 700] + ["".join(rng.choices("abcdefgh é", k=rng.randrange(3000))) for _ in range(40)]
    prints = edit_embedding.fingerprints(texts)
    got = edit_embedding.sketches(texts, prints)
    assert (got == np.vstack([edit_embedding.sketches([t], p[None]) for t, p in zip(texts, prints)])).all() and (got == edit_embedding.sketches(texts, prints, block=3)).all()
    short = [i for i, t in enumerate(texts) if len(t) <= edit_embedding.FINE]
    assert (got[short] == prints[short]).all() and (got[:, :63] == prints[:, :63]).all() and (got != prints).any()
    assert edit_embedding.sketches([], prints[:0]).shape == (0, 128)


def test_near_copies_meet_by_length(spark):
    """Classes of equal signatures share a bucket if their lengths may be near, across the edges of cells too; lengths far apart, whose bands agree by chance, share none."""
    cells = spark.range(1, 1500).select(edit_embedding.length_cells("id", 0.01).alias("c")).collect()
    sets = [set(r["c"]) for r in cells]
    assert all(sets[a - 1] & sets[b - 1] for b in range(1, 1500) for a in range(b - int(0.01 * b), b))
    assert sum(map(len, sets)) < 1.2 * len(sets)
    classes = spark.createDataFrame([(0, 1000, bytearray(6)), (1, 1010, bytearray(6)), (2, 2000, bytearray(6))], "node long, n_chars long, signature binary")
    search = edit_embedding.Search(None, np.uint8, 3, 0.2, None, None, None, edit_embedding.length_cells("n_chars", 0.01))
    held = {n: {(r["index"], r["band"]) for r in search.bands(classes, 6).collect() if r["node"] == n} for n in range(3)}
    assert {i for i, _ in held[0] & held[1]} == {0, 1} and not held[2] & (held[0] | held[1])


def test_near_copies_behind_a_head_unlike_them(spark):
    """The only bucket of two near texts has a third, unlike them, as its least id."""
    rng, alike = random.Random(6), edit_embedding.likeness
    while True:
        a, b = ("".join(rng.choices("abcdefgh", k=200)) for _ in range(2))
        c = b[:150] + "Z" + b[151:]
        p = edit_embedding.fingerprints([a, b, c])
        if p[0, 0] == p[1, 0] == p[2, 0] and alike(p[1], p[2]) >= 0.5 > max(alike(p[0], p[1]), alike(p[0], p[2])):
            break
    df = spark.createDataFrame([(0, a), (1, b), (2, c)], "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in edit_embedding.near_copies(df, band=1, likely=0.4, share=0.2).collect()} == {0: 0, 1: 1, 2: 1}


# --- packing


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_paths()[0])
    ids = {i: t.encode(x or "", add_special_tokens=False).ids + [2] for i, x, *_ in rows}
    got = packing.pack_documents(docs).collect()
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(own) == r["length"] and r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
    for i, parts in by_doc.items():
        parts.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts))) and sum(r["length"] for r in parts) == len(ids[i])
        assert len(ids[i]) > 1024 or len(parts) == 1
        assert all(r["length"] == 1024 for r in parts[1:])
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in parts] == np.cumsum([0] + [r["length"] for r in parts])[:-1].tolist() and sum(r["length"] for r in parts) <= 1024
    assert set(by_doc) == set(ids) and len(by_sequence) <= 1.03 * -(-sum(map(len, ids.values())) // 1024) + 1
    assert packing.pack_documents(empty).count() == 0


def test_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    paths = packing.tokenizer_paths()
    t, encode = Tokenizer.from_file(paths[0]), packing.load_encoder(*paths)
    rng = random.Random(0)
    texts = ["", " ", "a<|endoftext|>b", "it's 12,345  \n\n x\t\r\n", "naïve — “q” 漢字 😀🏽 á", "\x00\x01", "  x"] + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 0x2FFF), 32, 10])) for _ in range(60)) for _ in range(200)]
    for x in texts:
        assert encode(x) == t.encode(x, add_special_tokens=False).ids


def test_packing_in_many_rounds(spark):
    rng = random.Random(6)
    sizes = [rng.randint(1, 1024) for _ in range(3000)]
    units = spark.createDataFrame(list(enumerate(sizes)), "unit long, length long")
    got = packing.pack(units, local=200).collect()
    fill, places = Counter(), {}
    for r in got:
        fill[r["sequence_id"]] += sizes[r["unit"]]
        places.setdefault(r["sequence_id"], []).append((r["offset"], sizes[r["unit"]]))
    assert len(got) == 3000 and max(fill.values()) <= 1024
    for p in places.values():
        p.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(p, p[1:])) and p[0][0] == 0
    assert len(fill) <= 1.04 * sum(sizes) / 1024


# --- quality


def test_quality_on_held_out_rows(spark):
    """Trained on some labels, told on others."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id", F.lit(99)), F.lit(4)) == 0
    marks = quality.classify(docs, labels.filter(~held)).join(labels.filter(held), "doc_id").groupBy("quality", "toxic").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()
    for r in marks:
        good = r["quality"] == 1 and r["toxic"] == 0
        assert r["kept"] >= 0.99 if good else r["kept"] <= 0.15, r


def test_quality_edges(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.classify(docs, none).filter("not kept").count() == 0
    assert quality.classify(empty, none).count() == 0
    odd = spark.createDataFrame([(0, None, 1), (0, 1, 0), (0, 1, 0), (None, 0, 1), (10**9, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.select_documents(docs.withColumn("rejected_id", F.lit(1)), odd).count() == docs.count()


def plain_grams(text: str) -> Counter:
    """What grams counts, one token at a time: n-grams as strings."""
    data = "".join(chr(b) for b in text.encode())
    tokens = re.findall(r"[A-Za-z\x80-\xff]+|[0-9]+|[^\x20\x09-\x0DA-Za-z0-9\x80-\xff]+", data)
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in tokens]
    forms = []
    for i, (t, w) in enumerate(zip(tokens, low)):
        n = sum("A" <= c <= "Z" for c in t)
        near = [b for b in range(1, quality.BACK + 1) if b <= i and low[i - b] == w]
        kind = "d" if t[0].isdigit() else "w" if re.match("[A-Za-z\x80-\xff]", t) else t
        case = "none" if not n else "all" if n == len(t) else "first" if n == 1 and "A" <= t[0] <= "Z" else "some"
        forms.append(f"back {near[0]}" if near else kind if kind == t else f"{kind} {case}")
    out = Counter(("word", w) for w in low)
    out.update(("pair", a, b) for a, b in zip(low, low[1:]))
    for t, w in zip(tokens, low):
        if re.match("[A-Za-z\x80-\xff]", t):
            out.update(("piece", (" " + w)[i : i + quality.PIECE]) for i in range(len(w) + 2 - quality.PIECE))
    for k in (3, 5):
        out.update(("form", k, *forms[i : i + k]) for i in range(len(forms) - k + 1))
    return out


def test_grams_against_a_plain_count():
    """The same n-grams get the same bucket, others mostly another; counts and sizes agree."""
    texts = [t or "" for _, t, *_ in corpus(3)] + ["a a a a B-52!! B-52!! Äß 12", "", " x", "éééé ABC aBc Abc worldwide"]
    owner, bucket, count, total = quality.grams([t.encode() for t in texts])
    alone = [quality.grams([t.encode()]) for t in texts]
    assert np.array_equal(np.concatenate([a[1] for a in alone]), bucket) and np.array_equal(np.concatenate([a[2] for a in alone]), count)
    seen, pooled = {}, Counter()
    for i, t in enumerate(texts):
        want = plain_grams(t)
        assert total[i] == sum(want.values()) == count[owner == i].sum() and len(want) * 0.98 <= (owner == i).sum() <= len(want)
        pooled.update(want)
        seen.setdefault(tuple(sorted(want.items())), sorted(zip(bucket[owner == i], count[owner == i])))
        assert seen[tuple(sorted(want.items()))] == sorted(zip(bucket[owner == i], count[owner == i]))
    assert len(set(bucket.tolist())) >= 0.98 * len(pooled)


def test_weights_against_a_plain_model(spark):
    """Ratios, the rest and weights of a small table, counted with dictionaries."""
    rng = random.Random(11)
    common, texts, good = [f"word{i}" for i in range(30)], [], []
    for i in range(400):
        poor = i % 3 == 0
        texts.append(" ".join(rng.choices(common, k=20) + ["junk"] * (poor * rng.randint(1, 5))))
        good.append(not poor)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sample = spark.createDataFrame([(t, g, True) for t, g in list(zip(texts, good))[::2]], "text string, good boolean, harmless boolean")
    model = quality.fit(docs, sample, least_z=3.0, least_effect=0.5)
    got = {r["doc_id"]: r["good"] for r in quality.weigh(docs, model, "doc_id").collect()}
    each = [Counter(dict(zip(b.tolist(), c.tolist()))) for _, b, c, _ in (quality.grams([t.encode()]) for t in texts)]
    near = [e for e, g in list(zip(each, good))[::2] if g]
    mass = [sum(map(Counter, of), Counter()) for of in (near, each)]
    size = [sum(m.values()) for m in mass]
    level = [Counter() for _ in range(2)]
    for l, of in zip(level, (near, each)):
        for e in of:
            l.update({b: c.bit_length() for b, c in e.items()})
    own, scale = {}, min(1.0, size[0] / size[1])
    for b in mass[1]:
        ratio = math.log((mass[0][b] + 0.5) / size[0]) - math.log((mass[1][b] * scale + 0.5) / (size[1] * scale))
        p = (level[0][b] + level[1][b]) / (len(near) + len(each))
        told = sum(x * math.log(x / (p * n)) for x, n in ((level[0][b], len(near)), (level[1][b], len(each))) if x)
        if abs(ratio) >= 0.5 and 2 * told >= 9:
            own[b] = ratio
    rest = math.log((size[0] - sum(mass[0][b] for b in own)) / size[0]) - math.log((size[1] - sum(mass[1][b] for b in own)) / size[1])
    assert own and rest > 0
    for i, e in enumerate(each):
        assert abs(got[i] - sum(c * own.get(b, rest) for b, c in e.items())) < 1e-6
    assert max(got[i] for i in got if not good[i]) < min(got[i] for i in got if good[i])


def test_top_k_is_exact(spark):
    rng = random.Random(8)
    values = [rng.choice([0.0, 1.5, rng.random(), rng.random() * 1e6]) for _ in range(30_000)]
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, key double").cache()
    for k in (0, 1, 777, 15_000, 30_000):
        got = {r[0] for r in df.filter(quality._top(df, "key", k, ids=("doc_id",))).select("doc_id").collect()}
        assert got == set(sorted(range(len(values)), key=lambda i: (-values[i], i))[:k])


# --- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, sf), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert 0 < docs.select("doc_id").distinct().count() <= n
    packed = corpus_pipeline.pack_sequences(spark, docs, sf)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
