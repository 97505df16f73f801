"""Decontamination, exact substrings, near-duplicates: against brute force."""

import random
import time

import fixture_docs as fx
import numpy as np
import pyarrow as pa
import pytest
from fixture_docs import docs, no_docs, rows  # noqa: F401
from pyspark.sql import functions as F

from tideline.llm import neardup, repeats
from tideline.llm import text as tx
from tideline.llm.common import merged_spans
from tideline.llm.decontaminate import decontaminate
from tideline.llm.graph import components
from tideline.session import scratch_folders


@pytest.mark.parametrize("table", [tx.space_words(), tx.letter_words()], ids=["space", "letter"])
@pytest.mark.parametrize("segment", [7, 1 << 20])
def test_words_match_the_patterns(monkeypatch, table, segment):
    monkeypatch.setattr(tx, "SEGMENT", segment)
    rng = random.Random(2)
    texts = ["".join(rng.choice("aBé \n\t.9_x") for _ in range(rng.randint(0, 60))) for _ in range(200)] + [None, "", "a" * 99]
    split = (lambda t: fx.space_words(fx.low(t))) if table[0x2E] else fx.letter_words
    for first, last, data, offsets in tx.slices(pa.array(texts), limit=400):
        w = tx.Words(data, offsets, table)
        for i in range(first, last):
            got = [w.joined(j, j + 1).decode() for j in range(w.bounds[i - first], w.bounds[i - first + 1])]
            assert got == split(texts[i])


ITEMS = [(1, "x"), (2, None), (None, "two words"), (3, ""), (4, "Same line same")]


def test_decontaminate(spark, docs, rows):
    long = " ".join(fx.letter_words(rows[0][1])[:11])
    items = [*ITEMS, (5, long), (5, long), (6, " ".join(fx.letter_words(rows[1][1])[2:12]) + " tail of the item"), (7, "word")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("window", F.lit("clash"))
    got = decontaminate(docs, benchmark).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    assert sorted(((r[0], r[1], r[2], list(r[3])) for r in got), key=key) == sorted(fx.contamination(rows, items), key=key)
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in got)


def test_decontaminate_empty(spark, docs, no_docs):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate(no_docs, benchmark).count() == 0
    assert decontaminate(docs, benchmark.limit(0)).where("n_hit > 0 or n_items > 0").count() == 0


def _repeats(docs, **options):
    rows, texts = repeats.dedup_repeats(docs, **options)
    cut = texts.select("t1", "t2", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha")).distinct()
    out = rows.join(cut, ["t1", "t2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)), F.coalesce("n_spans", F.lit(0)), F.coalesce("sha", "text_sha256"))
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("crowd", [2048, 2, 0])  # gathered by gram; counted, for hot grams; counted only
def test_repeats(docs, rows, crowd):
    import hashlib

    expected = [(r[0], n, gone, runs, hashlib.sha256(kept).hexdigest())
                for r, (n, gone, runs, kept) in zip(rows, fx.repeated_bytes([r[1] for r in rows]))]
    assert sum(e[2] for e in expected) > 5000
    assert _repeats(docs, crowd=crowd) == sorted(expected, key=repr)


def test_repeats_in_chunks_of_a_long_text(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 60_000).astype(np.uint8)
    whole = repeats._anchors(data, np.array([0, len(data)]))
    monkeypatch.setattr(repeats, "CHUNK", 3_000)
    parts = repeats.anchors(data, np.array([0, len(data)]))
    for a, b in zip(whole, parts):
        assert np.array_equal(a, b)


def test_repeats_empty(no_docs):
    assert _repeats(no_docs) == []


def test_repeats_cut_contexts_in_small_batches(monkeypatch):
    """A batch of contexts is as large as a chunk of text needs, however many texts Spark hands over at once."""
    monkeypatch.setattr(repeats, "CHUNK", 5_000)
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdef") for _ in range(2_000)) for _ in range(40)]
    asked, expected = [], set()
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        _, place, gram, context, left, right = repeats.anchors(data, np.array([0, len(data)]))
        asked.append([{"gram": g, "context": c, "n": 1, "crowd": 2} for g, c in zip(gram.tolist(), context.tolist())])
        for p, g, x, y in zip(place.tolist(), gram.tolist(), left.tolist(), right.tolist()):
            expected.add((g, t[p - x : p][::-1].encode(), t[p : p + y].encode()))
    batch = pa.RecordBatch.from_pydict({"text": texts, "wanted": asked})
    got = list(repeats._cut_contexts(iter([batch])))
    assert {(r["gram"], r["before"], r["after"]) for b in got for r in b.to_pylist()} == expected
    assert max(b.num_rows for b in got) < len(expected) / 5


@pytest.mark.parametrize("todo", [None, list(range(1, 300))])
def test_repeats_hash_runs_in_small_batches(todo):
    """The run hashes of a batch of contexts are not held all at once."""
    rng = random.Random(7)
    n = 4 * repeats.ROWS + 1
    rows = {"gram": [5] * n, "context": list(range(n)), "before": [rng.randbytes(repeats.LEFT) for _ in range(n)],
            "after": [rng.randbytes(repeats.LENGTH) for _ in range(n)]} | ({"todo": [todo] * n} if todo else {})
    got = list(repeats._cut_runs(iter([pa.RecordBatch.from_pydict(rows)])))
    keys = [k for b in got for k in zip(b["context"].to_pylist(), b["kind"].to_pylist(), b["d"].to_pylist())]
    each = [(0, d) for d in todo] if todo else [(0, d) for d in range(0, 301, 20)] + [(1, d) for d in range(0, 300, 20)]
    assert sorted(keys) == sorted((i, *k) for i in range(n) for k in each)
    assert max(b.num_rows for b in got) <= repeats.ROWS * len(each)


def test_repeats_write_few_files(spark, docs):
    """Small tables between the steps are not dealt over as many files as the session has shuffle partitions."""
    before, kept = set(scratch_folders(spark)), {}
    for key, value in {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}.items():
        kept[key] = spark.conf.get(key)
        spark.conf.set(key, value)
    try:
        repeats.dedup_repeats(docs, crowd=2)
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    files = {f: len(spark.read.parquet(f).inputFiles()) for f in scratch_folders(spark) if f not in before}
    assert len(files) >= 6
    small = {f: n for f, n in files.items() if not any(x in f for x in ("-texts-", "-anchors-"))}  # as many as the input has
    assert max(small.values()) == 1, files


def test_repeats_context_listed_twice_is_no_repeat(spark):
    rng = random.Random(8)
    rows = [(5, i, 1, rng.randbytes(repeats.LEFT), rng.randbytes(repeats.LENGTH)) for i in (1, 1, 2)]
    rows[1] = rows[0]
    contexts = spark.createDataFrame(rows, "gram long, context long, n long, before binary, after binary")
    assert repeats.scan_crowds(contexts).count() == 0


def test_maximal_repeats_have_all_occurrences():
    after = [b"b" * 300 + x for x in (b"1", b"2", b"2", b"")]
    before = [b"a" * 200 + x for x in (b"7", b"8", b"8x", b"9")]
    got = {(left, right): sorted(m) for left, right, m in repeats.maximal_repeats(before, after, [1] * 4)}
    assert got == {(200, 300): [0, 1, 2, 3], (201, 301): [1, 2]}


@pytest.mark.parametrize("block", [neardup.BLOCK, 150])  # groups settled in one task; in blocks
def test_near_duplicates(docs, rows, block):
    got = neardup.near_duplicates(docs, block=block).select("doc_id", "n_shingles", "component_id", "kept").collect()
    expected = fx.near_components(rows)
    assert sorted((tuple(r)[:3] for r in got), key=repr) == sorted(expected, key=repr)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_empty(no_docs):
    assert neardup.near_duplicates(no_docs).count() == 0


def test_signature_keys_meet_within_the_distance(spark):
    """Any pair that differs in at most 23 of the 48 symbols shares a key."""
    rng = np.random.default_rng(4)
    one = rng.integers(0, 1 << 16, neardup.SYMBOLS).astype(np.uint16)
    rows = [(0, one.tobytes())]
    for i in range(1, 60):
        other = one.copy()
        other[rng.choice(neardup.SYMBOLS, 23, replace=False)] ^= np.uint16(1)
        rows.append((i, other.tobytes()))
    keys = neardup.keys(spark.createDataFrame([(i, bytearray(s)) for i, s in rows], "node long, sig binary"))
    met = keys.alias("a").join(keys.alias("b"), "key").where("a.node = 0 and b.node > 0").select("b.node").distinct().count()
    assert met == 59


def test_links_connect_like_all_pairs():
    rng = random.Random(8)
    base = np.arange(60, dtype=np.uint64)
    sets = []
    for _ in range(80):
        s = set(base.tolist())
        for _ in range(rng.randint(0, 8)):
            s.discard(rng.randrange(60))
            s.add(rng.randrange(60, 90))
        sets.append(np.array(sorted(s), np.uint64))

    def parts(pairs):
        label = list(range(len(sets)))
        for a, b in pairs:
            x, y = label[a], label[b]
            label = [x if v == y else v for v in label]
        return [label.index(v) for v in label]

    full = [(a, b) for a in range(80) for b in range(a)
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))]
    found = neardup.links(sets)
    assert parts(found) == parts(full) and len(found) < 80


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200), (200, 150), (7, 7), (300, 301), (301, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 150: 100, 200: 100, 300: 300, 301: 300}


def test_spans_are_merged_in_linear_time(spark):
    """Also 100,000 that stay apart within one text."""
    rng = random.Random(2)
    rows = [(k, s, s + rng.randint(1, 9)) for k in range(40) for s in (rng.randint(0, 200) for _ in range(30))]
    frame = spark.createDataFrame(rows, "k int, start long, stop long")
    for r in merged_spans(frame, "k").collect():
        inside = {p for k, a, b in rows if k == r["k"] for p in range(2 * a, 2 * b + 1)}  # the ends too, so that what touches is joined
        assert {p for x in r["spans"] for p in range(2 * x["start"], 2 * x["stop"] + 1)} == inside
        assert all(a["stop"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
    apart = spark.range(100_000).select(F.lit(1).alias("k"), (F.col("id") * 3).alias("start"), (F.col("id") * 3 + 2).alias("stop"))
    began = time.time()
    assert len(merged_spans(apart, "k").first()["spans"]) == 100_000
    assert time.time() - began < 60  # by copying the list it took some ten minutes
