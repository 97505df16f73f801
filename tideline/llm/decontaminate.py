"""Benchmark decontamination: prefix-filtered join of documents with item windows.

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
A window is ``window`` consecutive words of an item; an item with fewer words,
but not none, is one window.  A window occurs where a document holds exactly
its words in a row.

How it is joined:

1. *Rarity.*  Every shingle (``SHINGLE`` words, or the whole window if shorter)
   of every window is counted over the whole corpus.
2. *Necessary prefix.*  To hold a window a document must hold all its
   shingles, so of the shingles in order of rarity a prefix of one is
   necessary: the rarest.  Only it goes into the join.
3. *Bounds.*  A hit of the shingle at document word q, which stands at word p
   of the window, can only be the window at q - p: it must begin and end
   inside the document.
4. *Verification.*  The item-sized run of document words there is compared
   with the window, word for word.

Documents are filtered before the join by two probes of a bitmap of fixed
greatest size (``MAX_BITS``), built from the benchmark's shingles.  A larger
benchmark makes the bitmap pass more, the join stays exact.  The benchmark
itself is never broadcast by this module; Spark does so when it is small.

Edge cases: null or empty text has no words and no hits.  A null item text
has no window; a null item_id is matched, hit words count, but it adds no id.
Equal item rows count as one.  Rows that repeat a doc_id are judged one by one,
so are null ids.  Empty tables give empty results or no hits.  Other columns of the
inputs are not read, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm import text as tx
from tideline.llm.common import materialize, merged_spans, pick

WINDOW = 10
SHINGLE = 3
MAX_BITS = 27  # the bitmap has at most 2**27 bits: 16 MB

HITS_SCHEMA = ("row long, doc_id {id}, text_hash long, n_words long, "
               "found array<struct<key: long, at: long, lo: long, words: string>>")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Windows of the items: ``item_id, window, w`` and the shingle hashes by place ``keys``."""

    def cut(batches):
        table = tx.letter_words()
        for batch in batches:
            ids, wins, size, keys = [], [], [], []
            for first, last, data, offsets in tx.slices(batch.column(1)):
                words = tx.Words(data, offsets, table)
                hashed = {}
                for i in range(last - first):
                    lo, n = int(words.bounds[i]), int(words.counts[i])
                    if n == 0:
                        continue
                    w = min(window, n)
                    k = min(shingle, w)
                    if k not in hashed:
                        hashed[k] = dict(zip(*(a.tolist() for a in words.shingles(k))))
                    for s in range(lo, lo + n - w + 1):
                        ids.append(batch.column(0)[first + i].as_py())
                        wins.append(words.joined(s, s + w).decode("utf-8", "replace"))
                        size.append(w)
                        keys.append(np.array([hashed[k][s + j] for j in range(w - k + 1)], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(0).type), pa.array(wins, pa.string()), pa.array(size, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["item_id", "window", "w", "keys"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.mapInArrow(cut, f"item_id {kind}, window string, w long, keys array<long>")


def bitmap(keys: DataFrame, spread: int = 14) -> np.ndarray:
    """Bits at two places for each ``key``; at most ``2**MAX_BITS`` of them."""
    n = keys.select(F.approx_count_distinct("key")).first()[0]
    bits = min(MAX_BITS, max(16, math.ceil(math.log2(n + 1)) + spread))
    mask = (1 << bits) - 1
    place = F.explode(F.array(F.col("key").bitwiseAND(F.lit(mask)),
                              F.shiftrightunsigned("key", 64 - bits).bitwiseAND(F.lit(mask)))).alias("at")
    # one row of 32 bits each, so at most 2**(MAX_BITS - 5) rows reach the driver
    rows = (keys.select(place).select(F.shiftright("at", 5).alias("cell"),
                                      F.expr("shiftleft(1L, cast(at & 31 as int))").alias("bit"))
            .groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 5), dtype=np.uint32)
    out[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy().astype(np.uint32)
    return out


def probe(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of ``keys`` that may be in the bitmap."""
    size = int(len(bits)).bit_length() - 1 + 5
    mask = np.uint64((1 << size) - 1)

    def at(a):
        return (bits[(a >> np.uint64(5)).astype(np.int64)] >> (a & np.uint64(31)).astype(np.uint32)) & np.uint32(1)

    hit = np.flatnonzero(at(keys & mask))
    return hit[at(keys[hit] >> np.uint64(64 - size)) == 1]


def corpus_counts(docs: DataFrame, bits, sizes: list[int]) -> DataFrame:
    """How often each shingle that passes the bitmap occurs in the corpus: ``key, n``."""

    def count(batches):
        table = tx.letter_words()
        seen, held = [], 0

        def total():
            keys, n = np.unique(np.concatenate(seen), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

        for batch in batches:
            for _, _, data, offsets in tx.slices(batch.column(0)):
                words = tx.Words(data, offsets, table)
                for k in sizes:
                    h = words.shingles(k)[1]
                    seen.append(h[probe(bits.value, h)])
                    held += len(seen[-1])
            if held > 1 << 20:
                yield total()
                seen, held = [], 0
        if held:
            yield total()

    return docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def candidates(docs: DataFrame, bits, sizes: list[int], window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per document its word count and where a wanted shingle may stand, with the words around it."""

    def find(batches):
        table = tx.letter_words()
        row = TaskContext.get().partitionId() << 33
        kind = pa.list_(pa.struct([("key", pa.int64()), ("at", pa.int64()), ("lo", pa.int64()), ("words", pa.string())]))
        for batch in batches:
            for first, last, data, offsets in tx.slices(batch.column(1)):
                words = tx.Words(data, offsets, table)
                found: list[list] = [[] for _ in range(last - first)]
                own = words.owner()
                for k in sizes:
                    places, h = words.shingles(k)
                    hit = probe(bits.value, h)
                    reach = window - k if k == shingle else 0  # shorter windows are a single shingle
                    for s, key in zip(places[hit].tolist(), h[hit].view(np.int64).tolist()):
                        i = own[s]
                        base, end = int(words.bounds[i]), int(words.bounds[i + 1])
                        lo, hi = max(base, s - reach), min(end, s + k + reach)
                        found[i].append({"key": key, "at": s - base, "lo": lo - base,
                                         "words": words.joined(lo, hi).decode("utf-8", "replace")})
                n = last - first
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), batch.column(0).slice(first, n), batch.column(2).slice(first, n),
                     pa.array(words.counts.astype(np.int64)), pa.array(found, kind)],
                    names=["row", "doc_id", "text_hash", "n_words", "found"])
                row += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(find, HITS_SCHEMA.format(id=kind))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each document: ``doc_id, text_hash, n_words, n_hit, n_items, items, contaminated, spans``.

    ``items`` are the ids of the items with occurring windows as strings, sorted as
    strings; ``spans`` are the hit runs of words, as begin and end (exclusive).
    """
    spark = docs.sparkSession
    docs = pick(docs, doc_id=id_col, text=text_col)
    items = pick(benchmark, item_id=item_col, text=item_text_col)
    windows = materialize(benchmark_windows(items, window).distinct(), "windows")
    texts = windows.select("window", "w", "keys").distinct()
    sizes = [r[0] for r in texts.select(F.least(F.lit(SHINGLE), F.col("w"))).distinct().collect()]  # at most SHINGLE values
    shingles = texts.select("window", "w", F.posexplode("keys").alias("p", "key"))

    bits = spark.sparkContext.broadcast(bitmap(shingles.select("key")))
    counted = corpus_counts(docs, bits, sizes)
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "p")).alias("first")
    index = materialize(shingles.join(counted, "key", "left").groupBy("window", "w").agg(rarest)
                        .select("window", "w", F.col("first.key").alias("key"), F.col("first.p").alias("p")), "prefixes")

    bits = spark.sparkContext.broadcast(bitmap(index.select("key")))
    found = materialize(candidates(docs, bits, sizes, window), "candidates")
    at = found.select("row", "n_words", F.explode("found").alias("f")).select("row", "n_words", "f.*")
    start = F.col("at") - F.col("p")
    run = F.array_join(F.slice(F.split("words", " "), (F.col("start") - F.col("lo") + 1).cast("int"), F.col("w").cast("int")), " ")
    hits = (at.join(index, "key").withColumn("start", start)
            .where((F.col("start") >= F.col("lo")) & (F.col("start") + F.col("w") <= F.col("n_words")))
            .where(run == F.col("window"))
            .select("row", "start", "w", "window"))
    hits = materialize(hits, "hits")

    spans = merged_spans(hits.select("row", "start", (F.col("start") + F.col("w")).alias("stop")), "row")
    ids = (hits.select("row", "window").distinct().join(windows.select("window", "item_id").distinct(), "window")
           .groupBy("row").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    none = F.lit(None).cast("array<struct<start: bigint, stop: bigint>>")
    out = found.select("row", "doc_id", "text_hash", "n_words").join(spans, "row", "left").join(ids, "row", "left")
    return out.select(
        "doc_id", "text_hash", "n_words",
        F.coalesce(F.expr("aggregate(spans, 0L, (n, x) -> n + x.stop - x.start)"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("spans").isNotNull().alias("contaminated"),
        F.coalesce("spans", none).alias("spans"))
