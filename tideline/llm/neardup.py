"""Near-duplicate classes: b-bit MinHash signatures joined by a multi-index Hamming join.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a document's set holds
its distinct 5-word shingles (the whole sequence, if there are fewer words).
Documents are linked when ``100 * |A & B| >= 85 * |A | B|``.

1. A signature has ``SYMBOLS`` symbols of 16 bits, one for each MinHash.
2. It is split into chunks of ``PER_CHUNK`` symbols.  If two signatures differ in
   fewer than ``(ERRORS + 1) * chunks`` symbols, some chunk has at most ``ERRORS``
   of the errors (pigeonhole), and leaving out the right symbols of that
   chunk gives both the same key.  All ways to leave out ``ERRORS`` symbols are
   enumerated, so every pair within that distance (23 of 48) meets in a bucket;
   at similarity 0.85 a pair lies beyond it with a chance of about 1e-8.
3. A bucket gives one edge from each member to its least member, never all pairs.
   The components of these edges are candidate groups.
4. Each candidate group is settled on the full sets (``settle``), exactly, and
   without testing pairs that are known to be connected.  A group of
   more than ``BLOCK`` shingles is cut into blocks: a few centres go to every
   block, then each document not yet connected to the main part goes to every block.

Documents with equal sets form one class by a 128-bit fingerprint of the
set; only one of each class takes part in 2 to 4.

Edge cases: null or empty text, or text without words, has an empty set, is linked to
nothing and is its own component.  Rows that repeat a doc_id are separate
documents.  A row with a null id can be linked but never names a component; if
no row of a component has an id, component_id is null and the rows are kept.
Other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm import text as tx
from tideline.llm.common import materialize, partitions, pick, small
from tideline.llm.graph import components

SHINGLE = 5
SYMBOLS = 48
PER_CHUNK = 4
ERRORS = 1
BLOCK = 1 << 21  # shingles settled in one task
CENTRES = 8


def sets_of(data, offsets, table) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = tx.Words(data, offsets, table)
    first, h = words.shingles(SHINGLE)
    bounds = np.searchsorted(first, words.bounds)
    out = []
    for i, n in enumerate(words.counts.tolist()):
        if n >= SHINGLE:
            s = np.sort(h[bounds[i] : bounds[i + 1]])
            keep = np.ones(len(s), bool)
            keep[1:] = s[1:] != s[:-1]
            out.append(s[keep])
        elif n:
            lo, whole = int(words.bounds[i]), np.array([n], np.uint64)
            for x in words.hashes[lo : lo + n]:
                whole = whole * tx._P + x
            out.append(tx.mix(whole))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _constants():
    rng = np.random.default_rng(20240229)
    return (rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64))


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n, fp, sig``: set size, fingerprint and signature of each document."""

    def sign(batches):
        table = tx.space_words()
        times, flip = _constants()
        for batch in batches:
            for first, last, data, offsets in tx.slices(batch.column(1)):
                sets = sets_of(data, offsets, table)
                size = np.array([len(s) for s in sets], np.int64)
                some = np.flatnonzero(size)
                fp, sig = [None] * len(sets), [None] * len(sets)
                if len(some):
                    flat = np.concatenate([sets[i] for i in some])
                    at = np.concatenate([[0], np.cumsum(size[some])[:-1]])
                    prints = np.stack([np.add.reduceat(tx.mix(flat ^ flip[j]), at) for j in (0, 1)], axis=1)
                    symbols = np.empty((len(some), SYMBOLS), np.uint16)
                    for j in range(SYMBOLS):
                        least = np.minimum.reduceat((flat ^ flip[j]) * times[j], at)
                        symbols[:, j] = tx.mix(least) >> np.uint64(48)
                    for k, i in enumerate(some.tolist()):
                        fp[i], sig[i] = prints[k].tobytes(), symbols[k].tobytes()
                n = last - first
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), batch.column(2).slice(first, n), pa.array(size),
                     pa.array(fp, pa.binary()), pa.array(sig, pa.binary())],
                    names=["doc_id", "text_hash", "n", "fp", "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
            .mapInArrow(sign, f"doc_id {kind}, text_hash long, n long, fp binary, sig binary"))


def keys(classes: DataFrame) -> DataFrame:
    """The bucket keys of each class: every chunk with every choice of ``ERRORS`` symbols left out."""
    wide = 2 * PER_CHUNK
    out = []
    for chunk in range(SYMBOLS // PER_CHUNK):
        for gone in combinations(range(PER_CHUNK), ERRORS):
            rest = [F.substring("sig", chunk * wide + 2 * s + 1, 2) for s in range(PER_CHUNK) if s not in gone]
            out.append(F.xxhash64(F.lit(chunk), F.lit(sum(1 << s for s in gone)), *rest))
    return classes.select("node", F.explode(F.array(*out)).alias("key"))


def links(sets: list[np.ndarray], queries: np.ndarray | None = None, percent: int = 85) -> list[tuple[int, int]]:
    """Links that connect what the full link graph connects, found on whole sets.

    Without ``queries``: one set after another is compared with all others at
    once, by way of the shared shingles, until those left form one component.
    With ``queries``: each of these is compared with all others.
    """
    n = len(sets)
    if n < 2:
        return []
    size = np.array([len(s) for s in sets], np.int64)
    if n == 2:
        both = np.sort(np.concatenate(sets))
        common = int(np.count_nonzero(both[1:] == both[:-1]))
        return [(0, 1)] if 100 * common >= percent * (int(size.sum()) - common) else []
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n, dtype=np.int32), size)
    order = np.argsort(flat, kind="stable")
    sorted_flat = flat[order]
    new = np.ones(len(flat), bool)
    new[1:] = sorted_flat[1:] != sorted_flat[:-1]
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(flat)))
    shared_by = owner[order]  # for each shingle the sets that have it
    rank = np.empty(len(flat), np.int32)
    rank[order] = np.cumsum(new) - 1
    at = np.concatenate([[0], np.cumsum(size)])
    label = np.arange(n)
    done = np.zeros(n, bool)
    out: list[tuple[int, int]] = []

    def compare(x: int) -> None:
        mine = rank[at[x] : at[x + 1]]
        lens = count[mine]
        total = int(lens.sum())
        place = np.repeat(begin[mine] - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(total)
        common = np.bincount(shared_by[place], minlength=n)
        near = np.flatnonzero(100 * common >= percent * (size + size[x] - common))
        labels, one = np.unique(label[near], return_index=True)
        if len(labels) > 1:
            out.extend((x, int(near[i])) for lab, i in zip(labels, one) if lab != label[x])
            label[np.isin(label, labels)] = label[x]

    if queries is not None:
        for x in queries.tolist():
            compare(x)
        return out
    x = 0
    while True:
        compare(x)
        done[x] = True
        values, counts = np.unique(label, return_counts=True)
        left = np.flatnonzero(~done & (label != values[np.argmax(counts)]))
        if not len(left):
            return out
        x = int(left[0])


def settle(sets: DataFrame) -> DataFrame:
    """Verified links ``a, b`` (fingerprints) within each group of ``sets``.

    ``sets`` has ``grp``, ``fp``, ``items`` (the set's hashes) and ``query``; rows of a
    group are sorted next to each other.  A group with no query is settled as a whole.
    """

    def run(batches):
        def close(rows):
            names, arrays, ask = [], [], []
            for fp, items, query in rows:
                names.append(fp)
                arrays.append(np.frombuffer(items, np.uint64))
                ask.append(query)
            found = links(arrays, np.flatnonzero(ask) if any(ask) else None)
            return [names[i] for i, _ in found], [names[j] for _, j in found]

        group, rows, a, b = None, {}, [], []
        for batch in batches:
            grp = batch.column(0).to_pylist()
            for i in range(len(grp)):
                if grp[i] != group:
                    if len(rows) > 1:
                        x, y = close(rows.values())
                        a += x
                        b += y
                    group, rows = grp[i], {}
                fp, query = batch.column(1)[i].as_py(), batch.column(3)[i].as_py()
                if fp not in rows or query:  # repeated rows, or a query that also is a member
                    rows[fp] = (fp, batch.column(2)[i].as_py(), query)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])
            a, b = [], []
        if len(rows) > 1:
            x, y = close(rows.values())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), pa.array(y, pa.binary())], names=["a", "b"])

    return (sets.select("grp", "fp", "items", "query").repartition(partitions(sets.sparkSession), "grp")
            .sortWithinPartitions("grp").mapInArrow(run, "a binary, b binary"))


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The sets of the ``wanted`` class representatives, made from their texts again."""
    side = small(wanted)
    chosen = (docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).alias("d")
              .join(side.alias("w"), F.expr("d.text_hash = w.rep.text_hash and d.doc_id <=> w.rep.doc_id")))

    def build(batches):
        table = tx.space_words()
        for batch in batches:
            for first, last, data, offsets in tx.slices(batch.column(0)):
                n = last - first
                items = [s.tobytes() for s in sets_of(data, offsets, table)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(first, n), batch.column(2).slice(first, n), pa.array(items, pa.binary())],
                    names=["root", "fp", "items"])

    return chosen.select("text", "root", "fp").mapInArrow(build, "root long, fp binary, items binary")


def settle_blocks(sets: DataFrame, blocks: DataFrame) -> DataFrame:
    """Links of groups too large for one task; ``blocks`` has ``root`` and the number of ``blocks``."""
    sets = materialize(sets.join(blocks, "root").withColumn(
        "block", F.pmod(F.xxhash64("fp", F.lit("block")), F.col("blocks"))), "sets")

    def asked(queries: DataFrame) -> DataFrame:
        members = sets.select("root", "block", "fp", "items", F.lit(False).alias("query"))
        sent = sets.join(queries, ["root", "fp"], "left_semi").select(
            "root", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "fp", "items",
            F.lit(True).alias("query"))
        grouped = members.unionByName(sent).withColumn("grp", F.xxhash64("root", "block"))
        return materialize(settle(grouped), "links")

    first = [F.min(F.struct(F.xxhash64("fp", F.lit(i)).alias("h"), "fp")).alias(f"c{i}") for i in range(CENTRES)]
    centres = sets.groupBy("root").agg(*first).select(
        "root", F.explode(F.array(*[F.col(f"c{i}.fp") for i in range(CENTRES)])).alias("fp")).distinct()
    links1 = asked(centres)
    joined = components(links1).select(F.col("node").alias("fp"), F.col("root").alias("part"))
    parts = materialize(sets.select("root", "fp").join(joined, "fp", "left")
                        .withColumn("part", F.coalesce("part", "fp")), "parts")
    main = parts.groupBy("root", "part").count().groupBy("root").agg(
        F.max(F.struct("count", "part")).alias("m")).select("root", F.col("m.part").alias("part"))
    rest = parts.join(main, ["root", "part"], "left_anti").select("root", "fp")
    return links1.unionByName(asked(rest))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row for each document: ``doc_id, text_hash, n_shingles, component_id, kept, chosen``.

    ``chosen`` marks one document of each component by (doc_id, null last, and text hash), so also where ids repeat or
    are null; rows alike in both are all marked, and so are texts without words.
    """
    docs = pick(docs, doc_id=id_col, text=text_col)
    signed = materialize(signatures(docs), "signatures")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    classes = materialize(
        signed.where("n > 0").groupBy("fp").agg(rep.alias("rep"), F.first("sig").alias("sig"), F.first("n").alias("n"))
        .select("fp", F.conv(F.hex(F.substring("fp", 1, 7)), 16, 10).cast("long").alias("node"), "sig", "n",
                F.col("rep").alias("rep")), "classes")

    bucketed = keys(classes)
    heads = bucketed.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("rows")).where("rows > 1")
    edges = (bucketed.join(heads.select("key", "head"), "key").where("node <> head")
             .select(F.col("node").alias("a"), F.col("head").alias("b")).distinct())
    groups = components(edges)
    wanted = materialize(classes.drop("sig").join(groups, "node"), "candidates")
    blocks = wanted.groupBy("root").agg(F.sum("n").alias("n")).where(F.col("n") > block).select(
        "root", F.ceil(F.col("n") / block).cast("long").alias("blocks"))
    blocks = materialize(blocks, "blocks")
    small = wanted.join(blocks, "root", "left_anti")
    found = settle(full_sets(docs, small).select(F.col("root").alias("grp"), "fp", "items", F.lit(False).alias("query")))
    if not blocks.isEmpty():
        found = found.unionByName(settle_blocks(full_sets(docs, wanted.join(blocks, "root", "left_semi")), blocks))
    parts = components(found)

    of_class = (classes.select("fp", "rep").join(parts, F.col("fp") == F.col("node"), "left")
                .select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    named = of_class.groupBy("root").agg(F.min("rep").alias("first"))
    of_class = of_class.join(named, "root").select("fp", "first")
    chosen = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.col("text_hash").eqNullSafe(F.col("first.text_hash"))
    linked = signed.where("n > 0").join(of_class, "fp").select(
        "doc_id", "text_hash", "n", F.col("first.doc_id").alias("component_id"), chosen.alias("chosen"))
    alone = signed.where("n = 0").select(
        "doc_id", "text_hash", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("chosen"))
    return linked.unionByName(alone).select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "chosen")
