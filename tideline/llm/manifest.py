"""Merkle manifest of a dataset: a leaf for each row, a tree for each language, a root over the trees.

A leaf is the SHA-256 of the row's fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and
its value.  The leaves of a language ascend by ``doc_id``; every two consecutive nodes become the
hash of their hex digests, a last one alone the hash of itself, until one node is left.  The roots
of the languages, ordered by language (null first, then bytewise), are reduced likewise.

*Bitmap-rank index.*  No row is sorted to find its place.  Each language's ids are merged into a
compressed bitmap: one row for each 64-bit word that is not empty, ``bit_or`` of its bits, combined
map-side before the exchange.  Popcount directories over runs of 2**20 words, and over runs of 2**20
of those, hold how many leaves stand before each word; they are windows of at most 2**20 entries.
The coordinate of a leaf is the word's count plus the set bits below its own.

*Keyed slot arrays.*  Leaves meet in arrays keyed by ``(language, slot >> 10)``, each entry at its
slot; one array is 10 levels of the tree, so that 2**30 leaves take three rounds.  The way back
hands each array the siblings above it, and each leaf's proof is made where its array is.

Cases: ids that occur more than once in a language stand in the order of their leaf digests (rows
alike in all fields have equal leaves, so their order does not show); only the words that hold such
ids are ranked by a range partition, of which any one id can fill several parts.  Null ids come first in
their language, likewise by digest.  Null and empty fields differ in the leaf (``-`` and ``0:``).
Texts of any length are hashed whole.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import importable, materialize, ranked, small

LEVELS = 10  # levels of one slot array
BLOCK = 1 << LEVELS
RUN = 20  # words of a directory entry, as a power of two
NO_ID = -(1 << 57) - 1  # the word of null ids, below those of all ids


class Manifest(NamedTuple):
    #: doc_id, leaf, tampered, g, slot: one row for each leaf
    leaves: DataFrame
    #: one table of slot arrays for each round, leaves first: g, block, n, members
    rounds: list[DataFrame]
    #: lang, g, n, rank, n_groups, subroot, path: the siblings from the subroot to the root
    groups: DataFrame
    #: null if there is no row
    root: str | None


def _h(*digests: bytes) -> bytes:
    return hashlib.sha256(b"".join(digests)).hexdigest().encode()


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, g, leaf, tampered``; ``g`` is the language as a key that is never null and sorts like it."""
    c = {name: F.col(f"`{name}`") for name in ("doc_id", "source", "lang", "n_chars", "text")}
    digest = lambda n_chars: F.unhex(F.sha2(F.concat(
        *[_field(x) for x in (c["doc_id"], c["source"], c["lang"], n_chars, c["text"])]), 256))
    picked = F.crc32(c["doc_id"].cast("string").cast("binary")) % 7 == 0
    return docs.select(
        c["doc_id"].cast("long").alias("doc_id"), c["lang"].alias("lang"),
        F.when(c["lang"].isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), c["lang"])).alias("g"),
        digest(c["n_chars"]).alias("leaf"),
        F.when(picked, digest(c["n_chars"].cast("decimal(20,0)") + 1)).alias("tampered"))


def directory(leaves: DataFrame) -> DataFrame:
    """Per language and occupied word: its bits, its rows, and the rows before it."""
    bits = F.when(F.col("doc_id").isNull(), F.lit(1).cast("long")).otherwise(F.expr("shiftleft(1L, cast(doc_id & 63 as int))"))
    words = materialize(
        leaves.select("g", word_of("doc_id").alias("word"), bits.alias("bits")).groupBy("g", "word").agg(
            F.bit_or("bits").alias("bits"), F.count("*").alias("rows")), "bitmap")
    up = lambda c: F.shiftright(c, RUN)
    runs = words.groupBy("g", up("word").alias("run")).agg(F.sum("rows").alias("rows"))
    tops = runs.groupBy("g", up("run").alias("top")).agg(F.sum("rows").alias("rows"))

    def before(*keys: str, by: str) -> Column:
        w = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("rows").over(w), F.lit(0).cast("long"))

    tops = tops.select("g", "top", before("g", by="top").alias("top_before"))
    runs = runs.withColumn("top", up("run")).withColumn("in_top", before("g", "top", by="run")).join(tops, ["g", "top"])
    runs = materialize(runs.select("g", "run", (F.col("top_before") + F.col("in_top")).alias("run_before")), "runs")
    words = words.withColumn("run", up("word")).withColumn("in_run", before("g", "run", by="word"))
    return words.join(small(runs), ["g", "run"]).select(
        "g", "word", "bits", "rows", (F.col("run_before") + F.col("in_run")).alias("before"))


def word_of(column: str) -> Column:
    return F.coalesce(F.shiftright(F.col(column), 6), F.lit(NO_ID))


def coordinates(leaves: DataFrame) -> DataFrame:
    """``leaves`` (a written table) and the ``slot`` of each in its language, by rank queries."""
    words = materialize(directory(leaves), "directory")
    crowded = "rows > bit_count(bits)"
    plain = leaves.withColumn("word", word_of("doc_id")).join(words, ["g", "word"])
    below = F.expr("bit_count(bits & ~shiftleft(-1L, cast(doc_id & 63 as int)))")
    columns = [F.col(c) for c in leaves.columns]
    alone = plain.where(f"not ({crowded})").select(
        *columns, (F.col("before") + F.when(F.col("doc_id").isNull(), 0).otherwise(below)).alias("slot"))
    many = words.where(crowded)
    if many.isEmpty():
        return alone
    many = small(many.select("g", "word", "before"))
    rows = leaves.withColumn("word", word_of("doc_id")).join(many, ["g", "word"])
    rows = materialize(ranked(rows, "g", "word", "doc_id", "leaf"), "crowded")
    first = materialize(rows.groupBy("g", "word").agg(F.min("rank").alias("first")), "crowded-first")
    return alone.unionByName(rows.join(small(first), ["g", "word"]).select(
        *columns, (F.col("before") + F.col("rank") - F.col("first")).alias("slot")))


def height(n: int) -> int:
    return (n - 1).bit_length()


def levels(nodes: list[bytes], total: int) -> list[list[bytes]]:
    """The array's nodes, and those of each level above them; ``total`` nodes stand at its lowest level in all."""
    out = [nodes]
    for _ in range(min(LEVELS, height(total))):
        below = out[-1]
        out.append([_h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return out


def siblings(tree: list[list[bytes]], i: int) -> list[bytes]:
    """The other node of each run on the way up from the ``i``-th."""
    out = []
    for nodes in tree[:-1]:
        if (i ^ 1) < len(nodes):
            out.append(nodes[i ^ 1])
        i >>= 1
    return out


def _hex(x) -> bytes:
    return bytes(x).hex().encode()


def slot_arrays(nodes: DataFrame) -> DataFrame:
    """``g, slot, n`` and further columns -> ``g, block, n, members`` (at most 2**10, in order of their slots)."""
    rest = [c for c in nodes.columns if c not in ("g", "n")]
    return nodes.groupBy("g", F.shiftright("slot", LEVELS).alias("block")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct(*rest))).alias("members"))


def _node_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        g, slot, n, node = [], [], [], []
        for row in batch.to_pylist():
            g.append(row["g"])
            slot.append(row["block"])
            n.append(-(-row["n"] // BLOCK))
            node.append(bytes.fromhex(levels([_hex(x) for x in row["nodes"]], row["n"])[-1][0].decode()))
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(slot, pa.int64()), pa.array(n, pa.int64()),
                                          pa.array(node, pa.binary())], ["g", "slot", "n", "node"])


def climb(nodes: DataFrame, key: str, most: int) -> list[DataFrame]:
    """Slot arrays of each round, of which the last holds one array for each group; ``most``: the largest ``n``."""
    rounds = []
    while True:
        rounds.append(materialize(slot_arrays(nodes), "slots"))
        if most <= BLOCK:
            return rounds
        most = -(-most // BLOCK)
        nodes, key = _above(rounds[-1], key), "node"


def _above(arrays: DataFrame, key: str) -> DataFrame:
    return arrays.select("g", "block", "n", F.col(f"members.{key}").alias("nodes")).mapInArrow(
        _node_batches, "g string, slot long, n long, node binary")


def _path_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        g, slot, path = [], [], []
        for row in batch.to_pylist():
            tree, above = levels([_hex(x) for x in row["nodes"]], row["n"]), [bytes(x) for x in row["path"]]
            for i, s in enumerate(row["slots"]):
                g.append(row["g"])
                slot.append(s)
                path.append([bytes.fromhex(x.decode()) for x in siblings(tree, i)] + above)
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(slot, pa.int64()), pa.array(path, pa.list_(pa.binary()))],
                                         ["g", "block", "path"])


def descend(rounds: list[DataFrame], above: DataFrame, lowest: int = 1) -> DataFrame:
    """``g, block, path``: the siblings above each slot array of round ``lowest - 1``, from ``g, path`` of the groups."""
    path = above.select("g", F.lit(0).cast("long").alias("block"), "path")
    for arrays in reversed(rounds[lowest:]):
        step = arrays.select("g", "block", "n", F.col("members.node").alias("nodes"), F.col("members.slot").alias("slots"))
        path = materialize(step.join(path, ["g", "block"]).mapInArrow(_path_batches, "g string, block long, path array<binary>"), "paths")
    return path


def build(docs: DataFrame) -> Manifest:
    """Leaves, slot arrays and roots, all but the last as tables."""
    importable(docs.sparkSession)
    hashed = materialize(leaf_digests(docs), "leaves")
    leaves = coordinates(hashed)
    sizes = materialize(hashed.groupBy("g", "lang").agg(F.count("*").alias("n")), "sizes")
    most = sizes.agg(F.max("n")).first()[0]
    nodes = leaves.drop("lang").join(small(sizes.select("g", "n")), "g").select("g", "slot", "leaf", "tampered", "doc_id", "n")
    rounds = climb(nodes, "leaf", most or 0)
    n = sizes.count()
    langs = ranked(sizes.join(_above(rounds[-1], "leaf" if len(rounds) == 1 else "node").select("g", "node"), "g"), "g")
    langs = materialize(langs.withColumn("n_groups", F.lit(n).cast("long")), "subroots")
    tops = climb(langs.select(F.lit("").alias("g"), F.col("rank").alias("slot"), F.col("n_groups").alias("n"), "node"), "node", n)
    root = _above(tops[-1], "node").first()
    ends = langs.sparkSession.range(1).select(F.lit("").alias("g"), F.array().cast("array<binary>").alias("path"))
    path = descend(tops, ends, lowest=0).select(F.col("block").alias("rank"), "path")
    groups = langs.join(path, "rank").select("lang", "g", "n", "rank", "n_groups", F.lower(F.hex("node")).alias("subroot"), "path")
    return Manifest(leaves, rounds, materialize(groups, "groups"), bytes(root["node"]).hex() if root else None)


_PROVED = ("doc_id long, lang string, slot long, leaf string, subroot string, root string, proof_sha256 string, "
           "folded_root string, verified boolean")


def _proofs(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _PROVED.split(", ")]
        types = [pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 5, pa.bool_()]
        for batch in batches:
            for row in batch.to_pylist():  # one slot array
                tree = levels([_hex(m["leaf"]) for m in row["members"]], row["n"])
                above = [_hex(x) for x in row["path"]]
                out = []
                for i, m in enumerate(row["members"]):
                    proof = siblings(tree, i) + above
                    node = tree[0][i] if m["tampered"] is None else _hex(m["tampered"])
                    folded = fold(node, m["slot"], row["n"], row["rank"], row["n_groups"], proof).decode()
                    out.append((m["doc_id"], row["lang"], m["slot"], tree[0][i].decode(), row["subroot"], root,
                                _h(*proof).decode(), folded, folded == root))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names)

    return run


def fold(node: bytes, slot: int, n: int, rank: int, n_groups: int, proof: list[bytes]) -> bytes:
    """The root that follows from a leaf at ``slot`` of ``n``, in the group at ``rank`` of ``n_groups``, and its siblings."""
    proof = iter(proof)
    for at, total in ((slot, n), (rank, n_groups)):
        while total > 1:
            if at & 1:
                node = _h(next(proof), node)
            elif at + 1 < total:
                node = _h(node, next(proof))
            else:
                node = _h(node)
            at, total = at >> 1, (total + 1) >> 1
    return node


def prove(made: Manifest) -> DataFrame:
    """For each row: its leaf, the digest of its proof, and the root that its (tampered) leaf folds to.

    Rows whose id has a CRC-32 divisible by 7 are tampered with: 1 is added to ``n_chars`` (null stays
    null), and the leaf is folded with the siblings of the original.
    """
    spark = made.groups.sparkSession
    if made.root is None:
        return spark.createDataFrame([], _PROVED)
    path = descend(made.rounds, made.groups.select("g", "path"))
    arrays = made.rounds[0].join(path, ["g", "block"]).join(small(made.groups.drop("n", "path")), "g")
    return arrays.select("lang", "n", "members", "path", "subroot", "rank", "n_groups").mapInArrow(_proofs(made.root), _PROVED)


def manifest(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: its place, leaf, proof and roots."""
    return prove(build(docs))
