"""Mixing sources to target weights by fixed-length blocks of tokens.

A token is a word ``[^\\x20\\x09-\\x0D]+``.  The documents of a source are laid end to end
and cut into blocks of ``BLOCK`` tokens, the last one shorter.  A source's target
makes a number of slots; these are dealt to the output shards with multinomial
counts (``Generator.multinomial`` seeded by source), so that the totals meet the targets.
The j-th slot of a source takes block ``perm(j mod n)`` of the ``n`` blocks, where ``perm`` is
a pseudorandom permutation of the indices of that source and of the pass ``j div n``
(a Feistel network, walked until the index is in range).  Slots and the pieces of
documents are joined by source and block index, so a hot source is spread over its blocks.

Targets: sources stand in the order of code points, null last, with the ``weights``
repeating; they share ``share`` times all tokens.  A target stops at ``most`` times
the source's tokens, the excess goes to the others by weight until none is above.
No block is taken more than ``most`` times, so no document is either.

Positions in a source follow (bucket of the id's hash, id, text hash); running sums are made
inside buckets and over the few bucket totals, never over a whole source at once.

Edge cases: null or empty text has size 0 and is never taken.  Null sources are one
source of their own.  Repeated rows are rows like others.  With no tokens at all every
target is 0.  Other columns are not read.  Reruns agree: nothing depends on partitioning.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import materialize, pick

BLOCK = 64
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
ROWS_PER_BUCKET = 5_000
SLOTS_PER_SHARD = 16_384
SLOTS_PER_TASK = 400_000
SEED = 7


def targets_for(sizes: list[int], weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Targets of sources with these sizes, in order; the excess over ``most`` is shared anew."""
    total = share * sum(sizes)
    weight = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    held: dict[int, float] = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in held]
        left, whole = total - sum(held.values()), sum(weight[i] for i in free)
        over = {i: float(most * sizes[i]) for i in free if left * weight[i] / whole > most * sizes[i]}
        if not over:
            got = {i: left * weight[i] / whole for i in free} | held
            return [got[i] for i in range(len(sizes))]
        held |= over
        if len(held) == len(sizes):
            return [held[i] for i in range(len(sizes))]


def permute(index: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A pseudorandom permutation of ``0 .. n - 1`` at ``index``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for r in range(6):
            f = (right + np.uint64((seed * 6 + r) & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(32)
            left, right = right, left ^ (f & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def slots(plan: DataFrame, seed: int = SEED, tasks: int = 1) -> DataFrame:
    """``s, shard, slot, pass, block``: the block that each slot of each source takes.

    ``plan`` has ``s`` (a source's number), ``blocks``, ``slots`` and ``shards``.
    """

    def counts(batches):
        for batch in batches:
            rows = batch.to_pylist()
            s, shard, lo, n, blocks = [], [], [], [], []
            for r in rows:
                drawn = np.random.default_rng([seed, r["s"]]).multinomial(r["slots"], np.full(r["shards"], 1 / r["shards"]))
                at = np.concatenate([[0], np.cumsum(drawn)[:-1]])
                some = np.flatnonzero(drawn)
                s += [r["s"]] * len(some)
                shard += some.tolist()
                lo += at[some].tolist()
                n += drawn[some].tolist()
                blocks += [r["blocks"]] * len(some)
            yield pa.RecordBatch.from_pydict({"s": s, "shard": shard, "lo": lo, "n": n, "blocks": blocks},
                                             schema=pa.schema([(c, pa.int64()) for c in ("s", "shard", "lo", "n", "blocks")]))

    def draw(batches):
        for batch in batches:
            for r in batch.to_pylist():
                j = np.arange(r["lo"], r["lo"] + r["n"])
                turn = j // r["blocks"]
                block = np.empty(len(j), np.int64)
                for t in np.unique(turn).tolist():
                    own = turn == t
                    block[own] = permute(j[own] % r["blocks"], r["blocks"], zlib.crc32(f"{seed}/{r['s']}/{t}".encode()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(j), r["s"])), pa.array(np.full(len(j), r["shard"])),
                     pa.array(np.arange(len(j))), pa.array(turn), pa.array(block)],
                    names=["s", "shard", "slot", "turn", "block"])

    per_shard = plan.mapInArrow(counts, "s long, shard long, lo long, n long, blocks long")
    # dealt by what the rows become, some 16 thousand slots each, not by their own few bytes
    return (per_shard.repartition(tasks, "s", "shard")
            .mapInArrow(draw, "s long, shard long, slot long, turn long, block long"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block: int = BLOCK, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The documents with what is taken of each, and the mixed blocks.

    Returns ``documents`` (``doc_id, text_hash, source, size, source_size, target, taken``) and
    ``blocks`` (``source, shard, slot, turn, block, doc_id, first, n``: which tokens of which documents
    fill a slot; pieces of a slot are ordered by ``place``).
    """
    spark = docs.sparkSession
    words = F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+")  # empty at an end that is a separator
    size = (F.size(words) - (F.element_at(words, 1) == "").cast("int")
            - ((F.size(words) > 1) & (F.element_at(words, -1) == "")).cast("int"))
    rows = materialize(pick(docs, doc_id=id_col, text=text_col, source=source_col).select(
        "doc_id", "source", F.xxhash64("text").alias("text_hash"), size.cast("long").alias("size")), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")).collect()
    sources.sort(key=lambda r: (r["source"] is None, r["source"] or ""))  # one row for each source
    goal = targets_for([r["source_size"] for r in sources]) if sources else []
    total_slots = 0
    table = []
    for i, r in enumerate(sources):
        n = -(-r["source_size"] // block)
        k = min(round(goal[i] * n / r["source_size"]), MOST * n) if n else 0
        total_slots += k
        table.append([i, r["source"], r["source_size"], goal[i], n, k])
    shards = max(1, total_slots // SLOTS_PER_SHARD)
    kind = rows.schema["source"].dataType.simpleString()
    plan = spark.createDataFrame([(*t, shards) for t in table],
                                 f"s long, source {kind}, source_size long, target double, blocks long, slots long, shards long")
    plan = F.broadcast(plan)  # a few numbers for each source, made on the driver above

    buckets = max(1, sum(r["rows"] for r in sources) // ROWS_PER_BUCKET)
    placed = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets)))
    order = Window.partitionBy("s", "bucket").orderBy("doc_id", "text_hash", "size")
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("s", "bucket").agg(F.sum("size").alias("total")).select(
        "s", "bucket", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = placed.withColumn("at", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = placed.join(bases, ["s", "bucket"]).withColumn("start", F.col("base") + F.col("at"))
    placed = materialize(placed.select("doc_id", "text_hash", "source", "size", "s", "source_size", "target", "start"), "placed")

    lo = F.col("block") * block
    pieces = placed.where("size > 0").select("s", "source", "doc_id", "text_hash", "start", "size", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    pieces = pieces.withColumn("first", F.greatest(F.lit(0), lo - F.col("start"))).withColumn(
        "n", F.least(F.col("size"), lo + block - F.col("start")) - F.col("first"))
    wanted = slots(plan.select("s", "blocks", "slots", "shards").where("slots > 0"), seed,
                   max(1, total_slots // SLOTS_PER_TASK))
    filled = pieces.join(wanted.hint("merge"), ["s", "block"])  # as many rows as the mix has blocks: never broadcast
    blocks = filled.select("source", "shard", "slot", "turn", "block", (F.col("start") + F.col("first")).alias("place"),
                           "doc_id", "text_hash", "first", "n")

    # by where a document begins in its source; documents without tokens share a place and take nothing
    taken = filled.groupBy("s", "start").agg(F.sum("n").alias("taken")).withColumn("some", F.lit(True))
    out = placed.withColumn("some", F.col("size") > 0).join(taken, ["s", "start", "some"], "left")
    return out.select("doc_id", "text_hash", "source", "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken")), blocks


def block_texts(blocks: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mixed corpus itself: ``source, shard, slot, turn, block, text`` of the ``blocks`` of ``mix``.

    A block's pieces are joined to their documents and put together in order; a block
    has at most ``BLOCK`` pieces.
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    texts = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"), words.alias("words")).dropDuplicates(["d", "h"])
    pieces = blocks.join(texts, blocks["doc_id"].eqNullSafe(texts["d"]) & (blocks["text_hash"] == texts["h"])).select(
        "source", "shard", "slot", "turn", "block", "place",
        F.array_join(F.slice("words", (F.col("first") + 1).cast("int"), F.col("n").cast("int")), " ").alias("piece"))
    parts = F.array_sort(F.collect_list(F.struct("place", "piece")))
    return pieces.groupBy("source", "shard", "slot", "turn", "block").agg(
        F.array_join(F.transform(parts, lambda x: x["piece"]), " ").alias("text"))
