"""Histogram sort into shards of near equal bytes, with DataFrame functions only.

Documents are ordered by a 62-bit hash of the text and then of the id, so that
equal texts stand together.  The splitters between shards are found as
in histogram sort: each round counts the exact bytes in the cells between
candidate boundaries over all partitions, keeps for each splitter the one cell
that holds its target, and cuts that cell anew, until a boundary lies within
the tolerance of the target.  Then every row learns its shard and is moved once.

If the cell of a splitter has come down to a single text hash (copies of one text
that are heavier than the tolerance), the search goes on over the id hashes in it;
rows that agree in both are told apart no further.

Slots are gapless from 0 in each shard and follow (text hash, id hash, id), at every size
and as ``write_shards`` writes: the keys are dealt by range into sorted parts (copies of one
text span as many as they need), and a row's rank is that of its part's first row plus its place there.

Edge cases: a null text has no bytes (size 1, checksum 0).  Null and repeated ids are
rows like others.  Fewer rows than shards leave shards empty; an empty table
gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import materialize, pick, ranked, unique

SHARDS = 16
CUTS = 64  # cells a bracket is cut into in each round
TOLERANCE = 0.002  # of a shard's bytes
TOP = 1 << 62  # keys are hashes of 62 bits


def _search(rows: DataFrame, key: str, targets: list[int], below: list[int], lows: list[int], highs: list[int],
            tolerance: int, where: list[Column], nearest: bool) -> list[tuple[int, int]]:
    """For each target a boundary b, and the bytes with ``key < b``; rows outside ``where[i]`` don't count.

    ``below[i]`` are the bytes below ``lows[i]``.  A boundary that cannot meet the tolerance is
    the key value that crosses the target, or with ``nearest`` the nearer of its two sides.
    """
    n = len(targets)
    found: list[tuple[int, int] | None] = [None] * n
    lows, highs, below = list(lows), list(highs), list(below)
    while any(f is None for f in found):
        # splitters that share a bracket share its cells
        brackets = sorted({(lows[i], highs[i], str(where[i])) for i in range(n) if found[i] is None})
        index = {b: k for k, b in enumerate(brackets)}
        cell, which = F.lit(None).cast("long"), F.lit(None).cast("int")
        for b, k in index.items():
            i = next(i for i in range(n) if found[i] is None and (lows[i], highs[i], str(where[i])) == b)
            step = max(1, -(-(b[1] - b[0]) // CUTS))
            inside = where[i] & (F.col(key) >= b[0]) & (F.col(key) < b[1])
            which = F.when(inside, F.lit(k)).otherwise(which)
            cell = F.when(inside, F.floor((F.col(key) - F.lit(b[0])) / F.lit(step)) if step < (1 << 40)
                          else F.expr(f"({key} - {b[0]}L) div {step}L")).otherwise(cell)
        counted = (rows.select(which.alias("which"), cell.cast("long").alias("cell"), "size").where("which is not null")
                   .groupBy("which", "cell").agg(F.sum("size").alias("bytes")).collect())  # at most CUTS cells a splitter
        cells = {(r["which"], r["cell"]): r["bytes"] for r in counted}
        for i in range(n):
            if found[i] is not None:
                continue
            lo, hi = lows[i], highs[i]
            k, step = index[lo, hi, str(where[i])], max(1, -(-(hi - lo) // CUTS))
            at, c = below[i], 0
            while c < CUTS - 1 and lo + (c + 1) * step < hi and at + cells.get((k, c), 0) <= targets[i]:
                at += cells.get((k, c), 0)
                c += 1
            b, after = lo + c * step, at + cells.get((k, c), 0)
            if abs(targets[i] - at) <= tolerance:
                found[i] = (b, at)
            elif abs(after - targets[i]) <= tolerance:
                found[i] = (min(b + step, hi), after)
            elif step == 1:
                found[i] = (b + 1, after) if nearest and after - targets[i] < targets[i] - at else (b, at)
            else:
                lows[i], highs[i], below[i] = b, min(b + step, hi), at
    return found


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """Boundaries ``(text hash, id hash)``: a row is in the shard of how many it is not below."""
    total = rows.agg(F.sum("size")).first()[0]
    if not total:
        return []
    slack = int(total / shards * tolerance)
    n = shards - 1
    targets = [total * (i + 1) // shards for i in range(n)]
    every = F.lit(True)
    first = _search(rows, "k1", targets, [0] * n, [0] * n, [TOP] * n, slack, [every] * n, False)
    out: list[tuple[int, int]] = [(b, 0) for b, _ in first]
    heavy = [i for i in range(n) if abs(first[i][1] - targets[i]) > slack]
    if heavy:
        inner = _search(rows, "k2", [targets[i] for i in heavy], [first[i][1] for i in heavy], [0] * len(heavy),
                        [TOP] * len(heavy), slack, [F.col("k1") == first[i][0] for i in heavy], True)
        for i, (b, _) in zip(heavy, inner):
            out[i] = (first[i][0], b)
    return sorted(out)


def _keys(text: Column, doc_id: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(F.xxhash64(text), 2), F.shiftrightunsigned(F.xxhash64(doc_id, F.lit("id")), 2)


def _place(cuts: list[tuple[int, int]], k1: Column, k2: Column) -> Column:
    place = F.lit(0)
    for i, (a, b) in enumerate(cuts):
        place = F.when((k1 > a) | ((k1 == a) & (k2 >= b)), F.lit(i + 1)).otherwise(place)
    return place.cast("int")


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS,
                 files: int = 1) -> None:
    """Write the documents, all columns (one named ``shard`` is replaced), as ``shard=0/ ..`` folders of ``files`` files, in key order.

    The splitters come from the keys alone; the documents are exchanged once.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    k1, k2 = _keys(text, F.col(f"`{id_col}`"))
    keys = materialize(docs.select((F.octet_length(text) + 1).cast("long").alias("size"), k1.alias("k1"), k2.alias("k2")), "keys")
    of, a, b = "shard", unique("k1"), unique("k2")
    placed = docs.withColumn(of, _place(splitters(keys, shards), k1, k2)).withColumn(a, k1).withColumn(b, k2)
    (placed.repartition(shards * files, of, F.pmod(F.col(a), F.lit(files))).sortWithinPartitions(of, a, b, f"`{id_col}`").drop(a, b)
     .write.partitionBy(of).parquet(path))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row for each document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    text = F.coalesce("text", F.lit(""))
    k1, k2 = _keys(text, F.col("doc_id"))
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), k1.alias("k1"), k2.alias("k2"))
    rows = materialize(rows, "keys")
    cuts = splitters(rows, shards)
    placed = rows.withColumn("shard", _place(cuts, F.col("k1"), F.col("k2")))
    # the shard grows with the keys, so the rank over all rows less that of the shard's first row is the slot
    numbered = materialize(ranked(placed, "k1", "k2", "doc_id"), "ranked-keys")
    starts = numbered.groupBy("shard").agg(F.min("rank").alias("start"))
    return numbered.join(F.broadcast(starts), "shard").select(  # a row for each shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("rank") - F.col("start")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
