"""Exact substring dedup: maximal repeats by a stack scan over an enhanced suffix array.

Texts are taken as UTF-8 bytes.  A byte is removed if it is covered by a string of
``LENGTH`` bytes that also starts anywhere else in the corpus, the same text included.

*Sampled suffixes.*  Suffixes start at anchors: in each run of ``LENGTH`` bytes the place whose
``GRAM`` bytes have the least hash (the leftmost, if several).  Equal runs have the same anchor, so each
repeat of at least ``LENGTH`` bytes has suffixes that start inside it, at the same places.
Anchors whose ``GRAM`` bytes occur once are dropped; anchors that agree in all ``LENGTH`` bytes after and
``LEFT`` bytes before them are one *context* with a count, so copies cost one row.

*Common-prefix interval tree.*  The contexts of one gram are sorted by what follows the anchor, with the
lengths of the common prefixes of neighbours.  A stack scan yields every interval
of the tree, bottom up.  In each interval the members are ordered by what
precedes the anchor (read backwards), and a second scan yields the groups that
agree to the left as well; a group is a maximal repeat if its members are
diverse on both sides.  All occurrences are put out, not only neighbours.

*Hot grams.*  A gram with more than ``CROWD`` contexts is not gathered in one task: for each context
the run of ``LENGTH`` bytes at each offset around the anchor is looked for elsewhere by
counting hashes, first at every ``GRID``-th offset, then only at the offsets that can still widen the span
and whose common part is shared.  Both ways give the same spans.

Grams, contexts and texts are told apart by polynomial and xx hashes of 64 bits (a context by its gram's
and its own, a text by two).

Edge cases: null and empty texts, and texts shorter than ``LENGTH``, lose nothing.
Equal texts repeat each other, so rows that repeat an id do too.  Empty tables give
empty results.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm import text as tx
from tideline.llm.common import materialize, merged_spans, partitions, pick, small

LENGTH = 400
GRAM = 100
LEFT = LENGTH - GRAM
GRID = 20
CROWD = 20_000  # contexts of one gram gathered in a task: 14 MB of bytes
CHUNK = 1 << 18  # bytes of one text looked at at a time
ROWS = 256  # contexts whose runs are hashed at a time
LIGHT = 500_000  # rows of a few numbers that one task writes
HEAVY = 2_000  # contexts that one task cuts or hashes
PLACE = np.uint64((1 << 32) - 1)


def written(df: DataFrame, name: str, rows: int, each: int = LIGHT) -> DataFrame:
    """``df`` written in no more files than one for ``each`` of some ``rows``: a session with many partitions
    would deal a small table over as many tiny files, and each costs its writer several calls of the file system."""
    return materialize(df.coalesce(1 + rows // each), name)


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p, inverse = tx.powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[: len(data)], out=total[1:])
    return total, inverse


def _hash(total, inverse, begin, end) -> np.ndarray:
    return tx.mix((total[end] - total[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    n = len(values) - width + 1
    pad = -len(values) % width
    blocks = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def _anchors(data: np.ndarray, offsets: np.ndarray, first: int = 0, last: int | None = None):
    """Anchors of the runs that start at ``first`` to ``last - 1``: text, place, gram and context hash, reach to both sides."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none, none, none
    total, inverse = _sums(data)
    at = np.arange(n - GRAM + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))  # of the text of each byte
    grams = _hash(total, inverse, at, at + GRAM)
    order = (grams & ~PLACE) | at.astype(np.uint64)  # the least hash, then the leftmost
    best = _least(order, LENGTH - GRAM + 1) & PLACE
    runs = np.arange(len(best))
    runs = runs[(runs + LENGTH <= ends[: len(best)]) & (runs >= first) & (runs < (n if last is None else last))]
    place = best[runs].astype(np.int64)
    place = np.unique(place[np.concatenate([[True], place[1:] != place[:-1]])]) if len(place) else none
    own = np.searchsorted(offsets, place, side="right") - 1
    left = np.minimum(place - offsets[own], LEFT)
    right = np.minimum(offsets[own + 1] - place, LENGTH)
    context = _hash(total, inverse, place - left, place + right) ^ (left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return own, place - offsets[own], grams[place].view(np.int64), context.view(np.int64), left, right


def anchors(data: np.ndarray, offsets: np.ndarray):
    """``_anchors`` of several texts; a very long one is looked at in overlapping chunks."""
    if len(offsets) != 2 or len(data) <= 4 * CHUNK:
        return _anchors(data, offsets)
    got = []
    for lo in range(0, len(data) - LENGTH + 1, CHUNK):
        a, b = max(0, lo - LEFT), min(len(data), lo + CHUNK + LEFT + 2 * LENGTH)
        own, place, *rest = _anchors(data[a:b], np.array([0, b - a]), lo - a, lo + CHUNK - a)
        got.append((own, place + a, *rest))
    out = [np.concatenate(x) for x in zip(*got)]
    _, once = np.unique(out[1], return_index=True)
    return tuple(x[once] for x in out)


def sampled(texts: DataFrame) -> DataFrame:
    """``t1, t2, place, gram, context, reach_left, reach_right, copies`` of every anchor."""

    def find(batches):
        for batch in batches:
            for first, _, data, offsets in tx.slices(batch.column(0), CHUNK):
                own, place, gram, context, left, right = anchors(data, offsets)
                rows = pa.array(own + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).take(rows), batch.column(2).take(rows), pa.array(place.astype(np.int32)),
                     pa.array(gram), pa.array(context), pa.array(left.astype(np.int16)), pa.array(right.astype(np.int16)),
                     batch.column(3).take(rows)],
                    names=["t1", "t2", "place", "gram", "context", "reach_left", "reach_right", "copies"])

    return texts.select("text", "t1", "t2", "copies").mapInArrow(
        find, "t1 long, t2 long, place int, gram long, context long, reach_left short, reach_right short, copies long")


def intervals(lcp: list[int], least: int = 0) -> Iterator[tuple[int, int, int]]:
    """Stack scan: every interval ``(length, first, last)`` of the tree of common prefixes.

    ``lcp[i]`` is the common length of the sorted neighbours i - 1 and i; ``lcp[0]`` is not read.
    """
    stack: list[tuple[int, int]] = []  # length, first
    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else -1
        first = i - 1
        while stack and stack[-1][0] > now:
            length, first = stack.pop()
            if length >= least:
                yield length, first, i - 1
        if now >= 0 and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def _sorted(parts: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of the strings, and the common prefix of each with the one before."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    lcp = [0]
    for a, b in zip(order, order[1:]):
        lcp.append(common(parts[a], parts[b]))
    return order, lcp


def common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] == b[:lo], a[:hi] != b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def maximal_repeats(before: list[bytes], after: list[bytes], counts: list[int], length: int = LENGTH):
    """Maximal repeats of at least ``length`` bytes around the anchors of one gram.

    ``before`` is read backwards.  Yields ``(left, right, members)``: the members agree on ``left`` bytes
    before and ``right`` bytes from the anchor on, and on no more to either side (as far as is known).
    A context with a count is a repeat by itself.
    """
    for i, n in enumerate(counts):
        if n > 1 and len(before[i]) + len(after[i]) >= length:
            yield len(before[i]), len(after[i]), [i]
    if len(after) < 2:
        return
    order, lcp = _sorted(after)
    left_order, left_lcp = _sorted(before)
    rank = {x: r for r, x in enumerate(left_order)}
    whole = len(order)
    place = {x: r for r, x in enumerate(order)}
    for right, first, last in intervals(lcp):
        need = length - right
        if need > LEFT:
            continue
        if last - first + 1 == whole:
            members, adjacent = left_order, left_lcp
        else:
            members = sorted(order[first : last + 1], key=rank.__getitem__)
            adjacent = [0] + [common(before[a], before[b]) for a, b in zip(members, members[1:])]
        for left, lo, hi in intervals(adjacent, max(need, 0)):
            group = members[lo : hi + 1]
            at = sorted(place[x] for x in group)
            if min(lcp[at[0] + 1 : at[-1] + 1]) == right:  # diverse to the right: not all in one child
                yield left, right, group


def reaches(before: list[bytes], after: list[bytes], counts: list[int]) -> tuple[list[int], list[int]]:
    """How far each context is covered to the left and to the right of its anchor; -1 if not at all."""
    n = len(counts)
    if n == 2:
        left, right = common(before[0], before[1]), common(after[0], after[1])
        pair = left + right >= LENGTH
        out = [(len(before[i]), len(after[i])) if counts[i] > 1 else (left, right) if pair else (-1, -1) for i in (0, 1)]
        return [x for x, _ in out], [x for _, x in out]
    lo, hi = [-1] * n, [-1] * n
    for left, right, members in maximal_repeats(before, after, counts):
        for x in members:
            if left > lo[x]:
                lo[x] = left
            if right > hi[x]:
                hi[x] = right
    return lo, hi


def context_bytes(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``gram, context, n, crowd, before, after``: the bytes of the ``wanted`` contexts, cut from one text each."""
    lists = wanted.groupBy("t1").agg(F.collect_list(F.struct("gram", "context", "n", "crowd")).alias("wanted"))  # of one text each
    rows = texts.select("t1", "text").join(lists, "t1")
    return rows.select("text", "wanted").mapInArrow(
        _cut_contexts, "gram long, context long, n long, crowd long, before binary, after binary")


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted contexts of texts, those of some ``CHUNK`` bytes of text at a time: their bytes are several times the texts."""
    for batch in batches:
        for first, last, data, offsets in tx.slices(batch.column(0), CHUNK):
            out = {k: [] for k in ("gram", "context", "n", "crowd", "before", "after")}
            own, place, gram, context, left, right = anchors(data, offsets)
            asked = {(i, w["gram"], w["context"]): w for i in range(last - first) for w in batch.column(1)[first + i].as_py()}
            for i, p, g, c, x, y in zip(own.tolist(), place.tolist(), gram.tolist(), context.tolist(), left.tolist(), right.tolist()):
                w = asked.pop((i, g, c), None)
                if w:
                    at = int(offsets[i]) + p
                    out["gram"].append(g)
                    out["context"].append(c)
                    out["n"].append(w["n"])
                    out["crowd"].append(w["crowd"])
                    out["before"].append(data[at - x : at][::-1].tobytes())
                    out["after"].append(data[at : at + y].tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("gram", pa.int64()), ("context", pa.int64()), ("n", pa.int64()), ("crowd", pa.int64()),
                 ("before", pa.binary()), ("after", pa.binary())]))


def scan_groups(contexts: DataFrame) -> DataFrame:
    """``gram, context, lo, hi`` of the covered contexts, gram by gram."""

    def run(batches):
        def close(rows):
            rows = list({r[0]: r for r in rows}.values())
            lo, hi = reaches([r[2] for r in rows], [r[3] for r in rows], [r[1] for r in rows])
            return [(gram, r[0], a, b) for r, a, b in zip(rows, lo, hi) if a >= 0]

        gram, rows, out = None, [], []
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for g, *row in zip(*cols):
                if g != gram:
                    if rows:
                        out += close(rows)
                    gram, rows = g, []
                rows.append(row)
            yield table(out)
            out = []
        if rows:
            yield table(close(rows))

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
            (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["gram", "context", "lo", "hi"])

    return (contexts.select("gram", "context", "n", "before", "after")
            .repartition(partitions(contexts.sparkSession), "gram").sortWithinPartitions("gram")
            .mapInArrow(run, "gram long, context long, lo int, hi int"))


def run_keys(contexts: DataFrame, every: bool) -> DataFrame:
    """Hashes of runs around the anchors: ``gram, context, kind, d, key``.

    With ``every`` those at each ``GRID``-th offset (kind 0) and the common part of all runs between two
    of these (kind 1), else the runs at the offsets listed in ``todo`` (kind 0).
    """
    columns = ["gram", "context", "before", "after"] + ([] if every else ["todo"])
    return contexts.select(*columns).mapInArrow(_cut_runs, "gram long, context long, kind int, d int, key long")


def _cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The run hashes of contexts, ``ROWS`` of them at a time: one has some 300 runs at most."""
    for whole in batches:
        for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
            out = {k: [] for k in ("gram", "context", "kind", "d", "key")}
            for r in batch.to_pylist():
                text = r["before"][::-1] + r["after"]
                at = len(r["before"])
                if "todo" in r:
                    spans = [(0, d, at - d, at - d + LENGTH) for d in r["todo"]]
                else:
                    spans = [(0, d, at - d, at - d + LENGTH) for d in range(0, LEFT + 1, GRID)]
                    spans += [(1, d, at - d - 1, at - d - GRID + 1 + LENGTH) for d in range(0, LEFT, GRID)]
                for kind, d, a, b in spans:
                    if a >= 0 and b <= len(text):
                        h = hashlib.blake2b(text[a:b], digest_size=8, salt=f"{kind}/{d}".encode(),
                                            person=(r["gram"] & (1 << 64) - 1).to_bytes(8, "big")).digest()
                        for k, v in zip(out, (r["gram"], r["context"], kind, d, int.from_bytes(h, "big", signed=True))):
                            out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                [("gram", pa.int64()), ("context", pa.int64()), ("kind", pa.int32()), ("d", pa.int32()), ("key", pa.int64())]))


def _shared(keys: DataFrame, contexts: int) -> DataFrame:
    """Those keys that several of the ``contexts`` have; a context that is listed twice is one."""
    keys = written(keys, "runs", contexts, HEAVY)
    often = keys.groupBy("key").agg(F.min("context").alias("a"), F.max("context").alias("b")).where("a < b").select("key")
    return keys.join(often, "key")


def scan_crowds(contexts: DataFrame) -> DataFrame:
    """As ``scan_groups`` for grams with many contexts, by counts instead of a scan in one task."""
    n = contexts.count()
    shared = written(_shared(run_keys(contexts, True), n), "shared", n * 2 * LEFT // GRID)
    found = shared.where("kind = 0").groupBy("gram", "context").agg(F.max("d").alias("top"), F.min("d").alias("low"))
    ranges = shared.where("kind = 1").select("gram", "context", "d", "key")
    # a range is looked into, by all that share its common part, if it can widen the span of one of them
    open_keys = (ranges.join(found, ["gram", "context"], "left")
                 .where("top is null or d >= top or d < low").select("key").distinct())
    todo = F.flatten(F.transform(F.collect_set("d"), lambda d: F.sequence(d + 1, d + GRID - 1)))  # some 300 offsets at most
    asked = contexts.join(ranges.join(open_keys, "key", "left_semi").groupBy("gram", "context").agg(todo.alias("todo")),
                          ["gram", "context"])
    finer = _shared(run_keys(asked, False), n).groupBy("gram", "context").agg(F.max("d").alias("top"), F.min("d").alias("low"))
    both = found.unionByName(finer)
    alone = contexts.where("n > 1").select(
        "gram", "context", F.octet_length("before").alias("lo"), F.octet_length("after").alias("hi"))
    runs = both.groupBy("gram", "context").agg(F.max("top").alias("lo"), (LENGTH - F.min("low")).alias("hi"))
    return runs.unionByName(alone).groupBy("gram", "context").agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"))


def covered(texts: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``t1, t2, spans``: the removed runs of bytes of each text that has some."""
    found = materialize(sampled(texts), "anchors")
    contexts = found.groupBy("gram", "context").agg(
        F.sum("copies").alias("n"), F.min("t1").alias("t1"), F.min("reach_left").alias("reach_left"),
        F.min("reach_right").alias("reach_right"))  # shuffled once for both uses
    grams = contexts.groupBy("gram").agg(F.sum("n").alias("all"), F.count("*").alias("crowd")).where(F.col("all") > 1)
    repeated = written(contexts.join(grams.select("gram", "crowd"), "gram"), "repeated", found.count())

    single = repeated.where("crowd = 1").select(
        "gram", "context", F.col("reach_left").cast("int").alias("lo"), F.col("reach_right").cast("int").alias("hi"))
    wanted = repeated.where("crowd > 1").select("gram", "context", "n", "crowd", "t1")
    cut = written(context_bytes(texts, wanted), "bytes", wanted.count(), HEAVY)
    reach = single.unionByName(scan_groups(cut.where(F.col("crowd") <= crowd)))
    crowds = cut.where(F.col("crowd") > crowd)
    if not crowds.isEmpty():
        reach = reach.unionByName(scan_crowds(crowds))
    spans = found.join(reach, ["gram", "context"]).select(
        "t1", "t2", (F.col("place") - F.col("lo")).alias("start"), (F.col("place") + F.col("hi")).alias("stop"))
    return written(merged_spans(spans, "t1", "t2"), "spans", found.count())


def cut_out(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``t1, t2, n_removed, n_spans, kept``: the bytes that stay of each text with spans."""
    rows = texts.select("t1", "t2", "text").join(spans, ["t1", "t2"])

    def cut(batches):
        for batch in batches:
            kept, gone, runs = [], [], []
            for text, spans in zip(batch.column(2), batch.column(3)):
                data, at, left, n = text.as_buffer(), 0, [], 0
                for s in spans.as_py():
                    left.append(memoryview(data)[at : s["start"]])
                    n += s["stop"] - s["start"]
                    at = s["stop"]
                left.append(memoryview(data)[at:])
                kept.append(b"".join(left))
                gone.append(n)
                runs.append(len(spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.int64()),
                                              pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                                             names=["t1", "t2", "n_removed", "n_spans", "kept"])

    return rows.select("t1", "t2", "text", "spans").mapInArrow(
        cut, "t1 long, t2 long, n_removed long, n_spans long, kept binary")


def dedup_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """The documents without repeated bytes.

    Returns ``documents`` (``doc_id, n_bytes, t1, t2, text_sha256``) and ``texts`` (``t1, t2, n_removed, n_spans, kept``
    for each distinct text that loses bytes, once for each row alike in id and text); they join on ``t1, t2``, the
    hashes of the text.
    """
    text = F.coalesce("text", F.lit(""))
    docs = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", text.alias("text"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("2"), text).alias("t2"))
    rows = docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "t1", "t2",
                       F.sha2("text", 256).alias("text_sha256"))
    rows = materialize(rows, "texts")
    # one row of each text stands for its copies; rows alike in id and text all do, which changes no result
    copied = written(rows.where(F.col("n_bytes") >= LENGTH).groupBy("t1", "t2").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("rep")).where("copies > 1"), "copied", rows.count())
    texts = docs.where(F.octet_length("text") >= LENGTH).alias("d").join(
        small(copied, 100_000).alias("r"), F.expr("d.t1 = r.t1 and d.t2 = r.t2"), "left").where(
        "r.copies is null or d.doc_id <=> r.rep").select("d.text", "d.t1", "d.t2", F.expr("coalesce(r.copies, 1L)").alias("copies"))
    return rows, cut_out(texts, covered(texts, crowd))
