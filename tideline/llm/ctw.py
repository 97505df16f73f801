"""Language-model scores by context-tree weighting over bytes, beside a unigram base score.

*Model.*  A byte is eight binary decisions, most significant bit first; each is a node of a
tree over the bits already seen.  Every node has a Krichevsky-Trofimov estimate for
each context of 0 to ``depth`` preceding bytes (the registered query: ``DEPTH``); the estimates are mixed over all depths
with the weights of context-tree weighting (one half for the context's own estimate, one half
for its children), learned from the training texts.  Texts begin after ``depth`` zero bytes.
The score is the sum of log10 probabilities of all bytes, so the code length per
byte is ``-score * log2(10) / n_bytes``.

The tree grows with the corpus and is never in one place.  Runs of ``depth + 1`` bytes are dealt to
parts by the last ``TOP + 1`` bytes of their context, so each part mixes its contexts of more than ``TOP`` bytes bottom
up by itself and passes sums on to the shorter ones; these are at most 65,792 contexts (4 KB each, whatever
the corpus) and are broadcast.  Texts are cut into blocks of ``BLOCK`` bytes; a block asks
the parts once for each distinct run it holds, and the answers meet its texts again.

*Base.*  Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then one end token a text;
the sum of ``log10((c + 1) / (N + V + 1))``.  Words are told apart by a 64-bit hash.  The
vocabulary is not bounded, so the counts of its at most ``HOT`` most frequent words are looked up in
the task, and those of all other words are joined by key.

Training texts: those whose ``crc32(id as text) mod 7`` is not 2 (a null id counts as an empty one).

Edge cases: a null or empty text has no bytes (score 0) and only the end token.  Without training texts all
counts are 0 and each bit has probability one half.  Rows that repeat an id are
scored, and learned from, one by one.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm import text as tx
from tideline.llm.common import materialize, partitions, pick

DEPTH = 5  # of the registered query
TOP = 2  # contexts up to this many bytes are in the table that is broadcast
BLOCK = 16 << 20  # bytes of text whose distinct runs are looked up together
HOT = 1 << 18  # words looked up in tasks: 4 MB
FOLDS, HELD = 7, 2
END = 0x7E4D5D3A11  # the end token's key
FLUSH = 1 << 19  # distinct keys a task holds before it passes them on


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD


def grams(data: np.ndarray, offsets: np.ndarray, depth: int) -> np.ndarray:
    """Each byte after the ``depth`` bytes before it, the oldest highest, as one number; zeros before a text."""
    out = data.astype(np.int64)
    begin, lengths = offsets[:-1], np.diff(offsets)
    for j in range(1, depth + 1):
        back = np.zeros(len(data), np.int64)
        back[j:] = data[:-j]
        for i in range(j):
            back[begin[lengths > i] + i] = 0
        out |= back << (8 * j)
    return out


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[first], np.add.reduceat(n, first)


def word_counts(docs: DataFrame) -> DataFrame:
    """How often each word occurs: ``key, n``."""

    def count(batches):
        table = tx.space_words()
        keys, n = [], []

        def passed():
            batch = pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(keys, n)], names=["key", "n"])
            keys.clear()
            n.clear()
            return batch

        for batch in batches:
            for first, last, data, offsets in tx.slices(batch.column(0)):
                words = tx.Words(data, offsets, table)
                k, times = np.unique(words.hashes, return_counts=True)
                keys += [k.view(np.int64), np.array([END], np.int64)]
                n += [times.astype(np.int64), np.array([last - first], np.int64)]
                if sum(map(len, keys)) > FLUSH:
                    yield passed()
        if keys:
            yield passed()

    return docs.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def pack(numbers: np.ndarray, size: int) -> bytes:
    """The lowest ``size`` bytes of each number, the first bytes of all, then the second: sorted numbers compress well."""
    return numbers.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes()


def unpack(blob: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(blob) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(blob, np.uint8).reshape(size, -1).T
    return out.view("<i8").ravel()


def part_of(keys: np.ndarray, parts: int, depth: int) -> np.ndarray:
    """Contexts alike in their last ``TOP + 1`` bytes are in one part."""
    near = (keys >> 8) & ((1 << 8 * min(TOP + 1, depth)) - 1)
    return (tx.mix(near.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def cut(docs: DataFrame, parts: int, depth: int) -> DataFrame:
    """Texts in blocks of about ``BLOCK`` bytes, and what each block holds.

    Rows with a null ``part`` are the documents; the others have a block's distinct runs of
    ``depth + 1`` bytes in a part, sorted, and how often the training texts of the block hold each.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["block", "row", "doc_id", "held_out", "text", "part", "keys", "n"]

    def work(batches):
        block = row = TaskContext.get().partitionId() << 33
        keys, n, size = [], [], 0

        def passed(doc_type, text_type):
            k, times = _summed(keys, n)
            of = part_of(k, parts, depth)
            order = np.argsort(of, kind="stable")
            ends = np.searchsorted(of[order], np.arange(parts + 1))
            some = np.flatnonzero(np.diff(ends))
            own = [order[ends[p] : ends[p + 1]] for p in some]
            none = lambda t: pa.nulls(len(some), t)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), block)), none(pa.int64()), none(doc_type), none(pa.bool_()), none(text_type),
                 pa.array(some.astype(np.int32)), pa.array([pack(k[i], depth + 1) for i in own], pa.binary()),
                 pa.array([pack(times[i], 6) for i in own], pa.binary())], names=names)

        types = None
        for batch in batches:
            types = batch.column(0).type, batch.column(2).type
            held = batch.column(1).to_numpy(zero_copy_only=False)
            for first, last, data, offsets in tx.slices(batch.column(2)):
                if len(data):
                    learned = np.repeat(~held[first:last], np.diff(offsets))
                    both = np.sort((grams(data, offsets, depth) << 1) | learned)
                    at = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
                    keys.append(both[at] >> 1)
                    n.append(np.diff(np.append(at, len(both))) * (both[at] & 1))
                nothing = [pa.nulls(last - first, t) for t in (pa.int32(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(last - first, block)), pa.array(np.arange(row, row + last - first)),
                     *[batch.column(i).slice(first, last - first) for i in range(3)], *nothing], names=names)
                row, size = row + last - first, size + len(data)
                if size >= BLOCK:
                    yield passed(*types)
                    block, size = block + 1, 0
                    keys.clear()
                    n.clear()
        if keys:
            yield passed(*types)

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        work, f"block long, row long, doc_id {kind}, held_out boolean, text string, part int, keys binary, n binary")


def _lgamma(x: np.ndarray) -> np.ndarray:
    shift = np.log(x)
    for j in range(1, 7):
        shift = shift + np.log(x + j)
    y = x + 7
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of that many zeros and ones."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - 2 * 0.5723649429247001 - _lgamma(zeros + ones + 1.0)


def mixed(own: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of the weighted probability of a context, and the weight of its own estimate."""
    both = np.logaddexp(own, children) - np.log(2)
    return both, np.exp(own - np.log(2) - both)


def _grouped(ids: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct ids, sorted, and the sums of their values."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, np.int64)
    return ids[first], [np.add.reduceat(v[order], first) if len(ids) else v for v in values]


def steps(keys: np.ndarray):
    """For each bit of the last byte: the context with the bit's node instead of the byte, the node, and the bit."""
    byte = keys & 255
    for bit in range(8):
        node = (1 << bit) | (byte >> (8 - bit))
        yield keys - byte + node, node, (byte >> (7 - bit)) & 1


class Deep:
    """Nodes of the contexts longer than ``TOP`` bytes in one part, from the deepest upwards: ids, estimates and weights."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, depth: int):
        walk = [(ids, n * (1.0 - one), n * (one + 0.0)) for ids, _, one in steps(keys)]
        ids, (zeros, ones) = _grouped(*[np.concatenate(x) for x in zip(*walk)])
        below, self.levels = np.zeros(len(ids)), []
        for d in range(depth, TOP, -1):
            own = log_kt(zeros, ones)
            both, weight = (own, np.ones(len(own))) if d == depth else mixed(own, below)
            self.levels.append(((1 << 8 * (d + 1)) - 1, ids, (ones + 0.5) / (zeros + ones + 1), weight))
            ids, (zeros, ones, below) = _grouped(ids & ((1 << 8 * d) - 1), zeros, ones, both)
        self.top = ids, zeros, ones, below  # what the contexts of TOP bytes get from this part

    def p_one(self, ids: np.ndarray) -> np.ndarray:
        """Probability of a one at these nodes by the contexts longer than ``TOP`` bytes; one half where nothing was seen."""
        p = np.full(len(ids), 0.5)
        for mask, known, own, weight in self.levels:
            if len(known):
                at = np.minimum(np.searchsorted(known, ids & mask), len(known) - 1)
                p = np.where(known[at] == ids & mask, weight[at] * own[at] + (1 - weight[at]) * p, 0.5)
        return p


class Weights:
    """Estimates and weights at the root and at the contexts of one byte: a few MB at most."""

    def __init__(self, rows: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]):
        zeros, ones, below = np.zeros((3, 256, 256))
        for byte, *sums in rows:
            zeros[byte], ones[byte], below[byte] = sums
        self.p_one = (ones + 0.5) / (zeros + ones + 1)
        weighted, self.w_one = mixed(log_kt(zeros, ones), below)
        zeros, ones = zeros.sum(axis=0), ones.sum(axis=0)
        self.p_root = (ones + 0.5) / (zeros + ones + 1)
        self.w_root = mixed(log_kt(zeros, ones), weighted.sum(axis=0))[1]

    def line(self, byte: int, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """``a`` and ``b``: the probability of a one is ``a + b * q`` if longer contexts tell ``q``."""
        rest = (1 - self.w_root) * (1 - self.w_one[byte])
        a = self.w_root * self.p_root + (1 - self.w_root) * self.w_one[byte] * self.p_one[byte] + rest * weight * p
        return np.stack([a, rest * (1 - weight)], axis=1)


def _dense(pdf, leaf: bool):
    """The older bytes that occur, zeros and ones at their nodes, and log and weight of their mixture."""
    ids = pdf["id"].to_numpy()
    older, at = np.unique(ids >> 16, return_inverse=True)
    zeros, ones, below = np.zeros((3, len(older), 256))
    for to, name in ((zeros, "zeros"), (ones, "ones"), (below, "below")):
        to[at, ids & 255] = pdf[name].to_numpy()
    own = log_kt(zeros, ones)
    return older, zeros, ones, *((own, np.ones(own.shape)) if leaf else mixed(own, below))


def _learned(blobs: list[bytes], counts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    k, n = _summed([unpack(x, depth + 1) for x in blobs], [unpack(x, 6) for x in counts])
    return k[n > 0], n[n > 0]


def train(held: DataFrame, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the contexts of ``TOP`` bytes: rows of ``Weights.line`` by node, and where each context's is."""
    import pandas as pd

    def learn(table):
        ids, zeros, ones, below = Deep(*_learned(table["keys"].to_pylist(), table["n"].to_pylist(), depth), depth).top
        return pa.table({"id": ids, "zeros": zeros, "ones": ones, "below": below})

    top = held.groupBy("part").applyInArrow(learn, "id long, zeros double, ones double, below double")
    top = materialize(top.groupBy("id").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")])
                      .withColumn("byte", F.expr("cast((id div 256) % 256 as int)")), "top")
    leaf = depth == TOP

    def summarise(key, pdf):  # at most 65,280 rows: the nodes of the contexts that end in one byte
        _, zeros, ones, both, _ = _dense(pdf, leaf)
        return pd.DataFrame({"byte": [key[0]], "zeros": [zeros.sum(axis=0)], "ones": [ones.sum(axis=0)], "below": [both.sum(axis=0)]})

    rows = top.groupBy("byte").applyInPandas(summarise, "byte int, zeros array<double>, ones array<double>, below array<double>").collect()
    weights = Weights([(r["byte"], *(np.array(r[c]) for c in ("zeros", "ones", "below"))) for r in rows])  # at most 256 rows

    def finish(key, pdf):
        older, zeros, ones, _, weight = _dense(pdf, leaf)
        lines = weights.line(key[0], (ones + 0.5) / (zeros + ones + 1), weight)
        return pd.DataFrame({"context": older * 256 + key[0], "line": [x.tobytes() for x in lines]})

    found = top.groupBy("byte").applyInPandas(finish, "context long, line binary").toArrow()
    known = found.column("context").to_numpy()
    half = np.full((1, 256), 0.5)
    table = [weights.line(b, half, half) for b in range(256)]  # contexts never seen
    if len(known):
        table.append(np.frombuffer(b"".join(found.column("line").to_pylist())).reshape(-1, 2, 256))
    where = np.tile(np.arange(256, dtype=np.int32), 256)
    where[known] = 256 + np.arange(len(known), dtype=np.int32)
    return np.concatenate(table), where


def answers(held: DataFrame, model, depth: int) -> DataFrame:
    """``block, keys, logs``: the log10 probability of each run of bytes that a block holds."""

    def answer(table):
        lines, where = model.value
        blobs = table["keys"].to_pylist()
        deep = Deep(*_learned(blobs, table["n"].to_pylist(), depth), depth)
        asked = [unpack(x, depth + 1) for x in blobs]
        keys = np.unique(np.concatenate(asked))
        at, logs = where[(keys >> 8) & 0xFFFF], np.zeros(len(keys))
        for ids, node, one in steps(keys):
            p = lines[at, 0, node] + lines[at, 1, node] * deep.p_one(ids)
            logs += np.log10(np.where(one == 1, p, 1 - p))
        logs = logs.astype(np.float32)
        return pa.table({"block": table["block"], "keys": table["keys"],
                         "logs": pa.array([logs[np.searchsorted(keys, k)].tobytes() for k in asked], pa.binary())})

    return held.groupBy("part").applyInArrow(answer, "block long, keys binary, logs binary")


def hot_words(counts: DataFrame, most: int = HOT) -> tuple[np.ndarray, np.ndarray]:
    """Keys, sorted, and counts of the most frequent words, at most ``most``."""
    words = counts.withColumn("level", F.floor(F.log2("n") * 8).cast("int"))
    levels = sorted(((r["level"], r["k"]) for r in words.groupBy("level").agg(F.count("*").alias("k")).collect()),
                    reverse=True)  # some 500 rows at most
    least, total = None, 0
    for level, k in levels:
        if total + k > most:
            break
        least, total = level, total + k
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    got = words.where(F.col("level") >= least).select("key", "n").toArrow()
    keys, n = got.column("key").to_numpy(), got.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, depth: int = TOP) -> DataFrame:
    """One row for each document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes``.

    ``depth``: bytes of the longest contexts, 2 to 6 (a run of bytes is one number).
    """
    if not TOP <= depth <= 6:
        raise ValueError(f"depth {depth} is not within {TOP} and 6")
    spark = docs.sparkSession
    docs = pick(docs, doc_id=id_col, text=text_col)
    counts = materialize(word_counts(docs.where(~held_out())), "counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    blocks = materialize(cut(docs, 4 * partitions(spark), depth), "blocks")
    held = blocks.where("part is not null").select("block", "part", "keys", "n")
    model = spark.sparkContext.broadcast(train(held, depth))
    known = spark.sparkContext.broadcast(hot_words(counts, hot))

    def rate(texts, told):
        keys, often = known.value
        table, out = tx.space_words(), []
        runs = np.concatenate([np.zeros(0, np.int64), *[unpack(x, depth + 1) for x in told["keys"].to_pylist()]])
        logs = np.concatenate([np.zeros(0, np.float32), *[np.frombuffer(x, np.float32) for x in told["logs"].to_pylist()]])
        order = np.argsort(runs)
        runs, logs = runs[order], logs[order].astype(np.float64)
        for first, last, data, offsets in tx.slices(texts["text"]):
            size = last - first
            words = tx.Words(data, offsets, table)
            base, seen = np.zeros(size), np.zeros(size, np.int64)
            rare, rare_n = [], []
            for i in range(size):
                own = np.append(words.hashes[words.bounds[i] : words.bounds[i + 1]].view(np.int64), END)
                k, times = np.unique(own, return_counts=True)
                at = np.minimum(np.searchsorted(keys, k), max(len(keys) - 1, 0))
                hit = keys[at] == k if len(keys) else np.zeros(len(k), bool)
                c = often[at[hit]] if len(keys) else np.zeros(0)
                base[i] = float((times[hit] * np.log10(c + 1.0)).sum())
                seen[i] = int(times[hit].sum())
                rare.append(k[~hit])
                rare_n.append(times[~hit])
            total = np.zeros(size)
            some = np.flatnonzero(np.diff(offsets))
            if len(some):
                each = logs[np.searchsorted(runs, grams(data, offsets, depth))]
                total[some] = np.add.reduceat(each, offsets[:-1][some])
            at = np.concatenate([[0], np.cumsum([len(x) for x in rare])]).astype(np.int32)
            out.append(pa.Table.from_arrays(
                [*[texts[c].slice(first, size) for c in ("row", "doc_id", "held_out")],
                 pa.array(words.counts.astype(np.int64) + 1), pa.array(np.diff(offsets)), pa.array(total), pa.array(base),
                 pa.array(seen), pa.ListArray.from_arrays(at, pa.array(np.concatenate(rare))),
                 pa.ListArray.from_arrays(at, pa.array(np.concatenate(rare_n)))],
                names=["row", "doc_id", "held_out", "n_tokens", "n_bytes", "score", "hot_log", "hot_known", "rare", "times"]))
        return pa.concat_tables(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = blocks.where("part is null").select("block", "row", "doc_id", "held_out", "text")
    rated = materialize(texts.groupBy("block").cogroup(answers(held, model, depth).groupBy("block")).applyInArrow(
        rate, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_bytes long, score double, hot_log double, "
              "hot_known long, rare array<long>, times array<long>"), "scores")
    rare = rated.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "row", F.col("w.rare").alias("key"), F.col("w.times").alias("times"))
    found = rare.join(counts, "key").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("log"), F.sum("times").alias("known"))
    out = rated.drop("rare", "times").join(found, "row", "left")
    base = (F.col("hot_log") + F.coalesce("log", F.lit(0.0))) - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("hot_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score", "n_bytes")
