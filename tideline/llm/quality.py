"""Quality rules by robust multivariate outliers, with DataFrame functions only.

Words are ``[^\\x20\\x09-\\x0D]+``.  For each document: n_words, word_chars (code points in
words), n_symbols (``[#*$%&|<>]``), n_dup_lines (lines with a word, equal to an earlier line) and
n_repeat_words (words in 5-word windows that the text holds twice or more).  A document
with fewer than 10 words, or with more than 20 % of them in repeated windows, fails outright.

The others are judged by a minimum-covariance-determinant estimate for each
language and source, made of the documents that have not failed:

1. The statistics become a vector: characters, symbols, repeated lines and
   repeated words per word, each shrunk to the median of the group by ``PRIOR`` words, so
   that a short text is not extreme by chance; the symbols' rate by log1p.
2. Starts: medians with quartiles of each coordinate; mean and covariance of all; the spatial signs'
   covariance; the correlations of the coordinates' hyperbolic tangents.
3. Concentration steps from each start: the ``CORE`` share of the documents nearest by Mahalanobis
   distance gives the next mean and covariance (``FLOORS`` squared added on the diagonal), as long as a step lowers
   the logarithm of the determinant by more than ``DROP``.  The estimate of the least determinant of all stands.
4. The covariance is scaled so that the median distance is that of a normal law.
   A document farther than ``CUTOFF`` is rejected.

Quantiles come from counts of fixed bins, a fiftieth of a floor wide near zero and 2 % of the value far from it, so reruns agree and no group is gathered in one
task.  A group of fewer than ``LEAST`` documents is judged by the estimate of its
language, or of all documents, each made of all documents of that level; if these are fewer too,
nothing is rejected.

Edge cases: null or empty text has no words and fails.  Null languages and sources are
groups like others.  Rows that repeat an id are judged one by one.  An empty table
gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import materialize, pick

SEPARATORS = "[\\x20\\x09-\\x0D]+"
WINDOW = 5
PRIOR = 50.0
CORE = 0.55  # just over one half: up to 45 % of a group may be outliers
DROP = 0.001
LEAST = 100
CUTOFF = 5.0
FLOORS = (0.25, 0.06, 0.01, 0.025)  # least standard deviation of each coordinate; CUTOFF of them lie within its range
NORMAL_MEDIAN = 3.357  # of the squared distance in four dimensions
BINS = 50  # bins for a standard deviation, or for a factor e of squared distance
DIMS = len(FLOORS)


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, lang, source`` and the statistics of each text."""
    rows = docs.select("doc_id", "lang", "source", F.xxhash64("text").alias("text_hash"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("parts", F.split("text", SEPARATORS))
    lead = (F.element_at("parts", 1) == "").cast("int")
    tail = ((F.size("parts") > 1) & (F.element_at("parts", -1) == "")).cast("int")
    rows = rows.withColumn("words", F.slice("parts", lead + 1, F.size("parts") - lead - tail))
    rows = rows.select(
        "doc_id", "text_hash", "lang", "source", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    near = F.expr(f"transform(slice(h, 1, greatest(size(h) - {WINDOW - 1}, 0)), (x, i) -> xxhash64(x, "
                  + ", ".join(f"h[i + {j}]" for j in range(1, WINDOW)) + "))")
    rows = rows.withColumn("windows", near)
    again = F.size("windows") > F.size(F.array_distinct("windows"))
    rows = rows.withColumn("sorted", F.when(again, F.expr(
        "array_sort(transform(windows, (x, i) -> named_struct('x', x, 'i', i)))")))
    covered = F.expr(f"""
        aggregate(
          array_sort(transform(
            filter(sorted, (s, j) -> coalesce(s.x = get(sorted, j - 1).x, false) or coalesce(s.x = get(sorted, j + 1).x, false)),
            s -> s.i)),
          named_struct('n', 0L, 'stop', 0L),
          (got, i) -> named_struct('n', got.n + i + {WINDOW} - greatest(cast(i as bigint), got.stop), 'stop', cast(i + {WINDOW} as bigint)),
          got -> got.n)""")
    return rows.select(
        "doc_id", "text_hash", "lang", "source", "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _group(*columns: str) -> Column:
    return F.xxhash64(F.lit(len(columns)), *[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def groups(rows: DataFrame) -> DataFrame:
    """``lang, source`` to each group ``g`` whose estimate they are part of, and if it is their ``own``, that judges them.

    Groups are a language's source, a language, and all; only those that judge some documents are listed.
    """
    counts = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_lang = counts.groupBy("lang").agg(F.sum("n").alias("of_lang"))
    everything = rows.count()
    same = counts["lang"].eqNullSafe(by_lang["lang"])
    counts = counts.join(by_lang, same).drop(by_lang["lang"])
    levels = [(F.col("n"), _group("lang", "source")), (F.col("of_lang"), _group("lang")), (F.lit(everything), _group())]
    judge = F.coalesce(*[F.when(n >= LEAST, g) for n, g in levels])
    counts = materialize(counts.select("lang", "source", judge.alias("judge"), F.array(*[g for _, g in levels]).alias("levels")), "groups")
    used = counts.select(F.col("judge").alias("g")).distinct()  # null if no group has enough documents
    return (counts.select("lang", "source", "judge", F.explode("levels").alias("g")).join(used, "g")
            .select("lang", "source", "g", F.expr("g = judge").alias("own")))


def quantiles(binned: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Of ``g, dim, bin``: the least bin with at least each share of the rows at or below it."""
    up_to = Window.partitionBy("g", "dim").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    counted = binned.groupBy("g", "dim", "bin").agg(F.count("*").alias("n"))
    counted = counted.withColumn("below", F.sum("n").over(up_to)).withColumn(
        "all", F.sum("n").over(Window.partitionBy("g", "dim")))
    return counted.groupBy("g", "dim").agg(
        *[F.min(F.when(F.col("below") >= share * F.col("all"), F.col("bin"))).alias(name) for name, share in shares.items()])


def _level(value: Column, floor: float) -> Column:
    """The bin of a value from 0 on; their number grows with the logarithm of the greatest."""
    return F.floor(F.log1p(value / floor) * BINS).cast("long")


def _value(level: Column, floor: float) -> Column:
    return F.expm1(level / BINS) * floor


def levels(rows: DataFrame, columns: list[Column]) -> DataFrame:
    return rows.select("g", F.posexplode(F.array(*[_level(c, f) for c, f in zip(columns, FLOORS)])).alias("dim", "bin"))


def medians(rows: DataFrame, columns: list[Column]) -> DataFrame:
    """``g`` and the median of each column in it, ``q2_0 ..``."""
    q = quantiles(levels(rows, columns), {"q2": 0.5})
    return q.groupBy("g").agg(*[F.max(F.when(F.col("dim") == i, _value(F.col("q2"), f))).alias(f"q2_{i}") for i, f in enumerate(FLOORS)])


def vectors(rows: DataFrame) -> DataFrame:
    """``g`` and the coordinates ``v0 ..`` added to the statistics."""
    counts = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rates = materialize(medians(rows, [F.col(c) / F.col("n_words") for c in counts]), "rates")
    rows = rows.join(rates, "g")
    out = []
    for i, c in enumerate(counts):
        rate = (F.col(c) + PRIOR * F.col(f"q2_{i}")) / (F.col("n_words") + PRIOR)
        out.append(F.log1p(rate) if c == "n_symbols" else rate)
    return rows.select(*[c for c in rows.columns if not c.startswith("q2_")], *[v.alias(f"v{i}") for i, v in enumerate(out)])


def starts(rows: DataFrame) -> DataFrame:
    """Four estimates ``k`` of location and covariance for each ``g``."""
    q = quantiles(levels(rows, [F.col(f"v{i}") for i in range(DIMS)]), {"q1": 0.25, "q2": 0.5, "q3": 0.75})
    middle = []
    for i, f in enumerate(FLOORS):
        of = F.col("dim") == i
        middle.append(F.max(F.when(of, _value(F.col("q2") + 0.5, f))).alias(f"m{i}"))
        sd = F.greatest((_value(F.col("q3") + 0.5, f) - _value(F.col("q1") + 0.5, f)) / 1.349, F.lit(f))
        middle.append(F.max(F.when(of, sd)).alias(f"s{i}"))
    middle = materialize(q.groupBy("g").agg(*middle), "estimate")  # a row for each group
    scaled = rows.join(middle, "g").select("g", *[f"v{i}" for i in range(DIMS)], *[
        ((F.col(f"v{i}") - F.col(f"m{i}")) / F.col(f"s{i}")).alias(f"z{i}") for i in range(DIMS)])
    norm = F.greatest(F.sqrt(sum((F.col(f"z{i}") ** 2 for i in range(DIMS)), F.lit(0.0))), F.lit(1e-9))
    out = [F.avg(f"v{i}").alias(f"a{i}") for i in range(DIMS)]
    for i in range(DIMS):
        for j in range(i + 1):
            out.append(F.covar_pop(f"v{i}", f"v{j}").alias(f"all{i}{j}"))
            out.append((DIMS * F.avg(F.col(f"z{i}") * F.col(f"z{j}") / norm / norm)).alias(f"sign{i}{j}"))
            spread = F.stddev_pop(F.tanh(f"z{i}")) * F.stddev_pop(F.tanh(f"z{j}"))
            tanh = F.covar_pop(F.tanh(f"z{i}"), F.tanh(f"z{j}"))
            out.append((F.lit(1.0) if i == j else F.when(spread > 1e-12, tanh / spread).otherwise(0.0)).alias(f"tanh{i}{j}"))
    every = scaled.groupBy("g").agg(*out).join(middle, "g")

    def one(k: int, mean: str, cov) -> Column:
        return F.struct(F.lit(k).alias("k"), *[F.col(f"{mean}{i}").alias(f"m{i}") for i in range(DIMS)], *[
            (cov(i, j) + F.lit(FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i in range(DIMS) for j in range(i + 1)])

    def sized(name: str):
        return lambda i, j: F.col(f"{name}{i}{j}") * F.col(f"s{i}") * F.col(f"s{j}")

    return every.select("g", F.inline(F.array(
        one(0, "m", lambda i, j: F.col(f"s{i}") ** 2 if i == j else F.lit(0.0)), one(1, "a", lambda i, j: F.col(f"all{i}{j}")),
        one(2, "m", sized("sign")), one(3, "m", sized("tanh")))))


def factors(estimate: DataFrame) -> DataFrame:
    """Adds the Cholesky factors ``l00 ..`` of the covariance."""
    for i in range(DIMS):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            low = F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2 / 100))) if i == j else rest / F.col(f"l{j}{j}")
            estimate = estimate.withColumn(f"l{i}{j}", low)
    return estimate


def distance(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Adds the squared Mahalanobis distance ``d2`` (and ``k``) for each estimate of the row's group."""
    columns = [*rows.columns, *(c for c in estimate.columns if c == "k")]
    rows = rows.join(factors(estimate), "g")
    for i in range(DIMS):
        y = F.col(f"v{i}") - F.col(f"m{i}")
        for j in range(i):
            y = y - F.col(f"l{i}{j}") * F.col(f"y{j}")
        rows = rows.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    return rows.select(*columns, sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(DIMS)), F.lit(0.0)).alias("d2"))


def _bin(d2: Column) -> Column:
    return F.floor(F.log(d2 + 1e-6) * BINS).cast("long")


def concentrate(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """For each ``g, k``: mean and covariance of the ``CORE`` share of documents nearest to the
    estimate, and ``log_det``, the logarithm of the covariance's determinant."""
    near = distance(rows.select("g", *[f"v{i}" for i in range(DIMS)]), estimate).withColumn("bin", _bin(F.col("d2")))
    edge = materialize(quantiles(near.select("g", F.col("k").alias("dim"), "bin"), {"edge": CORE}).select(
        "g", F.col("dim").alias("k"), "edge"), "edge")
    core = near.join(edge, ["g", "k"]).where("bin <= edge")
    out = [F.avg(f"v{i}").alias(f"m{i}") for i in range(DIMS)]
    for i in range(DIMS):
        for j in range(i + 1):
            c = F.covar_pop(f"v{i}", f"v{j}")
            out.append((c + F.lit(FLOORS[i] ** 2) if i == j else c).alias(f"c{i}{j}"))
    after = core.groupBy("g", "k").agg(*out)
    return factors(after).select(*after.columns, (2 * sum((F.log(f"l{i}{i}") for i in range(DIMS)), F.lit(0.0))).alias("log_det"))


def estimates(rows: DataFrame) -> DataFrame:
    """Location, covariance, ``log_det`` and ``scale`` of each group ``g``: the least determinant that the starts lead to."""
    now = materialize(concentrate(rows, materialize(starts(rows), "estimate")), "estimate")
    found = now
    while True:  # each round lowers a determinant by a fixed factor, and the floors bound it from below
        after = concentrate(rows, now).alias("a").join(now.select("g", "k", "log_det").alias("b"), ["g", "k"])
        now = materialize(after.where(f"a.log_det < b.log_det - {DROP}").drop(F.col("b.log_det")), "estimate")
        if now.isEmpty():
            break
        found = found.unionByName(now)
    rest = [c for c in found.columns if c not in ("g", "k", "log_det")]
    best = materialize(found.groupBy("g").agg(F.min(F.struct("log_det", "k", *rest)).alias("e")).select(
        "g", "e.log_det", *[f"e.{c}" for c in rest]), "estimate")
    near = distance(rows.select("g", *[f"v{i}" for i in range(DIMS)]), best)
    middle = quantiles(near.select("g", F.lit(0).alias("dim"), _bin(F.col("d2")).alias("bin")), {"q2": 0.5})
    scale = F.greatest(F.exp((F.col("q2") + 0.5) / BINS) / NORMAL_MEDIAN, F.lit(1.0))
    return materialize(best.join(middle.select("g", scale.alias("scale")), "g"), "estimate")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            source_col: str = "source") -> DataFrame:
    """One row for each document: the statistics, ``base_failed``, ``distance`` (null if not judged) and ``kept``."""
    rows = statistics(pick(docs, doc_id=id_col, text=text_col, lang=lang_col, source=source_col))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = materialize(rows.withColumn("base_failed", failed), "statistics")
    judge = groups(rows.where(~F.col("base_failed")))
    judged = (rows.alias("r").join(judge.alias("j"), F.expr("r.lang <=> j.lang and r.source <=> j.source and not r.base_failed"))
              .select("r.*", "j.g", "j.own"))
    judged = materialize(vectors(judged), "vectors")
    est = estimates(judged)
    far = distance(judged.where("own").drop("own"), est.drop("scale", "log_det")).join(est.select("g", "scale"), "g").select(
        "doc_id", "text_hash", F.sqrt(F.col("d2") / F.col("scale")).alias("distance"), *[c for c in rows.columns[2:]])
    rest = (rows.alias("r").join(judge.alias("j"), F.expr("r.lang <=> j.lang and r.source <=> j.source and not r.base_failed"), "left_anti")
            .withColumn("distance", F.lit(None).cast("double")))
    out = far.unionByName(rest)
    return out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF))
