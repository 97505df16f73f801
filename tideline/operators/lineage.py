"""Lineage graph operators.

All operators work on every dataset at once and return DataFrames; a single
dataset's answer is a filter on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tideline.session import ensure_checkpoint_dir, materialize, scratch_dir
from tideline.sources.lineage import LineageGraph


def direct_upstream(g: LineageGraph) -> DataFrame:
    """``(dataset, upstream, ord)`` in declared order (L1); unknown -> no rows."""
    return g.edges.select("dataset", "upstream", "ord")


def direct_downstream(g: LineageGraph) -> DataFrame:
    """``(dataset, downstream, ord)`` (L3); ``ord`` is the downstream's
    declaration position, the order in which declarations are scanned."""
    e = g.edges.select(F.col("upstream").alias("dataset"), F.col("dataset").alias("downstream"))
    d = g.datasets.select(F.col("dataset").alias("downstream"), F.col("decl_ord").alias("ord"))
    return e.join(d, "downstream", "left").select("dataset", "downstream", "ord")


def critical_columns(g: LineageGraph) -> DataFrame:
    """``(dataset, column, ord)``."""
    return g.critical.select("dataset", "column", "ord")


BUCKET_PAIRS = 2_000_000  # a round of so many pairs is bucketed; the join strategy for a smaller one is Spark's
PATIENCE = 16  # rounds of a walk from seeds before its steps are lengthened


class _Levels:
    """Pairs ``(__a, __b, __d)`` by rounds, each a written table.

    A round of at least ``bucket_pairs`` pairs is also written as two bucketed and sorted tables: by the pair, for the
    anti joins that drop known pairs, and by its first, for the joins that go on from a frontier.  Both
    have as many buckets as the session shuffles into, so neither is moved again.
    """

    def __init__(self, spark: SparkSession, bucket_pairs: int):
        self.spark, self.bucket_pairs = spark, bucket_pairs
        self.tables: list[str] = []
        self.files: list[DataFrame] = []
        self.pairs: list[DataFrame] = []  # for the anti joins
        self.steps: list[DataFrame] = []  # for the joins

    def _bucketed(self, df: DataFrame, *keys: str) -> DataFrame:
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path = scratch_dir(self.spark, "closure-buckets")
        self.tables.append(path.rsplit("/", 1)[1].replace("-", "_"))
        writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        writer.option("path", path).saveAsTable(self.tables[-1])
        return self.spark.table(self.tables[-1]).hint("merge")

    def add(self, fresh: DataFrame, deepest: int) -> int:
        """Write a round; returns how many of its pairs are at depth ``deepest``."""
        seen = Observation()
        observed = fresh.observe(seen, F.count_if(F.col("__d") == deepest).alias("deepest"), F.count(F.lit(1)).alias("n"))
        self.files.append(materialize(observed, "closure"))
        large = seen.get["n"] >= self.bucket_pairs
        self.pairs.append(self._bucketed(self.files[-1], "__a", "__b") if large else self.files[-1])
        self.steps.append(self._bucketed(self.files[-1], "__a") if large else self.files[-1])
        return seen.get["deepest"]

    def unknown(self, found: DataFrame) -> DataFrame:
        """The nearest of each pair in ``found``, without pairs that are known."""
        out = found.groupBy("__a", "__b").agg(F.min("__d").alias("__d"))
        for known in self.pairs:
            out = out.join(known, ["__a", "__b"], "left_anti")
        return out

    def close(self) -> DataFrame:
        """All pairs; the bucketed tables leave the catalog (their files stay with the other scratch folders)."""
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        out = self.files[0]
        for df in self.files[1:]:
            out = out.unionByName(df)
        return out


def closure(
    g: LineageGraph,
    seeds: DataFrame | None = None,
    direction: str = "up",
    hops: int | None = None,
    bucket_pairs: int = BUCKET_PAIRS,
) -> DataFrame:
    """Transitive closure pairs ``(dataset, upstream, depth)``.

    From every dataset at once, the reach doubles each round: a pair at distance
    ``D + k``, ``k <= D``, is one at distance ``D`` (the frontier) followed by one at
    distance ``k``, and all of these are known.  A round joins the frontier to the
    known pairs, keeps the smallest depth per pair, drops pairs already known, and writes
    the rest; when nothing is ``2 D`` levels down, nothing deeper exists and the loop stops
    (cycles terminate).  A cycle of 5,000 datasets takes 14 rounds.

    From ``seeds`` (a one-column DataFrame of dataset names), only their pairs are
    walked.  They go on by a table of the distances up to ``hops`` (1 by default) between any two
    datasets; it is extended to twice that, in the same way, after every ``PATIENCE`` rounds,
    so that long chains do not take a round for each level.

    ``depth`` is the length of the shortest path; a dataset on a cycle reaches itself;
    names only ever mentioned as upstream are included.  ``direction="down"`` walks the
    reversed edges; the pairs are then ``(dataset, downstream, depth)``.  Known pairs
    stay where they are: each round is a table in the shared checkpoint folder (a lost
    executor's output is re-read, not recomputed from the first round), a large one
    bucketed, so that it is co-partitioned with what is joined to it; the size of the next frontier
    is observed while the round is written.
    """
    spark = g.edges.sparkSession
    ensure_checkpoint_dir(spark)
    if direction not in ("up", "down"):
        raise ValueError(direction)
    src, dst, out = ("dataset", "upstream", "upstream") if direction == "up" else ("upstream", "dataset", "downstream")
    if hops is not None and hops < 1:
        raise ValueError("hops must be >= 1")
    edges = g.edges.select(F.col(src).alias("__a"), F.col(dst).alias("__b")).groupBy("__a", "__b").agg(F.lit(1).alias("__d"))
    every = _Levels(spark, bucket_pairs)
    reach = 1
    more = every.add(edges, reach)
    if seeds is None:
        while more:
            reach, more = _double(every, reach)
        pairs = every.close()
    else:
        while more and reach < (hops or 1):
            reach, more = _double(every, reach, most=hops)
        roots = seeds.select(F.col(seeds.columns[0]).alias("__a")).distinct()
        walked, rounds = _Levels(spark, bucket_pairs), 0
        first = every.files[0].join(roots, "__a", "left_semi")
        depth = 1
        left = walked.add(first.groupBy("__a", "__b").agg(F.min("__d").alias("__d")), depth)
        while left:
            rounds += 1
            if more and rounds % PATIENCE == 0:
                reach, more = _double(every, reach)
            found = _onward(walked.files[-1].where(F.col("__d") == depth), every.steps, reach)
            depth += reach
            left = walked.add(walked.unknown(found), depth)
        pairs = walked.close()
        every.close()
    return pairs.select(F.col("__a").alias("dataset"), F.col("__b").alias(out), F.col("__d").cast("int").alias("depth"))


def _onward(frontier: DataFrame, steps: list[DataFrame], most: int) -> DataFrame:
    """Pairs that go on from the frontier by at most ``most`` levels."""
    at = frontier.select(F.col("__a").alias("__from"), F.col("__b").alias("__via"), F.col("__d").alias("__so_far"))
    out = None
    for step in steps:
        far = at.join(step.where(F.col("__d") <= most), F.col("__via") == F.col("__a")).select(
            F.col("__from").alias("__a"), "__b", (F.col("__so_far") + F.col("__d")).alias("__d"))
        out = far if out is None else out.unionByName(far)
    return out


def _double(every: _Levels, reach: int, most: int | None = None) -> tuple[int, int]:
    """Extend all pairs from distance ``reach`` to twice that (or to ``most``); the new reach, and its pairs there."""
    go_on = min(reach, (most or 2 * reach) - reach)
    found = _onward(every.files[-1].where(F.col("__d") == reach), every.steps, go_on)
    return reach + go_on, every.add(every.unknown(found), reach + go_on)


def all_upstream(g: LineageGraph, seeds: DataFrame | None = None) -> DataFrame:
    """``(dataset, upstream, depth)`` (L2), of every dataset or only of the ``seeds``."""
    return closure(g, seeds=seeds)


def all_downstream(g: LineageGraph, seeds: DataFrame | None = None) -> DataFrame:
    """``(dataset, downstream, depth)`` (L4): the closure over reversed edges."""
    return closure(g, seeds=seeds, direction="down")


def listing(g: LineageGraph) -> DataFrame:
    """One row per declared dataset (L6): source flag, depends-on, feeds-into.

    Lists are rendered as ``", "``-joined text in declaration order; ``listing_pages``
    gives the same lists without a giant row for a hub.
    """
    up = g.edges.groupBy("dataset").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("ord", "upstream"))), lambda s: s["upstream"]), ", "
        ).alias("depends_on")
    )
    down = direct_downstream(g).groupBy("dataset").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.col("ord"), F.col("downstream")))), lambda s: s["downstream"]
            ),
            ", ",
        ).alias("feeds_into")
    )
    d = g.datasets.select("dataset", "decl_ord")
    out = d.join(up, "dataset", "left").join(down, "dataset", "left")
    return out.select(
        "dataset",
        F.col("depends_on").isNull().alias("is_source"),
        F.coalesce("depends_on", F.lit("")).alias("depends_on"),
        F.coalesce("feeds_into", F.lit("")).alias("feeds_into"),
    )


PAGE = 1000  # names on a page


def listing_pages(g: LineageGraph, size: int = PAGE) -> DataFrame:
    """``(dataset, list, page, n_names, names)``: the neighbours of each dataset in pages of at most ``size`` names.

    ``list`` is ``depends_on`` or ``feeds_into``; pages count from 1 in declaration order, and
    joined in that order their names are the text of ``listing``.  A page is a range of
    ``size`` places in the declaration (of the upstreams, or of all datasets), so no
    neighbour list is ever sorted or held as a whole; only its pages are numbered.
    """
    up = direct_upstream(g).select("dataset", F.lit("depends_on").alias("list"), "ord", F.col("upstream").alias("name"))
    down = direct_downstream(g).select("dataset", F.lit("feeds_into").alias("list"), "ord", F.col("downstream").alias("name"))
    declared = g.datasets.select("dataset").distinct()
    both = up.unionByName(down).join(declared, "dataset", "left_semi").withColumn("__range", F.floor(F.col("ord") / size))
    pages = both.groupBy("dataset", "list", "__range").agg(
        F.count(F.lit(1)).alias("n_names"), F.array_sort(F.collect_list(F.struct("ord", "name"))).alias("__names"))
    number = F.row_number().over(Window.partitionBy("dataset", "list").orderBy("__range"))
    return pages.select("dataset", "list", number.cast("bigint").alias("page"), "n_names",
                        F.array_join(F.transform("__names", lambda x: x["name"]), ", ").alias("names"))
