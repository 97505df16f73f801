"""From raw documents to shards: quality rules, near-duplicates, decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor
kept; ``run`` writes each result as Parquet into the shared folder and reads it
again for the next stage.  All stages but the last return the columns of ``docs``.
Rows are told apart by id and text: a decision on a row holds for the rows alike in both.

An empty table passes through all stages.  Null ids and texts are handled as the operators'
docstrings say: texts without words fail the quality rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import documents, materialize, small, unique
from tideline.llm.decontaminate import decontaminate
from tideline.llm.mixing import mix
from tideline.llm.neardup import near_duplicates
from tideline.llm.quality import quality
from tideline.llm.sharding import shard

SAME = "d.doc_id <=> g.doc_id and xxhash64(d.text) = g.text_hash"


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` but for the rows alike in ``doc_id`` and ``text_hash``."""
    gone = materialize(gone.select("doc_id", "text_hash").distinct(), "gone")
    return docs.alias("d").join(small(gone).alias("g"), F.expr(SAME), "left_anti")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return without(docs, quality(docs).where(~F.col("kept")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, also where ids repeat or are null; of rows alike in id and text, one."""
    judged = materialize(near_duplicates(docs), "near")
    kept = without(docs, judged.where(~F.col("chosen")))
    again = materialize(judged.where("chosen and n_shingles > 0").groupBy("doc_id", "text_hash").count().where("count > 1"), "again")
    if again.isEmpty():
        return kept
    repeated = kept.alias("d").join(small(again).alias("g"), F.expr(SAME), "left_semi")
    return without(kept, again).unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return without(docs, found.where("contaminated"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, whole: its taken words over its size, the
    fraction rounded up or down by a hash of the document, so that sources keep their shares."""
    taken, _ = mix(docs)
    chance = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit("copies")), F.lit(1 << 20)) / (1 << 20)
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + chance)).otherwise(F.lit(0))
    plan = taken.select("doc_id", "text_hash", copies.cast("int").alias("copies")).groupBy("doc_id", "text_hash").agg(
        F.max("copies").alias("copies"))
    plan = materialize(plan.where("copies > 0"), "copies")
    nth = unique("nth")  # a name that no column of the documents has
    joined = docs.alias("d").join(plan.hint("merge").alias("g"), F.expr(SAME)).select("d.*", F.explode(F.sequence(
        F.lit(1), F.col("g.copies"))).alias(nth))
    return joined.drop(nth)


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each document of the mix."""
    return shard(docs)


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage), ("decontaminate", decontaminate_stage),
          ("mix", mix_stage), ("shard", shard_stage)]

#: Concentration steps, components and permutations have no form in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
