"""The pipeline's stages against what their operators decide, and the queries against their SQL."""

import duckdb
import fixture_docs as fx
import pytest
from fixture_docs import docs, no_docs, rows  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tideline.llm.queries import ORACLE, REGISTRY
from tideline.session import materialize

SF = "/root/testdata/sf0.001"


def ids(frame):
    return sorted((r["doc_id"] for r in frame.select("doc_id").collect()), key=repr)


def test_stages(spark, docs, rows, tmp_root):
    item = " ".join(fx.letter_words(rows[7][1])[:10])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_root}/benchmark.parquet")
    out, left = docs, list(rows)
    for name, stage in cp.STAGES:
        out = materialize(stage(spark, out, tmp_root), name)
        if name == "quality":
            def good(t):
                c = fx.quality_counts(t)
                return c[0] >= 10 and 100 * c[4] <= 20 * c[0]
            left = [r for r in left if good(r[1])]
        elif name == "near_duplicates":
            parts = fx.near_components(left)
            left = [r for r, (i, _, least) in zip(left, parts) if i == least]
            left = list(dict.fromkeys(left))  # of the repeated row one stays
        elif name == "decontaminate":
            left = [r for r, c in zip(left, fx.contamination(left, [(1, item)])) if not c[2]]
        elif name == "mix":
            taken = ids(out)
            assert set(taken) <= {r[0] for r in left} and max(taken.count(i) for i in set(taken)) <= 2
            words = sum(len(fx.space_words(r["text"])) for r in out.select("text").collect())
            total = sum(len(fx.space_words(r[1])) for r in left)
            assert 1.1 * total < words < 1.9 * total  # whole documents, so only near 1.5
            continue
        else:
            assert ids(out) == taken and out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
            continue
        assert out.columns == docs.columns
        assert ids(out) == sorted((r[0] for r in left), key=repr), name


def test_one_of_each_group_stays_under_repeated_and_null_ids(spark):
    """Near-copies of different text that share an id, or have none, are one group of which one stays."""
    words = [f"w{i}" for i in range(60)]
    copies = [" ".join([*words, f"end{k}"]) for k in range(4)]
    other = " ".join(f"x{i}" for i in range(40))
    rows = [(7, copies[0]), (7, copies[1]), (7, copies[1]), (None, copies[2]), (9, copies[3])]
    rows += [(None, other), (None, other + " y"), (None, " ".join(f"z{i}" for i in range(30))), (7, "no copy of any " * 5), (8, None), (8, None)]
    docs = fx.frame(spark, [(i, t, "en", "s") for i, t in rows])
    out = cp.near_duplicate_stage(spark, docs, SF)
    left = [(r["doc_id"], r["text"]) for r in out.collect()]
    group = [r for r in left if r[1] in copies]
    assert len(group) == 1 and group[0] in ((7, copies[0]), (7, copies[1]))
    assert len([r for r in left if r[1] in (other, other + " y")]) == 1
    assert len(left) == 6 and left.count((8, None)) == 2
    assert out.columns == docs.columns


def test_stages_on_an_empty_table(spark, no_docs, tmp_root):
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(f"{tmp_root}/benchmark.parquet")
    for _, stage in cp.STAGES:
        assert stage(spark, no_docs, tmp_root).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = REGISTRY[name](spark, SF)
    expected = con.execute(ORACLE[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(expected.fetchall())


def test_run_keeps_every_decision(spark):
    out = cp.run(spark, SF)
    assert out.count() > 0
    assert out.groupBy("shard").agg(F.max("slot").alias("m"), F.count("*").alias("n")).where("m <> n - 1").count() == 0
