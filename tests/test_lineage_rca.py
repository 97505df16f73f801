"""Lineage closure, baselines and root-cause analysis."""

from pyspark.sql import functions as F

from tideline.operators.baseline import anomalies, baseline
from tideline.operators.lineage import all_downstream, closure, direct_downstream, listing
from tideline.operators.rca import analyze
from tideline.sources.lineage import LineageGraph
from tideline.sources.store import RESULT_SCHEMA

GRAPH = [
    {"dataset": "a", "upstream": ["c"]},
    {"dataset": "b", "upstream": ["a"]},
    {"dataset": "c", "upstream": ["b"]},
    {"dataset": "top", "upstream": []},
    {"dataset": "left", "upstream": ["top"]},
    {"dataset": "right", "upstream": ["top", "ghost"]},
    {"dataset": "bottom", "upstream": ["left", "right"], "critical_columns": ["k"]},
]


def _pairs(df, a="dataset", b="upstream"):
    return {(r[a], r[b], r["depth"]) for r in df.collect()}


def test_closure_cycle_diamond_and_undeclared(spark):
    g = LineageGraph.from_records(spark, GRAPH)
    up = _pairs(closure(g))
    assert {("a", "c", 1), ("a", "b", 2), ("a", "a", 3)} <= up  # a cycle reaches itself
    assert ("bottom", "top", 2) in up and ("bottom", "ghost", 2) in up
    assert not any(d == "top" for d, _, _ in up)
    down = _pairs(all_downstream(g), "dataset", "downstream")
    assert ("top", "bottom", 2) in down and ("ghost", "right", 1) in down
    seeded = _pairs(all_downstream(g, seeds=spark.createDataFrame([("top",)], "d string")), "dataset", "downstream")
    assert seeded == {("top", "left", 1), ("top", "right", 1), ("top", "bottom", 2)}
    unknown = closure(g).where(F.col("dataset") == "nope")
    assert unknown.count() == 0


def test_listing_and_direct_downstream(spark):
    g = LineageGraph.from_records(spark, GRAPH)
    rows = {r.dataset: r for r in listing(g).collect()}
    assert rows["top"].is_source and rows["top"].feeds_into == "left, right"
    assert rows["right"].depends_on == "top, ghost" and not rows["right"].is_source
    assert {(r.dataset, r.downstream) for r in direct_downstream(g).collect()} >= {("ghost", "right")}


def _res(spark, rows):
    full = [(r[0], r[1], r[2], r[3], r[4], r[5], float(r[6]), "t", r[7]) for r in rows]
    df = spark.createDataFrame(full, "run_id string, dataset string, partition string, check_name string, "
                                     "check_type string, passed boolean, metric_value double, threshold string, "
                                     "ts string")
    return df.withColumn("timestamp", F.col("ts").cast("timestamp_ntz")).drop("ts").select(*RESULT_SCHEMA.fieldNames())


def test_baseline_window_edges(spark):
    rows = [("r1", "u", f"p{i:02d}", "volume_check", "volume", True, i, "2024-01-01 00:00:00") for i in range(40)]
    b = {r.partition: r for r in baseline(_res(spark, rows)).collect()}
    assert b["p00"].baseline_rows == 0 and b["p00"].baseline_mean is None
    assert b["p01"].baseline_rows == 1 and b["p01"].baseline_mean == 0.0
    assert b["p39"].baseline_rows == 30 and b["p39"].baseline_max == 38.0 and b["p39"].baseline_mean == 23.5
    # a second run of the same partitions must not leak same-partition peers in
    rows2 = rows + [("r2", "u", f"p{i:02d}", "volume_check", "volume", True, 100 + i, "2024-01-02 00:00:00")
                    for i in range(40)]
    b2 = {r.partition: r for r in baseline(_res(spark, rows2)).collect()}
    assert b2["p01"].baseline_rows == 2 and b2["p01"].baseline_max == 100.0
    assert b2["p39"].baseline_rows == 30 and b2["p39"].baseline_max == 138.0
    an = {(r.run_id, r.partition) for r in anomalies(_res(spark, rows2)).collect()}
    assert ("r2", "p00") not in an and ("r2", "p05") in an


def test_rca_branches(spark):
    g = LineageGraph.from_records(spark, [
        {"dataset": "src", "upstream": []},
        {"dataset": "mid", "upstream": ["src"], "critical_columns": ["k"]},
        {"dataset": "out", "upstream": ["mid"]},
    ])
    ts = "2024-01-01 00:00:00"
    rows = [
        # p1: src fails on a non-critical column only -> no upstream cause, and no baseline check either
        ("r", "src", "p1", "null_rate_other", "null_check", False, 0.5, ts),
        ("r", "mid", "p1", "volume_check", "volume", False, 3, ts),
        # p2: src fails on a critical column -> upstream cause
        ("r", "src", "p2", "null_rate_k", "null_check", False, 0.4, ts),
        ("r", "mid", "p2", "volume_check", "volume", False, 3, ts),
        # p3: src clean but anomalous vs its baseline -> baseline cause
        ("r", "src", "p0", "volume_check", "volume", True, 10, ts),
        ("r", "src", "p3", "volume_check", "volume", True, 50, ts),
        ("r", "mid", "p3", "volume_check", "volume", False, 3, ts),
    ]
    a = analyze(_res(spark, rows), g)
    causes = {(r.dataset, r.partition, r.cause_dataset, r.kind, r.confidence) for r in a.causes.collect()}
    assert ("src", "p1", "src", "source", 0.95) in causes
    assert ("mid", "p1", "mid", "self", 0.75) in causes
    assert ("mid", "p2", "src", "upstream", 0.9) in causes
    assert ("mid", "p3", "src", "baseline", 0.7) in causes
    impact = {(r.dataset, r.impacted_dataset, r.depth) for r in a.impact.collect()}
    assert ("src", "out", 2) in impact and ("mid", "out", 1) in impact
    recs = [r.recommendation for r in a.recommendations.where("dataset = 'mid' and partition = 'p2'")
            .orderBy("rec_no").collect()]
    assert recs[0] == "Verify data ingestion for mid - possible incomplete load"
    assert recs[1] == "Check src - null_rate_k failed (value: 0.4000)"
    m = {r.partition: r.estimated_mttr for r in a.mttr.where("dataset = 'mid'").collect()}
    assert m == {"p1": 15, "p2": 15, "p3": 15}


def test_closure_round_spans_agree(spark):
    chain = [{"dataset": f"n{i}", "upstream": [f"n{i - 1}"]} for i in range(1, 12)]
    shortcut = [{"dataset": "n12", "upstream": ["n11", "n2"]}]  # a short and a long path to n12
    g = LineageGraph.from_records(spark, GRAPH + chain + shortcut)
    one = _pairs(closure(g, hops=1))
    assert ("n12", "n2", 1) in one and ("n12", "n0", 3) in one
    for k in (2, 3, 4):
        assert _pairs(closure(g, hops=k)) == one, k
    seeds = spark.createDataFrame([("n0",), ("top",)], "d string")
    a = _pairs(closure(g, seeds=seeds, direction="down", hops=4), "dataset", "downstream")
    b = _pairs(closure(g, seeds=seeds, direction="down", hops=1), "dataset", "downstream")
    assert a == b and ("n0", "n11", 11) in a and ("n0", "n12", 3) in a


def test_lineage_from_json_lines(spark, tmp_root):
    import json

    path = tmp_root.replace("file:", "") + ".jsonl"
    with open(path, "w") as fh:
        for r in [{"dataset": "orders_raw", "upstream": []},
                  {"dataset": "revenue_daily", "upstream": ["orders_raw", "products"],
                   "critical_columns": ["product_id", "amount"], "description": "Daily revenue"}]:
            fh.write(json.dumps(r) + "\n")
    g = LineageGraph.from_json(spark, path)
    assert [(r.dataset, r.upstream, r.ord) for r in g.edges.orderBy("ord").collect()] == [
        ("revenue_daily", "orders_raw", 0), ("revenue_daily", "products", 1)]
    assert [r.column for r in g.critical.orderBy("ord").collect()] == ["product_id", "amount"]
    rows = {r.dataset: r for r in listing(g).collect()}
    assert rows["orders_raw"].is_source and rows["orders_raw"].feeds_into == "revenue_daily"


def test_rca_options_latest_run_and_error_free_baseline(spark):
    g = LineageGraph.from_records(spark, [{"dataset": "src", "upstream": []},
                                          {"dataset": "out", "upstream": ["src"]}])
    rows = [
        ("r1", "src", "p1", "volume_check", "volume", False, 1, "2024-01-01 00:00:00"),   # old failure
        ("r2", "src", "p1", "volume_check", "volume", True, 100, "2024-01-02 00:00:00"),  # re-check passed
        ("r2", "out", "p1", "volume_check", "volume", False, 3, "2024-01-02 00:00:00"),
    ]
    res = _res(spark, rows)
    fails = res.where("dataset = 'out'")
    every = {(r.cause_dataset, r.kind) for r in analyze(res, g, failures=fails).causes.collect()}
    assert every == {("src", "upstream")}
    latest = {(r.cause_dataset, r.kind)
              for r in analyze(res, g, failures=fails, upstream_runs="latest").causes.collect()}
    assert latest == {("out", "self")}
    err = [("r", "u", f"p{i}", "c", "t", True, v, "2024-01-01 00:00:00") for i, v in enumerate([5, -1, 5])]
    keep = {r.partition: r.baseline_mean for r in baseline(_res(spark, err)).collect()}
    drop = {r.partition: r.baseline_mean for r in baseline(_res(spark, err), exclude_errors=True).collect()}
    assert keep["p2"] == 2.0 and drop["p2"] == 5.0 and "p1" not in drop


def test_lineage_from_one_document(spark, tmp_root):
    import json

    document = {"datasets": {"b": {"upstream": ["a"], "critical_columns": ["k"]}, "a": {"upstream": []}, "c": {"upstream": ["b", "a"]}}}
    path = tmp_root.replace("file:", "") + ".json"
    with open(path, "w") as fh:
        json.dump(document, fh, indent=2)
    g = LineageGraph.from_json(spark, path)
    assert [(r.dataset, r.upstream, r.ord) for r in g.edges.orderBy("dataset", "ord").collect()] == [
        ("b", "a", 0), ("c", "b", 0), ("c", "a", 1)]
    assert [r.dataset for r in g.datasets.orderBy("decl_ord").collect()] == ["b", "a", "c"]
    assert [(r.dataset, r.column) for r in g.critical.collect()] == [("b", "k")]


def test_closure_has_no_depth_limit_and_takes_seeds(spark):
    from tideline.operators.lineage import all_upstream

    chain = [{"dataset": f"n{i}", "upstream": [f"n{i + 1}"]} for i in range(9)]
    g = LineageGraph.from_records(spark, chain)
    seed = spark.createDataFrame([("n2",)], "dataset string")
    assert sorted((r.dataset, r.upstream, r.depth) for r in all_upstream(g, seed).collect()) == [
        ("n2", f"n{i}", i - 2) for i in range(3, 10)]
    assert all_upstream(g).count() == 45
