"""Print the physical plans of the headline queries (for docs/PLANS.md).

usage: python tools/plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import functions as F

    from tideline.operators.baseline import baseline
    from tideline.operators.checks import ReferentialCheck, orphan_rows
    from tideline.plans import fixtures as fx
    from tideline.plans.fused import check_results
    from tideline.plans.partitioned import check_partitions
    from tideline.operators.lineage import _Levels, all_upstream
    from tideline.operators.rca import analyze
    from tideline.queries import REGISTRY, raw_on_disk
    from tideline.session import local_session, scratch_dir
    from tideline.sources.datasets import read_dataset
    from tideline.sources.partitions import list_partitions, new_partitions, partitions_frame
    from tideline.sources.store import ResultStore, checkpoints_from_results

    spark = local_session()
    root = raw_on_disk(spark, sf)
    store = ResultStore(spark, scratch_dir(spark, "plans-store"))
    store.update_checkpoints(checkpoints_from_results(store.written(store.save_results(fx.res(spark, sf)))))
    graph = fx.lineage(spark, sf)
    rounds = _Levels(spark, bucket_pairs=1)
    rounds.add(graph.edges.selectExpr("dataset as __a", "upstream as __b", "1 as __d").distinct(), 1)
    onward = rounds.files[0].alias("x").join(rounds.steps[0].alias("y"), F.expr("x.__b = y.__a")).selectExpr("x.__a", "y.__b", "2 as __d")
    shown = {
        "Fused checks on an on-disk dataset after the watermark (dt > 2024-01-20)": check_results(
            read_dataset(spark, root).where("dt > '2024-01-20'"), fx.order_checks(fx.ref(spark, sf)),
            dataset=fx.ORDERS, run_id="r"),
        "Fused checks with the referential check forced onto the shuffle path": check_results(
            fx.bad(spark, sf), fx.order_checks(fx.ref(spark, sf)), dataset=fx.ORDERS, run_id="r", broadcast_rows=0),
        "Revenue roll-up": fx.rev(spark, sf),
        "Three large references in one further scan": REGISTRY["check_three_references"](spark, sf),
        "New partitions after the mark": new_partitions(
            partitions_frame(spark, list_partitions(spark, root)), store.checkpoints(), fx.ORDERS),
        "Latest results of the store": store.results(),
        "Root causes of a stored run": analyze(store.results(), fx.reference_lineage(spark),
                                               failures=store.results().where("not passed")).causes,
        "All upstream datasets": all_upstream(graph),
        "A closure round on bucketed pairs: nothing is exchanged under the known sides": rounds.unknown(onward),
        "Null-rate and volume checks from footers": check_partitions(
            spark, root, [c for c in fx.order_checks(fx.ref(spark, sf)) if c.check_type in ("null_check", "volume")],
            dataset=fx.ORDERS, partitions=list_partitions(spark, root), run_id="r"),
        "Baselines of a long history, in blocks with halo rows": baseline(store.results(), block_rows=50),
        "Orphan rows (C4)": orphan_rows(fx.bad(spark, sf), ReferentialCheck("product_id", fx.ref(spark, sf))),
    }
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `python tools/plans.py {sf}` (local[*], AQE on; the plans are the initial")
    print("adaptive plans before runtime re-optimisation).\n")
    for title, df in shown.items():
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        keep = [line for line in text.splitlines()
                if not line.startswith(("Arguments:", "Input ["))]
        print(f"## {title}\n\n```")
        print("\n".join(keep).replace(root, "<orders_raw>").replace(sf, "<sf>"))
        print("```\n")


if __name__ == "__main__":
    main()
