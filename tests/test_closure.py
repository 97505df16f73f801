"""Closure by doubling rounds, plain and bucketed, against a breadth-first search."""

import random
import re
from collections import deque

import pytest

from tideline.operators import lineage
from tideline.operators.lineage import closure
from tideline.sources.lineage import LineageGraph


def graph(spark, ups):
    return LineageGraph.from_records(spark, [{"dataset": d, "upstream": u} for d, u in ups.items()])


def search(ups, roots=None):
    out = set()
    for root in ups if roots is None else roots:
        seen, queue = {}, deque((u, 1) for u in ups.get(root, ()))
        while queue:
            at, d = queue.popleft()
            if at not in seen:
                seen[at] = d
                queue.extend((u, d + 1) for u in ups.get(at, ()))
        out |= {(root, at, d) for at, d in seen.items()}
    return out


def random_graph(seed, n, edges):
    r = random.Random(seed)
    ups = {f"d{i}": [] for i in range(n)}
    for _ in range(edges):
        ups[f"d{r.randrange(n)}"].append(f"d{r.randrange(n + 3)}")
    return {k: list(dict.fromkeys(v)) for k, v in ups.items()}


@pytest.mark.parametrize("bucket_pairs", [1, lineage.BUCKET_PAIRS])
def test_closure_against_search(spark, bucket_pairs):
    ups = random_graph(3, 40, 55)
    g = graph(spark, ups)
    got = closure(g, bucket_pairs=bucket_pairs)
    assert {tuple(r) for r in got.collect()} == search(ups)
    assert got.count() == len(search(ups))
    assert not [t for t in spark.catalog.listTables() if "closure" in t.name]  # the catalog is left as it was
    seeds = spark.createDataFrame([("d1",), ("d2",), ("nope",)], "d string")
    assert {tuple(r) for r in closure(g, seeds, bucket_pairs=bucket_pairs).collect()} == search(ups, ["d1", "d2"])


def test_a_long_cycle_takes_few_rounds(spark, monkeypatch):
    n, rounds = 150, []
    g = graph(spark, {f"d{i}": [f"d{(i + 1) % n}"] for i in range(n)})
    add = lineage._Levels.add
    monkeypatch.setattr(lineage._Levels, "add", lambda self, *a: rounds.append(1) or add(self, *a))
    got = closure(g)
    assert len(rounds) == 9  # reaches 1, 2, 4, ... 256
    assert got.count() == n * n and got.where(f"depth = {n} and dataset = upstream").count() == n


def test_a_long_chain_from_a_seed(spark, monkeypatch):
    monkeypatch.setattr(lineage, "PATIENCE", 3)
    n, rounds = 60, []
    ups = {f"d{i}": [f"d{i + 1}"] for i in range(n)}
    add = lineage._Levels.add
    monkeypatch.setattr(lineage._Levels, "add", lambda self, *a: rounds.append(1) or add(self, *a))
    got = closure(graph(spark, ups), spark.createDataFrame([("d0",)], "d string"))
    assert {(r.upstream, r.depth) for r in got.collect()} == {(f"d{i}", i) for i in range(1, n + 1)}
    assert len(rounds) < 25


def test_known_pairs_are_not_moved(spark):
    """In the anti join with a bucketed round, only the new pairs are exchanged."""
    every = lineage._Levels(spark, 1)
    every.add(spark.range(50).selectExpr("cast(id as string) as __a", "cast(id + 1 as string) as __b", "1 as __d"), 1)
    found = spark.range(9).selectExpr("cast(id as string) as __a", "cast(id + 2 as string) as __b", "2 as __d")
    plan = every.unknown(found)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"FileScan parquet .*closure_buckets.*Bucketed: true", plan)
    assert plan.count("Exchange hashpartitioning") == 1  # the new pairs, for their smallest depth
    every.close()


def test_pages_of_a_hub_are_its_list(spark):
    """A hub of 5,000 neighbours: pages of at most 100 names that join to the one-row listing."""
    ups = {"hub": [f"u{i}" for i in range(250)]} | {f"d{i}": ["hub"] for i in range(5000)} | {"alone": []}
    g = graph(spark, ups)
    pages = lineage.listing_pages(g, size=100).collect()
    assert max(p.n_names for p in pages) <= 100
    joined = {}
    for p in sorted(pages, key=lambda p: (p.dataset, p.list, p.page)):
        joined.setdefault((p.dataset, p.list), []).append(p.names)
    assert [p.page for p in sorted(pages, key=lambda p: p.page) if (p.dataset, p.list) == ("hub", "feeds_into")] == list(range(1, 52))
    for row in lineage.listing(g).collect():
        assert ", ".join(joined.get((row.dataset, "depends_on"), [])) == row.depends_on
        assert ", ".join(joined.get((row.dataset, "feeds_into"), [])) == row.feeds_into
