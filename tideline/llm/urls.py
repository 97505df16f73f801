"""URL filters: rules by host and path, and trust carried over host links, with DataFrame functions only.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
there up to ``?``, ``#`` or the end.  Without ``://`` both are empty.

A rule ``(verdict, host, path)`` fits its host and all subdomains where the path starts with the
rule's; the longest rule that fits decides.  Other urls are judged by their host:

* links between hosts come from the ``href`` attributes of the pages (absolute ones; a host's
  links to itself don't count), weighted by the number of pages that have them;
* trust is a personalised PageRank along the links, which starts from the hosts of allowed
  pages; distrust is one against the links, which starts from the hosts of blocked pages, so that who
  links to bad hosts is distrusted too.  Both start in proportion to pages; a host without
  links gives its rank back to the start;
* a host with ``distrust / (distrust + trust) >= THRESHOLD`` is blocked, any other is allowed.

The rules are a short list, made into an expression.  Ranks are tables of hosts, written to the
shared folder each round, until a round moves less than ``EPSILON`` in all; the damping bounds the rounds (some 90) and with
them the reach: a host is judged by seeds up to that many links away.

Edge cases: null urls and html are empty: no rule, no link, allowed.  Repeated rows count again.
Without allowed or blocked pages that rank is zero everywhere.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import materialize, pick, small

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
DAMPING = 0.85
THRESHOLD = 0.9
EPSILON = 1e-6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = "://([^/?#]*)([^?#]*)"
HREF = "(?i)href\\s*=\\s*[\"']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\\s<>]+)"


def apply_rules(rules=RULES) -> tuple[Column, Column]:
    """The rule that decides on ``host`` and ``path``, and its verdict; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """``a`` links to ``b`` from ``pages`` pages of it."""
    targets = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(HREF), F.lit(1)),
                                           lambda h: F.translate(h, UPPER, LOWER)))
    return (pages.where("host <> ''").select(F.col("host").alias("a"), F.explode(targets).alias("b"))
            .where("a <> b and b <> ''").groupBy("a", "b").agg(F.count("*").alias("pages")))


def ranks(links: DataFrame, seeds: DataFrame, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank: ``kind, host, rank`` for the ``seeds`` (``kind, host, start``).

    ``links`` has ``kind, a, b, weight``, the weights of each ``(kind, a)`` summing up to 1.
    """
    seeds = materialize(seeds, "ranks")
    now = seeds.select("kind", "host", F.col("start").alias("rank"))
    while True:  # a round moves at most DAMPING times what the one before did
        sent = (now.join(links, (links["kind"] == now["kind"]) & (links["a"] == now["host"]))
                .groupBy(links["kind"], F.col("b").alias("host")).agg(F.sum(F.col("rank") * F.col("weight")).alias("got")))
        sent = materialize(sent, "ranks")
        moved = {r["kind"]: r["got"] for r in sent.groupBy("kind").agg(F.sum("got").alias("got")).collect()}  # two rows
        back = F.lit(1.0)  # what is not passed on goes to the start
        for kind, got in moved.items():
            back = F.when(F.col("kind") == kind, F.lit(1.0 - damping * got)).otherwise(back)
        after = (seeds.select("kind", "host", (F.col("start") * back).alias("rank"))
                 .unionByName(sent.select("kind", "host", (F.col("got") * damping).alias("rank")))
                 .groupBy("kind", "host").agg(F.sum("rank").alias("rank")))
        after = materialize(after, "ranks")
        change = (after.unionByName(now.select("kind", "host", (-F.col("rank")).alias("rank")))
                  .groupBy("kind", "host").agg(F.abs(F.sum("rank")).alias("d")).agg(F.sum("d")).first()[0])
        now = after
        if (change or 0.0) < EPSILON:
            return now


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES) -> DataFrame:
    """One row for each page: ``page_id, host, path, rule, verdict, trust, distrust``."""
    url = F.coalesce("url", F.lit(""))
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col).select(
        "page_id", "html", F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, PARTS, 2).alias("path"))
    rule, verdict = apply_rules(rules)
    judged = rows.withColumn("rule", rule).withColumn("by_rule", verdict)

    links = materialize(host_links(rows), "links")
    both = (links.select(F.lit("allow").alias("kind"), "a", "b", "pages")
            .unionByName(links.select(F.lit("block").alias("kind"), F.col("b").alias("a"), F.col("a").alias("b"), "pages")))
    out = both.groupBy("kind", "a").agg(F.sum("pages").alias("all"))
    both = materialize(both.join(out, ["kind", "a"]).select("kind", "a", "b", (F.col("pages") / F.col("all")).alias("weight")), "links")
    counts = materialize(judged.where("by_rule is not null and host <> ''").groupBy(F.col("by_rule").alias("kind"), "host")
                         .agg(F.count("*").alias("n")), "seeds")
    totals = {r["kind"]: r["n"] for r in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}  # two rows
    share = F.lit(None).cast("double")
    for kind, n in totals.items():
        share = F.when(F.col("kind") == kind, F.col("n") / n).otherwise(share)
    seeds = counts.select("kind", "host", share.alias("start"))
    by_host = ranks(both, seeds).groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "allow", F.col("rank"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "block", F.col("rank"))), F.lit(0.0)).alias("distrust"))
    by_host = small(materialize(by_host, "hosts"))
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    bad = (distrust > 0) & (distrust >= THRESHOLD * (distrust + trust))
    return judged.drop("html").join(by_host, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"))
