"""License scans by the Dice coefficient over word bigrams, with DataFrame functions only.

Text is normalised: everything but ASCII letters and digits separates words, A-Z are
lower-cased, so line ends, comment signs and punctuation don't matter.  Each template (a licence's body, its standard
header or a short notice) of ``L`` bigrams is compared with the windows of ``L`` bigrams, over the whole
text, that begin at one of its bigrams, and with the last window; a text of fewer bigrams is one window.  (A window that
begins elsewhere has no bigram of the template more than the next of these, so no match is missed.)
Bigrams count as often as they occur: a window of ``W`` bigrams that shares ``I`` with the template matches if
``100 * 2 * I >= THRESHOLD * (W + L)``.

Candidates: a match shares at least ``t * L / (2 - t)`` bigrams, so a template is dropped for the texts that have too few
distinct ones of it.  Of the others only the places of template bigrams are kept.  The place ``p`` of a bigram
that the template has ``c`` times counts for the windows that begin at or before ``p``, reach it and begin after its ``c``-th last place
before; the sum of these intervals, taken along the text, is ``I`` for each window.

Matching windows of one template that overlap in a chain are one finding, of which the best window (the first of these)
stands; it is left out where the middle of it lies in a better finding of another template.  Ties all stay.

Edge cases: null or empty text, or one word, has no finding.  Rows that repeat an id are judged one by one.  Templates
without a bigram never match; without any template nothing is found.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import materialize, pick, small
from tideline.llm.license_texts import TEMPLATES

THRESHOLD = 80  # per cent


def template_bigrams(text: str) -> Counter:
    words = re.findall("[a-z0-9]+", text.lower())
    return Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def known_templates(templates: Mapping[str, tuple[str, ...] | str]) -> list[tuple[str, Counter]]:
    """Licence and counted bigrams of each template that has some."""
    texts = [(name, text) for name, all_of in sorted(templates.items()) for text in ([all_of] if isinstance(all_of, str) else all_of)]
    return [(name, bigrams) for name, text in texts if (bigrams := template_bigrams(text))]


def fewest(bigrams: Counter, threshold: int) -> int:
    """How many distinct bigrams of the template a matching window has at the least."""
    shared, n = -(-threshold * bigrams.total() // (200 - threshold)), 0
    for c in sorted(bigrams.values(), reverse=True):
        if shared <= 0:
            break
        shared, n = shared - c, n + 1
    return n


def places(words: Column, vocabulary: list[str]) -> Column:
    """Where the bigrams of ``vocabulary`` stand: structs of ``p`` (from 0) and ``b``."""
    pairs = [b.split(" ") for b in vocabulary]
    firsts, seconds = sorted({a for a, _ in pairs}), sorted({b for _, b in pairs})

    def found(w: Column) -> Column:
        def two(i: Column) -> Column:
            return F.concat(F.get(w, i), F.lit(" "), F.get(w, i + 1))

        # most words of a text begin no bigram of a template, so few are put together
        at = F.filter(F.sequence(F.lit(0), F.size(w) - 2),
                      lambda i: F.get(w, i).isin(firsts) & F.get(w, i + 1).isin(seconds) & two(i).isin(vocabulary))
        return F.transform(at, lambda i: F.struct(i.alias("p"), two(i).alias("b")))

    return F.when(F.size(words) > 1, F.get(F.transform(F.array(words), found), F.lit(0)))


def windows(rows: DataFrame, table: DataFrame, threshold: int) -> DataFrame:
    """The matching windows: ``row, t, l, w`` (bigrams of template and window), ``s`` (its first bigram), ``shared``."""
    at = rows.select("row", "n", F.explode("near").alias("t"), "found").select("row", "n", "t", F.explode("found").alias("f"))
    at = at.select("row", "n", "t", "f.p", "f.b").join(F.broadcast(table), ["t", "b"])  # the table is as long as the templates
    same = at.groupBy("row", "n", "t", "l", "b", "c").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    last = F.greatest(F.col("n") - F.col("l"), F.lit(0))

    def steps(p: Column, i: Column) -> Column:
        before = F.coalesce(F.get("ps", F.when(i >= F.col("c"), i - F.col("c"))), F.lit(-1))
        first = F.greatest(before, p - F.col("l")) + 1

        def step(s: Column, change: int, judged: bool) -> Column:
            return F.struct(s.alias("s"), F.lit(change).alias("change"), F.lit(judged).alias("judged"))

        return F.array(step(first, 1, False), step(p + 1, -1, False), step(F.least(p, last), 0, True))

    sums = same.select("row", "n", "t", "l", F.explode(F.flatten(F.transform("ps", steps))).alias("e")).groupBy(
        "row", "t", "n", "l", "e.s").agg(F.sum("e.change").alias("change"), F.max("e.judged").alias("judged"))
    along = Window.partitionBy("row", "t").orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.least("l", "n")
    return sums.withColumn("shared", F.sum("change").over(along)).where(
        F.col("judged") & (200 * F.col("shared") >= threshold * (size + F.col("l")))).select(
        "row", "t", "l", size.alias("w"), "s", "shared")


def findings(matches: DataFrame, longest: int) -> DataFrame:
    """The best window of each chain, but for those whose middle lies in a better one."""
    along = Window.partitionBy("row", "t").orderBy("s")
    apart = F.coalesce(F.col("s") - F.lag("s").over(along) >= F.col("w"), F.lit(True))
    best = F.max(F.struct("shared", (-F.col("s")).alias("back")))
    chains = matches.withColumn("apart", apart).withColumn("chain", F.sum(F.col("apart").cast("int")).over(along))
    top = materialize(chains.groupBy("row", "t", "l", "w", "chain").agg(best.alias("best")).select(
        "row", "t", "l", "w", (-F.col("best.back")).alias("s"), "best.shared"), "chains")
    # a block has few findings of any template, since those of one template are apart
    a = top.withColumn("middle", F.expr("s + (w - 1) div 2")).withColumn("block", F.expr(f"middle div {longest}")).alias("a")
    b = top.withColumn("block", F.explode(F.expr(f"sequence(s div {longest}, (s + w - 1) div {longest})"))).alias("b")
    better = "b.s <= a.middle and a.middle < b.s + b.w and b.shared * (a.w + a.l) > a.shared * (b.w + b.l)"
    return a.join(b, F.expr(f"a.row = b.row and a.block = b.block and {better}"), "left_anti").select(
        "row", "t", "s", "w", (2 * F.col("shared") / (F.col("w") + F.col("l"))).alias("dice"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: Mapping[str, tuple[str, ...] | str] | None = None, threshold: int = THRESHOLD) -> DataFrame:
    """One row for each document: ``doc_id, n_words, n_matched, licenses, best_dice, spans``.

    ``n_matched`` are the findings, ``licenses`` their names, ``best_dice`` the greatest coefficient, 0 without any;
    ``spans`` their names and words (``name, start, stop``, the end exclusive).
    """
    known = known_templates(TEMPLATES if templates is None else templates)
    plain = F.trim(F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z0-9]+", " ")))
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", plain.alias("plain")).select(  # a column, so it is made once
        "doc_id", F.when(F.col("plain") == "", F.array().cast("array<string>")).otherwise(F.split("plain", " ")).alias("words"))
    none = F.array().cast("array<struct<name: string, start: bigint, stop: bigint>>")
    if not known:
        return rows.select("doc_id", F.size("words").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_matched"),
                           F.lit("").alias("licenses"), F.lit(0.0).alias("best_dice"), none.alias("spans"))
    table = docs.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("t"), F.lit(name).alias("name"), F.lit(b).alias("b"), F.lit(c).alias("c"), F.lit(has.total()).alias("l"))
        for t, (name, has) in enumerate(known) for b, c in has.items()])))
    vocabulary = sorted({b for _, has in known for b in has})
    bounds = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(fewest(has, threshold)).alias("least"),
                                F.array(*[F.lit(b) for b in sorted(has)]).alias("has")) for t, (_, has) in enumerate(known)])
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), places(F.col("words"), vocabulary).alias("found"))
    rows = rows.withColumn("kinds", F.array_distinct(F.transform("found", lambda f: f["b"])))
    near = F.filter(bounds, lambda t: (F.size("kinds") >= t["least"]) & (F.size(F.array_intersect("kinds", t["has"])) >= t["least"]))
    rows = rows.select("doc_id", "n_words", "found", F.transform(near, lambda t: t["t"]).alias("near"))
    rows = materialize(rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", (F.col("n_words") - 1).cast("int").alias("n"), "near",
        F.when(F.size("near") > 0, F.col("found")).alias("found")), "places")

    matches = windows(rows.where(F.size("near") > 0), table.drop("name"), threshold)
    found = findings(matches, max(has.total() for _, has in known)).join(
        F.broadcast(table.select("t", "name").distinct()), "t")
    per_row = small(materialize(found.groupBy("row").agg(
        F.count("*").alias("n_matched"), F.array_join(F.sort_array(F.collect_set("name")), ",").alias("licenses"),
        F.max(F.round("dice", 6)).alias("best_dice"), F.sort_array(F.collect_set(F.struct(
            "name", F.col("s").cast("long").alias("start"), (F.col("s") + F.col("w") + 1).cast("long").alias("stop")))).alias("spans")),
        "licenses"))
    return rows.select("row", "doc_id", "n_words").join(per_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_matched", F.lit(0)).cast("long").alias("n_matched"),
        F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("best_dice", F.lit(0.0)).alias("best_dice"),
        F.coalesce("spans", none).alias("spans"))
