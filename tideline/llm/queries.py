"""Registered queries of the operators here: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import documents

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def add(fn):
        REGISTRY[name] = fn
        return fn

    return add


@query("op1_decontaminate")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.decontaminate import decontaminate

    out = decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


ORACLE["op1_decontaminate"] = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
item_words as (
  select distinct item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
item_windows as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as win
  from (select item_id, w, least(10, len(w)) as n, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i
        from item_words where len(w) > 0)),
doc_windows as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
        from words, (select distinct n from item_windows) where len(w) >= n)),
hits as (
  select d.doc_id, d.i, d.n, x.item_id from doc_windows d join item_windows x on d.n = x.n and d.win = x.win),
covered as (
  select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(i, i + n)) as pos from hits) group by doc_id),
items as (
  select doc_id, count(distinct item_id) as n_items, list_sort(list(distinct cast(item_id as varchar))) as items
  from hits group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join covered using (doc_id) left join items using (doc_id)
"""


@query("op3_near_duplicates")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.neardup import near_duplicates

    return near_duplicates(documents(spark, sf_dir)).drop("text_hash", "chosen")


ORACLE["op3_near_duplicates"] = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as c
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select x, y from common join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 85 * (p.n + q.n - c)),
edges as (select x, y from links union all select y, x from links),
reach as (select distinct x as doc_id, x as root from edges
          union select r.doc_id, e.y from reach r join edges e on e.x = r.root),
roots as (select doc_id, min(root) as root from reach group by doc_id)
select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, coalesce(root, doc_id) as component_id,
       coalesce(root, doc_id) = doc_id as kept
from words left join sizes using (doc_id) left join roots using (doc_id)
"""


@query("op9_mix")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.mixing import mix

    taken, _ = mix(documents(spark, sf_dir))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


@query("op10_shard")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.sharding import shard

    return shard(documents(spark, sf_dir))


@query("op6_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.quality import quality

    return quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


@query("op7_licenses")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.licenses import scan

    return scan(documents(spark, sf_dir)).drop("spans")


def _license_sql() -> str:
    from tideline.llm.licenses import TEMPLATES, THRESHOLD, known_templates

    rows = ", ".join(f"({t}, '{name}', '{b}', {c}, {has.total()})"
                     for t, (name, has) in enumerate(known_templates(TEMPLATES)) for b, c in has.items())
    return rf"""
with templates(t, name, b, c, l) as (values {rows}),
words as (select doc_id, row_number() over () as r,
                 regexp_extract_all(lower(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9]', ' ', 'g')), '[a-z0-9]+') as w from documents),
bigrams as (select r, len(w) - 1 as n, unnest(range(0, len(w) - 1)) as p,
                   unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as b from words where len(w) > 1),
hits as (select r, n, t, l, p, b, c, least(l, n) as z from bigrams join templates using (b)),
starts as (select distinct r, t, l, z, least(p, n - z) as s from hits),
counted as (select x.r, x.t, x.l, x.z, x.s, h.b, least(count(*), any_value(h.c)) as k
            from starts x join hits h on h.r = x.r and h.t = x.t and h.p >= x.s and h.p < x.s + x.z group by all),
matches as (select r, t, l, z, s, cast(sum(k) as bigint) as k from counted group by all having 200 * sum(k) >= {THRESHOLD} * (z + l)),
chains as (select *, sum(apart) over (partition by r, t order by s) as chain from (
  select *, case when s - lag(s) over (partition by r, t order by s) < z then 0 else 1 end as apart from matches)),
best as (select * from chains qualify row_number() over (partition by r, t, chain order by k desc, s) = 1),
found as (select r, t, 2 * k / (z + l) as dice from best a where not exists (
  select 1 from best b where b.r = a.r and b.s <= a.s + (a.z - 1) // 2 and a.s + (a.z - 1) // 2 < b.s + b.z
                         and b.k * (a.z + a.l) > a.k * (b.z + b.l))),
per_doc as (select r, count(*) as n_matched, array_to_string(list_sort(list(distinct name)), ',') as licenses,
                   max(round(dice, 6)) as best_dice from found join (select distinct t, name from templates) using (t) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_matched, 0) as bigint) as n_matched,
       coalesce(licenses, '') as licenses, coalesce(best_dice, 0.0) as best_dice
from words left join per_doc using (r)
"""


ORACLE["op7_licenses"] = _license_sql()


@query("op8_urls")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.urls import judge_urls

    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op5_ctw")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.ctw import DEPTH, score

    return score(documents(spark, sf_dir), depth=DEPTH)


def _of(kind: str):
    return lambda span: span["kind"] == kind


@query("op4_pii")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.pii import KINDS, find_pii

    out = find_pii(documents(spark, sf_dir))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    return out.withColumn("base", base).select(
        "doc_id", *[F.size(F.filter("base", _of(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


@query("op2_repeats")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.repeats import dedup_repeats

    rows, texts = dedup_repeats(documents(spark, sf_dir))
    cut = texts.select("t1", "t2", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha")).distinct()
    return rows.join(cut, ["t1", "t2"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("sha", "text_sha256").alias("kept_sha256"))


@query("op11_manifest")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.manifest import manifest

    return manifest(documents(spark, sf_dir)).drop("lang")


def _field_sql(c: str) -> str:
    return f"coalesce(cast(strlen(cast({c} as varchar)) as varchar) || ':' || cast({c} as varchar), '-')"


ORACLE["op11_manifest"] = rf"""
with recursive rows as (
  select row_number() over () as r, doc_id, lang, {_field_sql('doc_id')} || {_field_sql('source')} || {_field_sql('lang')} as head,
         n_chars, {_field_sql('text')} as tail,
         list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::UBIGINT)),
           lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda i: i::UBIGINT)),
             lambda x, i: xor(x >> 1, (x & 1::UBIGINT) * 3988292384::UBIGINT))) as crc
  from documents),
hashed as (
  select r, doc_id, lang, sha256(head || {_field_sql('n_chars')} || tail) as leaf,
         sha256(head || {_field_sql('(n_chars + 1)')} || tail) as changed, coalesce(xor(crc, 4294967295::UBIGINT) % 7 = 0, false) as picked
  from rows),
leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as slot from hashed),
nodes as (
  select lang, 0 as level, slot, leaf as h, count(*) over (partition by lang) as n from leaves
  union all
  select lang, level + 1, slot // 2, sha256(string_agg(h, '' order by slot)), any_value((n + 1) // 2)
  from nodes where n > 1 group by lang, level, slot // 2),
subroots as (
  select lang, h as subroot, row_number() over (order by encode(lang) nulls first) - 1 as rank from nodes where n = 1),
tops as (
  select 0 as level, rank as slot, subroot as h, count(*) over () as n from subroots
  union all
  select level + 1, slot // 2, sha256(string_agg(h, '' order by slot)), any_value((n + 1) // 2) from tops where n > 1 group by level, slot // 2),
places as (
  select l.*, s.rank, s.subroot from leaves l join subroots s on l.lang is not distinct from s.lang),
runs as (
  select p.r, 0 as part, n.level, p.slot >> n.level as mine, n.slot as spot, n.h
  from places p join nodes n on n.lang is not distinct from p.lang and n.n > 1 and n.slot // 2 = (p.slot >> n.level) // 2
  union all
  select p.r, 1, t.level, p.rank >> t.level, t.slot, t.h
  from places p join tops t on t.n > 1 and t.slot // 2 = (p.rank >> t.level) // 2),
steps as (
  select r, row_number() over (partition by r order by part, level) as k, max(h) filter (where spot <> mine) as sibling, any_value(mine % 2) as odd
  from runs group by r, part, level),
folds as (
  select r, 0 as k, case when picked and n_chars is not null then changed else leaf end as h from places join rows using (r)
  union all
  select f.r, f.k + 1, sha256(case when sibling is null then f.h when odd = 1 then sibling || f.h else f.h || sibling end)
  from folds f join steps s on s.r = f.r and s.k = f.k + 1),
proofs as (select r, sha256(coalesce(string_agg(sibling, '' order by k), '')) as proof_sha256, max(k) as steps from steps group by r)
select p.doc_id, p.slot, leaf, subroot, t.h as root, coalesce(proof_sha256, sha256('')) as proof_sha256,
       f.h as folded_root, f.h = t.h as verified
from places p left join proofs q using (r) join tops t on t.n = 1 join folds f on f.r = p.r and f.k = coalesce(q.steps, 0)
"""


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.whitening import whiten

    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op12_extraction")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tideline.llm.extraction import extract

    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
