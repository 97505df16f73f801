"""DuckDB SQL for every registered query (the correctness oracle).

The fixture views are re-declared here as CTEs over the raw tables, from the
same fixed values as ``tideline.plans.fixtures``; the texts of causes and
recommendations are those of ``tideline.operators.rca``.  No plan of this package
is run.
"""

from __future__ import annotations

from tideline.operators import rca
from tideline.plans import fixtures as fx

H = "((order_id * 7919 + 13) % 1000)"


def _ratio(num: str, den: str) -> str:
    return f"(CASE WHEN {den} = 0 THEN 0.0 ELSE CAST({num} AS DOUBLE) / {den} END)"


def _ts(ts: str) -> str:
    return f"TIMESTAMP '{ts}'"


def check_rows(run_id: str, ts: str, dataset: str, full: str, checks: list[tuple]) -> str:
    """UNION ALL of one SELECT per check over a ``full`` stats relation.

    ``checks`` items: (name, type, metric_sql, passed_sql, threshold_text).
    """
    parts = []
    for name, ctype, metric, passed, thr in checks:
        parts.append(
            f"SELECT '{run_id}' AS run_id, '{dataset}' AS dataset, dt AS \"partition\", "
            f"'{name}' AS check_name, '{ctype}' AS check_type, ({passed}) AS passed, "
            f"CAST({metric} AS DOUBLE) AS metric_value, '{thr}' AS threshold, {_ts(ts)} AS \"timestamp\" FROM {full}"
        )
    return "\nUNION ALL\n".join(parts)


def order_check_sql(run_id: str, ts: str, src: str, vol=fx.BAD_VOLUME) -> str:
    lo, hi = vol
    return check_rows(
        run_id,
        ts,
        fx.ORDERS,
        src,
        [
            ("null_rate_order_id", "null_check", _ratio("n0", "n"), f"{_ratio('n0', 'n')} <= 0.0", "0.0"),
            ("null_rate_product_id", "null_check", _ratio("n1", "n"), f"{_ratio('n1', 'n')} <= 0.05", "0.05"),
            ("null_rate_amount", "null_check", _ratio("n2", "n"), f"{_ratio('n2', 'n')} <= 0.05", "0.05"),
            ("volume_check", "volume", "n", f"n BETWEEN {lo} AND {hi}", f"{lo}-{hi}"),
            ("ref_integrity_product_id", "referential", _ratio("n4", "n"), f"{_ratio('n4', 'n')} = 0.0", "0.0"),
        ],
    )


def revenue_check_sql(run_id: str, ts: str, src: str, vol=fx.REV_VOLUME) -> str:
    lo, hi = vol
    return check_rows(
        run_id,
        ts,
        fx.REVENUE,
        src,
        [
            ("null_rate_total_revenue", "null_check", _ratio("n0", "n"), f"{_ratio('n0', 'n')} <= 0.0", "0.0"),
            ("null_rate_product_id", "null_check", _ratio("n1", "n"), f"{_ratio('n1', 'n')} <= 0.0", "0.0"),
            ("volume_check", "volume", "n", f"n BETWEEN {lo} AND {hi}", f"{lo}-{hi}"),
        ],
    )


def _faults() -> tuple[str, str]:
    """(product_id expression, row filter) of the fixture faults."""
    keep = []
    cases = []
    for f in fx.FAULTS:
        lim = f.rate * 1000
        if f.kind == "null_spike":
            cases.append(f"WHEN dt = '{f.partition}' AND {H} < {lim} THEN NULL")
        elif f.kind == "ref_break":
            cases.append(f"WHEN dt = '{f.partition}' AND {H} < {lim} THEN {f.missing}")
        elif f.kind == "volume_drop":
            keep.append(f"(dt <> '{f.partition}' OR {H} < {lim})")
    # later faults override earlier ones: list them first in CASE
    pid = "CASE " + " ".join(reversed(cases)) + " ELSE product_id END"
    return pid, " AND ".join(keep) or "TRUE"


def fixtures_cte() -> str:
    pid, keep = _faults()
    return f"""
raw AS (
  SELECT event_id AS order_id, user_id AS product_id, "value" AS amount,
         strftime(ts, '%Y-%m-%d') AS dt
  FROM events),
ref AS (
  SELECT c_custkey AS product_id, c_name AS name, c_mktsegment AS category, c_acctbal AS price
  FROM customer),
bad AS (
  SELECT order_id, {pid} AS product_id, amount, dt FROM raw WHERE {keep}),
refk AS (SELECT DISTINCT product_id AS k FROM ref WHERE product_id IS NOT NULL),
rev AS (
  SELECT dt, product_id,
         CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
         COUNT(order_id) AS order_count
  FROM bad GROUP BY dt, product_id),
rev_clean AS (
  SELECT dt, product_id,
         CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
         COUNT(order_id) AS order_count
  FROM raw GROUP BY dt, product_id),
bad_stats AS (
  SELECT d.dt, COALESCE(s.n, 0) AS n, COALESCE(s.n0, 0) AS n0, COALESCE(s.n1, 0) AS n1,
         COALESCE(s.n2, 0) AS n2, COALESCE(s.n4, 0) AS n4
  FROM (SELECT DISTINCT dt FROM bad UNION SELECT '{fx.EMPTY_PARTITION}') d
  LEFT JOIN (
    SELECT b.dt, COUNT(*) AS n,
           COUNT(*) FILTER (WHERE b.order_id IS NULL) AS n0,
           COUNT(*) FILTER (WHERE b.product_id IS NULL) AS n1,
           COUNT(*) FILTER (WHERE b.amount IS NULL) AS n2,
           COUNT(*) FILTER (WHERE r.k IS NULL) AS n4
    FROM bad b LEFT JOIN refk r ON b.product_id = r.k GROUP BY b.dt) s ON s.dt = d.dt),
raw_stats AS (
  SELECT d.dt, COALESCE(s.n, 0) AS n, COALESCE(s.n0, 0) AS n0, COALESCE(s.n1, 0) AS n1,
         COALESCE(s.n2, 0) AS n2, COALESCE(s.n4, 0) AS n4
  FROM (SELECT DISTINCT dt FROM raw UNION SELECT '{fx.EMPTY_PARTITION}') d
  LEFT JOIN (
    SELECT b.dt, COUNT(*) AS n,
           COUNT(*) FILTER (WHERE b.order_id IS NULL) AS n0,
           COUNT(*) FILTER (WHERE b.product_id IS NULL) AS n1,
           COUNT(*) FILTER (WHERE b.amount IS NULL) AS n2,
           COUNT(*) FILTER (WHERE r.k IS NULL) AS n4
    FROM raw b LEFT JOIN refk r ON b.product_id = r.k GROUP BY b.dt) s ON s.dt = d.dt),
rev_stats AS (
  SELECT dt, COUNT(*) AS n, COUNT(*) FILTER (WHERE total_revenue IS NULL) AS n0,
         COUNT(*) FILTER (WHERE product_id IS NULL) AS n1
  FROM rev GROUP BY dt),
rev_clean_stats AS (
  SELECT dt, COUNT(*) AS n, COUNT(*) FILTER (WHERE total_revenue IS NULL) AS n0,
         COUNT(*) FILTER (WHERE product_id IS NULL) AS n1
  FROM rev_clean GROUP BY dt),
res AS (
  {order_check_sql(fx.RUN_ID, fx.RUN_TS, 'bad_stats')}
  UNION ALL
  {revenue_check_sql(fx.RUN_ID, fx.RUN_TS, 'rev_stats')}),
res_strict AS (
  {order_check_sql(fx.RUN_ID, fx.RUN_TS, 'bad_stats')}
  UNION ALL
  {revenue_check_sql(fx.RUN_ID, fx.RUN_TS, 'rev_stats', fx.STRICT_REV_VOLUME)}),
res2 AS (
  SELECT * FROM res
  UNION ALL
  {order_check_sql(fx.RUN2_ID, fx.RUN2_TS, 'raw_stats')}
  UNION ALL
  {revenue_check_sql(fx.RUN2_ID, fx.RUN2_TS, 'rev_clean_stats')})
"""


def lineage_cte() -> str:
    decls = list(fx.REFERENCE_LINEAGE) + list(fx.SHAPES_LINEAGE)
    ds = ", ".join(f"('{d['dataset']}', {i})" for i, d in enumerate(decls))
    ed = ", ".join(
        f"('{d['dataset']}', '{u}', {j})" for d in decls for j, u in enumerate(d.get("upstream") or [])
    )
    cr = ", ".join(
        f"('{d['dataset']}', '{c}', {j})" for d in decls for j, c in enumerate(d.get("critical_columns") or [])
    )
    off = fx.PART_ORD_OFFSET
    return f"""
lin_datasets AS (
  SELECT dataset, CAST(decl_ord AS BIGINT) AS decl_ord FROM (VALUES {ds}) t(dataset, decl_ord)
  UNION ALL SELECT 'ds_' || p_partkey, CAST(p_partkey + {off} AS BIGINT) FROM part),
lin_edges AS (
  SELECT dataset, upstream, CAST(ord AS INTEGER) AS ord FROM (VALUES {ed}) t(dataset, upstream, ord)
  UNION ALL SELECT 'ds_' || p_partkey, 'ds_' || (p_partkey // 2), 0 FROM part WHERE p_partkey > 0),
lin_critical AS (
  SELECT dataset, "column", CAST(ord AS INTEGER) AS ord FROM (VALUES {cr}) t(dataset, "column", ord)
  UNION ALL SELECT 'ds_' || p_partkey, 'partkey', 0 FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT 'ds_' || p_partkey, lower(replace(replace(p_brand, '#', '_'), ' ', '_')), 1 FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT 'ds_' || p_partkey, 'size_' || p_size, 2 FROM part WHERE p_partkey % 3 = 0),
lin_nodes AS (SELECT dataset AS n FROM lin_edges UNION SELECT upstream FROM lin_edges),
lin_walk(dataset, upstream, depth) AS (
  SELECT dataset, upstream, 1 FROM lin_edges
  UNION ALL
  SELECT w.dataset, e.upstream, w.depth + 1 FROM lin_walk w JOIN lin_edges e ON e.dataset = w.upstream
  WHERE w.depth < (SELECT COUNT(*) FROM lin_nodes)),
lin_closure AS (SELECT dataset, upstream, MIN(depth) AS depth FROM lin_walk GROUP BY dataset, upstream)
"""


def baseline_cte(name: str, hist: str, window: int = 30) -> str:
    return f"""
{name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY dataset, check_name ORDER BY "partition", "timestamp", run_id) AS rn,
         rank() OVER (PARTITION BY dataset, check_name ORDER BY "partition") - 1 AS nb
  FROM {hist}),
{name}_p AS (SELECT DISTINCT dataset, check_name, "partition", nb FROM {name}_r),
{name} AS (
  SELECT p.dataset, p.check_name, p."partition", AVG(h.metric_value) AS baseline_mean,
         MAX(h.metric_value) AS baseline_max, COUNT(h.metric_value) AS baseline_rows
  FROM {name}_p p LEFT JOIN {name}_r h
    ON h.dataset = p.dataset AND h.check_name = p.check_name AND h.rn BETWEEN p.nb - {window - 1} AND p.nb
  GROUP BY p.dataset, p.check_name, p."partition")
"""


Q = "'"  # a single quote inside SQL text literals


def sql_template(text: str, **exprs: str) -> str:
    """A ``{name}`` text template as a SQL ``||`` concatenation."""
    import re

    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", text):
        if m.start() > pos:
            parts.append("'" + text[pos:m.start()].replace("'", "''") + "'")
        parts.append(f"({exprs[m.group(1)]})")
        pos = m.end()
    if pos < len(text):
        parts.append("'" + text[pos:].replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


def explain_sql(alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    m, n, t, th = f"{a}metric_value", f"{a}check_name", f"{a}check_type", f"{a}threshold"
    pct = lambda x: f"printf('%.2f', {x} * 100.0) || '%'"
    return (
        f"(CASE WHEN {m} = -1.0 THEN {sql_template(rca.TEXT_ERROR, check_name=n)}"
        f" WHEN {t} = 'null_check' THEN "
        + sql_template(rca.TEXT_NULL, col=f"replace({n}, 'null_rate_', '')", metric=pct(m),
                       threshold=pct(f"TRY_CAST({th} AS DOUBLE)"))
        + f" WHEN {t} = 'volume' THEN "
        + sql_template(rca.TEXT_VOLUME, rows=f"CAST(CAST(trunc({m}) AS BIGINT) AS VARCHAR)", threshold=th)
        + f" WHEN {t} = 'referential' THEN "
        + sql_template(rca.TEXT_REFERENTIAL, col=f"replace({n}, 'ref_integrity_', '')", metric=pct(m))
        + " ELSE "
        + sql_template(rca.TEXT_OTHER, check_name=n, metric=f"CAST({m} AS VARCHAR)", threshold=th)
        + " END)"
    )


def rca_cte(p: str, hist: str, latest: bool = False) -> str:
    """Causes (``{p}_causes``), recommendations, impact and MTTR over ``hist``.

    ``latest``: upstream failures only from the newest run of each partition.
    """
    g = 'run_id, dataset, "partition"'
    kind_ord = "CASE kind WHEN 'source' THEN 0 WHEN 'self' THEN 2 ELSE 1 END"
    # the checks in the order they are declared, stated here once more
    orders = ["null_rate_order_id", "null_rate_product_id", "null_rate_amount", "volume_check", "ref_integrity_product_id"]
    revenue = ["null_rate_total_revenue", "null_rate_product_id", "volume_check"]
    names = ", ".join(f"'{d}/{c}'" for d, cs in ((fx.ORDERS, orders), (fx.REVENUE, revenue)) for c in cs)
    place = lambda d, c: f"COALESCE(list_position([{names}], {d} || '/' || {c}), 1000000)"
    up_src = hist
    if latest:
        up_src = (f'(SELECT * FROM {hist} QUALIFY rank() OVER (PARTITION BY dataset, "partition" '
                  f'ORDER BY "timestamp" DESC, run_id DESC) = 1)')
    rec_null = sql_template(rca.REC_NULL, col="replace(check_name, 'null_rate_', '')")
    rec_ref = sql_template(rca.REC_REFERENTIAL, col="replace(check_name, 'ref_integrity_', '')")
    rec_volume = sql_template(rca.REC_VOLUME, dataset="dataset")
    rec_cause = sql_template(rca.REC_CAUSE, cause_dataset="cause_dataset", reason="reason")
    upstream_reason = sql_template(rca.TEXT_UPSTREAM, check_name="uf.u_check", metric="printf('%.4f', uf.u_metric)")
    anomaly_reason = sql_template(rca.TEXT_ANOMALY, check_name="h.check_name", metric="printf('%.4f', h.metric_value)",
                                  mean="printf('%.4f', b.baseline_mean)")
    return baseline_cte(f"{p}_base", hist) + f""",
{p}_fails AS (SELECT {g}, check_name, check_type, metric_value, threshold FROM {hist} WHERE NOT passed),
{p}_targets AS (SELECT DISTINCT {g} FROM {p}_fails),
{p}_hasup AS (SELECT DISTINCT dataset FROM lin_edges),
{p}_r2 AS (
  SELECT f.run_id, f.dataset, f."partition", f.dataset AS cause_dataset, {explain_sql('f')} AS reason,
         CAST(0.95 AS DOUBLE) AS confidence, 'source' AS kind, -1 AS upstream_ord, f.check_name AS item
  FROM {p}_fails f WHERE f.dataset NOT IN (SELECT dataset FROM {p}_hasup)),
{p}_tu AS (SELECT t.run_id, t.dataset, t."partition", e.upstream, e.ord
           FROM {p}_targets t JOIN lin_edges e ON e.dataset = t.dataset),
{p}_uf AS (SELECT dataset AS upstream, "partition", check_name AS u_check, check_type AS u_type, metric_value AS u_metric
           FROM {up_src} WHERE NOT passed),
{p}_r3 AS (
  SELECT tu.run_id, tu.dataset, tu."partition", tu.upstream AS cause_dataset,
         {upstream_reason} AS reason,
         CAST(0.90 AS DOUBLE) AS confidence, 'upstream' AS kind, tu.ord AS upstream_ord, uf.u_check AS item
  FROM {p}_tu tu JOIN {p}_uf uf ON uf.upstream = tu.upstream AND uf."partition" = tu."partition"
  WHERE uf.u_type IN ('volume', 'referential')
     OR EXISTS (SELECT 1 FROM lin_critical c WHERE c.dataset = tu.dataset
                AND c."column" = replace(replace(uf.u_check, 'null_rate_', ''), 'ref_integrity_', ''))),
{p}_clean AS (SELECT * FROM {p}_tu tu WHERE NOT EXISTS (
  SELECT 1 FROM {p}_uf uf WHERE uf.upstream = tu.upstream AND uf."partition" = tu."partition")),
{p}_r4 AS (
  SELECT c.run_id, c.dataset, c."partition", c.upstream AS cause_dataset,
         {anomaly_reason} AS reason,
         CAST(0.70 AS DOUBLE) AS confidence, 'baseline' AS kind, c.ord AS upstream_ord, h.check_name AS item
  FROM {p}_clean c JOIN {hist} h ON h.dataset = c.upstream AND h."partition" = c."partition"
  JOIN {p}_base b ON b.dataset = h.dataset AND b.check_name = h.check_name AND b."partition" = h."partition"
  WHERE b.baseline_rows > 0 AND (h.metric_value > b.baseline_mean * 2 OR h.metric_value > b.baseline_max)),
{p}_found AS (SELECT {g} FROM {p}_r3 UNION SELECT {g} FROM {p}_r4),
{p}_r5 AS (
  SELECT f.run_id, f.dataset, f."partition", f.dataset AS cause_dataset, {explain_sql('f')} AS reason,
         CAST(0.75 AS DOUBLE) AS confidence, 'self' AS kind, -1 AS upstream_ord, f.check_name AS item
  FROM {p}_fails f WHERE f.dataset IN (SELECT dataset FROM {p}_hasup)
    AND NOT EXISTS (SELECT 1 FROM {p}_found x
                    WHERE x.run_id = f.run_id AND x.dataset = f.dataset AND x."partition" = f."partition")),
{p}_c0 AS (
  SELECT * FROM {p}_r2 UNION ALL SELECT * FROM {p}_r3 UNION ALL SELECT * FROM {p}_r4 UNION ALL SELECT * FROM {p}_r5),
{p}_causes AS (
  SELECT *,
    row_number() OVER (PARTITION BY {g} ORDER BY {kind_ord}, upstream_ord, {place('cause_dataset', 'item')}, item, reason) AS cause_ord,
    row_number() OVER (PARTITION BY {g} ORDER BY confidence DESC, {kind_ord}, upstream_ord, {place('cause_dataset', 'item')}, item, reason) AS cause_rank,
    CASE WHEN confidence > 0.85 THEN 'high' ELSE 'medium' END AS band
  FROM {p}_c0),
{p}_rec0 AS (
  SELECT {g}, 0 AS sec, {place('dataset', 'check_name')} AS d, check_name AS k, 0 AS o,
    CASE check_type
      WHEN 'null_check' THEN {rec_null}
      WHEN 'volume' THEN {rec_volume}
      WHEN 'referential' THEN {rec_ref}
    END AS recommendation
  FROM {p}_fails
  UNION ALL
  SELECT {g}, 1, 0, '', cause_ord, {rec_cause}
  FROM {p}_causes WHERE cause_dataset <> dataset),
{p}_recs AS (
  SELECT {g}, row_number() OVER (PARTITION BY {g} ORDER BY sec, d, k, o, recommendation) AS rec_no, recommendation
  FROM {p}_rec0 WHERE recommendation IS NOT NULL),
{p}_impact AS (
  SELECT t.run_id, t.dataset, t."partition", c.dataset AS impacted_dataset, c.depth
  FROM {p}_targets t JOIN lin_closure c ON c.upstream = t.dataset),
{p}_mttr AS (
  SELECT t.run_id, t.dataset, t."partition", COALESCE(n.n, 0) AS n_causes,
         CASE WHEN COALESCE(n.n, 0) <= 2 THEN 15 ELSE 30 END AS estimated_mttr, 120 AS manual_mttr,
         120 - CASE WHEN COALESCE(n.n, 0) <= 2 THEN 15 ELSE 30 END AS time_saved
  FROM {p}_targets t LEFT JOIN (SELECT {g}, COUNT(*) AS n FROM {p}_causes GROUP BY ALL) n
    ON n.run_id = t.run_id AND n.dataset = t.dataset AND n."partition" = t."partition")
"""


def with_fixtures(body: str, extra_ctes: str = "") -> str:
    ctes = fixtures_cte().rstrip() + ",\n" + lineage_cte().strip()
    if extra_ctes:
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH RECURSIVE {ctes}\n{body}"
