"""Oracle SQL text per registered query key (DuckDB dialect)."""

from __future__ import annotations

from tideline.oracle import H, baseline_cte, check_rows, explain_sql, order_check_sql, rca_cte, with_fixtures
from tideline.plans import fixtures as fx

RES_COLS = 'run_id, dataset, "partition", check_name, check_type, passed, metric_value, threshold, "timestamp"'
SQL: dict[str, str] = {}


def _bad_only(checks_sql_filter: str) -> str:
    return with_fixtures(f"SELECT * FROM ({order_check_sql(fx.RUN_ID, fx.RUN_TS, 'bad_stats')}) WHERE {checks_sql_filter}")


SQL["scan_all"] = with_fixtures("SELECT order_id, product_id, amount, dt FROM raw")
SQL["scan_partition"] = with_fixtures("SELECT order_id, product_id, amount, dt FROM raw WHERE dt = '2024-01-10'")
SQL["scan_reference"] = "SELECT COUNT(*) AS n_products FROM customer"
SQL["new_partitions"] = with_fixtures(
    f"""SELECT dt AS "partition" FROM (SELECT DISTINCT dt FROM raw UNION SELECT '{fx.EMPTY_PARTITION}')
        WHERE dt > (SELECT MAX("partition") FROM res WHERE dataset = '{fx.ORDERS}' AND "partition" <= '2024-01-20')"""
)
SQL["new_partitions_late"] = with_fixtures(
    f"""SELECT dt AS "partition" FROM (SELECT DISTINCT dt FROM raw UNION SELECT '{fx.EMPTY_PARTITION}') p
        WHERE NOT EXISTS (SELECT 1 FROM res r WHERE r.dataset = '{fx.ORDERS}' AND r."partition" = p.dt
                          AND r."partition" <> '2024-01-05')"""
)
SQL["check_null_rate"] = _bad_only("check_name = 'null_rate_product_id'")
SQL["check_volume"] = _bad_only("check_name = 'volume_check'")
SQL["check_ref_integrity"] = _bad_only("check_name = 'ref_integrity_product_id'")
SQL["check_ref_integrity_shuffled"] = SQL["check_ref_integrity"]
SQL["orphan_rows"] = with_fixtures(
    "SELECT b.* FROM bad b WHERE NOT EXISTS (SELECT 1 FROM ref r WHERE r.product_id = b.product_id)"
)
SQL["check_error_rows"] = with_fixtures(
    f"""SELECT * FROM (
      {check_rows(fx.RUN_ID, fx.RUN_TS, fx.ORDERS, 'bad_stats', [
          ("null_rate_discount", "null_check", "-1.0", "FALSE", "0.05"),
          ("volume_check", "volume", "n", f"n BETWEEN {fx.BAD_VOLUME[0]} AND {fx.BAD_VOLUME[1]}",
           f"{fx.BAD_VOLUME[0]}-{fx.BAD_VOLUME[1]}"),
          ("ref_integrity_customer_id", "referential", "-1.0", "FALSE", "N/A"),
          ("ref_integrity_product_id", "referential", "-1.0", "FALSE", "N/A"),
      ])})"""
)
SQL["check_custom"] = with_fixtures(
    f"""SELECT *, {explain_sql()} AS explanation
        FROM (
      {check_rows(fx.RUN_ID, fx.RUN_TS, fx.ORDERS, 'custom_stats', [
          ("high_amount_rate", "distribution", "(CASE WHEN n = 0 THEN 0.0 ELSE CAST(nh AS DOUBLE) / n END)",
           "(CASE WHEN n = 0 THEN 0.0 ELSE CAST(nh AS DOUBLE) / n END) <= 0.25", "0.25"),
      ])})""",
    extra_ctes=f"""custom_stats AS (
      SELECT d.dt, COALESCE(s.n, 0) AS n, COALESCE(s.nh, 0) AS nh
      FROM (SELECT DISTINCT dt FROM bad UNION SELECT '{fx.EMPTY_PARTITION}') d
      LEFT JOIN (SELECT dt, COUNT(*) AS n, COUNT(*) FILTER (WHERE amount > 400) AS nh FROM bad GROUP BY dt) s
      ON s.dt = d.dt)""",
)
SQL["check_empty_partition"] = with_fixtures(
    f"""SELECT * FROM ({order_check_sql(fx.RUN_ID, fx.RUN_TS, 'bad_stats')})
        WHERE "partition" IN ('2024-01-30', '{fx.EMPTY_PARTITION}')"""
)
SQL["check_all_fused"] = with_fixtures(f"SELECT * FROM res WHERE dataset = '{fx.ORDERS}'")
SQL["revenue_rollup"] = with_fixtures("SELECT dt, product_id, total_revenue, order_count FROM rev")
SQL["revenue_sink_roundtrip"] = SQL["revenue_rollup"]
SQL["results_upsert"] = with_fixtures(
    f"""SELECT * FROM res WHERE NOT (dataset = '{fx.ORDERS}' AND "partition" >= '2024-01-15')
        UNION ALL
        SELECT run_id, dataset, "partition", check_name, check_type, passed, metric_value, threshold,
               TIMESTAMP '{fx.RUN2_TS}' AS "timestamp"
        FROM (SELECT * REPLACE ('{fx.RUN_ID}' AS run_id) FROM res2 WHERE run_id = '{fx.RUN2_ID}')
        WHERE dataset = '{fx.ORDERS}' AND "partition" >= '2024-01-15'"""
)
SQL["checkpoint_upsert"] = with_fixtures(
    f"""SELECT dataset, MAX("partition") AS last_checked_partition, MAX("timestamp") AS last_check_time
        FROM res2 WHERE run_id = '{fx.RUN2_ID}' GROUP BY dataset
        UNION ALL
        SELECT dataset, MAX("partition"), MAX("timestamp") FROM res
        WHERE "partition" <= '2024-01-20'
          AND dataset NOT IN (SELECT dataset FROM res2 WHERE run_id = '{fx.RUN2_ID}')
        GROUP BY dataset"""
)

# --- runs -----------------------------------------------------------------
SQL["run_all_datasets"] = with_fixtures("SELECT * FROM res")
SQL["run_without_diagnostics"] = SQL["run_all_datasets"]
SQL["run_summary"] = with_fixtures(
    "SELECT COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE passed) AS passed, "
    "COUNT(*) FILTER (WHERE NOT passed) AS failed FROM res"
)
SQL["run_incremental"] = with_fixtures(
    f"""SELECT CASE WHEN "partition" <= '2024-01-20' THEN 'run-a' ELSE 'run-b' END AS run_id,
               dataset, "partition", check_name, check_type, passed, metric_value, threshold,
               CASE WHEN "partition" <= '2024-01-20' THEN TIMESTAMP '{fx.RUN_TS}' ELSE TIMESTAMP '{fx.RUN2_TS}' END
               AS "timestamp"
        FROM res"""
)

# --- lineage --------------------------------------------------------------
SQL["lineage_edges"] = with_fixtures(
    "SELECT e.dataset, e.upstream, e.ord, d.decl_ord FROM lin_edges e LEFT JOIN lin_datasets d USING (dataset)"
)
SQL["lineage_upstream"] = with_fixtures("SELECT dataset, upstream, ord FROM lin_edges")
SQL["lineage_downstream"] = with_fixtures(
    "SELECT e.upstream AS dataset, e.dataset AS downstream, d.decl_ord AS ord "
    "FROM lin_edges e LEFT JOIN lin_datasets d ON d.dataset = e.dataset"
)
SQL["lineage_all_upstream"] = with_fixtures("SELECT dataset, upstream, depth FROM lin_closure")
SQL["lineage_all_downstream"] = with_fixtures(
    "SELECT upstream AS dataset, dataset AS downstream, depth FROM lin_closure"
)
SQL["lineage_critical"] = with_fixtures('SELECT dataset, "column", ord FROM lin_critical')
SQL["lineage_listing"] = with_fixtures(
    """SELECT d.dataset, u.depends_on IS NULL AS is_source, COALESCE(u.depends_on, '') AS depends_on,
              COALESCE(w.feeds_into, '') AS feeds_into
       FROM lin_datasets d
       LEFT JOIN (SELECT dataset, string_agg(upstream, ', ' ORDER BY ord, upstream) AS depends_on
                  FROM lin_edges GROUP BY dataset) u ON u.dataset = d.dataset
       LEFT JOIN (SELECT e.upstream AS dataset, string_agg(e.dataset, ', ' ORDER BY x.decl_ord, e.dataset) AS feeds_into
                  FROM lin_edges e LEFT JOIN lin_datasets x ON x.dataset = e.dataset GROUP BY e.upstream) w
         ON w.dataset = d.dataset"""
)

SQL["lineage_listing_pages"] = with_fixtures(
    """SELECT dataset, list, row_number() OVER (PARTITION BY dataset, list ORDER BY place) AS page, n_names, names
       FROM (SELECT n.dataset, list, n.ord // 1000 AS place, COUNT(*) AS n_names, string_agg(name, ', ' ORDER BY n.ord, name) AS names
             FROM (SELECT dataset, 'depends_on' AS list, CAST(ord AS BIGINT) AS ord, upstream AS name FROM lin_edges
                   UNION ALL
                   SELECT e.upstream, 'feeds_into', x.decl_ord, e.dataset FROM lin_edges e JOIN lin_datasets x ON x.dataset = e.dataset) n
             WHERE n.dataset IN (SELECT dataset FROM lin_datasets) GROUP BY ALL)"""
)

# --- baselines ------------------------------------------------------------
_B = 'dataset, check_name, "partition", ROUND(baseline_mean, 9) AS baseline_mean, baseline_max, baseline_rows'
SQL["baseline_window"] = with_fixtures(f"SELECT {_B} FROM b1", baseline_cte("b1", "res"))
SQL["baseline_multi_run"] = with_fixtures(f"SELECT {_B} FROM b2", baseline_cte("b2", "res2"))
SQL["baseline_anomalies"] = with_fixtures(
    """SELECT h.run_id, h.dataset, h."partition", h.check_name, h.metric_value, ROUND(b.baseline_mean, 9) AS baseline_mean,
              b.baseline_max, b.baseline_rows
       FROM res2 h JOIN b2 b ON b.dataset = h.dataset AND b.check_name = h.check_name AND b."partition" = h."partition"
       WHERE b.baseline_rows > 0 AND (h.metric_value > b.baseline_mean * 2 OR h.metric_value > b.baseline_max)""",
    baseline_cte("b2", "res2"),
)

# --- root-cause analysis --------------------------------------------------
_C = ('run_id, dataset, "partition", cause_dataset, reason, confidence, kind, upstream_ord, item, cause_ord, '
      'cause_rank, band')
SQL["rca_source"] = with_fixtures(f"SELECT {_C} FROM a_causes WHERE kind = 'source'", rca_cte("a", "res"))
SQL["rca_upstream"] = with_fixtures(f"SELECT {_C} FROM a_causes WHERE kind = 'upstream'", rca_cte("a", "res"))
SQL["rca_fallback"] = with_fixtures(
    f"SELECT {_C} FROM s_causes WHERE dataset = '{fx.REVENUE}'", rca_cte("s", "res_strict")
)
SQL["rca_all"] = with_fixtures(f"SELECT {_C} FROM m_causes", rca_cte("m", "res2"))
SQL["rca_impact"] = with_fixtures("SELECT * FROM a_impact", rca_cte("a", "res"))
SQL["rca_recommendations"] = with_fixtures("SELECT * FROM s_recs", rca_cte("s", "res_strict"))
SQL["rca_ranked"] = with_fixtures(
    'SELECT run_id, dataset, "partition", cause_rank, cause_dataset, confidence, band, reason FROM s_causes',
    rca_cte("s", "res_strict"),
)
SQL["rca_mttr"] = with_fixtures("SELECT * FROM s_mttr", rca_cte("s", "res_strict"))

# --- fault injection ------------------------------------------------------
SQL["inject_null_spike"] = with_fixtures(
    f"SELECT order_id, CASE WHEN dt = '2024-01-10' AND {H} < 350.0 THEN NULL ELSE product_id END AS product_id, "
    "amount, dt FROM raw"
)
SQL["inject_volume_drop"] = with_fixtures(f"SELECT * FROM raw WHERE dt <> '2024-01-15' OR {H} < 250.0")
SQL["inject_ref_break"] = with_fixtures(
    f"SELECT order_id, CASE WHEN dt = '2024-01-20' AND {H} < 180.0 THEN {fx.MISSING_KEY} ELSE product_id END "
    "AS product_id, amount, dt FROM raw"
)
SQL["inject_scenarios"] = with_fixtures("SELECT * FROM bad")
SQL["inject_exact_fraction"] = with_fixtures(
    """SELECT order_id, CASE WHEN sel THEN NULL ELSE product_id END AS product_id, amount, dt FROM (
         SELECT r.*, dt = '2024-01-10' AND
                row_number() OVER (PARTITION BY dt ORDER BY md5(CAST(order_id AS VARCHAR)), order_id)
                <= round_even(CAST(0.35 AS DOUBLE) * COUNT(*) OVER (PARTITION BY dt), 0) AS sel
         FROM raw r)"""
)

# --- reports --------------------------------------------------------------
SQL["report_summary"] = with_fixtures(
    "SELECT dataset, COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE passed) AS passed, "
    "COUNT(*) FILTER (WHERE NOT passed) AS failed FROM res GROUP BY dataset"
)
SQL["report_failed"] = with_fixtures(
    'SELECT dataset, "partition", check_name, metric_value, threshold, "timestamp" FROM res2 WHERE NOT passed'
)
SQL["report_failed_projection"] = with_fixtures(
    'SELECT dataset, "partition", check_name, metric_value FROM res WHERE NOT passed'
)
SQL["report_recent"] = with_fixtures(
    'SELECT dataset, "partition", check_name, passed, metric_value, "timestamp", run_id FROM res2 '
    'ORDER BY "timestamp" DESC, "partition" DESC, dataset, check_name, run_id LIMIT 10'
)
SQL["report_checkpoints"] = SQL["checkpoint_upsert"]
SQL["run_impact"] = with_fixtures(
    "SELECT COUNT(*) FILTER (WHERE NOT passed) AS failed_checks, "
    "CAST(FLOOR(COUNT(*) FILTER (WHERE NOT passed) * 105 / 60) AS BIGINT) AS hours_saved FROM res"
)
SQL["metrics_scale"] = with_fixtures(
    'SELECT COUNT(*) AS total_checks, COUNT(DISTINCT dataset) AS datasets_checked, '
    'COUNT(DISTINCT "partition") AS partitions_checked FROM res2'
)
SQL["metrics_rows"] = with_fixtures(
    """SELECT p.dataset, p.partitions, CAST(COALESCE(c.rpp, 0) AS BIGINT) AS rows_per_partition,
              CAST(p.partitions * COALESCE(c.rpp, 0) AS BIGINT) AS estimated_rows,
              CAST(COALESCE(m.measured_rows, 0) AS BIGINT) AS measured_rows
       FROM (SELECT dataset, COUNT(DISTINCT "partition") AS partitions FROM res2 GROUP BY dataset) p
       LEFT JOIN (VALUES ('orders_raw', 15000), ('revenue_daily', 1000)) c(dataset, rpp) ON c.dataset = p.dataset
       LEFT JOIN (SELECT dataset, SUM(CAST(v AS BIGINT)) AS measured_rows FROM (
                    SELECT dataset, "partition", FIRST(metric_value ORDER BY "timestamp" DESC, run_id DESC) AS v
                    FROM res2 WHERE check_name = 'volume_check' GROUP BY dataset, "partition") GROUP BY dataset) m
         ON m.dataset = p.dataset"""
)
_DET = """SELECT COUNT(*) FILTER (WHERE NOT passed) AS issues_detected,
                 COUNT(DISTINCT CASE WHEN NOT passed THEN dataset || '/' || "partition" END) AS affected_partitions,
                 (CASE WHEN COUNT(*) = 0 THEN 0.0 ELSE CAST(COUNT(*) FILTER (WHERE NOT passed) AS DOUBLE) / COUNT(*) END)
                   * 100.0 AS failure_rate_pct
          FROM res2"""
SQL["metrics_detection"] = with_fixtures(_DET)
SQL["metrics_impact"] = with_fixtures(
    f"""SELECT 120 AS manual_mttr_min, 15 AS automated_mttr_min, 105 AS saved_per_incident_min,
               CAST(affected_partitions * 105 AS BIGINT) AS total_saved_min,
               CAST(affected_partitions * 105 AS DOUBLE) / 60.0 AS total_saved_hours,
               CAST(87.5 AS DOUBLE) AS mttr_reduction_pct
        FROM ({_DET})"""
)
SQL["metrics_types"] = with_fixtures(
    'SELECT check_type, COUNT(*) AS "count", COUNT(*) FILTER (WHERE passed) AS passed, '
    "COUNT(*) FILTER (WHERE NOT passed) AS failed FROM res2 GROUP BY check_type"
)
SQL["profile"] = with_fixtures(
    f"""SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT dt FROM raw UNION SELECT '{fx.EMPTY_PARTITION}')) AS n_partitions,
               (SELECT MIN(dt) FROM raw) AS first_partition, '{fx.EMPTY_PARTITION}' AS last_partition,
               4 AS n_columns, 'order_id, product_id, amount, dt' AS columns,
               COUNT(*) FILTER (WHERE order_id IS NULL) AS nulls_order_id,
               COUNT(*) FILTER (WHERE product_id IS NULL) AS nulls_product_id,
               COUNT(*) FILTER (WHERE amount IS NULL) AS nulls_amount,
               COUNT(*) FILTER (WHERE dt IS NULL) AS nulls_dt,
               MIN(product_id) AS min_product_id, MAX(product_id) AS max_product_id,
               MIN(amount) AS min_amount, MAX(amount) AS max_amount, COUNT(*) AS total_rows
        FROM raw"""
)

SQL["check_lineitem_monthly"] = with_fixtures(
    "SELECT * FROM (" + check_rows(fx.RUN_ID, fx.RUN_TS, "lineitem_monthly", "big_stats", [
        ("null_rate_order_id", "null_check", "(CASE WHEN n = 0 THEN 0.0 ELSE CAST(n0 AS DOUBLE) / n END)",
         "(CASE WHEN n = 0 THEN 0.0 ELSE CAST(n0 AS DOUBLE) / n END) <= 0.0", "0.0"),
        ("null_rate_product_id", "null_check", "(CASE WHEN n = 0 THEN 0.0 ELSE CAST(n1 AS DOUBLE) / n END)",
         "(CASE WHEN n = 0 THEN 0.0 ELSE CAST(n1 AS DOUBLE) / n END) <= 0.05", "0.05"),
        ("null_rate_amount", "null_check", "(CASE WHEN n = 0 THEN 0.0 ELSE CAST(n2 AS DOUBLE) / n END)",
         "(CASE WHEN n = 0 THEN 0.0 ELSE CAST(n2 AS DOUBLE) / n END) <= 0.05", "0.05"),
        ("volume_check", "volume", "n", f"n BETWEEN {fx.BIG_VOLUME[0]} AND {fx.BIG_VOLUME[1]}",
         f"{fx.BIG_VOLUME[0]}-{fx.BIG_VOLUME[1]}"),
        ("ref_integrity_product_id", "referential", "(CASE WHEN n = 0 THEN 0.0 ELSE CAST(n4 AS DOUBLE) / n END)",
         "(CASE WHEN n = 0 THEN 0.0 ELSE CAST(n4 AS DOUBLE) / n END) = 0.0", "0.0"),
    ]) + ")",
    extra_ctes="""big AS (
      SELECT l_orderkey AS order_id, l_partkey AS product_id, l_extendedprice AS amount,
             strftime(l_shipdate, '%Y-%m') AS dt FROM lineitem),
    big_stats AS (
      SELECT b.dt, COUNT(*) AS n, COUNT(*) FILTER (WHERE b.order_id IS NULL) AS n0,
             COUNT(*) FILTER (WHERE b.product_id IS NULL) AS n1, COUNT(*) FILTER (WHERE b.amount IS NULL) AS n2,
             COUNT(*) FILTER (WHERE p.k IS NULL) AS n4
      FROM big b LEFT JOIN (SELECT DISTINCT p_partkey AS k FROM part WHERE p_partkey IS NOT NULL) p
        ON b.product_id = p.k
      GROUP BY b.dt)""",
)
SQL["rca_latest_run"] = with_fixtures(f"SELECT {_C} FROM l_causes", rca_cte("l", "res2", latest=True))
SQL["stream_checks"] = with_fixtures(
    f"""SELECT * REPLACE ('stream-0' AS run_id) FROM ({order_check_sql(fx.RUN_ID, fx.RUN_TS, 'bad_stats')})
        WHERE "partition" <> '{fx.EMPTY_PARTITION}'"""
)

# --- partitions under their own schema, isolation, NULL partitions ----------
_R = "(CASE WHEN n = 0 THEN 0.0 ELSE CAST({c} AS DOUBLE) / n END)"


def _row(name, kind, metric, passed, threshold, source, dataset=fx.ORDERS):
    return (f"SELECT '{fx.RUN_ID}' AS run_id, '{dataset}' AS dataset, dt AS \"partition\", '{name}' AS check_name, "
            f"'{kind}' AS check_type, {passed} AS passed, CAST({metric} AS DOUBLE) AS metric_value, '{threshold}' AS threshold, "
            f"TIMESTAMP '{fx.RUN_TS}' AS \"timestamp\" FROM {source}")


def _rate(col, limit):
    r = _R.format(c=col)
    return r, f"{r} <= {limit}"


_VOLUME = f"{fx.BAD_VOLUME[0]}-{fx.BAD_VOLUME[1]}"
_IN_VOLUME = f"n BETWEEN {fx.BAD_VOLUME[0]} AND {fx.BAD_VOLUME[1]}"
SQL["check_drifted_partition"] = with_fixtures(
    " UNION ALL ".join([
        _row("null_rate_order_id", "null_check", "0.0", "TRUE", "0.0", "drift_stats"),
        _row("null_rate_product_id", "null_check", *_rate("n1", 0.05), "0.05", "drift_stats"),
        _row("null_rate_amount", "null_check", "CASE WHEN dt = '2024-01-03' THEN -1.0 ELSE 0.0 END", "dt <> '2024-01-03'", "0.05",
             "drift_stats"),
        _row("volume_check", "volume", "n", _IN_VOLUME, _VOLUME, "drift_stats"),
        _row("ref_integrity_product_id", "referential", _R.format(c="n4"), f"{_R.format(c='n4')} = 0.0", "0.0", "drift_stats"),
        *[_row(name, kind, "-1.0", "FALSE", threshold, "(SELECT '2024-01-04' AS dt)") for name, kind, threshold in (
            ("null_rate_order_id", "null_check", "0.0"), ("null_rate_product_id", "null_check", "0.05"),
            ("null_rate_amount", "null_check", "0.05"), ("volume_check", "volume", "N/A"),
            ("ref_integrity_product_id", "referential", "N/A"))],
    ]),
    extra_ctes="""drift AS (
      SELECT dt, CASE WHEN dt = '2024-01-02' AND order_id % 20 < 7 THEN NULL ELSE product_id END AS product_id
      FROM raw WHERE dt <> '2024-01-04'),
    drift_stats AS (
      SELECT d.dt, COUNT(*) AS n, COUNT(*) FILTER (WHERE d.product_id IS NULL) AS n1, COUNT(*) FILTER (WHERE r.k IS NULL) AS n4
      FROM drift d LEFT JOIN refk r ON d.product_id = r.k GROUP BY d.dt)""",
)
SQL["check_error_runtime"] = with_fixtures(
    " UNION ALL ".join([
        _row("parsed_ids", "format", "CASE WHEN dt = '2024-01-02' THEN -1.0 ELSE s END", "dt <> '2024-01-02' AND s > 0", "N/A", "ids"),
        _row("null_rate_product_id", "null_check", "0.0", "TRUE", "0.05", "ids"),
        _row("volume_check", "volume", "n", _IN_VOLUME, _VOLUME, "ids"),
    ]),
    extra_ctes="ids AS (SELECT dt, COUNT(*) AS n, CAST(SUM(order_id) AS DOUBLE) AS s FROM raw GROUP BY dt)",
)
_NULL_DAYS = "nd AS (SELECT order_id, product_id, CASE WHEN order_id % 4 = 0 THEN NULL ELSE dt END AS dt FROM bad)"
SQL["check_null_partition"] = with_fixtures(
    " UNION ALL ".join(
        x for name in ("broadcast", "shuffled") for x in (
            _row("ref_integrity_product_id", "referential", _R.format(c="n4"), f"{_R.format(c='n4')} = 0.0", "0.0", "nd_stats", name),
            _row("volume_check", "volume", "n", _IN_VOLUME, _VOLUME, "nd_stats", name))),
    extra_ctes=_NULL_DAYS + """,
    nd_stats AS (
      SELECT d.dt, COUNT(*) AS n, COUNT(*) FILTER (WHERE r.k IS NULL) AS n4
      FROM nd d LEFT JOIN refk r ON d.product_id = r.k GROUP BY d.dt)""",
)
SQL["new_rows_null_partition"] = with_fixtures(
    f"""SELECT w.way, nd.dt AS "partition", COUNT(*) AS n
        FROM nd CROSS JOIN (VALUES ('inlined'), ('joined')) w(way)
        WHERE NOT EXISTS (SELECT 1 FROM res r WHERE r.dataset = '{fx.ORDERS}' AND r."partition" = nd.dt
                          AND r."partition" <> '2024-01-05')
        GROUP BY w.way, nd.dt""",
    extra_ctes=_NULL_DAYS,
)
SQL["check_three_references"] = (
    """WITH refs AS (
      SELECT strftime(l_shipdate, '%Y') AS dt, COUNT(*) AS n,
             COUNT(*) FILTER (WHERE CASE WHEN l_linenumber = 7 THEN -l_orderkey ELSE l_orderkey END NOT IN (SELECT o_orderkey FROM orders)) AS a,
             COUNT(*) FILTER (WHERE CASE WHEN l_linenumber = 7 AND l_quantity > 25 THEN -l_partkey ELSE l_partkey END NOT IN (SELECT p_partkey FROM part)) AS b,
             COUNT(*) FILTER (WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)) AS c
      FROM lineitem GROUP BY 1) """
    + " UNION ALL ".join(
        _row(f"ref_integrity_{col}", "referential", _R.format(c=c), f"{_R.format(c=c)} = 0.0", "0.0", "refs", "lineitem")
        for c, col in (("a", "l_orderkey"), ("b", "l_partkey"), ("c", "l_suppkey")))
)
SQL["revenue_fine_amounts"] = with_fixtures(
    "SELECT dt, product_id, ROUND(SUM(amount / 7000), 6) AS total_revenue, COUNT(order_id) AS order_count FROM raw GROUP BY dt, product_id"
)


def _chosen(day, rate, key="CAST(order_id AS VARCHAR)"):
    return (f"(dt = '{day}' AND row_number() OVER (PARTITION BY dt ORDER BY md5({key}), order_id) "
            f"<= round_even(CAST({rate} AS DOUBLE) * COUNT(*) OVER (PARTITION BY dt), 0))")


SQL["inject_volume_exact"] = with_fixtures(
    f"SELECT order_id, product_id, amount, dt FROM (SELECT *, {_chosen('2024-01-15', 0.25)} AS sel FROM raw) "
    "WHERE sel OR dt <> '2024-01-15'"
)
SQL["inject_break_exact"] = with_fixtures(
    f"SELECT order_id, CASE WHEN sel THEN {fx.MISSING_KEY} ELSE product_id END AS product_id, amount, dt "
    f"FROM (SELECT *, {_chosen('2024-01-20', 0.18)} AS sel FROM raw)"
)
SQL["inject_text_key"] = with_fixtures(
    f"""SELECT order_id, CASE WHEN a THEN NULL ELSE product_id END AS product_id, amount, dt
        FROM (SELECT *, {_chosen('2024-01-10', 0.35, 'order_id')} AS a, {_chosen('2024-01-15', 0.25, 'order_id')} AS b FROM keyed)
        WHERE b OR dt <> '2024-01-15'""",
    extra_ctes="keyed AS (SELECT * REPLACE (md5('order-' || order_id) AS order_id) FROM raw)",
)
SQL["metrics_total_rows"] = SQL["metrics_rows"].replace(
    "SELECT p.dataset, p.partitions,", "SELECT CAST(SUM(estimated_rows) AS BIGINT) AS estimated_rows, "
    "CAST(SUM(measured_rows) AS BIGINT) AS measured_rows FROM (SELECT p.dataset, p.partitions,") + ")"
SQL["checkpoint_mixed_writes"] = with_fixtures(
    f"SELECT '{fx.ORDERS}' AS dataset, MAX(dt) AS last_checked_partition, TIMESTAMP '{fx.RUN2_TS}' AS last_check_time FROM raw"
)
SQL["lineage_upstream_of_some"] = with_fixtures(
    "SELECT dataset, upstream, depth FROM lin_closure WHERE dataset IN "
    "(SELECT 'ds_' || p_partkey FROM part WHERE p_partkey >= 100 AND p_partkey < 200)"
)
SQL["rca_impact_deep"] = with_fixtures(
    "SELECT * FROM x_impact",
    f"resx AS (SELECT * REPLACE ('ds_9' AS dataset) FROM res WHERE dataset = '{fx.ORDERS}'),\n" + rca_cte("x", "resx"),
)
