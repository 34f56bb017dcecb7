"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Stages are named CTEs with dependencies; :func:`sql_with` assembles the
``WITH`` clause a query needs. Double outputs are rounded to 6 places like the
Spark side.
"""

from __future__ import annotations

from stresscast.sources.driver_views import VIEW_DEPS, VIEW_SQL

STAGE_SQL = {
    "region_daily_v": """
        SELECT p.pipeline, p.region_id, d.date, CAST(count(DISTINCT d.ghcnd_station_id) AS BIGINT) AS n_stations_used,
               median(d.tavg_c) AS tavg_c_median, median(d.tavg_c) * 9.0 / 5.0 + 32.0 AS tavg_f_median,
               median(d.hdd) AS hdd_median, avg(d.tavg_c) AS tavg_c_mean,
               avg(d.tavg_c) * 9.0 / 5.0 + 32.0 AS tavg_f_mean, avg(d.hdd) AS hdd_mean
        FROM station_day d JOIN station_pipeline p ON d.ghcnd_station_id = p.ghcnd_station_id
        WHERE d.tavg_c IS NOT NULL
        GROUP BY p.pipeline, p.region_id, d.date""",
    "notice_days_v": """
        SELECT pipeline, notice_id, coalesce(critical, false) AS crit,
               CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT pipeline, notice_id, critical,
                     CAST(coalesce(effective_dt, posted_dt) AS DATE) AS s,
                     CAST(coalesce(end_dt, effective_dt, posted_dt) AS DATE) AS e
              FROM notice WHERE coalesce(effective_dt, posted_dt) IS NOT NULL)
        WHERE e >= s""",
    "stress_v": """
        SELECT pipeline, date, CAST(count(DISTINCT notice_id) AS BIGINT) AS notice_active_count,
               max(CAST(crit AS INTEGER)) AS critical_active, max(CAST(crit AS INTEGER)) AS stress_event
        FROM notice_days_v GROUP BY pipeline, date""",
    "storage_daily_v": """
        SELECT region, CAST(unnest(generate_series(CAST(date AS TIMESTAMP), CAST(coalesce(nxt - 1, date) AS TIMESTAMP),
                                                   INTERVAL 1 DAY)) AS DATE) AS date, v AS working_gas_bcf
        FROM (SELECT region, date,
                     last_value(working_gas_bcf IGNORE NULLS) OVER (PARTITION BY region ORDER BY date
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v,
                     lead(date) OVER (PARTITION BY region ORDER BY date) AS nxt
              FROM storage_weekly)""",
    "cap_median_v": """
        SELECT pipeline, date, median(q) AS all_qty_avail_median
        FROM (SELECT pipeline, TRY_CAST(trim(Post_Date) AS DATE) AS date, TRY_CAST(trim(All_Qty_Avail) AS DOUBLE) AS q
              FROM capacity)
        WHERE date IS NOT NULL GROUP BY pipeline, date""",
    "model_frame_v": """
        SELECT pipeline, region_id, date, hdd_mean, hdd_median, n_stations_used, henry_hub_usd_per_mmbtu,
               working_gas_bcf, notice_active_count, critical_active, stress_event, all_qty_avail_median, hh_log,
               hh_log - lag(hh_log) OVER (PARTITION BY pipeline ORDER BY date) AS hh_ret
        FROM (SELECT b.pipeline, b.region_id, b.date, b.hdd_mean, b.hdd_median, b.n_stations_used,
                     p.henry_hub_usd_per_mmbtu, s.working_gas_bcf,
                     CAST(coalesce(n.notice_active_count, 0) AS BIGINT) AS notice_active_count,
                     CAST(coalesce(n.critical_active, 0) AS INTEGER) AS critical_active,
                     CAST(coalesce(n.stress_event, 0) AS INTEGER) AS stress_event,
                     c.all_qty_avail_median,
                     CASE WHEN p.henry_hub_usd_per_mmbtu > 0 THEN ln(p.henry_hub_usd_per_mmbtu) END AS hh_log
              FROM region_daily_v b
              LEFT JOIN price_daily p ON p.date = b.date
              LEFT JOIN storage_daily_v s ON s.region = b.pipeline AND s.date = b.date
              LEFT JOIN stress_v n ON n.pipeline = b.pipeline AND n.date = b.date
              LEFT JOIN cap_median_v c ON c.pipeline = b.pipeline AND c.date = b.date)""",
}

STAGE_DEPS = {
    "region_daily_v": ["station_day", "station_pipeline"],
    "notice_days_v": ["notice"],
    "stress_v": ["notice_days_v"],
    "storage_daily_v": ["storage_weekly"],
    "cap_median_v": ["capacity"],
    "model_frame_v": ["region_daily_v", "price_daily", "storage_daily_v", "stress_v", "cap_median_v"],
}

ALL_SQL = {**VIEW_SQL, **STAGE_SQL}
ALL_DEPS = {**VIEW_DEPS, **STAGE_DEPS}


def sql_with(body: str, *names: str, round_cols=()) -> str:
    order: list[str] = []

    def add(n):
        for d in ALL_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    prefix = ("WITH " + ",\n".join(f"{n} AS ({ALL_SQL[n]})" for n in order) + "\n") if order else ""
    if round_cols:
        rep = ", ".join(f"round({c}, 6) AS {c}" for c in round_cols)
        body = f"SELECT * REPLACE ({rep}) FROM ({body}) AS q"
    return prefix + body


MF_DOUBLES = ("hdd_mean", "hdd_median", "henry_hub_usd_per_mmbtu", "working_gas_bcf", "all_qty_avail_median",
              "hh_log", "hh_ret")

ORACLE = {
    "region_daily": sql_with("SELECT * FROM region_daily_v", "region_daily_v",
                             round_cols=("tavg_c_median", "tavg_f_median", "hdd_median", "tavg_c_mean",
                                         "tavg_f_mean", "hdd_mean")),
    "model_frame": sql_with("SELECT * FROM model_frame_v", "model_frame_v", round_cols=MF_DOUBLES),
    "notices_to_stress": sql_with("SELECT * FROM stress_v", "stress_v"),
    "notices_to_stress_sweep": sql_with("SELECT * FROM stress_v", "stress_v"),
    "weekly_to_daily_ffill": sql_with("SELECT * FROM storage_daily_v", "storage_daily_v",
                                      round_cols=("working_gas_bcf",)),
    "capacity_daily_median": sql_with("SELECT * FROM cap_median_v", "cap_median_v",
                                      round_cols=("all_qty_avail_median",)),
}


# ------------------------------------------------------ batch 2
STAGE_SQL.update({
    "fi_v": """
        SELECT pipeline, date,
               CASE WHEN count(stress_event) OVER w3 >= 3 THEN avg(stress_event) OVER w3 END AS op,
               CASE WHEN count(abs(hh_ret)) OVER w3 >= 3 THEN avg(abs(hh_ret)) OVER w3 END AS persist,
               hdd_median AS hdd,
               working_gas_bcf - CASE WHEN count(working_gas_bcf) OVER w1095 >= 1095
                                      THEN avg(working_gas_bcf) OVER w1095 END AS storage
        FROM model_frame_v
        WINDOW w3 AS (PARTITION BY pipeline ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
               w1095 AS (PARTITION BY pipeline ORDER BY date ROWS BETWEEN 1094 PRECEDING AND CURRENT ROW)""",
    "scored_points_v": """
        SELECT f.pipeline, f.date, f.op,
               CASE WHEN s.sp IS NULL OR s.sp = 0 THEN 0.0 ELSE (f.persist - s.mp) / s.sp END AS persist,
               CASE WHEN s.sh IS NULL OR s.sh = 0 THEN 0.0 ELSE (f.hdd - s.mh) / s.sh END AS hdd,
               CASE WHEN s.ss IS NULL OR s.ss = 0 THEN 0.0 ELSE (f.storage - s.ms) / s.ss END AS storage
        FROM fi_v f JOIN (SELECT pipeline, avg(persist) AS mp, stddev_pop(persist) AS sp, avg(hdd) AS mh,
                                 stddev_pop(hdd) AS sh, avg(storage) AS ms, stddev_pop(storage) AS ss
                          FROM fi_v GROUP BY pipeline) s ON f.pipeline = s.pipeline""",
    "grid_draws_v": """
        SELECT CAST(-1.2 AS DOUBLE) + CAST(d AS DOUBLE) / CAST(100.0 AS DOUBLE) AS a,
               CAST(0.8 AS DOUBLE) - CAST(d AS DOUBLE) / CAST(250.0 AS DOUBLE) AS b_op,
               CAST(d % 7 - 3 AS DOUBLE) / CAST(10.0 AS DOUBLE) AS b_persist,
               CAST(d % 11 - 5 AS DOUBLE) / CAST(20.0 AS DOUBLE) AS b_hdd,
               CAST(d % 13 - 6 AS DOUBLE) / CAST(25.0 AS DOUBLE) AS b_storage
        FROM (SELECT range AS d FROM range(6000))""",
    "keyed_draws_v": """
        SELECT pipeline, CAST(d % 37 - 18 - k AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS a,
               CAST(d % 7 - k AS DOUBLE) / CAST(500.0 AS DOUBLE) AS b_op,
               CAST(d % 5 - 2 AS DOUBLE) / CAST(400.0 AS DOUBLE) AS b_persist,
               CAST(d % 11 - 5 AS DOUBLE) / CAST(900.0 AS DOUBLE) AS b_hdd,
               CAST(d % 13 - 6 AS DOUBLE) / CAST(800.0 AS DOUBLE) AS b_storage,
               CAST(d % 17 + 1 AS DOUBLE) / CAST(500.0 AS DOUBLE) AS sigma,
               tan(pi() * ((CAST(d * 7919 % 1000 AS DOUBLE) + 0.5) / CAST(1000.0 AS DOUBLE) - 0.5)) AS t
        FROM (SELECT DISTINCT pipeline, length(pipeline) AS k FROM supplier_geo), (SELECT range AS d FROM range(1000))""",
})
STAGE_DEPS.update({"fi_v": ["model_frame_v"], "scored_points_v": ["fi_v"], "keyed_draws_v": ["supplier_geo"]})
ALL_SQL.update(STAGE_SQL)
ALL_DEPS.update(STAGE_DEPS)

_W = "WINDOW w AS (PARTITION BY pipeline ORDER BY date)"


def _z(policy, x, m, s):
    if policy == "a":
        return f"({x} - {m}) / CASE WHEN {s} > 1e-8 THEN {s} ELSE 1.0 END"
    return f"CASE WHEN {s} IS NULL OR {s} = 0 THEN 0.0 ELSE ({x} - {m}) / {s} END"


_STRESS_DESIGN = f"""
    SELECT pipeline, date, y,
           {_z('a', 'hdd_lag1', 'avg(hdd_lag1) OVER p', 'stddev_pop(hdd_lag1) OVER p')} AS hdd_lag1,
           {_z('a', 'storage_lag1', 'avg(storage_lag1) OVER p', 'stddev_pop(storage_lag1) OVER p')} AS storage_lag1,
           {_z('a', 'cap_avail_lag1', 'avg(cap_avail_lag1) OVER p', 'stddev_pop(cap_avail_lag1) OVER p')} AS cap_avail_lag1,
           {_z('a', 'notices_lag1', 'avg(notices_lag1) OVER p', 'stddev_pop(notices_lag1) OVER p')} AS notices_lag1
    FROM (SELECT pipeline, date, stress_event AS y, lag(hdd_median) OVER w AS hdd_lag1,
                 lag(working_gas_bcf) OVER w AS storage_lag1, lag(all_qty_avail_median) OVER w AS cap_avail_lag1,
                 lag(notice_active_count) OVER w AS notices_lag1
          FROM model_frame_v {_W})
    WHERE y IS NOT NULL AND hdd_lag1 IS NOT NULL AND storage_lag1 IS NOT NULL AND cap_avail_lag1 IS NOT NULL
          AND notices_lag1 IS NOT NULL
    WINDOW p AS (PARTITION BY pipeline)"""

_VOL_DESIGN = f"""
    SELECT pipeline, date, y, op,
           {_z('b', 'persist', 'avg(persist) OVER p', 'stddev_pop(persist) OVER p')} AS persist,
           {_z('b', 'hdd', 'avg(hdd) OVER p', 'stddev_pop(hdd) OVER p')} AS hdd,
           {_z('b', 'storage', 'avg(storage) OVER p', 'stddev_pop(storage) OVER p')} AS storage
    FROM (SELECT pipeline, date, y, CAST(lag(op_stress) OVER w AS DOUBLE) AS op,
                 CAST(lag(stress_days_7d) OVER w AS DOUBLE) AS persist, lag(hdd_5d) OVER w AS hdd,
                 lag(storage_z) OVER w AS storage
          FROM (SELECT pipeline, date, y, op_stress,
                       CASE WHEN count(op_stress) OVER w7 >= 1 THEN sum(op_stress) OVER w7 END AS stress_days_7d,
                       CASE WHEN count(hdd_median) OVER w5 >= 1 THEN avg(hdd_median) OVER w5 END AS hdd_5d,
                       {_z('b', 'working_gas_bcf', 'smu', 'ssd')} AS storage_z
                FROM (SELECT pipeline, date, abs(hh_ret) AS y, stress_event AS op_stress, hdd_median, working_gas_bcf,
                             avg(working_gas_bcf) OVER (PARTITION BY pipeline) AS smu,
                             stddev_pop(working_gas_bcf) OVER (PARTITION BY pipeline) AS ssd
                      FROM model_frame_v)
                WINDOW w7 AS (PARTITION BY pipeline ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
                       w5 AS (PARTITION BY pipeline ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
          {_W})
    WHERE y IS NOT NULL AND op IS NOT NULL AND persist IS NOT NULL AND hdd IS NOT NULL AND storage IS NOT NULL
    WINDOW p AS (PARTITION BY pipeline)"""

_ZSC = """
    SELECT m.pipeline, m.date,
           CASE WHEN s.sh IS NULL OR s.sh = 0 THEN 0.0 ELSE (m.hdd_median - s.mh) / s.sh END AS hdd_median_z,
           CASE WHEN s.sw IS NULL OR s.sw = 0 THEN 0.0 ELSE (m.working_gas_bcf - s.mw) / s.sw END AS working_gas_bcf_z
    FROM model_frame_v m LEFT JOIN (
        SELECT pipeline, avg(hdd_median) AS mh, stddev_pop(hdd_median) AS sh, avg(working_gas_bcf) AS mw,
               stddev_pop(working_gas_bcf) AS sw
        FROM model_frame_v WHERE date <= DATE '1998-12-31' GROUP BY pipeline) s ON m.pipeline = s.pipeline
    WHERE m.date > DATE '1998-12-31'"""


def _zs(policy, cols):
    sel = ", ".join(f"{_z(policy, f'm.{c}', f's.m_{c}', f's.s_{c}')} AS {c}_z" for c in cols)
    st = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    return (f"SELECT m.pipeline, m.date, {sel} FROM model_frame_v m LEFT JOIN "
            f"(SELECT pipeline, {st} FROM model_frame_v GROUP BY pipeline) s ON m.pipeline = s.pipeline")


_SCORED_DESCRIBE = """
    SELECT {keys} CAST(count(score) AS BIGINT) AS count, avg(score) AS mean, stddev_samp(score) AS std,
           CAST(min(score) AS DOUBLE) AS min, quantile_cont(score, 0.25) AS p25, quantile_cont(score, 0.5) AS p50,
           quantile_cont(score, 0.75) AS p75, CAST(max(score) AS DOUBLE) AS max
    FROM scored {group}"""

_AUC = """
    SELECT sum(CAST(p AS DOUBLE) * (CAST(below AS DOUBLE) + 0.5 * CAST(n AS DOUBLE)))
             / (CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) AS auc,
           CAST(sum(p) AS BIGINT) AS n_pos, CAST(sum(n) AS BIGINT) AS n_neg
    FROM (SELECT s, p, n, coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 AS below
          FROM (SELECT {score} AS s, sum({label}) AS p, sum(1 - {label}) AS n FROM {src}
                WHERE {score} IS NOT NULL AND {label} IS NOT NULL GROUP BY {score}))"""

_BASELINE = """
    SELECT * FROM (SELECT auc AS auc_baseline FROM ({auc_b})) AS x, (SELECT auc AS auc_model, n_pos, n_neg FROM ({auc_m})) AS y"""

_BASE_ROWS = """(SELECT * FROM (SELECT score, outcome,
        CASE WHEN count(outcome) OVER w30 >= 30 THEN avg(CAST(outcome AS DOUBLE)) OVER w30 END AS baseline
     FROM (SELECT user_id, date_trunc('hour', ts) AS hour, max(outcome) AS outcome, max(score) AS score
           FROM scored GROUP BY user_id, date_trunc('hour', ts))
     WINDOW w30 AS (PARTITION BY user_id ORDER BY hour ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
     WHERE baseline IS NOT NULL AND score IS NOT NULL AND outcome IS NOT NULL)"""

_RELIABILITY = """
    SELECT bin, q[bin + 1] AS bin_lo, q[bin + 2] AS bin_hi, avg(CAST(outcome AS DOUBLE)) AS observed_freq,
           CAST(count(*) AS BIGINT) AS n
    FROM (SELECT s.outcome, e.q,
                 CASE WHEN s.score < e.q[1] THEN NULL WHEN s.score <= e.q[2] THEN 0 WHEN s.score <= e.q[3] THEN 1
                      WHEN s.score <= e.q[4] THEN 2 WHEN s.score <= e.q[5] THEN 3 WHEN s.score <= e.q[6] THEN 4 END AS bin
          FROM scored s, (SELECT quantile_cont(score, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS q FROM scored) e)
    WHERE bin IS NOT NULL GROUP BY bin, q[bin + 1], q[bin + 2]"""

_GRID = """
    SELECT z.pipeline, z.date,
           avg(CASE WHEN z.op IS NULL OR z.persist IS NULL OR z.hdd IS NULL OR z.storage IS NULL THEN NULL
                    WHEN 1.0 / (1.0 + exp(-((((d.a + d.b_op * z.op) + d.b_persist * z.persist) + d.b_hdd * z.hdd)
                                             + d.b_storage * z.storage))) > 0.3 THEN 1.0 ELSE 0.0 END) AS prob
    FROM scored_points_v z, grid_draws_v d GROUP BY z.pipeline, z.date"""


def _keyed(over: str) -> str:
    """Share of a pipeline's draws for which ``over`` holds of the line ``l`` and the draw ``d``."""
    return f"""
    SELECT pipeline, date, avg(CASE WHEN l IS NULL THEN NULL WHEN {over} THEN 1.0 ELSE 0.0 END) AS prob
    FROM (SELECT z.pipeline, z.date, d.sigma, d.t,
                 (((d.a + d.b_op * z.op) + d.b_persist * z.persist) + d.b_hdd * z.hdd) + d.b_storage * z.storage AS l
          FROM scored_points_v z LEFT JOIN keyed_draws_v d USING (pipeline)) GROUP BY pipeline, date"""


ORACLE["score_keyed_draws"] = sql_with(_keyed("1.0 / (1.0 + exp(-l)) > 0.4985"), "scored_points_v", "keyed_draws_v",
                                       round_cols=("prob",))
ORACLE["score_vol_variates"] = sql_with(_keyed("l + sigma * t > 0.0213"), "scored_points_v", "keyed_draws_v",
                                        round_cols=("prob",))
ORACLE.update({
    "log_return": sql_with("""SELECT region, date, CASE WHEN working_gas_bcf > 0 THEN ln(working_gas_bcf) END
                              - lag(CASE WHEN working_gas_bcf > 0 THEN ln(working_gas_bcf) END)
                                OVER (PARTITION BY region ORDER BY date) AS log_ret FROM storage_daily_v""",
                           "storage_daily_v", round_cols=("log_ret",)),
    "lag_features": sql_with(f"""SELECT pipeline, date, lag(hdd_median) OVER w AS hdd_median_lag1,
                                 lag(working_gas_bcf) OVER w AS working_gas_bcf_lag1,
                                 lag(all_qty_avail_median) OVER w AS all_qty_avail_median_lag1,
                                 lag(notice_active_count) OVER w AS notice_active_count_lag1
                                 FROM model_frame_v {_W}""", "model_frame_v",
                             round_cols=("hdd_median_lag1", "working_gas_bcf_lag1", "all_qty_avail_median_lag1")),
    "rolling_sum7": sql_with("""SELECT pipeline, date, CASE WHEN count(stress_event) OVER w7 >= 1
                                THEN CAST(sum(stress_event) OVER w7 AS BIGINT) END AS stress_days_7d FROM model_frame_v
                                WINDOW w7 AS (PARTITION BY pipeline ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
                             "model_frame_v"),
    "rolling_mean5": sql_with("""SELECT pipeline, date, CASE WHEN count(hdd_median) OVER w5 >= 1
                                 THEN avg(hdd_median) OVER w5 END AS hdd_5d FROM model_frame_v
                                 WINDOW w5 AS (PARTITION BY pipeline ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
                              "model_frame_v", round_cols=("hdd_5d",)),
    "rolling_mean3_gated": sql_with("SELECT pipeline, date, op AS op_3d, persist AS persist_3d FROM fi_v", "fi_v",
                                    round_cols=("op_3d", "persist_3d")),
    "rolling_mean1095_gated": sql_with("""SELECT pipeline, date, CASE WHEN count(working_gas_bcf) OVER w >= 1095
                                          THEN avg(working_gas_bcf) OVER w END AS storage_mean_1095 FROM model_frame_v
                                          WINDOW w AS (PARTITION BY pipeline ORDER BY date
                                                       ROWS BETWEEN 1094 PRECEDING AND CURRENT ROW)""",
                                       "model_frame_v", round_cols=("storage_mean_1095",)),
    "stress_design": sql_with(_STRESS_DESIGN, "model_frame_v",
                              round_cols=("hdd_lag1", "storage_lag1", "cap_avail_lag1", "notices_lag1")),
    "vol_design": sql_with(_VOL_DESIGN, "model_frame_v", round_cols=("y", "op", "persist", "hdd", "storage")),
    "forecast_inputs": sql_with("""SELECT pipeline, date, op, persist, hdd, storage FROM (
                                     SELECT *, row_number() OVER (PARTITION BY pipeline ORDER BY date DESC) AS rn
                                     FROM fi_v) WHERE rn = 1""", "fi_v", round_cols=("op", "persist", "hdd", "storage")),
    "zscore_a": sql_with(_zs("a", ["hdd_median", "all_qty_avail_median"]), "model_frame_v",
                         round_cols=("hdd_median_z", "all_qty_avail_median_z")),
    "zscore_b": sql_with(_zs("b", ["working_gas_bcf", "notice_active_count"]), "model_frame_v",
                         round_cols=("working_gas_bcf_z", "notice_active_count_z")),
    "zscore_c": sql_with(_ZSC, "model_frame_v", round_cols=("hdd_median_z", "working_gas_bcf_z")),
    "daily_dedupe_last": """
        SELECT date, o_orderkey, o_totalprice, o_orderpriority FROM (
          SELECT CAST(o_orderdate AS DATE) AS date, o_orderkey, o_totalprice, o_orderpriority,
                 row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn
          FROM orders) WHERE rn = 1""",
    "station_dedupe_first": sql_with("""
        SELECT pipeline, ghcnd_station_id, station_name, CAST(NULL AS VARCHAR) AS state FROM (
          SELECT lower(trim(pipeline)) AS pipeline, trim(ghcnd_station_id) AS ghcnd_station_id, station_name,
                 row_number() OVER (PARTITION BY lower(trim(pipeline)), trim(ghcnd_station_id) ORDER BY pos) AS rn
          FROM (SELECT '  ' || upper(g.pipeline) || ' ' AS pipeline, ' N' || CAST(s.s_nationkey AS VARCHAR) || ' '
                         AS ghcnd_station_id, s.s_name AS station_name, s.s_suppkey AS pos
                FROM supplier s JOIN supplier_geo g ON s.s_suppkey = g.s_suppkey))
        WHERE rn = 1""", "supplier_geo"),
    "range_scan": """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, l_quantity FROM lineitem
                     WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""",
    "active_as_of": sql_with("""SELECT pipeline, notice_id, end_dt FROM notice
                                WHERE end_dt IS NULL OR end_dt >= TIMESTAMP '1998-06-01'""", "notice"),
    "lookback_filter": sql_with("""SELECT date, henry_hub_usd_per_mmbtu FROM price_daily
                                   WHERE date >= DATE '2001-08-01' - INTERVAL 60 DAY""", "price_daily",
                                round_cols=("henry_hub_usd_per_mmbtu",)),
    "takewhile_cutoff": """
        SELECT o_custkey, o_orderkey, posted FROM (
          SELECT o_custkey, o_orderkey, posted,
                 sum(CASE WHEN posted IS NOT NULL AND posted < DATE '1998-01-01' THEN 1 ELSE 0 END)
                   OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS older
          FROM (SELECT o_custkey, o_orderkey,
                       CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS posted FROM orders))
        WHERE older = 0 AND posted IS NOT NULL""",
    "scan_topk": """SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem WHERE l_returnflag = 'R'
                    ORDER BY l_shipdate DESC, l_orderkey, l_linenumber LIMIT 100""",
    "station_meta_lookup": sql_with("""
        SELECT d.ghcnd_station_id, d.date, d.tavg_c, m.station_name, m.state FROM station_day d LEFT JOIN (
          SELECT 'ST' || CAST(s.s_suppkey AS VARCHAR) AS ghcnd_station_id, s.s_name AS station_name, n.n_name AS state
          FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey) m ON d.ghcnd_station_id = m.ghcnd_station_id""",
                                    "station_day", round_cols=("tavg_c",)),
    "semi_station_filter": sql_with("""
        SELECT ghcnd_station_id, date, tavg_c, hdd FROM station_day
        WHERE ghcnd_station_id IN (SELECT ghcnd_station_id FROM station_pipeline WHERE pipeline = 'europe')""",
                                    "station_day", "station_pipeline", round_cols=("tavg_c", "hdd")),
    "union_stations": sql_with("""
        SELECT ghcnd_station_id, date, tavg_c, tmin_c, tmax_c,
               CASE WHEN tavg_c IS NOT NULL THEN greatest(0.0, 65.0 - (tavg_c * 9.0 / 5.0 + 32.0)) END AS hdd
        FROM (SELECT r.ghcnd_station_id, r."DATE" AS date,
                     coalesce(CASE WHEN s.s_acctbal >= 0 THEN r.TAVG / 10.0 END, (r.TMIN / 10.0 + r.TMAX / 10.0) / 2.0)
                       AS tavg_c, r.TMIN / 10.0 AS tmin_c, r.TMAX / 10.0 AS tmax_c
              FROM station_raw r JOIN supplier s ON r.l_suppkey = s.s_suppkey)""",
                               "station_raw", round_cols=("tavg_c", "tmin_c", "tmax_c", "hdd")),
    "describe": sql_with(_SCORED_DESCRIBE.format(keys="", group=""), "scored",
                         round_cols=("mean", "std", "min", "p25", "p50", "p75", "max")),
    "grouped_describe": sql_with(_SCORED_DESCRIBE.format(keys="outcome,", group="GROUP BY outcome"), "scored",
                                 round_cols=("mean", "std", "min", "p25", "p50", "p75", "max")),
    "alert_crosstab": sql_with("""
        SELECT alert, CAST(sum(CASE WHEN outcome = 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS frac_0,
               CAST(sum(CASE WHEN outcome = 1 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS frac_1
        FROM (SELECT score > 250.0 AS alert, outcome FROM scored WHERE score IS NOT NULL AND outcome IS NOT NULL)
        GROUP BY alert""", "scored", round_cols=("frac_0", "frac_1")),
    "auc": sql_with(_AUC.format(score="score", label="outcome", src="scored"), "scored", round_cols=("auc",)),
    "naive_baseline_auc": sql_with(_BASELINE.format(
        auc_b=_AUC.format(score="baseline", label="outcome", src=_BASE_ROWS),
        auc_m=_AUC.format(score="score", label="outcome", src=_BASE_ROWS)), "scored",
        round_cols=("auc_baseline", "auc_model")),
    "reliability_quintile": sql_with(_RELIABILITY, "scored", round_cols=("bin_lo", "bin_hi", "observed_freq")),
    "score_stress_grid": sql_with(_GRID, "scored_points_v", "grid_draws_v", round_cols=("prob",)),
})


# ------------------------------------------------------ batch 3
def _prices_by_day(pick):
    return f"""SELECT 'RNGWHHD' AS series, date, CASE WHEN day(date) % 7 <> 0 THEN v END AS henry_hub_usd_per_mmbtu
               FROM (SELECT CAST(o_orderdate AS DATE) AS date, {pick}(o_totalprice) / 1000.0 AS v FROM orders
                     GROUP BY CAST(o_orderdate AS DATE))"""


_MERGE = f"""
    SELECT coalesce(e.series, i.series) AS series, coalesce(e.date, i.date) AS date,
           CASE WHEN i.date IS NOT NULL THEN i.henry_hub_usd_per_mmbtu ELSE e.henry_hub_usd_per_mmbtu END
             AS henry_hub_usd_per_mmbtu,
           e.units,
           CASE WHEN e.date IS NOT NULL THEN TIMESTAMP '2000-01-01 00:00:00' ELSE TIMESTAMP '2001-01-01 00:00:00' END
             AS created_at_utc,
           CASE WHEN i.date IS NOT NULL THEN TIMESTAMP '2001-01-01 00:00:00' ELSE TIMESTAMP '2000-01-01 00:00:00' END
             AS updated_at,
           CASE WHEN e.date IS NULL THEN 'insert' WHEN i.date IS NULL THEN 'keep'
                WHEN e.henry_hub_usd_per_mmbtu IS NOT DISTINCT FROM i.henry_hub_usd_per_mmbtu THEN 'unchanged'
                ELSE 'update' END AS _action
    FROM (SELECT *, '$/MMBTU' AS units FROM ({_prices_by_day("min")}) WHERE date < DATE '2000-01-01') e
    FULL OUTER JOIN (SELECT * FROM ({_prices_by_day("max")}) WHERE date >= DATE '1998-01-01') i
      ON e.series = i.series AND e.date = i.date"""

_ENERGY_ROWS = """
    SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'bad' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS period,
           CASE WHEN o_orderkey % 7 = 0 THEN 'NA' ELSE CAST(o_totalprice AS VARCHAR) END AS value,
           CASE WHEN o_orderkey % 5 <> 0 THEN 'RNGWHHD' END AS series
    FROM orders"""

ORACLE.update({
    "keyed_merge": sql_with(_MERGE, round_cols=("henry_hub_usd_per_mmbtu",)),
    "merge_stats": sql_with(f"""
        SELECT CAST(count(*) FILTER (WHERE _action = 'insert') AS BIGINT) AS inserted,
               CAST(count(*) FILTER (WHERE _action = 'update') AS BIGINT) AS modified,
               CAST(count(*) FILTER (WHERE _action = 'unchanged') AS BIGINT) AS unchanged,
               CAST(count(*) FILTER (WHERE _action = 'keep') AS BIGINT) AS kept,
               CAST(count(*) FILTER (WHERE _action = 'unkeyed') AS BIGINT) AS unkeyed,
               CAST(count(*) FILTER (WHERE _action IN ('insert', 'update')) AS BIGINT) AS upserts_or_updates
        FROM ({_MERGE})"""),
    "unique_check": sql_with("""SELECT pipeline, posted_dt, count(*) AS n_rows FROM notice
                                GROUP BY pipeline, posted_dt HAVING count(*) > 1""", "notice"),
    "quarantine_split": sql_with("""SELECT pipeline, Loc_Name, Post_Date, All_Qty_Avail FROM capacity
                                    WHERE NOT (TRY_CAST(trim(Post_Date) AS DATE) IS NOT NULL
                                               AND TRY_CAST(trim(All_Qty_Avail) AS DOUBLE) IS NOT NULL)""", "capacity"),
    "normalize_prices": sql_with(f"""
        SELECT strftime(d, '%Y-%m-%d') AS date, TRY_CAST(value AS DOUBLE) AS henry_hub_usd_per_mmbtu,
               '$/MMBTU' AS units, coalesce(nullif(series, ''), 'RNGWHHD') AS series,
               'Henry Hub Natural Gas Spot Price' AS series_description, 'NUS' AS duoarea, 'U.S.' AS area_name,
               CAST(NULL AS VARCHAR) AS product, CAST(NULL AS VARCHAR) AS product_name,
               CAST(NULL AS VARCHAR) AS process, CAST(NULL AS VARCHAR) AS process_name
        FROM (SELECT TRY_CAST(period AS DATE) AS d, * FROM ({_ENERGY_ROWS})) WHERE d IS NOT NULL""",
                                 round_cols=("henry_hub_usd_per_mmbtu",)),
    "normalize_storage": sql_with("""
        SELECT strftime(date, '%Y-%m-%d') AS date, region, working_gas_bcf, 'BCF' AS units,
               'NW2_EPG0_SWO_R48_BCF' AS series, CAST(NULL AS VARCHAR) AS series_description,
               CAST(NULL AS VARCHAR) AS duoarea, region AS area_name, CAST(NULL AS VARCHAR) AS product,
               CAST(NULL AS VARCHAR) AS product_name, CAST(NULL AS VARCHAR) AS process,
               CAST(NULL AS VARCHAR) AS process_name
        FROM storage_weekly""", "storage_weekly", round_cols=("working_gas_bcf",)),
})


# ------------------------------------------------------ batch 4
ORACLE.update({
    "load_prices_range": sql_with("""SELECT date, henry_hub_usd_per_mmbtu, units, series FROM price_daily
                                     WHERE date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""", "price_daily",
                                  round_cols=("henry_hub_usd_per_mmbtu",)),
    "load_storage_region": sql_with("""SELECT date, region, working_gas_bcf, units, series FROM storage_weekly
                                       WHERE date >= DATE '1996-01-01' AND region = 'europe'""", "storage_weekly",
                                    round_cols=("working_gas_bcf",)),
    "load_region_daily_pipeline": sql_with("""SELECT * FROM region_daily_v WHERE pipeline = 'asia'
                                              AND date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'""",
                                           "region_daily_v",
                                           round_cols=("tavg_c_median", "tavg_f_median", "hdd_median", "tavg_c_mean",
                                                       "tavg_f_mean", "hdd_mean")),
    "load_capacity_range": sql_with("""SELECT pipeline, Loc_Name, TRY_CAST(trim(Post_Date) AS DATE) AS Post_Date_dt,
                                       All_Qty_Avail FROM capacity
                                       WHERE TRY_CAST(trim(Post_Date) AS DATE) BETWEEN DATE '1997-01-01'
                                         AND DATE '1997-03-31'""", "capacity"),
    "load_notices_active": sql_with("""SELECT pipeline, notice_id, posted_dt, end_dt FROM notice
                                       WHERE posted_dt >= TIMESTAMP '1998-01-01' AND posted_dt < TIMESTAMP '1998-04-01'
                                         AND (end_dt IS NULL OR end_dt >= TIMESTAMP '1998-02-15')""", "notice"),
})

ORACLE["split_stats"] = sql_with("""
    SELECT pipeline, CAST(count(*) AS BIGINT) AS rows, min(date) AS first_date, max(date) AS last_date,
           CASE WHEN date <= DATE '1998-12-31' THEN 'train' ELSE 'test' END AS split
    FROM model_frame_v GROUP BY pipeline, CASE WHEN date <= DATE '1998-12-31' THEN 'train' ELSE 'test' END""",
    "model_frame_v")

_TEST_DAYS = """
    SELECT pipeline, date, {outcome}, {known} AS scored FROM (
        SELECT *, lag(hdd) OVER w AS hdd_lag, lag(working_gas_bcf) OVER w AS gas_lag, lag(all_qty_avail_median) OVER w AS cap_lag,
               lag(notice_active_count) OVER w AS notices_lag, lag(date) OVER w AS day_lag, lag(hdd_5d) OVER w AS hdd_5d_lag
        FROM (SELECT *, hdd_median AS hdd, avg(hdd_median) OVER (PARTITION BY pipeline ORDER BY date
                        ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hdd_5d FROM model_frame_v)
        WINDOW w AS (PARTITION BY pipeline ORDER BY date))
    WHERE date > DATE '1998-06-30'"""

ORACLE["backtest_days_stress"] = sql_with(_TEST_DAYS.format(
    outcome="stress_event",
    known="hdd_lag IS NOT NULL AND gas_lag IS NOT NULL AND cap_lag IS NOT NULL AND notices_lag IS NOT NULL"), "model_frame_v")
ORACLE["backtest_days_vol"] = sql_with(_TEST_DAYS.format(
    outcome="CASE WHEN abs(hh_ret) > 0.02 THEN 1 WHEN hh_ret IS NOT NULL THEN 0 END AS realized_vol_exceed",
    known="day_lag IS NOT NULL AND hdd_5d_lag IS NOT NULL AND gas_lag IS NOT NULL"), "model_frame_v")
ORACLE["backtest_days_vol_source"] = sql_with("""
    SELECT pipeline, date, CASE WHEN abs(hh_ret) > 0.02 THEN 1 WHEN hh_ret IS NOT NULL THEN 0 END AS realized_vol_exceed,
           count(stress_event) OVER w3 = 3 AND count(hh_ret) OVER w3 = 3 AND hdd_median IS NOT NULL
           AND working_gas_bcf IS NOT NULL AND count(working_gas_bcf) OVER w1095 = 1095 AS scored
    FROM model_frame_v WHERE date > DATE '1998-06-30'
    WINDOW w3 AS (PARTITION BY pipeline ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
           w1095 AS (PARTITION BY pipeline ORDER BY date ROWS BETWEEN 1094 PRECEDING AND CURRENT ROW)""", "model_frame_v")
_MODELS = """SELECT DISTINCT pipeline, param, 0.0::DOUBLE AS gradient FROM model_frame_v,
             (SELECT unnest([{names}]) AS param)"""
ORACLE["fit_stress_gradient"] = sql_with(_MODELS.format(
    names="'a', 'b_hdd_lag1', 'b_storage_lag1', 'b_cap_avail_lag1', 'b_notices_lag1'"), "model_frame_v")
ORACLE["fit_vol_gradient"] = sql_with(_MODELS.format(
    names="'a', 'b_op', 'b_persist', 'b_hdd', 'b_storage', 'log_sigma'"), "model_frame_v")
ORACLE["lenient_dates"] = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 5 THEN CAST(o_orderdate AS DATE) END AS date FROM orders"""
ORACLE["stream_ingest"] = sql_with("""
    SELECT series, strftime(d, '%Y-%m-%d') AS date, v AS henry_hub_usd_per_mmbtu, sequence FROM (
        SELECT 'RNGWHHD' AS series, CAST(o_orderdate AS DATE) AS d,
               CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS v, o_orderkey AS sequence,
               row_number() OVER (PARTITION BY CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS rn
        FROM orders WHERE o_orderkey % 13 <> 0) WHERE rn = 1""", round_cols=("henry_hub_usd_per_mmbtu",))

ORACLE["merge_touched_parts"] = """
    SELECT 'p-' || strftime(o_orderdate, '%Y-%m') AS part,
           CAST(CASE WHEN strftime(o_orderdate, '%Y-%m') BETWEEN '1998-03' AND '1998-05' THEN 1 ELSE 0 END AS BIGINT) AS version,
           CAST(count(DISTINCT CAST(o_orderdate AS DATE)) AS BIGINT) AS rows
    FROM orders WHERE o_orderkey % 13 <> 0 GROUP BY ALL"""

_DECODED = "regexp_replace(replace({}, '&quot;', '\"'), '&amp;?', '&', 'g')"
ORACLE["page_list_extract"] = f"""
    SELECT page_id, CAST(i - 1 AS INTEGER) AS row_pos, {_DECODED.format("x[i]")} AS row_text, {_DECODED.format("h[i]")} AS href,
           regexp_extract(url, '^[a-z]+://[^/]+') || {_DECODED.format("h[i]")} AS detail_url, 1::INTEGER AS n_cells
    FROM (SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS h,
                 regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS x FROM pages),
         unnest(range(1, len(h) + 1)) AS u(i)"""


def _upsert_sql(table: str, keys: tuple[str, ...], values: tuple[str, ...]) -> str:
    cols = ", ".join(keys + values)
    stored = f"""(SELECT {", ".join(keys)}, {", ".join(f"{v} + CASE WHEN day(date) % 2 = 0 THEN 1 ELSE 0 END AS {v}" for v in values)}
                  FROM {table} WHERE day(date) % 3 <> 0)"""
    sent = f"(SELECT {cols} FROM {table} WHERE day(date) % 3 <> 1 AND day(date) {{}} 29)"
    same = " AND ".join(f"e.{v} IS NOT DISTINCT FROM i.{v}" for v in values)
    old, new = "TIMESTAMP '2000-01-01 00:00:00'", "TIMESTAMP '2001-01-01 00:00:00'"
    return sql_with(f"""
        SELECT {", ".join(f"coalesce(e.{k}, i.{k}) AS {k}" for k in keys)},
               {", ".join(f"CASE WHEN i.date IS NOT NULL THEN i.{v} ELSE e.{v} END AS {v}" for v in values)},
               CASE WHEN e.date IS NOT NULL THEN {old} ELSE {new} END AS created_at_utc,
               CASE WHEN i.date IS NOT NULL THEN {new} ELSE {old} END AS updated_at,
               CASE WHEN e.date IS NULL THEN 'insert' WHEN i.date IS NULL THEN 'keep' WHEN {same} THEN 'unchanged'
                    ELSE 'update' END AS _action
        FROM {stored} e FULL OUTER JOIN {sent.format("<>")} i ON {" AND ".join(f"e.{k} = i.{k}" for k in keys)}
        UNION ALL
        SELECT CAST(NULL AS VARCHAR), {", ".join((*keys[1:], *values))}, {new}, {new}, 'unkeyed' FROM {sent.format("=")}""",
                    table, round_cols=tuple(v for v in values if v != "n_stations_used"))


ORACLE["upsert_station_days"] = _upsert_sql("station_day", ("ghcnd_station_id", "date"), ("tavg_c", "hdd"))
ORACLE["upsert_region_days"] = _upsert_sql("region_daily_v", ("pipeline", "date"), ("hdd_median", "n_stations_used"))
ORACLE["upsert_storage"] = _upsert_sql("storage_weekly", ("region", "date"), ("working_gas_bcf",))


# ------------------------------------------------------ batch 7: stored documents merged by key
def _documents_sql(names, keys, stored, sent, values, provider, round_cols):
    """``stored`` and ``sent``: SELECTs with the keys (date as DATE); ``values``: per column whether it is in the stored and in
    the sent documents, and its type. Days of the month decide what is stored and what is sent."""
    new = "TIMESTAMP '2001-01-01 00:00:00'"
    text = lambda k: "strftime(CAST(date AS DATE), '%Y-%m-%d') AS date" if k == "date" else k
    fields = ", ".join(
        f"CASE WHEN i.hit THEN i.{c} ELSE e.{c} END AS {c}" if e and i else
        f"CASE WHEN i.hit THEN i.{c} END AS {c}" if i else f"e.{c}" for c, (e, i) in values.items())
    key = ", ".join(f"coalesce(e.{k}, i.{k}) AS {k}" for k in keys)
    cols = ", ".join(text(k) for k in keys)
    has = lambda side: ", ".join(c for c, v in values.items() if v[side])
    bad = " OR ".join(f"{k} IS NULL" for k in keys)
    lone = ", ".join(c if v[1] else f"NULL AS {c}" for c, v in values.items())
    return sql_with(f"""SELECT * FROM (
        WITH e AS (SELECT {cols}, {has(0)}, true AS hit FROM ({stored}) WHERE day(CAST(date AS DATE)) % 3 <> 0),
        i AS (SELECT {cols}, {has(1)}, true AS hit FROM ({sent}) WHERE day(CAST(date AS DATE)) % 3 <> 1)
        SELECT {key}, {fields},
               CASE WHEN i.hit THEN '{provider}' ELSE 'old' END AS source_provider,
               CASE WHEN e.hit THEN 'archive' END AS source_dataset, CASE WHEN e.hit THEN 'box 7' END AS source_shelf,
               CASE WHEN i.hit THEN {new} END AS updated_at_utc,
               CASE WHEN i.hit THEN {new} END AS created_at_utc,
               CASE WHEN i.hit THEN {new} END AS updated_at,
               CASE WHEN e.hit IS NULL THEN 'insert' WHEN i.hit IS NULL THEN 'keep' ELSE 'update' END AS _action
        FROM e FULL OUTER JOIN (SELECT * FROM i WHERE NOT ({bad})) i ON {" AND ".join(f"e.{k} = i.{k}" for k in keys)}
        UNION ALL BY NAME
        SELECT {", ".join(keys)}, {lone}, '{provider}' AS source_provider, NULL AS source_dataset, NULL AS source_shelf,
               {new} AS updated_at_utc, {new} AS created_at_utc, {new} AS updated_at, 'unkeyed' AS _action
        FROM i WHERE {bad})""", *names, round_cols=round_cols)


def _station_documents_sql(shift: str, known: str) -> str:
    return f"""
        SELECT p.pipeline, d.ghcnd_station_id, d.date, d.tavg_c {shift} AS tavg_c, d.tmin_c, d.tmax_c, d.hdd,
               m.pipeline AS station_meta_pipeline, m.ghcnd_station_id AS station_meta_ghcnd_station_id,
               m.station_name AS station_meta_station_name, m.state AS station_meta_state
        FROM station_day d JOIN station_pipeline p ON d.ghcnd_station_id = p.ghcnd_station_id LEFT JOIN (
          SELECT sp.pipeline, sp.ghcnd_station_id, s.s_name AS station_name, n.n_name AS state
          FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
          JOIN station_pipeline sp ON sp.ghcnd_station_id = 'ST' || CAST(s.s_suppkey AS VARCHAR)
          WHERE {known}) m ON d.ghcnd_station_id = m.ghcnd_station_id"""


_BOTH, _OLD_ONLY, _NEW_ONLY = (True, True), (True, False), (False, True)
ORACLE["merge_station_documents"] = _documents_sql(
    ("station_day", "station_pipeline"), ("pipeline", "ghcnd_station_id", "date"),
    _station_documents_sql("+ 1", "true"), _station_documents_sql("", "sp.ghcnd_station_id > 'ST5'"),
    {c: _BOTH for c in ("tavg_c", "tmin_c", "tmax_c", "hdd", "station_meta_pipeline", "station_meta_ghcnd_station_id",
                        "station_meta_station_name", "station_meta_state")}, "NOAA", ("tavg_c", "tmin_c", "tmax_c", "hdd"))
_REGION_VALUES = ("tavg_c_median", "tavg_f_median", "tavg_c_mean")
ORACLE["merge_region_documents"] = _documents_sql(
    ("region_daily_v",), ("pipeline", "region_id", "date"), "SELECT * FROM region_daily_v",
    "SELECT * REPLACE (hdd_mean + 1 AS hdd_mean) FROM region_daily_v",
    {c: _BOTH for c in ("n_stations_used", *_REGION_VALUES, "hdd_mean")} | {"hdd_median": _OLD_ONLY, "tavg_f_mean": _NEW_ONLY},
    "NOAA", (*_REGION_VALUES, "hdd_mean", "hdd_median", "tavg_f_mean"))
_PRICES = f"""SELECT series, date, henry_hub_usd_per_mmbtu AS value, '$/MMBTU' AS units FROM ({_prices_by_day("max")})"""
ORACLE["merge_price_documents"] = _documents_sql(
    (), ("series", "date"), _PRICES, _PRICES, {"value": _BOTH, "units": _OLD_ONLY}, "EIA", ("value",))
_STORAGE = "SELECT {} AS series, region, date, working_gas_bcf AS value, units FROM storage_weekly"
ORACLE["merge_storage_documents"] = _documents_sql(
    ("storage_weekly",), ("series", "region", "date"), _STORAGE.format("series"),
    _STORAGE.format("CASE WHEN day(date) % 5 <> 0 THEN series END"), {"value": _BOTH, "units": _OLD_ONLY}, "EIA", ("value",))
