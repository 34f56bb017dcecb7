"""Input views derived from the driver's TPC-H-like tables.

The reference system ingests weather, prices, storage, notices and capacity
postings; the test tables carry none of those, so each input is *derived* from
a driver table by a fixed rule, written once for Spark (here) and once as SQL
(:data:`VIEW_SQL`) for the DuckDB oracle. Every view reads its whole table,
so its work grows with the scale factor.

Fixed derivation rules (must be identical in both forms):

* geography: supplier/customer -> nation -> region; pipeline = lower(r_name),
  region_id = 'r' || r_regionkey
* station_raw: one station per supplier ('ST' || l_suppkey), one row per
  (supplier, ship day); tenths of a degree C:
  TAVG = avg(l_quantity where l_returnflag = 'A') * 10 - 100 (NULL when no such row),
  TMIN = min(l_quantity) * 10 - 100, TMAX = max(l_quantity) * 10 - 100
* price_daily: max(o_totalprice) / 1000 per order day; NULL on days whose
  day-of-month is a multiple of 7
* storage_weekly: sum(o_totalprice) / 10000 per (customer region, Monday week);
  NULL when (days since 1970-01-05) / 7 is a multiple of 9
* notice: one per order; posted = o_orderdate + (o_orderkey % 24) hours;
  effective = posted + (key % 3) days, NULL when key % 10 = 0;
  end = NULL when key % 5 = 0, effective - 2 days when key % 17 = 0,
  else effective + (key % 14) days; critical = (o_orderpriority = '1-URGENT')
* capacity: one posting per line item; Loc_Name = 'LOC' || l_partkey,
  Post_Date = ship day as text ('not a date' when l_linenumber = 6),
  All_Qty_Avail = quantity * 1000 as text ('n/a' when l_linenumber = 7,
  padded with spaces when l_linenumber = 3)
* scored: events; outcome = (event_type = 'error'), score = value
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stresscast.sources.tables import read_table


def supplier_geo(spark: SparkSession, base: str) -> DataFrame:
    sup = read_table(spark, base, "supplier").select("s_suppkey", "s_nationkey")
    return _geo(spark, base, sup, "s_nationkey").select("s_suppkey", "pipeline", "region_id")


def customer_geo(spark: SparkSession, base: str) -> DataFrame:
    cus = read_table(spark, base, "customer").select("c_custkey", "c_nationkey")
    return _geo(spark, base, cus, "c_nationkey").select("c_custkey", "pipeline", "region_id")


def _geo(spark, base, df, nation_col):
    nat = read_table(spark, base, "nation").select("n_nationkey", "n_regionkey")
    reg = read_table(spark, base, "region").select("r_regionkey", "r_name")
    geo = (df.join(nat, df[nation_col] == nat.n_nationkey)
             .join(reg, nat.n_regionkey == reg.r_regionkey)
             .withColumn("pipeline", F.lower("r_name"))
             .withColumn("region_id", F.concat(F.lit("r"), F.col("r_regionkey").cast("string"))))
    # a dimension (one row per supplier/customer): broadcast when its checked size allows
    return geo


def station_raw(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_returnflag")
    g = li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("DATE")).agg(
        (F.avg(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))) * 10 - 100).alias("TAVG"),
        (F.min("l_quantity") * 10 - 100).alias("TMIN"),
        (F.max("l_quantity") * 10 - 100).alias("TMAX"))
    return g.select(F.concat(F.lit("ST"), F.col("l_suppkey").cast("string")).alias("ghcnd_station_id"),
                    "l_suppkey", "DATE", "TAVG", "TMIN", "TMAX")


def station_pipeline(spark: SparkSession, base: str) -> DataFrame:
    """Station -> (pipeline, region_id): the station map derived from suppliers."""
    return supplier_geo(spark, base).select(
        F.concat(F.lit("ST"), F.col("s_suppkey").cast("string")).alias("ghcnd_station_id"), "pipeline", "region_id")


def price_daily(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders").select("o_orderdate", "o_totalprice")
    g = o.groupBy(F.to_date("o_orderdate").alias("date")).agg((F.max("o_totalprice") / 1000.0).alias("_v"))
    return g.select("date", F.when(F.dayofmonth("date") % 7 != 0, F.col("_v")).alias("henry_hub_usd_per_mmbtu"),
                    F.lit("$/MMBTU").alias("units"), F.lit("RNGWHHD").alias("series"))


def storage_weekly(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    j = o.join(customer_geo(spark, base), o.o_custkey == F.col("c_custkey"))
    week = F.trunc(F.to_date("o_orderdate"), "week")
    g = j.groupBy(F.col("pipeline").alias("region"), week.alias("date")).agg(
        (F.sum("o_totalprice") / 10000.0).alias("_v"))
    wk = F.expr("datediff(date, DATE'1970-01-05') div 7")
    return g.select("region", "date", F.when(wk % 9 != 0, F.col("_v")).alias("working_gas_bcf"),
                    F.lit("BCF").alias("units"), F.lit("NW2_EPG0_SWO_R48_BCF").alias("series"))


def notice(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    j = o.join(customer_geo(spark, base), o.o_custkey == F.col("c_custkey"))
    k = F.col("o_orderkey")
    posted = F.timestamp_add("HOUR", (k % 24).cast("int"), F.col("o_orderdate"))
    eff = F.when(k % 10 != 0, F.timestamp_add("DAY", (k % 3).cast("int"), posted))
    end = (F.when(k % 5 == 0, F.lit(None))
            .when(k % 17 == 0, F.timestamp_add("DAY", F.lit(-2), eff))
            .otherwise(F.timestamp_add("DAY", (k % 14).cast("int"), eff)))
    return j.select("pipeline", F.upper("pipeline").alias("tsp"), k.alias("notice_id"),
                    posted.alias("posted_dt"), eff.alias("effective_dt"), end.alias("end_dt"),
                    (F.col("o_orderpriority") == "1-URGENT").alias("critical"))


def capacity(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
                                                    "l_quantity")
    j = li.join(supplier_geo(spark, base), li.l_suppkey == F.col("s_suppkey"))
    qty = (F.col("l_quantity").cast("bigint") * 1000).cast("string")
    ln = F.col("l_linenumber")
    return j.select(
        "pipeline", F.upper("pipeline").alias("TSP"),
        F.concat(F.lit("LOC"), F.col("l_partkey").cast("string")).alias("Loc_Name"),
        F.when(ln == 6, F.lit("not a date")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd")).alias("Post_Date"),
        F.when(ln == 7, F.lit("n/a")).when(ln == 3, F.concat(F.lit("  "), qty, F.lit(" ")))
         .otherwise(qty).alias("All_Qty_Avail"))


def scored(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return e.select("event_id", "user_id", "ts", F.to_date("ts").alias("date"),
                    F.col("value").alias("score"), (F.col("event_type") == "error").cast("int").alias("outcome"))


# ---------------------------------------------------------------- SQL forms
VIEW_SQL = {
    "supplier_geo": """
        SELECT s.s_suppkey, lower(r.r_name) AS pipeline, 'r' || CAST(r.r_regionkey AS VARCHAR) AS region_id
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "customer_geo": """
        SELECT c.c_custkey, lower(r.r_name) AS pipeline, 'r' || CAST(r.r_regionkey AS VARCHAR) AS region_id
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "station_raw": """
        SELECT 'ST' || CAST(l_suppkey AS VARCHAR) AS ghcnd_station_id, l_suppkey, CAST(l_shipdate AS DATE) AS "DATE",
               avg(CASE WHEN l_returnflag = 'A' THEN l_quantity END) * 10 - 100 AS TAVG,
               min(l_quantity) * 10 - 100 AS TMIN, max(l_quantity) * 10 - 100 AS TMAX
        FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""",
    "station_pipeline": """
        SELECT 'ST' || CAST(s_suppkey AS VARCHAR) AS ghcnd_station_id, pipeline, region_id FROM supplier_geo""",
    "station_day": """
        SELECT ghcnd_station_id, "DATE" AS date,
               coalesce(TAVG / 10.0, (TMIN / 10.0 + TMAX / 10.0) / 2.0) AS tavg_c, TMIN / 10.0 AS tmin_c,
               TMAX / 10.0 AS tmax_c,
               CASE WHEN coalesce(TAVG / 10.0, (TMIN / 10.0 + TMAX / 10.0) / 2.0) IS NOT NULL THEN
                 greatest(0.0, 65.0 - (coalesce(TAVG / 10.0, (TMIN / 10.0 + TMAX / 10.0) / 2.0) * 9.0 / 5.0 + 32.0))
               END AS hdd
        FROM station_raw""",
    "price_daily": """
        SELECT date, CASE WHEN day(date) % 7 <> 0 THEN v END AS henry_hub_usd_per_mmbtu,
               '$/MMBTU' AS units, 'RNGWHHD' AS series
        FROM (SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) / 1000.0 AS v
              FROM orders GROUP BY CAST(o_orderdate AS DATE))""",
    "storage_weekly": """
        SELECT region, date, CASE WHEN ((date - DATE '1970-01-05') // 7) % 9 <> 0 THEN v END AS working_gas_bcf,
               'BCF' AS units, 'NW2_EPG0_SWO_R48_BCF' AS series
        FROM (SELECT g.pipeline AS region, CAST(date_trunc('week', o.o_orderdate) AS DATE) AS date,
                     sum(o.o_totalprice) / 10000.0 AS v
              FROM orders o JOIN customer_geo g ON o.o_custkey = g.c_custkey
              GROUP BY g.pipeline, CAST(date_trunc('week', o.o_orderdate) AS DATE))""",
    "notice": """
        SELECT pipeline, upper(pipeline) AS tsp, notice_id, posted_dt, effective_dt,
               CASE WHEN notice_id % 5 = 0 THEN NULL
                    WHEN notice_id % 17 = 0 THEN effective_dt - INTERVAL 2 DAY
                    ELSE effective_dt + to_days(CAST(notice_id % 14 AS INTEGER)) END AS end_dt,
               critical
        FROM (SELECT g.pipeline, o.o_orderkey AS notice_id,
                     o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) AS posted_dt,
                     CASE WHEN o.o_orderkey % 10 <> 0 THEN
                       o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER))
                         + to_days(CAST(o.o_orderkey % 3 AS INTEGER)) END AS effective_dt,
                     o.o_orderpriority = '1-URGENT' AS critical
              FROM orders o JOIN customer_geo g ON o.o_custkey = g.c_custkey)""",
    "capacity": """
        SELECT g.pipeline, upper(g.pipeline) AS TSP, 'LOC' || CAST(l.l_partkey AS VARCHAR) AS Loc_Name,
               CASE WHEN l.l_linenumber = 6 THEN 'not a date' ELSE strftime(l.l_shipdate, '%Y-%m-%d') END AS Post_Date,
               CASE WHEN l.l_linenumber = 7 THEN 'n/a'
                    WHEN l.l_linenumber = 3 THEN '  ' || CAST(CAST(l.l_quantity AS BIGINT) * 1000 AS VARCHAR) || ' '
                    ELSE CAST(CAST(l.l_quantity AS BIGINT) * 1000 AS VARCHAR) END AS All_Qty_Avail
        FROM lineitem l JOIN supplier_geo g ON l.l_suppkey = g.s_suppkey""",
    "scored": """
        SELECT event_id, user_id, ts, CAST(ts AS DATE) AS date, value AS score,
               CAST(event_type = 'error' AS INTEGER) AS outcome
        FROM events""",
}

# Dependencies between views, so a query's WITH clause carries only what it needs.
VIEW_DEPS = {
    "station_pipeline": ["supplier_geo"],
    "station_day": ["station_raw"],
    "storage_weekly": ["customer_geo"],
    "notice": ["customer_geo"],
    "capacity": ["supplier_geo"],
}


def with_views(*names: str) -> str:
    """A ``WITH`` prefix defining the named views (and what they depend on), in order."""
    order: list[str] = []

    def add(n):
        for d in VIEW_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in order)
