"""Grouped aggregations.

All of them are ``groupBy().agg()`` with built-in aggregate functions, so
Spark plans partial (map-side) aggregation before the shuffle; a hot group
key is combined on every mapper first. Medians and quartiles are exact and come
from ranks over ranges of value counts (``operators/ranks.py``): no buffer or
task holds the values of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stresscast.functions.scalar import c_to_f, strip_ws, to_date_lenient, to_double
from stresscast.operators.ranks import counted_ranges, join_null_safe, medians, quantiles_of

REGION_DAILY_COLS = ("pipeline", "region_id", "date", "n_stations_used", "tavg_c_median", "tavg_f_median",
                     "hdd_median", "tavg_c_mean", "tavg_f_mean", "hdd_mean")


def aggregate_region_daily(station_day: DataFrame, keys: Sequence[str] = ("pipeline", "region_id"),
                           station_col: str = "ghcnd_station_id", stations_unique: bool = False) -> DataFrame:
    """A1: per (keys, date) over stations with a temperature.

    Rows without ``tavg_c`` are dropped; distinct stations, median and mean of
    tavg_c and hdd, Fahrenheit of the median and the mean. ``stations_unique``
    states that the input has at most one row with a station per (station, date) (e.g. it is
    the output of a group-by on those keys); the number of stations is then the number of
    rows and the input is read once. Otherwise stations are counted in a second pass over
    the station column. The result is the same.
    """
    by = [*keys, "date"]
    v = station_day.where(F.col("tavg_c").isNotNull())
    g = medians(v, ["tavg_c", "hdd"], by)
    if stations_unique:
        g = g.withColumn("n_stations_used", F.col("tavg_c_n"))
    else:
        g = join_null_safe(g, v.groupBy(*by).agg(F.count_distinct(station_col).alias("n_stations_used")), by)
    return g.select(*by, F.col("n_stations_used").cast("bigint").alias("n_stations_used"),
                    "tavg_c_median", c_to_f("tavg_c_median").alias("tavg_f_median"), "hdd_median",
                    "tavg_c_mean", c_to_f("tavg_c_mean").alias("tavg_f_mean"), "hdd_mean")


def capacity_daily_median(cap: DataFrame, keys: Sequence[str] = ("pipeline",), date_col: str = "Post_Date",
                          qty_col: str = "All_Qty_Avail") -> DataFrame:
    """A2: daily median of the available quantity; bad dates dropped, bad numbers ignored."""
    by = [*keys, "date"]
    d = cap.select(*keys, to_date_lenient(strip_ws(F.col(date_col).cast("string"))).alias("date"),
                   to_double(strip_ws(F.col(qty_col).cast("string"))).alias("_q")).where(F.col("date").isNotNull())
    return medians(d, ["_q"], by).select(*by, F.col("_q_median").alias("all_qty_avail_median"))


def fit_scalers(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """A4: mean and population std per column (NULLs ignored), one row per key."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return df.groupBy(*keys).agg(*aggs)


def scalers_long(wide: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Scaler map as one row per (keys, feature): feature, mean, std."""
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"),
                                        F.col(f"{c}__std").alias("std")) for c in cols]))
    return wide.select(*keys, rows.alias("_s")).select(*keys, "_s.*")


def exceed_prob(col, threshold: float) -> Column:
    """A5: Monte-Carlo exceedance probability mean(x > t) as an aggregate expression."""
    c = F.col(col) if isinstance(col, str) else col
    return F.avg(F.when(c > F.lit(threshold), 1.0).otherwise(0.0))


DESCRIBE_COLS = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation), max.

    All from one table of value counts (``operators/ranks.py``), so the input is read
    once. A key without values has count 0 and NULL statistics; without keys there is always one row. Not
    ``DataFrame.summary()``, whose quantiles are approximate.
    """
    keys = list(keys)
    x, c, n = F.col("_x"), F.col("_c"), F.col("count")
    # a row without a value is kept with weight 0, so that its key is in the result
    weighted = df.select(*keys, F.coalesce(F.col(col).cast("double"), F.lit(0.0)).alias("_x"),
                         F.col(col).isNotNull().cast("long").alias("_w"))
    table = counted_ranges(weighted, keys, "_x", {"_c": F.sum("_w")})
    known = F.when(c > 0, x)
    base = table.groupBy(*keys).agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("count"), F.sum(x * c).alias("_sum"),
                                    F.min(known).alias("min"), F.max(known).alias("max"))
    base = base.withColumn("mean", F.col("_sum") / F.nullif(n, F.lit(0)))
    spread = join_null_safe(table, base.select(*keys, "mean"), keys).groupBy(*keys).agg(
        F.sum(c * F.pow(x - F.col("mean"), 2)).alias("_squares"))
    quartiles = quantiles_of(table.where("_c > 0"), keys, "_x", [0.25, 0.5, 0.75], "_c", "_p").drop("_c_all")
    g = join_null_safe(join_null_safe(base, spread, keys, "left"), quartiles, keys, "left")
    return g.select(*keys, n.cast("bigint").alias("count"), "mean",
                    F.when(n > 1, F.sqrt(F.col("_squares") / (n - 1))).alias("std"), "min",
                    F.col("_p0").alias("p25"), F.col("_p1").alias("p50"), F.col("_p2").alias("p75"), "max")


def grouped_mean(df: DataFrame, by: Sequence[str], col: str, name: str | None = None) -> DataFrame:
    """Mean per group (e.g. observed frequency per score bin)."""
    return df.groupBy(*by).agg(F.avg(col).alias(name or f"{col}_mean"))


def crosstab_normalized(df: DataFrame, row_col: str, col_col: str, values: Sequence = (0, 1),
                        keys: Sequence[str] = ()) -> DataFrame:
    """Contingency table normalized by row total; rows/columns with NULL are left out."""
    d = df.where(F.col(row_col).isNotNull() & F.col(col_col).isNotNull())
    cnt = [F.sum(F.when(F.col(col_col) == F.lit(v), 1).otherwise(0)).alias(f"_n{i}") for i, v in enumerate(values)]
    g = d.groupBy(*keys, row_col).agg(*cnt, F.count(F.lit(1)).alias("_tot"))
    return g.select(*keys, row_col, *[(F.col(f"_n{i}") / F.col("_tot")).alias(f"frac_{v}")
                                      for i, v in enumerate(values)])


def split_stats(df: DataFrame, date_col: str = "date", keys: Sequence[str] = ()) -> DataFrame:
    """Rows, first and last date."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                 F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))
