"""Ranks of values by key, in ranges that follow the data.

An order statistic of a key needs the number of rows below each value. No key is gathered in one task for it:

1. rows are counted per (keys, value), so a value that a third of all rows hold is one row after the map side;
2. the counts go through one range exchange by (keys, value): as many ranges as the exchange has tasks, cut where the
   data lie, so a hot key is many ranges and many small keys are one. Each task sorts its range and adds a running sum
   per key as it streams by (Arrow batches; nothing is held but the last key). The result is written once in the shared
   folder; the input is read once and a lost executor repeats single tasks;
3. sums per (keys, range), one row for each key that a range touches, give every range's offset within its key. A value's
   rank is that offset and its running sum.

After the range exchange only these small tables are exchanged, the counts stay where they are.
NULL values have no rank; NULL keys are a key like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from stresscast.operators.joins import attach_row
from stresscast.session import staged

RANGE = "_range"


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL equals NULL; the key columns are the left side's. Without keys ``right`` is one row."""
    if not keys:
        return attach_row(left, right)
    renamed = right.select([F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def counted_ranges(df: DataFrame, keys: Sequence[str], value: str, sums: Mapping[str, Column],
                   running: Sequence[str] | None = None) -> DataFrame:
    """Sums per (keys, value), written with the number of the range (``_range``) each value fell into.

    Ranges are disjoint and ordered: within a key every value of a lower range is lower. For each of ``running`` (all
    sums by default) ``<sum>_below`` is its total over the lower values of the same key and range. Sums that run are integers.
    """
    running = list(sums) if running is None else list(running)
    counts = (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
              .agg(*[s.alias(name) for name, s in sums.items()]))
    schema = StructType([*counts.schema, *[StructField(f"{c}_below", LongType()) for c in running], StructField(RANGE, IntegerType())])

    def run(batches):
        from pyspark import TaskContext
        number, last, before = TaskContext.get().partitionId(), None, dict.fromkeys(running, 0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(k) for k in keys]
            new = np.zeros(n, bool)
            new[0] = [c[0].as_py() for c in columns] != last
            for c in columns:
                new[1:] |= _differs(c.slice(1), c.slice(0, n - 1))
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # 0 too for rows that go on from the last batch
            below = []
            for c in running:
                v = batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                total = np.cumsum(v)
                since = total - v - np.concatenate([[0], total])[first]
                if not new[0]:
                    going_on = n if not new.any() else int(np.argmax(new))
                    since[:going_on] += before[c]
                below.append(pa.array(since))
                before[c] = int(since[-1] + v[-1])
            last = [c[n - 1].as_py() for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *below, pa.array(np.full(n, number, np.int32))], names=schema.names)

    ranged = counts.repartitionByRange(*keys, value).sortWithinPartitions(*keys, value)
    return staged(ranged.mapInArrow(run, schema), "ranges")


def _differs(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether two columns differ row by row; NULL is equal to NULL and NaN to NaN."""
    differ = pc.fill_null(pc.not_equal(a, b), False)
    if pa.types.is_floating(a.type):
        differ = pc.and_not(differ, pc.and_(pc.fill_null(pc.is_nan(a), False), pc.fill_null(pc.is_nan(b), False)))
    return pc.or_(differ, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def range_totals(table: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Per (keys, range) and sum: ``<sum>_before`` (in lower ranges), ``<sum>_here`` and ``<sum>_all`` (of the key).

    The window runs over one row per range that the key touches.
    """
    key = Window.partitionBy(*keys)
    lower = key.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    here = table.groupBy(*keys, RANGE).agg(*[F.sum(s).alias(f"{s}_here") for s in sums])
    return here.withColumns({f"{s}_before": F.coalesce(F.sum(f"{s}_here").over(lower), F.lit(0)) for s in sums}
                            | {f"{s}_all": F.sum(f"{s}_here").over(key) for s in sums})


def interpolated(lo: Column, hi: Column, position: Column) -> Column:
    """Value at a fractional position between the values at its floor and ceiling, as ``percentile`` computes it."""
    lo, hi = lo.cast("double"), hi.cast("double")
    below, above = F.floor(position), F.ceil(position)
    # equal neighbours return the value itself (0.3 v + 0.7 v need not be exactly v)
    return F.when((below == above) | (lo == hi), lo).otherwise((above - position) * lo + (position - below) * hi)


def quantiles_of(table: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], count: str,
                 prefix: str = "q") -> DataFrame:
    """Quantiles per key from a table of :func:`counted_ranges`: columns ``<prefix>0 ..`` and ``<count>_all``."""
    totals = range_totals(table, keys, [count])
    n, before, here = F.col(f"{count}_all"), F.col(f"{count}_before"), F.col(f"{count}_here")
    position = [(n - 1) * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(F.array(*[f(p) for p in position for f in (F.floor, F.ceil)]))
    cells = totals.where(F.exists(ranks, lambda r: (r >= before) & (r < before + here)))
    rows = join_null_safe(table, cells, [*keys, RANGE]).withColumn("_start", before + F.col(f"{count}_below"))
    has = lambda rank: (F.col("_start") <= rank) & (rank < F.col("_start") + F.col(count))
    picked = rows.groupBy(*keys).agg(F.max(n).alias(f"{count}_all"), *[
        F.max(F.when(has(f(p)), F.col(value))).alias(f"_{side}{i}")
        for i, p in enumerate(position) for side, f in (("lo", F.floor), ("hi", F.ceil))])
    return picked.select(*keys, f"{count}_all", *[
        interpolated(F.col(f"_lo{i}"), F.col(f"_hi{i}"), p).alias(f"{prefix}{i}") for i, p in enumerate(position)])


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], keys: Sequence[str] = (),
                    prefix: str = "q") -> DataFrame:
    """One row per key that has values, with columns ``{prefix}0 .. {prefix}{k-1}`` (linear interpolation)."""
    keys = list(keys)
    table = counted_ranges(df, keys, col, {"_c": F.count(F.lit(1))})
    return quantiles_of(table, keys, col, probs, "_c", prefix).drop("_c_all")


def medians(df: DataFrame, cols: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Exact median, number and mean of several columns per key in one pass: ``<col>_median``, ``<col>_n``, ``<col>_mean``.

    One row for every key of the input; a column without values has n 0 and NULL median and mean.
    """
    keys = list(keys)
    one = F.explode(F.array(*[F.struct(F.lit(i).alias("_m"), F.col(c).cast("double").alias("_v"))
                              for i, c in enumerate(cols)]))
    long = df.select(*keys, one.alias("_s")).select(*keys, "_s._m", "_s._v")
    # a row without a value is kept with weight 0, so that its key is in the result
    weight = F.col("_v").isNotNull().cast("long")
    table = counted_ranges(long.select(*keys, "_m", F.coalesce("_v", F.lit(0.0)).alias("_v"), weight.alias("_w")),
                           [*keys, "_m"], "_v", {"_c": F.sum("_w")})
    mid = quantiles_of(table.where("_c > 0"), [*keys, "_m"], "_v", [0.5], "_c", "_median")
    sums = table.groupBy(*keys, "_m").agg((F.sum(F.col("_v") * F.col("_c")) / F.nullif(F.sum("_c"), F.lit(0))).alias("_mean"))
    both = join_null_safe(sums, mid, [*keys, "_m"], "left")
    pick = lambda i, c: F.max(F.when(F.col("_m") == i, F.col(c)))
    return both.groupBy(*keys).agg(*[e for i, c in enumerate(cols) for e in (
        pick(i, "_median0").alias(f"{c}_median"), F.coalesce(pick(i, "_c_all"), F.lit(0)).alias(f"{c}_n"),
        pick(i, "_mean").alias(f"{c}_mean"))])
