"""M1: the daily model frame, one lazy plan over every pipeline at once.

calendar = weather days per pipeline; left joins to the daily price (J1),
the forward-filled daily storage (J2, W7), the notice stress signal (J3, A3,
zero-filled) and the daily capacity median (J4, A2); then the log return of
the price over the pipeline's rows (W1).

Physical shape: every input is first reduced to at most one row per
(pipeline, day) by its own aggregate, so all joins are between day-grain
tables. The daily price has no pipeline key and is bounded by the number of
calendar days; AQE turns its join into a broadcast at run time when the
measured size is below the broadcast threshold, and keeps a shuffle join
otherwise. No broadcast is forced on a table that grows with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stresscast.functions.scalar import safe_ln
from stresscast.operators.dedupe import ensure_daily
from stresscast.operators.windows import series_window
from stresscast.sources.tables import date_between

FRAME_COLS = ("pipeline", "region_id", "date", "hdd_mean", "hdd_median", "n_stations_used",
              "henry_hub_usd_per_mmbtu", "working_gas_bcf", "notice_active_count", "critical_active",
              "stress_event", "all_qty_avail_median", "hh_log", "hh_ret")


@dataclass(frozen=True)
class FrameConfig:
    """Window of the frame; ``None`` bounds are open. ``dedupe`` enforces one row per day
    on every input (skip only when inputs are unique by construction)."""
    start: str | None = None
    end: str | None = None
    dedupe: bool = True


def build_model_frame(weather: DataFrame, price: DataFrame, storage_daily: DataFrame | None,
                      stress: DataFrame, capacity_median: DataFrame, cfg: FrameConfig = FrameConfig(),
                      keys: Sequence[str] = ("pipeline",), storage_key: str | None = "region") -> DataFrame:
    """Join the day-grain inputs onto the weather calendar of each pipeline.

    A ``source`` column of the weather (its provenance) is carried to the last column of the frame.

    ``storage_daily`` has ``storage_key`` (matched to the pipeline) or no key
    (one series for every pipeline); ``None`` leaves the column NULL.
    """
    keys = list(keys)
    rng = date_between("date", cfg.start, cfg.end)
    base = weather.where(rng)
    if cfg.dedupe:
        base = ensure_daily(base, keys, "date", ["region_id"])
    source = [c for c in ("source",) if c in weather.columns]
    base = base.select(*keys, "region_id", "date", "hdd_mean", "hdd_median", "n_stations_used", *source)

    hh = price.where(rng)
    if cfg.dedupe:
        hh = ensure_daily(hh, [], "date")
    df = base.join(hh.select("date", "henry_hub_usd_per_mmbtu"), "date", "left")

    if storage_daily is not None:
        st = storage_daily.where(rng)
        if storage_key and storage_key in st.columns:
            st = st.select(F.col(storage_key).alias(keys[0]), "date", "working_gas_bcf")
            df = df.join(st, [keys[0], "date"], "left")
        else:
            df = df.join(st.select("date", "working_gas_bcf"), "date", "left")
    else:
        df = df.withColumn("working_gas_bcf", F.lit(None).cast("double"))

    df = df.join(stress.where(rng).select(*keys, "date", "notice_active_count", "critical_active", "stress_event"),
                 keys + ["date"], "left")
    df = df.join(capacity_median.where(rng).select(*keys, "date", "all_qty_avail_median"), keys + ["date"], "left")
    df = df.withColumns({
        "notice_active_count": F.coalesce("notice_active_count", F.lit(0)).cast("bigint"),
        "critical_active": F.coalesce("critical_active", F.lit(0)).cast("int"),
        "stress_event": F.coalesce("stress_event", F.lit(0)).cast("int"),
        "hh_log": safe_ln("henry_hub_usd_per_mmbtu"),
    })
    df = df.withColumn("hh_ret", F.col("hh_log") - F.lag("hh_log").over(series_window(keys, "date")))
    return df.select(*keys, *[c for c in FRAME_COLS if c not in keys], *source)
