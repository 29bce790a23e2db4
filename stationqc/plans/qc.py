"""Batch QC, sequential (level-by-level) QC and the long-term overlay.

Each function returns a small result object holding DataFrames.  The
exchange key alternates between time (spatial tests) and station
(completeness, temporal tests); the sequential plan stores every level as a
compressed table in the cluster's checkpoint folder, so a lost executor recomputes
at most one level.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, functions as F

from stationqc.functions.columns import mask, round_to
from stationqc.operators import completeness as C
from stationqc.operators import temporal as T
from stationqc.operators.buddy import buddy_check, eligible_times
from stationqc.operators.grid import apply_masks, combine_flags, current_level
from stationqc.operators.seasonal import seasonal_good
from stationqc.operators.spatial import sct
from stationqc.params import (BATCH_BUDDY, BATCH_SCT, BATCH_SEASON_LIMITS, OVERLAY, SEQUENTIAL_BUDDY,
                              SEQUENTIAL_SCT, SEQUENTIAL_SEASON_LIMITS, BuddyParams, LongTermParams, SctParams)
from stationqc.session import spread, store
from stationqc.sources.files import write_qc_dataset


@dataclass
class QcResult:
    grid: DataFrame                      # long grid with values, flags and levels
    stats: DataFrame                     # one row
    time_mask: DataFrame | None = None   # (t, keep_t)
    station_mask: DataFrame | None = None  # (sid, keep_s)
    extra: dict = field(default_factory=dict)


# ------------------------------------------------------------------ D20
def batch_qc(grid: DataFrame, stations: DataFrame, limits: dict = BATCH_SEASON_LIMITS,
             buddy: BuddyParams = BATCH_BUDDY, sct_prm: SctParams = BATCH_SCT, p: float = 0.8,
             sct_plan: str = "auto") -> QcResult:
    """Seasonal -> timestep completeness -> buddy and SCT independently on the raw
    values of kept times -> combine -> station completeness -> final mask."""
    # the grid feeds eight branches below: store it once
    g = store(grid.withColumn("seasonal_good", seasonal_good("v", "t", limits)))
    tm = C.timestep_completeness(g, "seasonal_good", p).select("t", "keep_t")
    kept_times = F.broadcast(tm.where("keep_t").select("t"))       # a part of the time axis
    kept = g.join(kept_times, "t", "left_semi")
    k = buddy_check(kept, stations, buddy, out="buddy_suspect")
    k = sct(k, stations, sct_prm, stct=False, plan=sct_plan)
    k = k.withColumn("combined", combine_flags("seasonal_good", "buddy_suspect", "sct_flag"))
    k = store(k.select(*g.columns, "buddy_suspect", "sct_flag", "combined"))
    sm = C.station_completeness(k, "combined", p).select("sid", "keep_s")
    # the tested cells carry the grid's columns; those of the other times have no flags
    rest = g.join(kept_times, "t", "left_anti").select("*", *[F.lit(None).cast("boolean").alias(c) for c in ("buddy_suspect", "sct_flag", "combined")])
    out = apply_masks(k.unionByName(rest), F.broadcast(tm), sm, good="combined")
    out = out.withColumn("v_qc", mask("v", "final_good"))
    # stations and times are counted on their own small tables, not over the grid
    n_removed = (g.select("sid").distinct().join(sm.where("keep_s"), "sid", "left_anti")
                 .agg(F.count(F.lit(1)).cast("long")).scalar())
    t_removed = tm.agg(F.count_if(~F.col("keep_t")).cast("long")).scalar()
    stats = out.agg(
        F.count(F.lit(1)).cast("long").alias("total_values"),
        F.count_if("final_good").cast("long").alias("good_values"),
        F.count_if(~F.col("seasonal_good")).cast("long").alias("seasonal_flags"),
        F.count_if(F.col("buddy_suspect")).cast("long").alias("buddy_flags"),
        F.count_if(F.col("sct_flag")).cast("long").alias("sct_flags"))
    stats = stats.select("total_values", "good_values", n_removed.alias("stations_removed"),
                         t_removed.alias("timesteps_removed"),
                         "seasonal_flags", "buddy_flags", "sct_flags")
    return QcResult(out, stats, tm, sm)


def valid_percent(result: QcResult) -> DataFrame:
    """Valid share of the masked dataset after dropping all-missing stations."""
    g = result.grid
    per = g.groupBy("sid").agg(F.count(F.lit(1)).alias("n"), F.count("v_qc").alias("nv"))
    kept = per.where(F.col("nv") > 0)
    return kept.agg(F.count(F.lit(1)).cast("long").alias("stations_left"),
                    F.coalesce(F.sum("nv"), F.lit(0)).cast("long").alias("valid_values"),
                    F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("cells_left"),
                    round_to(F.lit(100.0) * F.sum("nv") / F.sum("n"), 2).alias("valid_pct"))


# ------------------------------------------------------------------ D21
LEVEL_COLS = ["t_lvl0", "t_lvl1", "t_lvl2", "t_lvl3"]


def _completeness_counters(per_day: DataFrame, level: int) -> DataFrame:
    st = C.completeness_stats(per_day)
    return st.select(*[F.col(c).alias(f"{c}_lvl{level}") for c in st.columns])


def _folded(levels: DataFrame, cur: str, *flags: str) -> DataFrame:
    """``(t, sid, cur, masked, flags)``: a level's value is that of level 0 or missing, so the
    levels before are kept as the values that ``cur`` has lost (``masked``) and the flags."""
    return levels.select("t", "sid", cur, F.when(F.col(cur).isNull(), F.col("t_lvl0")).alias("masked"), *flags)


def _unfolded(levels: DataFrame, cur: str) -> DataFrame:
    """``_folded`` with the values of level 0 again."""
    return levels.withColumn("t_lvl0", F.coalesce(cur, "masked")).drop("masked")


def sequential_qc(grid: DataFrame, stations: DataFrame, limits: dict = SEQUENTIAL_SEASON_LIMITS,
                  buddy: BuddyParams = SEQUENTIAL_BUDDY, sct_prm: SctParams = SEQUENTIAL_SCT, p: float = 0.8,
                  sct_plan: str = "auto", checkpoint: bool = True) -> QcResult:
    """Level 1 seasonal, level 2 buddy, level 3 spatio-temporal test, each followed by
    the daily/monthly completeness rule; values are masked after each step, so
    every test sees only the survivors of the previous one."""
    keep = store if checkpoint else (lambda d: d)
    months = keep(C.axis_months(grid.select("t")))   # no level adds or drops a time
    g = grid.select("t", "sid", F.col("v").alias("t_lvl0"))
    # level 1: the dense grid is partitioned by station, so its verdicts are found in place
    g = g.withColumn("seasonal_ok", seasonal_good("t_lvl0", "t", limits))
    c1 = C.completeness_by_station(g, "seasonal_ok", p, months, out="t_lvl1_flag")
    g = keep(_folded(c1.withColumn("t_lvl1", mask("t_lvl0", "t_lvl1_flag")), "t_lvl1", "seasonal_ok", "t_lvl1_flag"))
    st1 = _completeness_counters(keep(C.station_days(g, "seasonal_ok", p)), 1)
    # level 2
    el = eligible_times(g, buddy.num_min, v="t_lvl1").select("t", F.col("eligible").alias("el2"))
    b = buddy_check(g, stations, buddy, v="t_lvl1", out="_bs").join(F.broadcast(el), "t")
    b = b.withColumn("buddy_ok", ~(F.col("el2") & F.col("_bs"))).drop("_bs", "el2")
    c2 = C.completeness_by_station(spread(b, "sid"), "buddy_ok", p, months, out="t_lvl2_flag")
    c2 = _unfolded(c2, "t_lvl1").withColumn("t_lvl2", mask("t_lvl1", "t_lvl2_flag"))
    g = keep(_folded(c2, "t_lvl2", "seasonal_ok", "t_lvl1_flag", "buddy_ok", "t_lvl2_flag"))
    st2 = _completeness_counters(keep(C.station_days(g, "buddy_ok", p)), 2)
    # level 3: the temporal test partitions by station again
    el = eligible_times(g, sct_prm.num_min, v="t_lvl2").select("t", F.col("eligible").alias("el3"))
    s = sct(g, stations, sct_prm, stct=True, v="t_lvl2", plan=sct_plan).join(F.broadcast(el), "t")
    s = (s.withColumn("sct_ok", ~(F.col("el3") & F.col("sct_flag")))
         .withColumn("temporal_ok", ~(F.col("el3") & F.col("temporal_flag")))
         .drop("sct_flag", "temporal_flag", "el3"))
    s = s.withColumn("l3_ok", F.col("sct_ok") & F.col("temporal_ok"))
    c3 = C.completeness_by_station(s, "l3_ok", p, months, out="t_lvl3_flag")
    c3 = _unfolded(c3, "t_lvl2").withColumn("t_lvl3", mask("t_lvl2", "t_lvl3_flag"))
    out = keep(c3.select("t", "sid", "t_lvl0", "seasonal_ok", mask("t_lvl0", "t_lvl1_flag").alias("t_lvl1"), "t_lvl1_flag",
                         "buddy_ok", "t_lvl2", "t_lvl2_flag", "sct_ok", "temporal_ok", "l3_ok", "t_lvl3", "t_lvl3_flag"))
    st3 = _completeness_counters(keep(C.station_days(out, "l3_ok", p)), 3)
    counts = out.agg(
        F.count(F.lit(1)).cast("long").alias("total_values"),
        *[F.count(c).cast("long").alias(f"{c}_valid") for c in LEVEL_COLS],
        F.count_if(~F.col("seasonal_ok")).cast("long").alias("seasonal_flags"),
        F.count_if(~F.col("buddy_ok")).cast("long").alias("buddy_flags"),
        F.count_if(~F.col("sct_ok")).cast("long").alias("sct_flags"),
        F.count_if(~F.col("temporal_ok")).cast("long").alias("temporal_flags"))
    # one-row frames combined column-wise through a constant key (each side is a single row)
    one = F.lit(1).alias("_k")
    stats = (counts.select("*", one).join(st1.select("*", one), "_k").join(st2.select("*", one), "_k")
             .join(st3.select("*", one), "_k").drop("_k"))
    return QcResult(out, stats)


def level_report(result: QcResult) -> DataFrame:
    """E5: per level, valid count, percent of all cells, and the dimensions: timesteps x
    stations, and the stations that still have values."""
    per = result.grid.groupBy("sid").agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in LEVEL_COLS])
    dims = per.agg(F.count(F.lit(1)).alias("n_stations"), F.max("n").alias("n_times"), F.sum("n").alias("total"),
                   *[F.struct(F.sum(c).alias("valid"), F.count_if(F.col(c) > 0).alias("active")).alias(c) for c in LEVEL_COLS])
    rows = [F.struct(F.lit(c).alias("level"), F.col(f"{c}.valid").alias("valid"), F.col(f"{c}.active").alias("active")) for c in LEVEL_COLS]
    ex = dims.select("n_stations", "n_times", "total", F.explode(F.array(*rows)).alias("r"))
    return ex.select(F.col("r.level").alias("level"), F.col("r.valid").alias("valid"),
                     round_to(F.lit(100.0) * F.col("r.valid") / F.col("total"), 2).alias("pct"),
                     "n_times", "n_stations", F.col("r.active").alias("stations_with_values"))


# ------------------------------------------------------------------ D22
def temporal_overlay(levels: DataFrame, prm: LongTermParams = OVERLAY) -> QcResult:
    """Long-term check on the highest level; its survivors become the next level.

    The parameters are stored with the level: in the metadata of its column and, by
    ``write_overlay``, in the dataset's table of attributes.
    """
    lvl = current_level(levels.columns)
    cur, nxt = f"t_lvl{lvl}", f"t_lvl{lvl + 1}"
    chk = T.long_term_check(levels.withColumnRenamed(cur, "v"), prm.window_hours, prm.seasonal_window_hours,
                            prm.z_threshold, prm.min_samples).withColumnRenamed("v", cur)
    params = asdict(prm)
    out = chk.withColumn(nxt, mask(cur, "lt_good").alias(nxt, metadata={"temporal_analysis_params": json.dumps(params)}))
    stats = out.agg(F.lit(nxt).alias("new_level"), F.count(F.lit(1)).cast("long").alias("cells"),
                    F.count(nxt).cast("long").alias("valid_values"))
    return QcResult(out, stats, extra={"level": lvl + 1, "params": params})


def write_overlay(result: QcResult, path: str, stations: DataFrame | None = None) -> None:
    """The overlay's dataset: all levels, the flag of the new one, and its parameters as columns of the attributes."""
    params = [F.lit(v).alias(f"temporal_{k}") for k, v in result.extra["params"].items()]
    attrs = result.stats.select("*", *params, F.lit(result.extra["level"]).alias("temporal_qc_level"))
    levels = sorted(c for c in result.grid.columns if re.fullmatch(r"t_lvl\d+", c))
    write_qc_dataset(result.grid, attrs, path, value_cols=levels, flag_cols=["lt_good"], stations=stations,
                     methods="rolling and seasonal z-score on the highest level")
