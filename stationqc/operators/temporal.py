"""D9 temporal step, D14-D19 long-term checks.

Per-station windows run after one shuffle by station; a station's partition is
bounded by the axis length.  The climatology pre-aggregates moments per
(station, day of year) before the circular-window merge, so at most
366 x (2*half+1) partial rows per station are exchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from stationqc.functions.columns import epoch_seconds, round_to
from stationqc.session import spread


def temporal_step(grid: DataFrame, thr: float, v: str = "v", out: str = "step_suspect", parts: int | None = None) -> DataFrame:
    """Suspect when |v - prev| > thr or |v - next| > thr on the dense grid.

    prev/next are the adjacent axis rows of the station (not adjacent hours);
    the axis edges have no neighbour; a missing value is never suspect.
    ``parts`` is the number of parts by station (see ``spread``).
    """
    w = Window.partitionBy("sid").orderBy("t")
    g = spread(grid, "sid", parts=parts)
    g = g.withColumn("v_prev", F.lag(v).over(w)).withColumn("v_next", F.lead(v).over(w))
    s = (F.coalesce(F.abs(F.col(v) - F.col("v_prev")) > F.lit(float(thr)), F.lit(False))
         | F.coalesce(F.abs(F.col(v) - F.col("v_next")) > F.lit(float(thr)), F.lit(False)))
    return g.withColumn(out, s)


def rolling_zscore(grid: DataFrame, window_hours: int = 720, thr: float = 3.0, min_samples: int = 720,
                   v: str = "v", block_hours: int | None = None, parts: int | None = None) -> DataFrame:
    """Centred window [t - W//2 h, t + W//2 h], both ends inclusive, self included.

    Needs >= min_samples axis rows (missing rows count); z = (v - mean)/std with
    the mean and population std of the non-missing values; bad when |z| > thr.
    Adds ``roll_rows``, ``roll_z`` and ``roll_good``.  ``parts`` is the number of parts by
    station, or by station and block (see ``spread``).

    With ``block_hours`` (half the window at least) a station's axis is cut into blocks
    of that many hours.  A cell goes to its own block and, within half a window of an
    edge, as a halo to the block behind it; the windows of a block's own cells so lie
    within the block and its halos.  A long history is spread over tasks by block, and
    running sums are as long as a block, whatever the length of the history.
    """
    half = int(window_hours) // 2 * 3600
    keys = ["sid"]
    g = grid.withColumn("_sec", epoch_seconds("t"))
    if block_hours is not None:
        size = int(block_hours) * 3600
        if size < half or size <= 0:
            raise ValueError("a block has to hold half a window")
        keys.append("_block")
        own = F.floor(F.col("_sec") / F.lit(size)).cast("long")
        at = F.col("_sec") - own * F.lit(size)
        homes = F.array(own, F.when(at < F.lit(half), own - 1), F.when(at >= F.lit(size - half), own + 1))
        g = (g.withColumn("_own", own).withColumn("_block", F.explode(F.array_compact(homes))))
    by_key = Window.partitionBy(*keys)
    run = by_key.orderBy("_sec")
    upto = run.rangeBetween(Window.unboundedPreceding, half)
    before = run.rangeBetween(Window.unboundedPreceding, -half - 1)
    # running sums up to both window edges, linear in the cells; centred on the mean of
    # the station (or block) so that the squares stay small
    g = spread(g, *keys, parts=parts).withColumn("_c", F.avg(v).over(by_key))
    x = F.col(v) - F.col("_c")
    sums = F.struct(F.count(F.lit(1)).over(upto).alias("rows"), F.count(v).over(upto).alias("n"),
                    F.coalesce(F.sum(x).over(upto), F.lit(0.0)).alias("s1"),
                    F.coalesce(F.sum(x * x).over(upto), F.lit(0.0)).alias("s2"))
    less = F.struct(F.count(F.lit(1)).over(before).alias("rows"), F.count(v).over(before).alias("n"),
                    F.coalesce(F.sum(x).over(before), F.lit(0.0)).alias("s1"),
                    F.coalesce(F.sum(x * x).over(before), F.lit(0.0)).alias("s2"))
    g = g.withColumn("_a", sums).withColumn("_b", less)
    if block_hours is not None:
        g = g.where(F.col("_block") == F.col("_own")).drop("_block", "_own")
    part = {k: F.col(f"_a.{k}") - F.col(f"_b.{k}") for k in ("rows", "n", "s1", "s2")}
    mean = part["s1"] / F.nullif(part["n"], F.lit(0))
    var = part["s2"] / F.nullif(part["n"], F.lit(0)) - mean * mean
    # equal values leave rounding noise of the running sums instead of zero
    spread_ok = (part["n"] > 1) & (var > F.lit(1e-13) * F.greatest(F.col("_a.s2"), F.col("_c") * F.col("_c")))
    z = F.when((part["rows"] >= F.lit(int(min_samples))) & spread_ok,
               (F.col(v) - F.col("_c") - mean) / F.sqrt(F.greatest(var, F.lit(0.0))))
    g = g.withColumn("roll_rows", part["rows"]).withColumn("roll_z", z)
    return g.withColumn("roll_good", ~F.coalesce(F.abs(F.col("roll_z")) > F.lit(float(thr)), F.lit(False))) \
        .drop("_sec", "_c", "_a", "_b")


def climatology(grid: DataFrame, half_days: float = 15.0, v: str = "v") -> DataFrame:
    """Per station and day of year 1..366, moments of all rows of all years
    within +-half days (circular over 366 days).

    Returns ``(sid, doy, clim_rows, clim_n, clim_mean, clim_std)``; rows count
    missing values, mean/std use the present ones (population std).
    """
    h = int(math.floor(half_days))
    lo, hi = max(-h, -182), min(h, 183)
    g = grid.withColumn("doy", F.dayofyear("t"))
    # per (station, day of year): row count, value count, sum and M2 (the
    # within-group squared deviations, from the numerically stable var_pop)
    pre = (g.groupBy("sid", "doy")
           .agg(F.count(F.lit(1)).alias("r"), F.count(v).alias("n"), F.sum(v).alias("sv"),
                (F.coalesce(F.var_pop(v), F.lit(0.0)) * F.count(v)).alias("m2")))
    pre = pre.withColumn("bq", F.when(F.col("n") > 0, F.col("sv") * F.col("sv") / F.col("n")).otherwise(0.0))
    spread = pre.withColumn("k", F.explode(F.sequence(F.lit(lo), F.lit(hi)))) \
        .withColumn("doy_t", F.pmod(F.col("doy") - 1 + F.col("k"), F.lit(366)) + 1)
    agg = spread.groupBy("sid", F.col("doy_t").alias("doy")).agg(
        F.sum("r").alias("clim_rows"), F.sum("n").alias("clim_n"), F.sum("sv").alias("sv"),
        F.sum("m2").alias("m2"), F.sum("bq").alias("bq"))
    # merged M2 = sum of within-group M2 + between-group part sum(s_k^2/n_k) - S^2/N
    n_ = F.nullif(F.col("clim_n"), F.lit(0))
    var = F.greatest((F.col("m2") + F.col("bq") - F.col("sv") * F.col("sv") / n_) / n_, F.lit(0.0))
    # the mean from the plain sum (exact for exactly representable data)
    mean = F.col("sv") / n_
    return agg.select("sid", "doy", F.col("clim_rows").cast("long"), F.col("clim_n").cast("long"),
                      mean.alias("clim_mean"), F.sqrt(var).alias("clim_std"))


def seasonal_zscore(grid: DataFrame, clim: DataFrame, thr: float = 3.0, min_samples: int = 720,
                    v: str = "v") -> DataFrame:
    """Bad when |(v - mean_doy)/std_doy| > thr and that doy has >= min_samples rows."""
    g = grid.withColumn("doy", F.dayofyear("t")).join(clim, ["sid", "doy"], "left")
    z = F.when(F.col("clim_rows") >= F.lit(int(min_samples)),
               (F.col(v) - F.col("clim_mean")) / F.nullif(F.col("clim_std"), F.lit(0.0)))
    g = g.withColumn("seas_z", z)
    return g.withColumn("seas_good", ~F.coalesce(F.abs(F.col("seas_z")) > F.lit(float(thr)), F.lit(False)))


def long_term_check(grid: DataFrame, window_hours: int = 720, seasonal_window_hours: float = 360.0,
                    thr: float = 3.0, min_samples: int = 720, v: str = "v", block_hours: int | None = None) -> DataFrame:
    """good = rolling good and seasonal good, all stations at once."""
    r = rolling_zscore(grid, window_hours, thr, min_samples, v, block_hours)
    clim = climatology(grid, seasonal_window_hours / 24.0, v)
    s = seasonal_zscore(r, clim, thr, min_samples, v)
    return s.withColumn("lt_good", F.col("roll_good") & F.col("seas_good"))


def violations(checked: DataFrame, v: str = "v") -> DataFrame:
    """One record per violation and kind (``z_score`` / ``seasonal``)."""
    a = checked.where(~F.col("roll_good")).select(
        "sid", "t", F.lit("z_score").alias("kind"), F.col(v).alias("value"),
        F.lit(None).cast("int").alias("day_of_year"), F.col("roll_z").alias("z"))
    b = checked.where(~F.col("seas_good")).select(
        "sid", "t", F.lit("seasonal").alias("kind"), F.col(v).alias("value"),
        F.col("doy").alias("day_of_year"), F.col("seas_z").alias("z"))
    return a.unionByName(b)


def history_span(grid: DataFrame, years: float) -> DataFrame:
    """Whole days of span / 365.25 and whether it reaches ``years``."""
    sec = epoch_seconds("t")
    agg = grid.agg(F.floor((F.max(sec) - F.min(sec)) / 86400).alias("span_days"))
    yrs = F.col("span_days") / F.lit(365.25)
    return agg.select(F.col("span_days").cast("long"), round_to(yrs, 4).alias("span_years"),
                      (yrs >= F.lit(float(years))).alias("sufficient"))
