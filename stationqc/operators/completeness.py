"""Completeness rules D2, D3, D10-D13.

The daily and monthly rules are hash aggregates: cells to station-days (map-side
first), station-days to station-months, and a month table of the axis (twelve rows
a year).  The cells get both verdicts back by one join on the station-day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stationqc.functions.columns import days_in_month, epoch_seconds, month_key

EXPECTED_PER_DAY = 24  # fixed: hourly data assumed by the daily rule


def timestep_completeness(grid: DataFrame, flag: str, p: float) -> DataFrame:
    """``(t, share, keep_t)``: keep a time when good cells / all stations >= p."""
    agg = grid.groupBy("t").agg(F.avg(F.col(flag).cast("int")).alias("share"))
    return agg.withColumn("keep_t", F.col("share") >= F.lit(float(p)))


def station_completeness(grid: DataFrame, flag: str, p: float, kept_times: DataFrame | None = None) -> DataFrame:
    """D3: ``(sid, share, keep_s)`` over the kept timesteps (all rows of ``grid`` if None).

    With no kept time the share is undefined and no station is kept.
    """
    g = grid if kept_times is None else grid.join(kept_times.select("t"), "t", "left_semi")
    agg = g.groupBy("sid").agg(F.avg(F.col(flag).cast("int")).alias("share"))
    return agg.withColumn("keep_s", F.coalesce(F.col("share") >= F.lit(float(p)), F.lit(False)))


def _month_limits(axis_days: DataFrame) -> DataFrame:
    """``(mk, guard, expected)`` of an axis given as days ``(day, mk, lo, hi)``: twelve rows a year."""
    months = axis_days.groupBy("mk").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                         F.first(days_in_month("day")).cast("long").alias("dim"))
    whole = Window.partitionBy()   # over the month table only
    return months.select("mk", (F.floor((F.max("hi").over(whole) - F.min("lo").over(whole)) / 86400) >= 30)
                         .alias("guard"),
                         F.least("dim", F.floor((F.col("hi") - F.col("lo")) / 86400) + 1).alias("expected"))


def axis_months(times: DataFrame) -> DataFrame:
    """The month table of D11, ``(mk, guard, expected)``, from the axis times ``(t)`` of a grid."""
    sec = epoch_seconds("t")
    days = (times.groupBy(F.to_date("t").alias("day")).agg(F.min(sec).alias("lo"), F.max(sec).alias("hi"))
            .where(F.col("day").isNotNull()))
    return _month_limits(days.withColumn("mk", month_key("day")))


def station_days(grid: DataFrame, flag: str, p: float) -> DataFrame:
    """D10 and D11 as aggregates: one row ``(sid, day, mk, day_bad, month_bad)`` per
    station-day of the dense grid.

    The grid is reduced to station-days once (map-side first); station-months come
    from those days, and the month extents and the span of the axis from the days of
    all stations (every station carries every axis time): twelve rows a year.
    """
    p = float(p)
    sec = epoch_seconds("t")
    days = (grid.groupBy("sid", F.to_date("t").alias("day"))
            .agg(F.count_if(F.col(flag)).alias("n_good"), F.min(sec).alias("lo"), F.max(sec).alias("hi"))
            .withColumn("mk", month_key("day")))
    months = _month_limits(days.groupBy("day", "mk").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    valid = days.groupBy("sid", "mk").agg(F.count_if(F.col("n_good") > 0).alias("valid_days"))
    month_bad = F.col("guard") & (F.col("valid_days") / F.col("expected") < F.lit(p))
    by_month = valid.join(F.broadcast(months), "mk").select("sid", "mk", month_bad.alias("month_bad"))
    day_bad = F.col("n_good") / F.lit(float(EXPECTED_PER_DAY)) < F.lit(p)
    return (days.select("sid", "day", "mk", "n_good", day_bad.alias("day_bad")).join(by_month, ["sid", "mk"])
            .select("sid", "day", "mk", "n_good", "day_bad", "month_bad"))


def completeness_temporal(grid: DataFrame, flag: str, p: float, out: str = "complete",
                          per_day: DataFrame | None = None, months: DataFrame | None = None) -> DataFrame:
    """D12 on a dense grid with a non-null boolean ``flag`` column.

    Adds ``day``, ``mk``, ``day_bad`` (D10), ``month_bad`` (D11) and ``out`` = flag and
    not day_bad and not month_bad.  Both rules read the *input* flags.
    * D10: per station-day, good flags / 24 < p -> the station-day is bad.
    * D11 (only if the whole axis spans >= 30 full days): per station-month,
      days with any good flag / expected < p -> bad; expected = min(days in
      month, whole days between the month's first and last axis time + 1).
    ``grid`` is read twice (station-days, then the cells): give a stored table or a
    checkpoint where it is costly to derive.  ``per_day`` is the ``station_days`` of the
    grid where the caller has them already.  With ``months``, the ``axis_months`` of a grid that
    is partitioned by station, the verdicts are found where its rows are
    (``completeness_by_station``): the grid is read once and crosses no shuffle.
    """
    if months is not None:
        return completeness_by_station(grid, flag, p, months, out)
    per_day = station_days(grid, flag, p) if per_day is None else per_day
    g = grid.withColumn("day", F.to_date("t")).join(per_day.drop("n_good"), ["sid", "day"])
    return (g.withColumn(out, F.col(flag) & ~F.col("day_bad") & ~F.col("month_bad"))
            .select(*[F.col(c) for c in grid.columns if c != out], "day", "mk", "day_bad", "month_bad", out))


def completeness_by_station(grid: DataFrame, flag: str, p: float, months: DataFrame, out: str = "complete") -> DataFrame:
    """D12 as ``completeness_temporal`` gives it, by windows within a station.

    ``months`` is the ``axis_months`` of the grid.  A grid that is partitioned by station
    (as ``dense_grid`` and ``temporal_step`` leave it) gets its verdicts where its rows are:
    one sort for all windows, no join of cells and no shuffle.
    """
    p = float(p)
    g = grid.where(F.col("sid").isNotNull() & F.col("t").isNotNull()).withColumn("day", F.to_date("t"))
    g = g.withColumn("mk", month_key("day"))
    # the window by station comes first: it asks for no partitioning beyond the station
    opens = ~F.lag("day").over(Window.partitionBy("sid").orderBy("mk", "day", "t")).eqNullSafe(F.col("day"))
    g = g.withColumn("_opens", opens)
    of_day = (Window.partitionBy("sid", "mk", "day").orderBy("t")
              .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    g = g.withColumn("_good", F.count_if(F.col(flag)).over(of_day))
    valid = F.count_if(F.col("_opens") & (F.col("_good") > 0)).over(Window.partitionBy("sid", "mk"))
    g = g.withColumn("_valid", valid).join(F.broadcast(months), "mk")
    g = g.withColumn("day_bad", F.col("_good") / F.lit(float(EXPECTED_PER_DAY)) < F.lit(p))
    g = g.withColumn("month_bad", F.col("guard") & (F.col("_valid") / F.col("expected") < F.lit(p)))
    return (g.withColumn(out, F.col(flag) & ~F.col("day_bad") & ~F.col("month_bad"))
            .select(*[F.col(c) for c in grid.columns if c != out], "day", "mk", "day_bad", "month_bad", out))


def completeness_stats(per_day: DataFrame, out: bool = False) -> DataFrame:
    """The four counters of D12 from the output of ``station_days``: no cell is read again.

    Station-days nest in station-months and these in stations, each step a partial
    aggregate before its shuffle.  With ``out`` the good flags of days that are not bad,
    in months that are not bad, are added as ``n_out`` (the true output flags).
    """
    o = F.when(~F.col("day_bad") & ~F.col("month_bad"), F.col("n_good")).otherwise(0)
    per_sm = per_day.groupBy("sid", "mk").agg(F.count_if("day_bad").alias("nd"), F.max(F.col("month_bad").cast("int")).alias("mb"),
                                              F.sum(o).alias("no"))
    per_s = per_sm.groupBy("sid").agg(F.sum("nd").alias("nd"), F.sum("mb").alias("nm"), F.sum("no").alias("no"))
    res = per_s.agg(
        F.coalesce(F.sum("nd"), F.lit(0)).cast("long").alias("days_flagged"),
        F.coalesce(F.sum("nm"), F.lit(0)).cast("long").alias("months_flagged"),
        F.count_if(F.col("nd") > 0).cast("long").alias("stations_with_flagged_days"),
        F.count_if(F.col("nm") > 0).cast("long").alias("stations_with_flagged_months"),
        F.coalesce(F.sum("no"), F.lit(0)).cast("long").alias("n_out"))
    return res if out else res.drop("n_out")


def apply_completeness(grid: DataFrame, p: float, v: str = "v") -> DataFrame:
    """Completeness with all flags true (it counts time rows), values masked.

    Adds ``qc_flags`` and masks ``v``.
    """
    g = grid.withColumn("_all", F.lit(True))
    out = completeness_temporal(g, "_all", p, out="qc_flags")
    return out.withColumn(v, F.when(F.col("qc_flags"), F.col(v))).drop("_all")
