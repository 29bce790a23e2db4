"""Completeness and summaries on run-length cells, without the dense grid.

The dense grid holds a cell for every axis time and station, most of them missing in
a sparse network.  Here a station is its filled cells and the runs of missing axis
positions between them; everything that is counted over the dense grid is counted
over the filled cells and completed from the axis: the axis has ``n_rows`` times on a
day, so a station with ``k`` filled cells on it misses ``n_rows - k``.

A flag over the dense grid is given by ``good`` on the filled cells (None: all of them)
and by ``missing_good`` for all missing ones (missing is good for limits, not for
presence).

Work is one aggregate of the cells by (station, day); station-days without cells are
never made (unless they are the output), station-months are, twelve a year.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationqc.functions.columns import days_in_month, epoch_seconds, month_key, round_to, season
from stationqc.operators.completeness import EXPECTED_PER_DAY
from stationqc.operators.grid import time_axis
from stationqc.session import cut_lineage, spread, store


@dataclass(frozen=True)
class RunGrid:
    """Filled cells ``(t, sid, v)`` and the small tables of their axis."""
    cells: DataFrame
    days: DataFrame        # (day, mk, n_rows, lo, hi): axis times of a day, its first and last second
    months: DataFrame      # (mk, guard, expected, n_days)
    stations: DataFrame    # (sid)


def run_grid(cells: DataFrame) -> RunGrid:
    """The axis tables of ``cells`` (one row per filled cell).

    The cells are stored once, as every rule reads them.
    """
    cells = store(cells)
    sec = epoch_seconds("t")
    days = cut_lineage(cells.select("t").distinct().groupBy(F.to_date("t").alias("day"))
                       .agg(F.count(F.lit(1)).alias("n_rows"), F.min(sec).alias("lo"), F.max(sec).alias("hi"))
                       .withColumn("mk", month_key("day")))
    whole = Window.partitionBy()      # over the month table only
    months = (days.groupBy("mk").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count(F.lit(1)).alias("n_days"),
                                     F.max(days_in_month("day")).cast("long").alias("dim"))
              .select("mk", "n_days", (F.floor((F.max("hi").over(whole) - F.min("lo").over(whole)) / 86400) >= 30).alias("guard"),
                      F.least("dim", F.floor((F.col("hi") - F.col("lo")) / 86400) + 1).alias("expected")))
    return RunGrid(cells, days, cut_lineage(months), cut_lineage(cells.select("sid").distinct()))


def to_runs(cells: DataFrame) -> DataFrame:
    """B3 as runs ``(sid, first, last, v)`` of axis positions: a filled cell is a run of one,
    missing positions between cells (and before the first and after the last) are one run."""
    c = spread(cells.join(time_axis(cells), "t"), "sid")
    w = Window.partitionBy("sid").orderBy("idx")
    c = c.withColumn("before", F.lag("idx").over(w)).withColumn("after", F.coalesce(F.lead("idx").over(w), F.col("n_times")))
    missing = F.lit(None).cast("double")

    def run(first: Column, last: Column, v: Column) -> Column:
        return F.struct(first.alias("first"), last.alias("last"), v.alias("v"))
    zero = F.lit(0).cast("long")
    runs = F.array(F.when(F.col("before").isNull() & (F.col("idx") > 0), run(zero, F.col("idx") - 1, missing)),
                   run(F.col("idx"), F.col("idx"), F.col("v")),
                   F.when(F.col("after") > F.col("idx") + 1, run(F.col("idx") + 1, F.col("after") - 1, missing)))
    return c.select("sid", F.explode(F.filter(runs, lambda r: r.isNotNull())).alias("r")).select("sid", "r.*")


def expand_runs(runs: DataFrame, axis: DataFrame) -> DataFrame:
    """The dense cells ``(t, sid, v)`` of runs, for rules that look at neighbours in time or space."""
    long = runs.select("sid", "v", F.explode(F.sequence("first", "last")).alias("idx"))
    return long.join(axis.select("t", "idx"), "idx").select("t", "sid", "v")


def _good_cells(good: Column | None) -> Column:
    return F.count(F.lit(1)) if good is None else F.count_if(F.coalesce(good, F.lit(False)))


def timestep_share(grid: RunGrid, p: float, good: Column | None = None, missing_good: bool = False) -> DataFrame:
    """``(t, share, keep_t)`` over all stations, from the filled cells of each time."""
    n = grid.stations.select(F.count(F.lit(1))).scalar()
    per = grid.cells.groupBy("t").agg(_good_cells(good).alias("g"), F.count(F.lit(1)).alias("k"))
    absent = (n - F.col("k")) if missing_good else F.lit(0)
    per = per.select("t", ((F.col("g") + absent) / n).alias("share"))
    return per.withColumn("keep_t", F.col("share") >= F.lit(float(p)))


def station_share(grid: RunGrid, p: float, good: Column | None = None, missing_good: bool = False) -> DataFrame:
    """D3: ``(sid, share, keep_s)`` over all axis times, from the filled cells of each station."""
    n = grid.days.select(F.sum("n_rows")).scalar()
    per = grid.cells.groupBy("sid").agg(_good_cells(good).alias("g"), F.count(F.lit(1)).alias("k"))
    absent = (n - F.col("k")) if missing_good else F.lit(0)
    per = per.select("sid", ((F.col("g") + absent) / n).alias("share"))
    return per.withColumn("keep_s", F.coalesce(F.col("share") >= F.lit(float(p)), F.lit(False)))


def _held_days(grid: RunGrid, p: float, good: Column | None, missing_good: bool) -> DataFrame:
    """Station-days with cells: ``(sid, day, mk, n_rows, n_good, n_cells, day_bad)``."""
    per = grid.cells.groupBy("sid", F.to_date("t").alias("day")).agg(_good_cells(good).alias("g"), F.count(F.lit(1)).alias("n_cells"))
    per = per.join(F.broadcast(grid.days.select("day", "mk", "n_rows")), "day")      # the day table
    n_good = F.col("g") + ((F.col("n_rows") - F.col("n_cells")) if missing_good else F.lit(0))
    return per.select("sid", "day", "mk", "n_rows", n_good.alias("n_good"), "n_cells").withColumn("day_bad", _day_bad(F.col("n_good"), p))


def _day_bad(n_good: Column, p: float) -> Column:
    """Good flags over the fixed number of hours below the share."""
    return n_good / F.lit(float(EXPECTED_PER_DAY)) < F.lit(float(p))


def _empty_good(missing_good: bool) -> Column:
    """Good flags of a station on a day without cells."""
    return F.col("n_rows") if missing_good else F.lit(0).cast("long")


def station_months(grid: RunGrid, p: float, good: Column | None = None, missing_good: bool = False) -> DataFrame:
    """D10-D12 per station-month of the axis: ``(sid, mk, n_rows, month_bad, n_days_bad, n_rows_day_bad, n_out)``.

    ``n_out`` counts the good cells of days that are not bad in months that are not
    bad.  What the days without cells add is the month's figure for an empty station
    less that of the days the station has.
    """
    empty = _empty_good(missing_good)

    def figures(n_good: Column, prefix: str) -> list[Column]:
        bad = _day_bad(n_good, p)
        return [F.count_if(n_good > 0).alias(prefix + "valid"), F.count_if(bad).alias(prefix + "bad"),
                F.sum(F.when(bad, F.col("n_rows")).otherwise(0)).alias(prefix + "bad_rows"),
                F.sum(F.when(bad, F.lit(0)).otherwise(n_good)).alias(prefix + "out")]
    held = (_held_days(grid, p, good, missing_good).groupBy("sid", "mk")
            .agg(*figures(F.col("n_good"), "h_"), *figures(empty, "e_")))
    blank = grid.days.groupBy("mk").agg(F.sum("n_rows").alias("n_rows"), *figures(empty, "b_"))
    months = grid.months.join(blank, "mk").withColumn("pos", F.row_number().over(Window.orderBy("mk")) - 1)   # the month table
    last = months.select(F.max("pos")).scalar()
    frame = grid.stations.select("sid", F.explode(F.sequence(F.lit(0), last)).alias("pos")).join(F.broadcast(months), "pos")
    j = frame.join(held, ["sid", "mk"], "left")

    def total(name: str) -> Column:
        return F.coalesce(F.col("h_" + name), F.lit(0)) + F.col("b_" + name) - F.coalesce(F.col("e_" + name), F.lit(0))
    month_bad = F.col("guard") & (total("valid") / F.col("expected") < F.lit(float(p)))
    return (j.select("sid", "mk", "n_rows", month_bad.alias("month_bad"), total("bad").alias("n_days_bad"),
                     total("bad_rows").alias("n_rows_day_bad"), total("out").alias("out"))
            .withColumn("n_out", F.when(F.col("month_bad"), F.lit(0)).otherwise(F.col("out")).cast("long")).drop("out"))


def station_days(grid: RunGrid, p: float, good: Column | None = None, missing_good: bool = False,
                 parts: int | None = None) -> DataFrame:
    """D10 for every station-day of the axis ``(sid, day, n_good, day_bad, month_bad, n_out)``: here, as
    the output, the days without cells are written out.

    As in ``dense_grid``, a day with cells (and a mark before the first day) writes out the run of days up to
    the station's next one, and the station brings along its bad months: what crosses a shuffle
    are the days with cells and the stations; the rows lie by station (in ``parts`` parts, see ``spread``).
    """
    held = _held_days(grid, p, good, missing_good).select("sid", "day", F.col("n_good").alias("held"))
    days = grid.days.withColumn("pos", F.row_number().over(Window.orderBy("day")) - 1)                        # the day table
    last = days.select(F.max("pos")).scalar()
    held = held.join(F.broadcast(days.select("day", "pos")), "day").select("sid", F.col("pos").alias("own"), "held")
    marks = grid.stations.select("sid", F.lit(-1).alias("own"), F.lit(None).cast("long").alias("held"))
    next_own = F.coalesce(F.lead("own").over(Window.partitionBy("sid").orderBy("own")), last + 1)
    runs = spread(held.unionByName(marks), "sid", parts=parts).withColumn("next", next_own)
    every = runs.select("sid", "own", "held", F.explode(F.sequence("own", F.col("next") - 1)).alias("pos")).where("pos >= 0")
    every = every.join(F.broadcast(days.select("pos", "day", "mk", "n_rows")), "pos").where(F.col("mk").isNotNull())
    n_good = F.coalesce(F.when(F.col("pos") == F.col("own"), F.col("held")), _empty_good(missing_good))
    every = every.select("sid", "day", "mk", n_good.alias("n_good")).withColumn("day_bad", _day_bad(F.col("n_good"), p))
    verdict = (station_months(grid, p, good, missing_good).groupBy("sid")
               .agg(F.collect_set(F.when(F.col("month_bad"), F.col("mk"))).alias("bad")))        # twelve a year
    return every.join(verdict, "sid").withColumn("month_bad", F.array_contains("bad", F.col("mk"))).select(
        "sid", "day", "n_good", "day_bad", "month_bad",
        F.when(F.col("day_bad") | F.col("month_bad"), F.lit(0)).otherwise(F.col("n_good")).cast("long").alias("n_out"))


def completeness_counters(grid: RunGrid, p: float, good: Column | None = None, missing_good: bool = False) -> DataFrame:
    """The four counters and ``n_out``, from the station-months."""
    per = station_months(grid, p, good, missing_good).groupBy("sid").agg(
        F.sum("n_days_bad").alias("d"), F.count_if("month_bad").alias("m"), F.sum("n_out").alias("o"))
    return per.agg(F.coalesce(F.sum("d"), F.lit(0)).cast("long").alias("days_flagged"),
                   F.coalesce(F.sum("m"), F.lit(0)).cast("long").alias("months_flagged"),
                   F.count_if(F.col("d") > 0).cast("long").alias("stations_with_flagged_days"),
                   F.count_if(F.col("m") > 0).cast("long").alias("stations_with_flagged_months"),
                   F.coalesce(F.sum("o"), F.lit(0)).cast("long").alias("n_out"))


def valid_after_completeness(grid: RunGrid, p: float) -> DataFrame:
    """All flags true (time rows count); per station the cells, the kept cells and the kept values."""
    months = station_months(grid, p, missing_good=True)
    kept = _held_days(grid, p, None, True).where(~F.col("day_bad")).groupBy("sid", "mk").agg(F.sum("n_cells").alias("values"))
    j = months.join(kept, ["sid", "mk"], "left")
    return j.groupBy("sid").agg(F.sum("n_rows").alias("n_cells"), F.sum("n_out").alias("n_qc_true"),
                                F.sum(F.when(F.col("month_bad"), 0).otherwise(F.coalesce("values", F.lit(0)))).alias("n_valid"))


def dataset_summary(grid: RunGrid, dimension: DataFrame) -> DataFrame:
    """E1 from the station table, the axis and the number of filled cells: no distinct count over the grid."""
    n_st = grid.stations.select(F.count(F.lit(1))).scalar()
    no_alt = dimension.where(F.col("alt").isNull()).select(F.count(F.lit(1))).scalar()
    filled = grid.cells.select(F.count(F.lit(1))).scalar()
    at = grid.cells.agg(F.min("t").alias("a"), F.max("t").alias("b"))
    times = grid.days.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_times"))
    return times.select(n_st.alias("n_stations"), "n_times", at.select("a").scalar().alias("first_t"), at.select("b").scalar().alias("last_t"),
                        (n_st * F.col("n_times") - filled).alias("missing_cells"), no_alt.alias("stations_no_alt"))


def seasonal_summary(grid: RunGrid, names=("DJF", "MAM", "JJA", "SON")) -> DataFrame:
    """E2 from (station, season) counts and the axis: no distinct count over the grid."""
    n_st = grid.stations.select(F.count(F.lit(1))).scalar()
    per = (grid.cells.groupBy(season("t").alias("season"), "sid").agg(F.count(F.lit(1)).alias("k"))
           .groupBy("season").agg(F.count(F.lit(1)).alias("active"), F.sum("k").alias("filled")))
    axis = (grid.cells.select("t").distinct().groupBy(season("t").alias("season"))
            .agg(F.count(F.lit(1)).alias("n_times"), F.min("t").alias("first_t"), F.max("t").alias("last_t")))
    frame = grid.cells.sparkSession.createDataFrame([(s,) for s in names], "season string")
    j = frame.join(axis, "season", "left").join(per, "season", "left")
    pct = round_to(F.lit(100.0) * F.col("filled") / (n_st * F.col("n_times")), 2)
    return j.select("season", F.coalesce("active", F.lit(0)).alias("active_stations"), pct.alias("completeness_pct"),
                    F.coalesce("n_times", F.lit(0)).alias("n_times"), "first_t", "last_t",
                    F.when(F.col("first_t").isNull(), "no data").otherwise("ok").alias("status"))
