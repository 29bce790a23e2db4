"""Grid construction and reshaping (long form ``t, sid, v``).

The dense time x station grid is built by *gap filling*: every station's
filled cells are ranked on the shared time axis and each cell emits the run of
missing axis positions up to the station's next cell (``sequence`` +
``explode``).  Each emitted row is one real output cell, so the work is linear
in the grid size and no product of the two dimensions is planned.  Per-station
partitions are bounded by the axis length (one cell per axis time).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from stationqc.functions.columns import mask, month_key, nan_to_null, season, timeframe_label
from stationqc.session import spread, store


def hourly_cells(obs: DataFrame, t: str = "t", sid: str = "sid", v: str = "v") -> DataFrame:
    """B1: one cell per (time, station), mean of duplicates, missing skipped.

    Cells, times and stations that are all-missing disappear.  Partial
    aggregation happens map-side, so a hot station is pre-reduced before the
    shuffle.
    """
    return (obs.select(F.col(t).alias("t"), F.col(sid).alias("sid"), nan_to_null(v).alias("v"))
            .where(F.col("v").isNotNull())
            .groupBy("t", "sid").agg(F.avg("v").alias("v")))


def time_axis(cells: DataFrame) -> DataFrame:
    """Distinct axis times with a dense position ``idx`` (0-based) and ``n_times``.

    Positions are computed per month (a window partitioned by month) plus the
    running count of the earlier months.  The month table has twelve rows per
    year, the only data that meets in one task.
    """
    ax = cells.select("t").distinct().withColumn("mk", month_key("t"))
    months = ax.groupBy("mk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("mk").rowsBetween(Window.unboundedPreceding, -1)
    months = months.select("mk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
                           F.sum("n").over(Window.partitionBy()).alias("n_times"))
    within = F.row_number().over(Window.partitionBy("mk").orderBy("t")) - 1
    return (ax.withColumn("w", within).join(F.broadcast(months), "mk")
            .select("t", (F.col("base") + F.col("w")).cast("long").alias("idx"), F.col("n_times").cast("long")))


#: Cells of a dense grid that one task is meant to hold.
TASK_CELLS = 1_000_000


def grid_parts(cells: DataFrame, axis: DataFrame) -> int:
    """Parts by station of about ``TASK_CELLS`` dense cells, ``spark.sql.shuffle.partitions`` at least, so that
    a task sorts its cells in memory however large the grid is (counts the stations: give stored cells)."""
    least = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(cells.select("sid").distinct().count() * axis.count() / TASK_CELLS))


def dense_grid(cells: DataFrame, axis: DataFrame | None = None, extra: list[str] | None = None,
               parts: int | None = None) -> DataFrame:
    """Every axis time x every station with a cell, NULL where absent.

    ``extra`` names further value columns of ``cells`` carried along (B4).
    The axis (one row per hour of the calendar) is broadcast, so the cells cross one
    shuffle, by station, and the grid rows none: the grid stays partitioned by station
    (in ``parts`` parts, see ``spread``).
    """
    extra = list(extra or [])
    vals = ["v"] + extra
    if axis is None:
        axis = time_axis(cells)
    c = spread(cells.join(F.broadcast(axis), "t"), "sid", parts=parts)
    w = Window.partitionBy("sid").orderBy("idx")
    c = (c.withColumn("prev_idx", F.lag("idx").over(w))
         .withColumn("next_idx", F.lead("idx").over(w)))
    start = F.when(F.col("prev_idx").isNull(), F.lit(0).cast("long")).otherwise(F.col("idx"))
    stop = F.coalesce(F.col("next_idx"), F.col("n_times")) - 1
    runs = c.select("sid", "idx", *vals, F.explode(F.sequence(start, stop)).alias("k"))
    runs = runs.select("sid", F.col("k").alias("idx"),
                       *[F.when(F.col("k") == F.col("idx"), F.col(x)).alias(x) for x in vals])
    return runs.join(F.broadcast(axis.select("t", "idx")), "idx").select("t", "sid", *vals)


def outer_product(df: DataFrame, keys: tuple[str, str] = ("t", "sid"), values: list[str] | None = None) -> DataFrame:
    """Dense product of several value columns; duplicate keys are an error.

    Returns the dense frame; raise on duplicates before building it.
    """
    t, s = keys
    values = values or [c for c in df.columns if c not in keys]
    dups = df.groupBy(t, s).count().where(F.col("count") > 1).limit(1).count()
    if dups:
        raise ValueError("duplicate (time, station) keys")
    cells = df.select(F.col(t).alias("t"), F.col(s).alias("sid"), *values)
    first = values[0]
    cells = cells.withColumnRenamed(first, "v")
    out = dense_grid(cells, extra=values[1:])
    return out.withColumnRenamed("v", first)


def duplicate_keys(df: DataFrame, keys=("t", "sid")) -> DataFrame:
    """Keys appearing more than once (B4 check as a DataFrame)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


#: Stations of a wide frame at most that have a column each.
WIDE_STATIONS = 1000


def to_wide(grid: DataFrame, station_ids: list | None = None, value: str = "v") -> DataFrame:
    """One row per time, one column per station (export view only), in time
    order (E8: a distributed range-partitioned sort at the edge)."""
    return grid.groupBy("t").pivot("sid", station_ids).agg(F.first(value, ignorenulls=True)).orderBy("t")


def to_long(wide: DataFrame, value: str = "v") -> DataFrame:
    """B5 inverse: back to ``(t, sid, v)``; station ids come back as strings."""
    ids = [c for c in wide.columns if c != "t"]
    return wide.unpivot("t", ids, "sid", value)


def to_wide_blocks(grid: DataFrame, value: str = "v", width: int = WIDE_STATIONS) -> tuple[DataFrame, DataFrame]:
    """B5 for any number of stations: (wide frame, header ``(block, pos, sid)``).

    The stations are dealt into blocks of ``width`` places.  A row of the wide frame is a
    time and a block, column ``c<pos>`` the value of the block's station at that place.
    """
    # places in the order of hashed parts: counted per part, then the running count of the parts before
    ids = grid.select("sid").distinct().withColumn("part", F.pmod(F.xxhash64("sid"), F.lit(width)))
    ids = store(ids.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy("sid")) - 1))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = ids.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", before.alias("before"))
    at = F.col("before") + F.col("nth")
    header = store(ids.join(F.broadcast(parts), "part").select(F.floor(at / width).alias("block"), (at % width).cast("int").alias("pos"), "sid"))
    mine = header.select("block", "pos", F.col("sid").alias("_sid"))
    placed = grid.join(mine, F.col("sid").eqNullSafe(F.col("_sid"))).groupBy("t", "block").pivot("pos", list(range(width))).agg(F.first(value, ignorenulls=True))
    return placed.withColumnsRenamed({str(p): f"c{p}" for p in range(width)}), header


def from_wide_blocks(wide: DataFrame, header: DataFrame, value: str = "v") -> DataFrame:
    """Inverse of ``to_wide_blocks`` on a dense grid: back to ``(t, sid, v)``; station ids come back as strings, as in ``to_long``."""
    cells = [c for c in wide.columns if c not in ("t", "block")]
    at = wide.select("t", "block", F.posexplode(F.array(*cells)).alias("pos", value))
    return at.join(header, ["block", "pos"]).select("t", F.coalesce(F.col("sid").cast("string"), F.lit("null")).alias("sid"), value)


def slice_time(grid: DataFrame, start=None, end=None) -> DataFrame:
    """Both ends inclusive; absent or unusable bounds mean the full range."""
    low, high = (F.lit(bound).try_cast("timestamp_ntz") for bound in (start, end))
    return grid.where((low.isNull() | (F.col("t") >= low)) & (high.isNull() | (F.col("t") <= high)))


def dense_slice(cells: DataFrame, start=None, end=None) -> DataFrame:
    """B6 before B3: the slice of the dense grid, without building the rest of it.

    Every axis time holds a cell, so the sliced cells give the sliced axis.  Every
    station of the whole table stays: one missing cell at the slice's first time.
    """
    part = slice_time(cells, start, end).select("t", "sid", "v")
    first = part.agg(F.min("t")).scalar()
    empty = (cells.select("sid").distinct().select(first.alias("t"), "sid", F.lit(None).cast("double").alias("v"))
             .where(F.col("t").isNotNull()))
    filled = part.unionByName(empty)
    return dense_grid(filled.groupBy("t", "sid").agg(F.max("v").alias("v")), time_axis(part))


def timeframe(grid: DataFrame, start=None, end=None) -> DataFrame:
    """Label of a selection (``yyyyMMdd_yyyyMMdd``; no row if nothing is selected) or
    of the full range (with hours)."""
    if start is not None and end is not None:
        label = timeframe_label(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"), False)
        return slice_time(grid, start, end).agg(F.min("t").alias("t")).where(F.col("t").isNotNull()).select(label.alias("label"))
    return grid.agg(timeframe_label(F.min("t"), F.max("t"), True).alias("label"))


def with_season(grid: DataFrame) -> DataFrame:
    """B8."""
    return grid.withColumn("season", season("t"))


def apply_mask(df: DataFrame, good: str, v: str = "v", out: str | None = None) -> DataFrame:
    """Value where good, else missing."""
    return df.withColumn(out or v, mask(v, good))


def combine_flags(seasonal_good: str, *suspects: str):
    """good = seasonal and not any suspect flag (all flags non-null)."""
    c = F.col(seasonal_good)
    for s in suspects:
        c = c & ~F.col(s)
    return c


def mask_any(df: DataFrame, flags: list[str], v: str = "v", out: str = "v_masked") -> DataFrame:
    """Missing where any flag type is set; the flags stay beside the value."""
    any_set = F.greatest(*[F.coalesce(F.col(f), F.lit(False)) for f in flags]) if len(flags) > 1 else \
        F.coalesce(F.col(flags[0]), F.lit(False))
    return df.withColumn("any_flag", any_set).withColumn(out, F.when(~F.col("any_flag"), F.col(v)))


def drop_empty_stations(grid: DataFrame, v: str = "v") -> DataFrame:
    """Remove stations without any valid value."""
    keep = grid.where(F.col(v).isNotNull()).select("sid").distinct()
    return grid.join(keep, "sid", "left_semi")


def apply_masks(flags: DataFrame, time_mask: DataFrame, station_mask: DataFrame, good: str = "good",
                out: str = "final_good") -> DataFrame:
    """Final good = combined flag where time and station are both kept, false elsewhere.

    ``time_mask`` is ``(t, keep_t)`` and ``station_mask`` ``(sid, keep_s)``; both are
    dimension-sized and joined by key.
    """
    j = flags.join(time_mask, "t", "left").join(station_mask, "sid", "left")
    keep = F.coalesce(F.col("keep_t"), F.lit(False)) & F.coalesce(F.col("keep_s"), F.lit(False))
    return j.withColumn(out, keep & F.coalesce(F.col(good), F.lit(False)))


def ensure_columns(df: DataFrame, columns: list[str], types: dict | None = None) -> DataFrame:
    """Add missing columns as NULL and fix the column order."""
    types = types or {}
    out = df
    for c in columns:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(types.get(c, "string")))
    return out.select(*columns)


def with_units(df: DataFrame, units: dict[str, dict]) -> DataFrame:
    """Attach units / standard name / long name as column metadata."""
    return df.select(*[F.col(c).alias(c, metadata=units[c]) if c in units else F.col(c) for c in df.columns])


def current_level(columns: list[str]) -> int:
    """Highest ``t_lvlN`` among the columns (case-insensitive)."""
    import re

    levels = [int(m.group(1)) for c in columns if (m := re.fullmatch(r"t_lvl(\d+)", c, re.IGNORECASE))]
    if not levels:
        raise ValueError("no level columns")
    return max(levels)


def station_metadata(obs: DataFrame, cols=("lat", "lon", "alt")) -> DataFrame:
    """B2: first non-null value per station and column, ordered by time."""
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("t"))).alias(c) for c in cols]
    return obs.groupBy("sid").agg(*aggs)
