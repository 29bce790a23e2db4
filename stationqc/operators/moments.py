"""D15 from stored moments: the climatology as a table that new cells are merged into.

A row per (station, day of year) holds the number of values, their mean and the sum of
squared deviations (M2); two such rows merge by the pairwise formula
``M2 = M2a + M2b + d * d * na * nb / (na + nb)`` with ``d`` the difference of the means,
and a row can be taken out again by its inverse.  So a delivery reads its own cells
and the small table, never the history.  The rows of the axis (missing cells count as
rows) are kept as times per day of year, the same for all stations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

DAYS = 366
#: Readings that one task is meant to hold.
TASK_ROWS = 500_000


def dealt(rows: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """``rows`` hash-partitioned by station into parts of about ``TASK_ROWS`` rows of ``of`` (default: of themselves),
    ``spark.sql.shuffle.partitions`` at least: cells, moments and windows are made where the rows
    are, and a task's memory does not grow with the table."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, math.ceil((rows if of is None else of).count() / TASK_ROWS)), "sid")


def day_moments(cells: DataFrame, v: str = "v") -> DataFrame:
    """``(sid, doy, n, mean, m2)`` of filled cells ``(t, sid, v)``, partial before the shuffle."""
    n = F.count(v)
    return (cells.groupBy("sid", F.dayofyear("t").alias("doy"))
            .agg(n.alias("n"), F.avg(v).alias("mean"), (F.var_pop(v) * n).alias("m2")).where(F.col("n") > 0))


def axis_days(times: DataFrame) -> DataFrame:
    """``(doy, n_times)`` of axis times ``(t)``."""
    return times.select("t").distinct().groupBy(F.dayofyear("t").alias("doy")).agg(F.count(F.lit(1)).alias("n_times"))


def _combined(a: DataFrame, b: DataFrame, sign: int) -> DataFrame:
    """Row by row a + b (sign 1) or a - b (sign -1)."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("sid", "doy", *[F.col(c).alias(f"{name}_{c}") for c in ("n", "mean", "m2")])
    j = side(a, "a").join(side(b, "b"), ["sid", "doy"], "full_outer")
    na, nb = F.coalesce("a_n", F.lit(0)), F.coalesce("b_n", F.lit(0))
    ma, mb, qa, qb = (F.coalesce(c, F.lit(0.0)) for c in ("a_mean", "b_mean", "a_m2", "b_m2"))
    n = na + F.lit(sign) * nb
    some = F.nullif(n, F.lit(0)).cast("double")
    mean = F.when(nb == 0, ma).when(na == 0, mb).otherwise(ma + F.lit(float(sign)) * (mb - ma) * nb / some)
    d = mb - (ma if sign > 0 else mean)
    other = na if sign > 0 else n
    m2 = qa + F.lit(float(sign)) * (qb + d * d * nb * other / (some if sign > 0 else F.nullif(na, F.lit(0)).cast("double")))
    m2 = F.when(nb == 0, qa).when(na == 0, qb).otherwise(F.greatest(m2, F.lit(0.0)))
    return j.select("sid", "doy", n.alias("n"), mean.alias("mean"), m2.alias("m2")).where(F.col("n") > 0)


def merge_moments(a: DataFrame, b: DataFrame) -> DataFrame:
    return _combined(a, b, 1)


def retract_moments(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a`` without the cells of ``b`` (cells that a later delivery replaces)."""
    return _combined(a, b, -1)


def climatology_of(moments: DataFrame, axis: DataFrame, stations: DataFrame, half_days: float = 15.0) -> DataFrame:
    """D15 ``(sid, doy, clim_rows, clim_n, clim_mean, clim_std)`` from stored moments.

    A day's window is a frame of +-half days over the station's days in order, with the days
    of the year's edges repeated beyond the other edge (circular over 366 days); days are
    merged around the station's mean of the window, as sums of n, n * mean and M2 with
    the part between days.  The moments cross one shuffle, by station, and a station's window
    holds 366 days and the repeated ones, whatever the width and the number of stations.
    """
    h = int(math.floor(half_days))
    lo, hi = max(-h, -182), min(h, 183)

    def reached(doy: Column) -> Column:
        return F.transform(F.sequence(F.lit(lo), F.lit(hi)), lambda k: F.pmod(doy - 1 + k, F.lit(DAYS)) + 1)
    rows = axis.select(F.explode(reached(F.col("doy"))).alias("doy"), "n_times").groupBy("doy").agg(F.sum("n_times").alias("clim_rows"))
    rows = F.broadcast(rows)   # 366 rows
    days = stations.select("sid", F.explode(F.sequence(F.lit(1), F.lit(DAYS))).alias("doy")).join(rows, "doy")
    near = days.select("sid", "doy", "clim_rows", *[F.lit(None).cast(k).alias(c) for c, k in (("n", "long"), ("s1", "double"), ("s2", "double"))])
    # a row of the moments counts on its own day and, near the year's edges, a year before or after
    shown = F.array(F.col("doy"), F.when(F.col("doy") > DAYS - hi, F.col("doy") - DAYS), F.when(F.col("doy") <= -lo, F.col("doy") + DAYS))
    s1 = F.col("n") * F.col("mean")
    given = moments.where(F.col("sid").isNotNull()).select(
        "sid", F.explode(F.array_compact(shown)).alias("doy"), F.lit(None).cast("long").alias("clim_rows"), "n", s1.alias("s1"),
        (F.col("m2") + s1 * F.col("mean")).alias("s2"))
    w = Window.partitionBy("sid").orderBy("doy").rangeBetween(-hi, -lo)
    j = dealt(near.unionByName(given), moments).select("sid", "doy", "clim_rows", *[F.sum(c).over(w).alias(c) for c in ("n", "s1", "s2")])
    mean = F.col("s1") / F.col("n")
    var = F.greatest(F.col("s2") / F.col("n") - mean * mean, F.lit(0.0))
    return (j.where(F.col("clim_rows").isNotNull())
            .select("sid", "doy", F.col("clim_rows").cast("long").alias("clim_rows"), F.coalesce("n", F.lit(0)).alias("clim_n"),
                    mean.alias("clim_mean"), F.sqrt(var).alias("clim_std")))


def update_moments(spark: SparkSession, path: str, cells: DataFrame, seq: int, replaced: DataFrame | None = None) -> None:
    """State ``seq`` of the table at ``path``: state ``seq - 1`` and the new cells, less the cells they replace.

    A state is made from the one before and the delivery alone, so repeating it gives
    the same state again; the cells' times extend the axis.
    """
    new = day_moments(cells)
    times = cells.select("t").distinct()
    if seq:
        before = spark.read.parquet(f"{path}/moments/seq={seq - 1}")
        if replaced is not None:
            before = retract_moments(before, day_moments(replaced))
        new = merge_moments(before, new)
        times = spark.read.parquet(f"{path}/times/seq={seq - 1}").union(times).distinct()
    new.write.mode("overwrite").parquet(f"{path}/moments/seq={seq}")
    times.write.mode("overwrite").parquet(f"{path}/times/seq={seq}")


def stored_climatology(spark: SparkSession, path: str, seq: int, half_days: float = 15.0) -> DataFrame:
    """D15 from state ``seq`` of the table at ``path``."""
    moments = spark.read.parquet(f"{path}/moments/seq={seq}")
    axis = axis_days(spark.read.parquet(f"{path}/times/seq={seq}"))
    return climatology_of(moments, axis, moments.select("sid").distinct(), half_days)
