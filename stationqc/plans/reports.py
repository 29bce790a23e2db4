"""Summaries and reports, each one aggregate pass over the grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationqc.functions.columns import round_to, season
from stationqc.operators import completeness as C
from stationqc.operators.seasonal import seasonal_threshold

SEASONS = ("DJF", "MAM", "JJA", "SON")  # fixed values: season names in report order


def dataset_summary(grid: DataFrame, stations: DataFrame) -> DataFrame:
    """Stations, timepoints, first/last time, missing cells, stations without altitude.

    The station count without altitude is a scalar subquery on the station
    dimension (planned as its own small job, no join).
    """
    no_alt = stations.where(F.col("alt").isNull()).select(F.count(F.lit(1)).cast("long")).scalar()
    return grid.agg(F.count_distinct("sid").cast("long").alias("n_stations"),
                    F.count_distinct("t").cast("long").alias("n_times"),
                    F.min("t").alias("first_t"), F.max("t").alias("last_t"),
                    F.count_if(F.col("v").isNull()).cast("long").alias("missing_cells"),
                    no_alt.alias("stations_no_alt"))


def seasonal_summary(grid: DataFrame) -> DataFrame:
    """Per season active stations, valid share (%) of the season's full grid,
    timepoints, first/last time; a 'no data' row for a season without times."""
    spark = grid.sparkSession
    per = (grid.withColumn("season", season("t")).groupBy("season")
           .agg(F.count_distinct(F.when(F.col("v").isNotNull(), F.col("sid"))).cast("long").alias("active_stations"),
                round_to(F.lit(100.0) * F.count("v") / F.count(F.lit(1)), 2).alias("completeness_pct"),
                F.count_distinct("t").cast("long").alias("n_times"),
                F.min("t").alias("first_t"), F.max("t").alias("last_t")))
    names = spark.createDataFrame([(s,) for s in SEASONS], "season string")
    j = F.broadcast(names).join(per, "season", "left")
    return j.select("season", F.coalesce("active_stations", F.lit(0)).cast("long").alias("active_stations"),
                    "completeness_pct", F.coalesce("n_times", F.lit(0)).cast("long").alias("n_times"),
                    "first_t", "last_t",
                    F.when(F.col("first_t").isNull(), F.lit("no data")).otherwise(F.lit("ok")).alias("status"))


def seasonal_daily_valid(grid: DataFrame, limits: dict, p: float) -> DataFrame:
    """Per-station counts after the seasonal limits and the daily/monthly completeness
    rule, where a cell is good when it is filled and within the limits."""
    g = seasonal_threshold(grid, limits)
    g = g.withColumn("flag", F.col("v").isNotNull() & F.col("seasonal_good"))
    c = C.completeness_temporal(g, "flag", p, out="out")
    return c.groupBy("sid").agg(
        F.count(F.lit(1)).cast("long").alias("n_cells"), F.count("v").cast("long").alias("n_filled"),
        F.count_if(~F.col("seasonal_good")).cast("long").alias("n_seasonal_bad"),
        F.count_distinct(F.when(F.col("day_bad"), F.col("day"))).cast("long").alias("n_days_bad"),
        F.count_if("out").cast("long").alias("n_valid"))
