"""Adapters that turn the driver's tables into station observations.

``events`` -> hourly observations, one station per user (adapter E), ``lineitem`` ->
daily observations of the suppliers (adapter L), plus a deterministic station
dimension.  All of them are lazy projections/aggregations of the given tables,
so their work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationqc.functions.columns import epoch_seconds, hour_floor, nan_to_null


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw hourly readings ``(sid, t, v)``; duplicates per hour are left to ``hourly_cells``."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("sid"),
                     hour_floor("ts").alias("t"),
                     nan_to_null(F.lit(10.0) + (F.col("value") - F.lit(50.0)) / F.lit(10.0)).alias("v"))


def lineitem_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily readings ``(sid, t, v)`` over several years."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").alias("sid"), F.col("l_shipdate").alias("t"),
                     nan_to_null(F.col("l_quantity") - F.lit(10.0)).alias("v"))


def station_coords(sid) -> dict:
    """Deterministic coordinates (fixed formulas of the fixtures).  Every block of 24
    stations has a 0.1 degree square of its own, so the network grows in area and a
    station's neighbour count stays the same however many stations there are."""
    s = F.col(sid) if isinstance(sid, str) else sid
    lat = F.lit(46.40) + (s * 37 % 1009).cast("double") / F.lit(10000.0) \
        + (F.floor(s / 24) % 100).cast("double") / F.lit(10.0)
    lon = F.lit(11.25) + (s * 401 % 1009).cast("double") / F.lit(10000.0) \
        + F.floor(s / 2400).cast("double") * F.lit(0.15)
    alt = F.when(s % 17 == 16, F.lit(None).cast("double")).otherwise(
        F.lit(200.0) + (s * 53 % 60).cast("double") * F.lit(10.0))
    return {"lat": lat, "lon": lon, "alt": alt}


def station_dim(cells: DataFrame) -> DataFrame:
    """``(sid, lat, lon, alt)`` for every station present in the cells."""
    c = station_coords("sid")
    return cells.select("sid").distinct().select("sid", c["lat"].alias("lat"), c["lon"].alias("lon"),
                                                  c["alt"].alias("alt"))


def stations_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``station_dim`` of the cells of adapter E: the stations with a value, without building the cells."""
    return station_dim(events_obs(spark, sf_dir).where(F.col("v").isNotNull()))


def stations_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``station_dim`` of the cells of adapter L."""
    return station_dim(lineitem_obs(spark, sf_dir).where(F.col("v").isNotNull()))


def fill_rule(grid: DataFrame) -> DataFrame:
    """Adapter F: fill most holes of a dense grid by a fixed arithmetic rule."""
    hidx = F.floor(epoch_seconds("t") / 3600).cast("long")
    fill = F.when((hidx * 31 + F.col("sid") * 17) % 97 < 90,
                  F.lit(10.0) + ((hidx * 13 + F.col("sid") * 29) % 83).cast("double") / F.lit(8.3))
    return grid.withColumn("v", F.coalesce(F.col("v"), fill))
