"""B5 / A18 as chunked arrays: the time x station matrix in blocks, without a column per station.

A dataset is a folder of three tables: ``blocks`` (a row per time chunk and station
chunk, its values as one array, a row of the matrix after the other; one partition per
time chunk, sorted by station chunk), and the index: ``axis`` (time -> chunk and
position) and ``stations`` (station -> chunk and position).  The wide view of a chunk is
its array, so no pivot is planned and no number of stations is too large; a slice looks
up its chunks in the index and reads only those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stationqc.operators.grid import time_axis
from stationqc.session import cut_lineage

#: Times and stations of a block, and groups that stations are numbered in.
TIMES, STATIONS, GROUPS = 256, 64, 64


def station_chunks(grid: DataFrame, size: int = STATIONS, groups: int = GROUPS) -> DataFrame:
    """``(sid, schunk, spos)``: stations numbered in id order within hashed groups, ``size`` to a chunk."""
    g = F.pmod(F.xxhash64("sid"), F.lit(groups))
    k = F.row_number().over(Window.partitionBy("g").orderBy("sid")) - 1
    numbered = grid.select("sid").distinct().withColumn("g", g).withColumn("k", k)
    return numbered.select("sid", (F.floor(F.col("k") / size) * groups + F.col("g")).cast("long").alias("schunk"),
                           (F.col("k") % size).cast("int").alias("spos"))


def write_chunks(grid: DataFrame, path: str, v: str = "v", times: int = TIMES, stations: int = STATIONS, groups: int = GROUPS,
                 mode: str = "overwrite") -> None:
    """Write a dense grid (every station at every time) as blocks with their index."""
    spark = grid.sparkSession
    grid = cut_lineage(grid.select("t", "sid", F.col(v).cast("double").alias("v")))
    axis = time_axis(grid).select("t", F.floor(F.col("idx") / times).cast("int").alias("tchunk"), (F.col("idx") % times).cast("int").alias("tpos"))
    axis.write.mode(mode).parquet(f"{path}/axis")
    station_chunks(grid, stations, groups).write.mode(mode).parquet(f"{path}/stations")
    axis, places = spark.read.parquet(f"{path}/axis"), spark.read.parquet(f"{path}/stations")
    widths = places.groupBy("schunk").agg(F.count(F.lit(1)).cast("int").alias("n_stations"))
    cells = grid.join(axis, "t").join(places, "sid").join(widths, "schunk")
    at = (F.col("tpos") * F.col("n_stations") + F.col("spos")).alias("at")
    blocks = (cells.groupBy("tchunk", "schunk").agg(
        F.max("n_stations").alias("n_stations"), F.count_if(F.col("v").isNotNull()).alias("n_filled"),
        F.sort_array(F.collect_list(F.struct(at, "v"))).alias("cells"))            # times * stations items at most
        .select("tchunk", "schunk", "n_stations", "n_filled", F.transform("cells", lambda c: c["v"]).alias("block")))
    (blocks.hint("rebalance", "tchunk").sortWithinPartitions("tchunk", "schunk").write.mode(mode).partitionBy("tchunk")
     .parquet(f"{path}/blocks"))


def _selected(spark: SparkSession, path: str, start, end, sids: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Axis, stations and blocks of a slice; the chunks are constants of the scan, so others are not read."""
    axis, places = spark.read.parquet(f"{path}/axis"), spark.read.parquet(f"{path}/stations")
    blocks = spark.read.parquet(f"{path}/blocks")
    if start is not None:
        axis = axis.where(F.col("t") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        axis = axis.where(F.col("t") <= F.lit(end).cast("timestamp_ntz"))
    if start is not None or end is not None:
        first = axis.agg(F.min("tchunk").alias("a"), F.max("tchunk").alias("b")).first()
        blocks = blocks.where(F.col("tchunk").between(F.lit(first["a"]), F.lit(first["b"])) if first["a"] is not None else F.lit(False))
    if sids is not None:
        places = places.join(sids.select("sid").distinct(), "sid", "left_semi")
        blocks = blocks.join(places.select("schunk").distinct(), "schunk", "left_semi")
    return axis, places, blocks


def read_chunks(spark: SparkSession, path: str, start=None, end=None, sids: DataFrame | None = None) -> DataFrame:
    """Back to ``(t, sid, v)``; both ends of a slice inclusive, ``sids`` names the stations wanted."""
    axis, places, blocks = _selected(spark, path, start, end, sids)
    long = blocks.select("tchunk", "schunk", "n_stations", F.posexplode("block").alias("at", "v"))
    tpos, spos = F.floor(F.col("at") / F.col("n_stations")).cast("int"), (F.col("at") % F.col("n_stations")).cast("int")
    long = long.select("tchunk", "schunk", tpos.alias("tpos"), spos.alias("spos"), "v")
    return long.join(axis, ["tchunk", "tpos"]).join(places, ["schunk", "spos"]).select("t", "sid", "v")


def wide_rows(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """The wide view: ``(t, schunk, row)``, the values of a chunk's stations at a time in the order of their positions."""
    axis, _, blocks = _selected(spark, path, start, end, None)

    def line(k: Column) -> Column:
        return F.slice("block", k.cast("int") * F.col("n_stations") + 1, F.col("n_stations"))
    n_times = (F.size("block") / F.col("n_stations")).cast("int")
    lines = blocks.select("tchunk", "schunk", F.posexplode(F.transform(F.sequence(F.lit(0), n_times - 1), line)).alias("tpos", "row"))
    return lines.join(axis, ["tchunk", "tpos"]).select("t", "schunk", "row")
