"""Files at rest.

Every read has an explicit schema.  Layers are Parquet directories partitioned
by the keys that queries filter on, so partition pruning and predicate
pushdown reach the scan.
"""

from __future__ import annotations

import posixpath
import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stationqc.operators.grid import drop_empty_stations
from stationqc.schemas import OBS_FILE, OBS_FILE_COLUMNS, STATION_LIST, STATION_LIST_COLUMNS

LAYERS = ("raw", "processed", "qc")  # fixed values: storage areas


def write_station_list(stations: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4: CSV with header and the fixed column order; extra columns are dropped."""
    stations.select(*STATION_LIST_COLUMNS).write.mode(mode).option("header", True).csv(path)


#: Column that keeps the text of a CSV line that does not fit its schema.
CORRUPT = "_corrupt_record"


def _checked(spark: SparkSession, schema: T.StructType):
    with_text = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(with_text).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT))


def station_lines(spark: SparkSession, path: str) -> DataFrame:
    """A4 with nothing lost: one row per line with ``reason`` (NULL, ``bad_line`` or ``no_station``) and ``raw``."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "bad_line").when(F.col("station_id").isNull(), "no_station")
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in STATION_LIST_COLUMNS])
    return _checked(spark, STATION_LIST).csv(path).select(
        *STATION_LIST_COLUMNS, reason.alias("reason"), F.when(reason.isNotNull(), F.coalesce(CORRUPT, line)).alias("raw"))


def read_station_list(spark: SparkSession, path: str) -> DataFrame:
    """A4: the station list; lines that do not fit are left out (``station_lines`` names them)."""
    return station_lines(spark, path).where(F.col("reason").isNull()).select(*STATION_LIST_COLUMNS)


def bucketed(df: DataFrame, station: str, buckets: int) -> DataFrame:
    """Add ``bucket``, a hash of the station, and rebalance by it: files per bucket, not
    per station; AQE splits a large bucket over tasks and joins small ones."""
    b = F.pmod(F.xxhash64(station), F.lit(int(buckets))).cast("int")
    return df.withColumn("bucket", b).hint("rebalance", "bucket")


def write_observation_files(obs: DataFrame, path: str, mode: str = "overwrite", buckets: int = 64) -> None:
    """Observation CSVs (time first, fixed columns), series in time order inside a file."""
    out = obs.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "temperature", "longitude",
                     "latitude", F.coalesce(F.col("altitude").cast("string"), F.lit("Unknown")).alias("altitude"),
                     F.col("station_id").alias("station_ID"))
    (bucketed(out.select(*OBS_FILE_COLUMNS), "station_ID", buckets).sortWithinPartitions("bucket", "station_ID", "ts")
     .write.mode(mode).option("header", True).partitionBy("bucket").csv(path))


def observation_lines(spark: SparkSession, path: str) -> DataFrame:
    """A14 with nothing lost: one row per line of all observation CSVs below ``path``, with
    ``reason`` and ``raw``.  ``reason`` is NULL for an accepted line, else ``bad_line`` (a wrong
    number of fields or a text where a number belongs), ``no_station`` or ``bad_time``."""
    raw = _checked(spark, OBS_FILE).option("recursiveFileLookup", True).csv(path)
    ts = F.col("ts").try_cast("timestamp_ntz")
    reason = (F.when(F.col(CORRUPT).isNotNull(), "bad_line").when(F.col("station_ID").isNull(), "no_station")
              .when(ts.isNull(), "bad_time"))
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in OBS_FILE_COLUMNS])
    return raw.select(F.col("station_ID").alias("station_id"), ts.alias("ts"), "temperature", "longitude", "latitude",
                      F.col("altitude").try_cast("double").alias("altitude"), reason.alias("reason"),
                      F.when(reason.isNotNull(), F.coalesce(CORRUPT, line)).alias("raw"))


def read_observation_files(spark: SparkSession, path: str) -> DataFrame:
    """All observation CSVs below ``path``; the first column is the time;
    altitude is numeric or NULL ('Unknown' and other text -> NULL).  Lines that do not fit
    are left out (``observation_lines`` names them)."""
    return observation_lines(spark, path).where(F.col("reason").isNull()).drop("reason", "raw")


def layered_write(df: DataFrame, base: str, layer: str, station: str = "station_id", buckets: int = 64,
                  mode: str = "overwrite") -> str:
    """Write a frame into one of the storage areas, in buckets of stations."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    path = f"{base.rstrip('/')}/{layer}"
    bucketed(df, station, buckets).sortWithinPartitions("bucket", station).write.mode(mode).partitionBy("bucket").parquet(path)
    return path


def file_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Layer, name below the base, and bytes of every stored file.  The layer is
    the first path part below the base (empty if that is none of the layers).  Only
    ``path`` and ``length`` are selected, so file contents are never read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
             .select("path", "length"))
    below = posixpath.normpath(re.sub(r"^[a-z0-9+.-]+:(//[^/]*)?", "", base)) + "/"
    name = F.substring_index("path", below, -1)
    layer = F.substring_index(name, "/", 1)
    return (files.where(~F.col("path").rlike(r"/(_SUCCESS|\.[^/]*)$"))
            .select(F.when(layer.isin("raw", "processed", "qc"), layer).otherwise("").alias("layer"),
                    name.alias("name"), F.col("length").alias("n_bytes")))


def layer_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Files and size in MB per layer."""
    return (file_inventory(spark, base).groupBy("layer")
            .agg(F.count(F.lit(1)).cast("long").alias("n_files"),
                 F.round(F.sum("n_bytes") / F.lit(1024.0 * 1024.0), 1).alias("size_mb")))


# Variable attributes of the QC output.
TEMPERATURE_UNITS = {"units": "°C", "standard_name": "air_temperature", "long_name": "Quality controlled air temperature"}
FLAG_UNITS = {"units": "1", "long_name": "Quality control flag", "flag_values": "0, 1",
              "flag_meanings": "failed_qc passed_qc"}


def level_units(column: str) -> dict:
    """Attributes of a value column: those of its level for ``t_lvlN``."""
    level = re.fullmatch(r"t_lvl(\d+)", column)
    if not level:
        return TEMPERATURE_UNITS
    return TEMPERATURE_UNITS | {"long_name": f"Air temperature at quality control level {level.group(1)}"}


def write_qc_dataset(grid: DataFrame, stats: DataFrame, path: str, value_cols=("v_qc",), flag_cols=("final_good",),
                     stations: DataFrame | None = None, methods: str = "", drop_empty: str | None = None,
                     title: str = "Quality controlled temperature data", mode: str = "overwrite") -> None:
    """Values and 0/1 flags as Parquet partitioned by month, units / names as column
    metadata; statistics, methods and title in a one-row table; with ``stations`` the
    station vectors (id, position, altitude) of the stations in the dataset.
    ``drop_empty`` names the value column without whose values a station is left out.
    A dataset of all levels lists every ``t_lvlN`` and its flags."""
    kept = drop_empty_stations(grid, drop_empty) if drop_empty else grid
    cols = [F.col("t"), F.col("sid")]
    cols += [F.col(c).alias(c, metadata=(kept.schema[c].metadata or {}) | level_units(c)) for c in value_cols]
    cols += [F.col(c).cast("int").alias(c, metadata=FLAG_UNITS) for c in flag_cols]
    out = kept.select(*cols, F.date_format("t", "yyyy-MM").alias("month"))
    (out.hint("rebalance", "month").sortWithinPartitions("month", "sid", "t")
     .write.mode(mode).partitionBy("month").parquet(f"{path}/data"))
    if stations is not None:
        present = grid.sparkSession.read.parquet(f"{path}/data").select("sid").distinct()
        (stations.select("sid", "lat", "lon", "alt").join(present, "sid", "left_semi")
         .write.mode(mode).parquet(f"{path}/stations"))
    meta = stats.select("*", F.lit(title).alias("title"), F.lit(methods).alias("qc_methods"),
                        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("creation_date"))
    meta.coalesce(1).write.mode(mode).parquet(f"{path}/dataset_meta")


def write_grid(grid: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The stored time x station grid: Parquet partitioned by month and sorted by
    station and time inside each file, so time slices prune partitions and
    station predicates skip row groups.  The rebalance lets AQE write a large month
    from many tasks."""
    (grid.withColumn("month", F.date_format("t", "yyyy-MM"))
     .hint("rebalance", "month").sortWithinPartitions("month", "sid", "t")
     .write.mode(mode).partitionBy("month").parquet(path))


def read_grid(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Read a stored grid; a time range is turned into a month filter as well, so
    the scan touches only the months it needs (partition pruning) before the
    exact (inclusive) time filter."""
    g = spark.read.parquet(path)
    if start is not None:
        g = g.where((F.col("month") >= F.date_format(F.lit(start).cast("timestamp_ntz"), "yyyy-MM"))
                    & (F.col("t") >= F.lit(start).cast("timestamp_ntz")))
    if end is not None:
        g = g.where((F.col("month") <= F.date_format(F.lit(end).cast("timestamp_ntz"), "yyyy-MM"))
                    & (F.col("t") <= F.lit(end).cast("timestamp_ntz")))
    return g.drop("month")
