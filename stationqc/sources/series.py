"""A12 + A19: the stored series as a keyed table that deliveries are merged into.

A table is a folder:

* ``data``: one row per (station, time), in partitions by period of the time and
  bucket of the station.  A delivery rewrites only the partitions that it touches
  (dynamic partition overwrite), so reading the series is a plain scan: no grouping.
* ``counts``: per partition and station the hours held, rewritten with the partition.
* ``marks``: the state per station after each delivery (first and last time, rows
  delivered, late rows), made from the state before and the delivery alone.
* ``manifest``: one entry per finished delivery, with the partitions it rewrote.  It is
  written last.

Every step of a delivery gives the same files when it is done again: the merge keeps
the row of the latest delivery per key, and state and manifest overwrite their own
entry.  A delivery in the manifest is not done again; one that broke off before is
simply repeated.  One writer at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stationqc.functions.columns import epoch_seconds, valid_from_year
from stationqc.session import cut_lineage
from stationqc.sources.ingest import merge_keep_last

DATA = "station_id string, ts timestamp_ntz, temperature double, delivery long, period string, bucket int"
COUNTS = "station_id string, hours long, period string, bucket int"
MARKS = "station_id string, first_ts timestamp_ntz, last_ts timestamp_ntz, n_delivered long, n_late long, seq int"
MANIFEST = "delivery long, period string, bucket int, n_rows long, seq int"


@dataclass(frozen=True)
class SeriesTable:
    path: str
    buckets: int = 64
    period: str = "yyyy-MM"     # date pattern of a partition: its text order is the time order

    def place(self, station: str = "station_id", ts: str = "ts") -> list[Column]:
        """Partition columns of a row."""
        digest = F.conv(F.substring(F.md5(F.col(station)), 1, 8), 16, 10).cast("long")
        return [F.date_format(ts, self.period).alias("period"), F.pmod(digest, F.lit(self.buckets)).cast("int").alias("bucket")]


def _folder(spark: SparkSession, table: SeriesTable, name: str, schema: str) -> DataFrame:
    """One of the table's folders; an empty one is laid down first where it does not exist."""
    path = f"{table.path}/{name}"
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*(["seq"] if "seq " in schema else ["period", "bucket"])).parquet(path)
    return spark.read.schema(schema).parquet(path)


def read_series(spark: SparkSession, table: SeriesTable) -> DataFrame:
    """The series: a scan of the partitions, one row per key."""
    return _folder(spark, table, "data", DATA)


def read_manifest(spark: SparkSession, table: SeriesTable) -> DataFrame:
    """``(seq, delivery, period, bucket, n_rows)``: the partitions that each delivery rewrote, with their rows since."""
    return _folder(spark, table, "manifest", MANIFEST)


def read_marks(spark: SparkSession, table: SeriesTable) -> DataFrame:
    """A9/A13 from the state: per station the mark (none before 2020), rows delivered, rows that
    came at or before the mark of their time (late or repeated), hours held and hours missing
    between the first and the last."""
    marks = _folder(spark, table, "marks", MARKS)
    seq = marks.agg(F.max("seq")).first()[0]
    held = _folder(spark, table, "counts", COUNTS).groupBy("station_id").agg(F.sum("hours").alias("hours"))
    span = F.floor((epoch_seconds("last_ts") - epoch_seconds("first_ts")) / 3600) + 1
    return (marks.where(F.col("seq") == F.lit(-1 if seq is None else seq)).join(held, "station_id")
            .select("station_id", valid_from_year("last_ts").alias("mark"), "n_delivered", "n_late", "hours",
                    (span - F.col("hours")).cast("long").alias("gap_hours")))


def _rewrite(rows: DataFrame, path: str, *order: str) -> None:
    """Replace exactly the partitions that ``rows`` has; a large one is written by several tasks."""
    (rows.hint("rebalance", "period", "bucket").sortWithinPartitions("period", "bucket", *order)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period", "bucket").parquet(path))


def _only(rows: DataFrame, parts: list) -> DataFrame:
    """Rows of the given partitions, as a condition on the partition columns that prunes the scan."""
    keys = [f"{p}/{b}" for p, b in parts]
    return rows.where(F.concat_ws("/", "period", F.col("bucket").cast("string")).isin(keys) if keys else F.lit(False))


def upsert_series(spark: SparkSession, table: SeriesTable, rows: DataFrame, delivery: int, arrival: tuple[str, ...] = ()) -> bool:
    """Merge ``(station_id, ts, temperature)`` into the table; False if that delivery is in it already.

    Per key the row of the highest delivery stays; within a delivery the last by
    ``arrival`` (then by value).  Rows without station or time cannot be placed and
    are left out (they belong to the rejects).
    """
    manifest = read_manifest(spark, table)
    seen = manifest.agg(F.max("seq").alias("seq"), F.max((F.col("delivery") == F.lit(delivery)).cast("int")).alias("done")).first()
    if seen["done"]:
        return False
    seq = 0 if seen["seq"] is None else seen["seq"] + 1
    new = rows.where(F.col("station_id").isNotNull() & F.col("ts").isNotNull()).select(
        "station_id", "ts", "temperature", F.lit(delivery).cast("long").alias("delivery"), *table.place(), *arrival)
    new = cut_lineage(new)
    touched = [tuple(r) for r in new.select("period", "bucket").distinct().collect()]     # at most the table's partitions
    old = _only(read_series(spark, table), touched)
    merged = merge_keep_last(old.withColumn("_order", F.col("delivery")), new.withColumn("_order", F.col("delivery")),
                             keys=("station_id", "ts", "period", "bucket"), order="_order", arrival=arrival)
    _rewrite(merged.select("station_id", "ts", "temperature", "delivery", "period", "bucket"), f"{table.path}/data", "station_id", "ts")
    now = _only(read_series(spark, table), touched)
    _folder(spark, table, "counts", COUNTS)
    _rewrite(now.groupBy("station_id", "period", "bucket").agg(F.count(F.lit(1)).alias("hours")), f"{table.path}/counts", "station_id")
    _advance_marks(spark, table, new, seq)
    sizes = now.groupBy("period", "bucket").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(delivery).cast("long").alias("delivery"), "*")
    # a delivery without rows is in the manifest too, with no partition
    none = spark.range(1 if not touched else 0).select(F.lit(delivery).cast("long").alias("delivery"), F.lit(None).cast("string").alias("period"),
                                                       F.lit(None).cast("int").alias("bucket"), F.lit(0).cast("long").alias("n_rows"))
    sizes.unionByName(none).write.mode("overwrite").parquet(f"{table.path}/manifest/seq={seq}")
    return True


def _advance_marks(spark: SparkSession, table: SeriesTable, new: DataFrame, seq: int) -> None:
    """State after the delivery = state before + the delivery, per station."""
    before = _folder(spark, table, "marks", MARKS).where(F.col("seq") == F.lit(seq - 1)).drop("seq")
    known = before.select("station_id", F.col("last_ts").alias("known"))
    came = (new.join(known, "station_id", "left").groupBy("station_id")
            .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n_delivered"),
                 F.count_if(F.col("ts") <= F.col("known")).alias("n_late")))
    (before.unionByName(came).groupBy("station_id")
     .agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n_delivered").alias("n_delivered"),
          F.sum("n_late").alias("n_late"))
     .write.mode("overwrite").parquet(f"{table.path}/marks/seq={seq}"))


def compact_series(spark: SparkSession, table: SeriesTable, max_files: int = 4) -> int:
    """Rewrite the partitions that have more than ``max_files`` files; returns how many."""
    read_series(spark, table)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{table.path}/data")
    many = (files.select(F.regexp_extract("path", r"period=([^/]+)/bucket=(\d+)/", 1).alias("period"),
                         F.regexp_extract("path", r"period=([^/]+)/bucket=(\d+)/", 2).alias("bucket"))
            .groupBy("period", "bucket").count().where(F.col("count") > max_files).select("period", "bucket").collect())  # partitions
    if many:
        _rewrite(_only(read_series(spark, table), [tuple(r) for r in many]), f"{table.path}/data", "station_id", "ts")
    return len(many)
