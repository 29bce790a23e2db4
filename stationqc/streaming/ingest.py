"""Incremental ingest (re-aim of the resumable download).

Landed measurement payloads (JSON lines ``{"station_id": .., "body": {epoch:
[value]}}``) are picked up by a file-source stream; each micro-batch is parsed
(A6) and appended to ``<table>/batch_id=<n>``.  The write of a batch is keyed
by its id, so a retried batch overwrites its own folder (exactly once), and
the stream checkpoint records which files were consumed: a re-run picks up
only what is new.  Reading the table merges keep-last per (station, time) with
the batch id as delivery order (A12), so re-delivered hours overwrite.

``start_series_ingest`` is the form for long histories: every batch is merged into a
keyed table (``sources.series``), which is read without grouping and carries the marks
per station, and what does not fit goes to a rejects table keyed by the batch id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from stationqc.operators.seasonal import seasonal_good
from stationqc.sources.ingest import merge_keep_last
from stationqc.session import cut_lineage
from stationqc.sources.payloads import accepted, measure_entries, parse_measure_payload, rejected
from stationqc.sources.series import SeriesTable, upsert_series

LANDED = T.StructType([T.StructField("station_id", T.StringType()),
                       T.StructField("body", T.MapType(T.StringType(), T.ArrayType(T.DoubleType())))])


def start_ingest(spark: SparkSession, landing: str, table: str, checkpoint: str, available_now: bool = True,
                 max_files_per_trigger: int | None = None, season_limits: dict | None = None):
    """Start the ingest stream.  With ``season_limits`` every delivered reading also
    carries the stateless seasonal good-flag (D1), computed per micro-batch."""
    src = spark.readStream.schema(LANDED)
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = src.json(landing).select("station_id", F.to_json(F.struct("body")).alias("json"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = parse_measure_payload(batch)
        if season_limits is not None:
            rows = rows.withColumn("seasonal_good", seasonal_good("temperature", "ts", season_limits))
        rows.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_ingested(spark: SparkSession, table: str, with_flag: bool = False) -> DataFrame:
    """The ingested table with duplicates resolved keep-last by batch id."""
    cols = ["station_id", "ts", "temperature"] + (["seasonal_good"] if with_flag else [])
    schema = "station_id string, ts timestamp_ntz, temperature double, " + \
        ("seasonal_good boolean, " if with_flag else "") + "batch_id long"
    raw = spark.read.schema(schema).option("basePath", table).parquet(table)
    empty = raw.limit(0)
    return merge_keep_last(empty, raw, order="batch_id", columns=cols)


REJECTS = "station_id string, reason string, raw string, batch_id long"


def deliver(spark: SparkSession, documents: DataFrame, table: SeriesTable, rejects: str, batch_id: int,
            col: str = "value") -> None:
    """One batch of landed documents (one JSON text per row): the readings are merged into the
    series, the rest is written with reason and raw text.  Repeating a batch changes nothing."""
    entries = cut_lineage(measure_entries(documents, col, station_col=None))
    rejected(entries).write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
    upsert_series(spark, table, accepted(entries), batch_id)


def start_series_ingest(spark: SparkSession, landing: str, table: SeriesTable, rejects: str, checkpoint: str,
                        available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the stream over landed files of JSON lines ``{"station_id": .., "body": {epoch: [value]}}``."""
    src = spark.readStream
    if max_files_per_trigger:
        src = src.option("maxFilesPerTrigger", max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        deliver(spark, batch, table, rejects, batch_id)
    w = src.text(landing).writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_rejects(spark: SparkSession, rejects: str) -> DataFrame:
    return spark.read.schema(REJECTS).option("basePath", rejects).parquet(rejects)
