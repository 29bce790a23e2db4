"""Session construction and checkpoint-directory handling."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str = "local[*]", app: str = "stationqc", shuffle_partitions: int = 8,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    * session zone UTC, so zone-bearing casts cannot shift naive timestamps;
    * AQE on: runtime broadcast of small join sides, partition coalescing and
      skew-join splitting are left to the optimizer;
    * UI off: nothing listens on a port.
    """
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # inputs hash-partitioned by time may join on (time, station) without a
         # re-shuffle; every time holds one row per station, so no skew follows
         .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
         # no broadcast from static size *estimates*: only sides whose measured
         # (runtime) size is small are broadcast by AQE, plus explicit hints on
         # sides with a proven bound
         .config("spark.sql.autoBroadcastJoinThreshold", "-1")
         .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Return the checkpoint directory, configuring it from the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    used as is.  Only where nothing is configured, ``default`` (tests) or, in a
    session of one process, a scratch folder is taken; a cluster session without a
    setting gets an error, since its executors could not read a local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    target = conf or default
    if not target and re.match(r"local(\[|$)", sc.master):
        target = tempfile.mkdtemp(prefix="stationqc-ckpt-")
    if not target:
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for checkpoints")
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir()


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint (written to the shared checkpoint folder)."""
    spark = spark or df.sparkSession
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def store(df):
    """``df`` written as a compressed columnar table below the checkpoint folder and read back.

    For grid-sized steps: a reliable checkpoint holds uncompressed rows, several times as many bytes.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df, *keys, parts: int | None = None):
    """Hash-partition ``df`` by ``keys`` into ``parts`` parts (default ``spark.sql.shuffle.partitions``).

    Used in front of compute-heavy stages (neighbour expansion, range windows,
    per-time scans) whose *input* shuffle is small: an explicit count keeps AQE
    from coalescing them into a single task, while the key still co-locates
    the rows the stage needs.  Rows that lie so already cross no further shuffle.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)
