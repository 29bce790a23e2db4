"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationqc.session import ensure_checkpoint_dir

#: White space of every contract here: blank, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``.

    A session without that setting gets a folder of its own only when it runs in
    one process (``local[..]``), where every task sees the driver's disk.
    """
    own = None
    if not spark.sparkContext.getCheckpointDir() and re.match(r"local(\[|$)", spark.sparkContext.master):
        if not spark.conf.get("spark.checkpoint.dir", None):
            own = tempfile.mkdtemp(prefix="ckpt-")
    return ensure_checkpoint_dir(spark, default=own)


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: cuts the lineage, survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    For loops: unlike a checkpoint, a table read back has the size of its files, so
    the planner's size estimates do not multiply from round to round.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-space characters (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def md5_int(value: Column, digits: int) -> Column:
    """First hex digits (15 at most) of the MD5 of a string, as an integer."""
    return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("long")


def running_offsets(rows: DataFrame, keys: list[str], part: str, amount: str, name: str) -> DataFrame:
    """Per (keys, part): the sum of ``amount`` over all smaller parts of the same keys.

    First level of a two-level prefix sum: only one row per (keys, part) meets in
    the window, so a hot key does not pull its rows into one task.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, part).agg(F.sum(amount).alias("_sum"))
    return sums.select(*keys, part, F.coalesce(F.sum("_sum").over(w), F.lit(0)).cast("long").alias(name))
