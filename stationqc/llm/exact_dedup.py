"""Exact deduplication by a tree-merge of sorted digest runs (native Spark only).

Every row belongs to one of ``fan ** levels`` origin runs.  A run holds one entry
per digest: the smallest identifier and the number of rows.  In round t the runs
whose addresses differ only in digit t exchange entries: an entry leaves for the
address in which the origin's digit t is replaced by the digest's digit t, and
the runs that meet there are merged by (digest, text length), keeping the smallest
identifier.  After the last round an address is given by the digest alone, so each
digest is held once, at one of all addresses: no task ever sees all entries.

Runs are partitioned by their address, so a run lies in one task, sorted by digest;
a round is one exchange by the new address, a sort and a merge of equal neighbours,
without another exchange.  Runs stay even: rows are dealt to their origin by hash, and
from then on a digest is in a run at most once.

The verdict descends the same tree: an entry of a level is unique per (address,
digest), so a group of copies as large as a third of all rows still meets every
join as at most one row per run; its rows are spread over the runs evenly.

Defined results: null text counts as empty; a group whose identifiers are equal
keeps exactly one of its rows; null identifiers sort last (a group with only null
identifiers keeps one row, with a null ``keep_id``); an empty table gives no rows;
columns other than the two named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationqc.llm.common import SPACE, settle, shuffle_partitions

FAN = 8


def run_levels(partitions: int, fan: int = FAN) -> int:
    levels = 2
    while fan ** levels < partitions:
        levels += 1
    return levels


def text_sha256(text: Column) -> Column:
    """SHA-256 of the text with every run of white space as one space; null is empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "), 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan: int = FAN) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    levels = run_levels(shuffle_partitions(docs.sparkSession), fan)
    runs = fan ** levels
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ")
    rows = (docs.select(F.col(id_col).alias("doc_id"), norm.alias("_norm"))
            .select("doc_id", F.unhex(F.sha2("_norm", 256)).alias("digest"),
                    F.octet_length("_norm").alias("bytes"), F.monotonically_increasing_id().alias("rid"))
            .withColumn("addr", F.pmod(F.xxhash64("doc_id", "rid"), F.lit(runs)).cast("int")))
    rows = settle(rows)

    ident = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    key = ["addr", "digest", "bytes"]

    def run(entries: DataFrame) -> DataFrame:
        """Entries at their addresses, each address whole in one task and sorted by digest."""
        return entries.repartition(shuffle_partitions(docs.sparkSession), "addr").sortWithinPartitions(*key)
    # each level is stored: the verdict descends over the same runs, and a lost executor costs one round
    tree = [settle(run(rows).groupBy(*key).agg(F.min(ident).alias("keep"), F.count("*").alias("size")))]
    home = F.pmod(F.xxhash64("digest"), F.lit(runs)).cast("int")
    parents = []
    for t in range(1, levels + 1):
        low = fan ** t
        parents.append((F.col("addr") - F.col("addr") % low + home % low).cast("int"))
        tree.append(settle(run(tree[-1].withColumn("addr", parents[-1])).groupBy(*key)
                           .agg(F.min("keep").alias("keep"), F.sum("size").alias("size"))))

    verdict = tree[-1]
    for level, parent in zip(reversed(tree[:-1]), reversed(parents)):
        child = level.select(F.col("addr").alias("child"), parent.alias("addr"), "digest", "bytes")
        verdict = (child.join(verdict, key)
                   .select(F.col("child").alias("addr"), "digest", "bytes", "keep", "size"))
    return (rows.join(verdict, key)
            .select("doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
                    (F.col("keep.rid") == F.col("rid")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")))
