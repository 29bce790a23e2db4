"""Cross-site boilerplate removal by the distinct-site spread of lines (native Spark only).

A line's key is the 128-bit digest of its text without surrounding white space.  One
aggregation by key merges HyperLogLog sketches of the sites a line occurs on.
Lines whose estimate is clearly below or above the threshold are settled by it;
those within the sketch's error band get an exact distinct count over their
(line, site) pairs.  Lines on at least ``min_sites`` sites leave every document.

Skew: sketches and pairs are pre-aggregated before each shuffle, so a line that
fills a third of all rows arrives as one sketch per task and one pair per site;
the join that marks a document's boilerplate is salted by document.

Defined results: blank lines always stay; a null site is a site of its own; null
text stays null with 0 lines; repeated documents each count, on one site; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationqc.llm.common import SPACE

MIN_SITES = 5
#: log2 of the sketch's registers: standard error 1.04 / sqrt(2**10) = 3.3 %.
LG_K = 10
#: Estimates within 6 standard errors of the threshold are counted exactly.
BAND = 6 * 1.04 / 2 ** (LG_K / 2)
SALTS = 16

_EDGES = rf"^{SPACE}|{SPACE}$"


def line_spread(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Keys of boilerplate lines, from rows of (h, site)."""
    sketch = lines.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
    est = sketch.select("h", F.hll_sketch_estimate("sketch").cast("double").alias("est"))
    est = est.filter(F.col("est") >= min_sites * (1 - BAND))
    sure = est.filter(F.col("est") > min_sites * (1 + BAND)).select("h")
    near = est.filter(F.col("est") <= min_sites * (1 + BAND)).select("h")
    pairs = lines.groupBy("h", "site").agg(F.lit(1).alias("one"))
    exact = (pairs.join(near, "h").groupBy("h").agg(F.count("*").alias("sites"))
             .filter(F.col("sites") >= min_sites).select("h"))
    return sure.unionByName(exact)


def remove_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                       min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, n_lines, n_removed, text (without the boilerplate lines)."""
    key = lambda line: F.unhex(F.md5(F.regexp_replace(line, _EDGES, "")))
    site = F.coalesce(F.concat(F.lit("s"), F.col(site_col)), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), site.alias("site"), F.col(text_col).alias("text"))
    lines = (base.select("doc_id", "site", F.explode(F.split("text", "\n", -1)).alias("line"))
             .filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
             .select("doc_id", "site", key(F.col("line")).alias("h")))
    spread = line_spread(lines.select("h", "site"), min_sites)
    salted = spread.select("h", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    marked = (lines.select("doc_id", "h", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
              .join(salted, ["h", "salt"])
              .groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("k"))
              .agg(F.collect_set("h").alias("bad")))
    kept = F.when(F.col("bad").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda x: ~F.array_contains("bad", key(x)) | ~x.rlike(r"[^\x20\x09-\x0D]")))
    return (base.withColumn("k", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
            .join(marked, "k", "left")
            .withColumn("lines", F.split("text", "\n", -1)).withColumn("kept", kept)
            .select("doc_id", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
                    F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"),
                    F.when(F.col("bad").isNull(), F.col("text")).otherwise(F.array_join("kept", "\n")).alias("text")))
