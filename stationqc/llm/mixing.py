"""Mixing sources to target weights by a low-discrepancy source schedule (native Spark only).

The words of each source, its documents shuffled by a hash, form one stream that
is cut into blocks of equally many words.  The schedule has one slot per block to
take.  Slot j maps the golden-ratio point frac(j * phi) through the cumulative
slot quotas to a source, and is ranked among the slots of that source; rank k
takes block ``k mod blocks`` of the source's stream, so a source is repeated only
after all of it was taken.  What a document gives is summed over the blocks that
hold a part of it.

The golden-ratio sequence fills every interval of the quotas evenly at any length,
so each prefix of the schedule has the target mixture too.  Ranks and stream
offsets are two-level prefix sums (chunk counts first, then positions inside a
chunk), so a source with a third of all words is never sorted by one task.

Defined results: null text has no words; a null source is a source of its own and
comes last; documents without words get 0; repeated rows are documents of their
own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationqc.llm.common import md5_int, running_offsets, settle, word_count

#: Words of a block; smaller in a source so small that it would not fill MIN_BLOCKS blocks.
BLOCK_WORDS = 256
MIN_BLOCKS = 1024
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3

#: Golden ratio as a multiplier modulo 2**31 (odd, nearest to 2**31 / 1.618...).
GOLDEN, MODULUS = 1327217885, 2 ** 31
SLOT_CHUNK = 65536
CELLS = 4096


def source_plan(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets by water filling, over one row per source (source, source_size).

    Sources in code-point order, null last, take the weights in turn.  A source is
    full at ``max_epochs`` times its size; what it cannot hold is shared by the
    others by weight.  Filled in the order of cap / weight, the level at which the
    rest of the words fits the rest of the weights decides who is full.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    wcol = F.array(*[F.lit(float(w)) for w in weights])
    s = (sources.withColumn("rank", F.row_number().over(order) - 1)
         .withColumn("weight", F.get(wcol, (F.col("rank") % len(weights)).cast("int")))
         .withColumn("cap", F.col("source_size") * max_epochs))
    all_rows = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    s = (s.withColumn("total", F.sum("source_size").over(all_rows))
         .withColumn("all_weight", F.sum("weight").over(all_rows))
         .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(fill), F.lit(0)))
         .withColumn("weight_left", F.col("all_weight") - F.coalesce(F.sum("weight").over(fill), F.lit(0.0)))
         .withColumn("full", F.col("cap") * F.col("weight_left") <= F.col("left") * F.col("weight")))
    # full sources form a prefix of the filling order: the first other one sets the level
    level = F.min(F.when(~F.col("full"), F.struct((F.col("cap") / F.col("weight")).alias("o"), "rank",
                                                  "left", "weight_left"))).over(all_rows)
    s = s.withColumn("level", level)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * F.col("level.left") / F.col("level.weight_left"))
    return s.select("source", "source_size", "rank", target.cast("double").alias("target"))


def schedule_quotas(plan: DataFrame, block_words: int, min_blocks: int) -> DataFrame:
    """Block length, blocks and slot quota of each source, with the quota's interval."""
    block = F.least(F.lit(block_words), F.greatest(F.lit(1), F.floor(F.col("source_size") / min_blocks))).cast("long")
    order = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    q = (plan.filter("source_size > 0").withColumn("block", block)
         .withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long"))
         .withColumn("quota", F.round(F.col("target") / F.col("source_size") * F.col("blocks")).cast("long")))
    return q.withColumn("hi", F.sum("quota").over(order)).withColumn("lo", F.col("hi") - F.col("quota"))


def slots(spark, quotas: DataFrame, total: int) -> DataFrame:
    """slot, rank (of the source), k (rank of the slot within its source): the schedule."""
    point = (F.col("slot") % MODULUS * GOLDEN % MODULUS) / float(MODULUS)
    slot = spark.range(total).withColumnRenamed("id", "slot").withColumn("at", point * total)
    # the interval of a source meets a point only inside the cells that both touch
    width = max(total / CELLS, 1.0)
    cut = (quotas.filter("quota > 0")
           .withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))))
           .select("cell", F.col("rank"), "lo", "hi"))
    mapped = (slot.withColumn("cell", F.floor(F.col("at") / width)).join(cut, "cell")
              .filter("at >= lo and at < hi")
              .select("slot", "rank", F.floor(F.col("slot") / SLOT_CHUNK).alias("chunk"), F.lit(1).alias("one")))
    before = running_offsets(mapped, ["rank"], "chunk", "one", "before")
    w = Window.partitionBy("rank", "chunk").orderBy("slot")
    return (mapped.withColumn("in_chunk", F.row_number().over(w) - 1).join(before, ["rank", "chunk"])
            .select("slot", "rank", (F.col("before") + F.col("in_chunk")).alias("k")))


def _rank_of(docs: DataFrame, plan: DataFrame, cols: list[Column]) -> DataFrame:
    return docs.join(plan, docs["source"].eqNullSafe(plan["source"])).select(*cols)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block_words: int = BLOCK_WORDS, min_blocks: int = MIN_BLOCKS, weights=WEIGHTS,
        max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """doc_id, size, source_size, target, taken: what the mix takes of every document."""
    return mix_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                word_count(F.col(text_col)).alias("size")),
                    block_words, min_blocks, weights, max_epochs).drop("rid", "source")


def mix_rows(sized: DataFrame, block_words: int = BLOCK_WORDS, min_blocks: int = MIN_BLOCKS, weights=WEIGHTS,
             max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``mix`` over rows of (doc_id, source, size)."""
    spark = sized.sparkSession
    rows = settle(sized.select("doc_id", "source", "size", F.monotonically_increasing_id().alias("rid")))
    plan = settle(schedule_quotas_all(rows, block_words, min_blocks, weights, max_epochs))
    total = plan.agg(F.max("hi")).first()[0] or 0                       # one number: the length of the schedule

    at = md5_int(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), 15)
    ranked = (rows.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
              .withColumn("at", at).withColumn("bucket", F.floor(F.col("at") / 16 ** 12).cast("int")))
    stream = ranked.filter("size > 0").select("rid", "size", "rank", "block", "bucket", "at", "doc_id")
    before = running_offsets(stream, ["rank"], "bucket", "size", "before")
    w = (Window.partitionBy("rank", "bucket").orderBy("at", "doc_id", "size", "rid")
         .rowsBetween(Window.unboundedPreceding, -1))
    stream = (stream.withColumn("inside", F.coalesce(F.sum("size").over(w), F.lit(0)))
              .join(before, ["rank", "bucket"])
              .withColumn("lo", F.col("before") + F.col("inside")).withColumn("hi", F.col("lo") + F.col("size")))
    pieces = (stream.withColumn("block_no", F.explode(F.sequence(
        F.floor(F.col("lo") / F.col("block")), F.floor((F.col("hi") - 1) / F.col("block")))))
        .select("rid", "rank", "block_no",
                (F.least("hi", (F.col("block_no") + 1) * F.col("block"))
                 - F.greatest("lo", F.col("block_no") * F.col("block"))).alias("words")))

    chosen = (slots(spark, plan.filter("source_size > 0"), total)
              .join(plan.select("rank", "blocks"), "rank")
              .filter(F.col("k") < F.col("blocks") * max_epochs)
              .groupBy("rank", (F.col("k") % F.col("blocks")).alias("block_no")).agg(F.count("*").alias("times")))
    taken = (pieces.join(chosen, ["rank", "block_no"])
             .groupBy("rid").agg(F.sum(F.col("words") * F.col("times")).alias("taken")))
    return (ranked.join(taken, "rid", "left")
            .select("rid", "doc_id", "source", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def schedule_quotas_all(rows: DataFrame, block_words: int, min_blocks: int, weights, max_epochs: int) -> DataFrame:
    """Plan and quotas of every source; a source without words has neither blocks nor slots."""
    sources = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    plan = source_plan(sources, weights, max_epochs)
    quotas = schedule_quotas(plan, block_words, min_blocks).drop("source", "source_size", "target")
    return plan.join(quotas, "rank", "left")
