"""D7/D8 as dependency rounds: the order-dependent scan by joins and aggregates.

A station's outcome at a time depends only on the lower ids within
max(inner, outer): which of them are flagged there (they leave its neighbour list)
and whether one that was tested has it within its inner radius (then it is not
tested).  That graph is the same at all times, so every station has a level: 0
without lower neighbours, else one more than the highest level among them.  Round r
settles all stations of level r at all times; the number of rounds is the longest
chain of descending neighbours, not the number of stations.

A row holds a station's cells of a block of ``BLOCK`` consecutive axis times, yes/no
states as bits of a long:

* the values of each block go once to every station that has them in its list, and lie
  there as arrays beside what is the same at all times (distance, id, altitude
  difference).  A list holds the neighbours by (distance, id) up to the ``num_max``-th
  higher id: higher ids are never flagged before the station's turn, so nothing behind
  is used.  The rows are dealt by level once and stored; they cross no further shuffle;
* a settled block sends rows only to the higher neighbours that it changes (``gone``:
  times at which it is flagged and leaves their lists, ``block``: times at which it was
  tested and has them within the inner radius), stored by the level of the receiver.  A
  round reads its own rows and those sent to its level, nothing else.

What is sent to a level is broadcast to the stored rows.  A level to which more than
``SENT_ROWS`` rows may be sent is settled in parts of its stations, each with a broadcast of
about that many.  No task holds a component: blocks and stations of a round are spread
freely, and a lost executor recomputes tasks of one round.  At the end the cells meet the
flags of their station, as one array of longs, and cross no shuffle for it.  The round tables
lie in a folder of the run below the checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window, functions as F

from stationqc.operators.grid import time_axis
from stationqc.operators.temporal import temporal_step
from stationqc.params import SctParams
from stationqc.session import cut_lineage, ensure_checkpoint_dir, store

#: Steps of the level computation between two looks at whether it has settled.
STEPS = 4
#: Times of a block (bits of a long), rows sent to one part of a level on average at most,
#: rows (a station's block with its list) of one part of the stored lists.
BLOCK, SENT_ROWS, LIST_ROWS = 64, 200_000, 20_000


def dependency_levels(stations: DataFrame, links: DataFrame) -> DataFrame:
    """``(sid, level)``: the round in which each of ``stations`` is settled.

    ``links`` are pairs (i, j, ...) of them within max(inner, outer).  Levels only grow
    from step to step, so an unchanged sum means that they have settled.
    """
    lower = cut_lineage(links.where(F.col("j") < F.col("i")).select("i", "j"))
    ground = stations.select("sid", F.lit(0).alias("level"))
    levels, before = cut_lineage(ground), None
    while True:
        total = levels.agg(F.sum("level")).first()[0]
        if total is None or total == before:
            return levels
        before = total
        for _ in range(STEPS):
            above = lower.join(levels.withColumnRenamed("sid", "j"), "j").select(F.col("i").alias("sid"), F.col("level") + 1)
            levels = ground.union(above).groupBy("sid").agg(F.max("level").alias("level"))
        levels = cut_lineage(levels)


def testable(stations: DataFrame, links: DataFrame, prm: SctParams, to_check: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Stations that can be tested at all, ``(sid, n_outer, level)``, and the links among
    them; the other stations only serve as neighbours."""
    checked = F.coalesce(F.col(to_check), F.lit(False)) if to_check else F.lit(True)
    n_outer = (links.where((F.col("i") != F.col("j")) & (F.col("dist") <= float(prm.outer_radius)))
               .groupBy(F.col("i").alias("sid")).agg(F.count(F.lit(1)).alias("n_outer")))
    able = cut_lineage(stations.select("sid", checked.alias("c")).where("c").join(n_outer, "sid")
                       .where(F.col("n_outer") >= int(prm.num_min)).select("sid", "n_outer"))
    among = links.join(able.select(F.col("sid").alias("i")), "i").join(able.select(F.col("sid").alias("j")), "j", "left_semi")
    return cut_lineage(able.join(dependency_levels(able, among), "sid").select("sid", "n_outer", "level")), among


def usable_pairs(links: DataFrame, prm: SctParams, stct: bool) -> DataFrame:
    """Outer pairs (i, j, dist, da) that a test of i may use, nearest first up to the
    ``num_max``-th higher id; for the spatio-temporal test only those in the altitude band."""
    near = links.where((F.col("i") != F.col("j")) & (F.col("dist") <= float(prm.outer_radius)))
    if stct:
        near = near.where(F.abs(F.col("da")).between(float(prm.min_elev_diff), float(prm.max_elev_diff)))
    before = Window.partitionBy("i").orderBy("dist", "j").rowsBetween(Window.unboundedPreceding, -1)
    higher = F.coalesce(F.sum((F.col("j") > F.col("i")).cast("int")).over(before), F.lit(0))
    return near.withColumn("higher", higher).where(F.col("higher") < int(prm.num_max)).select("i", "j", "dist", "da")


def _bit(mask, at):
    """Whether bit ``at`` of a long is set."""
    return F.getbit(mask, at) == 1


def _mask(at):
    """The long that has bit ``at`` alone."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def station_blocks(grid: DataFrame, axis: DataFrame, v: str = "v", tf=None) -> DataFrame:
    """``(sid, block, here, tf, v)``: a station's values by place in the block; ``here`` marks the times that
    it has a row at, ``tf`` those with the temporal flag."""
    tf = F.lit(False) if tf is None else tf
    cells = grid.select("t", "sid", F.col(v).cast("double").alias("v"), tf.alias("tf")).where(F.col("sid").isNotNull())
    cells = cells.join(F.broadcast(axis), "t")      # one row per axis time
    rows = cells.groupBy("sid", "block").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("cells"), F.bit_or(_mask(F.col("at"))).alias("here"),
                                             F.bit_or(F.when(F.col("tf"), _mask(F.col("at"))).otherwise(F.lit(0).cast("long"))).alias("tf"))
    n = F.size("cells")
    gapless = (F.bit_count("here") == n) & (F.element_at("cells", -1)["at"] == n - 1)
    placed = F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda k: F.get(F.filter("cells", lambda c: c["at"] == k), F.lit(0))["v"])
    return rows.select("sid", "block", "here", "tf", F.when(gapless, F.col("cells")["v"]).otherwise(placed).alias("v"))


def _background(sel, prm: SctParams, stct: bool):
    """Mean and background of the chosen neighbours ``sel`` of a cell."""
    plain = _mean(sel, lambda e: e["v"])
    if not stct:
        return plain, plain

    def w(e):
        return F.lit(1.0) / (e["dist"] + F.lit(float(prm.eps)))
    return plain, (_mean(sel, lambda e: e["v"] * w(e)) / F.nullif(_mean(sel, w), F.lit(0.0))
                   + _mean(sel, lambda e: e["da"]) * F.lit(float(prm.vertical_scale)))


def _mean(sel, item):
    """Mean over the chosen neighbours; a missing value makes it missing."""
    return F.aggregate(sel, F.lit(0.0), lambda s, e: s + item(e)) / F.nullif(F.size(sel), F.lit(0)).cast("double")


def settling(prm: SctParams, stct: bool):
    """Columns of a round, made once for all rounds: the places of a block that are tested, the long
    of them and the long of those that are flagged."""
    none = F.lit(0).cast("long")
    open_ = F.col("here").bitwiseAND(F.bitwise_not(F.coalesce("blocked", none)))

    def left(k):
        """Outer neighbours that are not yet flagged at place ``k``."""
        return F.col("n_outer") - F.aggregate("gone", none, lambda n, g: n + F.getbit(g["gone"], k))

    def chosen(k):
        rest = F.filter("near", lambda e: _bit(e["here"], k) & ~F.exists("gone", lambda g: (g["j"] == e["j"]) & _bit(g["gone"], k)))
        return F.transform(F.slice(rest, 1, int(prm.num_max)), lambda e: F.struct(e["dist"].alias("dist"), e["da"].alias("da"), F.get(e["v"], k).alias("v")))

    def judged(c):
        plain, background = _background(c["sel"], prm, stct)
        return F.struct(c["at"].alias("at"), c["sel"].alias("sel"), c["v"].alias("v"), plain.alias("m"), (c["v"] - background).alias("dev"))

    def bad(c):
        err = F.sqrt(_mean(c["sel"], lambda e: (e["v"] - c["m"]) * (e["v"] - c["m"])))
        over = (c["dev"] > F.lit(float(prm.pos_threshold)) * err) | (c["dev"] < -F.lit(float(prm.neg_threshold)) * err)
        return F.coalesce(over, F.lit(False)) | _bit(F.col("tf"), c["at"])
    at = F.filter(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda k: _bit(open_, k) & (left(k) >= int(prm.num_min)))
    cells = F.transform("at", lambda k: F.struct(k.alias("at"), F.get("v", k).alias("v"), chosen(k).alias("sel")))
    flagged = F.filter(F.transform(cells, judged), bad)
    return (at.alias("at"), F.aggregate("at", none, lambda m, k: m.bitwiseOR(_mask(k))).alias("tested"),
            F.aggregate(flagged, none, lambda m, c: m.bitwiseOR(_mask(c["at"]))).alias("flagged"))


def settle_round(lists: DataFrame, sent: DataFrame, columns) -> DataFrame:
    """``(sid, block, tested, flagged, heirs)`` of one part of a level, from its lists, what lower stations
    sent and the ``columns`` of ``settling``."""
    at, tested, flagged = columns
    told = sent.groupBy("block", F.col("i").alias("sid")).agg(
        F.bit_or("blocked").alias("blocked"), F.collect_list(F.when(F.col("gone") != 0, F.struct("j", "gone"))).alias("gone"))
    x = lists.join(F.broadcast(told), ["block", "sid"], "left")      # SENT_ROWS
    gone = F.coalesce("gone", F.array().cast(dict(told.dtypes)["gone"])).alias("gone")
    x = x.select("sid", "block", "n_outer", "heirs", "here", "tf", "v", "near", "blocked", gone)
    return x.select("*", at).select("sid", "block", tested, flagged, "heirs").where(F.col("tested") != 0)


def neighbour_lists(blocks: DataFrame, stations: DataFrame, pairs: DataFrame, heirs: DataFrame, tables: int) -> DataFrame:
    """One row per tested station and block: its own values, those of its neighbours, and whom it can change; dealt into
    ``tables`` parts by level, so that few tasks write to a level."""
    own = stations.join(heirs, "sid").select(F.col("sid").alias("j"), "level", "part", "salts", F.struct("n_outer", "heirs").alias("own"))
    mine = own.select("j", F.col("j").alias("i"), "level", "part", "salts", F.lit(None).cast("double").alias("dist"), F.lit(None).cast("double").alias("da"), "own")
    near = pairs.join(own.select(F.col("j").alias("i"), "level", "part", "salts", F.lit(None).cast(dict(own.dtypes)["own"]).alias("own")), "i")
    to = mine.unionByName(near.select(*mine.columns))
    x = (blocks.repartition(tables, "sid").join(to.withColumnRenamed("j", "sid"), "sid")
         .withColumn("salt", F.pmod(F.xxhash64("i", "block"), F.col("salts"))).drop("salts")
         .repartition(tables, "level", "part", "salt"))
    is_own = F.col("own").isNotNull()
    x = x.groupBy("level", "part", "salt", "i", "block").agg(
        F.sort_array(F.collect_list(F.when(~is_own, F.struct("dist", F.col("sid").alias("j"), "da", "here", "v")))).alias("near"),
        F.max_by(F.struct("own", "here", "tf", "v"), is_own).alias("x"), F.bool_or(is_own).alias("any"))
    return x.where("any").select(F.col("i").alias("sid"), "block", F.col("x.own.n_outer").alias("n_outer"), F.col("x.own.heirs").alias("heirs"),
                                 F.col("x.here").alias("here"), F.col("x.tf").alias("tf"), F.col("x.v").alias("v"), "near", "level", "part")


def _read(path: str, schema: str, nothing: DataFrame) -> DataFrame:
    """The rows sent to a level, ``nothing`` where no row was."""
    try:
        return nothing.sparkSession.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return nothing


def with_flags(g: DataFrame, axis: DataFrame, found: DataFrame) -> DataFrame:
    """``g`` with ``sct_flag`` from ``found``, the longs ``gone`` of the flagged times by station ``i`` and block.

    A station's longs lie in one array by block (0 where nothing is flagged) and meet the cells by station
    alone: cells that lie by station, as those of a dense grid do, cross no shuffle, and no row is made per flag.
    """
    none = F.lit(0).cast("long")
    found = found.groupBy(F.col("i").alias("sid")).agg(F.sort_array(F.collect_set(F.struct("block", "gone"))).alias("found"))

    def placed(e, k):
        """The long of a block behind the zeros of the blocks since the one before."""
        before = F.coalesce(F.get("found", k - 1)["block"], F.lit(-1))
        return F.concat(F.array_repeat(none, e["block"] - before - 1), F.array(e["gone"]))
    found = found.select("sid", F.flatten(F.transform("found", placed)).alias("_gone"))
    at = axis.select("t", F.struct("block", "at").alias("_at"))      # one row per axis time
    flag = F.coalesce(_bit(F.get("_gone", F.col("_at.block")), F.col("_at.at")), F.lit(False)).alias("sct_flag")
    return (g.join(F.broadcast(at), "t", "left").join(found, "sid", "left")
            .select("t", "sid", *[c for c in g.columns if c not in ("t", "sid")], flag))


def sct_rounds(grid: DataFrame, stations: DataFrame, links: DataFrame, prm: SctParams, stct: bool = False, v: str = "v",
               to_check: str | None = None) -> DataFrame:
    """Adds ``sct_flag`` (and ``temporal_flag`` for D8) to a dense grid (every station at every time).

    ``links``: pairs (i, j, dist, da) within max(inner, outer), a station itself
    included.  An eager loop over the levels.
    """
    spark = grid.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/rounds-{uuid.uuid4().hex}"
    g = grid
    if stct:
        g = temporal_step(g, prm.temporal_threshold, v=v, out="temporal_flag").drop("v_prev", "v_next")
    tested, among = testable(stations, links, prm, to_check)
    if tested.isEmpty():
        return g.withColumn("sct_flag", F.lit(False))
    axis = time_axis(store(grid.select("t").distinct()))
    axis = store(axis.select("t", F.floor(F.col("idx") / BLOCK).cast("int").alias("block"), (F.col("idx") % BLOCK).cast("int").alias("at")))
    n_blocks = axis.agg(F.countDistinct("block")).first()[0]
    blocks = store(station_blocks(g, axis, v, F.coalesce(F.col("temporal_flag"), F.lit(False)) if stct else None))
    tables = max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks.count() // LIST_ROWS + 1)

    # whom a settled station can change: higher ids that are tested themselves
    lower = among.where(F.col("j") < F.col("i")).select("i", "j", "dist")
    into = lower.groupBy(F.col("i").alias("sid")).agg(F.count(F.lit(1)).alias("n"))
    sizes = (tested.join(into, "sid", "left").groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("sent"))
             .select("level", F.ceil((F.col("sent") * n_blocks + 1) / SENT_ROWS).cast("int").alias("parts"),
                     F.ceil(F.col("n") * n_blocks / (LIST_ROWS / 8)).cast("int").alias("salts")))
    sizes = cut_lineage(sizes)
    tested = cut_lineage(tested.join(sizes, "level").withColumn("part", F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")))
    to = tested.select(F.col("sid").alias("i"), F.col("level").alias("to_level"), F.col("part").alias("to_part"))
    # the row that a station sends to itself, to level -1, holds its flags
    own = tested.select("sid", F.col("sid").alias("i"), F.lit(-1).alias("to_level"), F.lit(0).alias("to_part"), F.lit(False).alias("inner"), F.lit(True).alias("outer"))
    heirs = (lower.join(to, "i").select(F.col("j").alias("sid"), "i", "to_level", "to_part", (F.col("dist") <= float(prm.inner_radius)).alias("inner"),
                                        (F.col("dist") <= float(prm.outer_radius)).alias("outer"))
             .unionByName(own).groupBy("sid").agg(F.collect_list(F.struct("i", "to_level", "to_part", "inner", "outer")).alias("heirs")))
    pairs = usable_pairs(links.join(tested.select(F.col("sid").alias("i")), "i"), prm, stct)
    lists = neighbour_lists(blocks, tested, pairs, heirs, tables)
    lists.write.partitionBy("level", "part").parquet(f"{folder}/lists")
    lists = spark.read.schema(lists.schema).parquet(f"{folder}/lists")

    kind, none = dict(grid.dtypes)["sid"], F.lit(0).cast("long")
    sent_schema = f"block int, i {kind}, j {kind}, gone bigint, blocked bigint"
    columns, gone = settling(prm, stct), F.when(F.col("to.outer"), F.col("flagged")).otherwise(none).alias("gone")
    blocked = F.when(F.col("to.inner"), F.col("tested")).otherwise(none).alias("blocked")
    changes = (F.col("gone") != 0) | (F.col("blocked") != 0)
    nothing = spark.createDataFrame([], sent_schema)
    for level, part in sorted((r["level"], k) for r in sizes.collect() for k in range(r["parts"])):
        mine = lists.where((F.col("level") == level) & (F.col("part") == part))
        sent = _read(f"{folder}/sent/to_level={level}/to_part={part}", sent_schema, nothing)
        told = (settle_round(mine, sent, columns).select("sid", "block", "tested", "flagged", F.explode("heirs").alias("to"))
                .select("block", F.col("to.i").alias("i"), F.col("sid").alias("j"), gone, blocked, F.col("to.to_level").alias("to_level"),
                        F.col("to.to_part").alias("to_part")).where(changes))
        told.hint("rebalance", "to_level", "to_part").write.mode("append").partitionBy("to_level", "to_part").parquet(f"{folder}/sent")
    found = _read(f"{folder}/sent/to_level=-1/to_part=0", sent_schema, nothing)
    return with_flags(g, axis, found)
