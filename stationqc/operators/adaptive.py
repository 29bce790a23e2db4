"""C2, C3 and C6 with adaptive cells: dense places are split, thin ones are not.

The bucketed distance join keys on square cells of side ``r``; a dense city is then one
hot cell.  Here a cell with more than ``bound`` stations is split as a quad-tree: a
station's place within its cell is a Morton code, whose prefixes are the nodes, and the
leaves are the first nodes on the way down that hold at most ``bound`` stations.  All
levels are counted by one aggregate.  A station probes the cells around it and, in each,
the leaves whose bounding box it can reach, so probes cross levels freely.

No task holds a cell: both joins of a dense cell are salted by its count, and a join
key (cell, leaf, salt) has at most ``bound`` members and about as many probes for each
of the cells around.  Only stations at exactly one place cannot be split further.

``nearest_k_any`` needs no radius: a station starts with the size of its leaf and
doubles its ring until k others lie within, so thin places look far and dense ones not.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from stationqc.session import cut_lineage

#: Halvings of a cell at most, and stations of a leaf.
DEPTH, BOUND = 12, 1024
_NODE = ["cx", "cy", "level", "prefix"]


def _morton(u: Column, w: Column) -> Column:
    """Interleaved bits of two integers below 2 ** DEPTH."""
    code = F.lit(0).cast("long")
    for b in range(DEPTH):
        code = (code + F.shiftleft(F.shiftright(u, b).bitwiseAND(F.lit(1).cast("long")), 2 * b)
                + F.shiftleft(F.shiftright(w, b).bitwiseAND(F.lit(1).cast("long")), 2 * b + 1))
    return code


def _placed(stations: DataFrame, xcol: str, ycol: str, r: float, x0: float = 0.0, y0: float = 0.0,
            keep: tuple = ("sid", "alt")) -> DataFrame:
    """``(px, py, cx, cy, code)`` and the columns ``keep``: the cell of each station and its Morton code within."""
    px, py = F.col(xcol) - F.lit(x0), F.col(ycol) - F.lit(y0)
    cx, cy = F.floor(px / F.lit(r)).cast("long"), F.floor(py / F.lit(r)).cast("long")
    top = F.lit(2 ** DEPTH - 1).cast("long")

    def within(p: Column, c: Column) -> Column:
        return F.greatest(F.lit(0).cast("long"), F.least(top, F.floor((p / F.lit(r) - c) * F.lit(float(2 ** DEPTH))).cast("long")))
    return stations.select(*keep, F.col(xcol).alias("px"), F.col(ycol).alias("py"), cx.alias("cx"), cy.alias("cy"),
                           _morton(within(px, cx), within(py, cy)).alias("code"))


def quad_leaves(placed: DataFrame, bound: int = BOUND) -> tuple[DataFrame, DataFrame]:
    """(members with ``level`` and ``prefix`` of their leaf, leaves with their bounding box and cell count ``held``)."""
    held = placed.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("held"))
    rows = placed.join(held, ["cx", "cy"])
    deep = F.when(F.col("held") > bound, F.sequence(F.lit(1), F.lit(DEPTH))).otherwise(F.array(F.lit(0)))
    rows = rows.select("*", F.explode(deep).alias("level"))
    prefix = F.expr(f"shiftright(code, 2 * ({DEPTH} - level))")
    rows = rows.withColumn("prefix", F.when(F.col("level") == 0, F.lit(0).cast("long")).otherwise(prefix))
    nodes = rows.groupBy(*_NODE).agg(
        F.count(F.lit(1)).alias("n"), F.max("held").alias("held"), F.min("px").alias("x0"), F.max("px").alias("x1"),
        F.min("py").alias("y0"), F.max("py").alias("y1"))
    nodes = cut_lineage(nodes)
    # a leaf: small enough (or at the last level) under a parent that is not; the cell itself is above level 1
    full = nodes.where((F.col("n") > bound) & (F.col("level") > 0)).select("cx", "cy", (F.col("level") + 1).alias("level"), F.col("prefix").alias("up"))
    inner = (nodes.where((F.col("level") > 1) & ((F.col("n") <= bound) | (F.col("level") == DEPTH)))
             .withColumn("up", F.shiftright("prefix", 2)).join(full, ["cx", "cy", "level", "up"], "left_semi").drop("up"))
    leaves = cut_lineage(nodes.where((F.col("level") == 0) | ((F.col("level") == 1) & (F.col("n") <= bound))).unionByName(inner))
    members = rows.join(leaves.select(*_NODE), _NODE).select("sid", "px", "py", "alt", *_NODE)
    return members, leaves


def adaptive_pairs(stations: DataFrame, xcol: str, ycol: str, r: float, bound: int = BOUND, keep_self: bool = False,
                   probes: DataFrame | None = None) -> DataFrame:
    """Ordered pairs ``(i, j, dist, alt_i, alt_j, da)`` within ``r``; ``probes`` (sid) are the i asked for (default: all)."""
    r = float(r)
    if r <= 0:
        raise ValueError("radius must be positive")
    placed = _placed(stations, xcol, ycol, r)
    members, leaves = quad_leaves(placed, bound)
    salts = F.greatest(F.lit(1), F.ceil(F.col("held") / F.lit(bound))).cast("int")
    asking = placed if probes is None else placed.join(probes.select("sid"), "sid", "left_semi")
    around = F.array(*[F.lit(o) for o in (-1, 0, 1)])
    asking = (asking.withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around))
              .select(F.col("sid").alias("i"), F.col("px").alias("xi"), F.col("py").alias("yi"), F.col("alt").alias("alt_i"),
                      (F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy")))
    # a dense cell's probes are dealt over salts, each of which sees the leaf table of the cell
    cells = leaves.groupBy("cx", "cy").agg(F.max(salts).alias("salts"))
    asking = asking.join(cells, ["cx", "cy"]).withColumn("salt", F.pmod(F.xxhash64("i"), F.col("salts")).cast("int")).drop("salts")
    boxes = leaves.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    gap = [F.greatest(F.lit(0.0), F.col(f"{a}0") - F.col(f"{a}i"), F.col(f"{a}i") - F.col(f"{a}1")) for a in "xy"]
    # a hair above r: the box only decides what is looked at
    reach = F.sqrt(gap[0] ** 2 + gap[1] ** 2) <= F.lit(r * (1 + 1e-9))
    visits = asking.join(boxes, ["cx", "cy", "salt"]).where(reach).select("i", "xi", "yi", "alt_i", *_NODE, "salt")
    held = leaves.select(*_NODE, salts.alias("salts"))
    spread = (members.join(held, _NODE).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
              .select(F.col("sid").alias("j"), F.col("px").alias("xj"), F.col("py").alias("yj"), F.col("alt").alias("alt_j"), *_NODE, "salt"))
    d = F.sqrt((F.col("xj") - F.col("xi")) ** 2 + (F.col("yj") - F.col("yi")) ** 2)
    out = visits.join(spread, [*_NODE, "salt"]).select("i", "j", d.alias("dist"), "alt_i", "alt_j").where(F.col("dist") <= F.lit(r))
    if not keep_self:
        out = out.where(F.col("i") != F.col("j"))
    return out.withColumn("da", F.col("alt_j") - F.col("alt_i"))


def _places(per: DataFrame) -> DataFrame:
    """``(x, y, n, lo, lo2, hi, hi2)`` of ``(sid, x, y, m)``: rows, two smallest and two largest ids of a place."""
    ends = per.groupBy("x", "y").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi"))
    return (per.join(ends, ["x", "y"]).groupBy("x", "y", "lo", "hi")
            .agg(F.sum("m").alias("n"), F.min(F.when(F.col("sid") > F.col("lo"), F.col("sid"))).alias("lo2"),
                 F.max(F.when(F.col("sid") < F.col("hi"), F.col("sid"))).alias("hi2")))


def _descend(places: DataFrame, r: float, bound: int) -> DataFrame:
    """``(x, y, n, lo, hi, far)`` of the other places within ``r`` of each place.

    The quad-tree is walked level by level by all places at once.  A node wholly within
    reach gives its count and its smallest and largest id; it is opened only while it
    may hold the farthest station, that is while its far corner is beyond the distance
    that some node is known to reach.  Nodes on the edge and those on the way to the place
    itself are opened down to the leaves, whose members are compared one by one.
    """
    placed = cut_lineage(_placed(places, "x", "y", r, keep=("n", "lo", "hi")))
    held = placed.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("held"))
    deep = F.when(F.col("held") > bound, F.sequence(F.lit(0), F.lit(DEPTH))).otherwise(F.array(F.lit(0)))
    rows = placed.join(held, ["cx", "cy"]).select("*", F.explode(deep).alias("level"))
    rows = cut_lineage(rows.withColumn("prefix", F.expr(f"shiftright(code, 2 * ({DEPTH} - level))"))
                       .select(*_NODE, "px", "py", "n", "lo", "hi"))
    nodes = cut_lineage(rows.groupBy(*_NODE).agg(
        F.count(F.lit(1)).alias("held"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min("px").alias("x0"), F.max("px").alias("x1"), F.min("py").alias("y0"), F.max("py").alias("y1")))
    around = F.array(*[F.lit(o) for o in (-1, 0, 1)])
    open_ = (placed.select("px", "py", F.col("cx").alias("qx"), F.col("cy").alias("qy"), "code")
             .withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around))
             .select("px", "py", "qx", "qy", "code", (F.col("qx") + F.col("dx")).alias("cx"), (F.col("qy") + F.col("dy")).alias("cy"),
                     F.lit(0).cast("long").alias("up"), F.lit(False).alias("counted"), F.lit(0.0).alias("low")))
    apart = {a: F.greatest(F.lit(0.0), F.col(f"{a}0") - F.col(f"p{a}"), F.col(f"p{a}") - F.col(f"{a}1")) for a in "xy"}
    to = {f"{a}{e}": F.abs(F.col(f"{a}{e}") - F.col(f"p{a}")) for a in "xy" for e in "01"}
    near = F.sqrt(apart["x"] ** 2 + apart["y"] ** 2)
    far = F.sqrt(F.greatest(to["x0"], to["x1"]) ** 2 + F.greatest(to["y0"], to["y1"]) ** 2)
    # every side of the bounding box holds a station
    sure = F.greatest(F.sqrt(F.greatest(to["x0"], to["x1"]) ** 2 + apart["y"] ** 2),
                      F.sqrt(F.greatest(to["y0"], to["y1"]) ** 2 + apart["x"] ** 2))
    hair, own_place = 1e-9, Window.partitionBy("px", "py")
    taken, visits = [], []
    for level in range(DEPTH + 1):
        here = nodes.where(F.col("level") == level).withColumn("up", F.shiftright("prefix", 2))
        f = open_.join(here, ["cx", "cy", "up"])
        own = ((F.col("cx") == F.col("qx")) & (F.col("cy") == F.col("qy"))
               & (F.shiftright("code", 2 * (DEPTH - level)) == F.col("prefix")))
        f = f.withColumn("near", near).withColumn("far", far).where(F.col("counted") | (F.col("near") <= F.lit(r * (1 + hair))))
        f = f.withColumn("inside", ~own & (F.col("counted") | (F.col("far") <= F.lit(r * (1 - hair)))))
        f = f.withColumn("low", F.greatest("low", F.max(F.when(F.col("inside"), sure)).over(own_place)))
        f = cut_lineage(f.select("px", "py", "qx", "qy", "code", *_NODE, "n", "lo", "hi", "held", "inside", "counted", "far", "low"))
        taken.append(f.where(F.col("inside") & ~F.col("counted")).select("px", "py", "n", "lo", "hi"))
        f = f.where(~F.col("inside") | (F.col("far") * F.lit(1 + hair) >= F.col("low")))
        leaf = (F.col("held") <= bound) | F.lit(level == DEPTH)
        visits.append(f.where(leaf).select("px", "py", *_NODE, F.col("inside").alias("counted")))
        open_ = f.where(~leaf).select("px", "py", "qx", "qy", "code", "cx", "cy", F.col("prefix").alias("up"),
                                      F.col("inside").alias("counted"), "low")
        if open_.isEmpty():
            break
    whole, single = taken[0], visits[0]
    for a, b in zip(taken[1:], visits[1:]):
        whole, single = whole.unionByName(a), single.unionByName(b)
    members = rows.select(*_NODE, F.col("px").alias("xj"), F.col("py").alias("yj"), "n", "lo", "hi")
    d = F.sqrt((F.col("xj") - F.col("px")) ** 2 + (F.col("yj") - F.col("py")) ** 2)
    single = (single.join(members, _NODE).withColumn("far", d).where(F.col("far") <= F.lit(r))
              .where((F.col("xj") != F.col("px")) | (F.col("yj") != F.col("py"))))
    new = ~F.col("counted")
    single = single.select("px", "py", *[F.when(new, F.col(c)).alias(c) for c in ("n", "lo", "hi")], "far")
    return (whole.withColumn("far", F.lit(None).cast("double")).unionByName(single).groupBy(F.col("px").alias("x"), F.col("py").alias("y"))
            .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("far").alias("far")))


def adaptive_reach(stations: DataFrame, xcol: str, ycol: str, r: float, bound: int = BOUND) -> DataFrame:
    """``(i, n, first_j, last_j, farthest)``: the pairs of ``adaptive_pairs`` counted per station, with the
    smallest and largest neighbour and the largest distance, without a row per pair.

    Stations at one place ask once, and places within reach are taken by whole quad-tree
    nodes, so a place costs about as many rows as there are nodes on the edge of its circle.
    Rows of one id at several places, if there are any, are asked for by pairs.
    """
    r = float(r)
    if r <= 0:
        raise ValueError("radius must be positive")
    known = F.col("sid").isNotNull() & F.col(xcol).isNotNull() & F.col(ycol).isNotNull()
    st = stations.where(known)
    per = cut_lineage(st.groupBy("sid", F.col(xcol).alias("x"), F.col(ycol).alias("y")).agg(F.count(F.lit(1)).alias("m")))
    strewn = cut_lineage(per.groupBy("sid").agg(F.count(F.lit(1)).alias("at")).where(F.col("at") > 1).select("sid"))
    places = cut_lineage(_places(per))
    around = _descend(places, r, bound).select("x", "y", F.col("n").alias("n_out"), F.col("lo").alias("lo_out"), F.col("hi").alias("hi_out"), "far")
    j = per.join(strewn, "sid", "left_anti").join(places, ["x", "y"]).join(around, ["x", "y"], "left")
    others = F.col("n") - F.col("m") + F.coalesce("n_out", F.lit(0))
    low, high = (F.when(F.col(c) != F.col("sid"), F.col(c)).otherwise(F.col(f"{c}2")) for c in ("lo", "hi"))
    out = j.where(others > 0).select(
        F.col("sid").alias("i"), (F.col("m") * others).cast("long").alias("n"), F.least("lo_out", low).alias("first_j"),
        F.greatest("hi_out", high).alias("last_j"), F.coalesce("far", F.lit(0.0)).alias("farthest"))
    if strewn.isEmpty():
        return out
    pairs = adaptive_pairs(st, xcol, ycol, r, bound, probes=strewn)
    return out.unionByName(pairs.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.min("j").alias("first_j"), F.max("j").alias("last_j"),
                                                  F.max("dist").alias("farthest")))


def nearest_k_any(stations: DataFrame, xcol: str, ycol: str, k: int, bound: int = BOUND) -> DataFrame:
    """C6 without a radius: ``(i, rank, j, dist)``, the k nearest others (all, if fewer), ties to the smaller id.

    A station's first ring is as wide as the quad-tree leaf (of about 4 k stations) that
    holds it.  In each round the stations whose ring is due are answered if k others
    lie within it; the rest wait for twice the ring.  An eager loop of at most
    ``DEPTH`` rounds and a few, each of them over fewer stations.  Stations at one place
    ask together, so a place of any number of stations costs as much as a few.
    """
    st = cut_lineage(stations.select("sid", F.col(xcol).alias("x"), F.col(ycol).alias("y"), "alt"))
    box = st.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    empty = st.sparkSession.createDataFrame([], f"i {dict(st.dtypes)['sid']}, rank int, j {dict(st.dtypes)['sid']}, dist double")
    if box["x0"] is None:
        return empty
    wide = math.hypot(box["x1"] - box["x0"], box["y1"] - box["y0"]) * (1 + 1e-9) or 1.0
    # stations at one place share their list: all of them see the others at the same distances, so a place
    # asks once, for k + 1 stations (one may be the asker), and shows its k + 1 smallest ids
    places = cut_lineage(st.where(F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy("x", "y").agg(F.min("sid").alias("place")))
    # a station given several times is asked and shown once, its entries are repeated at the end
    at = st.join(places, ["x", "y"]).groupBy("sid", "x", "y", "place").agg(F.first("alt").alias("alt"))
    times = cut_lineage(st.groupBy("sid").agg(F.least(F.lit(k), F.count(F.lit(1))).cast("int").alias("times")))
    shown = cut_lineage(at.withColumn("nth", F.row_number().over(Window.partitionBy("place").orderBy("sid")))
                        .where(F.col("nth") <= k + 1).select("sid", "x", "y", "alt", "place"))
    asking = shown.where(F.col("sid") == F.col("place")).select("sid")
    members, _ = quad_leaves(_placed(shown, "x", "y", wide, box["x0"], box["y0"]), 4 * k)
    waiting = cut_lineage(members.join(asking, "sid", "left_semi").select("sid", "level"))
    lists = []
    for level in range(DEPTH, -1, -1):
        due = waiting.where(F.col("level") >= level)
        if due.isEmpty():
            continue
        ring = wide / 2 ** level
        w = Window.partitionBy("i").orderBy("dist", "j")
        near = adaptive_pairs(shown, "x", "y", ring, bound, keep_self=True, probes=due)
        near = cut_lineage(near.select("i", "j", "dist", F.row_number().over(w).alias("rank")).where(F.col("rank") <= k + 1))
        done = near.where(F.col("rank") == k + 1).select("i") if level else due.select(F.col("sid").alias("i"))
        lists.append(near.join(done, "i", "left_semi").select(F.col("i").alias("place"), "rank", "j", "dist"))
        waiting = cut_lineage(waiting.join(done.withColumnRenamed("i", "sid"), "sid", "left_anti"))
        if waiting.isEmpty():
            break
    if not lists:
        return empty
    found = lists[0]
    for part in lists[1:]:
        found = found.unionByName(part)
    # one row per place holds its list; a station takes the first k that are not itself
    kept = (found.join(times.withColumnRenamed("sid", "j"), "j").groupBy("place")
            .agg(F.sort_array(F.collect_list(F.struct("rank", "j", "dist", "times"))).alias("near")))
    mine = at.select(F.col("sid").alias("i"), "place").join(kept, "place").join(times.withColumnRenamed("sid", "i"), "i")
    others = F.filter("near", lambda e: e["j"] != F.col("i"))
    again = F.flatten(F.transform(others, lambda e: F.array_repeat(e, e["times"] * F.col("times"))))
    mine = mine.select("i", F.slice(again, 1, k).alias("near"))
    return mine.select("i", F.posexplode("near").alias("at", "e")).select(
        "i", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.j").alias("j"), F.col("e.dist").alias("dist"))
