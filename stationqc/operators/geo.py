"""Geometry: projection, neighbour pairs, nearest-k, distance weighting.

Neighbour pairs are found with a grid-bucket equi-join: each station is put in
the square cell of side ``r`` that holds it, and each station probes the 3 x 3
block of cells around it.  The join key is the cell, so no nested-loop join is
planned; a final exact distance filter makes the result exact (a pair within
``r`` is always in adjacent cells).  Pair lists are time-invariant and computed
once, then reused for every time step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stationqc.functions.columns import with_utm
from stationqc.operators.grid import time_axis
from stationqc.session import spread, store

#: Axis positions whose cells travel as one row (a position within is a byte).
BLOCK = 128


def project(stations: DataFrame, zone: int = 33) -> DataFrame:
    """Add planar ``x, y`` (metres) to ``(sid, lat, lon, ...)``."""
    return with_utm(stations, "lat", "lon", zone)


def _pairs(st: DataFrame, xcol: str, ycol: str, r: float, keep_self: bool = False) -> DataFrame:
    r = float(r)
    if r <= 0:
        raise ValueError("radius must be positive")
    base = st.select("sid", F.col(xcol).alias("px"), F.col(ycol).alias("py"), "alt",
                     F.floor(F.col(xcol) / F.lit(r)).cast("long").alias("cx"),
                     F.floor(F.col(ycol) / F.lit(r)).cast("long").alias("cy"))
    offs = F.array(*[F.lit(o) for o in (-1, 0, 1)])
    probe = (base.withColumn("dx", F.explode(offs)).withColumn("dy", F.explode(offs))
             .select(F.col("sid").alias("i"), F.col("px").alias("xi"), F.col("py").alias("yi"),
                     F.col("alt").alias("alt_i"),
                     (F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy")))
    other = base.select(F.col("sid").alias("j"), F.col("px").alias("xj"), F.col("py").alias("yj"),
                        F.col("alt").alias("alt_j"), "cx", "cy")
    d = F.sqrt((F.col("xj") - F.col("xi")) ** 2 + (F.col("yj") - F.col("yi")) ** 2)
    out = (probe.join(other, ["cx", "cy"])
           .select("i", "j", d.alias("dist"), "alt_i", "alt_j")
           .where(F.col("dist") <= F.lit(r)))
    if not keep_self:
        out = out.where(F.col("i") != F.col("j"))
    return out.withColumn("da", F.col("alt_j") - F.col("alt_i"))


def radius_pairs_metric(stations: DataFrame, r: float, zone: int = 33) -> DataFrame:
    """Ordered pairs i != j with projected distance <= r (metres).

    The projected stations are stored first: the join's null filters would otherwise be
    pushed below the projection, which writes its whole series out once per use.
    """
    return _pairs(store(project(stations, zone).select("sid", "x", "y", "alt")), "x", "y", r)


def radius_pairs_degree(stations: DataFrame, r: float) -> DataFrame:
    """Ordered pairs i != j with distance <= r on raw (lon, lat) degrees."""
    return _pairs(stations, "lon", "lat", r)


def elev_max(pairs: DataFrame, d: float) -> DataFrame:
    """C4: if d > 0 keep pairs with |altitude difference| <= d; NULL altitude drops the pair."""
    if d > 0:
        return pairs.where(F.abs(F.col("da")) <= F.lit(float(d)))
    return pairs


def elev_band(pairs: DataFrame, lo: float, hi: float) -> DataFrame:
    """Lo <= |altitude difference| <= hi."""
    return pairs.where(F.abs(F.col("da")).between(F.lit(float(lo)), F.lit(float(hi))))


def nearest_k(pairs: DataFrame, k: int) -> DataFrame:
    """The k nearest neighbours per station (ties by neighbour id), with their ``rank``."""
    w = Window.partitionBy("i").orderBy("dist", "j")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def neighbour_values(cells: DataFrame, pairs: DataFrame, axis: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Per time, each station's non-missing neighbour readings.

    ``cells`` is ``(t, sid, v)`` with non-null ``v``.  Returns
    ``(t, i, v_i, j, v_j, dist, da)``.  A station's cells of ``BLOCK`` axis positions are one row
    of arrays; it travels to the station itself and to every station it is a neighbour of, where the
    positions are written out and meet the station's own by a window.  The result lies by ``i`` in ``parts`` parts
    (see ``spread``), so that grouping it by time and station crosses no further shuffle.
    ``axis`` is the ``time_axis`` of the cells (broadcast) where the caller has it; the pair list is dimension-sized.
    """
    axis = F.broadcast((time_axis(cells) if axis is None else axis).select("t", "idx"))
    at = cells.where(F.col("sid").isNotNull()).join(axis, "t")
    entry = F.struct((F.col("idx") % BLOCK).cast("byte").alias("p"), F.col("v").alias("x"))
    blocks = at.groupBy("sid", F.floor(F.col("idx") / BLOCK).alias("block")).agg(F.collect_list(entry).alias("es"))
    blocks = blocks.select("sid", "block", F.col("es.p").alias("p"), F.col("es.x").alias("x"))
    link = pairs.where(F.col("i").isNotNull()).select(F.col("j").alias("sid"), "i", "dist", "da", F.lit(False).alias("own"))
    none = [F.lit(None).cast(link.schema[c].dataType).alias(c) for c in ("dist", "da")]
    ways = link.unionByName(link.select("i").distinct().select(F.col("i").alias("sid"), "i", *none, F.lit(True).alias("own")))
    sent = spread(blocks.join(ways, "sid"), "i", parts=parts)
    rows = sent.select("i", F.col("sid").alias("j"), "dist", "da", "own", "block", F.inline(F.arrays_zip("p", "x")).alias("p", "v_j"))
    rows = rows.select("i", "j", "dist", "da", "own", (F.col("block") * BLOCK + F.col("p")).alias("idx"), "v_j")
    here = F.collect_list(F.when(F.col("own"), F.struct("v_j"))).over(Window.partitionBy("i", "idx"))
    met = rows.withColumn("here", here).where(~F.col("own")).select("*", F.explode("here").alias("me"))
    return met.join(axis, "idx").select("t", "i", F.col("me.v_j").alias("v_i"), "j", "v_j", "dist", "da")


def idw_background(nbrs: DataFrame, eps: float = 0.1, slope: float = 0.0,
                   keys=("t", "i")) -> DataFrame:
    """Inverse-distance weighted mean with weight 1/(d+eps) plus mean(da)*slope.

    A NULL neighbour value poisons the estimate (it is NULL), like NaN would.
    """
    w = F.lit(1.0) / (F.col("dist") + F.lit(float(eps)))
    agg = nbrs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count("v_j").alias("n_v"),
        F.sum(F.col("v_j") * w).alias("swv"), F.sum(w).alias("sw"), F.avg("da").alias("mean_da"),
        F.count("da").alias("n_da"))
    bg = F.when((F.col("n_v") == F.col("n")) & (F.col("n_da") == F.col("n")),
                F.col("swv") / F.col("sw") + F.col("mean_da") * F.lit(float(slope)))
    return agg.withColumn("background", bg)
