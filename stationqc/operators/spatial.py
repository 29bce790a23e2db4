"""Greedy spatial (and spatio-temporal) consistency tests.

Within one time step the test is an order-dependent scan over the stations
(sorted by id): the first unprocessed station is tested against its outer
neighbours that are not yet flagged, then it and every station within the
inner radius are marked processed.  Times are independent.

Two plans:

* **Closed form** when every pair of stations is within both radii (the
  shipped radii, given in coordinate units, cover any realistic network): only
  the lowest station id is tested at each time and its neighbour set is the
  same for every time.  This is one static neighbour list (a distributed
  top-k), one join and one hash aggregate by time -- plain SQL.
* **General scan** otherwise, in one of two forms with the same result.  A network
  whose connected components (of the static neighbour graph) are small is scanned by
  component: blocks of times of one component go through a numpy kernel in a cogroup
  with the component's pair list.  With a component beyond ``SCAN_STATIONS`` the
  scan runs as dependency rounds (``spatial_rounds``), joins and aggregates in which
  no task holds a component.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from stationqc.functions.columns import epoch_seconds
from stationqc.operators.geo import _pairs, project
from stationqc.operators.spatial_rounds import sct_rounds, testable
from stationqc.operators.temporal import temporal_step
from stationqc.params import SctParams
from stationqc.session import cut_lineage, store


def _coords(stations: DataFrame, prm: SctParams) -> DataFrame:
    if prm.metric == "m":
        return store(project(stations).select("sid", F.col("x").alias("cx"), F.col("y").alias("cy"), "alt"))
    return stations.select("sid", F.col("lon").alias("cx"), F.col("lat").alias("cy"), "alt")


def network_summary(stations: DataFrame, prm: SctParams, to_check: str | None = None):
    """One small aggregate over the station dimension: station count, bounding-box
    diagonal, and id / coordinates / altitude of the first checked station (lowest id)."""
    c = _coords(stations, prm)
    first = F.col("sid")
    if to_check:
        c = c.join(stations.select("sid", F.coalesce(F.col(to_check), F.lit(False)).alias("_chk")), "sid")
        first = F.when(F.col("_chk"), F.col("sid"))
    return c.agg(F.count(F.lit(1)).alias("n"),
                 F.sqrt((F.max("cx") - F.min("cx")) ** 2 + (F.max("cy") - F.min("cy")) ** 2).alias("diag"),
                 F.min(first).alias("i0"), F.min_by("cx", first).alias("x0"), F.min_by("cy", first).alias("y0"),
                 F.min_by("alt", first).alias("a0")).first()


def covers_all(stations: DataFrame, prm: SctParams, summary=None) -> bool:
    """True when the bounding-box diagonal of the network is within both radii."""
    row = summary or network_summary(stations, prm)
    diag = row["diag"] if row and row["diag"] is not None else 0.0
    return diag <= min(prm.inner_radius, prm.outer_radius)


# ------------------------------------------------------------------ closed form
def _first_station_neighbours(stations: DataFrame, prm: SctParams, band: bool, summary) -> DataFrame:
    c = _coords(stations, prm)
    i0 = summary["i0"]
    x0, y0 = F.lit(summary["x0"]).cast("double"), F.lit(summary["y0"]).cast("double")
    a0 = F.lit(summary["a0"]).cast("double")
    nb = c.where(F.col("sid") != F.lit(i0)).select(
        F.col("sid").alias("j"), F.sqrt((F.col("cx") - x0) ** 2 + (F.col("cy") - y0) ** 2).alias("dist"),
        (F.col("alt") - a0).alias("da"))
    if band:
        nb = nb.where(F.abs(F.col("da")).between(F.lit(float(prm.min_elev_diff)), F.lit(float(prm.max_elev_diff))))
    # distributed top-k: each partition keeps its num_max best, then one merge
    nb = nb.orderBy("dist", "j").limit(int(prm.num_max))
    return nb


def sct_closed_form(grid: DataFrame, stations: DataFrame, prm: SctParams, stct: bool = False,
                    v: str = "v", summary=None, to_check: str | None = None) -> DataFrame:
    """D7 (``stct=False``) or D8 closed form. Adds ``sct_flag`` (and ``temporal_flag`` for D8)."""
    summary = summary or network_summary(stations, prm, to_check)
    if summary["i0"] is None:   # no station, or none to check
        return grid.withColumn("sct_flag", F.lit(False)) if not stct else \
            temporal_step(grid, prm.temporal_threshold, v=v, out="temporal_flag").drop("v_prev", "v_next") \
            .withColumn("sct_flag", F.lit(False))
    n_st = F.lit(int(summary["n"]))
    i0 = F.lit(summary["i0"])
    nb = _first_station_neighbours(stations, prm, stct, summary)
    cells = grid.select("t", F.col("sid").alias("j"), F.col(v).alias("v_j"))
    j = cells.join(F.broadcast(nb), "j")   # nb has at most num_max rows
    w = F.lit(1.0) / (F.col("dist") + F.lit(float(prm.eps)))
    st = j.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.count("v_j").alias("n_v"),
                            F.avg("v_j").alias("m"), F.stddev_pop("v_j").alias("s"),
                            F.sum(F.col("v_j") * w).alias("swv"), F.sum(w).alias("sw"), F.avg("da").alias("mda"))
    g = grid
    if stct:
        g = temporal_step(g, prm.temporal_threshold, v=v, out="temporal_flag").drop("v_prev", "v_next")
    g = g.join(F.broadcast(st), "t", "left")   # one row per axis time
    if stct:
        bg = F.col("swv") / F.col("sw") + F.col("mda") * F.lit(float(prm.vertical_scale))
    else:
        bg = F.col("m")
    dev = F.col(v) - bg
    spatial = (F.col("n_v") == F.col("n")) & ((dev > F.lit(float(prm.pos_threshold)) * F.col("s"))
                                              | (dev < -F.lit(float(prm.neg_threshold)) * F.col("s")))
    tested = (F.col("sid") == i0) & (n_st - 1 >= F.lit(int(prm.num_min)))
    flag = F.coalesce(spatial, F.lit(False))
    if stct:
        flag = flag | F.col("temporal_flag")
    g = g.withColumn("sct_flag", tested & flag)
    return g.drop("n", "n_v", "m", "s", "swv", "sw", "mda")


# ------------------------------------------------------------------ general scan
GROUP_CELLS = 400_000   # cells of one scan group: as many whole times of a component as fit, at least one
SCAN_STATIONS = 4_000   # stations of a component that one scan group may hold


def _links(stations: DataFrame, prm: SctParams) -> DataFrame:
    """Ordered pairs ``(i, j, dist, da)``, a station itself included, within max(inner, outer)."""
    return _pairs(_coords(stations, prm), "cx", "cy", max(prm.inner_radius, prm.outer_radius), keep_self=True)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on undirected edges ``(a, b)``: every station's neighbours are
    re-linked to the smallest id it sees -- the larger ones (large) or the smaller
    ones and itself (small)."""
    if large:
        seen = edges.union(edges.select("b", "a"))
    else:
        seen = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = seen.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    near = seen.join(low, "a")
    if large:
        out = near.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = (near.select(F.col("b").alias("a"), F.col("low").alias("b"))
               .union(low.select("a", F.col("low").alias("b"))))
    return out.where(F.col("a") != F.col("b")).distinct()


def scan_components(stations: DataFrame, prm: SctParams, links: DataFrame | None = None) -> DataFrame:
    """``(sid, comp)``: connected components of the static graph joining stations
    within max(inner, outer) of each other; ``comp`` is the smallest id.

    The scan only passes state between such neighbours (flags through the outer
    radius, processed marks through the inner one), so each component is scanned
    on its own, in station-id order, with results identical to the scan of the
    whole network.  Alternating large-star / small-star steps over the pair list
    (a logarithmic number of rounds), each written to the checkpoint folder; the
    loop runs until the edges no longer change, so this part is not lazy.
    """
    links = _links(stations, prm) if links is None else links
    edges = cut_lineage(links.where(F.col("i") < F.col("j")).select(F.col("i").alias("a"), F.col("j").alias("b")))
    mark = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    before = None
    while True:
        state = edges.agg(*mark).first()
        if state == before or state[0] == 0:
            break
        before = state
        edges = cut_lineage(_star(_star(edges, True), False))
    low = edges.select(F.col("a").alias("sid"), F.col("b").alias("comp"))
    return stations.select("sid").join(low, "sid", "left").select("sid", F.coalesce("comp", "sid").alias("comp"))


def scan_levels(stations: DataFrame, prm: SctParams, to_check: str | None = None) -> DataFrame:
    """``(sid, level)``: the dependency round that settles each station that can be tested."""
    links = cut_lineage(_links(stations, prm).select("i", "j", "dist", "da"))
    return testable(stations, links, prm, to_check)[0].select("sid", "level")


def neighbour_arrays(links: pd.DataFrame, n: int, prm: SctParams):
    """Flat arrays of one component's pair list: the outer neighbours of position k are
    ``pos[start[k]:start[k + 1]]`` by (distance, id), likewise the inner ones."""
    i, j, d = links["pi"].to_numpy(), links["pj"].to_numpy(), links["dist"].to_numpy(dtype=float)
    da = links["da"].to_numpy(dtype=float, na_value=np.nan)
    by_near = np.lexsort((j, d, i))
    i, j, d, da = i[by_near], j[by_near], d[by_near], da[by_near]
    outer, inner = (i != j) & (d <= prm.outer_radius), d <= prm.inner_radius
    o_start = np.searchsorted(i[outer], np.arange(n + 1))
    n_start = np.searchsorted(i[inner], np.arange(n + 1))
    return o_start, j[outer], d[outer], da[outer], n_start, j[inner]


def greedy_scan(v, present, tflag, arrays, checked, prm: SctParams, stct: bool):
    """The order-dependent scan of several times at once: ``v``, ``present`` and
    ``tflag`` are (times x positions); the times do not influence each other, so
    every step handles one station at all times where it is still unprocessed."""
    o_start, o_pos, o_d, o_da, n_start, n_pos = arrays
    flags = np.zeros(v.shape, dtype=bool)
    processed = ~present
    for k in np.flatnonzero(checked):
        at = np.flatnonzero(~processed[:, k])
        part = slice(o_start[k], o_start[k + 1])
        nb, d, da = o_pos[part], o_d[part], o_da[part]
        use = present[np.ix_(at, nb)] & ~flags[np.ix_(at, nb)]
        enough = use.sum(axis=1) >= prm.num_min
        at, use = at[enough], use[enough]
        if not len(at):
            continue
        if stct:
            with np.errstate(invalid="ignore"):
                use &= (np.abs(da) >= prm.min_elev_diff) & (np.abs(da) <= prm.max_elev_diff)
        use &= np.cumsum(use, axis=1) <= prm.num_max
        count = use.sum(axis=1)
        vals = np.where(use, v[np.ix_(at, nb)], 0.0)   # a missing value stays NaN: no comparison
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = vals.sum(axis=1) / count
            if stct:
                w = np.where(use, 1.0 / (d + prm.eps), 0.0)
                bg = (w * vals).sum(axis=1) / w.sum(axis=1) \
                    + np.where(use, da, 0.0).sum(axis=1) / count * prm.vertical_scale
            else:
                bg = mean
            err = np.sqrt((np.where(use, vals - mean[:, None], 0.0) ** 2).sum(axis=1) / count)
            dev = v[at, k] - bg
            bad = (dev > prm.pos_threshold * err) | (dev < -prm.neg_threshold * err)
        if stct:
            bad |= tflag[at, k]
        flags[at, k] = bad
        processed[np.ix_(at, n_pos[n_start[k]:n_start[k + 1]])] = True
    return flags


def sct_general(grid: DataFrame, stations: DataFrame, prm: SctParams, stct: bool = False, v: str = "v",
                to_check: str | None = None, plan: str = "general") -> DataFrame:
    """General scan: ``plan`` 'scan' (by component), 'rounds', or 'general' for the one that fits.

    By component, one group holds some times of one component (``GROUP_CELLS``
    cells, at least one whole time, which is the exact unit of the scan): its narrow
    cells are cogrouped with the component's pair list, which so travels once per
    group instead of once per cell.  Station ids of any orderable type: positions in
    id order stand for them inside the scan.  ``to_check`` names a boolean column of
    ``stations``: only those stations are tested (the others still serve as
    neighbours)."""
    links = cut_lineage(_links(stations, prm).select("i", "j", "dist", "da"))
    if plan == "rounds":
        return sct_rounds(grid, stations, links, prm, stct, v, to_check)
    comps = scan_components(stations, prm, links)
    if plan == "general":
        largest = comps.groupBy("comp").count().agg(F.max("count")).first()[0]
        if largest and largest > SCAN_STATIONS:
            return sct_rounds(grid, stations, links, prm, stct, v, to_check)
    g = grid
    if stct:
        g = temporal_step(g, prm.temporal_threshold, v=v, out="temporal_flag").drop("v_prev", "v_next")
    checked = F.coalesce(F.col(to_check), F.lit(False)) if to_check else F.lit(True)
    comps = comps.join(stations.select("sid", checked.alias("checked")), "sid")
    by_comp = Window.partitionBy("comp")
    n = F.count(F.lit(1)).over(by_comp)
    # one component's stations meet in one task here, as they do in the scan
    comps = cut_lineage(comps.select("sid", "comp", "checked", n.alias("n"), F.row_number().over(by_comp.orderBy("sid"))
                                     .cast("int").alias("pos")).withColumn("pos", F.col("pos") - 1))
    tflag = F.coalesce(F.col("temporal_flag"), F.lit(False)) if stct else F.lit(False)
    block = F.floor(epoch_seconds("t") / 3600 / F.greatest(F.lit(1), F.floor(F.lit(GROUP_CELLS) / F.col("n"))))
    cells = (g.select("t", "sid", F.col(v).alias("_v"), tflag.alias("tf")).join(comps, "sid")
             .select("comp", block.alias("block"), "t", "pos", "_v", "tf"))
    place = comps.select(F.col("sid").alias("i"), "comp", "n", F.col("pos").alias("pi"), "checked")
    pairs = (links.join(place, "i").join(comps.select(F.col("sid").alias("j"), F.col("pos").alias("pj")), "j")
             .select("comp", "n", "pi", "pj", "dist", "da", "checked"))
    # the pair list once for every group that exists
    groups = cells.select(F.col("comp").alias("in_comp"), F.col("block").alias("in_block")).distinct()
    pairs = pairs.join(groups, F.col("comp") == F.col("in_comp")).drop("comp")

    def scan(cells: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        n = int(pairs["n"].iloc[0]) if len(pairs) else 0
        times, row = np.unique(cells["t"].to_numpy(), return_inverse=True)
        pos = cells["pos"].to_numpy()
        values = np.full((len(times), n), np.nan)
        present, tf = np.zeros(values.shape, dtype=bool), np.zeros(values.shape, dtype=bool)
        values[row, pos] = cells["_v"].to_numpy(dtype=float, na_value=np.nan)
        present[row, pos] = True
        tf[row, pos] = cells["tf"].to_numpy(dtype=bool)
        checked = np.zeros(n, dtype=bool)
        checked[pairs["pi"].to_numpy()] = pairs["checked"].to_numpy(dtype=bool)
        flags = greedy_scan(values, present, tf, neighbour_arrays(pairs, n, prm), checked, prm, stct)
        return cells.loc[flags[row, pos], ["comp", "t", "pos"]]

    types = dict(grid.dtypes)
    found = (cells.groupBy("comp", "block").cogroup(pairs.groupBy("in_comp", "in_block"))
             .applyInPandas(scan, f"comp {types['sid']}, t {types['t']}, pos int"))
    flags = found.join(comps, ["comp", "pos"]).select("t", "sid", F.lit(True).alias("sct_flag"))
    return g.join(flags, ["t", "sid"], "left").withColumn("sct_flag", F.coalesce("sct_flag", F.lit(False)))


def sct(grid: DataFrame, stations: DataFrame, prm: SctParams, stct: bool = False, v: str = "v",
        plan: str = "auto", to_check: str | None = None) -> DataFrame:
    """Dispatch: closed form when the radii cover the whole network, else the scan
    (``plan`` 'closed', 'general', 'scan' or 'rounds' asks for a form)."""
    summary = network_summary(stations, prm, to_check) if plan in ("auto", "closed") else None
    if plan == "closed" or (plan == "auto" and covers_all(stations, prm, summary)):
        return sct_closed_form(grid, stations, prm, stct, v, summary, to_check)
    return sct_general(grid, stations, prm, stct, v, to_check, "general" if plan == "auto" else plan)
