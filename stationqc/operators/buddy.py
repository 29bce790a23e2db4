"""Buddy check with lapse adjustment, and the time eligibility gate.

Plan: the neighbour statistics of a cell need only the *neighbours'* values.  The stations
are dealt into groups of one place (a square of four radii, ``GROUP_STATIONS`` at most);
a group needs the cells of its own stations and, as a halo, those of their other
neighbours.  So a cell travels once to its own group and once to every further group it is
a neighbour in, and the cells x neighbours expansion happens inside the group: it
crosses no shuffle, whatever the size of the pair list.  The own rows carry their
columns along, so nothing joins back.  Many times of a large group are cut into buckets of days.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from stationqc.operators.geo import elev_max, project, radius_pairs_metric
from stationqc.params import BuddyParams
from stationqc.session import spread, store

#: Own stations of a group at most; stations (halo included) for which one more bucket of days is opened.
GROUP_STATIONS, BUCKET_STATIONS, BUCKETS = 256, 64, 256


def buddy_pairs(stations: DataFrame, prm: BuddyParams, zone: int = 33) -> DataFrame:
    return elev_max(radius_pairs_metric(stations, prm.radius, zone), prm.max_elev_diff)


def neighbour_groups(stations: DataFrame, pairs: DataFrame, radius: float) -> tuple[DataFrame, DataFrame]:
    """(members ``(grp, sid, own, pos, n)``: the own stations of every group and their other
    neighbours, pairs ``(grp, pi, pj, da, n)`` by position within the group)."""
    side = F.lit(4.0 * float(radius))
    square = store(project(stations).select("sid", "x", "y")).withColumns({c: F.floor(F.col(p) / side) for c, p in (("cx", "x"), ("cy", "y"))})
    nth = F.row_number().over(Window.partitionBy("cx", "cy").orderBy("y", "x", "sid")) - 1
    home = store(square.select("sid", F.xxhash64("cx", "cy", F.floor(nth / GROUP_STATIONS)).alias("grp")).dropDuplicates(["sid"]))
    near = store(pairs.select("i", "j", "da").join(home.select(F.col("sid").alias("i"), "grp"), "i"))
    both = home.select("grp", "sid", F.lit(True).alias("own")).unionByName(
        near.select("grp", F.col("j").alias("sid"), F.lit(False).alias("own")))
    by_group = Window.partitionBy("grp")
    members = both.groupBy("grp", "sid").agg(F.bool_or("own").alias("own"))
    members = store(members.select("*", (F.row_number().over(by_group.orderBy("sid")) - 1).alias("pos"),
                                   F.count(F.lit(1)).over(by_group).cast("int").alias("n")))
    at_i = members.select("grp", F.col("sid").alias("i"), F.col("pos").alias("pi"), "n")
    at_j = members.select("grp", F.col("sid").alias("j"), F.col("pos").alias("pj"))
    return members, near.join(at_i, ["grp", "i"]).join(at_j, ["grp", "j"]).select("grp", "pi", "pj", "da", "n")


def _group_stats(cells: pa.Table, near: pa.Table, gradient: float) -> tuple[np.ndarray, ...]:
    """Neighbour count, count / mean / population std of the adjusted values for the ``own`` rows of a group."""
    axis = cells["t"].combine_chunks().dictionary_encode()
    at, times = axis.indices.fill_null(-1).to_numpy(zero_copy_only=False), max(1, len(axis.dictionary))
    pos = cells["pos"].to_numpy()
    n = near["n"][0].as_py() if len(near) else 0
    here = (at >= 0) & (pos >= 0) & (pos < n)
    filled = np.flatnonzero(here & cells["_v"].is_valid().to_numpy())
    # a repeated (time, station) counts as often as it is there: further rows lie in further layers
    key = pos[filled].astype(np.int64) * times + at[filled]
    order = np.argsort(key, kind="stable")
    first = np.r_[True, key[order][1:] != key[order][:-1]] if len(key) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    layer = np.empty(len(key), np.int64)
    layer[order] = np.arange(len(key)) - np.repeat(starts, np.diff(np.r_[starts, len(key)]))
    layers = int(layer.max()) + 1 if len(layer) else 1
    values, there = np.zeros((layers * n, times)), np.zeros((layers * n, times), bool)
    place = layer * n + pos[filled], at[filled]
    values[place], there[place] = cells["_v"].fill_null(0.0).to_numpy()[filled], True
    counts, used = np.zeros((n, times), np.int64), np.zeros((n, times), np.int64)
    means, stds = np.zeros((n, times)), np.zeros((n, times))
    if len(near):
        pi, pj = near["pi"].to_numpy(), near["pj"].to_numpy()
        da = near["da"].fill_null(np.nan).to_numpy()
        by_i = np.argsort(pi, kind="stable")
        pi, pj, da = pi[by_i], pj[by_i], da[by_i]
        edges = np.searchsorted(pi, np.arange(n + 1))
        for k in np.unique(pi):
            part = slice(edges[k], edges[k + 1])
            nb = (pj[part] + n * np.arange(layers)[:, None]).ravel()
            use = there[nb]
            counts[k] = use.sum(axis=0)
            adj = values[nb]
            if gradient != 0:
                lift = np.tile(da[part], layers)[:, None]
                use = use & ~np.isnan(lift)
                adj = adj + gradient * lift          # D5, sign as in the original
            used[k] = use.sum(axis=0)
            with np.errstate(invalid="ignore", divide="ignore"):
                means[k] = np.where(use, adj, 0.0).sum(axis=0) / used[k]
                stds[k] = np.sqrt((np.where(use, adj - means[k], 0.0) ** 2).sum(axis=0) / used[k])
    own = np.flatnonzero(cells["own"].to_numpy())
    some = here[own]
    spot = np.where(some, pos[own], 0), np.where(some, at[own], 0)
    if not n:
        return own, np.zeros(len(own), np.int64), np.zeros(len(own), np.int64), np.zeros(len(own)), np.zeros(len(own))
    return own, np.where(some, counts[spot], 0), np.where(some, used[spot], 0), means[spot], stds[spot]


def buddy_stats(grid: DataFrame, stations: DataFrame, pairs: DataFrame, prm: BuddyParams, v: str = "v",
                parts: int | None = None) -> DataFrame:
    """The grid with ``n_nb, n_adj, nb_mean, nb_std`` per (t, sid): neighbour count and mean / population
    std of the adjusted values (all NULL without a neighbour).  The groups are dealt into ``parts`` parts if given."""
    members, near = neighbour_groups(stations, pairs, prm.radius)
    buckets = F.least(F.lit(BUCKETS), F.ceil(F.col("n") / BUCKET_STATIONS)).cast("int")
    # the tested value travels once, for its own row and as a neighbour
    once = v not in ("t", "sid") and dict(grid.dtypes)[v] == "double"
    rest = [c for c in grid.columns if c not in ("t", "sid") and not (once and c == v)]
    carried = F.struct(*rest) if rest else F.struct(F.lit(None).cast("boolean").alias("_"))
    own = F.coalesce("own", F.lit(True))             # a station outside the dimension has no neighbours
    day = F.coalesce(F.datediff(F.to_date("t"), F.lit("1970-01-01")), F.lit(0))
    cells = (grid.join(members, "sid", "left")
             .where(own | F.col(v).isNotNull())
             .select(F.coalesce("grp", F.xxhash64("sid")).alias("grp"), F.pmod(day, F.coalesce(buckets, F.lit(1))).alias("bucket"),
                     "t", "sid", F.coalesce("pos", F.lit(-1)).alias("pos"), own.alias("own"), F.col(v).cast("double").alias("_v"),
                     F.when(own, carried).alias("rest")))
    if parts is not None:
        cells = spread(cells, "grp", "bucket", parts=parts)
    near = near.withColumn("in_bucket", F.explode(F.sequence(F.lit(0), buckets - 1))).withColumnRenamed("grp", "in_grp")
    gradient = float(prm.elev_gradient)

    def with_stats(cells: pa.Table, near: pa.Table) -> pa.Table:
        own, n_nb, n_adj, mean, std = _group_stats(cells, near, gradient)
        out = cells.select(["t", "sid", "_v", "rest"]).take(pa.array(own))
        for name, x, kind, known in (("n_nb", n_nb, pa.int64(), n_nb > 0), ("n_adj", n_adj, pa.int64(), n_nb > 0),
                                     ("nb_mean", mean, pa.float64(), n_adj > 0), ("nb_std", std, pa.float64(), n_adj > 0)):
            out = out.append_column(name, pa.array(x, type=kind, mask=~known, from_pandas=False))
        return out

    shape = StructType(cells.select("t", "sid", "_v", "rest").schema.fields).add("n_nb", "long").add("n_adj", "long")
    done = (cells.groupBy("grp", "bucket").cogroup(near.groupBy("in_grp", "in_bucket"))
            .applyInArrow(with_stats, shape.add("nb_mean", "double").add("nb_std", "double")))
    back = {c: F.col(f"rest.{c}") for c in rest} | ({v: F.col("_v")} if once else {})
    return done.select(*[back[c].alias(c) if c in back else F.col(c) for c in grid.columns],
                       "n_nb", "n_adj", "nb_mean", "nb_std")


def buddy_check(grid: DataFrame, stations: DataFrame, prm: BuddyParams = BuddyParams(), v: str = "v",
                out: str = "buddy_suspect", pairs: DataFrame | None = None, keep_stats: bool = False,
                parts: int | None = None) -> DataFrame:
    """Suspect-flag over the dense grid.

    Missing -> suspect.  Neighbours: within ``radius`` (projected), not self,
    non-missing, altitude rule.  Fewer than ``num_min`` -> suspect.  Else suspect
    when |v - mean| > threshold * max(std, min_std), strictly.  A NULL
    neighbour altitude under a gradient poisons the mean: no comparison.
    ``keep_stats`` keeps the columns of ``buddy_stats``.

    With ``parts`` the rows come out by station in so many parts, and a missing cell, which is suspect
    whatever its neighbours, does not travel to its group: for a grid of many missing cells that lies
    by station in ``parts`` parts and is cheap to read twice.
    """
    if pairs is None:
        pairs = buddy_pairs(stations, prm)
    if parts is not None and not keep_stats:
        filled = _flagged(buddy_stats(grid.where(F.col(v).isNotNull()), stations, pairs, prm, v, parts), prm, v, out, False)
        missing = grid.where(F.col(v).isNull()).withColumn(out, F.lit(True))
        return spread(filled, "sid", parts=parts).unionByName(spread(missing, "sid", parts=parts))
    return _flagged(buddy_stats(grid, stations, pairs, prm, v, parts), prm, v, out, keep_stats)


def _flagged(j: DataFrame, prm: BuddyParams, v: str, out: str, keep_stats: bool) -> DataFrame:
    """The verdicts ``out`` from the columns of ``buddy_stats``."""
    scale = F.greatest(F.col("nb_std"), F.lit(float(prm.min_std)))
    outlier = (F.col("n_adj") == F.col("n_nb")) & \
        (F.abs(F.col(v) - F.col("nb_mean")) > F.lit(float(prm.threshold)) * scale)
    suspect = (F.col(v).isNull() | (F.coalesce(F.col("n_nb"), F.lit(0)) < F.lit(int(prm.num_min)))
               | F.coalesce(outlier, F.lit(False)))
    j = j.withColumn(out, suspect)
    return j if keep_stats else j.drop("n_nb", "n_adj", "nb_mean", "nb_std")


def eligible_times(grid: DataFrame, n: int, v: str = "v") -> DataFrame:
    """``(t, n_valid, eligible)``: a spatial test runs only where >= n values exist."""
    return (grid.groupBy("t").agg(F.count(v).alias("n_valid"))
            .withColumn("eligible", F.col("n_valid") >= F.lit(int(n))))
