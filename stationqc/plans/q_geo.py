"""Queries over geometry (C1-C8), buddy check (D4-D6) and the step test."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationqc.functions.columns import utm_sql
from stationqc.operators import buddy as B
from stationqc.operators import geo as Geo
from stationqc.operators.grid import dense_grid, grid_parts, time_axis
from stationqc.operators.temporal import temporal_step
from stationqc.params import BuddyParams
from stationqc.plans.catalog import cells_e, grid_e, grid_f, r4, register
from stationqc.plans.sqlfix import FGRID, GRID, STATIONS, e_cells, l_cells
from stationqc.session import store
from stationqc.sources import fixtures as X

XS, YS = utm_sql("lat", "lon")
PROJ = f"proj AS (SELECT sid, lat, lon, alt, {XS} AS x, {YS} AS y FROM stations)"
MPAIRS = ("mp AS (SELECT a.sid AS i, b.sid AS j, sqrt((b.x - a.x)^2 + (b.y - a.y)^2) AS dist, b.alt - a.alt AS da "
          "FROM proj a JOIN proj b ON a.sid <> b.sid WHERE sqrt((b.x - a.x)^2 + (b.y - a.y)^2) <= {r})")
DPAIRS = ("dp AS (SELECT a.sid AS i, b.sid AS j, sqrt((b.lon - a.lon)^2 + (b.lat - a.lat)^2) AS dist, "
          "b.alt - a.alt AS da FROM stations a JOIN stations b ON a.sid <> b.sid "
          "WHERE sqrt((b.lon - a.lon)^2 + (b.lat - a.lat)^2) <= {r})")


def stations_l(spark, sf):
    return X.stations_l(spark, sf)


@register("utm_xy", f"""WITH {l_cells()}, {STATIONS}, {PROJ}
SELECT sid, round(x, 4) AS x, round(y, 4) AS y FROM proj""")
def q_utm_xy(spark, sf):
    p = Geo.project(stations_l(spark, sf))
    return p.select("sid", r4("x").alias("x"), r4("y").alias("y"))


@register("radius_pairs", f"""WITH {l_cells()}, {STATIONS}, {PROJ}, {MPAIRS.format(r=5000.0)}
SELECT i, j, round(dist, 4) AS dist FROM mp""")
def q_radius_pairs(spark, sf):
    p = Geo.radius_pairs_metric(stations_l(spark, sf), 5000.0)
    return p.select("i", "j", r4("dist").alias("dist"))


@register("degree_pairs", f"""WITH {l_cells()}, {STATIONS}, {DPAIRS.format(r=0.04)}
SELECT i, j, round(dist, 4) AS dist FROM dp""")
def q_degree_pairs(spark, sf):
    p = Geo.radius_pairs_degree(stations_l(spark, sf), 0.04)
    return p.select("i", "j", r4("dist").alias("dist"))


@register("elev_pairs", f"""WITH {l_cells()}, {STATIONS}, {PROJ}, {MPAIRS.format(r=5000.0)},
dp2 AS (SELECT a.sid AS i, b.sid AS j, b.alt - a.alt AS da FROM stations a JOIN stations b ON a.sid <> b.sid
        WHERE sqrt((b.lon - a.lon)^2 + (b.lat - a.lat)^2) <= 0.05)
SELECT 'max100' AS rule, i, j, da FROM mp WHERE abs(da) <= 100
UNION ALL SELECT 'band20_200' AS rule, i, j, da FROM dp2 WHERE abs(da) BETWEEN 20 AND 200""")
def q_elev_pairs(spark, sf):
    st = stations_l(spark, sf)
    a = Geo.elev_max(Geo.radius_pairs_metric(st, 5000.0), 100.0).select(F.lit("max100").alias("rule"), "i", "j", "da")
    b = Geo.elev_band(Geo.radius_pairs_degree(st, 0.05), 20.0, 200.0).select(
        F.lit("band20_200").alias("rule"), "i", "j", "da")
    return a.unionByName(b)


@register("nearest_k", f"""WITH {l_cells()}, {STATIONS}, {DPAIRS.format(r=0.04)}
SELECT i, j, rnk FROM (SELECT i, j, row_number() OVER (PARTITION BY i ORDER BY dist, j)::BIGINT AS rnk FROM dp)
WHERE rnk <= 5""")
def q_nearest_k(spark, sf):
    p = Geo.nearest_k(Geo.radius_pairs_degree(stations_l(spark, sf), 0.04), 5)
    return p.select("i", "j", F.col("rank").cast("long").alias("rnk"))


@register("idw_background", f"""WITH {e_cells()}, {GRID}, {FGRID}, {STATIONS}, {DPAIRS.format(r=0.04)},
nk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY dist, j) AS rnk FROM dp) WHERE rnk <= 5),
nb AS (SELECT g.t, nk.i, nk.dist, nk.da, h.v AS v_j FROM fgrid g JOIN nk ON nk.i = g.sid
       JOIN fgrid h ON h.t = g.t AND h.sid = nk.j WHERE g.v IS NOT NULL AND h.v IS NOT NULL)
SELECT t, i, count(*)::BIGINT AS n,
       round(CASE WHEN count(da) = count(*) THEN
             sum(v_j / (dist + 0.1)) / sum(1.0 / (dist + 0.1)) + avg(da) * -0.0065 END, 4) AS background
FROM nb GROUP BY t, i""")
def q_idw_background(spark, sf):
    given = store(cells_e(spark, sf))
    axis = store(time_axis(given))
    parts = grid_parts(given, axis)
    cells = X.fill_rule(dense_grid(given, axis, parts=parts)).where(F.col("v").isNotNull())
    pairs = store(Geo.nearest_k(Geo.radius_pairs_degree(X.stations_e(spark, sf), 0.04), 5))
    nb = Geo.neighbour_values(cells, pairs, axis, parts * (5 + 1))
    bg = Geo.idw_background(nb, eps=0.1, slope=-0.0065)
    return bg.select("t", "i", F.col("n").cast("long").alias("n"), r4("background").alias("background"))


def _buddy_sql(grid_rel, cells_cte, radius, max_elev, thr, gradient, extra_ctes=""):
    adj = "h.v" if gradient == 0 else f"h.v + {gradient!r} * (b.alt - a.alt)"
    elev = f"AND abs(b.alt - a.alt) <= {max_elev!r}" if max_elev > 0 else ""
    return f"""WITH {cells_cte}, {GRID}, {extra_ctes}{STATIONS}, {PROJ},
pairs AS (SELECT a.sid AS i, b.sid AS j, a.alt AS alt_i, b.alt AS alt_j FROM proj a JOIN proj b ON a.sid <> b.sid
          WHERE sqrt((b.x - a.x)^2 + (b.y - a.y)^2) <= {radius!r} {elev}),
nb AS (SELECT g.t, g.sid, {adj.replace('b.alt', 'p.alt_j').replace('a.alt', 'p.alt_i')} AS adj
       FROM {grid_rel} g JOIN pairs p ON p.i = g.sid JOIN {grid_rel} h ON h.t = g.t AND h.sid = p.j
       WHERE g.v IS NOT NULL AND h.v IS NOT NULL),
st AS (SELECT t, sid, count(*) AS n, count(adj) AS n_adj, avg(adj) AS m, stddev_pop(adj) AS s FROM nb GROUP BY t, sid)
SELECT g.t, g.sid, CASE WHEN g.v IS NULL THEN 'missing'
                        WHEN coalesce(st.n, 0) < 3 THEN 'isolated'
                        WHEN st.n_adj = st.n AND abs(g.v - st.m) > {thr!r} * greatest(st.s, 0.1) THEN 'outlier'
                        ELSE 'ok' END AS category,
       g.v IS NULL OR coalesce(st.n, 0) < 3
       OR coalesce(st.n_adj = st.n AND abs(g.v - st.m) > {thr!r} * greatest(st.s, 0.1), false) AS suspect
FROM {grid_rel} g LEFT JOIN st ON st.t = g.t AND st.sid = g.sid"""


def _buddy_categories(g, stations, prm):
    # the category for reporting comes from the statistics of the same pass
    j = B.buddy_check(g, stations, prm, out="suspect", keep_stats=True)
    cat = (F.when(F.col("v").isNull(), "missing")
           .when(F.coalesce(F.col("n_nb"), F.lit(0)) < prm.num_min, "isolated")
           .when(F.col("suspect"), "outlier").otherwise("ok"))
    return j.select("t", "sid", cat.alias("category"), "suspect")


@register("buddy_flags", _buddy_sql("grid", e_cells(), 20000.0, 100.0, 3.0, -0.0065))
def q_buddy_flags(spark, sf):
    prm = BuddyParams(radius=20000.0, num_min=3, threshold=3.0, max_elev_diff=100.0, elev_gradient=-0.0065)
    return _buddy_categories(grid_e(spark, sf), X.stations_e(spark, sf), prm)


@register("buddy_lapse", _buddy_sql("fgrid", e_cells(), 5000.0, 400.0, 1.5, -0.0065, extra_ctes=FGRID + ", "))
def q_buddy_lapse(spark, sf):
    prm = BuddyParams(radius=5000.0, num_min=3, threshold=1.5, max_elev_diff=400.0, elev_gradient=-0.0065)
    return _buddy_categories(grid_f(spark, sf), X.stations_e(spark, sf), prm)


@register("eligible_timesteps", f"""WITH {e_cells()}, {GRID}
SELECT t, count(v)::BIGINT AS n_valid, count(v) >= 10 AS eligible FROM grid GROUP BY t""")
def q_eligible_timesteps(spark, sf):
    e = B.eligible_times(grid_e(spark, sf), 10)
    return e.select("t", F.col("n_valid").cast("long").alias("n_valid"), "eligible")


@register("step_flags", f"""WITH {e_cells()}, {GRID},
s AS (SELECT *, lag(v) OVER (PARTITION BY sid ORDER BY t) AS vp, lead(v) OVER (PARTITION BY sid ORDER BY t) AS vn
      FROM grid)
SELECT t, sid, coalesce(abs(v - vp) > 3.0, false) OR coalesce(abs(v - vn) > 3.0, false) AS suspect FROM s""")
def q_step_flags(spark, sf):
    return temporal_step(grid_e(spark, sf), 3.0, out="suspect").select("t", "sid", "suspect")
