"""Queries over the greedy spatial tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationqc.operators import spatial as SP
from stationqc.params import BATCH_SCT, GREEDY, GREEDY_ST, SEQUENTIAL_SCT, SctParams
from stationqc.plans.catalog import grid_f, register
from stationqc.plans.sqlfix import FGRID, GRID, STATIONS, e_cells, greedy_ctes
from stationqc.sources import fixtures as X

def _closed_sql(prm: SctParams, stct: bool) -> str:
    """The first station against its neighbours at each time; every other cell is plainly false."""
    band = (f"AND abs(s.alt - i0.alt) BETWEEN {prm.min_elev_diff!r} AND {prm.max_elev_diff!r}" if stct else "")
    w = f"(1.0 / (nk.dist + {prm.eps!r}))"
    bg = f"(sum(f.v * {w}) / sum({w}) + avg(nk.da) * {prm.vertical_scale!r})" if stct else "avg(f.v)"
    cells = "fgrid"
    if stct:
        cells = f"""(SELECT *, coalesce(abs(v - lag(v) OVER (PARTITION BY sid ORDER BY t)) > {prm.temporal_threshold!r}, false)
             OR coalesce(abs(v - lead(v) OVER (PARTITION BY sid ORDER BY t)) > {prm.temporal_threshold!r}, false)
             AS temporal_flag FROM fgrid)"""
    tcol, also = (", g.temporal_flag", " OR g.temporal_flag") if stct else ("", "")
    return f"""WITH {e_cells()}, {GRID}, {FGRID}, {STATIONS},
i0 AS MATERIALIZED (SELECT *, (SELECT count(*) FROM stations) - 1 >= {prm.num_min} AS enough FROM stations ORDER BY sid LIMIT 1),
nk AS MATERIALIZED (SELECT s.sid AS j, sqrt((s.lon - i0.lon)^2 + (s.lat - i0.lat)^2) AS dist, s.alt - i0.alt AS da
       FROM stations s, i0 WHERE s.sid <> i0.sid {band} ORDER BY dist, j LIMIT {prm.num_max}),
st AS MATERIALIZED (SELECT f.t, count(*) = count(f.v) AS whole, {bg} AS bg, stddev_pop(f.v) AS s FROM fgrid f JOIN nk ON nk.j = f.sid GROUP BY f.t)
SELECT g.t, g.sid{tcol}, i0.sid IS NOT NULL AND i0.enough
       AND (coalesce(st.whole AND (g.v - st.bg > {prm.pos_threshold!r} * st.s OR g.v - st.bg < -{prm.neg_threshold!r} * st.s), false){also}) AS sct_flag
FROM {cells} g LEFT JOIN i0 ON i0.sid = g.sid LEFT JOIN st ON st.t = g.t AND i0.sid = g.sid"""


def _run(spark, sf, prm, stct, plan):
    g = grid_f(spark, sf)
    st = X.stations_e(spark, sf)
    out = SP.sct(g, st, prm, stct=stct, plan=plan)
    cols = ["t", "sid"] + (["temporal_flag"] if stct else []) + ["sct_flag"]
    return out.select(*cols)


@register("sct_shipped", _closed_sql(BATCH_SCT, False))
def q_sct_shipped(spark, sf):
    return _run(spark, sf, BATCH_SCT, False, "auto")


@register("stct_shipped", _closed_sql(SEQUENTIAL_SCT, True))
def q_stct_shipped(spark, sf):
    return _run(spark, sf, SEQUENTIAL_SCT, True, "auto")


TEXT_STATIONS = (STATIONS.replace("stations AS", "stations_n AS", 1)
                 + ", stations AS (SELECT 'st-' || sid AS sid, lat, lon, alt FROM stations_n)")


@register("sct_greedy_text_ids", f"""WITH RECURSIVE {e_cells()}, {GRID}, {FGRID}, {TEXT_STATIONS},
tgrid AS (SELECT t, 'st-' || sid AS sid, v FROM fgrid), {greedy_ctes('tgrid', 'v', GREEDY, False, 'gs')}
SELECT t, sid, sct_flag FROM gs""")
def q_sct_greedy_text_ids(spark, sf):
    """The scan in the order of text ids (``st-10`` before ``st-2``)."""
    name = F.concat(F.lit("st-"), F.col("sid").cast("string"))
    g = grid_f(spark, sf).withColumn("sid", name)
    st = X.stations_e(spark, sf).withColumn("sid", name)
    return SP.sct(g, st, GREEDY, plan="general").select("t", "sid", "sct_flag")


@register("sct_obs_to_check", f"""WITH RECURSIVE {e_cells()}, {GRID}, {FGRID}, {STATIONS},
{greedy_ctes('fgrid', 'v', GREEDY_ST, True, 'gs', check='alt >= 400')}
SELECT t, sid, temporal_flag, sct_flag FROM gs""")
def q_sct_obs_to_check(spark, sf):
    """Only stations at 400 m and above are tested (none of unknown altitude)."""
    st = X.stations_e(spark, sf).withColumn("check", F.col("alt") >= 400)
    out = SP.sct(grid_f(spark, sf), st, GREEDY_ST, stct=True, plan="general", to_check="check")
    return out.select("t", "sid", "temporal_flag", "sct_flag")


def _greedy_sql(prm: SctParams, stct: bool) -> str:
    cols = "t, sid, temporal_flag, sct_flag" if stct else "t, sid, sct_flag"
    return f"""WITH RECURSIVE {e_cells()}, {GRID}, {FGRID}, {STATIONS}, {greedy_ctes('fgrid', 'v', prm, stct, 'gs')}
SELECT {cols} FROM gs"""


@register("sct_greedy", _greedy_sql(GREEDY, False))
def q_sct_greedy(spark, sf):
    return _run(spark, sf, GREEDY, False, "general")


@register("stct_greedy", _greedy_sql(GREEDY_ST, True))
def q_stct_greedy(spark, sf):
    return _run(spark, sf, GREEDY_ST, True, "general")


@register("sct_greedy_rounds", _greedy_sql(GREEDY, False))
def q_sct_greedy_rounds(spark, sf):
    """D7 as dependency rounds: joins and aggregates, no component in one task."""
    return _run(spark, sf, GREEDY, False, "rounds")


@register("stct_greedy_rounds", _greedy_sql(GREEDY_ST, True))
def q_stct_greedy_rounds(spark, sf):
    return _run(spark, sf, GREEDY_ST, True, "rounds")


@register("sct_levels", f"""WITH RECURSIVE {e_cells()}, {STATIONS},
pr AS (SELECT a.sid AS i, b.sid AS j, sqrt((b.lon - a.lon)^2 + (b.lat - a.lat)^2) AS d FROM stations a, stations b WHERE a.sid <> b.sid),
able AS (SELECT i AS sid FROM pr WHERE d <= {GREEDY.outer_radius!r} GROUP BY i HAVING count(*) >= {GREEDY.num_min}),
lower AS (SELECT i, j FROM pr WHERE j < i AND d <= {max(GREEDY.inner_radius, GREEDY.outer_radius)!r}
          AND i IN (SELECT sid FROM able) AND j IN (SELECT sid FROM able)),
up(sid, level) AS (SELECT sid, 0::INTEGER FROM able UNION SELECT lower.i, up.level + 1 FROM up JOIN lower ON lower.j = up.sid),
lev AS (SELECT sid, max(level) AS level FROM up GROUP BY sid)
SELECT level, count(*)::BIGINT AS stations, min(sid) AS first_station FROM lev GROUP BY level""")
def q_sct_levels(spark, sf):
    """The rounds of the scan: how many stations each settles."""
    stations = X.stations_e(spark, sf)
    lev = SP.scan_levels(stations, GREEDY)
    return lev.groupBy("level").agg(F.count(F.lit(1)).alias("stations"), F.min("sid").alias("first_station"))
