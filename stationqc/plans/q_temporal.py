"""Queries over the long-term checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stationqc.operators import moments as M
from stationqc.operators import temporal as T
from stationqc.operators.grid import hourly_cells
from stationqc.plans.catalog import ORACLE, cells_e, cells_l, grid_e, grid_l, r4, r4_tie, register
from stationqc.plans.sqlfix import GRID, e_cells, l_cells
from stationqc.session import ensure_checkpoint_dir
from stationqc.sources import fixtures as X


def _roll_sql(half_h: int) -> str:
    return (f"WINDOW w AS (PARTITION BY sid ORDER BY t RANGE BETWEEN INTERVAL {half_h} HOURS PRECEDING "
            f"AND INTERVAL {half_h} HOURS FOLLOWING)")


def _roll_cte(src: str, half_h: int, min_samples: int, thr: float) -> str:
    return f"""r0 AS (SELECT *, count(*) OVER w AS roll_rows, avg(v) OVER w AS m, stddev_pop(v) OVER w AS s
       FROM {src} {_roll_sql(half_h)}),
r AS (SELECT *, CASE WHEN roll_rows >= {min_samples} THEN (v - m) / nullif(s, 0) END AS roll_z FROM r0),
rr AS (SELECT *, NOT coalesce(abs(roll_z) > {thr!r}, false) AS roll_good FROM r)"""


def _clim_cte(src: str, half: int) -> str:
    return f"""g2 AS (SELECT *, dayofyear(t) AS doy FROM {src}),
targets AS (SELECT range::INT AS doy_t FROM range(1, 367)),
clim AS (SELECT g2.sid, tg.doy_t AS doy, count(*) AS clim_rows, count(g2.v) AS clim_n,
         sum(g2.v) / nullif(count(g2.v), 0) AS clim_mean, stddev_pop(g2.v) AS clim_std
         FROM targets tg JOIN g2 ON least(abs(g2.doy - tg.doy_t), 366 - abs(g2.doy - tg.doy_t)) <= {half}
         GROUP BY 1, 2)"""


def _seas_cte(src: str, min_samples: int, thr: float) -> str:
    return f"""sz0 AS (SELECT s.*, c.clim_rows, c.clim_mean, c.clim_std, dayofyear(s.t) AS doy_s FROM {src} s
        LEFT JOIN clim c ON c.sid = s.sid AND c.doy = dayofyear(s.t)),
sz AS (SELECT *, CASE WHEN clim_rows >= {min_samples} THEN (v - clim_mean) / nullif(clim_std, 0) END AS seas_z FROM sz0),
ss AS (SELECT *, NOT coalesce(abs(seas_z) > {thr!r}, false) AS seas_good FROM sz)"""


@register("rolling_z", f"""WITH {e_cells()}, {GRID}, {_roll_cte('grid', 360, 300, 3.0)}
SELECT t, sid, roll_rows::BIGINT AS roll_rows, round(roll_z, 4) AS roll_z, roll_good FROM rr""")
def q_rolling_z(spark, sf):
    r = T.rolling_zscore(grid_e(spark, sf), 720, 3.0, 300)
    return r.select("t", "sid", F.col("roll_rows").cast("long"), r4("roll_z").alias("roll_z"), "roll_good")


@register("climatology", f"""WITH {l_cells()}, {GRID}, {_clim_cte('grid', 15)}
SELECT sid, doy, clim_rows::BIGINT AS clim_rows, clim_n::BIGINT AS clim_n,
       round(clim_mean * 10000.0 + 1e-6) / 10000.0 AS clim_mean,
       round(clim_std, 4) AS clim_std FROM clim""")
def q_climatology(spark, sf):
    c = T.climatology(grid_l(spark, sf), 15.0)
    return c.select("sid", F.col("doy").cast("int"), "clim_rows", "clim_n", r4_tie("clim_mean").alias("clim_mean"),
                    r4("clim_std").alias("clim_std"))


@register("seasonal_z", f"""WITH {l_cells()}, {GRID}, {_clim_cte('grid', 15)}, {_seas_cte('grid', 40, 1.6)}
SELECT t, sid, round(seas_z, 4) AS seas_z FROM ss WHERE NOT seas_good""")
def q_seasonal_z(spark, sf):
    g = grid_l(spark, sf)
    s = T.seasonal_zscore(g, T.climatology(g, 15.0), 1.6, 40)
    return s.where(~F.col("seas_good")).select("t", "sid", r4("seas_z").alias("seas_z"))


_LT = dict(window_hours=2400, seasonal_window_hours=360.0, thr=1.6, min_samples=40)


@register("violations", f"""WITH {l_cells()}, {GRID}, {_roll_cte('grid', 1200, 40, 1.6)}, {_clim_cte('grid', 15)},
{_seas_cte('rr', 40, 1.6)}
SELECT sid, t, 'z_score' AS kind, round(v, 4) AS value, NULL::BIGINT AS day_of_year, round(roll_z, 4) AS z
FROM ss WHERE NOT roll_good
UNION ALL
SELECT sid, t, 'seasonal' AS kind, round(v, 4) AS value, doy_s::BIGINT AS day_of_year, round(seas_z, 4) AS z
FROM ss WHERE NOT seas_good""")
def q_violations(spark, sf):
    chk = T.long_term_check(grid_l(spark, sf), **_LT)
    vi = T.violations(chk)
    return vi.select("sid", "t", "kind", r4("value").alias("value"), F.col("day_of_year").cast("long"),
                     r4("z").alias("z"))


@register("long_term_flags", f"""WITH {l_cells()}, {GRID}, {_roll_cte('grid', 1200, 40, 1.6)}, {_clim_cte('grid', 15)},
{_seas_cte('rr', 40, 1.6)}
SELECT sid, count(*)::BIGINT AS n_cells, count(*) FILTER (WHERE NOT roll_good)::BIGINT AS n_roll_bad,
       count(*) FILTER (WHERE NOT seas_good)::BIGINT AS n_seas_bad,
       count(*) FILTER (WHERE roll_good AND seas_good)::BIGINT AS n_good,
       count(CASE WHEN roll_good AND seas_good THEN v END)::BIGINT AS n_valid_next FROM ss GROUP BY sid""")
def q_long_term_flags(spark, sf):
    chk = T.long_term_check(grid_l(spark, sf), **_LT)
    return chk.groupBy("sid").agg(
        F.count(F.lit(1)).cast("long").alias("n_cells"),
        F.count_if(~F.col("roll_good")).cast("long").alias("n_roll_bad"),
        F.count_if(~F.col("seas_good")).cast("long").alias("n_seas_bad"),
        F.count_if("lt_good").cast("long").alias("n_good"),
        F.count(F.when(F.col("lt_good"), F.col("v"))).cast("long").alias("n_valid_next"))


@register("history_span", f"""WITH {l_cells()}, {GRID}
SELECT 'lineitem' AS adapter, floor((epoch(max(t)) - epoch(min(t))) / 86400)::BIGINT AS span_days,
       round(floor((epoch(max(t)) - epoch(min(t))) / 86400) / 365.25, 4) AS span_years,
       floor((epoch(max(t)) - epoch(min(t))) / 86400) / 365.25 >= 5 AS five_years,
       floor((epoch(max(t)) - epoch(min(t))) / 86400) / 365.25 >= 10 AS ten_years FROM grid
UNION ALL
SELECT 'events' AS adapter, floor((epoch(max(t)) - epoch(min(t))) / 86400)::BIGINT,
       round(floor((epoch(max(t)) - epoch(min(t))) / 86400) / 365.25, 4),
       floor((epoch(max(t)) - epoch(min(t))) / 86400) / 365.25 >= 5,
       floor((epoch(max(t)) - epoch(min(t))) / 86400) / 365.25 >= 10
FROM (SELECT date_trunc('hour', ts) AS t FROM events)""")
def q_history_span(spark, sf):
    out = None
    for name, g in (("lineitem", cells_l(spark, sf)), ("events", cells_e(spark, sf))):
        h5 = T.history_span(g, 5.0)
        h = h5.select(F.lit(name).alias("adapter"), "span_days", "span_years", F.col("sufficient").alias("five_years"),
                      (F.col("span_days") / F.lit(365.25) >= F.lit(10.0)).alias("ten_years"))
        out = h if out is None else out.unionByName(h)
    return out


@register("rolling_z_blocks", ORACLE["rolling_z"])
def q_rolling_z_blocks(spark, sf):
    """The rolling test with every station's axis cut into blocks of 15 days with halos."""
    r = T.rolling_zscore(grid_e(spark, sf), 720, 3.0, 300, block_hours=360)
    return r.select("t", "sid", F.col("roll_rows").cast("long"), r4("roll_z").alias("roll_z"), "roll_good")


@register("climatology_moments", ORACLE["climatology"])
def q_climatology_moments(spark, sf):
    """Three deliveries merged into stored moments; the last replaces the values of the second."""
    cells = hourly_cells(M.dealt(X.lineitem_obs(spark, sf)))
    path = f"{ensure_checkpoint_dir(spark)}/moments-{uuid.uuid4().hex}"
    first, second = cells.where("t < '1994-03-01'"), cells.where("t >= '1994-03-01'")
    raw = second.withColumn("v", F.col("v") * 2 + 1)
    M.update_moments(spark, path, first, 0)
    M.update_moments(spark, path, raw, 1)
    M.update_moments(spark, path, second, 2, replaced=raw)
    c = M.stored_climatology(spark, path, 2)
    return c.select("sid", F.col("doy").cast("int"), "clim_rows", "clim_n", r4_tie("clim_mean").alias("clim_mean"),
                    r4("clim_std").alias("clim_std"))
