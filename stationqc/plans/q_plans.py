"""Queries over the composed plans."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stationqc.operators import grid as G
from stationqc.operators.seasonal import seasonal_threshold
from stationqc.operators.temporal import temporal_step
from stationqc.params import (BATCH_SCT, GREEDY, BATCH_SEASON_LIMITS, SEQUENTIAL_BUDDY, SEQUENTIAL_SCT,
                              SEQUENTIAL_SEASON_LIMITS, BuddyParams, LongTermParams)
from stationqc.plans import qc as Q
from stationqc.plans.catalog import grid_e, grid_f, register
from stationqc.plans.sqlfix import (FGRID, GRID, STATIONS, buddy_ctes, completeness_counters_sql,
                                    completeness_sql, e_cells, greedy_ctes, proj_cte, sct_closed_ctes,
                                    seasonal_good_sql)
from stationqc.session import ensure_checkpoint_dir
from stationqc.sources import fixtures as X

BATCH_LIMITS = dict(BATCH_SEASON_LIMITS, DJF=(6.0, 18.0))
BATCH_BUDDY_F = BuddyParams(radius=5000.0, num_min=3, threshold=3.0, max_elev_diff=400.0, elev_gradient=-0.0065)
OVERLAY_F = LongTermParams(window_hours=720, seasonal_window_hours=360.0, z_threshold=2.0, min_samples=300)

def _batch_ctes(sct_part: str) -> str:
    return f"""{e_cells()}, {GRID}, {FGRID}, {STATIONS}, {proj_cte()},
s AS (SELECT t, sid, v, {seasonal_good_sql('v', 't', BATCH_LIMITS)} AS sg FROM fgrid),
tm AS (SELECT t, avg(sg::INT) >= 0.8 AS keep_t FROM s GROUP BY t),
k AS (SELECT s.* FROM s JOIN tm ON tm.t = s.t WHERE tm.keep_t),
{buddy_ctes('k', 'v', BATCH_BUDDY_F, 'kb')},
{sct_part},
kc AS (SELECT *, sg AND NOT bs AND NOT sct_flag AS comb FROM ks),
sm AS (SELECT sid, avg(comb::INT) >= 0.8 AS keep_s FROM kc GROUP BY sid),
fin AS (SELECT s.*, coalesce(kc.comb AND sm.keep_s, false) AS fg, kc.bs, kc.sct_flag, tm.keep_t, sm.keep_s,
        CASE WHEN coalesce(kc.comb AND sm.keep_s, false) THEN s.v END AS v_qc
        FROM s LEFT JOIN kc ON kc.t = s.t AND kc.sid = s.sid LEFT JOIN tm ON tm.t = s.t LEFT JOIN sm ON sm.sid = s.sid)"""


_BATCH_CTES = _batch_ctes(sct_closed_ctes("kb", "v", BATCH_SCT, False, "ks"))
_BATCH_GREEDY_CTES = _batch_ctes(
    greedy_ctes("kb", "v", GREEDY, False, "gk")
    + ",\nks AS (SELECT kb.*, coalesce(gk.sct_flag, false) AS sct_flag FROM kb LEFT JOIN gk"
    " ON gk.t = kb.t AND gk.sid = kb.sid)")


def _batch(spark, sf):
    g = grid_f(spark, sf)
    st = X.stations_e(spark, sf)
    return Q.batch_qc(g, st, BATCH_LIMITS, BATCH_BUDDY_F, BATCH_SCT, 0.8)


@register("batch_stats", f"""WITH {_BATCH_CTES}
SELECT count(*)::BIGINT AS total_values, count(*) FILTER (WHERE fg)::BIGINT AS good_values,
       (count(DISTINCT sid) - count(DISTINCT CASE WHEN keep_s THEN sid END))::BIGINT AS stations_removed,
       (count(DISTINCT t) - count(DISTINCT CASE WHEN keep_t THEN t END))::BIGINT AS timesteps_removed,
       count(*) FILTER (WHERE NOT sg)::BIGINT AS seasonal_flags, count(*) FILTER (WHERE bs)::BIGINT AS buddy_flags,
       count(*) FILTER (WHERE sct_flag)::BIGINT AS sct_flags FROM fin""")
def q_batch_stats(spark, sf):
    return _batch(spark, sf).stats


_BATCH_STATS_SELECT = """SELECT count(*)::BIGINT AS total_values, count(*) FILTER (WHERE fg)::BIGINT AS good_values,
       (count(DISTINCT sid) - count(DISTINCT CASE WHEN keep_s THEN sid END))::BIGINT AS stations_removed,
       (count(DISTINCT t) - count(DISTINCT CASE WHEN keep_t THEN t END))::BIGINT AS timesteps_removed,
       count(*) FILTER (WHERE NOT sg)::BIGINT AS seasonal_flags, count(*) FILTER (WHERE bs)::BIGINT AS buddy_flags,
       count(*) FILTER (WHERE sct_flag)::BIGINT AS sct_flags FROM fin"""


@register("batch_stats_greedy", f"WITH RECURSIVE {_BATCH_GREEDY_CTES}\n{_BATCH_STATS_SELECT}")
def q_batch_stats_greedy(spark, sf):
    """Batch QC with the general (order-dependent) spatial scan on the kept times."""
    g = grid_f(spark, sf)
    st = X.stations_e(spark, sf)
    return Q.batch_qc(g, st, BATCH_LIMITS, BATCH_BUDDY_F, GREEDY, 0.8, sct_plan="general").stats


@register("batch_masks", f"""WITH {_BATCH_CTES}
SELECT sid, coalesce(bool_or(keep_s), false) AS keep_s, count(*) FILTER (WHERE fg)::BIGINT AS n_good,
       count(*) FILTER (WHERE keep_t)::BIGINT AS n_kept_times FROM fin GROUP BY sid""")
def q_batch_masks(spark, sf):
    r = _batch(spark, sf).grid
    return r.groupBy("sid").agg(F.coalesce(F.bool_or("keep_s"), F.lit(False)).alias("keep_s"),
                                F.count_if("final_good").cast("long").alias("n_good"),
                                F.count_if("keep_t").cast("long").alias("n_kept_times"))


@register("valid_percent", f"""WITH {_BATCH_CTES},
per AS (SELECT sid, count(*) AS n, count(v_qc) AS nv FROM fin GROUP BY sid HAVING count(v_qc) > 0)
SELECT count(*)::BIGINT AS stations_left, coalesce(sum(nv), 0)::BIGINT AS valid_values,
       coalesce(sum(n), 0)::BIGINT AS cells_left, round(100.0 * sum(nv) / sum(n), 2) AS valid_pct FROM per""")
def q_valid_percent(spark, sf):
    return Q.valid_percent(_batch(spark, sf))


_SEQ_CTES = f"""{e_cells()}, {GRID}, {FGRID}, {STATIONS}, {proj_cte()},
l0 AS (SELECT t, sid, v AS t_lvl0 FROM fgrid),
l1a AS (SELECT *, {seasonal_good_sql('t_lvl0', 't', SEQUENTIAL_SEASON_LIMITS)} AS seasonal_ok FROM l0),
l1b AS (SELECT *, CASE WHEN seasonal_ok THEN t_lvl0 END AS t_lvl1 FROM l1a),
{completeness_sql('l1b', 'seasonal_ok', 0.8, 'c1')},
l1 AS (SELECT t, sid, t_lvl0, seasonal_ok, out AS t_lvl1_flag, CASE WHEN out THEN t_lvl1 END AS t_lvl1 FROM c1),
el2 AS (SELECT t, count(t_lvl1) >= {SEQUENTIAL_BUDDY.num_min} AS el FROM l1 GROUP BY t),
{buddy_ctes('l1', 't_lvl1', SEQUENTIAL_BUDDY, 'b2')},
l2a AS (SELECT b2.*, NOT (el2.el AND b2.bs) AS buddy_ok FROM b2 JOIN el2 ON el2.t = b2.t),
l2b AS (SELECT * EXCLUDE (bs), CASE WHEN buddy_ok THEN t_lvl1 END AS t_lvl2 FROM l2a),
{completeness_sql('l2b', 'buddy_ok', 0.8, 'c2')},
l2 AS (SELECT * EXCLUDE (out, day_bad, month_bad, t_lvl2), out AS t_lvl2_flag,
       CASE WHEN out THEN t_lvl2 END AS t_lvl2 FROM c2),
el3 AS (SELECT t, count(t_lvl2) >= {SEQUENTIAL_SCT.num_min} AS el FROM l2 GROUP BY t),
{sct_closed_ctes('l2', 't_lvl2', SEQUENTIAL_SCT, True, 's3')},
l3a AS (SELECT s3.* EXCLUDE (sct_flag, temporal_flag), NOT (el3.el AND s3.sct_flag) AS sct_ok,
        NOT (el3.el AND s3.temporal_flag) AS temporal_ok FROM s3 JOIN el3 ON el3.t = s3.t),
l3b AS (SELECT *, sct_ok AND temporal_ok AS l3_ok, CASE WHEN sct_ok AND temporal_ok THEN t_lvl2 END AS t_lvl3 FROM l3a),
{completeness_sql('l3b', 'l3_ok', 0.8, 'c3')},
l3 AS (SELECT * EXCLUDE (out, day_bad, month_bad, t_lvl3), out AS t_lvl3_flag,
       CASE WHEN out THEN t_lvl3 END AS t_lvl3 FROM c3)"""


def _seq(spark, sf, checkpoint=True):
    g = grid_f(spark, sf)
    st = X.stations_e(spark, sf)
    return Q.sequential_qc(g, st, SEQUENTIAL_SEASON_LIMITS, SEQUENTIAL_BUDDY, SEQUENTIAL_SCT, 0.8,
                           checkpoint=checkpoint)


_LEVEL_STATS_SELECT = f"""SELECT (SELECT count(*) FROM l3)::BIGINT AS total_values,
(SELECT count(t_lvl0) FROM l3)::BIGINT AS t_lvl0_valid, (SELECT count(t_lvl1) FROM l3)::BIGINT AS t_lvl1_valid,
(SELECT count(t_lvl2) FROM l3)::BIGINT AS t_lvl2_valid, (SELECT count(t_lvl3) FROM l3)::BIGINT AS t_lvl3_valid,
(SELECT count(*) FILTER (WHERE NOT seasonal_ok) FROM l3)::BIGINT AS seasonal_flags,
(SELECT count(*) FILTER (WHERE NOT buddy_ok) FROM l3)::BIGINT AS buddy_flags,
(SELECT count(*) FILTER (WHERE NOT sct_ok) FROM l3)::BIGINT AS sct_flags,
(SELECT count(*) FILTER (WHERE NOT temporal_ok) FROM l3)::BIGINT AS temporal_flags,
{completeness_counters_sql('c1', 1)},
{completeness_counters_sql('c2', 2)},
{completeness_counters_sql('c3', 3)}"""


@register("level_stats", f"WITH {_SEQ_CTES}\n{_LEVEL_STATS_SELECT}")
def q_level_stats(spark, sf):
    return _seq(spark, sf).stats


@register("level_report", f"""WITH {_SEQ_CTES},
tot AS (SELECT count(*) AS n FROM l3),
long AS (SELECT sid, t, 't_lvl0' AS level, t_lvl0 AS v FROM l3 UNION ALL SELECT sid, t, 't_lvl1', t_lvl1 FROM l3
       UNION ALL SELECT sid, t, 't_lvl2', t_lvl2 FROM l3 UNION ALL SELECT sid, t, 't_lvl3', t_lvl3 FROM l3)
SELECT level, count(v)::BIGINT AS valid, round(100.0 * count(v) / (SELECT n FROM tot), 2) AS pct, count(DISTINCT t)::BIGINT AS n_times,
       count(DISTINCT sid)::BIGINT AS n_stations, count(DISTINCT CASE WHEN v IS NOT NULL THEN sid END)::BIGINT AS stations_with_values
FROM long GROUP BY level""")
def q_level_report(spark, sf):
    return Q.level_report(_seq(spark, sf))


_OVERLAY_CTES = f"""{_SEQ_CTES},
r0 AS (SELECT *, count(*) OVER w AS roll_rows, avg(t_lvl3) OVER w AS m, stddev_pop(t_lvl3) OVER w AS s
       FROM l3 WINDOW w AS (PARTITION BY sid ORDER BY t RANGE BETWEEN INTERVAL 360 HOURS PRECEDING
       AND INTERVAL 360 HOURS FOLLOWING)),
rr AS (SELECT *, NOT coalesce(abs(CASE WHEN roll_rows >= 300 THEN (t_lvl3 - m) / nullif(s, 0) END) > 2.0, false)
       AS roll_good FROM r0),
g2 AS (SELECT sid, t, t_lvl3 AS v, dayofyear(t) AS doy FROM l3),
targets AS (SELECT range::INT AS doy_t FROM range(1, 367)),
clim AS (SELECT g2.sid, tg.doy_t AS doy, count(*) AS clim_rows, sum(g2.v) / nullif(count(g2.v), 0) AS clim_mean,
         stddev_pop(g2.v) AS clim_std FROM targets tg JOIN g2
         ON least(abs(g2.doy - tg.doy_t), 366 - abs(g2.doy - tg.doy_t)) <= 15 GROUP BY 1, 2),
ss AS (SELECT rr.*, NOT coalesce(abs(CASE WHEN c.clim_rows >= 300 THEN (rr.t_lvl3 - c.clim_mean) / nullif(c.clim_std, 0)
       END) > 2.0, false) AS seas_good FROM rr LEFT JOIN clim c ON c.sid = rr.sid AND c.doy = dayofyear(rr.t))"""


@register("overlay_level", f"""WITH {_OVERLAY_CTES}
SELECT 't_lvl4' AS new_level, count(*)::BIGINT AS cells,
       count(CASE WHEN roll_good AND seas_good THEN t_lvl3 END)::BIGINT AS valid_values FROM ss""")
def q_overlay_level(spark, sf):
    return Q.temporal_overlay(_seq(spark, sf).grid, OVERLAY_F).stats


@register("overlay_dataset", f"""WITH {_OVERLAY_CTES}
SELECT sid, count(*)::BIGINT AS n_cells, count(CASE WHEN roll_good AND seas_good THEN t_lvl3 END)::BIGINT AS n_valid,
       't_lvl4' AS new_level, {OVERLAY_F.window_hours}::BIGINT AS window_hours, {OVERLAY_F.z_threshold!r}::DOUBLE AS z_threshold,
       {OVERLAY_F.min_samples}::BIGINT AS min_samples FROM ss GROUP BY sid""")
def q_overlay_dataset(spark, sf):
    """The overlay written as a dataset and read back: its values and the parameters stored with them."""
    path = f"{ensure_checkpoint_dir(spark)}/overlay-{uuid.uuid4().hex}"
    Q.write_overlay(Q.temporal_overlay(_seq(spark, sf).grid, OVERLAY_F), path)
    meta = spark.read.parquet(f"{path}/dataset_meta").first()
    data = spark.read.parquet(f"{path}/data").groupBy("sid").agg(F.count(F.lit(1)).alias("n_cells"), F.count(meta["new_level"]).alias("n_valid"))
    return data.select("*", F.lit(meta["new_level"]).alias("new_level"), F.lit(meta["temporal_window_hours"]).cast("long").alias("window_hours"),
                       F.lit(meta["temporal_z_threshold"]).alias("z_threshold"), F.lit(meta["temporal_min_samples"]).cast("long").alias("min_samples"))


@register("mask_any", f"""WITH {e_cells()}, {GRID},
f AS (SELECT *, NOT {seasonal_good_sql('v', 't', BATCH_LIMITS)} AS seasonal_bad,
      coalesce(abs(v - lag(v) OVER (PARTITION BY sid ORDER BY t)) > 3.0, false)
      OR coalesce(abs(v - lead(v) OVER (PARTITION BY sid ORDER BY t)) > 3.0, false) AS step_bad FROM grid)
SELECT sid, count(*) FILTER (WHERE seasonal_bad OR step_bad)::BIGINT AS n_any_flag,
       count(CASE WHEN NOT (seasonal_bad OR step_bad) THEN v END)::BIGINT AS n_valid FROM f GROUP BY sid""")
def q_mask_any(spark, sf):
    g = seasonal_threshold(grid_e(spark, sf), BATCH_LIMITS).withColumn("seasonal_bad", ~F.col("seasonal_good"))
    g = temporal_step(g, 3.0, out="step_bad")
    m = G.mask_any(g, ["seasonal_bad", "step_bad"])
    return m.groupBy("sid").agg(F.count_if("any_flag").cast("long").alias("n_any_flag"),
                                F.count("v_masked").cast("long").alias("n_valid"))
