"""Queries over grid, seasonal and completeness operators (B*, D1-D3, D10-D13, E1, E2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationqc.operators import completeness as C
from stationqc.operators import grid as G
from stationqc.operators.seasonal import seasonal_threshold
from stationqc.params import BATCH_SEASON_LIMITS
from stationqc.plans import reports as R
from stationqc.plans.catalog import cells_e, cells_l, day_str, grid_e, grid_l, month_str, r4, register
from stationqc.plans.sqlfix import GRID, STATIONS, completeness_sql, e_cells, l_cells, season_sql, seasonal_good_sql
from stationqc.session import store
from stationqc.sources import fixtures as X

LIM = BATCH_SEASON_LIMITS


@register("hourly_cells", f"""WITH {e_cells()}
SELECT t, sid, round(v, 4) AS v FROM cells""")
def q_hourly_cells(spark, sf):
    return cells_e(spark, sf).select("t", "sid", r4("v").alias("v"))


@register("dense_grid_counts", f"""WITH {e_cells()}, {GRID}
SELECT sid, count(*)::BIGINT AS n_cells, count(v)::BIGINT AS n_filled, min(t) AS first_t, max(t) AS last_t,
       count(DISTINCT t::DATE)::BIGINT AS n_days FROM grid GROUP BY sid""")
def q_dense_grid_counts(spark, sf):
    g = grid_e(spark, sf)
    return g.groupBy("sid").agg(F.count(F.lit(1)).cast("long").alias("n_cells"),
                                F.count("v").cast("long").alias("n_filled"),
                                F.min("t").alias("first_t"), F.max("t").alias("last_t"),
                                F.count_distinct(F.to_date("t")).cast("long").alias("n_days"))


@register("seasonal_flags", f"""WITH {l_cells()}, {GRID},
f AS (SELECT *, {seasonal_good_sql('v', 't', LIM)} AS good FROM grid)
SELECT sid, {season_sql('t')} AS season,
       count(*)::BIGINT AS n_cells, count(v)::BIGINT AS n_filled,
       count(*) FILTER (WHERE NOT good)::BIGINT AS n_bad FROM f GROUP BY 1, 2""")
def q_seasonal_flags(spark, sf):
    g = G.with_season(seasonal_threshold(grid_l(spark, sf), LIM))
    return g.groupBy("sid", "season").agg(
        F.count(F.lit(1)).cast("long").alias("n_cells"), F.count("v").cast("long").alias("n_filled"),
        F.count_if(~F.col("seasonal_good")).cast("long").alias("n_bad"))


@register("seasonal_daily_valid", f"""WITH {e_cells()}, {GRID},
f AS (SELECT *, {seasonal_good_sql('v', 't', LIM)} AS sgood,
      v IS NOT NULL AND {seasonal_good_sql('v', 't', LIM)} AS flag FROM grid),
{completeness_sql('f', 'flag', 0.1)}
SELECT sid, count(*)::BIGINT AS n_cells, count(v)::BIGINT AS n_filled,
       count(*) FILTER (WHERE NOT sgood)::BIGINT AS n_seasonal_bad,
       count(DISTINCT CASE WHEN day_bad THEN t::DATE END)::BIGINT AS n_days_bad,
       count(*) FILTER (WHERE out)::BIGINT AS n_valid FROM comp GROUP BY sid""")
def q_seasonal_daily_valid(spark, sf):
    """Minimum slice: adapter E -> B1 -> B3 -> D1 -> D10/D12 -> per-station counts."""
    return R.seasonal_daily_valid(grid_e(spark, sf), LIM, 0.1)


@register("dataset_summary", f"""WITH {e_cells()}, {GRID}, {STATIONS}
SELECT count(DISTINCT sid)::BIGINT AS n_stations, count(DISTINCT t)::BIGINT AS n_times,
       min(t) AS first_t, max(t) AS last_t, count(*) FILTER (WHERE v IS NULL)::BIGINT AS missing_cells,
       (SELECT count(*) FROM stations WHERE alt IS NULL)::BIGINT AS stations_no_alt FROM grid""")
def q_dataset_summary(spark, sf):
    cells = cells_e(spark, sf)
    return R.dataset_summary(G.dense_grid(cells), X.station_dim(cells))


@register("timestep_mask", f"""WITH {e_cells()}, {GRID}
SELECT t, round(avg((v IS NOT NULL)::INT), 4) AS share, avg((v IS NOT NULL)::INT) >= 0.09 AS keep_t
FROM grid GROUP BY t""")
def q_timestep_mask(spark, sf):
    g = grid_e(spark, sf).withColumn("filled", F.col("v").isNotNull())
    return C.timestep_completeness(g, "filled", 0.09).select("t", r4("share").alias("share"), "keep_t")


@register("station_mask", f"""WITH {e_cells()}, {GRID}
SELECT sid, round(avg((v IS NOT NULL)::INT), 4) AS share, avg((v IS NOT NULL)::INT) >= 0.09 AS keep_s
FROM grid GROUP BY sid""")
def q_station_mask(spark, sf):
    g = grid_e(spark, sf).withColumn("filled", F.col("v").isNotNull())
    return C.station_completeness(g, "filled", 0.09).select("sid", r4("share").alias("share"), "keep_s")


@register("daily_completeness", f"""WITH {e_cells()}, {GRID},
f AS (SELECT *, v IS NOT NULL AS flag FROM grid), {completeness_sql('f', 'flag', 0.1)}
SELECT sid, strftime(t::DATE, '%Y-%m-%d') AS day, count(*) FILTER (WHERE flag)::BIGINT AS n_good,
       bool_or(day_bad) AS day_bad, bool_or(month_bad) AS month_bad,
       count(*) FILTER (WHERE out)::BIGINT AS n_out FROM comp GROUP BY 1, 2""")
def q_daily_completeness(spark, sf):
    g = grid_e(spark, sf).withColumn("flag", F.col("v").isNotNull())
    c = C.completeness_temporal(g, "flag", 0.1, out="out")
    return c.groupBy("sid", day_str().alias("day")).agg(
        F.count_if("flag").cast("long").alias("n_good"), F.bool_or("day_bad").alias("day_bad"),
        F.bool_or("month_bad").alias("month_bad"), F.count_if("out").cast("long").alias("n_out"))


@register("monthly_completeness", f"""WITH {l_cells()}, {GRID},
f AS (SELECT *, v IS NOT NULL AS flag FROM grid), {completeness_sql('f', 'flag', 0.2)}
SELECT sid, strftime(t, '%Y-%m') AS month, count(*)::BIGINT AS n_rows,
       bool_or(month_bad) AS month_bad, count(*) FILTER (WHERE day_bad)::BIGINT AS n_day_bad,
       count(*) FILTER (WHERE out)::BIGINT AS n_out FROM comp GROUP BY 1, 2""")
def q_monthly_completeness(spark, sf):
    cells = store(cells_l(spark, sf))
    axis = store(G.time_axis(cells))
    g = G.dense_grid(cells, axis, parts=G.grid_parts(cells, axis)).withColumn("flag", F.col("v").isNotNull())
    c = C.completeness_temporal(g, "flag", 0.2, out="out", months=C.axis_months(axis))
    return c.groupBy("sid", month_str().alias("month")).agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"), F.bool_or("month_bad").alias("month_bad"),
        F.count_if("day_bad").cast("long").alias("n_day_bad"), F.count_if("out").cast("long").alias("n_out"))


@register("completeness_stats", f"""WITH {l_cells()}, {GRID},
f AS (SELECT *, v IS NOT NULL AS flag FROM grid), {completeness_sql('f', 'flag', 0.2)},
sd AS (SELECT sid, t::DATE AS day, bool_or(day_bad) AS db FROM comp GROUP BY 1, 2),
sm AS (SELECT sid, year(t) * 12 + month(t) AS mk, bool_or(month_bad) AS mb FROM comp GROUP BY 1, 2)
SELECT (SELECT count(*) FROM sd WHERE db)::BIGINT AS days_flagged,
       (SELECT count(*) FROM sm WHERE mb)::BIGINT AS months_flagged,
       (SELECT count(DISTINCT sid) FROM sd WHERE db)::BIGINT AS stations_with_flagged_days,
       (SELECT count(DISTINCT sid) FROM sm WHERE mb)::BIGINT AS stations_with_flagged_months,
       (SELECT count(*) FROM comp WHERE out)::BIGINT AS n_out""")
def q_completeness_stats(spark, sf):
    g = grid_l(spark, sf).withColumn("flag", F.col("v").isNotNull())
    return C.completeness_stats(C.station_days(g, "flag", 0.2), out=True)


@register("all_true_completeness", f"""WITH {e_cells()}, {GRID},
f AS (SELECT *, true AS flag FROM grid), {completeness_sql('f', 'flag', 0.8)}
SELECT sid, count(*)::BIGINT AS n_cells, count(*) FILTER (WHERE out)::BIGINT AS n_qc_true,
       count(CASE WHEN out THEN v END)::BIGINT AS n_valid FROM comp GROUP BY sid""")
def q_all_true_completeness(spark, sf):
    out = C.apply_completeness(grid_e(spark, sf), 0.8)
    return out.groupBy("sid").agg(F.count(F.lit(1)).cast("long").alias("n_cells"),
                                  F.count_if("qc_flags").cast("long").alias("n_qc_true"),
                                  F.count("v").cast("long").alias("n_valid"))


def _seasonal_summary_sql(cells_cte):
    from stationqc.plans.sqlfix import season_sql
    return f"""WITH {cells_cte}, {GRID},
s AS (SELECT {season_sql('t')} AS season, * FROM grid),
per AS (SELECT season, count(DISTINCT CASE WHEN v IS NOT NULL THEN sid END)::BIGINT AS active_stations,
        round(100.0 * count(v) / count(*), 2) AS completeness_pct, count(DISTINCT t)::BIGINT AS n_times,
        min(t) AS first_t, max(t) AS last_t FROM s GROUP BY season),
names AS (SELECT * FROM (VALUES ('DJF'), ('MAM'), ('JJA'), ('SON')) v(season))
SELECT n.season, coalesce(p.active_stations, 0)::BIGINT AS active_stations, p.completeness_pct,
       coalesce(p.n_times, 0)::BIGINT AS n_times, p.first_t, p.last_t,
       CASE WHEN p.season IS NULL THEN 'no data' ELSE 'ok' END AS status
FROM names n LEFT JOIN per p ON p.season = n.season"""


@register("seasonal_summary", _seasonal_summary_sql(l_cells()))
def q_seasonal_summary(spark, sf):
    return R.seasonal_summary(grid_l(spark, sf))


@register("seasonal_summary_events", _seasonal_summary_sql(e_cells()))
def q_seasonal_summary_events(spark, sf):
    return R.seasonal_summary(grid_e(spark, sf))


@register("time_slice", f"""WITH {e_cells()}, {GRID}
SELECT sid, count(*)::BIGINT AS n_cells, count(v)::BIGINT AS n_filled, min(t) AS first_t, max(t) AS last_t
FROM grid WHERE t BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 23:00:00' GROUP BY sid""")
def q_time_slice(spark, sf):
    cells, (lo, hi) = cells_e(spark, sf), ("2024-01-10 00:00:00", "2024-01-20 23:00:00")
    g = G.dense_slice(cells, lo, hi)
    return g.groupBy("sid").agg(F.count(F.lit(1)).cast("long").alias("n_cells"),
                                F.count("v").cast("long").alias("n_filled"),
                                F.min("t").alias("first_t"), F.max("t").alias("last_t"))


@register("timeframe_label", f"""WITH {e_cells()}, {GRID}
SELECT 'full' AS kind, strftime(min(t), '%Y%m%d_%H%M') || '_' || strftime(max(t), '%Y%m%d_%H%M') AS label FROM grid
UNION ALL
SELECT 'selection' AS kind, '20240110_20240120' AS label FROM grid
WHERE t BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 23:00:00' HAVING count(*) > 0""")
def q_timeframe_label(spark, sf):
    g = cells_e(spark, sf)   # the first and last cell are those of the dense grid
    full = G.timeframe(g).select(F.lit("full").alias("kind"), "label")
    sel = G.timeframe(g, "2024-01-10 00:00:00", "2024-01-20 23:00:00")
    return full.unionByName(sel.select(F.lit("selection").alias("kind"), "label"))


@register("drop_empty_stations", f"""WITH {e_cells()}, {GRID},
f AS (SELECT *, v IS NOT NULL AS flag FROM grid), {completeness_sql('f', 'flag', 0.25)},
m AS (SELECT sid, t, CASE WHEN out THEN v END AS v FROM comp),
keep AS (SELECT DISTINCT sid FROM m WHERE v IS NOT NULL)
SELECT sid, count(*)::BIGINT AS n_cells, count(v)::BIGINT AS n_valid FROM m WHERE sid IN (SELECT sid FROM keep)
GROUP BY sid""")
def q_drop_empty_stations(spark, sf):
    g = grid_e(spark, sf).withColumn("flag", F.col("v").isNotNull())
    c = C.completeness_temporal(g, "flag", 0.25, out="out")
    m = G.apply_mask(c, "out").select("sid", "t", "v")
    kept = G.drop_empty_stations(m)
    return kept.groupBy("sid").agg(F.count(F.lit(1)).cast("long").alias("n_cells"),
                                   F.count("v").cast("long").alias("n_valid"))
