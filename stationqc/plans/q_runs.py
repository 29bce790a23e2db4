"""Queries over run-length cells: the rules of the dense grid without the grid.

Each has the SQL of the query over the dense grid.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stationqc.operators import runs as R
from stationqc.operators.grid import time_axis
from stationqc.plans.catalog import ORACLE, cells_e, cells_l, day_str, r4, register
from stationqc.plans.sqlfix import GRID, e_cells
from stationqc.sources import fixtures as X


@register("timestep_mask_runs", ORACLE["timestep_mask"])
def q_timestep_mask_runs(spark, sf):
    g = R.run_grid(cells_e(spark, sf))
    return R.timestep_share(g, 0.09).select("t", r4("share").alias("share"), "keep_t")


@register("station_mask_runs", ORACLE["station_mask"])
def q_station_mask_runs(spark, sf):
    g = R.run_grid(cells_e(spark, sf))
    return R.station_share(g, 0.09).select("sid", r4("share").alias("share"), "keep_s")


@register("daily_completeness_runs", ORACLE["daily_completeness"])
def q_daily_completeness_runs(spark, sf):
    d = R.station_days(R.run_grid(cells_e(spark, sf)), 0.1)
    return d.select("sid", day_str("day").alias("day"), "n_good", "day_bad", "month_bad", "n_out")


@register("monthly_completeness_runs", ORACLE["monthly_completeness"])
def q_monthly_completeness_runs(spark, sf):
    m = R.station_months(R.run_grid(cells_l(spark, sf)), 0.2)
    month = F.format_string("%04d-%02d", F.floor(F.col("mk") / 12).cast("int"), (F.col("mk") % 12 + 1).cast("int"))
    return m.select("sid", month.alias("month"), "n_rows", "month_bad", F.col("n_rows_day_bad").cast("long").alias("n_day_bad"), "n_out")


@register("completeness_stats_runs", ORACLE["completeness_stats"])
def q_completeness_stats_runs(spark, sf):
    return R.completeness_counters(R.run_grid(cells_l(spark, sf)), 0.2)


@register("all_true_completeness_runs", ORACLE["all_true_completeness"])
def q_all_true_completeness_runs(spark, sf):
    return R.valid_after_completeness(R.run_grid(cells_e(spark, sf)), 0.8)


@register("dataset_summary_runs", ORACLE["dataset_summary"])
def q_dataset_summary_runs(spark, sf):
    cells = cells_e(spark, sf)
    return R.dataset_summary(R.run_grid(cells), X.station_dim(cells))


@register("seasonal_summary_runs", ORACLE["seasonal_summary"])
def q_seasonal_summary_runs(spark, sf):
    return R.seasonal_summary(R.run_grid(cells_l(spark, sf)))


@register("run_lengths", f"""WITH {e_cells()}, {GRID},
m AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY t) - row_number() OVER (PARTITION BY sid, v IS NULL ORDER BY t) AS island FROM grid),
r AS (SELECT sid, island, count(*) AS n FROM m WHERE v IS NULL GROUP BY sid, island)
SELECT g.sid, count(*)::BIGINT AS n_cells, count(g.v)::BIGINT AS n_filled,
       (SELECT count(*) FROM r WHERE r.sid = g.sid)::BIGINT AS n_gaps,
       (SELECT coalesce(max(n), 0) FROM r WHERE r.sid = g.sid)::BIGINT AS longest_gap FROM grid g GROUP BY g.sid""")
def q_run_lengths(spark, sf):
    """The dense grid as runs: cells, filled cells, gaps and the longest gap per station."""
    runs = R.to_runs(cells_e(spark, sf))
    length = F.col("last") - F.col("first") + 1
    return runs.groupBy("sid").agg(F.sum(length).alias("n_cells"), F.count("v").alias("n_filled"),
                                   F.count_if(F.col("v").isNull()).alias("n_gaps"),
                                   F.coalesce(F.max(F.when(F.col("v").isNull(), length)), F.lit(0)).alias("longest_gap"))


@register("expanded_runs", f"""WITH {e_cells()}, {GRID}
SELECT t, sid, round(v, 4) AS v FROM grid""")
def q_expanded_runs(spark, sf):
    cells = cells_e(spark, sf)
    return R.expand_runs(R.to_runs(cells), time_axis(cells)).select("t", "sid", r4("v").alias("v"))
