"""Query over change propagation (D20-D22): flags of some rules after a change, spliced, against the full run."""

from __future__ import annotations

from pyspark.sql import functions as F

from stationqc.functions.columns import month_key
from stationqc.operators import runs as R
from stationqc.operators.buddy import buddy_check
from stationqc.operators.grid import dense_grid, grid_parts, time_axis
from stationqc.operators.temporal import rolling_zscore, temporal_step
from stationqc.params import BuddyParams
from stationqc.plans import propagate as P
from stationqc.plans.catalog import cells_l, register
from stationqc.plans.sqlfix import GRID, STATIONS, buddy_ctes, completeness_sql, l_cells, proj_cte
from stationqc.session import store
from stationqc.sources import fixtures as X

STEP, WINDOW, Z, SAMPLES, SHARE = 30.0, 2400, 1.6, 40, 0.04
BUDDY = BuddyParams(radius=5000.0, num_min=3, threshold=3.0, max_elev_diff=400.0, elev_gradient=-0.0065)
MONTHS = (1995 * 12 + 2, 1996 * 12 + 6)      # March 1995 and July 1996


def change(t: str = "t", v: str = "v"):
    """Every tenth station, in two months: every third day is lost, the other values rise."""
    hit = (F.col("sid") % 10 == 1) & month_key(t).isin(*MONTHS)
    return F.when(hit & (F.dayofmonth(t) % 3 == 0), F.lit(None)).when(hit, F.col(v) + 7.0).otherwise(F.col(v))


@register("propagated_flags", f"""WITH {l_cells()}, {GRID}, {STATIONS}, {proj_cte()},
n AS (SELECT t, sid, CASE WHEN sid % 10 = 1 AND year(t) * 12 + month(t) - 1 IN {MONTHS}
      THEN CASE WHEN day(t) % 3 <> 0 THEN v + 7.0 END ELSE v END AS v FROM grid),
f AS (SELECT *, v IS NOT NULL AS flag,
      coalesce(abs(v - lag(v) OVER (PARTITION BY sid ORDER BY t)) > {STEP}, false)
      OR coalesce(abs(v - lead(v) OVER (PARTITION BY sid ORDER BY t)) > {STEP}, false) AS step,
      count(*) OVER w AS rows, avg(v) OVER w AS m, stddev_pop(v) OVER w AS s
      FROM n WINDOW w AS (PARTITION BY sid ORDER BY t RANGE BETWEEN INTERVAL {WINDOW // 2} HOURS PRECEDING
                          AND INTERVAL {WINDOW // 2} HOURS FOLLOWING)),
{completeness_sql('f', 'flag', SHARE)},
{buddy_ctes('n', 'v', BUDDY, 'kb')}
SELECT c.sid, count(*) FILTER (WHERE c.step)::BIGINT AS n_step,
       count(*) FILTER (WHERE coalesce(abs(CASE WHEN c.rows >= {SAMPLES} THEN (c.v - c.m) / nullif(c.s, 0) END) > {Z}, false))::BIGINT AS n_roll_bad,
       count(*) FILTER (WHERE kb.bs)::BIGINT AS n_buddy, count(*) FILTER (WHERE c.out)::BIGINT AS n_out
FROM comp c JOIN kb ON kb.t = c.t AND kb.sid = c.sid GROUP BY c.sid""")
def q_propagated_flags(spark, sf):
    """Flags stored before a change, with what the change can reach done again and spliced in."""
    held = R.run_grid(cells_l(spark, sf).where("t IS NOT NULL"))
    axis = store(time_axis(held.cells))
    parts = grid_parts(held.cells, axis)
    # the grids lie by station in so many parts, and so do all flags: they are made from the stored cells wherever they are read
    old = dense_grid(held.cells, axis, parts=parts)
    new = old.withColumn("v", change())
    stations = store(X.station_dim(held.cells))
    changes = store(P.changed_months(old, new))
    stored = (temporal_step(old, STEP, parts=parts).select("t", "sid", "step_suspect"),
              rolling_zscore(old, WINDOW, Z, SAMPLES, parts=parts).select("t", "sid", "roll_good"),
              buddy_check(old, stations, BUDDY, parts=parts).select("t", "sid", "buddy_suspect"))
    redone = (P.redo_step(new, axis, changes, STEP, parts), P.redo_rolling(new, axis, changes, WINDOW, Z, SAMPLES, parts),
              P.redo_buddy(new, stations, changes, BUDDY, parts))
    step, roll, buddy = (P.splice(a, b, parts=parts) for a, b in zip(stored, redone))
    days = P.splice(R.station_days(held, SHARE, parts=parts).select("sid", "day", "n_out"),
                    P.redo_completeness(held, new.where("v IS NOT NULL"), changes, SHARE, parts), ("sid", "day"), parts)
    return (step.groupBy("sid").agg(F.count_if("step_suspect").alias("n_step"))
            .join(roll.groupBy("sid").agg(F.count_if(~F.col("roll_good")).alias("n_roll_bad")), "sid")
            .join(buddy.groupBy("sid").agg(F.count_if("buddy_suspect").alias("n_buddy")), "sid")
            .join(days.groupBy("sid").agg(F.sum("n_out").alias("n_out")), "sid"))
