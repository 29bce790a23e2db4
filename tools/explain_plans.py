"""Write the physical plans of the headline operators to PLANS.md (long
expressions truncated).  Usage: python tools/explain_plans.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def compact(plan: str, width: int = 150) -> str:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        out.append(line if len(line) <= width else line[:width] + " ...")
    return "\n".join(out)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from stationqc.operators import adaptive as A
    from stationqc.operators import completeness as C
    from stationqc.operators import grid as G
    from stationqc.operators import moments as M
    from stationqc.operators import runs as R
    from stationqc.operators import temporal as T
    from stationqc.operators.buddy import buddy_check
    from stationqc.operators.spatial_rounds import settle_round, settling
    from stationqc.operators.spatial import sct
    from stationqc.params import GREEDY, SEQUENTIAL_BUDDY
    from stationqc.session import get_spark
    from stationqc.sources import fixtures as X

    spark = get_spark()
    cells = G.hourly_cells(X.events_obs(spark, sf))
    grid = G.dense_grid(cells)
    st = X.station_dim(cells)
    gl = G.dense_grid(G.hourly_cells(X.lineitem_obs(spark, sf)))
    cl = G.hourly_cells(X.lineitem_obs(spark, sf))
    near = "array<struct<dist: double, j: bigint, da: double, here: bigint, v: array<double>>>"
    heirs = "array<struct<i: bigint, to_level: int, to_part: int, inner: boolean, outer: boolean>>"
    lists = spark.createDataFrame([], f"sid long, block int, n_outer long, heirs {heirs}, here long, tf long, v array<double>, near {near}")
    sent = spark.createDataFrame([], "block int, i long, j long, gone bigint, blocked bigint")
    plans = {
        "hourly cells (B1)": cells,
        "dense grid by gap filling (B3)": grid,
        "buddy check (D4)": buddy_check(grid, st, SEQUENTIAL_BUDDY),
        "greedy spatial test, general scan (D7)": sct(X.fill_rule(grid), st, GREEDY, plan="general"),
        "greedy spatial test, one dependency round (D7)": settle_round(lists, sent, settling(GREEDY, False)),
        "completeness counters on run-length cells (D12)": R.completeness_counters(R.run_grid(cl), 0.2),
        "rolling z-score in blocks with halos (D14)": T.rolling_zscore(grid, 720, 3.0, 300, block_hours=1440),
        "climatology from stored moments (D15)": M.climatology_of(M.day_moments(cl), M.axis_days(cl), cl.select("sid").distinct()),
        "radius pairs with adaptive cells (C3)": A.adaptive_pairs(st, "lon", "lat", 0.04),
        "daily/monthly completeness (D12)": C.completeness_temporal(gl.withColumn("f", F.col("v").isNotNull()), "f", 0.2),
        "rolling z-score (D14)": T.rolling_zscore(grid, 720, 3.0, 300),
        "climatology + seasonal z (D15, D16)": T.seasonal_zscore(gl, T.climatology(gl, 15.0), 1.6, 40),
    }
    parts = ["# Physical plans of the headline operators",
             "",
             f"Generated by `tools/explain_plans.py` at `{sf}` (local session, AQE on; the final",
             "adaptive plan may replace shuffle joins by broadcasts at run time). Long expressions are cut.", ""]
    for name, df in plans.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        parts += [f"## {name}", "", "```", compact(plan), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(parts))


if __name__ == "__main__":
    main()
