"""Headline-query benchmark: prints one JSON line.

Runs the survey's bench set through adapters E (one station per user) and L at ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``: buddy check, general
greedy spatial test, temporal completeness, rolling z-score, climatology +
seasonal z-score, batch QC and sequential QC.  Each query is run once to warm
up and then ``$BENCH_REPEATS`` times; the median is reported; the grids are built
once (one run, counted in the total).  Every run
executes the whole plan (``noop`` sink or a collected aggregate).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))

    from pyspark.sql import functions as F

    from stationqc.operators import completeness as C
    from stationqc.operators import grid as G
    from stationqc.operators import temporal as T
    from stationqc.operators.buddy import buddy_check
    from stationqc.operators.spatial import sct
    from stationqc.params import BATCH_SCT, GREEDY, SEQUENTIAL_BUDDY, SEQUENTIAL_SCT, SEQUENTIAL_SEASON_LIMITS
    from stationqc.plans import qc as Q
    from stationqc.plans.q_plans import BATCH_BUDDY_F, BATCH_LIMITS
    from stationqc.session import cut_lineage, ensure_checkpoint_dir, get_spark
    from stationqc.sources import fixtures as X
    from stationqc.sources.files import read_grid, write_grid

    spark = get_spark(f"local[{cpus}]", "stationqc-bench", int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    ensure_checkpoint_dir(spark, default=tempfile.mkdtemp(prefix="bench-ckpt-", dir="/tmp"))

    # The grids are built once from the raw tables and stored as Parquet in the
    # shared checkpoint folder (the stored time x station matrix of the
    # workflow); the operators are timed on the stored grids.
    store = ensure_checkpoint_dir(spark).rstrip("/") + f"/bench-grids-{os.getpid()}"
    cells = G.hourly_cells(X.events_obs(spark, sf_dir))
    X.station_dim(cells).write.mode("overwrite").parquet(f"{store}/stations_e")
    results = {}

    def build(name, grid):
        t0 = time.perf_counter()
        write_grid(grid, f"{store}/{name}")
        results[f"grid_build_{name[-1]}"] = round(time.perf_counter() - t0, 3)
        print(f"# grid_build_{name[-1]}: {results[f'grid_build_{name[-1]}']}s", file=sys.stderr)

    build("grid_e", G.dense_grid(cells))
    build("grid_f", X.fill_rule(read_grid(spark, f"{store}/grid_e")))
    build("grid_l", G.dense_grid(G.hourly_cells(X.lineitem_obs(spark, sf_dir))))

    def grid_e():
        return read_grid(spark, f"{store}/grid_e")

    def grid_f():
        return read_grid(spark, f"{store}/grid_f")

    def stations_e():
        return spark.read.parquet(f"{store}/stations_e")

    def grid_l():
        return read_grid(spark, f"{store}/grid_l")

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    def q_buddy():
        run(buddy_check(grid_e(), stations_e(), SEQUENTIAL_BUDDY))

    def q_sct_greedy():
        run(sct(grid_f(), stations_e(), GREEDY, plan="general"))

    def q_sct_shipped():
        run(sct(grid_f(), stations_e(), BATCH_SCT))

    def q_completeness():
        g = grid_l().withColumn("flag", F.col("v").isNotNull())
        per_day = cut_lineage(C.station_days(g, "flag", 0.2))
        run(C.completeness_temporal(g, "flag", 0.2, out="out", per_day=per_day))
        C.completeness_stats(per_day, out=True).collect()

    def q_rolling():
        run(T.rolling_zscore(grid_e(), 720, 3.0, 300))

    def q_climatology():
        g = grid_l()
        run(T.seasonal_zscore(g, T.climatology(g, 15.0), 1.6, 40))

    def q_batch():
        Q.batch_qc(grid_f(), stations_e(), BATCH_LIMITS, BATCH_BUDDY_F, BATCH_SCT, 0.8).stats.collect()

    def q_sequential():
        Q.sequential_qc(grid_f(), stations_e(), SEQUENTIAL_SEASON_LIMITS, SEQUENTIAL_BUDDY, SEQUENTIAL_SCT,
                        0.8).stats.collect()

    bench = {"buddy_check": q_buddy, "sct_greedy": q_sct_greedy, "sct_shipped": q_sct_shipped,
             "completeness_temporal": q_completeness, "rolling_zscore": q_rolling,
             "climatology_seasonal_z": q_climatology, "batch_qc": q_batch, "sequential_qc": q_sequential}
    only = [a for a in sys.argv[1:]]
    for name, fn in bench.items():
        if only and name not in only:
            continue
        fn()  # warm-up
        times = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
        print(f"# {name}: {results[name]}s {[round(t, 2) for t in times]}", file=sys.stderr)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(results.values()), 3), "unit": "sec",
                      "queries": results, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus), "repeats": repeats}))


if __name__ == "__main__":
    main()
