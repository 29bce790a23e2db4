"""Run-length cells against the rules over the dense grid."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stationqc.operators import completeness as C
from stationqc.operators import grid as G
from stationqc.operators import runs as R
from stationqc.plans import reports as Rep


@pytest.fixture(scope="module")
def cells(spark):
    """Six stations over 40 days with holes of hours, days and months, one of them nearly empty."""
    rnd = random.Random(2)
    t0 = dt.datetime(2023, 12, 20)
    rows = []
    for s in range(6):
        for h in range(24 * 40):
            keep = rnd.random() < (0.97, 0.8, 0.5, 0.02, 0.9, 1.0)[s]
            if keep and not (s == 4 and 100 < h < 700) and h % 24 != 13:
                rows.append((t0 + dt.timedelta(hours=h), s, round(rnd.gauss(5, 8), 2)))
    return spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double").checkpoint()


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("missing_good", [False, True])
@pytest.mark.parametrize("p", [0.1, 0.75])
def test_rules_equal_those_of_the_dense_grid(cells, p, missing_good):
    good = F.col("v") > 0
    dense = G.dense_grid(cells).withColumn("flag", F.coalesce(good, F.lit(missing_good))).checkpoint()
    g = R.run_grid(cells)
    share = F.round("share", 9)
    assert rows(R.timestep_share(g, p, good, missing_good), "t", share, "keep_t") == rows(C.timestep_completeness(dense, "flag", p), "t", share, "keep_t")
    assert rows(R.station_share(g, p, good, missing_good), "sid", share, "keep_s") == rows(C.station_completeness(dense, "flag", p), "sid", share, "keep_s")
    per_day = C.station_days(dense, "flag", p)
    cols = ("sid", "day", "n_good", "day_bad", "month_bad")
    assert rows(R.station_days(g, p, good, missing_good), *cols) == rows(per_day, *cols)
    assert R.completeness_counters(g, p, good, missing_good).collect() == C.completeness_stats(per_day, out=True).collect()
    flagged = C.completeness_temporal(dense, "flag", p, out="o")
    months = flagged.groupBy("sid", "mk").agg(F.count(F.lit(1)).alias("n_rows"), F.bool_or("month_bad").alias("month_bad"),
                                              F.count_if("day_bad").alias("n_rows_day_bad"), F.count_if("o").alias("n_out"))
    cols = ("sid", "mk", "n_rows", "month_bad", "n_rows_day_bad", "n_out")
    assert rows(R.station_months(g, p, good, missing_good), *cols) == rows(months, *cols)


def test_runs_expand_to_the_dense_grid(cells):
    runs = R.to_runs(cells)
    dense = G.dense_grid(cells)
    assert rows(R.expand_runs(runs, G.time_axis(cells)), "sid", "t") == rows(dense, "sid", "t")
    assert R.expand_runs(runs, G.time_axis(cells)).exceptAll(dense).count() == 0
    assert runs.count() < 2 * cells.count() + 6


def test_summaries_equal_those_of_the_dense_grid(spark, cells):
    stations = spark.createDataFrame([(s, None if s == 2 else 100.0) for s in range(6)], "sid long, alt double")
    g, dense = R.run_grid(cells), G.dense_grid(cells)
    want = Rep.dataset_summary(dense, stations)
    assert rows(R.dataset_summary(g, stations), *want.columns) == rows(want, *want.columns)
    want = Rep.seasonal_summary(dense)
    assert sorted(map(str, R.seasonal_summary(g).select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_counters_make_no_station_days(cells):
    """The only rows made are station-months: one Generate, over the station table."""
    plan = R.completeness_counters(R.run_grid(cells), 0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and "Distinct" not in plan
