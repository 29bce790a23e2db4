"""A hot key holding a third of all rows: results stay whole and the plans
pre-aggregate before the shuffle, so the hot key never reaches one task raw."""

import datetime as dt

from pyspark.sql import functions as F

from stationqc.operators import grid as G
from stationqc.sources import ingest as I

T0 = dt.datetime(2024, 1, 1)


def _skewed(spark, n=3000):
    rows = []
    for k in range(n):
        if k % 3 == 0:                       # a third of all rows: station 0, ten hours, many duplicates
            rows.append((T0 + dt.timedelta(hours=k % 10), 0, float(k % 7)))
        else:
            rows.append((T0 + dt.timedelta(hours=k % 50), 1 + k % 40, float(k % 11)))
    return rows, spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double")


def test_hourly_cells_hot_station(spark):
    rows, df = _skewed(spark)
    out = {(r.t, r.sid): r.v for r in G.hourly_cells(df).collect()}
    exp = {}
    for t, s, v in rows:
        exp.setdefault((t, s), []).append(v)
    assert out.keys() == exp.keys()
    assert all(abs(out[k] - sum(v) / len(v)) < 1e-12 for k, v in exp.items())
    plan = G.hourly_cells(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_avg") > plan.index("Exchange")   # partial aggregate below (before) the exchange


def test_dense_grid_hot_station_bounded_by_axis(spark):
    _, df = _skewed(spark)
    g = G.dense_grid(G.hourly_cells(df))
    per = {r.sid: r.n for r in g.groupBy("sid").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_axis = G.hourly_cells(df).select("t").distinct().count()
    assert set(per.values()) == {n_axis}    # every station, hot or not, has exactly one row per axis time


def test_merge_keep_last_hot_key(spark):
    t = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([("hot", t, float(k)) for k in range(1)] + [(f"s{k}", t, 1.0) for k in range(20)],
                                "station_id string, ts timestamp_ntz, temperature double")
    new = spark.createDataFrame([("hot", t, 42.0)], "station_id string, ts timestamp_ntz, temperature double")
    m = {(r.station_id): r.temperature for r in I.merge_keep_last(old, new).collect()}
    assert m["hot"] == 42.0 and len(m) == 21
