"""Adaptive cells, chunked arrays, blocks of the rolling window, stored moments and change propagation."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from stationqc.operators import adaptive as A
from stationqc.operators import geo
from stationqc.operators import grid as G
from stationqc.operators import moments as M
from stationqc.operators import temporal as T
from stationqc.plans import propagate as P
from stationqc.sources import chunks as Ch

T0 = dt.datetime(2023, 12, 28)


@pytest.fixture(scope="module")
def city(spark):
    """Half of 400 stations within one cell, 20 of them at one place, two far away."""
    rnd = random.Random(4)
    rows = [(i, 11.2 + rnd.random() * 0.001, 46.3 + rnd.random() * 0.001, 100.0) for i in range(180)]
    rows += [(i, 11.2003, 46.3007, None) for i in range(180, 200)]
    rows += [(i, 5 + rnd.random() * 10, 40 + rnd.random() * 10, 50.0) for i in range(200, 398)] + [(398, -170.0, -80.0, 1.0), (399, 170.0, 85.0, 2.0)]
    return rows, spark.createDataFrame(rows, "sid long, x double, y double, alt double").checkpoint()


def dist(a, b):
    return math.sqrt((b[1] - a[1]) ** 2 + (b[2] - a[2]) ** 2)


@pytest.mark.parametrize("r", [0.0003, 0.05, 3.0])
def test_adaptive_pairs_equal_all_pairs(city, r):
    rows, df = city
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] != b[0] and dist(a, b) <= r)
    got = A.adaptive_pairs(df, "x", "y", r, bound=8)
    assert sorted((p.i, p.j) for p in got.collect()) == want
    assert got.exceptAll(geo._pairs(df, "x", "y", r)).count() == 0
    some = A.adaptive_pairs(df, "x", "y", r, bound=8, probes=df.where("sid % 50 = 3"), keep_self=True)
    assert sorted((p.i, p.j) for p in some.collect()) == sorted([w for w in want if w[0] % 50 == 3] + [(i, i) for i in range(3, 400, 50)])


def test_dense_cell_is_split(city):
    _, df = city
    members, leaves = A.quad_leaves(A._placed(df, "x", "y", 0.05), 8)
    assert members.count() == 400 and leaves.agg(F.sum("n")).first()[0] == 400
    crowded = leaves.where("n > 8").collect()
    assert all(r.n >= 20 and r.x1 - r.x0 < 0.05 / 2 ** (A.DEPTH - 1) for r in crowded)   # only what lies at one place
    assert leaves.where("held > 100").count() > 20


def test_nearest_without_a_radius(spark, city):
    rows, df = city
    got = {}
    for r in A.nearest_k_any(df, "x", "y", 4, bound=16).collect():
        got.setdefault(r.i, []).append((r.rank, r.j))
    for a in rows:
        want = [b[0] for b in sorted((b for b in rows if b[0] != a[0]), key=lambda b: (dist(a, b), b[0]))[:4]]
        assert [j for _, j in sorted(got[a[0]])] == want
    few = df.where("sid < 3")
    assert A.nearest_k_any(few, "x", "y", 5).count() == 6 and A.nearest_k_any(df.limit(0), "x", "y", 5).count() == 0


def grid_of(spark, stations=23, hours=24 * 9, hot=None):
    rnd = random.Random(9)
    rows = [(T0 + dt.timedelta(hours=h), s, None if rnd.random() < 0.1 else round(rnd.gauss(5, 3) + (30 if rnd.random() < 0.01 else 0), 2))
            for s in range(stations) for h in range(hours)]
    return spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double").checkpoint()


def test_chunks_round_trip_and_slice(spark, tmpdir_path):
    g = grid_of(spark)
    Ch.write_chunks(g, tmpdir_path, times=48, stations=5, groups=2)
    back = Ch.read_chunks(spark, tmpdir_path)
    assert back.exceptAll(g.select("t", "sid", "v")).count() == 0 and back.count() == g.count()
    blocks = spark.read.parquet(f"{tmpdir_path}/blocks")
    assert blocks.select(F.max(F.size("block"))).first()[0] <= 48 * 5 and blocks.agg(F.sum("n_filled")).first()[0] == g.where("v IS NOT NULL").count()
    lo, hi = T0 + dt.timedelta(hours=60), T0 + dt.timedelta(hours=80)
    some = spark.createDataFrame([(3,), (17,)], "sid long")
    part = Ch.read_chunks(spark, tmpdir_path, lo, hi, some)
    want = g.where(F.col("t").between(lo, hi) & F.col("sid").isin(3, 17))
    assert part.exceptAll(want).count() == 0 and part.count() == want.count() == 42
    _, _, read = Ch._selected(spark, tmpdir_path, lo, hi, some)
    assert {r.tchunk for r in read.select("tchunk").distinct().collect()} == {1} < {r.tchunk for r in blocks.select("tchunk").distinct().collect()}
    assert "PartitionFilters: [isnotnull(tchunk" in read._jdf.queryExecution().executedPlan().toString() and read.count() <= 2
    rows = Ch.wide_rows(spark, tmpdir_path, lo, hi)
    assert rows.agg(F.sum(F.size("row"))).first()[0] == 23 * 21


def test_rolling_in_blocks_with_a_hot_station(spark):
    """A station with a third of all cells and a history of its own length: same verdicts, many tasks."""
    rnd = random.Random(3)
    rows = [(T0 + dt.timedelta(hours=h), s, None if rnd.random() < 0.05 else rnd.gauss(1000, 1)) for s in range(4) for h in range(500)]
    rows += [(T0 + dt.timedelta(hours=h), 9, rnd.gauss(0, 1) + (40 if h == 777 else 0)) for h in range(1000)]
    g = spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double").checkpoint()
    whole = {(r.sid, r.t): r for r in T.rolling_zscore(g, 48, 3.0, 20).collect()}
    for block in (24, 50, 100_000):
        cut = T.rolling_zscore(g, 48, 3.0, 20, block_hours=block).collect()
        assert len(cut) == len(rows)
        for r in cut:
            w = whole[(r.sid, r.t)]
            assert (r.roll_rows, r.roll_good) == (w.roll_rows, w.roll_good)
            assert (r.roll_z is None) == (w.roll_z is None) and (r.roll_z is None or abs(r.roll_z - w.roll_z) < 1e-6)
    with pytest.raises(ValueError):
        T.rolling_zscore(g, 48, block_hours=23)


def test_moments_merge_and_retract(spark):
    rnd = random.Random(8)
    rows = [(dt.datetime(2020, 1, 1) + dt.timedelta(days=d), s, 1e6 + rnd.gauss(0, 1)) for s in range(3) for d in range(1200) if rnd.random() < 0.7]
    cells = spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double").checkpoint()

    def table(df):
        return {(r.sid, r.doy): (r.n, round(r["mean"], 6), round(r.m2, 5)) for r in df.collect()}
    whole = M.day_moments(cells)
    a, b = cells.where("sid < 2 AND year(t) < 2022"), cells.where("sid = 2 OR year(t) >= 2022")
    merged = M.merge_moments(M.day_moments(a), M.day_moments(b))
    assert table(merged) == table(whole)
    assert table(M.retract_moments(merged, M.day_moments(b))) == table(M.day_moments(a))
    grid = G.dense_grid(cells)
    want = {(r.sid, r.doy): (r.clim_rows, r.clim_n, r.clim_mean, r.clim_std) for r in T.climatology(grid, 15.0).collect()}
    got = M.climatology_of(whole, M.axis_days(cells), cells.select("sid").distinct(), 15.0).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[(r.sid, r.doy)]
        assert (r.clim_rows, r.clim_n) == w[:2] and r.clim_mean == pytest.approx(w[2], abs=1e-6) and r.clim_std == pytest.approx(w[3], abs=2e-2)


def test_propagation_reads_little_and_equals_the_full_run(spark):
    g = grid_of(spark, stations=8, hours=24 * 130)
    hit = F.col("sid").isin(2, 5) & (F.date_format("t", "yyyy-MM") == "2024-02")
    new = g.withColumn("v", F.when(hit & (F.hour("t") == 5), None).when(hit, F.col("v") + 20).otherwise(F.col("v"))).checkpoint()
    changes = P.changed_months(g, new)
    assert sorted(tuple(r) for r in changes.collect()) == [(2, 2024 * 12 + 1), (5, 2024 * 12 + 1)]
    axis = G.time_axis(g)
    step = P.redo_step(new, axis, changes, 12.0)
    roll = P.redo_rolling(new, axis, changes, 48, 3.0, 20)
    assert step.count() == 2 * (29 * 24 + 2) and roll.count() == 2 * (29 * 24 + 48)
    full = T.temporal_step(new, 12.0).select("t", "sid", "step_suspect")
    spliced = P.splice(T.temporal_step(g, 12.0).select("t", "sid", "step_suspect"), step)
    assert spliced.exceptAll(full).count() == 0 and spliced.count() == full.count()
    full = T.rolling_zscore(new, 48, 3.0, 20).select("t", "sid", "roll_good")
    spliced = P.splice(T.rolling_zscore(g, 48, 3.0, 20).select("t", "sid", "roll_good"), roll)
    assert spliced.exceptAll(full).count() == 0 and spliced.count() == full.count()
