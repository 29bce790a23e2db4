"""Steps of the findings of round 3: the same results by what crosses fewer shuffles or writes out fewer rows."""

import datetime as dt
import math
import os
import random
import re

from pyspark.sql import functions as F

from stationqc.operators import adaptive as A
from stationqc.operators import completeness as C
from stationqc.operators import moments as M
from stationqc.operators import spatial as SP
from stationqc.operators import spatial_rounds as SR
from stationqc.operators.grid import dense_grid, hourly_cells
from stationqc.params import SctParams

T0 = dt.datetime(2024, 1, 30)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _flagged(spark, days=40):
    """Hourly cells of three stations with days and months of either verdict, repeated, null and out of order."""
    rows = [(T0 + dt.timedelta(hours=h), s, (h // 24 + s) % 5 != 0 and (s != 2 or h // 24 % 3 == 0))
            for h in range(24 * days) for s in range(3)]
    rows += [(T0, 1, True), (None, 1, True), (T0, None, True)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "t timestamp_ntz, sid long, good boolean")


def test_completeness_by_station_is_the_joined_rule(spark):
    g = _flagged(spark)
    cols = ["t", "sid", "good", "day", "mk", "day_bad", "month_bad", "out"]
    want = C.completeness_temporal(g, "good", 0.8, out="out").select(*cols).collect()
    got = C.completeness_by_station(g, "good", 0.8, C.axis_months(g), out="out").select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len({r.out for r in got}) == 2
    assert len({r.month_bad for r in got}) == 2 and len({r.day_bad for r in got}) == 2


def test_completeness_of_a_dense_grid_shuffles_no_cells(spark):
    g = dense_grid(spark.createDataFrame([], "t timestamp_ntz, sid long, v double")).withColumn("good", F.col("v").isNotNull())
    months = spark.createDataFrame([], "mk int, guard boolean, expected long")
    p = _plan(C.completeness_by_station(g, "good", 0.8, months))
    assert "SortMergeJoin" not in p
    cells = p.split("Generate", 1)[0].replace("BroadcastExchange", "")
    assert "Exchange" not in cells.split("BroadcastHashJoin")[0]
    p = _plan(C.completeness_by_station(_flagged(spark, 1), "good", 0.8, months))
    assert p.count("Exchange hashpartitioning(sid") == 1


def _brute_reach(rows, r):
    out = {}
    for a in rows:
        for b in rows:
            if a[0] is None or b[0] is None or a[0] == b[0] or a[1] is None or b[1] is None:
                continue
            d = math.sqrt((b[1] - a[1]) ** 2 + (b[2] - a[2]) ** 2)
            if d <= r:
                n, lo, hi, far = out.get(a[0], (0, b[0], b[0], 0.0))
                out[a[0]] = (n + 1, min(lo, b[0]), max(hi, b[0]), max(far, d))
    return out


def test_reach_is_the_count_of_the_pairs(spark):
    rng = random.Random(5)
    rows = [(s, 0.3 + rng.random() * 0.02, 0.7 + rng.random() * 0.02, 0.0) for s in range(150)]      # a town
    rows += [(s, rng.random() * 1.5, rng.random() * 1.5, 0.0) for s in range(150, 300)]              # the country
    rows += [(s, 0.31, 0.71, 0.0) for s in range(300, 340)]                                          # one place
    rows += [(7, *rows[7][1:]), (310, 0.31, 0.71, 0.0), (5, 1.2, 1.2, 0.0), (None, 0.3, 0.7, 0.0), (400, None, 0.7, 0.0),
             (401, 9.0, 9.0, 0.0), (-1, 0.3, 0.7, 0.0)]
    df = spark.createDataFrame(rows, "sid long, x double, y double, alt double")
    for r in (0.012, 0.1):
        got = {x.i: (x.n, x.first_j, x.last_j, x.farthest) for x in A.adaptive_reach(df, "x", "y", r, bound=4).collect()}
        want = _brute_reach(rows, r)
        assert got.keys() == want.keys()
        for i, w in want.items():
            assert got[i][:3] == w[:3] and abs(got[i][3] - w[3]) < 1e-12, i


def test_reach_of_a_town_writes_no_pairs(spark, monkeypatch):
    """3,000 places within reach of each other: nine million pairs, some tens of rows per place."""
    rows = [(s, 11.0 + (s * 37 % 3001) / 1e6, 46.0 + (s * 401 % 3001) / 1e6, 0.0) for s in range(3000)]
    df = spark.createDataFrame(rows, "sid long, x double, y double, alt double")
    made, cut = [], A.cut_lineage

    def counted(d, *a):
        out = cut(d, *a)
        made.append(out.count())
        return out
    monkeypatch.setattr(A, "cut_lineage", counted)
    monkeypatch.setattr(A, "adaptive_pairs", None)
    got = A.adaptive_reach(df, "x", "y", 0.05, bound=32).collect()
    assert {x.n for x in got} == {2999} and len(got) == 3000
    assert sum(made) < 200 * len(rows)


def test_climatology_of_moments_spreads_no_rows(spark):
    """The circular window as frames of a station: as many rows as days, and the sums of all days within reach."""
    rng = random.Random(2)
    rows = [(s, d, rng.randint(1, 5), rng.random() * 9, rng.random()) for s in (1, 2) for d in range(1, 367) if rng.random() < 0.4]
    rows.append((None, 7, 2, 1.0, 0.5))
    mom = spark.createDataFrame(rows, "sid long, doy int, n long, mean double, m2 double")
    axis = spark.createDataFrame([(d, 3) for d in range(1, 366)], "doy int, n_times long")
    for half in (15.0, 0.0, 182.0, 400.0):
        df = M.climatology_of(mom, axis, mom.select("sid").distinct(), half)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join LeftOuter" not in plan
        got = {(r.sid, r.doy): r for r in df.collect()}
        assert len(got) == 3 * (366 if half else 365)   # no axis time on the last day
        for (s, doy), r in got.items():
            def near(d):
                return min(abs(d - doy), 366 - abs(d - doy)) <= half
            part = [x for x in rows if s is not None and x[0] == s and near(x[1])]
            n = sum(x[2] for x in part)
            assert r.clim_n == n and r.clim_rows == sum(3 for d in range(1, 366) if near(d))
            if not n:
                assert r.clim_mean is None
                continue
            mean = sum(x[2] * x[3] for x in part) / n
            var = sum(x[4] + x[2] * (x[3] - mean) ** 2 for x in part) / n
            assert abs(r.clim_mean - mean) < 1e-9 and abs(r.clim_std - math.sqrt(var)) < 1e-6


def test_moments_of_more_readings_have_more_parts(spark, monkeypatch):
    monkeypatch.setattr(M, "TASK_ROWS", 100)
    obs = spark.range(2000).select((F.col("id") % 50).alias("sid"), F.lit(T0).alias("t"), F.lit(1.0).alias("v"))
    d = M.dealt(obs)
    assert d.rdd.getNumPartitions() == 20 and d.count() == 2000
    p = _plan(M.day_moments(hourly_cells(d)))
    assert p.count("Exchange") == 1


GREEDY = SctParams(inner_radius=0.012, outer_radius=0.04, num_min=3, num_max=4, pos_threshold=1.0, neg_threshold=1.0, min_elev_diff=20.0,
                   max_elev_diff=400.0, vertical_scale=-0.0065, temporal_threshold=3.0, eps=0.1)


def _network(spark, n=30, hours=150):
    """Stations of one town with text ids, and hourly values with gaps in the axis, missing values and a missing altitude."""
    rng = random.Random(17)
    st = [(f"s{k}", 46.4 + rng.random() * 0.1, 11.2 + rng.random() * 0.1, None if k % 13 == 5 else 200.0 + rng.randrange(0, 600, 10)) for k in range(n)]
    rows = [(T0 + dt.timedelta(hours=h + (h > 70) * 30), s[0], None if rng.random() < 0.05 else round(10 + rng.gauss(0, 2), 2))
            for h in range(hours) for s in st]
    rng.shuffle(rows)
    return (spark.createDataFrame(st, "sid string, lat double, lon double, alt double"),
            spark.createDataFrame(rows, "t timestamp_ntz, sid string, v double").repartition(4).checkpoint())


def _rounds_folders(spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {f"{folder}/{x}" for x in os.listdir(folder) if x.startswith("rounds-")}


def _flags(df):
    return {(r.t, r.sid) for r in df.where("sct_flag").collect()}


def test_rounds_hold_blocks_of_cells(spark, monkeypatch):
    """Several blocks of times and several parts of a level: the flags of the scan, by few stored rows for many cells."""
    st, g = _network(spark)
    known = _rounds_folders(spark)
    want = _flags(SP.sct(g, st, GREEDY, plan="scan"))
    got = _flags(SP.sct(g, st, GREEDY, plan="rounds"))
    assert got == want and len(want) > 100
    (folder,) = _rounds_folders(spark) - known
    rows = sum(spark.read.parquet(f"{folder}/{x}").count() for x in os.listdir(folder))
    assert rows < g.count() / 4
    monkeypatch.setattr(SR, "SENT_ROWS", 20)
    known = _rounds_folders(spark)
    assert _flags(SP.sct(g, st, GREEDY, plan="rounds")) == want
    (folder,) = _rounds_folders(spark) - known
    assert spark.read.parquet(f"{folder}/lists").select("part").distinct().count() > 1


def test_station_blocks_keep_the_places_of_gaps(spark):
    g = spark.createDataFrame([(T0 + dt.timedelta(hours=h), s, None if h == 65 else float(h)) for h in range(70) for s in ("a", "b", None)
                               if (h, s) not in ((0, "b"), (3, "b"), (66, "b"))] + [(None, "a", 1.0)], "t timestamp_ntz, sid string, v double")
    axis = spark.createDataFrame([(T0 + dt.timedelta(hours=h), h // 64, h % 64) for h in range(70)], "t timestamp_ntz, block int, at int")
    got = {(r.sid, r.block): r for r in SR.station_blocks(g, axis, tf=F.col("v") == 64).collect()}
    assert set(got) == {("a", 0), ("a", 1), ("b", 0), ("b", 1)}
    for (s, block), r in got.items():
        for k in range(6 if block else 64):
            h = block * 64 + k
            there = (h, s) not in ((0, "b"), (3, "b"), (66, "b"))
            assert (r.here >> k & 1) == there and (r.v[k] == (float(h) if there and h != 65 else None)) and (r.tf >> k & 1) == (h == 64)


def test_rounds_with_altitudes_hold_blocks_of_cells(spark):
    """The spatio-temporal test: the flags of the scan, by few stored rows for many cells."""
    st, g = _network(spark, n=16)
    known = _rounds_folders(spark)
    got = _flags(SP.sct(g, st, GREEDY, stct=True, plan="rounds"))
    assert got == _flags(SP.sct(g, st, GREEDY, stct=True, plan="scan")) and len(got) > 100
    (folder,) = _rounds_folders(spark) - known
    assert sum(spark.read.parquet(f"{folder}/{x}").count() for x in os.listdir(folder)) < g.count() / 4


def test_flags_of_blocks_meet_the_cells_by_station(spark):
    """Flags of far blocks, of the first and last bit, and cells without a time, a station or a flag; further columns stay."""
    axis = spark.createDataFrame([(T0 + dt.timedelta(hours=h), h // 64, h % 64) for h in range(200)], "t timestamp_ntz, block int, at int")
    flagged = {("a", 0), ("a", 63), ("a", 192), ("a", 199), ("b", 130), ("c", 191)}
    masks = {}
    for s, h in flagged:
        masks[s, h // 64] = masks.get((s, h // 64), 0) | 1 << h % 64
    found = [(b, s, s, m - (m >> 63 << 64), 0) for (s, b), m in masks.items()] + [(2, "b", "b", 1 << 2, 0)]     # a row twice
    found = spark.createDataFrame(found, "block int, i string, j string, gone bigint, blocked bigint")
    cells = [(s, T0 + dt.timedelta(hours=h), float(h), h) for s in "abcd" for h in range(200)]
    cells += [(None, T0, 1.0, -1), ("a", None, 1.0, -2), ("a", T0, 1.0, -3), (None, None, None, -4)]
    g = spark.createDataFrame(cells, "sid string, t timestamp_ntz, v double, at long")
    got = SR.with_flags(g, axis, found)
    assert got.columns == ["t", "sid", "v", "at", "sct_flag"]
    rows = got.collect()
    assert sorted(r["at"] for r in rows) == sorted(c[3] for c in cells)
    assert {(r["sid"], r["at"]) for r in rows if r["sct_flag"]} == flagged | {("a", -3)}
    assert {r["sct_flag"] for r in rows} == {True, False}


def test_cells_of_rounds_cross_no_shuffle_for_their_flags(spark):
    """The dense grid lies by station; the flags come to it by station, not by time and station."""
    st, g = _network(spark, n=12, hours=70)
    cells = g.where(F.col("v").isNotNull())
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    known = spark.conf.get(key)
    spark.conf.set(key, "true")     # Spark's default, other than the session of the tests
    try:
        out = SP.sct(dense_grid(cells), st, GREEDY, stct=True, plan="rounds")
        plan = re.sub(r"#\d+L?", "", _plan(out))
        assert "Exchange hashpartitioning(t, sid" not in plan and "Exchange hashpartitioning(sid" in plan
        got = _flags(out)
    finally:
        spark.conf.set(key, known)
    assert got == _flags(SP.sct(dense_grid(cells), st, GREEDY, stct=True, plan="scan")) and len(got) > 20
