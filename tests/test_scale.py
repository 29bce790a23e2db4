"""Steps that must not grow faster than their input: what crosses a shuffle, and the same results by the way around it."""

import datetime as dt
import math

from pyspark.sql import functions as F

from stationqc.operators import buddy as B
from stationqc.operators import geo as Geo
from stationqc.params import BuddyParams
from stationqc.sources import fixtures as X

T0 = dt.datetime(2024, 1, 1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _network(spark, n=40):
    places = [(s, 46.4 + (s * 37 % 101) / 2000.0, 11.3 + (s * 53 % 97) / 2000.0, None if s % 17 == 16 else 200.0 + s * 53 % 60 * 10) for s in range(n)]
    rows = [(T0 + dt.timedelta(hours=h), s, None if (h * 31 + s * 17) % 7 == 0 else 10.0 + (h * 13 + s * 29) % 83 / 8.3, h % 2 == 0)
            for h in range(60) for s in range(n)]
    rows += [(T0, 3, 15.0, True), (None, 4, 12.0, True), (T0, None, 12.0, True), (T0, 999, 12.0, True)]
    return (spark.createDataFrame(places, "sid long, lat double, lon double, alt double"),
            spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double, also boolean"), rows)


def test_buddy_stats_by_groups(spark, monkeypatch):
    """Small groups with halos and several buckets of days give every cell the statistics of all its neighbours."""
    monkeypatch.setattr(B, "GROUP_STATIONS", 3)
    monkeypatch.setattr(B, "BUCKET_STATIONS", 8)
    st, grid, rows = _network(spark)
    prm = BuddyParams(radius=1500.0, max_elev_diff=400.0, elev_gradient=-0.0065)
    pairs = B.buddy_pairs(st, prm)
    near = {}
    for p in pairs.collect():
        near.setdefault(p.i, []).append((p.j, p.da))
    held = {}
    for t, s, v, _ in rows:
        if v is not None:
            held.setdefault((t, s), []).append(v)
    got = B.buddy_stats(grid, st, pairs, prm).collect()
    assert len(got) == len(rows)
    assert sorted((str(r.t), str(r.sid), str(r.v), r.also) for r in got) == sorted((str(t), str(s), str(v), a) for t, s, v, a in rows)
    some = 0
    for r in got:
        vals = [v - 0.0065 * da for j, da in near.get(r.sid, []) for v in held.get((r.t, j), [])] if r.t else []
        assert (r.n_nb or 0) == len(vals) and (r.n_adj or 0) == len(vals)
        if not vals:
            assert r.n_nb is None and r.nb_mean is None and r.nb_std is None
            continue
        some += 1
        mean = sum(vals) / len(vals)
        assert abs(r.nb_mean - mean) < 1e-9
        assert abs(r.nb_std - math.sqrt(sum((x - mean) ** 2 for x in vals) / len(vals))) < 1e-9
    assert some > 1000


def test_buddy_expansion_crosses_no_shuffle(spark):
    st, grid, _ = _network(spark)
    p = _plan(B.buddy_check(grid, st, BuddyParams()))
    assert "FlatMapCoGroupsInArrow" in p and "Aggregate" not in p


def test_stations_without_cells(spark, tmpdir_path):
    rows = [(1, T0, 20.0), (2, T0, None), (3, None, 5.0), (None, T0, 5.0), (4, T0, float("nan"))]
    spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp_ntz, l_quantity double").write.parquet(f"{tmpdir_path}/lineitem.parquet")
    df = X.stations_l(spark, tmpdir_path)
    assert sorted(str(r.sid) for r in df.collect()) == ["1", "3", "None"]
    assert "l_shipdate" not in _plan(df)


def test_pairs_do_not_repeat_the_projection(spark):
    st, _, _ = _network(spark)
    assert "ATANH" not in _plan(Geo.radius_pairs_metric(st, 5000.0)).upper()


def test_dense_grid_rows_cross_no_shuffle(spark):
    from stationqc.operators.grid import dense_grid

    p = _plan(dense_grid(spark.createDataFrame([], "t timestamp_ntz, sid long, v double")))
    above = p.split("Generate", 1)[0]
    assert "Exchange" not in above.replace("BroadcastExchange", "").split("BroadcastHashJoin")[0] and "SortMergeJoin" not in p


def test_wide_blocks_hold_any_number_of_stations(spark):
    from stationqc.operators.grid import from_wide_blocks, to_wide_blocks

    rows = [(T0 + dt.timedelta(hours=h), s, None if s % 5 == h else float(s + h)) for h in range(3) for s in range(50)]
    grid = spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double")
    spark.conf.set("spark.sql.pivotMaxValues", "20")
    try:
        wide, header = to_wide_blocks(grid, width=16)
        assert len(wide.columns) == 18 and wide.count() == 3 * 4
        back = from_wide_blocks(wide, header).collect()
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
    assert sorted(map(tuple, back), key=str) == sorted(((t, str(s), v) for t, s, v in rows), key=str)


def test_nearest_of_crowded_places(spark):
    """Many stations at one place: as many candidates as asked for, not all pairs; a station given twice counts twice."""
    from stationqc.operators.adaptive import nearest_k_any

    rows = [(s, float(s % 3), 0.0, 0.0) for s in range(300)] + [(300, 50.0, 0.0, 0.0), (300, 50.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "sid long, x double, y double, alt double")
    got = {}
    for r in nearest_k_any(df, "x", "y", 3).collect():
        got.setdefault(r.i, []).append((r.rank, r.j, r.dist))
    for i in {r[0] for r in rows}:
        x = next(r[1] for r in rows if r[0] == i)
        pairs = sorted((abs(b[1] - x), b[0]) for a in rows if a[0] == i for b in rows if b[0] != i)[:3]
        assert sorted(got[i]) == [(n + 1, j, d) for n, (d, j) in enumerate(pairs)]
