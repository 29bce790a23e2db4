"""Kernel unit tests on tiny literal frames: NULL rules, inclusive bounds, strict thresholds."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationqc.functions.columns import epoch_to_ntz, hour_floor, utm_xy
from stationqc.operators import completeness as C
from stationqc.operators import geo as Geo
from stationqc.operators import grid as G
from stationqc.operators import temporal as T
from stationqc.operators.buddy import buddy_check, eligible_times
from stationqc.operators.seasonal import seasonal_threshold
from stationqc.params import BuddyParams

H = dt.timedelta(hours=1)
T0 = dt.datetime(2024, 1, 1)


def cells(spark, rows):
    return spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double")


def test_hourly_cells_mean_and_nan(spark):
    df = spark.createDataFrame([(T0, 1, 1.0), (T0, 1, 3.0), (T0, 2, float("nan")), (T0 + H, 2, None)],
                               "t timestamp_ntz, sid long, v double")
    out = {(r.t, r.sid): r.v for r in G.hourly_cells(df).collect()}
    assert out == {(T0, 1): 2.0}   # all-missing cells, times and stations disappear


def test_dense_grid_gap_fill(spark):
    c = cells(spark, [(T0, 1, 1.0), (T0 + 3 * H, 1, 2.0), (T0 + H, 2, 5.0), (T0 + 5 * H, 3, 7.0)])
    g = G.dense_grid(c).collect()
    axis = {T0, T0 + H, T0 + 3 * H, T0 + 5 * H}   # a time without any obs is not on the axis
    assert len(g) == 4 * 3
    assert {r.t for r in g} == axis
    got = {(r.t, r.sid): r.v for r in g}
    assert got[(T0, 1)] == 1.0 and got[(T0 + H, 1)] is None and got[(T0 + 5 * H, 3)] == 7.0
    assert sum(v is not None for v in got.values()) == 4


def test_time_axis_positions(spark):
    ts = [dt.datetime(2023, 12, 31, 23), dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 2, 1, 5)]
    c = cells(spark, [(t, 1, 1.0) for t in ts])
    ax = sorted((r.t, r.idx, r.n_times) for r in G.time_axis(c).collect())
    assert [(i, n) for _, i, n in ax] == [(0, 3), (1, 3), (2, 3)]


def test_seasonal_missing_is_good_and_bounds(spark):
    lim = {"DJF": (-30.0, 20.0), "MAM": (None, 30.0), "JJA": (0.0, None), "SON": (-10.0, 30.0)}
    rows = [(T0, 1, 20.0), (T0, 2, 20.5), (T0, 3, None), (dt.datetime(2024, 4, 1), 1, -99.0),
            (dt.datetime(2024, 7, 1), 1, 99.0), (dt.datetime(2024, 7, 1), 2, -0.1)]
    out = {(r.t, r.sid): r.seasonal_good for r in seasonal_threshold(cells(spark, rows), lim).collect()}
    assert out[(T0, 1)] is True and out[(T0, 2)] is False and out[(T0, 3)] is True
    assert out[(dt.datetime(2024, 4, 1), 1)] is True      # absent minimum
    assert out[(dt.datetime(2024, 7, 1), 1)] is True      # absent maximum
    assert out[(dt.datetime(2024, 7, 1), 2)] is False


def test_daily_completeness_fixed_24(spark):
    # 20 hourly rows on day 1 (all good) -> 20/24 >= 0.8; day 2 has 19 -> bad
    rows = [(T0 + k * H, 1, 1.0) for k in range(20)] + [(T0 + dt.timedelta(days=1) + k * H, 1, 1.0) for k in range(19)]
    g = cells(spark, rows).withColumn("flag", F.lit(True))
    out = C.completeness_temporal(g, "flag", 0.8)
    days = {r.day: r.day_bad for r in out.select("day", "day_bad").distinct().collect()}
    assert days[dt.date(2024, 1, 1)] is False and days[dt.date(2024, 1, 2)] is True
    assert out.where("month_bad").count() == 0      # axis spans < 30 days: monthly rule off


def test_monthly_guard_and_expected_days(spark):
    # daily rows 2024-01-01 .. 2024-02-10; flags true only on the first 10 days of February
    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=k) for k in range(41)]
    g = cells(spark, [(d, 1, 1.0) for d in days]).withColumn("flag", F.col("t") >= F.lit("2024-02-01").cast("timestamp_ntz"))
    out = C.completeness_temporal(g, "flag", 0.8)
    mb = {r.mk: r.month_bad for r in out.select("mk", "month_bad").distinct().collect()}
    # Jan: 0 valid days of 31 -> bad; Feb: expected min(29, 10) = 10, valid 10 -> kept
    assert mb[2024 * 12 + 0] is True and mb[2024 * 12 + 1] is False


def test_timestep_and_station_completeness(spark):
    rows = [(T0, 1, 1.0), (T0, 2, None), (T0 + H, 1, 1.0), (T0 + H, 2, 2.0)]
    g = cells(spark, rows).withColumn("f", F.col("v").isNotNull())
    tm = {r.t: r.keep_t for r in C.timestep_completeness(g, "f", 0.8).collect()}
    assert tm == {T0: False, T0 + H: True}
    sm = {r.sid: r.keep_s for r in C.station_completeness(g, "f", 0.5).collect()}
    assert sm == {1: True, 2: True}
    empty = C.station_completeness(g, "f", 0.5, kept_times=g.where("false").select("t"))
    assert empty.count() == 0   # no kept time -> no kept station


def _stations(spark, rows):
    return spark.createDataFrame(rows, "sid long, lat double, lon double, alt double")


def test_utm_reference_point(spark):
    x, y = utm_xy(F.lit(45.0), F.lit(15.0))
    r = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(r.x - 500000.0) < 1e-6 and abs(r.y - 4982950.400) < 1e-3


def test_pairs_inclusive_radius_and_plan(spark):
    st = _stations(spark, [(1, 0.0, 0.0, 1.0), (2, 0.0, 1.0, 2.0), (3, 0.0, 2.5, None), (4, 0.0, 0.0, 5.0)])
    p = Geo.radius_pairs_degree(st, 1.0)
    got = sorted((r.i, r.j) for r in p.collect())
    assert got == [(1, 2), (1, 4), (2, 1), (2, 4), (4, 1), (4, 2)]  # exactly at the radius counts
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert Geo.elev_max(p, 2.0).where("i = 2 AND j = 4").count() == 0
    assert Geo.elev_max(Geo.radius_pairs_degree(st, 2.0), 10.0).where("i = 3 OR j = 3").count() == 0


def test_nearest_k_tie_by_id(spark):
    st = _stations(spark, [(1, 0.0, 0.0, 0.0), (2, 0.0, 1.0, 0.0), (3, 0.0, -1.0, 0.0), (4, 0.0, 0.5, 0.0)])
    nk = Geo.nearest_k(Geo.radius_pairs_degree(st, 5.0), 2).where("i = 1")
    assert sorted(r.j for r in nk.collect()) == [2, 4]


def _buddy_grid(spark):
    st = _stations(spark, [(1, 46.40, 11.30, 200.0), (2, 46.401, 11.30, 210.0), (3, 46.402, 11.30, 220.0),
                           (4, 46.403, 11.30, 230.0), (5, 46.40, 11.301, None)])
    rows = [(T0, 1, 10.0), (T0, 2, 10.2), (T0, 3, 9.8), (T0, 4, 30.0), (T0, 5, 10.1),
            (T0 + H, 1, None), (T0 + H, 2, 10.0), (T0 + H, 3, 10.0), (T0 + H, 4, None), (T0 + H, 5, 10.0)]
    return cells(spark, rows), st


def test_buddy_rules(spark):
    g, st = _buddy_grid(spark)
    prm = BuddyParams(radius=1000.0, num_min=3, threshold=3.0)
    out = {(r.t, r.sid): r.buddy_suspect for r in buddy_check(g, st, prm).collect()}
    assert out[(T0, 4)] is True               # outlier
    assert out[(T0, 1)] is False
    assert out[(T0 + H, 1)] is True           # missing -> suspect
    assert out[(T0 + H, 2)] is True           # only 2 valid neighbours -> isolated -> suspect
    # altitude rule: null altitude drops every pair of station 5 -> isolated
    out2 = {(r.t, r.sid): r.buddy_suspect for r in
            buddy_check(g, st, BuddyParams(radius=1000.0, num_min=3, max_elev_diff=500.0)).collect()}
    assert out2[(T0, 5)] is True
    # gradient with a null neighbour altitude poisons the mean: no comparison, not flagged
    out3 = {(r.t, r.sid): r.buddy_suspect for r in
            buddy_check(g, st, BuddyParams(radius=1000.0, num_min=3, elev_gradient=-0.0065)).collect()}
    assert out3[(T0, 4)] is False


def test_buddy_min_std_and_strictness(spark):
    st = _stations(spark, [(k, 46.40 + k * 1e-4, 11.3, 0.0) for k in range(1, 5)])
    # neighbours all 10.0 -> std 0 -> spread min_std 0.1; 10.3 is exactly 3 * 0.1 away -> not flagged (strict)
    g = cells(spark, [(T0, 1, 10.0), (T0, 2, 10.0), (T0, 3, 10.0), (T0, 4, 10.25)])
    out = {r.sid: r.buddy_suspect for r in buddy_check(g, st, BuddyParams(radius=500.0, num_min=3)).collect()}
    assert out[4] is False
    g2 = cells(spark, [(T0, 1, 10.0), (T0, 2, 10.0), (T0, 3, 10.0), (T0, 4, 10.31)])
    out2 = {r.sid: r.buddy_suspect for r in buddy_check(g2, st, BuddyParams(radius=500.0, num_min=3)).collect()}
    assert out2[4] is True


def test_eligible_times(spark):
    g, _ = _buddy_grid(spark)
    e = {r.t: (r.n_valid, r.eligible) for r in eligible_times(g, 4).collect()}
    assert e == {T0: (5, True), T0 + H: (3, False)}


def test_temporal_step_edges_and_missing(spark):
    rows = [(T0, 1, 0.0), (T0 + H, 1, 5.0), (T0 + 2 * H, 1, None), (T0 + 3 * H, 1, 5.0), (T0 + 4 * H, 1, 5.5)]
    out = {r.t: r.step_suspect for r in T.temporal_step(cells(spark, rows), 3.0).collect()}
    assert out == {T0: True, T0 + H: True, T0 + 2 * H: False, T0 + 3 * H: False, T0 + 4 * H: False}


def test_rolling_z_counts_missing_rows_and_std_zero(spark):
    rows = [(T0 + k * H, 1, 1.0 if k != 5 else (None if k == 5 else 0.0)) for k in range(10)]
    r = T.rolling_zscore(cells(spark, rows), window_hours=4, thr=1.0, min_samples=5).collect()
    by_t = {x.t: x for x in r}
    assert by_t[T0].roll_rows == 3 and by_t[T0 + 2 * H].roll_rows == 5   # missing row counted
    assert all(x.roll_good for x in r)  # std 0 -> no z


def test_rolling_z_flags_spike(spark):
    rows = [(T0 + k * H, 1, 10.0 + (0.1 if k % 2 else -0.1)) for k in range(40)] + [(T0 + 40 * H, 1, 20.0)]
    r = {x.t: x.roll_good for x in T.rolling_zscore(cells(spark, rows), 20, 3.0, 5).collect()}
    assert r[T0 + 40 * H] is False and r[T0] is True


def test_climatology_circular_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    days = [dt.datetime(2020, 1, 1) + dt.timedelta(days=int(k)) for k in range(0, 3 * 366, 2)]
    vals = [float(x) if rng.random() > 0.1 else None for x in rng.normal(10, 3, len(days))]
    g = cells(spark, [(d, 7, v) for d, v in zip(days, vals)])
    got = {r.doy: r for r in T.climatology(g, 15.0).collect()}
    doys = np.array([d.timetuple().tm_yday for d in days])
    arr = np.array([np.nan if v is None else v for v in vals])
    for doy in (1, 2, 15, 16, 180, 351, 352, 365, 366):
        # days on a circle of 366: the window holds those at most 15 steps away, either way round
        apart = np.abs(doys - doy)
        sel = arr[np.minimum(apart, 366 - apart) <= 15]
        assert got[doy].clim_rows == len(sel)
        assert math.isclose(got[doy].clim_mean, np.nanmean(sel), rel_tol=1e-9)
        assert math.isclose(got[doy].clim_std, np.nanstd(sel), rel_tol=1e-7, abs_tol=1e-9)


def test_history_span(spark):
    g = cells(spark, [(dt.datetime(2020, 1, 1), 1, 1.0), (dt.datetime(2025, 1, 1, 23), 1, 1.0)])
    r = T.history_span(g, 5.0).first()
    assert r.span_days == 1827 and r.sufficient is True


def test_time_functions(spark):
    r = spark.range(1).select(epoch_to_ntz(F.lit(1609459200)).alias("a"), epoch_to_ntz(F.lit(1609462800)).alias("b"),
                              hour_floor(F.lit("2024-03-31 02:30:10").cast("timestamp_ntz")).alias("h")).first()
    assert r.a == dt.datetime(2021, 1, 1, 0) and r.b == dt.datetime(2021, 1, 1, 1)
    assert r.h == dt.datetime(2024, 3, 31, 2)


def test_masks_and_levels(spark):
    g = cells(spark, [(T0, 1, 1.0), (T0, 2, 2.0)]).withColumn("a", F.col("sid") == 1).withColumn("b", F.lit(None).cast("boolean"))
    m = {r.sid: r.v_masked for r in G.mask_any(g, ["a", "b"]).collect()}
    assert m == {1: None, 2: 2.0}
    assert G.current_level(["t", "T_lvl0", "t_lvl3", "t_lvl3_flag"]) == 3
    with pytest.raises(ValueError):
        G.current_level(["t"])
    e = G.ensure_columns(cells(spark, [(T0, 1, 1.0)]), ["v", "x", "t"])
    assert e.columns == ["v", "x", "t"]
    u = G.with_units(cells(spark, [(T0, 1, 1.0)]), {"v": {"units": "celsius"}})
    assert u.schema["v"].metadata == {"units": "celsius"}


def test_station_metadata_first_non_null(spark):
    df = spark.createDataFrame([(1, T0, None), (1, T0 + H, 5.0), (1, T0 + 2 * H, 6.0)], "sid long, t timestamp_ntz, alt double")
    assert G.station_metadata(df, cols=("alt",)).first().alt == 5.0


@pytest.mark.parametrize("offset", [0.0, 300.0])
def test_rolling_prefix_sums_match_a_direct_window(spark, offset):
    """Uneven times, missing values and a stretch of equal values (no z there)."""
    import random
    import statistics

    rnd = random.Random(4)
    t0 = dt.datetime(2024, 1, 1)
    hours = sorted(rnd.sample(range(400), 260))
    rows = [(t0 + dt.timedelta(hours=h), 1, None if rnd.random() < 0.2 else
             offset + (5.0 if 100 <= h <= 160 else rnd.gauss(0, 2))) for h in hours]
    got = {r.t: (r.roll_rows, r.roll_z) for r in T.rolling_zscore(cells(spark, rows), 20, 3.0, 6).collect()}
    for t, _, v in rows:
        part = [x for u, _, x in rows if abs((u - t).total_seconds()) <= 10 * 3600]
        have = [x for x in part if x is not None]
        sd = statistics.pstdev(have) if have else 0.0
        z = (v - statistics.fmean(have)) / sd if v is not None and len(part) >= 6 and sd > 0 else None
        assert got[t][0] == len(part)
        assert got[t][1] is None if z is None else abs(got[t][1] - z) < 1e-6, (t, got[t], z)
