"""The greedy spatial tests against a plain-Python model written from the
seven-step description (brute-force distances, no neighbour lists)."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from stationqc.operators import spatial as SP
from stationqc.operators.spatial_rounds import sct_rounds as rounds
from stationqc.params import SctParams


def model(st, vals, tvals, prm, stct):
    """st: list of (sid, lon, lat, alt) sorted by sid; vals/tvals: dict sid -> value / temporal flag."""
    ids = [s[0] for s in st]
    pos = {s[0]: s for s in st}
    flagged, processed = set(), set()

    def dist(a, b):
        return math.hypot(pos[a][1] - pos[b][1], pos[a][2] - pos[b][2])

    for i in ids:
        if i in processed:
            continue
        nb = [j for j in ids if j != i and dist(i, j) <= prm.outer_radius and j not in flagged]
        if len(nb) < prm.num_min:
            processed.add(i)
            continue
        if stct:
            def ok(j):
                a, b = pos[i][3], pos[j][3]
                if a is None or b is None:
                    return False
                return prm.min_elev_diff <= abs(a - b) <= prm.max_elev_diff
            nb = [j for j in nb if ok(j)]
        if len(nb) > prm.num_max:
            nb = sorted(nb, key=lambda j: (dist(i, j), j))[:prm.num_max]
        v = vals[i]
        xs = [vals[j] for j in nb]
        spatial = False
        if nb and v is not None and all(x is not None for x in xs):
            if stct:
                w = [1.0 / (dist(i, j) + prm.eps) for j in nb]
                bg = sum(wi * x for wi, x in zip(w, xs)) / sum(w)
                bg += sum(pos[j][3] - pos[i][3] for j in nb) / len(nb) * prm.vertical_scale
            else:
                bg = sum(xs) / len(xs)
            m = sum(xs) / len(xs)
            err = math.sqrt(sum((x - m) ** 2 for x in xs) / len(xs))
            dev = v - bg
            spatial = dev > prm.pos_threshold * err or dev < -prm.neg_threshold * err
        if spatial or (stct and tvals.get(i)):
            flagged.add(i)
        processed.add(i)
        processed.update(j for j in ids if dist(i, j) <= prm.inner_radius)
    return flagged


def _case(seed, n_st=18, n_t=12):
    rnd = random.Random(seed)
    st = sorted((k, 11.25 + rnd.random() * 0.1, 46.4 + rnd.random() * 0.1,
                 None if rnd.random() < 0.1 else 200.0 + rnd.randrange(0, 600, 10)) for k in range(n_st))
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for h in range(n_t):
        for s in st:
            v = None if rnd.random() < 0.08 else round(10 + rnd.gauss(0, 2) + (8 if rnd.random() < 0.05 else 0), 3)
            rows.append((t0 + dt.timedelta(hours=h), s[0], v))
    return st, rows


@pytest.mark.parametrize("inner,outer,stct", [(0.0, 0.04, False), (0.015, 0.04, False), (0.2, 0.2, False),
                                              (0.015, 0.05, True), (0.2, 0.2, True)])
def test_greedy_matches_model(spark, inner, outer, stct):
    st, rows = _case(int(inner * 1000 + outer * 100 + stct))
    prm = SctParams(inner_radius=inner, outer_radius=outer, num_min=3, num_max=5, pos_threshold=1.0,
                    neg_threshold=1.0, min_elev_diff=20.0, max_elev_diff=400.0, vertical_scale=-0.0065,
                    temporal_threshold=3.0, eps=0.1)
    sdf = spark.createDataFrame([(s[0], s[2], s[1], s[3]) for s in st], "sid long, lat double, lon double, alt double")
    g = spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double")
    plans = ["scan"] + (["closed"] if inner >= 0.2 else []) + (["rounds"] if inner < 0.2 or stct else [])
    # temporal flags of the model from the positional neighbours
    by_sid = {}
    for t, s, v in sorted(rows):
        by_sid.setdefault(s, []).append((t, v))
    tflag = {}
    for s, seq in by_sid.items():
        for k, (t, v) in enumerate(seq):
            p = seq[k - 1][1] if k > 0 else None
            n = seq[k + 1][1] if k + 1 < len(seq) else None
            f = v is not None and ((p is not None and abs(v - p) > 3.0) or (n is not None and abs(v - n) > 3.0))
            tflag[(t, s)] = f
    expected = set()
    for t in sorted({r[0] for r in rows}):
        vals = {s: v for tt, s, v in rows if tt == t}
        tv = {s: tflag[(t, s)] for s in vals}
        expected |= {(t, s) for s in model(st, vals, tv, prm, stct)}
    for plan in plans:
        out = SP.sct(g, sdf, prm, stct=stct, plan=plan)
        got = {(r.t, r.sid) for r in out.where(F.col("sct_flag")).collect()}
        assert got == expected, plan
        if stct:
            tf = {(r.t, r.sid) for r in out.where(F.col("temporal_flag")).collect()}
            assert tf == {k for k, f in tflag.items() if f}


def test_closed_form_is_chosen_when_radii_cover_network(spark):
    st, _ = _case(1)
    sdf = spark.createDataFrame([(s[0], s[2], s[1], s[3]) for s in st], "sid long, lat double, lon double, alt double")
    assert SP.covers_all(sdf, SctParams(inner_radius=2000.0, outer_radius=8000.0))
    assert not SP.covers_all(sdf, SctParams(inner_radius=0.01, outer_radius=0.04))


def test_scan_by_component_matches_model(spark):
    st, rows = _case(11, n_st=20)
    # move every second station one degree east: two clusters, at least two components
    st = sorted((s[0], s[1] + (1.0 if s[0] % 2 else 0.0), s[2], s[3]) for s in st)
    prm = SctParams(inner_radius=0.01, outer_radius=0.05, num_min=2, num_max=4, pos_threshold=1.0, neg_threshold=1.0)
    sdf = spark.createDataFrame([(s[0], s[2], s[1], s[3]) for s in st], "sid long, lat double, lon double, alt double")
    comps = SP.scan_components(sdf, prm)
    assert comps.select("comp").distinct().count() >= 2
    g = spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double")
    got = {(r.t, r.sid) for r in SP.sct(g, sdf, prm, plan="general")
           .where(F.col("sct_flag")).collect()}
    expected = set()
    for t in sorted({r[0] for r in rows}):
        vals = {s: v for tt, s, v in rows if tt == t}
        expected |= {(t, s) for s in model(st, vals, {}, prm, False)}
    assert got == expected and len(expected) > 0


def test_text_ids_follow_their_own_order(spark):
    """st-10 comes before st-2: the scan of text ids equals the model on the re-sorted stations."""
    st, rows = _case(5)
    st = sorted((f"st-{s[0]}", *s[1:]) for s in st)
    rows = [(t, f"st-{s}", v) for t, s, v in rows]
    prm = SctParams(inner_radius=0.015, outer_radius=0.05, num_min=2, num_max=4, pos_threshold=1.0, neg_threshold=1.0)
    sdf = spark.createDataFrame([(s[0], s[2], s[1], s[3]) for s in st], "sid string, lat double, lon double, alt double")
    g = spark.createDataFrame(rows, "t timestamp_ntz, sid string, v double")
    expected = set()
    for t in {r[0] for r in rows}:
        expected |= {(t, s) for s in model(st, {s: v for tt, s, v in rows if tt == t}, {}, prm, False)}
    for plan in ("scan", "rounds"):
        got = {(r.t, r.sid) for r in SP.sct(g, sdf, prm, plan=plan).where(F.col("sct_flag")).collect()}
        assert got == expected and expected


@pytest.mark.parametrize("plan", ["scan", "rounds", "closed"])
def test_only_checked_stations_are_tested(spark, plan):
    """Radii over the whole network: the lowest checked station alone is tested, by both plans."""
    st, rows = _case(7)
    prm = SctParams(inner_radius=1.0, outer_radius=1.0, num_min=3, num_max=5, pos_threshold=0.2, neg_threshold=0.2)
    sdf = spark.createDataFrame([(s[0], s[2], s[1], s[3], {4: True, 9: True, 2: None}.get(s[0], False)) for s in st],
                                "sid long, lat double, lon double, alt double, chk boolean")
    g = spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double")
    got = {r.sid for r in SP.sct(g, sdf, prm, plan=plan, to_check="chk").where(F.col("sct_flag")).collect()}
    assert got == {4}


def test_components_of_a_chain(spark):
    """A chain of stations in shuffled id order is one component, a station apart its own."""
    ids = list(range(40))
    random.Random(3).shuffle(ids)
    sdf = spark.createDataFrame([(s, 46.0, 11.0 + 0.01 * k, 0.0) for k, s in enumerate(ids)] + [(99, 50.0, 11.0, 0.0)],
                                "sid long, lat double, lon double, alt double")
    prm = SctParams(inner_radius=0.005, outer_radius=0.0101)
    got = {r.sid: r.comp for r in SP.scan_components(sdf, prm).collect()}
    assert got == {**{s: 0 for s in ids}, 99: 99}


def test_rounds_on_one_component_of_5000_stations(spark, monkeypatch):
    """A connected strip of 5,000 stations: the rounds flag what the scan flags, without a Python
    node, in a few rounds; the general plan picks them by the size of the component."""
    rnd = random.Random(21)
    n, hours = 5000, 2
    ids = list(range(n))
    rnd.shuffle(ids)
    st = [(s, 46.0 + rnd.random() * 0.02, 11.0 + k * 0.003, 200.0 + rnd.randrange(0, 300)) for k, s in enumerate(ids)]
    sdf = spark.createDataFrame(st, "sid long, lat double, lon double, alt double").repartition(8)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=h), s, None if rnd.random() < 0.01 else round(10 + rnd.gauss(0, 2), 3)) for h in range(hours) for s in ids]
    g = spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double").repartition(8).checkpoint()
    prm = SctParams(inner_radius=0.004, outer_radius=0.02, num_min=3, num_max=5, pos_threshold=1.0, neg_threshold=1.0)
    assert SP.scan_components(sdf, prm).select("comp").distinct().count() == 1
    scan = {(r.t, r.sid) for r in SP.sct(g, sdf, prm, plan="scan").where("sct_flag").collect()}
    asked = []
    monkeypatch.setattr(SP, "sct_rounds", lambda *a: asked.append(1) or rounds(*a))
    out = SP.sct(g, sdf, prm)
    assert asked == [1]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan
    got = {(r.t, r.sid) for r in out.where("sct_flag").collect()}
    assert got == scan and len(got) > 200 and out.count() == n * hours
    levels = SP.scan_levels(sdf, prm).groupBy("level").count().collect()
    assert 5 < len(levels) < 60 and sum(r["count"] for r in levels) <= n
