"""Plan-shape tests and properties of the composed plans."""

from pyspark.sql import functions as F

from stationqc.operators import completeness as C
from stationqc.operators import grid as G
from stationqc.operators.buddy import buddy_check
from stationqc.params import SEQUENTIAL_BUDDY, SEQUENTIAL_SCT, SEQUENTIAL_SEASON_LIMITS
from stationqc.plans import qc as Q
from stationqc.sources import fixtures as X

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dense_grid_has_no_product(spark):
    p = _plan(G.dense_grid(G.hourly_cells(X.events_obs(spark, SF))))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Generate" in p    # gap filling by sequence + explode


def test_scan_prunes_columns(spark):
    df = G.hourly_cells(X.events_obs(spark, SF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan


def test_buddy_expansion_is_map_side(spark):
    cells = G.hourly_cells(X.events_obs(spark, SF))
    df = buddy_check(G.dense_grid(cells), X.station_dim(cells), SEQUENTIAL_BUDDY)
    p = _plan(df)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BroadcastHashJoin" in p


def test_completeness_output_implies_input(spark):
    g = G.dense_grid(G.hourly_cells(X.events_obs(spark, SF))).withColumn("flag", F.col("v").isNotNull())
    out = C.completeness_temporal(g, "flag", 0.5, out="out")
    assert out.where(F.col("out") & ~F.col("flag")).count() == 0
    assert out.count() == g.count()


def test_completeness_is_aggregated(spark):
    """No window over station-months: the only window runs over the month table."""
    g = spark.createDataFrame([], "t timestamp_ntz, sid long, flag boolean")
    p = C.completeness_temporal(g, "flag", 0.5, out="out")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in p.splitlines() if line.lstrip(" :+-").startswith("Window")]
    assert windows and all("sid" not in line and "day" not in line for line in windows)
    assert p.count("Window") >= 1 and "collect_set" not in p


def test_selection_queries_build_no_dense_grid(spark):
    from stationqc.plans.catalog import QUERIES

    for name in ("history_span", "timeframe_label"):
        assert "Generate" not in _plan(QUERIES[name](spark, SF))


def test_sequential_levels_monotone(spark):
    cells = G.hourly_cells(X.events_obs(spark, SF))
    g = X.fill_rule(G.dense_grid(cells))
    r = Q.sequential_qc(g, X.station_dim(cells), SEQUENTIAL_SEASON_LIMITS, SEQUENTIAL_BUDDY, SEQUENTIAL_SCT, 0.8)
    s = r.stats.first()
    assert s.t_lvl0_valid >= s.t_lvl1_valid >= s.t_lvl2_valid >= s.t_lvl3_valid
    assert s.total_values == g.count()
    rep = {x.level: x.valid for x in Q.level_report(r).collect()}
    assert rep["t_lvl3"] == s.t_lvl3_valid
    ov = Q.temporal_overlay(r.grid).stats.first()
    assert ov.new_level == "t_lvl4" and ov.valid_values <= s.t_lvl3_valid


def test_batch_good_within_total(spark):
    cells = G.hourly_cells(X.events_obs(spark, SF))
    g = X.fill_rule(G.dense_grid(cells))
    r = Q.batch_qc(g, X.station_dim(cells))
    s = r.stats.first()
    assert 0 <= s.good_values <= s.total_values == g.count()
    vp = Q.valid_percent(r).first()
    assert vp.valid_values == s.good_values


def test_stored_grid_prunes_months(spark, tmpdir_path):
    from stationqc.sources.files import read_grid, write_grid

    g = G.dense_grid(G.hourly_cells(X.lineitem_obs(spark, SF)))
    write_grid(g, f"{tmpdir_path}/grid")
    s = read_grid(spark, f"{tmpdir_path}/grid", "1996-03-01 00:00:00", "1996-04-30 00:00:00")
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(t)" in plan
    expect = G.slice_time(g, "1996-03-01 00:00:00", "1996-04-30 00:00:00")
    assert sorted(map(tuple, s.select("t", "sid", "v").collect())) == sorted(map(tuple, expect.collect()))
