"""Steps of the findings of round 4: the same results without shuffles of the dense grid."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stationqc.operators import buddy as B
from stationqc.operators import completeness as C
from stationqc.operators import geo as Geo
from stationqc.operators import grid as G
from stationqc.operators import runs as R
from stationqc.operators import temporal as T
from stationqc.params import BuddyParams
from stationqc.plans import propagate as P
from stationqc.plans import q_propagate as QP
from stationqc.plans.catalog import QUERIES, cells_l, month_str
from stationqc.sources import fixtures as X

T0 = dt.datetime(1995, 1, 20)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sorted(df):
    return sorted(map(str, df.collect()))


def _lineitem(spark, path, suppliers=30, days=150, share=0.4):
    """Daily readings with holes, some repeated, with null keys, times and values."""
    rnd = random.Random(4)
    rows = [(s, T0 + dt.timedelta(days=d), float(rnd.randrange(1, 51))) for s in range(suppliers) for d in range(days)
            if rnd.random() < share and not (s == 5 and d > 40)]
    rows += [(3, T0, 9.0), (3, T0, 30.0), (None, T0, 4.0), (None, T0 + dt.timedelta(days=3), 40.0), (4, None, 8.0), (7, T0, None), (99, None, 1.0)]
    spark.createDataFrame(rows, "l_suppkey long, l_shipdate timestamp_ntz, l_quantity double").write.parquet(f"{path}/lineitem.parquet")
    return path


def test_monthly_completeness_shuffles_cells_but_no_grid(spark, tmpdir_path):
    sf = _lineitem(spark, tmpdir_path)
    got = QUERIES["monthly_completeness"](spark, sf)
    p = _plan(got)
    assert p.count("Exchange hashpartitioning(sid") == 1 and "SortMergeJoin" not in p
    g = G.dense_grid(cells_l(spark, sf)).withColumn("flag", F.col("v").isNotNull())
    want = C.completeness_temporal(g, "flag", 0.2, out="out").groupBy("sid", month_str().alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_or("month_bad").alias("month_bad"),
        F.count_if("day_bad").alias("n_day_bad"), F.count_if("out").alias("n_out"))
    assert _sorted(got) == _sorted(want) and got.count() == 30 * 6


def test_a_large_grid_is_dealt_into_more_parts(spark, monkeypatch):
    cells = spark.createDataFrame([(T0 + dt.timedelta(hours=h), s, 1.0) for h in range(20) for s in range(5)], "t timestamp_ntz, sid long, v double")
    axis = G.time_axis(cells)
    assert G.grid_parts(cells, axis) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(G, "TASK_CELLS", 9)
    assert G.grid_parts(cells, axis) == 12
    assert G.dense_grid(cells.where("sid < 4 OR hour(t) < 3"), axis, parts=12).exceptAll(G.dense_grid(cells.where("sid < 4 OR hour(t) < 3"))).isEmpty()


def test_propagated_flags_are_the_full_run_without_joins_of_grids(spark, tmpdir_path):
    sf = _lineitem(spark, tmpdir_path)
    got = QUERIES["propagated_flags"](spark, sf)
    p = _plan(got)
    assert "LeftAnti" not in p and "Exchange hashpartitioning(t#" not in p
    new = G.dense_grid(cells_l(spark, sf)).withColumn("v", QP.change()).checkpoint()
    step = T.temporal_step(new, QP.STEP).groupBy("sid").agg(F.count_if("step_suspect").alias("n_step"))
    roll = T.rolling_zscore(new, QP.WINDOW, QP.Z, QP.SAMPLES).groupBy("sid").agg(F.count_if(~F.col("roll_good")).alias("n_roll_bad"))
    buddy = B.buddy_check(new, X.station_dim(new), QP.BUDDY).groupBy("sid").agg(F.count_if("buddy_suspect").alias("n_buddy"))
    out = C.completeness_temporal(new.withColumn("f", F.col("v").isNotNull()), "f", QP.SHARE, out="o").groupBy("sid").agg(F.count_if("o").alias("n_out"))
    want = step.join(roll, "sid").join(buddy, "sid").join(out, "sid")
    assert _sorted(got) == _sorted(want) and got.count() == 30 and got.agg(F.sum("n_roll_bad")).first()[0] > 0


def _cells_with_odd_keys(spark, second):
    """Cells of two grids: other values, repeated and null keys, cells of one grid alone."""
    h = [T0 + dt.timedelta(days=d) for d in range(120)]
    rows = [(h[d], s, None if d % 7 == s else float(d + s)) for d in range(120) for s in range(4)]
    if second:
        rows = [(t, s, v + 1.0 if s == 1 and t.month == 3 and v is not None else v) for t, s, v in rows]
        rows += [(h[119] + dt.timedelta(days=40), 2, 5.0), (h[119] + dt.timedelta(days=80), 3, None), (h[0], 3, 4.0), (h[5], None, 7.0), (None, 2, None)]
    else:
        rows += [(h[0], 3, 3.0), (h[40], None, 6.0), (h[80], None, None), (None, 1, 8.0), (h[60], 0, 60.0)]
    return spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double")


def test_changed_months_as_the_outer_join_gives_them(spark):
    old, new = (_cells_with_odd_keys(spark, second).checkpoint() for second in (False, True))
    j = old.withColumnRenamed("v", "a").join(new.withColumnRenamed("v", "b"), ["t", "sid"], "full_outer")
    want = j.where("NOT a <=> b").select("sid", (F.year("t") * 12 + F.month("t") - 1).alias("mk")).distinct()
    assert _sorted(P.changed_months(old, new)) == _sorted(want) and want.count() >= 6
    lies = [G.spread(g, "sid", parts=5) for g in (old, new)]
    assert _plan(P.changed_months(*lies)).count("Exchange hashpartitioning(sid") == 2
    assert "Join" not in _plan(P.changed_months(*lies))


def test_splice_keeps_repeated_and_null_keys(spark):
    stored, redone = (_cells_with_odd_keys(spark, second) for second in (False, True))
    redone = redone.where("sid IS NULL OR t IS NULL OR sid = 1 OR day(t) = 20")
    want = stored.join(redone.select("t", "sid"), ["t", "sid"], "left_anti").unionByName(redone)
    assert _sorted(P.splice(stored, redone)) == _sorted(want) == _sorted(P.splice(stored, redone, parts=5))
    p = _plan(P.splice(G.spread(stored, "sid", parts=5), redone, parts=5))
    assert p.count("Exchange") == 2 and "Join" not in p


def test_buddy_check_by_station_leaves_missing_cells_where_they_are(spark, tmpdir_path):
    cells = cells_l(spark, _lineitem(spark, tmpdir_path))
    g = G.dense_grid(cells).withColumn("also", F.dayofmonth("t")).checkpoint()
    prm = BuddyParams(radius=6000.0, num_min=2, threshold=1.2, max_elev_diff=400.0, elev_gradient=-0.0065)
    st = X.station_dim(g)
    want = B.buddy_check(g, st, prm)
    got = B.buddy_check(G.spread(g, "sid", parts=5), st, prm, parts=5)
    assert got.columns == want.columns and _sorted(got) == _sorted(want)
    assert {r.buddy_suspect for r in want.where("v IS NOT NULL").collect()} == {True, False}
    assert _plan(got.groupBy("sid").count()).split("Union")[0].count("Exchange") == 0


def test_station_days_write_out_days_after_the_shuffle(spark, tmpdir_path):
    cells = cells_l(spark, _lineitem(spark, tmpdir_path)).where("t IS NOT NULL")
    held = R.run_grid(cells)
    p = _plan(R.station_days(held, 0.04, parts=5))
    assert ", day#" not in "".join(line for line in p.split("Generate")[0].splitlines() if "Exchange hashpartitioning" in line)
    dense = G.dense_grid(cells).withColumn("f", F.col("v").isNotNull())
    cols = ("sid", "day", "n_good", "day_bad", "month_bad")
    assert _sorted(R.station_days(held, 0.04).select(*cols)) == _sorted(C.station_days(dense, "f", 0.04).select(*cols))
    some = R.RunGrid(held.cells.where("sid <> 3"), held.days, held.months, held.stations)       # station 3 has no cell
    assert R.station_days(some, 0.04).where("sid = 3 AND n_good = 0 AND day_bad").count() == held.days.count()


def test_neighbour_values_are_the_joined_ones(spark, monkeypatch):
    """Blocks of few positions, odd times, repeated and null keys and values: the rows of the plain joins."""
    monkeypatch.setattr(Geo, "BLOCK", 7)
    rnd = random.Random(6)
    rows = [(T0 + dt.timedelta(minutes=37 * h), s, rnd.random()) for h in range(60) for s in range(8) if rnd.random() < 0.7]
    rows += [rows[3], (rows[3][0], rows[3][1], 50.0), rows[90], (None, 1, 1.0), (T0, None, 2.0), (T0, 2, None), (T0, 20, 3.0)]
    cells = spark.createDataFrame(rows, "t timestamp_ntz, sid long, v double")
    links = [(i, j, float(abs(i - j)), None if j == 6 else 1.5 * j) for i in range(8) for j in range(8) if 0 < abs(i - j) < 3]
    links += [links[0], (3, 77, 1.0, 1.0), (77, 3, 1.0, 1.0), (None, 2, 1.0, 1.0), (2, None, 1.0, 1.0), (20, 2, 9.0, None), (2, 2, 0.0, 0.0)]
    pairs = spark.createDataFrame(links, "i long, j long, dist double, da double")
    a = cells.select("t", F.col("sid").alias("i"), F.col("v").alias("v_i"))
    b = cells.select("t", F.col("sid").alias("j"), F.col("v").alias("v_j"))
    want = a.join(pairs, "i").join(b, ["t", "j"]).select("t", "i", "v_i", "j", "v_j", "dist", "da")
    got = Geo.neighbour_values(cells, pairs)
    assert got.columns == want.columns and _sorted(got) == _sorted(want) == _sorted(Geo.neighbour_values(cells, pairs, G.time_axis(cells), 3))
    assert len(_sorted(got)) > 900


def test_background_groups_neighbour_values_where_they_lie(spark):
    cells = spark.createDataFrame([], "t timestamp_ntz, sid long, v double")
    pairs = spark.createDataFrame([], "i long, j long, dist double, da double")
    axis = spark.createDataFrame([], "t timestamp_ntz, idx long, n_times long")
    p = _plan(Geo.idw_background(Geo.neighbour_values(cells, pairs, axis, 5)))
    after = p.split("hashpartitioning(i#")[0]
    assert "Window" in after and "hashpartitioning" not in after          # cells x neighbours cross no shuffle
