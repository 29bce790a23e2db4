"""Ingest operators: payloads, request plan, keep-last merge, files, streaming."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from stationqc.sources import files as Fi
from stationqc.sources import ingest as I
from stationqc.sources import payloads as P
from stationqc.streaming import ingest as S

STATION_DOC = {"status": "ok", "body": [
    {"_id": "st-a", "place": {"location": [11.30, 46.45], "altitude": 250, "city": "Town A",
                                          "country": "IT", "timezone": "Europe/Rome", "street": "Via A"},
     "module_types": {"m-9": "indoor", "m-2": P.OUTDOOR_TYPE,
                      "m-1": P.OUTDOOR_TYPE}},
    {"_id": "st-b", "place": {"location": [11.31, 46.46]}, "module_types": {"x": "rain"}},
]}


def test_station_payload(spark):
    docs = [json.dumps(STATION_DOC), json.dumps({"status": "failed", "body": STATION_DOC["body"]}),
            json.dumps({"status": "ok"})]
    df = spark.createDataFrame([(d,) for d in docs], "json string")
    out = {r.station_id: r for r in P.parse_station_payload(df).collect()}
    assert len(out) == 2
    a, b = out["st-a"], out["st-b"]
    assert (a.latitude, a.longitude, a.altitude) == (46.45, 11.30, 250.0)
    assert a.module1_id == "m-2" and a.module1_type == P.OUTDOOR_TYPE   # first in document order
    assert b.module1_id == "" and b.altitude is None and b.city == "Unknown" and b.timezone == "Unknown"
    s = P.station_list_summary(P.parse_station_payload(df)).first()
    assert (s.n_stations, s.n_with_module) == (2, 1)
    assert P.eligible_stations(P.parse_station_payload(df)).count() == 1
    with pytest.raises(ValueError):
        P.bbox_filter(P.parse_station_payload(df), (46.0, 11.0), (46.5, 10.0))
    assert P.bbox_filter(P.parse_station_payload(df), (46.455, 11.305), (46.40, 11.20)).count() == 1


def test_measure_payload(spark):
    docs = [("s1", json.dumps({"body": {"1609459200": [15.5], "1609462800": [16.0]}})),
            ("s2", json.dumps({"body": {}})), ("s3", json.dumps({}))]
    df = spark.createDataFrame(docs, "station_id string, json string")
    rows = sorted((r.station_id, r.ts, r.temperature) for r in P.parse_measure_payload(df).collect())
    assert rows == [("s1", dt.datetime(2021, 1, 1, 0), 15.5), ("s1", dt.datetime(2021, 1, 1, 1), 16.0)]


def _loop_plan(b, now, chunk):
    out, k = [], 0
    while b < now:
        e = min(b + chunk * 3600, now)
        out.append((k, b, e))
        b = (e // 3600) * 3600 + 3600
        k += 1
    return out


def test_fetch_plan_closed_form_matches_loop(spark):
    rnd = random.Random(7)
    now = dt.datetime(2024, 6, 1, 12, 34, 56)
    now_e = int((now - dt.datetime(1970, 1, 1)).total_seconds())
    starts = []
    for k in range(300):
        b = now_e - rnd.randrange(-7200, 400 * 3600)
        starts.append((f"s{k}", dt.datetime(1970, 1, 1) + dt.timedelta(seconds=b), b))
    df = spark.createDataFrame([(s, t) for s, t, _ in starts], "station_id string, fetch_from timestamp_ntz")
    for chunk in (1, 24, 1024):
        got = sorted((r.station_id, r.chunk, r.begin_epoch, r.end_epoch) for r in I.fetch_plan(df, now, chunk).collect())
        exp = sorted((s, k, bb, e) for s, _, b in starts for k, bb, e in _loop_plan(b, now_e, chunk))
        assert got == exp


def test_marks_and_start(spark):
    obs = spark.createDataFrame([("a", dt.datetime(2024, 1, 5, 3)), ("a", dt.datetime(2024, 1, 6, 4)),
                                 ("b", dt.datetime(2019, 12, 31, 23))], "station_id string, ts timestamp_ntz")
    marks = {r.station_id: r.mark for r in I.high_water_mark(obs).collect()}
    assert marks == {"a": dt.datetime(2024, 1, 6, 4), "b": None}
    st = spark.createDataFrame([("a",), ("b",), ("c",)], "station_id string")
    fs = {r.station_id: r.fetch_from for r in I.fetch_start(st, I.high_water_mark(obs), start="2024-01-01").collect()}
    assert fs == {"a": dt.datetime(2024, 1, 6, 5), "b": dt.datetime(2024, 1, 1), "c": dt.datetime(2024, 1, 1)}
    fs2 = {r.station_id: r.fetch_from for r in I.fetch_start(st, I.high_water_mark(obs), now="2024-12-31").collect()}
    assert fs2["c"] == dt.datetime(2024, 1, 1)


def test_merge_keep_last_idempotent(spark):
    t = dt.datetime(2024, 1, 1)
    a = spark.createDataFrame([("s", t, 1.0), ("s", t + dt.timedelta(hours=1), 2.0)], "station_id string, ts timestamp_ntz, temperature double")
    b = spark.createDataFrame([("s", t + dt.timedelta(hours=1), 5.0)], "station_id string, ts timestamp_ntz, temperature double")
    m = I.merge_keep_last(a, b, columns=["station_id", "ts", "temperature"])
    assert sorted(r.temperature for r in m.collect()) == [1.0, 5.0]
    m2 = I.merge_keep_last(m, b, columns=["station_id", "ts", "temperature"])
    assert sorted(tuple(r) for r in m2.collect()) == sorted(tuple(r) for r in m.collect())


def test_files_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([(json.dumps(STATION_DOC),)], "json string")
    st = P.parse_station_payload(df).withColumn("extra", F.lit(1))
    Fi.write_station_list(st, f"{tmpdir_path}/stations")
    back = Fi.read_station_list(spark, f"{tmpdir_path}/stations")
    from stationqc.schemas import STATION_LIST_COLUMNS
    assert back.columns == STATION_LIST_COLUMNS
    assert back.count() == 2 and back.where("altitude IS NULL").count() == 1
    obs = spark.createDataFrame([("s1", dt.datetime(2024, 1, 1, 1), 3.5, 11.3, 46.4, None),
                                 ("s2", dt.datetime(2024, 1, 1, 2), 4.5, 11.3, 46.4, 250.0)],
                                "station_id string, ts timestamp_ntz, temperature double, longitude double, latitude double, altitude double")
    Fi.write_observation_files(obs, f"{tmpdir_path}/obs")
    rb = {r.station_id: r for r in Fi.read_observation_files(spark, f"{tmpdir_path}/obs").collect()}
    assert rb["s1"].altitude is None and rb["s2"].altitude == 250.0 and rb["s1"].ts == dt.datetime(2024, 1, 1, 1)
    Fi.layered_write(obs, f"{tmpdir_path}/store", "raw")
    Fi.layered_write(obs, f"{tmpdir_path}/store", "processed")
    inv = {r.layer: r.n_files for r in Fi.layer_inventory(spark, f"{tmpdir_path}/store").collect()}
    assert inv["raw"] >= 1 and inv["processed"] >= 1
    with pytest.raises(ValueError):
        Fi.layered_write(obs, f"{tmpdir_path}/store", "other")


def test_qc_dataset_metadata(spark, tmpdir_path):
    g = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, 2.0, True)], "t timestamp_ntz, sid long, v_qc double, final_good boolean")
    stats = spark.createDataFrame([(1, 1)], "total_values long, good_values long")
    Fi.write_qc_dataset(g, stats, f"{tmpdir_path}/qc")
    d = spark.read.parquet(f"{tmpdir_path}/qc/data")
    assert d.schema["v_qc"].metadata["standard_name"] == "air_temperature"
    assert d.schema["final_good"].metadata["flag_meanings"] == "failed_qc passed_qc"
    assert spark.read.parquet(f"{tmpdir_path}/qc/dataset_meta").first().title.startswith("Quality")


def test_streaming_incremental_ingest(spark, tmpdir_path):
    land, table, ck = (os.path.join(tmpdir_path, x) for x in ("landing", "table", "ckpt"))
    os.makedirs(land)

    def land_file(name, docs):
        with open(os.path.join(land, name), "w") as f:
            for d in docs:
                f.write(json.dumps(d) + "\n")

    land_file("a.json", [{"station_id": "s1", "body": {"1609459200": [1.0], "1609462800": [2.0]}},
                         {"station_id": "s2", "body": {}}])
    q = S.start_ingest(spark, land, table, ck)
    q.awaitTermination(120)
    assert S.read_ingested(spark, table).count() == 2
    # second run: only the new file is consumed; the re-delivered hour overwrites
    land_file("b.json", [{"station_id": "s1", "body": {"1609462800": [9.0], "1609466400": [3.0]}}])
    q = S.start_ingest(spark, land, table, ck)
    q.awaitTermination(120)
    rows = {(r.station_id, r.ts): r.temperature for r in S.read_ingested(spark, table).collect()}
    assert rows == {("s1", dt.datetime(2021, 1, 1, 0)): 1.0, ("s1", dt.datetime(2021, 1, 1, 1)): 9.0,
                    ("s1", dt.datetime(2021, 1, 1, 2)): 3.0}
    assert len([d for d in os.listdir(table) if d.startswith("batch_id=")]) == 2


def test_streaming_seasonal_flag(spark, tmpdir_path):
    land, table, ck = (os.path.join(tmpdir_path, x) for x in ("landing", "table", "ckpt"))
    os.makedirs(land)
    with open(os.path.join(land, "a.json"), "w") as f:   # 2021-01-01: winter, DJF max 20
        f.write(json.dumps({"station_id": "s1", "body": {"1609459200": [25.0], "1609462800": [5.0]}}) + "\n")
    q = S.start_ingest(spark, land, table, ck, season_limits={"DJF": (-30.0, 20.0)})
    q.awaitTermination(120)
    got = {r.temperature: r.seasonal_good for r in S.read_ingested(spark, table, with_flag=True).collect()}
    assert got == {25.0: False, 5.0: True}


def test_merge_keep_last_repeats_inside_one_delivery(spark):
    t = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([("s", t, 1.0, "f0", 0)], "station_id string, ts timestamp_ntz, temperature double, file string, pos int")
    new = spark.createDataFrame([("s", t, float(v), "f1", p) for p, v in enumerate((9, 2, 7, 5))], old.schema)
    for n in (1, 3, 17):
        got = I.merge_keep_last(old, new.repartition(n), arrival=("file", "pos"), columns=["station_id", "ts", "temperature"])
        assert [r.temperature for r in got.collect()] == [5.0]                # the last appended
        tied = I.merge_keep_last(old.drop("file", "pos"), new.drop("file", "pos").repartition(n))
        assert [r.temperature for r in tied.collect()] == [9.0]               # no arrival order: by value


def test_inventory_below_a_base_named_like_a_layer(spark, tmpdir_path):
    base = f"{tmpdir_path}/raw/net"
    Fi.layered_write(spark.range(3).withColumn("station_id", F.lit("a")), base, "qc")
    assert {r.layer for r in Fi.layer_inventory(spark, base).collect()} == {"qc"}
    files = Fi.file_inventory(spark, base + "/").collect()
    assert files and all(r.layer == "qc" and r.name.startswith("qc/") and r.n_bytes > 0 for r in files)


def test_slice_time_with_an_unusable_bound(spark):
    from stationqc.operators.grid import slice_time
    g = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS t UNION ALL SELECT timestamp_ntz'2024-01-02 00:00:00'")
    assert slice_time(g, "garbage", None).count() == 2 and slice_time(g, "2024-01-02", "nonsense").count() == 1
