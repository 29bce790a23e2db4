"""The keyed series table, its state, and the rejects beside it."""

import datetime as dt
import json
import os

import pytest

from stationqc.sources import files as Fi
from stationqc.sources import ingest as I
from stationqc.sources import payloads as P
from stationqc.sources import series as Se
from stationqc.streaming import ingest as S

T0 = dt.datetime(2024, 1, 30)
H = dt.timedelta(hours=1)
OBS = "station_id string, ts timestamp_ntz, temperature double"


def obs(spark, *rows):
    return spark.createDataFrame([(s, T0 + h * H, v) for s, h, v in rows], OBS)


def content(spark, table):
    return sorted((r.station_id, r.ts, r.temperature, r.delivery) for r in Se.read_series(spark, table).collect())


def files_of(table):
    return {os.path.join(d, f) for d, _, fs in os.walk(f"{table.path}/data") for f in fs if f.endswith(".parquet")}


FIRST = [("a", 0, 1.0), ("a", 1, 2.0), ("a", 60, 3.0), ("b", 0, 4.0), ("b", 0, 5.0), ("c", 30, None)]
SECOND = [("a", 1, 9.0), ("a", 2, 8.0), (None, 3, 1.0)]


def test_upsert_keeps_last_and_rewrites_only_what_it_touches(spark, tmpdir_path):
    table = Se.SeriesTable(f"{tmpdir_path}/s", buckets=4)
    assert Se.read_series(spark, table).count() == 0 and Se.read_marks(spark, table).count() == 0
    assert Se.upsert_series(spark, table, obs(spark, *FIRST), 0)
    before = files_of(table)
    assert Se.upsert_series(spark, table, obs(spark, *SECOND), 7)
    after = files_of(table)
    jan_a = {f for f in before if "period=2024-01" in f} - after
    assert jan_a and before - after == jan_a and all("period=2024-02" in f or "period=2024-01" in f for f in before)
    assert any("period=2024-02" in f for f in before & after)            # the other month was not touched
    want = [("a", T0, 1.0, 0), ("a", T0 + H, 9.0, 7), ("a", T0 + 2 * H, 8.0, 7), ("a", T0 + 60 * H, 3.0, 0), ("b", T0, 5.0, 0), ("c", T0 + 30 * H, None, 0)]
    assert content(spark, table) == want
    # the read is a scan
    plan = Se.read_series(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan
    # again: nothing changes, not even a file
    assert not Se.upsert_series(spark, table, obs(spark, *SECOND), 7) and files_of(table) == after
    marks = {r.station_id: (r.mark, r.n_delivered, r.n_late, r.hours, r.gap_hours) for r in Se.read_marks(spark, table).collect()}
    assert marks == {"a": (T0 + 60 * H, 5, 2, 4, 57), "b": (T0, 2, 0, 1, 0), "c": (T0 + 30 * H, 1, 0, 1, 0)}
    assert marks["a"][0] == {r.station_id: r.mark for r in I.high_water_mark(Se.read_series(spark, table)).collect()}["a"]
    assert Se.read_manifest(spark, table).select("delivery").distinct().count() == 2


@pytest.mark.parametrize("step", ["_rewrite", "_advance_marks"])
def test_a_delivery_that_broke_off_is_repeated_whole(spark, tmpdir_path, monkeypatch, step):
    clean, torn = Se.SeriesTable(f"{tmpdir_path}/clean", buckets=2), Se.SeriesTable(f"{tmpdir_path}/torn", buckets=2)
    for table in (clean, torn):
        Se.upsert_series(spark, table, obs(spark, *FIRST), 0)
    Se.upsert_series(spark, clean, obs(spark, *SECOND), 1)
    whole = getattr(Se, step)

    def broken(*args):
        if step == "_advance_marks" or args[1].endswith("/counts"):
            raise RuntimeError("executor lost")
        whole(*args)
    with monkeypatch.context() as m:
        m.setattr(Se, step, broken)
        with pytest.raises(RuntimeError):
            Se.upsert_series(spark, torn, obs(spark, *SECOND), 1)
    assert Se.upsert_series(spark, torn, obs(spark, *SECOND), 1)
    assert content(spark, torn) == content(spark, clean)
    assert sorted(map(str, Se.read_marks(spark, torn).collect())) == sorted(map(str, Se.read_marks(spark, clean).collect()))


def test_empty_delivery_and_compaction(spark, tmpdir_path):
    table = Se.SeriesTable(f"{tmpdir_path}/s", buckets=1)
    assert Se.upsert_series(spark, table, obs(spark), 0) and not Se.upsert_series(spark, table, obs(spark), 0)
    Se.upsert_series(spark, table, obs(spark, *FIRST), 1)
    rows = content(spark, table)
    part = spark.read.parquet(f"{table.path}/data").where("period = '2024-01'")
    part.select("station_id", "ts", "temperature", "delivery").checkpoint().repartition(3).write.mode("overwrite").parquet(
        f"{table.path}/data/period=2024-01/bucket=0")
    assert len([f for f in files_of(table) if "2024-01" in f]) == 3
    assert Se.compact_series(spark, table, max_files=2) == 1 and Se.compact_series(spark, table, max_files=2) == 0
    assert content(spark, table) == rows


def test_measure_entries_lose_nothing(spark):
    docs = [("s1", '{"body": {"1609459200": [1.5, 2], "1609462800": [null], "1609466400": [], "1609470000": null}}'),
            ("s2", '{"body": {"x": [1.0], "1609459200": ["n/a"], "1609462800": 5, "1609466400": [7], "99999999999999": [1]}}'),
            ("s3", '{"body": {"1609459200": [1.0'), ("s4", "[]"), ("s5", None), ("s6", '{"body": {}}'), ("s7", "{}"),
            (None, '{"body": {"1609459200": [1.0]}}'), ("s8", '{"body": 5}'), ("s9", '{"body": {"1609459200.5": [1], "1609459200": ["3.5"]}}')]
    rows = P.measure_entries(spark.createDataFrame(docs, "station_id string, json string")).collect()
    ok = sorted(((r.station_id, r.ts.hour, r.temperature) for r in rows if r.reason is None), key=str)
    assert ok == sorted([("s1", 0, 1.5), ("s1", 1, None), ("s1", 2, None), ("s1", 3, None), ("s2", 2, 7.0), ("s9", 0, 3.5)], key=str)
    bad = sorted((str(r.station_id), r.reason) for r in rows if r.reason)
    assert bad == sorted([("s2", "bad_epoch"), ("s2", "bad_value"), ("s2", "bad_value"), ("s2", "bad_epoch"), ("s3", "bad_json"), ("s4", "bad_json"),
                          ("s5", "bad_json"), ("None", "no_station"), ("s8", "bad_json"), ("s9", "bad_epoch")])
    assert {r.raw for r in rows if r.reason == "bad_json"} >= {docs[2][1], "[]", None}
    assert P.parse_measure_payload(spark.createDataFrame(docs, "station_id string, json string")).count() == len(ok)


def test_csv_lines_lose_nothing(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/obs")
    with open(f"{tmpdir_path}/obs/a.csv", "w") as f:
        f.write("ts,temperature,longitude,latitude,altitude,station_ID\n2024-01-01 01:00:00,3.5,11.3,46.4,Unknown,s1\n"
                "2024-01-01 02:00:00,warm,11.3,46.4,200,s1\nyesterday,3.5,11.3,46.4,200,s1\n2024-01-01 03:00:00,3.5\n"
                "2024-01-01 04:00:00,,11.3,46.4,200.5,s2\n2024-01-01 05:00:00,1.0,11.3,46.4,200.5,\n")
    lines = Fi.observation_lines(spark, f"{tmpdir_path}/obs").collect()
    assert sorted(str(r.reason) for r in lines) == ["None", "None", "bad_line", "bad_line", "bad_time", "no_station"]
    assert {r.raw for r in lines if r.reason == "bad_line"} == {"2024-01-01 02:00:00,warm,11.3,46.4,200,s1", "2024-01-01 03:00:00,3.5"}
    kept = {r.station_id: (r.temperature, r.altitude) for r in Fi.read_observation_files(spark, f"{tmpdir_path}/obs").collect()}
    assert kept == {"s1": (3.5, None), "s2": (None, 200.5)}
    os.makedirs(f"{tmpdir_path}/list")
    with open(f"{tmpdir_path}/list/a.csv", "w") as f:
        f.write(",".join(Fi.STATION_LIST_COLUMNS) + "\ns1,m,o,46.1,11.2,200,c,d,e,z\ns2,m,o,north,11.2,200,c,d,e,z\n")
    assert sorted(str(r.reason) for r in Fi.station_lines(spark, f"{tmpdir_path}/list").collect()) == ["None", "bad_line"]
    assert [r.station_id for r in Fi.read_station_list(spark, f"{tmpdir_path}/list").collect()] == ["s1"]


def test_stream_survives_bad_documents(spark, tmpdir_path):
    table = Se.SeriesTable(f"{tmpdir_path}/series", buckets=2)
    rejects, land = f"{tmpdir_path}/rejects", f"{tmpdir_path}/landing"
    os.makedirs(land)

    def run(name, *docs):
        with open(f"{land}/{name}", "w") as f:
            f.writelines((d if isinstance(d, str) else json.dumps(d)) + "\n" for d in docs)
        S.start_series_ingest(spark, land, table, rejects, f"{tmpdir_path}/progress").awaitTermination(120)

    run("a.json", {"station_id": "s1", "body": {"1609459200": [1.0], "x": [2.0]}}, '{"station_id": "s2", "body": {"16094')
    run("b.json", {"station_id": "s1", "body": {"1609459200": [7.0], "1609462800": [3.0]}}, {"station_id": "s3", "body": {}})
    assert [(s, v) for s, _, v, _ in content(spark, table)] == [("s1", 7.0), ("s1", 3.0)]
    assert sorted((r.reason, r.batch_id) for r in S.read_rejects(spark, rejects).collect()) == [("bad_epoch", 0), ("bad_json", 0)]
    mark, = Se.read_marks(spark, table).collect()
    assert (mark.mark, mark.n_late, mark.gap_hours) == (dt.datetime(2021, 1, 1, 1), 1, 0)
    # a retried batch changes nothing
    S.deliver(spark, spark.createDataFrame([('{"station_id": "s1", "body": {"1609459200": [99.0]}}',)], "value string"), table, rejects, 1)
    assert [v for _, _, v, _ in content(spark, table)] == [7.0, 3.0]
