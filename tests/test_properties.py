"""Property tests (hypothesis) for the ingest bookkeeping."""

import datetime as dt

from hypothesis import example, given, HealthCheck, settings
from hypothesis import strategies as st

from stationqc.sources import ingest as I

T0 = dt.datetime(2024, 1, 1)
rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 30),
                          st.floats(-40, 40, allow_nan=False)), max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=rows, new=rows)
def test_merge_keep_last_properties(spark, old, new):
    def df(rs):
        uniq = {(s, h): v for s, h, v in rs}
        return spark.createDataFrame([(s, T0 + dt.timedelta(hours=h), v) for (s, h), v in uniq.items()],
                                     "station_id string, ts timestamp_ntz, temperature double")
    a, b = df(old), df(new)
    m = I.merge_keep_last(a, b, columns=["station_id", "ts", "temperature"])
    got = {(r.station_id, r.ts): r.temperature for r in m.collect()}
    exp = {(s, T0 + dt.timedelta(hours=h)): v for s, h, v in old}
    exp = {k: v for k, v in exp.items()}
    newd = {(s, T0 + dt.timedelta(hours=h)): v for s, h, v in new}
    exp.update(newd)                                   # later delivery wins
    assert got == exp
    again = I.merge_keep_last(m, b, columns=["station_id", "ts", "temperature"])
    assert {(r.station_id, r.ts): r.temperature for r in again.collect()} == got   # idempotent


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@example(offsets=[3601], chunk=1)
@given(offsets=st.lists(st.integers(-3600, 300 * 3600), min_size=1, max_size=20), chunk=st.integers(1, 200))
def test_fetch_plan_chunks_are_disjoint_and_cover(spark, offsets, chunk):
    now = dt.datetime(2024, 3, 1, 7, 30)
    starts = spark.createDataFrame([(f"s{k}", now - dt.timedelta(seconds=o)) for k, o in enumerate(offsets)],
                                   "station_id string, fetch_from timestamp_ntz")
    plan = {}
    for r in I.fetch_plan(starts, now, chunk).collect():
        plan.setdefault(r.station_id, []).append((r.chunk, r.begin_epoch, r.end_epoch))
    now_e = int((now - dt.datetime(1970, 1, 1)).total_seconds())
    for k, o in enumerate(offsets):
        chunks = sorted(plan.get(f"s{k}", []))
        if o <= 0:
            assert not chunks
            continue
        assert [c[0] for c in chunks] == list(range(len(chunks)))
        assert chunks[0][1] == now_e - o
        # a chunk that ends within the current hour is the last: the next would begin after now
        last = chunks[-1][2]
        assert last <= now_e and last // 3600 * 3600 + 3600 >= now_e // 3600 * 3600
        for (_, b1, e1), (_, b2, _) in zip(chunks, chunks[1:]):
            assert e1 < b2 and b2 - e1 <= 3600      # disjoint, next request starts on the next hour
        assert all(e - b <= chunk * 3600 for _, b, e in chunks)
