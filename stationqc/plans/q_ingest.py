"""Queries over ingest operators.

Payloads are JSON documents that Spark derives from the driver tables
(suppliers and nations become station discovery payloads; event readings
become measurement payloads), so every query grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stationqc.functions.columns import epoch_seconds
from stationqc.operators import grid as G
from stationqc.plans.catalog import cells_e, r4, register
from stationqc.plans.sqlfix import ALT, GRID, LAT, LON, e_cells
from stationqc.sources import fixtures as X
from stationqc.sources import ingest as I
from stationqc.sources import payloads as P
from stationqc.sources import series as Se
from stationqc.session import ensure_checkpoint_dir
from stationqc.streaming import ingest as S

NOW = "2024-02-01 00:00:00"
START = "2024-01-10 00:00:00"
SPLIT = "2024-01-15 00:00:00"
OVERLAP = "2024-01-13 00:00:00"
CHUNK = 168


def station_payloads(spark, sf):
    """Discovery payloads: up to 10 stations per document, every 7th document failed."""
    s = X.read_table(spark, sf, "supplier")
    n = X.read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    j = s.join(F.broadcast(n), s["s_nationkey"] == n["n_nationkey"], "left")   # nation: 25 rows
    k = F.col("s_suppkey")
    c = X.station_coords(k)
    mk = lambda suffix: F.concat(F.lit("m"), k.cast("string"), F.lit(suffix))
    modules = (F.when(k % 4 == 0, F.create_map(mk("a"), F.lit("indoor")))
               .when(k % 4 == 1, F.create_map(mk("b"), F.lit(P.OUTDOOR_TYPE), mk("a"), F.lit(P.OUTDOOR_TYPE)))
               .otherwise(F.create_map(mk("i"), F.lit("indoor"), mk("o"), F.lit(P.OUTDOOR_TYPE),
                                       mk("r"), F.lit("rain"))))
    place = F.struct(F.array(c["lon"], c["lat"]).alias("location"), c["alt"].alias("altitude"),
                     F.when(k % 3 != 0, F.col("s_name")).alias("city"), F.col("n_name").alias("country"),
                     F.when(k % 5 != 0, F.lit("Europe/Rome")).alias("timezone"),
                     F.when(k % 2 == 0, F.concat(F.lit("Via "), F.col("s_name"))).alias("street"))
    st = F.struct(F.concat(F.lit("st-"), k.cast("string")).alias("_id"), place.alias("place"),
                  modules.alias("module_types"))
    docs = j.groupBy((k / 10).cast("long").alias("doc")).agg(F.collect_list(st).alias("body"))
    status = F.when(F.col("doc") % 7 == 6, F.lit("failed")).otherwise(F.lit("ok"))
    return docs.select(F.to_json(F.struct(status.alias("status"), "body")).alias("json"))


def stations_from_payloads(spark, sf):
    return P.parse_station_payload(station_payloads(spark, sf))


_EXPECTED_STATIONS = f"""exp AS (SELECT 'st-' || s.s_suppkey AS station_id,
  CASE WHEN s.s_suppkey % 4 = 0 THEN '' WHEN s.s_suppkey % 4 = 1 THEN 'm' || s.s_suppkey || 'b'
       ELSE 'm' || s.s_suppkey || 'o' END AS module1_id,
  CASE WHEN s.s_suppkey % 4 = 0 THEN '' ELSE '{P.OUTDOOR_TYPE}' END AS module1_type,
  {LAT.format('s.s_suppkey')} AS latitude, {LON.format('s.s_suppkey')} AS longitude,
  {ALT.format('s.s_suppkey')} AS altitude,
  CASE WHEN s.s_suppkey % 3 <> 0 THEN s.s_name ELSE 'Unknown' END AS city, n.n_name AS country,
  CASE WHEN s.s_suppkey % 2 = 0 THEN 'Via ' || s.s_name ELSE 'Unknown' END AS street,
  CASE WHEN s.s_suppkey % 5 <> 0 THEN 'Europe/Rome' ELSE 'Unknown' END AS timezone
  FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey WHERE (s.s_suppkey // 10) % 7 <> 6)"""


@register("station_payload", f"""WITH {_EXPECTED_STATIONS}
SELECT station_id, module1_id, module1_type, round(latitude, 4) AS latitude, round(longitude, 4) AS longitude,
       altitude, city, country, street, timezone FROM exp""")
def q_station_payload(spark, sf):
    s = stations_from_payloads(spark, sf)
    return s.select("station_id", "module1_id", "module1_type", r4("latitude").alias("latitude"),
                    r4("longitude").alias("longitude"), "altitude", "city", "country", "street", "timezone")


@register("outdoor_module", f"""WITH {_EXPECTED_STATIONS}
SELECT module1_type, count(*)::BIGINT AS n, count(*) FILTER (WHERE module1_id LIKE '%b')::BIGINT AS n_first_of_two
FROM exp GROUP BY module1_type""")
def q_outdoor_module(spark, sf):
    s = stations_from_payloads(spark, sf)
    return s.groupBy("module1_type").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                         F.count_if(F.col("module1_id").endswith("b")).cast("long")
                                         .alias("n_first_of_two"))


@register("bbox", f"""WITH {_EXPECTED_STATIONS}
SELECT station_id FROM exp WHERE latitude BETWEEN 46.42 AND 46.75 AND longitude BETWEEN 11.28 AND 11.33""")
def q_bbox(spark, sf):
    return P.bbox_filter(stations_from_payloads(spark, sf), (46.75, 11.33), (46.42, 11.28)).select("station_id")


@register("station_summary", f"""WITH {_EXPECTED_STATIONS}
SELECT count(*)::BIGINT AS n_stations, count(*) FILTER (WHERE module1_id <> '')::BIGINT AS n_with_module FROM exp""")
def q_station_summary(spark, sf):
    return P.station_list_summary(stations_from_payloads(spark, sf))


@register("eligible_stations", f"""WITH {_EXPECTED_STATIONS}
SELECT station_id, module1_id FROM exp WHERE module1_id <> ''""")
def q_eligible_stations(spark, sf):
    return P.eligible_stations(stations_from_payloads(spark, sf)).select("station_id", "module1_id")


def obs_from_payloads(spark, sf, chunk=CHUNK):
    docs = I.measure_payloads(cells_e(spark, sf), chunk).withColumn(
        "station_id", F.concat(F.lit("st-"), F.col("sid").cast("string")))
    return P.parse_measure_payload(docs)


@register("measure_payload", f"""WITH {e_cells()}
SELECT 'st-' || sid AS station_id, t AS ts, round(v, 4) AS temperature FROM cells""")
def q_measure_payload(spark, sf):
    o = obs_from_payloads(spark, sf)
    return o.select("station_id", "ts", r4("temperature").alias("temperature"))


@register("attach_metadata", f"""WITH {e_cells()}, {_EXPECTED_STATIONS}
SELECT 'st-' || c.sid AS station_id, count(*)::BIGINT AS n, round(min(e.latitude), 4) AS latitude,
       round(min(e.longitude), 4) AS longitude, min(e.altitude) AS altitude
FROM cells c LEFT JOIN exp e ON e.station_id = 'st-' || c.sid GROUP BY 1""")
def q_attach_metadata(spark, sf):
    o = I.attach_station_metadata(obs_from_payloads(spark, sf), stations_from_payloads(spark, sf))
    return o.groupBy("station_id").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                       r4(F.min("latitude")).alias("latitude"),
                                       r4(F.min("longitude")).alias("longitude"), F.min("altitude").alias("altitude"))


@register("high_water", f"""WITH {e_cells()}
SELECT 'events' AS adapter, 'st-' || sid AS station_id,
       CASE WHEN year(max(t)) >= 2020 THEN max(t) END AS mark FROM cells WHERE t < TIMESTAMP '{SPLIT}' GROUP BY sid
UNION ALL
SELECT 'lineitem', 'st-' || l_suppkey, CASE WHEN year(max(l_shipdate)) >= 2020 THEN max(l_shipdate) END
FROM lineitem GROUP BY l_suppkey""")
def q_high_water(spark, sf):
    e = obs_from_payloads(spark, sf).where(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"))
    a = I.high_water_mark(e).select(F.lit("events").alias("adapter"), "station_id", "mark")
    li = X.read_table(spark, sf, "lineitem").select(
        F.concat(F.lit("st-"), F.col("l_suppkey").cast("string")).alias("station_id"), F.col("l_shipdate").alias("ts"))
    b = I.high_water_mark(li).select(F.lit("lineitem").alias("adapter"), "station_id", "mark")
    return a.unionByName(b)


_STARTS_SQL = f"""marks AS (SELECT 'st-' || sid AS station_id, CASE WHEN year(max(t)) >= 2020 THEN max(t) END AS mark
   FROM cells WHERE t < TIMESTAMP '{SPLIT}' GROUP BY sid),
starts AS (SELECT e.station_id, m.mark,
   greatest(TIMESTAMP '{START}', coalesce(m.mark + INTERVAL 1 HOUR, TIMESTAMP '{START}')) AS fetch_from
   FROM exp e LEFT JOIN marks m ON m.station_id = e.station_id WHERE e.module1_id <> '')"""


def _starts(spark, sf):
    st = P.eligible_stations(stations_from_payloads(spark, sf))
    e = obs_from_payloads(spark, sf).where(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"))
    return I.fetch_start(st, I.high_water_mark(e), start=START)


@register("fetch_start", f"""WITH {e_cells()}, {_EXPECTED_STATIONS}, {_STARTS_SQL}
SELECT station_id, mark, fetch_from FROM starts""")
def q_fetch_start(spark, sf):
    return _starts(spark, sf)


@register("fetch_plan", f"""WITH RECURSIVE {e_cells()}, {_EXPECTED_STATIONS}, {_STARTS_SQL},
req(station_id, chunk, begin_epoch, end_epoch) AS (
  SELECT station_id, 0::BIGINT, epoch(fetch_from)::BIGINT,
         least(epoch(fetch_from)::BIGINT + {CHUNK * 3600}, epoch(TIMESTAMP '{NOW}')::BIGINT)
  FROM starts WHERE epoch(fetch_from)::BIGINT < epoch(TIMESTAMP '{NOW}')::BIGINT
  UNION ALL
  SELECT station_id, chunk + 1, (end_epoch // 3600) * 3600 + 3600,
         least((end_epoch // 3600) * 3600 + 3600 + {CHUNK * 3600}, epoch(TIMESTAMP '{NOW}')::BIGINT)
  FROM req WHERE (end_epoch // 3600) * 3600 + 3600 < epoch(TIMESTAMP '{NOW}')::BIGINT)
SELECT station_id, chunk, begin_epoch, end_epoch FROM req""")
def q_fetch_plan(spark, sf):
    return I.fetch_plan(_starts(spark, sf), NOW, CHUNK)


_MERGE_SQL = f"""ex AS (SELECT 'st-' || sid AS station_id, t AS ts, v AS temperature FROM cells WHERE t < TIMESTAMP '{SPLIT}'),
nw AS (SELECT 'st-' || sid AS station_id, t AS ts, v + 1.0 AS temperature FROM cells WHERE t >= TIMESTAMP '{OVERLAP}'),
merged AS (SELECT * FROM nw UNION ALL SELECT * FROM ex WHERE NOT EXISTS
           (SELECT 1 FROM nw WHERE nw.station_id = ex.station_id AND nw.ts = ex.ts))"""


def _merged(spark, sf):
    o = obs_from_payloads(spark, sf)
    ex = o.where(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"))
    nw = o.where(F.col("ts") >= F.lit(OVERLAP).cast("timestamp_ntz")).withColumn(
        "temperature", F.col("temperature") + F.lit(1.0))
    return I.merge_keep_last(ex, nw, columns=["station_id", "ts", "temperature"])


@register("merge_keep_last", f"""WITH {e_cells()}, {_MERGE_SQL}
SELECT station_id, ts, round(temperature, 4) AS temperature FROM merged""")
def q_merge_keep_last(spark, sf):
    return _merged(spark, sf).select("station_id", "ts", r4("temperature").alias("temperature"))


@register("ingest_progress", f"""WITH RECURSIVE {e_cells()}, {_EXPECTED_STATIONS}, {_MERGE_SQL},
loaded AS (SELECT station_id, count(*) AS n_rows, max(ts) AS last_ts FROM merged GROUP BY station_id),
starts AS (SELECT e.station_id, greatest(TIMESTAMP '{START}',
           coalesce(CASE WHEN year(l.last_ts) >= 2020 THEN l.last_ts END + INTERVAL 1 HOUR, TIMESTAMP '{START}')) AS fetch_from
           FROM exp e LEFT JOIN loaded l ON l.station_id = e.station_id WHERE e.module1_id <> ''),
req(station_id, chunk, begin_epoch, end_epoch) AS (
  SELECT station_id, 0::BIGINT, epoch(fetch_from)::BIGINT,
         least(epoch(fetch_from)::BIGINT + {CHUNK * 3600}, epoch(TIMESTAMP '{NOW}')::BIGINT)
  FROM starts WHERE epoch(fetch_from)::BIGINT < epoch(TIMESTAMP '{NOW}')::BIGINT
  UNION ALL
  SELECT station_id, chunk + 1, (end_epoch // 3600) * 3600 + 3600,
         least((end_epoch // 3600) * 3600 + 3600 + {CHUNK * 3600}, epoch(TIMESTAMP '{NOW}')::BIGINT)
  FROM req WHERE (end_epoch // 3600) * 3600 + 3600 < epoch(TIMESTAMP '{NOW}')::BIGINT),
pend AS (SELECT station_id, count(*) AS n FROM req GROUP BY station_id)
SELECT s.station_id, coalesce(l.n_rows, 0)::BIGINT AS n_rows, l.last_ts, s.fetch_from,
       coalesce(p.n, 0)::BIGINT AS pending_requests, CASE WHEN coalesce(p.n, 0) = 0 THEN 'done' ELSE 'pending' END AS status
FROM starts s LEFT JOIN loaded l ON l.station_id = s.station_id LEFT JOIN pend p ON p.station_id = s.station_id""")
def q_ingest_progress(spark, sf):
    st = P.eligible_stations(stations_from_payloads(spark, sf))
    return I.ingest_progress(st, _merged(spark, sf), NOW, START, CHUNK)


@register("station_metadata", f"""WITH {e_cells()},
o AS (SELECT sid, t, CASE WHEN hour(t) >= 6 THEN 46.40::DOUBLE + ((sid*37) % 1009)::DOUBLE / 10000.0 + hour(t) / 1000.0 END AS lat,
      CASE WHEN day(t) >= 3 THEN 200.0::DOUBLE + day(t) END AS alt FROM cells)
SELECT sid, round(arg_min(lat, t) FILTER (WHERE lat IS NOT NULL), 4) AS lat,
       arg_min(alt, t) FILTER (WHERE alt IS NOT NULL) AS alt FROM o GROUP BY sid""")
def q_station_metadata(spark, sf):
    c = cells_e(spark, sf)
    o = c.select("sid", "t",
                 F.when(F.hour("t") >= 6, F.lit(46.40) + (F.col("sid") * 37 % 1009).cast("double") / F.lit(10000.0)
                        + F.hour("t") / F.lit(1000.0)).alias("lat"),
                 F.when(F.dayofmonth("t") >= 3, F.lit(200.0) + F.dayofmonth("t")).alias("alt"))
    m = G.station_metadata(o, cols=("lat", "alt"))
    return m.select("sid", r4("lat").alias("lat"), "alt")


@register("wide_long", f"""WITH {e_cells()}, {GRID}
SELECT t, sid::VARCHAR AS sid, round(v, 4) AS v FROM grid""")
def q_wide_long(spark, sf):
    g = G.dense_grid(cells_e(spark, sf))
    w, header = G.to_wide_blocks(g)   # a column per station up to a block's width, further blocks as rows
    return G.from_wide_blocks(w, header).select("t", "sid", r4("v").alias("v"))


@register("outer_product", f"""WITH {e_cells()}, {GRID}
SELECT sid, count(*)::BIGINT AS n_cells, count(v)::BIGINT AS n_v, count(v * 2)::BIGINT AS n_v2,
       round(max(v * 2), 4) AS max_v2 FROM grid GROUP BY sid""")
def q_outer_product(spark, sf):
    c = cells_e(spark, sf).withColumn("v2", F.col("v") * 2)
    g = G.outer_product(c, values=["v", "v2"])
    return g.groupBy("sid").agg(F.count(F.lit(1)).cast("long").alias("n_cells"), F.count("v").cast("long").alias("n_v"),
                                F.count("v2").cast("long").alias("n_v2"), r4(F.max("v2")).alias("max_v2"))


# ---------------------------------------------------------------- keyed series, rejects, stream
def damaged_documents(spark, sf, chunk=CHUNK):
    """Measurement documents of the event readings, some of them damaged by rule: cut off,
    with a key that is no number, or with a text where the reading belongs."""
    hour = F.floor(epoch_seconds("t") / 3600).cast("long")
    c = cells_e(spark, sf).select("sid", hour.alias("h"), "v", F.floor(hour / F.lit(chunk)).cast("long").alias("window"))
    key = F.concat(F.when((F.col("h") + F.col("sid")) % 97 == 0, "x").otherwise(""), (F.col("h") * 3600).cast("string"))
    value = F.when((F.col("h") * 3 + F.col("sid")) % 89 == 0, F.lit('["n/a"]')).otherwise(F.concat(F.lit("["), F.col("v").cast("string"), F.lit("]")))
    docs = c.groupBy("sid", "window").agg(F.array_join(F.collect_list(F.concat(F.lit('"'), key, F.lit('":'), value)), ",").alias("body"))
    doc = F.concat(F.lit('{"station_id":"st-'), F.col("sid").cast("string"), F.lit('","body":{'), F.col("body"), F.lit("}}"))
    cut = (F.col("sid") * 7 + F.col("window")) % 13 == 0
    docs = docs.select("window", cut.alias("cut"), doc.alias("doc"))
    return docs.select("window", F.when(F.col("cut"), F.left("doc", F.length("doc") - 3)).otherwise(F.col("doc")).alias("value"))


_DAMAGED = f"""entry AS (SELECT sid, t, v, epoch(t)::BIGINT // 3600 AS h, (epoch(t)::BIGINT // 3600) // {CHUNK} AS w FROM cells),
judged AS (SELECT *, CASE WHEN (sid * 7 + w) % 13 = 0 THEN 'bad_json' WHEN (h + sid) % 97 = 0 THEN 'bad_epoch'
           WHEN (h * 3 + sid) % 89 = 0 THEN 'bad_value' ELSE 'accepted' END AS fate FROM entry)"""


@register("measure_rejects", f"""WITH {e_cells()}, {_DAMAGED}
SELECT fate, count(*)::BIGINT AS n, count(DISTINCT sid)::BIGINT AS n_stations FROM judged WHERE fate <> 'bad_json' GROUP BY fate
UNION ALL SELECT 'bad_json', count(DISTINCT (sid, w))::BIGINT, 0::BIGINT FROM judged WHERE fate = 'bad_json' HAVING count(*) > 0""")
def q_measure_rejects(spark, sf):
    """Landed entries by what becomes of them; a document that is cut off is one entry."""
    entries = P.measure_entries(damaged_documents(spark, sf), "value", station_col=None)
    return entries.groupBy(F.coalesce("reason", F.lit("accepted")).alias("fate")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("station_id").alias("n_stations"))


EARLY = "2024-01-04 00:00:00"


def merged_deliveries(spark, sf):
    """The event readings in three deliveries (the second one repeated) merged into a keyed table."""
    o = cells_e(spark, sf).select("sid", F.concat(F.lit("st-"), F.col("sid").cast("string")).alias("station_id"),
                                  F.col("t").alias("ts"), F.col("v").alias("temperature"))
    table = Se.SeriesTable(f"{ensure_checkpoint_dir(spark)}/series-{uuid.uuid4().hex}", buckets=2, period="yyyy-MM-dd")
    first = o.where(F.col("ts") < F.lit(SPLIT).cast("timestamp_ntz"))
    second = o.where((F.col("ts") >= F.lit(OVERLAP).cast("timestamp_ntz")) & (F.col("sid") % 5 == 0)) \
        .withColumn("temperature", F.col("temperature") + 1)
    late = o.where((F.col("ts") < F.lit(EARLY).cast("timestamp_ntz")) & (F.col("sid") % 7 == 1)) \
        .withColumn("temperature", F.col("temperature") - 0.5)
    for delivery, rows in ((0, first), (1, second), (1, second), (2, late)):
        Se.upsert_series(spark, table, rows, delivery)
    return table


_DELIVERIES = f"""delivered AS (
SELECT 0 AS d, 'st-' || sid AS station_id, t AS ts, v AS temperature FROM cells WHERE t < TIMESTAMP '{SPLIT}'
UNION ALL SELECT 1, 'st-' || sid, t, v + 1.0 FROM cells WHERE t >= TIMESTAMP '{OVERLAP}' AND sid % 5 = 0
UNION ALL SELECT 2, 'st-' || sid, t, v - 0.5 FROM cells WHERE t < TIMESTAMP '{EARLY}' AND sid % 7 = 1)"""


@register("series_upsert", f"""WITH {e_cells()}, {_DELIVERIES}
SELECT station_id, ts, round(arg_max(temperature, d), 4) AS temperature, max(d)::BIGINT AS delivery FROM delivered GROUP BY station_id, ts""")
def q_series_upsert(spark, sf):
    """The keyed table after three deliveries, read without grouping."""
    rows = Se.read_series(spark, merged_deliveries(spark, sf))
    return rows.select("station_id", "ts", r4("temperature").alias("temperature"), "delivery")


@register("upsert_partitions", f"""WITH {e_cells()}, {_DELIVERIES},
placed AS (SELECT *, ts::DATE AS day, ('0x' || substr(md5(station_id), 1, 8))::BIGINT % 2 AS bucket FROM delivered),
hit AS (SELECT DISTINCT d, day, bucket FROM placed),
held AS (SELECT DISTINCT h.d, h.day, h.bucket, p.station_id, p.ts FROM hit h JOIN placed p ON p.day = h.day AND p.bucket = h.bucket AND p.d <= h.d)
SELECT d::BIGINT AS delivery, count(DISTINCT (day, bucket))::BIGINT AS n_partitions, count(*)::BIGINT AS n_rows FROM held GROUP BY d""")
def q_upsert_partitions(spark, sf):
    """Partitions that each delivery rewrote, and the rows they hold since; the repeated delivery rewrote none."""
    done = Se.read_manifest(spark, merged_deliveries(spark, sf))
    return done.where("period IS NOT NULL").groupBy("delivery").agg(F.count(F.lit(1)).alias("n_partitions"), F.sum("n_rows").alias("n_rows"))


@register("ingest_marks", f"""WITH {e_cells()}, {_DELIVERIES},
known AS (SELECT a.*, (SELECT max(b.ts) FROM delivered b WHERE b.station_id = a.station_id AND b.d < a.d) AS mark FROM delivered a)
SELECT station_id, CASE WHEN year(max(ts)) >= 2020 THEN max(ts) END AS mark, count(*)::BIGINT AS n_delivered,
       count(*) FILTER (WHERE ts <= mark)::BIGINT AS n_late, count(DISTINCT ts)::BIGINT AS hours,
       (epoch(max(ts))::BIGINT - epoch(min(ts))::BIGINT) // 3600 + 1 - count(DISTINCT ts)::BIGINT AS gap_hours
FROM known GROUP BY station_id""")
def q_ingest_marks(spark, sf):
    """Marks, late rows and gaps per station from the state that the deliveries advanced."""
    return Se.read_marks(spark, merged_deliveries(spark, sf))


@register("incremental_ingest", f"""WITH {e_cells()}, {_DAMAGED}
SELECT 'st-' || sid AS station_id, count(*)::BIGINT AS n_hours, min(t) AS first_ts, max(t) AS last_ts,
       round(min(v), 4) AS lowest, round(max(v), 4) AS highest FROM judged WHERE fate = 'accepted' GROUP BY sid""")
def q_incremental_ingest(spark, sf):
    """Two landings of documents, damaged ones among them, each taken up by a run of the stream."""
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    table = Se.SeriesTable(f"{base}/series", buckets=2, period="yyyy-MM-dd")
    docs = damaged_documents(spark, sf)
    for part in (0, 1):
        docs.where(F.col("window") % 2 == part).select("value").write.mode("append").text(f"{base}/landing")
        S.start_series_ingest(spark, f"{base}/landing", table, f"{base}/rejects", f"{base}/progress").awaitTermination()
    return Se.read_series(spark, table).groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n_hours"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        r4(F.min("temperature")).alias("lowest"), r4(F.max("temperature")).alias("highest"))
