"""Queries over files at rest (A4, A14-A18) and the layout helpers (B14, B15): each
writes its table into the shared checkpoint folder, reads it back and returns that."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stationqc.operators import grid as G
from stationqc.plans.catalog import cells_e, day_str, r4, register
from stationqc.plans.q_ingest import _EXPECTED_STATIONS, obs_from_payloads, stations_from_payloads
from stationqc.plans.q_plans import _SEQ_CTES, _seq
from stationqc.plans.sqlfix import e_cells
from stationqc.session import ensure_checkpoint_dir
from stationqc.sources import files as Fi
from stationqc.sources import fixtures as X
from stationqc.sources import ingest as I


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/files-{uuid.uuid4().hex}"


@register("station_list_csv", f"""WITH {_EXPECTED_STATIONS}
SELECT station_id, module1_id, module1_type, round(latitude, 4) AS latitude, round(longitude, 4) AS longitude,
       altitude, city, country, street, timezone FROM exp""")
def q_station_list_csv(spark, sf):
    path = _folder(spark)
    Fi.write_station_list(stations_from_payloads(spark, sf), path)
    back = Fi.read_station_list(spark, path)
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("module1_id", "module1_type")]
    return back.select("station_id", *text, r4("latitude").alias("latitude"), r4("longitude").alias("longitude"),
                       "altitude", "city", "country", "street", "timezone")


_OBS_SQL = f"""{e_cells()}, {_EXPECTED_STATIONS},
o AS (SELECT 'st-' || c.sid AS station_id, c.t AS ts, c.v AS temperature, e.longitude, e.latitude, e.altitude
      FROM cells c LEFT JOIN exp e ON e.station_id = 'st-' || c.sid)"""


def _obs(spark, sf):
    return I.attach_station_metadata(obs_from_payloads(spark, sf), stations_from_payloads(spark, sf))


@register("observation_files", f"""WITH {_OBS_SQL}
SELECT station_id, ts, round(temperature, 4) AS temperature, round(longitude, 4) AS longitude,
       round(latitude, 4) AS latitude, altitude FROM o""")
def q_observation_files(spark, sf):
    """A14; an absent altitude is written as text and read as NULL."""
    path = _folder(spark)
    Fi.write_observation_files(_obs(spark, sf), path)
    return Fi.read_observation_files(spark, path).select(
        "station_id", "ts", r4("temperature").alias("temperature"), r4("longitude").alias("longitude"),
        r4("latitude").alias("latitude"), "altitude")


@register("layer_files", f"""WITH {_OBS_SQL}
SELECT 'raw' AS layer, count(*)::BIGINT AS n_rows, count(DISTINCT station_id)::BIGINT AS n_stations,
       true AS has_files FROM o
UNION ALL SELECT 'processed', count(*)::BIGINT, count(DISTINCT station_id)::BIGINT, true FROM o
WHERE latitude IS NOT NULL""")
def q_layer_files(spark, sf):
    """Two storage areas and their inventory."""
    base, o = _folder(spark), _obs(spark, sf)
    layers = {"raw": Fi.layered_write(o, base, "raw"),
              "processed": Fi.layered_write(o.where(F.col("latitude").isNotNull()), base, "processed")}
    rows = [spark.read.parquet(path).groupBy(F.lit(name).alias("layer"))
            .agg(F.count(F.lit(1)).cast("long").alias("n_rows"), F.count_distinct("station_id").cast("long").alias("n_stations"))
            for name, path in layers.items()]
    files = Fi.layer_inventory(spark, base)
    return I.union_series(*rows).join(files, "layer").select(
        "layer", "n_rows", "n_stations", (F.col("n_files") > 0).alias("has_files"))


@register("union_series", f"""WITH {e_cells()}
SELECT 'events' AS network, t, round(v, 4) AS v, sid, NULL::VARCHAR AS day FROM cells
UNION ALL SELECT 'lineitem', l_shipdate, round(l_quantity - 10.0, 4), l_suppkey, strftime(l_shipdate, '%Y-%m-%d') FROM lineitem""")
def q_union_series(spark, sf):
    """A column that one series lacks is NULL there."""
    e = cells_e(spark, sf).select(F.lit("events").alias("network"), "t", r4("v").alias("v"), "sid")
    li = X.lineitem_obs(spark, sf).select(F.lit("lineitem").alias("network"), "sid", "t", r4("v").alias("v"),
                                          day_str().alias("day"))
    return I.union_series(e, li).select("network", "t", "v", "sid", "day")


@register("ensure_columns", f"""WITH {e_cells()}
SELECT sid, t, round(v, 4) AS v, NULL::DOUBLE AS humidity, NULL::VARCHAR AS note FROM cells""")
def q_ensure_columns(spark, sf):
    c = cells_e(spark, sf).withColumn("v", r4("v")).withColumn("left_out", F.lit(1))
    return G.ensure_columns(c, ["sid", "t", "v", "humidity", "note"], {"humidity": "double"})


@register("units", f"""WITH {e_cells()}
SELECT sid, count(*)::BIGINT AS n, '°C' AS units, 'air_temperature' AS standard_name FROM cells GROUP BY sid""")
def q_units(spark, sf):
    """Units and names are read back from the stored column."""
    path = _folder(spark)
    G.with_units(cells_e(spark, sf), {"v": Fi.TEMPERATURE_UNITS}).write.parquet(path)
    back = spark.read.parquet(path)
    of = back.schema["v"].metadata
    return back.groupBy("sid").agg(F.count("v").cast("long").alias("n"), F.lit(of["units"]).alias("units"),
                                   F.lit(of["standard_name"]).alias("standard_name"))


_FLAGS = ("t_lvl1_flag", "t_lvl2_flag", "t_lvl3_flag")
_LEVELS = ("t_lvl0", "t_lvl1", "t_lvl2", "t_lvl3")


@register("level_dataset", f"""WITH {_SEQ_CTES},
per AS (SELECT sid, {', '.join(f"count({c})::BIGINT AS n_{c}" for c in _LEVELS)},
        {', '.join(f"sum({c}::INT)::BIGINT AS n_{c}" for c in _FLAGS)} FROM l3 GROUP BY sid HAVING count(t_lvl3) > 0)
SELECT per.*, round(s.lat, 4) AS lat, round(s.lon, 4) AS lon, s.alt,
       'Air temperature at quality control level 3' AS long_name FROM per JOIN stations s ON s.sid = per.sid""")
def q_level_dataset(spark, sf):
    """All levels of the sequential plan, empty stations removed, station vectors beside them."""
    path, r = _folder(spark), _seq(spark, sf)
    Fi.write_qc_dataset(r.grid, r.stats, path, _LEVELS, _FLAGS, stations=X.station_dim(cells_e(spark, sf)),
                        methods="seasonal limits; buddy check; spatio-temporal test", drop_empty="t_lvl3")
    data = spark.read.parquet(f"{path}/data")
    per = data.groupBy("sid").agg(*[F.count(c).cast("long").alias(f"n_{c}") for c in _LEVELS],
                                  *[F.sum(c).cast("long").alias(f"n_{c}") for c in _FLAGS])
    st = spark.read.parquet(f"{path}/stations").select("sid", r4("lat").alias("lat"), r4("lon").alias("lon"), "alt")
    return per.join(st, "sid").withColumn("long_name", F.lit(data.schema["t_lvl3"].metadata["long_name"]))
