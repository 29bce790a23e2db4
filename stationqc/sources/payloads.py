"""Landed JSON payloads -> station and observation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationqc.functions.columns import epoch_to_ntz, nan_to_null
from stationqc.schemas import MEASURE_DOCUMENT, MEASURE_LENIENT, STATION_LIST_COLUMNS, STATION_PAYLOAD

OUTDOOR_TYPE = "NAModule1"  # fixed value: module type of the outdoor sensor
UNKNOWN = "Unknown"         # fixed value: sentinel for absent text fields


def pick_outdoor_module(module_types, outdoor: str = OUTDOOR_TYPE):
    """A2: (id, type) of the first map entry of the outdoor type in document order,
    else empty strings.  ``from_json`` keeps the document order of map entries."""
    hit = F.try_element_at(F.filter(F.map_entries(module_types), lambda e: e["value"] == F.lit(outdoor)), F.lit(1))
    return (F.coalesce(hit["key"], F.lit("")).alias("module1_id"),
            F.coalesce(hit["value"], F.lit("")).alias("module1_type"))


def parse_station_payload(json_df: DataFrame, col: str = "json") -> DataFrame:
    """A1: one row per station of payloads with status 'ok' and a body.

    Location is [lon, lat] (swapped on output); absent city / country / timezone /
    street become 'Unknown'; an absent altitude stays NULL (numeric column).
    """
    p = json_df.select(F.from_json(F.col(col), STATION_PAYLOAD).alias("p"))
    p = p.where((F.col("p.status") == "ok") & F.col("p.body").isNotNull())
    s = p.select(F.explode("p.body").alias("s"))
    mid, mtype = pick_outdoor_module(F.col("s.module_types"))
    out = s.select(
        F.col("s._id").alias("station_id"), mid, mtype,
        F.get(F.col("s.place.location"), 1).alias("latitude"),
        F.get(F.col("s.place.location"), 0).alias("longitude"),
        F.col("s.place.altitude").alias("altitude"),
        *[F.coalesce(F.col(f"s.place.{c}"), F.lit(UNKNOWN)).alias(c) for c in ("city", "country", "street",
                                                                                 "timezone")])
    return out.select(*STATION_LIST_COLUMNS)


def _span(name: str, low: float, high: float, limit: float):
    """Inclusive span of one axis of a box, as a condition; the bounds are checked on the driver."""
    if not max(abs(low), abs(high)) <= limit:
        raise ValueError(f"{name} bounds {low}, {high} leave the range -{limit:g} .. {limit:g}")
    if not low < high:
        raise ValueError(f"{name}: the south-west bound {low} has to be below the north-east bound {high}")
    return F.col(name).between(low, high)


def bbox_filter(stations: DataFrame, ne: tuple[float, float], sw: tuple[float, float]) -> DataFrame:
    """A3: the stations inside a box of (latitude, longitude) corners, edges included."""
    spans = [_span(name, low, high, limit)
             for name, low, high, limit in zip(("latitude", "longitude"), sw, ne, (90.0, 180.0))]
    return stations.where(spans[0] & spans[1])


def station_list_summary(stations: DataFrame) -> DataFrame:
    """A5: total stations and stations having an outdoor module."""
    return stations.agg(F.count(F.lit(1)).cast("long").alias("n_stations"),
                        F.count_if(F.coalesce(F.col("module1_id"), F.lit("")) != "").cast("long")
                        .alias("n_with_module"))


def eligible_stations(stations: DataFrame) -> DataFrame:
    """Stations with an outdoor module id (NULL or empty are skipped)."""
    return stations.where(F.col("module1_id").isNotNull() & (F.col("module1_id") != ""))


# Epoch seconds of the years 1 to 9999, the range of a timestamp.
EPOCH_RANGE = (-62135596800, 253402300799)
_KEEP_CORRUPT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def measure_entries(json_df: DataFrame, col: str = "json", station_col: str | None = "station_id") -> DataFrame:
    """A6 with nothing lost: one row ``(station_id, ts, temperature, reason, raw)`` per landed entry.

    ``reason`` is NULL for an accepted reading, else ``bad_json`` (the document is no
    object with a ``body`` map: one row), ``no_station``, ``bad_epoch`` (the key is no
    epoch second of a timestamp) or ``bad_value`` (the entry is no array that begins
    with a number or null); ``raw`` holds the text.  The station comes from
    ``station_col`` or, if that is None, from the document.  A document that fits is
    parsed once; only one with some entry that does not fit is read again as text.
    """
    station = F.col(station_col) if station_col else F.lit(None).cast("string")
    p = json_df.select(station.alias("_station"), F.col(col).alias("_doc"), F.from_json(F.col(col), MEASURE_DOCUMENT, _KEEP_CORRUPT).alias("p"))
    p = p.withColumn("q", F.from_json(F.when(F.col("p._corrupt").isNotNull(), F.col("_doc")), MEASURE_LENIENT, _KEEP_CORRUPT))
    broken = F.col("p").isNull() | F.col("q._corrupt").isNotNull()

    def entry(epoch, value, reason, raw):
        return F.struct(epoch.alias("epoch"), value.alias("value"), reason.alias("reason"), raw.alias("raw"))
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    typed = F.transform(F.map_entries("p.body"), lambda e: entry(e["key"], F.get(e["value"], 0), text, text))

    def from_text(e):
        items = F.from_json(e["value"], "array<string>")
        value = F.get(items, 0).try_cast("double")
        bad = e["value"].isNotNull() & (items.isNull() | (F.get(items, 0).isNotNull() & value.isNull()))
        return entry(e["key"], value, F.when(bad, "bad_value"), F.concat_ws(": ", e["key"], e["value"]))
    lenient = F.transform(F.map_entries("q.body"), from_text)
    whole = F.array(entry(text, number, F.lit("bad_json"), F.col("_doc")))
    found = (p.select(F.coalesce("_station", "p.station_id", "q.station_id").alias("station_id"),
                      F.explode(F.when(broken, whole).when(F.col("q").isNotNull(), lenient).otherwise(typed)).alias("e"))
             .select("station_id", "e.*"))
    epoch = F.col("epoch").try_cast("long")
    epoch = F.when(epoch.between(*EPOCH_RANGE), epoch)
    reason = (F.when(F.col("reason") == "bad_json", F.col("reason")).when(F.col("station_id").isNull(), "no_station")
              .when(epoch.isNull(), "bad_epoch").otherwise(F.col("reason")))
    return found.select("station_id", epoch_to_ntz(epoch).alias("ts"), nan_to_null("value").alias("temperature"), reason.alias("reason"),
                        F.when(F.col("reason") == "bad_json", F.col("raw"))
                        .otherwise(F.coalesce("raw", F.concat_ws(": ", "epoch", F.col("value").cast("string")))).alias("raw"))


def accepted(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("reason").isNull()).select("station_id", "ts", "temperature")


def rejected(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("reason").isNotNull()).select("station_id", "reason", "raw")


def parse_measure_payload(json_df: DataFrame, col: str = "json", station_col: str = "station_id") -> DataFrame:
    """``{body: {epoch: [temperature]}}`` -> one row per entry.

    The first array element is the reading; epoch seconds are read as UTC into a
    naive timestamp; an empty or absent body gives no rows; entries that do not fit
    are left out (``measure_entries`` names them).
    """
    return accepted(measure_entries(json_df, col, station_col))
