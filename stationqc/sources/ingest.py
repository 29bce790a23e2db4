"""Incremental ingest bookkeeping as table operations.

The state of a resumable download is the observation table itself: marks,
start times, work lists and progress are all derived from it with joins and
aggregates, and new deliveries are merged keep-last per (station, time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stationqc.functions.columns import epoch_seconds, valid_from_year

CHUNK_HOURS = 1024          # fixed value: readings per request
DEFAULT_HISTORY_DAYS = 365  # fixed value: default start is now minus this many days


def attach_station_metadata(obs: DataFrame, stations: DataFrame) -> DataFrame:
    """Add longitude, latitude, altitude to each reading (AQE broadcasts a station table it measures small)."""
    st = stations.select("station_id", "longitude", "latitude", "altitude")
    return obs.join(st, "station_id", "left")


def high_water_mark(obs: DataFrame, station: str = "station_id", ts: str = "ts") -> DataFrame:
    """Latest time per station; a mark before 2020 counts as none."""
    return obs.groupBy(F.col(station).alias("station_id")).agg(valid_from_year(F.max(ts)).alias("mark"))


def fetch_start(stations: DataFrame, marks: DataFrame, start=None, now=None) -> DataFrame:
    """A10: later of ``start`` and mark + 1 h; ``start`` alone without a mark.

    ``start`` defaults to ``now`` minus 365 days.
    """
    if start is None:
        if now is None:
            raise ValueError("give start or now")
        start_c = F.lit(now).cast("timestamp_ntz") - F.expr(f"INTERVAL {DEFAULT_HISTORY_DAYS} DAYS")
    else:
        start_c = F.lit(start).cast("timestamp_ntz")
    j = stations.select("station_id").join(marks, "station_id", "left")
    nxt = F.col("mark") + F.expr("INTERVAL 1 HOUR")
    return j.select("station_id", "mark", F.greatest(start_c, nxt).alias("fetch_from"))


def fetch_plan(starts: DataFrame, now, chunk_hours: int = CHUNK_HOURS) -> DataFrame:
    """Work list of request windows per station.

    Closed form of the request loop: begin_0 = b; begin_k = floor_hour(b) +
    k * (chunk + 1) h for k >= 1; end_k = min(begin_k + chunk h, now); while
    begin_k < now.  ``sequence`` + ``explode`` emits exactly the chunks.
    """
    now_e = epoch_seconds(F.lit(now).cast("timestamp_ntz"))
    b = epoch_seconds("fetch_from")
    step = (chunk_hours + 1) * 3600
    fh = F.floor(b / 3600).cast("long") * 3600
    last_k = F.greatest(F.lit(0).cast("long"), F.ceil((now_e - fh) / F.lit(step)).cast("long") - 1)
    s = starts.where(F.col("fetch_from").isNotNull() & (b < now_e))
    s = s.select("station_id", b.alias("b"), fh.alias("fh"), F.explode(F.sequence(F.lit(0).cast("long"), last_k))
                 .alias("chunk"))
    begin = F.when(F.col("chunk") == 0, F.col("b")).otherwise(F.col("fh") + F.col("chunk") * F.lit(step))
    s = s.withColumn("begin_epoch", begin).where(F.col("begin_epoch") < now_e)
    return s.select("station_id", "chunk", "begin_epoch",
                    F.least(F.col("begin_epoch") + F.lit(chunk_hours * 3600), now_e).alias("end_epoch"))


def merge_keep_last(existing: DataFrame, new: DataFrame, keys=("station_id", "ts"), order: str = "_batch",
                    columns: list[str] | None = None, arrival: tuple[str, ...] = ()) -> DataFrame:
    """Append; one row per key, the last appended wins; fixed column order.

    ``order`` ranks deliveries (the newer batch has the higher value); it is
    added as 0 / 1 when absent.  ``arrival`` names the columns that order the rows
    within a delivery (source file, position in file); rows that still tie are ordered
    by their values, so the result never depends on partitioning.  ``max_by`` over a
    struct keeps the winning row with an aggregate that is partial before the shuffle.
    """
    a = existing if order in existing.columns else existing.withColumn(order, F.lit(0))
    b = new if order in new.columns else new.withColumn(order, F.lit(1))
    u = a.unionByName(b, allowMissingColumns=True)
    vals = [c for c in u.columns if c not in keys and c != order and c not in arrival]
    w = u.groupBy(*keys).agg(F.max_by(F.struct(*vals), F.struct(order, *arrival, *vals)).alias("_r"))
    out = w.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in vals])
    return out.select(*(columns or out.columns))


def ingest_progress(stations: DataFrame, obs: DataFrame, now, start=None, chunk_hours: int = CHUNK_HOURS) -> DataFrame:
    """Per eligible station what is loaded and what is left to fetch."""
    loaded = obs.groupBy("station_id").agg(F.count(F.lit(1)).cast("long").alias("n_rows"),
                                           F.max("ts").alias("last_ts"))
    marks = loaded.select("station_id", valid_from_year("last_ts").alias("mark"))
    st = fetch_start(stations, marks, start=start, now=now)
    plan = fetch_plan(st, now, chunk_hours).groupBy("station_id").agg(
        F.count(F.lit(1)).cast("long").alias("pending_requests"))
    out = (st.join(loaded, "station_id", "left").join(plan, "station_id", "left")
           .select("station_id", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"), "last_ts",
                   "fetch_from", F.coalesce("pending_requests", F.lit(0)).cast("long").alias("pending_requests")))
    return out.withColumn("status", F.when(F.col("pending_requests") == 0, "done").otherwise("pending"))


def union_series(*frames: DataFrame) -> DataFrame:
    """Concatenate the series of all stations."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def measure_payloads(cells: DataFrame, chunk_hours: int = CHUNK_HOURS) -> DataFrame:
    """Inverse of A6 (used to land payloads derived from a table): one JSON document
    per (station, request window) with at most ``chunk_hours`` readings."""
    e = epoch_seconds("t")
    c = cells.select(F.col("sid"), e.alias("e"), F.col("v"),
                     F.floor(e / F.lit(3600 * chunk_hours)).cast("long").alias("window"))
    g = c.groupBy("sid", "window").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("e").cast("string"), F.array(F.col("v"))))).alias("body"))
    return g.select(F.col("sid"), F.col("window"), F.to_json(F.struct("body")).alias("json"))

