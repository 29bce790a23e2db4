"""Scalar column functions.

All of them are compositions of built-in ``pyspark.sql.functions`` so that the
work stays inside whole-stage code generation; no Python UDF is involved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

EPOCH_DATE = "1970-01-01"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def season(t) -> Column:
    """Meteorological season of a timestamp: DJF, MAM, JJA, SON."""
    m = F.month(col_(t))
    return (F.when(m.isin(12, 1, 2), F.lit("DJF"))
            .when(m.isin(3, 4, 5), F.lit("MAM"))
            .when(m.isin(6, 7, 8), F.lit("JJA"))
            .otherwise(F.lit("SON")))


def hour_floor(t) -> Column:
    """Truncate a naive timestamp to the hour without passing through a zone."""
    t = col_(t)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def epoch_seconds(t) -> Column:
    """Zone-free whole-second count of a naive timestamp (BIGINT)."""
    t = col_(t)
    days = F.datediff(F.to_date(t), F.lit(EPOCH_DATE).cast("date")).cast("long")
    return days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t).cast("long")


def epoch_to_ntz(e) -> Column:
    """Epoch seconds (read as UTC) to a naive timestamp, zone-free."""
    e = col_(e).cast("long")
    days = F.floor(e / 86400).cast("int")
    rem = e - days.cast("long") * 86400
    d = F.date_add(F.lit(EPOCH_DATE).cast("date"), days)
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d),
                                F.floor(rem / 3600).cast("int"), F.floor((rem % 3600) / 60).cast("int"),
                                (rem % 60).cast("int"))


def month_key(t) -> Column:
    t = col_(t)
    return F.year(t) * 12 + F.month(t) - 1


def days_in_month(t) -> Column:
    return F.dayofmonth(F.last_day(col_(t)))


def mask(v, good) -> Column:
    """Value where the good-flag is true, NULL otherwise."""
    return F.when(col_(good), col_(v))


def nan_to_null(v) -> Column:
    """NaN is missing: convert at ingest so that ordering/comparison rules are SQL's."""
    v = col_(v).cast("double")
    return F.nanvl(v, F.lit(None).cast("double"))


def valid_from_year(ts, year: int = 2020) -> Column:
    """Timestamps before ``year`` count as absent (high-water marks)."""
    ts = col_(ts)
    return F.when(F.year(ts) >= year, ts)


def round_to(c, places: int) -> Column:
    """Round on the binary value: round(x * 10^p) / 10^p (half away from zero)."""
    m = float(10 ** places)
    return F.round(col_(c) * F.lit(m)) / F.lit(m)


def round4(c) -> Column:
    """Round to 4 places on the binary value: round(x * 1e4) / 1e4."""
    return F.round(col_(c) * F.lit(10000.0)) / F.lit(10000.0)


def timeframe_label(start, end, with_time: bool) -> Column:
    """``yyyyMMdd_yyyyMMdd`` or, for the full range, ``yyyyMMdd_HHmm_yyyyMMdd_HHmm``."""
    fmt = "yyyyMMdd_HHmm" if with_time else "yyyyMMdd"
    return F.concat_ws("_", F.date_format(col_(start), fmt), F.date_format(col_(end), fmt))


# WGS84 ellipsoid and UTM constants.
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0


def _utm_constants():
    n = WGS84_F / (2.0 - WGS84_F)
    big_a = WGS84_A / (1.0 + n) * (1.0 + n * n / 4.0 + n ** 4 / 64.0)
    alpha = (n / 2.0 - 2.0 * n * n / 3.0 + 5.0 * n ** 3 / 16.0,
             13.0 * n * n / 48.0 - 3.0 * n ** 3 / 5.0,
             61.0 * n ** 3 / 240.0)
    c = 2.0 * math.sqrt(n) / (1.0 + n)
    return big_a, alpha, c


def utm_xy(lat, lon, zone: int = 33) -> tuple[Column, Column]:
    """Transverse Mercator easting/northing in metres (Krueger series to n^3).

    Northern-hemisphere convention (no false northing) for the fixed zone, like a
    projection object built for one zone number.
    """
    big_a, alpha, c = _utm_constants()
    phi = F.radians(col_(lat))
    dlam = F.radians(col_(lon)) - F.lit(math.radians(zone * 6.0 - 183.0))
    sphi = F.sin(phi)
    tt = F.sinh(F.atanh(sphi) - F.lit(c) * F.atanh(F.lit(c) * sphi))
    xi = F.atan2(tt, F.cos(dlam))
    eta = F.atanh(F.sin(dlam) / F.sqrt(F.lit(1.0) + tt * tt))
    east = eta
    north = xi
    for j, a in enumerate(alpha, start=1):
        east = east + F.lit(a) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
        north = north + F.lit(a) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
    x = F.lit(UTM_FALSE_EASTING) + F.lit(UTM_K0 * big_a) * east
    y = F.lit(UTM_K0 * big_a) * north
    return x, y


def with_utm(df, lat: str = "lat", lon: str = "lon", zone: int = 33, x: str = "x", y: str = "y"):
    """``utm_xy`` as staged projections: each intermediate is computed once per
    row (Catalyst keeps a project whose non-trivial outputs are reused), which
    keeps the generated code and the plan small."""
    big_a, alpha, c = _utm_constants()
    d = df.withColumn("_phi", F.radians(col_(lat))) \
        .withColumn("_dl", F.radians(col_(lon)) - F.lit(math.radians(zone * 6.0 - 183.0)))
    d = d.withColumn("_tt", F.sinh(F.atanh(F.sin("_phi")) - F.lit(c) * F.atanh(F.lit(c) * F.sin("_phi"))))
    d = d.withColumn("_xi", F.atan2(F.col("_tt"), F.cos("_dl"))) \
        .withColumn("_eta", F.atanh(F.sin("_dl") / F.sqrt(F.lit(1.0) + F.col("_tt") * F.col("_tt"))))
    east, north = F.col("_eta"), F.col("_xi")
    for j, a in enumerate(alpha, start=1):
        east = east + F.lit(a) * F.cos(F.lit(2.0 * j) * F.col("_xi")) * F.sinh(F.lit(2.0 * j) * F.col("_eta"))
        north = north + F.lit(a) * F.sin(F.lit(2.0 * j) * F.col("_xi")) * F.cosh(F.lit(2.0 * j) * F.col("_eta"))
    d = d.withColumn(x, F.lit(UTM_FALSE_EASTING) + F.lit(UTM_K0 * big_a) * east) \
        .withColumn(y, F.lit(UTM_K0 * big_a) * north)
    return d.drop("_phi", "_dl", "_tt", "_xi", "_eta")


def utm_sql(lat: str, lon: str, zone: int = 33) -> tuple[str, str]:
    """The same projection as SQL text (used by the oracle queries)."""
    big_a, alpha, c = _utm_constants()
    phi = f"radians({lat})"
    dlam = f"(radians({lon}) - {math.radians(zone * 6.0 - 183.0)!r})"
    tt = f"sinh(atanh(sin({phi})) - {c!r} * atanh({c!r} * sin({phi})))"
    xi = f"atan2({tt}, cos({dlam}))"
    eta = f"atanh(sin({dlam}) / sqrt(1.0 + ({tt}) * ({tt})))"
    east = eta
    north = xi
    for j, a in enumerate(alpha, start=1):
        east += f" + {a!r} * cos({2.0 * j!r} * {xi}) * sinh({2.0 * j!r} * {eta})"
        north += f" + {a!r} * sin({2.0 * j!r} * {xi}) * cosh({2.0 * j!r} * {eta})"
    return (f"({UTM_FALSE_EASTING!r} + {UTM_K0 * big_a!r} * ({east}))", f"({UTM_K0 * big_a!r} * ({north}))")
