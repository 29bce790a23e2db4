"""Seasonal range limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stationqc.functions.columns import col_, season


def _bound(s: Column, limits: dict, pos: int) -> Column:
    expr = None
    for name, lim in limits.items():
        val = lim[pos] if lim is not None else None
        if val is None:
            continue
        expr = (F.when(s == F.lit(name), F.lit(float(val))) if expr is None
                else expr.when(s == F.lit(name), F.lit(float(val))))
    return expr if expr is not None else F.lit(None).cast("double")


def seasonal_good(v, t, limits: dict) -> Column:
    """Good-flag: bad when v < min or v > max of the season; missing is good.

    ``limits`` maps season -> (min, max); either bound may be None.  The limits
    are folded into the expression (four seasons), so no join is needed.
    """
    s = season(t)
    v = col_(v)
    bad = (v < _bound(s, limits, 0)) | (v > _bound(s, limits, 1))
    return ~F.coalesce(bad, F.lit(False))


def seasonal_threshold(grid: DataFrame, limits: dict, v: str = "v", out: str = "seasonal_good") -> DataFrame:
    return grid.withColumn(out, seasonal_good(v, "t", limits))
