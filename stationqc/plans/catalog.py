"""Registered queries: each a Spark plan over the driver tables plus, where SQL
can state it, the equivalent DuckDB text used as the correctness oracle.

Conventions shared by both sides: counts are BIGINT, doubles are rounded to 4
places, dates are ``yyyy-MM-dd`` strings, months ``yyyy-MM`` strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationqc.operators import grid as G
from stationqc.sources import fixtures as X

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- adapters
def cells_e(spark, sf):
    return G.hourly_cells(X.events_obs(spark, sf))


def grid_e(spark, sf):
    return G.dense_grid(cells_e(spark, sf))


def cells_l(spark, sf):
    return G.hourly_cells(X.lineitem_obs(spark, sf))


def grid_l(spark, sf):
    return G.dense_grid(cells_l(spark, sf))


def grid_f(spark, sf):
    return X.fill_rule(grid_e(spark, sf))


def r4(c):
    """Round to 4 places as round(x * 1e4) / 1e4 on the binary value (the oracle's rule)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * F.lit(10000.0)) / F.lit(10000.0)


def r4_tie(c):
    """``r4`` with exact ties broken upwards by a 1e-10 nudge.  For means of sums
    of fractional values the summation order differs between engines by ~1e-13;
    on a value exactly halfway (common for low-denominator rationals) both sides
    then still round the same way.  The oracle applies the same rule."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * F.lit(10000.0) + F.lit(1e-6)) / F.lit(10000.0)


def day_str(t="t"):
    return F.date_format(F.col(t), "yyyy-MM-dd")


def month_str(t="t"):
    return F.date_format(F.col(t), "yyyy-MM")


# import the query modules so that they register themselves
from stationqc.plans import (q_files, q_geo, q_grid, q_ingest, q_plans, q_runs, q_spatial, q_temporal,  # noqa: E402,F401
                             q_adaptive, q_propagate)
