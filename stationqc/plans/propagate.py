"""What a change of some station-months makes a rule do again.

A rule's flag of a cell depends on a neighbourhood of the cell.  From the changed
(station, month) set follow, rule by rule, the cells whose flag can differ (``redo``)
and the cells that deciding them needs (``context``):

* step (D9): the months and one axis step on either side; context one step more;
* rolling z (D14): the months and half a window on either side; context half a window more;
* completeness (D10-D12): the station-month itself;
* buddy (D4): the stations with a changed neighbour, for the months of the change; context
  their neighbours.

The rule then runs over the context alone, and its verdicts for the redo cells are
spliced into the stored flags.  The context of a station is one span for changes that lie
close together; apart they are separate spans, each of them a station of its own to
the rule.  Times are those of the stored axis: a change of values, not of the axis.

Grids and flags that lie by station, in ``parts`` parts where a step takes that number, meet
there: what has to be looked up (months, spans) comes as a few rows per station, and two
tables of cells meet as one union in which a station's rows are one group.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from stationqc.functions.columns import epoch_seconds, month_key
from stationqc.operators import runs as R
from stationqc.operators.buddy import buddy_check
from stationqc.operators.geo import radius_pairs_metric
from stationqc.operators.temporal import rolling_zscore, temporal_step
from stationqc.params import BuddyParams
from stationqc.session import spread

#: A changed station-month is (sid, mk), mk = 12 * year + month - 1.
CHANGES = ("sid", "mk")


def changed_months(old: DataFrame, new: DataFrame, v: str = "v") -> DataFrame:
    """``(sid, mk)`` in which two grids of the same cells differ.

    A cell of one grid alone differs if it has a value, a cell of both if its values are not all the same.
    """
    both = (old.select("t", "sid", F.col(v).alias("x"), F.lit(False).alias("is_new"))
            .unionByName(new.select("t", "sid", F.col(v).alias("x"), F.lit(True).alias("is_new"))))
    cells = both.groupBy("sid", "t").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_new").alias("n_new"), F.count("x").alias("filled"),
                                         F.min("x").alias("low"), F.max("x").alias("high"))
    paired = F.col("n_new").between(1, F.col("n") - 1) & F.col("sid").isNotNull() & F.col("t").isNotNull()
    same = (F.col("filled") == 0) | ((F.col("filled") == F.col("n")) & (F.col("low") == F.col("high")) & paired)
    return cells.where(~same).select("sid", month_key("t").alias("mk")).distinct()


def _in_months(rows: DataFrame, months: DataFrame) -> DataFrame:
    """The rows ``(sid, mk, ...)`` of the station-months ``(sid, mk)``.  A station's months (twelve a year) come
    as one array, so that rows that lie by station cross no shuffle."""
    of = months.groupBy(F.col("sid").alias("_sid")).agg(F.collect_set("mk").alias("_mks"))
    return rows.join(of, F.col("sid") == F.col("_sid")).where(F.array_contains("_mks", F.col("mk"))).drop("_sid", "_mks")


def _spans(edges: DataFrame, reach: int) -> DataFrame:
    """Edges ``(sid, lo, hi)`` of the changed months as spans ``(sid, span, lo, hi)``: those
    whose contexts (two reaches on either side) meet are one."""
    w = Window.partitionBy("sid").orderBy("lo", "hi")
    so_far = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = (so_far.isNull() | (F.col("lo") - 2 * reach > so_far + 2 * reach)).cast("int")
    spans = edges.withColumn("new", new).withColumn("span", F.sum("new").over(w))
    return spans.groupBy("sid", "span").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def _over_spans(grid: DataFrame, at, edges: DataFrame, reach: int, rule: Callable[[DataFrame], DataFrame], flags: list[str]) -> DataFrame:
    """``rule`` over the context of every span, its ``flags`` for the redo cells ``(t, sid, ...)``."""
    spans = _spans(edges, reach).select(F.col("sid").alias("_sid"), "span", "lo", "hi")
    cells = grid.withColumn("_at", at)
    near = (F.col("sid") == F.col("_sid")) & F.col("_at").between(F.col("lo") - 2 * reach, F.col("hi") + 2 * reach)
    context = cells.join(spans, near).withColumn("sid", F.struct("_sid", "span")).drop("_sid", "span")
    done = rule(context).where(F.col("_at").between(F.col("lo") - reach, F.col("hi") + reach))
    return done.select("t", F.col("sid._sid").alias("sid"), *flags)


def redo_step(grid: DataFrame, axis: DataFrame, changes: DataFrame, thr: float, parts: int | None = None) -> DataFrame:
    """D9 anew: ``(t, sid, step_suspect)`` of the cells that the changes can reach; ``axis`` is ``time_axis``."""
    months = axis.groupBy(month_key("t").alias("mk")).agg(F.min("idx").alias("lo"), F.max("idx").alias("hi"))
    edges = changes.join(F.broadcast(months), "mk").select("sid", "lo", "hi")
    placed = grid.join(F.broadcast(axis.select("t", "idx")), "t")
    return _over_spans(placed, F.col("idx"), edges, 1, lambda g: temporal_step(g, thr, parts=parts), ["step_suspect"])


def redo_rolling(grid: DataFrame, axis: DataFrame, changes: DataFrame, window_hours: int, thr: float, min_samples: int,
                 parts: int | None = None) -> DataFrame:
    """D14 anew: ``(t, sid, roll_good)`` of the cells that the changes can reach."""
    sec = epoch_seconds("t")
    months = axis.groupBy(month_key("t").alias("mk")).agg(F.min(sec).alias("lo"), F.max(sec).alias("hi"))
    edges = changes.join(F.broadcast(months), "mk").select("sid", "lo", "hi")
    return _over_spans(grid, sec, edges, int(window_hours) // 2 * 3600,
                       lambda g: rolling_zscore(g, window_hours, thr, min_samples, parts=parts), ["roll_good"])


def redo_completeness(axis: R.RunGrid, cells: DataFrame, changes: DataFrame, p: float, parts: int | None = None) -> DataFrame:
    """D10-D12 anew for the changed station-months: ``(sid, day, day_bad, month_bad, n_out)``.

    ``axis`` has the axis tables, ``cells`` the filled cells after the change.
    """
    mine = _in_months(cells.withColumn("mk", month_key("t")), changes).drop("mk")
    some = R.RunGrid(mine, axis.days.join(changes.select("mk").distinct(), "mk", "left_semi"),
                     axis.months.join(changes.select("mk").distinct(), "mk", "left_semi"), changes.select("sid").distinct())
    days = R.station_days(some, p, parts=parts).withColumn("mk", month_key("day"))
    return _in_months(days, changes).select("sid", "day", "day_bad", "month_bad", "n_out")


def redo_buddy(grid: DataFrame, stations: DataFrame, changes: DataFrame, prm: BuddyParams, parts: int | None = None) -> DataFrame:
    """D4 anew: ``(t, sid, buddy_suspect)`` of the changed stations and their neighbours, in the changed months."""
    pairs = radius_pairs_metric(stations, prm.radius).select("i", "j")

    def with_neighbours(months: DataFrame) -> DataFrame:
        return months.unionByName(months.join(pairs, F.col("sid") == F.col("i")).select(F.col("j").alias("sid"), "mk")).distinct()
    redo = with_neighbours(changes)
    context = _in_months(grid.withColumn("mk", month_key("t")), with_neighbours(redo))
    done = buddy_check(context.select("t", "sid", "v"), stations, prm, out="buddy_suspect", parts=parts).withColumn("mk", month_key("t"))
    return _in_months(done, redo).select("t", "sid", "buddy_suspect")


def splice(stored: DataFrame, redone: DataFrame, keys: tuple[str, ...] = ("t", "sid"), parts: int | None = None) -> DataFrame:
    """The stored rows with those that were done again in their place.

    ``keys`` hold the station: stored rows that lie by station, in ``parts`` parts, stay there.
    """
    both = (spread(stored.withColumn("_again", F.lit(False)), "sid", parts=parts)
            .unionByName(spread(redone.select(*stored.columns, F.lit(True).alias("_again")), "sid", parts=parts)))
    unknown = functools.reduce(operator.or_, [F.col(k).isNull() for k in keys])       # a null key is none of the others
    again = F.max("_again").over(Window.partitionBy(*sorted(keys, key="sid".__ne__)))
    return both.withColumn("_done", again & ~unknown).where(F.col("_again") | ~F.col("_done")).select(*stored.columns)
