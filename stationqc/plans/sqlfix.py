"""The adapters of ``stationqc.sources.fixtures`` as DuckDB CTE text (oracle side)."""

from __future__ import annotations


def e_cells() -> str:
    return ("obs AS (SELECT user_id AS sid, date_trunc('hour', ts) AS t, "
            "10.0 + (value - 50.0) / 10.0 AS v FROM events), "
            "cells AS (SELECT t, sid, avg(v) AS v FROM obs WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY t, sid)")


def l_cells() -> str:
    return ("obs AS (SELECT l_suppkey AS sid, l_shipdate AS t, l_quantity - 10.0 AS v FROM lineitem), "
            "cells AS (SELECT t, sid, avg(v) AS v FROM obs WHERE v IS NOT NULL AND NOT isnan(v) GROUP BY t, sid)")


# Coordinates of station {0}: blocks of 24 stations, each in a 0.1 degree square of its own.
LAT = "46.40::DOUBLE + (({0}*37) % 1009)::DOUBLE / 10000.0 + (({0} // 24) % 100)::DOUBLE / 10.0"
LON = "11.25::DOUBLE + (({0}*401) % 1009)::DOUBLE / 10000.0 + ({0} // 2400)::DOUBLE * 0.15"
ALT = "CASE WHEN {0} % 17 = 16 THEN NULL ELSE 200.0::DOUBLE + (({0}*53) % 60)::DOUBLE * 10.0 END"

STATIONS = (f"stations AS (SELECT sid, {LAT.format('sid')} AS lat, {LON.format('sid')} AS lon, {ALT.format('sid')} AS alt "
            "FROM (SELECT DISTINCT sid FROM cells))")

GRID = ("grid AS (SELECT a.t, s.sid, c.v FROM (SELECT DISTINCT t FROM cells) a "
        "CROSS JOIN (SELECT DISTINCT sid FROM cells) s LEFT JOIN cells c ON c.t = a.t AND c.sid = s.sid)")

FGRID = ("fgrid AS (SELECT t, sid, coalesce(v, CASE WHEN ((epoch(t)::BIGINT // 3600)*31 + sid*17) % 97 < 90 "
         "THEN 10.0 + (((epoch(t)::BIGINT // 3600)*13 + sid*29) % 83)::DOUBLE / 8.3 END) AS v FROM grid)")


def season_sql(t: str) -> str:
    return (f"CASE WHEN month({t}) IN (12, 1, 2) THEN 'DJF' WHEN month({t}) IN (3, 4, 5) THEN 'MAM' "
            f"WHEN month({t}) IN (6, 7, 8) THEN 'JJA' ELSE 'SON' END")


def seasonal_good_sql(v: str, t: str, limits: dict) -> str:
    lo = " ".join(f"WHEN '{s}' THEN {float(b[0])!r}" for s, b in limits.items() if b[0] is not None)
    hi = " ".join(f"WHEN '{s}' THEN {float(b[1])!r}" for s, b in limits.items() if b[1] is not None)
    s = season_sql(t)
    lo_e = f"(CASE {s} {lo} END)" if lo else "NULL"
    hi_e = f"(CASE {s} {hi} END)" if hi else "NULL"
    return f"NOT coalesce({v} < {lo_e} OR {v} > {hi_e}, false)"


def completeness_sql(src: str, flag: str, p: float, name: str = "comp") -> str:
    """D12 over a dense relation ``src(t, sid, <flag>, ...)`` -> ``name`` with day_bad, month_bad, out."""
    return f"""
{name}_d AS (SELECT sid, t::DATE AS day, sum({flag}::INT) AS n_good FROM {src} GROUP BY sid, t::DATE),
{name}_ax AS (SELECT year(t) * 12 + month(t) - 1 AS mk, min(t) AS m_lo, max(t) AS m_hi,
          max(day(last_day(t))) AS dim FROM (SELECT DISTINCT t FROM {src}) GROUP BY 1),
{name}_g AS (SELECT floor((epoch(max(t)) - epoch(min(t))) / 86400) >= 30 AS guard FROM {src}),
{name}_m AS (SELECT d.sid, year(d.day) * 12 + month(d.day) - 1 AS mk,
          count(*) FILTER (WHERE d.n_good > 0) AS valid_days FROM {name}_d d GROUP BY 1, 2),
{name}_mb AS (SELECT m.sid, m.mk, m.valid_days,
          least(a.dim, floor((epoch(a.m_hi) - epoch(a.m_lo)) / 86400)::BIGINT + 1) AS expected,
          (SELECT guard FROM {name}_g) AND m.valid_days / least(a.dim, floor((epoch(a.m_hi) - epoch(a.m_lo)) / 86400)::BIGINT + 1) < {float(p)!r} AS month_bad
          FROM {name}_m m JOIN {name}_ax a ON a.mk = m.mk),
{name} AS (SELECT s.*, d.n_good / 24.0 < {float(p)!r} AS day_bad, mb.month_bad,
          s.{flag} AND NOT (d.n_good / 24.0 < {float(p)!r}) AND NOT mb.month_bad AS out
          FROM {src} s JOIN {name}_d d ON d.sid = s.sid AND d.day = s.t::DATE
          JOIN {name}_mb mb ON mb.sid = s.sid AND mb.mk = year(s.t) * 12 + month(s.t) - 1)"""


def proj_cte() -> str:
    from stationqc.functions.columns import utm_sql

    xs, ys = utm_sql("lat", "lon")
    return f"proj AS (SELECT sid, lat, lon, alt, {xs} AS x, {ys} AS y FROM stations)"


def buddy_ctes(src: str, vcol: str, prm, name: str) -> str:
    """D4 over ``src(t, sid, <vcol>, ...)`` -> ``name`` = src columns + ``bs`` (suspect)."""
    adj = "h.{v}".format(v=vcol)
    if prm.elev_gradient != 0:
        adj += f" + {float(prm.elev_gradient)!r} * (p.alt_j - p.alt_i)"
    elev = f"AND abs(b.alt - a.alt) <= {float(prm.max_elev_diff)!r}" if prm.max_elev_diff > 0 else ""
    return f"""{name}_pairs AS (SELECT a.sid AS i, b.sid AS j, a.alt AS alt_i, b.alt AS alt_j FROM proj a JOIN proj b
     ON a.sid <> b.sid WHERE sqrt((b.x - a.x)^2 + (b.y - a.y)^2) <= {float(prm.radius)!r} {elev}),
{name}_nb AS (SELECT g.t, g.sid, {adj} AS adj FROM {src} g JOIN {name}_pairs p ON p.i = g.sid
     JOIN {src} h ON h.t = g.t AND h.sid = p.j WHERE g.{vcol} IS NOT NULL AND h.{vcol} IS NOT NULL),
{name}_st AS (SELECT t, sid, count(*) AS n, count(adj) AS n_adj, avg(adj) AS m, stddev_pop(adj) AS s
     FROM {name}_nb GROUP BY t, sid),
{name} AS (SELECT g.*, (g.{vcol} IS NULL OR coalesce(st.n, 0) < {int(prm.num_min)}
     OR coalesce(st.n_adj = st.n AND abs(g.{vcol} - st.m) > {float(prm.threshold)!r} * greatest(st.s, {float(prm.min_std)!r}), false)) AS bs
     FROM {src} g LEFT JOIN {name}_st st ON st.t = g.t AND st.sid = g.sid)"""


def sct_closed_ctes(src: str, vcol: str, prm, stct: bool, name: str) -> str:
    """D7/D8 closed form over ``src`` -> ``name`` = src columns + temporal_flag + sct_flag."""
    band = (f"AND abs(s.alt - i0.alt) BETWEEN {prm.min_elev_diff!r} AND {prm.max_elev_diff!r}" if stct else "")
    bg = (f"(st.swv / st.sw + st.mda * {prm.vertical_scale!r})" if stct else "st.m")
    temporal = "OR g.temporal_flag" if stct else ""
    thr = float(prm.temporal_threshold)
    return f"""{name}_i0 AS (SELECT sid, lon, lat, alt FROM stations ORDER BY sid LIMIT 1),
{name}_nb AS (SELECT s.sid AS j, sqrt((s.lon - i0.lon)^2 + (s.lat - i0.lat)^2) AS dist, s.alt - i0.alt AS da
     FROM stations s, {name}_i0 i0 WHERE s.sid <> i0.sid {band}),
{name}_nk AS (SELECT * FROM {name}_nb ORDER BY dist, j LIMIT {int(prm.num_max)}),
{name}_st AS (SELECT f.t, count(*) AS n, count(f.{vcol}) AS nv, avg(f.{vcol}) AS m, stddev_pop(f.{vcol}) AS s,
     sum(f.{vcol} * (1.0 / (nk.dist + {prm.eps!r}))) AS swv, sum(1.0 / (nk.dist + {prm.eps!r})) AS sw,
     avg(nk.da) AS mda FROM {src} f JOIN {name}_nk nk ON nk.j = f.sid GROUP BY f.t),
{name}_g AS (SELECT *, coalesce(abs({vcol} - lag({vcol}) OVER (PARTITION BY sid ORDER BY t)) > {thr!r}, false)
     OR coalesce(abs({vcol} - lead({vcol}) OVER (PARTITION BY sid ORDER BY t)) > {thr!r}, false) AS temporal_flag
     FROM {src}),
{name} AS (SELECT g.*, g.sid = (SELECT sid FROM {name}_i0) AND (SELECT count(*) FROM stations) - 1 >= {int(prm.num_min)}
     AND (coalesce(st.nv = st.n AND (g.{vcol} - {bg} > {prm.pos_threshold!r} * st.s
                                     OR g.{vcol} - {bg} < -{prm.neg_threshold!r} * st.s), false) {temporal}) AS sct_flag
     FROM {name}_g g LEFT JOIN {name}_st st ON st.t = g.t)"""


def completeness_counters_sql(rel: str, level: int) -> str:
    return f"""(SELECT count(DISTINCT (sid, t::DATE)) FILTER (WHERE day_bad) FROM {rel})::BIGINT AS days_flagged_lvl{level},
(SELECT count(DISTINCT (sid, year(t) * 12 + month(t))) FILTER (WHERE month_bad) FROM {rel})::BIGINT AS months_flagged_lvl{level},
(SELECT count(DISTINCT sid) FILTER (WHERE day_bad) FROM {rel})::BIGINT AS stations_with_flagged_days_lvl{level},
(SELECT count(DISTINCT sid) FILTER (WHERE month_bad) FROM {rel})::BIGINT AS stations_with_flagged_months_lvl{level}"""


def greedy_ctes(src: str, vcol: str, prm: SctParams, stct: bool, name: str, check: str = "true") -> str:
    """The order-dependent scan over ``src(t, sid, <vcol>)`` as a recursive CTE: per
    time, state = (position k, flagged list f, processed list pr), one step per
    station in id order.  Produces ``name(t, sid[, temporal_flag], sct_flag)``.
    Needs the ``stations`` relation; only stations where ``check`` holds are tested."""
    band = (f"list_filter(ns2, lambda x: abs(x.da) >= {prm.min_elev_diff!r} AND abs(x.da) <= {prm.max_elev_diff!r})"
            if stct else "ns2")
    if stct:
        bg = (f"list_sum(list_transform(sel, lambda x: vs[x.p] * (1.0 / (x.d + {prm.eps!r})))) / "
              f"list_sum(list_transform(sel, lambda x: 1.0 / (x.d + {prm.eps!r}))) + "
              f"list_avg(list_transform(sel, lambda x: x.da)) * {prm.vertical_scale!r}")
        tcond = "OR tf[i]"
    else:
        bg = "list_avg(list_transform(sel, lambda x: vs[x.p]))"
        tcond = ""
    return f"""{name}_pos AS (SELECT sid, lon, lat, alt, coalesce({check}, false) AS chk, row_number() OVER (ORDER BY sid)::INT AS p FROM stations),
{name}_n AS (SELECT count(*)::INT AS s FROM {name}_pos),
{name}_pr AS (SELECT a.p AS pi, a.chk, b.p AS pj, b.sid AS sj, sqrt((b.lon - a.lon)^2 + (b.lat - a.lat)^2) AS d,
       b.alt - a.alt AS da FROM {name}_pos a, {name}_pos b),
{name}_nb AS (SELECT pi, bool_and(chk) AS chk, coalesce(list({{'p': pj, 'd': d, 'da': da}} ORDER BY d, sj)
                            FILTER (WHERE pj <> pi AND d <= {prm.outer_radius!r}), []) AS ns,
              coalesce(list(pj) FILTER (WHERE d <= {prm.inner_radius!r}), []) AS inn FROM {name}_pr GROUP BY pi),
{name}_tfl AS (SELECT t, sid, {vcol} AS v,
        coalesce(abs({vcol} - lag({vcol}) OVER (PARTITION BY sid ORDER BY t)) > {prm.temporal_threshold!r}, false)
        OR coalesce(abs({vcol} - lead({vcol}) OVER (PARTITION BY sid ORDER BY t)) > {prm.temporal_threshold!r}, false)
        AS tflag FROM {src}),
{name}_vals AS (SELECT g.t, list(g.v ORDER BY pos.p) AS vs, list(g.tflag ORDER BY pos.p) AS tf
         FROM {name}_tfl g JOIN {name}_pos pos ON pos.sid = g.sid GROUP BY g.t),
{name}_scan(t, vs, tf, k, f, pr) AS (
  SELECT t, vs, tf, 0, list_transform(range(1, (SELECT s FROM {name}_n) + 1), lambda x: false),
         list_transform(range(1, (SELECT s FROM {name}_n) + 1), lambda x: false) FROM {name}_vals
  UNION ALL
  SELECT t, vs, tf, i,
         list_transform(range(1, len(f) + 1), lambda x: CASE WHEN x = i THEN f[x] OR flag ELSE f[x] END),
         list_transform(range(1, len(pr) + 1), lambda x: pr[x] OR (NOT skip AND (x = i OR (tested AND list_contains(inn, x)))))
  FROM (SELECT *, tested AND (coalesce(len(sel) > 0 AND list_count(list_transform(sel, lambda x: vs[x.p])) = len(sel)
                  AND (vs[i] - ({bg}) > {prm.pos_threshold!r} * list_aggregate(list_transform(sel, lambda x: vs[x.p]), 'stddev_pop')
                       OR vs[i] - ({bg}) < -{prm.neg_threshold!r} * list_aggregate(list_transform(sel, lambda x: vs[x.p]), 'stddev_pop')),
                  false) {tcond}) AS flag
        FROM (SELECT *, list_slice({band}, 1, {prm.num_max}) AS sel
              FROM (SELECT *, NOT skip AND len(ns2) >= {prm.num_min} AS tested
                    FROM (SELECT s.t, s.vs, s.tf, s.f, s.pr, nb.pi AS i, nb.inn, s.pr[nb.pi] OR NOT nb.chk AS skip,
                                 list_filter(nb.ns, lambda x: NOT s.f[x.p]) AS ns2
                          FROM {name}_scan s JOIN {name}_nb nb ON nb.pi = s.k + 1))))),
{name}_fin AS (SELECT t, vs, tf, f FROM {name}_scan WHERE k = (SELECT s FROM {name}_n)),
{name} AS (SELECT fin.t, pos.sid{", fin.tf[pos.p] AS temporal_flag" if stct else ""}, fin.f[pos.p] AS sct_flag
           FROM {name}_fin fin, {name}_pos pos)"""
