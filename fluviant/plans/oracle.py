"""DuckDB SQL for the river-network queries, over the stamped tables."""

from __future__ import annotations

from . import fixtures

# Networks are built up by common table expressions: rep (repaired), ord (ordered),
# net0 (without small watersheds), then dissolve, prune, route and merge steps.

_REPAIR = """
    zc AS (SELECT s.LINKNO AS id, CAST(CASE WHEN s.DSLINKNO <> -1 THEN 2 WHEN EXISTS (SELECT 1 FROM streams u WHERE u.DSLINKNO = s.LINKNO) THEN 3 ELSE 1 END AS INTEGER) AS "case"
           FROM streams s WHERE s.LengthGeodesicMeters <= 0.01),
    hop(id, ds) AS (SELECT LINKNO, DSLINKNO FROM streams WHERE LINKNO NOT IN (SELECT id FROM zc)
                    UNION ALL SELECT h.id, s.DSLINKNO FROM hop h JOIN zc ON zc.id = h.ds AND zc."case" = 2 JOIN streams s ON s.LINKNO = h.ds),
    rep AS (SELECT s.* EXCLUDE (DSLINKNO), CAST(CASE WHEN h.ds IN (SELECT id FROM zc WHERE "case" = 3) THEN -1 ELSE h.ds END AS BIGINT) AS DSLINKNO
            FROM hop h JOIN streams s ON s.LINKNO = h.id WHERE h.ds NOT IN (SELECT id FROM zc WHERE "case" = 2)),
    walk(start, cur, d) AS (SELECT LINKNO, LINKNO, CAST(0 AS BIGINT) FROM rep
                            UNION ALL SELECT w.start, r.DSLINKNO, w.d + 1 FROM walk w JOIN rep r ON r.LINKNO = w.cur WHERE r.DSLINKNO <> -1),
    term AS (SELECT w.start AS LINKNO, w.cur AS TerminalLink FROM walk w JOIN rep r ON r.LINKNO = w.cur WHERE r.DSLINKNO = -1),
    ht AS (SELECT cur AS LINKNO, max(d) AS height FROM walk GROUP BY cur),
    ord AS (SELECT r.*, row_number() OVER (PARTITION BY TDXHydroRegion ORDER BY height, LINKNO) AS TopologicalOrder FROM rep r JOIN ht USING (LINKNO)),
    small AS (SELECT t.LINKNO FROM term t JOIN ord o ON o.LINKNO = t.TerminalLink WHERE o.DSContArea < 2e8),
    net0 AS (SELECT o.*, CAST(1 AS BIGINT) AS n_lines FROM ord o WHERE LINKNO NOT IN (SELECT LINKNO FROM small))
"""


def _dissolve(m: int, before: str) -> str:
    """Candidates, labels and the dissolved network of one pass."""
    return f"""
    st{m} AS (SELECT r.DSLINKNO AS id, count(*) AS n, max(s.strmOrder) AS hi, count(*) FILTER (WHERE s.strmOrder = {m - 1}) AS c
              FROM rep r JOIN {before} s ON s.LINKNO = r.LINKNO WHERE r.DSLINKNO <> -1 GROUP BY r.DSLINKNO),
    cand{m} AS (SELECT s.LINKNO AS id FROM {before} s JOIN st{m} p ON p.id = s.LINKNO
                WHERE s.strmOrder = {m} AND ((n = 2 AND c = 2) OR (n > 2 AND NOT (hi <> {m - 1} AND c >= 2)))),
    lab{m} AS (SELECT w.start AS LINKNO, arg_max(w.cur, w.d) AS keep FROM walk w JOIN cand{m} c ON c.id = w.cur GROUP BY w.start),
    abs{m} AS (SELECT l.keep, sum(s.USContArea) AS us, sum(s.n_lines) AS nl FROM {before} s JOIN lab{m} l USING (LINKNO) WHERE l.keep <> s.LINKNO GROUP BY l.keep),
    net{m} AS (SELECT s.* REPLACE (coalesce(a.us, s.USContArea) AS USContArea, CAST(s.n_lines + coalesce(a.nl, 0) AS BIGINT) AS n_lines)
               FROM {before} s LEFT JOIN abs{m} a ON a.keep = s.LINKNO LEFT JOIN lab{m} l ON l.LINKNO = s.LINKNO WHERE l.keep IS NULL OR l.keep = s.LINKNO)"""


def _prune(m: int) -> str:
    """Prune pairs on the network after pass ``m``; lines keep the labels of all passes."""
    label = "coalesce(l3.keep, l2.keep, r.LINKNO)" if m == 3 else "coalesce(l2.keep, r.LINKNO)"
    join3 = "LEFT JOIN lab3 l3 ON l3.LINKNO = r.LINKNO" if m == 3 else ""
    return f"""
    lines AS (SELECT {label} AS LINKNO, r.x, r.y, r.px, r.py FROM net0 r LEFT JOIN lab2 l2 ON l2.LINKNO = r.LINKNO {join3}),
    side AS (SELECT s.LINKNO AS dr, s.DSLINKNO, (s.x + s.px) / 2 AS cx, (s.y + s.py) / 2 AS cy FROM net{m} s
             WHERE s.strmOrder = 1 AND s.DSLINKNO IN (SELECT LINKNO FROM net{m} WHERE strmOrder >= 2)),
    sib AS (SELECT side.*, k.LINKNO AS s, k.strmOrder AS o FROM side JOIN rep r ON r.DSLINKNO = side.DSLINKNO AND r.LINKNO <> side.dr JOIN net{m} k ON k.LINKNO = r.LINKNO),
    seg AS (SELECT sib.dr, sib.s, cx, cy, l.x, l.y, l.px - l.x AS dx, l.py - l.y AS dy FROM sib JOIN lines l ON l.LINKNO = sib.s),
    near AS (SELECT dr, s, min(sqrt(pow(cx - (x + t * dx), 2) + pow(cy - (y + t * dy), 2))) AS dist FROM
             (SELECT *, CASE WHEN dx * dx + dy * dy > 0 THEN least(greatest(((cx - x) * dx + (cy - y) * dy) / (dx * dx + dy * dy), 0e0), 1e0) ELSE 0e0 END AS t FROM seg)
             GROUP BY dr, s),
    pick AS (SELECT sib.dr, count(*) AS n, min(sib.s) AS only_s, min(o) AS lo, max(o) AS hi, min(sib.s) FILTER (WHERE o > 1) AS first_higher, arg_min(sib.s, (near.dist, sib.s)) AS nearest
             FROM sib JOIN near ON near.dr = sib.dr AND near.s = sib.s GROUP BY sib.dr),
    prune AS (SELECT CASE WHEN n = 1 THEN only_s WHEN lo = 1 AND hi > 1 THEN first_higher ELSE nearest END AS LINKNO, dr AS LINKTODROP FROM pick),
    pruned AS (SELECT * FROM net{m} WHERE LINKNO NOT IN (SELECT LINKTODROP FROM prune))"""


def _route(source: str) -> str:
    return f"""
    vel AS (SELECT *, greatest(round_even(exp(0.16842e0 * ln(DSContArea) - 4.68e0) * 1000, 0) / 1000, 0.25e0) AS velocity_factor FROM {source}),
    routed AS (SELECT * , CASE WHEN LINKNO IN (SELECT LINKNO FROM lakes) THEN greatest(k0, 3600) ELSE k0 END AS musk_k,
                      CASE WHEN LINKNO IN (SELECT LINKNO FROM lakes) THEN 0.01e0 ELSE 0.25e0 END AS musk_x
               FROM (SELECT *, CAST(least(greatest(round_even(LengthGeodesicMeters / velocity_factor, 0), 0), 100000) AS BIGINT) AS k0 FROM vel))"""


_MERGE = """
    ups AS (SELECT DSLINKNO AS LINKNO, min(LINKNO) AS u, min(musk_k) AS uk FROM routed WHERE DSLINKNO <> -1 GROUP BY DSLINKNO HAVING count(*) = 1),
    opt AS (SELECT r.LINKNO, r.DSLINKNO, a.u, a.uk, CASE WHEN b.LINKNO IS NOT NULL THEN d.musk_k END AS dk
            FROM routed r LEFT JOIN ups a ON a.LINKNO = r.LINKNO LEFT JOIN ups b ON b.LINKNO = r.DSLINKNO LEFT JOIN routed d ON d.LINKNO = r.DSLINKNO WHERE r.musk_k < 900),
    merges AS (SELECT DISTINCT * FROM (
               SELECT LINKNO, u AS MergeWith FROM opt WHERE u IS NOT NULL AND (dk IS NULL OR uk <= dk)
               UNION ALL SELECT DSLINKNO, LINKNO FROM opt WHERE dk IS NOT NULL AND (u IS NULL OR uk > dk))),
    mhop(id, target) AS (SELECT MergeWith, LINKNO FROM merges UNION ALL SELECT h.id, m.LINKNO FROM mhop h JOIN merges m ON m.MergeWith = h.target),
    mlab AS (SELECT id, target FROM mhop WHERE target NOT IN (SELECT MergeWith FROM merges)),
    folded AS (SELECT l.target, min(r.USContArea) AS us, max(r.DSContArea) AS ds, sum(r.LengthGeodesicMeters) AS len FROM routed r JOIN mlab l ON l.id = r.LINKNO GROUP BY l.target),
    merged AS (SELECT r.* REPLACE (least(r.USContArea, coalesce(f.us, r.USContArea)) AS USContArea, greatest(r.DSContArea, coalesce(f.ds, r.DSContArea)) AS DSContArea,
                      r.LengthGeodesicMeters + coalesce(f.len, 0e0) AS LengthGeodesicMeters, coalesce(l.target, r.DSLINKNO) AS DSLINKNO)
               FROM routed r LEFT JOIN folded f ON f.target = r.LINKNO LEFT JOIN mlab l ON l.id = r.DSLINKNO WHERE r.LINKNO NOT IN (SELECT id FROM mlab))"""

_E2 = "(1e0 / 298.257223563e0 * (2e0 - 1e0 / 298.257223563e0))"


def _y(lat: str) -> str:
    """Metres north on the equal-area cylinder."""
    s = f"sin(radians({lat}))"
    return f"(6378137e0 * (1 - {_E2}) * ({s} / (1 - {_E2} * {s} * {s}) - ln((1 - sqrt({_E2}) * {s}) / (1 + sqrt({_E2}) * {s})) / (2 * sqrt({_E2}))) / 2)"


def _rect(x0: str, x1: str, y0: str, y1: str) -> str:
    """Square metres of a rectangle in degrees."""
    return f"(6378137e0 * radians(({x1}) - ({x0})) * ({_y(y1)} - {_y(y0)}))"


def _axes(step: str, margin: str) -> str:
    """Cells of the two axes: index, coordinate, band."""

    def cells(name: str, values: str) -> str:
        return f"""{name} AS (SELECT idx, c, coalesce((c + lag(c) OVER (ORDER BY c)) / 2, c - {margin}) AS lo, coalesce((c + lead(c) OVER (ORDER BY c)) / 2, c + {margin}) AS hi
            FROM (SELECT c, min(idx) AS idx FROM ({values}) GROUP BY c))"""

    lon = f"SELECT CAST(j AS INTEGER) AS idx, CASE WHEN j * {step} > 180 THEN j * {step} - 360 ELSE j * {step} END AS c FROM range(CAST(360 / {step} AS BIGINT)) t(j)"
    lat = f"SELECT CAST(j AS INTEGER) AS idx, 90e0 - j * {step} AS c FROM range(CAST(180 / {step} AS BIGINT) + 1) t(j)"
    return cells("xs", lon) + ",\n    " + cells("ys", lat)


#: Widths of longitude that a 0.25 degree grid spans once wrapped, hence its envelope.
_MARGIN = "359.75e0"

_WEIGHTS = (
    _axes("0.25e0", _MARGIN)
    + f""",
    wide AS (SELECT LINKNO, x - 0.1e0 AS x0, x + 0.1e0 AS x1, y - 0.1e0 AS y0, y + 0.1e0 AS y1 FROM streams),
    met AS (SELECT LINKNO, xs.idx AS lon_index, ys.idx AS lat_index, (xs.lo + xs.hi) / 2 AS lon, (ys.lo + ys.hi) / 2 AS lat,
                   greatest(x0, xs.lo) AS a0, least(x1, xs.hi) AS a1, greatest(y0, ys.lo) AS b0, least(y1, ys.hi) AS b1
            FROM wide JOIN xs ON xs.lo < x1 AND xs.hi > x0 JOIN ys ON ys.lo < y1 AND ys.hi > y0),
    weights AS (SELECT LINKNO, lon_index, lat_index, lon, lat, {_rect("a0", "a1", "b0", "b1")} AS area_sqm FROM met)"""
)

_AREA = "round_even(area_sqm / 1e6 * 1000, 0) / 1000 AS area_km2, round_even(lon * 1000000, 0) / 1000000 AS lon, round_even(lat * 1000000, 0) / 1000000 AS lat"


def _q(final: str, *steps: str) -> str:
    return "WITH RECURSIVE " + ",".join((fixtures.SQL, *steps)) + "\n" + final


def _r(expr: str, digits: int, name: str) -> str:
    return f"round_even({expr} * 1e{digits}, 0) / 1e{digits} AS {name}"


_D2, _D3 = _dissolve(2, "net0"), _dissolve(3, "net2")
_FLAT = "flat AS (SELECT r.*, t.TerminalLink FROM routed r JOIN term t USING (LINKNO))"
_SHAPE = "LINKNO, DSLINKNO, strmOrder, TopologicalOrder, round_even(USContArea, 0) AS USContArea, n_lines"
_LEVELS = f"{_r('USContArea', 3, 'USContArea')}, {_r('DSContArea', 3, 'DSContArea')}, {_r('LengthGeodesicMeters', 3, 'LengthGeodesicMeters')}"

#: Both axes of the grid with their wrapped coordinates.
_GRID = (
    "ax AS (SELECT 'lon' AS axis, CAST(j AS INTEGER) AS idx, j * 0.25e0 AS coord, CASE WHEN j * 0.25e0 > 180 THEN j * 0.25e0 - 360 ELSE j * 0.25e0 END AS c FROM range(1440) t(j) "
    "UNION ALL SELECT 'lat', CAST(j AS INTEGER), 90e0 - j * 0.25e0, 90e0 - j * 0.25e0 FROM range(721) t(j))"
)

_F = "(1e0 / 298.257223563e0)"

#: Vincenty's inverse formula between the ends of each line, a fixed number of rounds.
_VINCENTY = f"""
    g0 AS (SELECT LINKNO, radians(px - x) AS span, atan((1 - {_F}) * tan(radians(y))) AS u1, atan((1 - {_F}) * tan(radians(py))) AS u2 FROM streams WHERE x <> px OR y <> py),
    it(LINKNO, span, u1, u2, lam, n) AS (
        SELECT LINKNO, span, u1, u2, span, 0 FROM g0
        UNION ALL SELECT LINKNO, span, u1, u2, span + (1 - c) * {_F} * sa * (sigma + c * ss * (c2m + c * cs * (2 * c2m * c2m - 1))), n + 1
        FROM (SELECT *, {_F} / 16 * c2a * (4 + {_F} * (4 - 3 * c2a)) AS c FROM (SELECT *, cs - 2 * sin(u1) * sin(u2) / c2a AS c2m FROM (SELECT *, 1 - sa * sa AS c2a, atan2(ss, cs) AS sigma FROM (
              SELECT *, cos(u1) * cos(u2) * sin(lam) / ss AS sa FROM (
              SELECT *, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM it WHERE n < 8))))) ),
    vin AS (SELECT LINKNO, 6356752.314245179e0 * (1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))) * (sigma - m * ss * (c2m + m / 4 * (cs * (2 * c2m * c2m - 1) - m / 6 * c2m * (4 * ss * ss - 3) * (4 * c2m * c2m - 3)))) AS len
            FROM (SELECT *, u / 1024 * (256 + u * (-128 + u * (74 - 47 * u))) AS m FROM (SELECT *, cs - 2 * sin(u1) * sin(u2) / c2a AS c2m, c2a * (pow(6378137e0, 2) - pow(6356752.314245179e0, 2)) / pow(6356752.314245179e0, 2) AS u
                  FROM (SELECT *, 1 - sa * sa AS c2a, atan2(ss, cs) AS sigma FROM (SELECT *, cos(u1) * cos(u2) * sin(lam) / ss AS sa FROM (
                  SELECT *, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs FROM it WHERE n = 8))))))"""

#: Line simplification: a stretch is split at its farthest point while that is too far off.
_SIMPLIFY = """
    pts AS (SELECT b, list(price / 1e6 ORDER BY i) AS ys, count(*) AS n FROM st GROUP BY b),
    stretch(b, lo, hi) AS (
        SELECT b, CAST(1 AS BIGINT), n FROM pts
        UNION ALL SELECT b, h.lo, h.hi FROM (SELECT b, unnest([{lo: lo, hi: -far.k}, {lo: -far.k, hi: hi}]) AS h FROM (
            SELECT s.b, s.lo, s.hi, list_max(list_transform(range(s.lo + 1, s.hi), lambda k: {
                d: sqrt(pow((k - s.lo) * 1e-2 - t(k, s.lo, s.hi, ys) * (s.hi - s.lo) * 1e-2, 2) + pow(ys[k] - ys[s.lo] - t(k, s.lo, s.hi, ys) * (ys[s.hi] - ys[s.lo]), 2)), k: -k})) AS far
            FROM stretch s JOIN pts USING (b) WHERE s.hi - s.lo > 1) WHERE far.d > 5e-2))"""


def _along(k: str, lo: str, hi: str) -> str:
    """Where on the way from one point to another a third one is nearest, between 0 and 1."""
    dx, dy = f"(({hi} - {lo}) * 1e-2)", f"(ys[{hi}] - ys[{lo}])"
    return f"least(greatest((({k} - {lo}) * 1e-2 * {dx} + (ys[{k}] - ys[{lo}]) * {dy}) / ({dx} * {dx} + {dy} * {dy}), 0e0), 1e0)"


_SIMPLIFY = _SIMPLIFY.replace("t(k, s.lo, s.hi, ys)", _along("k", "s.lo", "s.hi"))

#: Concave basins: what a cell shares with the square less what it shares with the quarter.
_ELBOW = (
    _axes("0.25e0", _MARGIN)
    + f""",
    elbow AS (SELECT LINKNO, x, y, x - 2e-1 AS x0, x + 2e-1 AS x1, y - 2e-1 AS y0, y + 2e-1 AS y1 FROM streams),
    cut AS (SELECT LINKNO, xs.idx AS lon_index, ys.idx AS lat_index, (xs.lo + xs.hi) / 2 AS lon, (ys.lo + ys.hi) / 2 AS lat,
                   greatest(x0, xs.lo) AS a0, least(x1, xs.hi) AS a1, greatest(y0, ys.lo) AS b0, least(y1, ys.hi) AS b1, greatest(x, xs.lo) AS c0, greatest(y, ys.lo) AS d0
            FROM elbow JOIN xs ON xs.lo < x1 AND xs.hi > x0 JOIN ys ON ys.lo < y1 AND ys.hi > y0),
    weights AS (SELECT LINKNO, lon_index, lat_index, lon, lat, {_rect("a0", "a1", "b0", "b1")} - CASE WHEN c0 < a1 AND d0 < b1 THEN {_rect("c0", "a1", "d0", "b1")} ELSE 0 END AS area_sqm
                FROM cut WHERE NOT (c0 = a0 AND d0 = b0 AND c0 < a1 AND d0 < b1))"""
)

#: The content of a unit's files, line by line in the order of its rivers.
_UNIT_FILES = """
    master AS (SELECT f.*, VPUCode FROM flat f JOIN vpu USING (TerminalLink)),
    width AS (SELECT VPUCode, max(n) AS w FROM (SELECT VPUCode, DSLINKNO, count(*) FILTER (WHERE DSLINKNO <> -1) AS n FROM master GROUP BY VPUCode, DSLINKNO) GROUP BY VPUCode),
    up AS (SELECT DSLINKNO AS LINKNO, list(LINKNO ORDER BY TopologicalOrder, LINKNO) AS ids FROM master WHERE DSLINKNO <> -1 GROUP BY DSLINKNO),
    line AS (SELECT VPUCode, TopologicalOrder, m.LINKNO, musk_k, musk_x, m.LINKNO || ',' || DSLINKNO || ',' || coalesce(len(ids), 0)
                    || CASE WHEN w > 0 THEN ',' || array_to_string(list_resize(coalesce(ids, []), w, 0), ',') ELSE '' END AS connect
             FROM master m LEFT JOIN up USING (LINKNO) JOIN width USING (VPUCode)),
    texts AS (SELECT VPUCode, string_agg(connect || chr(10), '' ORDER BY TopologicalOrder, LINKNO) AS a, string_agg(LINKNO || chr(10), '' ORDER BY TopologicalOrder, LINKNO) AS b,
                     string_agg(musk_k || chr(10), '' ORDER BY TopologicalOrder, LINKNO) AS c, string_agg(musk_x || chr(10), '' ORDER BY TopologicalOrder, LINKNO) AS d,
                     'LINKNO,lat,lon,z' || chr(10) || string_agg(LINKNO || ',0,0,0' || chr(10), '' ORDER BY TopologicalOrder, LINKNO) AS e, count(*) AS n
              FROM line GROUP BY VPUCode)"""

ORACLE_SQL = {
    "global_ids": _q("SELECT LINKNO, DSLINKNO, strmOrder, TDXHydroRegion FROM streams"),
    "zero_length_classes": _q("SELECT * FROM zc", _REPAIR),
    "zero_length_repair": _q("SELECT LINKNO, DSLINKNO FROM rep", _REPAIR),
    "basins_repaired": _q("SELECT LINKNO FROM streams WHERE LINKNO NOT IN (SELECT id FROM zc) AND LINKNO NOT IN (SELECT LINKNO FROM small)", _REPAIR),
    "topological_order": _q("SELECT TDXHydroRegion, LINKNO, TopologicalOrder FROM ord", _REPAIR),
    "ancestor_pairs": _q("SELECT start AS ancestor, cur AS LINKNO, d AS distance FROM walk WHERE d > 0", _REPAIR),
    "small_watersheds_dropped": _q("SELECT LINKNO, DSLINKNO, TopologicalOrder FROM net0", _REPAIR),
    "headwater_candidates_o2": _q("SELECT id FROM cand2", _REPAIR, _D2),
    "headwater_candidates_o3": _q("SELECT id FROM cand3", _REPAIR, _D2, _D3),
    "headwaters_dissolved_o2": _q(f"SELECT {_SHAPE} FROM net2", _REPAIR, _D2),
    "headwaters_dissolved_o3": _q(f"SELECT {_SHAPE} FROM net3", _REPAIR, _D2, _D3),
    "prune_pairs": _q("SELECT LINKNO, LINKTODROP FROM prune", _REPAIR, _D2, _prune(2)),
    "branches_pruned": _q("SELECT LINKNO, DSLINKNO FROM pruned", _REPAIR, _D2, _prune(2)),
    "muskingum_k_x": _q("SELECT LINKNO, velocity_factor, musk_k, musk_x FROM routed", _route("streams")),
    "k_agg_helpers": _q(
        "SELECT DSLINKNO, CASE WHEN count(*) > 1 THEN max(musk_k) FILTER (WHERE rn = n) + max(musk_k) FILTER (WHERE rn < n) ELSE max(musk_k) END AS last_plus_max, "
        "round_even(CASE WHEN count(*) > 1 THEN avg(musk_k) * 3.5 ELSE max(musk_k) END * 1e3, 0) / 1e3 AS scaled_mean "
        "FROM (SELECT *, row_number() OVER (PARTITION BY DSLINKNO ORDER BY LINKNO) AS rn, count(*) OVER (PARTITION BY DSLINKNO) AS n FROM routed WHERE DSLINKNO <> -1) GROUP BY DSLINKNO",
        _route("streams"),
    ),
    "short_stream_pairs": _q("SELECT LINKNO, MergeWith FROM merges", _REPAIR, _D2, _prune(2), _route("pruned"), _MERGE),
    "short_streams_merged": _q(
        f"SELECT LINKNO, DSLINKNO, round_even(USContArea, 0) AS USContArea, round_even(DSContArea, 0) AS DSContArea, {_r('LengthGeodesicMeters', 3, 'LengthGeodesicMeters')}, musk_k FROM merged",
        _REPAIR, _D2, _prune(2), _route("pruned"), _MERGE,
    ),
    "terminal_links": _q("SELECT LINKNO, TerminalLink FROM term", _REPAIR),
    "rapid_connect": _q(
        "SELECT o.LINKNO AS HydroID, o.DSLINKNO AS NextDownID, coalesce(u.n, 0) AS CountUpstreamID, coalesce(ids[1], 0) AS UpstreamID1, coalesce(ids[2], 0) AS UpstreamID2, coalesce(ids[3], 0) AS UpstreamID3 "
        "FROM ord o LEFT JOIN (SELECT DSLINKNO, count(*) AS n, list(LINKNO ORDER BY TopologicalOrder, LINKNO) AS ids FROM ord WHERE DSLINKNO <> -1 GROUP BY DSLINKNO) u ON u.DSLINKNO = o.LINKNO",
        _REPAIR,
    ),
    "routing_columns": _q("SELECT TopologicalOrder, LINKNO, musk_k, musk_x, CAST(0 AS INTEGER) AS lat, CAST(0 AS INTEGER) AS lon, CAST(0 AS INTEGER) AS z FROM flat", _REPAIR, _route("ord"), _FLAT),
    "global_master": _q(f"SELECT LINKNO, DSLINKNO, strmOrder, TDXHydroRegion, VPUCode, TopologicalOrder, TerminalLink, musk_k, musk_x, {_LEVELS} FROM flat JOIN vpu USING (TerminalLink)", _REPAIR, _route("ord"), _FLAT),
    "missing_vpu_labels": _q("SELECT LINKNO, TerminalLink FROM flat WHERE TerminalLink NOT IN (SELECT TerminalLink FROM vpu WHERE b % 11 <> 0)", _REPAIR, _route("ord"), _FLAT),
    "vpu_weights_subset": _q(f"SELECT w.LINKNO, VPUCode, lon_index, lat_index, {_AREA} FROM weights w JOIN flat f ON f.LINKNO = w.LINKNO JOIN vpu USING (TerminalLink)", _REPAIR, _route("ord"), _FLAT, _WEIGHTS),
    "vpu_streams_geometry": _q(f"SELECT f.LINKNO, VPUCode, {_r('6378137e0 * radians(x)', 1, 'x0')}, {_r('6378137e0 * ln(tan(pi() / 4 + radians(y) / 2))', 1, 'y0')} FROM flat f JOIN vpu USING (TerminalLink)", _REPAIR, _route("ord"), _FLAT),
    "thiessen_cells": _q(
        f"SELECT xs.idx AS lon_index, ys.idx AS lat_index, {_r('(xs.lo + xs.hi) / 2', 6, 'lon')}, {_r('(ys.lo + ys.hi) / 2', 6, 'lat')}, "
        f"{_r('xs.lo', 6, 'x0')}, {_r('xs.hi', 6, 'x1')}, {_r('ys.lo', 6, 'y0')}, {_r('ys.hi', 6, 'y1')} FROM xs CROSS JOIN ys",
        _axes("2.5e0", "357.5e0"),
    ),
    "grid_axis_window": _q(
        "SELECT axis, idx, coord FROM ax WHERE CASE WHEN axis = 'lon' THEN idx BETWEEN (SELECT arg_min(idx, (abs(c - x0), idx)) FROM ax, bb WHERE axis = 'lon') AND (SELECT arg_min(idx, (abs(c - x1), idx)) FROM ax, bb WHERE axis = 'lon') "
        "ELSE idx BETWEEN (SELECT arg_min(idx, (abs(c - y1), idx)) FROM ax, bb WHERE axis = 'lat') AND (SELECT arg_min(idx, (abs(c - y0), idx)) FROM ax, bb WHERE axis = 'lat') END",
        "bb AS (SELECT min(x) - 0.005e0 - 0.25e0 AS x0, max(x) + 0.005e0 + 0.25e0 AS x1, min(y) - 0.005e0 - 0.25e0 AS y0, max(y) + 0.005e0 + 0.25e0 AS y1 FROM streams)",
        _GRID,
    ),
    "weights_full": _q(f"SELECT LINKNO, lon_index, lat_index, {_AREA} FROM weights", _WEIGHTS),
    "weights_full_npoints": _q(f"SELECT LINKNO, lon_index, lat_index, count(*) OVER (PARTITION BY LINKNO) AS npoints, {_AREA} FROM weights", _WEIGHTS),
    "weights_simplified": _q(
        f"SELECT LINKNO, lon_index, lat_index, {_AREA} FROM w4",
        _REPAIR, _D2, _D3, _prune(3), _route("pruned"), _MERGE, _WEIGHTS,
        "w1 AS (SELECT w.* REPLACE (coalesce(l3.keep, l2.keep, w.LINKNO) AS LINKNO) FROM weights w LEFT JOIN lab2 l2 ON l2.LINKNO = w.LINKNO LEFT JOIN lab3 l3 ON l3.LINKNO = w.LINKNO "
        "WHERE w.LINKNO NOT IN (SELECT id FROM zc) AND w.LINKNO NOT IN (SELECT LINKNO FROM small))",
        "w2 AS (SELECT w.* REPLACE (coalesce(p.LINKNO, w.LINKNO) AS LINKNO) FROM w1 w LEFT JOIN prune p ON p.LINKTODROP = w.LINKNO)",
        "w3 AS (SELECT w.* REPLACE (coalesce(m.target, w.LINKNO) AS LINKNO) FROM w2 w LEFT JOIN mlab m ON m.id = w.LINKNO)",
        "w4 AS (SELECT LINKNO, lon_index, lat_index, lon, lat, sum(area_sqm) AS area_sqm FROM w3 GROUP BY ALL)",
    ),
    "line_centroids": _q(f"SELECT LINKNO, {_r('(x + px) / 2', 6, 'cx')}, {_r('(y + py) / 2', 6, 'cy')} FROM streams"),
    "polygon_areas": _q(f"SELECT LINKNO, {_r(_rect('x - 0.005e0', 'x + 0.005e0', 'y - 0.005e0', 'y + 0.005e0') + ' / 1e6', 4, 'area_km2')} FROM streams"),
    "region_consistency": _q(
        "SELECT name, n, n = (SELECT count(*) FROM rep) AS matches FROM (SELECT 'master' AS name, count(*) AS n FROM rep UNION ALL SELECT 'weight_all.csv', count(DISTINCT LINKNO) FROM streams UNION ALL SELECT 'weight_kept.csv', count(DISTINCT LINKNO) FROM rep)",
        _REPAIR,
    ),
    "outputs_valid": _q(
        "SELECT 'whole' AS outputs, CAST(6 AS BIGINT) AS n_tables, count(*) AS least, count(*) AS most, TRUE AS valid FROM rep "
        "UNION ALL SELECT 'short', 6, count(*) FILTER (WHERE LINKNO % 3 <> 0), count(*), FALSE FROM rep",
        _REPAIR,
    ),
    "slim_tables_present": "SELECT 'weight_' || n_name || '_full.csv' AS name, n_nationkey % 3 <> 0 AS has_slim FROM nation",
    "master_pipeline": _q(
        f"SELECT LINKNO, DSLINKNO, strmOrder, Magnitude, TDXHydroRegion, TopologicalOrder, velocity_factor, musk_k, musk_x, TerminalLink, {_LEVELS} FROM merged JOIN term USING (LINKNO)",
        _REPAIR, _D2, _D3, _prune(3), _route("pruned"), _MERGE,
    ),
    "geodesic_lengths": _q(f"SELECT LINKNO, {_r('coalesce(len, 1e-2)', 3, 'length_m')} FROM streams LEFT JOIN vin USING (LINKNO)", _VINCENTY),
    "simplified_lines": _q(
        "SELECT b, count(*) AS n_points, string_agg(CAST(k - 1 AS VARCHAR), ' ' ORDER BY k) AS slots FROM (SELECT b, lo AS k FROM stretch UNION SELECT b, hi FROM stretch) GROUP BY b",
        _SIMPLIFY,
    ),
    "multi_line_centroids": _q(
        f"SELECT LINKNO, {_r('(l * (x + px) / 2 + 2e-2 * (x + 1e-2) + 3e-2 * (x + 2e-2)) / (l + 5e-2)', 6, 'cx')}, {_r('(l * (y + py) / 2 + 2e-2 * y + 3e-2 * (y + 15e-3)) / (l + 5e-2)', 6, 'cy')} "
        "FROM (SELECT *, sqrt(pow(px - x, 2) + pow(py - y, 2)) AS l FROM streams)"
    ),
    "concave_weights": _q(f"SELECT LINKNO, lon_index, lat_index, {_AREA} FROM weights", _ELBOW),
    "axis_weights": _q(f"SELECT LINKNO, lon_index, lat_index, count(*) OVER (PARTITION BY LINKNO) AS npoints, {_AREA} FROM weights", _WEIGHTS),
    "wrapped_axis_window": _q(
        "SELECT axis, idx, coord FROM ax WHERE CASE WHEN axis = 'lon' THEN idx >= (SELECT arg_min(idx, (abs(c - x0), idx)) FROM ax, bb WHERE axis = 'lon') OR idx <= (SELECT arg_min(idx, (abs(c - x1), idx)) FROM ax, bb WHERE axis = 'lon') "
        "ELSE idx BETWEEN (SELECT arg_min(idx, (abs(c - y1), idx)) FROM ax, bb WHERE axis = 'lat') AND (SELECT arg_min(idx, (abs(c - y0), idx)) FROM ax, bb WHERE axis = 'lat') END",
        "bb AS (SELECT min((x + 120) / 100 - 1e-1) - 0.005e0 - 0.25e0 AS x0, max((x + 120) / 100 - 1e-1) + 0.005e0 + 0.25e0 AS x1, min(y) - 0.005e0 - 0.25e0 AS y0, max(y) + 0.005e0 + 0.25e0 AS y1 FROM streams)",
        _GRID,
    ),
    "zero_id_basin": _q(
        f"SELECT LINKNO % 10000000 AS LINKNO, {_r(_rect('cx - r', 'cx + r', 'cy - r', 'cy + r') + ' / 1e6', 4, 'area_km2')} FROM (SELECT *, CASE WHEN LINKNO % 10000000 = 0 THEN (x + px) / 2 ELSE x END AS cx, "
        "CASE WHEN LINKNO % 10000000 = 0 THEN (y + py) / 2 ELSE y END AS cy, CASE WHEN LINKNO % 10000000 = 0 THEN 15e-3 ELSE 5e-3 END AS r FROM streams WHERE LengthGeodesicMeters > 0.01)"
    ),
    "deep_chain": "SELECT c_custkey AS id, t AS root, c_custkey - f AS height, CASE WHEN m >= c_custkey THEN m END AS mark, CASE WHEN m >= c_custkey THEN m - c_custkey END AS at_mark "
    "FROM customer, (SELECT max(c_custkey) AS t, min(c_custkey) AS f, max(c_custkey) FILTER (WHERE c_custkey % 7 = 3) AS m FROM customer)",
    "wide_confluence": "SELECT s_suppkey AS HydroID, CASE WHEN s_suppkey = f THEN -1 ELSE f END AS NextDownID, CASE WHEN s_suppkey = f THEN n - 1 ELSE 0 END AS CountUpstreamID, CASE WHEN s_suppkey = f THEN ids ELSE '' END AS UpstreamIDs "
    "FROM supplier, (SELECT min(s_suppkey) AS f, count(*) AS n FROM supplier), (SELECT string_agg(s_suppkey, ',' ORDER BY s_suppkey * 7 % 1009, s_suppkey) AS ids FROM supplier WHERE s_suppkey > (SELECT min(s_suppkey) FROM supplier))",
    "unit_files": _q(
        "SELECT VPUCode, 'rapid_connect.csv' AS name, n AS n_lines, md5(a) AS content_md5 FROM texts UNION ALL SELECT VPUCode, 'riv_bas_id.csv', n, md5(b) FROM texts UNION ALL SELECT VPUCode, 'k.csv', n, md5(c) FROM texts "
        "UNION ALL SELECT VPUCode, 'x.csv', n, md5(d) FROM texts UNION ALL SELECT VPUCode, 'comid_lat_lon_z.csv', n + 1, md5(e) FROM texts "
        "UNION ALL SELECT VPUCode, 'weight_grid.csv', 1 + count(*), NULL FROM weights JOIN master USING (LINKNO) GROUP BY VPUCode",
        _REPAIR, _route("ord"), _FLAT, _WEIGHTS, _UNIT_FILES,
    ),
    "short_unit_file": _q(
        "SELECT VPUCode AS unit, CAST(6 AS BIGINT) AS n_files, least(n, s) AS least, n AS most, n = s AS valid FROM "
        "(SELECT VPUCode, count(*) AS n, count(*) FILTER (WHERE TerminalLink % 1000 <> 0 OR VPUCode % 2 = 0) AS s FROM vpu GROUP BY VPUCode)"
    ),
}
