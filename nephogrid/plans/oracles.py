"""SQL for another engine that states each query of the catalogue on the same tables. Decimals are written as doubles, so both engines divide alike."""

from __future__ import annotations

_A = """
dims AS (SELECT count(*) // 100 AS h, 100 AS w FROM events),
a AS (SELECT event_id // 100 AS r, event_id % 100 AS c, 300e0 - value AS bt,
        CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 END AS phase,
        90e0 - (event_id // 100) * 180e0 / (h - 1) AS lat FROM events, dims),
dens AS (SELECT *, CASE WHEN bt IS NULL OR coalesce(phase, 0) < 1 THEN 0
        ELSE CAST(floor(least(greatest((285e0 - bt) / 85e0, 0e0), 1e0) * 255) AS BIGINT) END AS d0 FROM a),
g AS (SELECT r, c, lat, CASE WHEN d0 > 0 THEN CAST(floor(255e0 * power(d0 / 255e0, 0.45e0)) AS BIGINT) ELSE 0 END AS d FROM dens)"""

_B_RAW = """
odims AS (SELECT count(*) // 100 AS oh FROM orders),
braw AS (SELECT o_orderkey // 100 AS r, o_orderkey % 100 AS c, CAST(floor(o_totalprice) AS BIGINT) % 256 AS s,
        90e0 - (o_orderkey // 100) * 180e0 / (oh - 1) AS lat FROM orders, odims)"""
_B_FLOOR = """,
b AS (SELECT r, c, lat, CASE WHEN abs(lat) < 60 THEN 0 ELSE s END AS s FROM braw),
bg AS (SELECT coalesce(CAST(floor(quantile_cont(s, 0.05) FILTER (WHERE s > 0)) AS BIGINT), 0) AS bg FROM b),
bs AS (SELECT r, c, lat, greatest(s - bg, 0) AS s FROM b, bg)"""
_B = _B_RAW + _B_FLOOR
#: All orders on the primary raster's grid.
_B_GRID = (
    """
bput AS (SELECT o_orderkey % (h * 100) AS k, CAST(floor(o_totalprice) AS BIGINT) % 256 AS s, h FROM orders, dims),
braw AS (SELECT k // 100 AS r, k % 100 AS c, max(s) AS s, 90e0 - (k // 100) * 180e0 / (any_value(h) - 1) AS lat FROM bput GROUP BY k)"""
    + _B_FLOOR
)

_LUT = """
ov AS (SELECT g.d, bs.s FROM g JOIN bs USING (r, c) WHERE abs(g.lat) BETWEEN 55 AND 65 AND g.d > 0 AND bs.s > 0),
ks AS (SELECT CAST(range AS BIGINT) AS k FROM range(256)),
hs AS (SELECT k, (SELECT count(*) FROM ov WHERE s = k) AS n, (SELECT count(*) FROM ov WHERE d = k) AS m FROM ks),
cs AS (SELECT k, CASE WHEN sum(n) OVER () = 0 THEN 0 ELSE CAST(CAST(CAST(sum(n) OVER (ORDER BY k) AS FLOAT) AS DOUBLE) / CAST(CAST(sum(n) OVER () AS FLOAT) AS DOUBLE) AS FLOAT) END AS sc,
        CASE WHEN sum(m) OVER () = 0 THEN 0 ELSE CAST(CAST(CAST(sum(m) OVER (ORDER BY k) AS FLOAT) AS DOUBLE) / CAST(CAST(sum(m) OVER () AS FLOAT) AS DOUBLE) AS FLOAT) END AS dc FROM hs),
lut AS (SELECT x.k AS src, CASE WHEN (SELECT count(*) FROM ov) > 100 THEN arg_min(y.k, {'d': abs(CAST(y.dc AS DOUBLE) - CAST(x.sc AS DOUBLE)), 'k': y.k}) ELSE x.k END AS dst
        FROM cs x, cs y GROUP BY x.k)"""

_FILL = """
fl AS (SELECT g.r, g.c, g.lat, g.d, g.d = 0 AND abs(g.lat) > 60 AS gap, coalesce(lut.dst, 0) AS s FROM g LEFT JOIN bs USING (r, c) LEFT JOIN lut ON lut.src = bs.s)"""

_FEATHER = """
filled AS MATERIALIZED (SELECT r, c, CASE WHEN NOT gap THEN d WHEN abs(lat) BETWEEN 60 AND 62 THEN CAST(floor(d * (1e0 - w) + s * w) AS BIGINT) ELSE s END AS d
        FROM (SELECT *, (1e0 - cos((abs(lat) - 60e0) / 2e0 * pi())) / 2e0 AS w FROM fl))"""

_C = """
cp AS MATERIALIZED (SELECT CAST(vec_id AS BIGINT) AS r, CAST(c AS BIGINT) AS c, CAST(floor(least(greatest((CAST(embedding[c + 1] AS DOUBLE) + 0.5e0) * 255e0, 0e0), 255e0)) AS BIGINT) AS v
        FROM embeddings, range(64) t(c))"""

_L = """
li AS (SELECT 'product/' || strftime(hour, '%Y/%m/%d/%H') || '/file' || CASE WHEN k % 3 = 0 THEN '_full_' ELSE '_blend_' END || k
        || CASE WHEN k % 5 = 0 THEN '' ELSE '_s' || strftime(hour, '%Y%m%d%H') || '0000' END || CASE WHEN k % 7 = 0 THEN '.tmp' ELSE '.nc' END AS key,
        CAST(floor(o_totalprice) AS BIGINT) AS size, hour + INTERVAL 7 MINUTE AS modified, hour, k
        FROM (SELECT o_orderkey AS k, o_totalprice, date_trunc('day', CAST(o_orderdate AS TIMESTAMP)) + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS hour FROM orders))"""

_P = """
p AS (SELECT event_id AS seq, (user_id * 37 + event_id * 13) % 18000 / 100e0 - 90e0 AS lat, (user_id * 91 + event_id * 29) % 36000 / 100e0 - 180e0 AS lng FROM events)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _stretch(least: int) -> str:
    return (
        _with(_A)
        + f""", t AS (SELECT r, c, CASE WHEN d < {least} THEN 0 ELSE d END AS d FROM g),
m AS (SELECT count(*) AS n, min(d) AS low, max(d) AS high FROM t WHERE d > 0)
SELECT r, c, CASE WHEN n > 1 AND high > low THEN CAST(floor(least(greatest((d - low) / CAST(high - low AS DOUBLE), 0e0), 1e0) * 255) AS BIGINT) ELSE d END AS d FROM t, m"""
    )


def _bilinear(points: str, keys: str, source: str, w: str, h: str) -> str:
    """Samples ``source`` (r, c, v) at ``points`` (keys, ix, iy); its rows are made lists once and joined twice."""
    return f"""
ls AS MATERIALIZED (SELECT r, list(v ORDER BY c) AS line FROM {source} GROUP BY r),
q AS (SELECT *, floor(ix) AS fx0, floor(iy) AS fy0 FROM {points}),
n4 AS MATERIALIZED (SELECT *, ((CAST(fx0 AS BIGINT) % {w}) + {w}) % {w} AS x0, ((CAST(fx0 AS BIGINT) + 1) % {w} + {w}) % {w} AS x1,
        greatest(0, least(CAST(fy0 AS BIGINT), {h} - 1)) AS y0, greatest(0, least(CAST(fy0 AS BIGINT) + 1, {h} - 1)) AS y1, ix - fx0 AS ax, iy - fy0 AS ay FROM q),
v4 AS (SELECT n4.*, a.line[x0 + 1] AS v00, a.line[x1 + 1] AS v10, b.line[x0 + 1] AS v01, b.line[x1 + 1] AS v11 FROM n4 JOIN ls a ON a.r = y0 JOIN ls b ON b.r = y1),
sm AS (SELECT {keys}, greatest(0, least(255, CAST(round_even(v00 * (1 - ax) * (1 - ay) + v10 * ax * (1 - ay) + v01 * (1 - ax) * ay + v11 * ax * ay, 0) AS BIGINT))) AS v FROM v4)"""


def _cube() -> str:
    """Faces of half the raster's height."""
    cases = {"px": ("1e0", "-v", "-u"), "nx": ("-1e0", "-v", "u"), "py": ("u", "1e0", "v"), "ny": ("u", "-1e0", "-v"), "pz": ("u", "-v", "1e0"), "nz": ("-u", "-v", "-1e0")}
    parts = " UNION ALL ".join(f"SELECT '{f}' AS face, fy, fx, {x} AS x, {y} AS y, {z} AS z, u, v FROM uv" for f, (x, y, z) in cases.items())
    return f"""
uv AS (SELECT CAST(i // z AS BIGINT) AS fy, CAST(i % z AS BIGINT) AS fx, (i % z) * 2e0 / z - 1e0 AS u, (i // z) * 2e0 / z - 1e0 AS v FROM (SELECT h // 2 AS z, unnest(range((h // 2) * (h // 2))) AS i FROM dims)),
dr AS (SELECT face, fy, fx, x / l AS x, y / l AS y, z / l AS z FROM (SELECT *, sqrt(u * u + v * v + 1e0) AS l FROM ({parts}))),
spots AS (SELECT face, fy, fx, (CASE WHEN x = 0 AND y = 0 AND face = 'nz' THEN -pi() ELSE atan2(y, x) END / (2 * pi()) + 0.5e0) * w AS x0,
        greatest(0e0, least((0.5e0 - asin(greatest(-1e0, least(1e0, z))) / pi()) * h, h - 1e0)) AS iy, w, h FROM dr, dims)"""


def _lanczos(n_in: str, n_out: str, name: str) -> str:
    """Weights (o, i, w) of a resize along one axis, in 2^-22ths."""
    return f"""
{name}s AS (SELECT CAST({n_in} AS BIGINT) AS n, CAST({n_out} AS BIGINT) AS m),
{name}m AS (SELECT o, (o + 0.5e0) * (n / CAST(m AS DOUBLE)) AS mid, greatest(1e0, n / CAST(m AS DOUBLE)) AS sc, n FROM (SELECT unnest(range(m)) AS o, n, m FROM {name}s)),
{name}k AS (SELECT o, i, (i - mid + 0.5e0) / sc AS x FROM (SELECT *, unnest(range(greatest(0, CAST(floor(mid - 3 * sc + 0.5e0) AS BIGINT)), least(n, CAST(floor(mid + 3 * sc + 0.5e0) AS BIGINT)))) AS i FROM {name}m)),
{name}w AS (SELECT o, i, CASE WHEN x = 0 THEN 1e0 WHEN abs(x) < 3 THEN 3e0 * sin(x * pi()) * sin(x * pi() / 3) / (x * pi() * x * pi()) ELSE 0e0 END AS w FROM {name}k),
{name} AS (SELECT o, i, CASE WHEN w < 0 THEN -CAST(floor(0.5e0 - w) AS BIGINT) ELSE CAST(floor(w + 0.5e0) AS BIGINT) END AS w FROM (SELECT o, i, w / sum(w) OVER (PARTITION BY o) * 4194304 AS w FROM {name}w))"""


def _resized(source: str, table: str, along: str, across: str, out: str) -> str:
    """``source`` (r, c, v) resized along one axis."""
    return f"{out} AS (SELECT {table}.o AS {along}, {across}, least(255, greatest(0, CAST(sum(v * w) AS BIGINT) + 2097152) // 4194304) AS v FROM {source} JOIN {table} ON {table}.i = {source}.{along} GROUP BY {table}.o, {across})"


_POLAR_ROWS = """
rw AS (SELECT h, CAST(round_even((90e0 - 89.9e0) / 180e0 * h, 0) AS BIGINT) AS t, CAST(round_even((90e0 - 85e0) / 180e0 * h, 0) AS BIGINT) AS m, CAST(round_even((90e0 - 60e0) / 180e0 * h, 0) AS BIGINT) AS p,
 CAST(round_even((90e0 + 89.9e0) / 180e0 * h, 0) AS BIGINT) AS st, CAST(round_even((90e0 + 85e0) / 180e0 * h, 0) AS BIGINT) AS sm, CAST(round_even((90e0 + 60e0) / 180e0 * h, 0) AS BIGINT) AS sp FROM dims)"""


def _polar_bands(sources: dict[str, tuple[str, str]]) -> str:
    """``pieces`` (r, c, v, o) of the four bands, given their sources (r, c, v) and those sources' heights."""
    rows = {"cn": ("t", "m - t"), "bn": ("m", "p - m"), "cs": ("h - (st - sm)", "st - sm"), "bs4": ("sp", "sm - sp")}
    parts, union = [], []
    for i, (k, (first, n)) in enumerate(rows.items()):
        source, height = sources[k]
        parts += [_lanczos(height, f"(SELECT {n} FROM rw)", f"w{k}"), _resized(source, f"w{k}", "r", "c", f"p{k}")]
        union.append(f"SELECT r + (SELECT {first} FROM rw) AS r, c, v, {i} AS o FROM p{k}")
    return ",\n".join(parts) + ",\npieces AS (" + " UNION ALL ".join(union) + ")"


_STORED = "bcap AS (SELECT r, c, s AS v FROM braw), binv AS (SELECT r, c, 255 - s AS v FROM braw)"
_OH = "(SELECT oh FROM odims)"


_FACES_OF_FILLED = (
    """, th AS (SELECT r, c, CASE WHEN d < 45 THEN 0 ELSE d END AS d FROM filled),
mm AS (SELECT count(*) AS n, min(d) AS low, max(d) AS high FROM th WHERE d > 0),
sx AS MATERIALIZED (SELECT r, c, CASE WHEN n > 1 AND high > low THEN CAST(floor(least(greatest((d - low) / CAST(high - low AS DOUBLE), 0e0), 1e0) * 255) AS BIGINT) ELSE d END AS d FROM th, mm),
src AS (SELECT x.r, x.c, y.d AS v FROM sx x JOIN sx y ON y.r = x.r AND y.c = CASE WHEN x.c < 3 THEN x.c + 3 WHEN x.c >= 97 THEN x.c - 3 ELSE x.c END),"""
    + _cube()
    + ", pt AS (SELECT face, fy, fx, ((x0 % w) + w) % w AS ix, iy, w, h FROM spots),"
    + _bilinear("pt", "face, fy, fx", "src", "w", "h")
)

ORACLES: dict[str, str] = {
    "density": _with(_A) + " SELECT r, c, d0 AS d FROM dens",
    "density_no_phase": _with(_A) + " SELECT r, c, CASE WHEN bt IS NULL THEN 0 ELSE CAST(floor(least(greatest((285e0 - bt) / 85e0, 0e0), 1e0) * 255) AS BIGINT) END AS d FROM a",
    "density_fill_mask": _with(_A) + " SELECT r, c, CASE WHEN bt IS NULL OR bt <= 201 THEN 0 ELSE CAST(floor(least(greatest((285e0 - bt) / 85e0, 0e0), 1e0) * 255) AS BIGINT) END AS d FROM a",
    "density_prescaled": _with(_A, _B_RAW) + " SELECT r, c, coalesce(CAST(floor(least(greatest(s, 0), 255)) AS BIGINT), 0) AS d FROM braw",
    "gamma": _with(_A) + " SELECT r, c, d FROM g",
    "threshold_stretch": _stretch(45),
    "threshold_stretch_35": _stretch(35),
    "zone_stats": _with(_A)
    + """ SELECT zone, count(*) AS n, round(avg(d), 6) AS mean, round(count(*) FILTER (WHERE d = 0) * 100e0 / count(*), 6) AS zero_percent
FROM (SELECT d0 AS d, CASE WHEN abs(lat) > 0 AND abs(lat) <= 30 THEN 'low' WHEN abs(lat) > 30 AND abs(lat) <= 45 THEN 'mid_low' WHEN abs(lat) > 45 AND abs(lat) <= 60 THEN 'mid'
 WHEN abs(lat) > 60 AND abs(lat) <= 70 THEN 'mid_high' WHEN abs(lat) > 70 AND abs(lat) <= 80 THEN 'high' WHEN abs(lat) > 80 AND abs(lat) <= 90 THEN 'polar' END AS zone FROM dens)
WHERE zone IS NOT NULL GROUP BY zone""",
    "raster_stats": _with(_A)
    + """ SELECT count(*) AS n, count(*) - count(d) AS missing, min(d) AS low, max(d) AS high, round(avg(d), 6) AS mean, round(count(*) FILTER (WHERE d = 0) * 100e0 / greatest(count(d), 1), 6) AS zero_percent,
round(avg(d) FILTER (WHERE d > 0), 6) AS mean_above_zero FROM g""",
    "background_floor": _with(_A, _B) + " SELECT bg FROM bg",
    "background_subtract": _with(_A, _B) + " SELECT r, c, s FROM bs",
    "histogram256": _with(_A, _B) + " SELECT s AS k, count(*) AS n FROM b GROUP BY s",
    "cdf": _with(_A, _B)
    + """, hh AS (SELECT CAST(range AS BIGINT) AS k, (SELECT count(*) FROM b WHERE s = range AND s > 0) AS n FROM range(256))
SELECT k, round(CAST(CAST(CAST(CAST(sum(n) OVER (ORDER BY k) AS FLOAT) AS DOUBLE) / CAST(CAST(sum(n) OVER () AS FLOAT) AS DOUBLE) AS FLOAT) AS DOUBLE), 6) AS cdf FROM hh""",
    "cdf_lut": _with(_A, _B_GRID, _LUT) + " SELECT src, dst FROM lut",
    "lut_apply": _with(_A, _B_GRID, _LUT) + " SELECT bs.r, bs.c, lut.dst AS s FROM bs JOIN lut ON lut.src = bs.s",
    "gap_mask": _with(_A) + " SELECT r, c, d = 0 AND abs(lat) > 60 AS gap FROM g",
    "gap_fill": _with(_A, _B_GRID, _LUT, _FILL) + " SELECT r, c, CASE WHEN gap THEN s ELSE d END AS d FROM fl",
    "gap_fill_feather": _with(_A, _B_GRID, _LUT, _FILL, _FEATHER) + " SELECT r, c, d FROM filled",
    "whole_map": _with(_A, _B_GRID, _LUT, _FILL, _FEATHER)
    + _FACES_OF_FILLED
    + " SELECT face, fy, fx, v FROM sm",
    "edge_fix": _with(_A) + " SELECT x.r, x.c, y.d FROM g x JOIN g y ON y.r = x.r AND y.c = CASE WHEN x.c < 3 THEN x.c + 3 WHEN x.c >= 97 THEN x.c - 3 ELSE x.c END",
    "pad_to_global": _with(_A)
    + """, part AS (SELECT r - (SELECT min(r) FROM g WHERE abs(lat) <= 60) AS r, c, lat, d FROM g WHERE abs(lat) <= 60),
sh AS (SELECT max(lat) AS top, CAST(round_even((max(r) + 1) * 180e0 / (max(lat) - min(lat)), 0) AS BIGINT) AS hh FROM part),
grid AS (SELECT i // 104 AS r, i % 104 AS c FROM (SELECT unnest(range(CAST(hh AS BIGINT) * 104)) AS i FROM sh))
SELECT CAST(grid.r AS BIGINT) AS r, CAST(grid.c AS BIGINT) AS c, coalesce(part.d, 0) AS d FROM grid CROSS JOIN sh LEFT JOIN part ON part.r + CAST(round_even((90e0 - top) / 180e0 * hh, 0) AS BIGINT) = grid.r AND part.c = grid.c""",
    "mosaic": _with(_C) + " SELECT (r // 16) * 16 + r % 16 AS r, (c // 16) * 16 + c % 16 AS c, v FROM cp",
    "band_composite": _with(_A, _B_RAW, _POLAR_ROWS, _STORED, _polar_bands({"cn": ("bcap", _OH), "bn": ("binv", _OH), "cs": ("binv", _OH), "bs4": ("bcap", _OH)})) + " SELECT r, c, arg_max(v, o) AS v FROM pieces GROUP BY r, c",
    "polar_build": _with(_A, _B_RAW, _C, _POLAR_ROWS, _STORED)
    + """, md AS (SELECT count(*) AS mh FROM embeddings), bh AS (SELECT greatest(1, CAST(round_even(25e0 / 180 * 100 * 0.5e0, 0) AS BIGINT)) AS bh),
ll AS (SELECT band, CAST(i // 100 AS BIGINT) AS r, CAST(i % 100 AS BIGINT) AS c, top - (i // 100 + 0.5e0) / bh * 25e0 AS lat, -180e0 + (i % 100 + 0.5e0) / 100 * 360e0 AS lon
        FROM (SELECT bh, unnest(range(bh * 100)) AS i FROM bh), (VALUES ('n', 85e0), ('s', -60e0)) b(band, top)),
pt AS (SELECT band, r AS orow, c AS ocol, (lon + 180e0) / 360e0 * 64 AS ix, (1e0 - ln(tan(pi() / 4 + radians(lat) / 2)) / pi()) / 2 * mh AS iy, mh FROM ll, md),
ins AS (SELECT * FROM pt WHERE iy >= 1 AND iy < mh - 2),"""
    + _bilinear("ins", "band, orow, ocol", "cp", "64", "mh")
    + """, eq AS MATERIALIZED (SELECT band, orow AS r, ocol AS c, v FROM sm UNION ALL SELECT band, orow, ocol, 0 FROM pt WHERE NOT (iy >= 1 AND iy < mh - 2)),
eqn AS (SELECT r, c, v FROM eq WHERE band = 'n'), eqs AS (SELECT r, c, v FROM eq WHERE band = 's'),"""
    + _polar_bands({"cn": ("bcap", _OH), "bn": ("eqn", "(SELECT bh FROM bh)"), "cs": ("binv", _OH), "bs4": ("eqs", "(SELECT bh FROM bh)")})
    + " SELECT r, c, arg_max(v, o) AS s FROM pieces GROUP BY r, c",
    "source_load": _with(_A, " gv AS (SELECT r, c, d AS v FROM g)", _lanczos("100", "50", "wc"), _lanczos("(SELECT h FROM dims)", "(SELECT h // 2 FROM dims)", "wr"), _resized("gv", "wc", "c", "r", "p1"), _resized("p1", "wr", "r", "c", "p2"))
    + """ SELECT (SELECT strftime(max(slot), '%Y%m%d_%H%M%S') FROM (SELECT date_trunc('hour', CAST(ts AS TIMESTAMP)) AS slot FROM events WHERE event_type = 'purchase'), (SELECT date_trunc('hour', CAST(max(ts) AS TIMESTAMP)) - INTERVAL 30 HOUR AS n FROM events)
 WHERE slot BETWEEN n - INTERVAL 96 HOUR AND n) AS stamp, r, c, round(90e0 - r * 180e0 / ((SELECT h // 2 FROM dims) - 1), 6) AS lat, v AS d FROM p2""",
    "second_source": """SELECT DISTINCT event_type, strftime(date_trunc('hour', CAST(ts AS TIMESTAMP)), '%Y%m%d_%H%M%S') AS stamp,
CASE event_type WHEN 'view' THEN 'LIR' WHEN 'click' THEN 'data' ELSE 'y' END AS variable, hour(CAST(ts AS TIMESTAMP)) % 2 = 0 AS is_scaled FROM events""",
    "storm_job": _with(_P)
    + """, f AS (SELECT seq, CAST(CAST(lat AS FLOAT) AS DOUBLE) AS lat, CAST(CAST(lng AS FLOAT) AS DOUBLE) AS lng FROM p),
u AS (SELECT seq, round_even(lat, 4) AS lat, round_even(lng, 4) AS lng FROM (SELECT *, row_number() OVER (PARTITION BY floor(lat), floor(lng) ORDER BY seq) AS n FROM f) WHERE n = 1),
k AS (SELECT * FROM u ORDER BY seq % 500 * 7919 % 503, seq LIMIT 2000)
SELECT '[' || string_agg('{"lat":' || lat || ',"lng":' || lng || '}', ',' ORDER BY seq) || ']' AS points FROM k""",
    "storm_decode": _with(_P) + """ SELECT format('payload-{:012d}/{:02d}', seq // 3, n) AS path, CAST(seq % 3 AS BIGINT) AS seq, CAST(CAST(lat AS FLOAT) AS DOUBLE) AS lat, CAST(CAST(lng AS FLOAT) AS DOUBLE) AS lng
FROM (SELECT *, count(*) OVER (PARTITION BY seq // 3) AS m FROM p), range(37) t(n) WHERE n <= 12 * m AND seq % 3 < n // 12""",
    "mercator_reproject": _with(_C)
    + """, md AS (SELECT count(*) AS mh, greatest(1, CAST(round_even(25e0 / 180 * count(*) * 0.5e0, 0) AS BIGINT)) AS bh FROM embeddings),
ll AS (SELECT CAST(i // mh AS BIGINT) AS r, CAST(i % mh AS BIGINT) AS c, 85e0 - (i // mh + 0.5e0) / bh * 25e0 AS lat, -180e0 + (i % mh + 0.5e0) / mh * 360e0 AS lon FROM (SELECT mh, bh, unnest(range(bh * mh)) AS i FROM md)),
pt AS (SELECT r AS orow, c AS ocol, (lon + 180e0) / 360e0 * 64 AS ix, (1e0 - ln(tan(pi() / 4 + radians(lat) / 2)) / pi()) / 2 * mh AS iy, mh FROM ll, md),
ins AS (SELECT * FROM pt WHERE iy >= 1 AND iy < mh - 2),"""
    + _bilinear("ins", "orow, ocol", "cp", "64", "mh")
    + " SELECT orow AS r, ocol AS c, v FROM sm UNION ALL SELECT orow, ocol, 0 FROM pt WHERE NOT (iy >= 1 AND iy < mh - 2)",
    "bilinear_sample": _with(_C)
    + """, md AS (SELECT count(*) AS mh FROM embeddings),
pt AS (SELECT event_id AS id, (event_id * 7 % 6400) / 100e0 AS ix, (event_id * 13 % (mh * 100)) / 100e0 AS iy, mh FROM events, md),"""
    + _bilinear("pt", "id", "cp", "64", "mh")
    + " SELECT id, v FROM sm",
    "cubemap_coords": _with(_A, _cube()) + " SELECT face, fy, fx, round(((round(x0, 6) % w) + w) % w, 6) AS ix, round(iy, 6) AS iy FROM spots",
    "cubemap": _with(_A, _cube()) + ", pt AS (SELECT face, fy, fx, ((x0 % w) + w) % w AS ix, iy, w, h FROM spots), src AS (SELECT r, c, d AS v FROM g)," + _bilinear("pt", "face, fy, fx", "src", "w", "h") + " SELECT face, fy, fx, v FROM sm",
    "lanczos_downsample": _with(_C, " md AS (SELECT count(*) AS mh FROM embeddings)", _lanczos("64", "25", "wc"), _lanczos("(SELECT mh FROM md)", "(SELECT mh // 2 FROM md)", "wr"), _resized("cp", "wc", "c", "r", "p1"), _resized("p1", "wr", "r", "c", "p2"))
    + " SELECT r, c, v FROM p2",
    "storm_dedup": _with(_P) + " SELECT seq, round_even(lat, 4) AS lat, round_even(lng, 4) AS lng FROM (SELECT *, row_number() OVER (PARTITION BY floor(lat), floor(lng) ORDER BY seq) AS n FROM p) WHERE n = 1",
    "storm_cap": _with(_P) + " SELECT seq, lat, lng FROM p ORDER BY seq * 7919 % 10007, seq LIMIT 2000",
    "latest_slot": """WITH t AS (SELECT CAST(max(ts) AS TIMESTAMP) AS m FROM events), now AS (SELECT date_trunc('hour', m) - INTERVAL 30 HOUR AS n FROM t)
SELECT strftime(slot, '%Y%m%d_%H%M%S') AS stamp, 'archive/' || strftime(slot, '%Y/%m/%d') || '/composite.' || strftime(slot, '%Y') || lpad(CAST(dayofyear(slot) AS VARCHAR), 3, '0') || '.' || strftime(slot, '%H') || '00.3km.nc' AS path
FROM (SELECT date_trunc('hour', CAST(ts AS TIMESTAMP)) AS slot FROM events WHERE event_type = 'purchase'), now WHERE slot BETWEEN n - INTERVAL 96 HOUR AND n ORDER BY slot DESC LIMIT 1""",
    "latest_largest": _with(_L)
    + """, now AS (SELECT max(hour) + INTERVAL 5 HOUR AS n FROM li)
SELECT strftime(CASE WHEN regexp_matches(key, '_s[0-9]{14}') THEN strptime(regexp_extract(key, '_s([0-9]{14})', 1), '%Y%m%d%H%M%S') ELSE modified END, '%Y-%m-%d %H:%M:%S') AS stamp, key, size FROM li, now
WHERE key LIKE '%.nc' AND contains(key, '_blend_') AND hour BETWEEN date_trunc('day', n) - INTERVAL 14 DAY AND greatest(date_trunc('day', n), date_trunc('hour', n) - INTERVAL 3 HOUR)
ORDER BY hour DESC, size DESC, key LIMIT 1""",
    "scalar_formats": _with(_L)
    + """ SELECT key, CASE WHEN regexp_matches(key, '_s[0-9]{14}') THEN strftime(strptime(regexp_extract(key, '_s([0-9]{14})', 1), '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') END AS key_stamp,
strftime(hour, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(hour, '%Y%m%d_%H%M%S') AS compact, 'product/' || strftime(hour, '%Y/%m/%d/%H') || '/' AS prefix,
'https://maps.example.org/api?products=ir&z=2&x=' || (k % 4) || '&y=' || (k // 4 % 4) || '&width=256&height=256' || CASE WHEN k % 2 = 0 THEN '&time=' || strftime(hour, '%Y-%m-%dT%H:%M:%SZ') ELSE '' END AS tile,
'https://maps.example.org/wms?map=ir&BBOX=-180,' || (60 + k % 10) || ',180,85&WIDTH=1024&HEIGHT=' || greatest(1, CAST(round_even(1024 * (85 - (60 + k % 10)) / 360e0, 0) AS BIGINT)) AS box FROM li""",
    "grid_axes": """SELECT 'lat' AS axis, CAST(i AS BIGINT) AS i, round(90e0 + i * -180e0 / (n - 1), 6) AS value FROM (SELECT count(*) // 100 AS n FROM events), range(n) t(i)
UNION ALL SELECT 'lon', CAST(i AS BIGINT), round(-180e0 + i * 360e0 / (n - 1), 6) FROM (SELECT count(*) // 100 AS n FROM orders), range(n) t(i)""",
    "manifest": """SELECT k, '{"baseUrl":"' || CASE k % 3 WHEN 0 THEN 'https://host' || k || '.example.org/x/tiles/' WHEN 1 THEN 'https://owner-' || c || '.github.io/Site' || k || '/tiles/' ELSE 'https://owner.github.io/tiles-site/tiles/' END
    || '","timestamp":"' || day || '_000000"}' AS manifest FROM (SELECT o_orderkey AS k, o_custkey AS c, strftime(CAST(o_orderdate AS TIMESTAMP), '%Y%m%d') AS day FROM orders)""",
    "gridded_window": _with(_C) + " SELECT r, c, round(90e0 - 180e0 * r / (SELECT count(*) FROM embeddings), 6) AS lat, v FROM cp WHERE r >= 64 AND c >= 10 AND c < 40",
    "match_wide": "WITH ks AS (SELECT CAST(range AS BIGINT) AS k FROM range(65536)), "
    + ", ".join(
        f"h{t[0]} AS (SELECT CAST(floor({c}) AS BIGINT) % 65536 AS k, count(*) AS n FROM {t} GROUP BY 1), c{t[0]} AS (SELECT k, CAST(CAST(CAST(sum(coalesce(n, 0)) OVER (ORDER BY k) AS FLOAT) AS DOUBLE) / CAST(CAST(sum(coalesce(n, 0)) OVER () AS FLOAT) AS DOUBLE) AS FLOAT) AS cdf FROM ks LEFT JOIN h{t[0]} USING (k))"
        for t, c in (("orders", "o_totalprice"), ("lineitem", "l_extendedprice"))
    )
    + """, lv AS (SELECT cdf, min(k) AS dst FROM cl GROUP BY cdf), b AS (SELECT co.k AS src, co.cdf, lv.cdf AS low, lv.dst AS below FROM co ASOF LEFT JOIN lv ON co.cdf >= lv.cdf),
m AS (SELECT b.*, lv.cdf AS high, lv.dst AS above FROM b ASOF LEFT JOIN lv ON b.cdf <= lv.cdf)
SELECT src, CASE WHEN below IS NULL THEN above WHEN above IS NULL OR abs(CAST(low AS DOUBLE) - CAST(cdf AS DOUBLE)) <= abs(CAST(high AS DOUBLE) - CAST(cdf AS DOUBLE)) THEN below ELSE above END AS dst FROM m""",
    "listed_files": """WITH e AS (SELECT date_trunc('hour', CAST(ts AS TIMESTAMP)) AS hour, event_type, count(*) AS size FROM events GROUP BY 1, 2), t AS (SELECT date_trunc('day', CAST(max(ts) AS TIMESTAMP)) AS top FROM events)
SELECT strftime(hour, '%Y/%m/%d/%H') || '/' || event_type || CASE event_type WHEN 'view' THEN '_full_' ELSE '_blend_' END || strftime(hour, 's%Y%m%d%H%M%S') || CASE event_type WHEN 'error' THEN '.tmp' ELSE '.nc' END AS key, size,
    strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour FROM e, t WHERE hour BETWEEN top - INTERVAL 3 DAY AND top - INTERVAL 1 HOUR""",
    "newest_file": """WITH e AS (SELECT date_trunc('hour', CAST(ts AS TIMESTAMP)) AS hour, event_type, count(*) AS size FROM events GROUP BY 1, 2), t AS (SELECT CAST(max(ts) AS TIMESTAMP) + INTERVAL 5 HOUR AS now FROM events)
SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(hour, '%Y/%m/%d/%H') || '/' || event_type || '_blend_' || strftime(hour, 's%Y%m%d%H%M%S') || '.nc' AS key, size
FROM e, t WHERE event_type NOT IN ('view', 'error') AND hour BETWEEN date_trunc('day', now) - INTERVAL 14 DAY AND greatest(date_trunc('day', now), date_trunc('hour', now) - INTERVAL 3 HOUR) ORDER BY e.hour DESC, size DESC, key LIMIT 1""",
    "band_stats": _with(_A) + """, b AS (SELECT s_suppkey AS zone, s_suppkey * 7 % 83 AS low, s_suppkey * 7 % 83 + s_suppkey % 16 AS high FROM supplier)
SELECT zone, count(*) AS n, round(avg(d), 6) AS mean, round(count(*) FILTER (d = 0) * 100e0 / count(*), 6) AS zero_percent FROM g JOIN b ON abs(lat) > low AND abs(lat) <= high GROUP BY zone""",
    "storm_cuts": _with(_P) + """, m AS (SELECT seq // 3 AS k, count(*) AS m FROM p GROUP BY 1)
SELECT format('payload-{:012d}', k) AS path, n, CASE WHEN n < 0 THEN m ELSE n // 12 END AS points, CASE WHEN n < 0 THEN 'foreign field' WHEN n % 12 = 0 THEN 'end' ELSE 'truncated' END AS why FROM m, range(-1, 37) t(n) WHERE n <= 12 * m""",
    "published_strips": _with(_A) + """ SELECT format('strip-{:06d}.png', r // 16) AS name, 1600 AS n, CAST(sum(d) AS BIGINT) AS total, CAST(sum(d * (r % 16 * 100 + c)) AS BIGINT) AS moment FROM g GROUP BY r // 16""",
    "png_tiles": _with(_C) + ", n AS (SELECT (count(*) + 15) // 16 * 16 AS h FROM embeddings), px AS (SELECT r, c FROM n, range(h) a(r), range(64) b(c)) SELECT r, c, coalesce(v, 0) AS v FROM px LEFT JOIN cp USING (r, c)",
    "png_luminance": _with(_C) + """, n AS (SELECT (count(*) + 49) // 50 * 50 AS h FROM embeddings), px AS (SELECT r, c FROM n, range(h) a(r), range(64) b(c))
SELECT r, c, coalesce((v * 19595 + (255 - v) * 38470 + v * 7 % 256 * 7471 + 32768) >> 16, 0) AS v FROM px LEFT JOIN cp USING (r, c)""",
}


def _places() -> str:
    from nephogrid.operators.points import DEFAULT_PLACES

    rows = ", ".join(f"({i}, {a}e0, {b}e0)" for i, (a, b) in enumerate(DEFAULT_PLACES))
    return f"SELECT CAST(seq AS BIGINT) AS seq, lat, lng FROM (VALUES {rows}) t(seq, lat, lng)"


ORACLES["storm_fallback"] = _places()

# The whole job is the polar auxiliary in place of the secondary raster.
ORACLES["map_job"] = (
    _with(_A, f" pb AS ({ORACLES['polar_build']})", " bg AS (SELECT coalesce(CAST(floor(quantile_cont(s, 0.05) FILTER (WHERE s > 0)) AS BIGINT), 0) AS bg FROM pb), bs AS (SELECT r, c, greatest(s - bg, 0) AS s FROM pb, bg)", _LUT, _FILL, _FEATHER)
    + _FACES_OF_FILLED
    + " SELECT face, fy, fx, v, (SELECT stamp FROM (" + ORACLES["latest_slot"] + ")) AS stamp, 'https://some-owner.github.io/Site/tiles/' AS base_url, 6 AS files FROM sm"
)
ORACLES["second_load"] = (
    ORACLES["pad_to_global"]
    .replace(" lat, d FROM g", " lat, CASE WHEN bt IS NULL OR bt <= 201e0 THEN 0 ELSE CAST(floor(least(greatest((285e0 - bt) / 85e0, 0e0), 1e0) * 255) AS BIGINT) END AS d FROM a")
    .replace("coalesce(part.d, 0) AS d FROM", "coalesce(part.d, 0) AS d, '20240131_120000' AS stamp FROM")
)
