"""DuckDB SQL for the queries of this package, written independently of the operators: range joins where they use exploded keys,
window functions where they aggregate, recursion where they iterate."""

from __future__ import annotations

from .settings import FIXTURE, LEGEND, MERC, WORLD, Grid

G = Grid()


def sql_text(v: str | None) -> str:
    return "NULL" if v is None else f"'{v}'"


LEGEND_SQL = "legend(idx, codes, layer, kind, max_zoom, colour) AS (VALUES " + ", ".join(f"({i}, {list(c)}, {sql_text(layer)}, {sql_text(kind)}, {z}, {sql_text(col)})" for i, c, layer, kind, z, col in LEGEND) + ")"
ZOOMS = "zooms AS (SELECT CAST(z AS INTEGER) AS z FROM range(11) t(z))"
BLOCKS = f"""{ZOOMS},
blocks AS (
  SELECT z, CAST(x AS INTEGER) AS bx, CAST(y AS INTEGER) AS by_ FROM (SELECT z, CAST(ceil(2 ** z / {G.block_tiles}) AS BIGINT) AS n FROM zooms) s,
  unnest(range(n)) a(x), unnest(range(n)) b(y))"""
SPANS = f"""spans AS (SELECT *, {WORLD!r} / 2 ** z AS span, bx * {G.block_tiles} AS x0, by_ * {G.block_tiles} AS y0, least(bx * {G.block_tiles} + {G.block_tiles}, 2 ** z) AS x1, least(by_ * {G.block_tiles} + {G.block_tiles}, 2 ** z) AS y1 FROM blocks),
inner_box AS (SELECT z, bx, by_, span / {G.tile_px} AS px, x0 * span - {MERC!r} AS minx, x1 * span - {MERC!r} AS maxx, {MERC!r} - y1 * span AS miny, {MERC!r} - y0 * span AS maxy FROM spans),
boxes AS (
  SELECT *, greatest(-{MERC!r}, minx - {G.margin_px} * px) AS win_minx, greatest(-{MERC!r}, miny - {G.margin_px} * px) AS win_miny,
         least({MERC!r}, maxx + {G.margin_px} * px) AS win_maxx, least({MERC!r}, maxy + {G.margin_px} * px) AS win_maxy,
         minx / {MERC!r} * 180 AS west, maxx / {MERC!r} * 180 AS east,
         degrees(atan(sinh(miny / {MERC!r} * pi()))) AS south, degrees(atan(sinh(maxy / {MERC!r} * pi()))) AS north
  FROM inner_box)"""
BOXES = f"{BLOCKS}, {SPANS}"
TABLE_ZOOMS = "zooms AS (SELECT s_suppkey, CAST(z AS INTEGER) AS z FROM supplier, range(11) t(z) WHERE z <= s_suppkey % 11)"
TABLE_BLOCKS = f"""blocks AS (
  SELECT DISTINCT CAST(z AS INTEGER) AS z, CAST(o_custkey % n AS INTEGER) AS bx, CAST(o_orderkey * 7 % n AS INTEGER) AS by_
  FROM (SELECT *, CAST(ceil(2 ** z / {G.block_tiles}) AS BIGINT) AS n FROM (SELECT *, o_orderkey % 11 AS z FROM orders) o) s)"""
TABLE_BOXES = f"{TABLE_BLOCKS}, {SPANS}"
NAMES = """names AS (
  SELECT CASE WHEN s_suppkey % 7 = 0 THEN 'readme' || s_suppkey || '.txt'
    ELSE format('map/tile_{}{:02d}{}{:03d}_v2.tif', CASE WHEN s_suppkey % 2 = 0 THEN 'N' ELSE 'S' END, s_suppkey * 3 % 84, CASE WHEN s_suppkey % 3 = 0 THEN 'W' ELSE 'E' END, s_suppkey * 21 % 180) END AS key
  FROM supplier),
corners AS (
  SELECT key, CAST(CASE WHEN m[1] = 'S' THEN -1 ELSE 1 END * CAST(m[2] AS INTEGER) AS INTEGER) AS lat, CAST(CASE WHEN m[3] = 'W' THEN -1 ELSE 1 END * CAST(m[4] AS INTEGER) AS INTEGER) AS lon
  FROM (SELECT key, [regexp_extract(key, '([NS])(\\d{2})([EW])(\\d{3})', 1), regexp_extract(key, '([NS])(\\d{2})([EW])(\\d{3})', 2), regexp_extract(key, '([NS])(\\d{2})([EW])(\\d{3})', 3), regexp_extract(key, '([NS])(\\d{2})([EW])(\\d{3})', 4)] AS m
        FROM names WHERE regexp_matches(key, '[NS]\\d{2}[EW]\\d{3}')) s),
cells AS (SELECT DISTINCT lat, lon FROM corners)"""
TOUCHED = f"""{BOXES}, {NAMES},
touched AS (
  SELECT z, bx, by_ FROM boxes WHERE EXISTS (SELECT 1 FROM cells WHERE lat < north AND lat + 3 > south AND lon < east AND lon + 3 > west))"""

SIZE = FIXTURE.size_px(FIXTURE.max_level)
RAW = f"""raw AS (
  SELECT CAST(l_partkey % {SIZE} AS INTEGER) AS x, CAST(l_suppkey * 7 % {SIZE} AS INTEGER) AS y, [0, 10, 30, 80, 50][CAST(l_quantity AS INTEGER) % 5 + 1] AS value FROM lineitem),
modes AS (
  SELECT x, y, value FROM (SELECT x, y, value, row_number() OVER (PARTITION BY x, y ORDER BY count(*) DESC, value) AS n FROM raw GROUP BY x, y, value) s WHERE n = 1)"""
RASTER = f"""{RAW},
raster AS (
  SELECT CAST(gx AS INTEGER) AS x, CAST(gy AS INTEGER) AS y, coalesce(value, 0) AS value
  FROM range({SIZE}) a(gx), range({SIZE}) b(gy) LEFT JOIN modes ON x = gx AND y = gy)"""
RASTER = RASTER.replace(f"FROM range({SIZE}) a(gx), range({SIZE}) b(gy) LEFT JOIN modes", f"FROM (SELECT gx, gy FROM range({SIZE}) a(gx), range({SIZE}) b(gy)) g LEFT JOIN modes")
CHANNELS = f"""{RASTER}, {LEGEND_SQL},
channels AS (SELECT x, y, coalesce((SELECT idx FROM legend WHERE list_contains(codes, value) AND layer IS NOT NULL AND max_zoom >= {FIXTURE.max_level}), 0) AS channel FROM raster)"""
WEIGHTS = "taps(o, w) AS (VALUES " + ", ".join(f"({k}, {w})" for k0, w in enumerate(FIXTURE.kernel()) for k in {k0, -k0}) + ")"
SCORES = f"""{CHANNELS}, {WEIGHTS},
h AS (SELECT x + o AS x, y, channel, sum(w) AS score FROM channels, taps WHERE x + o BETWEEN 0 AND {SIZE - 1} GROUP BY ALL),
scores AS (SELECT x, y + o AS y, channel, sum(score * w) AS score FROM h, taps WHERE y + o BETWEEN 0 AND {SIZE - 1} GROUP BY ALL)"""
CLASSES = f"""{SCORES},
classes AS (SELECT x, y, channel FROM (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY score DESC, channel) AS n FROM scores) s WHERE n = 1)"""
# The raster of a block for each supplier; labels spread to equal neighbours until none changes; a label is the region's first pixel in row order.
SIDE = 16
BLOCK_RASTER = f"""braw AS (
  SELECT CAST(l_suppkey % 32 AS INTEGER) AS bx, CAST(l_suppkey // 32 AS INTEGER) AS by_, CAST(l_partkey % {SIDE} AS INTEGER) AS x, CAST((l_orderkey * 7 + l_linenumber) % {SIDE} AS INTEGER) AS y,
         [0, 10, 30, 80, 50][CAST(l_quantity AS INTEGER) % 5 + 1] AS value FROM lineitem),
bmodes AS (SELECT bx, by_, x, y, value FROM (SELECT *, row_number() OVER (PARTITION BY bx, by_, x, y ORDER BY n DESC, value) AS nth FROM (SELECT bx, by_, x, y, value, count(*) AS n FROM braw GROUP BY ALL) c) s WHERE nth = 1),
bgrid AS (SELECT bx, by_, CAST(gx AS INTEGER) AS x, CAST(gy AS INTEGER) AS y FROM (SELECT DISTINCT bx, by_ FROM bmodes) b, range({SIDE}) a(gx), range({SIDE}) c(gy)), {LEGEND_SQL},
bclasses AS (
  SELECT bx, by_, x, y, coalesce((SELECT idx FROM legend WHERE list_contains(codes, coalesce(value, 0)) AND layer IS NOT NULL AND max_zoom >= {FIXTURE.max_level}), 0) AS channel
  FROM bgrid LEFT JOIN bmodes USING (bx, by_, x, y))"""
REGIONS = f"""{BLOCK_RASTER},
steps(dx, dy) AS (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)),
near AS (SELECT a.bx, a.by_, a.x, a.y, b.x AS nx, b.y AS ny FROM (SELECT *, x + dx AS tx, y + dy AS ty FROM bclasses, steps) a JOIN bclasses b ON a.bx = b.bx AND a.by_ = b.by_ AND a.channel = b.channel AND b.x = a.tx AND b.y = a.ty),
spread(bx, by_, x, y, region) USING KEY (bx, by_, x, y) AS (
  SELECT bx, by_, x, y, y * {SIDE} + x FROM bclasses
  UNION
  SELECT n.bx, n.by_, n.x, n.y, min(s.region) FROM near n JOIN spread s ON s.bx = n.bx AND s.by_ = n.by_ AND s.x = n.nx AND s.y = n.ny JOIN recurring.spread r ON r.bx = n.bx AND r.by_ = n.by_ AND r.x = n.x AND r.y = n.y
  WHERE s.region < r.region GROUP BY n.bx, n.by_, n.x, n.y),
regions AS (SELECT bx, by_, CAST(c.x AS INTEGER) AS x, CAST(c.y AS INTEGER) AS y, CAST(channel AS INTEGER) AS channel, CAST(region AS BIGINT) AS region FROM bclasses c JOIN spread USING (bx, by_, x, y)),
-- how many of a pixel's four sides are inside its region
sides AS (
  SELECT r.bx, r.by_, r.region, r.x, r.y, count(o.region) AS same FROM (SELECT *, x + dx AS tx, y + dy AS ty FROM regions, steps) r
  LEFT JOIN regions o ON o.bx = r.bx AND o.by_ = r.by_ AND o.x = r.tx AND o.y = r.ty AND o.region = r.region GROUP BY r.bx, r.by_, r.region, r.x, r.y)"""
HALO = f"""{RASTER},
halo AS (
  SELECT {FIXTURE.max_level} AS z, CAST(i AS INTEGER) AS bx, CAST(j AS INTEGER) AS by_, x, y, value FROM raster, range({FIXTURE.blocks(FIXTURE.max_level)}) a(i), range({FIXTURE.blocks(FIXTURE.max_level)}) b(j)
  WHERE x >= i * {FIXTURE.block_px} - {FIXTURE.margin_px} AND x < (i + 1) * {FIXTURE.block_px} + {FIXTURE.margin_px} AND y >= j * {FIXTURE.block_px} - {FIXTURE.margin_px} AND y < (j + 1) * {FIXTURE.block_px} + {FIXTURE.margin_px})"""
TILE_VALUES = f"""{LEGEND_SQL},
vals AS (SELECT DISTINCT CAST(p_partkey % 12 AS INTEGER) AS z, p_size AS bx, CAST(p_partkey % 97 AS INTEGER) AS by_, [0, 10, 30, 80, 255][p_partkey * p_size % 5 + 1] AS value FROM part),
drawn AS (SELECT DISTINCT z, bx, by_, idx FROM vals JOIN legend ON list_contains(codes, value) AND layer IS NOT NULL AND max_zoom >= z),
windows AS (SELECT z, bx, by_, count(*) AS n_present, string_agg(CAST(value AS VARCHAR), ',' ORDER BY value) AS present FROM vals GROUP BY ALL),
active AS (SELECT z, bx, by_, count(*) AS n_active, min(idx) AS first FROM drawn GROUP BY ALL),
branches AS (
  SELECT w.*, coalesce(n_active, 0) AS n_active, first, CASE WHEN n_active IS NULL THEN 'empty' WHEN n_present = 1 THEN 'uniform' ELSE 'full' END AS branch
  FROM windows w LEFT JOIN active USING (z, bx, by_))"""
UNIFORM = f"""{TABLE_BOXES}, {LEGEND_SQL},
uniform AS (SELECT z, bx, by_, layer, kind, west, south, east, north FROM boxes JOIN legend ON idx = (bx + 3 * by_ + z) % 12 WHERE layer IS NOT NULL)"""


def boxes_sql(name: str, source: str, key: str, size: str) -> str:
    place = f"({key} * {{m}} % 128) / 128.0 * 2 ** ({key} % 5)"
    u, v = place.format(m=37), place.format(m=61)
    return f"""{name} AS (
  SELECT id, z, CAST(i AS INTEGER) AS tx, CAST(j AS INTEGER) AS ty
  FROM (SELECT {key} AS id, CAST({key} % 5 AS INTEGER) AS z, {u} AS u0, {u} + {size} % 4 / 2.0 AS u1, {v} AS v0, {v} + {size} % 3 / 4.0 AS v1 FROM {source}) s, range(16) a(i), range(16) b(j)
  WHERE i < 2 ** z AND j < 2 ** z AND i + 1 > u0 AND (i < u1 OR i = floor(u0)) AND j + 1 > v0 AND (j < v1 OR j = floor(v0)))"""


TILES = boxes_sql("ours", "part", "p_partkey", "p_size")
BASE = boxes_sql("base", "supplier", "s_suppkey", "s_nationkey")
EVENTS = """log AS (SELECT event_id AS seq, epoch_us(ts) // 1000 AS t_ms, user_id % 3 + 1 AS n FROM events),
done AS (SELECT *, CAST(sum(n) OVER (ORDER BY seq) AS BIGINT) AS done, CAST(sum(n) OVER () AS BIGINT) AS total, min(seq) OVER () AS first_seq FROM log),
-- the ring: a sample (start, 0), then the rows; at most 64 are held
ring AS (SELECT seq, t_ms, done, total FROM done UNION ALL SELECT min(seq) - 1, min_by(t_ms, seq), 0, min(total) FROM done),
framed AS (
  SELECT *, first_value(t_ms) OVER w AS old_t, first_value(done) OVER w AS old_done, first_value(t_ms) OVER (ORDER BY seq) AS start_t FROM ring
  WINDOW w AS (ORDER BY seq ROWS BETWEEN 63 PRECEDING AND CURRENT ROW)
  QUALIFY seq >= (SELECT min(first_seq) FROM done)),
rated AS (
  SELECT *, CASE WHEN t_ms > old_t THEN (done - old_done) / ((t_ms - old_t) / 1000) WHEN t_ms > start_t THEN done / ((t_ms - start_t) / 1000) ELSE 0.0 END AS rate FROM framed)"""


def micro(c: str, factor: str = "1000000") -> str:
    return f"CAST(floor({c} * {factor} + 0.5) AS BIGINT)"


def said(s: str) -> str:
    """Duration text of a number of seconds."""
    w = f"CAST(floor({s} + 0.5) AS BIGINT)"
    return f"""CASE WHEN {s} IS NULL OR {s} < 0 THEN '--' WHEN {w} >= 3600 THEN {w} // 3600 || 'h' || lpad(CAST({w} % 3600 // 60 AS VARCHAR), 2, '0') || 'm'
      WHEN {w} >= 60 THEN {w} // 60 || 'm' || lpad(CAST({w} % 60 AS VARCHAR), 2, '0') || 's' ELSE {w} || 's' END"""


def mode_of_cells(source: str, shift: str) -> str:
    return f"SELECT x, y, value FROM (SELECT x // {shift} AS x, y // {shift} AS y, value, row_number() OVER (PARTITION BY x // {shift}, y // {shift} ORDER BY count(*) DESC, value) AS n FROM {source} GROUP BY x // {shift}, y // {shift}, value) s WHERE n = 1"


PYRAMID = f"{RASTER}, one AS ({mode_of_cells('raster', '2')}), zero AS ({mode_of_cells('one', '2')})"
LEVELS = "SELECT 2 AS level, x, y, value FROM raster UNION ALL SELECT 1, x, y, value FROM one UNION ALL SELECT 0, x, y, value FROM zero"
FILLED = "CAST(floor(done / total * 24 + 0.5) AS INTEGER)"

# The suppliers' blocks side by side; each level is the mode of two by two of the one above it.
def large(blocks: str) -> str:
    return f"""{BLOCK_RASTER},
big AS (SELECT bx * {SIDE} + x AS x, by_ * {SIDE} + y AS y, value FROM {blocks}),
l5 AS (SELECT CAST(gx AS INTEGER) AS x, CAST(gy AS INTEGER) AS y, coalesce(value, 0) AS value FROM (SELECT gx, gy FROM range(512) a(gx), range(512) b(gy)) g LEFT JOIN big ON big.x = gx AND big.y = gy),
""" + ",\n".join(f"l{z} AS ({mode_of_cells(f'l{z + 1}', '2')})" for z in range(4, -1, -1))


LARGE = large("bmodes")
CHANGED = large("""(
  SELECT bx, by_, x, y, CASE WHEN n % 15 = 0 THEN value + 1 WHEN n % 10 = 0 THEN 0 WHEN n % 5 = 0 THEN 110 - value ELSE value END AS value
  FROM (SELECT bx, by_, x, y, bx + 3 * by_ AS n, coalesce(value, 0) AS value FROM bgrid LEFT JOIN bmodes USING (bx, by_, x, y)) v) changed""")
CHUNK_SUMS = f"""levels AS ({" UNION ALL ".join(f"SELECT {z} AS level, x, y, value FROM l{z}" for z in range(6))})
SELECT level, CAST(x // {SIDE} AS INTEGER) AS cx, CAST(y // {SIDE} AS INTEGER) AS cy, CAST(count(*) FILTER (value > 0) AS BIGINT) AS n, CAST(sum(value) AS BIGINT) AS total FROM levels GROUP BY ALL HAVING sum(value) > 0"""
# Labels spread over the whole raster, block borders or not; a label is a pixel's block and its place there.
ACROSS = f"""{BLOCK_RASTER},
pix AS (SELECT bx, by_, bx * {SIDE} + x AS x, by_ * {SIDE} + y AS y, CASE WHEN value IN (10, 30) THEN 1 ELSE 2 END AS value, (CAST(by_ AS BIGINT) * 65536 + bx) * 1048576 + y * {SIDE} + x AS place FROM bmodes WHERE value > 0),
beside AS (SELECT a.place, b.place AS other FROM (SELECT *, x + dx AS tx, y + dy AS ty FROM pix, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) s(dx, dy)) a JOIN pix b ON b.x = a.tx AND b.y = a.ty AND b.value = a.value),
spread(place, region) USING KEY (place) AS (
  SELECT place, place FROM pix
  UNION
  SELECT n.place, min(s.region) FROM beside n JOIN spread s ON s.place = n.other JOIN recurring.spread r ON r.place = n.place WHERE s.region < r.region GROUP BY n.place)"""
OURS_FEATURES = "SELECT z, tx, ty, id, CASE WHEN id % 3 = 0 THEN 'water_polygons' ELSE 'land' END AS layer, 'a' || (id % 5) AS kind FROM ours"
FEATURES = "SELECT z, tx, ty, layer, kind, count(*) AS n, CAST(sum((id % 30 + 1) * (id % 7 + 1)) AS BIGINT) AS area, CAST(1 AS BIGINT) AS n_layers FROM merged GROUP BY ALL"

ORACLES: dict[str, str] = {
    "q_block_grid": f'WITH {TABLE_ZOOMS} SELECT s_suppkey, z, CAST(x AS INTEGER) AS bx, CAST(y AS INTEGER) AS "by" FROM (SELECT *, CAST(ceil(2 ** z / {G.block_tiles}) AS BIGINT) AS n FROM zooms WHERE z < 7) s, unnest(range(n)) a(x), unnest(range(n)) b(y)',
    "q_window_geometry": f"""WITH {TABLE_BOXES} SELECT z, bx, by_ AS "by", {", ".join(f"{micro(c, '1000')} AS {c}" for c in ("minx", "miny", "maxx", "maxy", "win_minx", "win_miny", "win_maxx", "win_maxy"))},
  CAST(round((win_maxx - win_minx) / px) AS INTEGER) AS px_width, CAST(round((win_maxy - win_miny) / px) AS INTEGER) AS px_height, {", ".join(f"{micro(c)} AS {c}" for c in ("west", "south", "east", "north"))} FROM boxes""",
    "q_tolerance_by_zoom": f"WITH zooms AS (SELECT p_partkey, CAST(p_size % 11 AS INTEGER) AS z FROM part) SELECT p_partkey, z, CAST(ceil(2 ** z / {G.block_tiles}) AS INTEGER) AS blocks, {micro(f'({WORLD!r} / 2 ** z / {G.tile_px})', '1000')} AS mm_per_px, {micro(f'({WORLD!r} / (256 * 2 ** z))', '1000')} AS tolerance_mm FROM zooms",
    "q_corner_parse": f"WITH {NAMES} SELECT key, lat, lon FROM corners",
    "q_xml_key_extract": """SELECT p_partkey, 'a/' || p_partkey || '.tif|b/' || p_partkey || '.tif' AS keys, CASE WHEN p_size % 3 <> 0 THEN 'T' || p_size END AS next_token FROM part""",
    "q_occupied_cells": f"WITH {NAMES} SELECT lat, lon FROM cells",
    "q_nonempty_blocks": f'WITH {TOUCHED} SELECT z, bx, by_ AS "by" FROM touched',
    "q_skipped_blocks": f'WITH {TOUCHED} SELECT z, bx, by_ AS "by" FROM blocks EXCEPT SELECT z, bx, by_ FROM touched',
    "q_blocks_per_zoom": f"WITH {TOUCHED} SELECT z, count(*) AS blocks FROM touched GROUP BY z",
    "q_resume_pending": f"""WITH {TOUCHED}, s AS (SELECT *, (bx * 7 + by_ * 3 + z) % 4 AS k, z <= 3 AS has_water FROM touched)
SELECT z, bx, by_ AS "by", true AS has_land, has_water FROM s WHERE NOT (k IN (0, 1) AND (NOT has_water OR k IN (0, 2)))""",
    "q_active_channels": f"WITH {TABLE_ZOOMS}, {LEGEND_SQL} SELECT s_suppkey, z, idx, layer, kind FROM zooms, legend WHERE layer IS NOT NULL AND max_zoom >= z",
    "q_nodata_codes": f"WITH {TABLE_ZOOMS}, {LEGEND_SQL} SELECT s_suppkey, z, unnest(codes) AS code FROM zooms, legend WHERE layer IS NULL OR max_zoom < z",
    "q_style_rules": f"""WITH d AS (SELECT p_partkey AS idx, p_type AS kind, [p_partkey * 7919 % 16777216 // 65536, p_partkey * 7919 % 16777216 // 256 % 256, p_partkey * 7919 % 16777216 % 256, 255] AS b FROM part WHERE p_size % 5 <> 0 AND p_size % 7 <> 0)
SELECT idx, 'land' AS layer, kind, array_to_string(b, ',') || ',rgb:' || array_to_string(list_transform(b, lambda v: regexp_replace(CAST(v / 255 AS VARCHAR), '\\.0$', '')), ',') AS fill, '"kind" = ''' || kind || '''' AS rule FROM d""",
    "q_color_parse": """WITH c AS (SELECT p_partkey, p_size, '#' || lpad(upper(to_hex(p_partkey * 7919 % 16777216)), 6, '0') || CASE WHEN p_size % 2 = 0 THEN lpad(upper(to_hex(p_size)), 2, '0') ELSE '' END AS code, p_partkey * 7919 % 16777216 AS v FROM part)
SELECT p_partkey, code, (v // 65536) || ',' || (v // 256 % 256) || ',' || (v % 256) || ',' || CASE WHEN p_size % 2 = 0 THEN p_size ELSE 255 END AS rgba FROM c""",
    "q_mode_resample": f"WITH {RAW} SELECT x, y, value FROM modes",
    "q_pyramid": f"WITH {PYRAMID} {LEVELS}",
    "q_pyramid_direct": f"WITH {RASTER}, one AS ({mode_of_cells('raster', '2')}), zero AS ({mode_of_cells('raster', '4')}) {LEVELS}",
    "q_level_read": f"WITH {PYRAMID} SELECT x, y, value FROM one",
    "q_mosaic": f"WITH {RAW}, moved AS (SELECT x + 10 AS x, y, value + 1 AS value FROM modes) SELECT x, y, value FROM moved UNION ALL SELECT x, y, value FROM modes WHERE NOT EXISTS (SELECT 1 FROM moved WHERE moved.x = modes.x AND moved.y = modes.y)",
    "q_window_read": f"WITH {RAW} SELECT CAST(gx AS INTEGER) AS x, CAST(gy AS INTEGER) AS y, coalesce(value, 0) AS value FROM (SELECT gx, gy FROM range(50, 80) a(gx), range(40, 70) b(gy)) g LEFT JOIN modes ON x = gx AND y = gy",
    "q_crop": f"WITH {CLASSES} SELECT CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, channel FROM classes WHERE x BETWEEN 16 AND 47 AND y BETWEEN 16 AND 47",
    "q_halo_assign": f'WITH {HALO} SELECT z, bx, by_ AS "by", x, y, value FROM halo',
    "q_histogram": f'WITH {HALO} SELECT z, bx, by_ AS "by", value, count(*) AS n FROM halo GROUP BY ALL',
    "q_present": f"""WITH {HALO} SELECT z, bx, by_ AS "by", string_agg(DISTINCT CAST(value AS VARCHAR), ',' ORDER BY CAST(value AS VARCHAR)) AS present FROM halo GROUP BY ALL""",
    "q_block_branch": f'WITH {TILE_VALUES} SELECT z, bx, by_ AS "by", CAST(n_present AS INTEGER) AS n_present, CAST(n_active AS INTEGER) AS n_active, branch FROM branches',
    "q_ordinals": f'WITH {TILE_VALUES} SELECT z, bx, by_ AS "by", CAST(row_number() OVER (PARTITION BY z, bx, by_ ORDER BY idx) + 1 AS INTEGER) AS code, idx AS channel FROM drawn',
    "q_block_log": f"""WITH {TILE_VALUES} SELECT '2024-01-02T03:04:05.678Z' AS timestamp, 'z' || z || '_' || bx || '_' || by_ AS id, branch, '1' AS ms, '' AS land_bytes, '' AS water_bytes, present,
  CASE WHEN branch = 'full' THEN CAST(n_active AS VARCHAR) ELSE '' END AS channels, CASE WHEN branch = 'uniform' THEN (SELECT kind FROM legend WHERE idx = first) ELSE '' END AS kind FROM branches""",
    "q_mask_long": f"WITH {CHANNELS} SELECT x, y, channel, 255 AS mask FROM channels",
    "q_blur": f"WITH {SCORES} SELECT CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, channel, CAST(score AS BIGINT) AS score FROM scores",
    "q_argmax": f"WITH {CLASSES} SELECT CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, channel FROM classes",
    "q_class_histogram": f"WITH {CLASSES} SELECT channel, count(*) AS n FROM classes GROUP BY channel",
    "q_channel_prune_equiv": f'WITH {BLOCK_RASTER} SELECT bx, by_ AS "by", count(*) AS n, CAST(0 AS BIGINT) AS n_different FROM bclasses GROUP BY bx, by_',
    "q_components": f'WITH RECURSIVE {REGIONS} SELECT bx, by_ AS "by", x, y, channel, region FROM regions',
    "q_region_sizes": f'WITH RECURSIVE {REGIONS} SELECT bx, by_ AS "by", region, channel, count(*) AS n FROM regions GROUP BY ALL',
    "q_region_adjacency": f"""WITH RECURSIVE {REGIONS} SELECT a.bx, a.by_ AS "by", least(a.region, b.region) AS one, greatest(a.region, b.region) AS two, count(*) AS edges
FROM (SELECT *, x + dx AS tx, y + dy AS ty FROM regions, steps WHERE dx + dy = 1) a JOIN regions b ON a.bx = b.bx AND a.by_ = b.by_ AND b.x = a.tx AND b.y = a.ty WHERE a.region <> b.region GROUP BY ALL""",
    "q_polygon_area": f'WITH RECURSIVE {REGIONS} SELECT bx, by_ AS "by", region, count(*) AS area, CAST(sum(4 - same) AS BIGINT) AS boundary FROM sides GROUP BY ALL',
    "q_tag_split": f"""WITH RECURSIVE {REGIONS}, codes AS (SELECT bx, by_, channel, row_number() OVER (PARTITION BY bx, by_ ORDER BY channel) + 1 AS code FROM (SELECT DISTINCT bx, by_, channel FROM regions WHERE channel > 0) s)
SELECT bx, by_ AS "by", region, CAST(code AS INTEGER) AS code, layer, kind, count(*) AS n FROM regions JOIN codes USING (bx, by_, channel) JOIN legend ON idx = channel WHERE layer IS NOT NULL GROUP BY ALL""",
    "q_uniform_fragments": f'WITH {UNIFORM} SELECT z, bx, by_ AS "by", layer, kind, {", ".join(f"{micro(c)} AS {c}" for c in ("west", "south", "east", "north"))} FROM uniform',
    "q_fragment_union": f"WITH {UNIFORM} SELECT z, layer, kind, count(*) AS n, count(*) AS n_geom FROM uniform GROUP BY ALL",
    "q_tile_explode": f"WITH {TILES} SELECT id, z, tx, ty FROM ours",
    "q_coalesce_smallest": """WITH c AS (SELECT c_custkey AS id, c_nationkey, c_acctbal AS area, c_custkey % 50 + 100 AS bytes FROM customer)
SELECT id, c_nationkey, coalesce((SELECT sum(b.bytes) FROM c b WHERE b.c_nationkey = a.c_nationkey AND (b.area < a.area OR b.area = a.area AND b.id < a.id)), 0) < (SELECT sum(bytes) FROM c b WHERE b.c_nationkey = a.c_nationkey) - 5000 AS merged FROM c a""",
    "q_zoom_union": f"WITH {TILES} SELECT z, count(*) AS n FROM ours GROUP BY z",
    "q_feature_merge": f"WITH {TILES}, {BASE}, merged AS (SELECT z, tx, ty, 0 AS b FROM ours UNION ALL SELECT z, tx, ty, 1 FROM base) SELECT z, tx, ty, count(*) AS n, CAST(sum(b) AS BIGINT) AS n_base FROM merged GROUP BY ALL",
    "q_layer_merge": f"""WITH {TILES}, {BASE}, merged AS (
  SELECT z, tx, ty, id, CASE WHEN id % 3 = 0 THEN 'water_polygons' ELSE 'land' END AS layer, 'a' || (id % 5) AS kind FROM ours
  UNION ALL SELECT z, tx, ty, id, CASE WHEN id % 2 = 0 THEN 'land' ELSE 'roads' END, CASE WHEN id % 4 = 0 THEN 'a1' ELSE 'b' || (id % 4) END FROM base)
SELECT z, tx, ty, layer, kind, count(*) AS n, CAST(sum((id % 30 + 1) * (id % 7 + 1)) AS BIGINT) AS area, CAST(1 AS BIGINT) AS n_layers FROM merged GROUP BY ALL""",
    "q_blob_merge": f"""WITH {TILES}, {BASE}, a AS (SELECT z, tx, ty, count(*) AS n FROM ours GROUP BY ALL), b AS (SELECT z, tx, ty, count(*) AS n FROM base GROUP BY ALL)
SELECT z, tx, ty, coalesce(CAST(a.n AS VARCHAR), '') || coalesce(CAST(b.n AS VARCHAR), '') AS data FROM a FULL OUTER JOIN b USING (z, tx, ty)""",
    "q_sliding_rate": f"WITH {EVENTS} SELECT seq, done, {micro('rate')} AS rate_micro FROM rated",
    "q_eta": f"WITH {EVENTS}, e AS (SELECT seq, done, CASE WHEN rate > 0 AND done < total THEN (total - done) / rate END AS eta FROM rated) SELECT seq, done, {said('eta')} AS eta_text FROM e",
    "q_percent_lines": f"""WITH {EVENTS}, p AS (SELECT seq, done, total, CAST(floor(done / total * 100) AS INTEGER) AS pct FROM done), l AS (SELECT *, coalesce(lag(pct) OVER (ORDER BY seq), 0) AS before FROM p)
SELECT seq, done, pct, {FILLED} AS cells FROM l WHERE before <> pct""",
    "q_duration_text": f"WITH o AS (SELECT o_orderkey, o_totalprice / 7 - 100 AS s FROM orders) SELECT o_orderkey, {said('s')} AS said FROM o",
    "q_job_rates": f"""WITH log AS (SELECT user_id % 23 AS job, event_id AS seq, epoch_us(ts) // 1000 AS t_ms, user_id % 3 + 1 AS n FROM events),
totals AS (SELECT *, CAST(sum(n) OVER (PARTITION BY job ORDER BY seq) AS BIGINT) AS done, first_value(t_ms) OVER (PARTITION BY job ORDER BY seq) AS start FROM log),
spans AS (SELECT *, (t_ms - coalesce(lag(t_ms, 63) OVER w, start)) / 1000 AS span, done - coalesce(lag(done, 63) OVER w, 0) AS grown, (t_ms - start) / 1000 AS elapsed FROM totals WINDOW w AS (PARTITION BY job ORDER BY seq)),
rated AS (SELECT *, CASE WHEN span > 0 THEN grown / span WHEN elapsed > 0 THEN done / elapsed ELSE 0 END AS rate FROM spans)
SELECT job, seq, done, {micro('rate')} AS rate_micro FROM rated""",
    "q_json_hist": "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(CASE WHEN json_extract(props, '$.k') IS NULL THEN 0 ELSE 2 END AS INTEGER) AS n_buckets, count(*) AS n FROM events GROUP BY ALL",
    "q_listing_url": """SELECT s_suppkey, 'https://store.example/bucket?list-type=2&prefix=' || replace(replace(url_encode(s_name), '%20', '+'), '%23', '%23') || CASE WHEN s_suppkey % 2 = 0 THEN '&continuation-token=a%2Fb%2B' || s_suppkey ELSE '' END AS url FROM supplier""",
    "q_exit_reason": """SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'killed by SIGKILL (out of memory?)' WHEN 1 THEN 'killed by SIGTERM' ELSE 'exited with code ' || s_nationkey END AS said,
  (s_suppkey % 3) || CASE WHEN s_suppkey % 3 = 1 THEN ' entry' ELSE ' entries' END AS entries FROM supplier""",
    "q_windowed_rate": f"""WITH e AS (SELECT CAST(floor(epoch_ms(ts) / 60000) AS BIGINT) * 60 - k * 60 AS start_s, event_type FROM events, range(5) t(k))
SELECT start_s, event_type, count(*) AS n, {micro('(count(*) / 300)')} AS rate_micro FROM e GROUP BY start_s, event_type""",
    "q_block_order": f'WITH {TABLE_BLOCKS} SELECT z, bx, by_ AS "by", CAST(row_number() OVER (PARTITION BY z ORDER BY by_, bx) - 1 AS INTEGER) AS nth FROM blocks',
    "q_cell_keys": f"WITH {NAMES} SELECT lat || ',' || lon AS cell FROM cells",
    "q_path_parts": f"WITH {NAMES} SELECT key, CASE WHEN contains(key, '/') THEN 'map' ELSE key END AS folder, string_split(key, '/')[-1] AS name, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'[length(key) % 25 + 1] AS band FROM names",
    "q_lines": "SELECT s_suppkey, CAST(nth AS INTEGER) AS nth, CASE nth WHEN 0 THEN s_name WHEN 1 THEN CAST(s_suppkey AS VARCHAR) ELSE 'end' END AS line FROM supplier, range(3) t(nth)",
    "q_active_layers": f"WITH {TABLE_ZOOMS} SELECT s_suppkey, z, true AS has_land, z <= 3 AS has_water FROM zooms",
    "q_project_points": f"""WITH p AS (SELECT c_custkey, c_custkey * 7919 % 3590000 / 10000 - 179.5 AS lon, c_custkey * 104729 % 1700000 / 10000 - 85 AS lat FROM customer)
SELECT c_custkey, {micro(f'(lon / 180 * {MERC!r})', '1000')} AS x_mm, {micro(f'(ln(tan(pi() / 4 + radians(lat) / 2)) / pi() * {MERC!r})', '1000')} AS y_mm, {micro('lon')} AS lon_micro, {micro('lat')} AS lat_micro FROM p""",
    "q_pixel_corners": f"""WITH p AS (SELECT p_partkey, {WORLD!r} / 2 ** (p_partkey % 11) / {G.tile_px} AS px, p_partkey * 31 % 1024 AS x, p_partkey * 17 % 1024 AS y FROM part)
SELECT p_partkey, {micro(f'((x * px - {MERC!r}) / {MERC!r} * 180)')} AS lon_micro, {micro(f'degrees(2 * atan(exp(({MERC!r} - y * px) / {MERC!r} * pi())) - pi() / 2)')} AS lat_micro FROM p""",
    "q_warp": f"""WITH c AS (SELECT (l_partkey * 7 % 540) / 1.5 - 179.7 AS lon, (l_suppkey * 11 % 270) / 1.5 - 89.6 AS lat, [0, 10, 30, 80, 50][CAST(l_quantity AS INTEGER) % 5 + 1] AS value FROM lineitem),
m AS (SELECT CAST(floor((lon + 180) / 360 * {SIZE}) AS INTEGER) AS x, CAST(floor((1 - ln(tan(pi() / 4 + radians(lat) / 2)) / pi()) / 2 * {SIZE}) AS INTEGER) AS y, value FROM c)
SELECT x, y, value FROM (SELECT x, y, value, row_number() OVER (PARTITION BY x, y ORDER BY count(*) DESC, value) AS n FROM m WHERE x BETWEEN 0 AND {SIZE - 1} AND y BETWEEN 0 AND {SIZE - 1} GROUP BY x, y, value) s WHERE n = 1""",
    "q_warp_fine": f"""WITH c AS (SELECT l_partkey % 18 AS i, l_suppkey % 85 AS j, [0, 10, 30, 80, 50][CAST(l_quantity AS INTEGER) % 5 + 1] AS value FROM lineitem),
n AS (SELECT i, j, value, count(*) AS n FROM c GROUP BY ALL),
-- lines of pixels gather lines of cells: those whose centres they hold, else the one that holds their middle
ci AS (SELECT k AS i, CAST(floor((k * 20 + 10) / 360.0 * 256) AS INTEGER) AS t FROM range(18) r(k)),
cj AS (SELECT k AS j, CAST(floor((1 - ln(tan(pi() / 4 + radians(k * 2 - 84.0) / 2)) / pi()) / 2 * 256) AS INTEGER) AS t FROM range(85) r(k)),
mj AS (SELECT CAST(t AS INTEGER) AS t, degrees(2 * atan(exp((1 - 2 * (t + 0.5) / 256) * pi())) - pi() / 2) AS lat FROM range(256) r(t)),
gx AS (SELECT t, i FROM ci UNION ALL SELECT CAST(t AS INTEGER), CAST(floor((t + 0.5) / 256 * 18) AS BIGINT) FROM range(256) r(t) WHERE t NOT IN (SELECT t FROM ci)),
gy AS (SELECT t, j FROM cj UNION ALL SELECT t, CAST(floor((lat + 85) / 2) AS BIGINT) FROM mj WHERE t NOT IN (SELECT t FROM cj) AND lat >= -85 AND lat < 85),
p AS (SELECT gx.t AS x, gy.t AS y, value, sum(n) AS n FROM n JOIN gx USING (i) JOIN gy USING (j) GROUP BY ALL)
SELECT x, y, value FROM (SELECT x, y, value, row_number() OVER (PARTITION BY x, y ORDER BY n DESC, value) AS nth FROM p) s WHERE nth = 1""",
    "q_simplify_checks": f'WITH RECURSIVE {REGIONS} SELECT bx, by_ AS "by", count(DISTINCT region) AS regions, CAST(sum(4 - same) AS BIGINT) AS corners, count(*) AS area, CAST(0 AS BIGINT) AS wrong FROM sides GROUP BY ALL',
    "q_sieve_checks": f'WITH {BLOCK_RASTER} SELECT bx, by_ AS "by", count(*) AS pixels, CAST(0 AS BIGINT) AS small FROM bclasses GROUP BY ALL',
    "q_rectangle_rings": f"""WITH {UNIFORM} SELECT z, bx, by_ AS "by", CAST(nth AS INTEGER) AS nth, {micro('(CASE WHEN nth IN (1, 2) THEN east ELSE west END)')} AS x_micro, {micro('(CASE WHEN nth IN (2, 3) THEN north ELSE south END)')} AS y_micro FROM uniform, range(5) t(nth)""",
    "q_layers_by_zoom": f"WITH {UNIFORM} SELECT z, count(*) FILTER (layer = 'land') AS n_land, count(*) FILTER (layer = 'water_polygons') AS n_water FROM uniform WHERE z % 2 = 0 AND bx % 2 = 1 GROUP BY z",
    "q_fragment_bytes": """WITH b AS (SELECT DISTINCT CAST(c_custkey % 50 AS INTEGER) AS bx, CAST(c_custkey % 7 AS INTEGER) AS by_ FROM customer),
o AS (SELECT CAST(o_custkey % 50 AS INTEGER) AS bx, CAST(o_custkey % 7 AS INTEGER) AS by_, o_orderkey % 3 = 0 AS water, length(o_orderpriority) AS n FROM orders)
SELECT 3 AS z, b.bx, b.by_ AS "by", 'full' AS branch, CAST(sum(n) FILTER (NOT water) AS BIGINT) AS land_bytes, CAST(sum(n) FILTER (water) AS BIGINT) AS water_bytes FROM b LEFT JOIN o USING (bx, by_) GROUP BY b.bx, b.by_""",
    "q_cut_boxes": """WITH b AS (SELECT p_partkey AS id, CAST(p_partkey % 5 AS INTEGER) AS z, (p_partkey * 37 % 128) / 128.0 * 2 ** (p_partkey % 5) AS u0, (p_partkey * 61 % 128) / 128.0 * 2 ** (p_partkey % 5) AS v0, p_size % 4 / 2.0 AS w, p_size % 3 / 4.0 AS h FROM part),
t AS (SELECT id, z, CAST(i AS INTEGER) AS tx, CAST(j AS INTEGER) AS ty, greatest((u0 - i) * 4096, -80) AS x0, least((u0 + w - i) * 4096, 4176) AS x1, greatest((v0 - j) * 4096, -80) AS y0, least((v0 + h - j) * 4096, 4176) AS y1
  FROM b, range(16) a(i), range(16) c(j) WHERE i < 2 ** z AND j < 2 ** z AND w > 0 AND h > 0 AND u0 + w <= 2 ** z AND v0 + h <= 2 ** z)
SELECT id, z, tx, ty, CAST(round(x0) AS BIGINT) AS x0, CAST(round(x1) AS BIGINT) AS x1, CAST(round(y0) AS BIGINT) AS y0, CAST(round(y1) AS BIGINT) AS y1 FROM t WHERE round(x0) < round(x1) AND round(y0) < round(y1)""",
    "q_status_lines": f"""WITH {EVENTS}, p AS (SELECT seq, done, total, CAST(floor(done / total * 100) AS INTEGER) AS pct FROM done), l AS (SELECT *, coalesce(lag(pct) OVER (ORDER BY seq), 0) AS before, CASE WHEN done < total THEN (total - done) / (2 / 7) END AS eta FROM p)
SELECT seq, lpad(CAST(pct AS VARCHAR), 3, ' ') || '% ' || done || '/' || total || ' (0.3/s, ETA ' || {said('eta')} || ')' AS line FROM l WHERE before <> pct""",
    "q_saved_list": f"WITH {NAMES} SELECT key, count(*) AS n FROM names GROUP BY key",
    "q_stored_levels": f"WITH {LARGE}, {CHUNK_SUMS}",
    "q_updated_levels": f"WITH {CHANGED}, {CHUNK_SUMS}",
    "q_regions_across": f"WITH RECURSIVE {ACROSS} SELECT region, value, count(*) AS n, count(DISTINCT (bx, by_)) AS n_chunks FROM pix JOIN spread USING (place) GROUP BY ALL",
    "q_stored_fragments": f'WITH {UNIFORM} SELECT z, bx, by_ AS "by", layer, kind, CAST(1 AS BIGINT) AS n_parts, {micro("west")} AS west_micro, {micro("north")} AS north_micro FROM uniform',
    "q_packed_tiles": f"WITH {TILES}, merged AS ({OURS_FEATURES}) {FEATURES}",
    # the pixels of a block or tile, counted in the raster that fills what no supplier has
    "q_block_areas": f"""WITH {BLOCK_RASTER}, big AS (SELECT bx * {SIDE} + x AS x, by_ * {SIDE} + y AS y, value FROM bmodes),
field AS (SELECT gx AS x, gy AS y, coalesce(value, 10) AS value FROM (SELECT gx, gy FROM range(512) a(gx), range(512) b(gy)) g LEFT JOIN big ON big.x = gx AND big.y = gy),
levels AS (SELECT 5 - k AS z, x >> k AS x, y >> k AS y FROM field, range(4) t(k) GROUP BY ALL)
SELECT CAST(z AS INTEGER) AS z, CAST(x // 32 AS INTEGER) AS bx, CAST(y // 32 AS INTEGER) AS "by", count(*) AS pixels FROM levels GROUP BY ALL""",
    "q_tile_areas": f"""WITH {BLOCK_RASTER}, big AS (SELECT bx * {SIDE} + x AS x, by_ * {SIDE} + y AS y, value FROM bmodes),
field AS (SELECT gx AS x, gy AS y, coalesce(value, 10) AS value FROM (SELECT gx, gy FROM range(512) a(gx), range(512) b(gy)) g LEFT JOIN big ON big.x = gx AND big.y = gy),
levels AS (SELECT 5 - k AS z, x >> k AS x, y >> k AS y FROM field, range(4) t(k) GROUP BY ALL)
SELECT CAST(z AS INTEGER) AS z, CAST(x // 16 AS INTEGER) AS tx, CAST(y // 16 AS INTEGER) AS ty, CAST(count(*) * (4096 // 16) * (4096 // 16) AS BIGINT) AS units FROM levels GROUP BY ALL""",
}
ORACLES["q_merged_containers"] = ORACLES["q_layer_merge"]
