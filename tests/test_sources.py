"""Listings over a local server, saved lists, raster files."""

import struct
import threading
import urllib.parse
import zlib
from http.server import BaseHTTPRequestHandler, HTTPServer

import numpy as np
import pytest

from rasterloom.operators import resample, warp
from rasterloom.plans import pipeline
from rasterloom.plans.settings import FIXTURE, Grid
from rasterloom.sources import listing, packs, raster_files

PAGES = {
    None: "<R><Key>a/N00E003.tif</Key><Key>a/readme.txt</Key><Key>.tif</Key><IsTruncated>true</IsTruncated><NextContinuationToken>t/1+</NextContinuationToken></R>",
    "t/1+": "<R><Key>a/S03W006.tif</Key><IsTruncated>true</IsTruncated><NextContinuationToken>t2</NextContinuationToken></R>",
    "t2": "<R><Key>a/N06W006.tif</Key><IsTruncated>false</IsTruncated><NextContinuationToken>t3</NextContinuationToken></R>",
}


@pytest.fixture
def store():
    """A local store; asked holds the queries it got."""
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            q = dict(urllib.parse.parse_qsl(urllib.parse.urlparse(self.path).query))
            asked.append(q)
            page = PAGES.get(q.get("continuation-token")) if q.get("prefix") == "a/" else None
            self.send_response(200 if page else 403)
            self.end_headers()
            self.wfile.write((page or "").encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/bucket", asked
    server.shutdown()
    server.server_close()


def test_a_listing_is_read_to_its_end(spark, store):
    url, asked = store
    spark.dataSource.register(listing.ListingSource)
    names = spark.read.format("tile_listing").option("url", url).option("prefix", "a/").load()
    assert sorted(r.key for r in names.collect()) == ["a/N00E003.tif", "a/N06W006.tif", "a/S03W006.tif"]
    assert [q.get("continuation-token") for q in asked] == [None, "t/1+", "t2"] and {q["list-type"] for q in asked} == {"2"}
    assert {tuple(r) for r in listing.occupied_cells(names).collect()} == {(0, 3), (6, -6), (-3, -6)}
    with pytest.raises(Exception, match="403"):
        spark.read.format("tile_listing").option("url", url).option("prefix", "b/").load().collect()


def test_a_truncated_page_without_a_token_is_the_last():
    asked = []

    def page(token):
        asked.append(token)
        return 200, "<IsTruncated>true</IsTruncated><NextContinuationToken></NextContinuationToken>"

    assert len(list(listing.pages(page))) == 1 and asked == [None]
    with pytest.raises(OSError):
        list(listing.pages(lambda token: (500, "")))


def test_a_saved_list(spark, tmp_path):
    (tmp_path / "names.txt").write_text(" a/N00E003.tif \n\nb.tif\n")
    (tmp_path / "none.txt").write_text("\n \n")
    assert sorted(r.key for r in listing.read_list(spark, str(tmp_path / "names.txt")).collect()) == ["a/N00E003.tif", "b.tif"]
    with pytest.raises(ValueError):
        listing.read_list(spark, str(tmp_path / "none.txt"))


def tiff(pixels, lon, lat, step, *, tile=None, deflate=False, predictor=False, big=False, order="<"):
    """A north-up file of one byte a pixel."""
    h, w = pixels.shape
    wide, high = (tile, tile) if tile else (w, 5)
    blocks = []
    for y in range(0, h, high):
        for x in range(0, w, wide):
            part = pixels[y : y + high, x : x + wide]
            if tile:
                part = np.pad(part, ((0, high - part.shape[0]), (0, wide - part.shape[1])))
            if predictor:
                part = np.diff(part, axis=1, prepend=np.uint8(0))
            blocks.append(zlib.compress(part.tobytes()) if deflate else part.tobytes())
    word = "Q" if big else "I"
    head = 16 if big else 8
    places = [head + sum(map(len, blocks[:k])) for k in range(len(blocks))]
    sizes = list(map(len, blocks))
    tags = [(256, "I", [w]), (257, "I", [h]), (258, "H", [8]), (259, "H", [8 if deflate else 1]), (277, "H", [1])]
    tags += [(322, "I", [wide]), (323, "I", [high]), (324, word, places), (325, word, sizes)] if tile else [(273, word, places), (278, "I", [high]), (279, word, sizes)]
    tags += [(317, "H", [2])] if predictor else []
    tags += [(33550, "d", [step, step, 0.0]), (33922, "d", [0.0, 0.0, 0.0, lon, lat, 0.0])]
    body, extra = b"".join(blocks), b""
    at = head + len(body)
    entries, room = b"", struct.calcsize(word)
    after = at + (8 if big else 2) + len(tags) * (20 if big else 12) + room
    codes = {"H": 3, "I": 4, "d": 12, "Q": 16}
    for tag, kind, values in sorted(tags):
        data = struct.pack(f"{order}{len(values)}{kind}", *values)
        if len(data) > room:
            data, extra = struct.pack(order + word, after + len(extra)), extra + data
        entries += struct.pack(f"{order}HH{word}", tag, codes[kind], len(values)) + data.ljust(room, b"\0")
    mark = {"<": b"II", ">": b"MM"}[order]
    start = mark + (struct.pack(order + "HHHQ", 43, 8, 0, at) if big else struct.pack(order + "HI", 42, at))
    return start + body + struct.pack(order + ("Q" if big else "H"), len(tags)) + entries + bytes(room) + extra


@pytest.mark.parametrize("options", [{}, {"tile": 16}, {"tile": 16, "deflate": True, "predictor": True}, {"deflate": True, "big": True}, {"tile": 32, "order": ">"}, {"predictor": True, "big": True, "order": ">"}])
def test_raster_files(spark, tmp_path, options):
    pixels = np.random.default_rng(1).integers(0, 200, (37, 41)).astype(np.uint8)
    (tmp_path / "a.tif").write_bytes(tiff(pixels, 10.0, 50.0, 0.25, **options))
    got = np.zeros_like(pixels)
    for r in raster_files.read_blocks(spark, str(tmp_path / "*.tif")).collect():
        x, y = round((r.lon - 10) / 0.25), round((50 - r.lat) / 0.25)
        got[y : y + r.height, x : x + r.width] = np.frombuffer(r.data, np.uint8).reshape(r.height, r.width)
    assert (got == pixels).all()


def test_other_files_are_errors():
    with pytest.raises(ValueError, match="TIFF"):
        list(raster_files.blocks_of(b"PK\x03\x04 something else"))
    with pytest.raises(ValueError, match="byte"):
        list(raster_files.blocks_of(tiff(np.zeros((4, 4), np.uint8), 0, 0, 1).replace(struct.pack("<HHIHH", 258, 3, 1, 8, 0), struct.pack("<HHIHH", 258, 3, 1, 16, 0))))


def test_files_warped_to_the_grid(spark, tmp_path):
    """Overlapping files, one of them across the antimeridian's and the square's edge, against the relational form over all pixels."""
    rng = np.random.default_rng(2)
    grid, rows = FIXTURE, []
    for k, (lon, lat) in enumerate([(-30.0, 40.0), (-10.0, 35.0), (170.0, 88.0), (-180.0, -60.0)]):
        pixels = rng.choice(np.array([0, 10, 30, 80], np.uint8), (60, 70))
        (tmp_path / f"{k}.tif").write_bytes(tiff(pixels, lon, lat, 0.5, tile=32, deflate=True))
        rows += [(lon + (i + 0.5) * 0.5, lat - (j + 0.5) * 0.5, int(pixels[j, i])) for j in range(60) for i in range(70)]
    want = {(r.x, r.y): r.value for r in resample.warp(spark.createDataFrame(rows, "lon double, lat double, value int"), 2, grid, 0.5, 0.5).collect() if r.value}
    made = warp.warp_blocks(raster_files.read_blocks(spark, str(tmp_path)), 2, grid, 16)
    got = {(r.x, r.y): r.value for r in pipeline.pixels_of(made, 16).collect() if r.value}
    assert got == want and len(want) > 100
    pipeline.load_chunks(made, str(tmp_path / "levels"), grid, 16)
    assert spark.read.parquet(str(tmp_path / "levels")).where("level = 0").count() >= 1


def gathered(pixels, lon, lat, step, z, grid):
    """Pixel by pixel: the mode of the cells whose centres it covers along both axes; along an axis without one, the cell of its middle."""
    size, h, w = grid.size_px(z), *pixels.shape
    k = np.arange(-400, 800)
    on = {"x": np.floor(warp.columns_at(lon + (k + 0.5) * step, z, grid)), "y": np.floor(warp.rows_at(lat - (k + 0.5) * step, z, grid))}
    out = {}
    for y in range(size):
        rows = k[on["y"] == y] if (on["y"] == y).any() else [int(np.floor((lat - warp.lat_of_rows(y + 0.5, z, grid)) / step))]
        rows = [r for r in rows if 0 <= r < h]
        for x in range(size) if rows else ():
            columns = k[on["x"] == x] if (on["x"] == x).any() else [int(np.floor((warp.lon_of_columns(x + 0.5, z, grid) - lon) / step))]
            values = [int(pixels[r, c]) for r in rows for c in columns if 0 <= c < w]
            if values:
                out[x, y] = min(values, key=lambda v: (-values.count(v), v))
    return out


@pytest.mark.parametrize(("lon", "lat", "step"), [(-30.0, 85.5, 0.5), (150.0, -70.0, 0.5), (-20.0, 20.0, 3.0), (0.0, 84.0, 0.2)])
def test_warped_pixels_gather_their_cells(spark, lon, lat, step):
    """Finer and coarser than the source, up to the square's edges: no hole, and both forms equal plain loops."""
    grid, z = Grid(max_level=3, tile_px=32, block_tiles=2), 3
    pixels = np.random.default_rng(4).choice(np.array([10, 20, 30], np.uint8), (40, 50))
    want = gathered(pixels, lon, lat, step, z, grid)
    blocks = [(lon + x * step, lat - y * step, step, step, min(16, 50 - x), min(16, 40 - y), pixels[y : y + 16, x : x + 16].tobytes()) for y in range(0, 40, 16) for x in range(0, 50, 16)]
    made = warp.warp_blocks(spark.createDataFrame(blocks, "lon double, lat double, dlon double, dlat double, width int, height int, data binary"), z, grid, 32)
    assert {(r.x, r.y): r.value for r in pipeline.pixels_of(made, 32).collect() if r.value} == want
    cells = spark.createDataFrame([(lon + (i + 0.5) * step, lat - (j + 0.5) * step, int(pixels[j, i])) for j in range(40) for i in range(50)], "lon double, lat double, value int")
    assert {(r.x, r.y): r.value for r in resample.warp(cells, z, grid, step, step).collect()} == want


def test_no_row_is_missed_at_any_latitude():
    """Tiles of one degree at 1/12,000 of a degree, on the default grid's finest level."""
    grid = Grid()
    for lat in range(-84, 85):
        rows, _ = warp.taken_rows(lat + 1.0, 1 / 12_000, 12_000, grid.max_level, grid)
        edges = warp.rows_at(np.array([lat + 1.0, float(lat)]), grid.max_level, grid)
        assert set(range(max(0, int(np.ceil(edges[0]))), min(grid.size_px(10), int(edges[1])))) <= set(rows.tolist())


def test_sources_that_overlap_count_together(spark):
    grid = Grid(max_level=0, tile_px=4, block_tiles=1)
    block = lambda v: (-180.0, 60.0, 30.0, 30.0, 3, 1, bytes([v]) * 3)
    df = spark.createDataFrame([block(v) for v in (10, 30, 30)], "lon double, lat double, dlon double, dlat double, width int, height int, data binary")
    assert {r.value for r in pipeline.pixels_of(warp.warp_blocks(df, 0, grid, 4), 4).collect() if r.value} == {30}


def with_reduced(pixels, lon, lat, step, tile):
    """A file with its image and two reduced ones, chained."""
    images = [pixels, pixels[::2, ::2], pixels[::4, ::4]]
    out, link = bytearray(), None
    for a in images:
        one = bytearray(tiff(np.ascontiguousarray(a), lon, lat, step, tile=tile, deflate=True))
        start, base = struct.unpack_from("<I", one, 4)[0], len(out)
        (n,) = struct.unpack_from("<H", one, start)
        for k in range(n):  # move what points into the file
            place = start + 2 + 12 * k
            tag, kind, count = struct.unpack_from("<HHI", one, place)
            size = {3: 2, 4: 4, 12: 8}[kind] * count
            at = place + 8 if size <= 4 else struct.unpack_from("<I", one, place + 8)[0]
            if tag == 324:
                struct.pack_into(f"<{count}I", one, at, *(v + base for v in struct.unpack_from(f"<{count}I", one, at)))
            if size > 4:
                struct.pack_into("<I", one, place + 8, at + base)
        if link is not None:
            struct.pack_into("<I", out, link, start + base)
        out += one
        link = base + start + 2 + 12 * n
    return bytes(out)


def test_a_window_reads_its_blocks_only(spark, tmp_path, monkeypatch):
    pixels = np.random.default_rng(6).integers(0, 250, (512, 512)).astype(np.uint8)
    paths = [f"{tmp_path}/{k}.tif" for k in range(3)]
    for k, path in enumerate(paths):
        with open(path, "wb") as f:
            f.write(with_reduced(pixels, 10.0 + 64 * k, 50.0, 0.125, 64))
    df = raster_files.read_windows(spark, paths, 1 << 14)
    assert {(r.level, r.n) for r in df.groupBy("level").count().withColumnRenamed("count", "n").collect()} == {(0, 192), (1, 48), (2, 12)}
    some = raster_files.window(df, 20.0, 30.0, 29.0, 37.0)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan raster" in plan and "29.0" not in plan and "37.0" not in plan  # the reader has taken the comparisons
    got = some.collect()
    want = {(x, y) for y in range(0, 512, 64) for x in range(0, 512, 64) if 10 + x / 8 < 29 and 10 + (x + 64) / 8 > 20 and 50 - (y + 64) / 8 < 37 and 50 - y / 8 > 30}
    assert {(round((r.lon - 10) * 8), round((50 - r.lat) * 8)) for r in got} == want and len(got) == len(want) == 4
    for r in got:
        x, y = round((r.lon - 10) * 8), round((50 - r.lat) * 8)
        assert r.data == pixels[y : y + 64, x : x + 64].tobytes()
    coarse = raster_files.window(df, -180.0, -90.0, 180.0, 90.0, level=2)
    assert {(r.width, r.dlon) for r in coarse.collect()} == {(64, 0.5)}

    # the same by the reader itself, counting bytes: directories for the plan, then the blocks' own bytes
    read, real = [], raster_files.open_ranges
    monkeypatch.setattr(raster_files, "open_ranges", lambda path: (lambda at, n, one=real(path): read.append(n) or one(at, n)))
    from pyspark.sql.datasource import EqualTo, GreaterThan, LessThan, StringContains

    reader = raster_files.RasterReader(paths, 1 << 14)
    left = list(reader.pushFilters([EqualTo(("level",), 0), LessThan(("west",), 29.0), GreaterThan(("east",), 20.0), LessThan(("south",), 37.0), GreaterThan(("north",), 30.0), StringContains(("path",), "tif")]))
    assert [type(f) for f in left] == [StringContains]
    parts = reader.partitions()
    planned = sum(read)
    assert planned <= 3 * (raster_files.FRONT_BYTES + 20_000) and {p.path for p in parts} == {paths[0]}
    read.clear()
    assert len([row for p in parts for row in reader.read(p)]) == 4
    assert sum(read) == sum(b.size for p in parts for b in p.blocks) < sum(len(open(p, "rb").read()) for p in paths) / 20


def test_no_block_in_the_window(spark, tmp_path):
    (tmp_path / "a.tif").write_bytes(tiff(np.ones((8, 8), np.uint8), 0.0, 10.0, 1.0))
    df = raster_files.read_windows(spark, [f"{tmp_path}/a.tif"])
    assert raster_files.window(df, 100.0, 0.0, 110.0, 10.0).count() == 0 and raster_files.window(df, 0.0, 9.0, 1.0, 10.0).count() == 1


def test_download_then_build(spark, tmp_path):
    """From a list of files to tiles: what the levels hold is what warping whole files gives."""
    rng, grid = np.random.default_rng(7), FIXTURE
    (tmp_path / "store" / "map").mkdir(parents=True)
    keys = []
    for name, lon, lat in (("N00E000", 0.0, 3.0), ("N48W120", -120.0, 51.0), ("S03E003", 3.0, 0.0)):
        keys.append((f"map/tile_{name}_v2.tif",))
        (tmp_path / "store" / keys[-1][0]).write_bytes(tiff(np.kron(rng.choice(np.array([10, 30, 80], np.uint8), (6, 6)), np.ones((8, 8), np.uint8)), lon, lat, 0.0625, tile=16, deflate=True))
    cells = pipeline.download(spark, spark.createDataFrame(keys + keys[:1], "key string"), str(tmp_path / "store"), str(tmp_path / "out"), grid, 16)
    assert {tuple(r) for r in cells.collect()} == {(0, 0), (48, -120), (-3, 3)}
    want = warp.warp_blocks(raster_files.read_blocks(spark, f"{tmp_path}/store/map/*.tif"), 2, grid, 16)
    levels = spark.read.parquet(f"{tmp_path}/out/levels")
    top = levels.where("level = 2").select("cx", "cy", "data")
    assert sorted(map(repr, top.collect())) == sorted(map(repr, want.collect())) and top.count() > 0
    assert pipeline.build(spark, f"{tmp_path}/out/levels", cells, f"{tmp_path}/tiles", grid, chunk=16).count() >= 0


def pack_tiles(spark, n=60):
    rows = [(z, x, y, f"{z}/{x}/{y}".encode() * (x + 1)) for z in range(4) for x in range(1 << z) for y in range(1 << z)][:n]
    return spark.createDataFrame(rows, packs.TILES).repartition(3), {r[:3]: r[3] for r in rows}


def test_a_pack_answers_single_tiles(spark, tmp_path, monkeypatch):
    df, want = pack_tiles(spark)
    packs.write_pack(df, f"{tmp_path}/out", {"name": "classes", "minzoom": 0}, 5)
    back, about = packs.read_pack(spark, f"{tmp_path}/out")
    assert {(r.z, r.tx, r.ty): bytes(r.data) for r in back.collect()} == want and about == {"name": "classes", "minzoom": 0}
    pack, read, real = packs.Pack(f"file://{tmp_path}/out"), [], packs.Pack.ranges
    assert len(pack.files) > 1
    monkeypatch.setattr(packs.Pack, "ranges", lambda self, file: (lambda at, n, one=real(self, file): read.append(n) or one(at, n)))
    for (z, x, y), data in want.items():
        read.clear()
        assert pack.tile(z, x, y) == data and len(read) == 2 and read[1] == len(data)
    read.clear()
    assert pack.tile(3, 7, 7) is None and pack.tile(9, 0, 0) is None and pack.tile(-1, 0, 0) is None and len(read) <= 1


def test_a_pack_is_whole_or_not_there(spark, tmp_path):
    df, want = pack_tiles(spark)
    bad = df.unionByName(spark.createDataFrame([(0, 0, 0, b"again")], packs.TILES))
    with pytest.raises(Exception, match="two tiles"):
        packs.write_pack(bad, f"{tmp_path}/out", {}, 3)
    assert not list((tmp_path / "out").glob("*")) if (tmp_path / "out").exists() else True
    packs.write_pack(df, f"{tmp_path}/out", {"run": 1}, 3)
    with pytest.raises(Exception, match="two tiles"):
        packs.write_pack(bad, f"{tmp_path}/out", {"run": 2}, 3)
    assert packs.read_pack(spark, f"{tmp_path}/out")[1] == {"run": 1} and packs.read_pack(spark, f"{tmp_path}/out")[0].count() == len(want)
    packs.write_pack(df.where("z < 2"), f"{tmp_path}/out", {"run": 3}, 3)
    back, about = packs.read_pack(spark, f"{tmp_path}/out")
    assert back.count() == 5 and about == {"run": 3} and len(list((tmp_path / "out").glob("*.tiles"))) == len(packs.Pack(f"{tmp_path}/out").files)
    packs.write_pack(df.where("false"), f"{tmp_path}/none", {}, 3)
    assert packs.read_pack(spark, f"{tmp_path}/none")[0].count() == 0
