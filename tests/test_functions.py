"""Golden values of scalar functions, grids and listings."""

import pytest
from pyspark.sql import functions as F

from rasterloom.functions import geo, geometry, text
from rasterloom.operators import grid
from rasterloom.plans.settings import LEGEND, WORLD, Grid
from rasterloom.sources import legend, listing, sinks

G = Grid()


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], schema).select(column).collect()]


def test_derived_settings():
    assert (G.sieve_px, G.margin_px, G.block_px) == (28, 25, 8192)
    assert G.kernel() == [64, 61, 51, 39, 26, 16, 9, 4, 2, 1]
    assert [G.blocks(z) ** 2 for z in range(11)] == [1, 1, 1, 1, 4, 16, 64, 256, 1024, 4096, 16384]
    assert Grid(blur_radius=2).params_hash() != G.params_hash()


def test_duration(spark):
    said = values(spark, text.duration(F.col("s")), [float("inf"), -1.0, 5.4, 65.0, 3725.0, None, 0.5, 3599.6], "s double")
    assert said == ["--", "--", "5s", "1m05s", "1h02m", "--", "1s", "1h00m"]


def test_colour(spark):
    said = values(spark, text.colour(F.col("c")), ["#66AA44", "#FFFFFF", "#00000080"], "c string")
    assert said[0] == "102,170,68,255,rgb:0.4,0.6666666666666666,0.26666666666666666,1"
    assert said[1] == "255,255,255,255,rgb:1,1,1,1"
    assert said[2].startswith("0,0,0,128,rgb:0,0,0,")


def test_small_text_functions(spark):
    assert values(spark, text.percent(F.lit(0), F.col("n")), [0, 10], "n int") == [100, 0]
    assert values(spark, text.bar(F.col("f"), 4), [0.0, 0.5, 1.0], "f double") == ["░░░░", "██░░", "████"]
    assert values(spark, text.plural(F.col("n"), "entr"), [1, 2], "n int") == ["1 entry", "2 entries"]
    assert values(spark, text.band_letter(F.col("n")), [0, 11], "n int") == ["A", "L"]
    assert values(spark, text.base_name(F.col("p")), ["a/b/c.tif", "c"], "p string") == ["c.tif", "c"]
    assert values(spark, text.dir_name(F.col("p")), ["a/b/c.tif"], "p string") == ["a/b"]
    assert values(spark, text.buckets_of(F.col("j")), ['{"bands":[{"histogram":{"buckets":[1,2]}}]}', "{}", None], "j string") == [[1, 2], [], []]
    assert values(spark, text.iso_millis(F.col("t").cast("timestamp")), ["2024-01-02 03:04:05.6789"], "t string") == ["2024-01-02T03:04:05.678Z"]


def test_projection_round_trip(spark):
    assert geometry.lonlat(0, WORLD / 2)[1] == pytest.approx(85.0511287798066, abs=1e-12)
    for lon, lat in ((0, 0), (12.5, 51.2), (-77, -33.3)):
        assert geometry.lonlat(*geometry.mercator(lon, lat)) == pytest.approx((lon, lat))
    back = values(spark, geo.lat_of(geo.y_of(F.col("d"))), [51.2, -80.0], "d double")
    assert back == pytest.approx([51.2, -80.0])


WINDOWS = {
    (4, 0, 0): ((-20037508.343, -61149.623, 61149.623, 20037508.343), 8217, (-180, 0, 0, 85.051129)),
    (4, 1, 1): ((-61149.623, -20037508.343, 20037508.343, 61149.623), 8217, (0, -85.051129, 180, 0)),
    (5, 1, 2): ((-10049328.983, -10049328.983, 30574.811, 30574.811), 8242, (-90, -66.51326, 0, 0)),
    (10, 64, 40): ((-955.463, 7200024.098, 314041.531, 7515021.091), 8242, (0, 54.162434, 2.8125, 55.776573)),
    (2, 0, 0): ((-20037508.343, -20037508.343, 20037508.343, 20037508.343), 4096, (-180, -85.051129, 180, 85.051129)),
}


def test_block_windows(spark):
    rows = grid.block_windows(spark.createDataFrame(list(WINDOWS), "z int, bx int, by int"), G).collect()
    for r in rows:
        window, size, box = WINDOWS[r.z, r.bx, r.by]
        assert (r.win_minx, r.win_miny, r.win_maxx, r.win_maxy) == pytest.approx(window, abs=1e-3)
        assert (r.px_width, r.px_height) == (size, size)
        assert (r.west, r.south, r.east, r.north) == pytest.approx(box, abs=1e-6)
    nested = spark.createDataFrame([(5, 1, 2)], "z int, bx int, by int").select(geo.window_struct(F.col("z"), F.col("bx"), F.col("by"), G).alias("w")).select("w.size.width", "w.inner.maxx").first()
    assert tuple(nested) == (8242, 0.0)


def test_neighbouring_blocks_share_edges(spark):
    rows = {(r.z, r.bx, r.by): r for r in grid.block_windows(grid.block_grid(spark, Grid(max_level=6)), G).collect()}
    assert len(rows) == 88
    for (z, x, y), r in rows.items():
        if (z, x + 1, y) in rows:
            assert r.maxx == rows[z, x + 1, y].minx
        if (z, x, y + 1) in rows:
            assert r.miny == rows[z, x, y + 1].maxy


def test_corners_and_cells(spark):
    names = ["x_N51E009_Map.tif", "x_S03W078_Map.tif", "x_N00E000_Map.tif", "x_S00W000_Map.tif", "readme.txt", "x_S03W077_Map.tif"]
    df = spark.createDataFrame([(n,) for n in names], "key string")
    assert {tuple(r) for r in listing.corners(df).select("lat", "lon").collect()} == {(51, 9), (-3, -78), (0, 0), (-3, -77)}
    assert listing.occupied_cells(df).count() == 4


def test_cell_overlap(spark):
    boxes = [(1, 51.0, 54.0, 9.0, 12.0), (2, 50.9, 54.1, 9.0, 12.0), (3, -1.0, 4.0, 8.9, 12.0)]
    rows = grid.covered_cells(spark.createDataFrame(boxes, "id int, south double, north double, west double, east double")).collect()
    got = {i: {(r.lat, r.lon) for r in rows if r.id == i} for i in (1, 2, 3)}
    assert got == {1: {(51, 9)}, 2: {(48, 9), (51, 9), (54, 9)}, 3: {(-3, 6), (-3, 9), (0, 6), (0, 9), (3, 6), (3, 9)}}


def test_listing_pages(spark, tmp_path):
    first = "<R><Key>a/1.tif</Key><Key>a/2.tif</Key><Key>a/n.txt</Key><IsTruncated>true</IsTruncated><NextContinuationToken>T1</NextContinuationToken></R>"
    second = "<R><Key>a/3.tif</Key><IsTruncated>false</IsTruncated><NextContinuationToken>T2</NextContinuationToken></R>"
    assert list(listing.pages(lambda token: (200, second if token else first))) == [first, second]
    with pytest.raises(OSError):
        list(listing.pages(lambda token: (503, "")))
    for i, page in enumerate((first, second)):
        (tmp_path / f"{i}.xml").write_text(page)
    pages = listing.read_pages(spark, str(tmp_path))
    assert sorted(r[0] for r in pages.select(F.explode(listing.keys_of(F.col("xml")))).collect()) == ["a/1.tif", "a/2.tif", "a/3.tif"]
    assert {r[0] for r in pages.select(listing.next_token(F.col("xml"))).collect()} == {"T1", None}


def test_empty_list_is_an_error(spark, tmp_path):
    (tmp_path / "list.txt").write_text("\n \n")
    with pytest.raises(ValueError):
        listing.read_list(spark, str(tmp_path / "list.txt"))


def test_legend_counts(spark):
    zooms = grid.zooms(spark, G)
    active = {r.z: r.n for r in legend.active_channels(spark, zooms).groupBy("z").agg(F.count("*").alias("n")).collect()}
    assert [active[z] for z in range(11)] == [11] * 4 + [9] * 3 + [8] * 3 + [4]
    codes = {z: {r.code for r in legend.nodata_codes(spark, zooms).where(F.col("z") == z).collect()} for z in (3, 5, 10)}
    assert codes == {3: {0}, 5: {0, 70, 80}, 10: {0, 10, 70, 80, 40, 50, 60, 100}}
    assert all((layer is None) == (kind is None) for _, _, layer, kind, _, _ in LEGEND)


def test_style_and_clean(spark, tmp_path):
    sinks.write_style(spark, str(tmp_path / "style.qml"))
    sheet = (tmp_path / "style.qml").read_text()
    assert sheet.count("<style ") == 11 and "102,170,68,255,rgb:0.4" in sheet
    (tmp_path / "keep").mkdir()
    (tmp_path / "gone").mkdir()
    assert sinks.clean(str(tmp_path), ["gone", "missing"]) == ["gone"]
    assert (tmp_path / "keep").exists() and (tmp_path / "style.qml").exists()
    with pytest.raises(ValueError):
        sinks.clean(str(tmp_path), ["../x"])


def test_atomic_leaves_nothing_behind(tmp_path):
    def fail(path):
        open(path, "w").write("half")
        raise RuntimeError

    with pytest.raises(RuntimeError):
        sinks.atomic(str(tmp_path / "out"), fail)
    assert list(tmp_path.iterdir()) == []


def test_wkb_round_trip():
    shape = [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)], [(1.0, 0.5), (2.0, 1.0), (2.0, 0.5)]], [[(9.0, 9.0), (10.0, 9.0), (10.0, 10.0)]]]
    assert geometry.from_wkb(geometry.wkb(shape)) == shape


def test_clip():
    square = [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]]
    assert geometry.polygon_area(geometry.clip(square, 5, 5, 20, 20)) == 25
    assert geometry.clip(square, 11, 11, 20, 20) == []
