"""Rasters, classification, regions, fragments and tiles: goldens and properties over seeded rasters."""

import gzip
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import geometry, mvt
from rasterloom.operators import classify, fragments, progress, regions, resample, seams, tiles
from rasterloom.plans import pipeline
from rasterloom.plans.settings import FIXTURE, Grid
from rasterloom.sources import sinks

CODES = np.array([0, 10, 20, 30, 40, 50, 80, 95], np.uint8)


def blobs(seed, size=40, classes=5):
    """A seeded raster of blobs and specks."""
    rng = np.random.default_rng(seed)
    coarse = rng.integers(0, classes, (size // 5 + 1, size // 5 + 1))
    a = np.kron(coarse, np.ones((5, 5), int))[:size, :size]
    specks = rng.random((size, size)) < 0.1
    a[specks] = rng.integers(0, classes, specks.sum())
    return CODES[a]


def flood(a):
    """Region ids by plain flood fill."""
    out = np.full(a.shape, -1)
    h, w = a.shape
    for y in range(h):
        for x in range(w):
            if out[y, x] < 0:
                stack, out[y, x] = [(y, x)], y * w + x
                while stack:
                    v, u = stack.pop()
                    for q, p in ((v + 1, u), (v - 1, u), (v, u + 1), (v, u - 1)):
                        if 0 <= q < h and 0 <= p < w and out[q, p] < 0 and a[q, p] == a[v, u]:
                            out[q, p] = y * w + x
                            stack.append((q, p))
    return out


def rows_of(spark, a, **extra):
    y, x = np.mgrid[: a.shape[0], : a.shape[1]]
    data = list(zip(x.ravel().tolist(), y.ravel().tolist(), a.ravel().tolist(), strict=True))
    return spark.createDataFrame(data, "x int, y int, value int")


def test_mode_and_ties(spark):
    df = spark.createDataFrame([(0, 0, v) for v in (3, 1, 1, 3, 2)], "x int, y int, value int")
    assert resample.resample(df, F.col("x"), F.col("y")).first().value == 1


def test_mode_of_modes_differs_from_direct_mode(spark):
    a = np.array([[1, 1, 2, 2], [1, 2, 2, 2], [1, 1, 1, 1], [2, 2, 1, 2]])
    df = rows_of(spark, a)
    assert resample.pyramid(df, 2).where("level = 0").first().value == 1
    assert resample.pyramid_direct(df, 2).where("level = 0").first().value == 1
    assert resample.pyramid(df, 2).where("level = 1").count() == 4


def test_argmax_ties_go_to_the_lowest(spark):
    df = spark.createDataFrame([(0, 0, 1, 5), (0, 0, 2, 9), (0, 0, 3, 9)], "x int, y int, channel int, score int")
    assert classify.argmax(df).first().channel == 2


@pytest.mark.parametrize("seed", [1, 2])
def test_relational_and_array_classification_agree(spark, seed):
    a = blobs(seed, 24)
    got = np.zeros(a.shape, int)
    for r in classify.classify(rows_of(spark, a), 2, 24, 24, FIXTURE).collect():
        got[r.y, r.x] = r.channel
    assert (got == classify.classify_array(a, 2, FIXTURE)).all()
    assert (got == classify.classify_array(a, 2, FIXTURE, prune=False)).all()


BRANCHES = [([30], 9, "uniform"), ([10], 8, "empty"), ([0], 3, "empty"), ([0, 30], 3, "full"), ([20, 30], 3, "full"), ([255], 3, "empty")]


def test_branches(spark):
    df = spark.createDataFrame([(i, p, z) for i, (p, z, _) in enumerate(BRANCHES)], "i int, present array<int>, z int")
    got = {r.i: r.branch for r in classify.branch(df, F.col("z")).collect()}
    assert [got[i] for i in range(len(BRANCHES))] == [b for _, _, b in BRANCHES]


@pytest.mark.parametrize("seed", range(4))
def test_labels(seed):
    a = blobs(seed)
    assert (regions.label(a) == flood(a)).all()


def test_diagonals_do_not_touch():
    a = np.array([[1, 0], [0, 1]])
    assert len(np.unique(regions.label(a))) == 4


def test_sieve_threshold_is_strict():
    a = np.zeros((40, 40), int)
    a[5:8, 5:14] = 1  # 27 pixels
    a[20:24, 5:12] = 2  # 28 pixels
    out = regions.sieve(a, 28)
    assert (out == 1).sum() == 0 and (out == 2).sum() == 28


@pytest.mark.parametrize("seed", range(3))
def test_sieve_leaves_no_small_region(seed):
    out = regions.sieve(blobs(seed), 28)
    _, n = regions.sizes_of(regions.label(out))
    assert (n >= 28).all()


def plain_sieve(a, threshold):
    """One region at a time, smallest and first in front, everything labelled anew after each."""
    a = a.copy()
    while True:
        ids = flood(a)
        names, n = np.unique(ids, return_counts=True)
        small = sorted((int(k), int(r)) for r, k in zip(names, n, strict=True) if k < threshold)
        if not small or len(names) == 1:
            return a
        size = dict(zip(names.tolist(), n.tolist(), strict=True))
        mine = ids == small[0][1]
        around = np.zeros_like(mine)
        around[1:] |= mine[:-1]
        around[:-1] |= mine[1:]
        around[:, 1:] |= mine[:, :-1]
        around[:, :-1] |= mine[:, 1:]
        target = min(set(ids[around & ~mine].tolist()), key=lambda r: (-size[r], r))
        a[mine] = a[ids == target][0]


@pytest.mark.parametrize("seed", range(6))
def test_sieve_equals_one_region_at_a_time(seed):
    rng = np.random.default_rng(seed)
    for a in (blobs(seed, 24), rng.integers(0, 4, (16, 16)), rng.integers(0, 2, (20, 9))):
        assert (regions.sieve(a, 28) == plain_sieve(a, 28)).all()


@pytest.mark.parametrize("seed", range(3))
def test_sieve_ends_in_speckle(seed):
    """Regions that are each other's largest neighbour don't swap classes for ever."""
    y, x = np.mgrid[:40, :40]
    for a in ((x + y) % 2 + 1, np.random.default_rng(seed).integers(0, 5, (40, 40)), np.array([[1, 2]])):
        out = regions.sieve(a, 28)
        _, n = regions.sizes_of(regions.label(out))
        assert out.dtype == a.dtype and (len(n) == 1 or (n >= 28).all())


@pytest.mark.parametrize("seed", range(4))
def test_polygons_cover_without_gaps(seed):
    a = blobs(seed)
    labels = regions.label(a)
    ids, n = regions.sizes_of(labels)
    found = regions.polygonize(labels)
    assert {r: sum(map(regions.area2, rings)) // 2 for r, rings in found.items()} == dict(zip(ids.tolist(), n.tolist(), strict=True))
    assert all(sum(regions.area2(ring) > 0 for ring in rings) == 1 for rings in found.values())


def test_hole():
    a = np.zeros((5, 5), int)
    a[1:4, 1:4] = 1
    a[2, 2] = 0
    found = regions.polygonize(regions.label(a))
    assert sorted(len(r) for r in found.values()) == [1, 2, 2]


@pytest.mark.parametrize("seed", range(4))
def test_simplified_coverage_keeps_area_and_edge(seed):
    labels = regions.label(regions.sieve(blobs(seed), 28))
    before = regions.polygonize(labels)
    after = regions.simplify_coverage(labels, 1.5)
    assert sum(sum(map(regions.area2, r)) for r in after.values()) == 2 * labels.size
    assert sum(len(x) for r in after.values() for x in r) < sum(len(x) for r in before.values() for x in r)
    segments = {}
    for rings in after.values():
        for ring in rings:
            for p, q in zip(ring, ring[1:] + ring[:1], strict=True):
                segments[p, q] = segments.get((p, q), 0) + 1
    h, w = labels.shape
    for p, q in segments:  # each edge has its twin, but for the window's edge
        assert (q, p) in segments or p[0] == q[0] and p[0] in (0, w) or p[1] == q[1] and p[1] in (0, h)


def crossings(segments):
    """Pairs of segments that meet in another place than a common end."""
    def side(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    def within(p, q, r):
        return min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])

    found = 0
    for i, (p, q) in enumerate(segments):
        for r, s in segments[:i]:
            a, b, c, d = side(p, q, r), side(p, q, s), side(r, s, p), side(r, s, q)
            if a * b < 0 and c * d < 0:
                found += 1
            found += any(z == 0 and within(*line, t) and t not in line for z, line, t in ((a, (p, q), r), (b, (p, q), s), (c, (r, s), p), (d, (r, s), q)))
    return found


@pytest.mark.parametrize("seed", range(6))
def test_simplified_borders_do_not_cross(seed):
    """Noise, blobs, thin spirals and nested rings, at tolerances far above a pixel."""
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[:24, :24]
    for a in (rng.integers(0, 3, (24, 24)), blobs(seed, 24), (np.hypot(x - 12, y - 12) + seed).astype(int) % 2, ((x + seed) // 2 + y // 5) % 2 * 2 + (x * y % 7 == 0)):
        labels = regions.label(a)
        before = regions.polygonize(labels)
        for tolerance in (1.5, 4, 50):
            after = regions.simplify_coverage(labels, tolerance)
            edges = {tuple(sorted((p, q))) for rings in after.values() for ring in rings for p, q in zip(ring, ring[1:] + ring[:1], strict=True)}
            assert crossings(sorted(edges)) == 0
            assert all(len(ring) >= 3 and regions.area2(ring) for rings in after.values() for ring in rings)
            assert [[regions.area2(r) > 0 for r in rings] for rings in after.values()] == [[regions.area2(r) > 0 for r in rings] for rings in before.values()]
            assert sum(sum(map(regions.area2, r)) for r in after.values()) == 2 * labels.size


@pytest.mark.parametrize("seed", range(3))
def test_rings_equal_edges_one_by_one(seed):
    """Each unit edge between unlike pixels belongs to one ring of each side."""
    labels = regions.label(np.random.default_rng(seed).integers(0, 3, (13, 17)))
    h, w = labels.shape
    want = set()
    for v in range(h):
        for u in range(w):
            around = (((u, v), (u + 1, v), v - 1, u), ((u + 1, v), (u + 1, v + 1), v, u + 1), ((u + 1, v + 1), (u, v + 1), v + 1, u), ((u, v + 1), (u, v), v, u - 1))
            want |= {(labels[v, u], p, q) for p, q, j, i in around if not (0 <= j < h and 0 <= i < w) or labels[j, i] != labels[v, u]}
    got = [(r, p, q) for r, rings in regions.polygonize(labels).items() for ring in rings for p, q in zip(ring, ring[1:] + ring[:1], strict=True)]
    assert len(got) == len(want) and set(got) == want


def test_uniform_block_equals_its_rectangle():
    grid = Grid(max_level=2, tile_px=16, block_tiles=2)
    records = fragments.process_window(np.full((57, 57), 30, np.uint8), 2, 0, 0, grid)
    assert [r["record_type"] for r in records] == ["fragment", "log"] and records[1]["branch"] == "uniform"
    ((ring,),) = geometry.from_wkb(records[0]["geom"])
    assert len(ring) == 4 and ring[0] == pytest.approx((-180, 0)) and ring[2][0] == pytest.approx(0)
    full = fragments.block_polygons(np.full((57, 57), 30, np.uint8), 2, 0, 0, grid)
    assert [c for c, _ in full] == [7] and sum(map(regions.area2, full[0][1])) == 2 * 32 * 32


def test_ocean_is_not_filled_by_a_single_class():
    values = np.zeros((57, 57), np.uint8)
    values[:, 30:] = 30
    assert fragments.process_window(values, 2, 0, 0, FIXTURE)[-1]["branch"] == "full"


def test_halo_matches_windows(spark):
    a = blobs(3, 64)
    got = {}
    for r in resample.with_halo(rows_of(spark, a), 2, FIXTURE).collect():
        got.setdefault((r.bx, r.by), set()).add((r.x, r.y))
    for (bx, by), pixels in got.items():
        x0, y0, x1, y1 = fragments.window_box(2, bx, by, FIXTURE)
        assert pixels == {(x, y) for x in range(x0, x1) for y in range(y0, y1)}


def test_later_part_of_a_mosaic_wins(spark):
    one = spark.createDataFrame([(0, 0, 9), (1, 0, 9)], "x int, y int, value int")
    two = spark.createDataFrame([(1, 0, 3)], "x int, y int, value int")
    assert sorted(map(tuple, resample.mosaic([one, two]).collect())) == [(0, 0, 9), (1, 0, 3)]


def test_coalesce_keeps_everything(spark):
    def square(x, n):
        return geometry.wkb([[[(x, 0.0), (x + n, 0.0), (x + n, n), (x, n)]]])

    rows = [(0, 0, 0, "land", "forest", square(float(i * 10), float(i + 1))) for i in range(8)] + [(0, 0, 0, "land", "scrub", square(100.0, 1.0)), (1, 0, 0, "land", "forest", square(0.0, 1.0))]
    out = tiles.coalesce_smallest(spark.createDataFrame(rows, tiles.TILE), 200).collect()
    parts = [p for r in out for p in geometry.from_wkb(r.geom)]
    assert len(parts) == 10 and len(out) < 10
    assert sum(map(geometry.polygon_area, parts)) == sum((i + 1) ** 2 for i in range(8)) + 2


@pytest.mark.parametrize("budget", [60, 400, 2000])
def test_a_byte_budget_is_met(spark, budget):
    """200 features of a shared grid of wavy borders, ten times over budget; neighbours still share their borders."""
    wave = lambda i, j: (float(i * 100 + j * 7 % 13), float(j * 20 + i * 5 % 11))
    rows = []
    for i in range(20):
        for j in range(10):
            ring = [wave(i, 5 * j + k) for k in range(6)] + [wave(i + 1, 5 * j + k) for k in range(5, -1, -1)]
            rows.append((3, 1, 2, "land", ("forest", "scrub", "heath")[(i + j) % 3], geometry.wkb([[ring]])))
    df = spark.createDataFrame(rows, tiles.TILE)
    made = tiles.coalesce_smallest(df, budget)
    encoded = tiles.encode_tiles(made).collect()
    assert all(len(r.data) <= budget for r in encoded) and (encoded or budget == 60)
    parts = [p for r in made.collect() for p in geometry.from_wkb(r.geom)]
    whole = sum(geometry.polygon_area(p) for r in rows for p in geometry.from_wkb(r[5]))
    if budget == 2000:
        assert sum(map(geometry.polygon_area, parts)) == pytest.approx(whole, rel=0.1)


def squares(kinds):
    """A coverage of 10 x 10 squares: features (layer, kind, polygons), a square each."""
    out = []
    for j, row in enumerate(kinds):
        for i, kind in enumerate(row):
            x, y = float(i * 10), float(j * 10)
            out.append(("land", kind, [[[(x, y), (x + 10, y), (x + 10, y + 10), (x, y + 10)]]]))
    return out


def covered(rows):
    """Which half-unit points each feature covers, by the even-odd rule, over 40 x 40."""
    out = {}
    for n, (_, _, polygons) in enumerate(rows):
        for rings in polygons:
            for j in range(4):
                for i in range(4):
                    x, y = i * 10 + 5, j * 10 + 5
                    crossed = sum((p[1] > y) != (q[1] > y) and x < p[0] + (y - p[1]) * (q[0] - p[0]) / (q[1] - p[1]) for ring in rings for p, q in zip(ring, ring[1:] + ring[:1], strict=True))
                    if crossed % 2:
                        out.setdefault((i, j), []).append(n)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_dissolved_squares_still_cover_all(seed):
    """Whatever the order, every square stays covered once, and areas are those of the squares that went in."""
    rng = np.random.default_rng(seed)
    faces = tiles.Faces(squares(rng.choice(["a", "b", "c"], (4, 4)).tolist()))
    for left in range(15, 0, -1):
        assert faces.dissolve_smallest() >= 2
        rows = faces.rows()
        cover = covered(rows)
        assert len(rows) == left and set(cover) == {(i, j) for i in range(4) for j in range(4)} and all(len(v) == 1 for v in cover.values())
        held = [sum(map(geometry.polygon_area, polygons)) for _, _, polygons in rows]
        assert held == [100.0 * sum(v == [n] for v in cover.values()) for n in range(left)]
    assert faces.dissolve_smallest() is None


def test_the_smallest_goes_to_its_longest_border():
    ring = lambda *p: [[list(map(lambda c: (float(c[0]), float(c[1])), p))]]
    left, right = ring((0, 0), (10, 0), (10, 2), (10, 9), (10, 10), (0, 10)), ring((10, 0), (30, 0), (30, 10), (10, 10), (10, 9), (12, 9), (12, 2), (10, 2))
    speck, apart = ring((10, 2), (12, 2), (12, 9), (10, 9)), ring((50, 50), (51, 50), (51, 51), (50, 51))
    faces = tiles.Faces([("land", "a", left), ("land", "b", right), ("land", "c", speck), ("land", "d", apart), ("water_polygons", "w", speck)])
    assert faces.dissolve_smallest() == 6  # 11 units of border on the right, 7 on the left
    got = {(layer, kind): sum(map(geometry.polygon_area, p)) for layer, kind, p in faces.rows()}
    assert got == {("land", "a"): 100.0, ("land", "b"): 200.0, ("land", "d"): 1.0, ("water_polygons", "w"): 14.0}


def test_an_over_full_coverage_loses_no_area(spark):
    """A ragged coverage with holes, cut from regions, far over budget."""
    found = regions.simplify_coverage(regions.label(blobs(3, 60)), 1.0)
    features = [("land", ("forest", "scrub", "heath")[r % 3], [[[(float(x), float(y)) for x, y in ring] for ring in rings] for rings in fragments.polygons_of(rings_)]) for r, rings_ in found.items()]
    full = len(mvt.encode(features, 4096))
    for budget in (full - 1, full // 2, full // 8):
        rows = tiles.within_budget(features, budget, 4096)
        assert len(mvt.encode(rows, 4096)) <= budget and len(rows) < len(features)
        assert sum(geometry.polygon_area(p) for f in rows for p in f[2]) == pytest.approx(3600.0, abs=1e-6)


def test_shared_zoom_is_an_error(spark):
    t = spark.createDataFrame([(1, 0, 0, "land", "forest", b"")], tiles.TILE)
    with pytest.raises(ValueError):
        tiles.zoom_union([t, t])
    assert tiles.merge_features(t, t).count() == 2


def ring_rates(rows, start):
    """A ring of 64 samples that begins with (start, 0), fed one row at a time."""
    ring, done, out = [(start, 0)], 0, []
    for t, n in rows:
        done += n
        ring = [*ring, (t, done)][-64:]
        span, elapsed = (ring[-1][0] - ring[0][0]) / 1000, (t - start) / 1000
        out.append((ring[-1][1] - ring[0][1]) / span if span > 0 else done / elapsed if elapsed > 0 else 0.0)
    return out


def test_sliding_rate(spark):
    rng = np.random.default_rng(7)
    rows = [(int(t), int(n)) for t, n in zip(1000 + np.cumsum(rng.integers(0, 900, 150) * rng.integers(0, 2, 150)), rng.integers(0, 5, 150), strict=True)]
    log = spark.createDataFrame([(i, t, n) for i, (t, n) in enumerate(rows)], "seq long, t_ms long, n long")
    for width, start in ((1 << 16, None), (7, None), (50, 0)):
        got = [r.rate for r in progress.sliding_rate(log, width=width, start_ms=start).orderBy("seq").collect()]
        assert got == pytest.approx(ring_rates(rows, rows[0][0] if start is None else start))
    steady = spark.createDataFrame([(i, i * 1000, 1) for i in range(1, 101)], "seq long, t_ms long, n long")
    assert {r.rate for r in progress.sliding_rate(steady, start_ms=0).collect()} == {1.0}
    same = spark.createDataFrame([(1, 5, 50)], "seq long, t_ms long, n long")
    assert progress.sliding_rate(same).first().rate == 0.0
    assert progress.with_eta(progress.sliding_rate(same), F.lit(100)).first().eta_text == "--"
    lines = [r.pct for r in progress.percent_lines(steady, F.lit(100), width=10).orderBy("seq").collect()]
    assert lines == sorted({int(i / 100 * 100) for i in range(1, 101)} - {0})


def test_progress_of_a_running_job(spark):
    out, at = io.StringIO(), [0.0]
    bar = progress.Progress(200, "blocks", out, lambda: at[0])
    for k in range(200):
        at[0] += 0.5
        bar.set_label("zoom 1" if k >= 100 else "blocks")
        bar.tick()
    bar.done()
    lines = out.getvalue().splitlines()
    assert lines[0] == "blocks   0% 0/200 (0.0/s, ETA --)" and lines[1] == "blocks   1% 2/200 (2.0/s, ETA 1m39s)"
    assert len(lines) == 102 and lines[-1].startswith("zoom 1 100% 200/200")
    counter, bar = spark.sparkContext.accumulator(0), progress.Progress(8, out=io.StringIO())
    with bar.following(lambda: counter.value, 0.05):
        spark.sparkContext.range(8, numSlices=4).foreach(lambda _: counter.add(1))
    assert bar.count == 8
    terminal = io.StringIO()
    terminal.isatty = lambda: True
    progress.Progress(4, out=terminal).done()
    assert terminal.getvalue().endswith("] 100% 4/4 (" + terminal.getvalue().rsplit("(", 1)[1]) and "█" * 24 in terminal.getvalue()


EVERYWHERE = [(lat, lon) for lat in range(-90, 90, 3) for lon in range(-180, 180, 3)]
CELLS = "lat int, lon int"


@pytest.fixture(scope="module")
def levels(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raster") / "levels")
    pipeline.load_levels(rows_of(spark, blobs(5, 64)), path, FIXTURE, chunk=16)
    return path


def built(spark, levels, cells, out, **options):
    """What a build leaves: tiles, fragments and the container's tiles, sorted."""
    made = pipeline.build(spark, levels, spark.createDataFrame(cells, CELLS), str(out), FIXTURE, chunk=16, **options)
    root = f"{out}/{FIXTURE.params_hash()}"
    packed, about = sinks.read_container(spark, f"{root}/container")
    return [sorted(map(repr, df.collect())) for df in (made, pipeline.read_fragments(spark, root), packed)], about


def log_lines(out):
    return [sorted(line.split("\t")[1:3] for f in sorted(run.glob("*.csv")) for line in f.read_text().splitlines()[1:]) for run in sorted((out / FIXTURE.params_hash() / "log").glob("run=*"))]


def test_build_resumes_and_merges(spark, levels, tmp_path):
    a = blobs(5, 64)
    top = {(r.x, r.y): r.value for r in pipeline.pixels_of(spark.read.parquet(levels).where("level = 2"), 16).collect()}
    assert all(top.get((x, y), 0) == a[y, x] for x in range(64) for y in range(64))
    bar = progress.Progress(6, out=io.StringIO())
    first, about = built(spark, levels, EVERYWHERE, tmp_path / "out", metadata={"name": "classes", "attribution": "none"}, bar=bar)
    assert bar.count == 6 and about["name"] == "classes" and about["maxzoom"] == 2 and [v["id"] for v in about["vector_layers"]] == ["land", "water_polygons"]
    assert all(first) and first == built(spark, levels, EVERYWHERE, tmp_path / "out")[0]
    one, two = log_lines(tmp_path / "out")
    assert len(one) == len(two) == 6 and {b for _, b in two} == {"cached"} and "cached" not in {b for _, b in one}
    root = f"{tmp_path}/out/{FIXTURE.params_hash()}"
    ours = pipeline.read_tiles(spark, root)
    pipeline.merge(ours, ours, str(tmp_path / "merged"))
    assert spark.read.parquet(str(tmp_path / "merged")).count() == 2 * len(first[0])
    pipeline.merge_containers(spark, f"{root}/container", f"{root}/container", f"{tmp_path}/both")
    both, about = sinks.read_container(spark, f"{tmp_path}/both")
    single = {(r.z, r.tx, r.ty): gzip.decompress(r.data) for r in sinks.read_container(spark, f"{root}/container")[0].collect()}
    merged = {(r.z, r.tx, r.ty): gzip.decompress(r.data) for r in both.collect()}
    assert merged.keys() == single.keys()
    for place, tile in single.items():
        one, two = ([(layer, said, shape) for _, layer, said, _, shape, _ in mvt.decode(t)] for t in (tile, merged[place]))
        assert sorted(map(repr, two)) == sorted(map(repr, one + one))
        assert [v.name for v in mvt.layers_of(merged[place])] == [v.name for v in mvt.layers_of(tile)]
    assert about["attribution"] == "none"


def test_tiles_merge_layer_by_layer(spark):
    """Tiles of another writer: other keys, values of other types, ids, lines, an older version, other extents and no layer in common."""
    line = mvt.packed(mvt.FEATURE_GEOMETRY, [mvt.MOVE | 1 << 3, 20, 20, mvt.LINE | 2 << 3, 2, 3, 5, 8])
    odd = mvt.number_field(1, 77) + mvt.packed(mvt.FEATURE_TAGS, [1, 0, 0, 1]) + mvt.number_field(mvt.FEATURE_TYPE, 2) + line
    body = mvt.number_field(mvt.LAYER_VERSION, 1) + mvt.bytes_field(mvt.LAYER_NAME, b"land") + mvt.bytes_field(mvt.LAYER_FEATURE, odd) + mvt.bytes_field(mvt.LAYER_KEY, b"kind") + mvt.bytes_field(mvt.LAYER_KEY, b"lanes")
    body += mvt.bytes_field(mvt.LAYER_VALUE, mvt.number_field(4, 3)) + mvt.bytes_field(mvt.LAYER_VALUE, mvt.bytes_field(1, b"forest")) + mvt.number_field(mvt.LAYER_EXTENT, 2048)
    base = mvt.bytes_field(mvt.TILE_LAYER, body)
    square = [[(0.0, 0.0), (40.0, 0.0), (40.0, 40.0), (0.0, 40.0)]]
    ours = mvt.encode([("land", "forest", [square]), ("land", "scrub", [square]), ("water_polygons", "water", [square])], 4096)
    got = list(mvt.decode(mvt.merged([base, ours])))
    assert [(n, layer, kind, extent) for n, layer, _, kind, _, extent in got] == [(0, "land", 2, 2048), (0, "land", 3, 2048), (0, "land", 3, 2048), (1, "water_polygons", 3, 4096)]
    assert [said for _, _, said, _, _, _ in got] == [{"kind": "forest", "lanes": "{4: 3}"}, {"kind": "forest"}, {"kind": "scrub"}, {"kind": "water"}]
    assert got[0][4] == [[(10.0, 10.0), (11.0, 8.0), (8.0, 12.0)]] and geometry.area(got[1][4][0]) == 20 * 20
    assert b"".join(mvt.number_field(1, 77) for _ in range(1)) in mvt.merged([base, ours])
    assert mvt.merged([ours]) and list(mvt.decode(mvt.merged([b"", ours]))) == list(mvt.decode(ours))
    with pytest.raises(ValueError, match="tile"):
        mvt.merged([base[:-3]])
    schema = "z int, tx int, ty int, data binary"
    one = spark.createDataFrame([(1, 0, 0, gzip.compress(base)), (1, 0, 1, gzip.compress(base))], schema)
    two = spark.createDataFrame([(1, 0, 0, ours), (1, 1, 1, ours)], schema)
    out = {(r.tx, r.ty): gzip.decompress(r.data) for r in tiles.merge_tiles(one, two, ("gzip", "none"), "gzip").collect()}
    assert out[0, 0] == mvt.merged([base, ours]) and list(mvt.decode(out[0, 1])) == list(mvt.decode(base)) and list(mvt.decode(out[1, 1])) == list(mvt.decode(ours))
    with pytest.raises(ValueError, match="brotli"):
        tiles.merge_tiles(one, two, ("brotli", "none"))


@pytest.mark.parametrize("west", [0, 10, 30])
def test_settled_blocks_ship_no_pixels(spark, tmp_path, west):
    """Half of the raster is of one value (drawn, not drawn at this zoom's end, or sea): its blocks come out as if all pixels were shipped."""
    grid = Grid(max_level=3, tile_px=16, block_tiles=2, blur_radius=1)
    a = blobs(6, 128)
    a[:, :96] = west
    pipeline.load_levels(rows_of(spark, a), str(tmp_path / "levels"), grid, chunk=8)
    stored = spark.read.parquet(str(tmp_path / "levels")).withColumn("level", F.col("level").cast("int"))
    for r in stored.select("only", "data").collect():
        assert r.only == (r.data[0] if len(set(r.data)) == 1 else -1)
    from rasterloom.operators.grid import block_grid

    blocks = block_grid(spark, grid)
    settled = fragments.settled_blocks(stored.select("level", "cx", "cy", "only"), blocks, grid, 8)
    shipped = lambda b: fragments.chunks_for_blocks(stored.select("level", "cx", "cy", "data"), b, grid, 8)
    skip = ("ms", "ended")
    rows = lambda df: sorted(repr({k: v for k, v in r.asDict().items() if k not in skip}) for r in df.collect())
    whole = fragments.process_blocks(shipped(blocks), grid)
    parts = fragments.process_blocks(shipped(settled.where("only is null")), grid).unionByName(fragments.settle(settled.where("only is not null"), grid))
    assert rows(whole) == rows(parts)
    done = {(r.z, r.bx, r.by): r.only for r in settled.collect() if r.only is not None}
    assert len(done) >= 8 and set(done.values()) == {west}
    sent = lambda b: shipped(b).where("z = 3").agg(F.sum(F.octet_length("data"))).first()[0]
    assert sent(settled.where("only is null")) <= (0.6 if west else 1) * sent(blocks)


WRITES = ("write_records", "write_log", "write_tiles", "write_container")


@pytest.mark.parametrize("stop", WRITES)
@pytest.mark.parametrize("after", [True, False])
def test_a_build_that_was_stopped_ends_the_same(spark, levels, tmp_path, monkeypatch, stop, after):
    """Stopped right before or right after each write, with a part of the blocks done earlier, then started again."""
    half = [c for c in EVERYWHERE if c[1] < -3]
    whole, _ = built(spark, levels, EVERYWHERE, tmp_path / "whole")
    built(spark, levels, half, tmp_path / "out")
    real = getattr(sinks, stop)

    def stopped(*args):
        if after:
            real(*args)
        raise KeyboardInterrupt

    monkeypatch.setattr(sinks, stop, stopped)
    with pytest.raises(KeyboardInterrupt):
        built(spark, levels, EVERYWHERE, tmp_path / "out")
    monkeypatch.setattr(sinks, stop, real)
    assert built(spark, levels, EVERYWHERE, tmp_path / "out")[0] == whole
    done = [i for run in log_lines(tmp_path / "out") for i, branch in run if branch not in ("cached", "skip-empty")]
    assert len(done) == len(set(done)) == 6 and all(len(run) == 6 for run in log_lines(tmp_path / "out"))


def test_a_run_that_was_cut_short_does_not_count(spark, levels, tmp_path):
    """Files of a run without its mark of success are replaced."""
    whole, _ = built(spark, levels, EVERYWHERE, tmp_path / "out")
    (tmp_path / "out" / FIXTURE.params_hash() / "records" / "run=0" / "_SUCCESS").unlink()
    assert built(spark, levels, EVERYWHERE, tmp_path / "out")[0] == whole


def test_only_touched_zooms_are_cut_again(spark, levels, tmp_path):
    built(spark, levels, [(0, -180)], tmp_path / "out")
    built(spark, levels, EVERYWHERE, tmp_path / "out")
    root = f"{tmp_path}/out/{FIXTURE.params_hash()}"
    assert pipeline.newest_by_zoom(spark, f"{root}/tiles") == {0: 0, 1: 0, 2: 1}


@pytest.mark.parametrize("seed", range(2))
def test_chunked_pyramid_equals_the_relational_one(spark, tmp_path, seed):
    a = blobs(seed, 64)
    a[:32, :32] = 0  # chunks that are never stored
    base = rows_of(spark, a)
    pipeline.load_levels(base, str(tmp_path / "levels"), FIXTURE, chunk=8)
    levels = spark.read.parquet(str(tmp_path / "levels"))
    for z in range(3):
        want = {(r.x, r.y): r.value for r in resample.pyramid(base, 2).where(F.col("level") == z).collect() if r.value}
        got = {(r.x, r.y): r.value for r in pipeline.pixels_of(levels.where(F.col("level") == z), 8).collect() if r.value}
        assert got == want


def test_changed_chunks_go_up_the_pyramid(spark, tmp_path):
    """Two changes and a stopped one: the levels are those of a pyramid made anew, and a change writes one chunk a family."""
    path, a = str(tmp_path / "levels"), blobs(8, 64)
    place = lambda cx, cy: (slice(8 * cy, 8 * cy + 8), slice(8 * cx, 8 * cx + 8))
    a[:16, :16] = 0
    a[place(7, 7)] = 0
    pipeline.load_levels(rows_of(spark, a), path, FIXTURE, chunk=8)

    def update(changes):
        rows = []
        for (cx, cy), block in changes.items():
            a[place(cx, cy)] = 0 if block is None else block
            rows.append((cx, cy, block if block is None else bytearray(block.tobytes())))
        return pipeline.update_chunks(spark.createDataFrame(rows, "cx long, cy long, data binary"), path, FIXTURE, 8)

    def check():
        levels = pipeline.read_levels(spark, path)
        assert levels.count() == levels.select("level", "cx", "cy").distinct().count()
        for z in range(3):
            want = {(r.x, r.y): r.value for r in resample.pyramid(rows_of(spark, a), 2).where(F.col("level") == z).collect() if r.value}
            got = {(r.x, r.y): r.value for r in pipeline.pixels_of(levels.where(F.col("level") == z), 8).collect() if r.value}
            assert got == want

    block = np.full((8, 8), 30, np.uint8)
    assert pipeline.versions_of(spark, path) == []
    # A chunk where none was, one that is changed, one that goes as null and one as zeros, the last of its family.
    assert update({(0, 0): block, (5, 2): blobs(9, 8), (4, 4): None, (6, 6): block * 0, (7, 6): block * 0, (6, 7): None}) == 1
    check()
    written = {z: spark.read.parquet(f"{path}/_changes/version=1/level={z}") for z in range(3)}
    assert {z: df.count() for z, df in written.items()} == {2: 6, 1: 4, 0: 3}
    assert {(r.cx, r.cy) for r in written[1].where("data is null").collect()} == {(3, 3)}
    # What comes later wins, also over a chunk that went; an update that stopped before level 0 counts for nothing and is written over.
    stopped = tmp_path / "levels/_changes/version=2/level=2"
    spark.createDataFrame([(1, 1, bytearray(block.tobytes()), 30)], "cx int, cy int, data binary, only int").write.parquet(str(stopped))
    check()
    assert update({(0, 0): blobs(10, 8), (4, 4): block, (7, 7): block}) == 2
    check()
    assert update({}) == 3
    check()
    # A build of the changed pyramid has a place of its own; loading a base drops the changes.
    cells = spark.createDataFrame([], CELLS)
    assert pipeline.build_root(spark, path, "out", FIXTURE) == f"out/{FIXTURE.params_hash()}-3"
    assert pipeline.build(spark, path, cells, str(tmp_path / "out"), FIXTURE, chunk=8).count() == 0
    pipeline.load_levels(rows_of(spark, a), path, FIXTURE, chunk=8)
    assert pipeline.versions_of(spark, path) == []
    check()


def spiral(size):
    """One arm of a single pixel's width that winds inward, so that a region is as long as it can be."""
    a = np.zeros((size, size), np.uint8)
    x, y, dx, dy = 0, 0, 1, 0
    a[0, 0] = 10
    for _ in range(size * size):
        ahead, beyond = (x + dx, y + dy), (x + 2 * dx, y + 2 * dy)
        free = all(0 <= c < size for c in ahead) and not a[ahead[1], ahead[0]] and not (all(0 <= c < size for c in beyond) and a[beyond[1], beyond[0]])
        if free:
            x, y = ahead
            a[y, x] = 10
        else:
            dx, dy = -dy, dx
    return a


@pytest.mark.parametrize("kind", ["blobs", "spiral", "plain", "speckled"])
def test_regions_across_chunks_are_those_of_one_array(spark, kind):
    rng = np.random.default_rng(4)
    a = {"blobs": lambda: blobs(12, 48), "spiral": lambda: spiral(48), "plain": lambda: np.full((48, 48), 255, np.uint8), "speckled": lambda: rng.choice(np.array([0, 10, 30], np.uint8), (48, 48))}[kind]()
    chunks = fragments.chunk_pixels(rows_of(spark, a).withColumn("level", F.lit(2)), 8)
    parts = seams.parts_of_regions(chunks, 8).collect()
    want = flood(a)
    sizes = np.bincount(want.ravel())
    of_part, of_region = {}, {}
    for p in parts:
        at = p.part & 0xFFFFF
        y, x = p.cy * 8 + at // 8, p.cx * 8 + at % 8
        assert p.value == a[y, x] and p.region <= p.part
        of_part[p.part] = want[y, x]
        of_region.setdefault(p.region, []).append(p)
    assert len(of_part) == len(parts)
    assert len(of_region) == len(set(of_part.values())) == len({v for v in want[a > 0].tolist()})
    for region, held in of_region.items():
        assert {of_part[p.part] for p in held} == {of_part[region]} and sum(p.n for p in held) == sizes[of_part[region]]
        assert region == min(p.part for p in held)


def test_regions_across_nothing(spark):
    none = spark.createDataFrame([], "cx int, cy int, data binary")
    assert seams.regions_across(none, 8).count() == 0


def test_mode_of_four():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 4, (60, 60))
    got = fragments.mode_of_four(a)
    for y in range(30):
        for x in range(30):
            cell = a[2 * y : 2 * y + 2, 2 * x : 2 * x + 2].ravel().tolist()
            assert got[y, x] == min(cell, key=lambda v: (-cell.count(v), v))


def test_streaming_rate(spark, tmp_path):
    from rasterloom.streaming.rates import windowed_rate

    rows = [(f"2024-01-01 00:{m:02d}:00", "a") for m in range(10)]
    spark.createDataFrame(rows, "ts string, event_type string").select(F.col("ts").cast("timestamp").alias("ts"), "event_type").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, event_type string").parquet(str(tmp_path / "in"))
    query = windowed_rate(stream, width="5 minutes", slide="5 minutes").writeStream.outputMode("complete").format("memory").queryName("rates").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(r.n for r in spark.table("rates").collect()) == [5, 5]


def fields(data):
    """(field, value) pairs of a protobuf message."""
    at, out = 0, []

    def number():
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return n

    while at < len(data):
        key = number()
        if key & 7 == 2:
            size = number()
            out.append((key >> 3, data[at : at + size]))
            at += size
        else:
            out.append((key >> 3, number()))
    return out


def test_encoded_tile(spark):
    square = [[(0.0, 0.0), (0.0, 10.0), (10.0, 10.0), (10.0, 0.0)], [(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0)]]
    rows = [(1, 0, 1, "water_polygons", "water", geometry.wkb([square])), (1, 0, 1, "land", "scrub", geometry.wkb([square])), (1, 0, 1, "land", "forest", geometry.wkb([square]))]
    (tile,) = tiles.encode_tiles(spark.createDataFrame(rows, tiles.TILE)).collect()
    layers = [fields(v) for f, v in fields(bytes(tile.data)) if f == 3]
    assert [dict(x)[1] for x in layers] == [b"land", b"water_polygons"]
    assert [v for f, v in layers[0] if f == 3] == [b"kind"] and [fields(v) for f, v in layers[0] if f == 4] == [[(1, b"forest")], [(1, b"scrub")]]
    feature = dict(fields(next(v for f, v in layers[0] if f == 2)))
    assert list(feature[2]) == [0, 0] and feature[3] == 3
    steps = list(feature[4])
    assert steps[0] == 9 and steps.count(15) == 2 and steps[3] == 26  # move one, two closes, line of three
    assert dict(layers[0])[5] == tiles.EXTENT and dict(layers[0])[15] == 2


def test_job_rates_on_a_stream_that_is_stopped(spark, tmp_path):
    """Files of a log of three jobs, one a batch, with a stop between: the rates are those of each job's whole log."""
    from rasterloom.streaming.rates import job_rates

    rng = np.random.default_rng(2)
    times = np.cumsum(rng.integers(0, 3, 300) * 700)  # several rows at one time, also at the start
    rows = [(int(j), i, int(times[i]), int(n)) for i, (j, n) in enumerate(zip(rng.choice(3, 300, p=[0.7, 0.28, 0.02]), rng.integers(1, 5, 300), strict=True))]
    schema, folder = "job long, seq long, t_ms long, n long", tmp_path / "in"

    def feed(part):
        spark.createDataFrame(part[::-1], schema).coalesce(1).write.mode("append").parquet(str(folder))
        stream = job_rates(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder)), samples=8)
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()

    for low, high in ((0, 100), (100, 105), (105, 300)):
        feed(rows[low:high])  # a new query each time, from the checkpoint
    got = spark.read.parquet(str(tmp_path / "out"))
    for job in range(3):
        want = progress.sliding_rate(spark.createDataFrame([r for r in rows if r[0] == job], schema).drop("job"), samples=8)
        assert sorted(map(tuple, got.where(F.col("job") == job).drop("job").collect())) == sorted(map(tuple, want.select("seq", "t_ms", "n", "done", "rate").collect()))
    assert got.count() == 300
