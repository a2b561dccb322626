"""What the engine relies on the optimizer for."""

from pyspark.sql import functions as F

from rasterloom.operators import grid, resample
from rasterloom.plans.queries import QUERIES
from rasterloom.plans.settings import Grid
from rasterloom.sources import listing

DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_coverage_is_a_hash_join(spark):
    text = plan(QUERIES["q_nonempty_blocks"](spark, DIR))
    assert "LeftSemi" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_a_window_read_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(x, x, 1) for x in range(100)], "x int, y int, value int").write.parquet(str(tmp_path / "p"))
    text = plan(resample.window(spark.read.parquet(str(tmp_path / "p")), 10, 10, 20, 20))
    assert "LessThan(x,20)" in text and "GreaterThanOrEqual(y,10)" in text


def test_a_zoom_reads_its_own_level(spark, tmp_path):
    rows = [(level, 0, 0, 1) for level in range(4)]
    spark.createDataFrame(rows, "level int, x int, y int, value int").write.partitionBy("level").parquet(str(tmp_path / "levels"))
    text = plan(resample.at_level(spark.read.parquet(str(tmp_path / "levels")), 2))
    assert "PartitionFilters: [isnotnull(level" in text and "= 2)]" in text


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["q_mode_resample"](spark, DIR))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in text


def test_modes_are_counted_before_the_shuffle(spark):
    text = plan(QUERIES["q_mode_resample"](spark, DIR))
    assert "partial_mode" in text


def test_coverage_equals_a_range_join(spark):
    """The exploded form against the plain overlap test, over cells with negative and edge coordinates."""
    g = Grid(max_level=6)
    names = [(f"N{lat:02d}E{lon:03d}",) for lat in range(0, 84, 12) for lon in range(0, 180, 33)] + [(f"S{lat:02d}W{lon:03d}",) for lat in range(3, 84, 9) for lon in range(3, 180, 21)]
    cells = listing.occupied_cells(spark.createDataFrame(names, "key string"))
    blocks = grid.block_windows(grid.block_grid(spark, g), g)
    overlap = (F.col("lat") < F.col("north")) & (F.col("lat") + 3 > F.col("south")) & (F.col("lon") < F.col("east")) & (F.col("lon") + 3 > F.col("west"))
    want = {tuple(r) for r in blocks.join(cells, overlap, "left_semi").select("z", "bx", "by").collect()}
    assert {tuple(r) for r in grid.nonempty_blocks(grid.block_grid(spark, g), cells, g).collect()} == want
