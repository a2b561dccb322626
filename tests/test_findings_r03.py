"""What the third review found, on the smallest tables that show it."""

import tracemalloc

import duckdb
import pytest

from rasterloom.functions import mvt
from rasterloom.operators import resample
from rasterloom.plans import queries
from rasterloom.plans.oracles import ORACLES


@pytest.fixture
def both(spark, tmp_path):
    """A query's rows and those of its SQL, over tables of which the test gives the rows as SQL."""

    def run(name, **tables):
        duck = duckdb.connect()
        for table, sql in tables.items():
            duck.execute(f"COPY ({sql}) TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
        got = queries.QUERIES[name](spark, str(tmp_path))
        want = duck.execute(f'SELECT {", ".join(f"""\"{c}\"""" for c in got.columns)} FROM ({ORACLES[name]}) t').fetchall()
        return sorted(map(tuple, got.collect()), key=repr), sorted(want, key=repr)

    return run


def test_northings_keep_their_digits_in_the_south(both):
    keys = (73015, 1773015, 3473015, 5173015, *range(0, 1700000, 4999))
    got, want = both("q_project_points", customer=f"SELECT CAST(unnest({list(keys)}) AS BIGINT) AS c_custkey")
    assert got == want and len(got) == len(keys)


#: Items of suppliers beyond the 1,024 whose blocks fill the square of the SQL.
ITEMS = """SELECT CAST(i AS BIGINT) AS l_orderkey, CAST(i * 31 % 977 AS BIGINT) AS l_partkey, CAST(i % 7 * 181 + i % 3 AS BIGINT) AS l_suppkey,
  CAST(i % 4 AS INTEGER) AS l_linenumber, CAST(i % 50 AS DOUBLE) AS l_quantity FROM range(4000) t(i)"""


def test_stored_levels_of_a_raster_beyond_the_square(both):
    got, want = both("q_stored_levels", lineitem=ITEMS)
    assert got == want and len(got) > 10


def test_updated_levels_of_a_raster_beyond_the_square(both):
    got, want = both("q_updated_levels", lineitem=ITEMS)
    assert got == want and len(got) > 10


def test_blocks_below_the_square_are_stored(spark, both, tmp_path):
    both("q_stored_levels", lineitem=ITEMS)
    grid = queries.load_large(spark, str(tmp_path), str(tmp_path / "levels"))
    rows = {(r.level, r.cy) for r in spark.read.parquet(str(tmp_path / "levels")).select("level", "cy").collect()}
    assert grid.max_level == 6 and (6, 1086 // 32) in rows


def test_points_leave_no_value_on_pixels_that_hold_none(both):
    """The row of pixels at 85 N is lower than the points are apart, and holds none of them."""
    got, want = both("q_warp", lineitem="SELECT i AS l_partkey, j AS l_suppkey, CAST((i * 7 + j) % 50 AS DOUBLE) AS l_quantity FROM range(0, 540, 5) a(i), range(270) b(j)")
    assert got == want and len(got) > 1000


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_windows_do_not_depend_on_the_zone_of_the_session(spark, both, zone):
    """Hours that the zone leaves out or has twice among them."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for name in ("q_windowed_rate", "q_sliding_rate"):
            got, want = both(name, events="SELECT i AS event_id, TIMESTAMP '2024-03-09 22:00:00' + to_seconds(i * 40) AS ts, i AS user_id, 'e' || i % 3 AS event_type FROM range(900) t(i)")
            assert got == want and len(got) > 800
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_warp_spreads_cells_not_rows(spark):
    """Rows of one cell are counted before they are placed on all pixels that take it."""
    rows = spark.range(5000).selectExpr("10.0 * (id % 2) as lon", "double(0) as lat", "int(id % 2) as value")
    plan = resample.warp(rows, 4, queries.FINE, 20.0, 2.0)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and plan.rindex("Generate") < plan.rindex("Exchange"), "rows are spread before they are counted"


def test_scores_of_a_block_stay_in_its_task(spark):
    plan = queries.q_channel_prune_equiv(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert dealt and not any("channel#" in line.split("hashpartitioning")[1] for line in dealt)


def test_a_tile_is_encoded_while_its_features_pass_by():
    """What is held is what is written: 20,000 features of some 25 bytes, not their points."""
    square = lambda n: [[[(0.0, 0.0), (n % 30 + 1.0, 0.0), (n % 30 + 1.0, 5.0), (0.0, 5.0)]]]
    rows = lambda n: (("land" if i < n // 2 else "roads", f"k{i * 6 // n}", square(i)) for i in range(n))
    assert bytes(mvt.encode_sorted(rows(60), 4096)) == mvt.encode(list(rows(60)), 4096)
    tracemalloc.start()
    size = len(mvt.encode_sorted(rows(20000), 4096))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert size > 400_000 and peak < 6 * size
    with pytest.raises(ValueError):
        mvt.encode_sorted(reversed(list(rows(60))), 4096)


def test_blocks_are_rows_of_a_batch_not_groups_of_python(spark):
    for name in ("q_simplify", "q_tag_split"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "FlatMapGroups" not in plan
