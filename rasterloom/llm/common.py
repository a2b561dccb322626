"""Pieces that the operators of this folder share: shared-folder tables, Arrow row passes, word splitting."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOWER_AZ = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

#: Lower-cases A-Z and turns every byte outside 0-9, a-z and UTF-8 sequences into a blank.
ALNUM_WORDS = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))


_caches: dict[str, Callable[[], None]] = {}
_in_use: set[str] = set()


def cache(name: str, clear: Callable[[], None]) -> None:
    """Registers what a worker keeps between batches, and how to drop it."""
    _caches[name] = clear


def enter(*names: str) -> None:
    """Called when a pass starts in a worker: drops what other passes left there, as workers are used again."""
    if _in_use != set(names):
        for name in _caches.keys() - set(names):
            _caches[name]()
        _in_use.clear()
        _in_use.update(names)
        gc.collect()
        pa.default_memory_pool().release_unused()


#: Bytes of an Arrow batch on its way to a worker, so that long texts don't add up to large ones.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's limit on the bytes of an Arrow batch to BATCH_BYTES; a lower one stays. Arrow passes call this."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key).rstrip("b")
    if not held.isdigit() or not 0 < int(held) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a temporary one is set if all runs on this machine;
    on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        found = "file://" + folder
        spark.sparkContext.setCheckpointDir(found)
    return found


#: Tables written by this process that are still there: paths, with the Hadoop settings to remove them by.
_tables: list[tuple[str, object, object]] = []


def as_table(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Writes df under the shared folder and returns a reader of it: the lineage ends there and a lost executor costs nothing.

    The table stays until remove_tables is called, or the process ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _tables:
        atexit.unregister(remove_tables)  # so that it is registered once
        atexit.register(remove_tables)
    _tables.append((path, spark._jvm, spark._jsc.hadoopConfiguration()))
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def tables_made() -> int:
    """A mark for remove_tables."""
    return len(_tables)


def remove_tables(since: int = 0, *, but_last: bool = False) -> None:
    """Removes the tables written after the mark, or all but the newest of them. What was read from them can't be read again."""
    stays = _tables[-1:] if but_last and len(_tables) > since else []
    for path, jvm, settings in _tables[since : len(_tables) - len(stays)]:
        try:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(settings).delete(place, True)
        except (Py4JError, OSError):  # the session's process has ended, or the folder is gone
            break
    _tables[since:] = stays


def row_pass(df: DataFrame, payload: Column, keep: Column, fn: Callable[[list], dict[str, object]], out: T.StructType, caches: tuple[str, ...] = ()) -> DataFrame:
    """Adds a struct `out` to a struct `row`.

    keep: a struct column that goes through as it is; payload: what fn gets, a list with one value per row.
    fn returns a list or Arrow array per field of out; caches names what it keeps in the worker. One Arrow pass, no shuffle."""
    bounded_batches(df.sparkSession)
    source = df.select(keep.alias("row"), payload.alias("payload"))
    schema = T.StructType([T.StructField("row", source.schema["row"].dataType), T.StructField("out", out)])
    names = out.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(*caches)
        kinds = None
        for batch in batches:
            if kinds is None:
                from pyspark.sql.pandas.types import to_arrow_type

                kinds = {f.name: to_arrow_type(f.dataType) for f in out.fields}
            made = fn(batch.column(1).to_pylist())
            arrays = [made[n] if isinstance(made[n], pa.Array) else pa.array(made[n], type=kinds[n]) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.StructArray.from_arrays(arrays, names)], names=["row", "out"])

    return source.mapInArrow(run, schema)


def text_bytes(name: str) -> Column:
    return F.col(name).cast("binary")


def struct_of_all(df: DataFrame) -> Column:
    """All columns of df as one struct, whatever their names hold."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns])


#: What may be broadcast, in rows and in bytes of their payload; more goes through an ordinary shuffled join.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20


def join_counted(large: DataFrame, small: DataFrame, on: list[str] | Column, how: str, payload: Column | None = None) -> DataFrame:
    """Joins a written table; it is broadcast only if its rows and the bytes of its payload are counted to be few."""
    rows, held = small.agg(F.count("*"), F.sum(payload) if payload is not None else F.lit(0)).first()
    return large.join(F.broadcast(small) if rows <= BROADCAST_ROWS and (held or 0) <= BROADCAST_BYTES else small, on, how)
