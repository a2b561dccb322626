"""A container of tiles for point reads: files of tiles in order of place, each with an index of offsets at its end, and one list of the files.

Writing is a data source (format "tilepack"): tiles are dealt out by ranges of place, and a task writes one file as its rows stream by.
The list is written last, when all tasks have ended, under the name by which readers find it; so a container is whole or isn't there.
A write that fails removes its own files only. Reading one tile takes the list, which a Pack keeps, then one index and one range of bytes."""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

TILES = "z int, tx int, ty int, data binary"
LIST = "tiles.json"
MARK = b"tilepack"
#: An entry of an index: zoom, row, column, where the tile begins, its bytes.
ENTRY = np.dtype([("z", "<i4"), ("ty", "<i4"), ("tx", "<i4"), ("place", "<u8"), ("size", "<u4")])


def store(folder: str):
    """The file system of a folder, on this machine or in a store that Arrow knows by its address, and its name there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


@dataclass
class Written(WriterCommitMessage):
    """A file of a task: its name, its first and last place, its tiles, and where its index is."""

    file: str | None
    first: tuple[int, int, int] | None = None
    last: tuple[int, int, int] | None = None
    tiles: int = 0
    index: int = 0
    bytes: int = 0


class PackWriter(DataSourceWriter):
    def __init__(self, folder: str, about: str, job: str):
        self.folder, self.about, self.job = folder.rstrip("/"), about, job

    def write(self, rows: Iterator) -> Written:
        system, folder = store(self.folder)
        entries, at, name = [], 0, f"{self.job}-{uuid.uuid4().hex}.tiles"
        out = None
        for r in rows:
            if out is None:
                system.create_dir(folder, recursive=True)
                out = system.open_output_stream(f"{folder}/{name}")
                at = out.write(MARK)
            key = (r.z, r.ty, r.tx)
            if entries and key <= entries[-1][:3]:
                raise ValueError(f"two tiles at {key}, or tiles out of order")
            out.write(r.data)
            entries.append((*key, at, len(r.data)))
            at += len(r.data)
        if out is None:
            return Written(None)
        index = zlib.compress(np.array(entries, ENTRY).tobytes(), 6)
        out.write(index)
        out.write(struct.pack("<Q", at))
        out.close()
        return Written(name, entries[0][:3], entries[-1][:3], len(entries), at, len(index))

    def commit(self, messages: list[Written | None]) -> None:
        """Puts the list in place under another name first, so that readers see the old container or the new one."""
        system, folder = store(self.folder)
        system.create_dir(folder, recursive=True)
        files = sorted(([*m.first], [*m.last], m.file, m.tiles, m.index, m.bytes) for m in messages if m and m.file)
        for one, two in zip(files, files[1:], strict=False):
            if two[0] <= one[1]:
                raise ValueError("tiles weren't dealt out by ranges of place")
        with system.open_output_stream(f"{folder}/{self.job}.json") as out:
            out.write(json.dumps({**json.loads(self.about), "files": files}).encode())
        system.move(f"{folder}/{self.job}.json", f"{folder}/{LIST}")
        listed = {f[2] for f in files}  # neither an older container's files nor those of attempts that were lost
        self.remove(lambda name: name.endswith(".tiles") and name not in listed)

    def abort(self, messages: list[Written | None]) -> None:
        self.remove(lambda name: name.startswith(self.job))

    def remove(self, which: Callable[[str], bool]) -> None:
        from pyarrow import fs

        system, folder = store(self.folder)
        for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if which(info.base_name):
                system.delete_file(info.path)


class Pack:
    """A container, opened: what it says of itself, and its tiles one by one."""

    def __init__(self, folder: str):
        self.system, self.folder = store(folder.rstrip("/"))
        with self.system.open_input_stream(f"{self.folder}/{LIST}") as held:
            self.about = json.loads(held.read())
        self.files = self.about.pop("files")
        self.firsts = [tuple(f[0]) for f in self.files]

    def ranges(self, file: str) -> Callable[[int, int], bytes]:
        held = self.system.open_input_file(f"{self.folder}/{file}")
        return lambda at, n: (held.seek(at), held.read(n))[1]

    def index(self, nth: int, read: Callable[[int, int], bytes]) -> np.ndarray:
        _, _, _, _, at, size = self.files[nth]
        return np.frombuffer(zlib.decompress(read(at, size)), ENTRY)

    def tile(self, z: int, tx: int, ty: int) -> bytes | None:
        """The tile at a place, or None: one index and one range are read."""
        key = (z, ty, tx)
        nth = bisect_right(self.firsts, key) - 1
        if nth < 0 or key > tuple(self.files[nth][1]):
            return None
        read = self.ranges(self.files[nth][2])
        entries = self.index(nth, read)
        at = int(np.searchsorted(entries[["z", "ty", "tx"]], np.array(key, entries[["z", "ty", "tx"]].dtype)))
        found = entries[at]
        return read(int(found["place"]), int(found["size"])) if (found["z"], found["ty"], found["tx"]) == key else None


@dataclass
class File(InputPartition):
    nth: int

    def __init__(self, nth: int):
        super().__init__(nth)
        self.nth = nth


class PackReader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[File]:
        return [File(n) for n in range(len(Pack(self.folder).files))] or [File(-1)]

    def read(self, partition: File) -> Iterator[tuple]:
        if partition.nth >= 0:
            pack = Pack(self.folder)
            read = pack.ranges(pack.files[partition.nth][2])
            for e in pack.index(partition.nth, read):
                yield int(e["z"]), int(e["tx"]), int(e["ty"]), read(int(e["place"]), int(e["size"]))


class PackSource(DataSource):
    """Format "tilepack". Options: path; about (JSON), what the container says of itself."""

    @classmethod
    def name(cls) -> str:
        return "tilepack"

    def schema(self) -> str:
        return TILES

    def reader(self, schema) -> PackReader:
        return PackReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> PackWriter:
        return PackWriter(self.options["path"], self.options.get("about", "{}"), uuid.uuid4().hex)


def write_pack(tiles: DataFrame, folder: str, about: dict, files: int) -> None:
    """Tiles (z, tx, ty, data; one a place) as a container of about so many files."""
    tiles.sparkSession.dataSource.register(PackSource)
    placed = tiles.select("z", "tx", "ty", F.col("data")).repartitionByRange(files, "z", "ty", "tx").sortWithinPartitions("z", "ty", "tx")
    placed.write.format("tilepack").option("about", json.dumps(about)).mode("append").save(folder)


def read_pack(spark: SparkSession, folder: str) -> tuple[DataFrame, dict]:
    """All tiles, a file in a task, and what the container says of itself."""
    spark.dataSource.register(PackSource)
    return spark.read.format("tilepack").load(folder), Pack(folder).about
