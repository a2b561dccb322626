"""Tile listings: paged XML from a store, or a saved list of names."""

from __future__ import annotations

import re
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader
from pyspark.sql.types import StructType

KEY = r"<Key>([^<]+\.tif)</Key>"
TOKEN = r"<NextContinuationToken>([^<]+)</NextContinuationToken>"
TRUNCATED = r"<IsTruncated>true</IsTruncated>"


def keys_of(xml: Column) -> Column:
    """All raster keys of a listing page."""
    return F.regexp_extract_all(xml, F.lit(KEY), 1)


def next_token(xml: Column) -> Column:
    """The token of the next page; null on the last page, whatever else it holds."""
    return F.when(xml.rlike(TRUNCATED), F.nullif(F.regexp_extract(xml, TOKEN, 1), F.lit("")))


def pages(first: Callable[[str | None], tuple[int, str]]) -> Iterator[str]:
    """Follows continuation tokens; first(token) returns (status, page). Another status than 200 is an error. A page without a token, or
    with an empty one, is the last."""
    token = None
    while True:
        status, page = first(token)
        if status != 200:
            raise OSError(f"listing failed with status {status}")
        yield page
        found = re.search(TOKEN, page)
        if not re.search(TRUNCATED, page) or not found:
            return
        token = found[1]


class ListingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.url, self.prefix = options["url"], options.get("prefix", "")

    def read(self, partition) -> Iterator[tuple[str]]:
        def page(token: str | None) -> tuple[int, str]:
            asked = {"list-type": "2", "prefix": self.prefix} | ({"continuation-token": token} if token else {})
            with urllib.request.urlopen(f"{self.url}?{urllib.parse.urlencode(asked)}", timeout=60) as reply:
                return reply.status, reply.read().decode()

        for xml in pages(page):
            for key in re.findall(KEY, xml):
                yield (key,)


class ListingSource(DataSource):
    """spark.read.format("tile_listing").option("url", ...).option("prefix", ...): a row per raster key of a paged store listing.

    Pages depend on each other, so one task reads them all; a listing is names only."""

    @classmethod
    def name(cls) -> str:
        return "tile_listing"

    def schema(self) -> str:
        return "key string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ListingReader(self.options)


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Saved listing pages: page_path, xml."""
    return spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("page_path"), F.col("value").alias("xml"))


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """A saved list, a name per line. An empty one is an error."""
    names = spark.read.text(path).select(F.trim("value").alias("key")).where("key != ''")
    if names.isEmpty():
        raise ValueError(f"no tiles are listed in {path}")
    return names


CORNER = r"([NS])(\d{2})([EW])(\d{3})"


def corners(names: DataFrame) -> DataFrame:
    """lat, lon of the south-west corner in each name; names without one are dropped."""
    part = lambda i: F.regexp_extract("key", CORNER, i)
    sign = lambda i, minus: F.when(part(i) == minus, -1).otherwise(1)
    return names.where(F.col("key").rlike(CORNER)).select("key", (sign(1, "S") * part(2).cast("int")).alias("lat"), (sign(3, "W") * part(4).cast("int")).alias("lon"))


def occupied_cells(names: DataFrame) -> DataFrame:
    """The distinct cells that have a tile."""
    return corners(names).select("lat", "lon").distinct()
