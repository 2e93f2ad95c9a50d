"""Pages of an open-data API as a data source, for batches and streams: ranges of offsets are partitions and stream positions.

    spark.dataSource.register(PagedJson)
    spark.read.format("paged_json").option("url", ...).load()          every record that there is now
    spark.readStream.format("paged_json").option("url", ...).load()    and those that come, each page once

Columns: offset (the record's number) and record (its JSON). Options: url, key (api-key), limit (records of a page, 1 to 100),
pages (pages of a partition), start (first offset of a stream's first run), timeout (seconds), attempts.
The API tells how many records there are as `total`; records are appended there, not changed.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .read import page_query
from .write import transient, with_retry

#: Fields of a record that the normalizer takes.
FIELDS = ("State", "District", "Market", "Commodity", "Variety", "Arrival_Date", "Min_Price", "Modal_Price", "Max_Price")


class Range(InputPartition):
    """Offsets from first to before last."""

    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class Api:
    def __init__(self, options: dict):
        self.url, self.key = options["url"], options.get("key", "")
        self.limit, self.pages = int(options.get("limit", 100)), int(options.get("pages", 10))
        self.timeout, self.attempts = float(options.get("timeout", 30)), int(options.get("attempts", 3))
        page_query(self.url, self.key, self.limit, 0)
        if self.pages < 1:
            raise ValueError("pages must be positive")

    def page(self, offset: int, limit: int) -> dict:
        def ask() -> bytes:
            with urlopen(page_query(self.url, self.key, limit, offset), timeout=self.timeout) as r:
                return r.read()

        got = json.loads(with_retry(ask, transient, self.attempts, 0.5))
        if not isinstance(got, dict) or not isinstance(got.get("records"), list):
            raise ValueError(f"no array of records at offset {offset} of {self.url}")
        return got

    def total(self) -> int:
        try:
            return int(self.page(0, 1)["total"])
        except (KeyError, TypeError) as e:
            raise ValueError(f"{self.url} doesn't tell its total") from e

    def ranges(self, first: int, last: int) -> list[Range]:
        step = self.limit * self.pages
        return [Range(at, min(at + step, last)) for at in range(first, last, step)]

    def read(self, part: Range) -> Iterator[tuple[int, str]]:
        """Page by page. A page that is short of what the API has promised is an error: nothing is left out silently."""
        for at in range(part.first, part.last, self.limit):
            wanted = min(self.limit, part.last - at)
            records = self.page(at, wanted)["records"]
            if len(records) < wanted:
                raise ValueError(f"{len(records)} of {wanted} records at offset {at} of {self.url}")
            for k, r in enumerate(records[:wanted]):
                yield at + k, json.dumps(r, ensure_ascii=False)


class PagedJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return "offset long, record string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return Batch(Api(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return Stream(Api(self.options), int(self.options.get("start", 0)))


class Batch(DataSourceReader):
    def __init__(self, api: Api):
        self.api = api

    def partitions(self) -> list[Range]:
        return self.api.ranges(0, self.api.total()) or [Range(0, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        return self.api.read(partition)


class Stream(DataSourceStreamReader):
    """Positions are counts of records. The checkpoint keeps them, so a restart goes on behind the last page that was read."""

    def __init__(self, api: Api, start: int):
        self.api, self.start = api, start

    def initialOffset(self) -> dict:
        return {"offset": self.start}

    def latestOffset(self) -> dict:
        return {"offset": max(self.start, self.api.total())}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.api.ranges(start["offset"], end["offset"])

    def read(self, partition: Range) -> Iterator[tuple]:
        return self.api.read(partition)

    def commit(self, end: dict) -> None:
        pass


def pages(spark: SparkSession, url: str, key: str, stream: bool = False, **options: object) -> DataFrame:
    page_query(url, key, int(options.get("limit", 100)), 0)  # refuses what can't be asked for
    spark.dataSource.register(PagedJson)
    reader = (spark.readStream if stream else spark.read).format("paged_json").option("url", url).option("key", key)
    return reader.options(**{k: str(v) for k, v in options.items()}).load()


def price_records(paged: DataFrame) -> DataFrame:
    """The normalizer's columns of each record, as text; names are taken in any case, as the API's releases differ in it."""
    fields = F.from_json("record", "map<string,string>")
    low = F.transform_keys(fields, lambda k, _: F.lower(k))
    return paged.select("offset", *(low[f.lower()].alias(f) for f in FIELDS))
