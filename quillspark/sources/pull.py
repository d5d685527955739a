"""A Python data source that pulls rollout items page by page."""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Iterator
from urllib.request import urlopen

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

REQUIRED = ("uid", "instance_id", "messages", "reward", "extra_info")


def http_page(url: str) -> list[dict]:
    with urlopen(url) as r:  # noqa: S310
        body = json.loads(r.read())
    return body if isinstance(body, list) else body.get("data", [])


class RolloutSource(DataSource):
    """``format("rollout_pull")`` with options ``url`` and ``pages``: one task per page of JSON items."""

    @classmethod
    def name(cls) -> str:
        return "rollout_pull"

    def schema(self) -> str:
        return "page int, item string"

    def reader(self, schema) -> DataSourceReader:
        return RolloutReader(self.options)


class RolloutReader(DataSourceReader):
    fetch: Callable[[str], list[dict]] = staticmethod(http_page)

    def __init__(self, options: dict):
        self.url, self.pages = options.get("url", ""), int(options.get("pages", "1"))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(self.pages)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for item in self.fetch(self.url.replace("{page}", str(partition.value))):
            yield partition.value, json.dumps(item)


def checked(items: DataFrame, column: str = "item") -> tuple[DataFrame, DataFrame]:
    """Items with all required keys, and the rejected ones with what they lack."""
    keys = F.json_object_keys(column)
    lacks = F.array_except(F.array(*map(F.lit, REQUIRED)), F.coalesce(keys, F.array().cast("array<string>")))
    x = items.withColumn("missing", lacks)
    return x.where(F.size("missing") == 0).drop("missing"), x.where(F.size("missing") > 0)


class RepeatReader(DataSourceReader):
    """Lines of the files of a folder, for every epoch, each ``repeats`` times; a partition is one file of one epoch."""

    def __init__(self, options: dict):
        self.path, self.epochs, self.repeats = options["path"], int(options.get("epochs", 1)), int(options.get("repeats", 1))

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(self.path)
        files = sorted(f.path for f in system.get_file_info(fs.FileSelector(at)) if f.is_file and not f.base_name.startswith(("_", ".")))
        return [InputPartition((e, f)) for e in range(self.epochs) for f in files]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from pyarrow import fs

        epoch, file = partition.value
        system, _ = fs.FileSystem.from_uri(self.path)
        with system.open_input_stream(file) as f:
            for line in io.TextIOWrapper(f, encoding="utf-8"):
                if line.strip():
                    for k in range(self.repeats):
                        yield epoch, k, line.rstrip("\n")


class RepeatSource(DataSource):
    """``spark.read.format("repeated_lines").option("path", uri)``: ``epoch, rep, value``."""

    @classmethod
    def name(cls) -> str:
        return "repeated_lines"

    def schema(self) -> str:
        return "epoch int, rep int, value string"

    def reader(self, schema) -> RepeatReader:
        return RepeatReader(self.options)
