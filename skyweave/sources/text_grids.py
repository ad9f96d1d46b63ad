"""Text-grid files as a data source: ``spark.read.format("text_grids").load(folder)``.

The folder holds files, in ``date=yyyy-MM-dd`` folders or not. Rows are (source, product, date, path, content); one byte is one
character. Filters on source, date and product reach the listing: folders of other days are not listed, files of other
products are not opened, and another source has no partitions at all. Files are dealt to partitions by their sizes. A
file outside a date folder has the day of its header's ``time`` line; only such files are opened to learn their day.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, In, InputPartition, LessThanOrEqual

SOURCE = "arso"
SCHEMA = "source string, product string, date string, path string, content string"
FOLDER = re.compile(r"(?:^|/)date=(\d{4}-\d\d-\d\d)(?:/|$)")
TIME = re.compile(rb"^\s*time\s+(\d+)\s+(\d+)\s+(\d+)\b", re.MULTILINE)
#: Bytes of files in one partition (a larger file is one of its own) and in one batch.
PARTITION_BYTES, BATCH_BYTES = 32 << 20, 4 << 20


def product_of(path: str) -> str:
    return "ZM" if "zm" in path.rsplit("/", 1)[-1].lower() else "RRG"


def day_of(path: str) -> str | None:
    found = FOLDER.search(path.rsplit("/", 1)[0])
    return found[1] if found else None


def day_of_header(content: bytes) -> str | None:
    found = TIME.search(content.split(b"DATA", 1)[0])
    try:
        return date(*map(int, found.groups())).isoformat() if found else None
    except ValueError:
        return None


def file_system(path: str):
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


@dataclass
class Wanted:
    """What the pushed filters leave: bounds of the day, and sets of names where they are limited."""

    first: str = ""
    last: str = "9999-12-31"
    days: frozenset[str] | None = None
    sources: frozenset[str] | None = None
    products: frozenset[str] | None = None

    def day(self, day: str | None) -> bool:
        """An unknown day (of a file outside a date folder) is wanted until its header is read."""
        return day is None or self.first <= day <= self.last and (self.days is None or day in self.days)

    def by_day(self) -> bool:
        return (self.first, self.last, self.days) != ("", "9999-12-31", None)

    def file(self, path: str) -> bool:
        return self.products is None or product_of(path) in self.products


@dataclass
class Files(InputPartition):
    paths: list[str]


class TextGridReader(DataSourceReader):
    def __init__(self, path: str, partition_bytes: int):
        self.path, self.partition_bytes, self.wanted = path, partition_bytes, Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes =, IN on source, product and date, and >=, <= on date; gives all others back."""
        w = self.wanted
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else ""
            values = frozenset([f.value] if isinstance(f, EqualTo) else f.value) if isinstance(f, (EqualTo, In)) else None
            field = {"source": "sources", "product": "products", "date": "days"}.get(name)
            if values is not None and field:
                before = getattr(w, field)
                setattr(w, field, values if before is None else before & values)
            elif name == "date" and isinstance(f, GreaterThanOrEqual):
                w.first = max(w.first, f.value)
            elif name == "date" and isinstance(f, LessThanOrEqual):
                w.last = min(w.last, f.value)
            else:
                yield f

    def listed(self) -> Iterator[tuple[str, int]]:
        """(path, bytes) of the wanted files; a folder of another day is not entered."""
        from pyarrow import fs

        files, root = file_system(self.path)
        todo = [root]
        while todo:
            for info in files.get_file_info(fs.FileSelector(todo.pop())):
                if info.base_name.startswith((".", "_")):
                    continue
                if info.type == fs.FileType.Directory:
                    if self.wanted.day(day_of(f"{info.path}/")):
                        todo.append(info.path)
                elif self.wanted.file(info.path):
                    yield info.path, info.size

    def partitions(self) -> list[Files]:
        if self.wanted.sources is not None and SOURCE not in self.wanted.sources:
            return []
        parts, size = [Files([])], 0
        for path, n in sorted(self.listed()):
            if parts[-1].paths and size + n > self.partition_bytes:
                parts.append(Files([]))
                size = 0
            parts[-1].paths.append(path)
            size += n
        return parts if parts[0].paths else []

    def read(self, partition: Files | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # what Spark makes of no partitions
            return
        files, _ = file_system(self.path)
        rows, size = [], 0
        for path in partition.paths:
            with files.open_input_file(path) as f:
                content = f.read()
            day = day_of(path) or day_of_header(content)
            if self.wanted.day(day) and (day or not self.wanted.by_day()):
                rows.append((SOURCE, product_of(path), day, path, content.decode("latin-1")))
                size += len(content)
            if size > BATCH_BYTES:
                yield self.batch(rows)
                rows, size = [], 0
        if rows:
            yield self.batch(rows)

    @staticmethod
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], [c.split()[0] for c in SCHEMA.split(", ")])


class TextGrids(DataSource):
    """Options: ``path``, and ``partition_bytes`` (32 MB)."""

    @classmethod
    def name(cls) -> str:
        return "text_grids"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TextGridReader:
        return TextGridReader(self.options["path"], int(self.options.get("partition_bytes", PARTITION_BYTES)))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path``. Filter pushdown into data sources is switched on for the session: the source relies on it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TextGrids)
    return spark.read.format("text_grids").load(path)


def write(files: DataFrame, path: str) -> int:
    """``files(date, path, content)`` as files ``date=.../<last part of path>``; returns their number.

    Tasks write under names of their own and rename, so that a repeated attempt leaves the same files.
    """

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        out, root = file_system(path)
        mine = TaskContext.get().taskAttemptId()
        for batch in batches:
            for row in batch.to_pylist():
                folder, name = f"{root}/date={row['date']}", row["path"].rsplit("/", 1)[-1]
                out.create_dir(folder, recursive=True)
                with out.open_output_stream(f"{folder}/.{mine}-{name}") as f:
                    f.write(row["content"].encode("latin-1"))
                out.move(f"{folder}/.{mine}-{name}", f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    return files.select("date", "path", "content").mapInArrow(put, "n long").groupBy().sum("n").first()[0] or 0
