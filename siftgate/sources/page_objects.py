"""Raw page objects as a data source: zipped pages below a partition template, read in batches or as a stream.

``spark.read.format("page_objects")`` lists folders level by level along the template and goes down only where the
pushed filters on the template's slots allow; the objects themselves are listed and opened in the tasks, one
``(prefix, split)`` each. As a stream, an offset is a modification time: a batch holds the objects changed after the
one before, so objects that arrive late in an old folder are still read. The sink writes one object per row under
its final name by way of a hidden one, so a repeated task replaces what it wrote and readers see whole objects.

The store is reached through Arrow's file systems (local, HDFS, S3, GCS). Stores that only Spark can read stay with
``objects.raw_page_source``.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage)
from pyspark.sql.types import DateType, IntegerType, StringType, StructType
from pyspark.sql.pandas.types import to_arrow_schema

from siftgate.sources.objects import first_member_text

FORMAT = "page_objects"
SLOT_TYPES = {"date_stamp": DateType(), "hour_stamp": IntegerType()}  # of template slots; all others are strings
READ_AS = {DateType(): dt.date.fromisoformat, IntegerType(): int, StringType(): str}
BATCH_CHARS = 8_000_000  # page text of an Arrow batch
MEMBER = "page.html"


def store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a location; plain paths and file:/x are local."""
    if path.startswith("file:"):
        path = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


class Template:
    """Folder levels with slots, as in ``platform_id={platform_id}/date_stamp={date_stamp}/``."""

    def __init__(self, text: str):
        self.levels = [x for x in text.split("/") if x]
        self.slots = re.findall(r"{(\w+)}", text)
        if len(set(self.slots)) < len(self.slots):
            raise ValueError(f"a slot occurs twice in {text!r}")
        self.patterns = [re.compile("".join(f"(?P<{p[1:-1]}>.*)" if p.startswith("{") else re.escape(p) for p in re.split(r"({\w+})", x)))
                         for x in self.levels]

    def schema(self) -> StructType:
        out = StructType()
        for slot in self.slots:
            out.add(slot, SLOT_TYPES.get(slot, StringType()))
        return out.add("object_name", StringType()).add("html", StringType())

    @staticmethod
    def value(slot: str, text: str) -> Any:
        """The typed value of a folder's part; null if it has none of that type."""
        try:
            return READ_AS[SLOT_TYPES.get(slot, StringType())](text)
        except ValueError:
            return None

    def folder(self, values: dict[str, Any]) -> str:
        if any(values[s] is None for s in self.slots):
            raise ValueError(f"an object needs {', '.join(self.slots)}")
        return "/".join(x.format(**values) for x in self.levels)


TESTS = {EqualTo: lambda v, x: v == x, In: lambda v, x: v in x, GreaterThan: lambda v, x: v > x, GreaterThanOrEqual: lambda v, x: v >= x,
         LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x}


@dataclass(frozen=True)
class Wanted:
    """A pushed comparison of one slot with constants."""
    slot: str
    kind: type
    value: Any

    def holds(self, value: Any) -> bool:
        return value is not None and TESTS[self.kind](value, self.value)


@dataclass
class Prefix(InputPartition):
    """One folder of objects with its slot values; of them, those of one split, changed in (after, until]."""
    path: str
    values: tuple
    split: int
    splits: int
    after: int | None = None
    until: int | None = None


def micros(info: fs.FileInfo) -> int:
    return info.mtime_ns // 1000


class Listing:
    """What batch and stream readers share."""

    def __init__(self, options: dict[str, str]):
        self.root, self.template = options["path"], Template(options["template"])
        self.splits = int(options.get("splits", 1))
        self.wanted: list[Wanted] = []

    def folders(self) -> list[tuple[str, tuple]]:
        """Folders at the template's end whose slots meet the pushed filters, pruned on every level."""
        system, root = store(self.root)
        found = [(root.rstrip("/"), {})]
        for pattern in self.template.patterns:
            below = []
            for path, values in found:
                for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                    hit = pattern.fullmatch(info.base_name) if info.type == fs.FileType.Directory else None
                    if hit:
                        more = {s: self.template.value(s, v) for s, v in hit.groupdict().items()}
                        if all(w.holds(more[w.slot]) for w in self.wanted if w.slot in more):
                            below.append((info.path, values | more))
            found = below
        return sorted((path, tuple(values[s] for s in self.template.slots)) for path, values in found)

    @staticmethod
    def objects(system: fs.FileSystem, path: str) -> list[fs.FileInfo]:
        return [i for i in system.get_file_info(fs.FileSelector(path, allow_not_found=True))
                if i.type == fs.FileType.File and i.base_name.endswith(".zip") and not i.base_name.startswith((".", "_"))]

    def prefixes(self, after: int | None = None, until: int | None = None) -> list[Prefix]:
        return [Prefix(path, values, k, self.splits, after, until) for path, values in self.folders() for k in range(self.splits)]

    def rows(self, part: Prefix) -> Iterator[pa.RecordBatch]:
        system, _ = store(self.root)
        schema = to_arrow_schema(self.template.schema())
        rows, held = [], 0
        for info in sorted(self.objects(system, part.path), key=lambda i: i.base_name):
            if zlib.crc32(info.base_name.encode()) % part.splits != part.split:
                continue
            if part.until is not None and not part.after < micros(info) <= part.until:
                continue
            with system.open_input_file(info.path) as f:
                html = first_member_text(f.read())
            rows.append((*part.values, info.base_name, html))
            held += len(html or "")
            if held >= BATCH_CHARS:
                yield self.batch(rows, schema)
                rows, held = [], 0
        if rows:
            yield self.batch(rows, schema)

    @staticmethod
    def batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.listing = Listing(options)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if type(f) in TESTS and len(f.attribute) == 1 and f.attribute[0] in self.listing.template.slots:
                self.listing.wanted.append(Wanted(f.attribute[0], type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[Prefix]:
        return self.listing.prefixes() or [Prefix("", (), 1, 1)]

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        return self.listing.rows(partition) if partition.path else iter(())


class PageStreamReader(DataSourceStreamReader):
    """Objects in order of change. Those younger than ``settle_seconds`` wait for a later batch, as others may still
    appear with the same time; folders before ``from_date`` are not listed."""

    def __init__(self, options: dict[str, str]):
        self.listing = Listing(options)
        self.settle = float(options.get("settle_seconds", 60))
        if "from_date" in options:
            self.listing.wanted.append(Wanted("date_stamp", GreaterThanOrEqual, dt.date.fromisoformat(options["from_date"])))
        self.last = 0

    def initialOffset(self) -> dict:
        return {"changed": 0}

    def latestOffset(self) -> dict:
        system, _ = store(self.listing.root)
        now = int((dt.datetime.now(dt.timezone.utc).timestamp() - self.settle) * 1e6)
        times = (micros(i) for path, _ in self.listing.folders() for i in self.listing.objects(system, path))
        self.last = max([self.last, *(t for t in times if t <= now)])
        return {"changed": self.last}

    def partitions(self, start: dict, end: dict) -> list[Prefix]:
        return self.listing.prefixes(start["changed"], end["changed"])

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        return self.listing.rows(partition)


class PageWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.root, self.template = options["path"], Template(options["template"])
        missing = {*self.template.slots, "object_name", "html"} - {*schema.names}
        if missing:
            raise ValueError(f"page objects need the columns {', '.join(sorted(missing))}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, root = store(self.root)
        for batch in iterator:
            for row in batch.select([*self.template.slots, "object_name", "html"]).to_pylist():
                folder = f"{root.rstrip('/')}/{self.template.folder(row)}"
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr(MEMBER, row["html"] or "")
                system.create_dir(folder, recursive=True)
                hidden = f"{folder}/.{uuid.uuid4().hex}.zip"
                with system.open_output_stream(hidden) as f:
                    f.write(buffer.getvalue())
                system.move(hidden, f"{folder}/{row['object_name']}")
        return WriterCommitMessage()


class PageObjects(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return Template(self.options["template"]).schema()

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(dict(self.options))

    def streamReader(self, schema: StructType) -> PageStreamReader:
        return PageStreamReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> PageWriter:
        return PageWriter(dict(self.options), schema)


def registered(spark: SparkSession) -> SparkSession:
    """The session with the format known and its filters pushed down."""
    spark.dataSource.register(PageObjects)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def page_objects(spark: SparkSession, root: str, template: str, splits: int = 1) -> DataFrame:
    """Slots of the template, object_name and html of all zipped pages below a folder. Filter on the slots to prune folders."""
    return registered(spark).read.format(FORMAT).option("template", template).option("splits", splits).load(root)


def page_object_stream(spark: SparkSession, root: str, template: str, **options) -> DataFrame:
    """The same objects as a stream, each once after every change. Options: splits, settle_seconds, from_date."""
    return registered(spark).readStream.format(FORMAT).option("template", template).options(**options).load(root)


def write_page_objects(pages: DataFrame, root: str, template: str) -> None:
    """One zipped object per row, in the folder of its slots. Existing objects of that name are replaced."""
    registered(pages.sparkSession)
    pages.write.format(FORMAT).mode("append").option("template", template).save(root)
