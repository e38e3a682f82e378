"""Raw page objects (zipped HTML) and call logs."""

from __future__ import annotations

import io
import lzma
import zipfile
import zlib
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


OUTPUT_CHARS = 4 << 20  # page text of a batch that leaves Python


def first_member_text(content: bytes | None) -> str | None:
    """First file of a zip as UTF-8; broken bytes are replaced, a broken, encrypted or unsupported archive gives null."""
    if content is None:
        return None
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            names = archive.namelist()
            return archive.read(names[0]).decode("utf-8", errors="replace") if names else None
    except (zipfile.BadZipFile, zlib.error, lzma.LZMAError, RuntimeError, EOFError, OSError, ValueError):
        return None


def unzip_pages(objects: DataFrame, content: str = "content") -> DataFrame:
    """Replace the zipped content column by ``html``. Partition-local, Arrow batches; one page is unzipped at a time, and
    batches are cut at ``OUTPUT_CHARS`` of text, whatever a batch of zips holds."""
    rest = [f for f in objects.schema.fields if f.name != content]
    schema = T.StructType([*rest, T.StructField("html", T.StringType())])
    names = [f.name for f in rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            zips, html, size, start = batch.column(content), [], 0, 0
            for i in range(batch.num_rows):
                html.append(first_member_text(zips[i].as_py()))
                size += len(html[-1] or "")
                if size >= OUTPUT_CHARS or i + 1 == batch.num_rows:
                    kept = [batch.column(n).slice(start, len(html)) for n in names]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(html, pa.string())], names=[*names, "html"])
                    html, size, start = [], 0, i + 1

    return objects.mapInArrow(run, schema)


def raw_page_source(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """Zip objects below a folder; ``key=value`` path parts become columns."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "false").load(root))
    named = files.withColumn("object_name", F.element_at(F.split("path", "/"), -1)).drop("modificationTime", "length")
    return unzip_pages(named)


CALL_LOG_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("base_url", T.StringType()),
    T.StructField("latency_s", T.DoubleType()),
    T.StructField("usage", T.StructType([
        T.StructField("prompt_tokens", T.LongType()), T.StructField("completion_tokens", T.LongType()),
        T.StructField("total_tokens", T.LongType())])),
    T.StructField("prompt_chars", T.LongType()), T.StructField("response_chars", T.LongType()),
    T.StructField("ts", T.StringType())])


def call_log_source(spark: SparkSession, path: str, model: str | None = None, since=None, until=None) -> DataFrame:
    """Calls of a JSON-lines log. Malformed lines and unreadable timestamps are skipped; both ends
    of the time window are included."""
    log = (spark.read.schema(CALL_LOG_SCHEMA).option("mode", "DROPMALFORMED").json(path)
           .withColumn("ts", F.try_to_timestamp("ts")).where(F.col("ts").isNotNull()))
    if model is not None:
        log = log.where(F.col("model") == model)
    if since is not None:
        log = log.where(F.col("ts") >= F.lit(str(since)).cast("timestamp"))
    if until is not None:
        log = log.where(F.col("ts") <= F.lit(str(until)).cast("timestamp"))
    return log
