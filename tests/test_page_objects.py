"""The page object source: pruned listing, splits, broken objects, late objects on a stream, repeated writes."""

import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F

from siftgate.sources import page_objects as po

TEMPLATE = "layer=raw/platform_id={platform_id}/date_stamp={date_stamp}/hour_stamp={hour_stamp}/"


@pytest.fixture
def root(spark, tmp_path):
    pages = spark.range(48).selectExpr(
        "concat('p', id % 2) AS platform_id", "date_add(DATE '2024-01-01', CAST(id % 3 AS INT)) AS date_stamp", "CAST(id % 4 AS INT) AS hour_stamp",
        "concat('o', id, '.zip') AS object_name", "concat('<p>é', id, '</p>') AS html", "id AS other")
    po.write_page_objects(pages, str(tmp_path / "objects"), TEMPLATE)
    return str(tmp_path / "objects")


def test_only_wanted_folders_are_listed(spark, root):
    listing = po.Listing({"path": root, "template": TEMPLATE})
    assert len(listing.folders()) == 12
    listing.wanted = [po.Wanted("date_stamp", po.GreaterThan, dt.date(2024, 1, 1)), po.Wanted("hour_stamp", po.In, (1, 3)), po.Wanted("platform_id", po.EqualTo, "p1")]
    assert {v for _, v in listing.folders()} == {("p1", dt.date(2024, 1, d), h) for d in (2, 3) for h in (1, 3)}
    df = po.page_objects(spark, root, TEMPLATE).where("date_stamp = DATE '2024-01-02' AND hour_stamp IN (1, 3) AND platform_id = 'p1'")
    assert "EqualTo(date_stamp,2024-01-02)" in df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert df.rdd.getNumPartitions() == 2
    assert sorted(r["object_name"] for r in df.collect()) == sorted(f"o{i}.zip" for i in range(48) if i % 2 and i % 3 == 1 and i % 4 in (1, 3))


@pytest.mark.parametrize("splits", [1, 3])
def test_whole_table(spark, root, splits):
    rows = po.page_objects(spark, root, TEMPLATE, splits).collect()
    assert {(r["object_name"], r["html"], r["hour_stamp"]) for r in rows} == {(f"o{i}.zip", f"<p>é{i}</p>", i % 4) for i in range(48)} and len(rows) == 48
    assert po.page_objects(spark, root, TEMPLATE).where("platform_id = 'none' AND html LIKE '%é%'").collect() == []


def test_strange_objects(spark, root, tmp_path):
    folder = tmp_path / "objects/layer=raw/platform_id=p0/date_stamp=2024-01-01/hour_stamp=0"
    (folder / "broken.zip").write_bytes(b"PK no zip")
    with zipfile.ZipFile(folder / "empty.zip", "w"):
        pass
    (folder / "note.txt").write_text("not an object")
    (tmp_path / "objects/layer=raw/platform_id=p0/date_stamp=soon/hour_stamp=x").mkdir(parents=True)
    (tmp_path / "objects/other").mkdir()
    with zipfile.ZipFile(tmp_path / "objects/layer=raw/platform_id=p0/date_stamp=soon/hour_stamp=x/odd.zip", "w") as z:
        z.writestr("a", "odd")
    rows = {r["object_name"]: r for r in po.page_objects(spark, root, TEMPLATE).collect()}
    assert len(rows) == 51 and rows["broken.zip"]["html"] is None and rows["empty.zip"]["html"] is None
    assert (rows["odd.zip"]["date_stamp"], rows["odd.zip"]["hour_stamp"], rows["odd.zip"]["html"]) == (None, None, "odd")
    assert "odd.zip" not in {r["object_name"] for r in po.page_objects(spark, root, TEMPLATE).where("hour_stamp >= 0").collect()}


def test_repeated_write_replaces(spark, root):
    again = spark.sql("SELECT 'p1' AS platform_id, DATE '2024-01-02' AS date_stamp, 1 AS hour_stamp, 'o1.zip' AS object_name, 'new' AS html")
    po.write_page_objects(again, root, TEMPLATE)
    rows = po.page_objects(spark, root, TEMPLATE).collect()
    assert len(rows) == 48 and [r["html"] for r in rows if r["object_name"] == "o1.zip"] == ["new"]


def test_rows_without_slot_value_are_refused(spark, tmp_path):
    bad = spark.sql("SELECT CAST(NULL AS STRING) AS platform_id, DATE '2024-01-02' AS date_stamp, 1 AS hour_stamp, 'o.zip' AS object_name, 'x' AS html")
    with pytest.raises(Exception, match="an object needs"):
        po.write_page_objects(bad, str(tmp_path / "o"), TEMPLATE)
    with pytest.raises(Exception, match="need the columns"):
        po.write_page_objects(bad.drop("html"), str(tmp_path / "o"), TEMPLATE)


def test_stream_reads_each_object_once_and_late_ones_too(spark, root, tmp_path):
    stream = po.page_object_stream(spark, root, TEMPLATE, settle_seconds=0)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(r["object_name"] for r in spark.read.schema(stream.schema).parquet(out).collect())

    first = run()
    assert len(first) == 48 and run() == first
    late = po.page_objects(spark, root, TEMPLATE).where("hour_stamp = 0").withColumn("object_name", F.concat(F.lit("late_"), "object_name"))
    po.write_page_objects(late, root, TEMPLATE)
    assert run() == sorted(first + [f"late_o{i}.zip" for i in range(0, 48, 4)])
    assert po.page_object_stream(spark, root, TEMPLATE, settle_seconds=3600).isStreaming
