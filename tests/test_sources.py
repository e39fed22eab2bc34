"""File sources and sinks on hand-written files."""

import json
import os
import struct
import tempfile
import zlib

from pyspark.sql import functions as F

from palimpsest.operators import export as X
from palimpsest.operators import images as I
from palimpsest.operators import schema as SC


def test_schema_csv(spark):
    d = tempfile.mkdtemp(prefix="pal-csv-")
    with open(os.path.join(d, "s.csv"), "w") as f:
        f.write("Name,Google Data Type,Database Data Type,Page Order Sort,Cleaning Function,Extra\n")
        f.write("Depth,number,float,2,string_to_float,zzz\n")
        f.write("Well Name,text,varchar,,,\n")
    rows = {r["name"]: r for r in SC.read_schema_csv(spark, d).collect()}
    assert rows["Depth"]["data_type"] == "number" and rows["Depth"]["page_order_sort"] == 2.0
    assert rows["Well Name"]["page_order_sort"] is None
    assert "Extra" not in SC.read_schema_csv(spark, d).columns
    assert rows["Depth"]["alias"] is None
    legacy = SC.remap_legacy_keys(spark.read.option("header", True).csv(d))
    assert {"name", "google_data_type", "Extra"} <= set(legacy.columns)


def test_schema_json(spark):
    d = tempfile.mkdtemp(prefix="pal-json-")
    with open(os.path.join(d, "s.json"), "w") as f:
        json.dump([{"name": "A", "google_data_type": "text", "junk": 1}, 5, "x",
                   {"name": "B", "data_type": "number", "page_order_sort": "3"}], f)
    rows = {r["name"]: r for r in SC.read_schema_json(spark, d).collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"]["data_type"] == "text" and rows["B"]["page_order_sort"] == 3.0


def _png(path, w, h, rgb):
    raw = b"".join(b"\x00" + bytes(rgb) * w for _ in range(h))

    def chunk(t, data):
        return struct.pack(">I", len(data)) + t + data + struct.pack(">I", zlib.crc32(t + data) & 0xFFFFFFFF)
    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
                + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_images_and_listing(spark):
    d = tempfile.mkdtemp(prefix="pal-img-")
    _png(os.path.join(d, "white.png"), 4, 3, (255, 255, 255))
    _png(os.path.join(d, "ink.png"), 2, 2, (10, 250, 10))
    with open(os.path.join(d, "broken.png"), "wb") as f:
        f.write(b"not an image")
    pages = I.read_pages(spark, d)
    got = {os.path.basename(r["origin"]): r["s"] for r in
           pages.select("image.origin", I.image_white_share(F.col("image"), "all", 240, 99.99).alias("s")).collect()}
    assert got["white.png"]["whitespace_pct"] == 100.0 and got["white.png"]["meets_threshold"] is True
    assert got["ink.png"]["white_pixels"] == 0
    assert got["broken.png"]["total_pixels"] is None and got["broken.png"]["meets_threshold"] is False
    anym = pages.select("image.origin", I.image_white_share(F.col("image"), "any", 240).alias("s")).collect()
    assert {os.path.basename(r["origin"]): r["s"]["white_pixels"] for r in anym}["ink.png"] == 4
    listing = {os.path.basename(r["path"]): r["length"] for r in X.list_documents(spark, d).collect()}
    assert listing["broken.png"] == 12


def test_csv_json_sinks(spark):
    d = tempfile.mkdtemp(prefix="pal-out-")
    df = spark.createDataFrame([(1, "a", "t1"), (2, None, "t2")], "record_id long, T string, document_type string")
    X.write_csv_export(df, f"{d}/csv")
    assert {"document_type=t1", "document_type=t2"} <= set(os.listdir(f"{d}/csv"))
    back = spark.read.option("header", True).csv(f"{d}/csv")
    assert back.count() == 2
    X.write_json_export(df.withColumn("ts", F.current_timestamp()), f"{d}/json")
    line = spark.read.text(f"{d}/json/document_type=t1").first()[0]
    assert len(json.loads(line)["ts"]) == 10          # ISO date only


def test_schema_edits(spark):
    rows = spark.createDataFrame(
        [("p", 0, "A", None, "text", "varchar", None, None, 1.0, None),
         ("p", 1, "B", None, "text", "varchar", None, None, 2.0, "clean_bool")],
        "processor_id string, pos int, name string, alias string, data_type string, database_data_type string, "
        "occurrence string, grouping string, page_order_sort double, cleaning_function string")
    edits = spark.createDataFrame(
        [("p", 1, "add", "C", {"data_type": "number", "database_data_type": "float", "alias": ""}),
         ("p", 2, "add", "D", {"data_type": "number"}),
         ("p", 3, "delete", "A", {}),
         ("p", 4, "update", "B", {"cleaning_function": "", "name": "B2"}),
         ("p", 5, "delete", "Q", {}),
         ("p", 6, "update", "X", {"bogus": "1"})],
        "processor_id string, seq long, op string, name string, fields map<string,string>")
    new, rejected = SC.apply_schema_edits(rows, edits)
    got = {r["name"]: r for r in new.collect()}
    assert set(got) == {"B2", "C"}
    assert got["B2"]["cleaning_function"] is None and got["C"]["alias"] is None and got["C"]["pos"] == 2
    reasons = {r["name"]: r["reason"] for r in rejected.collect()}
    assert set(reasons) == {"D", "Q", "X"}
    bad = SC.invalid_schema_updates(edits.where("name = 'X'"))
    assert bad.first()["bad_fields"] == ["bogus"]
