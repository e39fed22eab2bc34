"""Whole attributes and lists, edits that must not pass, exports as one job, page files."""

import json
import os
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import edits as ED
from palimpsest.operators import export as X
from palimpsest.operators import extract as E
from palimpsest.operators import images as I
from palimpsest.session import work_folder
from palimpsest.sources import model as M


def attribute(key, value, subs=None):
    sub = [dict.fromkeys(ED.SUB_TYPE.fieldNames()) | {"key": k, "value": v} for k, v in subs] if subs is not None else None
    return dict.fromkeys(ED.ATTR_TYPE.fieldNames()) | {"key": key, "value": value, "value_type": "string", "subattributes": sub}


RECORD = f"record_id long, record_group_id string, review_status string, verification_status string, defective_categories array<string>, defective_description string, attributes {ED.ATTRS_TYPE.simpleString()}"


@pytest.fixture(scope="module")
def records(spark):
    rows = [(i, "g", "unreviewed", None, None, None, [attribute("a", "1"), attribute("b", "2", [("x", "3"), ("y", "4")]), attribute("a", "5")]) for i in range(4)]
    return spark.createDataFrame([*rows, (9, "g", "reviewed", None, None, None, None)], RECORD)


def keys(df):
    return {r.record_id: [a.key for a in r.attributes or []] for r in df.collect()}


EDIT = "record_id long, seq int, op string, idx int, sub_idx int, payload string, user string, ts timestamp"


def test_no_bad_edit_stops_the_batch_or_passes(spark, records):
    bad = [("insert", -2, None), ("insert", -5, None), ("insert", None, None), (None, 0, None), ("insert", 1, -3), ("replace", None, None),
           ("delete", -1, None), ("replace", 1, 7), ("patch", 0, None), ("attribute", 0, None), ("insert", None, 0)]
    edits = spark.createDataFrame([(0, k, op, i, j, "p", "u", None) for k, (op, i, j) in enumerate(bad)] + [(0, 50, "insert", 7, None, "end", "u", None)], EDIT)
    new, history = ED.apply_edits(records, edits)
    assert keys(new)[0] == ["a", "b", "a", "end"] and [r.seq for r in history.collect()] == [50]
    assert sorted(r.seq for r in ED.rejected_edits(records, edits).collect()) == list(range(len(bad)))


def test_whole_attribute_replaced_in_its_turn(spark, records):
    new = attribute("n", "9", [("z", "0")])
    rows = [(0, 1, "attribute", 1, None, None, "u", None, new, "unreviewed"), (0, 2, "attribute", 1, 0, None, "u", None, attribute("w", "8"), "reviewed"),
            (0, 3, "attribute", 1, 1, None, "u", None, new, None), (1, 1, "attribute", 9, None, None, "u", None, new, "unreviewed"),
            (2, 1, "attribute", 0, None, None, "u", None, None, "unreviewed"), (3, 1, "replace", 0, None, "v", "u", None, None, None)]
    edits = spark.createDataFrame(rows, EDIT + f", attribute {ED.ATTR_TYPE.simpleString()}, review_status string")
    out, history = ED.apply_edits(records, edits)
    got = {r.record_id: r for r in out.collect()}
    assert [s.key for s in got[0].attributes[1].subattributes] == ["w"] and got[0].attributes[1].key == "n"
    assert {i: got[i].review_status for i in range(4)} == {0: "incomplete", 1: "unreviewed", 2: "unreviewed", 3: "unreviewed"}
    before = {(r.record_id, r.seq): r.previous_value for r in history.collect()}
    assert set(before) == {(0, 1), (0, 2), (3, 1)}
    assert json.loads(before[0, 1])["key"] == "b" and json.loads(before[0, 2])["key"] == "z" and before[3, 1] == "1"
    assert {(r.record_id, r.reason) for r in ED.rejected_edits(records, edits).collect()} == {
        (0, "no sub-attribute at that position"), (1, "no attribute at that position"), (2, "no attribute given")}


def test_lists_replaced_with_their_differences(spark, records):
    a, b = attribute("a", "1"), attribute("c", "7")
    rows = [(0, 2, [b, a], "u", None), (0, 1, [a], "u", None), (9, 1, [a], "u", None), (1, 1, None, "u", None)]
    changes = spark.createDataFrame(rows, f"record_id long, seq int, attributes {ED.ATTRS_TYPE.simpleString()}, user string, ts timestamp")
    new, history = ED.replace_lists(records, changes)
    assert {k: v for k, v in keys(new).items()} == {0: ["c", "a"], 1: [], 2: ["a", "b", "a"], 3: ["a", "b", "a"], 9: ["a"]}
    got = sorted((r.record_id, r.seq, r.idx, r.change) for r in history.collect())
    assert got == [(0, 1, 1, "removed"), (0, 1, 2, "removed"), (0, 2, 0, "changed"), (0, 2, 1, "added"),
                   (1, 1, 0, "removed"), (1, 1, 1, "removed"), (1, 1, 2, "removed"), (9, 1, 0, "added")]


def test_fields_set_and_cleared(spark, records):
    rows = [(0, 1, "defective", "d", None), (0, 2, None, None, True), (1, 1, "reviewed", "e", None)]
    changes = spark.createDataFrame(rows, "record_id long, seq int, review_status string, defective_description string, set_defective_description boolean")
    got = {r.record_id: (r.review_status, r.defective_description) for r in ED.set_fields(records, changes).collect()}
    assert got[0] == ("defective", None) and got[1] == ("reviewed", None) and got[2] == ("unreviewed", None)


def test_status_change_without_a_type_is_rejected(spark, records):
    change = "record_id long, seq int, update_type string, review_status string, verification_status string, defective_categories array<string>, defective_description string"
    new, decided = ED.status_edits(records, spark.createDataFrame([(0, 1, None, "defective", None, None, None)], change))
    assert [r.reason for r in decided.collect()] == ["invalid update type"] and new.where("record_id = 0").first().review_status == "unreviewed"


def test_default_processor_takes_the_first_entitys_properties(spark):
    entity = {"type": "page", "mention_text": "m", "confidence": 0.5, "properties": [{"type": "p", "mention_text": "1"}, {"type": "q", "mention_text": "2"}]}
    rows = [(1, json.dumps([entity, entity]), True), (2, json.dumps([]), True), (3, json.dumps([{"type": "x", "mention_text": "3"}]), True),
            (4, json.dumps([entity]), False), (5, "no", True), (6, json.dumps([entity]), None)]
    df = spark.createDataFrame(rows, "record_id long, payload string, general boolean")
    got = {r.record_id: ([a.key for a in r.attributes], r.parse_ok) for r in E.extract_attributes(df, default_processor=F.col("general")).collect()}
    assert got == {1: (["p", "q"], True), 2: ([], True), 3: ([], True), 4: (["page"], True), 5: ([], False), 6: (["page"], True)}


def test_json_export_has_keys_beside_the_file(spark):
    rows = [(1, "f.png", [attribute("a", None), attribute("file", "x"), attribute("a", "2")]), (2, None, None)]
    df = spark.createDataFrame(rows, f"record_id long, filename string, attributes {ED.ATTRS_TYPE.simpleString()}")
    got = {r.record_id: json.loads(r.json) for r in X.export_json(df).collect()}
    assert got[2] == {"file": ""} and got[1]["file"] == "f.png" and got[1]["a"]["value"] == "2" and "confidence" in got[1]["a"]
    assert {r.record_id: set(json.loads(r.json)) for r in X.export_json(df, ["b"]).collect()} == {1: {"file"}, 2: {"file"}}


def test_export_counts_only_when_complete(spark, sf, monkeypatch):
    path = work_folder(spark, "download")
    args = (M.load_records(spark, sf), M.load_record_groups(spark, sf), M.load_processors(spark, sf), path, "record_group")
    group = M.load_records(spark, sf).groupBy("record_group_id").count().orderBy(F.desc("count")).first().record_group_id
    manifest = X.export_job(*args, group, formats=("csv", "json"), columns=["T"], origin="o")
    n = M.load_records(spark, sf).where(F.col("record_group_id") == group).count()
    assert {(r.kind, r["rows"]) for r in manifest.groupBy("kind").agg(F.sum("rows").alias("rows")).collect()} == {("csv", n), ("json", n)}
    for r in manifest.collect():
        assert os.path.getsize(f"{path}/{r.file}") == r.bytes
    assert {c for c in X.read_export(spark, path, "csv").columns} <= {"file", "URL", "document_type", "T", *(f"T_{i}" for i in range(2, 9))}

    def stop(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(X, "written_files", stop)
    with pytest.raises(RuntimeError):
        X.export_job(*args, group, formats=("json",))
    with pytest.raises(ValueError):
        X.read_export(spark, path, "json")
    monkeypatch.undo()
    X.export_job(*args, "no such group", formats=("csv", "json", "images"))
    assert X.read_export(spark, path, "json").count() == 0 and X.read_export(spark, path, "manifest").count() == 0


def test_page_files_score_like_their_pixels(spark):
    px = [[(255, 255, 255), (240, 240, 239), (0, 9, 250)], [(1, 2, 3)], [(255, 0, 255)] * 7]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(px)], "page int, px array<struct<r:int,g:int,b:int>>")
    path = work_folder(spark, "pages")
    I.write_pages(df.select("page", I.bitmap(F.col("px")).alias("data")).unionByName(spark.createDataFrame([(9, b"broken")], "page int, data binary")), path)
    for mode in I.REDUCTIONS:
        want = {r.page: r.s for r in df.select("page", I.white_share(F.col("px"), mode, 239, 50.0).alias("s")).collect()}
        got = {r.page: r.s for r in I.read_pages(spark, path).select("page", I.image_white_share(F.col("image"), mode, 239, 50.0).alias("s")).collect()}
        assert got.pop(9).total_pixels is None and got == want


def test_page_files_are_written_by_many_tasks_one_file_a_page(spark):
    path = work_folder(spark, "pages")
    pages = spark.range(0, 40, 1, 1).select((F.col("id") % 20).alias("page"), F.lit(b"a page").alias("data"))
    I.write_pages(pages.unionByName(pages), path)
    files = [str(f) for f in pathlib.Path(path).rglob("part-*")]
    assert len(files) == 20
    assert len({re.search(r"part-(\d+)", f).group(1) for f in files}) > 4


def test_page_files_are_listed_by_few_folders_and_keyed_by_their_path(spark):
    path = work_folder(spark, "pages")
    keys = [0, 7, -3, 2 ** 40, None, 7]
    df = spark.createDataFrame([(k, [(255, 0, 9)] * (i + 1)) for i, k in enumerate(keys)], "page long, px array<struct<r:int,g:int,b:int>>")
    I.write_pages(df.select("page", I.bitmap(F.col("px")).alias("data")), path)
    files = [str(f.relative_to(path)) for f in pathlib.Path(path).rglob("*") if f.is_file()]
    assert not [f for f in files if f.endswith(".crc") and "part-" in f]
    assert all(re.fullmatch(r"_task=\d+/page=[^/]+/part-.*|_SUCCESS|\._SUCCESS\.crc", f) for f in files)
    got = I.read_pages(spark, path)
    # no partition a page: discovering those takes time with the square of their number
    assert re.search(r"Relation \[image#\d+\] image", got._jdf.queryExecution().analyzed().toString())
    rows = {r.page: r.w for r in got.select("page", F.col("image.width").alias("w")).collect()}
    assert rows.pop(7) in (2, 6) and rows == {0: 1, -3: 3, 2 ** 40: 4, None: 5}


def test_page_names_are_read_as_they_were_written(spark):
    path = work_folder(spark, "pages")
    names = ["a b", "a+b", "50%", "x/y", "p=q", "\u00e9", "%2B"]
    df = spark.createDataFrame([(n, [(1, 2, 3)] * (i + 1)) for i, n in enumerate(names)], "name string, px array<struct<r:int,g:int,b:int>>")
    I.write_pages(df.select("name", I.bitmap(F.col("px")).alias("data")), path, key="name")
    rows = I.read_pages(spark, path, key="name", dtype="string").select("name", F.col("image.width").alias("w")).collect()
    assert {r.name: r.w for r in rows} == {n: i + 1 for i, n in enumerate(names)}
