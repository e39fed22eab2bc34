"""Operators over hand-written nested records (F1, F3, F4, P4-P6, R1, R2,
M1-M6, W1-W3, X1-X3) and the Q-n decisions."""

import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from palimpsest.functions import attrs as A
from palimpsest.operators import edits as ED
from palimpsest.operators import export as X
from palimpsest.operators import extract as EX
from palimpsest.operators import filters as FL
from palimpsest.operators import order as O
from palimpsest.operators import schema as SC
from palimpsest.sources.model import ATTR_TYPE, ATTRS_TYPE, SCHEMA_ATTR_TYPE, SUB_TYPE
from pyspark.sql import types as T


def attr(key, value="v", err=None, checked=None, subs=None, user_added=False, raw=None):
    d = {f.name: None for f in ATTR_TYPE.fields}
    d.update(key=key, value=value, raw_text=raw if raw is not None else value, cleaning_error=err,
             cleaning_checked=checked, user_added=user_added, edited=False, subattributes=subs)
    return d


def sub(key, value="s", err=None, checked=None, parent="P", user_added=False):
    d = {f.name: None for f in SUB_TYPE.fields}
    d.update(key=key, value=value, raw_text=value, cleaning_error=err, cleaning_checked=checked,
             top_level_attribute=parent, user_added=user_added, is_subattribute=True)
    return d


SCHEMA = T.StructType([T.StructField("record_id", T.LongType()), T.StructField("record_group_id", T.StringType()),
                       T.StructField("name", T.StringType()), T.StructField("review_status", T.StringType()),
                       T.StructField("attributes", ATTRS_TYPE)])


@pytest.fixture(scope="module")
def recs(spark):
    rows = [
        (1, "g1", "1_a", "reviewed", [attr("T", "10"), attr("Sec", "x", err="bad", checked=True),
                                      attr("T", "20", subs=[sub("Sec", "5")])]),
        (2, "g1", "scan_2", "unreviewed", [attr("A", "", err="", checked=True)]),
        (3, "g2", "3_b", "defective", [attr("B", None, subs=[sub("D", err="oops", checked=True)])]),
        (4, "g2", "4_c", None, []),
        (5, "g2", "5_d", "reviewed", None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def col_of(df, c):
    return [r[0] for r in df.orderBy("record_id").select(c).collect()]


def test_error_rules_q2(recs):
    # lenient: non-empty message only; strict: present and not False ('' counts)
    assert col_of(recs.select("record_id", A.has_errors().alias("e")), "e") == [True, False, True, False, False]
    assert col_of(recs.select("record_id", A.has_errors_strict().alias("e")), "e") == [True, True, True, False, False]


def test_first_value_and_hoist(recs):
    assert col_of(recs.select("record_id", A.first_value_of("T").alias("v")), "v") == ["10", "", "", "", ""]
    got = recs.select("record_id", *A.hoist_keys(("T", "Sec"))).orderBy("record_id").collect()
    assert (got[0]["T"], got[0]["Sec"]) == ("20", "5")     # last occurrence, subs after their parent


def test_record_filter(recs):
    s = recs.schema
    q = lambda spec: col_of(recs.where(FL.record_filter(spec, s)).select("record_id"), "record_id")
    assert q({"attributesList.key": "Sec"}) == [1]
    assert q({"attributesList.subattributes.key": "D"}) == [3]
    assert q({"review_status": None}) == [4]
    assert q({"review_status": {"$ne": "reviewed"}}) == [2, 3, 4]
    assert q({"$or": [{"name": {"$regex": "^SCAN", "$options": "i"}}, {"record_id": {"$gte": 5}}]}) == [2, 5]
    assert q({"attributesList": {"$elemMatch": {"key": "T", "value": "20"}}}) == [1]
    assert q({"review_status": {"$nin": ["reviewed", None]}}) == [2, 3]
    assert q({"$nor": [{"record_group_id": "g1"}]}) == [3, 4, 5]
    assert q({"review_status": {"$not": {"$in": ["reviewed"]}}}) == [2, 3, 4]
    with pytest.raises(ValueError):
        FL.record_filter({"$where": "1"}, s)


def test_ordinal_names_w3(recs):
    got = recs.where("record_id = 1").select(O.ordinal_names()).collect()[0][0]
    assert got == ["T", "Sec", "T_2"]


def test_reconcile_read_and_ingest(spark, recs):
    schema = [Row(name="Sec", alias=None, data_type="t", database_data_type="t", occurrence=None, grouping=None,
                  page_order_sort=2.0, cleaning_function=None),
              Row(name="T", alias=None, data_type="t", database_data_type="t", occurrence=None, grouping=None,
                  page_order_sort=1.0, cleaning_function=None),
              Row(name="Z", alias=None, data_type="t", database_data_type="t", occurrence=None, grouping=None,
                  page_order_sort=None, cleaning_function=None),
              Row(name="T::Sec", alias=None, data_type="t", database_data_type="t", occurrence=None, grouping=None,
                  page_order_sort=0.0, cleaning_function=None)]
    sch = F.lit(None).cast(T.ArrayType(SCHEMA_ATTR_TYPE))
    df = recs.where("record_id = 1").withColumn("schema", F.array(*[
        F.struct(*[F.lit(getattr(r, f.name)).cast(f.dataType).alias(f.name) for f in SCHEMA_ATTR_TYPE.fields])
        for r in schema]))
    read = df.select(SC.reconcile_attributes(F.col("attributes"), F.col("schema"), "read").getField("key")).first()[0]
    assert read == ["T", "T", "Sec", "Z"]                    # page order, '::' skipped, blank for Z
    ing = df.select(SC.reconcile_attributes(F.col("attributes"), F.col("schema"), "ingest").getField("key")).first()[0]
    assert ing == ["Sec", "T", "T", "Z"]                     # stored order
    empty = df.select(SC.reconcile_attributes(F.col("attributes"), F.array().cast(T.ArrayType(SCHEMA_ATTR_TYPE)),
                                              "read").getField("key")).first()[0]
    assert empty == ["T", "Sec", "T"]
    assert sch is not None


def test_edit_fold_insert_delete_identity(spark, recs):
    e = spark.createDataFrame([(1, 1, "insert", 0, None, "NEW", "u"), (1, 2, "delete", 1, None, None, "u")],
                              "record_id long, seq long, op string, idx int, sub_idx int, payload string, user string")
    e = e.withColumn("ts", F.current_timestamp())
    new, hist = ED.apply_edits(recs, e)
    got = new.where("record_id = 1").select(F.col("attributes").getField("key")).first()[0]
    assert got == ["T", "Sec", "T"]
    assert hist.count() == 2


def test_edit_replace_sub_and_insert_sub(spark, recs):
    e = spark.createDataFrame([(1, 1, "replace", 2, 0, "99", "u"), (1, 2, "insert", 2, 0, "New", "u"),
                               (3, 1, "insert", 9, None, "K", "u"), (3, 2, "coordinates", 0, None, None, "u")],
                              "record_id long, seq long, op string, idx int, sub_idx int, payload string, user string")
    e = e.withColumn("ts", F.current_timestamp()).withColumn(
        "coords", F.when(F.col("op") == "coordinates", F.array(F.array(F.lit(0.1), F.lit(0.2))))).withColumn(
        "page", F.lit(2))
    new, hist = ED.apply_edits(recs, e)
    r1 = new.where("record_id = 1").first()["attributes"]
    assert [s["key"] for s in r1[2]["subattributes"]] == ["Sec", "New"]
    assert r1[2]["subattributes"][0]["value"] == "99"
    prev = {(h["record_id"], h["seq"]): h["previous_value"] for h in hist.collect()}
    assert prev[(1, 1)] == "5"
    r3 = new.where("record_id = 3").first()["attributes"]
    assert [a["key"] for a in r3] == ["B", "K"] and r3[0]["edited"] and r3[0]["page"] == 2


def test_reset_m6(recs):
    df = recs.where("record_id = 2").select(ED.reset_attributes(F.col("attributes")).alias("a")).first()["a"]
    assert df[0]["cleaning_error"] is None and df[0]["cleaning_checked"] is True


def test_export_cells_and_json(spark, recs):
    df = recs.withColumn("filename", F.lit("f.png"))
    cells = X.export_cells(df, F.array(F.lit("B")), None, "https://o")
    c1 = {c["col"]: c["val"] for c in cells.where("record_id = 1").first()["cells"]}
    assert c1 == {"file": "f.png", "T": "10", "Sec": "x", "T_2[Sec]": "5", "URL": "https://o/record/1"}
    c3 = {c["col"] for c in cells.where("record_id = 3").first()["cells"]}
    assert c3 == {"file", "B[D]", "URL"}
    cols = X.export_columns(cells)
    assert cols[0] == "file" and cols[-1] == "URL"
    wide = X.export_wide(cells, cols)
    assert set(wide.columns) == {"record_id", *cols}
    j = X.export_json(df).where("record_id = 1").first()
    assert j["entries"]["T"]["value"] == "20"                # last wins, raw key


def test_export_wide_has_every_repeat(spark, monkeypatch):
    from palimpsest.plans import q_export as Q
    df = spark.createDataFrame([(1, "g", "1", None, [attr("T", str(i)) for i in range(7)] + [attr("Field 3", subs=[sub("Else", "s")])])], SCHEMA)
    df = df.withColumn("filename", F.lit("f.png"))
    monkeypatch.setattr(Q, "_export_cells", lambda spark, sf, selected=None: X.export_cells(df, None, selected, "https://o"))
    wide = Q.q_export_wide(spark, "")
    assert wide.first().asDict()["T_7"] == "6" and wide.first().asDict()["Field3[Else]"] == "s"
    assert wide.columns[1] == "file" and wide.columns[-1] == "URL" and wide.columns.index("T_7") < wide.columns.index("Field3[Depth]")
    cells = {r["column_name"]: r["value"] for r in Q.q_export_wide_cells(spark, "").collect()}
    assert cells == {"file": "f.png", "URL": "https://o/record/1", "T": "0", "Field3[Else]": "s", **{f"T_{i}": str(i - 1) for i in range(2, 8)}}


def test_skew_safe_rank_matches_window(spark):
    # one scope holds most rows and is cut by many range partitions
    rows = [(i, "hot" if i % 10 else f"g{i % 7}", (i * 7919) % 101 if i % 13 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "record_id long, scope string, k long")
    df = df.withColumn("date_created", F.col("k"))
    for direction in (1, -1):
        a = O.rank_records(df, ["scope"], sort=("dateCreated", direction), partitions=16)
        b = O.rank_records_window(df, ["scope"], sort=("dateCreated", direction))
        cols = ["record_id", "scope", "rank", "prev_id", "next_id", "first_id", "last_id"]
        assert sorted(map(tuple, a.select(cols).collect())) == sorted(map(tuple, b.select(cols).collect()))


def test_edit_recleans_field_m7(spark, recs):
    e = spark.createDataFrame([(1, 1, "replace", 0, None, "4,2 ft", "u"), (1, 2, "replace", 1, None, "abc", "u"),
                               (1, 3, "replace", 2, 0, "7", "u")],
                              "record_id long, seq long, op string, idx int, sub_idx int, payload string, user string")
    e = e.withColumn("ts", F.current_timestamp())
    fns = spark.createDataFrame([("g1", {"T": "string_to_int", "Sec": "string_to_float", "P::Sec": "clean_bool"})],
                                "record_group_id string, fns map<string,string>")
    new, _ = ED.apply_edits(recs, e, clean_with=fns)
    a = new.where("record_id = 1").first()["attributes"]
    assert (a[0]["value"], a[0]["value_type"], a[0]["cleaned"]) == ("42", "int", True)
    assert a[1]["value"] == "abc" and a[1]["cleaning_error"].startswith("string_to_float")
    assert a[2]["subattributes"][0]["cleaning_error"].startswith("clean_bool")


def test_upsert_keeps_each_columns_last_change(spark):
    from palimpsest.operators.edits import upsert_dimension

    table = spark.createDataFrame([("g1", "old", "p0"), ("g2", "b", "p0")], "id string, name string, processor string")
    changes = spark.createDataFrame([("g1", "new", None, 1), ("g1", None, "p1", 2), ("g1", None, "p2", 3)],
                                    "id string, name string, processor string, seq int")
    got = {r.id: (r.name, r.processor) for r in upsert_dimension(table, changes, "id").collect()}
    assert got == {"g1": ("new", "p2"), "g2": ("b", "p0")}
    plain = upsert_dimension(table, changes.drop("seq"), "id").collect()
    assert sorted((r.id, r.name, r.processor) for r in plain) == [("g1", "new", "p2"), ("g2", "b", "p0")]


def test_filter_null_exists_and_flags(spark):
    rows = [(1, None, None, None, [attr("a", None), attr("b", "x")]), (2, None, None, None, [attr("c", "x"), attr("d", "y\nA")]),
            (3, None, None, None, [attr("e", None)]), (4, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    q = lambda spec: col_of(df.where(FL.record_filter(spec, df.schema)).select("record_id"), "record_id")
    p = "attributesList.value"
    assert q({p: None}) == q({p: {"$eq": None}}) == q({p: {"$in": [None]}}) == [1, 3, 4]
    assert q({p: {"$ne": None}}) == [2]
    assert q({p: {"$exists": True}}) == [1, 2] and q({p: {"$exists": False}}) == [3, 4]
    assert q({p: re.compile("^X", re.I)}) == q({p: {"$regex": "^X", "$options": "i"}}) == [1, 2]
    assert q({p: re.compile("^X")}) == [] and q({p: re.compile("^A", re.M)}) == [2] and q({p: re.compile("^A")}) == []
    assert q({p: {"$not": re.compile("^X", re.I)}}) == [3, 4]
    with pytest.raises(ValueError):
        q({p: {"$regex": "x", "$options": "g"}})


def test_export_name_is_free(spark):
    df = spark.createDataFrame([(1, "g", "f", [attr("X", "1"), attr("X_2", "2"), attr("X", "3"), attr("X", "4"), attr("X_2", "5")])],
                               "record_id long, record_group_id string, filename string, attributes "
                               + ATTRS_TYPE.simpleString())
    cells = X.export_cells(df).select(F.inline("cells")).collect()
    assert {c["col"]: c["val"] for c in cells if c["kind"] == 1} == {"X": "1", "X_2": "2", "X_3": "3", "X_4": "4", "X_2_2": "5"}


def test_status_changes_in_order(spark):
    rng, kinds = random.Random(5), ("verification_status", "review_status", "other")
    states = ("unreviewed", "incomplete", "defective", "reviewed", None)
    changes = [(r, s, rng.choice(kinds), rng.choice(states), rng.choice(("required", "verified", None)),
                rng.choice((["tear"], None)), rng.choice(("d1", "d2", None))) for r in range(1, 40) for s in range(rng.randint(0, 5))]
    want = {r: ["reviewed", "required", ["old"], "old", 2] for r in range(1, 40)}
    bad = 0
    for r, _, kind, rs, vs, dc, dd in changes:
        w = want[r]
        if kind == "verification_status" and rs is not None:
            w[:2] = rs, vs
        elif kind == "review_status" and rs in states[:3]:
            w[0] = rs
            if rs == "defective":
                w[2:4] = dc or [], dd
            else:
                w[1] = None
            if rs == "unreviewed":
                w[4] = 1
        else:
            bad += 1
    recs = spark.createDataFrame([(r, "reviewed", "required", ["old"], "old", [attr("a"), attr("b", user_added=True)]) for r in want],
                                 "record_id int, review_status string, verification_status string, "
                                 "defective_categories array<string>, defective_description string, attributes "
                                 + ATTRS_TYPE.simpleString())
    rng.shuffle(changes)
    ch = spark.createDataFrame(changes, "record_id int, seq int, update_type string, review_status string, verification_status string, "
                                        "defective_categories array<string>, defective_description string")
    out, dec = ED.status_edits(recs, ch)
    got = {r["record_id"]: [r["review_status"], r["verification_status"], r["defective_categories"], r["defective_description"],
                            len(r["attributes"])] for r in out.collect()}
    assert got == want
    assert dec.count() == len(changes) and dec.where("not accepted").count() == bad


def test_rejected_edits_leave_no_history(spark, recs):
    e = spark.createDataFrame([(1, 1, "replace", 0, None, "5", "u"), (1, 2, "delete", 9, None, None, "u"),
                               (1, 3, "replace", 0, 7, "6", "u"), (1, 4, "insert", 9, 0, "K", "u"), (1, 5, "odd", 0, None, "K", "u")],
                              "record_id long, seq long, op string, idx int, sub_idx int, payload string, user string")
    e = e.withColumn("ts", F.current_timestamp())
    new, hist = ED.apply_edits(recs, e)
    attrs = new.where("record_id = 1").first()["attributes"]
    assert [h["seq"] for h in hist.collect()] == [1] and attrs[0]["value"] == "5" and len(attrs) == 3
    got = {r["seq"]: r["reason"] for r in ED.rejected_edits(recs, e).collect()}
    assert got == {2: "no attribute at that position", 3: "no sub-attribute at that position",
                   4: "no attribute at that position", 5: "unknown operation"}


def test_sub_attributes_only_where_listed(spark, recs):
    fields = lambda **k: EX.project_records(recs, attribute_fields=k["fields"], sub_fields=k.get("subs")) \
        .schema["attributes"].dataType.elementType.fieldNames()
    assert fields(fields=["key"], subs=["key"]) == ["key"] and fields(fields=["key"]) == ["key"]
    assert fields(fields=["key", "subattributes"], subs=["key"]) == ["key", "subattributes"]


NAV = ["record_id", "rank", "prev_id", "next_id", "first_id", "last_id"]


@pytest.mark.parametrize("direction", [1, -1])
@pytest.mark.parametrize("reuse", ["true", "false"])
def test_rank_holds_without_exchange_reuse(spark, direction, reuse):
    df = spark.range(3000).selectExpr("id as record_id", "case when id % 3 = 0 then null when id % 3 = 1 then 'a' else concat('g', id % 50) end as g",
                                      "case when id % 11 = 0 then null else (id * 7919) % 40 end as date_created")
    want = {r[0]: tuple(r) for r in O.rank_records_window(df.fillna("?", ["g"]), ["g"], ("dateCreated", direction)).select(*NAV).collect()}
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = {r[0]: tuple(r) for r in O.rank_records(df, ["g"], ("dateCreated", direction), partitions=7).select(*NAV).collect()}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert got == want


@pytest.mark.parametrize("direction", [1, -1])
def test_navigate_any_scope_and_direction(spark, direction):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else "a", None if i % 4 == 0 else i % 5) for i in range(30)],
                               "record_id long, g string, date_created long")
    for scope in (["g"], []):
        every = {r[0]: tuple(r) for r in O.navigate_all(df, scope, ("dateCreated", direction)).select(*NAV).collect()}
        for t in (0, 3, 7):
            assert tuple(O.navigate(df, t, scope, ("dateCreated", direction)).select(*NAV).first()) == every[t]
