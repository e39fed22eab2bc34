"""Typed payloads, append logs, one-pass deletion, schema edits in chains, ranks with text ids."""

import json
import random

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import history as H
from palimpsest.operators import order as O
from palimpsest.operators import schema as SC
from palimpsest.operators import typed_history as TH
from palimpsest.operators.graph import components
from palimpsest.operators.log import AppendLog
from palimpsest.session import work_folder


# --- typed payloads

PAYLOAD = {
    "attributesList.2": {"key": "a", "value": 1, "subattributes": [{"value": 2.0}, {"key": "s", "value": True}, {"value": "t", "other": {"key": "k", "value": 5}}]},
    "attributesList": [{"value": 3, "nested": {"key": "k", "value": 4}, "subattributes": [{"value": 6.5}]}],
    "plain": {"value": 7}, "pair": {"key": None, "value": 8}, "odd key": [[{"value": 9}]], "n": None,
}


def test_only_attribute_values_are_tagged():
    got = {p: (kind, own) for p, kind, _, _, own in TH.leaves(PAYLOAD)}
    assert {p for p, (_, own) in got.items() if own} == {
        '$."attributesList.2".value', '$."attributesList.2".subattributes[0].value', '$."attributesList.2".subattributes[1].value',
        '$."attributesList.2".subattributes[2].value', '$."attributesList.2".subattributes[2].other.value',
        "$.attributesList[0].value", "$.attributesList[0].subattributes[0].value", "$.pair.value", '$."odd key"[0][0].value'}
    assert got['$."attributesList.2".subattributes[1].value'][0] == "boolean" and got["$.n"][0] == "null"
    assert got['$."attributesList.2".subattributes[0].value'][0] == "float" and got["$.plain.value"][0] == "int"


def test_typed_values_by_action_and_depth(spark):
    deep = '{"a":' * 400 + '{"key": "k", "value": 1.5}' + "}" * 400
    rows = [(1, "updateRecord", json.dumps(PAYLOAD), None), (2, "other", json.dumps(PAYLOAD), None), (3, "updateRecord", "not json", None),
            (4, "updateRecord", deep, None), (5, "cleanRecord", '{"key": "k", "value": 1}', '[{"value": 1}, {"value": false}, 3]'),
            (6, "cleanRecord", None, None), (7, "updateRecord", "[" * 100_000, None), (8, "updateRecord", "{}", None)]
    df = spark.createDataFrame(rows, "history_id long, action string, query string, attributesList_before string")
    got = TH.typed_values(df, keep=("history_id",)).collect()
    tags = {(r.history_id, r.path): r.num_type for r in got if r.num_type}
    assert len([k for k in tags if k[0] == 1]) == 7 and not [k for k in tags if k[0] in (2, 3)]
    assert tags[(4, "$" + ".a" * 400 + ".value")] == "float"
    assert [(r.field, r.path, r.leaf_type, r.num_type) for r in got if r.history_id == 5 and r.field != "query"] == [
        ("attributesList_before", "$[2]", "int", None), ("attributesList_before", "$[1].value", "boolean", None), ("attributesList_before", "$[0].value", "int", "int")]
    assert {(r.history_id, r.leaf_type) for r in got if r.leaf_type == "unreadable"} == {(3, "unreadable"), (7, "unreadable")}


def test_one_records_history_is_newest_first(spark):
    df = spark.createDataFrame([(i, i % 3, i % 5) for i in range(30)], "history_id long, record_id long, ts long")
    got = [(r.ts, r.history_id) for r in TH.record_history(df, 1).collect()]
    assert got == sorted(((i % 5, i) for i in range(30) if i % 3 == 1), reverse=True)


# --- append logs

def test_batches_are_appended_once(spark):
    log = AppendLog(spark, work_folder(spark, "log"), spark.range(1).schema)
    assert log.read().count() == 0
    log.append(spark.range(3), "a.b/1_x")
    log.append(spark.range(3), "a.b/1_x")
    log.append(spark.range(10, 12), "2")
    log.write(spark.range(50, 60), "2")
    log.write(spark.range(50, 60), "3")
    assert sorted(r.id for r in log.read().collect()) == [0, 1, 2, 10, 11]
    log.append(spark.range(20, 21), "2")
    assert sorted(r.id for r in log.read().collect()) == [0, 1, 2, 20]
    assert log.clean(older_than=0) == 4
    assert sorted(r.id for r in log.read().collect()) == [0, 1, 2, 20] and set(log.batches()) == {"a.b/1_x", "2"}


# --- deletion

def test_deletion_splits_in_one_scan(spark):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else i % 5) for i in range(50)], "record_id long, g int")
    doomed = spark.createDataFrame([(1,), (1,), (4,), (None,), (99,)], "g int")
    tagged = H.tag_deleted(rows, doomed, "g", "me")
    assert tagged._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2  # rows and keys, once each
    kept, archived = H.split(tagged)
    assert sorted(r.record_id for r in archived.collect()) == [i for i in range(50) if i % 7 and i % 5 in (1, 4)]
    assert {r.deleted_by for r in archived.collect()} == {"me"} and kept.columns == ["record_id", "g"]
    assert kept.count() + archived.count() == 50


# --- schema edits

FIELDS = {"data_type": "t", "database_data_type": "d"}


def plain_schema_edits(rows, edits):
    """The edits one by one, as a list of (name, alias, order) by processor."""
    state = {p: [[n, None, None] for n in names] for p, names in rows.items()}
    rejected = []
    for p, seq, op, name, f in sorted(edits, key=lambda e: e[1]):
        f = f or {}
        target = ((f.get("name") if op == "add" else None) or name) or None
        mine = state.get(p)
        at = [i for i, r in enumerate(mine or []) if target is not None and r[0] == target]
        order = f.get("page_order_sort") or None
        bad = set(f) - set(SC.EDITABLE)
        number = order is None or order.replace(".", "", 1).isdigit()
        reason = (SC.UNKNOWN_PROCESSOR if mine is None else SC.UNKNOWN_OPERATION if op not in ("add", "delete", "update") else SC.NO_NAME if target is None
                  else SC.NAME_TAKEN if op == "add" and at else SC.TYPES_NEEDED if op == "add" and not (f.get("data_type") and f.get("database_data_type"))
                  else SC.NO_ATTRIBUTE if op != "add" and not at else SC.BAD_FIELD if op != "delete" and bad else SC.BAD_ORDER if op != "delete" and not number else None)
        if reason:
            rejected.append((p, seq, reason))
        elif op == "add":
            mine.append([target, f.get("alias") or None, float(order) if order else None])
        elif op == "delete":
            state[p] = [r for r in mine if r[0] != target]
        else:
            r = mine[at[0]]
            r[0] = (f["name"] or None) if "name" in f else r[0]
            r[1] = (f["alias"] or None) if "alias" in f else r[1]
            r[2] = (float(order) if order else None) if "page_order_sort" in f else r[2]
    return state, rejected


@pytest.mark.parametrize("seed", [1, 2])
def test_schema_edits_match_one_by_one(spark, seed):
    rnd = random.Random(seed)
    rows = {f"p{i}": rnd.choices("abcdefgh", k=rnd.randint(1, 5)) for i in range(12)}  # names may repeat
    edits = []
    for seq in range(400):
        op = rnd.choice(["add", "delete", "update", "update", "update", None, "drop"] if seq % 40 == 0 else ["add", "delete", "update", "update", "update"])
        f = {}
        if op == "add":
            f = dict(FIELDS) if rnd.random() < 0.9 else {"data_type": "", "database_data_type": "d"}
        if rnd.random() < 0.4:
            f["name"] = rnd.choice([*"abcdefgh", "", None])
        if rnd.random() < 0.3:
            f["alias"] = rnd.choice(["x", "", None, "y"])
        if rnd.random() < 0.3:
            f["page_order_sort"] = rnd.choice(["1", "2.5", "abc", "", None])
        if rnd.random() < 0.05:
            f["bogus"] = "1"
        edits.append((rnd.choice([*rows, *rows, "nowhere"]), seq, op, rnd.choice([*"abcdefgh", *"abcdefgh", "", None]), f or None))
    flat = [(p, i, n) for p, names in rows.items() for i, n in enumerate(names)]
    text = F.lit(None).cast("string")
    schema = spark.createDataFrame(flat, "processor_id string, pos int, name string").select(
        "*", *[(F.lit(None).cast("double") if f == "page_order_sort" else text).alias(f) for f in SC.EDITABLE if f != "name"])
    new, rejected = SC.apply_schema_edits(schema, spark.createDataFrame(edits, "processor_id string, seq long, op string, name string, fields map<string,string>"))
    want, lost = plain_schema_edits(rows, edits)
    assert sorted((r.processor_id, r.seq, r.reason) for r in rejected.collect()) == sorted(lost)
    got = {}
    for r in sorted(new.collect(), key=lambda r: r.pos):
        got.setdefault(r.processor_id, []).append([r["name"], r.alias, r.page_order_sort])
    assert got == {p: rs for p, rs in want.items() if rs}


def test_schema_edits_of_empty_tables(spark):
    schema = spark.createDataFrame([], "processor_id string, pos int, " + ", ".join(f"{f} string" for f in SC.EDITABLE))
    edits = spark.createDataFrame([("p", 1, "add", "a", FIELDS)], "processor_id string, seq long, op string, name string, fields map<string,string>")
    new, rejected = SC.apply_schema_edits(schema, edits)
    assert new.collect() == [] and [r.reason for r in rejected.collect()] == [SC.UNKNOWN_PROCESSOR]
    new, rejected = SC.apply_schema_edits(schema, edits, processors=spark.createDataFrame([("p",)], "processor_id string"))
    assert [(r["name"], r.pos) for r in new.collect()] == [("a", 0)] and rejected.collect() == []


def test_whole_processors(spark):
    have = spark.createDataFrame([("a", "m1", "d1"), ("b", "m2", "d2"), ("c", "m3", "d3")], "name string, model_id string, document_type string")
    changes = [("a", 1, "update", "n", None), ("a", 2, "delete", None, None), ("a", 3, "update", "x", None), ("a", 4, "upsert", None, "e"),
               ("b", 1, "delete", None, None), ("new", 1, "update", "u", None), ("new", 2, "upsert", "v", None), ("c", 5, None, "z", None), (None, 6, "upsert", "z", None)]
    new, outcome = SC.edit_processors(have, spark.createDataFrame(changes, "name string, seq long, op string, model_id string, document_type string"))
    assert sorted(map(tuple, new.collect())) == [("a", None, "e"), ("c", "m3", "d3"), ("new", "v", None)]
    assert {(r["name"], r.seq) for r in outcome.collect() if not r.accepted} == {("a", 3), ("new", 1), ("c", 5), (None, 6)}


def test_components_of_long_paths(spark):
    links = [(f"x{i:03d}", f"x{i + 1:03d}") for i in range(60)] + [("y1", "y2"), ("y2", "y1"), ("z", "z")]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {f"x{i:03d}": "x000" for i in range(61)} | {"y1": "y1", "y2": "y1"}


# --- ranks

@pytest.mark.parametrize("direction", [1, -1])
def test_rank_of_text_ids_in_one_exchange(spark, direction):
    df = spark.range(2000).selectExpr("concat(case when id % 2 = 0 then 'a' else 'ab' end, id) as record_id",
                                      "case when id % 4 > 0 then 'hot' else concat('g', id % 9) end as g", "id % 7 as date_created")
    cols = ["record_id", "g", "rank", "prev_id", "next_id", "first_id", "last_id"]
    ranked = O.rank_records(df, ["g"], ("dateCreated", direction), partitions=9)
    want = O.rank_records_window(df, ["g"], ("dateCreated", direction))
    assert sorted(map(tuple, ranked.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    plan = ranked._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    rows = [line for line in plan.splitlines() if "Exchange hashpartitioning(_b" in line and "ENSURE" not in line]
    assert len(rows) == 1 and plan.count("REPARTITION_BY_NUM") == 1
    got = {t: tuple(O.navigate(df, t, ["g"], ("dateCreated", direction)).select("rank", "first_id").first()) for t in ("a0", "ab1")}
    every = {r.record_id: (r["rank"], r.first_id) for r in ranked.collect()}
    assert all(every[t] == v for t, v in got.items())


@pytest.mark.parametrize("direction", [1, -1])
def test_ranked_page_is_a_part_of_the_ranking(spark, direction):
    df = spark.range(300).selectExpr("id as record_id", "case when id % 11 = 0 then null else id % 17 end as date_created")
    every = sorted(map(tuple, O.rank_records(df, [], ("dateCreated", direction)).select("rank", "record_id", "prev_id", "next_id").collect()))
    for first, n in ((0, 10), (20, 5), (295, 20)):
        got = O.ranked_page(df, first, n, ("dateCreated", direction)).select("rank", "record_id", "prev_id", "next_id").collect()
        assert sorted(map(tuple, got)) == every[first:first + n]
