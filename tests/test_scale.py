"""What large inputs ask for: flat rows in exchanges, no repeated work a row, pairs of one key over many tasks."""

import datetime
import json
import re

import pytest
from pyspark.sql import functions as F

from palimpsest.functions import attrs as A
from palimpsest.operators import clean as CL
from palimpsest.operators import edits as ED
from palimpsest.operators import export as X
from palimpsest.operators import order as O
from palimpsest.operators import scope as S
from palimpsest.sources import model as M
from palimpsest.sources import store
from palimpsest.streaming import streams as ST

LINE = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
ORDER = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"


@pytest.fixture
def folder(spark, tmp_path):
    """Two orders, one without line items; items out of order, one twice but for its tax, one of no order, null columns."""
    t = datetime.datetime(2020, 1, 2)
    item = lambda o, n, tax=0.01: (o, 10 + n, 7, n, 3.0, 5.5, 0.1, tax, "R", "F", t)
    rows = [item(1, 3), item(1, 1), item(1, 2, 0.08), item(1, 2, 0.02), (1, None, None, None, None, None, None, None, None, None, None), item(9, 1)]
    spark.createDataFrame(rows, LINE).repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 4, "F", t, "1-URGENT"), (2, None, None, None, None)], ORDER).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def exchanges(df) -> list[str]:
    """What goes into each exchange of the plan."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\n]*)\]", plan)


def test_nesting_shuffles_flat_rows(spark, folder):
    for df in (M.build_records(spark, folder), M.build_payloads(spark, folder)):
        of_items = [x for x in exchanges(df) if "l_orderkey" in x]
        assert of_items and all("l_partkey" in x and "buf" not in x for x in of_items)


def test_layout_shuffles_flat_rows(spark, folder):
    into = exchanges(M.build_records(spark, folder, store.cluster_by))
    assert len(into) >= 3 and not any("attributes" in x or "image_files" in x for x in into)


def test_nested_rows_are_in_position(spark, folder):
    got = {r["record_id"]: r for r in M.build_records(spark, folder, store.cluster_by).collect()}
    assert set(got) == {1, 2} and got[2]["attributes"] == [] and got[2]["record_group_id"] is None
    items = got[1]["attributes"]
    # the null line number comes first; equal positions are settled by the attribute itself
    assert [a["key"] for a in items] == [None, "T", "Sec", "Sec", "Field 3"]
    assert [a["user_added"] for a in items] == [None, False, False, True, False]
    assert [s["key"] for s in items[4]["subattributes"]] == ["Depth", "Sec"]
    assert {r["record_id"] for r in M.build_payloads(spark, folder).collect()} == {1, 9}


def test_tasks_grow_with_the_input(spark, folder, monkeypatch):
    files = f"{folder}/orders.parquet", f"{folder}/lineitem.parquet"
    here = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert M.tasks_for(spark, *files) == here
    monkeypatch.setattr(M, "BYTES_A_TASK", 64)
    n = M.tasks_for(spark, *files)
    assert n > here and M.spread(spark.range(5), n, "id").rdd.getNumPartitions() == n
    assert M.build_records(spark, folder).count() == 2


def test_rank_makes_no_bucket_to_find_cut_scopes(spark):
    df = spark.range(400).select(F.col("id").alias("record_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"),
                                 (F.col("id") % 7).alias("date_created"))
    out = O.rank_records(df, ["g"], partitions=4)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Filter" in x and "lambdafunction" in x]
    rows = sorted((r["g"] or 0, r["rank"], r["record_id"]) for r in out.collect())
    want = []
    for g in range(3):
        ids = sorted((i for i in range(400) if i % 3 == g), key=lambda i: (i % 7, i))
        want += [(g, k + 1, i) for k, i in enumerate(ids)]
    assert rows == want


def test_pairs_of_one_team_are_spread(spark):
    users = spark.createDataFrame([(f"u{i}", "t") for i in range(5)] + [("x", None)], "email string, default_team string")
    teams = spark.createDataFrame([("t", ["p", "p", "gone"])], "name string, project_list array<string>")
    projects = spark.createDataFrame([("p",)], "project_id string")
    groups = spark.createDataFrame([("p", f"g{i}") for i in range(200)] + [("p", None)], "project_id string, record_group_id string")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        out = S.visible_groups(users, teams, projects, groups)
        rows = out.select("email", "record_group_id", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set(key, before)
    assert len(rows) == 5 * 201 and len({(r["email"], r["record_group_id"]) for r in rows}) == 5 * 201
    assert len({r["p"] for r in rows}) > 1


def test_pairs_of_one_team_are_dealt_evenly_and_users_copied_by_many_tasks(spark):
    users = spark.createDataFrame([(f"u{i % 5}", "t") for i in range(6)], "email string, default_team string")
    teams = spark.createDataFrame([("t", ["p"])], "name string, project_list array<string>")
    projects = spark.createDataFrame([("p",)], "project_id string")
    groups = spark.range(0, 6000, 1, 1).select(F.lit("p").alias("project_id"), F.col("id").cast("string").alias("record_group_id"))
    out = S.visible_groups(users, teams, projects, groups)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    copies = plan[re.search(r"Generate explode\(.*_share", plan).start():]
    assert re.search(r"RepartitionByExpression \[email#\d+\]", copies)  # user 0 comes twice
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    tasks = 16 * spark.sparkContext.defaultParallelism
    assert sum(sizes) == 6 * 6000 and len(sizes) > 0.9 * tasks and max(sizes) < 4 * sum(sizes) / tasks


def below_first_join(df) -> str:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan[plan.index("Join "):]


def test_fields_that_nobody_reads_become_null(spark, folder):
    recs = M.build_records(spark, folder)
    slim = recs.select("record_id", A.with_fields_only("attributes", "key", "value").alias("attributes"))
    assert slim.schema["attributes"].dataType.simpleString() == recs.schema["attributes"].dataType.simpleString()
    whole, got = ({r["record_id"]: r["attributes"] for r in df.collect()} for df in (recs, slim))
    assert [(a["key"], a["value"], a["subattributes"] and [(s["key"], s["value"]) for s in a["subattributes"]]) for a in got[1]] == \
        [(a["key"], a["value"], a["subattributes"] and [(s["key"], s["value"]) for s in a["subattributes"]]) for a in whole[1]]
    assert all(v is None for a in got[1] for x in (a, *(a["subattributes"] or [])) for f, v in x.asDict().items()
               if f not in ("key", "value", "subattributes"))
    odd = spark.sql(f"SELECT CAST(array(NULL) AS {recs.schema['attributes'].dataType.simpleString()}) AS attributes UNION ALL SELECT NULL")
    assert sorted((r[0] for r in odd.select(A.with_fields_only("attributes", "key")).collect()), key=str) == [None, [None]]


def test_records_meet_their_schema_without_the_fields_that_nobody_reads(spark, folder):
    recs = M.build_records(spark, folder)
    groups = spark.createDataFrame([("4", "p")], "record_group_id string, processor_id string")
    procs = spark.sql("SELECT 'p' AS processor_id, array(named_struct('name', 'T', 'cleaning_function', 'string_to_int')) AS attributes") \
        .select("processor_id", F.transform("attributes", lambda s: F.struct(*[
            (s[f] if f in ("name", "cleaning_function") else F.lit(None).cast(M.SCHEMA_ATTR_TYPE[f].dataType)).alias(f)
            for f in M.SCHEMA_ATTR_TYPE.fieldNames()])).alias("attributes"))
    df = CL.clean_long(recs, groups, procs)
    assert "raw_text, null" in below_first_join(df)
    rows = {(r["attr_pos"], r["sub_pos"]): r for r in df.where("record_id = 1").collect()}
    assert rows[(1, None)]["cleaning_checked"] and rows[(4, 0)]["key"] == "Depth" and rows[(4, 0)]["cleaning_checked"]


def test_export_scope_is_met_as_records_are_read(spark, folder):
    recs = M.build_records(spark, folder)
    # a scope of few groups that the planner takes for a large one
    many = spark.range(300_000).where("id < 2").crossJoin(spark.range(100))
    groups = many.toDF("a", "b").select(F.when(F.col("a") == 0, F.lit("4")).alias("record_group_id"))
    assert [r["record_id"] for r in X.records_of(recs, groups).collect()] == [1]
    plan = X.records_of(recs, groups)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    before = recs.join(groups, "record_group_id", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in before[:before.index("LeftSemi")]


def test_edit_history_takes_values_alone_to_the_edits(spark, folder):
    recs = M.build_records(spark, folder)
    t = datetime.datetime(2024, 1, 1)
    edits = spark.createDataFrame([(1, 0, "replace", 4, 1, "x", "u", t), (1, 1, "delete", 1, None, None, "u", t), (1, 2, "replace", 1, None, "y", "u", t),
                                   (1, 3, "replace", 9, None, "z", "u", t)],
                                  "record_id bigint, seq int, op string, idx int, sub_idx int, payload string, user string, ts timestamp")
    new, hist = ED.apply_edits(recs, edits)
    values = {r["record_id"]: r["attributes"] for r in recs.collect()}[1]
    assert [(r["seq"], r["previous_value"]) for r in hist.orderBy("seq").collect()] == \
        [(0, values[4]["subattributes"][1]["value"]), (1, None), (2, values[2]["value"])]
    assert [r["seq"] for r in ED.rejected_edits(recs, edits).collect()] == [3]
    assert "raw_text, null" in below_first_join(hist) and "raw_text, null" not in below_first_join(new)


def test_ingest_moves_payloads_and_no_attributes(spark):
    """No join finds its records small; records of unknown groups, without payload and with broken or null ones; a group named twice."""
    base = spark.createDataFrame([(1, "g", "a", "a.png", "new"), (2, None, "b", "b.png", "new"), (3, "h", "c", "c.png", "new"), (4, "g", "d", "d.png", "new")],
                                 "record_id bigint, record_group_id string, name string, filename string, status string")
    payloads = spark.createDataFrame([(1, '[{"type": "Sec", "mention_text": "1,5"}]'), (2, '{"attributes_list": [{"type": "Sec", "mention_text": "7"}]}'),
                                      (3, None), (3, "broken")], "record_id bigint, payload string")
    groups = spark.createDataFrame([("g", "P"), ("g", "Q"), ("x", "P")], "record_group_id string, processor_id string")
    row = lambda name, fn: dict.fromkeys(M.SCHEMA_ATTR_TYPE.fieldNames()) | {"name": name, "cleaning_function": fn}
    processors = spark.createDataFrame([("P", [row("Sec", "string_to_int"), row("T", None)])],
                                       f"processor_id string, attributes array<{M.SCHEMA_ATTR_TYPE.simpleString()}>")
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        # the processors are few at any size
        out = ST.ingest_batch(payloads, base, groups, F.broadcast(processors))
        moved = exchanges(out)
        rows = out.collect()
    finally:
        spark.conf.set(conf, before)
    assert any("payload" in x for x in moved) and not any("attributes" in x for x in moved)
    got = sorted((r.record_id, r.status, r.error_message is None, tuple((a.key, a.value) for a in r.attributes)) for r in rows)
    made = [(("Sec", "1,5"),), (("Sec", "1,5"), ("T", "")), (("Sec", "15"),), (("Sec", "15"), ("T", ""))]
    blank = (("Sec", ""), ("T", ""))
    assert got == sorted([(1, "digitized", True, m) for m in made] + [(2, "digitized", True, (("Sec", "7"),))]
                         + 2 * [(3, "error", False, ())] + 2 * [(4, "processing", True, ()), (4, "processing", True, blank)])


def test_payloads_take_flat_values_to_even_tasks(spark, tmp_path):
    """What entities hold is worked out on flat rows; entities of one position keep the order of their own fields."""
    day = lambda d: datetime.datetime(2020, 1, d)
    item = lambda o, n, part, tax, ship: (o, part, 7, n, 3.0, 5.5, 0.1, tax, "R", "F", ship)
    rows = [item(1, 3, 12, 0.01, day(1)), item(1, 3, 12, 0.08, day(2)), item(1, 3, 12, None, day(1)), item(1, 3, 12, 0.01, day(1)),
            item(1, 1, 12, 0.01, day(9)), item(1, 1, 12, 0.08, day(2)), item(1, 1, 12, 0.02, None), item(2, 1, 12, 0.02, day(3)),
            item(97, 1, 1, 0.0, day(1)), item(3, None, None, None, None), item(None, 1, 12, 0.0, day(4))]
    spark.createDataFrame(rows, LINE).repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    df = M.build_payloads(spark, str(tmp_path))
    got = {r["record_id"]: r["payload"] for r in df.collect()}
    assert set(got) == {1, 2, 3, 97, None} and got[97] == "not json"
    ents = json.loads(got[1])
    # is a date where (part + line) % 5 = 3: line 1 by its day, the null one first
    assert [e.get("mention_text") for e in ents[:3]] == [None, "2020/01/02", "2020/01/09"]
    assert [e["normalized_value"] for e in ents[:3]] == [{}, {"text": "2020-01-02"}, {"text": "2020-01-09"}]
    assert [[p.get("confidence") for p in e["properties"]] for e in ents[3:]] == [[None, None], [0.92, 0.92], [0.99, 0.99], [0.99, 0.99]]
    assert [p["mention_text"] for p in ents[3]["properties"]] == ["5.50", "7"] and "properties" not in ents[0]
    assert list(json.loads(got[2])) == ["attributes_list"] and len(json.loads(got[2])["attributes_list"]) == 1
    assert [e["page_anchor"]["page_refs"][0]["page"] for e in json.loads(got[3])] == [1]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "date_format" in plan and "date_format(lambda" not in plan and "date_format(cast(lambda" not in plan


def test_heavy_nesting_has_some_tasks_a_core(spark, folder):
    path = f"{folder}/lineitem.parquet"
    assert M.even_tasks(spark, path) == M.tasks_for(spark, path)
    spark.range(1_500_000).select(F.rand(1).alias("a")).coalesce(1).write.parquet(f"{folder}/large.parquet")
    here = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        n = M.even_tasks(spark, f"{folder}/large.parquet")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", here)
    assert n >= 2 * spark.sparkContext.defaultParallelism
    li = M.table(spark, folder, "lineitem")
    assert M.line_items(li, 24, fixed=True).rdd.getNumPartitions() == 24
