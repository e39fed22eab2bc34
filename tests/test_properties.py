"""Property tests: idempotence, round trips and
containments over generated records."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions import attrs as A
from palimpsest.functions import cleaning as C
from palimpsest.operators import clean as CL
from palimpsest.operators import edits as ED
from palimpsest.operators import history as H
from palimpsest.operators import order as O
from palimpsest.operators import schema as SC
from palimpsest.sources.model import ATTR_TYPE, ATTRS_TYPE, SCHEMA_ATTR_TYPE

KEYS = ["T", "Sec", "Field 3", "Field 4", "X"]
VALUES = ["12", "1,234.5 ft", "8 3/4", "1995-03-02", "yes", "", "abc", None, "03/02/1995", "-7"]
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def _attr(key, value, err):
    d = {f.name: None for f in ATTR_TYPE.fields}
    d.update(key=key, value=value, raw_text=value, cleaning_error=err, cleaning_checked=err is not None,
             user_added=False, edited=False, value_type="string", cleaned=False)
    return d


attr_st = st.builds(_attr, st.sampled_from(KEYS), st.sampled_from(VALUES), st.sampled_from([None, "", "bad"]))
records_st = st.lists(st.lists(attr_st, max_size=6), min_size=1, max_size=8)
SCHEMA = T.StructType([T.StructField("record_id", T.LongType()), T.StructField("record_group_id", T.StringType()),
                       T.StructField("attributes", ATTRS_TYPE)])
FNS = {"T": "string_to_int", "Sec": "string_to_float", "Field 3": "convert_hole_size_to_decimal",
       "Field 4": "string_to_date"}


def _df(spark, recs):
    return spark.createDataFrame([(i, "g", a) for i, a in enumerate(recs)], SCHEMA)


@SETTINGS
@given(records_st)
def test_strict_errors_contain_lenient(spark, recs):
    df = _df(spark, recs).select(A.has_errors().alias("l"), A.has_errors_strict().alias("s"))
    assert df.where(F.col("l") & ~F.col("s")).count() == 0


@SETTINGS
@given(records_st)
def test_cleaning_is_idempotent(spark, recs):
    fns = F.create_map(*[x for k, v in FNS.items() for x in (F.lit(k), F.lit(v))])
    once = _df(spark, recs).select("record_id", CL.clean_attributes(F.col("attributes"), fns).alias("attributes"))
    twice = once.select("record_id", CL.clean_attributes(F.col("attributes"), fns).alias("attributes"))
    a = {r[0]: [x["value"] for x in r[1]] for r in once.collect()}
    b = {r[0]: [x["value"] for x in r[1]] for r in twice.collect()}
    assert a == b


@SETTINGS
@given(records_st)
def test_read_reconciliation_twice_is_once(spark, recs):
    schema = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(None).cast("string").alias("alias"),
                                F.lit("t").alias("data_type"), F.lit("t").alias("database_data_type"),
                                F.lit(None).cast("string").alias("occurrence"),
                                F.lit(None).cast("string").alias("grouping"),
                                F.lit(float(i)).alias("page_order_sort"),
                                F.lit(None).cast("string").alias("cleaning_function")).cast(SCHEMA_ATTR_TYPE)
                       for i, n in enumerate(["Sec", "T", "Field 9"])])
    df = _df(spark, recs)
    one = df.select("record_id", SC.reconcile_attributes(F.col("attributes"), schema, "read").alias("a"))
    two = one.select("record_id", "a", SC.reconcile_attributes(F.col("a"), schema, "read").alias("b"))
    assert two.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


@SETTINGS
@given(records_st, st.integers(min_value=0, max_value=7))
def test_insert_then_delete_is_identity(spark, recs, i):
    # holds for an index inside the list (past the end the insert appends)
    df = _df(spark, recs)
    at = {r: i % len(a) for r, a in enumerate(recs) if a}
    e = spark.createDataFrame([(r, 1, "insert", j, "NEW", "u") for r, j in at.items()] +
                              [(r, 2, "delete", j + 1, None, "u") for r, j in at.items()] +
                              [(-1, 1, "delete", 0, None, "u")],
                              "record_id long, seq long, op string, idx int, payload string, user string") \
        .withColumn("ts", F.current_timestamp())
    new, _ = ED.apply_edits(df, e)
    got = {r["record_id"]: [a["key"] for a in r["attributes"]] for r in new.collect()}
    want = {i_: [a["key"] for a in rec] for i_, rec in enumerate(recs)}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.integers(0, 5))),
                min_size=1, max_size=30))
def test_navigation_for_each_target_equals_window(spark, rows):
    df = spark.createDataFrame([(i, g, k) for i, (g, k) in enumerate(rows)],
                               "record_id long, record_group_id string, date_created long")
    allnav = {r["record_id"]: tuple(r) for r in O.navigate_all(df, ["record_group_id"]).select(
        "record_id", "rank", "prev_id", "next_id", "first_id", "last_id").collect()}
    for t in range(0, len(rows), max(1, len(rows) // 3)):
        one = O.navigate(df, t, ["record_group_id"]).select(
            "record_id", "rank", "prev_id", "next_id", "first_id", "last_id").first()
        assert tuple(one) == allnav[t]


@SETTINGS
@given(st.sets(st.integers(0, 40), max_size=15))
def test_kept_and_archived_partition_all(spark, doomed):
    df = spark.range(40).withColumnRenamed("id", "record_id")
    keys = spark.createDataFrame([(d,) for d in doomed] or [(-1,)], "record_id long")
    kept, arch = H.delete_records(df, keys, "record_id", "u")
    k = {r[0] for r in kept.collect()}
    a = {r[0] for r in arch.select("record_id").collect()}
    assert not (k & a) and (k | a) == set(range(40)) and a == (doomed & set(range(40)))


@SETTINGS
@given(st.integers(min_value=1, max_value=9), st.integers(min_value=0, max_value=3))
def test_page_concatenation_is_full_sort(spark, per_page, extra):
    n = per_page * 3 + extra
    df = spark.range(0, n).withColumnRenamed("id", "record_id") \
        .withColumn("date_created", F.col("record_id") % 4)
    full = [r[0] for r in O.sort_records(df).select("record_id").collect()]
    pages = []
    for p in range(-(-n // per_page) + 1):          # one page past the end is empty
        pages += [r[0] for r in O.page_records(df, p, per_page).select("record_id").collect()]
    assert pages == full


def test_cleaners_on_known_values(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    got = df.select(C.string_to_int(F.col("v"))["value"]).collect()
    assert [r[0] for r in got][:2] == ["12", None]
