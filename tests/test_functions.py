"""Column functions on hand-written values."""

from pyspark.sql import functions as F

from palimpsest.functions import attrs as A
from palimpsest.functions import cleaning as C
from palimpsest.functions import names as N


def one(spark, col, schema="v string", rows=None):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_leading_number(spark):
    got = one(spark, A.leading_number(F.col("v")), rows=[("-5.7",), ("1999-01-02",), ("abc",), ("",), (None,),
                                                        ("x99999999999999999999999",)])
    assert got == [5, 1999, None, None, None, None]


def test_api_number_and_base(spark):
    got = one(spark, N.api_number(F.col("v")), rows=[("123_abc",), ("scan_1",), ("42",), (None,)])
    assert got == [123, None, 42, None]
    assert one(spark, N.base_filename(F.col("v")), rows=[("a.pdf.png",), ("b",), (".x",)]) == ["a", "b", ""]


def test_page_names(spark):
    df = spark.createDataFrame([("n", 0), ("n", 1), ("n", 3)], "name string, k int")
    got = [r[0] for r in df.select(N.page_names(F.col("name"), F.col("k"))).collect()]
    assert got == [[], ["n.png"], ["n.png", "n_2.png", "n_3.png"]]


def test_upload_type_first_match(spark):
    got = one(spark, N.upload_type(F.col("v")), rows=[("A.PDF",), ("x.tiff",), ("y.jpeg",), ("z.docx",),
                                                     ("q.pdf.png",)])
    assert got == [".pdf", ".tif", ".jpeg", None, ".pdf"]


def test_valid_images_and_keys(spark):
    df = spark.createDataFrame([("g", 1, ["x", "p.png"], "f.png"), ("g", 2, ["x"], "f2.png"), ("g", 3, None, "f3")],
                               "g string, r long, imgs array<string>, f string")
    got = [r[0] for r in df.select(N.image_keys(F.col("g"), F.col("r"), F.col("imgs"), F.col("f"))).collect()]
    assert got == [["uploads/g/1/p.png"], ["uploads/g/2/f2.png"], ["uploads/g/3/f3"]]


def cleaned(spark, fn, values):
    df = spark.createDataFrame([(fn, v) for v in values], "fn string, v string")
    return [tuple(r) for r in df.select(C.clean_value(F.col("fn"), F.col("v")).alias("c"))
            .select("c.state", "c.value", "c.value_type").collect()]


def test_clean_bool(spark):
    got = cleaned(spark, "clean_bool", ["Yes", " n ", "X", "maybe", None, ""])
    assert [g[0] for g in got] == ["ok", "ok", "ok", "error", "none", "none"]
    assert [g[1] for g in got[:3]] == ["true", "false", "true"]


def test_numbers(spark):
    assert [g[1] for g in cleaned(spark, "string_to_int", ["1,234 ft", "+7", "12.0", "1.5"])] == \
        ["1234", "7", "12", None]
    assert [g[1] for g in cleaned(spark, "string_to_float", ["1,234.50", ".5in", "abc"])] == ["1234.5", "0.5", None]
    assert [g[1] for g in cleaned(spark, "convert_hole_size_to_decimal",
                                  ["8 3/4", "8-3/4", "3/4", "8.75", "1/0", "x"])] == \
        ["8.75", "8.75", "0.75", "8.75", None, None]


def test_dates(spark):
    got = cleaned(spark, "string_to_date", ["1995-03-02", "03/02/1995", "1995/03/02", "1995-02-30", "soon"])
    assert [g[1] for g in got] == ["1995-03-02", "1995-03-02", "1995-03-02", None, None]
    assert got[0][2] == "date"
    assert cleaned(spark, "clean_date", ["03/02/1995"])[0][2] == "string"


def test_unknown_and_empty_function(spark):
    assert cleaned(spark, "no_such_fn", ["1"])[0][0] == "skip"
    assert cleaned(spark, "", ["1"])[0][0] == "none"
    assert cleaned(spark, "llm_clean", ["1"])[0][0] == "error"


def test_registry():
    assert set(C.list_cleaning_functions()) >= {"clean_bool", "string_to_int", "string_to_float", "string_to_date",
                                                "clean_date", "convert_hole_size_to_decimal", "llm_clean"}
