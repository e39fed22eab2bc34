"""Cleaning functions (C1, C3): a registry of native Column builders.

The seven names come from the reference; their bodies live in a package
that is not part of it, so the semantics below are ours (SURVEY 2.11).
Each builder maps a string value to ``struct(ok, value, value_type)``;
failure is a message, never an exception (``try_*`` casts only).

* ``clean_bool``: yes/no/true/false/t/f/y/n/1/0/x, case-blind.
* ``string_to_int`` / ``string_to_float``: spaces and commas removed,
  trailing unit text allowed, exactly one number required.
* ``string_to_date`` / ``clean_date``: first matching format of
  ``DATE_FORMATS``; the first returns a date, the second ISO text.
* ``convert_hole_size_to_decimal``: ``8 3/4``, ``8-3/4``, ``3/4``, ``8.75``.
* ``llm_clean``: needs an external model: always "not available".

Null or blank input is left alone, without error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: accepted boolean spellings
TRUE_WORDS = ["yes", "true", "t", "y", "1", "x"]
FALSE_WORDS = ["no", "false", "f", "n", "0"]
# fixed values: date formats tried in order (regex guard, Spark pattern)
DATE_FORMATS = [
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy"),
    (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd"),
]
UNIT = r"""[A-Za-z%"']*"""
INT_RE = r"^([+-]?\d+)(\.0*)?" + UNIT + "$"
FLOAT_RE = r"^([+-]?(\d+\.?\d*|\.\d+))" + UNIT + "$"
MIXED_RE = r'^(\d+)[ -]+(\d+)/(\d+)"?$'
FRACTION_RE = r'^(\d+)/(\d+)"?$'
DECIMAL_RE = r'^(\d+(\.\d+)?|\.\d+)"?$'


def _result(ok: Column, value: Column, vtype: str) -> Column:
    return F.struct(ok.alias("ok"), value.cast("string").alias("value"), F.lit(vtype).alias("value_type"))


def decimal_text(x: Column) -> Column:
    """Canonical text of a number: 6 decimals, trailing zeros removed."""
    d = x.cast("decimal(38,6)").cast("string")
    return F.regexp_replace(d, r"\.?0+$", "")


def _strip(v: Column) -> Column:
    return F.regexp_replace(v, r"[\s,]", "")


def clean_bool(v: Column) -> Column:
    t = F.lower(F.trim(v))
    val = F.when(t.isin(*TRUE_WORDS), F.lit("true")).when(t.isin(*FALSE_WORDS), F.lit("false"))
    return _result(val.isNotNull(), val, "bool")


def string_to_int(v: Column) -> Column:
    s = _strip(v)
    n = F.when(s.rlike(INT_RE), F.regexp_extract(s, INT_RE, 1)).try_cast("bigint")
    return _result(n.isNotNull(), n, "int")


def string_to_float(v: Column) -> Column:
    s = _strip(v)
    n = F.when(s.rlike(FLOAT_RE), F.regexp_extract(s, FLOAT_RE, 1)).try_cast("double")
    return _result(n.isNotNull(), decimal_text(n), "float")


def _parse_date(v: Column) -> Column:
    t = F.trim(v)
    out = None
    for rx, fmt in DATE_FORMATS:
        d = F.when(t.rlike(rx), F.try_to_date(t, fmt))
        out = d if out is None else F.coalesce(out, d)
    return out


def string_to_date(v: Column) -> Column:
    d = _parse_date(v)
    return _result(d.isNotNull(), F.date_format(d, "yyyy-MM-dd"), "date")


def clean_date(v: Column) -> Column:
    d = _parse_date(v)
    return _result(d.isNotNull(), F.date_format(d, "yyyy-MM-dd"), "string")


def convert_hole_size_to_decimal(v: Column) -> Column:
    t = F.trim(v)

    def g(rx, i):
        return F.regexp_extract(t, rx, i).try_cast("double")

    mixed = F.when(t.rlike(MIXED_RE) & (g(MIXED_RE, 3) != 0), g(MIXED_RE, 1) + g(MIXED_RE, 2) / g(MIXED_RE, 3))
    frac = F.when(t.rlike(FRACTION_RE) & (g(FRACTION_RE, 2) != 0), g(FRACTION_RE, 1) / g(FRACTION_RE, 2))
    dec = F.when(t.rlike(DECIMAL_RE), g(DECIMAL_RE, 1))
    n = F.coalesce(mixed, frac, dec)
    return _result(n.isNotNull(), decimal_text(n), "float")


def llm_clean(v: Column) -> Column:
    return _result(F.lit(False), v, "string")


CLEANERS: dict[str, Callable[[Column], Column]] = {
    "clean_bool": clean_bool,
    "string_to_int": string_to_int,
    "string_to_float": string_to_float,
    "string_to_date": string_to_date,
    "clean_date": clean_date,
    "convert_hole_size_to_decimal": convert_hole_size_to_decimal,
    "llm_clean": llm_clean,
}


def register_cleaner(name: str, builder: Callable[[Column], Column]) -> None:
    """Add a cleaning function (a Column -> struct(ok, value, value_type)
    builder) to the registry."""
    CLEANERS[name] = builder


def list_cleaning_functions() -> list[str]:
    return list(CLEANERS)


def error_message(fn: Column, v: Column) -> Column:
    return F.when(fn == "llm_clean", F.lit("llm_clean: not available")) \
        .otherwise(F.concat(fn, F.lit(": could not clean '"), v, F.lit("'")))


def run_cleaner(fn: Column, v: Column) -> Column:
    """The registered function named by ``fn`` applied to ``v``:
    struct(ok, value, value_type); NULL when ``fn`` names none."""
    res = None
    for name, builder in CLEANERS.items():
        r = builder(v)
        res = F.when(fn == name, r) if res is None else res.when(fn == name, r)
    return res


def clean_state(fn: Column, v: Column, res: Column) -> Column:
    """``skip`` (no such function: leave untouched), ``none`` (no function
    or blank input: checked, no error), ``ok`` or ``error``."""
    blank = v.isNull() | (F.trim(v) == "")
    known = fn.isin(*CLEANERS.keys())
    return (F.when(fn.isNull() | (fn == ""), F.lit("none"))
            .when(~known, F.lit("skip"))
            .when(blank, F.lit("none"))
            .when(res["ok"], F.lit("ok"))
            .otherwise(F.lit("error")))


def clean_value(fn: Column, v: Column) -> Column:
    """C1 on one value with the function named by column ``fn``:
    struct(state, value, value_type, error).  For arrays, compute
    ``run_cleaner`` once per element first (see operators.clean) so the
    regexes are not re-evaluated per output field."""
    res = run_cleaner(fn, v)
    state = clean_state(fn, v, res)
    return F.struct(state.alias("state"), res["value"].alias("value"), res["value_type"].alias("value_type"),
                    F.when(state == "error", error_message(fn, v)).alias("error"))
