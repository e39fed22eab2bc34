"""Column builders over the nested ``attributes`` array.

They stay inside the array with higher-order functions: no explode, no
shuffle.  Where only some fields are needed they are selected with
``attrs.field`` / ``arrays_zip`` first, which lets Catalyst prune nested
columns when the records come from Parquet (a lambda over the whole
struct would read every field).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.model import ATTR_TYPE, ATTRS_TYPE, SUB_TYPE, SUBS_TYPE



def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_attrs(attrs="attributes") -> Column:
    return F.coalesce(col(attrs), F.array().cast(ATTRS_TYPE))


def field(attrs, name: str) -> Column:
    """``attrs.name`` as an array (empty when the list is NULL).  The
    field is extracted from the column itself, so Parquet reads only that
    nested field."""
    return F.coalesce(col(attrs).getField(name), F.array().cast(
        {"key": "array<string>", "value": "array<string>", "cleaning_error": "array<string>",
         "cleaning_checked": "array<boolean>"}.get(name, "array<string>")))


def with_fields_only(attrs, *names: str) -> Column:
    """The list with NULL in every field but ``names``, of attributes and
    sub-attributes alike: of the same type, but an exchange that carries it
    holds little more than these fields."""
    def some(x, st, **more):
        kept = [more.get(f.name, x[f.name] if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in st.fields]
        return F.when(x.isNotNull(), F.struct(*kept).cast(st))

    return F.transform(col(attrs), lambda a: some(a, ATTR_TYPE, subattributes=F.transform(
        a["subattributes"], lambda s: some(s, SUB_TYPE))))


def all_subattributes(attrs="attributes") -> Column:
    """Every sub-attribute of every attribute, in order.

    ``flatten`` is NULL as soon as one inner list is NULL, so each inner
    list is coalesced to empty first."""
    subs = F.coalesce(col(attrs).getField("subattributes"), F.array().cast(T.ArrayType(SUBS_TYPE)))
    return F.flatten(F.transform(subs, lambda s: F.coalesce(s, F.array().cast(SUBS_TYPE))))


def _any(arr: Column, pred) -> Column:
    # exists() over only NULL / false outcomes is NULL: make it false
    return F.coalesce(F.exists(arr, pred), F.lit(False))


def has_errors(attrs="attributes") -> Column:
    """F3 (list view, lenient): some attribute or sub-attribute carries a
    non-empty cleaning error message."""
    return (_any(field(attrs, "cleaning_error"), lambda e: F.length(e) > 0)
            | _any(all_subattributes(attrs).getField("cleaning_error"), lambda e: F.length(e) > 0))


def has_errors_strict(attrs="attributes") -> Column:
    """F4 (statistics, strict): the error field is present and not False,
    i.e. the value was checked and a message (even ``''``) was stored."""
    za = F.arrays_zip(field(attrs, "cleaning_checked").alias("cleaning_checked"),
                      field(attrs, "cleaning_error").alias("cleaning_error"))
    subs = all_subattributes(attrs)
    zs = F.arrays_zip(subs.getField("cleaning_checked"), subs.getField("cleaning_error"))

    def pred(z):
        return z["cleaning_checked"] & z["cleaning_error"].isNotNull()

    return _any(za, pred) | _any(zs, pred)


def attrs_with_key(key: str, attrs="attributes") -> Column:
    """the attributes whose key equals ``key`` (array order kept)."""
    return F.filter(safe_attrs(attrs), lambda a: a["key"] == F.lit(key))


def first_value_of(key: str, attrs="attributes") -> Column:
    """Value of the first attribute with ``key``; NULL or absent -> ''."""
    kv = F.arrays_zip(field(attrs, "key").alias("key"), field(attrs, "value").alias("value"))
    hit = F.filter(kv, lambda z: z["key"] == F.lit(key))
    return F.coalesce(F.get(hit, 0)["value"], F.lit(""))


def leading_number(value: Column) -> Column:
    """P5: first run of digits as an integer, else NULL ("-5.7" -> 5)."""
    return F.regexp_substr(value, F.lit(r"\d+")).try_cast("bigint")


def key_values(attrs="attributes") -> Column:
    """(key, value) of every attribute followed by its sub-attributes, in
    document order.  Built from ``attrs.key``, ``attrs.value`` and
    ``attrs.subattributes`` so a Parquet scan reads only those fields."""
    z = F.arrays_zip(field(attrs, "key").alias("key"), field(attrs, "value").alias("value"),
                     F.coalesce(col(attrs).getField("subattributes"),
                                F.array().cast(T.ArrayType(SUBS_TYPE))).alias("subs"))
    return F.flatten(F.transform(z, lambda x: F.concat(
        F.array(F.struct(x["key"].alias("key"), x["value"].alias("value"))),
        F.transform(F.coalesce(x["subs"], F.array().cast(SUBS_TYPE)),
                    lambda s: F.struct(s["key"].alias("key"), s["value"].alias("value"))))))


def hoist_keys(keys=("T", "Sec"), attrs="attributes") -> list[Column]:
    """One column per target key holding the value of its **last**
    occurrence (attributes and their sub-attributes, document order)."""
    kv = key_values(attrs)
    out = []
    for k in keys:
        hits = F.filter(kv, lambda z: z["key"] == F.lit(k))
        out.append(F.get(hits, F.size(hits) - 1)["value"].alias(k))
    return out


def attribute_count(attrs="attributes") -> Column:
    return F.size(safe_attrs(attrs))
