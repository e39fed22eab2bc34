"""Projection of nested records (P1-P3) and extraction payloads.

Extraction payloads are JSON documents as returned by the OCR/extraction
service (a list of entities, or ``{"attributes_list": [...]}``).  They
are parsed with ``from_json`` and reshaped with nested ``transform``:
no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names as N
from ..sources.model import ATTR_TYPE, ATTRS_TYPE, SUB_TYPE, SUBS_TYPE


def project_records(records: DataFrame, top_level: list[str] | None = None,
                    attribute_fields: list[str] | None = None,
                    sub_fields: list[str] | None = None, id_col: str = "record_id") -> DataFrame:
    """Keep listed top-level fields (the id always), listed fields
    of every attribute (the list is dropped when none are listed).
    Sub-attributes appear only where ``subattributes`` is one of the listed
    fields: with ``sub_fields`` of each (NULL list -> []), else whole."""
    cols = [F.col(id_col)] + [F.col(c) for c in (top_level or []) if c not in (id_col, "attributes")]
    if attribute_fields:
        def attr(a):
            fields = [a[f].alias(f) for f in attribute_fields if f != "subattributes"]
            if "subattributes" in attribute_fields and sub_fields:
                subs = F.transform(F.coalesce(a["subattributes"], F.array().cast(SUBS_TYPE)),
                                   lambda s: F.struct(*[s[f].alias(f) for f in sub_fields]))
                fields.append(subs.alias("subattributes"))
            elif "subattributes" in attribute_fields:
                fields.append(a["subattributes"].alias("subattributes"))
            return F.struct(*fields)
        cols.append(F.transform(F.coalesce("attributes", F.array().cast(ATTRS_TYPE)), attr).alias("attributes"))
    return records.select(*cols)


# ---------------------------------------------------------------- payloads
_VERT = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
_ENTITY_FIELDS = [
    T.StructField("type", T.StringType()),
    T.StructField("mention_text", T.StringType()),
    T.StructField("text_anchor", T.StructType([T.StructField("content", T.StringType())])),
    T.StructField("normalized_value", T.StructType([T.StructField("text", T.StringType())])),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("page_anchor", T.StructType([
        T.StructField("page_refs", T.ArrayType(T.StructType([
            T.StructField("page", T.IntegerType()),
            T.StructField("bounding_poly", T.StructType([T.StructField("normalized_vertices", _VERT)])),
        ])))])),
]
PROPERTY_TYPE = T.StructType(_ENTITY_FIELDS)
ENTITY_TYPE = T.StructType(_ENTITY_FIELDS + [T.StructField("properties", T.ArrayType(PROPERTY_TYPE))])
PAYLOAD_LIST_TYPE = T.ArrayType(ENTITY_TYPE)
PAYLOAD_OBJ_TYPE = T.StructType([T.StructField("attributes_list", PAYLOAD_LIST_TYPE),
                                 T.StructField("entities", PAYLOAD_LIST_TYPE)])


def _coords(e: Column) -> Column:
    """First page reference's polygon, its first four vertices, as [x, y]."""
    verts = F.get(e["page_anchor"]["page_refs"], 0)["bounding_poly"]["normalized_vertices"]
    four = F.slice(verts, 1, 4)
    return F.when(F.size(verts) > 0, F.transform(four, lambda v: F.array(v["x"], v["y"])))


def _value(e: Column) -> Column:
    # normalised text, else the raw mention (an empty string counts as absent)
    return F.coalesce(F.nullif(e["normalized_value"]["text"], F.lit("")), e["mention_text"])


def _attr_common(e: Column, parent_conf: Column | None, parent_key: Column | None):
    return [
        e["type"].alias("key"), _value(e).alias("value"), F.lit("string").alias("value_type"),
        e["mention_text"].alias("raw_text"), e["text_anchor"]["content"].alias("text_value"),
        e["normalized_value"]["text"].alias("normalized_value"),
        (parent_conf if parent_conf is not None else e["confidence"]).alias("ai_confidence"),
        e["confidence"].alias("confidence"),
        _coords(e).alias("normalized_vertices"),
        F.lit(None).cast("array<array<double>>").alias("user_provided_coordinates"),
        F.get(e["page_anchor"]["page_refs"], 0)["page"].alias("page"),
        F.lit(False).alias("edited"), F.lit(False).alias("user_added"),
        F.lit(parent_key is not None).alias("is_subattribute"),
        (parent_key if parent_key is not None else F.lit(None).cast("string")).alias("top_level_attribute"),
        F.lit(False).alias("cleaned"), F.lit(False).alias("cleaning_checked"),
        F.lit(None).cast("string").alias("cleaning_error"), F.lit(None).cast("string").alias("uncleaned_value"),
        F.lit(None).cast("timestamp").alias("last_cleaned"), F.lit(None).cast("timestamp").alias("last_updated"),
        F.lit(None).cast("string").alias("last_updated_user"),
    ]


def entities_to_attributes(entities: Column) -> Column:
    """Entity list -> attribute array.  Sub-attributes take the
    parent's ``ai_confidence`` (Q-1); an empty property list gives NULL."""
    def attr(e):
        subs = F.transform(F.coalesce(e["properties"], F.array().cast(T.ArrayType(PROPERTY_TYPE))),
                           lambda p: F.struct(*_attr_common(p, e["confidence"], e["type"])).cast(SUB_TYPE))
        return F.struct(*_attr_common(e, None, None),
                        F.when(F.size(subs) > 0, subs).alias("subattributes")).cast(ATTR_TYPE)
    return F.transform(entities, attr)


def extract_attributes(payloads: DataFrame, payload_col: str = "payload", default_processor: Column | bool = False) -> DataFrame:
    """S4 + E1: parse each payload (list form or ``{attributes_list}`` form)
    into ``attributes``; ``parse_ok`` is false when neither form parses.

    ``default_processor`` tells which payloads come from the general processor:
    their fields are the properties of the first entity (none without one)."""
    raw = F.col(payload_col)
    as_list = F.from_json(raw, PAYLOAD_LIST_TYPE)
    as_obj = F.from_json(raw, PAYLOAD_OBJ_TYPE)
    ents = F.when(F.ltrim(raw).startswith("["), as_list).otherwise(
        F.coalesce(as_obj["attributes_list"], as_obj["entities"]))
    parsed = payloads.withColumn("_ents", ents).withColumn("parse_ok", F.col("_ents").isNotNull())
    fields = F.col("_ents")
    if default_processor is not False:
        own = [F.lit(None).cast("array<" + PROPERTY_TYPE.simpleString() + ">").alias("properties")]
        first = F.transform(F.coalesce(F.get("_ents", 0)["properties"], F.array().cast(T.ArrayType(PROPERTY_TYPE))),
                            lambda p: F.struct(*[p[f.name].alias(f.name) for f in _ENTITY_FIELDS], *own).cast(ENTITY_TYPE))
        general = F.lit(True) if default_processor is True else F.coalesce(default_processor, F.lit(False))
        fields = F.when(general & F.col("parse_ok"), first).otherwise(fields)
    return parsed.withColumn("attributes", F.coalesce(entities_to_attributes(fields), F.array().cast(ATTRS_TYPE))).drop("_ents")


def new_records(uploads: DataFrame) -> DataFrame:
    """The record row written before extraction: names, api number,
    page images, status ``processing``.  ``uploads`` has
    (record_id, record_group_id, upload_name, n_pages, contributor)."""
    fname = F.col("upload_name")
    # split at the last dot, as os.path.splitext does (text before it is
    # the record name; a name without a dot has no extension)
    has_ext = fname.rlike(r"^.+\.[^.]*$")
    base = F.when(has_ext, F.regexp_extract(fname, r"^(.+)(\.[^.]*)$", 1)).otherwise(fname)
    ext = F.when(has_ext, F.regexp_extract(fname, r"^(.+)(\.[^.]*)$", 2)).otherwise(F.lit(""))
    stored = N.stored_extension(ext)
    raster = F.lower(ext).isin(*N.RASTERISED)
    return uploads.select(
        "record_id", "record_group_id",
        base.alias("name"),
        F.concat(base, stored).alias("filename"),
        N.api_number(base).alias("api_number"),
        F.col("contributor"),
        F.lit("processing").alias("status"),
        F.lit("unreviewed").alias("review_status"),
        fname.alias("original_filename"),
        F.when(raster, N.page_names(base, F.col("n_pages"), ".png"))
         .otherwise(F.array(F.concat(base, ext))).alias("image_files"),
    )


def assemble_records(new: DataFrame, extracted: DataFrame, reprocessed: bool = False) -> DataFrame:
    """State machine on ingest.  A payload that parses gives
    ``digitized`` (or ``reprocessed``) with its attributes; one that does
    not gives ``error`` and a message; no payload leaves ``processing``."""
    return record_states(new.join(extracted.select("record_id", "parse_ok", F.col("attributes")), "record_id", "left"), new.columns, reprocessed)


def extract_records(new: DataFrame, payloads: DataFrame, reprocessed: bool = False) -> DataFrame:
    """E1 and E3 in one: records meet their payloads as stored, so the
    exchange holds texts and not the wide attributes made of them."""
    j = new.join(payloads.select("record_id", "payload", F.lit(True).alias("_has")), "record_id", "left")
    ex = extract_attributes(j)
    return record_states(ex.withColumn("parse_ok", F.when(F.col("_has"), F.col("parse_ok"))), new.columns, reprocessed)


def record_states(j: DataFrame, columns: list[str], reprocessed: bool = False) -> DataFrame:
    ok = F.lit("reprocessed" if reprocessed else "digitized")
    return j.select(
        *[c for c in columns if c != "status"],
        F.when(F.col("parse_ok"), ok).when(F.col("parse_ok") == F.lit(False), F.lit("error"))
         .otherwise(F.lit("processing")).alias("status"),
        F.when(F.col("parse_ok") == F.lit(False), F.lit("unable to process document")).alias("error_message"),
        F.coalesce("attributes", F.array().cast(ATTRS_TYPE)).alias("attributes"),
    )
