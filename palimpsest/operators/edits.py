"""Batch record edits.

One edit in the reference is one HTTP call on one record.  Here a batch
table of edits ``(record_id, seq, op, idx, sub_idx, payload, user, ts)``
is applied to the whole records table: edits are grouped per record
(a partial-less collect, bounded by one record's edit batch), sorted by
``seq`` and folded over the attribute array with ``aggregate``; then the
result is joined back (left join on the record id, so untouched records
pass through).  The fold carries the previous value of each touched
path (M8) for the history rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import attrs as A
from ..sources.model import ATTR_TYPE, ATTRS_TYPE, NOTE_TYPE, SUB_TYPE

PREV_TYPE = T.ArrayType(T.StructType([T.StructField("seq", T.LongType()), T.StructField("op", T.StringType()),
                                      T.StructField("idx", T.IntegerType()),
                                      T.StructField("previous_value", T.StringType()),
                                      T.StructField("reason", T.StringType())]))
OPERATIONS = ("replace", "coordinates", "insert", "delete", "attribute")
ACC_TYPE = T.StructType([T.StructField("a", ATTRS_TYPE), T.StructField("h", PREV_TYPE)])


def blank_user_attribute(key: Column, ts: Column, user: Column, parent: Column | None = None) -> Column:
    """M2: the blank, user-added attribute (value ``""``)."""
    st = SUB_TYPE if parent is not None else ATTR_TYPE
    fields = {f.name: F.lit(None).cast(f.dataType) for f in st.fields}
    fields.update({
        "key": key, "value": F.lit(""), "value_type": F.lit("string"), "edited": F.lit(False),
        "user_added": F.lit(True), "is_subattribute": F.lit(parent is not None),
        "last_updated": ts, "last_updated_user": user,
    })
    if parent is not None:
        fields["top_level_attribute"] = parent
    return F.struct(*[fields[f.name].alias(f.name) for f in st.fields]).cast(st)


def _set_sub(a: Column, sub_idx: Column, fn) -> Column:
    return a.withField("subattributes", F.transform(a["subattributes"], lambda s, j: F.when(j == sub_idx, fn(s))
                                                    .otherwise(s)))


DIRTY = "\u0000edited"


def _step(acc: Column, e: Column, fns: bool = False, whole: bool = False) -> Column:
    """One edit applied to the accumulator (attrs, history).  With
    ``fns`` (MAP<name, cleaning_function>) a replaced value is cleaned
    before it is stored (M7); with ``whole`` edits carry an ``attribute``
    that the operation of that name puts in place of an element."""
    a, h = acc["a"], acc["h"]
    idx, sub = e["idx"], e["sub_idx"]
    n = F.size(a)
    is_sub = sub.isNotNull()
    target = F.get(a, idx)
    prev_val = F.when(is_sub, F.get(target["subattributes"], sub)["value"]).otherwise(target["value"])

    def replaced(x):
        y = (x.withField("value", e["payload"]).withField("edited", F.lit(True))
              .withField("last_updated", e["ts"]).withField("last_updated_user", e["user"]))
        # M7: mark the value; it is cleaned after the fold (cleaning inside
        # the fold lambda would copy the cleaner expressions per branch)
        return y.withField("value_type", F.lit(DIRTY)) if fns else y

    def coords(x):
        return (x.withField("user_provided_coordinates", e["coords"]).withField("page", e["page"])
                 .withField("edited", F.lit(True))
                 .withField("last_updated", e["ts"]).withField("last_updated_user", e["user"]))

    def stamp(x):
        return x.withField("last_updated", e["ts"]).withField("last_updated_user", e["user"])

    replace = F.transform(a, lambda x, i: F.when(i != idx, x).when(is_sub, _set_sub(x, sub, replaced))
                          .otherwise(replaced(x)))
    coord = F.transform(a, lambda x, i: F.when(i != idx, x).when(is_sub, stamp(_set_sub(x, sub, coords)))
                        .otherwise(coords(x)))
    # insert after idx; past the end appends (array_insert pads with NULLs
    # beyond size + 1, so the position is clamped)
    ins_top = F.array_insert(a, F.greatest(F.lit(1), F.least(idx + 2, n + 1)), blank_user_attribute(e["payload"], e["ts"], e["user"]))

    def ins_sub_one(x):
        subs = x["subattributes"]
        new = blank_user_attribute(e["payload"], e["ts"], e["user"], x["key"])
        return x.withField("subattributes", F.when(subs.isNull(), F.array(new))
                           .otherwise(F.array_insert(subs, F.greatest(F.lit(1), F.least(sub + 2, F.size(subs) + 1)), new)))

    ins_sub = F.transform(a, lambda x, i: F.when(i == idx, ins_sub_one(x)).otherwise(x))
    dele = F.filter(a, lambda x, i: i != idx)
    del_sub = F.transform(a, lambda x, i: F.when(i == idx, x.withField(
        "subattributes", F.filter(x["subattributes"], lambda s, j: j != sub))).otherwise(x))
    op = e["op"]
    in_range = F.coalesce((idx >= 0) & (idx < n), F.lit(False))
    has_sub = (sub >= 0) & (sub < F.coalesce(F.size(target["subattributes"]), F.lit(0)))
    # M8: what is rejected changes nothing and gets no history row
    reason = (F.when(~F.coalesce(op.isin(*OPERATIONS[:None if whole else -1]), F.lit(False)), F.lit("unknown operation"))
              .when(~in_range & (is_sub | (op != "insert") | F.coalesce(idx < 0, F.lit(True))), F.lit("no attribute at that position"))
              .when(is_sub & F.when(op == "insert", sub < 0).otherwise(~has_sub), F.lit("no sub-attribute at that position")))
    if whole:
        reason = reason.when((op == "attribute") & e["attribute"].isNull(), F.lit("no attribute given"))
    new_a = (F.when(reason.isNotNull(), a)
             .when(op == "replace", replace)
             .when(op == "coordinates", coord)
             .when((op == "insert") & is_sub, ins_sub)
             .when(op == "insert", ins_top)
             .when((op == "delete") & is_sub, del_sub)
             .when(op == "delete", dele))
    before = F.when((op == "replace") & in_range, prev_val)
    if whole:
        new = e["attribute"]
        new_sub = F.struct(*[new[f].alias(f) for f in SUB_TYPE.fieldNames()]).cast(SUB_TYPE)
        new_a = new_a.when(is_sub, F.transform(a, lambda x, i: F.when(i == idx, _set_sub(x, sub, lambda _: new_sub)).otherwise(x))) \
                     .otherwise(F.transform(a, lambda x, i: F.when(i == idx, new).otherwise(x)))
        before = before.when((op == "attribute") & in_range, F.when(
            is_sub, F.to_json(F.get(target["subattributes"], sub))).otherwise(F.to_json(target)))
    else:
        new_a = new_a.otherwise(a)
    rec = F.array(F.struct(e["seq"].cast("bigint").alias("seq"), op.alias("op"), idx.alias("idx"),
                           before.alias("previous_value"), reason.alias("reason")))
    return F.struct(new_a.cast(ATTRS_TYPE).alias("a"), F.concat(h, rec).cast(PREV_TYPE).alias("h"))


def fold_edits(attrs: Column, edits: Column, mark: bool = False, whole: bool = False) -> Column:
    """Apply a sorted array of edit structs to one attribute array."""
    init = F.struct(A.safe_attrs(attrs).alias("a"), F.array().cast(PREV_TYPE).alias("h")).cast(ACC_TYPE)
    return F.aggregate(edits, init, lambda acc, e: _step(acc, e, mark, whole))


EDIT_COLS = ["seq", "op", "idx", "sub_idx", "payload", "user", "ts", "coords", "page"]


def apply_edits(records: DataFrame, edits: DataFrame, clean_with: DataFrame | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """M1-M4, M7, M8: (new records, history rows with previous values).
    Rejected edits change nothing; ``rejected_edits`` lists them.

    ``edits`` may omit ``sub_idx``, ``coords`` and ``page``.  Edits with the
    columns ``attribute`` (a whole attribute, its fields typed) and
    ``review_status`` may replace an attribute or, with ``sub_idx``, a
    sub-attribute as a whole (operation ``attribute``): the history row holds
    the element that stood there as JSON, and an accepted edit that was made on
    an ``unreviewed`` record makes it ``incomplete``.  With
    ``clean_with`` = (record_group_id, fns) from ``clean.schema_functions``
    replaced values are cleaned before they are stored (M7)."""
    out, fns = _folded(records, edits, clean_with)
    new_records = out.withColumn("attributes", F.coalesce(F.col("_f.a"), F.col("attributes")))
    if "attribute" in edits.columns:
        began = F.zip_with("_edits", F.col("_f.h"), lambda e, h: (e["op"] == "attribute") & (e["review_status"] == "unreviewed") & h["reason"].isNull())
        new_records = new_records.withColumn("review_status", F.when(F.coalesce(F.array_contains(began, True), F.lit(False)), F.lit("incomplete"))
                                             .otherwise(F.col("review_status")))
    if fns is not None:
        from .clean import clean_attributes
        marked = lambda x: F.coalesce(x["value_type"] == F.lit(DIRTY), F.lit(False))
        new_records = new_records.withColumn("attributes", clean_attributes(F.col("attributes"), fns, only=marked))

        def unmark(x):
            return x.withField("value_type", F.when(marked(x), F.lit("string")).otherwise(x["value_type"]))
        new_records = new_records.withColumn("attributes", F.transform("attributes", lambda a: unmark(a).withField(
            "subattributes", F.transform(a["subattributes"], unmark))))
    new_records = new_records.withColumn("edited_now", F.col("_edits").isNotNull()).drop("_f", "_edits", "_fns")
    return new_records, _outcomes(_judged(records, edits, clean_with)).where(F.col("reason").isNull()).drop("reason")


def _judged(records: DataFrame, edits: DataFrame, clean_with: DataFrame | None = None) -> DataFrame:
    """``_folded`` for the outcomes alone: of an attribute they hold the value,
    or the whole element where whole attributes are put in place."""
    if "attribute" not in edits.columns:
        records = records.select("record_id", "record_group_id", A.with_fields_only("attributes", "value").alias("attributes"))
    return _folded(records, edits, clean_with)[0]


def rejected_edits(records: DataFrame, edits: DataFrame) -> DataFrame:
    """M8: (record_id, record_group_id, seq, op, idx, reason) of the edits
    that ``apply_edits`` rejects, judged in their turn."""
    return _outcomes(_judged(records, edits)).where(F.col("reason").isNotNull()).drop("previous_value")


def _outcomes(folded: DataFrame) -> DataFrame:
    return (folded.where(F.col("_edits").isNotNull())
            .select("record_id", "record_group_id", F.inline_outer("_f.h")).where(F.col("seq").isNotNull()))


def _folded(records: DataFrame, edits: DataFrame, clean_with: DataFrame | None = None) -> tuple[DataFrame, Column | None]:
    """Records with their batch (_edits) and its fold (_f), and the cleaning functions' column."""
    e, whole = edits, "attribute" in edits.columns
    for c, t in (("sub_idx", "int"), ("coords", "array<array<double>>"), ("page", "int"), *([("review_status", "string")] if whole else [])):
        if c not in e.columns:
            e = e.withColumn(c, F.lit(None).cast(t))
    cols = [*EDIT_COLS, *(["attribute", "review_status"] if whole else [])]
    e = e.withColumn("idx", F.col("idx").cast("int")).withColumn("sub_idx", F.col("sub_idx").cast("int")) \
         .withColumn("seq", F.col("seq").cast("bigint"))
    batch = (e.groupBy("record_id")
              .agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in cols]))).alias("_edits")))
    j = records.join(batch, "record_id", "left")
    fns = None
    if clean_with is not None:
        j = j.join(clean_with.select("record_group_id", F.col("fns").alias("_fns")), "record_group_id", "left")
        fns = F.coalesce(F.col("_fns"), F.create_map().cast("map<string,string>"))
    folded = fold_edits(F.col("attributes"), F.coalesce(F.col("_edits"), F.array().cast(
        T.ArrayType(batch.schema["_edits"].dataType.elementType))), fns is not None, whole)
    return j.withColumn("_f", F.when(F.col("_edits").isNotNull(), folded)), fns


# ---------------------------------------------------------------- reset
def _reset_one(x: Column) -> Column:
    return (x.withField("value", x["raw_text"]).withField("confidence", x["ai_confidence"])
             .withField("edited", F.lit(False)).withField("cleaning_checked", F.lit(True))
             .withField("cleaning_error", F.lit(None).cast("string"))
             .withField("uncleaned_value", F.lit(None).cast("string")).withField("cleaned", F.lit(False))
             .withField("last_cleaned", F.lit(None).cast("timestamp")))


def reset_attributes(attrs: Column) -> Column:
    """M6 on one array: user-added attributes and sub-attributes dropped,
    values back to the raw text, confidence to the model's, edit and
    cleaning state cleared (``normalized_value`` is kept)."""
    kept = F.filter(A.safe_attrs(attrs), lambda a: ~F.coalesce(a["user_added"], F.lit(False)))

    def one(a):
        subs = F.transform(F.filter(a["subattributes"], lambda s: ~F.coalesce(s["user_added"], F.lit(False))),
                           _reset_one)
        return _reset_one(a).withField("subattributes", subs)

    return F.transform(kept, one)


def reset_records(records: DataFrame, cond: Column | None = None) -> DataFrame:
    """M6 on the records matching ``cond`` (all when None)."""
    c = F.lit(True) if cond is None else cond
    return records.select(
        *[F.when(c, reset_attributes(F.col("attributes"))).otherwise(F.col("attributes")).alias(n)
          if n == "attributes" else
          (F.when(c, F.lit("unreviewed")).otherwise(F.col(n)).alias(n) if n == "review_status" else
           (F.when(c, F.lit(None).cast("string")).otherwise(F.col(n)).alias(n) if n == "verification_status"
            else F.col(n)))
          for n in records.columns])


# ---------------------------------------------------------------- status
def status_edits(records: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M5: apply a batch of status changes, any number per record, in
    ``seq`` order (ties by type and status).  ``changes``: (record_id, seq, update_type, review_status,
    verification_status, defective_categories, defective_description).

    Returns (records, decisions) where decisions has ``accepted`` and a
    ``reason`` for rejected changes.  ``reviewed`` arrives only through
    ``verification_status``; ``unreviewed`` resets the record (M6)."""
    ut, rs = F.col("update_type"), F.col("review_status")
    reason = (F.when((ut == "verification_status") & rs.isNull(), F.lit("verification_status needs review_status"))
              .when((ut == "review_status") & ~F.coalesce(rs.isin("unreviewed", "incomplete", "defective"), F.lit(False)),
                    F.lit("invalid review_status"))
              .when(~F.coalesce(ut.isin("verification_status", "review_status"), F.lit(False)), F.lit("invalid update type")))
    dec = changes.withColumn("reason", reason).withColumn("accepted", reason.isNull())
    # a rejected change leaves the record as it is, so no change depends on an earlier one: every column
    # takes its last accepted writer, which is a plain aggregate
    is_v = ut == "verification_status"
    clears = ~is_v & rs.isin("incomplete", "unreviewed")
    defect = ~is_v & (rs == "defective")

    def last(value, cond=None):
        at = F.struct("seq", "update_type", "review_status")
        return F.max_by(F.struct(*value), at if cond is None else F.when(cond, at))

    ok = dec.where("accepted").groupBy("record_id").agg(
        last([rs.alias("v")]).alias("_rs"),
        last([F.when(is_v, F.col("verification_status")).alias("v")], is_v | clears).alias("_vs"),
        last([F.coalesce("defective_categories", F.array().cast("array<string>")).alias("c"),
              F.col("defective_description").alias("d")], defect).alias("_de"),
        F.bool_or(~is_v & (rs == "unreviewed")).alias("_reset"))
    j = records.join(ok, "record_id", "left")
    out = j.select(
        *[c_ for c_ in records.columns if c_ not in ("review_status", "verification_status", "attributes",
                                                      "defective_categories", "defective_description")],
        *[F.when(F.col(new).isNotNull(), F.col(new)[f]).otherwise(F.col(c_)).alias(c_)
          for c_, new, f in (("review_status", "_rs", "v"), ("verification_status", "_vs", "v"),
                             ("defective_categories", "_de", "c"), ("defective_description", "_de", "d"))],
        F.when(F.coalesce("_reset", F.lit(False)), reset_attributes(F.col("attributes")))
         .otherwise(F.col("attributes")).alias("attributes"),
    )
    return out, dec.select("record_id", "seq", "update_type", "accepted", "reason")


# ---------------------------------------------------------------- whole lists and records
def replace_lists(records: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M5 with a whole attribute list: (records, history of every change).

    ``changes``: (record_id, seq, attributes, user, ts), any number a record,
    in the order of ``seq``; a null list is an empty one.  History has a row
    for every position at which a change differs from the list before it
    (that of the change before, or the record's own): ``change`` (added,
    removed or changed), ``idx``, and the elements ``before`` and ``after`` as
    JSON.  One join; a record's changes meet in one row, like its edits."""
    empty = F.array().cast(ATTRS_TYPE)
    per = changes.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("seq").cast("bigint").alias("seq"), F.coalesce("attributes", empty).cast(ATTRS_TYPE).alias("attributes"), "user", "ts"))).alias("_c"))
    j = records.join(per, "record_id", "left")
    out = j.select(*[F.coalesce(F.element_at("_c", -1)["attributes"], F.col(c)).alias(c) if c == "attributes" else F.col(c) for c in records.columns])
    steps = F.transform("_c", lambda x, i: F.struct(
        x["seq"].alias("seq"), x["user"].alias("user"), x["ts"].alias("ts"), x["attributes"].alias("new"),
        F.when(i == 0, A.safe_attrs("attributes")).otherwise(F.get(F.col("_c"), i - 1)["attributes"]).alias("old")))
    rows = j.where(F.col("_c").isNotNull()).select("record_id", "record_group_id", F.inline(steps))
    rows = rows.withColumn("before", F.transform("old", lambda x: F.to_json(x))).withColumn("after", F.transform("new", lambda x: F.to_json(x)))
    pairs = rows.select("record_id", "record_group_id", "seq", "user", "ts", F.posexplode(F.arrays_zip("before", "after")).alias("idx", "p"),
                        F.size("old").alias("_n"), F.size("new").alias("_m"))
    what = (F.when(F.col("idx") >= F.col("_n"), F.lit("added")).when(F.col("idx") >= F.col("_m"), F.lit("removed"))
            .when(~F.col("p.before").eqNullSafe(F.col("p.after")), F.lit("changed")))
    history = pairs.select("record_id", "record_group_id", "seq", "user", "ts", "idx", what.alias("change"), "p.before", "p.after")
    return out, history.where(F.col("change").isNotNull())


def set_fields(records: DataFrame, changes: DataFrame) -> DataFrame:
    """M5 ``record``: top-level fields of records set as given.  ``changes``:
    (record_id, seq, fields to set and, for each, ``set_<field>`` where a null
    value is meant as null); each field takes its last change by ``seq``."""
    cols = [c for c in changes.columns if c not in ("record_id", "seq") and c in records.columns]

    def given(c):
        flag = f"set_{c}"
        return F.coalesce(F.col(flag), F.lit(False)) if flag in changes.columns else F.col(c).isNotNull()

    last = changes.groupBy("record_id").agg(*[F.max_by(F.struct(F.col(c).alias("v")), F.when(given(c), F.col("seq"))).alias(f"_new_{c}") for c in cols])
    j = records.join(last, "record_id", "left")
    return j.select(*[F.when(F.col(f"_new_{c}").isNotNull(), F.col(f"_new_{c}")["v"]).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in records.columns])


# ---------------------------------------------------------------- notes
NOTES_TYPE = T.ArrayType(NOTE_TYPE)


def _note_step(acc: Column, e: Column) -> Column:
    """M9: one note operation (add / reply / edit / delete / resolve /
    unresolve) on the note array; a note's index is its position."""
    n = F.size(acc)
    op = e["op"]
    new = F.struct(n.alias("idx"), e["text"].alias("text"), e["user"].alias("creator"), e["ts"].alias("ts"),
                   F.lit(False).alias("resolved"), F.lit(False).alias("deleted"),
                   e["ts"].alias("last_updated"), e["user"].alias("last_updated_user"),
                   (op == "reply").alias("is_reply"),
                   F.when(op == "reply", e["target"]).alias("replies_to"),
                   F.array().cast("array<int>").alias("replies")).cast(NOTE_TYPE)

    def touch(x, **fields):
        for k, v in fields.items():
            x = x.withField(k, v)
        return x.withField("last_updated", e["ts"]).withField("last_updated_user", e["user"])

    added = F.concat(acc, F.array(new))
    replied = F.transform(added, lambda x, i: F.when(i == e["target"], x.withField(
        "replies", F.concat(x["replies"], F.array(n)))).otherwise(x))
    edit = F.transform(acc, lambda x, i: F.when(i == e["target"], touch(x, text=e["text"])).otherwise(x))
    delete = F.transform(acc, lambda x, i: F.when(i == e["target"], touch(x, deleted=F.lit(True))).otherwise(x))
    resolve = F.transform(acc, lambda x, i: F.when(i == e["target"], touch(x, resolved=F.lit(True))).otherwise(x))
    unresolve = F.transform(acc, lambda x, i: F.when(i == e["target"], touch(x, resolved=F.lit(False))).otherwise(x))
    return (F.when(op == "add", added).when(op == "reply", replied).when(op == "edit", edit)
             .when(op == "delete", delete).when(op == "resolve", resolve).when(op == "unresolve", unresolve)
             .otherwise(acc)).cast(NOTES_TYPE)


def apply_note_edits(notes: Column, ops: Column) -> Column:
    """Fold a sorted array of note operations (op, target, text, user, ts)."""
    return F.aggregate(ops, F.coalesce(notes, F.array().cast(NOTES_TYPE)), _note_step)


# ---------------------------------------------------------------- dimensions
def upsert_dimension(table: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Field-level update of dimension rows; a change row gives new
    values for some columns (NULL = keep).  Of several changes of a key each
    column takes its own last non-null value by ``seq`` (its largest value
    where the changes have no ``seq``)."""
    cols = [c for c in changes.columns if c not in (key, "seq") and c in table.columns]

    def newest(c):
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))) if "seq" in changes.columns else F.max(c)

    ch = changes.groupBy(key).agg(*(newest(c).alias(c) for c in cols))
    ch = ch.select(key, *[F.col(c).alias(f"_new_{c}") for c in cols])
    j = table.join(ch, key, "left")
    return j.select(*[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in table.columns])
