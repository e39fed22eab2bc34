"""Record filters (F1, F8, F9, F10 helpers).

``record_filter(spec, schema)`` turns a client filter document of the
kind the reference forwards to its database into one Spark ``Column``.
It is a translation of a small, closed set of operators into DataFrame
expressions -- no planner: Catalyst pushes the flat comparisons down to
the Parquet scan and keeps the array ones (``exists``) in codegen.

Supported: equality (NULL matches missing), ``$eq $ne $gt $gte $lt $lte
$in $nin $exists $regex $options $not $elemMatch $and $or $nor``, and
dotted paths through arrays with any-element semantics.  Anything else
raises ``ValueError``.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: reference field names -> our column names
FIELD_NAMES = {
    "attributesList": "attributes",
    "dateCreated": "date_created",
    "isSubattribute": "is_subattribute",
    "topLevelAttribute": "top_level_attribute",
    "lastUpdated": "last_updated",
    "lastUpdatedUser": "last_updated_user",
    "record_notes": "notes",
    "_id": "record_id",
}

_CMP = {
    "$gt": lambda c, v: c > v,
    "$gte": lambda c, v: c >= v,
    "$lt": lambda c, v: c < v,
    "$lte": lambda c, v: c <= v,
}


def _lit(v):
    return F.lit(v)


def _leaf(c: Column, dt: T.DataType, op: str, v, opts: str = "") -> Column:
    """Predicate on one scalar (or, for arrays of scalars, any element)."""
    if isinstance(dt, T.ArrayType) and op not in ("$exists", "$size"):
        if op in ("$ne", "$nin"):
            pos = "$eq" if op == "$ne" else "$in"
            return ~F.coalesce(F.exists(c, lambda e: _leaf(e, dt.elementType, pos, v, opts)), F.lit(False))
        return F.coalesce(F.exists(c, lambda e: _leaf(e, dt.elementType, op, v, opts)), F.lit(False))
    if op == "$eq":
        return c.isNull() if v is None else F.coalesce(c == _lit(v), F.lit(False))
    if op == "$ne":
        return c.isNotNull() if v is None else ~F.coalesce(c == _lit(v), F.lit(False))
    if op in _CMP:
        return F.coalesce(_CMP[op](c, _lit(v)), F.lit(False))
    if op == "$in":
        vals = [x for x in v if x is not None]
        hit = F.coalesce(c.isin(*vals), F.lit(False)) if vals else F.lit(False)
        return (hit | c.isNull()) if any(x is None for x in v) else hit
    if op == "$nin":
        return ~_leaf(c, dt, "$in", v)
    if op == "$exists":
        return c.isNotNull() if v else c.isNull()
    if op == "$regex":
        pat = f"(?{opts})" + v if opts else v
        return F.coalesce(c.rlike(pat), F.lit(False))
    if op == "$size":
        return F.coalesce(F.size(c) == _lit(v), F.lit(False))
    raise ValueError(f"unsupported filter operator {op!r}")


def _regex(v, opts: str = "") -> tuple[str, str]:
    """Pattern text and inline flags of a string or compiled pattern."""
    if isinstance(v, re.Pattern):
        for flag, letter in ((re.I, "i"), (re.M, "m"), (re.S, "s"), (re.X, "x")):
            opts += letter if v.flags & flag else ""
        if v.flags & (re.A | re.L):
            raise ValueError("unsupported regex flag")
        v = v.pattern
    if set(opts) - set("imsx"):
        raise ValueError(f"unsupported regex options {opts!r}")
    return v, "".join(sorted(set(opts)))


def _asks_null(op: str, v) -> bool:
    return v is None if op == "$eq" else op == "$in" and any(x is None for x in v)


def _resolve(c: Column | None, dt: T.DataType, parts: list[str], pred, missing: bool = False) -> Column:
    """Walk a dotted path; arrays of structs give any-element semantics.
    ``missing``: the answer where an array on the way is NULL."""
    if not parts:
        return pred(c, dt)
    head, rest = parts[0], parts[1:]
    if isinstance(dt, T.ArrayType):
        if head.isdigit():
            return _resolve(F.get(c, int(head)), dt.elementType, rest, pred, missing)
        return F.coalesce(F.exists(c, lambda e: _resolve(e, dt.elementType, parts, pred, missing)), F.lit(missing))
    if isinstance(dt, T.StructType):
        name = FIELD_NAMES.get(head, head)
        if name not in dt.fieldNames():
            raise ValueError(f"unknown field {head!r}")
        f = dt[name]
        sub = F.col(name) if c is None else c.getField(name)
        return _resolve(sub, f.dataType, rest, pred, missing)
    raise ValueError(f"cannot descend into {head!r}")


def _field_pred(path: str, cond, schema: T.StructType, base: Column | None) -> Column:
    parts = path.split(".")
    if isinstance(cond, dict) and cond and all(k.startswith("$") for k in cond):
        opts = cond.get("$options", "")
        preds = []
        for op, v in cond.items():
            if op == "$options":
                continue
            if op == "$not":
                inner = v if isinstance(v, dict) else {"$regex": v}
                preds.append(~_field_pred(path, inner, schema, base))
            elif op == "$elemMatch":
                preds.append(_resolve(base, schema, parts, lambda c, dt: _elem_match(c, dt, v)))
            elif op in ("$ne", "$nin"):
                # negative operators hold when no element / value matches
                pos = "$eq" if op == "$ne" else "$in"
                preds.append(~_resolve(base, schema, parts, lambda c, dt, _p=pos, _v=v: _leaf(c, dt, _p, _v),
                                       _asks_null(pos, v)))
            elif op == "$exists":
                there = _resolve(base, schema, parts, lambda c, dt: c.isNotNull())
                preds.append(there if v else ~there)
            elif op == "$regex":
                pat, flags = _regex(v, opts)
                preds.append(_resolve(base, schema, parts, lambda c, dt, _p=pat, _f=flags: _leaf(c, dt, "$regex", _p, _f)))
            else:
                preds.append(_resolve(base, schema, parts, lambda c, dt, _o=op, _v=v: _leaf(c, dt, _o, _v, opts),
                                      _asks_null(op, v)))
        out = preds[0]
        for p in preds[1:]:
            out = out & p
        return out
    if isinstance(cond, re.Pattern):
        return _field_pred(path, {"$regex": cond}, schema, base)
    # {field: null} is {field: {$eq: null}}: some element (or the path itself) is null or missing
    return _resolve(base, schema, parts, lambda c, dt: _leaf(c, dt, "$eq", cond), _asks_null("$eq", cond))


def _elem_match(c: Column, dt: T.DataType, spec: dict) -> Column:
    if not isinstance(dt, T.ArrayType):
        return F.lit(False)
    et = dt.elementType
    if isinstance(et, T.StructType):
        return F.coalesce(F.exists(c, lambda e: _compile(spec, et, e)), F.lit(False))
    return F.coalesce(F.exists(c, lambda e: _field_ops_scalar(e, et, spec)), F.lit(False))


def _field_ops_scalar(e: Column, dt: T.DataType, spec: dict) -> Column:
    out = F.lit(True)
    for op, v in spec.items():
        if op == "$options":
            continue
        v, opts = _regex(v, spec.get("$options", "")) if op == "$regex" else (v, "")
        out = out & _leaf(e, dt, op, v, opts)
    return out


def _compile(spec: dict, schema: T.StructType, base: Column | None) -> Column:
    preds = []
    for k, v in spec.items():
        if k == "$and":
            preds.append(_all([_compile(s, schema, base) for s in v]))
        elif k == "$or":
            preds.append(_any([_compile(s, schema, base) for s in v]))
        elif k == "$nor":
            preds.append(~_any([_compile(s, schema, base) for s in v]))
        elif k == "$expr":
            raise ValueError("$expr is not supported")
        elif k.startswith("$"):
            raise ValueError(f"unsupported top-level operator {k!r}")
        else:
            preds.append(_field_pred(k, v, schema, base))
    return _all(preds)


def _all(ps):
    out = F.lit(True)
    for p in ps:
        out = out & p
    return out


def _any(ps):
    out = F.lit(False)
    for p in ps:
        out = out | p
    return out


def record_filter(spec: dict | None, schema: T.StructType) -> Column:
    """compile a filter document against ``schema`` into a Column."""
    if not spec:
        return F.lit(True)
    return _compile(spec, schema, None)


def active_locks(locks, as_of: datetime, lifetime_s: int = 120):
    """F8: locks still valid at ``as_of`` (``timestamp + 120 s >= t``;
    expired is strict ``<``).  Returns every lock with its state."""
    # as text -> the timestamp type of the lock column: independent of the
    # session time zone (the stored times have no zone)
    t = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    expires = F.col("timestamp") + F.expr(f"INTERVAL {int(lifetime_s)} SECONDS")
    return locks.select("*", expires.alias("expires_at"), (expires >= t).alias("active"))


# fixed values: review-gate messages (the verified one embeds the review status)
GATE_REQUIRED = "This record is awaiting verification by a team lead."
GATE_VERIFIED = "This record has been verified as {review_status}, and can only be edited by a team lead."
GATE_LOCKED = "This record is currently being reviewed by a team member."


def review_gate(verification_status: Column, review_status: Column, can_verify: Column,
                locked_by_other: Column) -> Column:
    """(locked, message) for a user opening a record.  A lock held by
    someone else wins; otherwise a record awaiting or past verification is
    locked for users without ``verify_record``."""
    held = F.coalesce(locked_by_other, F.lit(False))
    needs = verification_status.isin("required", "verified") & ~F.coalesce(can_verify, F.lit(False))
    pre, post = GATE_VERIFIED.split("{review_status}")
    msg = (F.when(held, F.lit(GATE_LOCKED))
           .when(needs & (verification_status == "required"), F.lit(GATE_REQUIRED))
           .when(needs, F.concat(F.lit(pre), F.coalesce(review_status.cast("string"), F.lit("None")), F.lit(post))))
    return F.struct(msg.isNotNull().alias("locked"), msg.alias("lock_message"))
