"""H2 at any depth: the values inside history payloads, one row per leaf.

Payloads are JSON texts of any nesting.  ``typed_values`` walks them in one
scan and gives every leaf with its JSON path, its own type and, where the
action is a tagged one, the numeric tag (``int`` / ``float``, never for
booleans) of an attribute's value.  Whether a number is an int or a float is
read from its text (``1`` and ``1.0`` differ), before any conversion.

A value is tagged when it is the ``value`` of

* an object that also has a ``key``, wherever it stands in the payload;
* an object in a list of attributes: the payload's own list, any list reached
  on the way, the list under ``attributesList``, and, below these, the list
  under ``subattributes``.  Inside ``attributesList`` only attributes and their
  sub-attributes are tagged, not what else they hold.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import importable

#: fixed values: actions whose payloads are tagged, and the payloads of each
TAGGED_FIELDS = {"updateRecord": ("query", "previous_state"), "cleanRecord": ("attributesList_before", "attributesList_after")}
PAYLOADS = ("query", "previous_state", "attributesList_before", "attributesList_after")
VALUE_FIELDS = "field string, path string, leaf_type string, value_num double, value_text string, num_type string"
_PLAIN_KEY = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _kind(v) -> str | None:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, int):
        return "int"
    if isinstance(v, float):
        return "float"
    return "string" if isinstance(v, str) else None


def leaves(payload) -> list[tuple[str, str, float | None, str | None, bool]]:
    """(path, type, number, text, whether it is an attribute's value) of every leaf."""
    out = []
    # how a node was reached: "payload" (tagged with a key and a value), "both" (also an element of a payload's list),
    # "attributes" / "attribute" (the list under attributesList and its elements), "inside" (anything else in those)
    todo = [(payload, "$", "payload", False)]
    while todo:
        node, path, mode, tagged = todo.pop()
        if isinstance(node, dict):
            own = mode in ("attribute", "both") or (mode == "payload" and "key" in node and "value" in node)
            for k, v in node.items():
                at = f"{path}.{k if _PLAIN_KEY.fullmatch(k) else json.dumps(k, ensure_ascii=False)}"
                if mode in ("payload", "both"):
                    below = "attributes" if k == "attributesList" and isinstance(v, list) else "payload"
                else:
                    below = "attributes" if mode == "attribute" and k == "subattributes" and isinstance(v, list) else "inside"
                todo.append((v, at, below, own and k == "value"))
        elif isinstance(node, list):
            each = {"payload": "both", "both": "both", "attributes": "attribute"}.get(mode, "inside")
            todo.extend((v, f"{path}[{i}]", each, False) for i, v in enumerate(node))
        else:
            kind = _kind(node)
            number = float(node) if kind in ("int", "float") else None
            text = node if kind == "string" else str(node).lower() if kind == "boolean" else None
            out.append((path, kind, number, text, tagged))
    return out


def typed_values(history: DataFrame, keep: tuple[str, ...] = ("history_id", "record_id", "action", "ts"), payloads: tuple[str, ...] = PAYLOADS) -> DataFrame:
    """``keep`` plus field, path, leaf_type, value_num, value_text and num_type
    of every leaf of the payload columns that ``history`` has.  A null payload
    has no rows; one that is not JSON is a single leaf of type ``unreadable``."""
    importable(history.sparkSession)
    fields = [c for c in payloads if c in history.columns]
    src = history.select(*keep, F.col("action").alias("__action"), *fields)
    new = T.StructType.fromDDL(VALUE_FIELDS)

    def run(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.string(), pa.string(), pa.float64(), pa.string(), pa.string()]
        for rb in batches:
            actions = rb.column(len(keep)).to_pylist()
            rows, cols = [], [[] for _ in new.names]
            for j, field in enumerate(fields):
                for i, text in enumerate(rb.column(len(keep) + 1 + j).to_pylist()):
                    if text is None:
                        continue
                    try:
                        found = leaves(json.loads(text))
                    except (ValueError, RecursionError, OverflowError):
                        found = [("$", "unreadable", None, text, False)]
                    tags = field in TAGGED_FIELDS.get(actions[i], ())
                    rows.extend([i] * len(found))
                    for path, kind, number, value, own in found:
                        tag = kind if tags and own and kind in ("int", "float") else None
                        for c, v in zip(cols, (field, path, kind, number, value, tag), strict=True):
                            c.append(v)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([rb.column(k).take(at) for k in range(len(keep))]
                                             + [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[*keep, *new.names])

    return src.mapInArrow(run, T.StructType([src.schema[c] for c in keep] + new.fields))


def record_history(history: DataFrame, record_id, ts: str = "ts", id_col: str = "history_id") -> DataFrame:
    """O6 + H2: one record's history, newest first (ties: larger id first).
    The record is selected before the sort, so nothing else is moved."""
    return history.where(F.col("record_id") == F.lit(record_id)).orderBy(F.col(ts).desc(), F.col(id_col).desc())
