"""Upload checks (F6, J10, J11, O8, P9, U4, Q-12, Q-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from .order import first_n_per_group


def classify_documents(uploads: DataFrame, name_col: str = "upload_name") -> DataFrame:
    """the upload type of each file (first matching substring of the
    lower-cased name); NULL = not an accepted type, skipped."""
    return uploads.withColumn("doc_type", N.upload_type(F.col(name_col)))


def existing_bases(uploads: DataFrame, records: DataFrame, name_col: str = "upload_name") -> DataFrame:
    """Distinct (group, base name) of candidates whose base name
    already exists in the group (left-semi on both keys; Q-12: only the
    base-name form)."""
    cand = uploads.select("record_group_id", N.base_filename(F.col(name_col)).alias("base_name")).distinct()
    have = records.select("record_group_id", N.base_filename(F.col("filename")).alias("base_name"))
    return cand.join(have, ["record_group_id", "base_name"], "left_semi")


def pending_uploads(uploads: DataFrame, records: DataFrame, name_col: str = "upload_name",
                    cap: int | None = None, by_base_name: bool = False) -> DataFrame:
    """Accepted files not yet in their group (exact stored
    filename, or base name with ``by_base_name`` -- Q-13); all of them, or
    at most ``cap`` per group in name order where a caller asks for one."""
    typed = classify_documents(uploads, name_col).where(F.col("doc_type").isNotNull())
    if by_base_name:
        left = typed.withColumn("_k", N.base_filename(F.col(name_col)))
        right = records.select("record_group_id", N.base_filename(F.col("filename")).alias("_k"))
    else:
        left = typed.withColumn("_k", F.col(name_col))
        right = records.select("record_group_id", F.col("filename").alias("_k"))
    new = left.join(right, ["record_group_id", "_k"], "left_anti").drop("_k")
    if cap is None:
        return new
    ties = [F.col("upload_id").asc()] if "upload_id" in new.columns else []
    return first_n_per_group(new, ["record_group_id"], [F.col(name_col).asc(), *ties], cap)
