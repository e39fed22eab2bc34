"""Column builders for names and file paths.

All are native Spark expressions (stay inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: recognised upload types, tested in this order on the
# lower-cased file name (first match wins)
UPLOAD_TYPES = [".pdf", ".tif", ".png", ".jpg", ".jpeg"]
# extensions that are rasterised to PNG pages on ingest
RASTERISED = [".pdf", ".tif", ".tiff"]


def api_number(name: Column) -> Column:
    """Integer before the first ``_`` of the record name, else NULL."""
    return F.trim(F.split_part(name, F.lit("_"), F.lit(1))).try_cast("bigint")


def base_filename(filename: Column) -> Column:
    """Text before the first dot."""
    return F.substring_index(filename, ".", 1)


def valid_images(image_files: Column) -> Column:
    """page-image names longer than two characters."""
    return F.filter(F.coalesce(image_files, F.array().cast("array<string>")), lambda f: F.length(f) > 2)


def image_keys(record_group_id: Column, record_id: Column, image_files: Column, filename: Column) -> Column:
    """Storage keys ``uploads/{group}/{record}/{file}`` of the valid
    pages; a record without a valid page falls back to its filename."""
    valid = valid_images(image_files)
    files = F.when(F.size(valid) > 0, valid).otherwise(F.array(filename))
    return F.transform(files, lambda f: F.concat_ws("/", F.lit("uploads"), record_group_id,
                                                      record_id.cast("string"), f))


def page_names(name: Column, n_pages: Column, ext: str = ".png") -> Column:
    """Stored page names ``name.png``, ``name_2.png``, ... for a file
    of ``n_pages`` pages (0 pages gives an empty list)."""
    seq = F.sequence(F.lit(1), F.greatest(n_pages, F.lit(1)))
    names = F.transform(seq, lambda i: F.when(i == 1, F.concat(name, F.lit(ext)))
                        .otherwise(F.concat(name, F.lit("_"), i.cast("string"), F.lit(ext))))
    return F.when(n_pages >= 1, names).otherwise(F.array().cast("array<string>"))


def stored_extension(ext: Column) -> Column:
    """``.pdf``/``.tif``/``.tiff`` are stored as ``.png`` (case-blind, Q-17)."""
    return F.when(F.lower(ext).isin(*RASTERISED), F.lit(".png")).otherwise(ext)


def upload_type(filename: Column) -> Column:
    """document type by substring of the lower-cased name, first match
    in ``UPLOAD_TYPES`` order; NULL means the file is skipped."""
    low = F.lower(filename)
    out = None
    for t in UPLOAD_TYPES:
        cond = F.contains(low, F.lit(t))
        out = F.when(cond, F.lit(t)) if out is None else out.when(cond, F.lit(t))
    return out
