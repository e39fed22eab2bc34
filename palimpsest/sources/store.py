"""Stored model tables.

The source system keeps one nested document per record; the tables in a
test-data directory are flat.  ``stored_table`` derives a model table
once, writes it as Parquet under the session's checkpoint directory (the
cluster's shared folder), and serves every later query from the files:

* lineage is cut (a lost executor re-reads files instead of re-running
  the nesting shuffle);
* queries read only the nested fields they use (Parquet nested-column
  pruning), as they would against the real record store;
* the layout is range-partitioned on (record_group_id, record_id) and
  sorted, so group filters skip row groups and a hot group is spread
  over several files instead of one.

The file name carries a fingerprint of the input files (path, size,
modification time), so changed inputs give a new table.  A table is
written to a temporary folder and renamed into place once complete, so
readers never see a partial table.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

STORE_ENV = "PALIMPSEST_STORE"


def _code_version() -> str:
    """Hash of the model builder's source: a change to how tables are
    derived gives new stored tables, never stale ones."""
    here = os.path.dirname(os.path.abspath(__file__))
    h = hashlib.sha1()
    for f in ("model.py", "store.py", os.path.join("..", "functions", "names.py")):
        with open(os.path.join(here, f), "rb") as fh:
            h.update(fh.read())
    return h.hexdigest()[:10]


CODE_VERSION = _code_version()


def enabled() -> bool:
    return os.environ.get(STORE_ENV, "1") != "0"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    h = hashlib.sha1()
    for path in sorted(paths):
        fs, p = _fs(spark, path)
        for st in fs.listStatus(p) if fs.isDirectory(p) else [fs.getFileStatus(p)]:
            h.update(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()};".encode())
    return h.hexdigest()[:16]


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def stored_table(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame],
                 layout: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Return the stored table ``name`` derived from ``inputs``, building
    and writing it first when it does not exist yet."""
    return spark.read.parquet(stored_path(spark, name, inputs, build, layout))


def stored_path(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame],
                layout: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Path of the stored table (built first when missing); usable as a
    file-stream source directory."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/palimpsest-store"
    final = f"{root}/{name}-{fingerprint(spark, inputs)}-{CODE_VERSION}"
    if not _exists(spark, f"{final}/_SUCCESS"):
        tmp = f"{root}/_tmp-{name}-{uuid.uuid4().hex[:12]}"
        df = build()
        (layout(df) if layout else df).write.mode("overwrite").parquet(tmp)
        fs, src = _fs(spark, tmp)
        _, dst = _fs(spark, final)
        if not fs.rename(src, dst) and not _exists(spark, f"{final}/_SUCCESS"):
            raise RuntimeError(f"could not publish stored table {final}")
    return final


def cluster_by(df: DataFrame, partitions: int, *keys) -> DataFrame:
    """Range-partition on ``keys`` and sort inside partitions: files are
    clustered by the first key, and a value of it that holds a large share of
    all rows is split across several partitions."""
    return df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
