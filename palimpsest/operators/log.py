"""Append-only logs (history, archives) with exactly-once batches.

A batch has an id given by its writer.  Its rows are written to a folder of
their own, one for each attempt, and count only once a marker file names that
attempt; creating the marker is one atomic step on any file system, after all
data files are complete.  Appending a batch again (a retry after a lost
driver, or on purpose) writes a new attempt, whose marker replaces the earlier
one: readers always see one whole copy of each batch, the newest, and nothing
of attempts that never got a marker.

    <path>/data/<batch>/<attempt>/...      rows
    <path>/commits/<batch>.<n>.<attempt>   empty markers; the largest n of a batch holds
"""

from __future__ import annotations

import time
import uuid
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import hadoop_path


class AppendLog:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def append(self, rows: DataFrame, batch_id: str) -> None:
        """The batch's rows, in place of any earlier attempt at it."""
        self.commit(batch_id, self.write(rows, batch_id))

    def write(self, rows: DataFrame, batch_id: str) -> str:
        """Rows of an attempt that doesn't count yet; returns the attempt."""
        attempt = uuid.uuid4().hex
        rows.select(*self.schema.names).write.parquet(self._data(batch_id, attempt))
        return attempt

    def commit(self, batch_id: str, attempt: str) -> None:
        n = 1 + max((k for b, k, _ in self._commits() if b == batch_id), default=0)
        fs, p = hadoop_path(self.spark, f"{self.path}/commits/{_name(batch_id)}.{n}.{attempt}")
        fs.create(p, False).close()

    def batches(self) -> dict[str, str]:
        """The attempt that holds, by batch."""
        return {b: attempt for b, _, attempt in sorted(self._commits())}

    def read(self) -> DataFrame:
        paths = [self._data(b, a) for b, a in self.batches().items()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def clean(self, older_than: float = 86_400.0) -> int:
        """Delete attempts that don't hold and are older than so many seconds
        (readers and writers under way are done by then); how many went."""
        held, gone = self.batches(), 0
        fs, root = hadoop_path(self.spark, f"{self.path}/data")
        for batch in fs.listStatus(root) if fs.exists(root) else []:
            for attempt in fs.listStatus(batch.getPath()):
                stale = time.time() - attempt.getModificationTime() / 1000 >= older_than
                if stale and held.get(unquote(batch.getPath().getName()[1:])) != attempt.getPath().getName():
                    fs.delete(attempt.getPath(), True)
                    gone += 1
        return gone

    def _data(self, batch_id: str, attempt: str) -> str:
        return f"{self.path}/data/{_name(batch_id)}/{attempt}"

    def _commits(self) -> list[tuple[str, int, str]]:
        fs, root = hadoop_path(self.spark, f"{self.path}/commits")
        if not fs.exists(root):
            return []
        names = (s.getPath().getName().rsplit(".", 2) for s in fs.listStatus(root))
        return [(unquote(b[1:]), int(n), a) for b, n, a in names]


def _name(batch_id: str) -> str:
    """A folder name that no batch id shares with another; none starts with
    ``_`` or ``.`` (files of such names are skipped by readers)."""
    return "b" + quote(batch_id, safe="").replace(".", "%2E").replace("_", "%5F")
