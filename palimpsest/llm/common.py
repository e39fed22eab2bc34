"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: query name -> (builder(spark, sf_dir), DuckDB SQL or None)
REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (a cluster that ships it with --py-files finds it there as well)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder, below this application's id
    (the folder can go when the application has ended)."""
    importable(spark)
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/palimpsest-llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    the lineage, survives lost executors, and gives the planner true sizes."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(lengths, budget: int) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of rows holding about ``budget`` characters (one row at
    least), so that numpy buffers stay bounded whatever the batch size."""
    a, total = 0, 0
    for i, n in enumerate(lengths):
        if i > a and total + n > budget:
            yield a, i
            a, total = i, 0
        total += n
    if a < len(lengths):
        yield a, len(lengths)


def map_text(docs: DataFrame, keep: list[str], fn: Callable[[list[str]], dict], fields: str,
             text_col: str = "text", budget: int = 8_000_000) -> DataFrame:
    """``keep`` columns of ``docs``, untouched, plus ``fields`` (a DDL string)
    that ``fn`` computes from a list of whole texts (null: empty) as a dict of
    lists.  Arrow batches; ``fn`` sees about ``budget`` characters at a time."""
    importable(docs.sparkSession)
    new = T.StructType.fromDDL(fields)
    src = docs.select(*keep, text_or_empty(text_col).alias("__whole_text"))
    schema = T.StructType([src.schema[c] for c in keep] + new.fields)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in new.fields]
        for rb in batches:
            texts = rb.column(rb.num_columns - 1)
            for a, b in slices(pc.utf8_length(texts).to_pylist(), budget):  # texts become Python objects a slice at a time
                got = fn(texts.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rb.column(i).slice(a, b - a) for i in range(len(keep))]
                    + [pa.array(got[f.name], k) for f, k in zip(new.fields, kinds, strict=True)],
                    names=[*keep, *new.names])

    return src.mapInArrow(run, schema)


#: columns of documents
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def extras_aside(fn):
    """A pipeline stage whose documents' further columns travel in one struct,
    so that whatever their names they can't clash with the stage's own."""

    @functools.wraps(fn)
    def run(spark, docs, sf_dir):
        extra = [c for c in docs.columns if c not in DOCUMENT]
        if not extra:
            return fn(spark, docs, sf_dir)
        cols = docs.columns
        aside = docs.select(*[c for c in cols if c in DOCUMENT], F.struct(*[F.col(f"`{c}`") for c in extra]).alias("extra"))
        out = fn(spark, aside, sf_dir)
        return out.select(*[F.col("extra").getField(c).alias(c) if c in extra else F.col(c) for c in cols])

    return run


def by_shuffle(df: DataFrame) -> DataFrame:
    """Side of a join on text or binary keys whose other side holds no whole
    texts: it is shuffled and merged at every size.  A broadcast of such keys
    costs the driver much heap (measured: 128 to 323 MB committed for 100 rows)."""
    return df.hint("merge")


def arrow_schema(fields: str):
    """Arrow schema of a DDL string (made on the driver, tasks have no session)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(fields))


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, mod ``folds`` (a null id counts as '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """16 bytes that name a row by id and whole text (null id: none; null
    text: empty), for joins that must not depend on unique or non-null ids."""
    ident = F.coalesce(F.concat(F.lit("i"), F.col(doc_id).cast("string")), F.lit("n"))
    return F.unhex(F.md5(F.concat(ident, F.lit("|"), text_or_empty(text)).cast("binary")))


def map_groups(df: DataFrame, keys: list[str], fn, fields: str) -> DataFrame:
    """Group ``df`` by ``keys`` (each group must be bounded) and run ``fn`` on
    many whole groups at a time: ``fn(table, starts)`` gets an Arrow table
    sorted by the keys and the first row of each group, and returns a dict of
    lists.  Cheaper than one call a group where most groups are tiny."""
    importable(df.sparkSession)
    new = T.StructType.fromDDL(fields)
    ordered = df.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in new.fields]

        def out(t, starts):
            got = fn(t, starts)
            return pa.RecordBatch.from_arrays([pa.array(got[f.name], k) for f, k in zip(new.fields, kinds, strict=True)],
                                              names=new.names)

        rest = None
        for rb in batches:
            if not rb.num_rows:
                continue
            t = pa.Table.from_batches([rb])
            t = t if rest is None else pa.concat_tables([rest, t])
            change = np.zeros(t.num_rows, bool)
            change[0] = True
            for k in keys:
                v = t.column(k).to_numpy()
                change[1:] |= v[1:] != v[:-1]
            starts = np.flatnonzero(change)
            if len(starts) > 1:
                yield out(t.slice(0, starts[-1]), starts[:-1])
            rest = t.slice(starts[-1])
        if rest is not None:
            yield out(rest, np.zeros(1, np.int64))

    return ordered.mapInArrow(run, new)


def most_frequent(counts: DataFrame, word: str, n: str, size: int) -> DataFrame:
    """Rows of a table of counts whose words are among the most frequent:
    whole steps of the count (a sixteenth of a power of two each), as many as
    hold ``size`` rows at most.  A histogram of the steps, a few hundred rows,
    finds the limit, so no task sorts or gathers candidates of all others."""
    step = F.floor(F.log2(F.col(n).cast("double")) * 16).cast("int")
    least, total = None, 0
    for s, k in sorted(counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):
        if total + k > size:
            break
        least, total = s, total + k
    return counts.where(F.lit(False) if least is None else step >= least).select(word, n)
