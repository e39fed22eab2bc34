"""Stream forms (T1-T3): the batch functions, fed by Structured Streaming.

Each runs a file-source stream to completion (``availableNow``) into a
table under the session's checkpoint directory (the cluster's shared
folder; a scratch folder only when unset, as in tests) and returns that
table as a batch DataFrame.  Sinks are idempotent per micro-batch
(``foreachBatch`` writes a batch-id partition), so a retried batch after
an executor or driver loss overwrites rather than duplicates.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..functions import names as N
from ..operators import clean as CL
from ..operators import extract as E
from ..operators import schema as SC
from ..session import hadoop_path, importable, work_folder
from ..sources import model as M


def _batch_sink(out_path: str):
    """foreachBatch writer: each micro-batch replaces its own partition."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
              .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))
    return write


def _run(stream_df: DataFrame, out_path: str, ckpt: str, mode: str = "append") -> None:
    q = (stream_df.writeStream.outputMode(mode).option("checkpointLocation", ckpt)
                  .foreachBatch(_batch_sink(out_path)).trigger(availableNow=True).start())
    q.awaitTermination()


def activity_stream(events: DataFrame, window: str = "1 day", delay: str | None = None) -> DataFrame:
    """Activity counts per event-time window and action.  Without
    ``delay`` no event is ever late and the state is one row per window and
    action; with it, closed windows leave the state and events that come
    later than ``delay`` don't count."""
    # watermarks need TIMESTAMP (with time zone); parquet may hold NTZ
    h = M.history_from(events).withColumn("ts", F.col("ts").cast("timestamp"))
    return ((h.withWatermark("ts", delay) if delay else h)
             .groupBy(F.window("ts", window).alias("w"), "action")
             .agg(F.count(F.lit(1)).alias("n"))
             .select(F.col("w.start").alias("window_start"), "action", "n"))


def stream_activity(spark: SparkSession, source_dir: str, glob: str = "events*.parquet",
                    window: str = "1 day", delay: str | None = None, max_files: int | None = None) -> DataFrame:
    """Run T3 over the event files in ``source_dir`` (update mode: the
    latest update of each window is its count) and return the counts."""
    schema = spark.read.parquet(f"{source_dir}/{glob}").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    src = r.parquet(source_dir)
    work = work_folder(spark, "activity")
    _run(activity_stream(src, window, delay), f"{work}/out", f"{work}/ckpt", mode="update")
    out = spark.read.parquet(f"{work}/out")
    last = out.groupBy("window_start", "action").agg(F.max_by("n", "batch_id").alias("n"))
    return last


DEDUPE_KEYS = ["record_group_id", "base_name"]


def dedupe_stream(uploads: DataFrame, hold: int) -> DataFrame:
    """T2, the part with state: (group, base name) at its first sight.  A key
    is held for ``hold`` milliseconds after it was last seen, by a timer on
    processing time, so the state is bounded by the keys of that time; no upload
    is ever too late.  Keys seen again later come out again: ``dedupe_sink``
    knows them from the tables."""
    def first(key, _, state):
        if state.hasTimedOut:
            state.remove()
            return
        if not state.exists:
            yield pd.DataFrame([key], columns=DEDUPE_KEYS, dtype=object)
        state.update((True,))
        state.setTimeoutDuration(hold)

    importable(uploads.sparkSession)
    cand = uploads.select("record_group_id", N.base_filename(F.col("upload_name")).alias("base_name"))
    return cand.groupBy(*DEDUPE_KEYS).applyInPandasWithState(
        first, "record_group_id string, base_name string", "seen boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)


def dedupe_sink(out_path: str, records: DataFrame):
    """T2, the part without: of a batch's keys those that neither a stored
    record nor an earlier batch has are written, as the batch's own partition
    (a batch that is run again replaces it)."""
    have = records.select("record_group_id", N.base_filename(F.col("filename")).alias("base_name"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.select(*DEDUPE_KEYS).join(have, DEDUPE_KEYS, "left_anti")
        fs, p = hadoop_path(spark, out_path)
        if fs.exists(p):
            # the table as it was before this batch
            out = spark.read.schema("record_group_id string, base_name string, batch_id long").parquet(out_path)
            new = new.join(out.where(F.col("batch_id") < batch_id), DEDUPE_KEYS, "left_anti")
        new.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
    return write


def run_dedupe(uploads: DataFrame, records: DataFrame, out_path: str, ckpt: str, hold: int = 3_600_000) -> int:
    """Run T2 over what the source has; returns the keys left in the state."""
    spark, idle = uploads.sparkSession, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(idle)
    # timers on processing time would ask for one more batch without data for ever; the query keeps what is set at its start
    spark.conf.set(idle, "false")
    try:
        q = (dedupe_stream(uploads, hold).writeStream.outputMode("append").option("checkpointLocation", ckpt)
             .foreachBatch(dedupe_sink(out_path, records)).trigger(availableNow=True).start())
    finally:
        spark.conf.set(idle, before)
    q.awaitTermination()
    done = [p for p in q.recentProgress if p["stateOperators"]]
    return done[-1]["stateOperators"][0]["numRowsTotal"] if done else 0


def stage(df: DataFrame, path: str, files: int | None = None) -> str:
    """Write derived rows as the files a stream will pick up."""
    (df.repartition(files) if files else df).write.mode("overwrite").parquet(path)
    return path


def stream_dedupe(spark: SparkSession, sf_dir: str, files: int = 4) -> DataFrame:
    uploads = M.load_uploads(spark, sf_dir)
    work = work_folder(spark, "dedupe")
    src_path = stage(uploads, f"{work}/src", files)
    src = spark.readStream.schema(uploads.schema).option("maxFilesPerTrigger", 1).parquet(src_path)
    run_dedupe(src, M.load_records(spark, sf_dir, with_attributes=False), f"{work}/out", f"{work}/ckpt")
    return spark.read.parquet(f"{work}/out").drop("batch_id")


def ingest_batch(payloads: DataFrame, base_records: DataFrame, record_groups: DataFrame,
                 processors: DataFrame) -> DataFrame:
    """T1's per-batch work (also the batch form): E1 -> E3 -> C2 -> R1.

    Flat records meet their groups first, for the processor's short id, and
    then their payloads' texts; the wide attributes are made after that and go
    through no exchange."""
    flat = SC.own_processor(SC.own_processor(base_records, record_groups, "_cleaner"), record_groups, "_reconciler")
    rec = E.extract_records(flat, payloads)
    cleaned = CL.clean_by_functions(SC.processor_column(rec, CL.processor_functions(processors), "fns", "_cleaner"))
    return SC.reconcile_by_schema(SC.processor_column(cleaned.drop("audit_before", "audit_after"), SC.schemas(processors), "schema", "_reconciler"),
                                  mode="ingest")


def stream_ingest(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """Payload files -> extract -> clean -> reconcile -> append.

    Reads the stored payload files as they are; with ``files`` the
    payloads are first re-staged into that many files, fed one per
    micro-batch (tests)."""
    payloads = M.load_payloads(spark, sf_dir)
    work = work_folder(spark, "ingest")
    if files:
        src_path = stage(payloads, f"{work}/src", files)
        r = spark.readStream.schema(payloads.schema).option("maxFilesPerTrigger", 1)
    else:
        src_path = M.payloads_path(spark, sf_dir)
        r = spark.readStream.schema(payloads.schema)
    src = r.parquet(src_path)
    base = M.load_records(spark, sf_dir, with_attributes=False).select("record_id", "record_group_id", "name",
                                                                       "filename", "status")
    groups = M.load_record_groups(spark, sf_dir)
    procs = M.load_processors(spark, sf_dir)
    out_path = f"{work}/out"
    tasks = M.tasks_for(spark, src_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
            batch = batch.repartition(tasks, "record_id")   # texts of a task stay in memory where they meet their records
        # stream-static: only this batch's records meet the static tables
        ids = batch.select("record_id")
        recs = base.join(ids, "record_id", "left_semi")
        done = ingest_batch(batch, recs, groups, procs)
        (done.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
             .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))

    q = (src.writeStream.option("checkpointLocation", f"{work}/ckpt").foreachBatch(write)
            .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path).drop("batch_id")
