"""Stream forms fed in several files equal the batch forms."""

import tempfile

from pyspark.sql import functions as F

from palimpsest.sources import model as M
from palimpsest.streaming import streams as ST


def test_activity_stream_in_splits_equals_batch(spark, sf):
    d = tempfile.mkdtemp(prefix="pal-ev-")
    ev = M.table(spark, sf, "events")
    # random split into 5 files fed one per trigger, out of event-time order
    ev.repartition(5).write.mode("overwrite").parquet(f"{d}/src")
    got = ST.stream_activity(spark, f"{d}/src", glob="part-*", max_files=1)
    h = M.history_from(ev)
    want = h.groupBy(F.window(F.col("ts").cast("timestamp"), "1 day").start.alias("window_start"), "action") \
        .agg(F.count(F.lit(1)).alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_dedupe_stream_equals_batch(spark, sf):
    from palimpsest.operators import uploads as U
    got = ST.stream_dedupe(spark, sf, files=3)
    recs = M.load_records(spark, sf, with_attributes=False)
    up = M.load_uploads(spark, sf)
    cand = up.select("record_group_id", F.substring_index("upload_name", ".", 1).alias("base_name")).distinct()
    want = cand.join(U.existing_bases(up, recs), ["record_group_id", "base_name"], "left_anti")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_ingest_stream_equals_batch(spark, sf):
    got = ST.stream_ingest(spark, sf, files=3)
    base = M.load_records(spark, sf, with_attributes=False).select("record_id", "record_group_id", "name",
                                                                  "filename", "status")
    batch = ST.ingest_batch(M.load_payloads(spark, sf), base.join(M.load_payloads(spark, sf).select("record_id"),
                                                                  "record_id", "left_semi"),
                            M.load_record_groups(spark, sf), M.load_processors(spark, sf))
    key = lambda df: sorted((r["record_id"], r["status"], tuple(a["key"] for a in r["attributes"]))
                            for r in df.collect())
    assert key(got) == key(batch)



def test_dedupe_state_is_bounded_and_later_copies_are_known(spark):
    """Two runs of one stream with a short hold: the second finds the first's
    keys gone from the state, and its repeated uploads in the table."""
    import time

    from palimpsest.session import work_folder

    work = work_folder(spark, "dedupe-test")
    records = spark.createDataFrame([("g", "old.pdf")], "record_group_id string, filename string")
    schema = "record_group_id string, upload_name string"
    states = []
    for names in (["a.pdf", "a.png", "b.tif", "old.png"], ["a.pdf", "c.pdf", "old.x"], ["b.tif", "c.png"]):
        spark.createDataFrame([("g", x) for x in names], schema).coalesce(1).write.mode("append").parquet(f"{work}/src")
        src = spark.readStream.schema(schema).parquet(f"{work}/src")
        states.append(ST.run_dedupe(src, records, f"{work}/out", f"{work}/ckpt", hold=1000))
        time.sleep(2)
    got = sorted((r.base_name, r.batch_id) for r in spark.read.parquet(f"{work}/out").collect())
    assert [b for b, _ in got] == ["a", "b", "c"]
    assert states[0] == 3 and max(states) <= 4 and states[-1] <= 3
