"""Stream queries (T1-T3); each runs its stream to completion and
returns the sink table.  Oracles are the batch results in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import streams as ST
from .oracle_base import with_model
from .q_schema import RECON_INGEST_SQL
from .registry import query


@query("stream_activity", with_model("""
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, action, count(*) AS n FROM history GROUP BY ALL
""", "history").replace("SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start",
                        "SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start"),
       ops=("T3", "H3"))
def q_stream_activity(spark, sf):
    out = ST.stream_activity(spark, sf, glob="events.parquet")
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "action", "n")


@query("stream_dedupe", with_model("""
SELECT DISTINCT u.record_group_id, split_part(u.upload_name, '.', 1) AS base_name FROM uploads u
WHERE NOT EXISTS (SELECT 1 FROM recs r WHERE r.record_group_id = u.record_group_id
                  AND split_part(r.filename, '.', 1) = split_part(u.upload_name, '.', 1))
""", "uploads"), ops=("T2", "J10"))
def q_stream_dedupe(spark, sf):
    return ST.stream_dedupe(spark, sf)


@query("stream_ingest", "SELECT record_id, n_attrs, key_seq FROM (" + RECON_INGEST_SQL + """
) t WHERE record_id % 97 <> 0 AND record_id IN (SELECT l_orderkey FROM lineitem)
""", ops=("T1", "E1", "C2", "R1"))
def q_stream_ingest(spark, sf):
    out = ST.stream_ingest(spark, sf)
    return out.where(F.col("status") == "digitized").select(
        "record_id", F.size("attributes").cast("bigint").alias("n_attrs"),
        F.array_join(F.col("attributes").getField("key"), "|").alias("key_seq"))
