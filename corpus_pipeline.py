"""The corpus pipeline: documents through five stages, each written as Parquet
in the shared folder and read again by the next.

1. quality: documents that the quality classifier rejects go.
2. language: documents whose language stays undecided go.
3. near_duplicates: of each class of near duplicates one document stays.
4. mixing: documents are sampled to the raked target weights.
5. tokens: every document left, as token ids.

Null columns, empty texts, repeated rows, empty tables and extra columns are
handled by each stage's operator (see its module); extra columns pass through
all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm.bpe_lexicon import stage_bpe
from palimpsest.llm.common import stage
from palimpsest.llm.langid import stage_langid
from palimpsest.llm.mixing import stage_mixing
from palimpsest.llm.neardup import stage_neardup
from palimpsest.llm.quality_gbt import stage_quality

STAGES = [
    ("quality", stage_quality),
    ("language", stage_langid),
    ("near_duplicates", stage_neardup),
    ("mixing", stage_mixing),
    ("tokens", stage_bpe),
]

#: boosted trees, MinHash registers and BPE merges aren't SQL; tests/llm checks the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
