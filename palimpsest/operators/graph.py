"""Connected components of a link table, by shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_folder


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest
    node of its component.  Each round links all neighbours of a node, and the
    node, to the smallest of them, which also shortens paths: rounds grow with
    the logarithm of the longest path.  Rounds are written to the shared
    folder, so lineage stays short and lost executors cost one round."""
    spark = links.sparkSession
    work = work_folder(spark, "components")

    def written(df, name):
        df.write.parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    edges = written(links.select("a", "b").where("not (a <=> b)").distinct(), "0")
    done, n = edges.isEmpty(), 0
    while not done:
        n += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        up = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        least = up.groupBy("a").agg(F.min("b").alias("low"))
        star = up.join(least, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("low").alias("b")),
                                                            F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        new = written(star.select("e.a", "e.b").where("a <> b").distinct(), str(n))
        state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        done, edges = state(new) == state(edges), new
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
