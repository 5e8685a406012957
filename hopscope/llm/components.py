"""Connected components by joins, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hopscope.sources.staging import stage

MOST_ROUNDS = 60


def free(table: DataFrame) -> None:
    """Remove a staged table that nothing reads any more."""
    spark = table.sparkSession
    for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of all vertices of ``edges`` (a, b); the component is its least vertex.

    Each round a label takes the least label around it and then the label of
    its label, so the rounds grow with the logarithm of the longest path. Every
    round is written to the shared folder, and the tables of the round before it
    are removed. Only whether anything changed reaches the driver.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = stage(
        both.groupBy("a").agg(F.min("b").alias("near")).select(F.col("a").alias("vertex"), F.least("a", "near").alias("component")),
        "labels",
    )
    for _ in range(MOST_ROUNDS):
        near = (
            both.join(labels.select(F.col("vertex").alias("b"), F.col("component").alias("c")), "b")
            .groupBy("a")
            .agg(F.min("c").alias("c"))
        )
        lower = labels.join(near.withColumnRenamed("a", "vertex"), "vertex").select(
            "vertex", F.col("component").alias("was"), F.least("component", "c").alias("now")
        )
        lower, before = stage(lower, "lower"), labels
        # The label of the label; a label is a vertex itself.
        jumped = lower.join(lower.select(F.col("vertex").alias("now"), F.col("now").alias("then")), "now").select(
            "vertex", "was", F.col("then").alias("component")
        )
        jumped = stage(jumped, "jumped")
        labels = jumped.select("vertex", "component")
        free(before)
        free(lower)
        if jumped.filter(F.col("was") != F.col("component")).isEmpty():
            free(both)
            return labels
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
