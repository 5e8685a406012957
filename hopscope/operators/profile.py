"""Schema drift over many files. All functions take ``file_columns`` rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..sources.staging import stage


def _per_file(files: DataFrame) -> DataFrame:
    """One row per file with its ordered column list, NULL if unreadable."""
    pairs = F.array_sort(F.collect_list(F.when(F.col("name").isNotNull(), F.struct("pos", "name"))))
    return files.groupBy("chain", "path").agg(
        F.transform(pairs, lambda x: x["name"]).alias("columns"), F.max("error").alias("error")
    )


def schema_column_presence(files: DataFrame) -> DataFrame:
    """``(chain, name, present_in_files, present_ratio)``; unreadable files
    count in the denominator. The footers are read once."""
    files = stage(files, "footers")
    totals = files.groupBy("chain").agg(F.countDistinct("path").alias("_files"))
    return (
        files.filter(F.col("name").isNotNull())
        .groupBy("chain", "name")
        .agg(F.countDistinct("path").alias("present_in_files"))
        .join(totals, "chain")
        .select("chain", "name", "present_in_files", (F.col("present_in_files") / F.col("_files")).alias("present_ratio"))
        .orderBy("chain", F.desc("present_in_files"), "name")
    )


def schema_groups(files: DataFrame, top: int = 5, shown: int = 25) -> DataFrame:
    """Files grouped by ordered column list: the biggest groups per chain."""
    grouped = (
        _per_file(files)
        .filter(F.col("error").isNull())
        .groupBy("chain", "columns")
        .agg(F.count("*").alias("count"), F.min("path").alias("example_file"))
    )
    order = Window.partitionBy("chain").orderBy(F.desc("count"), "example_file")
    return (
        grouped.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select(
            "chain", "rank", "count", "example_file", F.size("columns").alias("num_cols"),
            F.slice("columns", 1, shown).alias(f"first_{shown}_cols"),
        )
    )


def schema_global_union(files: DataFrame) -> DataFrame:
    """Every column name with the number of files of all chains that have it."""
    return (
        files.filter(F.col("name").isNotNull())
        .groupBy("name")
        .agg(F.countDistinct("chain", "path").alias("chains_present"))
        .orderBy(F.desc("chains_present"), "name")
    )


def schema_summary(files: DataFrame, chains: Sequence[str]) -> DataFrame:
    """One row per asked-for chain; a chain without files has ``error`` set. The footers are read once."""
    spark = files.sparkSession
    files = stage(files, "footers")
    asked = spark.createDataFrame([(c,) for c in chains], "chain string")
    schemas = (
        _per_file(files)
        .groupBy("chain")
        .agg(
            F.count("*").alias("files_inspected"),
            F.countDistinct(F.when(F.col("error").isNull(), F.col("columns"))).alias("unique_schemas"),
        )
    )
    names = files.groupBy("chain").agg(F.countDistinct("name").alias("num_columns"))
    none = F.when(F.col("files_inspected").isNull(), F.lit("no parquet files"))
    return asked.join(schemas.join(names, "chain"), "chain", "left").select(
        "chain", "files_inspected", "unique_schemas", "num_columns", none.alias("error")
    )
