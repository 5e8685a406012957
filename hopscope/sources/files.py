"""File listings and footers as DataFrames.

Listings come from Spark's own file index (contents are not read); footers are
opened by the executors, one task per slice of the listing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

FOOTER_SCHEMA = "chain string, path string, pos int, name string, type string, error string"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_folder(spark: SparkSession, folder: str, merge_schema: bool = False) -> DataFrame:
    """All parquet files below a folder.

    ``key=value`` folders become partition columns, so that a filter on them
    skips whole folders; plain subfolders are walked.
    """
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    children = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)
    partitioned = any(c.isDirectory() and "=" in c.getPath().getName() for c in children)
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if not partitioned:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.parquet(folder)


def list_parquet(spark: SparkSession, roots: Sequence[str], recursive: bool = True) -> DataFrame:
    """``(path, length)`` of every ``*.parquet`` file under the roots."""
    roots = [r for r in roots if path_exists(spark, r)]
    if not roots:
        return spark.createDataFrame([], "path string, length bigint")
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", str(recursive).lower())
        .load(roots)
        .select("path", "length")
    )


def chain_files(
    spark: SparkSession, root: str, chains: Sequence[str], target: str, max_files: int = 0, recursive: bool = True
) -> DataFrame:
    """``(chain, path)`` of ``<root>/<chain>/<target>/*.parquet``, the first
    ``max_files`` per chain in path order (0 = all)."""
    listed = list_parquet(spark, [f"{root.rstrip('/')}/{c}/{target}" for c in chains], recursive)
    chain = F.regexp_extract("path", f"/([^/]+)/{target}/", 1)
    files = listed.select(chain.alias("chain"), "path")
    if max_files <= 0:
        return files
    rank = F.row_number().over(Window.partitionBy("chain").orderBy("path"))
    return files.withColumn("_n", rank).filter(F.col("_n") <= max_files).drop("_n")


def open_uri(path: str):
    """Open a Hadoop-style path with Arrow; runs inside tasks."""
    from pyarrow import fs

    uri = path.replace("s3a://", "s3://", 1)
    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + uri[len("file:"):].lstrip("/"))
    if "://" not in uri:
        return fs.LocalFileSystem().open_input_file(uri)
    system, inner = fs.FileSystem.from_uri(uri)
    return system.open_input_file(inner)


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    for batch in batches:
        rows = []
        for chain, path in zip(batch["chain"], batch["path"]):
            try:
                with open_uri(path) as source:
                    schema = pq.read_schema(source)
                rows += [(chain, path, i, f.name, str(f.type), None) for i, f in enumerate(schema)]
                if not len(schema):
                    rows.append((chain, path, None, None, None, None))
            except Exception as problem:
                rows.append((chain, path, None, None, None, str(problem)))
        yield pd.DataFrame(rows, columns=["chain", "path", "pos", "name", "type", "error"]).astype(
            {"pos": "Int32"}
        )


def file_columns(files: DataFrame) -> DataFrame:
    """One row per file and column, from the footers of ``(chain, path)``.

    A file that cannot be read gives one row with ``error`` set.
    """
    return files.select("chain", "path").mapInPandas(_read_footers, FOOTER_SCHEMA)
