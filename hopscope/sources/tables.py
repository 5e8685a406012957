"""Reading receipts, transactions and events; writing episodes and traces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import tx_value_text
from ..operators.receipts import ROLES, canonical_receipts
from .columns import match_column, project_tolerant, union_promoting
from .files import file_columns, list_parquet, path_exists, read_folder
from .staging import stage

# The column names of the stored tables.
TX_COLUMNS = {
    "block_timestamp": "timestamp",
    "transaction_hash": "string",
    "from_address": "string",
    "to_address": "string",
    "value": "string",
    "input": "string",
    "block_number": "bigint",
    "transaction_index": "bigint",
}
EVENT_COLUMNS = (
    "block_timestamp", "transaction_hash", "tx_hash", "log_index", "event_index", "log_idx", "address",
    "contract_address", "event_hash", "event_signature", "topics", "args", "args_json", "data",
)


def read_receipts(
    spark: SparkSession,
    root: str,
    limit_files: int | None = None,
    limit_rows: int | None = None,
    **overrides,
) -> DataFrame:
    """All receipt files below ``root`` with ``_file``, ``_idx`` and the roles.

    Files are grouped by schema first (footers only, read by the executors), so
    that every file has its columns detected on its own names; the groups are
    then united by name. A group is read by the widest folders that hold no
    file of another schema, so one schema below ``root`` is one path, however
    many files there are. Files that only Spark can open are one group, with
    the columns that any of them has. ``limit_files`` takes the first files in
    path order, ``limit_rows`` the first rows of each file. ``overrides`` go to
    ``canonical_receipts``.
    """
    files = list_parquet(spark, [root]).select(F.lit("receipts").alias("chain"), "path")
    if limit_files is not None:
        files = files.orderBy("path").limit(limit_files)
    units = receipt_units(files, whole_folders=limit_files is None)
    groups: dict[str, list[str]] = {}
    for row in units.orderBy("layout", "unit").toLocalIterator():
        groups.setdefault(row.layout, []).append(row.unit)
    if not groups:
        raise FileNotFoundError(f"no receipt files under {root}")

    def part(layout: str, paths: Sequence[str]) -> DataFrame:
        reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        df = reader.option("mergeSchema", str(layout == _UNOPENED).lower()).parquet(*paths)
        numbered = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_idx"))
        if limit_rows is not None:
            numbered = numbered.filter(F.col("_idx") < limit_rows)
        ids = numbered.select("_file", "_idx", *[F.col(f"`{c}`") for c in df.columns])
        return canonical_receipts(ids, **overrides)

    in_order = sorted(groups.items(), key=lambda group: group[1][0])
    return union_promoting([part(layout, paths) for layout, paths in in_order])


_UNOPENED = ""


def receipt_units(files: DataFrame, whole_folders: bool = True) -> DataFrame:
    """``(layout, unit)``: what to read for each schema, from ``(chain, path)``.

    A unit is the widest folder whose files all have that schema, or, below no
    such folder, a file. With ``whole_folders=False`` the files are part of what
    their folders hold, so every unit is a file.
    """
    columns = F.to_json(F.array_sort(F.collect_list(F.struct("pos", "name", "type"))))
    layout = F.when(F.max("error").isNull(), F.sha2(columns, 256)).otherwise(F.lit(_UNOPENED))
    per_file = stage(file_columns(files).groupBy("path").agg(layout.alias("layout")), "layouts")
    if not whole_folders:
        return per_file.select("layout", F.col("path").alias("unit"))
    parts = F.split("path", "/")
    depths = F.sequence(F.lit(1), F.size(parts) - 1)
    folders = per_file.select("path", "layout", F.explode(depths).alias("depth")).withColumn(
        "folder", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/")
    )
    # A folder above all files is above the root as well: the root's own depth is the least to use.
    kinds = folders.groupBy("folder", "depth").agg(F.min("layout").alias("a"), F.max("layout").alias("b"), F.count("*").alias("n"))
    total = per_file.count()
    root_depth = kinds.filter(F.col("n") == total).agg(F.max("depth")).first()[0] if total else 0
    pure = kinds.filter((F.col("a") == F.col("b")) & (F.col("depth") >= root_depth)).select("folder", F.lit(True).alias("pure"))
    widest = folders.join(pure, "folder").groupBy("path").agg(F.min(F.struct("depth", "folder"))["folder"].alias("folder"))
    return per_file.join(widest, "path", "left").select("layout", F.coalesce("folder", "path").alias("unit")).distinct()


def _chain_tables(spark: SparkSession, root: str, chains: Sequence[str], target: str, strict: bool):
    for chain in chains:
        folder = f"{root.rstrip('/')}/{chain}/{target}"
        if path_exists(spark, folder):
            yield chain, read_folder(spark, folder, merge_schema=True)
        elif strict:
            raise FileNotFoundError(f"no {target} folder: {folder}")


def read_transactions(spark: SparkSession, root: str, chains: Sequence[str], strict: bool = False) -> DataFrame:
    """``<root>/<chain>/transactions`` of every chain, with a ``chain`` column.

    Wanted columns a chain lacks are NULL. A chain without a folder gives no
    rows, or raises with ``strict``. The native value is turned into text chain
    by chain, while its stored type is known: numbers lose their fraction.
    """
    tables = _chain_tables(spark, root, chains, "transactions", strict)
    return unite_transactions(spark, [(chain, df) for chain, df in tables])


def unite_transactions(spark: SparkSession, tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """One table of the stored transactions of several chains."""
    frames = []
    for chain, df in tables:
        stored_time = dict(df.dtypes).get("block_timestamp", "timestamp")
        found = match_column(df.columns, ["value"])
        kind = None if found is None else df.schema[found].dataType
        if isinstance(kind, T.NumericType) and not isinstance(kind, T.IntegralType):
            df = df.withColumn(found, tx_value_text(F.col(f"`{found}`"), kind))
        shaped = project_tolerant(df, {**TX_COLUMNS, "block_timestamp": stored_time})
        frames.append(shaped.select(F.lit(chain).alias("chain"), "*"))
    if not frames:
        return project_tolerant(spark.createDataFrame([], "chain string"), {"chain": "string", **TX_COLUMNS})
    return union_promoting(frames)


def read_decoded_events(spark: SparkSession, root: str, chains: Sequence[str]) -> DataFrame | None:
    """``<root>/<chain>/decoded_events``; None when no chain has any."""
    return unite_events(list(_chain_tables(spark, root, chains, "decoded_events", strict=False)))


def unite_events(tables: Sequence[tuple[str, DataFrame]]) -> DataFrame | None:
    """One table of the stored events of several chains, None for none."""
    frames = [
        df.select(F.lit(chain).alias("chain"), *[F.col(c) for c in df.columns if c.lower() in EVENT_COLUMNS])
        for chain, df in tables
    ]
    return union_promoting(frames) if frames else None


def touched_chains(receipts: DataFrame) -> list[str]:
    """Distinct destination and source chains; a handful of names."""
    both = receipts.select(F.explode(F.array("_chain", "_src_chain")).alias("chain"))
    return sorted(r.chain for r in both.filter(F.col("chain").isNotNull()).distinct().collect())


def write_episodes(
    episodes: DataFrame, path: str, partition_by: Sequence[str] = ("chain", "date"), mode: str = "error"
) -> None:
    """Snappy parquet, partitioned by destination chain and arrival date.

    The rebalance hint gathers a partition's rows before the write, so a task
    does not open one file per partition, and splits partitions that are large.
    """
    own = {c.lower() for c in episodes.columns}
    derived = {"chain": F.col("_chain"), "date": F.to_date("_ts")}
    added = {c: derived[c] for c in partition_by if c not in own and c in derived}
    out = episodes.withColumns(added) if added else episodes
    out = out.drop(*ROLES)
    if partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = out.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_episodes(spark: SparkSession, path: str, columns: Sequence[str] = ("EPISODE_ACTIONS_JSON",)) -> DataFrame:
    """Chosen columns of stored episodes with ``episode_file`` and ``episode_row``."""
    df = spark.read.parquet(path)
    found = [c for c in columns if c in df.columns]
    return df.select(
        F.col("_metadata.file_path").alias("episode_file"), F.col("_metadata.row_index").alias("episode_row"), *found
    )


def write_action_trace(trace: DataFrame, path: str, mode: str = "append") -> None:
    trace.write.mode(mode).option("compression", "snappy").parquet(path)
