"""Per-file time index: which files can hold rows of a time range."""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import to_utc_ts, ts_iso
from .files import list_parquet, open_uri, path_exists, read_folder
from .staging import stage

TIMESTAMP_COL = "block_timestamp"
TARGETS = ("transactions", "decoded_events", "logs")
UNREADABLE = "unreadable"
_NAMED = 20  # file names in a warning
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of rows without a partition value
RAW_SCHEMA = "lo string, hi string, method string, error string"


def _bounds_from_footer(parquet, column: str):
    """Smallest and largest value from row-group statistics.

    None if a row group with rows has no statistics: what it holds is unknown.
    The leaf is found by its path, since leaves behind nested fields are not
    numbered like fields.
    """
    if parquet.schema_arrow.get_field_index(column) < 0:
        raise ValueError(f"no column {column}")
    low = high = None
    for i in range(parquet.metadata.num_row_groups):
        group = parquet.metadata.row_group(i)
        leaf = next(c for c in map(group.column, range(group.num_columns)) if c.path_in_schema == column)
        stats = leaf.statistics
        if stats is not None and stats.has_null_count and stats.null_count == group.num_rows:
            continue
        if stats is None or not stats.has_min_max:
            if group.num_rows:
                return None
            continue
        low = stats.min if low is None else min(low, stats.min)
        high = stats.max if high is None else max(high, stats.max)
    return None if low is None else (low, high)


def _bounds_from_column(parquet, column: str):
    """The same from the column itself, one batch in memory at a time."""
    import pyarrow.compute as pc

    lo = hi = None
    for batch in parquet.iter_batches(columns=[column]):
        found = pc.min_max(batch.column(0)).as_py()
        if found["min"] is not None:
            lo = found["min"] if lo is None else min(lo, found["min"])
            hi = found["max"] if hi is None else max(hi, found["max"])
    if lo is None:
        raise ValueError("no timestamps in file")
    return lo, hi


def _not_parquet(source) -> bool:
    """Whether the end of an open file shows that it is no parquet. Failing to open or read a file shows nothing."""
    size = source.size()
    source.seek(max(size - 4, 0))
    end = source.read(4)
    source.seek(0)
    return size < 12 or end not in (b"PAR1", b"PARE")


def _indexer(column: str, carried: Sequence[str]):
    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for path in batch["path"]:
                foreign = False
                try:
                    with open_uri(path) as source:
                        foreign = _not_parquet(source)
                        parquet = pq.ParquetFile(source)
                        bounds, method = _bounds_from_footer(parquet, column), "metadata"
                        if bounds is None:
                            bounds, method = _bounds_from_column(parquet, column), "read_column"
                    rows.append((str(bounds[0]), str(bounds[1]), method, None))
                except Exception as problem:
                    rows.append((None, None, None, f"{UNREADABLE}: {problem}" if foreign else str(problem)))
            found = pd.DataFrame(rows, columns=["lo", "hi", "method", "error"], index=batch.index)
            yield pd.concat([batch[list(carried)], found], axis=1)

    return index


def index_files(files: DataFrame, ts_col: str = TIMESTAMP_COL) -> DataFrame:
    """``files`` needs a ``path`` column; its other columns are kept.

    Footers are opened on the executors; the column itself is read only for
    files without statistics. Adds ``file, timestamp_col, min_ts, max_ts,
    method, error``.
    """
    names = [f"`{c}`" for c in files.columns]
    schema = ", ".join([*(f"{n} {t}" for n, (_, t) in zip(names, files.dtypes)), RAW_SCHEMA])
    raw = files.mapInPandas(_indexer(ts_col, files.columns), schema)
    lo, hi = (ts_iso(to_utc_ts(F.col(c), T.StringType())) for c in ("lo", "hi"))
    unreadable = F.when(F.col("error").isNull() & (lo.isNull() | hi.isNull()), F.lit("timestamp parse failed"))
    return raw.select(
        F.col("path").alias("file"),
        *[F.col(f"`{c}`") for c in files.columns if c != "path"],
        F.lit(ts_col).alias("timestamp_col"),
        lo.alias("min_ts"),
        hi.alias("max_ts"),
        "method",
        F.coalesce("error", unreadable).alias("error"),
    )


def listed_files(spark: SparkSession, folder: str, chain: str, dataset: str) -> DataFrame:
    """``path, rel_file, chain, dataset`` of the files below one folder.

    Chain and dataset are those of the folder asked for, whatever words the
    path holds besides.
    """
    listed = list_parquet(spark, [folder])
    inside = F.substring_index("path", f"/{chain}/{dataset}/", -1)
    return listed.select(
        "path",
        F.concat(F.lit(f"{chain}/{dataset}/"), inside).alias("rel_file"),
        F.lit(chain).alias("chain"),
        F.lit(dataset).alias("dataset"),
    )


def build_time_index(
    spark: SparkSession,
    base_dir: str,
    chains: Sequence[str],
    targets: Sequence[str] = TARGETS,
    ts_col: str = TIMESTAMP_COL,
) -> DataFrame:
    """Index rows and error rows of every ``<base>/<chain>/<target>`` there is.

    Rows: ``file, rel_file, chain, dataset, timestamp_col, min_ts, max_ts,
    method, error``; ``error`` is NULL for an indexed file.
    """
    base = base_dir.rstrip("/")
    parts = [listed_files(spark, f"{base}/{c}/{t}", c, t) for c in chains for t in targets]
    files = parts[0]
    for part in parts[1:]:
        files = files.unionByName(part)
    return index_files(files, ts_col)


def indexed_files(index: DataFrame) -> DataFrame:
    """Good rows in index order."""
    return index.filter(F.col("error").isNull()).drop("error").orderBy("min_ts", "max_ts", "file")


def index_errors(index: DataFrame) -> DataFrame:
    return index.filter(F.col("error").isNotNull()).select("file", "rel_file", "chain", "dataset", "error")


def time_index_summary(index: DataFrame) -> DataFrame:
    """Files, indexed files and errors per chain and dataset."""
    return index.groupBy("chain", "dataset").agg(
        F.count("*").alias("n_files"),
        F.count_if(F.col("error").isNull()).alias("n_indexed"),
        F.count_if(F.col("error").isNotNull()).alias("n_errors"),
    )


def select_files(index: DataFrame, start: Column, end: Column) -> DataFrame:
    """Index rows whose ``[min_ts, max_ts]`` overlaps ``[start, end)``."""
    lo, hi = (to_utc_ts(F.col(c), T.StringType()) for c in ("min_ts", "max_ts"))
    return index.filter((hi >= start) & (lo < end))


def write_time_index(index: DataFrame, path: str) -> None:
    index.write.mode("overwrite").parquet(path)


def write_time_index_json(index: DataFrame, base_dir: str, path: str) -> None:
    """One ``<chain>_<dataset>_time_index.json`` in ``path`` for each chain and dataset.

    A summary names all files of its dataset in one document, which is the
    format; ``write_time_index`` has no such bound.
    """
    spark = index.sparkSession
    entry = F.struct("min_ts", "max_ts", F.regexp_replace("file", "^file:/+", "/").alias("file"), "rel_file", "timestamp_col", "method", "error")
    parts = index.groupBy("chain", "dataset").agg(F.array_sort(F.collect_list(entry)).alias("all"), F.max("timestamp_col").alias("timestamp_col"))
    good, bad = (F.filter("all", lambda x: test(x["error"])) for test in (F.isnull, F.isnotnull))

    def listed(entries: Column, names: Sequence[str]) -> Column:
        own = {n: F.col(n) for n in ("chain", "dataset")}
        return F.transform(entries, lambda x: F.struct(*(own.get(n, x[n]).alias(n) for n in names)))

    document = F.struct(
        F.lit(base_dir).alias("base_dir"), "chain", "dataset", "timestamp_col",
        F.size("all").alias("n_files"), F.size(good).alias("n_indexed"), F.size(bad).alias("n_errors"),
        listed(good, [part.split()[0] for part in _GOOD.split(", ")]).alias("files"),
        listed(bad, [part.split()[0] for part in _BAD.split(", ")]).alias("errors"),
    )
    name = F.concat_ws("_", "chain", "dataset", F.lit("time_index"))
    parts.select(name.alias("name"), F.to_json(document).alias("value")).write.mode("overwrite").partitionBy("name").text(path)
    # Each name has one document, so one part file; give it the name that readers look for.
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in system.listStatus(top):
        own = folder.getPath()
        if folder.isDirectory() and own.getName().startswith("name="):
            part = next(f.getPath() for f in system.listStatus(own) if f.getPath().getName().startswith("part-"))
            named = own.getName().removeprefix("name=")
            system.rename(part, spark._jvm.org.apache.hadoop.fs.Path(top, f"{named}.json"))
            system.delete(own, True)


_GOOD = (
    "file string, rel_file string, chain string, dataset string, timestamp_col string, "
    "min_ts string, max_ts string, method string"
)
_BAD = "file string, rel_file string, chain string, dataset string, error string"


def read_time_index(spark: SparkSession, path: str) -> DataFrame | None:
    """Index from a parquet folder, a ``*_time_index.json`` summary or a folder of those.

    A missing index is None; one that is there but can't be read raises.
    """
    if not path_exists(spark, path):
        return None
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [str(f.getPath()) for f in system.listStatus(hadoop_path)]
    summaries = sorted(n for n in names if n.endswith("_time_index.json"))
    if not summaries:
        return spark.read.parquet(path)
    shape = f"files array<struct<{_fields(_GOOD)}>>, errors array<struct<{_fields(_BAD)}>>"
    summary = spark.read.schema(shape).option("multiLine", "true").option("mode", "FAILFAST").json(summaries)
    rows, errors = summary.select(F.inline("files")), summary.select(F.inline("errors"))
    return rows.unionByName(errors, allowMissingColumns=True)


def _fields(ddl: str) -> str:
    return ", ".join(":".join(part.split()) for part in ddl.split(","))


def file_keys(spark: SparkSession, files: DataFrame, root: str) -> DataFrame:
    """``files`` (``file`` and, where known, ``rel_file``) with ``key``, the one name of a file on this lake.

    The key is the path as the file system of ``root`` spells it, with scheme
    and authority. An index may name its files by plain paths, by ``file:///``
    addresses, relative to where it was built, or below another mount of the
    same lake; those that aren't below ``root`` are known by ``rel_file``.
    """
    base, prefix = _qualified(spark, root)
    file = F.col("file")
    spelt = F.when(
        file.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.regexp_replace(file, "^([A-Za-z][A-Za-z0-9+.-]*):/{3,}", "$1:/")
    ).when(F.startswith(file, F.lit("/")), F.concat(F.lit(prefix), file))
    spelt = F.regexp_replace(spelt, r"(?<![:/])/(\./|/)+", "/")
    key = F.when(F.startswith(spelt, F.lit(f"{base}/")), spelt)
    if "rel_file" in files.columns:
        relative = F.regexp_replace(F.regexp_replace("rel_file", r"/(\./|/)+", "/"), r"^(\./|/)+", "")
        key = F.coalesce(key, F.concat(F.lit(f"{base}/"), relative))
    return files.withColumn("key", F.coalesce(key, spelt, "file"))


def _qualified(spark: SparkSession, root: str) -> tuple[str, str]:
    """(the root as its file system spells it, what that puts before a plain path)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path)
    text = whole.toString().rstrip("/")
    return text, text.removesuffix(whole.toUri().getPath().rstrip("/"))


def choose_files(
    spark: SparkSession,
    index: DataFrame | None,
    root: str,
    target: str,
    chains: Sequence[str],
    days: DataFrame,
    strict: bool = False,
) -> tuple[DataFrame | None, list[str]]:
    """Stored files that can hold rows of the ``days`` (``chain, lo, hi``), and the chains they are chosen for.

    The files are ``(chain, key)``, in one plan over all chains. Listed is what
    the lake holds now: a file is chosen if the index has it in a day's range
    or as an error. A file the index does not have is indexed on the way; one
    of them whose bytes are no parquet is left out with a warning, one that
    could not be opened is chosen, since Spark may. Chains without any index
    row are not chosen for; with ``strict`` they raise, as does a chain without
    a file in the range.
    """
    base = root.rstrip("/")
    if index is None:
        known = []
    else:
        index = index.filter((F.col("dataset") == target) & F.col("chain").isin(list(chains)))
        known = sorted(r.chain for r in index.select("chain").distinct().collect())
    lost = sorted(set(chains) - set(known))
    if strict and lost:
        raise FileNotFoundError(f"no time index for {', '.join(f'{c}/{target}' for c in lost)}")
    if not known:
        return None, []
    if "error" not in index.columns:
        index = index.withColumn("error", F.lit(None).cast("string"))
    lo, hi = (to_utc_ts(F.col(c), T.StringType()) for c in ("min_ts", "max_ts"))

    def spans(rows: DataFrame) -> DataFrame:
        """One row for each file, however often an index lists it."""
        return rows.groupBy("chain", "key").agg(
            F.min(lo).alias("from"), F.max(hi).alias("to"), F.max(F.col("error").isNotNull() | lo.isNull() | hi.isNull()).alias("bad")
        )

    listed = listed_files(spark, f"{base}/{known[0]}/{target}", known[0], target)
    for chain in known[1:]:
        listed = listed.unionByName(listed_files(spark, f"{base}/{chain}/{target}", chain, target))
    listed = file_keys(spark, listed.withColumnRenamed("path", "file"), root)
    indexed = spans(file_keys(spark, index, root))
    found = stage(listed.select("file", "chain", "key").join(indexed, ["chain", "key"], "left"), "listed")
    fresh = index_files(found.filter("bad is null").select(F.col("file").alias("path"), "chain", "key"))
    fresh = stage(fresh.select("chain", "key", "min_ts", "max_ts", "error"), "fresh")
    foreign = fresh.filter(F.startswith("error", F.lit(UNREADABLE)))
    names = [r.key for r in foreign.select("key").orderBy("key").take(_NAMED + 1)]
    if names:
        more = " and more" if len(names) > _NAMED else ""
        warnings.warn(f"not parquet, left out: {', '.join(names[:_NAMED])}{more}", stacklevel=2)
    usable = spans(fresh.join(foreign.select("chain", "key"), ["chain", "key"], "left_anti"))
    files = found.filter("bad is not null").select("chain", "key", "from", "to", "bad").unionByName(usable)
    # A file is met by each day it touches: an equality join, whatever the number of days.
    touched = files.filter(~F.col("bad")).select("chain", "key", "from", "to", F.explode(F.sequence(F.to_date("from"), F.to_date("to"))).alias("day"))
    asked = days.select("chain", F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("day"), "lo", "hi").distinct()
    hits = touched.join(asked, ["chain", "day"]).filter((F.col("to") >= F.col("lo")) & (F.col("from") < F.col("hi")))
    hits = hits.select("chain", "key", F.lit(True).alias("hit"))
    either = stage(hits.unionByName(files.filter("bad").select("chain", "key", F.lit(False).alias("hit"))).distinct(), "chosen")
    if strict:
        met = {r.chain for r in either.filter("hit").select("chain").distinct().collect()}
        if lost := [c for c in known if c not in met]:
            raise FileNotFoundError(f"time index of {', '.join(f'{c}/{target}' for c in lost)} has no file in the range")
    return either.select("chain", "key"), known


def read_chosen(spark: SparkSession, root: str, chain: str, target: str, chosen: DataFrame | None) -> DataFrame:
    """The chosen files of a chain's folder with all columns that any of them has; the whole folder for None.

    In a folder of ``key=value`` folders the chosen files pick values, and the
    scan skips all other folders at run time, so no file names pass through the
    driver. Elsewhere the names of the chosen files are handed to the reader.
    """
    folder = f"{root.rstrip('/')}/{chain}/{target}"
    if chosen is None:
        return read_folder(spark, folder, merge_schema=True)
    base = _qualified(spark, folder)[0]
    mine = chosen.filter(F.col("chain") == chain)
    inside = F.substr(F.col("key"), F.lit(len(base) + 2))
    part = mine.select(F.regexp_extract(inside, "^([^/=]+)=([^/]*)/", 1).alias("name"), F.regexp_extract(inside, "^([^/=]+)=([^/]*)/", 2).alias("value"))
    names = [r.name for r in part.select("name").distinct().take(2)]
    if len(names) == 1 and names[0] and part.filter(F.col("value") == _NO_VALUE).isEmpty():
        rows = read_folder(spark, folder, merge_schema=True)
        by = rows.schema[names[0]]
        values = part.select(F.url_decode(F.replace("value", F.lit("+"), F.lit("%2B"))).cast(by.dataType).alias(by.name)).distinct()
        return rows.join(values, by.name, "left_semi").select(rows.columns)
    files = sorted(r.key for r in mine.select("key").toLocalIterator())
    if not files:
        return read_folder(spark, folder, merge_schema=True).limit(0)
    return spark.read.option("mergeSchema", "true").option("basePath", folder).parquet(*files)


def read_for_range(
    spark: SparkSession,
    index: DataFrame | None,
    root: str,
    chain: str,
    start: Column,
    end: Column,
    target: str = "transactions",
    strict: bool = False,
) -> DataFrame:
    """Read only the files of one chain that can hold rows in ``[start, end)``, with a ``chain`` column.

    Files the index does not list or could not cover are read too, so nothing
    is lost. Without an index the whole chain is read; with ``strict`` a miss
    raises instead.
    """
    days = spark.range(1).select(F.lit(chain).alias("chain"), start.alias("lo"), end.alias("hi"))
    chosen, _ = choose_files(spark, index, root, target, [chain], days, strict)
    rows = read_chosen(spark, root, chain, target, chosen)
    return rows.withColumn("chain", F.lit(chain))
