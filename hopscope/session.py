"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

# All are runtime SQL settings, so an already running session can take them.
SETTINGS = {
    # Re-plan from real shuffle sizes: small sides turn into broadcasts (behind
    # autoBroadcastJoinThreshold, a checked size), small partitions merge.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot (chain, address) or (chain, hash) partition even where that
    # costs one more shuffle further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Decoding makes long generated methods; HotSpot never compiles those above
    # 8000 bytes, so let Spark split them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Prune first-N groups before they are shuffled.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Bloom filter from the small join side down to the big scan, where that side has a
    # selective predicate; events have their own filter (operators/key_filter.py).
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # The default leaves it out where the small side is over 10 MB, as at scale.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4GB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "40000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "268435456",
    # Rows reach Python in batches of so many bytes; 10,000 rows, the default alone, are tens of
    # megabytes of texts, held by the JVM outside its heap and by the Python worker once more.
    ARROW_BYTES: "4m",
}

# These can only be set while the session is built.
STATIC_SETTINGS = {
    # Skip recording a Python call site for each column expression, which
    # otherwise takes a third of the time it takes to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def builder(master: str | None = None) -> SparkSession.Builder:
    """Session builder with every setting, for jobs that own their session."""
    made = SparkSession.builder.config("spark.sql.session.timeZone", "UTC")
    for key, value in (STATIC_SETTINGS | SETTINGS).items():
        made = made.config(key, value)
    return made.master(master) if master else made


PARTITION_BYTES = 128 << 20
MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
MERGED_DEFAULT, MERGED_BYTES = "67108864b", "16m"


def bound_batches(spark: SparkSession) -> SparkSession:
    """Of the settings only the size of batches that reach Python, for steps that are called alone."""
    spark.conf.set(ARROW_BYTES, SETTINGS[ARROW_BYTES])
    return spark


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the settings to a session and hand it back.

    ``shuffle_bytes``, the volume of the largest shuffle (about the narrow
    transaction columns of the scanned time range), sizes the shuffle
    partitions; AQE merges those that turn out small.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    # Shuffled hashes and addresses pack to a tenth and less; 64 MB of them, Spark's default for
    # merged partitions, take a GB to sort. A size that the session sets stays.
    if spark.conf.get(MERGED) == MERGED_DEFAULT:
        spark.conf.set(MERGED, MERGED_BYTES)
    if shuffle_bytes is not None:
        wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shuffle_bytes // PARTITION_BYTES)
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark
