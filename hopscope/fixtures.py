"""Chain-like tables derived from a generic ``events`` table.

Used by the registered queries, the benchmark and the tests: every row follows
from the given table, so the work grows with it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import to_utc_ts
from .sources.staging import staging_root

_CHAIN = "case {x} % 3 when 0 then 'eth' when 1 then 'arbitrum' else 'optimism' end"
_ADDRESS = "concat('0x', lpad(cast({x} as varchar(40)), 40, '0'))"
_HASH = "concat('0x', lpad(cast({x} as varchar(64)), 64, '0'))"

_CROSS = "cross join (values (0),(1),(2),(3)) as k(k)"
_CROSS_CUT = "where k.k <= e.event_id % 4"
_IN_PLACE = "lateral view explode(sequence(0, cast(e.event_id % 4 as int))) k as k"


def _chain(x: str) -> str:
    return _CHAIN.format(x=x)


def _address(x: str) -> str:
    return _ADDRESS.format(x=x)


def _hash(x: str) -> str:
    return _HASH.format(x=x)


# These three run in Spark SQL and in DuckDB.
TRANSACTIONS_SQL = f"""
select {_chain('user_id')} as chain,
  ts as block_timestamp,
  {_hash('event_id')} as transaction_hash,
  {_address('user_id')} as from_address,
  {_address('user_id + 3 * (event_id % 4)')} as to_address,
  cast(event_id % 1000 as bigint) * 1000000 as value,
  case event_type when 'error' then '0x' when 'click' then '0xa9059cbb0000'
    when 'view' then '0x095ea7b30000' else '0x38ed17390000' end as input,
  event_id - event_id % 10 as block_number, event_id % 10 as transaction_index
from events
"""

RECEIPTS_SQL = f"""
select event_id as receipt_id,
  {_address('user_id')} as DESTINATION_ADDRESS,
  case when event_id % 2 = 0 then {_chain('user_id')}
    else case user_id % 3 when 0 then '1' when 1 then '42161' else '10' end end as DESTINATION_CHAIN,
  ts as DESTINATION_TIMESTAMP,
  {_chain('(user_id + 1)')} as SOURCE_CHAIN,
  {_address('user_id + 1')} as SOURCE_ADDRESS,
  {_hash('event_id - 1')} as SOURCE_TX_HASH
from events where event_type = 'purchase'
"""

DECODED_EVENTS_SQL = f"""
select {_chain('e.user_id')} as chain,
  e.ts as block_timestamp,
  {_hash('e.event_id')} as transaction_hash,
  k.k as log_index,
  {_address('900000 + k.k')} as address,
  case when k.k = 1 then null when k.k = 3 then 'Swap(address,uint256)'
    when k.k = 2 then 'Approval(address,address,uint256)'
    else 'Transfer(address,address,uint256)' end as event_signature,
  case when k.k = 1 then '0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef' else null end
    as event_hash,
  concat('["', {_address('e.user_id')}, '","', {_address('e.user_id + 3 * (e.event_id % 4)')}, '",',
    cast(e.event_id % 500 as varchar(10)), ']') as args_json
from events e cross join (values (0),(1),(2),(3)) as k(k)
where k.k <= e.event_id % 4
"""


ROWS_PER_TASK = 100_000


def _over_events(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    # A small table is one file and so one scan task; its derived rows take all cores. They are many
    # times as wide as the stored ones, so a task gets a fixed number of them, not a share of the table.
    wanted = max(spark.sparkContext.defaultParallelism, -(-events.count() // ROWS_PER_TASK))
    if events.rdd.getNumPartitions() < wanted:
        events = events.repartition(wanted, "event_id", "user_id", "ts")
    # The same rows as the cross join with the constants, but made in place.
    sql = sql.replace(_CROSS, _IN_PLACE).replace(_CROSS_CUT, "")
    escaped = sql.replace("{", "{{").replace("}", "}}")
    return spark.sql(escaped.replace("from events", "from {events}"), events=events)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_events(spark, sf_dir, TRANSACTIONS_SQL)


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_events(spark, sf_dir, RECEIPTS_SQL)


def decoded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_events(spark, sf_dir, DECODED_EVENTS_SQL)


CHAINS = ("eth", "arbitrum", "optimism")
# How a chain stores the native value and the time.
_STORED = {
    "eth": ("double", "timestamp"), "arbitrum": ("decimal(20,2)", "timestamp_ntz"), "optimism": ("string", "timestamp"),
}


def write_lake(spark: SparkSession, sf_dir: str, files: int = 4) -> str:
    """The derived tables as a lake of several chains, files and stored types; returns its root.

    ``<root>/<chain>/transactions`` and ``decoded_events`` in time order, and
    ``<root>/receipts`` in two files. Each chain has ``files`` files, or one for
    every ``ROWS_PER_TASK`` transactions where that is more.
    """
    root = f"{staging_root(spark)}/lake-{uuid.uuid4().hex}/logs/eth/lake"
    tx, events = transactions(spark, sf_dir), decoded_events(spark, sf_dir)
    counts = {r.chain: r.n for r in tx.groupBy("chain").agg(F.count(F.lit(1)).alias("n")).collect()}
    for chain in CHAINS:
        parts = max(files, -(-counts.get(chain, 0) // ROWS_PER_TASK))
        value_type, time_type = _STORED[chain]
        instant = to_utc_ts(F.col("block_timestamp"), tx.schema["block_timestamp"].dataType)
        if time_type == "timestamp_ntz":
            instant = F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")
        own = tx.filter(F.col("chain") == chain).drop("chain")
        own = own.withColumns({"value": F.col("value").cast(value_type), "block_timestamp": instant})
        own.repartitionByRange(parts, "block_timestamp").write.parquet(f"{root}/{chain}/transactions")
        logs = events.filter(F.col("chain") == chain).drop("chain").withColumn(
            "block_timestamp", to_utc_ts(F.col("block_timestamp"), events.schema["block_timestamp"].dataType)
        )
        logs.repartitionByRange(parts, "block_timestamp").write.parquet(f"{root}/{chain}/decoded_events")
    rows = receipts(spark, sf_dir)
    for name, part in (("a", rows.filter("receipt_id % 2 = 0")), ("b", rows.filter("receipt_id % 2 = 1"))):
        part.repartition(1).sortWithinPartitions("receipt_id").write.parquet(f"{root}/receipts/{name}")
    return root
