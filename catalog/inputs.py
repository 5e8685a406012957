"""Inputs of the registered queries, all derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hopscope import fixtures as fx
from hopscope.functions.scalars import TRANSFER_TOPIC

SPELLED_SQL = """
select event_id,
  case event_id % 9
    when 0 then 'Ethereum' when 1 then 'Arbitrum One' when 2 then '10' when 3 then ' MATIC ' when 4 then 'nan'
    when 5 then '99999' when 6 then concat('Some-Chain ', cast(user_id as varchar(20))) when 7 then '0056' else '---'
  end as chain_text,
  case event_id % 4
    when 0 then concat('  0X', lpad(cast(user_id as varchar(40)), 40, 'A'), ' ') when 1 then 'None' when 2 then ''
    else concat('0x', lpad(cast(user_id as varchar(40)), 40, '0')) end as addr_text,
  case event_id % 8
    when 0 then concat(substr(cast(ts as varchar(40)), 1, 19), ' UTC')
    when 1 then concat(replace(substr(cast(ts as varchar(40)), 1, 19), ' ', 'T'), 'Z')
    when 2 then concat(substr(cast(ts as varchar(40)), 1, 19), '+02:00')
    when 3 then substr(cast(ts as varchar(40)), 1, 10)
    when 4 then replace(substr(cast(ts as varchar(40)), 1, 10), '-', '')
    when 5 then '1700000000' when 6 then 'not a time'
    else concat(substr(cast(ts as varchar(40)), 1, 19), '.250') end as ts_text,
  case event_id % 6
    when 0 then concat('0x', lower(hex(event_id))) when 1 then concat('0x', lower(hex(event_id + 1)), repeat('0', 25))
    when 2 then cast(event_id as varchar(20)) when 3 then 'zz' when 4 then concat('-', cast(event_id as varchar(20)))
    else concat('000', cast(event_id as varchar(20)), repeat('0', 40)) end as amount_text,
  concat('0x', repeat('0', 24), 'AB', lpad(cast(user_id as varchar(38)), 38, '0')) as topic,
  case event_id % 4
    when 0 then concat('["x",', cast(event_id as varchar(20)), ',null]')
    when 1 then concat('{"b":"', cast(event_id as varchar(20)), '","a":', cast(user_id as varchar(20)), '}')
    when 2 then '["cut",' else concat('[“q”,', cast(user_id as varchar(20)), ']') end as args_text
from events
"""


def _mixed_sql() -> str:
    """Decoded events whose arguments come in seven different encodings."""
    a, b = fx._address("e.user_id"), fx._address("e.user_id + 3 * (e.event_id % 4)")
    m = "(e.event_id % 500)"
    topic_a, topic_b = (f"concat('0x', repeat('0', 24), substr({x}, 3, 40))" for x in (a, b))
    topics = f"concat('[\"{TRANSFER_TOPIC}\",\"', {topic_a}, '\",\"', {topic_b}, '\"]')"
    key0 = "case when k.k = 2 then 'owner' when e.event_id % 7 = 1 then 'from' else 'src' end"
    key1 = "case when k.k = 2 then 'spender' when e.event_id % 7 = 1 then 'to' else 'dst' end"
    return f"""
select {fx._chain('e.user_id')} as chain, e.ts as block_timestamp, {fx._hash('e.event_id')} as transaction_hash,
  k.k as event_index, {fx._address('900000 + k.k')} as contract_address,
  case k.k when 1 then null when 3 then 'Swap(address,uint256)' when 2 then 'Approval(address,address,uint256)'
    else 'Transfer(address,address,uint256)' end as event_signature,
  case when k.k = 1 and e.event_id % 7 not in (3, 5) then '{TRANSFER_TOPIC}' end as event_hash,
  case when e.event_id % 7 in (3, 5) then {topics} end as topics,
  case e.event_id % 7
    when 0 then concat('["', {a}, '","', {b}, '",', cast({m} as string), ']')
    when 1 then concat('{{"', {key0}, '":"', {a}, '","', {key1}, '":"', {b}, '","value":"0x', hex({m}), '"}}')
    when 2 then concat('{{"', {key0}, '":"', {a}, '","', {key1}, '":"', {b}, '","amount":', cast({m} as string), '}}')
    when 5 then concat('["', {a}, '","', {b}, '"')
    when 6 then concat('{{"sender":" ', upper({a}), ' ","recipient":"","value":null,"amount":5}}')
  end as args_json,
  case when e.event_id % 7 = 4 then concat('[“', {a}, '”,“', {b}, '”,“', cast({m} as string), '”]') end as args,
  case e.event_id % 7 when 3 then concat('0x', lpad(hex({m}), 64, '0'))
    when 5 then concat('0x', lpad(concat(hex({m}), repeat('0', 25)), 64, '0'))
    when 6 then concat('0x', hex({m})) end as data
from events e cross join (values (0),(1),(2),(3)) as k(k)
where k.k <= e.event_id % 4
"""


def spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx._over_events(spark, sf_dir, SPELLED_SQL)


def mixed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx._over_events(spark, sf_dir, _mixed_sql())
