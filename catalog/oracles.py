"""SQL with the same results as ``queries``, written for DuckDB.

The SQL states each result directly over the given tables: plain joins,
windows and case tables, sharing only the definition of the derived inputs.
"""

from __future__ import annotations

from hopscope import fixtures as fx

from .inputs import SPELLED_SQL

TRANSFER = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
ORACLES: dict[str, str] = {}


def _iso(ts: str) -> str:
    return (
        f"(case when epoch_us({ts}) % 1000000 = 0 then strftime({ts}, '%Y-%m-%dT%H:%M:%S') "
        f"else strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') end || '+00:00')"
    )


# DuckDB has hex(); lower-case digits and repeat() are the same in both.
_SPELLED = f"spelled as ({SPELLED_SQL})"
_METHOD = "case when input like '0x%' and length(input) >= 10 then substr(input, 1, 10) end"

_BASE = f"""
transactions as ({fx.TRANSACTIONS_SQL}),
receipts as ({fx.RECEIPTS_SQL}),
decoded_events as ({fx.DECODED_EVENTS_SQL}),
canon as (
  select receipt_id, lower(DESTINATION_ADDRESS) as recv, DESTINATION_CHAIN as raw_chain,
    case DESTINATION_CHAIN when '1' then 'eth' when '42161' then 'arbitrum' when '10' then 'optimism'
      else DESTINATION_CHAIN end as chain,
    DESTINATION_TIMESTAMP as ts, SOURCE_CHAIN as src_chain, SOURCE_ADDRESS as src_addr,
    SOURCE_TX_HASH as src_hash
  from receipts)"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes)


def _actor(pre: int = 60) -> str:
    return f"""
resolved as (
  select c.*, coalesce(t.from_address, c.src_addr) as actor
  from canon c left join transactions t
    on t.chain = c.src_chain and t.transaction_hash = c.src_hash
    and t.block_timestamp >= c.ts - interval {pre} minute and t.block_timestamp < c.ts)"""


def _actions(phase: str, minutes: int = 180, n: int = 50, sender_only: bool = False) -> str:
    """CTE ``dst_post`` or ``src_pre``: numbered, capped rows."""
    if phase == "dst_post":
        source, chain, actor = "canon", "c.chain", "c.recv"
        window = f"t.block_timestamp >= c.ts and t.block_timestamp < c.ts + interval {minutes} minute"
    else:
        source, chain, actor = "resolved", "c.src_chain", "c.actor"
        window = f"t.block_timestamp >= c.ts - interval {minutes} minute and t.block_timestamp < c.ts"
    either = f"t.from_address = {actor}" + ("" if sender_only else f" or t.to_address = {actor}")
    cap = f"qualify seq <= {n}" if n > 0 else ""
    return f"""
{phase} as (
  select c.receipt_id, '{phase}' as phase, c.ts as receipt_ts, t.*,
    row_number() over (partition by c.receipt_id
      order by t.block_timestamp, t.block_number, t.transaction_index, t.transaction_hash) as seq
  from {source} c join transactions t on t.chain = {chain} and ({either}) and {window}
  {cap})"""


_ACTION_COLUMNS = f"""receipt_id, phase, cast(seq as integer) as seq, chain, transaction_hash, to_address,
  cast(value as varchar) as value, {_METHOD} as method_id, {_iso('block_timestamp')} as block_timestamp"""


def _both(pre: int = 60, post: int = 180, n: int = 50) -> tuple[str, ...]:
    ordered = f"""
acts as (
  select *, {_iso('block_timestamp')} as iso, {_METHOD} as method_id,
    row_number() over (partition by receipt_id
      order by block_timestamp, case phase when 'src_pre' then 0 else 1 end, seq) - 1 as pos
  from (select * from src_pre union all select * from dst_post))"""
    return _BASE, _actor(pre), _actions("dst_post", post, n), _actions("src_pre", pre, n), ordered


_EPISODES = f"""
episodes as (
  select c.receipt_id, c.raw_chain, c.chain, c.recv, c.ts,
    cast(count(a.pos) as integer) as n,
    arg_min(a.transaction_hash, a.pos) as first_hash, arg_max(a.transaction_hash, a.pos) as last_hash,
    arg_max(a.iso, a.pos) as last_iso,
    cast(trunc((epoch_us(max(a.block_timestamp)) - epoch_us(c.ts)) / 1000000) as bigint) as duration,
    coalesce(string_agg(a.phase || ',' || a.chain || ',' || a.iso || ',' || a.transaction_hash || ','
      || cast(a.value as varchar) || ',' || coalesce(a.method_id, '-'), ';' order by a.pos), '') as actions_text
  from canon c left join acts a using (receipt_id)
  group by c.receipt_id, c.raw_chain, c.chain, c.recv, c.ts)"""

_CHAIN_TABLE = """case event_id % 9 when 0 then 'eth' when 1 then 'arbitrum' when 2 then 'optimism'
  when 3 then 'polygon' when 6 then 'some_chain_' || cast(user_id as varchar) when 7 then 'bsc' end"""

_EVENT_NAME = "case log_index when 3 then 'Swap' when 2 then 'Approval' else 'Transfer' end"

# Functions

ORACLES["canonical_chain"] = f"select event_id, {_CHAIN_TABLE} as chain from events"

ORACLES["normalize_addr"] = """
select event_id, case event_id % 4 when 0 then '0x' || lpad(cast(user_id as varchar), 40, 'a')
  when 3 then '0x' || lpad(cast(user_id as varchar), 40, '0') end as addr from events"""

ORACLES["to_utc_ts"] = f"""
with t as (select event_id, case
    when event_id % 8 in (0, 1) then date_trunc('second', ts)
    when event_id % 8 = 2 then date_trunc('second', ts) - interval 2 hour
    when event_id % 8 in (3, 4) then date_trunc('day', ts)
    when event_id % 8 = 7 then date_trunc('second', ts) + interval 250 millisecond end as x from events)
select event_id, {_iso('x')} as ts from t"""

ORACLES["u256_parse"] = """
select event_id, case event_id % 6
    when 0 then cast(event_id as varchar)
    when 1 then cast((event_id + 1)::hugeint * 1267650600228229401496703205376::hugeint as varchar)
    when 2 then cast(event_id as varchar)
    when 4 then '-' || cast(event_id as varchar)
    when 5 then cast(event_id as varchar) || repeat('0', 40) end as amount
from events"""

ORACLES["topic_addr"] = """
select event_id, '0xab' || lpad(cast(user_id as varchar), 38, '0') as addr,
  '0x' || repeat('0', 24) || 'ab' || lpad(cast(user_id as varchar), 38, '0') as padded from events"""

ORACLES["parse_args"] = """
select event_id, cast(case event_id % 4 when 0 then 3 when 1 then 2 when 2 then 0 else 2 end as integer) as n_items,
  case event_id % 4 when 0 then 'x|' || cast(event_id as varchar)
    when 1 then cast(event_id as varchar) || '|' || cast(user_id as varchar)
    when 3 then 'q|' || cast(user_id as varchar) end as first_items from events"""

ORACLES["ts_iso"] = f"""
{_with(_BASE)} select transaction_hash, {_iso('block_timestamp')} as ts from transactions"""

ORACLES["time_bucket"] = f"""
{_with(_BASE)} select chain, {_iso("date_trunc('hour', block_timestamp)")} as bucket, count(*) as n
from transactions group by all"""

ORACLES["method_id"] = f"{_with(_BASE)} select transaction_hash, {_METHOD} as method_id from transactions"

ORACLES["event_name"] = f"""
{_with(_BASE)} select chain, {_EVENT_NAME} as name, count(*) as n from decoded_events group by all"""

# Receipts

ORACLES["canonical_receipts"] = f"""
{_with(_BASE)} select receipt_id, recv as _recv, chain as _chain, {_iso('ts')} as _ts, src_chain as _src_chain,
  src_addr as _src_addr, src_hash as _src_tx_hash from canon"""

ORACLES["valid_receipts"] = f"""
{_with(_BASE)} select receipt_id, recv as _recv, chain as _chain from canon
where receipt_id % 5 not in (0, 1) and receipt_id % 7 <> 0 and chain in ('eth', 'optimism')"""

ORACLES["with_windows"] = f"""
{_with(_BASE)} select receipt_id, {_iso('ts')} as _dst_start, {_iso('(ts + interval 180 minute)')} as _dst_end,
  {_iso('(ts - interval 60 minute)')} as _src_start, {_iso('ts')} as _src_end,
  {_iso("date_trunc('hour', ts)")} as _dst_bucket,
  {_iso("date_trunc('hour', ts - interval 60 minute)")} as _src_bucket
from canon"""

ORACLES["empty_episodes"] = f"""
{_with(_BASE)} select receipt_id, src_chain as label, 0 as EPISODE_TX_COUNT, '[]' as EPISODE_ACTIONS_JSON,
  cast(null as varchar) as EPISODE_FIRST_TX_HASH, cast(null as varchar) as EPISODE_LAST_TX_HASH,
  cast(null as varchar) as EPISODE_LAST_TX_TIMESTAMP, cast(null as bigint) as EPISODE_DURATION_SEC
from canon"""

_PLACED = f"""
{_with(_BASE)} select receipt_id, row_number() over (partition by receipt_id % 2 order by receipt_id) - 1 as _idx
from receipts"""
ORACLES["receipt_row_numbers"] = _PLACED
ORACLES["limit_rows"] = f"{_PLACED} qualify _idx < 100"
ORACLES["limit_files"] = f"select * from ({_PLACED}) where receipt_id % 2 = 0"
ORACLES["read_receipts"] = ORACLES["canonical_receipts"]
ORACLES["read_transactions"] = f"""
{_with(_BASE)} select chain, transaction_hash, from_address, to_address, cast(value as varchar) as value,
  {_METHOD} as method_id, {_iso('block_timestamp')} as block_timestamp from transactions"""
ORACLES["read_decoded_events"] = f"""
{_with(_BASE)} select chain, transaction_hash as tx_hash, cast(log_index as bigint) as log_index, address as contract,
  event_signature, {_iso('block_timestamp')} as block_timestamp from decoded_events"""

ORACLES["project_tolerant"] = f"""
{_with(_BASE)} select transaction_hash, block_number, cast(null as varchar) as gas_price from transactions"""

ORACLES["union_promoting"] = f"""
{_with(_BASE)} select chain, transaction_hash, cast(value as varchar) as value,
  case when chain <> 'eth' then block_number end as block_number from transactions"""

# Transactions

ORACLES["normalize_transactions"] = f"""
{_with(_BASE)} select chain, {_iso('block_timestamp')} as block_timestamp, transaction_hash, from_address, to_address,
  cast(value as varchar) as value, {_METHOD} as method_id, block_number, transaction_index from transactions"""

ORACLES["tx_by_actor"] = f"""
{_with(_BASE)}
select chain, from_address as actor, 0 as side, transaction_hash from transactions
union all
select chain, to_address, 1, transaction_hash from transactions where to_address <> from_address"""

_RANGE = "block_timestamp >= timestamp '2024-01-08' and block_timestamp < timestamp '2024-01-15'"

ORACLES["scan_by_actors"] = f"""
{_with(_BASE)} select chain, transaction_hash, to_address, {_iso('block_timestamp')} as block_timestamp
from transactions t where {_RANGE}
  and exists (select 1 from canon c where c.chain = t.chain and c.recv = t.to_address)"""

ORACLES["scan_by_hashes"] = f"""
{_with(_BASE)} select chain, transaction_hash, from_address, {_iso('block_timestamp')} as block_timestamp
from transactions t where {_RANGE}
  and exists (select 1 from canon c where c.src_chain = t.chain and c.src_hash = t.transaction_hash)"""

ORACLES["scan_events"] = f"""
{_with(_BASE)} select chain, transaction_hash as tx_hash, cast(log_index as bigint) as log_index, address as contract
from decoded_events t where {_RANGE}
  and exists (select 1 from canon c where c.src_chain = t.chain and c.src_hash = t.transaction_hash)"""

# Episodes

ORACLES["dst_post_actions"] = f"""
{_with(_BASE, _actions('dst_post'))} select {_ACTION_COLUMNS} from dst_post"""

ORACLES["dst_post_sender_only"] = f"""
{_with(_BASE, _actions('dst_post', sender_only=True))} select {_ACTION_COLUMNS} from dst_post"""

ORACLES["dst_post_unlimited"] = f"""
{_with(_BASE, _actions('dst_post', 1440, 0))} select {_ACTION_COLUMNS} from dst_post"""

ORACLES["cap_actions"] = f"""
{_with(_BASE, _actions('dst_post', 10080, 5))} select {_ACTION_COLUMNS} from dst_post"""

ORACLES["resolve_source_actor"] = f"""
{_with(_BASE, _actor())} select receipt_id, src_chain as _src_chain, actor as _src_actor from resolved"""

ORACLES["src_pre_actions"] = f"""
{_with(_BASE, _actor(), _actions('src_pre', 60))} select {_ACTION_COLUMNS} from src_pre"""

ORACLES["episodes"] = f"""
{_with(*_both(), _EPISODES)}
select receipt_id, raw_chain as DESTINATION_CHAIN, n as EPISODE_TX_COUNT, first_hash as EPISODE_FIRST_TX_HASH,
  last_hash as EPISODE_LAST_TX_HASH, last_iso as EPISODE_LAST_TX_TIMESTAMP, duration as EPISODE_DURATION_SEC,
  actions_text
from episodes"""

ORACLES["episodes_json"] = f"""
{_with(*_both(10080, 10080, 5))}
select receipt_id, cast(pos as integer) as pos, phase, transaction_hash as tx_hash, cast(value as varchar) as value
from acts"""

ORACLES["episode_summary"] = f"""
{_with(*_both(), _EPISODES)}
select chain, count(*) as n_receipts, count_if(n > 0)::bigint as n_with_actions, cast(sum(n) as bigint) as n_actions,
  min(duration) as min_duration, max(duration) as max_duration
from episodes group by chain"""

_EVENT_TEXT = f"""
event_rows as (
  select *, {_EVENT_NAME} as name, json_extract_string(args_json, '$[0]') as a,
    json_extract_string(args_json, '$[1]') as b, json_extract_string(args_json, '$[2]') as m
  from decoded_events),
event_texts as (
  select chain, transaction_hash, count(*) as n_events,
    string_agg(cast(log_index as varchar) || ':' || name || ':' || case when name = 'Swap' then '-' else address end
      || ':' || case when name = 'Transfer' then a || ':' || b else '-:-' end
      || ':' || case when name = 'Approval' then a || ':' || b else '-:-' end
      || ':' || case when name = 'Swap' then '-' else m end, ',' order by log_index) as txt
  from event_rows group by chain, transaction_hash)"""

ORACLES["episodes_enriched"] = f"""
{_with(*_both(), _EVENT_TEXT)}
select c.receipt_id, cast(count(a.pos) as integer) as EPISODE_TX_COUNT,
  cast(coalesce(sum(e.n_events), 0) as integer) as n_events,
  coalesce(string_agg(a.transaction_hash || '=' || coalesce(e.txt, ''), ';' order by a.pos), '') as events_text
from canon c left join acts a using (receipt_id)
  left join event_texts e on e.chain = a.chain and e.transaction_hash = a.transaction_hash
group by c.receipt_id"""

# Events

ORACLES["decode_events"] = f"""
{_with(_BASE, _EVENT_TEXT)}
select chain, {_iso('block_timestamp')} as ts, transaction_hash as tx_hash, cast(log_index as bigint) as log_index,
  address as contract, name as event_name, case when name = 'Swap' then event_signature end as event_signature,
  a || '|' || b || '|' || m as args_preview, cast(null as integer) as topics_preview,
  case when name <> 'Swap' then address end as token,
  case when name = 'Transfer' then a end as "from", case when name = 'Transfer' then b end as "to",
  case when name = 'Approval' then a end as owner, case when name = 'Approval' then b end as spender,
  case when name <> 'Swap' then m end as amount
from event_rows"""

# The seven encodings carry the same facts, so the expected values come from
# the source columns: a short amount, one shifted by 100 bits (case 5), and a
# second party or named owner that the encoding leaves out.
_FACTS = f"""
facts as (
  select {fx._chain('e.user_id')} as chain, {fx._hash('e.event_id')} as tx_hash, cast(k.k as bigint) as log_index,
    {fx._address('900000 + k.k')} as token, e.event_id % 7 as enc, {fx._address('e.user_id')} as a,
    {fx._address('e.user_id + 3 * (e.event_id % 4)')} as b,
    case when e.event_id % 7 = 5
      then cast((e.event_id % 500)::hugeint * 1267650600228229401496703205376::hugeint as varchar)
      else cast(e.event_id % 500 as varchar) end as amount
  from events e cross join (values (0), (1), (2), (3)) as k(k) where k.k <= e.event_id % 4)"""

ORACLES["decode_transfer"] = f"""
{_with(_FACTS)} select chain, tx_hash, log_index, token, a as "from", case when enc <> 6 then b end as "to", amount
from facts where log_index in (0, 1)"""

ORACLES["decode_approval"] = f"""
{_with(_FACTS)} select chain, tx_hash, log_index, token, case when enc <> 6 then a end as owner,
  case when enc <> 6 then b end as spender, amount
from facts where log_index = 2"""

ORACLES["cap_events"] = f"""
{_with(_BASE)} select chain, transaction_hash as tx_hash, cast(log_index as bigint) as log_index,
  cast(log_index + 1 as integer) as event_pos from decoded_events where log_index < 2"""

ORACLES["events_per_tx"] = f"""
{_with(_BASE, _EVENT_TEXT)} select chain, transaction_hash as tx_hash, cast(count(*) as integer) as n_events,
  string_agg(name, ',' order by log_index) as names from event_rows group by chain, transaction_hash"""

ORACLES["attach_events"] = f"""
{_with(_BASE)} select t.chain, t.transaction_hash, cast(count(e.log_index) as integer) as n_events
from transactions t left join decoded_events e using (chain, transaction_hash) group by t.chain, t.transaction_hash"""

# Action trace

ORACLES["explode_actions"] = f"""
{_with(*_both())} select receipt_id, cast(pos as bigint) as tx_pos, chain, phase, transaction_hash as tx_hash,
  iso as action_ts from acts"""

ORACLES["trace_with_meta"] = f"""
{_with(*_both())} select receipt_id, cast(pos as bigint) as tx_pos, transaction_hash as tx_hash,
  iso as block_timestamp, from_address, to_address, method_id, cast(value as varchar) as value from acts"""

_FOCUS = """
focus as (
  select distinct a.receipt_id, a.pos, a.chain, a.transaction_hash, f.addr
  from acts a join canon c using (receipt_id)
    cross join lateral (values (a.from_address), (c.src_addr), (c.recv)) as f(addr))"""

ORACLES["focus_addresses"] = f"""
{_with(*_both(), _FOCUS)} select receipt_id, cast(pos as bigint) as tx_pos, addr from focus"""

_LEGS = """
legs as (
  select chain, transaction_hash, a as addr, address as token, -cast(m as hugeint) as x
  from event_rows where name = 'Transfer'
  union all
  select chain, transaction_hash, b, address, cast(m as hugeint) from event_rows where name = 'Transfer'),
native as (
  select chain, transaction_hash, from_address as addr, -cast(value as hugeint) as x from transactions where value <> 0
  union all
  select chain, transaction_hash, to_address, cast(value as hugeint) from transactions where value <> 0)"""

ORACLES["transfer_delta"] = f"""
{_with(*_both(), _EVENT_TEXT, _FOCUS, _LEGS)}
select f.receipt_id, cast(f.pos as bigint) as tx_pos, f.addr, l.token, cast(sum(l.x) as varchar) as delta
from focus f left join legs l
  on l.chain = f.chain and l.transaction_hash = f.transaction_hash and l.addr = f.addr
group by all"""

ORACLES["native_delta"] = f"""
{_with(*_both(), _EVENT_TEXT, _FOCUS, _LEGS)}
select f.receipt_id, cast(f.pos as bigint) as tx_pos, f.addr, 'native' as token, cast(sum(l.x) as varchar) as delta
from focus f join native l
  on l.chain = f.chain and l.transaction_hash = f.transaction_hash and l.addr = f.addr
group by all"""

ORACLES["trace_actions"] = f"""
{_with(*_both(), _EVENT_TEXT)}
select receipt_id, cast(pos as bigint) as tx_pos, 0 as pos, 'CALL' as type, iso as ts, transaction_hash as tx_hash,
  from_address as "from", to_address as "to", cast(null as bigint) as log_index, cast(null as varchar) as amount
from acts
union all
select x.receipt_id, cast(x.pos as bigint), cast(e.log_index + 1 as integer), e.name, x.iso, x.transaction_hash,
  case when e.name = 'Transfer' then e.a end, case when e.name = 'Transfer' then e.b end,
  cast(e.log_index as bigint), case when e.name <> 'Swap' then e.m end
from acts x join event_rows e using (chain, transaction_hash)"""

ORACLES["action_trace"] = f"""
{_with(*_both(), _EVENT_TEXT, _FOCUS, _LEGS)},
moves as (
  select receipt_id, pos, addr, token, sum(x) as x from (
    select f.receipt_id, f.pos, f.addr, l.token, l.x from focus f join legs l
      on l.chain = f.chain and l.transaction_hash = f.transaction_hash and l.addr = f.addr
    union all
    select f.receipt_id, f.pos, f.addr, 'native', l.x from focus f join native l
      on l.chain = f.chain and l.transaction_hash = f.transaction_hash and l.addr = f.addr)
  group by all),
texts as (
  select receipt_id, pos, string_agg(txt, ';' order by txt) as delta_text
  from (select receipt_id, pos, addr || '/' || token || '/' || cast(x as varchar) as txt from moves) group by all),
sizes as (select receipt_id, pos, count(*) as n_focus from focus group by all)
select a.receipt_id, cast(a.pos as bigint) as tx_pos, a.chain, a.phase, a.transaction_hash as tx_hash,
  a.iso as block_timestamp, a.from_address, a.to_address, a.method_id, cast(a.value as varchar) as value,
  coalesce(e.n_events, 0) as n_events, cast(s.n_focus as integer) as n_focus, coalesce(t.delta_text, '') as delta_text
from acts a left join event_texts e using (chain, transaction_hash)
  left join texts t on t.receipt_id = a.receipt_id and t.pos = a.pos
  left join sizes s on s.receipt_id = a.receipt_id and s.pos = a.pos"""

# Time index

_INDEX = f"""
idx as (
  select 'events.parquet' as rel_file, 'events' as dataset, 'ts' as timestamp_col,
    cast(min(ts) as timestamp) as lo, cast(max(ts) as timestamp) as hi from events
  union all
  select 'orders.parquet', 'orders', 'o_orderdate', cast(min(o_orderdate) as timestamp),
    cast(max(o_orderdate) as timestamp) from orders
  union all
  select 'lineitem.parquet', 'lineitem', 'l_shipdate', cast(min(l_shipdate) as timestamp),
    cast(max(l_shipdate) as timestamp) from lineitem)"""

ORACLES["time_index"] = f"""
{_with(_INDEX)} select rel_file, dataset, timestamp_col, {_iso('lo')} as min_ts, {_iso('hi')} as max_ts from idx"""

ORACLES["select_files"] = f"""
{_with(_INDEX)} select rel_file, dataset from idx where hi >= timestamp '2024-01-10' and lo < timestamp '2024-01-11'"""

ORACLES["time_index_summary"] = f"""
{_with(_INDEX)} select 'all' as chain, dataset, count(*) as n_files, count(lo) as n_indexed,
  count(*) - count(lo) as n_errors
from (select dataset, lo from idx union all select 'nation', null) group by dataset"""

_LAKE_INDEX = f"""
{_with(_BASE)} select chain, dataset, {_iso('min(ts)')} as min_ts, {_iso('max(ts)')} as max_ts
from (select chain, 'transactions' as dataset, block_timestamp as ts from transactions
  union all select chain, 'decoded_events', block_timestamp from decoded_events) group by chain, dataset"""
ORACLES["read_time_index"] = _LAKE_INDEX
ORACLES["build_time_index"] = f"select *, cast(0 as bigint) as n_errors from ({_LAKE_INDEX})"

ORACLES["read_for_range"] = f"""
{_with(_BASE)} select chain, transaction_hash, to_address from transactions
where chain = 'eth' and block_timestamp >= timestamp '2024-01-10' and block_timestamp < timestamp '2024-01-11'"""

ORACLES["read_time_index_json"] = ORACLES["read_for_range"]

ORACLES["index_read_column"] = f"""
{_with(_BASE)} select 'eth' as chain, 'transactions' as dataset, {_iso('min(block_timestamp)')} as min_ts,
  {_iso('max(block_timestamp)')} as max_ts, 'read_column' as method, cast(null as varchar) as error from transactions"""

# Schema profile

_TABLES = ", ".join(
    f"'{t}'"
    for t in (
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
        "conversations"
    ).split()
)
_COLS = f"""
cols as (
  select distinct table_name, column_name, ordinal_position from information_schema.columns
  where table_name in ({_TABLES}))"""

ORACLES["schema_column_presence"] = f"""
{_with(_COLS)} select 'all' as chain, column_name as name, count(distinct table_name) as present_in_files,
  cast(count(distinct table_name) as double) / (select count(distinct table_name) from cols) as present_ratio
from cols group by column_name"""

ORACLES["schema_groups"] = f"""
{_with(_COLS)},
lists as (
  select table_name, string_agg(column_name, '|' order by ordinal_position) as columns,
    string_agg(case when rank <= 25 then column_name end, '|' order by ordinal_position) as first_columns, count(*) as n
  from (select *, row_number() over (partition by table_name order by ordinal_position) as rank from cols)
  group by table_name)
select 'all' as chain, count(*) as count, min(table_name) || '.parquet' as example_file,
  cast(min(n) as integer) as num_cols, min(first_columns) as columns
from lists group by columns"""

ORACLES["schema_groups_top"] = f"""
select cast(rank as integer) as rank, count, example_file from (
  select *, row_number() over (order by count desc, example_file) as rank from ({ORACLES["schema_groups"]})) where rank <= 5"""

ORACLES["schema_global_union"] = f"""
{_with(_COLS)} select column_name as name, count(distinct table_name) as chains_present from cols group by column_name"""

ORACLES["schema_summary"] = f"""
{_with(_COLS)},
lists as (select table_name, string_agg(column_name, '|' order by ordinal_position) as columns from cols group by 1)
select 'all' as chain, (select count(*) from lists) as files_inspected,
  (select count(distinct columns) from lists) as unique_schemas,
  (select count(distinct column_name) from cols) as num_columns, cast(null as varchar) as error
union all select 'none', null, null, null, 'no parquet files'"""

# Views

_VIEW_ALL = """
shown as (select *, row_number() over (order by receipt_id) - 1 as id from episodes where n > 0)"""
_VIEW = _VIEW_ALL.replace("n > 0)", "n > 0 qualify id < 2000)")

ORACLES["episode_view"] = f"""
{_with(*_both(), _EPISODES, _VIEW)}
select id, n as tx_count, first_hash as first_tx, last_hash as last_tx, last_iso as last_ts, duration as duration_sec,
  recv as receiver, raw_chain as dst_chain, cast(ts as varchar) as receipt_ts from shown"""

ORACLES["episode_view_first"] = ORACLES["episode_view"].replace("id < 2000", "id < 25")
ORACLES["episode_view_all"] = ORACLES["episode_view"].replace(_VIEW, _VIEW_ALL)

ORACLES["episode_event_preview"] = f"""
{_with(*_both(), _EPISODES, _VIEW_ALL, _EVENT_TEXT)}
select v.id, cast(a.pos as integer) as tx_pos, a.iso as ts, a.transaction_hash as tx_hash, a.to_address as "to",
  cast(a.value as varchar) as value, coalesce(a.method_id, '') as method_id,
  cast(count(e.log_index) as integer) as events_count,
  coalesce(string_agg(e.name || ' ' || e.address || ' amt=' || e.m, chr(10) order by e.log_index)
    filter (where e.log_index < 3), '') as events_preview
from shown v join acts a using (receipt_id)
  left join event_rows e on e.chain = a.chain and e.transaction_hash = a.transaction_hash
group by v.id, a.pos, a.iso, a.transaction_hash, a.to_address, a.value, a.method_id"""

# Sinks

ORACLES["episodes_indexed"] = ORACLES["episodes"]
ORACLES["episodes_stored"] = f"select * exclude (DESTINATION_CHAIN, actions_text) from ({ORACLES['episodes']})"
ORACLES["action_trace_stored"] = f"""
select receipt_id, tx_pos, chain, phase, tx_hash, block_timestamp, from_address, value, n_events
from ({ORACLES['action_trace']})"""
