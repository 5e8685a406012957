"""Decoded log events: normalise, cap per transaction, decode, nest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import (
    as_list,
    event_name,
    normalize_addr,
    parse_args,
    preview,
    text_list,
    to_utc_ts,
    topic_addr,
    ts_iso,
)
from ..functions.json_args import EVENT_FIELDS, clean_json
from ..functions.scalars import null_if_blank
from ..functions.u256 import hex_digits, hex_value, whole_number
from ..sources.columns import match_column
from .key_filter import EXPECTED_KEYS, keep_possible
from .transactions import require

# Argument names of the decoded events, best first.
FROM_KEYS = ("from", "src", "sender")
TO_KEYS = ("to", "dst", "recipient")
OWNER_KEYS = ("owner",)
SPENDER_KEYS = ("spender",)

EVENT_KEY = ["chain", "tx_hash"]
_FRACTION = r"^\s*-?[0-9]+([.][0-9]+)?([eE][+-]?[0-9]+)?\s*$"


def normalize_events(df: DataFrame) -> DataFrame:
    """One spelling for keys, time and contract; arguments and topics stay raw.

    ``args_json`` and ``args`` may be JSON text or typed columns, and some
    column names have accepted alternates. ``chain`` and the hash have to be there.
    """
    require(df, ["chain"], ["transaction_hash", "tx_hash"])

    def source(*names: str) -> tuple[Column, T.DataType]:
        found = match_column(df.columns, names)
        if found is None:
            return F.lit(None).cast("string"), T.StringType()
        return F.col(f"`{found}`"), df.schema[found].dataType

    def text(*names: str) -> Column:
        return source(*names)[0].cast("string")

    log_index, log_type = source("log_index", "event_index", "log_idx")
    return df.select(
        text("chain").alias("chain"),
        F.lower(text("transaction_hash", "tx_hash")).alias("tx_hash"),
        to_utc_ts(*source("block_timestamp")).alias("block_timestamp"),
        (log_index.cast("long") if isinstance(log_type, T.NumericType) else log_index.try_cast("long")).alias(
            "log_index"
        ),
        normalize_addr(text("address", "contract_address")).alias("contract"),
        text("event_hash").alias("event_hash"),
        text("event_signature").alias("event_signature"),
        source("topics")[0].alias("topics"),
        source("args_json")[0].alias("args_json"),
        source("args")[0].alias("args"),
        text("data").alias("data"),
    ).filter(F.length("tx_hash") > 0)


def scan_events(
    events: DataFrame, hashes: DataFrame, lo: Column | None = None, hi: Column | None = None, expected: int = EXPECTED_KEYS
) -> DataFrame:
    """Normalised events of the given ``(chain, tx_hash)`` keys, in a time range.

    ``expected`` keys size the filter that drops other events at the scan.
    """
    asked = hashes.select(*EVENT_KEY).distinct()
    kept = keep_possible(events, asked, EVENT_KEY, expected).join(asked, EVENT_KEY, "left_semi")
    if lo is None or hi is None:
        return kept
    return kept.filter((F.col("block_timestamp") >= lo) & (F.col("block_timestamp") < hi))


def _total_order(df: DataFrame) -> list[Column]:
    """Log order; the remaining columns only separate events that share it."""
    ties = ["contract", "event_hash", "event_signature", "data", "topics", "args_json", "args"]

    def comparable(name: str) -> Column:
        simple = isinstance(df.schema[name].dataType, T.AtomicType)
        return F.col(name) if simple else F.to_json(F.struct(name))

    return [F.col("log_index").asc_nulls_last(), *[comparable(c) for c in ties if c in df.columns]]


def cap_events(events: DataFrame, max_events: int) -> DataFrame:
    """Number events by log order as ``event_pos``; the first ``max_events`` stay.

    Where the rows come straight from a scan or a broadcast join, the limit is
    pushed below the shuffle, so a hash with very many rows sends at most
    ``max_events`` of them per map task; after a shuffled join it applies to the
    rows of a hash where they meet.
    """
    order = Window.partitionBy(*EVENT_KEY).orderBy(*_total_order(events))
    numbered = events.withColumn("event_pos", F.row_number().over(order))
    return numbered.filter(F.col("event_pos") <= max_events) if max_events > 0 else numbered


def capped_events_of(events: DataFrame, hashes: DataFrame, max_events: int, expected: int = EXPECTED_KEYS) -> DataFrame:
    """The first ``max_events`` events, numbered, of each ``(chain, tx_hash)`` asked for.

    ``cap_events`` after ``scan_events``, in the order that moves least: the key
    filter at the scan, the cap on either side of the one shuffle by hash, and
    there the exact join. Arguments, topics and data of events that are not
    kept stay behind that shuffle, but for the few that the filter lets through.
    """
    asked = hashes.select(*EVENT_KEY).distinct()
    possible = keep_possible(events, asked, EVENT_KEY, expected)
    return cap_events(possible, max_events).join(asked, EVENT_KEY, "left_semi")


def _parsed(events: DataFrame) -> DataFrame:
    """Replace the raw arguments and topics by parsed ones, parsed only once."""

    def parsed(name: str) -> Column:
        return parse_args(F.col(name), events.schema[name].dataType)

    readable = F.col("_first.items").isNotNull() | F.col("_first.fields").isNotNull()
    return (
        events.withColumns({"_first": parsed("args_json"), "_second": parsed("args")})
        .withColumns(
            {
                "_args": F.when(readable, F.col("_first")).otherwise(F.col("_second")),
                "_topics": text_list(F.col("topics"), events.schema["topics"].dataType),
            }
        )
        .withColumn("_list", as_list(F.col("_args")))
        .withColumn("_from_first", readable)
        .drop("topics", "_first", "_second")
    )


def _field(args: Column, keys: tuple[str, ...]) -> Column:
    """First non-blank value under one of the names."""
    return F.coalesce(*[null_if_blank(F.try_element_at(args["fields"], F.lit(k))) for k in keys])


def _listed(args: Column, pos: int) -> Column:
    """Value at a list position; lists of fewer than three values do not count."""
    return F.when(F.size(args["items"]) >= 3, F.get(args["items"], F.lit(pos)))


def _in_json(events: DataFrame, by_list: Column, key: Column) -> Column:
    """How the amount stands in its JSON: ``quoted`` (text, no number) and ``exact``, its digits.

    Asked only for texts with a fraction or an exponent, which are rare: the
    parsed arguments hold all values as text, and numbers with a fraction as
    doubles. ``exact`` has up to 38 digits.
    """

    def json(name: str) -> Column:
        return clean_json(F.col(name)) if isinstance(events.schema[name].dataType, T.StringType) else F.to_json(name)

    parsed = F.try_parse_json(F.when(F.col("_from_first"), json("args_json")).otherwise(json("args")))

    def at(path: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
        return F.struct((kind == "STRING").alias("quoted"), F.try_variant_get(parsed, path, "string").alias("exact"))

    return F.when(by_list, at("$[2]")).when(key == "value", at("$.value")).otherwise(at("$.amount"))


def _with_parties_and_amount(named: DataFrame) -> DataFrame:
    """Decode what Transfer and Approval share: two addresses and an amount.

    Each is read from the argument list, else from named arguments, else from
    the topics (addresses) or the data word (amount). The intermediate columns
    keep every parse to one evaluation per row.
    """
    args, topics = F.col("_args"), F.col("_topics")
    transfer = F.col("event_name") == "Transfer"
    known = F.col("event_name").isin("Transfer", "Approval")

    def party(pos: int, transfer_keys: tuple[str, ...], approval_keys: tuple[str, ...]) -> Column:
        by_name = F.when(transfer, _field(args, transfer_keys)).otherwise(_field(args, approval_keys))
        by_topic = F.when(F.size(topics) >= 3, topic_addr(F.get(topics, F.lit(pos + 1))))
        given = normalize_addr(F.coalesce(_listed(args, pos), by_name))
        return F.when(known, F.coalesce(given, by_topic))

    fields = args["fields"]
    has_value = F.array_contains(F.map_keys(fields), "value")
    amount_key = F.when(has_value, F.lit("value")).otherwise(F.lit("amount"))
    stands = _in_json(named, _listed(args, 2).isNotNull(), amount_key)
    return (
        named.withColumns(
            {
                "_party0": party(0, FROM_KEYS, OWNER_KEYS),
                "_party1": party(1, TO_KEYS, SPENDER_KEYS),
                "_given": F.when(known, F.coalesce(_listed(args, 2), F.try_element_at(fields, amount_key))),
            }
        )
        .withColumn("_stands", F.when(F.col("_given").rlike(_FRACTION) & F.col("_given").rlike("[.eE]"), stands))
        .withColumn("_whole", whole_number(F.coalesce("_stands.exact", "_given"), F.col("_stands.quoted")))
        .withColumn(
            "_hex",
            F.when(known & F.col("_whole").isNull(), F.coalesce(hex_digits(F.col("_given")), hex_digits(F.col("data")))),
        )
        .withColumn("amount", F.coalesce("_whole", hex_value(F.col("_hex"))))
    )


def decode_events(events: DataFrame, max_args: int = 6, max_topics: int = 4) -> DataFrame:
    """Event fields as columns, one row per event; unknown fields are NULL.

    Expects ``normalize_events`` rows; an ``event_pos`` column is kept.
    """
    topic0 = F.coalesce(F.col("event_hash"), F.get(F.col("_topics"), F.lit(0)))
    named = _parsed(events).withColumn("event_name", event_name(F.col("event_signature"), topic0))
    decoded = _with_parties_and_amount(named)
    transfer = F.col("event_name") == "Transfer"
    approval = F.col("event_name") == "Approval"
    known = F.coalesce(transfer | approval, F.lit(False))
    fields = {
        "ts": ts_iso(F.col("block_timestamp")),
        "event_signature": F.when(~known, null_if_blank(F.col("event_signature"))),
        "args_preview": preview(F.col("_list"), max_args),
        "topics_preview": preview(F.col("_topics"), max_topics),
        "token": F.when(known, F.col("contract")),
        "from": F.when(transfer, F.col("_party0")),
        "to": F.when(transfer, F.col("_party1")),
        "owner": F.when(approval, F.col("_party0")),
        "spender": F.when(approval, F.col("_party1")),
    }
    picked = [fields[n].alias(n) if n in fields else F.col(n) for n, _ in EVENT_FIELDS]
    return decoded.select("chain", *picked, *[c for c in events.columns if c == "event_pos"])


def decode_transfer(events: DataFrame) -> DataFrame:
    """Transfers only: token, both addresses and the exact amount."""
    return (
        decode_events(events)
        .filter("event_name = 'Transfer'")
        .select(*EVENT_KEY, "log_index", "token", "from", "to", "amount")
    )


def decode_approval(events: DataFrame) -> DataFrame:
    """Approvals only: token, owner, spender and the exact amount."""
    return (
        decode_events(events)
        .filter("event_name = 'Approval'")
        .select(*EVENT_KEY, "log_index", "token", "owner", "spender", "amount")
    )


def events_per_tx(decoded: DataFrame) -> DataFrame:
    """``(chain, tx_hash, events)``: the capped events of a hash in log order."""
    body = F.struct(*[F.col(n).alias(n) for n, _ in EVENT_FIELDS])
    nested = F.array_sort(F.collect_list(F.struct("event_pos", body.alias("event"))))
    return decoded.groupBy(*EVENT_KEY).agg(F.transform(nested, lambda x: x["event"]).alias("events"))


def attach_events(actions: DataFrame, nested: DataFrame, hash_col: str = "transaction_hash") -> DataFrame:
    """Left join the nested events; an action without events gets an empty array."""
    renamed = nested.withColumnRenamed("tx_hash", hash_col)
    joined = actions.join(renamed, ["chain", hash_col], "left")
    return joined.withColumn("events", F.coalesce("events", F.array()))
