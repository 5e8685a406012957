"""Episodes -> one row per transaction with exact net balance changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..config import TraceConfig
from ..functions import normalize_addr, parse_actions, to_utc_ts, ts_iso
from ..functions.json_args import bare_integers
from ..functions.scalars import let, null_if_blank, strip
from ..functions.u256 import LIMBS, MAX_DIGITS, limbs_of, limbs_text, long_sum_text, signed_text
from .transactions import tx_order

NATIVE = "native"
UNKNOWN_TOKEN = "unknown_token"
TX_KEY = ["chain", "tx_hash"]

_TRACE_FIELDS = (
    "type", "ts", "tx_hash", "from", "to", "method_id", "value", "chain", "log_index", "contract",
    "event_name", "event_signature", "token", "owner", "spender", "amount",
)


def episode_ids(df: DataFrame, id_cols: tuple[str, ...] | None) -> tuple[str, ...]:
    """The columns that tell episodes apart; rows repeat in every stored file, so the file belongs to them."""
    if id_cols is not None:
        return id_cols
    return ("episode_file", "episode_row") if "episode_file" in df.columns else ("episode_row",)


def explode_actions(episodes: DataFrame, config: TraceConfig = TraceConfig()) -> DataFrame:
    """One row per action with its position in the episode.

    Actions without hash or chain are dropped after numbering. ``extra_focus``
    holds the valid addresses of the chosen receipt columns.
    """
    ids = episode_ids(episodes, config.id_cols)
    data_type = episodes.schema[config.episode_actions_col].dataType
    actions = parse_actions(F.col(config.episode_actions_col), data_type)
    parsed = episodes.select(
        *ids, _extra_focus(episodes, config).alias("extra_focus"), F.posexplode(actions).alias("tx_pos", "_a")
    )
    known = set(parsed.schema["_a"].dataType.fieldNames())
    hashes = [null_if_blank(F.col(f"_a.{n}")) for n in ("tx_hash", "transaction_hash") if n in known]
    return parsed.select(
        *ids,
        F.col("tx_pos").cast("long").alias("tx_pos"),
        F.lower(strip(F.col("_a.chain"))).alias("chain"),
        F.col("_a.phase").alias("phase"),
        normalize_addr(F.coalesce(*hashes)).alias("tx_hash"),
        F.col("_a.ts").alias("action_ts"),
        "extra_focus",
    ).filter(F.col("tx_hash").isNotNull() & (F.length("chain") > 0))


def _extra_focus(episodes: DataFrame, config: TraceConfig) -> Column:
    found = [c for c in config.focus_addr_cols if c in episodes.columns]
    if not found:
        return F.array().cast("array<string>")
    addresses = F.array(*[normalize_addr(F.col(f"`{c}`")) for c in found])
    return F.filter(addresses, lambda a: F.startswith(a, F.lit("0x")))


def focus_addresses(from_address: Column, extra_focus: Column) -> Column:
    """Sender and extra addresses, each once."""
    return F.array_distinct(F.array_compact(F.concat(F.array(from_address), extra_focus)))


def trace_span(actions: DataFrame) -> DataFrame:
    """Scan range of the trace: action times an hour wider, open when unknown."""
    ts = to_utc_ts(F.col("action_ts"), T.StringType())
    hour = F.make_dt_interval(hours=F.lit(1))
    return actions.agg(
        F.coalesce(F.min(ts) - hour, F.timestamp_micros(F.lit(0))).alias("lo"),
        F.coalesce(F.max(ts) + hour, F.timestamp_micros(F.lit(4_102_444_800_000_000))).alias("hi"),
    )


def trace_with_meta(actions: DataFrame, tx: DataFrame) -> DataFrame:
    """Left join the transaction of each action; the earliest copy counts.

    ``tx`` is normalised. It is first reduced to the hashes asked for, so the
    outer join only sees matching rows.
    """
    asked = actions.select("chain", F.col("tx_hash").alias("transaction_hash")).distinct()
    wanted = tx.join(asked, ["chain", "transaction_hash"], "left_semi")
    copies = Window.partitionBy("chain", "transaction_hash").orderBy(*tx_order())
    meta = (
        wanted.withColumn("_copy", F.row_number().over(copies))
        .filter("_copy = 1")
        .select(
            "chain",
            F.col("transaction_hash").alias("tx_hash"),
            "from_address",
            "to_address",
            "method_id",
            "value",
            ts_iso(F.col("block_timestamp")).alias("_tx_ts"),
        )
    )
    return (
        actions.join(meta, TX_KEY, "left")
        .withColumn("block_timestamp", F.coalesce("_tx_ts", "action_ts"))
        .drop("_tx_ts")
    )


def trace_with_events(actions: DataFrame, nested: DataFrame) -> DataFrame:
    """Left join the nested events; none gives an empty array."""
    return actions.join(nested, TX_KEY, "left").withColumn("events", F.coalesce("events", F.array()))


def _leg(addr: Column, token: Column, amount: Column, sign: int) -> Column:
    return F.named_struct(
        F.lit("addr"), addr, F.lit("token"), token, F.lit("amount"), amount, F.lit("sign"), F.lit(sign)
    )


def _is_long(amount: Column) -> Column:
    return F.length(amount) > MAX_DIGITS


def transfer_legs(events: Column) -> Column:
    """Two signed legs per Transfer event that has an amount."""
    moves = F.filter(events, lambda e: (e["event_name"] == "Transfer") & e["amount"].isNotNull())

    def legs(e: Column) -> Column:
        token = F.coalesce(null_if_blank(e["token"]), e["contract"], F.lit(UNKNOWN_TOKEN))
        return F.array(_leg(e["from"], token, e["amount"], -1), _leg(e["to"], token, e["amount"], 1))

    return F.flatten(F.transform(moves, legs))


def native_legs(value: Column, from_address: Column, to_address: Column) -> Column:
    """Two signed legs of the native value; none when it is zero or unknown."""
    native = F.lit(NATIVE)
    legs = F.array(_leg(from_address, native, value, -1), _leg(to_address, native, value, 1))
    return F.when(value != "0", legs).otherwise(F.filter(legs, lambda x: F.lit(False)))


def net_delta(legs: Column, focus: Column) -> Column:
    """``map<address, map<token, delta>>`` with a key for every focus address.

    A column expression over one row: legs are first cut to the focus address
    and sorted by token, so that each token sums one slice of them and nothing
    is shuffled. Tokens come in the order of their first leg.
    """
    names = LIMBS.fieldNames()
    zero = F.struct(*[F.lit(0).cast("decimal(38,0)").alias(n) for n in names])

    def add(acc: Column, leg: Column) -> Column:
        return let(
            limbs_of(leg["amount"], leg["sign"]),
            lambda x: F.struct(*[(acc[n] + x[n]).cast("decimal(38,0)").alias(n) for n in names]),
        )

    def total(same: Column) -> Column:
        # Amounts beyond 86 digits, no uint256 but possible in event data, take a slower way.
        texts = F.transform(same, lambda leg: signed_text(leg["amount"], leg["sign"]))
        short = F.aggregate(same, zero, add, lambda s: limbs_text(s["low"], s["mid"], s["top"]))
        return F.when(F.exists(same, lambda leg: _is_long(leg["amount"])), long_sum_text(texts)).otherwise(short)

    def placed(leg: Column, pos: Column) -> Column:
        return F.struct(leg["token"].alias("token"), pos.alias("pos"), leg["amount"].alias("amount"), leg["sign"].alias("sign"))

    def per_token(ordered: Column) -> Column:
        size = F.size(ordered)
        token = lambda i: F.get(ordered, i)["token"]
        starts = F.filter(F.sequence(F.lit(1), size), lambda i: (i == 1) | (token(i - 1) != token(i - 2)))

        def sums(first: Column) -> Column:
            def one(i: Column, k: Column) -> Column:
                end = F.coalesce(F.get(first, k + 1), size + 1)
                return let(
                    F.slice(ordered, i, end - i),
                    lambda same: F.struct(F.get(same, F.lit(0))["pos"].alias("pos"), F.get(same, F.lit(0))["token"].alias("token"), total(same).alias("delta")),
                )

            entries = F.array_sort(F.transform(first, one))
            return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["token"], e["delta"])))

        return F.when(size > 0, let(starts, sums)).otherwise(F.create_map().cast("map<string,string>"))

    return let(
        legs,
        lambda all_legs: F.map_from_entries(
            F.transform(
                focus,
                lambda a: F.struct(a, let(F.array_sort(F.transform(F.filter(all_legs, lambda leg: leg["addr"] == a), placed)), per_token)),
            )
        ),
    )


def _delta_rows(trace: DataFrame, legs: Column, id_cols: tuple[str, ...] | None) -> DataFrame:
    keys = [*episode_ids(trace, id_cols), "tx_pos"]
    focus = focus_addresses(F.col("from_address"), F.col("extra_focus"))
    own = F.filter(F.col("_legs"), lambda leg: leg["addr"] == F.col("addr"))
    exploded = (
        trace.select(*keys, legs.alias("_legs"), focus.alias("_focus"))
        .select(*keys, "_legs", F.explode("_focus").alias("addr"))
        .select(*keys, "addr", F.explode_outer(own).alias("_leg"))
        .select(
            *keys,
            "addr",
            "_leg.token",
            limbs_of(F.col("_leg.amount"), F.col("_leg.sign")).alias("_limbs"),
            F.when(_is_long(F.col("_leg.amount")), signed_text(F.col("_leg.amount"), F.col("_leg.sign"))).alias("_long"),
        )
    )
    names = LIMBS.fieldNames()
    # Amounts too long for limbs are rare; they are kept as they are, for one transaction and address.
    sums = exploded.groupBy(*keys, "addr", "token").agg(
        *[F.sum(f"_limbs.{n}").alias(n) for n in names], F.collect_list("_long").alias("_longs")
    )
    short = limbs_text(F.col("low"), F.col("mid"), F.col("top"))
    whole = long_sum_text(F.concat("_longs", F.array(F.coalesce(short, F.lit("0")))))
    return sums.select(*keys, "addr", "token", F.when(F.size("_longs") > 0, whole).otherwise(short).alias("delta"))


def transfer_delta(trace: DataFrame, id_cols: tuple[str, ...] | None = None) -> DataFrame:
    """Long form ``(ids, tx_pos, addr, token, delta)`` of the Transfer events.

    A focus address without any movement has one row with a NULL token.
    """
    return _delta_rows(trace, transfer_legs(F.col("events")), id_cols)


def native_delta(trace: DataFrame, id_cols: tuple[str, ...] | None = None) -> DataFrame:
    """Long form of the native value moved by each transaction."""
    legs = native_legs(F.col("value"), F.col("from_address"), F.col("to_address"))
    return _delta_rows(trace, legs, id_cols).filter(F.col("token").isNotNull())


def trace_actions() -> Column:
    """``[CALL] + events`` as a typed array, each with its ``type``."""
    text = F.lit(None).cast("string")

    def entry(**fields: Column) -> Column:
        missing = {n: F.lit(None).cast("bigint") if n == "log_index" else text for n in _TRACE_FIELDS}
        return F.struct(*[{**missing, **fields}[n].alias(n) for n in _TRACE_FIELDS])

    call = entry(
        **{
            "type": F.lit("CALL"), "ts": F.col("block_timestamp"), "tx_hash": F.col("tx_hash"),
            "from": F.col("from_address"), "to": F.col("to_address"), "method_id": F.col("method_id"),
            "value": F.col("value"), "chain": F.col("chain"),
        }
    )
    copied = [
        "ts", "tx_hash", "from", "to", "log_index", "contract", "event_name", "event_signature", "token",
        "owner", "spender", "amount",
    ]

    def event(e: Column) -> Column:
        kind = F.coalesce(e["event_name"], e["event_signature"], F.lit("EVENT"))
        return entry(type=kind, **{n: e[n] for n in copied})

    return F.concat(F.array(call), F.transform("events", event))


def trace_rows(trace: DataFrame, config: TraceConfig = TraceConfig()) -> DataFrame:
    """The trace columns plus the typed ``transfer_delta`` map."""
    legs = F.concat(
        transfer_legs(F.col("events")),
        native_legs(F.col("value"), F.col("from_address"), F.col("to_address")),
    )
    focus = focus_addresses(F.col("from_address"), F.col("extra_focus"))
    return trace.withColumn("transfer_delta", net_delta(legs, focus)).select(
        *episode_ids(trace, config.id_cols),
        "tx_pos",
        "chain",
        "phase",
        "tx_hash",
        "block_timestamp",
        "from_address",
        "to_address",
        "method_id",
        "value",
        bare_integers(F.to_json(trace_actions()), "value", "amount").alias("actions_json"),
        F.regexp_replace(F.to_json("transfer_delta"), '":"(-?[0-9]+)"', '":$1').alias("transfer_delta_json"),
        F.size("events").cast("long").alias("n_events"),
        "transfer_delta",
    )
