"""Column expressions for addresses, chains, timestamps and call data.

Everything here is a built-in expression, so it stays inside whole-stage
codegen and never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Chain id -> chain name.
CHAIN_BY_ID = {
    "1": "eth",
    "10": "optimism",
    "56": "bsc",
    "100": "gnosis",
    "137": "polygon",
    "250": "fantom",
    "324": "zksync",
    "8453": "base",
    "42161": "arbitrum",
    "43114": "avalanche",
}

# Other spellings of a chain name. A slug is looked up as it is,
# then without underscores; names not listed stand for themselves.
CHAIN_ALIASES = {
    "ethereum": "eth",
    "mainnet": "eth",
    "ethereum_mainnet": "eth",
    "arbitrumone": "arbitrum",
    "arb": "arbitrum",
    "op": "optimism",
    "matic": "polygon",
    "bnb": "bsc",
    "avax": "avalanche",
    "xdai": "gnosis",
    "ftm": "fantom",
}

# topic0 hashes of the two ERC-20 events that are decoded.
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
APPROVAL_TOPIC = "0x8c5be1e5ebec7d5bd14f71427d1e84f3dd0314c0f7b2291e5b200ac8c7c3b925"

# Texts that stand for a missing value.
NULL_WORDS = ("", "none", "null", "nan")

_BLANKS = " \t\n\r\f\x0b"


def strip(col: Column) -> Column:
    """Trim every kind of ASCII white space, not only blanks."""
    return F.btrim(col.cast("string"), F.lit(_BLANKS))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a bound variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def integer_div(col: Column, width: int | Column) -> Column:
    """Floor division of a long by a positive width, exact for negatives."""
    w = width if isinstance(width, Column) else F.lit(width).cast("long")
    return F.call_function("div", col - F.pmod(col, w), w)


def null_if_blank(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def normalize_addr(col: Column) -> Column:
    """Trimmed lower-case text; NULL for blank, none, null and nan."""
    text = F.lower(strip(col))
    return F.when(~text.isin(*NULL_WORDS), text)


def _lookup(table: dict[str, str], key: Column) -> Column:
    entries = ", ".join(f"'{k}', '{v}'" for k, v in table.items())
    return F.try_element_at(F.expr(f"map({entries})"), key)


def canonical_chain(col: Column, data_type: T.DataType | None = None) -> Column:
    """Chain name for an id or a spelling.

    Numbers and digit-only texts are ids (an unknown id gives NULL); any other
    text becomes a slug and goes through the alias table.
    """
    if isinstance(data_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        whole = F.when(~F.isnan(col), col) if not isinstance(data_type, T.DecimalType) else col
        return _lookup(CHAIN_BY_ID, whole.try_cast("long").cast("string"))
    text = strip(col)
    chain_id = F.regexp_replace(text, "^0+(?=[0-9])", "")
    slug = F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))
    joined = F.replace(slug, F.lit("_"), F.lit(""))
    names = {name: name for name in CHAIN_BY_ID.values()} | CHAIN_ALIASES
    named = F.coalesce(_lookup(names, slug), _lookup(names, joined), null_if_blank(slug))
    return (
        F.when(F.lower(text).isin(*NULL_WORDS), F.lit(None).cast("string"))
        .when(text.rlike("^[0-9]+$"), _lookup(CHAIN_BY_ID, chain_id))
        .otherwise(named)
    )


_HAS_ZONE = r"(?i)(z|utc|gmt|[+-][0-9]{2}(:?[0-9]{2})?)$"
_TIME_PART = r"[0-9]{1,2}:[0-9]{2}"


def _as_utc_wall(col: Column) -> Column:
    """Reinterpret a session-zone wall clock as a UTC wall clock."""
    return F.from_utc_timestamp(col, F.current_timezone())


def to_utc_ts(col: Column, data_type: T.DataType, unit: str = "ns") -> Column:
    """Parse to a UTC instant; anything unreadable is NULL.

    ``timestamp_ntz``, dates and texts without an offset are UTC wall clocks.
    Numbers are epochs in ``unit`` (ns, us, ms or s); epoch text is not read.
    """
    if isinstance(data_type, T.TimestampType):
        return col
    if isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        return _as_utc_wall(col.cast("timestamp"))
    if isinstance(data_type, T.NumericType):
        per_unit = {"ns": -1000, "us": 1, "ms": 1000, "s": 1_000_000}[unit]
        if isinstance(data_type, T.IntegralType):
            us = integer_div(col.cast("long"), 1000) if per_unit < 0 else col.cast("long") * per_unit
        else:
            # Guard NaN, which no cast to a whole number accepts.
            scaled = col / 1000 if per_unit < 0 else col * per_unit
            us = F.floor(scaled.cast("double")).try_cast("long")
        return F.timestamp_micros(us)
    text = strip(col)
    # "+0000" -> "+00:00", the only offset form the parser lacks.
    text = F.regexp_replace(text, r"(:[0-9]{2}(?:\.[0-9]+)?\s*[+-][0-9]{2})([0-9]{2})$", "$1:$2")
    zoned = text.rlike(_TIME_PART) & text.rlike(_HAS_ZONE)
    digits = text.rlike("^[0-9]+$")
    parsed = F.try_to_timestamp(text)
    return (
        F.when(digits & (F.length(text) == 8), _as_utc_wall(F.try_to_timestamp(text, F.lit("yyyyMMdd"))))
        .when(digits & (F.length(text) != 4), F.lit(None).cast("timestamp"))
        .when(zoned, parsed)
        .otherwise(_as_utc_wall(parsed))
    )


def ts_iso(col: Column) -> Column:
    """ISO-8601 in UTC; the fraction is printed only when it is not zero."""
    wall = F.to_utc_timestamp(col, F.current_timezone())
    whole = F.pmod(F.unix_micros(col), F.lit(1_000_000)) == 0
    return F.concat(
        F.when(whole, F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
        F.lit("+00:00"),
    )


def time_bucket(col: Column, minutes: int) -> Column:
    """Floor a timestamp to a multiple of ``minutes`` since the epoch."""
    us = F.unix_micros(col)
    return F.timestamp_micros(us - F.pmod(us, F.lit(minutes * 60_000_000).cast("long")))


def _without_0x(text: Column) -> Column:
    return F.when(F.startswith(text, F.lit("0x")), F.substring(text, 3, 1 << 30)).otherwise(text)


def topic_addr(col: Column) -> Column:
    """Address in the low 20 bytes of a 32-byte topic."""
    digits = _without_0x(F.lower(strip(col)))
    return F.when(F.length(digits) >= 40, F.concat(F.lit("0x"), F.right(digits, F.lit(40))))


def topic_addr_padded(col: Column) -> Column:
    """Address as a 32-byte topic."""
    digits = _without_0x(F.lower(strip(col)))
    long_enough = F.when(F.length(digits) < 40, F.lpad(digits, 40, "0")).otherwise(digits)
    return F.concat(F.lit("0x" + "0" * 24), F.right(long_enough, F.lit(40)))


def method_id(col: Column) -> Column:
    """First four bytes of the call data."""
    text = col.cast("string")
    return F.when(F.startswith(text, F.lit("0x")) & (F.length(text) >= 10), F.substring(text, 1, 10))


def event_name(signature: Column, topic0: Column) -> Column:
    """Name in front of the bracket, else the name the topic hash stands for."""
    topic0 = F.lower(topic0)
    return F.coalesce(
        null_if_blank(F.substring_index(signature, "(", 1)),
        F.when(topic0 == TRANSFER_TOPIC, F.lit("Transfer")).when(topic0 == APPROVAL_TOPIC, F.lit("Approval")),
    )
