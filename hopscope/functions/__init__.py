"""Column expressions."""

from .json_args import as_list, parse_actions, parse_args, preview, text_list
from .scalars import (
    canonical_chain,
    event_name,
    method_id,
    normalize_addr,
    time_bucket,
    to_utc_ts,
    topic_addr,
    topic_addr_padded,
    ts_iso,
)
from .u256 import double_text, int_text, limbs_of, limbs_text, tx_value_text, u256_from_hex, u256_parse

__all__ = [
    "as_list",
    "canonical_chain",
    "double_text",
    "event_name",
    "int_text",
    "limbs_of",
    "limbs_text",
    "method_id",
    "normalize_addr",
    "parse_actions",
    "parse_args",
    "preview",
    "text_list",
    "time_bucket",
    "to_utc_ts",
    "topic_addr",
    "topic_addr_padded",
    "ts_iso",
    "tx_value_text",
    "u256_from_hex",
    "u256_parse",
]
