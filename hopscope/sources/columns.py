"""Finding the receipt columns by name, and drift-tolerant projection.

Runs on column names only, on the driver.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import to_utc_ts

# For each role the accepted names, best first, and the word
# groups that identify a column when no accepted name is present.
ROLE_RULES = {
    "recv": (
        ["destination_address", "dest_address", "dst_address", "recipient_address", "receiver_address",
         "recipient", "receiver", "to"],
        [("destination", "address"), ("dest", "address"), ("dst", "address"), ("receive", "address"),
         ("recipient", "address"), ("to", "address"), ("to",)],
    ),
    "chain": (
        ["destination_chain", "destination_chain_id", "dest_chain", "dest_chain_id", "dst_chain", "dst_chain_id",
         "to_chain", "to_chain_id", "tochain"],
        [("destination", "chain"), ("dest", "chain"), ("dst", "chain"), ("to", "chain")],
    ),
    "chain_fallback": (["source_chain"], [("source", "chain")]),
    "ts": (
        ["destination_timestamp", "destination_block_timestamp", "dest_timestamp", "dest_block_timestamp",
         "dst_timestamp", "dst_block_timestamp", "block_timestamp", "timestamp", "time"],
        [("destination", "timestamp"), ("dest", "timestamp"), ("dst", "timestamp"), ("block", "timestamp")],
    ),
    "id": (
        ["source_tx_hash", "src_tx_hash", "src_hash", "source_hash", "transaction_hash", "tx_hash", "hash"],
        [("src", "hash"), ("source", "hash"), ("tx", "hash")],
    ),
    "src_chain": (["source_chain", "src_chain"], [("source", "chain"), ("src", "chain")]),
    "src_addr": (
        ["source_address", "src_address", "sender", "receiver"],
        [("source", "address"), ("src", "address"), ("sender",), ("receiver",)],
    ),
    "src_tx_hash": (
        ["source_tx_hash", "src_tx_hash", "source_hash", "src_hash"],
        [("source", "hash"), ("src", "hash"), ("tx", "hash")],
    ),
}


class ReceiptColumns(NamedTuple):
    """Column that plays each role, None where there is none."""

    recv: str | None
    chain: str | None
    ts: str | None
    id: str | None
    src_chain: str | None
    src_addr: str | None
    src_tx_hash: str | None

    @property
    def complete(self) -> bool:
        return None not in (self.recv, self.chain, self.ts)


def _slug(name: str) -> str:
    return re.sub("[^a-z0-9]+", "_", name.lower()).strip("_")


def _find(columns: Sequence[str], role: str) -> str | None:
    names, word_groups = ROLE_RULES[role]
    slugs = [(_slug(c), c) for c in columns]
    by_slug = dict(slugs)
    exact = (by_slug[n] for n in names if n in by_slug)
    by_words = (c for slug, c in slugs if any(all(w in slug for w in group) for group in word_groups))
    return next(exact, None) or next(by_words, None)


def detect_receipt_columns(columns: Sequence[str], **overrides: str | None) -> ReceiptColumns:
    """Column for each role; ``recv``, ``chain``, ``ts`` and ``id`` can be set."""
    found = {role: overrides.get(role) or _find(columns, role) for role in ReceiptColumns._fields}
    found["chain"] = found["chain"] or _find(columns, "chain_fallback")
    return ReceiptColumns(**found)


def match_column(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """First candidate present, by exact name or else ignoring case."""
    folded = {c.lower(): c for c in columns}
    hits = (c if c in columns else folded.get(c.lower()) for c in candidates)
    return next((h for h in hits if h), None)


def project_tolerant(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Select ``wanted`` (name -> type); a missing column is a typed NULL."""
    present = set(df.columns)

    def pick(name: str, data_type: str) -> Column:
        value = F.col(name) if name in present else F.lit(None)
        return value.cast(data_type).alias(name)

    return df.select(*[pick(n, t) for n, t in wanted.items()])


def union_promoting(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name. Missing columns are NULL. A column whose types differ
    between the inputs becomes an instant if all of them are times (those
    without a zone are UTC wall clocks), a number if all are numbers, else text."""
    types: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            types.setdefault(field.name, []).append(field.dataType)

    def differ(seen: list[T.DataType]) -> bool:
        return any(t != seen[0] for t in seen)

    def all_are(seen: list[T.DataType], *kinds: type) -> bool:
        return all(isinstance(t, kinds) for t in seen)

    mixed = {name: seen for name, seen in types.items() if differ(seen)}
    times = [name for name, seen in mixed.items() if all_are(seen, T.TimestampType, T.TimestampNTZType, T.DateType)]
    texts = [name for name, seen in mixed.items() if name not in times and not all_are(seen, T.NumericType)]
    out = None
    for frame in frames:
        here = {n: F.col(f"`{n}`").cast("string") for n in texts if n in frame.columns}
        here |= {n: to_utc_ts(F.col(f"`{n}`"), frame.schema[n].dataType) for n in times if n in frame.columns}
        frame = frame.withColumns(here) if here else frame
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out
