"""Reading event arguments, topics and stored action lists out of JSON text.

Values are read as text on purpose: token amounts exceed every numeric type a
JSON reader would pick.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .scalars import let, strip

TEXT_LIST = "array<string>"
TEXT_MAP = "map<string,string>"
_STRICT = {"allowSingleQuotes": "false"}

# Typographic quotes and the plain ones they stand for.
_FANCY_QUOTES = "“”’‘"
_PLAIN_QUOTES = "\"\"''"

EVENT_FIELDS = [
    ("ts", "string"),
    ("tx_hash", "string"),
    ("log_index", "bigint"),
    ("contract", "string"),
    ("event_name", "string"),
    ("event_signature", "string"),
    ("args_preview", TEXT_LIST),
    ("topics_preview", TEXT_LIST),
    ("token", "string"),
    ("from", "string"),
    ("to", "string"),
    ("owner", "string"),
    ("spender", "string"),
    ("amount", "string"),
]
EVENT_TYPE = "struct<" + ",".join(f"`{n}`:{t}" for n, t in EVENT_FIELDS) + ">"

ACTION_FIELDS = [
    ("ts", "string"),
    ("tx_hash", "string"),
    ("to", "string"),
    ("value", "string"),
    ("method_id", "string"),
    ("chain", "string"),
    ("phase", "string"),
]
_ACTION_COLUMNS = ",".join(f"`{n}`:{t}" for n, t in ACTION_FIELDS)
ACTION_TYPE = f"struct<{_ACTION_COLUMNS},`events`:array<{EVENT_TYPE}>>"
# Stored lists may name the hash either way; log_index is read as text because
# a writer may have stored it as a fraction.
_STORED_EVENT = EVENT_TYPE.replace("`log_index`:bigint", "`log_index`:string")
_STORED_ACTION = f"struct<{_ACTION_COLUMNS},`transaction_hash`:string,`events`:array<{_STORED_EVENT}>>"


def clean_json(col: Column) -> Column:
    """Stripped text with plain quotes."""
    text = strip(col)
    return F.when(text.rlike(f"[{_FANCY_QUOTES}]"), F.translate(text, _FANCY_QUOTES, _PLAIN_QUOTES)).otherwise(text)


def _parse_text(text: Column) -> Column:
    def between(opening: str, closing: str) -> Column:
        return F.startswith(text, F.lit(opening)) & F.endswith(text, F.lit(closing))

    return F.struct(
        F.when(between("[", "]"), F.from_json(text, TEXT_LIST, _STRICT)).alias("items"),
        F.when(between("{", "}"), F.from_json(text, TEXT_MAP, _STRICT)).alias("fields"),
    )


def parse_args(col: Column, data_type: T.DataType | None = None) -> Column:
    """``struct<items: array<string>, fields: map<string,string>>``.

    Exactly one field is set for a readable list or object; both are NULL
    otherwise. Typed arrays, maps and structs are accepted besides text.
    """
    if isinstance(data_type, T.ArrayType):
        items, fields = col.cast(TEXT_LIST), F.lit(None).cast(TEXT_MAP)
    elif isinstance(data_type, T.MapType):
        items, fields = F.lit(None).cast(TEXT_LIST), col.cast(TEXT_MAP)
    elif isinstance(data_type, T.StructType):
        items, fields = F.lit(None).cast(TEXT_LIST), F.from_json(F.to_json(col), TEXT_MAP)
    else:
        return let(clean_json(col), _parse_text)
    return F.struct(items.alias("items"), fields.alias("fields"))


def as_list(args: Column) -> Column:
    """Items of a parsed list, values of a parsed object in order, else empty."""
    empty = F.array().cast(TEXT_LIST)
    return let(args, lambda a: F.coalesce(a["items"], F.map_values(a["fields"]), empty))


def text_list(col: Column, data_type: T.DataType | None = None) -> Column:
    """List-like column as ``array<string>``; unreadable text is an empty list."""
    return as_list(parse_args(col, data_type))


def preview(items: Column, size: int) -> Column:
    """First ``size`` items as text, NULL when there are none."""
    return F.when(F.size(items) > 0, F.transform(F.slice(items, 1, size), lambda x: F.coalesce(x, F.lit("None"))))


def parse_actions(col: Column, data_type: T.DataType | None = None) -> Column:
    """Stored episode actions as a typed array; bad or missing text is empty."""
    if isinstance(data_type, T.ArrayType):
        return F.coalesce(col, F.array())
    text = strip(col)
    parsed = F.when(F.startswith(text, F.lit("[")), F.from_json(text, f"array<{_STORED_ACTION}>", _STRICT))
    return F.coalesce(parsed, F.array().cast(f"array<{_STORED_ACTION}>"))


def bare_integers(json: Column, *keys: str) -> Column:
    """Drop the quotes round whole numbers stored under ``keys``.

    Quotes inside JSON strings are escaped, so the pattern cannot match there.
    """
    names = "|".join(keys)
    return F.regexp_replace(json, f'"({names})":"(-?[0-9]+)"', '"$1":$2')
