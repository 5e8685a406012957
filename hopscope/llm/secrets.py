"""Multipart credential linking, in DataFrame expressions only.

Three strong patterns (assignment, access identifier, long hex) are always
reported. Weak parts (bare mixed tokens, account names, endpoints) are reported
only if a complementary part stands within ``reach`` code points in the same
scope, a block of text without an empty line:

* ``weak``: an identifier (access or account) nearby
* ``account``: a secret (assign, hex or weak) nearby
* ``endpoint``: both an identifier and a secret nearby

Spans are code points, end exclusive, whole match. Defined cases: a null text
counts as empty; repeated rows get the same spans each; a weak part that
overlaps a strong span is not reported again; an empty table gives an empty
result. Carried columns travel in a struct, so extra columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopscope.sources.staging import stage

KINDS = ("assign", "access", "hex", "weak", "account", "endpoint")
STRONG = KINDS[:3]
ASSIGN = "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
# "{k,}" finds the same runs as "+" with shorter ones dropped.
PATTERNS = {
    "assign": ASSIGN,
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    "weak": "(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])(?=[0-9+/_=-]*+[A-Za-z])[A-Za-z0-9+/_=-]{16,}",
    "account": "(?i)\\b(?:user(?:_?name)?|login|account|client_?id)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9@._-]{3,}",
    "endpoint": "(?i)\\b(?:https?|ftp|s3a?|postgres(?:ql)?|mysql|redis|mongodb|amqp)://[^\\x20\\x09-\\x0D\"'<>]+",
}
IDENTIFIERS = ("access", "account")
SECRETS = ("assign", "hex", "weak")
BREAK = "\\n[\\x20\\x09\\x0B-\\x0D]*\\n"
REACH = 300
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"
MARK = "[SECRET]"

_CHUNK = 256


def _running_sums(lengths: str) -> Column:
    """Inclusive running sums of an int array, in steps of chunks, so that a very long array stays cheap."""
    col = F.col(lengths)
    add = lambda a, b: a + b
    total = lambda x: F.aggregate(x, F.lit(0), add)
    chunks = F.sequence(F.lit(0), F.floor((F.size(col) - 1) / _CHUNK).cast("int"))
    sums = F.transform(chunks, lambda c: total(F.slice(col, c * _CHUNK + 1, F.lit(_CHUNK))))
    base = F.transform(sums, lambda _, c: total(F.slice(sums, F.lit(1), c)))
    inside = lambda i: total(F.slice(col, F.floor(i / _CHUNK).cast("int") * _CHUNK + 1, i % _CHUNK + 1))
    return F.transform(col, lambda _, i: F.get(base, F.floor(i / _CHUNK).cast("int")) + inside(i))


def _with_spans(df: DataFrame, text: str, kind: str, pattern: str, out: str) -> DataFrame:
    """Add ``out``: the spans of a pattern, leftmost and non-overlapping.

    The text between the matches and the matches themselves alternate, so
    running sums of their lengths are the positions.
    """
    t, none = F.col(text), F.array().cast("array<string>")
    df = df.withColumn("_hit", F.regexp_extract_all(t, F.lit(pattern), F.lit(0)))
    df = df.withColumn("_gap", F.when(F.size("_hit") > 0, F.split(t, pattern, -1)).otherwise(none))
    value = (
        F.when(F.size("_hit") > 0, F.regexp_extract_all(t, F.lit(pattern), F.lit(2))).otherwise(none)
        if kind == "assign"
        else F.col("_hit")
    )
    df = df.withColumn("_value", value)
    df = df.withColumn("_step", F.transform("_hit", lambda x, i: F.length(F.get(F.col("_gap"), i)) + F.length(x)))
    df = df.withColumn("_ends", F.when(F.size("_hit") > 0, _running_sums("_step")).otherwise(F.array().cast("array<int>")))
    spans = F.transform(
        "_hit",
        lambda x, i: F.struct(
            (F.get(F.col("_ends"), i) - F.length(x)).alias("start"),
            F.lit(KINDS.index(kind) if kind in KINDS else -1).alias("rank"),
            F.lit(kind).alias("kind"),
            F.get(F.col("_ends"), i).alias("end"),
        ),
    )
    if kind == "assign":
        df = df.withColumn(
            "_long", F.filter(F.arrays_zip(spans.alias("s"), F.col("_value").alias("v")), lambda z: F.length(z["v"]) >= 6)
        )
        spans = F.transform("_long", lambda z: z["s"])
    return df.withColumn(out, spans.cast(SPAN)).drop("_hit", "_gap", "_value", "_step", "_ends", "_long")


def span_text(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def find_parts(packed: DataFrame, text: str) -> DataFrame:
    """Add ``base`` (strong spans, sorted), ``loose`` (weak ones, not overlapping ``base``) and ``breaks``."""
    df = packed.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    for kind in KINDS:
        df = _with_spans(df, "_t", kind, PATTERNS[kind], f"_{kind}")
    df = df.withColumn("base", F.array_sort(F.concat(*(F.col(f"_{k}") for k in STRONG))))
    clear = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    df = df.withColumn("_soft", F.concat(*(F.col(f"_{k}") for k in KINDS[3:])))
    df = df.withColumn("loose", F.when(F.size("_soft") > 0, F.filter("_soft", clear)).otherwise(F.col("_soft")))
    df = df.withColumn("_for_breaks", F.when(F.size("loose") > 0, F.col("_t")).otherwise(F.lit("")))
    df = _with_spans(df, "_for_breaks", "break", BREAK, "_breaks")
    df = df.withColumn("breaks", F.transform("_breaks", lambda b: b["start"]))
    return df.drop("_t", "_soft", "_for_breaks", "_breaks", *(f"_{k}" for k in KINDS))


def link_parts(found: DataFrame, reach: int = REACH) -> DataFrame:
    """(row key, linked spans) of documents that have weak parts with complements.

    Interval join: parts are bucketed by position in steps of ``reach``, a long
    part in each bucket it touches. One row per (document, scope, bucket) keeps
    the outermost ends of each role, which decides any neighbour exactly, so a
    part meets the buckets it touches and one on either side, however many parts
    a document has.
    """
    parts = found.filter(F.size("loose") > 0).select(
        "row_id", "row_hash", "breaks", F.explode(F.concat("base", "loose")).alias("s")
    )
    parts = parts.select(
        "row_id",
        "row_hash",
        F.size(F.filter("breaks", lambda b: b < F.col("s")["start"])).alias("scope"),
        "s",
    ).distinct()
    kind, start, end = F.col("s")["kind"], F.col("s")["start"], F.col("s")["end"]
    ident, secret = kind.isin(*IDENTIFIERS), kind.isin(*SECRETS)
    touched = lambda more: F.explode(F.sequence(F.floor(start / reach) - more, F.floor(end / reach) + more))
    roles = parts.filter(ident | secret).withColumn("bucket", touched(0)).groupBy("row_id", "row_hash", "scope", "bucket").agg(
        F.min(F.when(ident, start)).alias("id_first"),
        F.max(F.when(ident, end)).alias("id_last"),
        F.min(F.when(secret, start)).alias("secret_first"),
        F.max(F.when(secret, end)).alias("secret_last"),
    )
    wanted = parts.filter(kind.isin(*KINDS[3:])).withColumn("near", touched(1))
    meets = wanted.alias("w").join(
        roles.alias("r"),
        F.col("w.row_id").eqNullSafe(F.col("r.row_id"))
        & (F.col("w.row_hash") == F.col("r.row_hash"))
        & (F.col("w.scope") == F.col("r.scope"))
        & (F.col("w.near") == F.col("r.bucket")),
    )
    start, end, kind = F.col("w.s.start"), F.col("w.s.end"), F.col("w.s.kind")
    close = lambda role: (F.col(f"r.{role}_first") <= end + reach) & (F.col(f"r.{role}_last") >= start - reach)
    meets = meets.groupBy("w.row_id", "w.row_hash", "w.s").agg(
        F.coalesce(F.max(close("id")), F.lit(False)).alias("id"),
        F.coalesce(F.max(close("secret")), F.lit(False)).alias("secret"),
    )
    kind = F.col("s")["kind"]
    linked = (
        ((kind == "weak") & F.col("id"))
        | ((kind == "account") & F.col("secret"))
        | ((kind == "endpoint") & F.col("id") & F.col("secret"))
    )
    return meets.filter(linked).groupBy("row_id", "row_hash").agg(F.array_sort(F.collect_set("s")).alias("linked"))


def find_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id", carry: list[str] | None = None, reach: int = REACH):
    """``doc`` (struct of carried columns), ``base`` and ``spans`` (arrays of start, rank, kind, end)."""
    packed = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in (docs.columns if carry is None else carry))).alias("doc"),
        docs[f"`{text}`"].alias("_text"),
        docs[f"`{key}`"].cast("string").alias("row_id"),
        F.xxhash64(docs[f"`{text}`"]).alias("row_hash"),
    )
    found = stage(find_parts(packed, "_text").drop("_text"), "parts")
    plain = found.filter(F.size("loose") == 0).select("doc", "base", F.col("base").alias("spans"))
    open_ = found.filter(F.size("loose") > 0).alias("f")
    linked = link_parts(found, reach).alias("l")
    on = F.col("f.row_id").eqNullSafe(F.col("l.row_id")) & (F.col("f.row_hash") == F.col("l.row_hash"))
    joined = open_.join(linked, on, "left").select(
        "f.doc",
        "f.base",
        F.array_sort(F.concat("f.base", F.coalesce("l.linked", F.array().cast(SPAN)))).alias("spans"),
    )
    return plain.unionByName(joined)


def redact(docs: DataFrame, text: str = "text", key: str = "doc_id", mark: str = MARK, reach: int = REACH) -> DataFrame:
    """The documents with every reported span replaced by ``mark``; ``n_chars``, if there, follows the text."""
    found = find_secrets(docs, text, key, None, reach)
    t = F.col("doc")[text]
    spans = F.col("spans")
    before = lambda i: F.coalesce(F.array_max(F.transform(F.slice(spans, F.lit(1), i), lambda s: s["end"])), F.lit(0))

    def piece(s, i):
        done = before(i)
        return F.when(s["start"] >= done, F.concat(F.substring(t, done + 1, s["start"] - done), F.lit(mark))).otherwise("")

    tail = F.substring(t, F.array_max(F.transform(spans, lambda s: s["end"])) + 1, F.length(t))
    clean = F.when(F.size(spans) == 0, t).otherwise(F.concat(F.array_join(F.transform(spans, piece), ""), tail))
    out = found.select(*(clean.alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(F.col(text)).cast(docs.schema["n_chars"].dataType))
    return out
