"""Host-level quality rules, in DataFrame expressions only.

Every text is measured once (word counts, symbols, repeated lines and repeated
three-word windows). Rule failures are summed per host, the failure rates are
shrunk with a beta prior fitted to all hosts, and the verdict on a host is
joined back to its documents.

Defined cases: a null text counts as empty and so has no words; a null host has
no verdict of its own; repeated rows are judged one by one; an empty table gives
an empty result. The carried columns travel in a struct, so extra columns may
have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopscope.sources.staging import stage

WHITE = "[\\x20\\x09-\\x0D]+"
_TRIM = " \t\n\x0b\f\r"
_SYMBOL = "[#*$%&|<>]"
WINDOW = 3

# Rules whose failures are summed per host.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 5 * n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
}
BASE_RULES = ("short", "repeats")
HOST_LIMIT = 0.75


def split_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_TRIM))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WHITE))


def _neighbour_equal(values: str, key) -> Column:
    """Elements of a sorted array whose key equals that of a neighbour."""
    col = F.col(values)

    def same(item, i):
        one = key(item)
        before, after = key(F.get(col, i - 1)), key(F.get(col, i + 1))
        return F.coalesce(one == before, F.lit(False)) | F.coalesce(one == after, F.lit(False))

    return F.filter(col, same)


def _window_hash(i: Column) -> Column:
    return F.xxhash64(*(F.get(F.col("_words"), i + k) for k in range(WINDOW)))


def measure(df: DataFrame, text: str) -> DataFrame:
    """Add the text measures; helper columns start with ``_`` and are dropped.

    A word is repeated if a three-word window that covers it occurs at least
    twice. The window hashes are sorted as plain longs, their low bits replaced
    by the position; windows whose high bits meet a neighbour's are few and are
    sorted again by the full hash.
    """
    out = df.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumn("_words", split_words(F.col("_t")))
    out = out.withColumn("n_words", F.size("_words").cast("long"))
    out = out.withColumn("_low", F.expr("shiftleft(1L, length(bin(n_words))) - 1L"))
    lines = F.filter(F.split("_t", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    out = out.withColumn("_lines", F.transform(lines, lambda line: F.xxhash64(line)))
    starts = F.slice("_words", F.lit(1), F.greatest(F.col("n_words").cast("int") - (WINDOW - 1), F.lit(0)))
    high = lambda x: x.bitwiseAND(F.bitwise_not(F.col("_low")))
    out = out.withColumn(
        "_windows", F.sort_array(F.transform(starts, lambda _, i: high(_window_hash(i)).bitwiseOR(i.cast("long"))))
    )
    out = out.withColumn("_near", _neighbour_equal("_windows", high))

    def full(packed):
        at = packed.bitwiseAND(F.col("_low")).cast("int")
        return F.struct(_window_hash(at).alias("h"), at.alias("at"))

    out = out.withColumn("_near", F.array_sort(F.transform("_near", full)))
    twice = _neighbour_equal("_near", lambda x: x["h"])
    out = out.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["at"])))
    steps = F.transform(
        "_at", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_at"), i + 1) - x, F.lit(WINDOW)))
    )
    added = {
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count("_t", F.lit(_SYMBOL)).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.aggregate(steps, F.lit(0), lambda total, step: total + step).cast("long"),
    }
    return out.withColumns(added).drop("_t", "_words", "_low", "_lines", "_windows", "_near", "_at")


def host_verdicts(measured: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: documents, shrunk failure rate of each rule, verdict.

    The prior of a rule is a beta distribution with the mean of all documents
    and the spread between hosts that is left after the sampling spread is
    taken off (method of moments for the beta-binomial). A host is rejected if
    a shrunk rate is above ``host_limit``. Only one row of totals reaches the
    driver.
    """
    hosts = stage(
        measured.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), *(F.sum(F.expr(rule).cast("long")).alias(name) for name, rule in RULES.items())),
        "hosts",
    )
    total = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n").alias("n"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        *(F.sum(name).alias(name) for name in RULES),
        *(F.sum(F.col(name).cast("double") * F.col(name) / F.col("n")).alias(f"{name}_sq") for name in RULES),
    ).first()
    rates = {}
    for name in RULES:
        alpha, beta = beta_prior(total["hosts"], total["n"], total["nn"], total[name], total[f"{name}_sq"])
        rates[f"{name}_rate"] = (F.col(name) + F.lit(alpha)) / (F.col("n") + F.lit(alpha + beta))
    failed = F.greatest(*rates.values()) > F.lit(host_limit)
    return hosts.select("host", "n", *(rate.alias(name) for name, rate in rates.items()), failed.alias("host_failed"))


def beta_prior(hosts: int, n: int | None, n_squares: float | None, failures: int | None, rate_squares: float | None):
    """Beta parameters from sums over hosts of n, n*n, failures and failures*failures/n."""
    if not n or not failures or failures == n:
        mean = 0.0 if not n or not failures else 1.0
        return mean + 1e-6, 1.0 - mean + 1e-6
    mean = failures / n
    spread = rate_squares - n * mean * mean
    room = n - n_squares / n
    between = (spread - (hosts - 1) * mean * (1 - mean)) / room if room > 0 else 0.0
    # No spread beyond sampling: every host takes the common rate.
    strength = 1e9 if between <= 0 else max(mean * (1 - mean) / between - 1, 1e-3)
    return mean * strength, (1 - mean) * strength


def judge(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    carry: list[str] | None = None,
    host_limit: float = HOST_LIMIT,
) -> DataFrame:
    """``doc`` (struct of the carried columns), measures, ``base_failed``, ``host_failed``, ``kept``.

    The measured rows are written once, so the text is read and measured once.
    Rejected hosts are joined by Spark's own choice: broadcast while the stored
    table is under the threshold, else a shuffle whose hot hosts are split.
    """
    packed = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in (docs.columns if carry is None else carry))).alias("doc"),
        docs[f"`{text}`"].alias("_text"),
        docs[f"`{host}`"].cast("string").alias("host"),
    )
    measured = stage(measure(packed, "_text").drop("_text"), "measured")
    rejected = stage(
        host_verdicts(measured, host_limit).filter("host_failed").select("host", F.lit(True).alias("host_failed")), "rejected"
    )
    joined = measured.join(rejected, "host", "left")
    base = F.lit(False)
    for name in BASE_RULES:
        base = base | F.expr(RULES[name])
    host_failed = F.coalesce("host_failed", F.lit(False))
    return joined.withColumns(
        {"host_failed": host_failed, "base_failed": base, "kept": ~base & ~host_failed}
    )


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """The documents that pass, with their own columns only."""
    return judge(docs, text, host, None, host_limit).filter("kept").select("doc.*")
