"""Exact 256-bit integers on built-in types.

Spark's widest number has 38 digits and a uint256 needs 78, so amounts travel
as canonical decimal text. For arithmetic a text is cut into three decimal
limbs (34 + 26 + 26 digits); limbs are summed like any other column and the sum
is rendered back to text. Nothing here is a UDF.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F, types as T

from .scalars import _without_0x, let, strip

LIMB_DIGITS = 26
TOP_DIGITS = 34
_BASE = 10**LIMB_DIGITS
_WIDE = "decimal(38,0)"

LIMBS = T.StructType([T.StructField(n, T.DecimalType(38, 0)) for n in ("low", "mid", "top")])


def _dec(value: int) -> Column:
    return F.lit(Decimal(value)).cast(_WIDE)


def int_text(col: Column) -> Column:
    """Canonical text of a whole decimal number, NULL if it is not one."""
    text = strip(col)
    bare = F.regexp_replace(F.regexp_replace(text, "[+_]", ""), "^(-?)0+(?=[0-9])", "$1")
    return F.when(text.rlike("^(0|[1-9][0-9]*)$"), text).when(
        text.rlike("^[+-]?[0-9]+(_[0-9]+)*$"), F.when(bare == "-0", F.lit("0")).otherwise(bare)
    )


def _carry(low: Column, mid: Column, top: Column) -> Column:
    """Bring low and mid into [0, 10^26); top keeps the rest and the sign."""
    base = _dec(_BASE)

    def spill(x: Column) -> Column:
        return F.call_function("div", x - F.pmod(x, base), base).cast(_WIDE)

    first = F.struct(
        F.pmod(low, base).cast(_WIDE).alias("low"), (mid + spill(low)).cast(_WIDE).alias("mid"), top.alias("top")
    )
    return let(
        first,
        lambda s: F.struct(
            s["low"].alias("low"),
            F.pmod(s["mid"], base).cast(_WIDE).alias("mid"),
            (s["top"] + spill(s["mid"])).cast(_WIDE).alias("top"),
        ),
    )


def _render(limbs: Column) -> Column:
    """Decimal text of non-negative, carried limbs."""
    digits = F.concat(
        limbs["top"].cast("string"),
        F.lpad(limbs["mid"].cast("string"), LIMB_DIGITS, "0"),
        F.lpad(limbs["low"].cast("string"), LIMB_DIGITS, "0"),
    )
    return F.regexp_replace(digits, "^0+(?=[0-9])", "")


def limbs_text(low: Column, mid: Column, top: Column) -> Column:
    """Decimal text of (possibly negative) limb sums."""
    sums = F.struct(low.cast(_WIDE).alias("low"), mid.cast(_WIDE).alias("mid"), top.cast(_WIDE).alias("top"))

    def body(s: Column) -> Column:
        up = _carry(s["low"], s["mid"], s["top"])
        down = _carry(-s["low"], -s["mid"], -s["top"])
        return let(
            up,
            lambda u: F.when(u["top"] >= 0, _render(u)).otherwise(F.concat(F.lit("-"), let(down, _render))),
        )

    return F.when((mid == 0) & (top == 0), low.cast(_WIDE).cast("string")).otherwise(let(sums, body))


MAX_DIGITS = TOP_DIGITS + 2 * LIMB_DIGITS


def limbs_of(text: Column, sign: Column | None = None) -> Column:
    """Signed limbs of canonical decimal text; NULL beyond 86 digits.

    Up to 25 characters, which is nearly every amount, fit the low limb.
    """
    digits = F.regexp_replace(text, "^-", "")
    padded = F.when(F.length(digits) <= MAX_DIGITS, F.lpad(digits, MAX_DIGITS, "0"))
    minus = F.startswith(text, F.lit("-"))
    if sign is not None:
        minus = minus != (sign < 0)

    def signed(value: Column, negative: Column | None) -> Column:
        wide = value.cast(_WIDE)
        return wide if negative is None else F.when(negative, -wide).otherwise(wide).cast(_WIDE)

    def limbs(low: Column, mid: Column, top: Column) -> Column:
        return F.named_struct(F.lit("low"), low, F.lit("mid"), mid, F.lit("top"), top)

    def long_form(all_digits: Column) -> Column:
        part = lambda start, length: signed(F.substring(all_digits, start, length), minus)
        return limbs(
            part(TOP_DIGITS + LIMB_DIGITS + 1, LIMB_DIGITS), part(TOP_DIGITS + 1, LIMB_DIGITS), part(1, TOP_DIGITS)
        )

    zero = F.lit(0).cast(_WIDE)
    short = limbs(signed(text, None if sign is None else sign < 0), zero, zero)
    return F.when(F.length(text) < LIMB_DIGITS, short).otherwise(let(padded, long_form))


def signed_text(text: Column, sign: Column) -> Column:
    """Canonical text times a sign of 1 or -1."""
    flipped = F.when(F.startswith(text, F.lit("-")), F.substring(text, 2, 1 << 30)).otherwise(F.concat(F.lit("-"), text))
    return F.when((sign < 0) & (text != "0"), flipped).otherwise(text)


def long_sum_text(texts: Column) -> Column:
    """Exact sum of an array of canonical texts of any length, as text.

    For the rare numbers beyond 86 digits: limbs of 26 digits in arrays, the
    least first, are added place by place and carried once.
    """
    zero, base = F.lit(0).cast(_WIDE), _dec(_BASE)

    def limbs(text: Column) -> Column:
        minus = F.startswith(text, F.lit("-"))
        digits = F.regexp_replace(text, "^-", "")
        n = F.ceil(F.length(digits) / LIMB_DIGITS).cast("int")
        padded = F.lpad(digits, n * LIMB_DIGITS, F.lit("0"))

        def limb(i: Column) -> Column:
            part = F.substr(padded, (n - 1 - i) * LIMB_DIGITS + 1, F.lit(LIMB_DIGITS)).cast(_WIDE)
            return F.when(minus, -part).otherwise(part).cast(_WIDE)

        return F.transform(F.sequence(F.lit(0), n - 1), limb)

    def add(a: Column, b: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: (F.coalesce(x, zero) + F.coalesce(y, zero)).cast(_WIDE))

    def carried(sums: Column) -> Column:
        start = F.struct(zero.alias("carry"), F.array().cast(f"array<{_WIDE}>").alias("out"))

        def step(acc: Column, value: Column) -> Column:
            return let(
                (value + acc["carry"]).cast(_WIDE),
                lambda v: F.struct(
                    F.call_function("div", v - F.pmod(v, base), base).cast(_WIDE).alias("carry"),
                    F.concat(acc["out"], F.array(F.pmod(v, base).cast(_WIDE))).alias("out"),
                ),
            )

        return F.aggregate(sums, start, step)

    def render(c: Column) -> Column:
        rest = F.transform(F.reverse(c["out"]), lambda x: F.lpad(x.cast("string"), LIMB_DIGITS, "0"))
        return F.regexp_replace(F.concat(c["carry"].cast("string"), F.array_join(rest, "")), "^0+(?=[0-9])", "")

    total = F.aggregate(F.transform(texts, limbs), F.array().cast(f"array<{_WIDE}>"), add)

    def body(sums: Column) -> Column:
        down = carried(F.transform(sums, lambda x: (-x).cast(_WIDE)))
        return let(
            carried(sums),
            lambda up: F.when(up["carry"] >= 0, render(up)).otherwise(F.concat(F.lit("-"), let(down, render))),
        )

    return let(total, body)


def _hex_word_sum(digits: Column) -> Column:
    """Up to 64 hex digits: eight 32-bit words times constant limb weights."""
    padded = F.lpad(digits, 64, "0")
    sums = [None, None, None]
    for i in range(8):
        word = F.conv(F.substring(padded, 1 + 8 * i, 8), 16, 10).cast("decimal(10,0)")
        weight = 1 << (32 * (7 - i))
        for k in range(3):
            part = weight // _BASE**k % _BASE
            if part:
                term = (word * F.lit(Decimal(part)).cast("decimal(26,0)")).cast(_WIDE)
                sums[k] = term if sums[k] is None else (sums[k] + term).cast(_WIDE)
    raw = F.struct(sums[0].alias("low"), sums[1].alias("mid"), sums[2].alias("top"))
    return let(let(raw, lambda s: _carry(s["low"], s["mid"], s["top"])), _render)


def _hex_any_length(digits: Column) -> Column:
    """Hex text of any length: seven digits at a time enter limbs of ten decimal digits.

    The carries of a step are passed on together in the next one, so a step
    copies the limbs twice and no more; one last pass settles them.
    """
    base, factor = F.lit(10**10).cast("long"), F.lit(16**7).cast("long")
    zero = F.array(F.lit(0).cast("long"))
    size = F.ceil(F.length(digits) / 7).cast("int")
    padded = F.lpad(digits, size * 7, F.lit("0"))
    chunks = F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.conv(F.substr(padded, i * 7 + 1, F.lit(7)), 16, 10).cast("long"),
    )

    def step(limbs: Column, chunk: Column) -> Column:
        # A limb is below 10^10 + 16^7, so its product stays below 2^63.
        products = F.transform(limbs, lambda x: x * factor)
        carries = F.concat(F.array(chunk), F.transform(products, lambda x: F.call_function("div", x, base)))
        return let(
            F.zip_with(F.concat(F.transform(products, lambda x: F.pmod(x, base)), zero), carries, lambda x, y: x + y),
            lambda out: F.when(F.element_at(out, -1) == 0, F.slice(out, 1, F.size(out) - 1)).otherwise(out),
        )

    limbs = F.aggregate(chunks, F.array().cast("array<bigint>"), step)
    settled = F.aggregate(
        limbs,
        F.struct(F.lit(0).cast("long").alias("carry"), F.lit("").alias("text")),
        lambda acc, x: let(
            x + acc["carry"],
            lambda v: F.struct(
                F.call_function("div", v, base).alias("carry"),
                F.concat(F.lpad(F.pmod(v, base).cast("string"), 10, "0"), acc["text"]).alias("text"),
            ),
        ),
        lambda acc: F.concat(acc["carry"].cast("string"), acc["text"]),
    )
    return F.regexp_replace(settled, "^0+(?=[0-9])", "")


def hex_digits(col: Column) -> Column:
    """Bare lower-case hex digits without leading zeros, NULL if not hex."""
    digits = _without_0x(F.lower(strip(col)))
    return F.when(digits.rlike("^[0-9a-f]+$"), F.regexp_replace(digits, "^0+(?=[0-9a-f])", ""))


def hex_value(digits: Column) -> Column:
    """Decimal text of ``hex_digits``.

    Values below 2^64 (nearly all token amounts) take the cheap first branch.
    """
    return (
        F.when(F.length(digits) <= 16, F.conv(digits, 16, 10))
        .when(F.length(digits) <= 64, _hex_word_sum(digits))
        .otherwise(_hex_any_length(digits))
    )


def u256_from_hex(col: Column) -> Column:
    """Decimal text of hex text, with or without 0x; NULL if it is not hex."""
    return let(hex_digits(col), hex_value)


_POINT = r"^-?[0-9]+\.[0-9]+([eE][+-]?[0-9]+)?$"
# A number without a point is hex text as well, unless its exponent has a sign.
_SIGNED_EXPONENT = r"^-?[0-9]+[eE][+-][0-9]+$"
_EXPONENT = r"^-?[0-9]+[eE][0-9]+$"


def _shifted(text: Column) -> Column:
    """Whole part of a decimal number with a point or an exponent, by moving its digits.

    NULL where the number exceeds every double, which is no number in JSON readers.
    """
    parts = F.struct(
        F.regexp_extract(text, "^-?([0-9]+)", 1).alias("whole"),
        F.regexp_extract(text, r"\.([0-9]+)", 1).alias("rest"),
        F.regexp_extract(text, "[eE]([+-]?[0-9]+)$", 1).alias("exponent"),
        text.try_cast("double").alias("value"),
    )

    def body(p: Column) -> Column:
        digits = F.concat(p["whole"], p["rest"])
        point = F.length(p["whole"]) + F.when(p["exponent"] == "", F.lit(0)).otherwise(p["exponent"].try_cast("int"))
        moved = F.when(point <= 0, F.lit("0")).otherwise(F.rpad(F.substring(digits, F.lit(1), point), point, F.lit("0")))
        # Beyond these the exponent is out of range of any number but zero.
        settled = F.when(p["value"] == 0, F.lit("0")).when(F.abs(p["value"]) < float("inf"), moved)
        bare = F.regexp_replace(settled, "^0+(?=[0-9])", "")
        return F.when(F.startswith(text, F.lit("-")) & (bare != "0"), F.concat(F.lit("-"), bare)).otherwise(bare)

    return let(parts, body)


def _fraction_text(text: Column, quoted: Column | None) -> Column:
    """Whole part of a JSON number with a fraction or an exponent."""
    number = text.rlike(_POINT) | text.rlike(_SIGNED_EXPONENT)
    if quoted is not None:
        number = (number | text.rlike(_EXPONENT)) & ~F.coalesce(quoted, F.lit(False))
    return F.when(number, _shifted(text))


def whole_number(col: Column, quoted: Column | None = None) -> Column:
    """Decimal text, or a JSON fraction cut off; NULL for anything else.

    ``quoted`` tells text in quotes, which is no number where it has a fraction
    or an exponent. Where that isn't known, a fraction is taken for a number
    and ``1e5`` for hex text.
    """
    return F.coalesce(int_text(col), _fraction_text(strip(col), quoted))


def u256_parse(col: Column, quoted: Column | None = None) -> Column:
    """Amount given as decimal text, a JSON number (fraction cut off) or hex text."""
    return F.coalesce(whole_number(col, quoted), u256_from_hex(col))


def double_text(col: Column) -> Column:
    """Whole part of a double, all digits exact; NULL for NaN and the infinities.

    From 2^53 on a double is a whole number of at most 53 bits times a power of
    two: the bits become hex digits and the power zeros behind them.
    """
    value = col.cast("double")
    size = F.abs(value)
    small = F.when(value >= 0, F.floor(value)).otherwise(F.ceil(value)).cast("string")

    def large(shift: Column) -> Column:
        # Powers of two scale exactly, and the result is below 2^57.
        bits = (size * F.pow(F.lit(2.0), -shift)).cast("long")
        odd = F.pmod(shift, F.lit(4)).cast("int")
        digits = F.concat(F.lower(F.hex(F.call_function("shiftleft", bits, odd))), F.repeat(F.lit("0"), ((shift - odd) / 4).cast("int")))
        text = hex_value(digits)
        return F.when(value < 0, F.concat(F.lit("-"), text)).otherwise(text)

    shift = (F.floor(F.log2(size)) - 55).cast("int")
    exact = F.when(size < 2.0**53, small).when(size < 2.0**63, value.cast("long").cast("string")).otherwise(let(shift, large))
    return F.when(size < float("inf"), exact)


def tx_value_text(col: Column, data_type: T.DataType, keep_text: bool = True) -> Column:
    """Native value as whole-number text.

    Text that is no whole number is kept as it is for episodes and dropped for
    traces (``keep_text=False``).
    """
    if isinstance(data_type, T.IntegralType):
        return col.cast("string")
    if isinstance(data_type, T.DecimalType):
        return int_text(F.regexp_replace(col.cast("string"), r"\..*$", ""))
    if isinstance(data_type, T.NumericType):
        whole = double_text(col)
        text = F.coalesce(whole, col.cast("string")) if keep_text else whole
        return F.when(~F.isnan(col), text)
    text = col.cast("string")
    return F.coalesce(int_text(text), text) if keep_text else int_text(text)
