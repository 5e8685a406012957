"""Decision tables for the column expressions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from hopscope import functions as fn
from hopscope.functions.json_args import bare_integers


def column(spark, values, data_type, expr):
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("x", data_type)])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    return [r.y for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


TEXT = T.StringType()


def check(spark, table, expr, data_type=TEXT):
    assert column(spark, list(table), data_type, expr) == list(table.values())


def test_canonical_chain_text(spark):
    check(
        spark,
        {
            None: None,
            "": None,
            "nan": None,
            " NULL ": None,
            "1": "eth",
            "0042161": "arbitrum",
            "99999": None,
            "Ethereum": "eth",
            "Arbitrum One": "arbitrum",
            "MATIC": "polygon",
            "Zk Sync": "zksync",
            "1.0": "1_0",
            "---": None,
            "unknownchain": "unknownchain",
            "Some New-Chain!": "some_new_chain",
        },
        fn.canonical_chain,
    )


def test_canonical_chain_numbers(spark):
    assert column(spark, [1, 10, 7, None], T.LongType(), lambda c: fn.canonical_chain(c, T.LongType())) == [
        "eth", "optimism", None, None]
    assert column(spark, [1.0, 56.9, float("nan")], T.DoubleType(),
                  lambda c: fn.canonical_chain(c, T.DoubleType())) == ["eth", "bsc", None]


def test_addresses(spark):
    check(spark, {" 0xAB\t": "0xab", "none": None, "": None, "NaN": None, None: None}, fn.normalize_addr)
    word = "0x" + "0" * 24 + "Ab" * 20
    check(spark, {word: "0x" + "ab" * 20, "0x12": None, "ab" * 20: "0x" + "ab" * 20, None: None}, fn.topic_addr)
    check(spark, {"0x12": "0x" + "0" * 62 + "12", "AB" * 20: "0x" + "0" * 24 + "ab" * 20}, fn.topic_addr_padded)


def test_method_id_and_event_name(spark):
    check(spark, {"0xa9059cbb00": "0xa9059cbb", "0x123": None, "a9059cbb00": None, None: None}, fn.method_id)
    check(spark, {"Swap(address)": "Swap", "": None, "(x)": None, "Plain": "Plain"},
          lambda c: fn.event_name(c, F.lit(None).cast("string")))
    check(spark, {
        "0xDDF252AD1BE2C89B69C2B068FC378DAA952BA7F163C4A11628F55A4DF523B3EF": "Transfer",
        "0x8c5be1e5ebec7d5bd14f71427d1e84f3dd0314c0f7b2291e5b200ac8c7c3b925": "Approval",
        "0x00": None,
    }, lambda c: fn.event_name(F.lit(""), c))


U256_MAX = 2**256 - 1


def test_u256_hex(spark):
    rng = random.Random(7)
    table = {
        "0x0": "0", "0xde0b6b3a7640000": str(10**18), "0x8" + "0" * 63: str(2**255),
        "0x" + "f" * 64: str(U256_MAX), "zz": None, "0x": None, "": None, None: None, " 0xFF ": "255",
        "0x" + "0" * 70 + "10": "16", "f" * 16: str(2**64 - 1), "1" + "0" * 16: str(2**64),
        "0x" + "ab" * 64: str(int("ab" * 64, 16)), "0x1" + "0" * 64: str(2**256),
    }
    for bits in (63, 65, 100, 127, 128, 200, 255, 256, 300, 777):
        v = rng.getrandbits(bits)
        table[hex(v)] = str(v)
    check(spark, table, fn.u256_from_hex)


def test_amount_parse(spark):
    check(spark, {
        "10": "10", "-5": "-5", "+007": "7", "-0": "0", "0x10": "16", "ff": "255", "1e5": str(0x1E5), "bad!": None,
        "1.9": "1", "-1.9": "-1", "1.0E21": str(10**21), "1.25E30": str(125 * 10**28), "": None, None: None,
        str(U256_MAX): str(U256_MAX), "1_000": "1000", "9" * 90: "9" * 90,
    }, fn.u256_parse)


def test_tx_value(spark):
    check(spark, {"12": "12", "0x10": "0x10", "1.5": "1.5", None: None}, lambda c: fn.tx_value_text(c, TEXT))
    check(spark, {"12": "12", "0x10": None, "1.5": None}, lambda c: fn.tx_value_text(c, TEXT, keep_text=False))
    dbl = T.DoubleType()
    assert column(spark, [1.9, -1.9, 1e18, float("nan"), None], dbl, lambda c: fn.tx_value_text(c, dbl)) == [
        "1", "-1", str(10**18), None, None]


def test_limbs_round_trip_and_sum(spark):
    rng = random.Random(3)
    rows, expected = [], {}
    for g in range(40):
        total = 0
        for _ in range(rng.randint(1, 40)):
            v = rng.choice([1, -1]) * rng.getrandbits(rng.choice([1, 40, 128, 256]))
            rows.append((g, str(v)))
            total += v
        expected[g] = str(total)
    df = spark.createDataFrame(rows, "g int, v string").select("g", fn.limbs_of(F.col("v")).alias("x"))
    sums = df.groupBy("g").agg(*[F.sum(f"x.{n}").alias(n) for n in ("low", "mid", "top")])
    got = {r.g: r.t for r in sums.select("g", fn.limbs_text(F.col("low"), F.col("mid"), F.col("top")).alias("t")).collect()}
    assert got == expected


def test_to_utc_ts_text(spark):
    def iso(c):
        return fn.ts_iso(fn.to_utc_ts(c, TEXT))

    check(spark, {
        "2025-09-01 10:00:00 UTC": "2025-09-01T10:00:00+00:00",
        "2025-09-01T10:00:00Z": "2025-09-01T10:00:00+00:00",
        "2025-09-01T10:00:00.5+02:00": "2025-09-01T08:00:00.500000+00:00",
        "2025-09-01 10:00:00+0200": "2025-09-01T08:00:00+00:00",
        "2025-09-01": "2025-09-01T00:00:00+00:00",
        "20250901": "2025-09-01T00:00:00+00:00",
        "1700000000": None, "bad": None, "": None, None: None,
    }, iso)


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_time_functions_do_not_depend_on_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        ntz = T.TimestampNTZType()
        assert column(spark, [dt.datetime(2024, 1, 1, 3, 4, 5), dt.datetime(2024, 1, 1, 3, 4, 5, 250)], ntz,
                      lambda c: fn.ts_iso(fn.to_utc_ts(c, ntz))) == [
            "2024-01-01T03:04:05+00:00", "2024-01-01T03:04:05.000250+00:00"]
        check(spark, {"2024-01-01 03:04:05": "2024-01-01T03:00:00+00:00"},
              lambda c: fn.ts_iso(fn.time_bucket(fn.to_utc_ts(c, TEXT), 60)))
        us = T.LongType()
        assert column(spark, [1_700_000_000_000_000_000, None], us, lambda c: fn.ts_iso(fn.to_utc_ts(c, us))) == [
            "2023-11-14T22:13:20+00:00", None]
        assert column(spark, [1_700_000_000], us, lambda c: fn.ts_iso(fn.to_utc_ts(c, us, "s"))) == [
            "2023-11-14T22:13:20+00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_parse_args(spark):
    big = "9" * 77
    check(spark, {
        f'["a",{big},null]': ["a", big, None], '{"b": 1, "a": "x"}': ["1", "x"], "“bad”": [], "[1,2": [], None: [],
        "[“x”, ‘1’]": [], " [“x”,“y”] ": ["x", "y"], "[]": [], '[{"k": 1}, [2]]': ['{"k":1}', "[2]"],
    }, fn.text_list)
    arr = T.ArrayType(TEXT)
    assert column(spark, [["a", "b"], None], arr, lambda c: fn.text_list(c, arr)) == [["a", "b"], []]


def test_parse_actions_and_bare_integers(spark):
    rows = column(spark, ['[{"tx_hash":"0x1","value":99999999999999999999999999},{"chain":"eth"}]', "[bad", '{"a":1}',
                          "", None], TEXT, fn.parse_actions)
    assert [len(r) for r in rows] == [2, 0, 0, 0, 0]
    assert rows[0][0]["value"] == "99999999999999999999999999" and rows[0][1]["chain"] == "eth"
    check(spark, {'{"value":"12","note":"\\"value\\":\\"3\\"","amount":"x"}':
                  '{"value":12,"note":"\\"value\\":\\"3\\"","amount":"x"}'}, lambda c: bare_integers(c, "value", "amount"))
