"""Amounts of any size keep all digits; fractions are cut, not rounded."""

import json
import math
import random
import struct
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import hopscope as hs
from hopscope import functions as fn
from hopscope.functions.u256 import whole_number


def values(spark, rows, schema, column):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.v for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def test_json_numbers_are_cut(spark):
    table = {
        "1.0E40": str(10**40), "1.5e30": str(15 * 10**29), "12345678901234567890123456789012.5": "12345678901234567890123456789012",
        "9" * 45 + ".9": "9" * 45, "-1.9": "-1", "-0.9": "0", "0.1e1": "1", "1.25e1": "12", "1.5e-400": "0", "1.5e99999999999": None,
        "1.0e400": None, "1.5e+3": "1500", "1e+5": "100000", "1e-2": "0", "0.00012e4": "1", "7." : None, ".5": None, "1.2.3": None,
        "123456789.123456789e8": "12345678912345678", "0.0": "0", "1.7e308": str(17 * 10**307),
    }
    assert values(spark, list(table), "t string", whole_number(F.col("t"))) == list(table.values())


def test_quotes_decide(spark):
    rows = [("1.5", True), ("1.5", False), ("1e40", True), ("1e40", False), ("1e40", None), ("12", True), (" 7 ", False), ("0x1f", True), ("1e5", True)]
    got = values(spark, rows, "t string, q boolean", fn.u256_parse(F.col("t"), F.col("q")))
    assert got == [None, "1", str(0x1E40), str(10**40), str(10**40), "12", "7", "31", str(0x1E5)]


def test_doubles_keep_all_digits(spark):
    rng = random.Random(2)
    rows = [1e38, 1e40, 1.5e30, 2.0**53, 2.0**63, 2.0**64, -(2.0**200), 1.7976931348623157e308, 0.0, -0.9, 1.9, -1e300, 2.0**1023, 3.0 * 2.0**70, 9007199254740993.0]
    rows += [v for v in (struct.unpack("d", rng.randbytes(8))[0] for _ in range(400)) if math.isfinite(v)]
    assert values(spark, rows, "d double", fn.double_text(F.col("d"))) == [str(int(v)) for v in rows]
    odd = [float("nan"), float("inf"), -float("inf"), None]
    assert values(spark, odd, "d double", fn.double_text(F.col("d"))) == [None] * 4
    assert values(spark, [1e40, float("nan")], "d double", fn.tx_value_text(F.col("d"), T.DoubleType(), False)) == [str(int(1e40)), None]
    assert values(spark, [1e20, 3.9], "d float", fn.tx_value_text(F.col("d"), T.FloatType(), False)) == [str(int(struct.unpack("f", struct.pack("f", 1e20))[0])), "3"]


def test_long_hex(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("0123456789abcdef") for _ in range(n)) for n in (65, 66, 70, 71, 128, 129, 500, 1999, 3500)]
    texts += ["f" * 1000, "1" + "0" * 999, "0" * 100 + "1", "8" + "0" * 139]
    assert values(spark, texts, "t string", fn.u256_from_hex(F.col("t"))) == [str(int(t, 16)) for t in texts]


def test_ten_kilobytes_of_hex_take_seconds(spark):
    text = "0x" + "9f" * 5000
    started = time.time()
    got = values(spark, [text], "t string", fn.u256_from_hex(F.col("t")))[0]
    assert time.time() - started < 60
    number = 0
    for at in range(0, len(got), 1000):  # int() refuses longer texts
        number = number * 10 ** len(got[at : at + 1000]) + int(got[at : at + 1000])
    assert number == int(text, 16)


@pytest.mark.parametrize("given, amount", [
    ("1e40", str(10**40)), ("1.5e30", str(15 * 10**29)), ('"1.5"', "255"), ('"1e2"', str(0x1E2)), ("1.5", "1"), ("9" * 45, "9" * 45), ('"' + "9" * 45 + '"', "9" * 45),
    ("12345678901234567890123456789012.5", "12345678901234567890123456789012"), ("null", "255"), ('"0x10"', "16"),
])
@pytest.mark.parametrize("shape", ['["0xA","0xB",{}]', '{{"from":"0xA","to":"0xB","value":{}}}', '{{"from":"0xA","to":"0xB","amount":{}}}', "“args”"])
def test_amounts_of_transfers(spark, given, amount, shape):
    args = '["0xA","0xB",%s]' % given.replace('"', "”") if shape == "“args”" else shape.format(given)
    row = [("eth", "0x1", 0, "0xT", "Transfer(address,address,uint256)", args, "0xff")]
    events = spark.createDataFrame(row, "chain string, tx_hash string, log_index long, address string, event_signature string, args string, data string")
    got = hs.decode_transfer(hs.normalize_events(events)).first()
    assert (got["from"], got["to"], got["amount"]) == ("0xa", "0xb", amount)


def test_amounts_of_typed_arguments(spark):
    def amount(args, kind):
        row = [("eth", "0x1", 0, "0xT", "Transfer(address,address,uint256)", args, "0xff")]
        events = spark.createDataFrame(row, f"chain string, tx_hash string, log_index long, address string, event_signature string, args {kind}, data string")
        return hs.decode_transfer(hs.normalize_events(events)).first()["amount"]

    assert amount(["0xa", "0xb", "1.5"], "array<string>") == "255"
    assert amount({"from": "0xa", "value": "1.5"}, "map<string,string>") == "255"
    assert amount(("0xa", 1.5), "struct<from:string,value:double>") == "1"
    assert amount(("0xa", "1.5"), "struct<from:string,value:string>") == "255"


def test_native_delta_of_large_doubles(spark):
    tx = spark.createDataFrame([("eth", "0x1", "0xA", "0xB", 1e40, None)], "chain string, transaction_hash string, from_address string, to_address string, value double, block_timestamp timestamp")
    meta = hs.normalize_transactions(tx, keep_value_text=False).select("value", "from_address", "to_address")
    trace = meta.withColumns({"episode_row": F.lit(0), "tx_pos": F.lit(0).cast("long"), "extra_focus": F.array(F.lit("0xb"))})
    got = {(r.addr, r.delta) for r in hs.native_delta(trace).collect()}
    assert got == {("0xa", str(-int(1e40))), ("0xb", str(int(1e40)))}


def test_delta_of_many_tokens_is_linear(spark):
    """500 events of 500 tokens, and equal to the grouped form."""
    from hopscope.operators.trace import net_delta, transfer_legs

    rng = random.Random(4)
    event = "struct<event_name:string,token:string,contract:string,from:string,to:string,amount:string>"

    def rows(n):
        return [(1, 0, "0xa", ["0xb"], [("Transfer", f"0xt{(i * 7) % n}", None, rng.choice(["0xa", "0xb", "0xc"]), rng.choice(["0xa", "0xb"]), str(rng.randrange(10**30))) for i in range(n)])]

    schema = f"episode_row int, tx_pos long, from_address string, extra_focus array<string>, events array<{event}>"
    seconds = {}
    for n in (500, 500, 4000):
        df = spark.createDataFrame(rows(n), schema).coalesce(1)
        started = time.time()
        nested = df.select(net_delta(transfer_legs(F.col("events")), F.array(F.lit("0xa"), F.lit("0xb"))).alias("d")).first().d
        seconds[n] = time.time() - started
        grouped = {}
        for r in hs.transfer_delta(df).collect():
            grouped.setdefault(r.addr, {})[r.token] = r.delta
        assert nested == grouped
    assert seconds[4000] < 20 * max(seconds[500], 0.3)
    tokens = [e[1] for e in rows(5)[0][4]]
    assert json.dumps(tokens) == json.dumps(["0xt0", "0xt2", "0xt4", "0xt1", "0xt3"])


def test_tokens_keep_the_order_of_their_legs(spark):
    from hopscope.operators.trace import net_delta, transfer_legs

    event = "struct<event_name:string,token:string,contract:string,from:string,to:string,amount:string>"
    events = [("Transfer", t, None, "0xa", "0xb", "1") for t in ("0xz", "0xb", "0xz", "0xa")]
    df = spark.createDataFrame([(events,)], f"events array<{event}>")
    got = df.select(F.to_json(net_delta(transfer_legs(F.col("events")), F.array(F.lit("0xa"), F.lit("0xc"))))).first()[0]
    assert got == '{"0xa":{"0xz":"-2","0xb":"-1","0xa":"-1"},"0xc":{}}'
