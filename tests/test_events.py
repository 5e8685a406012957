"""Decision tables for event decoding."""

from pyspark.sql import functions as F

import hopscope as hs
from hopscope.functions.scalars import APPROVAL_TOPIC, TRANSFER_TOPIC

A, B = "0x" + "a" * 40, "0x" + "b" * 40
TOPIC_A, TOPIC_B = "0x" + "0" * 24 + "A" * 40, "0x" + "0" * 24 + "b" * 40
FIELDS = ("event_signature", "event_hash", "topics", "args", "args_json", "data")
TRANSFER = "Transfer(address,address,uint256)"
APPROVAL = "Approval(address,address,uint256)"


def decode(spark, *events):
    rows = [("eth", f"0xH{i}", i, "0xToken", *[e.get(f) for f in FIELDS]) for i, e in enumerate(events)]
    schema = "chain string, transaction_hash string, log_index int, address string, " + ", ".join(
        f"{f} string" for f in FIELDS)
    df = spark.createDataFrame(rows, schema).withColumn("block_timestamp", F.timestamp_micros(F.lit(10**15)))
    return hs.decode_events(hs.normalize_events(df)).orderBy("log_index").collect()


def test_transfer_encodings(spark):
    topics = f'["{TRANSFER_TOPIC}","{TOPIC_A}","{TOPIC_B}"]'
    cases = [
        (dict(args_json=f'["{A.upper()}"," {B} ",10]'), (A, B, "10")),
        (dict(args_json=f'{{"from":"{A}","to":"{B}","value":"0x10"}}'), (A, B, "16")),
        (dict(args_json=f'{{"src":"{A}","dst":"{B}","amount":7}}'), (A, B, "7")),
        (dict(args_json=f'{{"from":"","sender":"{A}","recipient":"{B}","value":null,"amount":7}}'), (A, B, None)),
        (dict(topics=topics, data="0x" + "f" * 64), (A, B, str(2**256 - 1))),
        (dict(args=f"[“{A}”,“{B}”,“5”]"), (A, B, "5")),
        (dict(args_json="[1,2", args=f'["{A}","{B}",6]'), (A, B, "6")),
        (dict(args_json=f'["{A}","{B}"', topics=topics, data="0x"), (A, B, None)),
        (dict(args_json=f'["{A}","{B}"]', data="0x05"), (None, None, "5")),
        (dict(args_json=f'["none","{B}","bad!"]', topics=topics, data="0x02"), (A, B, "2")),
        (dict(args_json=f'["{A}","{B}",1.5]'), (A, B, "1")),
        (dict(args_json=f'["{A}","{B}",1e21]'), (A, B, str(10**21))),
        (dict(), (None, None, None)),
    ]
    got = decode(spark, *[{"event_signature": TRANSFER, **e} for e, _ in cases])
    assert [(r["from"], r["to"], r.amount) for r in got] == [want for _, want in cases]
    assert {r.token for r in got} == {"0xtoken"} and all(r.owner is None and r.event_signature is None for r in got)
    assert got[0].tx_hash == "0xh0" and got[0].ts == "2001-09-09T01:46:40+00:00"


def test_approval_and_others(spark):
    got = decode(
        spark,
        dict(event_signature=APPROVAL, args_json=f'["{A}","{B}",3]'),
        dict(event_signature=APPROVAL, args_json=f'{{"owner":"{A}","spender":"{B}","value":4}}'),
        dict(event_hash=APPROVAL_TOPIC.upper().replace("0X", "0x"), topics=f'["x","{TOPIC_A}","{TOPIC_B}"]', data="0xff"),
        dict(topics=f'["{TRANSFER_TOPIC}"]'),
        dict(event_hash="0x00", topics=f'["{TRANSFER_TOPIC}"]'),
        dict(event_signature="Swap(uint256)", args_json="[1,2,3,4,5,6,7,8]", topics='["1","2","3","4","5"]'),
    )
    assert [(r.owner, r.spender, r.amount) for r in got[:3]] == [(A, B, "3"), (A, B, "4"), (A, B, "255")]
    assert [r.event_name for r in got] == ["Approval"] * 3 + ["Transfer", None, "Swap"]
    swap = got[5]
    assert swap.event_signature == "Swap(uint256)" and swap.amount is None and swap.token is None
    assert swap.args_preview == list("123456") and swap.topics_preview == list("1234")
    assert got[3].args_preview is None


def test_typed_columns_and_aliases(spark):
    df = spark.createDataFrame(
        [("eth", "0x1", 3, "0xT", TRANSFER, [A, B, "9"], [TRANSFER_TOPIC]),
         ("eth", "0x2", 4, "0xT", TRANSFER, None, [TRANSFER_TOPIC, TOPIC_A, TOPIC_B])],
        "chain string, tx_hash string, event_index int, contract_address string, event_signature string, "
        "args array<string>, topics array<string>",
    )
    got = hs.decode_events(hs.normalize_events(df)).orderBy("log_index").collect()
    assert [(r["from"], r["to"], r.amount, r.log_index) for r in got] == [(A, B, "9", 3), (A, B, None, 4)]


def test_cap_order_and_hot_hash(spark):
    rows = [("eth", "0xhot", i if i != 3 else None, "0xt", "E()", str(i)) for i in reversed(range(120))]
    rows += [("eth", "0xcold", 1, "0xt", "E()", "1")]
    df = spark.createDataFrame(
        rows, "chain string, transaction_hash string, log_index int, address string, event_signature string, data string")
    events = hs.normalize_events(df)

    def logs(n):
        nested = hs.events_per_tx(hs.decode_events(hs.cap_events(events, n))).filter("tx_hash = '0xhot'").first()
        return [e.log_index for e in nested.events]

    in_order = [i for i in range(120) if i != 3]
    assert logs(100) == in_order[:100]
    assert logs(0) == [*in_order, None]
    assert "WindowGroupLimit" in hs.cap_events(events, 5)._jdf.queryExecution().executedPlan().toString()
