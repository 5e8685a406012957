"""Net changes of amounts that no uint256 holds."""

import random

from pyspark.sql import functions as F

import hopscope as hs
from hopscope.functions.u256 import long_sum_text
from hopscope.operators.trace import net_delta, transfer_legs


def test_sums_of_any_length(spark):
    rng = random.Random(1)
    groups = [[rng.choice([1, -1]) * rng.randrange(10 ** rng.choice([1, 26, 52, 87, 200])) for _ in range(rng.randint(1, 6))] for _ in range(60)]
    groups += [[10**155, -(10**155)], [-(10**100), 1], [0], [10**26 - 1, 1], [-1, -(10**26) + 1]]
    df = spark.createDataFrame([(i, [str(x) for x in g]) for i, g in enumerate(groups)], "i int, texts array<string>")
    got = {r.i: r.s for r in df.select("i", long_sum_text(F.col("texts")).alias("s")).collect()}
    assert got == {i: str(sum(g)) for i, g in enumerate(groups)}


def test_long_transfers_enter_the_net_change(spark):
    big = 10**155 + 7
    event = "struct<event_name:string,token:string,contract:string,from:string,to:string,amount:string>"
    events = [("Transfer", "0xt", None, "0xa", "0xb", str(big)), ("Transfer", "0xt", None, "0xb", "0xa", "5")]
    df = spark.createDataFrame([(1, 0, "0xa", ["0xb"], events)], f"episode_row int, tx_pos long, from_address string, extra_focus array<string>, events array<{event}>")
    rows = {(r.addr, r.token): r.delta for r in hs.transfer_delta(df).collect()}
    assert rows == {("0xa", "0xt"): str(5 - big), ("0xb", "0xt"): str(big - 5)}
    nested = df.select(net_delta(transfer_legs(F.col("events")), F.array(F.lit("0xa"), F.lit("0xb"))).alias("d")).first().d
    assert nested == {"0xa": {"0xt": str(5 - big)}, "0xb": {"0xt": str(big - 5)}}
