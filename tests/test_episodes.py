"""Episode and trace semantics on hand-written rows."""

import json

import pytest
from pyspark.sql import functions as F

import hopscope as hs

R, S, X = ("0x" + c * 40 for c in "abc")
CONFIG = hs.EpisodeConfig(id_cols=("rid",))
T0 = "2024-01-01 12:00:00"


def receipts(spark, *rows):
    schema = "rid int, destination_address string, destination_chain string, destination_timestamp string, " \
             "source_chain string, source_address string, source_tx_hash string"
    return hs.canonical_receipts(spark.createDataFrame(rows, schema))


def txs(spark, *rows):
    """(chain, time, hash, from, to, value, input)"""
    full = [(*r, i, 0) for i, r in enumerate(rows)]
    schema = "chain string, t string, transaction_hash string, from_address string, to_address string, " \
             "value string, input string, block_number int, transaction_index int"
    return spark.createDataFrame(full, schema).withColumn("block_timestamp", F.to_timestamp("t")).drop("t")


def build(spark, r, t, events=None, **changes):
    config = hs.EpisodeConfig(id_cols=("rid",), **changes)
    return {x.rid: x for x in hs.build_episodes(r, t, events, config).collect()}


def test_window_edges_phases_and_duration(spark):
    r = receipts(
        spark,
        (1, R.upper().replace("0X", "0x"), "1", T0, "arb", S, None),
        (2, R, "1", T0, "arb", "0x" + "d" * 40, "0xSRC"),
        (3, X, "1", T0, "arb", X, None),
    )
    t = txs(
        spark,
        ("eth", "2024-01-01 12:00:00", "0xAT", R, S, "5", "0xa9059cbb00"),
        ("eth", "2024-01-01 14:59:59", "0xlast", S, R, "x1", None),
        ("eth", "2024-01-01 15:00:00", "0xend", R, S, "1", None),
        ("eth", "2024-01-01 11:59:59", "0xbefore", R, S, "1", None),
        ("arbitrum", "2024-01-01 11:00:00", "0xsrc", S, X, "1", None),
        ("arbitrum", "2024-01-01 10:59:59", "0xearly", S, X, "1", None),
        ("arbitrum", "2024-01-01 12:00:00", "0xlate", S, X, "1", None),
        ("base", "2024-01-01 12:30:00", "0xother", R, S, "1", None),
    )
    got = build(spark, r, t)
    for rid in (1, 2):  # 2 finds S through its source transaction
        assert [(a.phase, a.tx_hash) for a in got[rid].actions] == [
            ("src_pre", "0xsrc"), ("dst_post", "0xat"), ("dst_post", "0xlast")]
        assert got[rid].EPISODE_TX_COUNT == 3 and got[rid].EPISODE_DURATION_SEC == 3 * 3600 - 1
        assert (got[rid].EPISODE_FIRST_TX_HASH, got[rid].EPISODE_LAST_TX_HASH) == ("0xsrc", "0xlast")
        assert got[rid].EPISODE_LAST_TX_TIMESTAMP == "2024-01-01T14:59:59+00:00"
    parsed = json.loads(got[1].EPISODE_ACTIONS_JSON)
    assert parsed[1]["value"] == 5 and parsed[1]["method_id"] == "0xa9059cbb" and parsed[2]["value"] == "x1"
    # Only source side: the duration is negative and cut towards zero.
    assert [a.tx_hash for a in got[3].actions] == ["0xsrc"] and got[3].EPISODE_DURATION_SEC == -3600


def test_every_receipt_stays(spark):
    r = receipts(
        spark, (1, "not an address", "1", T0, None, None, None), (2, R, "1", "bad time", None, None, None),
        (3, R, "polygon", T0, None, None, None), (4, R, "1", T0, None, None, None), (5, R, None, T0, None, None, None))
    t = txs(spark, ("eth", T0, "0x1", R, S, "5", None), ("polygon", T0, "0x2", R, S, "5", None))
    got = build(spark, r, t)
    assert [got[i].EPISODE_TX_COUNT for i in range(1, 6)] == [0, 0, 0, 1, 0]
    assert got[1].EPISODE_ACTIONS_JSON == "[]" and got[1].EPISODE_DURATION_SEC is None and got[1].actions == []
    assert build(spark, r, t, chains=())[3].EPISODE_TX_COUNT == 1


def test_undetected_columns_pass_through(spark):
    df = hs.canonical_receipts(spark.createDataFrame([(1, "x")], "rid int, note string"))
    got = build(spark, df, txs(spark, ("eth", T0, "0x1", R, S, "5", None)))
    assert got[1].note == "x" and got[1].EPISODE_TX_COUNT == 0


def test_cap_per_phase_and_dedup(spark):
    r = receipts(spark, (1, R, "eth", T0, "eth", R, None))
    late = [("eth", f"2024-01-01 12:{i:02d}:00", f"0xp{i:02d}", R, R, "1", None) for i in range(60)]
    early = [("eth", f"2024-01-01 11:{i:02d}:30", f"0xq{i:02d}", S, R, "1", None) for i in range(60)]
    t = txs(spark, *late, *early, *late[:10])
    got = build(spark, r, t)[1]
    hashes = [a.tx_hash for a in got.actions]
    assert hashes == [f"0xq{i:02d}" for i in range(50)] + [f"0xp{i:02d}" for i in range(50)]
    assert build(spark, r, t, max_txs_per_episode=0)[1].EPISODE_TX_COUNT == 120
    only_sender = build(spark, r, t, include_to_address=False)[1]
    assert {a.phase for a in only_sender.actions} == {"dst_post"}


def test_ties_between_phases_put_source_first(spark):
    r = receipts(spark, (1, R, "eth", T0, "base", S, None))
    t = txs(spark, ("eth", T0, "0xdst", R, X, "1", None), ("base", T0, "0xsrc", S, X, "1", None))
    got = build(spark, r, t, pre_end_offset_minutes=10)[1]
    assert [a.tx_hash for a in got.actions] == ["0xsrc", "0xdst"]


def test_bucket_scope_widens_the_search(spark):
    """The source transaction lies outside the receipt's own window but inside
    that of another receipt of the same bucket."""
    r = receipts(
        spark, (1, R, "eth", "2024-01-01 12:50:00", "base", X, "0xsrc"), (2, R, "eth", "2024-01-01 12:05:00", "base", X, None))
    tx = hs.normalize_transactions(txs(spark, ("base", "2024-01-01 11:30:00", "0xsrc", S, X, "1", None)))
    found = {}
    for scope in (False, True):
        config = hs.EpisodeConfig(id_cols=("rid",), bucket_scope=scope)
        resolved = hs.resolve_source_actor(hs.with_windows(r, config), tx, config)
        found[scope] = {x.rid: x._src_actor for x in resolved.collect()}
    assert found == {False: {1: X, 2: X}, True: {1: S, 2: X}}


@pytest.fixture(scope="module")
def traced(spark):
    r = receipts(spark, (1, R, "eth", T0, "base", S, None))
    t = txs(
        spark,
        ("eth", "2024-01-01 12:00:00", "0x1", R, S, str(10**18), "0xa9059cbb00"),
        ("eth", "2024-01-01 12:01:00", "0x2", R, R, "7", None),
        ("eth", "2024-01-01 12:02:00", "0x3", X, R, "0", None),
    )
    big = str(2**256 - 1)
    rows = [
        ("eth", "0x1", 0, "0xT1", f'["{R}","{S}","{big}"]'), ("eth", "0x1", 1, "0xT1", f'["{R}","{X}",1]'),
        ("eth", "0x1", 2, None, f'["{S}","{R}",4]'), ("eth", "0x2", 0, "0xT1", f'["{R}","{R}",9]'),
    ]
    ev = spark.createDataFrame(rows, "chain string, transaction_hash string, log_index int, address string, args string") \
        .withColumns({"event_signature": F.lit("Transfer(a,b,c)"), "block_timestamp": F.to_timestamp(F.lit(T0))})
    config = hs.TraceConfig(id_cols=("rid",), focus_addr_cols=("source_address", "absent"))
    return hs.build_episodes(r, t, ev, CONFIG), t, ev, config


def test_trace_deltas(spark, traced):
    episodes, t, ev, config = traced
    rows = {x.tx_hash: x for x in hs.build_action_trace(episodes, t, ev, config).collect()}
    big = 2**256 - 1
    assert json.loads(rows["0x1"].transfer_delta_json) == {
        R: {"0xt1": -big - 1, "unknown_token": 4, "native": -(10**18)},
        S: {"0xt1": big, "unknown_token": -4, "native": 10**18}}
    assert json.loads(rows["0x2"].transfer_delta_json) == {R: {"0xt1": 0, "native": 0}, S: {}}
    assert json.loads(rows["0x3"].transfer_delta_json) == {X: {}, S: {}}
    assert [rows[h].n_events for h in ("0x1", "0x2", "0x3")] == [3, 1, 0]
    actions = json.loads(rows["0x1"].actions_json)
    assert [a["type"] for a in actions] == ["CALL"] + ["Transfer"] * 3
    assert actions[0]["value"] == 10**18 and actions[1]["amount"] == big and rows["0x3"].tx_pos == 2


def test_grouped_deltas_equal_row_deltas(spark, traced):
    from hopscope.plans.trace_plan import joined_trace

    episodes, t, ev, config = traced
    trace = joined_trace(hs.explode_actions(episodes, config), t, ev, config)
    grouped = {}
    for f in (hs.transfer_delta, hs.native_delta):
        for x in f(trace, ("rid",)).collect():
            grouped.setdefault((x.tx_pos, x.addr), {}).update({x.token: int(x.delta)} if x.token else {})
    per_row = {
        (x.tx_pos, a): d for x in hs.build_action_trace(episodes, t, ev, config).collect()
        for a, d in json.loads(x.transfer_delta_json).items()}
    assert grouped == per_row


def test_event_cap_limits_the_delta(spark, traced):
    episodes, t, ev, _ = traced
    config = hs.TraceConfig(id_cols=("rid",), max_events_per_tx=1)
    rows = {x.tx_hash: x for x in hs.build_action_trace(episodes, t, ev, config).collect()}
    assert json.loads(rows["0x1"].transfer_delta_json) == {R: {"0xt1": -(2**256 - 1), "native": -(10**18)}}


def test_explode_skips_unusable_actions(spark):
    stored = json.dumps([{"tx_hash": "0xA", "chain": " ETH "}, {"chain": "eth"}, {"tx_hash": "0xB"},
                         {"transaction_hash": "0xC", "chain": "eth", "ts": "2024-01-01T00:00:00+00:00"}])
    df = spark.createDataFrame([(1, stored), (2, "[bad"), (3, None)], "episode_row int, EPISODE_ACTIONS_JSON string")
    exploded = hs.explode_actions(df)
    assert [(x.tx_pos, x.tx_hash, x.chain) for x in exploded.orderBy("tx_pos").collect()] == [
        (0, "0xa", "eth"), (3, "0xc", "eth")]
    # No such transaction: fields are NULL, the time comes from the action.
    trace = hs.build_action_trace(df, txs(spark, ("eth", T0, "0xzz", R, S, "1", None))).orderBy("tx_pos").collect()
    assert [x.block_timestamp for x in trace] == [None, "2024-01-01T00:00:00+00:00"]
    assert trace[0].from_address is None and trace[0].transfer_delta_json == "{}"


def test_view(spark, traced):
    episodes, _, _, _ = traced
    view = hs.episode_view(episodes, 1, ("rid",))
    row = view.first()
    assert (row.id, row.tx_count, row.receiver, row.dst_chain) == (0, 3, R, "eth")
    lines = hs.episode_event_preview(view).orderBy("tx_pos").collect()
    assert [x.events_count for x in lines] == [3, 1, 0]
    assert lines[0].events_preview.split("\n")[2] == "Transfer  amt=4"
    with pytest.raises(ValueError):
        hs.episode_view(spark.createDataFrame([(1,)], "rid int"))
    assert hs.episode_view(episodes, 0, ("rid",)).count() == 1
