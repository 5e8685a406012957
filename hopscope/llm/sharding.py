"""Balanced label propagation: linked documents move to common shards, shard sizes stay even.

Input is a table of documents and a table of memberships (document, link key);
documents that share a key are linked. Every round a member looks at how its
keys' members lie over the shards and, where another shard with room holds more
of them, asks to move there. Requests between two shards are granted as far as
the room goes: all members of a key together while the key is small, member by
member (by a hash) where a key is too large for one shard. Members are joined to
one row for each key, so a key with a third of all documents makes no pairs.

At the end the shards are filled up exactly: members past a shard's quota and
documents without links are placed where rows are missing, by number. The law is
``rows``: shard sizes differ by one row at most.

In DataFrame expressions only. Defined cases: a null text counts as empty, and
equal texts (in the query) are one group; repeated rows are rows of their own;
with fewer rows than shards some shards are empty; an empty table gives an empty
result; carried columns travel in a struct, so extra columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hopscope.sources.staging import stage

SHARDS = 16
ROUNDS = 12
SETTLED = 0.001  # share of members that still move at which the rounds end
_HEAVY = 1024  # a key with more than this part of the members is heavy, so there are fewer of those
_BUCKET = 20_000  # rows numbered together


def _unit(column: Column, salt: int) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(column, F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)


def number_rows(df: DataFrame, group: str, order: str, total: int) -> DataFrame:
    """Add ``number``, gapless from 0 within ``group``, in order of a hash of ``order``.

    Rows are numbered in buckets of bounded size; the sizes of the buckets, few
    beside the rows, give each its first number.
    """
    buckets = max(1, total // _BUCKET) * 4
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(order, F.lit(5)), F.lit(buckets)))
    sizes = df.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    window = f"partition by {group} order by _bucket rows between unbounded preceding and 1 preceding"
    sizes = sizes.withColumn("_before", F.expr(f"coalesce(sum(_n) over ({window}), 0)")).drop("_n")
    rank = F.expr(f"row_number() over (partition by {group}, _bucket order by xxhash64({order}, 5), {order}, row_key) - 1")
    out = df.withColumn("_rank", rank).join(sizes, [group, "_bucket"])
    return out.withColumn("number", F.col("_before") + F.col("_rank")).drop("_bucket", "_before", "_rank")


def _join_keys(members: DataFrame, keys: DataFrame, heavy: list) -> DataFrame:
    """Members with the row of their key; the few heavy keys are broadcast, the rest dealt by key."""
    if not heavy:
        return members.join(keys, "key")
    is_heavy = F.col("key").isin(heavy)
    few = members.filter(is_heavy).join(F.broadcast(keys.filter(is_heavy)), "key")
    return members.filter(~is_heavy).join(keys, "key").unionByName(few)


def grants(requests: list[list[int]], sizes: list[int], quota: float) -> list[list[float]]:
    """Share of the requests between any two shards that may be granted so that no shard ends above its quota.

    Starts from all requests; what comes into a full shard is cut in
    proportion, until nothing is too full. A shard above its quota already may
    take nothing in.
    """
    n = len(sizes)
    share = [1.0] * n
    for _ in range(200):
        moved = [[requests[a][b] * share[b] for b in range(n)] for a in range(n)]
        out = [sum(moved[a]) for a in range(n)]
        calm = True
        for b in range(n):
            wanted = sum(requests[a][b] for a in range(n))
            room = max(0.0, quota - sizes[b] + out[b])
            fit = min(1.0, room / wanted) if wanted else 1.0
            if fit < share[b] - 1e-9:
                share[b], calm = fit, False
        if calm:
            break
    return [list(share) for _ in range(n)]


def propagate(
    members: DataFrame, total: int, shards: int = SHARDS, rounds: int = ROUNDS, one_key: bool = False
) -> DataFrame:
    """(row_key, shard, key) after the rounds, of memberships (row_key, key) with two or more members a key.

    A row in several keys follows the key that pulls most; ``one_key`` says that no row is. Only sums over pairs
    of shards reach the driver, and the names of heavy keys, fewer than 1024.
    """
    start = F.pmod(F.xxhash64("row_key", F.lit(3)), F.lit(shards)).cast("int")
    now = stage(members.select("row_key", "key", start.alias("shard")), "members")
    count = now.count()
    quota = total / shards
    heavy_rows = now.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * _HEAVY > count).select("key").collect()
    heavy = [r.key for r in heavy_rows]
    for step in range(rounds):
        sizes = [0] * shards
        for r in now.select("row_key", "shard").distinct().groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():
            sizes[r.shard] = r.n
        # Places kept for rows without links fill up last, so room is counted over all rows.
        room = [quota - size > 0 for size in sizes]
        keys = now.groupBy("key").agg(
            F.count(F.lit(1)).alias("n"),
            *(F.sum((F.col("shard") == s).cast("int")).alias(f"s{s}") for s in range(shards)),
        )
        counts = F.array(*(F.col(f"s{s}") for s in range(shards)))
        keys = stage(keys.select("key", "n", counts.alias("counts")), "keys")
        at = _join_keys(now, keys, heavy)
        own = F.get(F.col("counts"), F.col("shard")) - 1
        # Of shards with room the one with most of the key; a hash of the key breaks ties alike for all its members.
        choices = F.array(
            *(
                F.struct(
                    F.get(F.col("counts"), F.lit(s)).alias("pull"),
                    F.xxhash64("key", F.lit(s)).alias("tie"),
                    F.lit(s).alias("to"),
                )
                for s in range(shards)
                if room[s]
            )
        )
        if not any(room):
            return now
        at = at.withColumn("best", F.array_max(choices))
        # Strictly more there than here without itself; ties go one way only, to the key's own first choice.
        stays = F.struct((own + 1).alias("pull"), F.xxhash64("key", F.col("shard")).alias("tie"), F.col("shard").alias("to"))
        at = at.withColumn("pull", F.when((F.col("best.to") != F.col("shard")) & (F.col("best") > stays), F.col("best.pull") - own))
        asked = at.filter("pull is not null")
        if not one_key:
            most = asked.groupBy("row_key").agg(F.max(F.struct("pull", "key")).alias("of"))
            asked = asked.join(most.select("row_key", F.col("of.key").alias("key")), ["row_key", "key"])
        asked = stage(asked.select("row_key", "key", "n", F.col("shard").alias("from"), F.col("best.to").alias("to")), "asked")
        requests = [[0] * shards for _ in range(shards)]
        for r in asked.groupBy("from", "to").agg(F.count(F.lit(1)).alias("n")).collect():
            requests[r["from"]][r["to"]] = r.n
        if sum(map(sum, requests)) <= SETTLED * count:
            break
        share = grants(requests, sizes, quota)
        table = F.array(*(F.array(*(F.lit(x) for x in row)) for row in share))
        # A small key moves as one, a large one member by member.
        whole = F.col("n") * 8 < quota
        draw = F.when(whole, _unit(F.col("key"), 100 + step)).otherwise(_unit(F.col("row_key"), 100 + step))
        moves = asked.filter(draw < F.get(F.get(table, F.col("from")), F.col("to"))).select("row_key", F.col("to"))
        moved = now.join(moves, "row_key", "left").select("row_key", "key", F.coalesce("to", "shard").alias("shard"))
        now = stage(moved, "members")
    return now


def fill(rows: DataFrame, placed: DataFrame, total: int, shards: int = SHARDS) -> DataFrame:
    """(row_key, shard, slot) of all rows: ``placed`` (row_key, shard, key) as far as quotas go, the others where rows are missing."""
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    held = {r.shard: r.n for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    quota = F.get(F.array(*(F.lit(q) for q in quotas)), F.col("shard"))
    # In key order, so that those past the quota are whole keys where possible; rows of heavy keys one by one.
    heavy = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") * _HEAVY > total).select("key")
    heavy = [r.key for r in heavy.collect()]
    order = F.when(F.col("key").isin(heavy), F.col("row_key")).otherwise(F.col("key")) if heavy else F.col("key")
    stay = stage(number_rows(placed.withColumn("order", order), "shard", "order", total).filter(F.col("number") < quota).select("row_key", "shard", "number"), "stay")
    ends, end = [], 0
    for s in range(shards):
        end += max(0, quotas[s] - held.get(s, 0))
        ends.append(end)
    free = rows.join(stay.select("row_key"), "row_key", "left_anti").withColumn("one", F.lit(0))
    free = number_rows(free.select("row_key", "one"), "one", "row_key", total)
    # Free row i goes to the first shard whose end lies past i, behind the rows that stay there.
    firsts = [0, *ends[:-1]]
    kept = [min(held.get(s, 0), quotas[s]) for s in range(shards)]
    shard = F.size(F.filter(F.array(*(F.lit(e) for e in ends)), lambda e: e <= F.col("number")))
    free = free.withColumn("shard", shard.cast("int"))
    slot = F.col("number") - F.get(F.array(*map(F.lit, firsts)), F.col("shard")) + F.get(F.array(*map(F.lit, kept)), F.col("shard"))
    return stay.select("row_key", "shard", F.col("number").alias("slot")).unionByName(free.select("row_key", "shard", slot.alias("slot")))


def assign_by_text(docs: DataFrame, text: str = "text", key: str = "doc_id", carry: list[str] | None = None, shards: int = SHARDS) -> DataFrame:
    """``doc`` (struct of the carried columns), size, text_crc32, shard, slot; documents with equal texts are linked."""
    t = F.coalesce(docs[f"`{text}`"], F.lit(""))
    base = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in (docs.columns if carry is None else carry))).alias("doc"),
        F.coalesce(docs[f"`{key}`"].cast("string"), F.lit("\0")).alias("id"),
        (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
        F.md5(t.cast("binary")).alias("key"),
    )
    # Stored before rows are named, so that the names hold in every later reading.
    base = stage(base, "shard-base")
    copies = F.expr("row_number() over (partition by id, key order by size) - 1")
    twice = base.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    name = F.concat_ws(":", "id", copies if twice else F.lit(0), "key")
    rows = stage(base.withColumn("row_key", F.md5(name.cast("binary"))), "shard-rows")
    total = rows.count()
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    linked = stage(groups, "linked")
    heavy = [r.key for r in linked.filter(F.col("n") * _HEAVY > total).select("key").collect()]
    members = _join_keys(rows.select("row_key", "key"), linked.select("key"), heavy).select("row_key", "key")
    placed = propagate(members, total, shards, one_key=True)
    found = fill(rows.select("row_key"), placed, total, shards)
    return rows.join(found, "row_key").select("doc", "size", "text_crc32", "shard", "slot")
