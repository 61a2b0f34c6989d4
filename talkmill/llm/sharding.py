"""Balanced label propagation: linked documents move towards their neighbours' shards under capacity quotas, by Spark joins.

Documents are linked by groups (for the query: equal texts). Each round counts a group's members per shard, picks the shard with most
members that still has room, and admits as many movers as the quotas allow; whole groups move together, only groups larger than a
twentieth of a shard are admitted row by row. Documents without links cut no edges wherever they are, so they fill the shards up at the
end. The law is ``rows``: row counts of any two shards are at most one apart.

Every row counts, repeated rows too: equal rows are numbered, so a row's shard depends on the rows of the table alone, not on its
partitions, and ties go by hashes of row and round. Null text: no bytes, crc32 0, and no group. Null doc_ids are kept as rows. An empty
table gives no rows. Only doc_id and text are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RANK_ROWS, discard, join_with_hot_keys, numbered_copies, ranked, stored

ROUNDS = 8
#: A group over this share of a shard is admitted row by row.
LARGE_SHARE = 20


def propagate(linked: DataFrame, quotas: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(node, group, shard) after label propagation; ``linked`` has node and group (a node may be in several groups).

    Movers are drawn by hash, so a shard may come out a little over its quota; ``shard_documents`` settles that row by row.
    """
    shards = len(quotas)
    large = max(1, min(quotas) // LARGE_SHARE)
    now = stored(linked.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")), "labels")
    links = now.count()
    for turn in range(rounds):
        counts = {r.shard: r.n for r in now.groupBy("shard").agg(F.countDistinct("node").alias("n")).collect()}
        room = {s: quotas[s] - counts.get(s, 0) for s in range(shards)}
        votes = now.groupBy("group", "shard").agg(F.count("*").alias("n"))
        rank = F.transform("votes", lambda v: F.struct(v["n"].alias("n"), F.xxhash64(F.col("group"), v["shard"]).alias("tie"), v["shard"].alias("shard")))
        is_open = F.array(*(F.lit(s) for s in range(shards) if room[s] > 0)) if any(r > 0 for r in room.values()) else F.array().cast("array<int>")
        groups = (
            votes.groupBy("group")
            .agg(F.collect_list(F.struct("shard", "n")).alias("votes"), F.sum("n").alias("size"))
            .withColumn("rank", rank)
            .withColumn("best", F.array_max(F.filter("rank", lambda v: F.array_contains(is_open, v["shard"]))))
            .where("best is not null and size(votes) > 1")
        )
        groups = stored(groups.select("group", "size", "rank", "best"), "groups")  # joins with a stored table can split a large group
        own = F.element_at(F.filter("rank", lambda v: v["shard"] == F.col("shard")), 1)
        wish = (
            join_with_hot_keys(now, groups, "group", "size", links)
            .withColumn("own", own)
            .where(F.col("best") > F.col("own"))
            .select("node", "shard", F.struct(F.col("best.n") - F.col("own.n"), F.col("best.shard").alias("to"), F.when(F.col("size") > large, F.xxhash64("node", F.lit(turn))).otherwise(F.xxhash64("group", F.lit(turn))).alias("draw")).alias("wish"))
            .groupBy("node", "shard")
            .agg(F.max("wish").alias("wish"))
            .select("node", F.col("shard").alias("from"), "wish.to", "wish.draw")
        )
        wish = stored(wish, "wishes")
        flows = {(r["from"], r["to"]): r["n"] for r in wish.groupBy("from", "to").agg(F.count("*").alias("n")).collect()}  # at most shards x shards rows
        if not flows:
            break
        share = admitted(flows, counts, quotas)
        part = F.element_at(F.create_map(*(x for (a, b), p in share.items() for x in (F.lit(a * shards + b), F.lit(p)))), F.col("from") * shards + F.col("to"))
        moves = wish.where(F.pmod("draw", F.lit(1 << 30)) < part * (1 << 30)).select("node", "to")
        now = stored(now.join(moves, "node", "left").select("node", "group", F.coalesce("to", "shard").alias("shard")), "labels", instead_of=now)
        discard(wish)
        discard(groups)
        if sum(share[k] * n for k, n in flows.items()) < 1:
            break
    return now


def admitted(flows: dict, counts: dict, quotas: list[int]) -> dict:
    """The share of each flow that may move so that no shard grows over its quota: inflows are scaled until all fit."""
    x = {k: float(n) for k, n in flows.items()}
    for _ in range(200):
        worst = 0.0
        for s, quota in enumerate(quotas):
            inflow = sum(v for (_, b), v in x.items() if b == s)
            over = counts.get(s, 0) - sum(v for (a, _), v in x.items() if a == s) + inflow - quota
            if over > 0.5 and inflow > 0:
                worst = max(worst, min(over, inflow))
                keep = max(0.0, 1 - over / inflow)
                x = {k: v * keep if k[1] == s else v for k, v in x.items()}
        if worst <= 0.5:
            break
    return {k: min(1.0, v / flows[k]) for k, v in x.items()}


def shard_documents(docs: DataFrame, shards: int = 16, rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, text_crc32, law, shard, slot (gapless from 0 in a shard), grown_shard (null)."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    facts = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.md5(text)).alias("group"),
    )
    node = F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("group", F.lit("-")), F.col("copy").cast("string"))))
    rows = stored(numbered_copies(facts, "copy").withColumn("node", node).drop("copy"), "rows")
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    sizes = stored(rows.where("group is not null").groupBy("group").agg(F.count("*").alias("members")).where("members > 1"), "sizes")
    linked = stored(join_with_hot_keys(rows.select("node", "group").where("group is not null"), sizes, "group", "members", total), "linked")
    members = linked.select("node", F.col("group").alias("own_group"), "members")
    placed = propagate(linked.select("node", "group"), quotas, rounds).groupBy("node").agg(F.min("shard").alias("label"))
    placed = placed.join(members, "node").select("node", "label", F.when((F.col("members") * LARGE_SHARE > total // shards) | (F.col("members") > RANK_ROWS), F.xxhash64("node")).otherwise(F.xxhash64("own_group")).alias("spread"))
    known = rows.join(placed, "node", "left").select("doc_id", "size", "text_crc32", "node", F.coalesce("label", F.lit(shards)).alias("label"), F.coalesce("spread", F.xxhash64("node")).alias("spread"))
    known = stored(known, "known")
    counts = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}  # shards + 1 rows
    kept = [min(counts.get(s, 0), quotas[s]) for s in range(shards)]
    spilled, filled = [0], [0]  # rows over the quota, and free places, of the shards before each
    for s in range(shards):
        spilled.append(spilled[-1] + counts.get(s, 0) - kept[s])
        filled.append(filled[-1] + quotas[s] - kept[s])
    pick = lambda values: F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), F.col("label") + 1)
    out = ranked(known, "label", "spread", ["node"], max(256, total // RANK_ROWS))
    pool = F.when(F.col("label") == shards, spilled[-1] + F.col("rank")).when(F.col("rank") >= pick([*kept, 0]), pick([*spilled[:-1], 0]) + F.col("rank") - pick([*kept, 0]))
    out = out.withColumn("pool", pool)
    to = sum((F.col("pool") >= filled[s]).cast("int") for s in range(1, shards)) if shards > 1 else F.lit(0)
    out = out.withColumn("to", F.coalesce(to, F.lit(0)))
    at = lambda values, col: F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), F.col(col) + 1)
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.when(F.col("pool").isNull(), F.col("label")).otherwise(F.col("to")).cast("int").alias("shard"),
        F.when(F.col("pool").isNull(), F.col("rank")).otherwise(at(kept, "to") + F.col("pool") - at(filled[:-1], "to")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
