"""Connected components by alternating large-star and small-star joins, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_with_hot_keys, stored


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, root) for each id of ``edges`` (a, b: long), root the smallest id reachable. Ids without a link to another are left out.

    Every round maps the links of each id to its smallest neighbour; links become stars in about log(n) rounds. Nothing is gathered:
    the driver sees one count and one checksum a round. The links of a star's centre never meet in one task: ids with many links are few,
    so they are joined by a broadcast. A round's table is removed once the next one is written. Null ids are dropped.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _sum(now)
    for _ in range(rounds):
        if not before[0]:
            break
        between = stored(_large_star(now, before[0]), "links", instead_of=now)
        now = stored(_small_star(between, _sum(between)[0]), "links", instead_of=between)
        after = _sum(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("id"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct())


def _sum(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(links: DataFrame, n: int) -> DataFrame:
    both = links.union(links.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n")
    return join_with_hot_keys(both, least, "a", "n", 2 * n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame, n: int) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    moved = join_with_hot_keys(links, least, "a", "n", n).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", "m")).distinct()
