"""Trees of hashes over multisets of keys: equal roots for equal multisets only, and where roots differ, the ranges in which they do.

Keys are counted, and (key, count) lines go to leaves by the first hex digits of the key's MD5. A leaf's hash is over its sorted lines, a
node's over its children's prefixes and hashes. Leaves are made for about LEAF_KEYS keys each, so none is large, whatever the table's size;
a key that many rows hold is one line. Null keys are not part of a multiset.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.stage import stage_path
from .ordered import join_null_safe, narrow

LEAF_KEYS = 500
#: Digits by which the counted keys are laid out on disk, so that a few leaves are read without the rest.
FOLDER_DIGITS = 2


@dataclass(frozen=True)
class Tree:
    """``lines``: (*by, key, n, leaf, folder), on disk by folder; ``leaves``: (*by, prefix, hash); ``digits``: of a leaf's prefix."""

    by: tuple[str, ...]
    digits: int
    lines: DataFrame
    leaves: DataFrame

    def nodes(self, digits: int) -> DataFrame:
        """(*by, prefix, hash) of the nodes with a prefix of so many digits; with 0, the root of each group."""
        out = self.leaves
        for d in range(self.digits - 1, digits - 1, -1):
            child = F.concat("prefix", F.lit("="), "hash")  # at most 16 of a node
            out = out.groupBy(*self.by, F.substring("prefix", 1, d).alias("up")).agg(_hash(F.collect_list(child)).alias("hash")).withColumnRenamed("up", "prefix")
        return out

    def roots(self) -> DataFrame:
        return self.nodes(0).drop("prefix")


def _hash(lines: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(lines), "\n").cast("binary"), 256)


def digits_for(keys: int) -> int:
    """Digits of a leaf's prefix for so many keys."""
    digits = 0
    while LEAF_KEYS * 16**digits < keys:
        digits += 1
    return digits


def tree(rows: DataFrame, key: str = "compare_key", by: Sequence[str] = (), digits: int | None = None) -> Tree:
    """The tree of each group of ``by``. Trees that are to be compared need the same ``digits``, by default what the number of rows asks for."""
    spark = rows.sparkSession
    if digits is None:
        digits = digits_for(rows.count())
    md5 = F.md5(F.col("key").cast("binary"))
    lines = rows.select(*by, F.col(key).alias("key")).where("key is not null").groupBy(*by, "key").agg(F.count("*").alias("n"))
    lines = lines.withColumn("leaf", F.substring(md5, 1, digits)).withColumn("folder", F.substring(md5, 1, FOLDER_DIGITS))
    path = stage_path(spark, "merkle")
    lines.repartition("folder").sortWithinPartitions("folder", "leaf").write.partitionBy("folder").parquet(path)
    kept = spark.read.schema(lines.schema).parquet(path)
    leaves = kept.groupBy(*by, F.col("leaf").alias("prefix")).agg(_hash(F.collect_list(F.concat("key", F.lit(":"), F.col("n").cast("string")))).alias("hash"))
    return Tree(tuple(by), digits, kept, leaves)


def differing_leaves(left: Tree, right: Tree) -> DataFrame:
    """(*by, prefix): leaves of either tree whose hash is not the other's. Levels are compared from the top, so equal parts are left at once."""
    if (left.by, left.digits) != (right.by, right.digits):
        raise ValueError("trees of other groups or depths cannot be compared")
    by, found = list(left.by), None
    for digits in sorted({0, left.digits // 2, left.digits}):
        a, b = left.nodes(digits), right.nodes(digits)
        if found is not None:
            up = F.substring("prefix", 1, found[0])
            a, b = (join_null_safe(t.withColumn("up", up), found[1].withColumnRenamed("prefix", "up"), [*by, "up"], "left_semi").drop("up") for t in (a, b))
        other = b.select(*(F.col(c).alias(f"_{c}") for c in b.columns))
        same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*by, "prefix"]))
        apart = a.join(other, same, "full").where(~F.col("hash").eqNullSafe(F.col("_hash")))
        found = digits, apart.select(*(F.coalesce(c, f"_{c}").alias(c) for c in [*by, "prefix"]))
    return found[1]


def difference(left: Tree, right: Tree) -> DataFrame:
    """(*by, key, delta): keys that stand more often on the left (delta over 0) or on the right, read from the differing leaves' folders alone."""
    by = list(left.by)
    apart = differing_leaves(left, right)
    # Folders begin like leaves, so few leaves leave few folders to read.
    where = apart.withColumnRenamed("prefix", "leaf")
    folders = narrow(where.select(F.substring("leaf", 1, FOLDER_DIGITS).alias("folder")).distinct()) if left.digits >= FOLDER_DIGITS else None
    near = [t.lines if folders is None else t.lines.join(folders, "folder", "left_semi") for t in (left, right)]
    a, b = (join_null_safe(t, where, [*by, "leaf"], "left_semi").select(*by, "key", "n") for t in near)
    other = b.select(*(F.col(c).alias(f"_{c}") for c in b.columns))
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*by, "key"]))
    delta = F.coalesce("n", F.lit(0)) - F.coalesce("_n", F.lit(0))
    return a.join(other, same, "full").select(*(F.coalesce(c, f"_{c}").alias(c) for c in [*by, "key"]), delta.alias("delta")).where("delta <> 0")


def comparison(left: Tree, right: Tree, samples: int = 20) -> DataFrame:
    """(direction, keys, total, samples): for missing (more on the left) and extra keys, how many, by how much, and the first ones by amount, then key."""
    moved = difference(left, right).select("key", F.when(F.col("delta") > 0, "missing").otherwise("extra").alias("direction"), F.abs("delta").alias("delta"))
    totals = moved.groupBy("direction").agg(F.count("*").alias("keys"), F.sum("delta").alias("total"))
    first = [moved.where(F.col("direction") == d).orderBy(F.desc("delta"), "key").limit(samples) for d in ("missing", "extra")]
    shown = first[0].unionByName(first[1]).groupBy("direction").agg(F.array_sort(F.collect_list(F.struct((-F.col("delta")).alias("less"), "key"))).alias("s"))
    named = shown.select("direction", F.transform("s", lambda x: F.struct(x["key"].alias("key"), (-x["less"]).alias("delta"))).alias("samples"))
    both = left.lines.sparkSession.createDataFrame([("missing",), ("extra",)], "direction string")
    return both.join(totals, "direction", "left").join(named, "direction", "left").select("direction", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("keys", "total")), F.coalesce("samples", F.array().cast("array<struct<key:string,delta:bigint>>")).alias("samples"))
