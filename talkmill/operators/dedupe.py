"""Duplicates by normalised content: within a source, and across a batch in warn or reject mode. Rows with an empty hash are never duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import first_rows, previous_row


def source_duplicates(rows: DataFrame, scope: str = "scope", role: str = "role", hash_: str = "content_hash", seq: str = "seq") -> DataFrame:
    """Adds ``source_first``: the seq of the first row of the same scope, role and hash (its own for the first; null for an empty or null hash)."""
    hashed = first_rows(rows.where(F.col(hash_) != ""), [scope, role, hash_], seq, F.col(seq), "source_first")
    return hashed.unionByName(rows.where(F.coalesce(F.col(hash_), F.lit("")) == "").withColumn("source_first", F.lit(None).cast("long")))


def batch_duplicates_warned(rows: DataFrame, scope: str = "scope", role: str = "role", hash_: str = "content_hash", seq: str = "seq") -> DataFrame:
    """Rows that outlive the source rule, with ``batch_previous``: the seq of the kept row before of the same role and hash."""
    kept = source_duplicates(rows, scope, role, hash_, seq).where((F.col(hash_) != "") & (F.col("source_first") == F.col(seq)))
    warned = previous_row(kept, [role, hash_], seq, F.col(seq), "batch_previous")
    return warned.unionByName(rows.where(F.coalesce(F.col(hash_), F.lit("")) == "").withColumn("source_first", F.lit(None).cast("long")).withColumn("batch_previous", F.lit(None).cast("long")))


def batch_duplicates_rejected(rows: DataFrame, scope: str = "scope", role: str = "role", hash_: str = "content_hash", seq: str = "seq") -> DataFrame:
    """Adds ``verdict``: keep, duplicate_source or duplicate_batch, and ``duplicate_of``: the first row of that role and hash.

    Only the first row of a role and hash is kept; later rows of its scope are source duplicates, those of other scopes batch duplicates.
    """
    first = first_rows(rows.where(F.col(hash_) != ""), [role, hash_], seq, F.struct(F.col(seq).alias("seq"), F.col(scope).alias("scope")), "_first")
    verdict = F.when(F.col("_first.seq") == F.col(seq), "keep").when(F.col("_first.scope").eqNullSafe(F.col(scope)), "duplicate_source").otherwise("duplicate_batch")
    judged = first.withColumn("verdict", verdict).withColumn("duplicate_of", F.when(F.col("verdict") != "keep", F.col("_first.seq"))).drop("_first")
    return judged.unionByName(rows.where(F.coalesce(F.col(hash_), F.lit("")) == "").withColumn("verdict", F.lit("keep")).withColumn("duplicate_of", F.lit(None).cast("long")))


def duplicate_surplus(rows: DataFrame, hash_: str = "content_hash") -> DataFrame:
    """One row: rows beyond the first of each non-empty hash, and hashes that stand more than once."""
    n = rows.where(F.col(hash_) != "").groupBy(hash_).agg(F.count("*").alias("n"))
    return n.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"), F.count_if(F.col("n") > 1).alias("repeated_hashes"))


def top_duplicates(rows: DataFrame, hash_: str = "content_hash", seq: str = "seq", sample: str = "normalised", limit: int = 10) -> DataFrame:
    """The most frequent repeated hashes (ties: first seen) with the first row's content, cut to 180 characters."""
    n = rows.where(F.col(hash_) != "").groupBy(hash_).agg(F.count("*").alias("n"), F.min(seq).alias("first_seq"), F.min_by(F.substring(sample, 1, 180), seq).alias("content"))
    return n.where("n > 1").orderBy(F.desc("n"), "first_seq").limit(limit)
