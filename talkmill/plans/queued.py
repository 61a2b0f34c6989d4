"""Queued messages to any depth: each part is stripped of its own envelopes, which may be queued messages again, until none is left.

A round takes the parts of all messages of a depth at once; every round takes a header away, so rounds end. Then contents go up again: a
message's is that of its parts, without empty ones, joined by blank lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.extract import strip_envelopes
from ..functions.semantics import trimmed
from ..sources.stage import staged


def _has_parts() -> Column:
    return F.coalesce(F.size("queued_parts"), F.lit(0)) > 0


def unnest_queued(messages: DataFrame) -> DataFrame:
    """``messages`` (a stage with content and queued_parts) with the content of queued ones made of their parts; queued_parts is dropped."""
    plain = messages.where(~_has_parts()).drop("queued_parts")
    if messages.where(_has_parts()).isEmpty():
        return plain
    top = staged(messages.where(_has_parts()).withColumn("_row", F.monotonically_increasing_id()), "queued")
    level, levels = top.select(F.col("_row").cast("string").alias("_path"), "queued_parts"), []
    while levels == [] or not level.isEmpty():
        parts = level.select(F.col("_path").alias("_parent"), F.posexplode("queued_parts").alias("_n", "content"))
        named = parts.select("_parent", F.concat("_parent", F.lit("."), F.lpad(F.col("_n").cast("string"), 9, "0")).alias("_path"), "content", F.lit("user").alias("role"))
        levels.append(staged(strip_envelopes(named, queued_parts=True).select("_parent", "_path", "content", "queued_parts"), "queued"))
        level = levels[-1].where(_has_parts()).select("_path", "queued_parts")
    above = None
    for parts in reversed(levels):
        if above is not None:
            inner = parts.where(_has_parts()).drop("content").join(above.withColumnRenamed("_parent", "_path"), "_path", "left")
            parts = parts.where(~_has_parts()).unionByName(inner)
        said = parts.where("content <> ''").groupBy("_parent").agg(F.array_sort(F.collect_list(F.struct("_path", "content"))).alias("said"))
        above = said.select("_parent", trimmed(F.array_join(F.transform("said", lambda x: x["content"]), "\n\n")).alias("content"))
    whole = top.drop("content", "queued_parts").join(above.select(F.col("_parent").cast("bigint").alias("_row"), "content"), "_row", "left").drop("_row")
    return plain.unionByName(whole.withColumn("content", F.coalesce("content", F.lit(""))))
