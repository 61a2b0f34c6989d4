"""Batch state (manifest, index, journal) and the gates before and after an import."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import EXECUTABLE_BATCHES


def valid_month(value: str) -> str:
    if not re.fullmatch(r"\d{4}-\d{2}", value):
        raise ValueError(f"a month is YYYY-MM, not {value!r}")
    return value


def valid_batch_id(value: str) -> str:
    if not re.fullmatch(r"batch-\d{3}(-retry-\d+)?", value):
        raise ValueError(f"a batch is batch-NNN or batch-NNN-retry-N, not {value!r}")
    return value


def valid_count(value: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"not a positive whole number: {value!r}")
    return value


def valid_identifier(value: str) -> str:
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", value):
        raise ValueError(f"not a plain name of a table or column: {value!r}")
    return value


def executable_batches() -> list[tuple[str, str]]:
    return [(month, f"batch-{k:03d}") for month, n in EXECUTABLE_BATCHES.items() for k in range(1, n + 1)]


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with rows of ``new`` in place of those with the same keys."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def merge_fields(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Field by field: the new value, else the old one."""
    rest = [c for c in old.columns if c not in keys]
    a = old.select(*keys, *(F.col(c).alias(f"_old_{c}") for c in rest))
    return a.join(new, keys, "full").select(*keys, *(F.coalesce(F.col(c), F.col(f"_old_{c}")).alias(c) for c in rest))


def latest_phase(journal: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """The newest entry of each batch's phase log."""
    rest = [c for c in journal.columns if c not in keys]
    return journal.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_last")).select(*keys, *(F.col(f"_last.{c}").alias(c) for c in rest))


def estimate_seconds(rows: Column) -> list[Column]:
    return [F.greatest(F.lit(5), F.ceil(rows * 0.01)).cast("long").alias("l0_seconds"), F.greatest(F.lit(60), F.ceil(rows * 0.12)).cast("long").alias("l0_embedding_seconds")]


def _one_row(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, F.lit(True))
    return out


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def import_gate(planned: DataFrame, live_before: DataFrame, live_after: DataFrame, accepted_total: int, key: str = "compare_key", fts_before: DataFrame | None = None, fts_after: DataFrame | None = None) -> DataFrame:
    """One row: planned rows, keys already live before, keys missing after, the deltas of rows and index, and whether it was fit to run and verified.

    Verified: the store began at the accepted total without any planned key, rows and index both grew by the planned rows, none is missing.
    """
    keys = planned.select(key).distinct()
    parts = [_count(planned, "planned"), _count(keys, "planned_keys"), _count(live_before, "before"), _count(live_after, "after"), _count(keys.join(live_before.select(key), key, "left_semi"), "already_live"), _count(keys.join(live_after.select(key), key, "left_anti"), "missing_after"), _count(live_before if fts_before is None else fts_before, "fts_before"), _count(live_after if fts_after is None else fts_after, "fts_after")]
    out = _one_row(parts).withColumn("delta", F.col("after") - F.col("before")).withColumn("delta_fts", F.col("fts_after") - F.col("fts_before")).drop("fts_before", "fts_after")
    out = out.withColumn("extra", F.greatest(F.col("delta") - F.col("planned"), F.lit(0)))
    at_baseline, none_there = F.col("before") == accepted_total, F.col("already_live") == 0
    out = out.withColumn("may_run", at_baseline & none_there & (F.col("planned") > 0))
    return out.withColumn("verified", at_baseline & none_there & (F.col("delta") == F.col("planned")) & (F.col("delta_fts") == F.col("planned")) & (F.col("missing_after") == 0))


def accept_existing(planned: DataFrame, live: DataFrame, fts: DataFrame, accepted_total: int, key: str = "compare_key") -> DataFrame:
    """One row: whether a store holds an import that was not recorded: rows and index grew over the accepted total by the planned rows, and all planned keys are there.

    Keys are compared as sets on both sides, so rows that repeat a key within the batch do no harm.
    """
    keys = planned.select(key).distinct()
    parts = [_count(planned, "planned"), _count(keys, "planned_keys"), _count(live, "live"), _count(fts, "fts"), _count(keys.join(live.select(key), key, "left_semi"), "there")]
    out = _one_row(parts).withColumn("delta", F.col("live") - accepted_total).withColumn("delta_fts", F.col("fts") - accepted_total).withColumn("missing", F.col("planned_keys") - F.col("there"))
    return out.withColumn("acceptable", (F.col("delta") == F.col("planned")) & (F.col("delta_fts") == F.col("planned")) & (F.col("missing") == 0))


#: Phases of an import, in order; an import ends with one of the last two.
PHASES = ("planned", "rows-committed", "lines-appended", "verified-ok", "stop")


def journal_entry(spark, month: str, batch_id: str, phase: str, seq: int, **facts: str) -> DataFrame:
    """A row of the journal, to be appended; ``latest_phase`` reads it. ValueError for a phase that is none."""
    if phase not in PHASES:
        raise ValueError(f"no phase of an import: {phase!r}")
    return spark.createDataFrame([(valid_month(month), valid_batch_id(batch_id), seq, phase, facts)], "month string, batch_id string, seq long, phase string, facts map<string,string>")
