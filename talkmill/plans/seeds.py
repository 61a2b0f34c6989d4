"""The seed document of a batch: a page of the rounds of a month's selected files, with what was selected and which rounds these are."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.inventory import offset_rejects, rounds_between
from ..operators.ordered import prefix_sums
from ..operators.state import valid_batch_id, valid_count, valid_month
from ..sources.sinks import writable, write_private_json
from ..sources.stage import staged
from .curate import curate, seed_rounds

#: Equality filters by which a batch's files are selected, with the lines' columns.
FILTERS = {"sourceType": "source_type", "file": "file", "sessionId": "session_id", "sessionKey": "session_key"}


@dataclass
class SeedPage:
    """``rounds``: sessionKey, sessionId, sourceFile, round_id, place and messages; ``metadata``: of the document; ``rejects``: one more kind if the page is beyond the rounds."""

    rounds: DataFrame
    metadata: dict
    rejects: DataFrame
    beyond: DataFrame


def seed_page(lines: DataFrame, month: str, batch_size: int, batch_index: int = 1, batch_id: str | None = None, reject_batch_duplicates: bool = False, **filters: str | None) -> SeedPage:
    """Page ``batch_index`` (from 1) of the rounds that ``lines`` (read_transcripts) give for a month, by the FILTERS that are given, in batch order."""
    batch_id = valid_batch_id(batch_id or f"batch-{valid_count(batch_index):03d}")
    for name, value in filters.items():
        lines = lines if value is None else lines.where(F.col(FILTERS[name]) == value)
    curated = curate(lines, valid_month(month), reject_batch_duplicates)
    messages = staged(curated.messages, "rounds")
    kept = messages.where("reject is null and role = 'user'").select("file", "round_id")
    counts = kept.groupBy("file").agg(F.count("*").alias("n")).join(curated.places, "file").withColumnRenamed("before", "at")
    starts = prefix_sums(counts, [F.col("at")], F.col("n"), "before")
    total, offset = kept.count(), (batch_index - 1) * valid_count(batch_size)
    page = staged(rounds_between(kept, starts, ["file"], offset, batch_size), "page")
    rounds = seed_rounds(messages.join(page.select("file", "round_id"), ["file", "round_id"], "left_semi"), month)
    rounds = rounds.join(page.select(F.col("file").alias("sourceFile"), "round_id", "place"), ["sourceFile", "round_id"])
    n = min(max(total - offset, 0), batch_size)
    metadata = {
        "month": month,
        "sourceType": filters.get("sourceType"),
        "batchId": batch_id,
        "offsetRounds": offset,
        "limitRounds": batch_size,
        "rangeStartRound": offset + 1 if n else None,
        "rangeEndRound": offset + n if n else None,
        "totalAvailableRounds": total,
        "filters": {k: filters.get(k) for k in ("file", "sessionId", "sessionKey")} | {"batchSize": batch_size, "batchIndex": batch_index, "rejectBatchDuplicates": reject_batch_duplicates},
    }
    return SeedPage(rounds, metadata, curated.rejects, offset_rejects(total, month, batch_id, offset, lines.sparkSession))


def write_seed(page: SeedPage, path: str, roots: list[str], never: list[str] = ()) -> None:
    """The document as private JSON at ``path`` under ``roots``: metadata, and sessions in order of their first round. ValueError if the page has no rounds.

    A page has batch_size rounds at most, which come to the driver one after the other.
    """
    sessions: dict[tuple, dict] = {}
    for r in page.rounds.select("*", F.to_json("messages").alias("said")).drop("messages").orderBy("place").toLocalIterator():
        key = (r.sessionKey, r.sessionId, r.sourceFile)
        session = sessions.setdefault(key, {"sessionKey": r.sessionKey, "sessionId": r.sessionId, "sourceFile": r.sourceFile, "conversations": []})
        session["conversations"].append(json.loads(r.said))
    if not sessions:
        raise ValueError("no rounds of users and assistants in this page")
    write_private_json(writable(path, roots, never), {"metadata": page.metadata, "sessions": list(sessions.values())})
