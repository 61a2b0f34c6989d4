"""Import of planned rows into a store, batch by batch: each phase is journalled, and an import that was broken off goes on after its last phase.

Phases: planned, rows-committed (rows and their index are staged), lines-appended (dated JSON lines), then verified-ok (the store's next
version is published) or stop. Every phase's work may be repeated without effect. An import that has ended is not begun again; after a stop
another batch id is needed, as batch-001-retry-1.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import state
from ..sources import sinks
from ..sources.versions import Store

ROWS = "record_id string, session_key string, session_id string, role string, message_text string, ts_ms long, compare_key string"
INDEX = "record_id string, session_key string, role string, fts_text string, message_text string, ts_ms long"


def open_store(spark: SparkSession, root: str) -> Store:
    return Store(spark, root, {"rows": ROWS, "index": INDEX})


def _rows(planned: DataFrame) -> DataFrame:
    return planned.select("record_id", "session_key", "session_id", "role", F.col("captured").alias("message_text"), "ts_ms", "compare_key")


def _index(planned: DataFrame, tokenize: Callable[[Column], Column]) -> DataFrame:
    return planned.select("record_id", "session_key", "role", tokenize(F.col("captured")).alias("fts_text"), F.col("captured").alias("message_text"), "ts_ms")


def import_batch(store: Store, planned: DataFrame, month: str, batch_id: str, tokenize: Callable[[Column], Column] = lambda text: text, allowed: list[tuple[str, str]] | None = None) -> str:
    """Takes an import of ``planned`` (capture.planned_rows with session_id) from its last phase to its end, and returns that: verified-ok or stop.

    Where ``allowed`` is given, other (month, batch_id) are refused with a ValueError and nothing is written.
    """
    batch = f"{state.valid_month(month)}-{state.valid_batch_id(batch_id)}"
    if allowed is not None and (month, batch_id) not in allowed:
        raise ValueError(f"not a batch that may be imported: {batch}")
    entries = {e["phase"]: e["facts"] for e in store.journal(batch)}
    for end in ("verified-ok", "stop"):
        if end in entries:
            return end
    folders = {table: f"{table}/{batch}" for table in store.schemas}
    if "planned" not in entries:
        base = store.current()
        store.note(batch, "planned", {"version": base.number, "accepted_total": base.accepted_total, "planned": planned.count()})
    if "rows-committed" not in entries:
        store.stage("rows", _rows(planned), batch)
        store.stage("index", _index(planned, tokenize), batch)
        store.note(batch, "rows-committed", {})
    written = store.read_folders("rows", [folders["rows"]])
    if "lines-appended" not in entries:
        sinks.write_dated_lines(written, f"{store.root}/lines", batch_id=batch)
        store.note(batch, "lines-appended", {})
    base = store.current()
    if any(b["batch"] == batch for b in base.batches):  # published, and lost before it was noted
        store.note(batch, "verified-ok", {"version": base.number})
        return "verified-ok"
    gate = verified(store, base, folders).first()
    if not (gate.verified and gate.may_run):  # an empty batch may not be imported
        store.note(batch, "stop", {k: str(v) for k, v in gate.asDict().items()})
        return "stop"
    new = store.publish(base, batch, folders, gate.planned, status="OK", basis=f"accepted before {base.accepted_total}, rows {gate.planned}")
    store.note(batch, "verified-ok", {"version": new.number})
    return "verified-ok"


def verified(store: Store, base, folders: dict[str, str]) -> DataFrame:
    """One row: the gate of what is live, and would be live with the staged batch."""
    read = lambda table: store.read_folders(table, [*base.folders(table), folders[table]])
    batch = store.read_folders("rows", [folders["rows"]])
    return state.import_gate(batch, store.read("rows", base), read("rows"), base.accepted_total, fts_before=store.read("index", base), fts_after=read("index"))


def import_stream(planned: DataFrame, root: str, month: str, checkpoint: str, **options):
    """Starts a stream of planned rows; each micro-batch is an import of its own, batch-001 the first. A repeated micro-batch goes on where its import was."""
    store = open_store(planned.sparkSession, root)

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            if import_batch(store, rows, month, f"batch-{number + 1:03d}", **options) == "stop":
                raise RuntimeError(f"the import of micro-batch {number} was stopped by its checks")
        finally:
            rows.unpersist()

    return planned.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
