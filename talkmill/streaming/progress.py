"""Progress of sessions as a stream: a cursor for each session is kept as state and moves on with every micro-batch.

Events are stored rows and stated progress. The cursor is an aggregate of Spark's own: each task adds up what it has read of a session
before anything is shuffled, so a session with many rows costs a row for each task, and no Python is called for a session. What is given out
for a session in a micro-batch is its progress so far, by the rules of ``audit.session_progress``; the last of these is what a batch job
over all events gives, also when the stream was stopped in between.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import session_progress

#: ``n`` rows were stored, or (n null) progress was stated; the statement with the greatest ``seq`` counts.
EVENTS = "session_key string, n long, seq long, total_l0 long, next_offset long, completed boolean"
STATES = "session_key string, stored long, seq long, total_l0 long, next_offset long, completed boolean"
_STATEMENT = ("seq", "total_l0", "next_offset", "completed")


def session_states(events: DataFrame) -> DataFrame:
    """A stream of STATES from a stream of EVENTS: for each session of a micro-batch its cursor after it.

    The columns of a statement are aggregates of flat values, which are hashed; a struct would be sorted. All of them follow the same
    ``seq`` row by row, so they are those of one statement.
    """
    said = (F.max_by(c, "seq").alias(c) for c in _STATEMENT)
    return events.groupBy("session_key").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("stored"), *said)


@contextmanager
def rocksdb(spark: SparkSession):
    """Streams that are started inside keep their state in RocksDB, with a changelog, so that a micro-batch uploads what has changed."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def keep_states(events: DataFrame, out: str, checkpoint: str):
    """Starts a stream over what is there now; each micro-batch writes the states it has changed to a folder of its own, again if it is repeated."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    with rocksdb(events.sparkSession):
        return session_states(events).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_progress(spark: SparkSession, out: str) -> DataFrame:
    """Progress of every session, from the last state that ``keep_states`` has written of it."""
    states = spark.read.schema(f"{STATES}, batch long").parquet(out)
    last = states.groupBy("session_key").agg(*(F.max_by(c, "batch").alias(c) for c in ("stored", *_STATEMENT)))
    stored = last.where("stored > 0").select("session_key", F.col("stored").alias("l0"))
    stated = last.where("seq is not null").select("session_key", "total_l0", "next_offset", "completed")
    return session_progress(stored, stated)
