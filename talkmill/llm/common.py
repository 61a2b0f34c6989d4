"""Helpers that the training-data operators share: shared-folder tables and Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Texts are handled in Python in slices of about this many bytes, whatever the Arrow batch holds.
SLICE_BYTES = 4 << 20

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); one of our own only where it is unset and Spark runs on one machine, as in tests."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="spark-shared-"))
    return "file://" + _own_folder[0]


def stored(df: DataFrame, name: str, instead_of: DataFrame | None = None) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it back: cuts the lineage, survives lost executors, and is computed once.

    ``instead_of``: a stored table that nothing reads once this one is written, as between rounds; its files are removed.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    if instead_of is not None:
        discard(instead_of)
    return out


def discard(df: DataFrame) -> None:
    """Removes the files of a table that ``stored`` made and that nothing will read again."""
    spark = df.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(df.stored_path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: A side of a join is broadcast if it was counted to have at most this many rows of a few numbers.
BROADCAST_ROWS = 1_000_000
#: Keys that hold more than one in so many rows are joined by a broadcast of these keys: there are fewer of them than this.
HOT_KEYS = 500


def small(df: DataFrame) -> DataFrame:
    """A hint to broadcast ``df`` (a stored table of narrow rows) if it has at most BROADCAST_ROWS rows; else it is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def join_with_hot_keys(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table``, in which ``key`` is unique and ``weight`` counts the rows that have it; ``total`` of them in all.

    Keys with over 1/HOT_KEYS of the rows never meet in a shuffle: they are fewer than HOT_KEYS, so their part of the table is broadcast.
    """
    is_hot = F.col(weight) * HOT_KEYS > total
    hot = F.broadcast(table.where(is_hot))
    return rows.join(hot, key).unionByName(rows.join(F.broadcast(table.where(is_hot).select(key)), key, "left_anti").join(table.where(~is_hot), key))


def numbered_copies(rows: DataFrame, name: str, part: int = 10_000) -> DataFrame:
    """Adds ``name``: a number from 0 among equal rows, so that each row is told apart whatever the partitions. Copies are counted, never gathered."""
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("_copies"))
    parts = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / part))).alias("_part"))
    spread = parts.where(F.col("_copies") <= part).unionByName(parts.where(F.col("_copies") > part).repartition(F.xxhash64("_part", *rows.columns)))
    last = F.least(F.col("_part") * part + part, F.col("_copies")) - 1
    return spread.select(*rows.columns, F.explode(F.sequence(F.col("_part") * part, last)).alias(name))


#: Rows ranked in one window group come to about this many.
RANK_ROWS = 50_000


def ranked(rows: DataFrame, by: str, spread: str, ties: Sequence[str], buckets: int) -> DataFrame:
    """Adds ``rank``: gapless from 0 within each value of ``by``, in a fixed order.

    A bucket of the hash of ``spread`` is ranked by row numbers; counts per bucket give where it starts. So a value of ``by`` that holds
    a large part of all rows is still ranked in many tasks.
    """
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(spread), F.lit(buckets)).cast("int"))
    counts = rows.groupBy(by, "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy(by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(by, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy(by, "bucket").orderBy(spread, *ties)
    return rows.join(starts, [by, "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(inside) - 1).drop("bucket", "before")


def doc_crc(doc_id: Column | str) -> Column:
    """crc32 of the id written as text, for folds."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary"))


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def slices(batch: pa.RecordBatch, column: int = 1, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that the texts of each part come to about ``most`` bytes (one row at least)."""
    start, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()):
        if size and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


#: States that a Python worker keeps from one task to the next (vocabularies, caches of what was worked out for words): that of the running stage.
KEPT_STATES = 1
_states: OrderedDict[str, object] = OrderedDict()


def kept_state(key: str, start: Callable[[], object]) -> object:
    """The worker's state of ``key``, made by ``start`` if a task needs it for the first time."""
    if key not in _states:
        while len(_states) >= KEPT_STATES:
            _states.popitem(last=False)
        _states[key] = start()
    _states.move_to_end(key)
    return _states[key]


def map_texts(docs: DataFrame, rows: Callable[[list, list], Sequence[Sequence]], schema: T.StructType, start: Callable[[], object] | None = None, most: int = SLICE_BYTES) -> DataFrame:
    """Maps (doc_id, text) to rows of ``schema`` without a shuffle.

    ``rows(ids, texts[, state])`` gets lists and returns one list for each output column. ``start()`` makes a state, once a worker.
    Only doc_id and text are read, so further columns of any name do no harm.
    """
    names = [f.name for f in schema]
    key = uuid.uuid4().hex

    def run(batches):
        arrow = pa_schema(schema)
        state = (kept_state(key, start),) if start else ()
        for whole in batches:
            for batch in slices(whole, most=most):
                columns = rows(batch.column(0).to_pylist(), batch.column(1).to_pylist(), *state)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], names=names)
        pa.default_memory_pool().release_unused()  # the worker goes on to other stages

    return docs.select(F.col("doc_id"), F.col("text")).mapInArrow(run, schema)


def pa_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def text_column(column: str | Column, rows: Callable[..., list], returns: T.DataType, start: Callable[[], object] | None = None) -> Column:
    """A Column from an Arrow UDF over one text column, so that a stage keeps all other columns as they are."""
    out_type = pa_schema(T.StructType([T.StructField("x", returns)])).field(0).type
    key = uuid.uuid4().hex

    @F.arrow_udf(returns)
    def udf(texts: pa.Array) -> pa.Array:
        cell = (kept_state(key, start),) if start else ()
        values, batch = [], pa.RecordBatch.from_arrays([texts], names=["t"])
        for part in slices(batch, 0):
            values += rows(part.column(0).to_pylist(), *cell)
        return pa.array(values, type=out_type)

    return udf(column)


def free_name(columns: Sequence[str], name: str) -> str:
    """A column name that no column of the input has, in either case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Texts of a fitting sample come to at most this many bytes; documents of any length may be in it.
FIT_BYTES = 64 << 20
#: Of a longer text, a sample has one passage of so many characters, from a place that a hash of its id picks.
FIT_CHARS = 200_000


def fitting_sample(docs: DataFrame, bound: int, columns: Sequence[str], salt: int = 0, labels: DataFrame | None = None, most_bytes: int = FIT_BYTES, most_chars: int = FIT_CHARS) -> DataFrame:
    """(doc_id, text, *columns): about ``bound`` labelled rows at most, of ``most_bytes`` at most, one for each doc_id, picked by a hash of doc_id.

    The label ``columns`` stand in ``docs``, or in ``labels`` (doc_id, *columns), of which the greatest row of an id counts. Null ids, texts
    and labels are left out. Of repeated ids the least row stays, so the result does not depend on partitions. Ids are picked before texts
    are read, so that only the sample's texts are shuffled. Texts of over ``most_chars`` characters are in it with a passage of that length.
    If its texts are over the bound of bytes, they are taken in order of the hash, and one that does not fit any more is left out alone.
    """
    given = docs.select("doc_id", *columns).dropna() if labels is None else labels.select("doc_id", *columns).dropna().groupBy("doc_id").agg(*(F.max(c).alias(c) for c in columns))
    share = int(min(1.0, bound / max(given.count(), 1)) * (1 << 30))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 30))
    picked = draw < share
    spare = F.greatest(F.length("text") - most_chars, F.lit(0))
    passage = F.when(spare > 0, F.substring("text", 1 + F.pmod(F.xxhash64("doc_id", F.lit(salt + 1)), spare + 1).cast("int"), F.lit(most_chars))).otherwise(F.col("text"))
    rows = docs.where(picked).withColumn("text", passage)
    whole = rows.select("doc_id", "text", *columns).dropna() if labels is None else rows.select("doc_id", "text").dropna().join(given.where(picked), "doc_id")
    one = whole.groupBy("doc_id").agg(F.min(F.struct(*columns, "text")).alias("row"))
    sample = stored(one.select("doc_id", "row.text", *(f"row.{c}" for c in columns)), "sample")
    left, without = most_bytes, []
    for r in sample.select(draw.alias("draw"), F.octet_length("text").alias("n")).orderBy("draw", "n").collect():  # about ``bound`` pairs of numbers
        if r.n <= left:
            left -= r.n
        else:
            without.append(r.draw)
    return sample.where(~draw.isin(without)) if without else sample


class TokenRows(dict):
    """Numbers tokens from 0 in order of first sight; ``fresh`` holds those numbered since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, token: str) -> int:
        self[token] = n = len(self)
        self.fresh.append(token)
        return n
