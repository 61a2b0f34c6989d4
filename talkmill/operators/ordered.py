"""Running sums and previous rows of a group, in chunks, so that a group with a large part of all rows is not one task's work."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stage import staged

#: Consecutive numbers of an order column that make a chunk.
CHUNK = 50_000
#: Keys with more rows than this are joined by a broadcast; there is at most one such key for each so many rows.
HOT_ROWS = 1_000_000
#: A counted side of narrow rows is broadcast up to this many.
BROADCAST_ROWS = 1_000_000


def narrow(df: DataFrame) -> DataFrame:
    """A hint to broadcast ``df`` (computed once, a few short columns) if it has at most BROADCAST_ROWS rows; else it is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def join_null_safe(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on ``keys`` in which nulls equal nulls; ``table`` gives its other columns."""
    renamed = table.select(*(F.col(k).alias(f"_k_{k}") for k in keys), *(c for c in table.columns if c not in keys))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys))
    joined = rows.join(renamed, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*(f"_k_{k}" for k in keys))


def join_unique(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which has a row for each of their ``keys`` and in ``weight`` the rows that have it.

    The table is computed once, as a stage. If it has keys with over HOT_ROWS rows, these never meet in a shuffle: their part of the table
    is broadcast. ``weight`` is dropped.
    """
    table = staged(table, "unique")
    if not table.where(F.col(weight) > HOT_ROWS).isEmpty():
        hot, cold = table.where(F.col(weight) > HOT_ROWS), table.where(F.col(weight) <= HOT_ROWS)
        calm = join_null_safe(rows, F.broadcast(hot.select(*keys)), keys, "left_anti")
        return join_null_safe(rows, F.broadcast(hot), keys).unionByName(join_null_safe(calm, cold, keys)).drop(weight)
    return join_null_safe(rows, table, keys).drop(weight)


def chunk_of(order: Column, size: int = CHUNK) -> Column:
    return F.floor(order / size).cast("long")


def running_sum(rows: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[Column], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` up to each row in its group. ``chunk`` must not fall along ``order``. Null keys are groups like others."""
    cut = rows.withColumn("_chunk", chunk).withColumn("_value", value)
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = cut.groupBy(*keys, "_chunk").agg(F.sum("_value").alias("_sum")).select(*keys, "_chunk", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return join_null_safe(cut, before, [*keys, "_chunk"]).withColumn(name, F.col("_before") + F.sum("_value").over(within)).drop("_chunk", "_value", "_before")


def prefix_sums(rows: DataFrame, order: Sequence[Column], value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` (a long that is never null) over all rows before a row, by ``order``, which should be total.

    Rows go to ranges of the order and are summed up along each range as they come; the ranges' totals, one for each partition, give where
    a range begins. No window is over more than that, whatever the keys. The result is a stage.
    """
    kept = list(rows.columns)
    dealt = rows.withColumn("_value", value.cast("long")).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    schema = T.StructType([*dealt.schema.fields, T.StructField("_before", T.LongType())])

    def run(batches):
        total = 0
        for batch in batches:
            values = batch.column(len(kept)).to_numpy(zero_copy_only=False)
            upto = total + np.cumsum(values)
            if len(values):
                total = int(upto[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto - values, pa.int64())], names=schema.names)

    summed = staged(dealt.mapInArrow(run, schema), "ranges")
    totals = sorted((r._part, r.total) for r in summed.groupBy("_part").agg(F.sum("_value").alias("total")).collect())  # a row for each partition
    starts = zip((p for p, _ in totals), accumulate((t for _, t in totals), initial=0))
    table = rows.sparkSession.createDataFrame(list(starts), "_part int, _start long")
    return summed.join(F.broadcast(table), "_part").select(*kept, (F.col("_start") + F.col("_before")).alias(name))


def previous_row(rows: DataFrame, keys: Sequence[str], order: str, payload: Column, name: str, size: int = CHUNK) -> DataFrame:
    """Adds ``payload`` of the row before in the group, by the long column ``order``; null for the first."""
    cut = rows.withColumn("_chunk", chunk_of(F.col(order), size)).withColumn("_payload", payload)
    earlier = Window.partitionBy(*keys).orderBy("_chunk")
    ends = cut.groupBy(*keys, "_chunk").agg(F.max_by("_payload", order).alias("_end"))
    ends = ends.select(*keys, "_chunk", F.lag("_end").over(earlier).alias("_before"))
    within = Window.partitionBy(*keys, "_chunk").orderBy(order)
    return join_null_safe(cut, ends, [*keys, "_chunk"]).withColumn(name, F.coalesce(F.lag("_payload").over(within), F.col("_before"))).drop("_chunk", "_payload", "_before")


def first_rows(rows: DataFrame, keys: Sequence[str], order: str, payload: Column, name: str) -> DataFrame:
    """Adds ``payload`` of the group's first row: a partial aggregate joined back, large groups by broadcast."""
    firsts = rows.groupBy(*keys).agg(F.min_by(payload, order).alias(name), F.count("*").alias("_rows"))
    return join_unique(rows, firsts, list(keys), "_rows")
