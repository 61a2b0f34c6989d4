"""Hard negatives by a block matrix multiply (SUMMA-style): rows and dimensions are cut into blocks, partial score tiles are added in a shuffle.

Scores are inner products of whole numbers: a component x counts as floor(scale * x). Rows are dealt into shards and vectors into chunks of
dimensions; the block (shard i, chunk k) meets the anchors' block (j, k) in one task, which gives the partial int64 tile (i, j, k). The
tiles of one (i, j) are added over k, and each full tile gives for every anchor what it needs from it, at most a few rows:

* the positives: the first rows of the anchor's label. Only shards of the anchor's bucket of labels are multiplied for these;
* then, for each anchor and positive, the first rows of other labels within the window of scores that the positive sets.

What tiles give is ranked per anchor (and positive), within tasks before it is shuffled. Anchors are a query set that the caller states, so
anchors x rows products are the work asked for; no block, tile or list of one is larger than the parameters say, whatever the tables' sizes.

Rows with a null id, a null label, a null vector, or a null or non-finite component take no part. Of rows that repeat an id the least
(label, vector) counts. Vectors may differ in length: missing components are 0. Components are held at +-limit(dimensions), so that a
hundred times any score stays within 64 bits (64 dimensions: 2^24, which is |x| up to 65,536 at a scale of 256). Equal scores go by id.
Empty tables, anchors without positives and windows without rows give no rows. Only the id, vector and label are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Rows of a block, anchors of a block: a tile is BLOCK_ROWS x BLOCK_ANCHORS scores of 8 bytes.
BLOCK_ROWS = 2048
BLOCK_ANCHORS = 512
#: Dimensions of a chunk at least, and chunks at most.
CHUNK = 32
CHUNKS = 8
#: Labels are dealt into this many buckets, so that positives are looked for among the shards of one bucket.
LABEL_BUCKETS = 16

_NEVER = np.int64(-(1 << 62))


def limit(dimensions: int) -> int:
    """The power of two at which components are held, so that a hundred times a score stays within 64 bits."""
    return 1 << (((1 << 55) // max(dimensions, 1)).bit_length() - 1) // 2


def whole_vectors(rows: DataFrame, scale: int = 256, label: Column | None = None) -> tuple[DataFrame, int]:
    """(vec_id, label, q, bucket) of the rows that take part, as a stored table, and the largest number of dimensions."""
    given = rows.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("x")).dropna()
    finite = given.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    dimensions = finite.agg(F.max(F.size("x"))).first()[0] or 0
    most = float(limit(dimensions))
    whole = F.transform("x", lambda v: F.floor(F.least(F.greatest(v * scale, F.lit(-most)), F.lit(most))))
    one = finite.select("vec_id", "label", whole.alias("q")).groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("v"))
    bucket = F.pmod(F.xxhash64("v.label"), F.lit(LABEL_BUCKETS)).cast("int")
    return stored(one.select("vec_id", "v.label", "v.q", bucket.alias("bucket")), "vectors"), dimensions


def _numbers(column: str, values: list[int]) -> Column:
    """The value that a list of one for each bucket has for a row."""
    return F.element_at(F.array(*map(F.lit, values)), F.col(column) + 1)


def _dealt(rows: DataFrame, counts: list[int], size: int) -> tuple[DataFrame, list[int], list[int]]:
    """Adds ``block``: rows of a bucket are dealt by a hash of their id over blocks of about ``size``. Also each bucket's first block and its number of them."""
    blocks = [-(-n // size) for n in counts]
    first = [sum(blocks[:b]) for b in range(len(blocks))]
    number = _numbers("bucket", first) + F.pmod(F.xxhash64("vec_id"), _numbers("bucket", [max(b, 1) for b in blocks])).cast("int")
    return rows.withColumn("block", number), first, blocks


def _span(first: Column, number: Column) -> Column:
    return F.when(number > 0, F.sequence(first, first + number - 1)).otherwise(F.array().cast("array<int>"))


def _chunked(rows: DataFrame, dimensions: int) -> DataFrame:
    """A row for each chunk of dimensions, k, in place of q."""
    size = max(CHUNK, -(-dimensions // CHUNKS))
    parts = F.transform(F.sequence(F.lit(0), F.lit(max(0, -(-dimensions // size) - 1))), lambda k: F.struct(k.alias("k"), F.slice("q", k * size + 1, F.lit(size)).alias("part")))
    return rows.withColumn("_c", F.explode(parts)).select(*(c for c in rows.columns if c != "q"), "_c.k", "_c.part")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of whole numbers as rows of a matrix, filled up with zeros."""
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
    return out


TILE = "i int, j int, row_ids binary, row_labels binary, anchor_ids binary, anchor_labels binary, windows binary, tile binary"
_TILE = pa.schema([("i", pa.int32()), ("j", pa.int32()), *((n, pa.binary()) for n in ("row_ids", "row_labels", "anchor_ids", "anchor_labels", "windows", "tile"))])


def _numpy(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().to_numpy(zero_copy_only=False)


def partial_tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
    """The tile of one (i, j, k): inner products over a chunk of dimensions. The first chunk's row also names the rows, anchors and windows."""
    if not rows.num_rows or not anchors.num_rows:
        return _TILE.empty_table()
    rows, anchors = rows.sort_by("vec_id"), anchors.rename_columns([c.removeprefix("anchor_") for c in anchors.column_names]).sort_by("vec_id")
    width = max(int(np.diff(t.column("part").combine_chunks().offsets.to_numpy()).max()) for t in (rows, anchors))
    tile = _matrix(anchors.column("part"), width) @ np.ascontiguousarray(_matrix(rows.column("part"), width).T)
    names = [None] * 5
    if rows.column("k")[0].as_py() == 0:
        windows = [(n, w["positive_id"], w["positive_score"]) for n, ws in enumerate(anchors.column("windows").to_pylist()) for w in ws or ()]
        names = [_numpy(t.column(c)).astype(np.int64).tobytes() for t in (rows, anchors) for c in ("vec_id", "label")] + [np.array(windows, np.int64).tobytes()]
    return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip([rows.column("i")[0].as_py(), rows.column("j")[0].as_py(), *names, tile.tobytes()], _TILE)], schema=_TILE)


class Scores:
    """A full tile: partial tiles added, and each anchor's order of the rows that are (not) of its label: by score, then by id."""

    def __init__(self, partials: pa.Table, same_label: bool):
        named = next(r for r in partials.drop_columns(["tile"]).to_pylist() if r["row_ids"] is not None)
        self.ids, labels, self.anchors, anchor_labels, windows = (np.frombuffer(named[c], np.int64) for c in ("row_ids", "row_labels", "anchor_ids", "anchor_labels", "windows"))
        self.windows = windows.reshape(-1, 3)
        scores = np.zeros((len(self.anchors), len(self.ids)), np.int64)
        for tile in partials.column("tile"):
            scores += np.frombuffer(tile.as_buffer(), np.int64).reshape(scores.shape)
        fit = labels[None, :] == anchor_labels[:, None]
        fit = fit & (self.ids[None, :] != self.anchors[:, None]) if same_label else ~fit
        scores[~fit] = _NEVER
        self.fit = fit.sum(axis=1)
        self.order = np.argsort(-scores, axis=1, kind="stable")  # rows stand by id
        self.scores = np.take_along_axis(scores, self.order, axis=1)


def _table(columns: list[list], names: list[str]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *c]), pa.int64()) for c in columns], names=names)


def _tiles(rows: DataFrame, anchors: DataFrame, dimensions: int) -> DataFrame:
    """Partial tiles of ``rows`` and ``anchors`` that have the same i and j."""
    by = ["i", "j", "k"]
    left = _chunked(rows, dimensions).select(*by, "vec_id", "label", "part")
    right = _chunked(anchors, dimensions).select(*(F.col(c).alias(f"anchor_{c}") for c in (*by, "vec_id", "label", "part", "windows")))
    return left.groupBy(*by).cogroup(right.groupBy(*(f"anchor_{c}" for c in by))).applyInArrow(partial_tile, TILE)


def first_of(rows: DataFrame, by: list[str], score: str, tie: str, most: int) -> DataFrame:
    """The first ``most`` rows of each group with their ``rank`` from 1. Ranks are taken within tasks before rows are shuffled."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def positives(rows: DataFrame, anchors: DataFrame, counts: list[int], anchor_counts: list[int], dimensions: int, most: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): the first ``most`` other rows of each anchor's label."""
    shards, first, number = _dealt(rows, counts, BLOCK_ROWS)
    blocks, first_anchor, anchor_number = _dealt(anchors, anchor_counts, BLOCK_ANCHORS)
    left = shards.withColumn("i", F.col("block")).withColumn("j", F.explode(_span(_numbers("bucket", first_anchor), _numbers("bucket", anchor_number))))
    right = blocks.withColumn("j", F.col("block")).withColumn("i", F.explode(_span(_numbers("bucket", first), _numbers("bucket", number))))
    none = F.array().cast("array<struct<positive_id:bigint,positive_score:bigint>>")

    def best(partials: pa.Table) -> pa.Table:
        s, out = Scores(partials, True), [[], [], []]
        for a, n in enumerate(np.minimum(s.fit, most)):
            for column, values in zip(out, (np.full(n, s.anchors[a]), s.ids[s.order[a, :n]], s.scores[a, :n])):
                column.append(values)
        return _table(out, ["anchor_id", "positive_id", "positive_score"])

    tops = _tiles(left, right.withColumn("windows", none), dimensions).groupBy("i", "j").applyInArrow(best, "anchor_id long, positive_id long, positive_score long")
    return first_of(tops, ["anchor_id"], "positive_score", "positive_id", most).drop("rank")


def hard_negatives(embeddings: DataFrame, anchor: Column, label: Column | None = None, scale: int = 256, most_positives: int = 5, most: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchor``, a condition on vec_id, picks.

    A negative has another label, and low * positive_score <= 100 * negative_score <= high * positive_score. ``label``: in place of the column.
    """
    rows, dimensions = whole_vectors(embeddings, scale, label)
    sizes = {r.bucket: r for r in rows.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if(anchor).alias("anchors")).collect()}  # LABEL_BUCKETS rows at most
    counts, anchor_counts = ([sizes[b][c] if b in sizes else 0 for b in range(LABEL_BUCKETS)] for c in ("n", "anchors"))
    anchors = rows.where(anchor)
    found = stored(positives(rows, anchors, counts, anchor_counts, dimensions, most_positives), "positives")
    windows = found.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("windows"))  # most_positives of an anchor
    shards, first, number = _dealt(rows, counts, BLOCK_ROWS)
    blocks = -(-sum(anchor_counts) // BLOCK_ANCHORS)
    asked = anchors.join(windows, F.col("vec_id") == F.col("anchor_id")).withColumn("j", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(max(blocks, 1))).cast("int"))
    left = shards.withColumn("i", F.col("block")).withColumn("j", F.explode(_span(F.lit(0), F.lit(blocks))))
    right = asked.withColumn("i", F.explode(_span(F.lit(0), F.lit(sum(number)))))

    def within(partials: pa.Table) -> pa.Table:
        s, out = Scores(partials, False), [[], [], [], [], []]
        for a, positive, score in s.windows.tolist():
            fit = -s.scores[a, : s.fit[a]]
            start = np.searchsorted(fit, -(high * score // 100), "left")
            end = min(np.searchsorted(fit, low * -score // 100, "right"), start + most)
            if start < end:
                n = end - start
                for column, values in zip(out, (np.full(n, s.anchors[a]), np.full(n, positive), np.full(n, score), s.ids[s.order[a, start:end]], -fit[start:end])):
                    column.append(values)
        return _table(out, ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    tops = _tiles(left, right, dimensions).groupBy("i", "j").applyInArrow(within, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    ranked = first_of(tops, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", most)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
