"""Sequence packing as a cutting-stock problem, solved by column generation over the histogram of piece lengths.

Documents over the capacity are cut into full pieces and a rest. The driver only sees the histogram of lengths, put into a few hundred
classes. A linear program chooses how often to use each pattern (a multiset of classes that fits a sequence);
knapsack dynamic programming prices new patterns until none helps. Patterns are rounded, what is left of the histogram is packed best-fit
decreasing, and the pieces, ranked within their class by Spark, take their places in the patterns by arithmetic.

Null text counts as empty: one piece with the end token alone. Rows with a null doc_id are packed like others, repeated rows each; equal
rows are numbered first, so ranks have no ties and do not depend on partitions. An empty table gives no rows. Only doc_id and text are
read, so further columns of any name do no harm.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import RANK_ROWS, map_texts, numbered_copies, ranked, stored

CAPACITY = 2048
#: (up to this length, tokens to a length class); longer pieces go by LAST_GRAIN. Sizes that are multiples of each other settle the program soon.
GRAINS, LAST_GRAIN = ((8, 1), (16, 2), (32, 4)), 8
#: If patterns of whole rests leave more than this share of the tokens as padding, rests are cut into parts of CUT tokens first.
PADDING, CUT = 0.01, 256
#: A length that would waste over this share of all tokens in its class gets a class of its own.
WASTE = 1 / 4000
END_ID = 1
#: Words of one generation of a worker's cache (two are kept), and the longest that is kept, in characters; words encoded at once.
CACHE_WORDS, CACHE_CHARS, BATCH = 200_000, 200, 1000
#: Bytes of texts that are tokenized at once; what that takes is many times as much.
SLICE_BYTES = 2 << 20

#: A character that marks, while a text is cut, a part without a space before it; texts that hold it themselves are cut without it.
NO_SPACE = "\x01"
#: No white space of any kind, in Arrow's patterns.
_SOLID = r"[^\s\p{Z}\x0b\x{85}\x1c-\x1f]"
_UNSURE, _SURE = re.compile(r" (?:\s|\Z)|\x01"), re.compile(r"(?<=\S) (?=\S)")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of a byte-level BPE file by the tokenizers library, without special tokens put in, as little-endian unsigned 32-bit bytes.

    The pattern that parts a text before BPE always starts a new part at a single space between two other characters, before a mark that
    follows a letter or digit, and on both sides of a single line feed between other characters. So texts are cut there, and parts that
    were seen before have their ids in a cache.
    """

    def __init__(self, path: str | None = None, cache_words: int = CACHE_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or tokenizer_path())
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [t.content for t in added.values()]
        self.between, self.between_id = (self.added[0], next(iter(added))) if added else (None, None)
        self.cache_words = cache_words
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, words: list[str]) -> list[bytes]:
        """The ids of each word. Words are encoded at once with an added token between them, which the tokenizer cuts out before anything else."""
        if self.between is None or any(t in w for w in words for t in self.added):
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        ids = np.array(self.tokenizer.encode_batch_fast([self.between.join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = 4 * np.flatnonzero(ids == self.between_id)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *(ends + 4).tolist()], [*ends.tolist(), len(raw)], strict=True)]

    def ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of each of the different ``words``, each encoded as one part of a text: from the cache, or by the tokenizer."""
        if len(self.cache) > self.cache_words:
            self.cache, self.older = {}, self.cache
        cache, older = self.cache, self.older
        for w in [w for w in words if w not in cache]:
            if (ids := older.get(w)) is not None:
                cache[w] = ids
        new = [w for w in words if w not in cache]
        for at in range(0, len(new), BATCH):
            cache.update(zip(new[at : at + BATCH], self.encode(new[at : at + BATCH]), strict=True))
        out = list(map(cache.__getitem__, words))
        for w in new:
            if len(w) > CACHE_CHARS:
                del cache[w]
        return out

    def many(self, texts: Sequence[str | None]) -> list[bytes]:
        """The ids of each text (null: none). Texts are cut to parts and parts counted up by Arrow; each different part is looked up once."""
        out = [b""] * len(texts)
        odd = [k for k, t in enumerate(texts) if t and (_UNSURE.search(t) or any(x in t for x in self.added))]
        plain = sorted({k for k, t in enumerate(texts) if t} - set(odd))
        for k in odd:
            first, *words = _SURE.split(texts[k])
            words = [first, *(" " + w for w in words)]
            different = list(dict.fromkeys(words))
            found = dict(zip(different, self.ids_of(different), strict=True))
            out[k] = b"".join(map(found.__getitem__, words))
        if plain:
            marked = pa.array([NO_SPACE + texts[k] for k in plain])
            marked = pc.replace_substring_regex(marked, r"([\p{L}\p{N}])([.,;:!?])", rf"\1 {NO_SPACE}\2")
            marked = pc.replace_substring_regex(marked, rf"({_SOLID})\n({_SOLID})", f"\\1 {NO_SPACE}\n {NO_SPACE}\\2")
            cut = pc.split_pattern(marked, " ")
            coded = cut.flatten().dictionary_encode()
            which = np.asarray(coded.indices)
            found = self.ids_of([w[1:] if w[:1] == NO_SPACE else " " + w for w in coded.dictionary.to_pylist()])
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            ids, start = np.frombuffer(b"".join(found), "<u4"), np.r_[0, np.cumsum(sizes)[:-1]]
            length = sizes[which]
            end = np.cumsum(length)
            ids = ids[np.repeat(start[which] - (end - length), length) + np.arange(end[-1])]
            upto = np.r_[0, end][np.asarray(cut.offsets)]
            for k, a, b in zip(plain, upto[:-1].tolist(), upto[1:].tolist(), strict=True):
                out[k] = ids[a:b].tobytes()
        return out


PIECES = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: Callable[[], WordTokenizer] = WordTokenizer) -> DataFrame:
    """A row per piece: full pieces of ``capacity`` ids and a rest. Ids stay in the task; only crc32s go on, of the piece and of its parts of CUT ids."""
    schema = T.StructType([*PIECES, T.StructField("parts", T.ArrayType(T.LongType()))])

    def rows(ids, texts, words):
        out: list[list] = [[] for _ in schema]
        for i, data in zip(ids, words.many(texts), strict=True):
            data += END_ID.to_bytes(4, "little")
            n = len(data) // 4
            for a in range(0, n, capacity):
                b = min(a + capacity, n)
                crc = zlib.crc32(data[4 * a : 4 * b])
                parts = [zlib.crc32(data[4 * x : 4 * min(x + CUT, b)]) for x in range(a, b, CUT)] if CUT < b - a < capacity else [crc]
                for c, v in zip(out, (i, a, b - a, crc, n, parts), strict=True):
                    c.append(v)
        return out

    return map_texts(docs, rows, schema, tokenizer, SLICE_BYTES)


def cut_to_parts(cut: DataFrame, capacity: int) -> DataFrame:
    """The pieces with rests cut to parts of CUT ids."""
    part = F.when((F.col("length") < capacity) & (F.col("length") > CUT), F.transform("parts", lambda crc, k: F.struct((F.col("start") + k * CUT).alias("start"), F.least(F.lit(CUT), F.col("length") - k * CUT).cast("long").alias("length"), crc.alias("crc"))))
    whole = F.array(F.struct("start", "length", F.col("ids_crc32").alias("crc")))
    return cut.select("doc_id", "doc_tokens", F.explode(F.coalesce(part, whole)).alias("p")).select("doc_id", "p.start", "p.length", F.col("p.crc").alias("ids_crc32"), "doc_tokens")


def parts_of(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The histogram of lengths that ``cut_to_parts`` gives."""
    out: dict[int, int] = {}
    for n, c in counts.items():
        for size, each in ((n, 1),) if n == capacity or n <= CUT else ((CUT, n // CUT), (n % CUT, 1)):
            if size:
                out[size] = out.get(size, 0) + each * c
    return out


def length_classes(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """length -> the size in tokens that pieces of this length count with: rounded up to a grain, or the length itself if that would waste much."""

    def rounded(n: int) -> int:
        grain = next((g for most, g in GRAINS if n <= most), LAST_GRAIN)
        return min(-(-n // grain) * grain, capacity)

    total = sum(n * c for n, c in counts.items())
    return {n: n if (rounded(n) - n) * c > WASTE * total else rounded(n) for n, c in counts.items()}


# ---------------------------------------------------------------- the program, on the histogram


def knapsack(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The best value of a multiset of items that fits ``room``, and its counts: unbounded knapsack by dynamic programming.

    Item by item, each as often as it helps: with room c it is best[c - k * size] + k * value for some k, a running maximum along c, c +
    size, c + 2 * size and so on. Items that smaller ones can replace at no loss are passed over.
    """
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for k in np.argsort(sizes, kind="stable").tolist():
        size, value = int(sizes[k]), float(values[k])
        if value <= best[size] + 1e-12:
            continue
        rows = -(-(room + 1) // size)
        grid = np.full(rows * size, -np.inf)
        grid[: room + 1] = best
        taken = (np.arange(rows) * value)[:, None]
        new = (np.maximum.accumulate(grid.reshape(rows, size) - taken, axis=0) + taken).ravel()[: room + 1]
        better = new > best + 1e-12
        best = np.where(better, new, best)
        last[better] = k
    counts, c = np.zeros(len(sizes), np.int64), room
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[last[c]] += 1
            c -= int(sizes[last[c]])
    return float(best[room]), counts


def inverse_of(basis: np.ndarray) -> np.ndarray:
    """By Gauss-Jordan steps with row exchanges, in plain numpy: threaded BLAS may hang in a driver that has forked Spark's gateway."""
    m = len(basis)
    work = np.concatenate([basis, np.eye(m)], axis=1)
    for k in range(m):
        p = k + int(np.abs(work[k:, k]).argmax())
        work[[k, p]] = work[[p, k]]
        work[k] /= work[k, k]
        rows = np.flatnonzero(work[:, k])
        rows = rows[rows != k]
        work[rows] -= work[rows, k][:, None] * work[k]
    return work[:, m:]


def column_generation(sizes: np.ndarray, demand: np.ndarray, room: int, steps: int = 2000, gap: float = 0.001) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows: counts per class) and how often to use each: a basic solution of the linear program.

    Knapsacks are priced with a mean of the current and the best known prices, which settles sooner. Prices divided by the best pattern's
    worth bound the optimum from below; the work ends when no pattern helps or the bound is within ``gap``.
    """
    m = len(sizes)
    if not m:
        return np.zeros((0, 0), np.int64), np.zeros(0)
    basis = np.diag(room // sizes).astype(float)  # column p: counts of pattern p
    inverse = np.diag(1.0 / (room // sizes))
    bound, kept = 0.0, None
    for step in range(steps):
        if step % 100 == 99:
            inverse = inverse_of(basis)
        use = (inverse * demand).sum(axis=1)
        prices = inverse.sum(axis=0)  # every pattern costs one sequence
        mixed = prices if kept is None else 0.7 * kept + 0.3 * prices
        gain, column = knapsack(np.maximum(mixed, 0), sizes, room)
        if (lower := float((np.maximum(mixed, 0) * demand).sum()) / max(gain, 1e-9)) > bound:
            bound, kept = lower, mixed
        if (prices * column).sum() <= 1 + 1e-7:  # the mean misled: price with the current prices alone
            gain, column = knapsack(np.maximum(prices, 0), sizes, room)
            if gain <= 1 + 1e-7:
                break
            kept = 0.5 * kept + 0.5 * prices if kept is not None else None
        if use.sum() - bound <= max(0.5, gap * bound):
            break
        step_in = (inverse * column).sum(axis=1)
        ratio = np.where(step_in > 1e-9, np.maximum(use, 0) / np.where(step_in > 1e-9, step_in, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
        pivot = inverse[out] / step_in[out]
        inverse -= step_in[:, None] * pivot
        inverse[out] = pivot
    return basis.T.astype(np.int64), np.maximum((inverse_of(basis) * demand).sum(axis=1), 0)


def best_fit_decreasing(sizes: np.ndarray, left: np.ndarray, room: int) -> list[tuple[dict[int, int], int]]:
    """Packs what the rounded patterns leave over: [(items of a sequence, number of sequences)]; like sequences are handled together."""
    open_: dict[int, dict[tuple, int]] = {}  # free tokens -> items -> sequences
    for k in np.argsort(-sizes, kind="stable").tolist():
        n, size = int(left[k]), int(sizes[k])
        while n:
            free = min((f for f in open_ if f >= size), default=room)
            held = open_.get(free) or {(): n}  # or new sequences
            items, there = next(iter(held.items()))
            most = free // size
            each = min(most, n)
            used = min(there, n // each)
            if free in open_:
                held[items] -= used
                if not held[items]:
                    del held[items]
                    if not held:
                        del open_[free]
            now = open_.setdefault(free - each * size, {})
            key = (*items, (k, each))
            now[key] = now.get(key, 0) + used
            n -= used * each
    out: dict[tuple, int] = {}
    for held in open_.values():
        for items, count in held.items():
            out[items] = out.get(items, 0) + count
    return [({int(sizes[k]): n for k, n in items}, count) for items, count in out.items()]


def plan(histogram: dict[int, int], room: int) -> list[tuple[dict[int, int], int]]:
    """[(pattern as class size -> count, number of sequences)] that uses up the histogram (class size -> pieces) exactly."""
    sizes = np.array(sorted(histogram), np.int64)
    if not len(sizes):
        return []
    demand = np.array([histogram[int(s)] for s in sizes], float)
    patterns, use = column_generation(sizes, demand, room)
    whole = np.floor(use + 1e-6).astype(np.int64)
    left = demand.astype(np.int64) - patterns.T @ whole
    while (left < 0).any():  # a count that rounding took too often
        k = int(left.argmin())
        p = int(np.flatnonzero((patterns[:, k] > 0) & (whole > 0))[0])
        whole[p] -= 1
        left += patterns[p]
    for p in np.argsort(whole - use, kind="stable"):  # up, where there is enough left of all that the pattern takes
        if (patterns[p] <= left).all() and patterns[p].any():
            whole[p] += 1
            left = left - patterns[p]
    out = [({int(sizes[k]): int(n) for k, n in enumerate(row) if n}, int(c)) for row, c in zip(patterns, whole, strict=True) if c]
    return out + best_fit_decreasing(sizes, left, room)


def places(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, end rank, pieces a sequence, first sequence): where the ranked pieces of each class go."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for items, count in patterns:
        for k, n in items.items():
            a = rank.get(k, 0)
            out.append((k, a, a + n * count, n, sequence))
            rank[k] = a + n * count
        sequence += count
    return out


def planned(lengths: dict[int, int], capacity: int) -> tuple[dict[int, int], list[tuple[dict[int, int], int]], int]:
    """(length -> class, patterns, number of sequences) for a histogram of lengths."""
    classes, histogram = length_classes(lengths, capacity), {}
    for n, size in classes.items():
        histogram[size] = histogram.get(size, 0) + lengths[n]
    patterns = plan(histogram, capacity)
    return classes, patterns, sum(c for _, c in patterns)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: Callable[[], WordTokenizer] = WordTokenizer) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. No sequence is over ``capacity``."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, capacity, tokenizer), "pieces")
    lengths = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    tokens = sum(n * c for n, c in lengths.items())
    classes, patterns, used = planned(lengths, capacity)
    if (used - 1) * capacity * (1 - PADDING) > tokens and (other := planned(parts_of(lengths, capacity), capacity))[2] < used:
        (classes, patterns, used), cut = other, cut_to_parts(cut, capacity)
    cut = cut.select(*PIECES.names).join(F.broadcast(spark.createDataFrame(list(classes.items()), "length long, class int")), "length")
    rows = places(patterns)
    table = spark.createDataFrame(rows, "class int, first long, end long, each long, sequence long")
    own = numbered_copies(cut, "copy").withColumn("spread", F.xxhash64("doc_id", "start", "ids_crc32", "copy"))
    order = ranked(own, "class", "spread", ["doc_id", "start", "ids_crc32", "doc_tokens", "copy"], max(256, tokens // (capacity * RANK_ROWS)))
    # The table of places is bounded by the number of classes and patterns, not by the corpus.
    placed = order.join(F.broadcast(table), (order["class"] == table["class"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end")))
    placed = placed.withColumn("sequence_id", F.col("sequence") + F.floor((F.col("rank") - F.col("first")) / F.col("each")).cast("long")).drop(table["class"])
    before = Window.partitionBy("sequence_id").orderBy(F.desc("class"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long"))).select(*PIECES.names, "sequence_id", "offset")
