"""Phrase collocations, mined SPAM-style: compressed position bitmaps of words are shifted and combined, popcounts are summed over shards.

A shard is a slice of a task's texts. Its words have position bitmaps of which only the 64-bit words that are not zero are kept, or, where
they have few positions, these; a place between pieces belongs to no word, so a phrase never leaves its piece. A phrase's bitmap, shifted by
one and combined (AND) with a word's, is the bitmap of the longer phrase, and its popcount is the phrase's occurrences in the shard. Phrases
grow depth-first, those of few positions together.

No phrase is more frequent than its parts, so three passes over the texts suffice, each with less to count than all phrases there are:

1. words are counted, and those of ``least`` occurrences or more go into a filter of bounded size;
2. pairs of such words are counted by 64-bit hashes, and those hashes of ``least`` or more go into a filter, too;
3. each shard mines depth-first along pairs that pass. What passes wrongly is counted exactly like the rest and is left out by its sum.

Sums per language and phrase are exact; scores are divisions of exact decimals. A null text is empty, a null lang is ``und``. Repeated rows
count as often as they stand, ids are not looked at, ties go by phrase in the order of UTF-8 bytes, and an empty table, or one without
frequent phrases, gives no rows. Only text and lang are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bloom import bloom_filter, passes
from .common import TokenRows, slices, stored

SEED = 42
#: Texts of a shard come to about this many bytes; a longer text is a shard of its own.
SHARD_BYTES = 4 << 20
#: Texts are taken apart by so many bytes at once.
PART_BYTES = 1 << 20
#: Words whose counts a task holds before it gives them out.
HELD_WORDS = 200_000
#: Phrases of so many positions in a shard keep them as a list, and others as bits; a list is combined with a word's bits by looking its places up.
FEW = 256
#: Marks between pieces become a full stop, which no word holds then; the tab becomes a space; A-Z are lower-cased.
_MARKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"." * 10 + b" ")


def numbered_words(text: bytes, numbers: TokenRows) -> np.ndarray:
    """The numbers of the text's words, with that of the full stop between pieces. Texts are cut at spaces, so memory is bounded by numbers."""
    data, at, out = text.lower().translate(_MARKS), 0, [np.zeros(1, np.int32)]
    while at < len(data):
        end = data.find(b" ", at + PART_BYTES)
        end = len(data) if end < 0 else end
        words = data[at:end].replace(b".", b" . ").split()
        out.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        at = end
    return np.concatenate(out)


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, TokenRows]]:
    """(lang, numbers of all words in order, numbering) for each language of each slice of texts. The number 0 parts pieces."""
    for whole in batches:
        for batch in slices(whole, most=SHARD_BYTES):
            langs = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary())
            for lang in dict.fromkeys(langs):
                numbers = TokenRows()
                numbers[b"."]
                yield lang, np.concatenate([numbered_words(texts[i].as_py() or b"", numbers) for i, x in enumerate(langs) if x == lang]), numbers
        pa.default_memory_pool().release_unused()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.col("text"))


def word_hashes(lang: str, numbers: TokenRows) -> np.ndarray:
    """XXH64 of lang, tab and word, by number."""
    lead = lang.encode() + b"\t"
    return np.fromiter((xxhash.xxh64_intdigest(lead + w, SEED) for w in numbers), np.uint64, len(numbers))


def word_hash() -> Column:
    """The same in Spark."""
    return F.xxhash64(F.concat("lang", F.lit("\t"), "phrase"))


#: Positions whose pairs are hashed at once.
SPAN = 1 << 18


def spans(ids: np.ndarray, fit: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, hashes) of the pairs of words that ``fit``, a span of positions at a time."""
    for a in range(0, len(ids) - 1, SPAN):
        part = ids[a : a + SPAN + 1]
        at = np.flatnonzero(fit[part[:-1]] & fit[part[1:]])
        yield a + at, pair_hashes(hashes[part[at]], hashes[part[at + 1]])


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first * np.uint64(0xC2B2AE3D27D4EB4F) + (second ^ (second >> np.uint64(31))) * np.uint64(0x165667B19E3779F9)
    return x ^ (x >> np.uint64(33))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, f) for each word; the phrase '' has the number of all words."""

    def run(batches):
        held: dict[str, dict[bytes, int]] = {}

        def given_out():
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["lang", "phrase", "n"])
            held.clear()

        for lang, ids, numbers in shards(batches):
            n = np.bincount(ids, minlength=len(numbers)).tolist()
            mine = held.setdefault(lang, {b"": 0})
            mine[b""] += sum(n[1:])
            for word, k in zip(numbers, n):
                mine[word] = mine.get(word, 0) + k
            del mine[b"."]
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from given_out()
        yield from given_out()

    return _texts(docs).mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def pair_sums(docs: DataFrame, words) -> DataFrame:
    """(pair, f): occurrences by hash of pairs of words that pass ``words``, a broadcast filter."""

    def run(batches):
        for lang, ids, numbers in shards(batches):
            h = word_hashes(lang, numbers)
            fit = passes(words.value, h)
            fit[0] = False
            codes, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *(codes for _, codes in spans(ids, fit, h))]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(n, pa.int32())], names=["pair", "n"])

    return _texts(docs).mapInArrow(run, "pair long, n int").groupBy("pair").agg(F.sum("n").alias("f"))


class Bitmap:
    """Positions as bits, without the 64-bit words that are zero."""

    __slots__ = ("at", "bits")

    def __init__(self, at: np.ndarray, bits: np.ndarray):
        self.at, self.bits = at, bits

    @classmethod
    def of(cls, positions: np.ndarray) -> Bitmap:
        """From positions in order."""
        word = positions >> 6
        first = np.flatnonzero(np.diff(word, prepend=-1))
        return cls(word[first], np.bitwise_or.reduceat(np.uint64(1) << (positions & 63).astype(np.uint64), first))

    def shifted(self) -> Bitmap:
        """One position further: what leaves a 64-bit word enters the next one."""
        carry = self.bits >> np.uint64(63)
        moved = self.bits << np.uint64(1)
        over = np.flatnonzero(carry)
        if not len(over):
            return Bitmap(self.at, moved)
        at = np.concatenate([self.at, self.at[over] + 1])
        bits = np.concatenate([moved, carry[over]])
        order = np.argsort(at, kind="stable")
        at, bits = at[order], bits[order]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        return Bitmap(at[first], np.bitwise_or.reduceat(bits, first))

    def __and__(self, other: Bitmap) -> Bitmap:
        few, many = (self, other) if len(self.at) <= len(other.at) else (other, self)
        place = np.minimum(np.searchsorted(many.at, few.at), len(many.at) - 1)
        bits = few.bits & many.bits[place]
        there = np.flatnonzero((many.at[place] == few.at) & (bits != 0))
        return Bitmap(few.at[there], bits[there])

    def positions(self) -> np.ndarray:
        row, bit = np.nonzero(np.unpackbits(self.bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        return (self.at[row] << 6) + bit

    def count(self) -> int:
        return int(np.bitwise_count(self.bits).sum())


def grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values, how often each stands, and the places in order of value, then of place."""
    order = np.argsort(values, kind="stable")
    first = np.flatnonzero(np.diff(values[order], prepend=-1))
    return values[order[first]], np.diff(first, append=len(values)), order


class Shard:
    """Mines phrases of 2 to ``longest`` words along pairs that pass the filter ``pairs``; ``found[n]`` has (words, occurrences) of those of n words."""

    def __init__(self, ids: np.ndarray, hashes: np.ndarray, pairs: np.ndarray, longest: int):
        self.ids, self.longest = ids, longest
        self.found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(longest + 1)]
        # Phrases of few positions wait here: words, numbers of positions, and these one after the other (the phrase's last word).
        self.few: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in range(longest + 1)]
        self.goes_on = np.zeros(len(ids), bool)  # where a word and the next one are a pair that passes
        for at, codes in spans(ids, np.arange(len(hashes)) > 0, hashes):
            self.goes_on[at[passes(pairs, codes)]] = True
        used = np.flatnonzero(self.goes_on | np.concatenate([[False], self.goes_on[:-1]]))
        words, sizes, order = grouped(ids[used])
        places, many = used[order], sizes > FEW
        self.few[1].append((words[~many, None], sizes[~many], places[np.repeat(~many, sizes)]))
        ends = np.cumsum(sizes)
        self.bitmaps = {int(words[k]): Bitmap.of(places[ends[k] - sizes[k] : ends[k]]) for k in np.flatnonzero(many)}
        for word, bitmap in self.bitmaps.items():
            self.extend((word,), bitmap)
        for length in range(1, longest):
            self.extend_few(length)

    def extend(self, phrase: tuple[int, ...], bitmap: Bitmap) -> None:
        """Depth-first: the bitmap is shifted, and combined with that of each word of many positions that follows; what has few positions waits."""
        ends, moved, longer = bitmap.positions(), bitmap.shifted(), len(phrase) + 1
        ends = ends[self.goes_on[ends]] + 1
        words, sizes, order = grouped(self.ids[ends])
        few = sizes <= FEW
        names = np.column_stack([np.tile(np.array(phrase, words.dtype), (few.sum(), 1)), words[few]])
        self.found[longer].append((names, sizes[few]))
        self.few[longer].append((names, sizes[few], ends[order][np.repeat(few, sizes)]))
        for word in words[~few].tolist():
            both = moved & self.bitmaps[word]
            self.found[longer].append((np.array([(*phrase, word)], words.dtype), np.array([both.count()])))
            if longer < self.longest:
                self.extend((*phrase, word), both)

    def extend_few(self, length: int) -> None:
        """All phrases of few positions of a length at once: a position is looked up in the next word's, and runs of equal phrases are counted."""
        names, sizes, ends = (np.concatenate(x) for x in zip(*self.few[length]))
        phrase = np.repeat(np.arange(len(names)), sizes)
        on = self.goes_on[ends]
        phrase, ends = phrase[on], ends[on] + 1
        code, n, order = grouped(phrase << 32 | self.ids[ends])
        longer = np.column_stack([names[code >> 32], (code & 0xFFFFFFFF).astype(names.dtype)])
        self.found[length + 1].append((longer, n))
        if length + 1 < self.longest:
            self.few[length + 1].append((longer, n, ends[order]))


def phrase_counts(docs: DataFrame, pairs, longest: int) -> DataFrame:
    """(lang, phrase, f, words): sums over shards of what is mined along pairs that pass ``pairs``, a broadcast filter."""

    def run(batches):
        for lang, ids, numbers in shards(batches):
            words = pa.array(list(numbers), pa.binary()).cast(pa.string())
            for found in Shard(ids, word_hashes(lang, numbers), pairs.value, longest).found[2:]:
                names, n = (np.concatenate(x) for x in zip(*found))
                phrase = pc.binary_join_element_wise(*(words.take(pa.array(column)) for column in names.T), " ")
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), phrase, pa.array(n, pa.int64()), pa.array(np.full(len(n), names.shape[1], np.int32))], names=["lang", "phrase", "n", "words"])

    return _texts(docs).mapInArrow(run, "lang string, phrase string, n long, words int").groupBy("lang", "phrase").agg(F.sum("n").alias("f"), F.max("words").alias("words"))


def first_rows(rows: DataFrame, by: str, order: list[Column], spread: str, most: int) -> DataFrame:
    """The first ``most`` rows of each value of ``by``, with their rank from 1: within parts first, so that no task gets a large value's rows."""
    for parts in (256, 16, 1):
        part = F.pmod(F.xxhash64(spread), F.lit(parts))
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(by, part).orderBy(*order))).where(F.col("rank") <= most)
    return rows.withColumn("rank", F.col("rank").cast("long"))


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, share: int = 50, most: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``most`` phrases of 2 to ``longest`` words that stand ``least`` times or more.

    A cut of a phrase in two parts scores floor(1000000 a a / (l r)), and the lowest-scoring cut counts. A phrase goes if a longer one that
    holds it has ``share`` percent of its occurrences or more.
    """
    spark = docs.sparkSession
    words = stored(word_counts(docs).where((F.col("f") >= least) | (F.col("phrase") == "")), "words")
    frequent = spark.sparkContext.broadcast(bloom_filter(words.where("phrase <> ''").select(word_hash().alias("hash"))))
    pairs = stored(pair_sums(docs, frequent).where(F.col("f") >= least).select("pair"), "pairs")
    along = spark.sparkContext.broadcast(bloom_filter(pairs))
    phrases = stored(phrase_counts(docs, along, longest).where(F.col("f") >= least), "phrases")
    counts = words.where("phrase <> ''").unionByName(phrases.select("lang", "phrase", "f"))
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - words)"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    exact = lambda c: f"cast({c} as decimal(15,0))"
    score = F.expr(f"cast({exact('a')} * {exact('a')} * 1000000 as decimal(38,0)) div ({exact('l')} * {exact('r')})")
    cuts = stored(cuts.withColumn("score", score.cast("long")), "cuts")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    held = _held_inside(phrases, share, longest)
    fit = best.join(held, ["lang", "phrase"], "left_anti").select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ranked = first_rows(fit, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], "phrase", most)
    totals = words.where("phrase = ''").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _held_inside(phrases: DataFrame, share: int, longest: int) -> DataFrame:
    """(lang, phrase): phrases that stand inside a longer one which has ``share`` percent of their occurrences or more."""
    spans = [(k, m) for k in range(longest) for m in range(2, longest) if k + m <= longest]
    words = F.split("phrase", " ", -1)
    part = lambda k, m: F.when((F.size(words) > m) & (F.size(words) >= k + m), F.array_join(F.slice(words, k + 1, m), " "))
    parts = F.array_distinct(F.array_compact(F.array(*(part(k, m) for k, m in spans)))) if spans else F.array().cast("array<string>")
    inner = phrases.where("words > 2").select("lang", F.col("f").alias("longer"), F.explode(parts).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return phrases.join(most, ["lang", "phrase"]).where(F.col("longer") * 100 >= F.col("f") * share).select("lang", "phrase")
