"""Benchmark decontamination: seeds of word pairs join training passages to test items, Smith-Waterman alignment scores each passage.

Words are lower-cased tokens without marks at their ends. A seed is a pair of an item's words that stand next to each other or with one
word between; a document has it if the two words stand so there, with or without a word between. Seeds lose no passage that full
alignment would find: an alignment of m words at a share s of the score of an item of n words spends 2 * (m - s * n) at most on what lies
between its words, so at least s * n - 1 words have their next one at most one word on, in the item and in the passage. Of an
item's places, those with the rarest pairs are its seeds, so many that every such alignment holds HITS of them close together. Pairs are
counted over all documents; so what many items have in common is a seed of an item only as far as the item has too little of its own.
Items of one or two words are a seed as a whole: a document has them if all their words stand so there.

The test items are the stated query set; they go through in blocks of bounded bytes, each held by every task. Documents are mapped in
place: no shuffle of texts, no skew by passage or copy. Null, empty and wordless documents and items match nothing, and so do empty
tables; repeated items are reported each, repeated documents too; of an item's equally good passages in a document the one with most
seeds is reported, then the first. Only doc_id and text (item_id and text) are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import KEPT_STATES, free_name, map_texts, slices, stored, text_column

#: Places from a seed's first word to its second, and seeds that a passage must hit (or as many as an alignment is sure to have).
STEPS, HITS = (1, 2), 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: Share of an item's own alignment score from which a passage counts as a copy.
LEAST_SCORE = 0.5
#: Characters of the test items in a block (one item at least), and alignments computed at once. A block's seeds take about 30 times as many bytes.
BLOCK_CHARS, BATCH = 4_000_000, 256
#: Cells of an alignment row that a batch has, about, at most (one passage at least).
CELLS = 100_000
#: Words that a worker keeps; fewer where documents are dropped, as other stages run in the same workers.
CACHE_WORDS, CACHE_WORDS_DROP = 400_000, 80_000
EDGE = ".,;:!?()[]{}\"'<>|*%&#$-_/+=~`^«»“”‘’…"


def core(token: str) -> str:
    return token.lower().strip(EDGE)


class WordIds(dict):
    """token -> id of its word among the items' words, -1 for other words, -2 for tokens without a word."""

    def __init__(self, words: dict[str, int], most: int = CACHE_WORDS):
        super().__init__()
        self.words, self.most = words, most

    def __missing__(self, token: str) -> int:
        if len(self) >= self.most:
            self.clear()
        word = core(token)
        self[token] = n = self.words.get(word, -1) if word else -2
        return n

    def of(self, text: str | None) -> np.ndarray:
        tokens = (text or "").split()
        ids = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        return ids[ids != -2]


@dataclass
class Items:
    """A block of test items as word ids, and their pairs as sorted codes."""

    ids: list[int]
    words: dict[str, int]
    texts: list[np.ndarray]
    pairs: np.ndarray

    @classmethod
    def of(cls, rows: Sequence[tuple[int, str]]) -> Items:
        words: dict[str, int] = {}
        texts = [np.array([words.setdefault(w, len(words)) for t in (text or "").split() if (w := core(t))], np.int64) for _, text in rows]
        out = cls([i for i, _ in rows], words, texts, np.zeros(0, np.int64))
        found = [out.codes(t, step) for t in texts for step in STEPS] + [out.single(t) for t in texts if len(t) == 1]
        out.pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *found]))
        return out

    def codes(self, ids: np.ndarray, step: int) -> np.ndarray:
        """A code for each pair of words ``step`` places apart; negative if one of the words is in no item."""
        first, second = ids[:-step], ids[step:]
        return np.where((first < 0) | (second < 0), -1, first * (len(self.words) + 1) + second)

    def single(self, ids: np.ndarray) -> np.ndarray:
        """A code for each word alone, which no pair has."""
        return np.where(ids < 0, -1, ids * (len(self.words) + 1) + len(self.words))

    def seeds(self, frequency: np.ndarray, least: float = LEAST_SCORE) -> Seeds:
        """The places of each item with the rarest pairs, so many that every alignment at ``least`` has as many of them as ``hits`` says."""
        codes, item, place = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        hits, drift = np.ones(len(self.texts), np.int64), np.zeros(len(self.texts), np.int64)
        for k, text in enumerate(self.texts):
            if not len(text):
                continue
            if len(text) == 1:
                codes.append(self.single(text))
                item.append(np.array([k]))
                place.append(np.array([0]))
                continue
            sure = max(1, math.ceil(least * len(text) - 1e-9) - 1)
            hits[k], drift[k] = min(sure, HITS), math.floor(2 * len(text) * (1 - least) + 1e-9)
            found = [self.codes(text, step) for step in STEPS]
            often = np.zeros(len(text) - 1, np.int64)
            for c in found:
                often[: len(c)] += frequency[np.searchsorted(self.pairs, c)]
            chosen = np.argsort(often, kind="stable")[: len(often) - sure + hits[k]]
            for c in found:
                at = chosen[chosen < len(c)]
                codes.append(c[at])
                item.append(np.full(len(at), k))
                place.append(at)
        code, item, place = np.concatenate(codes), np.concatenate(item), np.concatenate(place)
        order = np.argsort(code, kind="stable")
        one, start, count = np.unique(code[order], return_index=True, return_counts=True)
        return Seeds(one, start, count, item[order], place[order], hits, drift)


@dataclass
class Seeds:
    """Codes, and for each its stretch of (item's place, position); for each item the hits a passage needs and how far diagonals may drift."""

    codes: np.ndarray
    start: np.ndarray
    count: np.ndarray
    item: np.ndarray
    place: np.ndarray
    hits: np.ndarray
    drift: np.ndarray


def find(sorted_codes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``codes`` that are among ``sorted_codes``, and their places there."""
    if not len(sorted_codes) or not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(sorted_codes, codes)
    hit = np.flatnonzero((codes >= 0) & (sorted_codes[np.minimum(at, len(sorted_codes) - 1)] == codes))
    return hit, at[hit]


def pair_frequency(docs: DataFrame, items: Items) -> np.ndarray:
    """In how many documents each of the items' pairs stands; the driver gets one number for each pair."""

    def run(batches):
        cache, counts = WordIds(items.words), np.zeros(len(items.pairs), np.int64)
        for whole in batches:
            for batch in slices(whole, 0):
                for text in batch.column(0).to_pylist():
                    ids = cache.of(text)
                    counts[np.unique(np.concatenate([find(items.pairs, items.codes(ids, step))[1] for step in STEPS]))] += 1
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some], pa.int64())], names=["pair", "n"])

    out = np.zeros(len(items.pairs), np.int64)
    for r in docs.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.pair] = r.n
    return out


def smith_waterman(passages: Sequence[np.ndarray], items: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment scores of passage-item pairs, and the passage position each ends at; a batch goes row by row of the items.

    Within a row the gaps in the passage are a running maximum: the score at j is the best of h[i] + GAP * (j - i) over i <= j.
    """
    n, wide, long = len(items), max(map(len, passages)), max(map(len, items))
    p = np.full((n, wide), -3, np.int64)
    t = np.full((n, long), -4, np.int64)
    for k in range(n):
        p[k, : len(passages[k])] = passages[k]
        t[k, : len(items[k])] = items[k]
    slope = np.arange(wide) * -GAP
    above = np.zeros((n, wide), np.int64)
    best, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(long):
        step = np.where(p == t[:, i : i + 1], MATCH, MISMATCH)
        step[:, 1:] += above[:, :-1]
        row = np.maximum(np.maximum(step, above + GAP), 0)
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        row[:, :] = np.where((t[:, i] == -4)[:, None], 0, row)
        at = row.argmax(axis=1)
        top = row[np.arange(n), at]
        better = top > best
        best[better], end[better] = top[better], at[better]
        above = row
    return best, end


class Matcher:
    """Finds the items that texts hold."""

    def __init__(self, items: Items, seeds: Seeds, least: float = LEAST_SCORE, most: int = CACHE_WORDS):
        self.items, self.seeds, self.least = items, seeds, least
        self.size = np.array([len(t) for t in items.texts], np.int64)
        self.cache = WordIds(items.words, most)
        self.singles = bool((self.size == 1).any())

    def passages(self, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item's place, start, end, seed hits) of each passage that enough hits point at; it has room for every alignment through them."""
        seeds = self.seeds
        found = [find(seeds.codes, self.items.codes(ids, step)) for step in STEPS]
        if self.singles:
            found.append(find(seeds.codes, self.items.single(ids)))
        at, which = (np.concatenate(x) for x in zip(*found, strict=True))
        count = seeds.count[which]
        if not count.sum():
            return []
        of = np.repeat(seeds.start[which] - np.cumsum(count) + count, count) + np.arange(count.sum())
        k, diagonal = seeds.item[of], np.repeat(at, count) - seeds.place[of]
        order = np.lexsort((diagonal, k))
        k, diagonal = k[order], diagonal[order]
        last = np.arange(len(k)) + seeds.hits[k] - 1
        end = np.minimum(last, len(k) - 1)
        first = np.flatnonzero((last < len(k)) & (k[end] == k) & (diagonal[end] - diagonal <= seeds.drift[k]))
        near = np.zeros(len(k) + 1, np.int64)
        np.add.at(near, first, 1)
        np.add.at(near, last[first] + 1, -1)
        kept = np.cumsum(near[:-1]) > 0
        k, diagonal = k[kept], diagonal[kept]
        if not len(k):
            return []
        drift = seeds.drift[k]
        starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (diagonal[1:] - diagonal[:-1] > drift[1:])])
        ends = np.r_[starts[1:], len(k)]
        a = np.maximum(diagonal[starts] - drift[starts], 0)
        b = np.minimum(diagonal[ends - 1] + self.size[k[starts]] + drift[starts], len(ids))
        return list(zip(k[starts].tolist(), a.tolist(), b.tolist(), (ends - starts).tolist(), strict=True))

    def __call__(self, texts: Sequence[str | None]) -> list[list[tuple[int, float, int, int]]]:
        """For each text [(item's place, score, seed hits, last word of the passage)], the best passage of each item that reaches the score."""
        jobs, parts = [], []
        for d, text in enumerate(texts):
            ids = self.cache.of(text)
            for k, a, b, n in self.passages(ids):
                jobs.append((d, k, n, a))
                parts.append(ids[a:b])
        best: list[dict[int, tuple[float, int, int]]] = [{} for _ in texts]
        order = sorted(range(len(jobs)), key=lambda j: len(parts[j]))  # passages of like length go together
        at = 0
        while at < len(order):
            size = next((n for n in range(1, BATCH) if at + n == len(order) or (n + 1) * len(parts[order[at + n]]) > CELLS), BATCH)
            some, at = order[at : at + size], at + size
            score, end = smith_waterman([parts[j] for j in some], [self.items.texts[jobs[j][1]] for j in some])
            for j, s, e in zip(some, score.tolist(), end.tolist(), strict=True):
                d, k, n, start = jobs[j]
                share = s / (MATCH * len(self.items.texts[k]))
                if share >= self.least and (k not in best[d] or (share, n) > best[d][k][:2]):
                    best[d][k] = (share, n, start + e)
        return [[(k, *v) for k, v in sorted(b.items())] for b in best]


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("seeds", T.LongType()), T.StructField("last_word", T.LongType())])


def item_blocks(benchmark: DataFrame, block: int = BLOCK_CHARS):
    """The test items, block by block, through the driver one at a time."""
    rows: list[tuple[int, str]] = []
    size = 0
    for r in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        if rows and size + len(r.text) > block:
            yield Items.of(rows)
            rows, size = [], 0
        rows.append((r.item_id, r.text))
        size += len(r.text)
    if rows:
        yield Items.of(rows)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE, block: int = BLOCK_CHARS) -> DataFrame:
    """A row for each document and test item it holds: doc_id, item_id, score (0 to 1), seed hits, and the passage's last word in the text."""
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    for items in item_blocks(benchmark, block):
        seeds = items.seeds(pair_frequency(docs, items), least)
        matcher = docs.sparkSession.sparkContext.broadcast((items, seeds))

        def rows(ids, texts, match, items=items.ids):
            found = [(i, items[k], share, n, end) for i, got in zip(ids, match(texts), strict=True) for k, share, n, end in got]
            return list(zip(*found, strict=True)) if found else [[] for _ in SCHEMA]

        out = out.unionByName(stored(map_texts(docs, rows, SCHEMA, lambda matcher=matcher: Matcher(*matcher.value, least)), "hits"))
        matcher.unpersist()
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE, block: int = BLOCK_CHARS, least_words: int = 3) -> DataFrame:
    """``docs`` without the rows that hold a test item of at least ``least_words`` words; all columns stay as they are.

    By default an item of one or two words takes no document out: it says nothing about where a document is from. ``contaminated`` reports it.
    """
    out = docs
    for k, items in enumerate(item_blocks(benchmark, block)):
        if k and k % KEPT_STATES == 0:
            out = stored(out, "clean")  # a worker keeps so many blocks at a time
        seeds = items.seeds(pair_frequency(docs, items), least)
        matcher = docs.sparkSession.sparkContext.broadcast((items, seeds))
        flag = free_name(docs.columns, "_held")
        counts = np.array([len(t) >= least_words for t in items.texts], bool)
        held = text_column(F.col("text"), lambda texts, match, counts=counts: [any(counts[got[0]] for got in found) for found in match(texts)], T.BooleanType(), lambda matcher=matcher: Matcher(*matcher.value, least, CACHE_WORDS_DROP))
        out = out.withColumn(flag, held).where(~F.col(flag)).drop(flag)
    return out
