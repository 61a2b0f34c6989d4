"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary.

Every language has a probability for each piece of the vocabulary. A word's probability in a language is the sum over all its
segmentations into pieces, by the forward algorithm; a text's is the product over its words. The piece probabilities are learned by
expectation maximisation (forward-backward) from word counts of a bounded sample of rows with a language.

Words are runs of letters (of any script, whole at any length) in lower case; each token's scores are computed once and kept. Null texts
and texts without a letter are ``und`` with score 0, and so is everything if nothing could be learned, as from an empty table. Of
languages with equal probability the first by name is taken. Texts are read whole, at any length. Only doc_id, text and (for learning)
lang are read, so further columns of any name do no harm. Repeated rows get equal results.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TokenRows, fitting_sample, map_texts

UNKNOWN = "und"
#: Rows that the probabilities are learned from, about, at most; rounds of expectation maximisation.
FIT_ROWS, ROUNDS = 4000, 4
#: Words of up to this many characters go through arrays, many at once; longer ones one by one with rescaling. Learning looks at stretches of this length.
PART = 40
#: Tokens whose scores a worker keeps, and their characters; tokens scored at once.
CACHE_TOKENS, CACHE_CHARS, BATCH = 400_000, 20_000_000, 20_000
#: Added to each piece's count: a share of its count in all languages, and a constant.
SHARED, CONSTANT = 0.02, 0.01

LETTERS = regex.compile(r"\p{L}+")


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read_pieces(path: str | None = None) -> list[str]:
    """The vocabulary's pieces that can stand in lower-case words; a word starts with the mark that pieces have for a space."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path or vocabulary_path())
    plain = (i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)))
    return sorted({p for i in plain if (p := sp.id_to_piece(i)) and (p == "▁" or LETTERS.fullmatch(p.removeprefix("▁"))) and p == p.lower()})


def words_of(token: str) -> list[str]:
    """The token's runs of letters, marked at their start."""
    return ["▁" + r for r in LETTERS.findall(token.lower())]


def stretches(token: str) -> list[str]:
    """The same cut to PART characters, to learn from."""
    return [w[a : a + PART] for w in words_of(token) for a in range(0, len(w), PART)]


def prefix_table(index: dict[str, int]) -> dict[str, int]:
    """Every start of a piece -> the piece's row, or -1 if it is no piece itself."""
    out = {p[:n]: -1 for p in index for n in range(1, len(p))}
    return out | index


class Lattice:
    """Pieces at every place of many words, by word length: ids[word, start, length - 1] is a row of the probabilities."""

    def __init__(self, index: dict[str, int], words: Sequence[str], prefixes: dict[str, int] | None = None):
        none, unknown = len(index) + 1, len(index)
        prefixes = prefixes or prefix_table(index)
        get = prefixes.get
        longest = max(map(len, index), default=1)
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            by_length.setdefault(len(w), []).append(k)
        self.count, self.groups = len(words), []
        for n, which in sorted(by_length.items()):
            ids = np.full((len(which), n, min(n, longest)), none, np.int32)
            for r, k in enumerate(which):
                w = words[k]
                row = ids[r]
                for i in range(n):
                    first = get(w[i])
                    row[i, 0] = unknown if first is None or first < 0 else first
                    if first is not None:
                        for end in range(i + 2, n + 1):
                            p = get(w[i:end])
                            if p is None:
                                break
                            if p >= 0:
                                row[i, end - i - 1] = p
            sizes = np.flatnonzero((ids != none).any(axis=(0, 1))) + 1
            self.groups.append((np.array(which), ids[:, :, : sizes[-1]], sizes.tolist()))

    def forward(self, ids: np.ndarray, sizes: Sequence[int], p: np.ndarray) -> np.ndarray:
        """words x places x languages: the summed probability of all segmentations up to each place."""
        words, n, _ = ids.shape
        alpha = np.zeros((words, n + 1, p.shape[1]))
        alpha[:, 0] = 1
        for end in range(1, n + 1):
            for size in sizes:
                if size <= end:
                    alpha[:, end] += alpha[:, end - size] * p[ids[:, end - size, size - 1]]
        return alpha

    def log_scores(self, p: np.ndarray) -> np.ndarray:
        """words x languages."""
        out = np.zeros((self.count, p.shape[1]))
        for which, ids, sizes in self.groups:
            out[which] = np.log(self.forward(ids, sizes, p)[:, -1])
        return out

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected piece counts under ``p`` when each word stands ``counts`` (words x languages) times."""
        out = np.zeros_like(p)
        for which, ids, sizes in self.groups:
            alpha = self.forward(ids, sizes, p)
            n = ids.shape[1]
            beta = np.zeros_like(alpha)
            beta[:, n] = 1
            weight = counts[which] / alpha[:, -1]
            for start in range(n - 1, -1, -1):
                for size in sizes:
                    if size <= n - start:
                        piece = ids[:, start, size - 1]
                        on = p[piece] * beta[:, start + size]
                        beta[:, start] += on
                        share = alpha[:, start] * on * weight
                        for k in range(p.shape[1]):
                            out[:, k] += np.bincount(piece, share[:, k], len(p))
        out[-1] = 0
        return out


def long_scores(word: str, prefixes: dict[str, int], unknown: int, p: list[list[float]], longest: int) -> list[float]:
    """The log probability of a word of any length in each language: the same sums, kept for the next ``longest`` places only and rescaled."""
    languages = range(len(p[0]))
    log, n = [0.0 for _ in languages], len(word)
    ahead = deque([[1.0] * len(languages)] + [[0.0] * len(languages) for _ in range(longest)])
    for i in range(n):
        if i % 16 == 0:
            for k in languages:
                scale = sum(a[k] for a in ahead)
                log[k] += math.log(scale)
                for a in ahead:
                    a[k] /= scale
        here = ahead.popleft()
        ahead.append([0.0] * len(languages))
        first = prefixes.get(word[i])
        step, to = p[unknown if first is None or first < 0 else first], ahead[0]
        for k in languages:
            to[k] += here[k] * step[k]
        if first is not None:
            for end in range(i + 2, min(i + longest, n) + 1):
                piece = prefixes.get(word[i:end])
                if piece is None:
                    break
                if piece >= 0:
                    step, to = p[piece], ahead[end - i - 1]
                    for k in languages:
                        to[k] += here[k] * step[k]
    return [log[k] + math.log(ahead[0][k]) for k in languages]


def learn(index: dict[str, int], words: Sequence[str], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities (pieces, unknown characters, none) x languages from ``counts`` (words x languages)."""
    if not counts.size:
        return np.zeros((len(index) + 2, counts.shape[1]))
    lattice = Lattice(index, words)
    p = np.full((len(index) + 2, counts.shape[1]), 1 / (len(index) + 1))
    p[-1] = 0
    for _ in range(rounds):
        found = lattice.expected(p, counts)
        p = found + SHARED * found.mean(axis=1, keepdims=True) + CONSTANT
        p[-1] = 0
        p /= p.sum(axis=0)
    return p


@dataclass
class LanguageModel:
    """languages; index: piece -> row of ``p``; prior: log share of each language's rows."""

    languages: list[str]
    index: dict[str, int]
    p: np.ndarray
    prior: np.ndarray


@dataclass
class Scorer:
    """Scores texts; a token's log probabilities are computed once while it is kept."""

    model: LanguageModel
    tokens: TokenRows = field(default_factory=TokenRows)
    rows: list[np.ndarray] = field(default_factory=list)
    chars: int = 0

    def __post_init__(self):
        self.prefixes, self.longest = prefix_table(self.model.index), max(map(len, self.model.index), default=1)
        self.plain = self.model.p.tolist()

    def word_scores(self, words: Sequence[str]) -> np.ndarray:
        """words x languages, whatever their length."""
        out = np.zeros((len(words), len(self.model.languages)))
        short = [k for k, w in enumerate(words) if len(w) <= PART]
        if short:
            out[short] = Lattice(self.model.index, [words[k] for k in short], self.prefixes).log_scores(self.model.p)
        for k, w in enumerate(words):
            if len(w) > PART:
                out[k] = long_scores(w, self.prefixes, len(self.model.index), self.plain, self.longest)
        return out

    def _add_fresh(self) -> None:
        fresh, self.tokens.fresh = self.tokens.fresh, []
        self.chars += sum(map(len, fresh))
        for a in range(0, len(fresh), BATCH):
            some = fresh[a : a + BATCH]
            parts = [words_of(t) for t in some]
            flat = sorted({w for ws in parts for w in ws})
            place = {w: k for k, w in enumerate(flat)}
            score = np.vstack([self.word_scores(flat), np.zeros((1, len(self.model.languages)))])
            of = np.repeat(np.arange(len(some)), [len(ws) for ws in parts])
            at = [place[w] for ws in parts for w in ws]
            sums = np.stack([np.bincount(of, score[at, k], len(some)) for k in range(score.shape[1])] + [np.bincount(of, minlength=len(some)).astype(float)], axis=1)
            self.rows.append(sums)

    def __call__(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        names, n = self.model.languages, len(self.model.languages)
        if not n:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        if len(self.tokens) > CACHE_TOKENS or self.chars > CACHE_CHARS:
            self.tokens, self.rows, self.chars = TokenRows(), [], 0
        number = self.tokens.__getitem__
        ids = [np.fromiter(map(number, t), np.int64, len(t)) for t in ((text or "").split() for text in texts)]
        self._add_fresh()
        if len(self.rows) > 1:
            self.rows = [np.concatenate(self.rows)]
        table = self.rows[0] if self.rows else np.zeros((0, n + 1))
        sums = np.array([table[i].sum(axis=0) for i in ids]).reshape(len(ids), n + 1)
        log = sums[:, :n] + self.model.prior
        chance = np.exp(log - log.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        best = chance.argmax(axis=1)
        known = sums[:, n] > 0
        return [names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], np.where(known, chance[np.arange(len(ids)), best], 0.0).tolist()


def train_languages(docs: DataFrame, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS, path: str | None = None) -> LanguageModel:
    """A model learned from about ``fit_rows`` rows of ``docs`` (doc_id, text, lang); words are counted by Spark, per language."""
    sample = fitting_sample(docs, fit_rows, ["lang"], 2)
    shares = {r.lang: r.n for r in sample.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # as many rows as languages
    languages = sorted(shares)
    index = {p: k for k, p in enumerate(read_pieces(path))}
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("words", T.ArrayType(T.StringType()))])
    words = map_texts(sample, lambda ids, texts: (ids, [stretches(t) for t in texts]), schema)
    counted = words.join(sample.select("doc_id", "lang"), "doc_id").select("lang", F.explode("words").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    place: dict[str, int] = {}
    entries = [(place.setdefault(r.word, len(place)), languages.index(r.lang), r.n) for r in counted.orderBy("word", "lang").toLocalIterator()]
    counts = np.zeros((len(place), len(languages)))
    for w, k, n in entries:
        counts[w, k] = n
    p = learn(index, list(place), counts, rounds)
    return LanguageModel(languages, index, p, np.log(np.array([shares[x] for x in languages]) / max(1, sum(shares.values()))))


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row for each row of ``docs``: doc_id, lang_pred and score, the probability of that language among those learned. No shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded by vocabulary x languages
    return map_texts(docs, lambda ids, texts, scorer: (ids, *scorer(texts)), SCHEMA, lambda: Scorer(held.value))
