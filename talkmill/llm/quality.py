"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of about PASSAGE words. Every passage is encoded from what its words look like and which they are (signs
drawn from their hashes); gated attention weighs the passages' codes, and the document's score is a logistic function of the weighted
code. Encoder, attention and output are learned together from document labels, on a bounded sample, by gradients written out in numpy.

Null and empty texts are a bag of one empty passage and get a score like any other. Repeated rows get equal results; rows are judged one
by one, so there are no ties. Texts are read whole, at any length. Only doc_id, text and (for learning) the label are read, so further
columns of any name do no harm. Without labels of both values, as from empty tables, the score is the share of label 1, or 0.5 without
any; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import TokenRows, fitting_sample, map_texts

#: Words of a passage; labelled rows to fit on, about, at most.
PASSAGE, FIT_ROWS = 64, 6000
#: Width of a passage's code and of the attention.
CODE, GATE = 16, 8
STEPS, BAGS, RATE, L2 = 800, 256, 0.01, 1e-4
CACHE_TOKENS, CACHE_CHARS = 400_000, 20_000_000
#: Signs that a word's hash gives.
SIGNS = 8
#: Score from which a document counts as good.
LEAST_SCORE = 0.3

_LETTER, _DIGIT, _SIGN = re.compile(r"[^\W\d_]"), re.compile(r"\d"), re.compile(r"[^\w\s]")
TOKEN_STATS = ("length", "letters", "digits", "signs", "upper", "title", "no letter", "sentence end", "comma", "run of signs", "bar", "long", "vowels", "markup", "at or link", *(f"sign {k}" for k in range(SIGNS)))
STATS = (*TOKEN_STATS, "words", "distinct", "repeats", "repeats of the one before last")
WIDTH = len(STATS)


def token_stats(token: str) -> tuple[float, ...]:
    n, word = len(token), xxhash.xxh64_intdigest(token.lower().strip(".,;:!?()[]{}\"'"))
    letters, digits, signs = len(_LETTER.findall(token)), len(_DIGIT.findall(token)), len(_SIGN.findall(token))
    return (
        min(n, 30) / 10, letters / n, digits / n, signs / n,
        float(letters > 1 and token.isupper()), float(token[0].isupper()), float(not letters), float(token[-1] in ".!?"), float(token[-1] in ",;:"),
        float(bool(re.search(r"[^\w\s]{2}", token))), float("|" in token), float(n > 20), sum(c in "aeiouyAEIOUY" for c in token) / n, float(any(c in "<>{}\\" for c in token)), float("@" in token or "//" in token),
        *(float(word >> k & 1) - 0.5 for k in range(SIGNS)),
    )


@dataclass
class Encoder:
    """Passages of texts as rows of STATS: means of the words' stats, and how much the words repeat."""

    tokens: TokenRows = field(default_factory=TokenRows)
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, len(TOKEN_STATS)), np.float32))
    chars: int = 0

    def __call__(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(passages x STATS, passages of each text)."""
        if len(self.tokens) > CACHE_TOKENS or self.chars > CACHE_CHARS:
            self.tokens, self.table, self.chars = TokenRows(), self.table[:0], 0
        number = self.tokens.__getitem__
        ids = [np.fromiter(map(number, t), np.int64, len(t)) for t in ((text or "").split() for text in texts)]
        if self.tokens.fresh:
            self.table = np.concatenate([self.table, np.array([token_stats(t) for t in self.tokens.fresh], np.float32)])
            self.chars += sum(map(len, self.tokens.fresh))
            self.tokens.fresh = []
        parts = np.array([max(1, -(-len(i) // PASSAGE)) for i in ids], np.int64)
        out = np.zeros((int(parts.sum()), WIDTH), np.float32)
        at = 0
        for i, n in zip(ids, parts, strict=True):
            if len(i):
                starts = np.arange(0, len(i), PASSAGE)
                sizes = np.diff(np.r_[starts, len(i)])
                of = np.repeat(np.arange(n), sizes)
                some = out[at : at + n]
                some[:, : len(TOKEN_STATS)] = np.add.reduceat(self.table[i], starts, axis=0) / sizes[:, None]
                some[:, -4] = sizes / PASSAGE
                key = np.sort(of * (len(self.tokens) + 1) + i)
                some[:, -3] = np.bincount(key[np.r_[True, key[1:] != key[:-1]]] // (len(self.tokens) + 1), minlength=n) / sizes
                some[:, -2] = np.bincount(of[1:], i[1:] == i[:-1], n) / sizes
                some[:, -1] = np.bincount(of[2:], i[2:] == i[:-2], n) / sizes
            at += n
        return out, parts


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product without BLAS, whose threads may hang in a driver that has forked Spark's gateway."""
    return np.einsum("ij,jk->ik", a, b)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class AttentionModel:
    """mean, scale: of the stats. weights: encoder (e, be), attention (v, u, w), output (c, b)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, stats: np.ndarray, parts: np.ndarray) -> dict[str, np.ndarray]:
        w, starts = self.weights, np.r_[0, np.cumsum(parts)[:-1]]
        x = (stats - self.mean) / self.scale
        h = np.tanh(_dot(x, w["e"]) + w["be"])
        t, g = np.tanh(_dot(h, w["v"])), _sigmoid(_dot(h, w["u"]))
        score = (t * g * w["w"]).sum(axis=1)
        top = np.maximum.reduceat(score, starts)
        a = np.exp(score - np.repeat(top, parts))
        a /= np.repeat(np.add.reduceat(a, starts), parts)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid((z * w["c"]).sum(axis=1) + w["b"])}

    def scores(self, stats: np.ndarray, parts: np.ndarray) -> np.ndarray:
        return self.forward(stats, parts)["p"] if len(parts) else np.zeros(0)

    def gradients(self, stats: np.ndarray, parts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss, with the L2 term."""
        f, w, n = self.forward(stats, parts), self.weights, len(y)
        starts = np.r_[0, np.cumsum(parts)[:-1]]
        off = (f["p"] - y) / n
        dz = np.repeat(off[:, None] * w["c"], parts, axis=0)
        da = (dz * f["h"]).sum(axis=1)
        ds = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), parts))
        dt = ds[:, None] * w["w"] * f["g"] * (1 - f["t"] ** 2)
        dg = ds[:, None] * w["w"] * f["t"] * f["g"] * (1 - f["g"])
        dh = (f["a"][:, None] * dz + _dot(dt, w["v"].T) + _dot(dg, w["u"].T)) * (1 - f["h"] ** 2)
        out = {"e": _dot(f["x"].T, dh), "be": dh.sum(axis=0), "v": _dot(f["h"].T, dt), "u": _dot(f["h"].T, dg), "w": (f["t"] * f["g"] * ds[:, None]).sum(axis=0), "c": (f["z"] * off[:, None]).sum(axis=0), "b": off.sum(keepdims=True)}
        return {k: g + L2 * w[k] for k, g in out.items()}


def fit(stats: np.ndarray, parts: np.ndarray, y: np.ndarray, steps: int = STEPS, attend: bool = True) -> AttentionModel:
    """Adam over BAGS bags a step, in a fixed random order; deterministic. Without ``attend`` all passages weigh the same."""
    stats = stats.astype(np.float64)
    draw = np.random.default_rng(7)
    mean, scale = (stats.mean(axis=0), stats.std(axis=0) + 1e-3) if len(stats) else (np.zeros(WIDTH), np.ones(WIDTH))
    share = (y.sum() + 0.5) / (len(y) + 1)
    shapes = {"e": (WIDTH, CODE), "be": (CODE,), "v": (CODE, GATE), "u": (CODE, GATE), "w": (GATE,), "c": (CODE,)}
    model = AttentionModel(mean, scale, {k: draw.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()} | {"b": np.array([np.log(share / (1 - share))])})
    if not attend:
        model.weights |= {"w": np.zeros(GATE)}
    if len(np.unique(y)) < 2:
        model.weights |= {"c": np.zeros(CODE)}
        return model
    m = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.weights.items()}
    first = np.r_[0, np.cumsum(parts)]
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < min(BAGS, len(y)):
            order = np.concatenate([order, draw.permutation(len(y))])
        bags, order = order[:BAGS], order[BAGS:]
        rows = np.concatenate([np.arange(first[b], first[b + 1]) for b in bags])
        for k, g in model.gradients(stats[rows], parts[bags], y[bags]).items():
            if k == "w" and not attend:
                continue
            m[k] = [0.9 * m[k][0] + 0.1 * g, 0.99 * m[k][1] + 0.01 * g**2]
            model.weights[k] = model.weights[k] - RATE * (m[k][0] / (1 - 0.9**step)) / (np.sqrt(m[k][1] / (1 - 0.99**step)) + 1e-8)
    return model


def train_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> AttentionModel:
    """A model fitted on about ``fit_rows`` rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, quality) covers."""
    sample = fitting_sample(docs, fit_rows, ["quality"], 3, labels)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("stats", T.BinaryType())])

    def rows(ids, texts, encoder):
        stats, parts = encoder(texts)
        return ids, [x.tobytes() for x in np.split(stats, np.cumsum(parts)[:-1])]

    got = map_texts(sample, rows, schema, Encoder).join(sample.select("doc_id", "quality"), "doc_id").orderBy("doc_id").toLocalIterator()
    bags, y = [], []
    for r in got:
        bags.append(np.frombuffer(r.stats, np.float32).reshape(-1, WIDTH))
        y.append(int(r.quality > 0))
    return fit(np.concatenate([np.zeros((0, WIDTH), np.float32), *bags]), np.array([len(b) for b in bags], np.int64), np.array(y, float))


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("passages", T.LongType())])


def score_quality(docs: DataFrame, model: AttentionModel, least: float = LEAST_SCORE) -> DataFrame:
    """One row for each row of ``docs``: doc_id, score (0 to 1), predicted (1 from ``least`` on) and the number of passages. No shuffle."""

    def rows(ids, texts, encoder):
        stats, parts = encoder(texts)
        p = model.scores(stats, parts)
        return ids, p, (p >= least).astype(np.int32), parts

    return map_texts(docs, rows, SCHEMA, Encoder)
