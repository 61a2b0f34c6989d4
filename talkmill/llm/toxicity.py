"""Toxicity by a classifier chain: categories are predicted one after another, each by a linear model that also sees earlier probabilities.

The models are logistic regressions over the presence of words and character n-grams, fitted on a bounded sample of labelled rows. The
probabilities that a later model is trained with come from models that did not see the row (out-of-fold); features, too, are chosen
without the rows of the fold. In scoring, probabilities come from the fitted earlier models. The last category is the label itself;
those before it are kinds of toxic rows, found by clustering the toxic rows of the sample by their features, so no word list is needed.

Features are those that stand in toxic rows more often than in others: the lack of a word is no evidence. Null and empty texts have no
features: their probability is that of the intercepts. Repeated rows get equal results; ties among features, clusters and thresholds
go by hash, by doc_id and to the middle. Without labelled toxic rows, or from an empty table, nothing is flagged; an empty table gives no
rows. Only doc_id and text are read, so further columns of any name do no harm. Texts are read whole; a term counts the same anywhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fitting_sample, free_name, map_texts, stored, text_column

#: Kinds of toxic rows that are told apart before the label itself, largest first.
KINDS = 3
CATEGORIES = (*(f"kind_{k + 1}" for k in range(KINDS)), "toxic")
#: Labelled rows that the models are fitted on, about, at most.
FIT_ROWS = 6000
#: Features kept for a fold: those with the greatest z of the difference between the shares of toxic and other rows.
FEATURES, LEAST_Z, LEAST_ROWS = 1500, 4.0, 3
#: Rounds of clustering.
MOVES = 20
FOLDS = 5
CACHE_WORDS, CACHE_CHARS = 300_000, 66
#: N-grams of a token are taken at so many places at once.
PIECE = 20_000
EDGE = "^$.,;:!?()[]{}\"'<>|*%&#-_/+=~`"


def word_features(token: str, kept: dict[int, int] | None = None) -> tuple[int, ...]:
    """64-bit hashes of a token's word and of the 4- and 5-character n-grams of it with its ends marked; none if nothing is left of it.

    With ``kept``, the values of those hashes that it has. Long tokens go piece by piece, so that not all their n-grams are held at once.
    """
    core = token.lower().strip(EDGE)
    if not core:
        return ()
    marked = f"^{core}$"
    grams, found = {"w" + core}, set()
    for at in range(0, len(marked), PIECE):
        grams |= {marked[i : i + n] for n in (4, 5) for i in range(at, min(at + PIECE, len(marked) - n + 1))}
        hashes = (xxhash.xxh64_intdigest(g) - (1 << 63) for g in grams)
        found.update(hashes if kept is None else (kept[h] for h in hashes if h in kept))
        grams = set()
    return tuple(sorted(found))


class FeatureCache(dict):
    """token -> its features (of those in ``kept``, if given); cleared when it has grown too large, and long tokens are not held."""

    def __init__(self, kept: dict[int, int] | None = None, most: int = CACHE_WORDS):
        super().__init__()
        self.kept, self.most = kept, most

    def __missing__(self, token: str) -> tuple[int, ...]:
        got = word_features(token, self.kept)
        if len(token) <= CACHE_CHARS:
            if len(self) >= (self.most // 10 if self.kept is None else self.most):  # all of a token's features take ten times as much
                self.clear()
            self[token] = got
        return got

    def of(self, text: str | None) -> list[int]:
        return sorted({f for token in set((text or "").split()) for f in self[token]})


@dataclass
class Chain:
    """columns: feature -> row of ``weights`` (features x categories); links[c, d]: weight of category d's probability for c > d."""

    columns: dict[int, int]
    weights: np.ndarray
    bias: np.ndarray
    links: np.ndarray
    threshold: float = 0.5

    def probabilities(self, rows: Sequence[Sequence[int]]) -> np.ndarray:
        """rows x categories, from the columns that each row has."""
        sizes = np.array([len(r) for r in rows], np.int64)
        flat = np.array([c for r in rows for c in r], np.int64)
        of = np.repeat(np.arange(len(rows)), sizes)
        out = np.zeros((len(rows), len(self.bias)))
        for c in range(len(self.bias)):
            score = self.bias[c] + np.bincount(of, self.weights[flat, c], len(rows)) + (out[:, :c] * self.links[c, :c]).sum(axis=1)
            out[:, c] = _sigmoid(score)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_linear(of: np.ndarray, column: np.ndarray, width: int, more: np.ndarray, y: np.ndarray, rows: np.ndarray, l2: float = 0.5, steps: int = 200):
    """Logistic regression on the rows marked in ``rows``: presence entries (of, column) and dense columns ``more``; Adam with steps that end at zero, deterministic."""
    use = rows[of]
    of, column = of[use], column[use]
    w, v, b = np.zeros(width), np.zeros(more.shape[1]), 0.0
    theta = np.concatenate([w, v, [b]])
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    n = max(1, int(rows.sum()))
    for step in range(1, steps + 1):
        score = np.bincount(of, theta[column], len(y)) + (more * theta[width:-1]).sum(axis=1) + theta[-1]
        off = np.where(rows, _sigmoid(score) - y, 0.0)
        grad = np.concatenate([np.bincount(column, off[of], width), (more * off[:, None]).sum(axis=0), [off.sum()]])
        grad[:-1] += l2 * theta[:-1]
        grad /= n
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad**2
        theta = theta - 0.1 * min(1.0, 2 * (1 - (step - 1) / steps)) * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-9)
    return theta[:width], theta[width:-1], theta[-1]


def fold_of(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) // 8 % FOLDS


def kinds_of(rows: Sequence[Sequence[int]], width: int, kinds: int = KINDS) -> np.ndarray:
    """A kind (0 is the largest) for each row by its features: spherical k-means, begun with rows that are far from those before; deterministic."""
    x = np.zeros((len(rows), width), np.float32)
    for k, r in enumerate(rows):
        x[k, list(r)] = 1
    x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)
    centres = [x.mean(axis=0)]
    for _ in range(kinds):
        near = np.max([np.einsum("ij,j->i", x, c / max(np.sqrt((c * c).sum()), 1e-9)) for c in centres], axis=0)
        centres.append(x[int(near.argmin())])
    centre, of = np.array(centres[1:]), np.full(len(rows), -1)
    for _ in range(MOVES):
        now = np.einsum("ij,kj->ik", x, centre).argmax(axis=1)
        if (now == of).all():
            break
        of = now
        for k in range(kinds):
            if (of == k).any():
                mean = x[of == k].mean(axis=0)
                centre[k] = mean / max(float(np.sqrt((mean * mean).sum())), 1e-9)
    order = np.argsort(-np.bincount(of, minlength=kinds), kind="stable")
    return np.argsort(order, kind="stable")[of]


def fit_chain(ids: Sequence[int], rows: Sequence[Sequence[int]], labels: np.ndarray, columns: dict[int, int], chosen: np.ndarray | None = None) -> Chain:
    """``labels``: rows x categories of 0 and 1. Out-of-fold probabilities of each category feed the later models' training.

    ``chosen``: (FOLDS + 1) x columns, the features that a model without a fold's rows may see; the last row is for the final models.
    """
    n, categories = labels.shape
    width = len(columns)
    chosen = np.ones((FOLDS + 1, width), bool) if chosen is None else chosen
    of = np.repeat(np.arange(n), [len(r) for r in rows]).astype(np.int64)
    column = np.array([c for r in rows for c in r], np.int64)
    fold = np.array([fold_of(i) for i in ids], np.int64)
    chain = Chain(columns, np.zeros((width, categories)), np.full(categories, -40.0), np.zeros((categories, categories)))
    outside = np.zeros((n, categories))
    for c in range(categories):
        y = labels[:, c].astype(float)
        if not y.any():
            continue  # nothing to learn: the category is never predicted
        for k in range(FOLDS):
            seen = chosen[k][column]
            w, v, b = fit_linear(of[seen], column[seen], width, outside[:, :c], y, fold != k)
            score = b + np.bincount(of[seen], w[column[seen]], n) + (outside[:, :c] * v).sum(axis=1)
            outside[fold == k, c] = _sigmoid(score[fold == k])
        seen = chosen[FOLDS][column]
        chain.weights[:, c], chain.links[c, :c], chain.bias[c] = fit_linear(of[seen], column[seen], width, outside[:, :c], y, np.ones(n, bool))
    last = labels[:, -1].astype(bool)
    if last.any():
        cuts = np.linspace(0.2, 0.8, 25)
        score = [2 * (last & (outside[:, -1] >= t)).sum() / max(1, last.sum() + (outside[:, -1] >= t).sum()) for t in cuts]
        best = np.flatnonzero(np.array(score) >= max(score) - 1e-9)
        chain.threshold = float(cuts[best[len(best) // 2]])  # the middle of the best cuts
    return chain


def train_chain(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Chain:
    """A chain fitted on about ``fit_rows`` rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) covers.

    Features are counted by Spark, per fold; the driver gets those that one of the folds' models may see (FEATURES for each at most), and
    which of them each row of the sample has.
    """
    sample = fitting_sample(docs, fit_rows, ["toxic"], 1, labels)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fold", T.IntegerType()), T.StructField("features", T.ArrayType(T.LongType()))])
    found = map_texts(sample, lambda ids, texts, cache: (ids, [fold_of(i) for i in ids], [cache.of(t) for t in texts]), schema, FeatureCache)
    seen = stored(found.join(sample.select("doc_id", (F.col("toxic") > 0).cast("long").alias("y")), "doc_id"), "features")
    totals = seen.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("k")).collect()  # FOLDS rows
    rows_in = {r.fold: (r.n, r.k) for r in totals}
    n, positive = sum(v[0] for v in rows_in.values()), sum(v[1] for v in rows_in.values())
    if not positive or positive == n:
        return Chain({}, np.zeros((0, len(CATEGORIES))), np.full(len(CATEGORIES), -40.0), np.zeros((len(CATEGORIES),) * 2))
    here = [F.col("fold") == k for k in range(FOLDS)]
    entries = seen.select("fold", F.explode("features").alias("feature"), "y").groupBy("feature")
    counts = stored(entries.agg(*(F.count_if(h).alias(f"n{k}") for k, h in enumerate(here)), *(F.sum(F.when(h, F.col("y")).otherwise(0)).alias(f"k{k}") for k, h in enumerate(here))), "counts")
    best = []
    for left_out in range(FOLDS + 1):
        others = [k for k in range(FOLDS) if k != left_out]
        all_n, all_k = (sum(rows_in.get(k, (0, 0))[at] for k in others) for at in (0, 1))
        if not 0 < all_k < all_n:
            best.append([])
            continue
        m, k = (sum((F.col(f"{c}{j}") for j in others), F.lit(0)) for c in "nk")
        share = m / all_n
        z = (k / all_k - (m - k) / (all_n - all_k)) / F.sqrt(share * (1 - share) * (1 / all_k + 1 / (all_n - all_k)))
        some = counts.where((k >= LEAST_ROWS) & (m < all_n)).select("feature", z.alias("z")).where(F.col("z") >= LEAST_Z)
        best.append([r.feature for r in some.orderBy(F.desc("z"), "feature").limit(FEATURES).collect()])
    columns = {f: k for k, f in enumerate(sorted({f for some in best for f in some}))}
    chosen = np.zeros((FOLDS + 1, len(columns)), bool)
    for k, some in enumerate(best):
        chosen[k, [columns[f] for f in some]] = True
    wanted = F.array(*(F.lit(f) for f in columns)) if columns else F.array().cast("array<bigint>")
    got = seen.select("doc_id", "y", F.array_intersect("features", wanted).alias("features")).orderBy("doc_id").collect()
    rows = [sorted(columns[f] for f in r.features) for r in got]
    toxic = np.array([r.y for r in got]) > 0
    labels_of = np.zeros((len(got), len(CATEGORIES)), np.int64)
    labels_of[toxic, -1] = 1
    if columns:
        labels_of[np.flatnonzero(toxic), kinds_of([rows[i] for i in np.flatnonzero(toxic)], len(columns))] = 1
    return fit_chain([r.doc_id for r in got], rows, labels_of, columns, chosen)


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), *(T.StructField(f"p_{c}", T.DoubleType()) for c in CATEGORIES), T.StructField("score", T.DoubleType()), T.StructField("toxic", T.BooleanType())])


def score_toxicity(docs: DataFrame, chain: Chain) -> DataFrame:
    """One row for each row of ``docs``: doc_id, a probability for each category, score (that of the last) and whether it is toxic. No shuffle."""

    def rows(ids, texts, cache):
        p = chain.probabilities([cache.of(t) for t in texts])
        return [ids, *p.T, p[:, -1], p[:, -1] >= chain.threshold]

    return map_texts(docs, rows, SCHEMA, lambda: FeatureCache(chain.columns))


def drop_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` without toxic rows; all columns stay as they are."""
    flag = free_name(docs.columns, "_toxic")
    is_toxic = text_column(F.col("text"), lambda texts, cache: (chain.probabilities([cache.of(t) for t in texts])[:, -1] >= chain.threshold).tolist(), T.BooleanType(), lambda: FeatureCache(chain.columns, CACHE_WORDS // 2))
    return docs.withColumn(flag, is_toxic).where(~F.col(flag)).drop(flag)
