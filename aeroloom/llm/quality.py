"""Quality classifier learned from trusted positives and unlabelled text.

A small network scores whole texts by their make-up: characters by kind, word lengths, repetition.  It minimises the
non-negative unbiased risk: with class prior p and logistic loss l,
``p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)])``; where the second term turns negative its gradient is turned
around, so that the network cannot win by memorising the positives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from aeroloom.llm import text as T

#: Printable ASCII signs that have a share of their own; then kinds of characters.
SIGNS = [c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum()]
KINDS = ["lower", "upper", "far letter", "digit", "blank", "line end", "other"]
WORDS = ["chars", "words", "mean length", "distinct", "repeats", "top word", "short lines", "ends in sign", "long words"]
WIDTH = len(SIGNS) + len(KINDS) + len(WORDS)
#: Rows of either sample below which the class prior is not estimated.
LEAST_FOR_PRIOR = 40
_map: list[np.ndarray] = []


def _kind_of() -> np.ndarray:
    """Column of each code point among the shares."""
    if not _map:
        t = np.full(0x110000, len(SIGNS) + KINDS.index("other"), np.uint8)
        c = T.classes()
        t[c == T.LETTER] = len(SIGNS) + KINDS.index("lower")
        upper = [i for i in range(0x250) if chr(i).isupper()]
        t[upper] = len(SIGNS) + KINDS.index("upper")
        far = np.flatnonzero(c == T.LETTER)
        t[far[far >= 0x250]] = len(SIGNS) + KINDS.index("far letter")
        t[c == T.NUMBER] = len(SIGNS) + KINDS.index("digit")
        t[c == T.BLANK] = len(SIGNS) + KINDS.index("blank")
        t[[0x0A, 0x0D]] = len(SIGNS) + KINDS.index("line end")
        t[[ord(s) for s in SIGNS]] = np.arange(len(SIGNS))
        _map.append(t)
    return _map[0]


def features(texts: list[str]) -> np.ndarray:
    """One row per text, of the whole text; an empty text is a row of zeros."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for lo, hi in T.chunks(texts):
        out[lo:hi] = _features(texts[lo:hi])
    return out


def _features(texts: list[str]) -> np.ndarray:
    n = len(texts)
    cp, offsets = T.code_points(texts)
    if len(cp) == 0:
        return np.zeros((n, WIDTH), np.float32)
    size = np.diff(offsets)
    text_of = np.repeat(np.arange(n), size)
    k = len(SIGNS) + len(KINDS)
    shares = np.bincount(text_of * k + _kind_of()[cp], minlength=n * k).reshape(n, k) / np.maximum(size, 1)[:, None]
    starts, ends, first = T.word_spans(T.plain_words(cp), offsets)
    words = np.diff(first)
    some = np.maximum(words, 1)
    owner = np.repeat(np.arange(n), words)
    hashes = T.span_hashes(cp, starts, ends)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    # Distinct words and the commonest one: runs of equal values in the order of text and hash.
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    run_at = np.flatnonzero(new)
    run = np.diff(np.append(run_at, len(h)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, o[run_at], run)
    length = ends - starts
    lines = np.bincount(text_of[cp == 0x0A], minlength=n) + 1
    sign_end = np.bincount(owner[_kind_of()[cp[ends - 1]] < len(SIGNS)], minlength=n) if len(ends) else np.zeros(n)
    more = np.stack([
        np.log1p(size) / 10, np.log1p(words) / 10, np.bincount(owner, length, n) / some / 10, np.bincount(o[run_at], minlength=n) / some,
        np.bincount(owner[again], minlength=n) / some, top / some, lines / some, sign_end / some,
        np.bincount(owner[length > 20], minlength=n) / some], axis=1)
    more[size == 0] = 0
    return np.concatenate([np.sqrt(shares), more], axis=1).astype(np.float32)


@dataclass
class Model:
    """Scaling of the features and the network's two layers; ``prior`` is the class prior it was fitted with."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality."""
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def risk(f: np.ndarray, is_p: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """Non-negative unbiased risk of the logits ``f``, and the gradient to descend along, with respect to ``f``.

    Where the share of the unknown negatives turns negative, the gradient is that of raising this share alone.
    """
    n_p = is_p.sum()
    n_u = len(f) - n_p
    s = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
    as_negative = np.logaddexp(0, f)  # its derivative is s; that of the loss as a positive is s - 1
    rest = as_negative[~is_p].mean() - prior * as_negative[is_p].mean()
    g = np.empty_like(f)
    if rest >= 0:
        g[is_p] = -prior / n_p
        g[~is_p] = s[~is_p] / n_u
    else:
        g[is_p], g[~is_p] = prior / n_p * s[is_p], -s[~is_p] / n_u
    return float(prior * np.logaddexp(0, -f[is_p]).mean() + max(0.0, rest)), g


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, doubt: float = 0.1) -> float:
    """Share of positives among the unlabelled scores, from the scores of both that were not fitted on.

    Above any limit, the unlabelled mass is at least the prior times the positive mass, so the least ratio of the two is an
    upper bound of the prior, and is the prior where the scores above the limit are pure.  The limit is the one whose ratio, with
    the error that ``doubt`` allows for both masses, is least: high limits with few rows do not decide.
    """
    p, u = np.sort(positive), np.sort(unlabelled)
    limits = np.unique(p)
    of_p = 1 - np.searchsorted(p, limits) / len(p)
    of_u = 1 - np.searchsorted(u, limits) / len(u)
    error = np.sqrt(np.log(4 / doubt) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(len(u)))
    best = ((of_u + error) / of_p).argmin()
    return float(min(0.98, max(0.02, of_u[best] / of_p[best])))


def fit_with_prior(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """`fit` with the class prior that both samples give.

    Each half of the rows is fitted twice, with an even prior and with the prior that the first network's scores of the other
    half give; the scores of the second give the half's estimate, and the prior is the mean of both.  A few rows give no
    estimate, and the even prior stays.  The result does not depend on the order of the rows.
    """
    p, u = (x[np.lexsort(x.T)] for x in (positive, unlabelled))
    if min(len(p), len(u)) < LEAST_FOR_PRIOR:
        return fit(p, u, 0.5)
    found = []
    for i in (0, 1):
        prior = 0.5
        for _ in range(2):
            half = fit(p[i::2], u[i::2], prior, rounds=200)
            prior = estimate_prior(half.logits(p[1 - i::2]), half.logits(u[1 - i::2]))
        found.append(prior)
    return fit(p, u, sum(found) / 2)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 16, rounds: int = 500, rate: float = 0.02, seed: int = 5) -> Model:
    """Minimise the non-negative unbiased risk by Adam over all rows of both samples."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    z = np.clip((both - mean) / scale, -8, 8)
    n_p, n_u = len(positive), len(unlabelled)
    params = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    is_p = np.arange(n_p + n_u) < n_p
    for step in range(1, rounds + 1):
        w1, b1, w2, b2 = params
        h = np.tanh(z @ w1 + b1)
        f = h @ w2 + b2[0]
        g = risk(f, is_p, prior)[1]
        gh = np.outer(g, w2) * (1 - h * h)
        grads = [z.T @ gh + 1e-4 * w1, gh.sum(axis=0), h.T @ g + 1e-4 * w2, np.array([g.sum()])]
        for i, d in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * d
            v[i] = 0.99 * v[i] + 0.01 * d * d
            params[i] = params[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)
    return Model(mean, scale, *params[:3], float(params[3][0]), prior)


def _sample(rows: DataFrame, bound: int, seed: int) -> np.ndarray:
    """Features of about ``bound`` rows drawn by a hash (all, if there are fewer)."""
    n = rows.count()
    if n == 0:
        return np.zeros((0, WIDTH), np.float32)
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1_000_000)) < F.lit(bound / n * 1_000_000)).select("text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in np.array_split(features([t if isinstance(t, str) else "" for t in batch["text"]]), max(1, len(batch) // 64)):
                yield pd.DataFrame({"x": list(row)})

    got = drawn.mapInPandas(run, "x array<float>").toPandas()
    return np.stack(got["x"].to_numpy()) if len(got) else np.zeros((0, WIDTH), np.float32)


def train(docs: DataFrame, labels: DataFrame, positives: int = 8000, unlabelled: int = 12000, seed: int = 23) -> Model:
    """Fit on ``docs`` (``doc_id, text``) with ``labels`` (``doc_id, quality``); give it the training part of both only.

    Trusted positives are documents with a label 1; the unlabelled sample is drawn from all documents as they come.  Both
    are bounded by the two parameters and drawn by a hash of doc_id.  The class prior is estimated from these two samples;
    labels of 0 serve for nothing.  Null labels, and labels of unknown documents, take no part.  Without a positive or a
    document the model scores everything 0.5.
    """
    T.small_batches(docs.sparkSession)
    ones = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("quality")).where(F.col("quality") == 1)
    rows = docs.select("doc_id", "text")
    p = _sample(rows.join(ones.select("doc_id"), "doc_id", "left_semi"), positives, seed)
    u = _sample(rows, unlabelled, seed + 1)
    if len(p) == 0 or len(u) == 0:
        return Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros((WIDTH, 1)), np.zeros(1), np.zeros(1), 0.0, 0.5)
    return fit_with_prior(p, u)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``quality_score``, from the whole text alone (null text: as an empty one)."""
    T.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers
    kept = docs.drop("quality_score")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(quality_score=shared.value.score(features([t if isinstance(t, str) else "" for t in batch["text"]])))

    return kept.mapInPandas(run, ", ".join([*(f"`{n}` {t}" for n, t in kept.dtypes), "quality_score double"]))
