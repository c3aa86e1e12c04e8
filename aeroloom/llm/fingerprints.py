"""Document fingerprints by consistent weighted sampling.

A document is a weighted set: its words and its pairs of neighbouring words, each weighing as often as it occurs.  For
sample d and term k, three values are drawn from hashes of (k, d) alone: r and c from Gamma(2, 1), b uniform.  With
t = floor(ln w / r + b) and ln a = ln c - r (t - b) - r, the sample is the (k, t) whose a is least.  Two documents give
the same sample with the probability sum(min) / sum(max) of their weights, the generalised Jaccard similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from aeroloom.llm import files, text as T

SAMPLES = 64
#: Terms looked at together; for 64 samples the arrays of a block stay near a core's cache.
BLOCK = 800
#: Where the samples' seeds begin.
SEED = 0xA0761D6478BD642F
#: Part of a bound that makes up for rounding in single precision.
SLACK = 1e-5


def _hash(terms: np.ndarray, samples: int) -> np.ndarray:
    """A 64-bit hash of each (sample, term); the samples' seeds are far from the mixed small numbers that terms may be."""
    seeds = T.mix64(np.arange(1, samples + 1, dtype=np.uint64) + np.uint64(SEED))
    return T.mix64(terms ^ seeds[:, None])


def _least(hashes: np.ndarray) -> np.ndarray:
    """ln a of terms of weight 1: a is -ln(1 - v), exponential, and grows with the hash."""
    v = np.minimum((hashes.astype(np.float64) + 0.5) * 2.0 ** -64, 1 - 2.0 ** -53)
    return np.log(-np.log1p(-v))


def _draws(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and b of each hash, in double precision.

    With three exponentials x, y and q, c = x + y is Gamma(2, 1) and s = ln(c / x) is exponential and does not depend on
    c; so r = s + q is Gamma(2, 1), and b = q / r is uniform and does not depend on r.  x is taken from all bits of the
    hash, of which the upper half decides it; q begins with the lower half, and the rest is from a second hash.
    """
    more = T.mix64(hashes ^ np.uint64(0x9E3779B97F4A7C15))
    low, half = np.uint64(0xFFFFFFFF), np.uint64(32)
    y = -np.log(((more >> half).astype(np.float64) + 0.5) * 2.0 ** -32)
    q = -np.log(((hashes & low).astype(np.float64) + ((more & low).astype(np.float64) + 0.5) * 2.0 ** -32) * 2.0 ** -32)
    log_x = _least(hashes)
    log_c = np.log(np.exp(log_x) + y)
    r = log_c - log_x + q
    return r, log_c, q / r


def _bounds(hashes: np.ndarray) -> np.ndarray:
    """v e^-q of each hash, or a little less: no a is below this over the weight."""
    real = lambda x: x.view(np.int32).astype(np.float32)  # noqa: E731  (faster than from unsigned numbers)
    left = real((hashes >> np.uint64(33)).astype(np.uint32))
    left *= real(hashes.astype(np.uint32) >> np.uint32(1))
    left *= np.float32(2.0 ** -62 * (1 - SLACK))
    return left


def signature(terms: np.ndarray, weights: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """16-bit digest of each sample of one weighted set (distinct 64-bit terms, weights above 0).

    Every term has its own draws for every sample.  At weight 1, t is 0 and a is x, so among such terms the least hash is
    the least a.  For other weights r (t - b) <= ln w gives a >= x e^-q / w, and x is at least the share v of the hash in
    its range.  Only terms whose bound is not above an a that was found already can be the least; logarithms are taken of
    those alone.
    """
    best, chosen, level = np.full(samples, np.inf), np.zeros(samples, np.uint64), np.zeros(samples, np.int64)
    single = weights == 1
    k = terms[single]
    if len(k):
        chosen = np.min([_hash(k[lo:lo + BLOCK], samples).min(axis=1) for lo in range(0, len(k), BLOCK)], axis=0)
        best = _least(chosen)
    k, w = terms[~single], weights[~single]
    order = np.argsort(-w, kind="stable")
    k, w = k[order], w[order]
    for lo in range(0, len(k), BLOCK):
        hashes, log_w = _hash(k[lo:lo + BLOCK], samples), np.log(w[lo:lo + BLOCK])
        n = len(log_w)
        bound = _bounds(hashes)
        bound /= w[lo:lo + BLOCK].astype(np.float32)

        def compete(at: np.ndarray) -> None:
            """The pairs at ascending places ``at`` of the block."""
            row, found = at // n, hashes.ravel()[at]
            r, log_c, b = _draws(found)
            t = np.floor(log_w[at - row * n] / r + b)
            value = log_c - r * (t - b) - r
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            least = np.minimum.reduceat(value, starts)
            won = np.flatnonzero((value == np.repeat(least, np.diff(starts, append=len(at)))) & (value < best[row]))[::-1]
            at = row[won]
            best[at], chosen[at], level[at] = value[won], found[won], t[won]

        if np.isinf(best[0]):
            compete(bound.argmin(axis=1) + np.arange(samples) * n)
        rest = np.flatnonzero(bound <= np.exp(best).astype(np.float32)[:, None])
        if len(rest):
            compete(rest)
    return (T.mix64(chosen ^ T.mix64(level.astype(np.uint64))) >> np.uint64(48)).astype(np.uint16)


def signatures(texts: list[str], samples: int = SAMPLES) -> np.ndarray:
    """Signature of each text; a text without words has the one of the empty set, a fixed term."""
    out = np.zeros((len(texts), samples), np.uint16)
    for lo, hi in T.chunks(texts):
        cp, offsets = T.code_points(texts[lo:hi])
        starts, ends, first = T.word_spans(T.plain_words(cp), offsets)
        words = T.span_hashes(cp, starts, ends)
        for i in range(hi - lo):
            w = words[first[i]:first[i + 1]]
            if len(w) == 0:
                terms, weights = np.ones(1, np.uint64), np.ones(1)
            else:
                terms, weights = np.unique(np.concatenate([w, T.shingle_hashes(w, 2)]) if len(w) > 1 else w, return_counts=True)
            out[lo + i] = signature(terms, weights.astype(np.float64), samples)
    return out


def as_hex(signature_rows: np.ndarray) -> list[str]:
    """Four hex digits per sample."""
    raw = signature_rows.astype(">u2").tobytes().hex()
    size = signature_rows.shape[1] * 4
    return [raw[i:i + size] for i in range(0, len(raw), size)]


def likeness(a, b, samples: int = SAMPLES):
    """Column: share of equal samples of two fingerprints, an estimate of the generalised Jaccard similarity."""
    part = lambda c, i: F.substring(c, i * 4 + F.lit(1), F.lit(4))
    same = F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), lambda i: part(a, i) == part(b, i))
    return F.size(same) / F.lit(float(samples))


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """All columns of ``docs`` and ``fingerprint``, of the whole text; a null text counts as empty."""
    T.small_batches(docs.sparkSession)
    kept = docs.drop("fingerprint")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            yield batch.assign(fingerprint=as_hex(signatures(texts, samples)))

    return kept.mapInPandas(run, ", ".join([*(f"`{n}` {t}" for n, t in kept.dtypes), "fingerprint string"]))


def in_order_with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows (part, tail, doc_id, text) dealt by ascending doc_id, one part per partition, each in order.

    The last row of a part is the first row of the next one (``tail``), so that every row's successor stands behind it;
    after the last part comes the first row of all.  A null id comes first; equal ids are in order of their texts.
    """
    spark = docs.sparkSession
    n = files.parts(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("part", files.bucket_of("doc_id", files.bounds(rows, "doc_id", n)))
    # The first row of each part, combined before the shuffle: as many rows as parts.
    heads = files.written(rows.groupBy("part").agg(F.min(F.struct("doc_id", "text")).alias("head")), "part-heads")
    order = Window.orderBy("part")
    following = heads.select("part", F.lead("part").over(order).alias("next"), F.first("part").over(order).alias("first"))
    tails = (following.select("part", F.coalesce("next", "first").alias("next"))
             .join(heads.select(F.col("part").alias("next"), "head"), "next")
             .select("part", F.lit(1).alias("tail"), "head.doc_id", "head.text"))
    both = rows.select("part", F.lit(0).alias("tail"), "doc_id", "text").unionByName(tails)
    return (both.repartitionById(n, "part").sortWithinPartitions("part", "tail", F.col("doc_id").asc_nulls_first(), "text"), n)


def edited_likeness(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprint of each document and of its edited text, and how like it is to that and to the next document.

    The edited text has the last quarter of the code points (rounded down) replaced by the first as many of the next
    document in order of doc_id, or all of it if that is shorter; after the last document comes the first.
    """
    T.small_batches(docs.sparkSession)
    dealt, _ = in_order_with_next(docs)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_id, held_text, held = [], [], np.zeros((0, samples), np.uint16)
        for batch in batches:
            ids, texts = held_id + [None if pd.isna(v) else int(v) for v in batch["doc_id"]], held_text + batch["text"].tolist()
            own = np.concatenate([held, signatures(texts[len(held):], samples)])
            n = len(texts) - 1
            cut = [len(t) - len(t) // 4 for t in texts[:n]]
            edited = [t[:c] + after[:len(t) - c] for t, c, after in zip(texts, cut, texts[1:])]
            marks = signatures(edited, samples)
            if n:
                yield pd.DataFrame({
                    "doc_id": pd.array(ids[:n], "Int64"), "n_chars": [len(t) for t in texts[:n]],
                    "edited_sha256": [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in edited],
                    "fingerprint": as_hex(own[:n]), "edited_fingerprint": as_hex(marks),
                    "near_edited": (own[:n] == marks).mean(axis=1), "near_next": (own[:n] == own[1:]).mean(axis=1)})
            held_id, held_text, held = ids[n:], texts[n:], own[n:]

    return dealt.select("doc_id", "text").mapInPandas(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
