"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language with Spark; the model is a matrix of log-probabilities, buckets by languages,
which is broadcast.  A batch of texts is scored at once: each n-gram that occurs picks its row, and rows are summed per
text, which is the product of the sparse count matrix with the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from aeroloom.llm import text as T

BITS = 15
SIZES = (1, 2, 3)
UNDETERMINED = "und"


@dataclass
class Model:
    """Languages in order, log-probability of each bucket (buckets by languages) and of each language."""

    languages: list[str]
    table: np.ndarray
    prior: np.ndarray


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of the n-grams (one array per size) that begin at each position of all texts; where each text begins
    among the positions; and whether it has a letter.  Two blanks before and after each text keep texts apart."""
    lowered = [t.lower() for t in texts]
    cp, offsets = T.code_points([f"  {t}" for t in lowered] + ["  "])
    letter = np.add.reduceat(T.classes()[cp] == T.LETTER, offsets[:-2]) > 0 if texts else np.zeros(0, bool)
    n = len(cp) - 2
    out = []
    with np.errstate(over="ignore"):
        for size in SIZES:
            h = np.full(n, size * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for k in range(size):
                h = (h ^ cp[k:k + n]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(13)
            out.append((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS))
    return out, offsets[:-2], letter


def held_out():
    """Column: the document is kept from training (crc32 of doc_id as text, modulo 4, is 2)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(labelled: DataFrame, rows_per_language: int = 4000, seed: int = 17, smoothing: float = 0.5) -> Model:
    """Fit on ``doc_id, text, lang`` rows, of which a language gives about ``rows_per_language``.

    They are drawn by a hash of doc_id and text, so copies are drawn each by itself; every language gives a row at least.  Rows without text or language take no part.  A language with fewer rows gives them all.  Counting is a Spark job
    whose result has at most 2**BITS rows per language.  Without rows the model has no language.
    """
    T.small_batches(labelled.sparkSession)
    rows = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        "text", "lang", F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1_000_000)).alias("draw"))
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("draw").alias("least")).collect()
    sizes = {r["lang"]: r["n"] for r in found}
    if not sizes:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    below = F.create_map(*[c for r in found for c in (F.lit(r["lang"]), F.lit(max(rows_per_language / r["n"] * 1_000_000, r["least"] + 1.0)))])
    drawn = rows.where(F.col("draw") < below[F.col("lang")]).select("text", "lang")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                texts = part["text"].tolist()
                for lo, hi in T.chunks(texts):
                    total = sums.setdefault(lang, np.zeros(1 << BITS, np.int64))
                    for g in grams(texts[lo:hi])[0]:
                        total += np.bincount(g, minlength=1 << BITS)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": total[at]})

    counted = drawn.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["lang"].unique())
    n = np.zeros((1 << BITS, len(languages)))
    n[counted["bucket"], np.searchsorted(languages, counted["lang"])] = counted["n"]
    n += smoothing
    seen = np.array([min(sizes[k], rows_per_language) for k in languages], float)
    return Model(list(languages), np.log(n / n.sum(axis=0)).astype(np.float32), np.log(seen / seen.sum()) if languages else seen)


def score(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Most probable language of each text and its probability; ``und`` and 0 if there is no letter."""
    labels, scores = [], np.zeros(len(texts))
    for lo, hi in T.chunks(texts):
        buckets, begins, letter = grams(texts[lo:hi])
        total = np.tile(model.prior, (hi - lo, 1))
        for k in range(len(model.languages)):
            column = np.ascontiguousarray(model.table[:, k])
            for g in buckets:
                total[:, k] += np.add.reduceat(column[g], begins, dtype=np.float64)
        if len(model.languages) == 0:
            labels += [UNDETERMINED] * (hi - lo)
            continue
        best = total.argmax(axis=1)
        scores[lo:hi] = np.where(letter, 1 / np.exp(total - total.max(axis=1)[:, None]).sum(axis=1), 0)
        labels += [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letter)]
    return labels, scores


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``lang_score`` of each whole text (null text: ``und``, 0).

    Only the text counts; equal texts get equal results.  Columns of these two names are replaced.
    """
    spark = docs.sparkSession
    T.small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # 2**BITS rows of four bytes per language
    kept = docs.drop("lang_pred", "lang_score")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            labels, scores = score(shared.value, [t if isinstance(t, str) else "" for t in batch["text"]])
            yield batch.assign(lang_pred=labels, lang_score=scores)

    return kept.mapInPandas(run, ", ".join([*(f"`{n}` {t}" for n, t in kept.dtypes), "lang_pred string", "lang_score double"]))
