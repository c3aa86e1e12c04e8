"""Packing by power-of-two decomposition: no sequence crosses documents, and sequences of a bucket have equal length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from aeroloom.llm import text as T, tokens

#: sequence_id = bucket, partition and running number within the partition: 6, 25 and 32 bits.
BUCKET_SHIFT, PARTITION_SHIFT = 57, 32


def decompose(n_tokens: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of each document: its index, where the piece starts and its length.

    As many pieces of ``longest`` as fit, then one piece for each bit of what is left, largest first.
    """
    n_tokens = np.asarray(n_tokens, np.int64)
    if longest & (longest - 1) or longest < 1:
        raise ValueError("longest must be a power of two")
    full, rest = n_tokens // longest, n_tokens % longest
    bits = [1 << b for b in range(longest.bit_length() - 2, -1, -1)]
    doc, length = [np.repeat(np.arange(len(n_tokens)), full)], [np.full(int(full.sum()), longest, np.int64)]
    for b in bits:
        has = np.flatnonzero(rest & b)
        doc.append(has)
        length.append(np.full(len(has), b, np.int64))
    docs, lengths = np.concatenate(doc), np.concatenate(length)
    order = np.argsort(docs, kind="stable")
    docs, lengths = docs[order], lengths[order]
    stop = np.cumsum(lengths)
    before = np.cumsum(n_tokens) - n_tokens
    return docs, stop - lengths - before[docs], lengths


def pack(docs: DataFrame, vocabulary: str, longest: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of all documents (``doc_id, text``): each is one sequence of 1, 2, 4 .. ``longest`` ids.

    A document's ids are those of its text and ``end_id``; a null text counts as empty, so every document has a piece.
    Each id is in one piece; nothing is padded, as each length is a power of two.  Sequences of one length form a bucket
    from which a trainer draws batches.  ``sequence_id`` holds bucket, task and running number, so ids are unique
    without a count over all tasks, and a task that runs again gives the same ones.  Repeated rows are packed each.
    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket and ids.
    """
    T.small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = tokens.encoder(vocabulary)
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch["text"].tolist()
            for lo, hi in T.chunks(texts):
                ids, begins = enc.encode(texts[lo:hi])
                ids = np.insert(ids, begins[1:], end_id).astype("<u4")
                counts = np.diff(begins) + 1
                doc, start, length = decompose(counts, longest)
                stop = np.cumsum(length)
                raw = memoryview(ids.tobytes())
                bucket = np.log2(length).astype(np.int64)
                number = made + np.arange(len(doc))
                made += len(doc)
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[lo + doc].array, "start": start, "length": length,
                    "ids_crc32": [zlib.crc32(raw[4 * (b - n):4 * b]) for b, n in zip(stop.tolist(), length.tolist())],
                    "doc_tokens": counts[doc], "sequence_id": (bucket << BUCKET_SHIFT) | (task << PARTITION_SHIFT) | number,
                    "offset": 0, "bucket": bucket, "ids": [ids[b - n:b].astype(np.int32) for b, n in zip(stop.tolist(), length.tolist())]})

    return rows.mapInPandas(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
                                 "bucket int, ids array<int>")
