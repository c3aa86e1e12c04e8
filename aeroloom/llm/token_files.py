"""Token files: ids of documents in ascending order, coded by Simple-8b, written and read back by tasks.

A file holds the documents of one range of doc_id:

    magic "AL8B", version, then for each group of blocks its words, and at the end an index

Ids are cut into blocks of `BLOCK`.  A block is coded into 64-bit words, each with a 4-bit selector that says how many
ids of which width follow (`COUNT`, `WIDTH`).  Selector 0 is an escape: a 28-bit count and a 32-bit id, for a run of one
id.  Selector 15 takes one value of up to 60 bits, so any id fits.  The index holds the word offset of each block, so
blocks are decoded from any place, and all words of a stretch at once.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from aeroloom.llm import files, text as T, tokens

BLOCK = 128
MAGIC = b"AL8B\x01\x00\x00\x00"
#: Ids per word and their width, by selector (fixed values of the format); 0 is the run escape.
COUNT = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 2, 1], np.int64)
WIDTH = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 28, 30, 60], np.int64)
_FITS = range(1, 16)
_U8, _U64 = np.uint8, np.uint64


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id, at least one."""
    return np.maximum(np.frexp(ids.astype(np.float64))[1], 1).astype(_U8)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of the ids, and the word at which each block begins (one more at the end).

    All blocks are walked side by side: step k writes the k-th word of each block that isn't done.
    """
    n = len(ids)
    rows = -(-n // BLOCK)
    if rows == 0:
        return np.zeros(0, _U64), np.zeros(1, np.int64)
    values = np.zeros((rows, BLOCK), _U64)
    values.ravel()[:n] = ids
    length = np.full(rows, BLOCK, np.int64)
    length[-1] = n - BLOCK * (rows - 1)
    width = np.zeros((rows, BLOCK), _U8)  # beyond the end: 0, so that the last word may be part full
    width.ravel()[:n] = _widths(np.asarray(ids))
    best = np.full((rows, BLOCK), 15, _U8)
    most, reach = width.copy(), 1  # the largest width among the next `reach` ids
    done: dict[int, np.ndarray] = {1: most}
    for size in sorted({int(COUNT[s]) for s in _FITS} - {1}):
        wide = done[reach].copy()
        step = size - reach
        while step > 0:  # widen from windows that are known
            have = max(k for k in done if k <= step)
            wide[:, :BLOCK - (size - step)] = np.maximum(wide[:, :BLOCK - (size - step)], done[have][:, size - step:])
            step -= have
        done[size], reach = wide, size
    for s in reversed(_FITS):
        best[done[int(COUNT[s])] <= WIDTH[s]] = s
    same = np.zeros((rows, BLOCK), bool)
    same[:, :-1] = values[:, 1:] == values[:, :-1]
    same.ravel()[n - 1:] = False
    stops = np.where(same, BLOCK, np.arange(BLOCK))
    run = np.minimum.accumulate(stops[:, ::-1], axis=1)[:, ::-1] - np.arange(BLOCK) + 1
    small = values < _U64(1 << 32)
    escape = (run > COUNT[best]) & small
    pace = COUNT[best]
    if escape.any():
        pace = np.where(escape, run, pace)
    pace, limit = pace.ravel(), np.arange(rows) * BLOCK + length
    at, owner, live = np.arange(rows) * BLOCK, np.arange(rows), []
    while len(at):
        live.append((owner, at))
        at = at + pace[at]
        more = at < limit[owner]
        at, owner = at[more], owner[more]
    owner, at = np.concatenate([o for o, _ in live]), np.concatenate([p for _, p in live])
    order = np.argsort(owner, kind="stable")
    at = at[order]
    s = np.where(escape.ravel()[at], 0, best.ravel()[at])
    words = s.astype(_U64) << _U64(60)
    roomy = np.zeros((rows, BLOCK + 60), _U64)  # so that a part-full word reads zeros
    roomy[:, :BLOCK] = values
    roomy, inside = roomy.ravel(), at + at // BLOCK * 60
    for sel in np.unique(s):
        mine = np.flatnonzero(s == sel)
        p = inside[mine]
        if sel == 0:
            words[mine] = (pace[at[mine]].astype(_U64) << _U64(32)) | roomy[p]
            continue
        w = words[mine]
        for k in range(int(COUNT[sel])):
            w |= roomy[p + k] << _U64(k * int(WIDTH[sel]))
        words[mine] = w
    return words, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))])


def decode(words: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of the words of whole blocks that begin at ``begins`` (one more at the end)."""
    if n == 0:
        return np.zeros(0, _U64)
    s = (words >> _U64(60)).astype(np.int64)
    count = np.where(s == 0, ((words >> _U64(32)) & _U64((1 << 28) - 1)).astype(np.int64), COUNT[s])
    stop = np.cumsum(count)
    start = stop - count
    k = np.arange(stop[-1]) - np.repeat(start, count)
    big = np.repeat(words, count)
    sel = np.repeat(s, count)
    mask = ((_U64(1) << WIDTH.astype(_U64)) - _U64(1))
    mask[0] = _U64((1 << 32) - 1)
    out = (big >> (k * WIDTH[sel]).astype(_U64)) & mask[sel]
    # The last word of a block may be part full: keep each block's first BLOCK ids.
    rows = len(begins) - 1
    ends = np.append(stop, 0)[begins[1:] - 1]
    firsts = np.concatenate([[0], ends[:-1]])
    size = np.full(rows, BLOCK, np.int64)
    size[-1] = n - BLOCK * (rows - 1)
    if (ends - firsts == size).all():
        return out
    base = np.cumsum(size) - size
    return out[np.arange(n) + np.repeat(firsts - base, size)]


class Writer:
    """Writes one file; groups of blocks go out as they fill, the index is kept until the end."""

    GROUP = BLOCK * 256

    def __init__(self, out):
        self.out, self.held, self.size = out, [], 0
        self.begins, self.words, self.ids = [np.zeros(1, np.int64)], 0, 0
        self.docs, self.counts = [], []
        out.write(MAGIC)

    def add(self, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs += doc_ids
        self.counts.append(counts)
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.GROUP:
            all_ids = np.concatenate(self.held)
            cut = self.size // BLOCK * BLOCK
            self._put(all_ids[:cut])
            self.held, self.size = [all_ids[cut:]], self.size - cut

    def _put(self, ids: np.ndarray) -> None:
        words, begins = encode(ids)
        self.out.write(words.astype("<u8").tobytes())
        self.begins.append(begins[1:] + self.words)
        self.words += len(words)
        self.ids += len(ids)

    def close(self) -> dict:
        if self.size:
            self._put(np.concatenate(self.held))
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)
        begins = np.concatenate(self.begins)
        names = json.dumps(self.docs).encode()
        for blob in (begins.astype("<i8").tobytes(), counts.astype("<i8").tobytes(), names):
            self.out.write(blob)
        self.out.write(struct.pack("<5q", len(begins), len(counts), len(names), self.words, self.ids))
        return {"n_docs": len(self.docs), "n_ids": self.ids, "n_words": self.words}


def read_file(uri: str, blocks: int = 4096) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Documents of a file in order: their ids, token counts and tokens, a bounded stretch of blocks at a time."""
    with files.read_at(uri) as f:
        end = f.size() - 40
        n_begins, n_docs, n_names, n_words, n_ids = struct.unpack("<5q", f.read_at(40, end))
        at = len(MAGIC) + 8 * n_words
        begins = np.frombuffer(f.read_at(8 * n_begins, at), "<i8")
        counts = np.frombuffer(f.read_at(8 * n_docs, at + 8 * n_begins), "<i8")
        names = json.loads(f.read_at(n_names, at + 8 * n_begins + 8 * n_docs))
        stops = np.cumsum(counts)
        held, base, doc = np.zeros(0, np.uint32), 0, 0
        for lo in range(0, max(n_begins - 1, 1), blocks):
            hi = min(lo + blocks, n_begins - 1)
            if hi > lo:
                words = np.frombuffer(f.read_at(8 * int(begins[hi] - begins[lo]), len(MAGIC) + 8 * int(begins[lo])), "<u8")
                n = min(hi * BLOCK, n_ids) - lo * BLOCK
                held = np.concatenate([held, decode(words, begins[lo:hi + 1] - begins[lo], n).astype(np.uint32)])
            upto = int(np.searchsorted(stops, base + len(held), "right"))
            if upto > doc:
                size = int(stops[upto - 1]) - base
                yield names[doc:upto], counts[doc:upto], held[:size]
                held, base, doc = held[size:], base + size, upto


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 0, n_files: int | None = None) -> DataFrame:
    """Encode ``doc_id, text`` and write token files under ``folder``; returns the manifest, one row per file.

    Files are numbered by ascending doc_id and hold their documents in that order (equal ids by text; a null id comes
    first, a null text is an empty one).  Each document ends with ``end_id``.  The manifest has file, uri, n_docs,
    n_ids, n_words and first_id, the ids in all files before it.  An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    T.small_batches(spark)
    n = n_files or files.parts(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = files.bounds(rows, "doc_id", n)
    dealt = (rows.withColumn("file", files.bucket_of("doc_id", cuts)).repartitionById(n, "file")
             .sortWithinPartitions("file", F.col("doc_id").asc_nulls_first(), "text").select("file", "doc_id", "text"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = tokens.encoder(vocabulary)
        number, ctx, writer, done = None, None, None, []

        def finish():
            done.append({"file": number, "uri": f"{folder}/{number:06d}.ids", **writer.close()})
            ctx.__exit__(None, None, None)

        for batch in batches:
            for f, part in batch.groupby("file", sort=True):
                if f != number:
                    if writer is not None:
                        finish()
                    number = int(f)
                    ctx = files.committed(f"{folder}/{number:06d}.ids")
                    writer = Writer(ctx.__enter__())
                texts = part["text"].tolist()
                names = [None if pd.isna(v) else int(v) for v in part["doc_id"]]
                for lo, hi in T.chunks(texts):
                    ids, begins = enc.encode(texts[lo:hi])
                    writer.add(names[lo:hi], np.diff(begins) + 1, np.insert(ids, begins[1:], end_id))
        if writer is not None:
            finish()
        yield pd.DataFrame(done, columns=["file", "uri", "n_docs", "n_ids", "n_words"])

    manifest = files.written(dealt.mapInPandas(write, "file int, uri string, n_docs long, n_ids long, n_words long"), "token-manifest")
    # One small row per file.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Documents of the files of a manifest: doc_id, start, n_tokens and ids_crc32 of the ids read back."""
    spark = manifest.sparkSession

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for uri, first in zip(batch["uri"], batch["first_id"]):
                at = int(first)
                for names, counts, ids in read_file(uri):
                    raw = memoryview(ids.astype("<u4").tobytes())
                    stops = np.cumsum(counts)
                    crc = [zlib.crc32(raw[4 * int(b - c):4 * int(b)]) for b, c in zip(stops, counts)]
                    yield pd.DataFrame({"doc_id": pd.array(names, "Int64"), "start": at + stops - counts, "n_tokens": counts, "ids_crc32": crc})
                    at += int(stops[-1])

    n = files.parts(spark)
    return (manifest.select("file", "uri", "first_id").repartition(n, "file")
            .mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))
