"""Texts as numpy arrays: code points, spans and span hashes of many texts at once, inside Spark tasks."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np

#: Code points handled at a time; a longer text makes a chunk of its own.
CHUNK = 1 << 20
#: Rows per Arrow batch: texts may be long, and a batch is held in memory.
BATCH_ROWS = 256
U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_tables: dict = {}
#: Unicode white space (fixed values of the standard).
SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Classes of `classes()`.
OTHER, LETTER, NUMBER, BLANK = 0, 1, 2, 3


def small_batches(spark) -> None:
    """Few rows per Arrow batch, so that a batch of long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def free_name(columns: list[str], name: str) -> str:
    """``name``, or with as many underscores behind it as make it differ from all ``columns`` (in any case of letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the splitmix finaliser)."""
    x = np.asarray(x, U64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def chunks(texts: list[str], limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts with about ``limit`` characters each."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and the offset at which each text begins (one more at the end)."""
    joined = "".join(texts)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4"), offsets


def _table(name: str, make):
    if name not in _tables:
        _tables[name] = make()
    return _tables[name]


def classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    def make():
        kinds = {"L": LETTER, "N": NUMBER}
        t = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)], np.uint8)
        t[SPACE] = BLANK
        return t
    return _table("classes", make)


def _values() -> np.ndarray:
    return _table("values", lambda: mix64(np.arange(sys.maxunicode + 1, dtype=U64) + U64(0x51ED2701)))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if n > len(_tables.get("powers", ((),))[0]):
        size = max(n, CHUNK + 1)
        both = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, U64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=U64))
        if size > 4 * CHUNK:  # of a giant text: not kept
            return both[0], both[1]
        _tables["powers"] = tuple(both)
    return _tables["powers"]


def span_hashes(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; equal spans have equal hashes wherever they stand.

    A polynomial over a random value per code point, taken from one running sum, so the cost is per code point
    however the spans overlap.
    """
    power, inverse = _powers(len(cp) + 1)
    running = np.zeros(len(cp) + 1, U64)
    np.cumsum(_values()[cp] * power[:len(cp)], out=running[1:])
    return mix64((running[ends] - running[starts]) * inverse[starts] + (ends - starts).astype(U64))


def word_spans(word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs where ``word`` holds, never across texts; and the first word of each text."""
    n = len(word)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.zeros(n + 1, bool)
    before[1:] = word
    now = np.zeros(n + 1, bool)
    now[:n] = word
    starts = np.flatnonzero(now & (first | ~before))
    ends = np.flatnonzero(before & (first | ~now))
    return starts, ends, np.searchsorted(starts, offsets)


def plain_words(cp: np.ndarray) -> np.ndarray:
    """True on code points of words, that is of runs without blank, tab, line ends, VT and FF."""
    return (cp != 0x20) & ((cp < 0x09) | (cp > 0x0D))


def lower_ascii(cp: np.ndarray) -> np.ndarray:
    """A-Z as a-z; all else stays."""
    return np.where((cp >= 0x41) & (cp <= 0x5A), cp + np.uint32(32), cp)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` neighbouring words; all words as one shingle if there are fewer, none of none."""
    if len(words) == 0:
        return words
    n = max(1, len(words) - size + 1)
    out = np.zeros(n, U64)
    for k in range(min(size, len(words))):
        out = mix64(out * U64(0x100000001B3) + words[k:k + n])
    return out
