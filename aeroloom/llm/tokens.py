"""Token ids of whole texts with a public byte-level BPE vocabulary, as the tokenizers library gives them.

Texts are cut by the vocabulary's split pattern with array operations; the library then encodes each distinct piece
once per worker.  Pieces are the unit over which byte-level BPE merges, so the ids are those of the whole text.
"""

from __future__ import annotations

import numpy as np

from aeroloom.llm import text as T

#: Pieces remembered per worker before the memory starts anew; only speed depends on it.
REMEMBERED = 1_500_000
_BLANKS = frozenset(map(chr, T.SPACE))
_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for one vocabulary file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def pieces(cp: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of the pattern
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``."""
    n = len(cp)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = T.classes()[cp]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    last = np.zeros(n, bool)
    last[offsets[1:][offsets[1:] > 0] - 1] = True
    first = first[:n]
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 255, kind[:-1]
    blank = kind == T.BLANK
    change = first | (kind != before)
    follows = np.zeros(n, bool)  # the same text goes on with something that isn't blank
    follows[:-1] = ~blank[1:]
    follows &= ~last
    cut = change & (blank | (before != T.BLANK) | first)
    # The blank before a run: U+0020 goes with the run, any other is a piece of its own; blanks before it are another.
    edge = blank & follows
    cut |= edge
    at = np.flatnonzero(edge & (cp != 0x20)) + 1
    cut[at] = True
    # Contractions: an apostrophe that is a whole run and does not go with a blank.
    apo = np.flatnonzero((cp == 0x27) & cut & (kind == T.OTHER))
    apo = apo[apo + 1 < n]
    apo = apo[~first[apo + 1]]
    if len(apo):
        a = cp[apo + 1]
        b = np.where((apo + 2 < n) & ~first[np.minimum(apo + 2, n - 1)], cp[np.minimum(apo + 2, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        cut[apo[one | two] + 1] = False
        for hit, size in ((apo[one], 2), (apo[two], 3)):
            after = hit + size
            cut[after[after < n]] = True
    starts = np.flatnonzero(cut)
    return starts, np.append(starts[1:], n)


class PieceEncoder:
    """Encodes texts; remembers the ids of the pieces it has seen."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, new: np.ndarray, words: list[str]) -> None:
        """Encode pieces that aren't known yet; ``new`` are their hashes, ascending."""
        lines = [w for w in words if w[:1] not in _BLANKS]
        spaced = [w for w in words if w[0] == " " and w[1:2] not in _BLANKS and len(w) > 1]
        found: dict[str, np.ndarray] = {}
        # Many pieces in one call, put so that the split pattern gives them back: those with a space before them in a
        # row, those without blanks on lines of their own.
        for group, glue, step in ((spaced, "", 1), (lines, "\n", 2)):
            parts = [group[i:i + 400] for i in range(0, len(group), 400)]
            for part, e in zip(parts, self.library.encode_batch([glue.join(p) for p in parts], add_special_tokens=False)):
                ids, word = np.array(e.ids, np.uint32), np.array(e.word_ids, np.int64)
                if len(word) and word[-1] + 1 == step * len(part) - step + 1:
                    cut = np.searchsorted(word, np.arange(0, step * len(part), step))
                    end = np.searchsorted(word, np.arange(0, step * len(part), step), "right")
                    found.update((w, ids[a:b]) for w, a, b in zip(part, cut.tolist(), end.tolist()))
        left = [w for w in words if w not in found]
        found.update((w, np.array(e.ids, np.uint32)) for w, e in zip(left, self.library.encode_batch_fast(left, add_special_tokens=False)))
        each = [found[w] for w in words]
        count = np.fromiter(map(len, each), np.int64, len(each))
        begin = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, *each])
        order = np.searchsorted(self.known, new)
        self.known = np.insert(self.known, order, new)
        self.begin = np.insert(self.begin, order, begin)
        self.count = np.insert(self.count, order, count)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text begins among them (one more at the end)."""
        flat, sizes = [], np.zeros(len(texts), np.int64)
        for lo, hi in T.chunks(texts):
            ids, n = self._chunk(texts[lo:hi])
            flat.append(ids)
            sizes[lo:hi] = n
        return np.concatenate(flat) if flat else np.zeros(0, np.uint32), np.concatenate([[0], np.cumsum(sizes)])

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if any(s in t for s in self.specials for t in texts):  # special tokens in a text: the library cuts there
            whole = [self.library.encode(t, add_special_tokens=False).ids for t in texts]
            return np.array([i for ids in whole for i in ids], np.uint32), np.array([len(x) for x in whole], np.int64)
        cp, offsets = T.code_points(texts)
        starts, ends = pieces(cp, offsets)
        if len(starts) == 0:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        hashes, where, back = np.unique(T.span_hashes(cp, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.known, hashes)
        have = np.zeros(len(hashes), bool)
        if len(self.known):
            have = self.known[np.minimum(at, len(self.known) - 1)] == hashes
        if not have.all():
            new = np.flatnonzero(~have)
            joined = "".join(texts)
            self._learn(hashes[new], [joined[starts[i]:ends[i]] for i in where[new]])
            at = np.searchsorted(self.known, hashes)
        n = self.count[at][back]
        stop = np.cumsum(n)
        take = np.arange(stop[-1]) + np.repeat(self.begin[at][back] - (stop - n), n)
        per_text = np.diff(np.concatenate([[0], stop])[np.searchsorted(starts, offsets)])
        return self.ids[take], per_text
