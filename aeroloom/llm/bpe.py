"""BPE encoding by speculation and verification, and decoding.

For a vocabulary of merges with word ends (``</w>``).  Each distinct word is cut by greedy longest match, which is cheap
but may differ from what the merges give.  A cut equals the merges' result exactly if every token of it is what the
merges make of its own characters, and no merge crosses the border of two neighbours.  The first holds for every token
in the trie, the second is checked for all neighbouring pairs at once, with array operations.  Only words with a pair
that fails are merged in rank order.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from aeroloom.llm import text as T

END = "</w>"
BASE = 512  # one symbol per byte, and one per byte that ends a word
#: Words remembered per worker before the memory starts anew; only speed depends on it.
REMEMBERED = 1_500_000
#: Words up to this many bytes are merged side by side as arrays, longer ones by a heap.
WIDE = 48
_codecs: dict[str, WordBpe] = {}


def codec(path: str) -> WordBpe:
    """The worker's codec for one vocabulary file."""
    if path not in _codecs:
        _codecs[path] = WordBpe(path)
    return _codecs[path]


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or one from U+0100 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in keep else extra))
        extra += b not in keep
    return out


def words_of(cp: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the matches of ``'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+``."""
    n = len(cp)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = T.classes()[cp]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    first = first[:n]
    blank = kind == T.BLANK
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 255, kind[:-1]
    cut = (first | (kind != before) | (kind == T.NUMBER)) & ~blank
    apo = np.flatnonzero((cp == 0x27) & cut)
    apo = apo[apo + 1 < n]
    apo = apo[~first[apo + 1]]
    if len(apo):
        a = cp[apo + 1]
        third = np.minimum(apo + 2, n - 1)
        b = np.where((apo + 2 < n) & ~first[third], cp[third], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        cut[apo[one | two] + 1] = False
        for hit, size in ((apo[one], 2), (apo[two], 3)):
            after = hit + size
            after = after[after < n]
            cut[after[~blank[after]]] = True
    starts = np.flatnonzero(cut)
    stops = np.append(np.flatnonzero(cut | blank | first), n)
    return starts, stops[np.searchsorted(stops, starts, "right")]


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        chars, vocab = byte_characters(), model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # Inner ids are in the order of the merges: a symbol's own id, then BASE + rank.
        inner = {c: b for b, c in enumerate(chars)} | {c + END: 256 + b for b, c in enumerate(chars)}
        self.left, self.right = np.arange(BASE + len(pairs)), np.arange(BASE + len(pairs))
        for rank, (a, b) in enumerate(pairs):
            self.left[BASE + rank], self.right[BASE + rank] = inner[a], inner[b]
            if inner.setdefault(a + b, BASE + rank) != BASE + rank:
                raise ValueError(f"two merges give {a + b!r}")
        self.outer = np.zeros(len(inner), np.uint32)
        for token, i in inner.items():
            self.outer[i] = vocab[token]
        key = self._key(self.left[BASE:], self.right[BASE:])
        order = np.argsort(key)
        self.pair_keys, self.pair_ids = key[order], BASE + order
        names = {i: t for t, i in self.library.get_vocab(with_added_tokens=True).items()}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self._grow_trie()
        self.forget()

    @staticmethod
    def _key(a, b):
        return np.asarray(a, np.int64) << 20 | np.asarray(b, np.int64)

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Inner id that the merge of each pair gives, or a number above all ids."""
        key = self._key(a, b)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ids[at], len(self.left))

    def _grow_trie(self) -> None:
        symbols = [(i,) for i in range(BASE)]
        for a, b in zip(self.left[BASE:].tolist(), self.right[BASE:].tolist()):
            symbols.append(symbols[a] + symbols[b])
        lengths = np.fromiter(map(len, symbols), np.int64, len(symbols))
        flat = np.fromiter((x for s in symbols for x in s), np.int64, int(lengths.sum()))
        ids, count = self.merge(flat, lengths)
        first = np.cumsum(count) - count
        sound = (count == 1) & (ids[first] == np.arange(len(symbols)))  # the merges make the token of its own characters
        nodes: dict[int, int] = {}
        token_at = [-1]
        for i in np.flatnonzero(sound).tolist():
            node = 0
            for x in symbols[i]:
                k = node << 9 | x
                node = nodes.get(k, 0)
                if not node:
                    node = nodes[k] = len(token_at)
                    token_at.append(-1)
            token_at[node] = i
        self.edge_keys = np.array(sorted(nodes), np.int64)
        self.edge_to = np.array([nodes[k] for k in self.edge_keys.tolist()], np.int64)
        self.token_at = np.array(token_at)

    def _step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        key = node << 9 | symbol
        at = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
        return np.where(self.edge_keys[at] == key, self.edge_to[at], 0)

    def greedy(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest match from the left for all words side by side: ids, and tokens per word."""
        stop = np.cumsum(lengths)
        at, word = stop - lengths, np.arange(len(lengths))
        found = []
        while len(word):
            best, reach = np.full(len(word), -1), np.zeros(len(word), np.int64)
            walker, node, depth = np.arange(len(word)), np.zeros(len(word), np.int64), 0
            while len(walker):
                node = self._step(node, symbols[at[walker] + depth])
                depth += 1
                on = node > 0
                walker, node = walker[on], node[on]
                token = self.token_at[node]
                hit = token >= 0
                best[walker[hit]], reach[walker[hit]] = token[hit], depth
                on = at[walker] + depth < stop[word[walker]]
                walker, node = walker[on], node[on]
            found.append((word, best))
            at = at + reach
            on = at < stop[word]
            at, word = at[on], word[on]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner = np.concatenate([w for w, _ in found])
        order = np.argsort(owner, kind="stable")
        return np.concatenate([t for _, t in found])[order], np.bincount(owner, minlength=len(lengths))

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether no merge crosses the border of each pair of sound tokens.

        Both tokens are undone from their last merge on.  At each stage the outermost parts at the border could have
        merged if such a merge ranks before the merge that was undone last; what is undone next is the later made.
        """
        out = np.zeros(len(a), bool)
        live, a, b = np.arange(len(a)), np.array(a, np.int64), np.array(b, np.int64)
        bound = np.full(len(a), len(self.left), np.int64)  # merges before this one come in time to cross
        while len(live):
            free = self._merged(a, b) >= bound
            live, a, b, bound = live[free], a[free], b[free], bound[free]
            # The merge made last is undone first; of equal ones the right-hand side's, which is made after the left's.
            by_left = a > b
            whole = np.where(by_left, self.right[a] == a, self.left[b] == b)  # a symbol: nothing to undo on that side
            other_whole = np.where(by_left, self.left[b] == b, self.right[a] == a)
            done = whole & other_whole
            out[live[done]] = True
            use_left = np.where(whole, ~by_left, by_left)
            bound = np.where(use_left, a, b + 1)
            a, b = np.where(use_left, self.right[a], a), np.where(use_left, b, self.left[b])
            live, a, b, bound = live[~done], a[~done], b[~done], bound[~done]
        return out

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merges in rank order for all words: ids, and tokens per word."""
        begin = np.cumsum(lengths) - lengths
        count = np.zeros(len(lengths), np.int64)
        made: list[tuple[np.ndarray, np.ndarray]] = []  # words, and their ids in a row
        low = 0
        for high in (4, 8, 16, WIDE):
            mine = np.flatnonzero((lengths > low) & (lengths <= high))
            low = high
            if len(mine) == 0:
                continue
            k = np.arange(high)
            inside = k < lengths[mine][:, None]
            row = np.where(inside, symbols[np.where(inside, begin[mine][:, None] + k, 0)], -1)
            size, live = lengths[mine].copy(), np.arange(len(mine))
            none = len(self.left)
            while len(live):
                r = row[live]
                got = np.where(r[:, 1:] >= 0, self._merged(np.maximum(r[:, :-1], 0), np.maximum(r[:, 1:], 0)), none)
                where = got.argmin(axis=1)
                value = got[np.arange(len(live)), where]
                on = value < none
                live, r, where, value = live[on], r[on], where[on], value[on]
                if len(live) == 0:
                    break
                shifted = np.concatenate([r[:, 1:], np.full((len(live), 1), -1)], axis=1)
                r = np.where(k > where[:, None], shifted, r)
                r[np.arange(len(live)), where] = value
                row[live] = r
                size[live] -= 1
            count[mine] = size
            made.append((np.repeat(mine, size), row[row >= 0]))
        for w in np.flatnonzero(lengths > WIDE).tolist():
            ids = self._merge_long(symbols[begin[w]:begin[w] + lengths[w]].tolist())
            count[w] = len(ids)
            made.append((np.full(len(ids), w), np.array(ids)))
        if not made:
            return np.zeros(0, np.int64), count
        order = np.argsort(np.concatenate([w for w, _ in made]), kind="stable")
        return np.concatenate([i for _, i in made])[order], count

    def _merge_long(self, ids: list[int]) -> list[int]:
        """One long word, with a heap over its pairs."""
        if not hasattr(self, "_pairs"):
            self._pairs = dict(zip(self.pair_keys.tolist(), self.pair_ids.tolist()))
        n = len(ids)
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := self._pairs.get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = m, -1
            after[i] = after[j]
            if after[j] < n:
                ahead[after[j]] = i
            for x, y in ((ahead[i], i), (i, after[i])):
                if x >= 0 and y < n and (new := self._pairs.get(ids[x] << 20 | ids[y])) is not None:
                    heapq.heappush(heap, (new, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.words = self.failed = 0

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Vocabulary ids of distinct words, and how many each has."""
        raw = [w.encode("utf-8", "replace") for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        symbols[np.cumsum(lengths) - 1] += 256
        ids, count = self.greedy(symbols, lengths)
        word = np.repeat(np.arange(len(words)), count)
        border = np.flatnonzero(word[1:] == word[:-1])
        pair, back = np.unique(self._key(ids[border], ids[border + 1]), return_inverse=True)
        good = self.compatible(pair >> 20, pair & ((1 << 20) - 1))[back]
        fails = np.zeros(len(words), bool)
        fails[word[border[~good]]] = True
        self.words, self.failed = self.words + len(words), self.failed + int(fails.sum())
        if fails.any():
            redo = np.flatnonzero(fails)
            begin = np.cumsum(lengths) - lengths
            take = np.repeat(begin[redo] - (np.cumsum(lengths[redo]) - lengths[redo]), lengths[redo]) + np.arange(lengths[redo].sum())
            new, n = self.merge(symbols[take], lengths[redo])
            keep = ~fails[word]
            owner = np.concatenate([word[keep], np.repeat(redo, n)])
            order = np.argsort(owner, kind="stable")
            ids = np.concatenate([ids[keep], new])[order]
            count[redo] = n
        return self.outer[ids], count

    def normalized(self, text: str) -> str:
        """NFC and lower case, character by character (blanks need no change: they only part words)."""
        if text.isascii():
            return text.lower()
        if max(text) < "̀":  # below, every text is NFC and case does not depend on neighbours
            return text.lower()
        return self.library.normalizer.normalize_str(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text begins among them (one more at the end)."""
        flat, sizes = [], np.zeros(len(texts), np.int64)
        for lo, hi in T.chunks(texts):
            ids, n = self._chunk(texts[lo:hi])
            flat.append(ids)
            sizes[lo:hi] = n
        return np.concatenate(flat) if flat else np.zeros(0, np.uint32), np.concatenate([[0], np.cumsum(sizes)])

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if any(s in t for s in self.specials for t in texts):
            return self._with_specials(texts)
        texts = [self.normalized(t) for t in texts]
        cp, offsets = T.code_points(texts)
        starts, ends = words_of(cp, offsets)
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
            ids, count = self.encode_words([joined[starts[i]:ends[i]] for i in where[new]])
            begin = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate([self.ids, ids])
            self.begin = np.insert(self.begin, at[new], begin)
            self.count = np.insert(self.count, at[new], count)
            self.known = np.insert(self.known, at[new], hashes[new])
            at = np.searchsorted(self.known, hashes)
        n = self.count[at][back]
        stop = np.cumsum(n)
        take = np.arange(stop[-1]) + np.repeat(self.begin[at][back] - (stop - n), n)
        # Differences of the running sum: a text of blanks alone has no word, and so no id.
        per_text = np.diff(np.concatenate([[0], stop])[np.searchsorted(starts, offsets)])
        return self.ids[take], per_text

    def _with_specials(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Texts that hold special tokens: each is one id, and what stands between is encoded by itself."""
        import re

        cut = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        out, sizes = [], []
        for t in texts:
            ids = []
            for part in cut.split(t):
                ids.append(np.array([self.library.token_to_id(part)], np.uint32) if part in self.specials else self._chunk([part])[0])
            out.append(np.concatenate(ids))
            sizes.append(len(out[-1]))
        return np.concatenate(out), np.array(sizes, np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens' names with a space between them: the vocabulary file names no decoder."""
        return b" ".join(map(self.names.__getitem__, ids.tolist()))


def encode_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """ids and decoded text of every document's whole text, with all other columns of ``docs``.

    Adds ``ids`` (null text: none) and ``decoded`` (binary, UTF-8), replacing columns of these names.
    """
    return _mapped(docs, vocabulary, full=True)


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and decoded text, without sending either out of the task.

    A null text is an empty one: no ids, and the decoded text is empty.  Repeated rows give repeated results.
    """
    return _mapped(docs, vocabulary, full=False)


def _mapped(docs: DataFrame, vocabulary: str, full: bool) -> DataFrame:
    T.small_batches(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in ("ids", "decoded")] if full else []
    rows = docs.drop("ids", "decoded") if full else docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = (", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "ids array<long>", "decoded binary"]) if full
              else "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(vocabulary)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"]]
            for lo, hi in T.chunks(texts):
                ids, begins = bpe.encode(texts[lo:hi])
                each = [ids[a:b].astype("<u4") for a, b in zip(begins[:-1], begins[1:])]
                if full:
                    yield batch.iloc[lo:hi].assign(ids=each, decoded=[bpe.decode(x) for x in each])
                else:
                    yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[lo:hi].array, "n_tokens": np.diff(begins),
                                        "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in each],
                                        "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in each]})

    return rows.mapInPandas(run, schema)
