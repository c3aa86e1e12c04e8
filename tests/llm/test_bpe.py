"""Speculative BPE against the library."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from aeroloom.llm import bpe, queries

VOCABULARY = queries.vocabulary("word_bpe_49k.json")
ODD = [None, "", " ", "\n\t", "a", "İstanbul ΣΑΣ Å", "it's 'll' I'VE !'s ?  x１٣", "x" * 3000, "word " * 4000, "thethethe" * 40, "漢字🎉", "<|endoftext|>",
       "a<|startoftext|> b"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())


@pytest.mark.parametrize("letters", ["abeintorsh's't re ve ll d !\n\t é漢1٣²\xa0　'’\\🎉<|>ΣİÅ", "etaoinshrdlu"])
def test_random_texts(library, letters):
    draw = random.Random(7)
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 70))) for _ in range(3000)]
    codec = bpe.WordBpe(VOCABULARY)
    ids, begins = codec.encode(texts)
    for i, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        mine = ids[begins[i]:begins[i + 1]]
        assert mine.tolist() == e.ids, texts[i]
        assert codec.decode(mine).decode() == library.decode(e.ids, skip_special_tokens=False)
    assert 0 < codec.failed < codec.words


def test_texts_of_blanks_among_others(library):
    codec = bpe.WordBpe(VOCABULARY)
    kinds = ["", " ", "\n\t ", "\u3000", "hello world", "a", " lead", "trail "]
    for x in kinds:
        for y in kinds:
            for texts in ([x, y], [x, y, "hello"], [x, x, y, x], [x, "<|endoftext|>", y]):
                ids, begins = codec.encode(texts)
                assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])] == [
                    e.ids for e in library.encode_batch(texts, add_special_tokens=False)], texts


def test_compatible_pairs_are_those_that_merge_to_themselves():
    codec, rng = bpe.codec(VOCABULARY), np.random.default_rng(3)
    sound = codec.token_at[codec.token_at >= 0]
    inner = sound[[not codec.names[i].endswith(b"</w>") for i in codec.outer[sound]]]
    a, b = rng.choice(inner[inner < 6000], 3000), rng.choice(sound[sound < 6000], 3000)

    def symbols(i):
        return [i] if i < bpe.BASE else symbols(codec.left[i]) + symbols(codec.right[i])

    words = [symbols(x) + symbols(y) for x, y in zip(a.tolist(), b.tolist())]
    ids, count = codec.merge(np.array([s for w in words for s in w]), np.array([len(w) for w in words]))
    first = np.cumsum(count) - count
    truth = [c == 2 and ids[f] == x and ids[f + 1] == y for c, f, x, y in zip(count, first, a, b)]
    assert codec.compatible(a, b).tolist() == truth and any(truth) and not all(truth)


def test_documents(spark, docs_of, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "copy"), (3, "copy"), (None, "no id")]
    got = bpe.digests(docs_of(rows), VOCABULARY).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *want(library, t))) for i, t in rows)
    assert bpe.digests(docs_of([]), VOCABULARY).collect() == []
    plain = [(i, t) for i, t in enumerate([" ", "hello world", "\n", "", None, "\u3000", "so it is", " ", "end"])]  # no special token: one chunk
    got = bpe.digests(docs_of(plain).coalesce(1), VOCABULARY).collect()
    assert sorted(map(tuple, got)) == sorted((i, *want(library, t)) for i, t in plain)
    for r in bpe.encode_decode(docs_of(rows), VOCABULARY).collect():
        e = library.encode(r.text or "", add_special_tokens=False)
        assert r.ids == e.ids and bytes(r.decoded).decode() == library.decode(e.ids, skip_special_tokens=False)


def test_query(spark, given, library):
    from tests.llm.conftest import SF

    got = {r.doc_id: tuple(r)[1:] for r in queries.op10_bpe(spark, SF).collect()}
    assert got == {r.doc_id: want(library, r.text) for r in given("documents")}
