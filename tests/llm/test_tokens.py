"""Token files and packing, against the library itself."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aeroloom.llm import files, packing, queries, token_files, tokens

VOCABULARY = queries.vocabulary("byte_bpe_50k.json")
ODD = [None, "", " ", "\n\n", "a", "it's 'll' I've\t!?  x", "x" * 3000, "word " * 4000, "é漢字🎉 ١٢", "<|endoftext|>", "a <|endoftext|> b"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_pieces_give_the_ids_of_whole_texts(library):
    draw = random.Random(5)
    texts = ["".join(draw.choice("ab's't re ve ll!\n\t é漢1٣²\xa0　'’\\🎉<|>") for _ in range(draw.randint(0, 40))) for _ in range(4000)]
    ids, begins = tokens.PieceEncoder(VOCABULARY).encode(texts)
    for i, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[begins[i]:begins[i + 1]].tolist() == e.ids, texts[i]


def test_forgetting_pieces_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    enc = tokens.PieceEncoder(VOCABULARY)
    for t in ["one two three four", "five six", "one two", "seven"]:
        assert enc.encode([t])[0].tolist() == library.encode(t).ids


@pytest.mark.parametrize("kind", range(6))
def test_codec_round_trip(kind):
    rng = np.random.default_rng(kind)
    for n in (0, 1, 127, 128, 129, 1000, 5000):
        a = [rng.integers(0, 50257, n), rng.integers(0, 2, n), np.minimum(rng.pareto(0.3, n) * 3, 2.0 ** 59), np.repeat(rng.integers(0, 9999, n), 25)[:n],
             np.zeros(n), rng.integers(2 ** 58, 2 ** 60, n)][kind].astype(np.uint64)
        words, begins = token_files.encode(a)
        assert (token_files.decode(words, begins, n) == a).all()
        if n > 400:  # from a block in the middle
            part = token_files.decode(words[begins[1]:begins[3]], begins[1:4] - begins[1], 256)
            assert (part == a[128:384]).all()


def check_files(got, rows, library):
    want, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ids_of(library, t)
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_files(spark, docs_of, library):
    rows = [(n * 7 - 20, t) for n, t in enumerate(ODD)] + [(None, "no id"), (1, "same id"), (1, "same id"), (1, None)]
    manifest = token_files.write_token_files(docs_of(rows), files.fresh(spark, "t"), VOCABULARY, n_files=3)
    check_files(token_files.read_token_files(manifest).collect(), rows, library)


def test_token_files_of_nothing(spark, docs_of):
    manifest = token_files.write_token_files(docs_of([]), files.fresh(spark, "t"), VOCABULARY)
    assert token_files.read_token_files(manifest).collect() == []


def test_token_files_query(spark, given, library):
    from tests.llm.conftest import SF

    check_files(queries.op4_token_files(spark, SF).collect(), [(r.doc_id, r.text) for r in given("documents")], library)


def test_decompose():
    doc, start, length = packing.decompose(np.array([1, 1027, 0, 2500]), 1024)
    assert list(zip(doc.tolist(), start.tolist(), length.tolist())) == [
        (0, 0, 1), (1, 0, 1024), (1, 1024, 2), (1, 1026, 1), (3, 0, 1024), (3, 1024, 1024), (3, 2048, 256), (3, 2304, 128), (3, 2432, 64), (3, 2496, 4)]
    with pytest.raises(ValueError):
        packing.decompose(np.array([1]), 1000)


def check_pieces(got, rows, library, longest):
    left = {}
    for i, t in rows:
        ids = ids_of(library, t)
        left.setdefault((i, len(ids)), []).append(ids)
    assert len({r.sequence_id for r in got}) == len(got)
    seen = {}
    for r in got:
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= longest and r.sequence_id >> packing.BUCKET_SHIFT == r.length.bit_length() - 1
        seen.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
    assert seen.keys() == left.keys()
    for k, copies in left.items():
        want = []
        for ids in copies:
            doc, start, length = packing.decompose(np.array([len(ids)]), longest)
            want += [(s, n, crc(ids[s:s + n])) for s, n in zip(start.tolist(), length.tolist())]
        assert sorted(want) == sorted(seen[k])


def test_pack(spark, docs_of, library):
    rows = [(n, t) for n, t in enumerate(ODD)] + [(3, "copy"), (3, "copy"), (None, "no id")]
    check_pieces(packing.pack(docs_of(rows).withColumn("ids", F.lit("clash")), VOCABULARY, longest=64).collect(), rows, library, 64)
    assert packing.pack(docs_of([]), VOCABULARY).collect() == []


def test_pack_query(spark, given, library):
    from tests.llm.conftest import SF

    check_pieces(queries.op7_pack(spark, SF).collect(), [(r.doc_id, r.text) for r in given("documents")], library, 1024)
