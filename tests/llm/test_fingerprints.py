"""Weighted-sampling fingerprints: collision rate, order of documents, odd rows."""

import hashlib
import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from aeroloom.llm import fingerprints, queries, text as T


def test_collision_rate_is_generalised_jaccard():
    rng, z = np.random.default_rng(1), []
    for trial in range(40):
        k = T.mix64(np.arange(trial * 1000, trial * 1000 + 300, dtype=np.uint64))
        a = rng.integers(0, 5, 300)
        b = np.where(rng.random(300) < rng.random(), a, rng.integers(0, 5, 300))
        j = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        s = [fingerprints.signature(k[w > 0], w[w > 0].astype(float), 1024) for w in (a, b)]
        z.append(((s[0] == s[1]).mean() - j) / np.sqrt(max(j * (1 - j), 0.01) / 1024))
    assert abs(np.mean(z)) < 0.8 and np.std(z) < 1.6


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        q = len(t) // 4
        e = t[:len(t) - q] + after[:q]
        a, b, c = fingerprints.signatures([t, e, after])
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), *fingerprints.as_hex(np.array([a, b])), float((a == b).mean()), float((a == c).mean())))
    return out


def same(got, rows):
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))


def test_edited_texts_follow_the_order_of_ids(spark, docs_of):
    rows = [(5, "five words are in here"), (2, None), (9, ""), (7, "é🎉 " * 500), (7, "same id"), (1, "x" * 9000), (4, "copy of a text"), (3, "copy of a text"),
            (None, "no id"), (100, " \n ")] + [(1000 + i, f"text number {i} of some more") for i in range(60)]
    same(fingerprints.edited_likeness(docs_of(rows).withColumn("part", F.lit("clash"))).collect(), rows)


def test_one_and_no_document(spark, docs_of):
    same(fingerprints.edited_likeness(docs_of([(1, "only one here")])).collect(), [(1, "only one here")])
    assert fingerprints.edited_likeness(docs_of([])).collect() == []


def test_column_likeness(spark, docs_of):
    f = fingerprints.fingerprints(docs_of([(1, "a b c d e f"), (2, "a b c d e f"), (3, "a b c d x y"), (4, None)]))
    a, b = f.alias("a"), f.alias("b")
    got = {(r[0], r[1]): r[2] for r in a.join(b, F.col("a.doc_id") < F.col("b.doc_id")).select(
        "a.doc_id", "b.doc_id", fingerprints.likeness(F.col("a.fingerprint"), F.col("b.fingerprint"))).collect()}
    assert got[1, 2] == 1 and 0.2 < got[1, 3] < 0.9 and got[1, 4] == 0


def test_query(spark, given):
    from tests.llm.conftest import SF

    same(queries.op1_fingerprints(spark, SF).collect(), [(r.doc_id, r.text) for r in given("documents")])


def test_every_term_has_its_own_draws():
    """Long Zipf texts: words and pairs of each, against the exact weighted Jaccard."""
    rng, off = np.random.default_rng(3), []
    for n in (50_000, 200_000):
        sets = []
        for _ in range(2):
            words = T.mix64((rng.zipf(1.2, n) % 30_000).astype(np.uint64))
            sets.append(np.unique(np.concatenate([words, T.shingle_hashes(words, 2)]), return_counts=True))
        terms = np.union1d(sets[0][0], sets[1][0])
        w = np.zeros((2, len(terms)))
        for x, (k, counts) in zip(w, sets):
            x[np.searchsorted(terms, k)] = counts
        s = [fingerprints.signature(k, counts.astype(float), 512) for k, counts in sets]
        off.append((s[0] == s[1]).mean() - np.minimum(*w).sum() / np.maximum(*w).sum())
    assert np.abs(off).max() < 0.08  # the standard deviation is 0.022


def mixed(x):
    """The splitmix finaliser on Python's integers."""
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2 ** 64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2 ** 64
    return x ^ x >> 31


def plain_signature(weights, samples):
    """The least a of all terms by the formula alone, one term and sample at a time."""
    out = []
    for d in range(1, samples + 1):
        best = None
        for k, w in weights.items():
            h = mixed(k ^ mixed(d + 0xA0761D6478BD642F))
            more = mixed(h ^ 0x9E3779B97F4A7C15)
            x = -math.log1p(-(h + 0.5) / 2 ** 64)
            y = -math.log(((more >> 32) + 0.5) / 2 ** 32)
            q = -math.log((h % 2 ** 32 + (more % 2 ** 32 + 0.5) / 2 ** 32) / 2 ** 32)
            c = x + y
            r = math.log(c / x) + q
            t = math.floor(math.log(w) / r + q / r)
            a = math.log(c) - r * (t - q / r) - r
            best = min(best or (a, h, t), (a, h, t))
        out.append(mixed(best[1] ^ mixed(best[2] % 2 ** 64)) >> 48)
    return out


def test_signature_against_the_plain_formula():
    rng = np.random.default_rng(4)
    for n, of in ((1, [1.0]), (1, [0.3]), (5, [2.0, 7.0]), (300, [0.3, 1.0, 1.0, 2.0, 70.5]), (900, [1.0]), (2000, [1.0, 1.0, 1.0, 2.0, 3.0])):
        k, w = np.unique(T.mix64(np.arange(n, dtype=np.uint64))), rng.choice(of, n)
        assert fingerprints.signature(k, w, 16).tolist() == plain_signature(dict(zip(k.tolist(), w.tolist())), 16)


def test_texts_against_the_plain_formula():
    texts = ["one two three two one two", "", "same same same", "a\tb\nc " * 40, "x"]
    for text, got in zip(texts, fingerprints.signatures(texts, 8).tolist()):
        words = text.split()
        spans = [int(T.span_hashes(T.code_points([w])[0], np.array([0]), np.array([len(w)]))[0]) for w in words]
        pairs = [mixed(mixed(a) * 0x100000001B3 + b & 2 ** 64 - 1) for a, b in zip(spans, spans[1:])]
        assert got == plain_signature(dict(Counter(spans + pairs)) or {1: 1}, 8)


def test_draws_have_their_distributions():
    """r and c Gamma(2, 1), b uniform, none correlated with another."""
    r, log_c, b = fingerprints._draws(T.mix64(np.arange(400_000, dtype=np.uint64)))
    c = np.exp(log_c)
    for x, mean, variance in ((r, 2, 2), (c, 2, 2), (b, 0.5, 1 / 12)):
        assert abs(x.mean() - mean) < 0.012 and abs(x.var() - variance) < 0.03
    # Gamma(2, 1) has 1 - 2/e of its mass below 1.
    assert abs((r < 1).mean() - (1 - 2 / math.e)) < 0.004 and abs((c < 1).mean() - (1 - 2 / math.e)) < 0.004
    assert np.abs(np.corrcoef([r, log_c, b, r * b, np.log(r)])[[0, 0, 1, 1, 2], [1, 2, 2, 3, 4]]).max() < 0.008
