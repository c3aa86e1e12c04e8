"""Language identification and quality classifier: held-out accuracy, brute force, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from aeroloom.llm import language, quality, queries
from tests.llm.conftest import SF

ODD = [(1, None), (2, ""), (3, " \n"), (4, "12 34 !!"), (5, "x"), (6, "the and of " * 5000), (7, "copy"), (7, "copy"), (None, "no id at all"), (9, "漢字 🎉")]


def kept_back(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_language_of_held_out_documents(spark, given):
    rows = queries.op3_language(spark, SF).collect()
    truth = {r.doc_id: r for r in given("documents")}
    assert {r.doc_id for r in rows} == truth.keys() and all(r.held_out == kept_back(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_language_score_is_naive_bayes():
    """Against the plain formula, gram by gram."""
    rng = np.random.default_rng(2)
    table = np.log(rng.dirichlet(np.ones(1 << language.BITS), 3).T).astype(np.float32)
    model = language.Model(["aa", "bb", "cc"], table, np.log([0.5, 0.3, 0.2]))
    texts = ["One two", "É漢 x", "", "..", "abc" * 30]
    labels, scores = language.score(model, texts)
    for t, label, s in zip(texts, labels, scores):
        alone, begins, _ = language.grams([t])
        assert len(begins) == 1
        counts = Counter(int(b) for g in alone for b in g)
        total = [model.prior[k] + sum(n * float(table[b, k]) for b, n in counts.items()) for k in range(3)]
        if not any(c.isalpha() for c in t):
            assert (label, s) == ("und", 0)
            continue
        best = max(range(3), key=lambda k: total[k])
        assert label == model.languages[best] and abs(s - 1 / sum(math.exp(x - total[best]) for x in total)) < 1e-6


def test_language_of_odd_rows(spark, docs_of):
    docs = docs_of([(i, t, "en") for i, t in ODD] + [(20, "der die das und", "de"), (21, "nur der", None)]).withColumn("lang_pred", F.lit("clash"))
    got = {(r.doc_id, r.text): (r.lang_pred, r.lang_score) for r in language.predict(docs, language.train(docs)).collect()}
    assert len(got) == len(ODD) + 1 and all(got[i, t][0] == "und" for i, t in ODD[:4]) and got[20, "der die das und"][0] == "de"
    none = language.train(docs_of([]))
    assert {r.lang_pred for r in language.predict(docs, none).collect()} == {"und"}
    assert language.predict(docs_of([]), none).collect() == []


def test_quality_of_held_out_documents(spark, given):
    rows = queries.op6_quality(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert len(rows) == 1000 and all(r.held_out == kept_back(r.doc_id) and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_features_do_not_depend_on_the_batch():
    texts = [t or "" for _, t in ODD] + ["Very very good.\nA line | with ## signs!!"]
    each = np.concatenate([quality.features([t]) for t in texts])
    assert np.allclose(quality.features(texts), each)
    words = texts[-1].split()
    at = len(quality.SIGNS) + len(quality.KINDS)
    assert np.isclose(each[-1][at + quality.WORDS.index("distinct")], len(set(words)) / len(words))
    assert np.isclose(each[-1][at + quality.WORDS.index("mean length")], np.mean([len(w) for w in words]) / 10)
    assert np.isclose(each[-1][quality.SIGNS.index("#")], np.sqrt(2 / len(texts[-1])))


def test_risk_stays_non_negative_and_separates():
    """Unlabelled data with 30 % negatives: the scores part the two kinds although no negative is known."""
    rng = np.random.default_rng(4)
    good, bad = rng.normal(1, 1, (3000, 4)), rng.normal(-1, 1, (900, 4))
    model = quality.fit(good[:900], np.concatenate([good[900:], bad]), prior=0.7)
    assert model.score(rng.normal(1, 1, (500, 4))).mean() > 0.85 and model.score(rng.normal(-1, 1, (500, 4))).mean() < 0.25


def test_risk_and_its_gradient_against_the_plain_formula():
    rng = np.random.default_rng(6)
    is_p = np.arange(12) < 5

    def plain(f, prior):
        """The positives' part, and that of the unknown negatives."""
        mean = lambda values: sum(values) / len(values)
        p, u = [float(x) for x in f[is_p]], [float(x) for x in f[~is_p]]
        return (prior * mean([math.log(1 + math.exp(-x)) for x in p]),
                mean([math.log(1 + math.exp(x)) for x in u]) - prior * mean([math.log(1 + math.exp(x)) for x in p]))

    turned = 0
    for _ in range(40):
        f, prior = rng.normal(0, 2, 12), rng.uniform(0.1, 0.9)
        of_p, rest = plain(f, prior)
        value, g = quality.risk(f, is_p, prior)
        assert abs(value - (of_p + max(0, rest))) < 1e-9
        turned += rest < 0
        for i in range(12):
            ends = [plain(f + d * (np.arange(12) == i), prior) for d in (-1e-5, 1e-5)]
            each = [sum(e) if rest >= 0 else -e[1] for e in ends]
            assert abs(g[i] - (each[1] - each[0]) / 2e-5) < 1e-5
    assert 0 < turned < 40


def test_prior_from_positives_and_unlabelled_rows():
    rng = np.random.default_rng(8)
    for prior in (0.3, 0.6, 0.9):
        n = int(3000 * prior)
        good, bad = rng.normal(1, 1, (900 + n, 4)), rng.normal(-1, 1, (3000 - n, 4))
        mixed = rng.permutation(np.concatenate([good[900:], bad]))
        model = quality.fit_with_prior(good[:900], mixed)
        assert abs(model.prior - prior) < 0.06
    again = quality.fit_with_prior(rng.permutation(good[:900]), rng.permutation(mixed))
    assert again.prior == model.prior and (again.w1 == model.w1).all()


def test_quality_of_odd_rows(spark, docs_of):
    docs = docs_of(ODD).withColumn("quality_score", F.lit("clash"))
    labels = spark.createDataFrame([(5, 1), (6, 1), (6, 1), (3, None), (99, 1), (None, 1), (4, 0)], "doc_id long, quality int")
    for model in (quality.train(docs, labels), quality.train(docs, labels.where("false")), quality.train(docs_of([]), labels)):
        rows = quality.predict(docs, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r.quality_score <= 1 for r in rows)
        same = {}
        for r in rows:
            same.setdefault(r.text or "", set()).add(r.quality_score)
        assert all(len(s) == 1 for s in same.values())
    assert quality.predict(docs_of([]), model).collect() == []


def test_copies_of_one_text_are_drawn_each_by_itself(docs_of):
    rows = [(100 * k + i, f"text of language {k}", f"l{k}") for k in range(8) for i in range(100)]
    model = language.train(docs_of(rows), rows_per_language=20)
    assert model.languages == [f"l{k}" for k in range(8)]
    assert language.train(docs_of(rows), rows_per_language=0.001).languages == model.languages
