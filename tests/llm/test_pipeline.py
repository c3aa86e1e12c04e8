"""The corpus pipeline stage by stage, each on its own input."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from aeroloom.llm import files, language, quality
from tests.llm.conftest import DOCS, SF
from tests.llm.test_setjoin import brute
from tests.llm.test_tokens import VOCABULARY, check_pieces


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        before = docs
        docs = files.written(stage(spark, docs, SF), f"test-{name}")
        out[name] = (before, docs)
    return out


def test_columns_stay_up_to_the_last_stage(outputs):
    assert [n for n, _ in pipeline.STAGES] == ["quality", "language", "near_duplicates", "personal_data", "packing"]
    for name in list(outputs)[:-1]:
        assert outputs[name][1].columns == pipeline.COLUMNS


def test_quality_keeps_good_documents(spark, outputs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = (set(r.doc_id for r in d.collect()) for d in outputs["quality"])
    good = [i for i in before if labels.get(i) == 1]
    bad = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in good) >= 0.97 * len(good) and sum(i in after for i in bad) <= 0.3 * len(bad)


def test_language_keeps_documents_with_words(outputs):
    before, after = (d.collect() for d in outputs["language"])
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert len(gone) <= 0.02 * len(before) and all(r.lang for r in after)


def test_one_document_of_each_group_stays(outputs):
    before, after = (d.collect() for d in outputs["near_duplicates"])
    want = {i for i, _, c in brute([(r.doc_id, r.text) for r in before], 5, 4, 5) if i == c}
    assert sorted(r.doc_id for r in after) == sorted(want)
    rows = {tuple(r) for r in before}
    assert all(tuple(r) in rows for r in after)


def test_personal_data_keeps_all_documents(outputs):
    before, after = (sorted(d.collect()) for d in outputs["personal_data"])
    assert [r.doc_id for r in before] == [r.doc_id for r in after] and any(a.text != b.text for a, b in zip(before, after))
    assert all(r.n_chars == len(r.text) for r in after)


def test_packing_holds_every_id_once(outputs):
    before, after = outputs["packing"]
    check_pieces(after.collect(), [(r.doc_id, r.text) for r in before.collect()], Tokenizer.from_file(VOCABULARY), 1024)


def test_odd_rows_pass_every_stage(spark):
    texts = [None, "", " \n", "12 !!", "Le texte est ici, et il est bon. " * 20, "Le texte est ici, et il est bon. " * 20, "x" * 50_000, "the of and to " * 30]
    docs = spark.createDataFrame([(i % 6, t, None, None, None) for i, t in enumerate(texts)] + [(None, texts[4], "fr", "s", 1)], DOCS)
    docs = docs.withColumn("rep", F.lit("clash"))
    for _, stage in pipeline.STAGES[1:]:
        docs = files.written(stage(spark, docs, SF), "odd")
    assert docs.where("doc_id IS NULL").count() > 0 and {r.doc_id for r in docs.collect()} >= {4}
    empty = spark.createDataFrame([], DOCS)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_models_see_no_label_of_held_out_documents(spark):
    """Turning the labels of held-out documents around changes no score."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(language.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    got = []
    for table in (labels, turned):
        model = quality.train(docs.where(~language.held_out()), table.where(~language.held_out()))
        got.append(np.concatenate([model.w1.ravel(), model.w2, [model.b2, model.prior]]))
    assert (got[0] == got[1]).all()
