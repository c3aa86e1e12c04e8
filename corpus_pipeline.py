"""Corpus pipeline: from documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and reread as the next one's docs:

1. quality: a classifier learned from trusted positives and unlabelled text; documents scored below `KEEP_QUALITY` go.
2. language: naive Bayes, learned from the documents it gets; those without a letter, or whose language is less sure than
   `KEEP_LANGUAGE`, go.  ``lang`` becomes the predicted language where it was null.
3. near duplicates: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more are linked; of each
   component the document with the smallest doc_id stays, once.
4. personal data: format-preserving pseudonyms in ``text``; ``n_chars`` follows the new text.
5. packing: sequences of a power of two tokens; its result is the pieces, with their ids.

Rows with a null doc_id pass all stages but the third, which cannot name them and keeps each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from aeroloom.llm import files, language, packing, pseudonyms, quality, setjoin
from aeroloom.llm.queries import vocabulary

KEEP_QUALITY, KEEP_LANGUAGE = 0.5, 0.5
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEY = "a key that only the owner of the corpus has"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; it learns from the labels of the training part."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~language.held_out())
    model = quality.train(docs.where(~language.held_out()), labels)
    return quality.predict(docs.select(*COLUMNS), model).where(F.col("quality_score") >= KEEP_QUALITY).select(*COLUMNS)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is sure enough; an unknown ``lang`` is filled in."""
    model = language.train(docs.where(~language.held_out()))
    scored = language.predict(docs.select(*COLUMNS), model)
    kept = scored.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("lang_score") >= KEEP_LANGUAGE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, and every document without words or doc_id."""
    classes = setjoin.similar_classes(docs.select("doc_id", "text"), size=5, threshold=(4, 5))
    kept = classes.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    named = docs.select(*COLUMNS).join(kept, "doc_id", "left_semi")
    # Rows that repeat a doc_id: the least stays.  The join has dealt and sorted the rows by doc_id already.
    once = named.groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("row")).select("doc_id", "row.*")
    return once.unionByName(docs.where(F.col("doc_id").isNull()).select(*COLUMNS))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pseudonyms in place of personal data; no document goes."""
    return (pseudonyms.pseudonymise(docs.select(*COLUMNS), KEY)
            .withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of up to 1024 tokens, none of which crosses documents."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good), ("language", keep_known_language), ("near_duplicates", keep_one_of_each_group), ("personal_data", hide_personal_data),
    ("packing", pack)]

#: No stage but the third can be said in SQL: models are trained, Feistel permutations hash, packing tokenizes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = files.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
