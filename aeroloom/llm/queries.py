"""Registered queries of the operators of this subpackage: name -> (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from aeroloom.llm import bpe, files, fingerprints, hyperminhash, language, merkle, nearest, packing, prefixtrie, pseudonyms, quality, setjoin, token_files, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def vocabulary(name: str) -> str:
    """File of a public vocabulary, in the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


@query
def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key="a key that only the owner of the corpus has")


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out())
    model = language.train(docs.where(~F.col("held_out")))
    return (language.predict(docs.select("doc_id", "held_out", "text"), model)
            .select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score")))


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = token_files.write_token_files(docs, files.fresh(spark, "token-files"), vocabulary("byte_bpe_50k.json"))
    return token_files.read_token_files(manifest)


@query
def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out())
    model = quality.train(docs.where(~F.col("held_out")), table(spark, sf_dir, "labels").where(~language.held_out()))
    return (quality.predict(docs.select("doc_id", "held_out", "text"), model)
            .select("doc_id", "held_out", F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.7).cast("int").alias("predicted")))


@query
def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")).drop("ids")


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = warc.mark_revisits(table(spark, sf_dir, "pages"))
    archives = warc.write_archives(marked, files.fresh(spark, "warc-whole"))
    return warc.read_archives(warc.normalise_archives(archives, files.fresh(spark, "warc-members"))).drop("url")


ORACLES["op8_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages),
d AS (SELECT page_id, octet_length(raw) AS payload_bytes, sha256(raw) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""


@query
def op9_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.similar_classes(table(spark, sf_dir, "documents"), size=4, threshold=(17, 20))


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op11_prefixtrie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = merkle.manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], seen={"text": lowered}, when=tampered)
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op13_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), size=5, threshold=(17, 20))
