"""One query per operator, over its whole table, and the SQL for those that SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.llm import (ann, embed_dedup, langid, lm, merkle, minhash, mixing, packing, pii, secret_scan, spelling,
                       toxicity, url_rules)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.labelled(docs, _table(spark, sf_dir, "labels")))
    return toxicity.score(toxicity.split(docs), model, ("doc_id", "held_out"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(langid.split(docs), langid.fit(langid.train_rows(docs)), ("doc_id", "held_out"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return lm.score(lm.split(docs), lm.fit(lm.train_rows(docs)), ("doc_id", "held_out"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=2)


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_packing, op3_embedding_dedup, op4_mixing, op5_pii, op6_langid,
                                   op7_ann, op8_secrets, op9_lm_scoring, op10_minhash_dedup, op11_url_rules, op12_spelling_variants,
                                   op13_merkle_manifest, pipeline)}
ORACLES = {"op3_embedding_dedup": embed_dedup.ORACLE, "op4_mixing": mixing.ORACLE, "op7_ann": ann.ORACLE,
           "op10_minhash_dedup": minhash.ORACLE, "op11_url_rules": url_rules.ORACLE, "op12_spelling_variants": spelling.ORACLE,
           "op13_merkle_manifest": merkle.ORACLE}
