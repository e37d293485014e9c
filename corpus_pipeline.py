"""From raw documents to packed training sequences.

language ID, near-duplicates, personal data, source mixture, packing: each stage gets what the one before
kept, as a stored table, and decides on all of it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.llm import langid, minhash, mixing, packing, pii
from shoal.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Word shingles and percent of similarity from which two documents are near-duplicates.
WIDTH, PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those that lie between two languages. A missing ``lang`` is filled in."""
    model = langid.fit(langid.train_rows(docs))
    found = langid.identify(docs, model, tuple(COLUMNS))
    return (found.filter((F.col("lang_pred") != "und") & ~F.col("ambiguous"))
            .withColumn("lang", F.coalesce("lang", "lang_pred")).select(COLUMNS))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group of near-duplicates, once. Documents without words or id stay."""
    found = minhash.near_duplicates(docs, WIDTH, PERCENT)
    keep = found.filter("kept").select("doc_id").distinct()
    docs = docs.select(COLUMNS)
    return (docs.join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
            .union(docs.filter("doc_id is null")).select(COLUMNS))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; n_chars follows the text."""
    docs = docs.select(COLUMNS)
    return (pii.redact(docs, pii.fit(docs))
            .withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes of it, to the nearest whole: none, one or up to three. A source of which
    the mix takes words keeps the document that it takes most of, if rounding leaves it without any."""
    keyed = docs.select(COLUMNS).withColumn("_key", F.xxhash64("doc_id", "source", "text"))
    share = F.col("_taken") / F.greatest("_size", F.lit(1))
    taken = (mixing.mix(keyed, keep=("source", "_key")).groupBy("source", "_key")
             .agg(F.sum("taken").alias("_taken"), F.sum("size").alias("_size"))
             .select("source", "_key", "_taken", share.alias("_share"), F.round(share).cast("int").alias("_times")))
    bare = (taken.groupBy(F.col("source").alias("_s")).agg(F.max("_times").alias("_most"), F.max(F.struct("_share", "_key"))["_key"].alias("_one"),
                                                           F.sum("_taken").alias("_words"))
            .filter("_most = 0 and _words > 0").select("_s", "_one"))
    taken = (taken.join(bare, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_key") == F.col("_one")), "left")
             .select("_key", F.when(F.col("_one").isNotNull(), 1).otherwise(F.col("_times")).alias("_times")).filter("_times > 0"))
    return (keyed.join(taken, "_key").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
            .select(COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the packed sequences."""
    return packing.pack_documents(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
          ("mixture", mixture), ("pack", pack)]

#: Trained classifiers and a token vocabulary decide the rows; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
