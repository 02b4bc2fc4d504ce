"""The queries op1 .. op10 over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as q8
from . import katz as q7
from . import language as q3
from . import licenses as q2
from . import near_duplicates as q6
from . import oracle
from . import pieces as q4
from . import quality_classifier as q10
from . import quality_rules as q1
from . import toxicity as q5
from . import warc as q9
from .common import fold, held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trusted target: the documents that labels mark as good."""
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return q1.quality_rules(_table(spark, sf_dir, "documents"), good)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q2.license_scan(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow margins are rejected by the operator; the query reports its best guess."""
    docs = _table(spark, sf_dir, "documents")
    content = q3.sample_dictionaries(docs, fold(F.col("doc_id"), 5) != 0)
    found = q3.identify(docs, content, ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), F.col("_swident_lang").alias("lang_pred"), F.col("_swident_score").alias("score"), F.col("_swident_margin").alias("margin"), F.col("_swident_rejected").alias("rejected"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text under seed 1 with one merge in ten skipped, decoded again."""
    made = q4.round_trip(_table(spark, sf_dir, "documents"), ["doc_id"], q4.load_model(), seed=1)
    return made.select("doc_id", F.col("_swident_n_pieces").alias("n_pieces"), F.col("_swident_ids").alias("ids"), F.col("_swident_lossless").alias("lossless"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    index = q5.fit(docs, _table(spark, sf_dir, "labels"), "toxic", fold(F.col("doc_id"), 4) != 2)
    scored = q5.score(docs, index, ["doc_id"], evidence=True)
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), F.col("_swident_score").alias("score"), (F.col("_swident_score") >= 0.3).cast("int").alias("predicted"), F.col("_swident_evidence").alias("evidence"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q6.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = held_out(F.col("doc_id"), 7, 2)
    scored = q7.score(_table(spark, sf_dir, "documents"), ~held)
    return scored.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = q8.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = q9.round_trip(_table(spark, sf_dir, "pages"))
    return read.select(F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    ranker = q10.fit(docs, _table(spark, sf_dir, "labels"), "quality", fold(F.col("doc_id"), 4) != 2)
    scored = q10.classify(docs, ranker, ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), F.col("_swident_score").alias("score"), (F.col("_swident_score") >= 0.7).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_license_scan": op2_license_scan,
    "op3_language_id": op3_language_id,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_toxicity": op5_toxicity,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_katz_backoff": op7_katz_backoff,
    "op8_decontamination": op8_decontamination,
    "op9_warc": op9_warc,
    "op10_quality_classifier": op10_quality_classifier,
}

ORACLE_SQL: dict[str, str] = {
    "op2_license_scan": oracle.OP2,
    "op6_ngram_jaccard_join": oracle.OP6,
    "op8_decontamination": oracle.OP8,
    "op9_warc": oracle.OP9,
}
