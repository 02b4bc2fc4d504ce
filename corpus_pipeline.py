"""From raw documents to tokens: five operators, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swident.llm import decontaminate, near_duplicates, pieces, quality_classifier, toxicity
from swident.llm.common import fold
from swident.storage import stored

MAX_TOXICITY = 0.3
MIN_QUALITY = 0.7
#: Nodes that a task of the last stage keeps: a bound of memory beside the stages before, results don't depend on it.
NODES = 150_000


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled examples don't vote toxic."""
    index = toxicity.fit(docs, _labels(spark, sf_dir), "toxic", fold(F.col("doc_id"), 4) != 2)
    return toxicity.score(docs, index, docs.columns).where(F.col("_swident_score") < MAX_TOXICITY).drop("_swident_score")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that rank above the learnt quantile; all of them if there is nothing to learn from."""
    ranker = quality_classifier.fit(docs, _labels(spark, sf_dir), "quality", fold(F.col("doc_id"), 4) != 2, at=MIN_QUALITY)
    if not ranker.learnt:
        return docs
    return quality_classifier.classify(docs, ranker, docs.columns).where(F.col("_swident_score") >= MIN_QUALITY).drop("_swident_score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an exact passage of the benchmark."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text, with seeded merge dropout, and whether they decode to it."""
    made = pieces.round_trip(docs, ["doc_id"], pieces.load_model(), seed=1, nodes=NODES)
    return made.select("doc_id", F.col("_swident_n_pieces").alias("n_pieces"), F.col("_swident_ids").alias("ids"), F.col("_swident_lossless").alias("lossless"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("n-gram jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece", tokens),
]

#: The stages learn models and tokenise, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
