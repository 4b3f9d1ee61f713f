"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatelake.llm import classifier, decontaminate, jaccard, pieces, pseudonyms
from gatelake.llm.common import table
from gatelake.llm.queries import MODEL_PATH, PSEUDONYM_KEY
from gatelake.session import materialize


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes for good."""
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    return classifier.score(docs, model).where("keep").select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return jaccard.keep_one(docs, n=5, threshold=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up less than a twentieth."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with pseudonyms for personal values; ``n_chars`` follows a changed text."""
    new = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.when(F.col("n_replaced") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return new.select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the text's token ids and their number."""
    coded = pieces.encode(docs.select("doc_id", "text"), pieces.read_model(MODEL_PATH))
    return coded.selectExpr("doc_id", "ids", "cast(coalesce(size(ids), 0) as bigint) as n_tokens")


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("SentencePiece", sentencepiece),
]
# a fitted classifier and merges are not SQL; tests of the stages hold the join and the decontamination against
# brute force, the others only to ids, columns and counts
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage{i}")
    return docs
