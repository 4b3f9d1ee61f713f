"""One query per operator over the given tables, with the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatelake.llm import classifier, decontaminate, fim, jaccard, licenses, ngram, packing, pieces, pseudonyms, repair, rules, secrets, urls
from gatelake.llm.common import table
from gatelake.llm.oracles import ORACLES  # noqa: F401

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
TOKENIZER = "byte_bpe_50k.json"
PSEUDONYM_KEY = "rotate-me"  # a deployment passes its own secret



def tokenizer_file(name: str) -> str:
    """Content of a public tokenizer's file."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("posterior", 4).alias("posterior")
    )


@query
def op2_ngram_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score")
    )


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("found")


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.round_trip(docs, pieces.read_model(MODEL_PATH)).select(
        "doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("bigint").alias("n_tokens"), "ids",
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = classifier.fit(docs, table(spark, sf_dir, "labels"))
    return classifier.score(docs.select("doc_id", "text", "source", "lang", "n_chars"), model).select(
        "doc_id", "p_text", "p_meta", "score", "keep"
    )


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.fill_in_middle(table(spark, sf_dir, "documents")))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


@query
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pieces(packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(TOKENIZER)))
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
