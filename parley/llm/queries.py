"""Registered queries of the package (production parameters, whole tables) and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, ctw, decontaminate, filter_audit, language, licenses, line_dedup, quality, resample, simhash, sql, token_counts,
               toxicity, url_filter)
from .common import read_columns

Query = Callable[[SparkSession, str], DataFrame]


#: rules of the URL contract
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
#: words of host labels that mark spam hosts
SPAM_WORDS = ["spam", "casino", "pills", "bets", "ads", "adult"]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL against the fixed rules; where none fits, against the spam hosts of the table."""
    pages = read_columns(spark, sf_dir, "pages", ["page_id", "url"])
    judged = url_filter.filter_urls(pages, spark.createDataFrame(URL_RULES, "rule string, verdict string"))
    own = url_filter.filter_urls(pages.select("url").distinct(), url_filter.spam_hosts(pages, SPAM_WORDS))
    blocked = own.where("rule is not null").select("host", F.col("rule").alias("spam_host")).distinct()
    out = judged.join(blocked, "host", "left")
    return out.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNull() & F.col("spam_host").isNotNull(), "block")
                      .otherwise(F.col("verdict")).alias("verdict"), "spam_host")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, boundary-crossing tokens by majority of characters."""
    return token_counts.token_counts(read_columns(spark, sf_dir, "documents", ["doc_id", "text"]))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document as digests."""
    return bpe.encode(read_columns(spark, sf_dir, "documents", ["doc_id", "text"]), keep_ids=False)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item it holds, copied or edited."""
    return decontaminate.find_leaks(read_columns(spark, sf_dir, "documents", ["doc_id", "text"]),
                                    read_columns(spark, sf_dir, "benchmark", ["item_id", "text"]))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and short notices (up to 12 % edits) of every document."""
    return licenses.scan(read_columns(spark, sf_dir, "documents", ["doc_id", "text"])).drop("spans")


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """Trained on the labelled documents whose crc32 remainder by 5 is not 0."""
    docs = read_columns(spark, sf_dir, "documents", ["doc_id", "text"])
    return toxicity.train(docs, read_columns(spark, sf_dir, "labels", ["doc_id", "toxic"]).where(_fold(5) != 0))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    out = toxicity.score(read_columns(spark, sf_dir, "documents", ["doc_id", "text"]), toxicity_model(spark, sf_dir)).drop("text")
    return out.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


BASE_FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict of every document; the cascade runs in measured order."""
    out = quality.judge(read_columns(spark, sf_dir, "documents", ["doc_id", "text"]), keep=BASE_FIGURES)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select("doc_id", *BASE_FIGURES, failed.alias("base_failed"), (~failed & F.col("rejected_by").isNull()).alias("kept"))


def _fold(modulus: int):
    """crc32 of the id's text modulo ``modulus``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; prototypes from the labelled documents of the other folds."""
    docs = read_columns(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    model = language.train(docs.where(_fold(3) != 1))
    out = language.predict(docs, model)
    return out.select("doc_id", (_fold(3) == 1).alias("held_out"), "lang_pred", "score")


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree score and word base of every document; the model learns from the other nine folds."""
    docs = read_columns(spark, sf_dir, "documents", ["doc_id", "text"])
    out = ctw.score(docs, _fold(10) != 0)
    return out.select("doc_id", (_fold(10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
                      "bits_per_byte")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, at most 3 differing bits."""
    return simhash.near_duplicates(read_columns(spark, sf_dir, "documents", ["doc_id", "text"]))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents of 20 words or more, drawn towards the benchmark; weights and scores of all."""
    return resample.resample(read_columns(spark, sf_dir, "documents", ["doc_id", "text"]),
                             read_columns(spark, sf_dir, "benchmark", ["text"]), percent=10, min_words=20)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in each of their 120 orders, for each language."""
    return filter_audit.audit_filters(read_columns(spark, sf_dir, "documents", ["doc_id", "text", "lang"]),
                                      read_columns(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"]))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents or more share."""
    out = line_dedup.drop_shared_lines(read_columns(spark, sf_dir, "documents", ["doc_id", "text"]), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_token_counts": op2_token_counts,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_decontaminate": op4_decontaminate,
    "op5_license_scan": op5_license_scan,
    "op6_toxicity": op6_toxicity,
    "op7_quality": op7_quality,
    "op8_language": op8_language,
    "op9_lm_score": op9_lm_score,
    "op10_simhash": op10_simhash,
    "op11_resample": op11_resample,
    "op12_filter_audit": op12_filter_audit,
    "op13_line_dedup": op13_line_dedup,
}

ORACLE: dict[str, str] = {
    "op1_url_filter": sql.url_filter(URL_RULES, SPAM_WORDS),
    "op7_quality": sql.QUALITY,
    "op11_resample": sql.RESAMPLE,
    "op12_filter_audit": sql.FILTER_AUDIT,
    "op13_line_dedup": sql.LINE_DEDUP,
}
