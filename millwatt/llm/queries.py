"""The registered queries on training text, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontam,
    exactdedup,
    language,
    linededup,
    minhash,
    mixing,
    quality,
    resampling,
    rules,
    sql,
    substring,
    toxicity,
    urls,
    whitening,
)
from .stage import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.dedup(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.report(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_join(F.col("items").cast("array<string>"), ",").alias("items")
    return found.select("doc_id", "contaminated", (~F.col("contaminated")).alias("kept"), "n_items", items)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return substring.dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return rules.judge(docs, trusted)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.dedup(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_minhash,
        op3_mixing,
        op4_line_dedup,
        op5_decontamination,
        op6_substring_dedup,
        op7_quality_classifier,
        op8_language,
        op9_url_filter,
        op10_quality_rules,
        op11_importance_resampling,
        op12_whitening,
        op13_exact_dedup,
    )
}
# The other queries train models, hash with functions of Spark, or compare all documents: their tests are brute force.
SQL: dict[str, str] = {
    "op3_mixing": sql.MIXING,
    "op4_line_dedup": sql.LINE_DEDUP,
    "op9_url_filter": sql.URL_FILTER,
    "op11_importance_resampling": sql.RESAMPLING,
    "op13_exact_dedup": sql.EXACT_DEDUP,
}
