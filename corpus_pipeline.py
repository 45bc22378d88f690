"""The corpus pipeline: language, lines, near copies, benchmark passages, mix.

Each stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and returns the documents that stay, in
the same columns; the last returns the mix. Rows are judged as each operator defines for nulls, empty and
repeated texts; stages add:

* Language: a document goes when its language is undetermined or its score is below ``LEAST_SCORE``. The declared language
  is not compared with the prediction.
* Lines: a document goes when every word of it went with removed lines.
* Near copies: of each group the smallest id stays. Rows that share an id are one document and stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwatt.llm import decontam, language, linededup, minhash, mixing
from millwatt.llm.stage import free, table, written

LEAST_SCORE = 0.3


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The documents' own columns of these names come through under others.
    own = {c: free(f"own_{c}", docs.columns) for c in docs.columns if c.lower() in ("lang_pred", "score")}
    found = language.identify(docs.withColumnsRenamed(own), language.fit(docs))
    kept = found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col(own[c]).alias(c) if c in own else F.col(c) for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = minhash.dedup(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("language", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]
# The language stage is a trained model, which SQL does not express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
