"""Quality rules: text statistics, and a log-likelihood ratio of hashed word n-grams.

Two multinomials over hashed word unigrams and bigrams are counted: one over every document (the raw corpus),
one over trusted documents. A document scores the mean of ``log(p_trusted / p_raw)`` over its n-grams; below a
fixed threshold it is refused. The trusted estimate is shrunk towards the raw one, so a bucket the trusted
documents never saw costs more the more text they had.

Native DataFrame functions only. Texts are shuffled once, to meet the trusted ids. Counts are merged in each task before they are shuffled. The model, a number for each
bucket, is a constant of the scoring plan, which therefore is a map over the documents without join or shuffle.

Defined results: a null or empty text has 0 words, no n-grams, score 0 and fails the base rules; a null id is a
document like any other; equal rows come out as they went in; an empty table gives no rows; other columns
of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import written
from .words import BLANK_CHARS, words

BUCKETS = 1 << 16
UNIT = 1_000_000_000  # ratios are kept as whole billionths
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def _hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _pairs(hashes: Column) -> Column:
    """A hash of every two neighbouring words."""
    return F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))), lambda h, i: F.xxhash64(h, F.get(hashes, i + 1))
    )


def _bucket(gram: Column) -> Column:
    return F.pmod(gram, F.lit(BUCKETS)).cast("int")


def ratios(docs: DataFrame, trusted: DataFrame, shrink: float = 2.0) -> DataFrame:
    """``bucket, ratio`` for every bucket that occurs: at most ``BUCKETS`` rows.

    ``trusted`` has a ``doc_id`` column. Both models count all of their documents: texts meet the trusted ids by a
    shuffle, whatever their number.
    """
    kind = docs.schema["doc_id"].dataType
    ids = trusted.select(F.col("doc_id").cast(kind).alias("trusted_id")).dropna().distinct()
    # Rows without an id are spread by their text.
    spread = F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    same = (spread == F.xxhash64("trusted_id")) & (F.col("doc_id") == F.col("trusted_id"))
    marked = docs.select("doc_id", "text").join(ids.hint("shuffle_hash"), same, "left")
    is_trusted = F.col("trusted_id").isNotNull().cast("long")
    hashed = marked.select(_hashes(F.col("text")).alias("hashes"), is_trusted.alias("t"))
    counts = (
        hashed.withColumn("pairs", _pairs(F.col("hashes"))).select(F.explode(F.concat("hashes", "pairs")).alias("gram"), "t")
        .groupBy(_bucket(F.col("gram")).alias("bucket"))
        .agg(F.sum("t").alias("seen"), F.count("*").alias("raw"))
    )
    counts = written(counts, "rules-counts")  # used twice; at most BUCKETS rows
    totals = counts.agg(F.sum("seen").alias("all_seen"), F.sum("raw").alias("all_raw"))
    prior = shrink * BUCKETS
    return counts.crossJoin(F.broadcast(totals)).select(  # totals is one row
        "bucket",
        F.log(
            (F.col("seen") * F.col("all_raw") / F.col("raw") + F.lit(prior)) / (F.col("all_seen") + F.lit(prior))
        ).alias("ratio"),
    )


def _windows(hashes: Column, pairs: Column) -> Column:
    """A hash of every ``WINDOW`` consecutive words, from two pairs and the last word."""
    return F.transform(
        F.slice(pairs, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
        lambda p, i: F.xxhash64(p, F.get(pairs, i + 2), F.get(hashes, i + 4)),
    )


def _bytes(text: Column, c: str) -> Column:
    """How often a character of one byte occurs."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id``, the hashes of words and ``pairs``, and the base statistics of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    n_blanks = sum((_bytes(F.col("text"), c) for c in BLANK_CHARS[1:]), _bytes(F.col("text"), BLANK_CHARS[0]))
    first = docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        _hashes(F.col("text")).alias("hashes"),
        (F.length("text") - n_blanks).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    second = first.select(
        "doc_id",
        "hashes",
        F.size("hashes").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _pairs(F.col("hashes")).alias("pairs"),
    ).withColumn("windows", _windows(F.col("hashes"), F.col("pairs")))
    order = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    third = second.withColumn("order", order).drop("windows")
    same = lambda s, k: F.get(F.col("order"), k)["h"] == s["h"]
    twice = F.filter(
        "order",
        lambda s, k: F.coalesce((k > 0) & same(s, F.greatest(k - 1, F.lit(0))), F.lit(False))
        | F.coalesce(same(s, k + 1), F.lit(False)),
    )
    fourth = third.withColumn("places", F.array_sort(F.transform(twice, lambda s: s["i"]))).drop("order")
    # A repeated window covers its words up to where the next one starts.
    covered = F.aggregate(
        F.transform(
            "places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("places"), k + 1) - p, F.lit(WINDOW)))
        ),
        F.lit(0),
        lambda a, x: a + x,
    )
    return fourth.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("places")


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = -0.1) -> DataFrame:
    """The base statistics, ``base_failed``, ``kept`` and ``score`` of every document."""
    ratio = [0] * BUCKETS
    for r in ratios(docs, trusted).collect():  # at most BUCKETS rows
        ratio[r.bucket] = round(r.ratio * UNIT)
    # One constant array; whole units, so that sums do not depend on their order.
    table = F.split(F.lit(",".join(map(str, ratio))), ",").cast("array<long>")
    total = F.lit(0)
    for grams in ("hashes", "pairs"):
        total = total + F.aggregate(grams, F.lit(0).cast("long"), lambda a, g: a + F.get(table, _bucket(g)))
    count = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    score = total / count / F.lit(float(UNIT))
    judged = measure(docs).select("doc_id", *BASE, failed.alias("base_failed"), score.alias("score"))
    return judged.select(
        "doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.col("score") >= F.lit(threshold))).alias("kept"), "score"
    )
