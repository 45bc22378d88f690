from __future__ import annotations

import os
import re

import pytest

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, len(text or ""))


@pytest.fixture
def docs(spark):
    return lambda rows: spark.createDataFrame([r if isinstance(r, tuple) and len(r) == 5 else doc(*r) for r in rows], DOCS)


@pytest.fixture
def read(spark):
    return lambda name, folder=FOLDER: spark.read.parquet(f"{folder}/{name}.parquet")


# Rows every operator must take: nulls, no words, blanks only, signs only, repeated rows, null ids, odd blanks, a long text.
ODD = [
    (1, None, None, None, None),
    (2, "", None, None, 0),
    (3, " \t\n\x0b\x0c\r ", "en", "s", 8),
    (4, "#*$%&|<>", "en", "s", 8),
    (5, "one two three four five six seven eight nine ten", "en", "s", None),
    (5, "one two three four five six seven eight nine ten", "en", "s", None),
    (None, "a row without an id but with some words of its own in it", "en", None, 1),
    (None, None, None, None, None),
    (6, "w" * 30_000, "en", "s", 30_000),
    (7, " ".join(f"word{i % 977}" for i in range(30_000)), "en", "t", 1),
    (8, "çé ß 漢字 😀 \u00a0 \u2003 x", "fr", "s", 1),
    (9, "same same same same same same same same same same same same", "en", "s", 1),
]
# Names that operators give to columns of their own.
CLASHING = ["score", "kept", "digest", "size", "target", "bands", "values", "component_id", "lang_pred", "copy", "line", "n", "packed", "hashes", "mask", "blocks", "rep", "first", "at"]


@pytest.fixture
def odd(spark):
    df = spark.createDataFrame(ODD, DOCS)
    for name in CLASHING:
        df = df.selectExpr("*", f"'x' as {name}")
    return df
