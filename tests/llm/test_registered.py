"""Registered queries against their SQL twins, and the pipeline as a whole."""

from __future__ import annotations

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from millwatt.llm import decontam, linededup, queries, urls
from tools.trial import canonical

from .conftest import DOCS, FOLDER, given


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@given
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_twin(spark, duck, name):
    df = queries.QUERIES[name](spark, FOLDER)
    got = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)
    cursor = duck.execute(queries.SQL[name])
    want = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description], dtype=object)
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_all_are_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "line_dedup", "near_dedup", "decontamination", "mixing"]


@given
def test_pipeline_stages_decide(spark, read):
    docs = read("documents").persist()
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, FOLDER).persist()
        if name != "mixing":
            assert after.columns == docs.columns
            assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
        if name == "language":
            assert after.count() == before.where("text rlike '[A-Za-zÀ-ÿ]'").count()  # prose in known languages stays
        if name == "line_dedup":
            assert linededup.removed(after).count() == 0 or after.count() < before.count() or linededup.removed(before).count() > 0
        if name == "decontamination":
            benchmark = read("benchmark")
            assert decontam.hits(after, benchmark).isEmpty()
            found = decontam.hits(before, benchmark).select("doc_id").distinct().count()
            assert after.count() == before.count() - found
        before = after
    assert before.columns == ["doc_id", "source", "size", "source_size", "target", "finish", "taken"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, before.collect()))


def test_pipeline_stages_take_odd_rows(spark, odd):
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for start in (plain, spark.createDataFrame([], DOCS)):
        docs = start
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
        docs.collect()


OWN = ["score", "lang_pred", "own_score", "kept", "removed_mask", "mask_id", "mask_digest", "leak_id", "leak_digest", "digest"]


def test_pipeline_stages_keep_own_columns(spark, odd):
    """Columns that operators use as names of their own come out of every filtering stage as they went in."""
    start = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for name in OWN:
        start = start.withColumn(name, F.concat(F.lit(f"{name}-"), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, start, FOLDER)
        assert after.columns == start.columns and after.dtypes == start.dtypes, name
        rows = after.collect()
        assert rows and all(r[c] == (None if r.doc_id is None else f"{c}-{r.doc_id}") for r in rows for c in OWN), name
    mixed = corpus_pipeline.STAGES[-1][1](spark, start, FOLDER)
    assert mixed.count() == start.count()


def sections(n):
    """Pages of a host with many sections, some bad, and of hosts with few pages each."""
    rng = random.Random(n)
    urls = [f"http://shop.net/{rng.choice(['es', 'fr', 'en', 'de'])}/p{rng.randrange(9)}" for _ in range(200)]
    urls += [f"http://wide.net/{'fr' if rng.random() < 0.2 else f's{rng.randrange(n)}'}/{rng.randrange(50)}/x{rng.randrange(4)}" for _ in range(700)]
    return urls + [f"http://h{rng.randrange(40)}.com/a{rng.randrange(3)}" for _ in range(695)]


@pytest.mark.parametrize("n", [5, 60, 300])
def test_url_twin_with_many_sections(spark, n):
    duckdb = pytest.importorskip("duckdb")
    pages = pd.DataFrame({"page_id": range(1595), "url": sections(n)})
    con = duckdb.connect()
    con.register("pages", pages)
    df = urls.judge(spark.createDataFrame(pages)).select("page_id", "host", "path", "rule", "verdict")
    got = sorted(map(tuple, df.collect()))
    cursor = con.execute(queries.SQL["op9_url_filter"])
    at = [[d[0] for d in cursor.description].index(c) for c in ("page_id", "host", "path", "rule", "verdict")]
    assert got == sorted(tuple(r[i] for i in at) for r in cursor.fetchall())
    # Sections without any labelled page are not drawn into the blocked ones.
    open_ = [v for _, host, path, _, v in got if host == "wide.net" and not path.startswith("/fr/")]
    assert open_.count("block") == 0
