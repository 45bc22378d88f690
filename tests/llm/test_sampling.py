"""Importance resampling, whitening and exact deduplication against plain versions, and their parts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from millwatt.llm import exactdedup, fuse, ngrams, queries, resampling, spectrum, whitening
from millwatt.session import work_folder

from .conftest import DOCS, FOLDER, given

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = [
    None, "", " ", "one", "One ONE one", "a-b_c 1,5 çÀé  x y 漢字 😀😀", "\x00\x7f{|}~ @[`", "w" * 70 + " " + "w" * 70 + " " + "w" * 69 + "v",
    " ".join(f"word{i % 50}" for i in range(400)), "eightlet eightlet ninelette sevenle tens eightlet",
]


def plain_grams(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(folded)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def spans(found):
    data = found.data.tobytes()
    return [(int(o) + found.first, data[s : s + n].decode()) for o, s, n in zip(found.owner, found.starts, found.lengths, strict=True)]


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_grams_are_those_of_a_plain_split(size):
    got, words = [], Counter()
    for found in ngrams.grams(pa.array(TEXTS), size):
        got += spans(found)
        for row, n in enumerate(found.words.tolist()):
            words[found.first + row] += n
    assert sorted(got) == sorted((i, g) for i, t in enumerate(TEXTS) for g in plain_grams(t))
    assert [words[i] for i in range(len(TEXTS))] == [(len(plain_grams(t)) + 1) // 2 for t in TEXTS]


def test_hashes_are_those_of_the_definition():
    rng = random.Random(4)
    words = ["x" * n for n in range(1, 40)] + ["".join(rng.choices("abcdefghij0189", k=rng.randrange(1, 60))) for _ in range(300)]
    for found in ngrams.grams(pa.array([" ".join(words)])):
        keys = ngrams.xxhash64(found.data, found.starts, found.lengths)
        assert [int(k) for k in keys] == [xxhash.xxh64_intdigest(g.encode()) for _, g in spans(found)]


@pytest.mark.parametrize("same_keys", [False, True])
def test_table_tells_spans_apart_by_their_bytes(same_keys):
    text = " ".join(random.Random(1).choices(["a", "b", "ab", "x" * 33, "x" * 34, "y" + "x" * 32, "eightlet", "eightlex"], k=300))
    for found in ngrams.grams(pa.array([text])):
        keys = np.zeros(len(found.starts), np.uint64) if same_keys else None  # all collide
        table = ngrams.Table(found, 97, keys)
        texts = [g for _, g in spans(found)]
        by_slot = {}
        for slot, g in zip(table.slot.tolist(), texts, strict=True):
            assert by_slot.setdefault(slot, g) == g
            assert table.bucket[slot] == zlib.crc32(g.encode()) % 97
        assert {g: int(table.count[s]) for s, g in by_slot.items()} == Counter(texts)
        assert len(table.used) == len(set(texts))


def plain_resample(docs, target, share=25, least=20, seed=7):
    s, t = Counter(), Counter()
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            counts.update(zlib.crc32(g.encode()) % 10_000 for g in plain_grams(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for doc_id, x in docs:
        grams = plain_grams(x)
        total = 0
        for g in grams:
            b = zlib.crc32(g.encode()) % 10_000
            total += math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
        weight = total // len(grams) if grams else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(grams), weight, score, (len(grams) + 1) // 2 >= least])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(able[: share * len(able) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=str)


def test_resampling_is_the_formula(spark, docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["alpha", "Beta", "gamma7", "δέλτα", "e"], k=rng.randrange(0, 60)))) for i in range(300)]
    rows += [(1000 + i, t) for i, t in enumerate(TEXTS)] + [(None, "null id " * 30)]
    target = ["alpha beta alpha", "gamma7", None, ""]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(docs(rows), frame)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_resample(rows, target)


def test_resampling_takes_odd_rows(spark, odd):
    frame = spark.createDataFrame([("some words of the target",)], "text string")
    got = resampling.resample(odd, frame, share=100).collect()
    assert len(got) == odd.count() and sorted(r.rank for r in got if r.rank) == list(range(1, 1 + sum(r.n_features >= 39 for r in got)))
    none = spark.createDataFrame([], DOCS)
    assert resampling.resample(none, none).count() == 0
    assert resampling.resample(odd, none).count() == odd.count()


def plain_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, float)) + 100_000
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    cov = centred.T @ centred / n
    values, found = np.linalg.eigh(cov)
    values, found = values[::-1][:k], found[:, ::-1][:, :k]
    return ((n * x - sums) ** 2).sum(1), centred @ found / np.sqrt(values), values / np.trace(cov)


VECTORS = "vec_id long, embedding array<float>, whitened string, component int"


@pytest.mark.parametrize(("n", "dims", "spread"), [(300, 12, 1.0), (60, 5, 0.01), (40, 3, 1e7)])
def test_whitening_is_that_of_a_dense_solver(spark, n, dims, spread):
    rng = np.random.default_rng(n)
    data = (rng.standard_normal((n, dims)) * np.linspace(1, 3, dims) * spread).astype(np.float32)
    bad = [(-1, None, "x", 1), (-2, [None] * dims, "x", 1), (-3, [float("nan")] * dims, "x", 1), (-4, [float("inf")] + [0.0] * (dims - 1), "x", 1), (-5, [], "x", 1)]
    rows = [(i, [float(v) for v in row], "x", 1) for i, row in enumerate(data)] + bad
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(3)).collect()
    deviation, z, share = plain_whitening(data)
    k = min(8, dims)
    assert len(got) == n * k and {r.component for r in got} == set(range(1, k + 1))
    table = np.zeros((n, k))
    for r in got:
        table[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and abs(r.explained / share[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-8
        if spread <= 1:
            assert r.deviation == int(deviation[r.vec_id])
    signs = np.sign((table * z).sum(0))
    assert np.abs(table * signs - z).max() < 1e-6


def test_whitening_of_odd_tables(spark):
    none = spark.createDataFrame([], VECTORS)
    assert whitening.whiten(none).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0], "x", 1) for i in range(4)] + [(None, [1.0, 2.0], "x", 1), (9, [1.0], "x", 1)], VECTORS)
    got = whitening.whiten(same).collect()
    assert len(got) == 10 and all(r.whitened is None and r.deviation == 0 and r.explained == 0 for r in got)
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], None, None) for i in range(6)], VECTORS)
    got = whitening.whiten(flat).collect()
    assert {r.component for r in got if r.whitened is not None} == {1} and got[0].identity_error < 1e-9
    wide = spark.createDataFrame([(0, [3.0e9, 0.0], None, None), (1, [-3.0e9, 1.0], None, None), (2, [0.0, 2.0], None, None)], VECTORS)
    assert {r.deviation for r in whitening.whiten(wide).collect() if r.vec_id < 2} == {None}


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_spectrum_counts_and_vectors(d):
    rng = np.random.default_rng(d)
    m = rng.standard_normal((d, d))
    a = m + m.T
    values = np.linalg.eigvalsh(a)[::-1]
    for shift in rng.uniform(values[-1] - 1, values[0] + 1, 20):
        assert spectrum.above(a, shift) == int((values > shift).sum())
    got, vectors = spectrum.leading(a, 8)
    assert np.allclose(got, values[:8]) and np.allclose(a @ vectors, vectors * got) and np.allclose(vectors.T @ vectors, np.eye(len(got)))


@pytest.mark.parametrize("values", [[3, 3, 3, 1, 1, 0], [1, 1, 1, 1], [5, 0, 0, 0], [0, 0], [2, 2 - 1e-13, 1]])
def test_spectrum_of_equal_eigenvalues(values):
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((len(values), len(values))))[0]
    a = q @ np.diag(np.array(values, float)) @ q.T
    got, vectors = spectrum.leading(a, 8)
    assert np.allclose(got, values, atol=1e-12) and np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-10)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 500, 5000])
def test_filters_hold_their_keys(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, n).astype(np.uint64)
    made = fuse.build(np.concatenate([keys, keys]))
    others = rng.integers(0, 1 << 63, 50_000).astype(np.uint64)
    assert fuse.contains(made, keys).all() and fuse.contains(made, others).mean() < 0.006
    assert len(made) < 128 + 1.7 * n  # small filters have two segments more


def plain_dedup(rows):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = {}
    for (doc_id, _), text in zip(rows, texts, strict=True):
        groups.setdefault(text, []).append(doc_id)
    out = []
    for (doc_id, _), text in zip(rows, texts, strict=True):
        ids = [i for i in groups[text] if i is not None]
        keep = min(ids) if ids else None
        out.append((doc_id, keep, len(groups[text]), doc_id == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


# With one byte of digest many different texts share one, so bytes have to tell them apart.
@pytest.mark.parametrize(("batches", "digest_bytes", "bucket_keys"), [(1, 32, 4096), (2, 32, 16), (3, 1, 8)])
def test_exact_dedup_is_that_of_a_dictionary(spark, docs, batches, digest_bytes, bucket_keys):
    rng = random.Random(batches)
    rows = [(i, rng.choice(["", " "]) + "  ".join(rng.choices("abc", k=rng.randrange(0, 6))) + rng.choice(["", "\n\t"])) for i in range(400)]
    rows += [(2000 + i, "the hot text") for i in range(200)] + [(None, "no id"), (None, "no id"), (None, "the hot text"), (7, None), (8, ""), (5000, "é b")]
    got = exactdedup.dedup(docs(rows), batches, digest_bytes, bucket_keys)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_dedup(rows)


def test_exact_dedup_takes_odd_rows(spark, odd):
    got = exactdedup.dedup(odd)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, got.collect()), key=str) == plain_dedup(rows)
    assert exactdedup.dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_a_batch_whose_snapshot_is_not_complete_is_taken_again(spark, docs):
    from millwatt.sources.files import delete_folder

    store = exactdedup.Snapshots(spark, work_folder(spark, "snapshots"))
    first, second = (exactdedup.written(exactdedup.digest(docs(rows)), "t") for rows in ([(1, "a"), (2, "b")], [(3, "a"), (4, "c"), (5, "c")]))
    assert store.add(first) == 0 and store.add(second) == 1
    delete_folder(spark, f"{store.root}/snapshot=1/filters")
    assert store.add(second) == 1
    got = store.judge(first.unionByName(second))
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got.collect()) == [(1, 1, 2), (2, 2, 1), (3, 1, 2), (4, 4, 2), (5, 4, 2)]


@given
def test_whitening_query_covers_its_table(spark, read):
    got = queries.op12_whitening(spark, FOLDER)
    assert got.count() == 8 * read("embeddings").count() and got.agg({"identity_error": "max"}).first()[0] < 1e-4
