"""Near copies, repeated passages and lines against brute force."""

from __future__ import annotations

import collections
import hashlib
import random

import pytest

import corpus_pipeline
from millwatt.llm import linededup, minhash, queries, substring
from millwatt.llm.components import components

from .conftest import DOCS, FOLDER, ODD, WORD, given

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingles(text))
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = find(a), find(b)
                label[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in sets}


def families(seed=5, bases=8, copies=12):
    """Texts with near copies at various distances, some that only share a passage, and short ones."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = r.choices(vocabulary, k=40)
    rows = []
    for _ in range(bases):
        base = r.choices(vocabulary, k=60)
        for c in range(copies):
            text = list(base)
            for _ in range(c // 3):
                text[r.randrange(len(text))] = r.choice(vocabulary)
            rows.append(" ".join(text))
        rows.append(" ".join(passage + r.choices(vocabulary, k=20)))
        rows.append(" ".join(base[: r.randrange(1, 8)]))
    r.shuffle(rows)
    return list(enumerate(rows))


def test_near_copies_match_brute_force(docs):
    rows = families()
    got = {r.doc_id: r for r in minhash.dedup(docs(rows)).collect()}
    want = brute_components(rows)
    assert {i: got[i].component_id for i in want} == want
    assert all(got[i].kept == (want[i] == i) and got[i].n_shingles == len(shingles(t)) for i, t in rows)


def test_blocks_smaller_than_a_bucket_find_the_same(docs, monkeypatch):
    # Without comparing leaders first, all links come from the blocks.
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rows = families(7, bases=3, copies=20)
    want = brute_components(rows)
    got = {r.doc_id: r.component_id for r in minhash.dedup(docs(rows)).collect()}
    assert got == want


@given
def test_near_copies_of_the_given_table(spark, read):
    rows = [(r.doc_id, r.text) for r in read("documents").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op2_minhash(spark, FOLDER).collect()}
    want = brute_components(rows)
    assert got == {i: (len(shingles(t)), want[i]) for i, t in rows}


def test_near_copies_of_odd_rows(odd, spark):
    got = minhash.dedup(odd).collect()
    assert len(got) == len(ODD)
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert by_id[1] == [(0, 1, True)] and by_id[2] == [(0, 2, True)] and by_id[3] == [(0, 3, True)]
    assert by_id[5] == [(6, 5, True)] * 2
    assert sorted(by_id[None]) == [(0, None, True), (10, None, True)]
    assert minhash.dedup(spark.createDataFrame([], DOCS)).collect() == []


def test_one_id_with_two_texts_connects_both(docs):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    got = {(r.doc_id, r.component_id) for r in minhash.dedup(docs([(1, a), (2, a), (2, b), (3, b)])).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}


@pytest.mark.parametrize("seed", range(3))
def test_components_match_a_walk(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    near = collections.defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    want = {}
    for i in sorted(near):
        if i not in want and near[i] != {i}:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = i
                    todo += near[x]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want


def brute_substring(rows, window=35):
    count = collections.Counter()
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for _, w in split:
        count.update(tuple(w[k : k + window]) for k in range(len(w) - window + 1))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    r = random.Random(seed)
    pool = [[f"v{r.randrange(30)}" for _ in range(r.choice((34, 35, 36, 50, 90)))] for _ in range(6)]
    rows = []
    for i in range(40):
        text = []
        for _ in range(r.randrange(4)):
            text += [f"v{r.randrange(300)}" for _ in range(r.randrange(30))]
            part = r.choice(pool)
            cut = r.randrange(3) * r.randrange(len(part))
            text += part[cut:] if r.random() < 0.7 else part[: len(part) - cut]
        rows.append((i, " ".join(text)))
    rows += [(100, "x " * 80), (101, "x y " * 60), (102, rows[3][1]), (103, rows[3][1] + " tail")]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_passages_match_brute_force(docs, seed):
    rows = passages(seed)
    got = substring.dedup(docs(rows)).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute_substring(rows)


@given
def test_passages_of_the_given_table(spark, read):
    rows = [(r.doc_id, r.text) for r in read("documents").collect()]
    got = queries.op6_substring_dedup(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(brute_substring(rows))


def test_passages_of_odd_rows(odd, spark):
    got = substring.dedup(odd).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute_substring([(r[0], r[1]) for r in ODD])
    assert substring.dedup(spark.createDataFrame([], DOCS)).collect() == []


def brute_lines(rows):
    first, where = {}, []
    for i, text in sorted({(i, t or "") for i, t in rows}):
        for k, line in enumerate(text.split("\n")):
            w = tuple(WORD.findall(line))
            if len(w) >= linededup.MIN_WORDS:
                first.setdefault(w, (i, k))
                where.append((i, k, w))
    long = [w for w in first if len(w) >= linededup.FUZZY_WORDS]

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
        if len(a) < len(b):
            a, b = b, a
        return len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a)))

    least = dict(first)
    for a in long:
        for b in long:
            if near(a, b):
                least[a] = min(least[a], first[b])
    return {(i, k) for i, k, w in where if (i, k) > least[w]}


def edited(seed):
    r = random.Random(seed)
    vocabulary = [f"u{i}" for i in range(40)]
    bases = [r.choices(vocabulary, k=n) for n in (2, 3, 5, 7, 8, 9, 12, 16, 17, 24, 40)]
    rows = []
    for i in range(30):
        lines = []
        for _ in range(r.randrange(1, 7)):
            w = list(r.choice(bases))
            for _ in range(r.randrange(3)):
                k = r.randrange(len(w) + 1)
                kind = r.randrange(3)
                if kind == 0 and k < len(w):
                    w[k] = r.choice(vocabulary)
                elif kind == 1:
                    w.insert(k, r.choice(vocabulary))
                elif k < len(w):
                    del w[k]
            lines.append(r.choice((" ", "  ", "\t")).join(w) + r.choice(("", " ", "\r")))
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_lines_match_brute_force(docs, seed):
    rows = edited(seed)
    got = linededup.removed(docs(rows)).collect()
    assert sorted((r.doc_id, r.line_no) for r in got) == sorted(brute_lines(rows))


def test_short_lines_are_copies_too(docs):
    rows = [(1, "Les.\n\nAnd ornd.\nonly here"), (2, " Les. \n\nand ornd.\nAnd\tornd."), (3, "Les.\nLes.\n \n")]
    got = linededup.removed(docs(rows)).collect()
    assert sorted((r.doc_id, r.line_no) for r in got) == [(2, 0), (2, 3), (3, 0), (3, 1)]
    assert {r.doc_id: r.text for r in linededup.dedup(docs(rows)).collect()} == {1: rows[0][1], 2: "\nand ornd."}


def test_lines_match_without_broadcasts(docs, monkeypatch):
    monkeypatch.setattr(linededup, "BROADCAST_ROWS", -1)
    rows = edited(8)
    got = linededup.removed(docs(rows)).collect()
    assert sorted((r.doc_id, r.line_no) for r in got) == sorted(brute_lines(rows))


def test_kept_lines_are_untouched(docs):
    rows = edited(4) + [(50, "\n".join(f"line number {k} of a text of many lines, all different k{k}" for k in range(200)) + "\nu1  u2")]
    rows += [(51, rows[-1][1] + "\nlast  words\there stay as they are in this line")]
    gone = brute_lines(rows)
    got = {r.doc_id: r.text for r in linededup.dedup(docs(rows)).collect()}
    for i, text in rows:
        kept = "\n".join(x for k, x in enumerate(text.split("\n")) if (i, k) not in gone)
        whole = not any(a == i for a, _ in gone)
        assert got.get(i) == (kept if whole or WORD.search(kept) else None)


def test_lines_of_odd_rows(odd, spark):
    out = linededup.dedup(odd)
    assert out.columns == odd.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r[0]) for r in ODD)  # no line repeats across ids
    report = {(r.doc_id, r.n_lines, r.n_removed, r.removed) for r in linededup.report(odd).collect()}
    assert {(1, 0, 0, ""), (2, 0, 0, ""), (3, 2, 0, "")} <= report
    assert linededup.dedup(spark.createDataFrame([], DOCS)).collect() == []
    assert linededup.report(spark.createDataFrame([], DOCS)).collect() == []


def test_stage_keeps_one_of_each_group(docs, spark):
    rows = families(9, bases=3)
    want = brute_components(rows)
    got = corpus_pipeline.drop_near_copies(spark, docs(rows), "").collect()
    assert sorted(r.doc_id for r in got) == sorted({want[i] for i in want})
