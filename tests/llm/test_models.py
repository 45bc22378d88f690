"""Classifiers: held-out accuracy on the given tables, their parts against plain versions, odd rows."""

from __future__ import annotations

import collections
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest

from millwatt.llm import language, quality, queries, toxicity
from millwatt.llm.letters import letters
from millwatt.llm.words import tokenise

from .conftest import DOCS, FOLDER, ODD

LARGER = "/root/testdata/sf0.01"
given = pytest.mark.skipif(not os.path.isdir(LARGER), reason="given tables are not here")
LABELS = "doc_id long, quality int, toxic int"


def area(score, truth):
    """Area under the curve, ties counted half."""
    good = [s for s, y in zip(score, truth, strict=True) if y]
    bad = [s for s, y in zip(score, truth, strict=True) if not y]
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def check(rows, remainder):
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % remainder[0] == remainder[1])
        assert 0 <= r.score <= 1


@given
@pytest.mark.parametrize(
    ("name", "target", "least"),
    # A fifth of the 18 held-out toxic labels there are on texts without any toxic word.
    [("op1_toxicity", "toxic", 0.85), ("op7_quality_classifier", "quality", 0.95)],
)
def test_held_out_labels(spark, read, name, target, least):
    rows = queries.QUERIES[name](spark, LARGER).collect()
    assert len(rows) == read("documents", LARGER).count()
    check(rows, (3, 1))
    label = {r.doc_id: r[target] for r in read("labels", LARGER).collect()}
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert area([r.score for r in held], [label[r.doc_id] for r in held]) >= least
    limit = 0.7 if target == "toxic" else 0.5
    assert all(r.predicted == (r.score >= limit) for r in rows)


@given
def test_held_out_languages(spark, read):
    rows = queries.op8_language(spark, LARGER).collect()
    check(rows, (4, 2))
    truth = {r.doc_id: r.lang for r in read("documents", LARGER).collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97


@given
def test_scores_agree_between_runs(spark):
    for name in ("op1_toxicity", "op7_quality_classifier", "op8_language"):
        runs = [sorted(map(tuple, queries.QUERIES[name](spark, FOLDER).collect())) for _ in range(2)]
        for a, b in zip(*runs, strict=True):
            assert a == pytest.approx(b, abs=1e-6) if isinstance(a, float) else str(a)[:30] == str(b)[:30]


def test_learning_ignores_held_out_rows(spark, docs):
    """Labels of held-out ids change nothing."""
    rows = [(i, f"good text number {i} with words" if i % 2 else f"BAD!! TEXT!! {i} ### ***") for i in range(60)]
    labels = [(i, i % 2, 1 - i % 2) for i in range(60)]
    flipped = [(i, q ^ 1, t ^ 1) if zlib.crc32(str(i).encode()) % 3 == 1 else (i, q, t) for i, q, t in labels]
    for module, kind in ((quality, dict), (toxicity, dict)):
        out = []
        for own in (labels, flipped):
            model = module.fit(docs(rows), spark.createDataFrame(own, LABELS))
            out.append(sorted((r.doc_id, round(r.score, 9)) for r in module.score(docs(rows), model).collect()))
        assert out[0] == out[1], kind


def test_quality_learns_what_separates(spark, docs):
    rows = [(i, f"good text number {i} with words" if i % 2 else f"BAD!! TEXT!! {i} ### ***") for i in range(200)]
    model = quality.fit(docs(rows), spark.createDataFrame([(i, i % 2, 0) for i in range(200)], LABELS))
    got = {r.doc_id: r.score for r in quality.score(docs(rows), model).collect()}
    assert all((got[i] >= 0.5) == bool(i % 2) for i in got)


def test_quality_features_are_unit_vectors_of_log_counts():
    (t,) = tokenise(pa.array(["a b a b", "", "One, TWO three3"]))
    text, column, value = quality.features(t)
    assert set(text) == {0, 2}
    assert np.bincount(text, value**2)[[0, 2]] == pytest.approx([1, 1])
    assert len(set(zip(text, column, strict=True))) == len(text)


def test_shapes_group_words_by_their_signs():
    (t,) = tokenise(pa.array(["the of THE A the!! was!!! x1 yyy22 | || é"]))
    s = quality.shapes(t)
    assert s[0] == s[1] and s[2] == s[3] and s[4] == s[5] and s[6] == s[7] and s[8] == s[9] and s[10] == s[0]
    assert len({s[0], s[2], s[4], s[6], s[8]}) == 5


def test_ftrl_fits_a_line():
    r = np.random.default_rng(1)
    model = quality.Ftrl(4, l1=0.0)
    for _ in range(3000):
        x = r.normal(size=4)
        model.learn(np.arange(4), x, int(x[0] - x[2] > 0))
    w = model.weights()
    assert w[0] > 1 and w[2] < -1 and abs(w[1]) < 0.5 * w[0]


def test_kernel_is_the_share_of_common_grams():
    texts = ["abc", "abd", "xyz", "a!b", ""]
    (block,) = letters(pa.array(texts))
    x = language.presence(block)

    def grams(t):
        t = "".join(c if c.isalpha() else " " for c in t)
        return {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1) if t[i : i + n].strip()}

    k = language.kernel(x, x)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            ga, gb = grams(a), grams(b)
            want = len(ga & gb) / np.sqrt(max(len(ga), 1) * max(len(gb), 1))
            assert k[i, j] == pytest.approx(want, abs=1e-6)


def test_language_learns_and_ignores_held_out_rows(spark, docs):
    sample = {"aa": "abra kadabra baba", "zz": "zyx wyzy xyzzy"}
    rows = [(i, f"{sample[lang]} {sample[lang][: i % 9]}", lang, "s", 0) for i in range(80) for lang in [("aa", "zz")[i % 2]]]
    wrong = [r if zlib.crc32(str(r[0]).encode()) % 4 != 2 else (r[0], r[1], "no", "s", 0) for r in rows]
    out = []
    for own in (rows, wrong):
        model = language.fit(docs(own))
        assert model.languages == ["aa", "zz"]
        found = language.identify(docs(rows), model).collect()
        assert all(r.lang_pred == r.lang for r in found)
        out.append(sorted((r.doc_id, r.score) for r in found))
    assert out[0] == out[1]


LM_TEXT = "you are an idiot and a clown . the idiot is worthless and stupid trash . a clown is a loser " * 50


@pytest.fixture(scope="module")
def chars():
    counts = np.zeros(toxicity.CLASSES**3)
    (block,) = letters(pa.array([LM_TEXT]))
    c = toxicity.classes(block.points, block.letter)
    np.add.at(counts, (c[:-2] * toxicity.CLASSES + c[1:-1]) * toxicity.CLASSES + c[2:], 1)
    return toxicity.char_model(counts)


@pytest.mark.parametrize(
    ("span", "word"),
    [("1d10t", "idiot"), ("i d i o t", "idiot"), ("i  d  i  o  t", "idiot"), ("i d 1 0 t", "idiot"), ("i.d.i.o.t", "idiot"), ("idiooooot", "idiot"), ("cl0wn", "clown"), ("l-o-s-e-r", "loser"), ("tr@sh", "trash"), ("$tup1d", "stupid"), ("st*pid", "stupid"), ("w0rthless", "worthless")],
)
def test_disguised_words_are_restored(chars, span, word):
    (block,) = letters(pa.array([f"you {span} and"]))
    assert [r for *_, r in toxicity.Reader(chars).restored(block)] == [word]


@pytest.mark.parametrize(
    ("span", "word"),
    [("1d107", "idiot"), ("p47h371c", "pathetic"), ("i..d..i..o..t", "idiot"), ("i--d--i--o--t", "idiot"), ("w__o__r__t__h__l__e__s__s", "worthless"), ("iiiiiidddddiiiiiiooooottttt", "idiot"), ("i   d   i   o   t", "idiot"), ("i" + " " * 40 + "d . - i\to _ t", "idiot"), ("1d1000007", "idiot"), ("w" * 9 + "0" * 9 + "r" * 9 + "7" * 9 + "h1355", "worthless")],
)
def test_heavily_disguised_words_are_restored(chars, span, word):
    (block,) = letters(pa.array([f"you {span} and"]))
    assert [r for *_, r in toxicity.Reader(chars).restored(block)] == [word]


def test_codes_stay_as_they_are(chars):
    codes = ["3f9a8b77", "x7k9q2z44", "550e8400e29b41d4a716446655440000", "q" + "7x94" * 2_000]
    (block,) = letters(pa.array([f"you {c} and" for c in codes]))
    assert len(list(toxicity.spans(block))) == len(codes)
    assert list(toxicity.Reader(chars).restored(block)) == []


def test_viterbi_finds_the_best_path(chars):
    """Against all paths of the lattice."""
    import itertools

    for span in ("1d10t", "cl0wn", "iid"):
        best = None
        for path in itertools.product(*toxicity.lattice(span)):
            text, value, x, y = "".join(s for s, _ in path), sum(c for _, c in path), 0, 0
            for c in text + " ":
                z = toxicity._class_of(c)
                value += chars[x, y, z]
                x, y = y, z
            best = max(best or (value, text), (value, text))
        assert toxicity.decode(span, chars) == best[1].strip()


def test_dropped_states_never_win(chars):
    """The decoder's best value against that over all states, on spans with many readings and deletions."""
    rng = np.random.default_rng(5)
    signs = [*toxicity.READINGS, *toxicity.NOISE, "i", "d", "o", "t"]
    for _ in range(60):
        span = "".join(rng.choice(signs, rng.integers(4, 24)))
        for model in (chars, chars / 8):  # the second hardly tells letters apart, so that most states stay
            assert toxicity.decoded(span, model, toxicity.reach(model)) == toxicity.decoded(span, model, np.inf)


def test_tables_of_digits_are_codes(chars):
    reader = toxicity.Reader(chars)
    table = ",".join("1735"[i % 4] for i in range(200_000))
    assert reader.read(table) == table and not reader.known
    assert reader.read("1d107") == "idiot"


def test_plain_text_has_no_spans(chars):
    (block,) = letters(pa.array(["The quick brown fox. It was 1999, e.g. a-b (see p. 12): 3 km; d'accord! A I", "cat", "dog"]))
    found = [("".join(map(chr, block.points[a:b])), r) for _, a, b, r in toxicity.Reader(chars).restored(block)]
    assert all(not any(c.isdigit() for c in s) for s, _ in found)


def test_restore_keeps_the_rest(spark, docs, chars):
    got = toxicity.restore(docs([(1, "You 1d10t, go!"), (2, None), (3, "plain")]), chars).collect()
    assert [tuple(r) for r in got] == [(1, "you idiot, go!", 1), (2, "", 0), (3, "plain", 0)]


def test_disguised_toxic_documents_score_high(spark, docs):
    r = np.random.default_rng(3)
    filler = ["the", "house", "garden", "walks", "today", "river", "stone", "music", "people", "and"]
    rows, labels = [], []
    for i in range(300):
        words = list(r.choice(filler, 30))
        if i % 3 == 0:
            for bad in r.choice(["idiot", "moron", "clown"], 2, replace=False):
                words.insert(int(r.integers(30)), bad)
        rows.append((i, " ".join(words) + f" n{i}x"))
        labels.append((i, 1, int(i % 3 == 0)))
    model = toxicity.fit(docs(rows), spark.createDataFrame(labels, LABELS))
    plain = " ".join(filler * 3)
    cases = [(1, f"{plain} 1d10t {plain} m0r0n"), (2, f"{plain} i d i o t and c.l.o.w.n"), (3, f"{plain} idiooot moroooon"), (4, plain), (5, f"{plain} stone")]
    got = {r.doc_id: r.score for r in toxicity.score(docs(cases), model).collect()}
    assert min(got[1], got[2], got[3]) >= 0.7 and max(got[4], got[5]) < 0.3


def test_models_take_odd_rows(spark, odd):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 1), (7, 0, 1), (None, 1, 1), (9, None, None), (99, 1, 1)], LABELS)
    ids = collections.Counter(str(r[0]) for r in ODD)
    for module in (quality, toxicity):
        got = module.score(odd, module.fit(odd, labels)).collect()
        assert collections.Counter(str(r.doc_id) for r in got) == ids and all(0 <= r.score <= 1 for r in got)
    got = language.identify(odd, language.fit(odd)).collect()
    assert collections.Counter(str(r.doc_id) for r in got) == ids
    assert {(r.doc_id, r.lang_pred, r.score) for r in got if r.doc_id in (1, 2, 3, 4)} == {(i, "und", 0.0) for i in (1, 2, 3, 4)}


def test_models_take_empty_tables(spark, odd):
    none, unlabelled = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    for module, value in ((quality, 0.5), (toxicity, 0.0)):
        assert module.score(none, module.fit(none, unlabelled)).collect() == []
        assert {r.score for r in module.score(odd, module.fit(odd, unlabelled)).collect()} == {value}
    assert language.identify(none, language.fit(none)).collect() == []
    assert {(r.lang_pred, r.score) for r in language.identify(odd, language.fit(none)).collect()} == {("und", 0.0)}


def test_a_sample_bounds_rows_not_ids(spark):
    """Many copies of one id, and many texts under one id, do not make the fit larger."""
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1][:6]
    labels = spark.createDataFrame([(i, k % 2, 0) for k, i in enumerate(ids)], LABELS)
    rows = [(ids[0], "the same text again", "en", "s", 1)] * 4000 + [(ids[1], f"text number {i}", "en", "s", 1) for i in range(900)]
    rows += [(i, f"a text of {i}", "en", "s", 1) for i in ids]
    docs = spark.createDataFrame(rows, DOCS)
    known = quality.labelled(docs, labels, "quality", 100, 7)
    assert known.count() == len(rows)
    assert quality.bounded(known, 10**6, 7).count() == 907  # a text of the second id is of its own
    assert quality.bounded(known, 200, 7).count() < 300
    assert len(quality.fit(docs, labels, sample=100)) == quality.SPACE + 1


def test_very_many_languages_have_a_bounded_model(spark):
    rows = [(i, f"Wort{i % 3000} noch ein Satz {chr(97 + i % 26) * 3}", f"l{i % 3000:04d}", "s", 1) for i in range(12_000)]
    rows += [(20_000 + i, "the usual words of one language", "en", "s", 1) for i in range(50)]
    copied = next(i for i in range(50_000, 50_020) if zlib.crc32(str(i).encode()) % 4 != 2)
    rows += [(copied, "one row many times", "l0000", "s", 1)] * 3000
    model = language.fit(spark.createDataFrame(rows, DOCS))
    assert len(model.landmarks) <= 128 and len(model.languages) <= 128 and "en" in model.languages

    few = [r for r in rows if r[2] in ("en", "l0000", "l0001")]
    assert language.fit(spark.createDataFrame(few, DOCS)).languages == ["en", "l0000", "l0001"]
