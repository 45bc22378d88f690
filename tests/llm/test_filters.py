"""Decontamination, URL filters, quality rules and mixing."""

from __future__ import annotations

import collections
import random
import re

import pytest

from millwatt.llm import decontam, mixing, queries, rules, urls

from .conftest import DOCS, FOLDER, ODD, WORD, given

TOKEN = re.compile(r"[^\W_]+")
BENCHMARK = "item_id long, text string"


def tokens(text):
    return TOKEN.findall((text or "").lower())


def brute_leaks(rows, items):
    """Every aligned window with few differing tokens around a place where some mask agrees."""
    out = collections.defaultdict(set)
    for i, text in rows:
        d = tokens(text)
        for item, passage in items:
            q = tokens(passage)
            size = min(decontam.WINDOW, len(q))
            allowed = decontam.SUBSTITUTED if len(q) >= decontam.WINDOW else len(q) * decontam.SUBSTITUTED // decontam.WINDOW
            for a in range(len(d)):
                for b in range(len(q) - decontam.SHORTEST + 1):
                    if not any(
                        a + m[-1] < len(d) and b + m[-1] < len(q) and all(d[a + k] == q[b + k] for k in m) for m in decontam.MASKS
                    ):
                        continue
                    for s in range(max(b + decontam.SHORTEST - size, 0), min(b, len(q) - size) + 1):
                        same = sum(0 <= a - b + s + k < len(d) and d[a - b + s + k] == q[s + k] for k in range(size))
                        if same >= size - allowed:
                            out[i].add(item)
    return out


def leaky(seed):
    r = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(60)]
    items = [(k, " ".join(r.choices(vocabulary, k=n))) for k, n in enumerate((6, 8, 9, 12, 13, 15, 30, 45))]
    rows = []
    for i in range(40):
        passage = tokens(r.choice(items)[1])
        for _ in range(r.randrange(5)):
            passage[r.randrange(len(passage))] = "zz"
        cut = r.randrange(len(passage)) if r.random() < 0.3 else 0
        around = [r.choices(vocabulary, k=r.randrange(12)) for _ in range(2)]
        rows.append((i, ", ".join(around[0] + passage[cut:] + around[1]).upper()))
    return rows, items


@pytest.mark.parametrize("seed", range(3))
def test_leaks_match_brute_force(spark, docs, seed):
    rows, items = leaky(seed)
    found = decontam.decontaminate(docs(rows), spark.createDataFrame(items, BENCHMARK)).collect()
    want = brute_leaks(rows, items)
    assert {r.doc_id: set(r["items"]) for r in found} == {i: want[i] for i, _ in rows}
    assert all(r.contaminated == bool(want[r.doc_id]) == (r.n_items > 0) for r in found)
    kept = decontam.clean(docs(rows), spark.createDataFrame(items, BENCHMARK))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in rows if not want[i])


def test_leaks_match_without_broadcasts(spark, docs, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", -1)
    rows, items = leaky(11)
    found = decontam.decontaminate(docs(rows), spark.createDataFrame(items, BENCHMARK)).collect()
    want = brute_leaks(rows, items)
    assert {r.doc_id: set(r["items"]) for r in found} == {i: want[i] for i, _ in rows}


def test_two_replaced_tokens_in_a_window_are_still_found(spark, docs):
    passage = [f"p{i}" for i in range(13)]
    rows = []
    for a in range(13):
        for b in range(a):
            text = list(passage)
            text[a] = text[b] = "other"
            rows.append((100 * a + b, " ".join(text)))
    items = [(1, " ".join(passage))]
    want = brute_leaks(rows, items)
    assert len(want) > 0.8 * len(rows)
    found = decontam.decontaminate(docs(rows), spark.createDataFrame(items, BENCHMARK)).where("contaminated").collect()
    assert {r.doc_id for r in found} == set(want)


def test_masks_leave_no_replacement_uncovered():
    """Every allowed set of differing tokens of every length leaves some mask untouched."""
    import itertools

    for length in range(decontam.SHORTEST, decontam.WINDOW + 1):
        allowed = length * decontam.SUBSTITUTED // decontam.WINDOW
        for differing in itertools.combinations(range(length), allowed):
            assert any(
                all(at + k not in differing for k in m) for m in decontam.MASKS for at in range(length - m[-1])
            ), (length, differing)


def plain_leaks(rows, items):
    """Every laying side by side of a window with few differing tokens; no masks."""
    out = collections.defaultdict(set)
    for i, text in rows:
        d = tokens(text)
        for item, passage in items:
            q = tokens(passage)
            size = min(decontam.WINDOW, len(q))
            allowed = size * decontam.SUBSTITUTED // decontam.WINDOW
            for at in range(-allowed, len(d) - size + allowed + 1):
                for s in range(len(q) - size + 1):
                    if sum(not (0 <= at + k < len(d) and d[at + k] == q[s + k]) for k in range(size)) <= allowed:
                        out[i].add(item)
    return out


@pytest.mark.parametrize("length", [5, 6, 7, 8, 9, 12, 13, 14, 15])
def test_every_allowed_replacement_is_found(spark, docs, length):
    import itertools

    passage = [f"p{i}" for i in range(length)]
    rows = []
    for n, places in enumerate(p for k in range(4) for p in itertools.combinations(range(length), k)):
        text = list(passage)
        for at in places:
            text[at] = "other"
        rows.append((n, " ".join(["before", *text, "after"])))
    items = [(1, " ".join(passage))]
    found = decontam.decontaminate(docs(rows), spark.createDataFrame(items, BENCHMARK)).where("contaminated").collect()
    assert {r.doc_id for r in found} == set(plain_leaks(rows, items))


@pytest.mark.parametrize("seed", range(2))
def test_leaks_match_plain_brute_force(spark, docs, seed):
    rows, items = leaky(20 + seed)
    found = decontam.decontaminate(docs(rows), spark.createDataFrame(items, BENCHMARK)).collect()
    want = plain_leaks(rows, items)
    assert {r.doc_id: set(r["items"]) for r in found} == {i: want[i] for i, _ in rows}


@given
def test_leaks_of_the_given_table(spark, read):
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    pieces = {tuple(tokens(t)[k : k + 13]) for _, t in items for k in range(len(tokens(t)) - 12)}
    rows = [(r.doc_id, tokens(r.text)) for r in read("documents").collect()]
    exact = {i for i, w in rows if any(tuple(w[k : k + 13]) in pieces for k in range(len(w) - 12))}
    got = {r.doc_id for r in queries.op5_decontamination(spark, FOLDER).where("contaminated").collect()}
    assert exact and exact <= got and len(got) <= 1.5 * len(exact) + 2


def test_leaks_of_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, None), (2, ""), (None, "one two three four five six seven eight nine ten")], BENCHMARK)
    found = decontam.decontaminate(odd, items).collect()
    assert len(found) == len(ODD)
    assert [(r.doc_id, r.n_items) for r in found if r.contaminated] == [(5, 1)] * 2
    assert decontam.clean(odd, items).count() == len(ODD) - 2
    none = spark.createDataFrame([], BENCHMARK)
    assert decontam.clean(odd, none).count() == len(ODD)
    assert decontam.decontaminate(spark.createDataFrame([], DOCS), items).collect() == []


def test_urls_are_split_and_ruled(spark):
    cases = {
        "http://A.Example.COM/en/x?q=/de/": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "https://www.example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://www.example.com/de/1#a": ("www.example.com", "/de/1", "com/", "allow"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "ftp://a.b.net/fr/": ("a.b.net", "/fr/", "net/fr/", "block"),
        "ftp://a.b.net/fr": ("a.b.net", "/fr", None, None),
        "x://com/": ("com", "/", "com/", "allow"),
        "x://com": ("com", "", None, None),
        "x://net?a=/es/": ("net", "", None, None),
        "nothing": ("", "", None, None),
        "a://b://c.net/es/": ("b:", "//c.net/es/", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string").selectExpr("*", "1 as host", "2 as verdict", "3 as rule")
    got = {r.page_id: r for r in urls.judge(rows).collect()}
    assert len(got) == len(cases)
    for k, (host, path, rule, verdict) in enumerate(cases.values()):
        assert (got[k].host, got[k].path, got[k]["rule"]) == (host, path, rule)
        assert got[k].verdict == verdict if verdict else got[k].verdict in ("allow", "block")
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_templates_follow_labelled_purity(spark):
    rows = [(f"h.net/es/{k}", "block") for k in range(40)] + [(f"h.net/good/{k}.html", "allow") for k in range(40)]
    pages = spark.createDataFrame([(i, f"http://{u}") for i, (u, _) in enumerate(rows)] + [(1000, "http://h.net/es/999"), (1001, "http://h.net/good/7.html")], "page_id long, url string")
    own = (("block", "h.net/es/1"), ("allow", "h.net/good/1"), ("block", "h.net/es/2"), ("allow", "h.net/good/2"))
    got = {r.page_id: r for r in urls.judge(pages, own).collect()}
    assert got[1000]["rule"] is None and got[1000].verdict == "block" and got[1000].template == "/es/*"
    assert got[1001]["rule"] is None and got[1001].verdict == "allow"


def test_a_node_with_many_children_becomes_a_wildcard(spark):
    pages = spark.createDataFrame([(i, f"http://h.org/user/name-{chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(120)], "page_id long, url string")
    assert {r.template for r in urls.judge(pages).collect()} == {"/user/*"}


@pytest.mark.parametrize("pages_each", [1, 3, 20])
def test_named_sections_stay_apart_among_many(spark, pages_each):
    """The verdict on a section does not depend on whether it has 49 siblings or 50."""
    names = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(60)]
    for n in (48, 49, 80 - 21):
        sections = ["es", "fr", *[x for x in names if x not in ("es", "fr")][:n]]
        paths = [f"http://h.net/{s}/{k}" for s in sections for k in range(pages_each)]
        paths += [f"http://h.com/{s}/{k}" for s in ("x", "y") for k in range(40 * pages_each)]
        pages = spark.createDataFrame(list(enumerate(paths)), "page_id long, url string")
        got = {(r.host, r.path.split("/")[1]): r.verdict for r in urls.judge(pages).collect()}
        assert {s for h, s in got if got[h, s] == "block"} == {"es", "fr"}


def brute_rules(text):
    w = WORD.findall(text or "")
    count = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = set()
    for k in range(len(w) - 4):
        if count[tuple(w[k : k + 5])] > 1:
            covered.update(range(k, k + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def check_rules(found, rows):
    want = sorted((str(i), *brute_rules(t)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == want
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)


@given
def test_rules_of_the_given_table(spark, read):
    found = queries.op10_quality_rules(spark, FOLDER).collect()
    check_rules(found, [(r.doc_id, r.text) for r in read("documents").collect()])
    label = {r.doc_id: r.quality for r in read("labels").collect()}
    good = [r.kept for r in found if label.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in found if label.get(r.doc_id) == 0 and not r.base_failed]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.5 * max(len(bad), 1)


def test_ratios_match_counts(spark, docs):
    """The score is the mean log ratio of the smoothed multinomials, counted here again."""
    import math

    rows = [(1, "a b c a b"), (2, "x y z"), (3, "a b x")]
    trusted = spark.createDataFrame([(1,), (None,)], "doc_id long")
    buckets = {r.bucket: r.ratio for r in rules.ratios(docs(rows), trusted).collect()}
    grams = lambda t: t.split() + [" ".join(p) for p in zip(t.split(), t.split()[1:], strict=False)]
    raw = collections.Counter(g for _, t in rows for g in grams(t))
    seen = collections.Counter(grams(rows[0][1]))
    total, good, prior = sum(raw.values()), sum(seen.values()), 2.0 * rules.BUCKETS
    ratio = {g: math.log((seen[g] * total / raw[g] + prior) / (good + prior)) for g in raw}
    assert sorted(round(v, 9) for v in buckets.values()) == sorted(round(v, 9) for v in ratio.values())
    got = {r.doc_id: r.score for r in rules.judge(docs(rows), trusted).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(sum(ratio[g] for g in grams(t)) / len(grams(t)), abs=1e-8)


def test_all_trusted_documents_count(spark, docs):
    """More trusted ids than were once sampled; every one of them adds to the ratios."""
    rows = [(i, f"w{i % 500} v") for i in range(21_000)] + [(None, "rare words")] * 3
    trusted = spark.range(21_000).withColumnRenamed("id", "doc_id")
    got = rules.ratios(spark.createDataFrame(rows, "doc_id long, text string"), trusted).collect()
    grams, total, prior = 3 * 21_000, 3 * 21_000 + 9, 2.0 * rules.BUCKETS
    import math

    least = math.log((42 * total / 42 + prior) / (grams + prior))
    assert sum(round(r.ratio, 9) >= round(least, 9) for r in got) >= len(got) - 3


def test_rules_of_odd_rows(spark, odd):
    trusted = spark.createDataFrame([(5,), (None,)], "doc_id long")
    check_rules(rules.judge(odd, trusted).collect(), [(r[0], r[1]) for r in ODD])
    assert rules.judge(spark.createDataFrame([], DOCS), trusted).collect() == []
    assert rules.judge(odd, spark.createDataFrame([], "doc_id long")).count() == len(ODD)


def fill(sizes, weights, budget):
    """Share a budget by weight under caps, one round of capping after the other."""
    free, target = set(sizes), {}
    while free:
        level = budget / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weights[s] for s in free}
        for s in over:
            target[s] = 2 * sizes[s]
            budget -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_mix_meets_its_targets(docs, seed):
    r = random.Random(seed)
    names = ["a", "B", "ä", "z", None, ""]
    rows = [(i, "w " * r.randrange(40) * r.choice((1, 1, 20)), "en", r.choice(names[: 2 + seed]), 0) for i in range(120)]
    got = mixing.mix(docs(rows)).collect()
    sizes = collections.Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(WORD.findall(text))
    order = sorted((s for s in sizes if s is not None), key=str) + [None] * (None in sizes)
    target = fill(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    taken = collections.Counter()
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(target[x.source])
        assert 0 <= x.taken <= 2 * x.size
        taken[x.source] += x.taken
    assert len(got) == len(rows)
    assert all(taken[s] == int(target[s] + 1e-9) for s in sizes)
    assert [x.finish for x in got] == sorted(x.finish for x in got)
    assert sorted(map(tuple, mixing.mix(docs(rows[::-1])).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_a_part_of_the_mix_keeps_the_proportions(docs):
    rows = [(i, "w " * (1 + i % 7), "en", "ab"[i % 2], 0) for i in range(200)]
    taken, target = collections.Counter(), {}
    for x in mixing.mix(docs(rows), fraction=0.25).collect():
        taken[x.source] += x.taken
        target[x.source] = x.target
    assert all(taken[s] == int(target[s] * 0.25) for s in target)


def test_mix_of_odd_rows(spark, odd):
    got = mixing.mix(odd).collect()
    assert len(got) == len(ODD)
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []
