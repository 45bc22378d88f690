"""Ordered operators against brute force, with chunks small enough that one hot key is cut."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millwatt.operators import ordered

SCHEMA = "device string, time timestamp, tie int, value int"
START = datetime(2024, 1, 1)


def readings(seed: int, count: int = 400, burst: bool = False) -> list[tuple]:
    """Readings of five devices; the first holds half of them."""
    rng = random.Random(seed)
    out = []
    for tie in range(count):
        device = "hot" if rng.random() < 0.5 else f"d{rng.randrange(4)}"
        # A burst puts most rows into a few seconds of a long range.
        spread = 20 if burst and rng.random() < 0.9 else 200_000
        out.append((device, START + timedelta(seconds=rng.randrange(spread)), tie, rng.choice([None, 1, 2, 3, -4])))
    return out


def by_device(rows: list[tuple]) -> dict[str, list[tuple]]:
    groups: dict[str, list[tuple]] = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


def result(df, name: str) -> dict[int, object]:
    return {r["tie"]: r[name] for r in df.collect()}


CASES = [(seed, burst, max_rows) for seed in (1, 2) for burst in (False, True) for max_rows in (7, 10_000)]


@pytest.fixture(params=CASES, ids=str)
def case(request, frame):
    seed, burst, max_rows = request.param
    rows = readings(seed, burst=burst)
    return rows, frame(rows, SCHEMA).repartition(3), max_rows


KEYS, ORDER = ["device"], ["time", "tie"]


def test_only_hot_keys_are_cut(frame):
    rows = readings(3)
    df = ordered.chunked(frame(rows, SCHEMA), KEYS, "time", max_rows=120)
    chunks = {r.device: r.n for r in df.groupBy("device").agg(F.countDistinct("_chunk").alias("n")).collect()}
    assert chunks.pop("hot") > 1
    assert set(chunks.values()) == {1}


def test_chunks_follow_the_order_and_stay_small(frame):
    rows = readings(4, burst=True)
    df = ordered.chunked(frame(rows, SCHEMA), KEYS, "time", max_rows=40)
    hot = sorted((r.time, r._chunk) for r in df.where("device = 'hot'").collect())
    numbers = [chunk for _, chunk in hot]
    assert numbers == sorted(numbers)
    assert len(set(numbers)) > 3


def test_previous(case):
    rows, df, max_rows = case
    got = result(ordered.previous(df, KEYS, ORDER, {"before": F.col("value")}, max_rows=max_rows), "before")
    for group in by_device(rows).values():
        for i, row in enumerate(group):
            assert got[row[2]] == (group[i - 1][3] if i else None)


def test_following(case):
    rows, df, max_rows = case
    got = result(ordered.following(df, KEYS, ORDER, {"after": F.col("tie")}, max_rows=max_rows), "after")
    for group in by_device(rows).values():
        for i, row in enumerate(group):
            assert got[row[2]] == (group[i + 1][2] if i + 1 < len(group) else None)


def test_running_sum_and_max(case):
    rows, df, max_rows = case
    sums = result(ordered.running_sum(df, KEYS, ORDER, {"total": F.col("value")}, max_rows=max_rows), "total")
    tops = result(ordered.running_max(df, KEYS, ORDER, {"top": F.col("value")}, max_rows=max_rows), "top")
    numbers = result(ordered.numbered(df, KEYS, ORDER, "number", max_rows=max_rows), "number")
    for group in by_device(rows).values():
        for i, row in enumerate(group):
            seen = [r[3] for r in group[: i + 1] if r[3] is not None]
            assert sums[row[2]] == (sum(seen) if seen else None)
            assert tops[row[2]] == (max(seen) if seen else None)
            assert numbers[row[2]] == i + 1


def test_last_known(case):
    rows, df, max_rows = case
    got = result(ordered.last_known(df, KEYS, ORDER, "known", F.col("value"), max_rows=max_rows), "known")
    for group in by_device(rows).values():
        known = None
        for row in group:
            known = row[3] if row[3] is not None else known
            assert got[row[2]] == known


@pytest.mark.parametrize("block_rows", [3, 10, 1000])
def test_trailing(frame, block_rows):
    rows = readings(5, 150)
    values = {"n": F.count("value"), "total": F.sum("value")}
    df = ordered.trailing(frame(rows, SCHEMA), KEYS, ORDER, 3, values, block_rows=block_rows, max_rows=20)
    got = {r.tie: (r.n, r.total) for r in df.collect()}
    assert len(got) == len(rows)
    for group in by_device(rows).values():
        for i, row in enumerate(group):
            seen = [r[3] for r in group[max(0, i - 3) : i] if r[3] is not None]
            assert got[row[2]] == (len(seen), sum(seen) if seen else None)


def test_chained_operators_share_chunks(frame):
    rows = readings(6)
    seen = ordered.previous(frame(rows, SCHEMA), KEYS, ORDER, {"before": F.col("tie")}, max_rows=9)
    got = result(ordered.running_sum(seen, KEYS, ORDER, {"total": F.col("before")}), "total")
    for group in by_device(rows).values():
        total = None
        for i, row in enumerate(group):
            if i:
                total = (total or 0) + group[i - 1][2]
            assert got[row[2]] == total


def test_whole_table_numbers_by_serial(frame):
    ids = random.Random(7).sample(range(10_000), 300)
    for max_rows in (40, 1000):
        got = ordered.numbered(frame([(i,) for i in ids], "id bigint"), [], ["id"], "n", max_rows=max_rows).collect()
        assert {r.id: r.n for r in got} == {value: place + 1 for place, value in enumerate(sorted(ids))}


@pytest.mark.parametrize("odd", ["outlier", "instant", "serial"])
def test_chunks_stay_small_whatever_the_clock(frame, odd):
    """A row far in the future, one instant for all, and ids far apart."""
    far = datetime(9999, 1, 1)
    rows = [("k", START + timedelta(seconds=i), i, 0) for i in range(5000)] + [("k", far, 9999, 0)]
    if odd == "instant":
        rows = [("k", START, i, 0) for i in range(5000)]
    if odd == "serial":
        rows = [("k", START, i**2 * 1000 % 2_000_000_011, 0) for i in range(5000)]
    keys = [] if odd == "serial" else KEYS
    df = ordered.chunked(frame(rows, SCHEMA), keys, ["tie"] if odd == "serial" else ORDER, max_rows=500)
    sizes = [r["count"] for r in df.groupBy("_chunk").count().collect()]
    assert max(sizes) <= 1000 and len(sizes) >= 6 and sum(sizes) == len(rows)


def test_latest_and_first_per_key(frame):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "n")]
    df = frame(rows, "k string, at int, v string")
    assert {r.k: r.v for r in ordered.latest_per_key(df, ["k"], ["at"]).collect()} == {"a": "y", "b": "n"}
    known = df.where("at is not null")
    assert {r.k: r.v for r in ordered.first_per_key(known, ["k"], ["at"]).collect()} == {"a": "x"}
