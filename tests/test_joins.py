from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows as table
from pyspark.sql import functions as F

from millwatt.operators import joins

START = datetime(2024, 1, 1)


def at(minutes: float) -> datetime:
    return START + timedelta(minutes=minutes)


@pytest.mark.parametrize("max_rows", [6, 10_000])
def test_as_of_matches_brute_force(frame, max_rows):
    rng = random.Random(max_rows)
    left = [(rng.choice("aaaab"), at(rng.randrange(200)), i) for i in range(120)]
    right = [(rng.choice("aaabc"), at(rng.randrange(200)), i) for i in range(80)]
    found = joins.as_of(
        frame(left, "k string, t timestamp, l int"),
        frame(right, "k string, u timestamp, r int"),
        ["k"], "t", "u", "r", max_rows=max_rows,
    )
    got = {row.l: row.matched.r if row.matched else None for row in found.collect()}
    for key, time, number in left:
        known = [(u, r) for k, u, r in right if k == key and u <= time]
        assert got[number] == (max(known)[1] if known else None)
    assert len(got) == len(left)


def test_as_of_ignores_null_keys(frame):
    left = frame([(None, at(5), 1)], "k string, t timestamp, l int")
    right = frame([(None, at(1), 9)], "k string, u timestamp, r int")
    assert [r.matched for r in joins.as_of(left, right, ["k"], "t", "u").collect()] == [None]


def test_within_interval_is_half_open_and_open_ended(frame):
    states = frame(
        [("m", at(0), at(10), "RUN"), ("m", at(10), at(15), "DOWN"), ("m", at(20), None, "IDLE")],
        "m string, s timestamp, e timestamp, state string",
    )
    points = frame([("m", at(x), x) for x in (0, 9, 10, 15, 19, 20, 500)], "m string, t timestamp, n int")
    got = joins.within_interval(points, states, ["m"], "t", "s", "e")
    assert {r.n: r.matched.state for r in got.collect()} == {
        0: "RUN", 9: "RUN", 10: "DOWN", 20: "IDLE", 500: "IDLE"
    }


def test_with_children_keeps_childless_and_fans_out(frame):
    parents = frame([(1, "a"), (2, "b"), (3, "c")], "id int, name string")
    children = frame([(2, 10), (3, 20), (3, 21), (3, 22), (9, 99)], "parent int, n int")
    got = joins.with_children(parents, children, "id", "parent").select("id", "name", "n")
    assert table(got) == [(1, "a", None), (2, "b", 10), (3, "c", 20), (3, "c", 21), (3, "c", 22)]


def test_shift_wraps_past_midnight(frame):
    shifts = frame(
        [(1, "A", 6, 14, "x"), (2, "B", 14, 22, "y"), (3, "C", 22, 6, "z")],
        "shift_id int, shift_code string, start_hour int, end_hour int, crew string",
    )
    runs = frame(
        [(datetime(2024, 1, 5, 23, 30),), (datetime(2024, 1, 6, 1, 0),), (datetime(2024, 1, 6, 6, 0),), (None,)],
        "t timestamp",
    )
    got = joins.with_shift(runs, shifts, "t").select(F.hour("t"), "shift_code", F.col("shift_date").cast("string"))
    assert table(got) == [(1, "C", "2024-01-05"), (23, "C", "2024-01-05"), (6, "A", "2024-01-06")]
    night = joins.with_shift(runs, shifts.where("shift_code = 'C'"), "t").select(F.hour("t"), "shift_code", F.col("shift_date").cast("string"))
    assert table(night) == [(1, "C", "2024-01-05"), (23, "C", "2024-01-05"), (6, None, "2024-01-06")]


@pytest.mark.parametrize("max_rows", [6, 10_000])
def test_within_interval_matches_brute_force_where_intervals_overlap(frame, max_rows):
    rng = random.Random(max_rows)
    points = [(rng.choice("aab"), at(rng.randrange(6000)), i) for i in range(200)]
    intervals = []
    for i in range(60):
        start = rng.randrange(6000)
        end = None if rng.random() < 0.1 else at(start + rng.choice((0, 5, 60, 2000)))
        intervals.append((rng.choice("aab"), at(start), end, i))
    got = joins.within_interval(
        frame(points, "m string, t timestamp, n int"),
        frame(intervals, "m string, s timestamp, e timestamp, id int"),
        ["m"], "t", "s", "e", "id", max_rows=max_rows,
    )
    want = [(n, i) for m, t, n in points for k, s, e, i in intervals if m == k and s <= t and (e is None or t < e)]
    assert sorted((r.n, r.matched.id) for r in got.collect()) == sorted(want)
