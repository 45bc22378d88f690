from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from millwatt.llm.letters import letters
from millwatt.llm.words import rolling, tokenise, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="ab é漢😀 \t\n\x0b\x0c\r\u00a0", max_size=30)), max_size=12)


@given(texts, st.booleans())
def test_tokeniser_finds_the_words_of_every_text(rows, lower):
    found = {}
    for t in tokenise(pa.array(rows, pa.string()), lower):
        for k in range(len(t)):
            a, b = t.bounds[k], t.bounds[k + 1]
            found[t.first + k] = [bytes(t.data[s:e]).decode() for s, e in zip(t.starts[a:b], t.ends[a:b], strict=True)]
    assert found == {i: WORD.findall(r or "") for i, r in enumerate(rows)}


@given(texts)
def test_equal_words_have_equal_hashes(rows):
    seen = {}
    for t in tokenise(pa.array(rows, pa.string())):
        for s, e, h in zip(t.starts, t.ends, t.hashes, strict=True):
            assert seen.setdefault(bytes(t.data[s:e]), h) == h
    assert len(set(seen.values())) == len(seen)


@given(texts)
def test_windows_stay_in_their_text_and_hash_their_words(rows):
    seen = {}
    for t in tokenise(pa.array(rows, pa.string())):
        hashes = rolling(t.hashes, 2)
        at, owner = windows(t, 2)
        want = [(k, i) for k in range(len(t)) for i in range(t.bounds[k], t.bounds[k + 1] - 1)]
        assert list(zip(owner, at, strict=True)) == want
        for i in at:
            key = tuple(t.hashes[i : i + 2])
            assert seen.setdefault(key, hashes[i]) == hashes[i]
    assert len(set(seen.values())) == len(seen)


@given(texts)
def test_letters_are_lower_case_code_points(rows):
    for block in letters(pa.array(rows, pa.string())):
        for k in range(len(block)):
            a, b = block.bounds[k], block.bounds[k + 1]
            text = rows[block.first + k] or ""
            assert "".join(map(chr, block.points[a:b])) == text.lower()
            assert block.letter[a:b].tolist() == [c.isalpha() for c in text]


def test_lower_folds_ascii_only():
    (t,) = tokenise(pa.array(["ÀB àb Àb"]), lower=True)
    assert t.hashes[0] == t.hashes[2] != t.hashes[1]
    assert np.array_equal(t.bounds, [0, 3])
