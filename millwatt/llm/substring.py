"""Substring deduplication by level-wise doubling.

A window of ``WINDOW`` words is removed when its word sequence also starts anywhere else. Candidates are found at
a short length first; only what repeats there is looked at over twice the length, and so on up to the full window:

* 9 words. Every window names one anchor, the 9-word piece in it with the least hash (the leftmost of equals). Equal
  windows name equal anchors at equal places, so only anchors whose piece repeats can belong to a repeated
  window. Anchors are about 7 % of all places, which is all that is shuffled.
* 18 words. A 35-word window around an anchor holds the 9 words before it or the 9 after it as well. Anchors where
  neither doubled piece repeats are dropped.
* The full window. The windows of one anchor together are a span. A span that occurs twice as a whole settles all its
  windows; equal spans are one row with a count, so a passage in a third of all documents costs one row. Where spans of one
  anchor differ, the windows of one copy of each are hashed (128 bits) and counted, weighted by the copies.

Then the marks go back to the documents. Texts move compressed, twice: to the spans that must be opened, and to the marks.
Nothing is capped or sampled and no group is collected but the marks of one document.

Defined results: words are runs of ``[^\\x20\\x09-\\x0D]``, taken unchanged; a null or empty text, and one with fewer words than
a window, loses nothing; rows with the same id and text are copies of each other and each comes out; a null id is
an id like any other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packing import pack, unpack
from .stage import written
from .words import _BASE, _BASE_INVERSE, Words, mix, powers, rolling, tokenise

WINDOW = 35
SHORT = 9  # a quarter of the window, rounded up: 9, 18, 35
SLACK = WINDOW - SHORT  # places at which the short piece may lie in a window, less one


def _least(g: np.ndarray, count: int) -> np.ndarray:
    """For each place, where the least of ``g`` over the next ``count`` is; the leftmost of equals."""
    at, width = np.arange(len(g)), 1
    while width < count:
        step = min(width, count - width)
        right = at[step:]
        left = at[: len(right)]
        at = np.where(g[left] <= g[right], left, right)
        width += step
    return at


def _pieces(tokens: Words) -> dict[str, np.ndarray] | None:
    """The anchors of a chunk: owner, place, largest and least distance to a window's start, and hashes."""
    h = tokens.hashes
    owner = tokens.owner()
    n = len(h) - WINDOW + 1
    if n <= 0:
        return None
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1 :])  # starts of windows
    if not len(inside):
        return None
    g = rolling(h, SHORT)
    anchor = _least(g, SLACK + 1)[inside]
    first = np.ones(len(inside), bool)
    # Windows of one anchor lie together.
    first[1:] = (anchor[1:] != anchor[:-1]) | (owner[inside[1:]] != owner[inside[:-1]])
    lo = inside[first]
    hi = inside[np.append(np.flatnonzero(first)[1:], len(inside)) - 1]
    p = anchor[first]
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(_BASE, len(h)), out=total[1:])
    inverse = powers(_BASE_INVERSE, len(h) + 1)

    def over(a, b):
        return mix((total[b] - total[a]) * inverse[a])

    doc = owner[lo]
    begin, end = tokens.bounds[doc], tokens.bounds[doc + 1]
    low32 = lambda x: (x & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
    # A doubled piece that would leave the text is in no window: give it a value of its own.
    alone = low32(mix(p.astype(np.uint64) + (g[p] << np.uint64(7))))
    left = np.where(p - SHORT >= begin, low32(over(np.maximum(p - SHORT, 0), p + SHORT)), alone)
    right = np.where(p + 2 * SHORT <= end, low32(over(p, np.minimum(p + 2 * SHORT, len(h)))), alone)
    span = mix(over(lo, hi + WINDOW) + ((p - lo) * 64 + (p - hi)).astype(np.uint64))
    return {
        "doc": doc,
        "place": (p - begin).astype(np.int32),
        "most": (p - lo).astype(np.int8),
        "least": (p - hi).astype(np.int8),
        "short": g[p].view(np.int64),
        "left": left,
        "right": right,
        "span": span.view(np.int64),
    }


def _anchors(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["place", "most", "least", "short", "left", "right", "span"]

    def run(batches):
        for batch in batches:
            for tokens in tokenise(batch.column("text")):
                found = _pieces(tokens)
                if found is None:
                    continue
                rows = pa.array(found["doc"] + tokens.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("digest").take(rows)] + [pa.array(found[x]) for x in names],
                    names=["doc_id", "digest", *names],
                )

    return docs.mapInArrow(
        run,
        f"doc_id {kind}, digest int, place int, most byte, least byte, short long, left int, right int, span long",
    )


def _same(a: DataFrame, b: DataFrame, keys: list[str]):
    """Join condition on keys that may be null."""
    on = [a[k].eqNullSafe(b[k]) for k in keys]
    out = on[0]
    for c in on[1:]:
        out = out & c
    return out


def repeated(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, marks`` of the documents that hold repeated windows.

    ``marks`` is a list of (place, mask): bit ``l`` of the mask says that the window starting ``l`` words before ``place``
    repeats. ``docs`` has ``doc_id, digest, text``.
    """
    anchors = _anchors(docs)
    # Written first, so that both sides of the join are plain exchanges and Spark can split a hot anchor.
    twice = written(anchors.groupBy("short").count().where("count > 1").select("short"), "substring-twice")
    kept = written(anchors.join(twice, "short"), "substring-9")
    key = ["short", "span"]
    spans = written(
        kept.groupBy("short", "left", "right", "most", "least", "span").agg(
            F.count("*").alias("n"), F.min(F.struct("doc_id", "digest", "place")).alias("copy")
        ),
        "substring-spans",
    )
    # Twice the length, to either side.
    doubled = spans
    for side, found in (("left", "l"), ("right", "r")):
        again = spans.groupBy("short", side).agg(F.sum("n").alias("all_n")).where("all_n > 1")
        doubled = doubled.join(again.select("short", side, F.lit(True).alias(found)), ["short", side], "left")
    doubled = doubled.where("l or r").drop("l", "r")
    # The full window. Spans that differ while their anchor is the same are opened, unless all of them repeat.
    mixed = doubled.groupBy("short").agg(F.count("*").alias("spans"), F.min("n").alias("rarest"))
    mixed = mixed.where("spans > 1 and rarest = 1").select("short")
    opened = doubled.join(mixed, "short").groupBy("copy.doc_id", "copy.digest").agg(
        F.collect_list(F.struct("short", "span", F.col("copy.place").alias("place"), "most", "least", "n")).alias("spans")
    )
    packed = pack(docs, ["doc_id", "digest"])
    texts = packed.join(opened, _same(packed, opened, ["doc_id", "digest"])).drop(opened["doc_id"]).drop(opened["digest"])
    # Rows with the same id and text would give their spans twice.
    texts = texts.dropDuplicates(["doc_id", "digest"]).select("packed", "spans")
    windows = written(
        texts.mapInArrow(_open, "w1 long, w2 long, short long, span long, l byte, n long"), "substring-35"
    )
    again = windows.groupBy("w1", "w2").agg(F.sum("n").alias("all_n")).where("all_n > 1").select("w1", "w2")
    bit = F.expr("shiftleft(1, cast(l as int))")
    by_window = windows.join(again, ["w1", "w2"]).groupBy(*key).agg(F.bit_or(bit).alias("mask"))
    whole = doubled.where("n > 1").select(*key, F.expr("shiftleft(1, most + 1) - shiftleft(1, cast(least as int))").alias("mask"))
    # Written before the join, so that Spark can split a span with very many copies.
    marks = written(whole.unionByName(by_window).groupBy(*key).agg(F.bit_or("mask").alias("mask")), "substring-marks")
    return kept.join(marks, key).groupBy("doc_id", "digest").agg(F.collect_list(F.struct("place", "mask")).alias("marks"))


def _open(batches):
    """Hashes of the windows of spans, each with its span and distance."""
    names = ["w1", "w2", "short", "span", "l", "n"]
    for batch in batches:
        spans = batch.column("spans").to_pylist()
        for tokens in tokenise(unpack(batch.column("packed"))):
            one, two = rolling(tokens.hashes, WINDOW), rolling(tokens.hashes, WINDOW, salt=0x5DEECE66D)
            out = {x: [] for x in names}
            for k in range(len(tokens)):
                for s in spans[tokens.first + k]:
                    l = np.arange(s["least"], s["most"] + 1)  # noqa: E741
                    at = tokens.bounds[k] + s["place"] - l
                    out["w1"].append(one[at].view(np.int64))
                    out["w2"].append(two[at].view(np.int64))
                    out["l"].append(l.astype(np.int8))
                    for x in ("short", "span", "n"):
                        out[x].append(np.full(len(l), s[x], np.int64))
            if out["l"]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out[x])) for x in names], names=names)


def _cut(batches):
    """Remove the words of marked windows."""
    for batch in batches:
        marks = batch.column("marks").to_pylist()
        texts = unpack(batch.column("packed"))
        n_words, n_removed, kept, sha = [], [], [], []
        for tokens in tokenise(texts):
            data = tokens.data.tobytes()
            for k in range(len(tokens)):
                a, b = int(tokens.bounds[k]), int(tokens.bounds[k + 1])
                gone = np.zeros(b - a + 1, np.int64)
                own = marks[tokens.first + k]
                if own:
                    place = np.array([m["place"] for m in own])
                    mask = np.array([m["mask"] for m in own])
                    for l in range(SLACK + 1):  # noqa: E741
                        at = place[(mask >> l) & 1 == 1] - l
                        np.add.at(gone, at, 1)
                        np.add.at(gone, at + WINDOW, -1)
                stays = np.cumsum(gone[:-1]) == 0
                places_kept = zip(tokens.starts[a:b][stays].tolist(), tokens.ends[a:b][stays].tolist(), strict=True)
                text = b" ".join([data[s:e] for s, e in places_kept])
                n_words.append(b - a)
                n_removed.append(b - a - int(stays.sum()))
                kept.append(text)
                sha.append(hashlib.sha256(text).hexdigest())
        columns = [
            batch.column("doc_id"),
            pa.array(n_words, pa.int64()),
            pa.array(n_removed, pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()),
            pa.array(sha, pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])


def dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, kept_sha256``: kept words are joined by one space."""
    digest = F.coalesce(F.xxhash64("text"), F.lit(0)).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
    docs = docs.select("doc_id", "text", digest.alias("digest"))
    marks = repeated(docs)
    packed = pack(docs, ["doc_id", "digest"])
    rows = packed.join(marks, _same(packed, marks, ["doc_id", "digest"]), "left").select(packed["doc_id"], "packed", "marks")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_cut, f"doc_id {kind}, n_words long, n_removed long, kept_text string, kept_sha256 string")
