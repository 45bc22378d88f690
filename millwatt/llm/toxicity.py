"""Toxicity: restore disguised words by a noisy channel, then score the restored text.

Channel and language model. Letter trigrams of all documents are counted in Spark and make the character language model.
A disguised span (signs standing for letters, a letter drawn out, letters set apart) is a lattice: each sign is
one of the letters it may stand for, or noise; a run of a letter or sign is one or two of it; a gap between single letters,
however wide, is a break or nothing. Viterbi decoding picks the likeliest reading of every span, whatever its length; it
is exact, as only states that cannot win are dropped. A span of signs alone that is longer than ``LONGEST``, such as a table of digits, is a code, and so is
a span with more signs than letters, or a long one with signs, when its reading costs more than ``CODE`` a letter: it stays as it is. All other words are their own
only reading.

Scoring. Words of restored texts are weighed by their smoothed log-odds in toxic against other labelled texts (a
word counts from ``SUPPORT`` toxic texts on); a document is the weight and number of the lexicon words it has and
their share, through a logistic curve fitted with each learning document's own count left out.

Fitting takes a bounded sample of labelled rows (``sample``). To the driver come at most 2**18 trigram counts, the
lexicon (at most ``LEXICON`` words) and three numbers for each sampled row. Scoring is a map without a shuffle.

Defined results: a null or empty text has no words and scores as the intercept says; without labels of both kinds every
score is 0; null ids are not learned from; equal rows come out as they went in; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .letters import Letters, letters
from .quality import labelled
from .words import mix

# Letters that a sign may stand for.
READINGS = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "€": "e",
    "£": "l",
    "(": "c",
}
NOISE = "*._-~'`^"
VOWELS = "aeiou"  # an asterisk often hides one
CLASSES = 64  # 0 is all but letters, 1 to 26 are a to z, the rest share the others
LONGEST = 24  # a longer span may be a code
CODE = -7.0  # log probability a letter: words new to the model are above, hexadecimal ids below
SUPPORT = 4
LEXICON = 5_000
SALT = np.uint64(0x9E3779B97F4A7C15)

_SIGNS = np.zeros(1 << 16, bool)
_SIGNS[[ord(c) for c in READINGS]] = True
_NOISE = np.zeros(1 << 16, bool)
_NOISE[[ord(c) for c in NOISE]] = True


def classes(points: np.ndarray, letter: np.ndarray) -> np.ndarray:
    plain = (points >= 97) & (points <= 122)
    return np.where(plain, points - 96, np.where(letter, 27 + points % (CLASSES - 27), 0)).astype(np.int64)


def trigrams(docs: DataFrame) -> np.ndarray:
    """Counts of letter trigrams over all documents, word ends included."""

    def count(batches):
        total = np.zeros(CLASSES**3, np.int64)
        for batch in batches:
            for block in letters(batch.column("text")):
                c = classes(block.points, block.letter)
                c = np.concatenate([[0, 0], c, [0, 0]])
                total += np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)
        total[0] = 0
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["gram", "seen"])

    seen = docs.select("text").mapInArrow(count, "gram long, seen long").groupBy("gram").agg(F.sum("seen").alias("seen"))
    out = np.zeros(CLASSES**3)
    for r in seen.collect():  # at most CLASSES**3 rows
        out[r.gram] = r.seen
    return out


def char_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a class after two others, smoothed by the bigram and the unigram."""
    three = counts.reshape(CLASSES, CLASSES, CLASSES)
    two = three.sum(0)
    one = two.sum(0)
    p1 = (one + 1) / (one.sum() + CLASSES)
    p2 = (two + 8 * p1) / (two.sum(1, keepdims=True) + 8)
    p3 = (three + 4 * p2) / (three.sum(2, keepdims=True) + 4)
    return np.log(p3)


# Costs of the channel, as log probabilities.
SUBSTITUTED, MASKED, DROPPED, JOINED, BROKEN = -1.0, -2.0, -8.0, -0.3, -1.5
PAIR_READ_ONCE, RUN_READ_ONCE, RUN_READ_TWICE, RUN_KEPT = -7.0, -0.5, -1.5, -6.0


@cache
def _class_of(c: str) -> int:
    return int(classes(np.array([ord(c)], np.uint32), np.array([c.isalpha()]))[0])


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """For each place of a span the strings it may be read as, with their channel cost."""
    out: list[list[tuple[str, float]]] = []
    gap = lambda c: not c.isalpha() and c not in READINGS
    i = 0
    while i < len(span):
        c = span[i]
        j = i
        while j < len(span) and (span[j] == c or (gap(c) and gap(span[j]))):
            j += 1
        n = j - i
        if c.isalpha():
            if n == 1:
                out.append([(c, 0.0)])
            elif n == 2:
                out.append([(c * 2, 0.0), (c, PAIR_READ_ONCE)])
            else:
                out.append([(c, RUN_READ_ONCE), (c * 2, RUN_READ_TWICE), (c * n, RUN_KEPT)])
        elif c in READINGS:
            each = [(x, SUBSTITUTED) for x in READINGS[c]] + [("", DROPPED)]
            if n < 3:
                out += [each] * n
            else:
                out.append([(x * k, k * SUBSTITUTED + cost) for x in READINGS[c] for k, cost in ((1, RUN_READ_ONCE), (2, RUN_READ_TWICE))] + each[-1:])
        elif "*" in span[i:j]:
            out.append([(x, MASKED) for x in VOWELS] + [("", MASKED), (" ", 2 * BROKEN)])
        else:
            out.append([("", JOINED), (" ", BROKEN)])
        i = j
    return out


def reach(model: np.ndarray) -> float:
    """How far a state may lie behind another one and still win.

    A state decides the probabilities of the next two letters only; each differs by the range of the model at most.
    """
    return 2 * float(model.max() - model.min())


def decode(span: str, model: np.ndarray) -> str:
    """The likeliest reading of a disguised span (Viterbi over the last two classes; of equal ones the first found)."""
    return decoded(span, model, reach(model))[0]


def decoded(span: str, model: np.ndarray, reach: float) -> tuple[str, float]:
    """The likeliest reading of a span and its log probability, that of the channel and the end of the word included.

    States further than ``reach`` behind the best cannot be on the likeliest path and are dropped; there are never more than
    pairs of classes.
    """
    # For each state the value of its best path, and the path as pieces linked to the one before.
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for options in [*lattice(span), [(" ", 0.0)]]:
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (value, path) in best.items():
            for string, cost in options:
                v, x, y = value + cost, a, b
                for c in string:
                    z = _class_of(c)
                    v += model[x, y, z]
                    x, y = y, z
                if (x, y) not in after or v > after[x, y][0]:
                    after[x, y] = (v, (path, string))
        least = max(value for value, _ in after.values()) - reach
        best = {state: found for state, found in after.items() if found[0] >= least}
    (value, path), pieces = max(best.values(), key=lambda found: found[0]), []
    while path:
        path, piece = path
        pieces.append(piece)
    return "".join(reversed(pieces)).strip(), value


def is_code(span: str, reading: str, value: float) -> bool:
    """Whether a span, long or with more signs than letters, has a reading that costs more than words do."""
    signs, alphas = sum(c in READINGS for c in span), sum(c.isalpha() for c in span)
    doubtful = signs > alphas or (signs and signs + alphas > LONGEST)
    return doubtful and value < (len(reading) + 1) * CODE


def spans(block: Letters) -> Iterator[tuple[int, int, int]]:
    """Text, start and end of each disguised span of a chunk."""
    p, letter = block.points, block.letter
    n = len(p)
    if n < 3:
        return
    low = np.minimum(p, (1 << 16) - 1)
    sign, noise = _SIGNS[low], _NOISE[low]
    after = lambda x, k: np.concatenate([x[k:], np.zeros(min(k, n), x.dtype)])
    before = lambda x, k: np.concatenate([np.zeros(min(k, n), x.dtype), x[:-k]])
    drawn = letter & (p == after(p, 1)) & (p == after(p, 2))
    edge = np.zeros(n + 1, bool)
    edge[block.bounds] = True
    next_letter, last_letter = after(letter, 1) & ~edge[1:], before(letter, 1) & ~edge[:-1]
    inner = sign & next_letter & (last_letter | before(sign, 1) | ~before(letter | sign, 1))
    tail = sign & last_letter & before(letter, 2) & ~after(letter | sign, 1) & (p != ord("!")) & (p != ord("|")) & (p != ord("("))
    broken = noise & last_letter & next_letter
    # Four or more single letters or signs with nothing but other characters between.
    part = letter | sign
    alone = part & ~(after(part, 1) & ~edge[1:]) & ~(before(part, 1) & ~edge[:-1])
    places = np.flatnonzero(alone)
    close = np.zeros(len(places) + 1, bool)
    if len(places) > 1:
        close[1:-1] = (np.diff(np.cumsum(part)[places]) == 1) & (np.cumsum(edge[:-1])[places[1:]] == np.cumsum(edge[:-1])[places[:-1]])
    run_start = np.flatnonzero(close[1:] & ~close[:-1])
    run_end = np.flatnonzero(~close[1:] & close[:-1])
    apart, stretch = np.zeros(n, bool), np.zeros(n, bool)
    for a, b in zip(run_start.tolist(), run_end.tolist(), strict=True):
        if b - a >= 3:
            apart[places[a]] = True
            stretch[places[a] : places[b] + 1] = True
    marked = drawn | inner | tail | broken | apart
    if not marked.any():
        return
    body = letter | sign | (noise & last_letter & next_letter)
    body |= stretch
    begin = body & (~before(body, 1) | edge[:-1])
    starts = np.flatnonzero(begin)
    if not len(starts):
        return
    stop = ~after(body, 1) | edge[1:]
    ends = np.flatnonzero(body & stop) + 1
    hit = np.unique(np.searchsorted(starts, np.flatnonzero(marked & body), "right") - 1)
    owner = np.searchsorted(block.bounds, starts[hit], "right") - 1
    yield from zip(owner.tolist(), starts[hit].tolist(), ends[hit].tolist(), strict=True)


def word_hashes(block: Letters) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash, start and end of each run of letters of a chunk."""
    letter, points = block.letter, block.points
    edge = np.zeros(len(points) + 1, bool)
    edge[block.bounds] = True
    last = np.concatenate([[False], letter[:-1]]) if len(letter) else letter
    coming = np.concatenate([letter[1:], [False]]) if len(letter) else letter
    starts = np.flatnonzero(letter & (~last | edge[:-1]))
    ends = np.flatnonzero(letter & (~coming | edge[1:])) + 1
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), starts, ends
    lead = starts[0]
    place = np.arange(lead, len(points)) - np.repeat(starts, np.diff(starts, append=len(points)))
    place = np.minimum(place, 255).astype(np.uint64)
    terms = mix(points[lead:].astype(np.uint64) * SALT + place)
    terms[~letter[lead:]] = 0
    hashes = np.add.reduceat(terms, starts - lead)
    return np.searchsorted(block.bounds, starts, "right") - 1, hashes, starts, ends


def hash_words(words: list[str]) -> np.ndarray:
    """The same hash of given lower-case words."""
    points = [np.array([ord(c) for c in w], np.uint64) for w in words]
    return np.array(
        [mix(p * SALT + np.minimum(np.arange(len(p)), 255).astype(np.uint64)).sum(dtype=np.uint64) for p in points], np.uint64
    )


class Reader:
    """Decodes the spans of chunks with a character model; equal spans once."""

    def __init__(self, model: np.ndarray):
        self.model, self.reach, self.known = model, reach(model), {}

    def read(self, span: str) -> str:
        if span not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            if len(span) > LONGEST and not any(c.isalpha() for c in span):
                return span  # a table of digits and the like
            reading, value = decoded(span, self.model, self.reach)
            self.known[span] = span if is_code(span, reading, value) else reading
        return self.known[span]

    def restored(self, block: Letters) -> Iterator[tuple[int, int, int, str]]:
        for text, start, end in spans(block):
            span = "".join(map(chr, block.points[start:end]))
            reading = self.read(span)
            if reading != span:
                yield text, start, end, reading

    def words(self, block: Letters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (text, word hash) of the restored texts, and the number of words of each text."""
        owner, hashes, _, _ = word_hashes(block)
        counts = np.bincount(owner, minlength=len(block))
        more_owner, more = [], []
        for text, _, _, reading in self.restored(block):
            found = hash_words(["".join(c for c in w if c.isalpha()) for w in reading.split()])
            more_owner += [text] * len(found)
            more.append(found)
        if more:
            owner = np.concatenate([owner, np.array(more_owner, np.int64)])
            hashes = np.concatenate([hashes, *more])
        return owner, hashes, counts


def restore(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """``doc_id, restored, spans``: the lower-cased text with its disguised spans decoded, and their number."""

    def run(batches):
        reader = Reader(model)
        for batch in batches:
            texts, counts = [], []
            for block in letters(batch.column("text")):
                pieces: list[list[tuple[int, int, str]]] = [[] for _ in range(len(block))]
                for text, start, end, reading in reader.restored(block):
                    pieces[text].append((start, end, reading))
                whole = block.points.tobytes().decode("utf-32-le", "replace")
                for k, own in enumerate(pieces):
                    at, out = int(block.bounds[k]), []
                    for start, end, reading in own:
                        out += [whole[at:start], reading]
                        at = end
                    texts.append("".join([*out, whole[at : int(block.bounds[k + 1])]]))
                    counts.append(len(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int32())],
                names=["doc_id", "restored", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, restored string, spans int")


@dataclass
class Model:
    chars: np.ndarray
    words: np.ndarray  # sorted hashes of the lexicon
    weights: np.ndarray
    curve: np.ndarray  # of weight, number, share, and the intercept
    known: bool = field(default=True)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method for a few columns."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[-1, -1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _columns(weight: np.ndarray, number: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.column_stack([np.log1p(np.maximum(weight, 0)), np.log1p(number), np.minimum(100 * number / np.maximum(words, 1), 10)])


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000) -> Model:
    chars = char_model(trigrams(docs))

    def distinct(batches):
        reader = Reader(chars)
        for batch in batches:
            y = np.array(batch.column("y").to_pylist(), np.int32)
            for block in letters(batch.column("text")):
                owner, hashes, counts = reader.words(block)
                order = np.lexsort((hashes, owner))
                owner, hashes = owner[order], hashes[order]
                new = np.ones(len(owner), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
                owner, hashes = owner[new], hashes[new]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("digest").take(pa.array(owner + block.first)), pa.array(hashes.view(np.int64)), pa.array(y[owner + block.first]), pa.array(counts[owner])],
                    names=["digest", "word", "y", "n"],
                )

    rows = labelled(docs, labels, "toxic", sample, 1).withColumn("digest", F.xxhash64("text"))
    once = rows.groupBy("digest").agg(F.max("text").alias("text"), F.max("y").alias("y"))  # copies of a text count once
    sizes = {r.y: r["count"] for r in once.groupBy("y").count().collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not other:
        return Model(chars, np.zeros(0, np.uint64), np.zeros(0), np.zeros(4), False)
    found = once.select("digest", "text", "y").mapInArrow(distinct, "digest long, word long, y int, n long")
    odds = lambda a, b: F.log((a + 0.5) / (toxic + 1.0)) - F.log((b + 0.5) / (other + 1.0))
    a, b = F.col("a"), F.col("b")
    lexicon = (
        found.groupBy("word")
        .agg(F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b"))
        .where((a >= SUPPORT) & (odds(a, b) > 2.0))
        .orderBy(F.desc(a * odds(a, b)), "word")
        .limit(LEXICON)
    )
    lexicon = [(r.word, r.a, r.b) for r in lexicon.collect()]
    if not lexicon:
        return Model(chars, np.zeros(0, np.uint64), np.zeros(0), np.zeros(4), False)
    words = np.array([w for w, _, _ in lexicon], np.int64).view(np.uint64)
    order = np.argsort(words)
    words = words[order]
    seen = np.array([(x, z) for _, x, z in lexicon], float)[order]
    weigh = lambda x, z: np.log((x + 0.5) / (toxic + 1)) - np.log((z + 0.5) / (other + 1))

    def left_out(batches):
        reader = Reader(chars)
        for batch in batches:
            y = np.array(batch.column("y").to_pylist())
            for block in letters(batch.column("text")):
                here = y[block.first : block.first + len(block)]
                text, word, counts = _matches(reader, block, words)
                own = here[text]
                weights = np.maximum(weigh(seen[word, 0] - own, seen[word, 1] - (1 - own)), 0)
                weights[(own == 1) & (seen[word, 0] <= SUPPORT)] = 0  # without this text it would not be in the lexicon
                x = _columns(np.bincount(text, weights, len(block)), np.bincount(text, weights > 0, len(block)), counts)
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in x.T] + [pa.array(here.astype(np.int32))], names=["w", "k", "share", "y"])

    points = once.select("text", "y").mapInArrow(left_out, "w double, k double, share double, y int").collect()
    table = np.array(sorted(tuple(r) for r in points))
    return Model(chars, words, weigh(seen[:, 0], seen[:, 1]), _logistic(table[:, :3], table[:, 3]))


def _matches(reader: Reader, block: Letters, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, number of a lexicon word) of a chunk, and each text's number of words."""
    owner, hashes, counts = reader.words(block)
    at = np.minimum(np.searchsorted(lexicon, hashes), max(len(lexicon) - 1, 0))
    hit = lexicon[at] == hashes if len(lexicon) else np.zeros(len(hashes), bool)
    pairs = np.unique(owner[hit] * (len(lexicon) + 1) + at[hit])
    return pairs // (len(lexicon) + 1), pairs % (len(lexicon) + 1), counts


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` in 0 to 1 of every document."""

    def run(batches):
        reader = Reader(model.chars)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for block in letters(batch.column("text")) if model.known else ():
                text, word, counts = _matches(reader, block, model.words)
                weights = np.maximum(model.weights[word], 0)
                x = _columns(np.bincount(text, weights, len(block)), np.bincount(text, weights > 0, len(block)), counts)
                margin = x @ model.curve[:-1] + model.curve[-1]
                out[block.first : block.first + len(block)] = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
