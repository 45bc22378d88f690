"""Line deduplication by a deletion-neighbourhood join.

Lines are compared as word sequences. Equal lines that are not blank are copies; from ``FUZZY_WORDS`` words on,
so are lines within one word of each other (one word replaced, added or missing). Of a line and its copies only the
earliest occurrence, by document id and line number, stays; a line goes when any copy of it occurs earlier, judged on
the input.

* Equal lines are found by their hashes, counted in each task before the shuffle.
* Two lines within one word share their first or their last half (of the shorter, rounded down to four words). Only
  lines that share a half with a different line go on; this is exact, and most lines end here.
* Those emit every variant with one word deleted, on the side that is not shared, as a hashed key, and the whole line. Equal
  variants at the same place are replacements; a variant equal to a whole line is a deletion. Each key is
  aggregated to its earliest line, so a bucket costs a row for each member, never pairs.
* Each line and the earliest one of its key are compared word by word before the link counts.

The halves that lines share are broadcast when counted to be at most ``BROADCAST_ROWS``, and the places of candidates when at
most ``BROADCAST_LINES``, so that no text is shuffled to find the few candidates; beyond that Spark shuffles both sides. Native DataFrame functions
only. Variant hashes are running sums (exclusive or) over a line's words, linear in its length.

Defined results: words are separated by ``[\\x20\\x09-\\x0D]+``, lines by a line feed; blank lines
always stay; a null or empty text has no removed lines and keeps its text; a null id comes before all others; rows with
the same id and text are one document and keep the same lines; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stage import free, small, written

MIN_WORDS = 1  # all but blank lines
FUZZY_WORDS = 8
BLOCK = 62  # lines in one mask
BROADCAST_ROWS = 200_000  # keys of 8 bytes
BROADCAST_LINES = 1_000_000  # of about 64 bytes
_LINE = ["l1", "l2"]
_AT = ["doc_id", "digest", "line_no"]


def _plain(text: Column) -> Column:
    """The text with every run of blanks inside a line as one space."""
    odd = text.contains("  ")
    for c in "\t\x0b\x0c\r":
        odd = odd | text.contains(c)
    return F.when(odd, F.regexp_replace(text, r"[ \t\x0B\f\r]+", " ")).otherwise(text)


def _digest(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def lines(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, line_no, line, n`` of every line with ``MIN_WORDS`` words or more."""
    parts = F.split(_plain(F.col("text")), "\n")
    rows = docs.where(F.col("text").isNotNull()).select(
        "doc_id", _digest(F.col("text")).alias("digest"), F.posexplode(parts).alias("line_no", "line")
    )
    trimmed = rows.withColumn("line", F.trim("line"))
    spaces = F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(" "), F.lit("")))
    return trimmed.withColumn("n", F.when(F.col("line") == "", 0).otherwise(spaces + 1)).where(F.col("n") >= MIN_WORDS)


def _identity(line: Column) -> list[Column]:
    return [F.xxhash64(line).alias("l1"), F.xxhash64(F.lit(1), line).alias("l2")]


def _halves(line: Column, n: Column) -> Column:
    """``(side, h, key)`` for the first and last ``h`` words, for each ``h`` a neighbour may use."""
    out = []
    for k, h in enumerate((F.floor(n / 8) * 4, F.floor((n - 1) / 8) * 4)):
        h = h.cast("int")
        for side, count in ((0, h), (1, -h)):
            part = F.xxhash64(F.lit(side), h, F.call_function("substring_index", line, F.lit(" "), count))
            one = F.struct(F.lit(side).alias("side"), h.alias("h"), part.alias("key"))
            out.append(one if k == 0 else F.when((n % 8 == 0) & (h > 0), one))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def _order(*names: str) -> Column:
    return F.struct(*names)


def _texts(docs: DataFrame, near: DataFrame) -> DataFrame:
    """``first, n, head, tail, line`` of each candidate, its text taken from its first occurrence.

    Only documents that hold one are split into lines again.
    """
    wanted = written(
        near.groupBy(F.col("first.doc_id").alias("at_id"), F.col("first.digest").alias("at_digest")).agg(
            F.collect_list(F.struct("first", "n", "head", "tail")).alias("wanted")  # at most the lines of one document
        ),
        "lines-wanted",
    )
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", _digest(F.col("text")).alias("digest"), "text")
    # Bounded by the lines it lists, about 64 bytes each.
    small_wanted = F.broadcast(wanted) if near.count() <= BROADCAST_LINES else wanted
    same = texts["doc_id"].eqNullSafe(wanted["at_id"]) & (texts["digest"] == wanted["at_digest"])
    found = texts.join(small_wanted, same).select("wanted", F.split(_plain(F.col("text")), "\n").alias("lines"))
    line = lambda w: F.trim(F.get(F.col("lines"), w["first"]["line_no"])).alias("line")
    each = F.transform("wanted", lambda w: F.struct(*[w[x].alias(x) for x in ("first", "n", "head", "tail")], line(w)))
    return found.select(F.explode(each).alias("c")).select("c.*").dropDuplicates(["first"])


def removed(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, line_no`` of every line that goes (once for rows with the same id and text)."""
    all_lines = lines(docs)
    narrow = written(
        all_lines.select(
            *_AT,
            "n",
            *_identity(F.col("line")),
            F.when(F.col("n") >= FUZZY_WORDS, _halves(F.col("line"), F.col("n"))).alias("halves"),
        ),
        "lines",
    )
    # Halves that different lines share, then the lines that have one.
    keys = narrow.select(*_LINE, F.explode("halves").alias("half")).select("l1", "half.key")
    shared = written(
        keys.groupBy("key").agg(F.min("l1").alias("x"), F.max("l1").alias("y")).where("x <> y").select("key"), "lines-halves"
    )
    near = (
        narrow.select(*_LINE, *_AT, "n", F.explode("halves").alias("half"))
        .select(*_LINE, *_AT, "n", "half.*")
        .join(small(shared, BROADCAST_ROWS), "key")
        .groupBy(*_LINE, "n")
        .agg(
            F.min(F.when(F.col("side") == 0, F.col("h"))).alias("head"),
            F.min(F.when(F.col("side") == 1, F.col("h"))).alias("tail"),
            F.min(_order(*_AT)).alias("first"),
        )
    )
    near = written(near, "lines-near")
    candidates = written(_texts(docs, near), "lines-candidates")

    words = candidates.select("first", "n", "head", "tail", F.posexplode(F.split("line", " ")).alias("i", "word"))
    words = words.withColumn("here", F.xxhash64("i", "word")).withColumn("shifted", F.xxhash64(F.col("i") - 1, "word"))
    own = Window.partitionBy("first")
    upto = own.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = words.select(
        "first",
        "n",
        "i",
        "head",
        "tail",
        "here",
        F.expr("bit_xor(here)").over(upto).alias("before"),
        F.expr("bit_xor(shifted)").over(upto).alias("shifted_before"),
        F.expr("bit_xor(here)").over(own).alias("all_here"),
        F.expr("bit_xor(shifted)").over(own).alias("all_shifted"),
    )
    rest = F.col("before").bitwiseXOR(F.col("here")).bitwiseXOR(F.col("all_shifted")).bitwiseXOR(F.col("shifted_before"))
    without = F.xxhash64(F.col("n") - 1, rest)
    deleted = sums.where("coalesce(i >= head, false) or coalesce(i < n - tail, false)").select(
        "first",
        F.explode(
            F.array(
                F.struct(F.xxhash64(without, "i").alias("key"), F.lit(0).alias("role")),  # replaced at i
                F.struct(without.alias("key"), F.lit(1).alias("role")),  # longer by one
            )
        ).alias("v"),
    )
    full = F.struct(F.xxhash64("n", "all_here").alias("key"), F.lit(2).alias("role"))
    whole = sums.where("i = 0").select("first", full.alias("v"))
    variants = written(deleted.unionByName(whole).select("first", "v.*"), "lines-variants")
    # Keys of replacements and of deletions are hashes of different shape and do not meet.
    met = (
        variants.groupBy("key")
        .agg(
            F.min("first").alias("least"),
            F.max("first").alias("most"),
            F.min(F.when(F.col("role") == 1, F.col("first"))).alias("longer"),
            F.min(F.when(F.col("role") == 2, F.col("first"))).alias("shorter"),
            F.min("role").alias("kind"),
        )
        .where("least <> most and (kind = 0 or (longer is not null and shorter is not null))")
        .drop("most", "kind")
    )
    partner = F.when(F.col("role") == 0, F.col("least")).when(F.col("role") == 1, F.col("shorter")).otherwise(F.col("longer"))
    pairs = variants.join(met, "key").select("first", partner.alias("partner")).where("partner < first").distinct()
    by_first = candidates.select("first", F.split("line", " ").alias("words"))
    checked = (
        pairs.join(by_first, "first")
        .join(by_first.select(F.col("first").alias("partner"), F.col("words").alias("other")), "partner")
        .where(within_one("words", "other"))
    )
    nearest = checked.groupBy("first").agg(F.min("partner").alias("partner"))
    # Lines that occur more than once, and lines near an earlier one.
    copies = narrow.groupBy(*_LINE).count().where("count > 1").select(*_LINE)
    moved = near.join(nearest, "first").select(*_LINE, "partner")
    # Each is written before it is joined, so that Spark can split a line with very many copies.
    affected = written(copies.join(moved, _LINE, "full_outer"), "lines-affected")
    at = written(narrow.select(*_LINE, *_AT).join(affected, _LINE), "lines-at")
    firsts = at.groupBy(*_LINE).agg(F.min(_order(*_AT)).alias("first"), F.first("partner").alias("partner"))
    stays = written(firsts.select(*_LINE, F.least("first", F.coalesce("partner", "first")).alias("stays")), "lines-stay")
    return at.drop("partner").join(stays, _LINE).where(_order(*_AT) > F.col("stays")).select(*_AT).distinct()


def within_one(a: str, b: str) -> Column:
    """Whether two arrays of words differ by one replacement, insertion or deletion at most.

    They do when their common head and tail together cover all but one word of the longer.
    """
    longer, shorter = F.greatest(F.size(a), F.size(b)), F.least(F.size(a), F.size(b))

    def common(x: Column, y: Column) -> Column:
        """Length of the common head."""
        same = F.zip_with(F.slice(x, 1, shorter), F.slice(y, 1, shorter), lambda p, q: p == q)
        at = F.array_position(same, F.lit(False))
        return F.when(at == 0, shorter).otherwise(at - 1)

    covered = common(F.col(a), F.col(b)) + common(F.reverse(a), F.reverse(b))
    return (longer - shorter <= 1) & (covered >= longer - 1)


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, removed``: numbers of the removed lines, from 0, joined by commas."""
    gone = removed(docs).groupBy("doc_id", "digest").agg(F.array_sort(F.collect_list("line_no")).alias("gone"))
    text = F.coalesce(F.col("text"), F.lit(""))
    feeds = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    sizes = docs.select(
        "doc_id",
        _digest(text).alias("digest"),
        F.when(text == "", 0).otherwise(feeds + 1).cast("long").alias("n_lines"),
    )
    same = sizes["doc_id"].eqNullSafe(gone["doc_id"]) & (sizes["digest"] == gone["digest"])
    return sizes.join(gone, same, "left").select(
        sizes["doc_id"],
        "n_lines",
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("gone", ","), F.lit("")).alias("removed"),
    )


def dedup(docs: DataFrame) -> DataFrame:
    """The documents with their removed lines taken out of ``text``.

    All other columns stay as they were but ``n_chars``, which is counted anew if there. A document whose every word went is a copy of others and goes too.
    """
    mask_id, mask_digest, mask = (free(name, docs.columns) for name in ("mask_id", "mask_digest", "removed_mask"))
    masks = (
        removed(docs)
        .groupBy("doc_id", "digest", F.floor(F.col("line_no") / BLOCK).cast("int").alias("block"))
        .agg(F.expr(f"bit_or(shiftleft(1L, line_no % {BLOCK}))").alias("bits"))
        .groupBy(F.col("doc_id").alias(mask_id), F.col("digest").alias(mask_digest))
        .agg(F.collect_list(F.struct("block", "bits")).alias("sparse"), F.max("block").alias("blocks"))
        .withColumn(
            mask,
            F.transform(
                F.sequence(F.lit(0), F.col("blocks")),
                lambda b: F.coalesce(F.get(F.filter("sparse", lambda s: s["block"] == b), F.lit(0))["bits"], F.lit(0)),
            ),
        )
        .select(mask_id, mask_digest, mask)
    )
    own = _digest(F.coalesce(docs["text"], F.lit("")))
    joined = docs.join(masks, docs["doc_id"].eqNullSafe(masks[mask_id]) & (own == masks[mask_digest]), "left")

    def gone(i: Column) -> Column:
        bits = F.get(F.col(mask), F.floor(i / BLOCK).cast("int"))
        return F.coalesce(F.call_function("shiftright", bits, i % BLOCK).bitwiseAND(F.lit(1)), F.lit(0)) == 1

    untouched = F.col(mask).isNull()
    left = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~gone(i)), "\n")
    cut = joined.withColumn("text", F.when(untouched, F.col("text")).otherwise(left))
    cut = cut.where(untouched | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(untouched, F.col("n_chars")).otherwise(counted))
    return cut.select(*docs.columns)
