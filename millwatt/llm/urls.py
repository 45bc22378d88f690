"""URL filters: explicit host and path rules, and a path-template tree that judges the pages no rule fits.

The pages a rule fits are the labelled ones. Per host, paths form a tree of segments; segments that vary
(numbers, hexadecimal ids, dates) become a wildcard. So do, at a node with more than ``MANY_CHILDREN`` different children,
those with less than ``ENOUGH`` pages whose share of labelled and of blocked pages does not differ significantly from the
node's; sections with pages or labels of their own stay branches however many siblings they have.
Branches of one node whose labelled share of blocked pages does not differ significantly from their pooled share are
judged together. A template is rejected when its labelled purity, smoothed by the same template on all hosts and by
the overall share, reaches a threshold.

Native DataFrame functions only. Pages are counted by host and path shape first, merged in each task, so a host with a third of all
pages is a few rows in all that follows; only verdicts are joined back to the narrow ``page_id, host, path`` rows.

Defined results: a null url or one without ``://`` has an empty host and path, fits no rule and is judged as the root
of the empty host; equal rows come out as often as they came in; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import written

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DEPTH = 3
SMOOTHING = 2.0
Z = 1.96
THRESHOLD = 0.5

_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_VARIABLE = r"^([0-9]+|[0-9a-f]{8,}|[0-9]+[-_][0-9a-zA-Z_-]*)(\.[a-z]+)?$"


def host(url: Column) -> Column:
    whole = F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 1)
    return F.translate(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 2)


def rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null. ``rules`` is a short configured list."""
    fits = []
    for _, pattern in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = pattern.partition("/")
        inside = (host == name) | host.endswith(f".{name}")
        fits.append(F.when(inside & path.startswith(slash + rest), F.lit(pattern)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def _shape(path: Column) -> Column:
    """Segments with the variable ones as ``*``; what lies below ``DEPTH`` is one last ``**``."""
    parts = F.transform(
        F.filter(F.split(path, "/"), lambda s: s != ""),
        lambda s: F.when(s.rlike(_VARIABLE), F.lit("*")).otherwise(s),
    )
    return F.when(F.size(parts) > DEPTH, F.concat(F.slice(parts, 1, DEPTH), F.array(F.lit("**")))).otherwise(parts)


def _differs(what: str) -> Column:
    """Whether a child's share of such pages differs significantly from that of its node; the half page is for small counts."""
    rate = F.col(f"all_{what}") / F.col("all_pages")
    return F.abs(F.col(what) / F.col("pages") - rate) > F.lit(Z) * F.sqrt(rate * (1 - rate) / F.col("pages")) + F.lit(0.5) / F.col("pages")


def templates(pages: DataFrame) -> DataFrame:
    """``host, shape, template, purity`` for every host and path shape of ``host, shape, verdict`` rows."""
    shapes = pages.groupBy("host", "shape").agg(
        F.count("*").alias("pages"),
        F.count("verdict").alias("labelled"),
        F.sum((F.col("verdict") == "block").cast("long")).alias("blocked"),
    )
    shapes = written(shapes.fillna(0, ["blocked"]), "urls-shapes").withColumn("general", F.col("shape"))
    for depth in range(1, DEPTH + 1):
        parent = F.slice("general", 1, depth - 1)
        here = F.get("general", F.lit(depth - 1))
        deep = F.size("general") >= depth
        counted = [F.sum(c).alias(c) for c in ("pages", "labelled", "blocked")]
        children = shapes.where(deep).groupBy(F.col("host").alias("at_host"), parent.alias("at"), here.alias("child")).agg(*counted)
        children = written(children, "urls-children")
        nodes = children.groupBy("at_host", "at").agg(*[F.sum(c).alias(f"all_{c}") for c in ("pages", "labelled", "blocked")])
        wide = (
            children.join(nodes, ["at_host", "at"])
            .where(~_differs("labelled") & ~_differs("blocked"))
            .select("at_host", "at", "child", F.lit(True).alias("wide"))
        )
        inside = (F.col("host") == F.col("at_host")) & (parent == F.col("at")) & (here == F.col("child")) & deep
        shapes = (
            shapes.join(wide, inside, "left")
            .withColumn(
                "general",
                F.when(
                    F.col("wide") & (here != "**"),
                    F.concat(parent, F.array(F.lit("*")), F.slice("general", depth + 1, DEPTH + 1)),
                ).otherwise(F.col("general")),
            )
            .drop("at_host", "at", "child", "wide")
        )
    named = shapes.withColumn("template", F.concat(F.lit("/"), F.array_join("general", "/"))).withColumn(
        "parent", F.concat(F.lit("/"), F.array_join(F.slice("general", 1, F.greatest(F.size("general") - 1, F.lit(0))), "/"))
    )
    leaves = named.groupBy("host", "parent", "template").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    pooled = leaves.groupBy("host", "parent").agg(F.sum("n").alias("pool_n"), F.sum("b").alias("pool_b"))
    rate = F.when(F.col("pool_n") > 0, F.col("pool_b") / F.col("pool_n")).otherwise(F.lit(0.0))
    alike = (F.col("n") == 0) | (
        F.abs(F.col("b") / F.col("n") - rate) <= Z * F.sqrt(rate * (1 - rate) / F.col("n"))
    )
    merged = leaves.join(pooled, ["host", "parent"]).withColumn(
        "branch", F.when(alike, F.lit("~")).otherwise(F.col("template"))
    )
    groups = merged.groupBy("host", "parent", "branch").agg(F.sum("n").alias("group_n"), F.sum("b").alias("group_b"))
    across = leaves.groupBy("template").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
    overall = leaves.agg(F.sum("n").alias("total_n"), F.sum("b").alias("total_b"))  # one row
    share = F.when(F.col("total_n") > 0, F.col("total_b") / F.col("total_n")).otherwise(F.lit(0.0))
    prior = (F.col("all_b") + SMOOTHING * share) / (F.col("all_n") + SMOOTHING)
    purity = (F.col("group_b") + SMOOTHING * prior) / (F.col("group_n") + SMOOTHING)
    judged = (
        merged.join(groups, ["host", "parent", "branch"])
        .join(across, "template")
        .crossJoin(F.broadcast(overall))
        .select("host", "parent", "template", "branch", F.round(purity, 9).alias("purity"))
    )
    return named.join(judged, ["host", "parent", "template"]).select("host", "shape", "template", "branch", "purity")


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` for every page."""
    parsed = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    verdicts = F.create_map(*[F.lit(x) for verdict, pattern in rules for x in (pattern, verdict)]) if rules else None
    ruled = parsed.withColumn("rule", rule(F.col("host"), F.col("path"), rules)).withColumn(
        "verdict", F.element_at(verdicts, F.col("rule")) if rules else F.lit(None).cast("string")
    )
    shaped = ruled.withColumn("shape", _shape(F.col("path")))
    tree = templates(shaped.select("host", "shape", "verdict"))
    by_tree = F.when(F.col("purity") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return shaped.join(tree, ["host", "shape"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", by_tree).alias("verdict"), "template", "purity"
    )
