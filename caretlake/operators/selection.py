"""Ordered rules over metadata, token sets and their similarity within blocks, grouping, canonical members, owner caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretlake.functions.regexes import re2_to_java
from caretlake.operators.components import hash_to_min
from caretlake.operators.sampling import cap

# Licence families that are allowed or restricted.
PERMISSIVE = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "Unlicense", "ISC", "MS-PL", "Zlib"]
RESTRICTED = ["GPL", "LGPL", "AGPL", "MPL", "EPL", "OSL", "EUPL", "MS-RL", "CC-BY-SA", "MulanPSL", "BSD-4-Clause", "Artistic", "ODbL"]
# Words that token sets leave out.
STOP_WORDS = "a an the for and of to in with is go golang lib library tool".split()
#: Default categories of this project's domain; the first pattern that matches decides. Any ordered table may be given.
CATEGORIES = [
    ("devtools", r"\blinter\b|\bcompiler\b|\bformatter\b|generator|\bast\b"),
    ("web", r"\bhttp\b|\brest\b|\brouter\b|\bapi\b|middleware"),
    ("networking", r"\btcp\b|\budp\b|\bproxy\b|\btunnel\b|\bsocket\b"),
    ("data", r"\bdatabase\b|\bsql\b|\bcache\b|\bshard\b|\bpartition\b|streaming"),
    ("observability", r"\bmetrics\b|\btracing\b|\blogging\b|monitoring"),
    ("testing", r"\btests?\b|\bmock\b|\bbenchmark\b|fuzz"),
    ("library", r"\blibrary\b|\bsdk\b|\bclient\b|\bwrapper\b|\bframework\b"),
]
#: Defaults of the content flags: a strong hit decides alone, two weak ones together, a benign context clears both.
STRONG, WEAK, BENIGN = [r"\bkeygen\b", r"\bcracked\b", r"\bbotnet\b"], [r"\bpayloads?\b", r"\bbroken\b", r"\bstale\b", r"\blossy\b", r"\bcold\b"], [r"\bdetection\b", r"\breview\b"]


def licence_bucket(c: Column) -> Column:
    restricted = F.lit(False)
    for p in RESTRICTED:
        restricted = restricted | c.startswith(p)
    return F.when(c.isin(*PERMISSIVE), "permissive").when(restricted, "restricted").otherwise("unknown")


def hits(hay: Column, patterns: list[str]) -> Column:
    """How many of the patterns match."""
    out = F.lit(0)
    for p in patterns:
        out = out + hay.rlike(re2_to_java(p)).cast("int")
    return out


def content_flag(hay: Column, strong=STRONG, weak=WEAK, benign=BENIGN) -> Column:
    ok = hits(hay, benign) > 0
    w = hits(hay, weak)
    return F.when((hits(hay, strong) > 0) & ~ok, "strong").when((w >= 2) & ~ok, "weak_twice").when(w > 0, "flag")


def category(hay: Column, rules=CATEGORIES, other: str = "other") -> Column:
    out = F.lit(other)
    for name, p in reversed(rules):
        out = F.when(hay.rlike(re2_to_java("(?i)" + p)), name).otherwise(out)
    return out


def token_set(text: Column, stop: list[str] = STOP_WORDS) -> Column:
    """Distinct lower-case words of a-z and 0-9 without stop words, sorted."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.array_sort(F.array_except(F.array_distinct(words), F.array(*map(F.lit, stop))))


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two sets, 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def normal_name(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.element_at(F.split(c, "/"), -1)), r"[-_.]", "")


def normal_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9_\s]", ""), r"\s+", " "))


def priority(stars: Column, pushed: Column, organisation: Column, described: Column, topics: Column, damp: Column, first: str = "2024-10-09", last: str = "2026-10-09") -> Column:
    """0 to 1000 from stars, recency, ownership and description, rounded half to even."""
    # The weights 0.45, 0.30, 0.10, 0.15, the parts 0.5 and 0.1 of a description, and 150,000 stars as full measure.
    popular = F.least(F.lit(1.0), F.log10(stars + 1) / F.log10(F.lit(150001.0)))
    span = F.datediff(F.lit(last).cast("date"), F.lit(first).cast("date"))
    recent = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.datediff(F.substring(pushed, 1, 10).cast("date"), F.lit(first).cast("date")) / span))
    quality = (F.when(described, 0.5).otherwise(0.0) + F.least(F.lit(0.5), 0.1 * topics)) * damp
    score = 0.45 * popular + 0.30 * recent + F.when(organisation, 0.10).otherwise(0.0) + 0.15 * quality
    return F.bround(1000 * score, 0).cast("int")


def similar_in_blocks(df: DataFrame, key: str, block: str, tokens: str, least: float) -> DataFrame:
    """(a, b, similarity) of the pairs within a block whose token sets are similar enough.

    Pairs come from an equality join on (block, token) of the sets' rarest tokens (prefix filter), never from all pairs of
    a block; two empty sets are similar to nothing.
    """
    d = df.select(F.col(key).alias("k"), F.col(block).alias("bl"), F.col(tokens).alias("t")).where("bl IS NOT NULL AND size(t) > 0")
    df_of = d.select("bl", F.explode("t").alias("w")).groupBy("bl", "w").agg(F.count("*").alias("n"))
    ranked = d.select("k", "bl", F.size("t").alias("m"), F.explode("t").alias("w")).join(df_of, ["bl", "w"])
    lists = ranked.groupBy("k", "bl", "m").agg(F.array_sort(F.collect_list(F.struct("n", "w"))).alias("o"))
    keep = (F.col("m") - F.ceil(F.col("m") * F.lit(least)) + 1).cast("int")
    pre = lists.select("k", "bl", F.explode(F.slice("o", F.lit(1), keep)).alias("x")).select("k", "bl", F.col("x.w").alias("w"))
    pairs = pre.alias("x").join(pre.alias("y"), F.expr("x.bl = y.bl AND x.w = y.w AND x.k < y.k")).select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).distinct()
    j = pairs.join(d.select(F.col("k").alias("a"), F.col("t").alias("ta")), "a").join(d.select(F.col("k").alias("b"), F.col("t").alias("tb")), "b")
    return j.select("a", "b", jaccard(F.col("ta"), F.col("tb")).alias("similarity")).where(F.col("similarity") >= least)


def same_text_edges(df: DataFrame, key: str, text: str, least_chars: int = 40) -> DataFrame:
    """A star of edges (a, b) from the smallest key of each equal, long enough text to the others."""
    d = df.select(F.col(key).alias("b"), F.col(text).alias("t")).where(F.length("t") >= least_chars)
    return d.join(d.groupBy("t").agg(F.min("b").alias("a")), "t").where("a <> b").select("a", "b")


def groups(nodes: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """(key, group): the smallest member names a group; a node without edges is its own."""
    found = hash_to_min(edges).toDF(key, "group")
    return nodes.select(key).distinct().join(found, key, "left").select(key, F.coalesce("group", key).alias("group"))


def canonical(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """(group, canonical): the member of the greatest ``order``, ties by the greatest name; all members count."""
    return df.groupBy(group).agg(F.max_by(name, F.struct(*order, name)).alias("canonical"))


def owner_cap(df: DataFrame, owner: Column, order: list[Column], n: int = 15) -> DataFrame:
    return cap(df.withColumn("owner", owner), ["owner"], order, n)


def reasons(rules: dict[str, Column]) -> Column:
    """The names of all rules that hold, sorted; a rule that is null does not hold."""
    return F.array_sort(F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]), lambda x: x.isNotNull()))


def first_reason(rules: dict[str, Column], detail: dict[str, Column] | None = None) -> Column:
    """The name of the first rule that holds, with ``:`` and its detail where it has one; null if none holds."""
    out = F.lit(None).cast("string")
    for name, c in reversed(list(rules.items())):
        said = F.concat(F.lit(name + ":"), (detail or {})[name].cast("string")) if name in (detail or {}) else F.lit(name)
        out = F.when(c, said).otherwise(out)
    return out


def odd_name(c: Column, stem: int = 10, digits: int = 3, vowels: float = 0.22) -> Column:
    """Whether a name looks made by chance: a run of digits beside a long stem of few vowels."""
    low = F.lower(c)
    letters = F.regexp_replace(low, "[-_0-9]", "")
    n = F.length(letters)
    return (n >= stem) & low.rlike(rf"[0-9]{{{digits},}}") & (F.length(F.regexp_replace(letters, "[^aeiou]", "")) / F.when(n > 0, n) < vowels)


def one_group(df: DataFrame, key: str, root: str | None = None) -> DataFrame:
    """A star of edges (a, b) that ties all rows of ``df`` together: from ``root`` if it is among them, else from the smallest key."""
    d = df.select(F.col(key).alias("b")).where("b IS NOT NULL").distinct()
    centre = d.agg(F.coalesce(F.max(F.when(F.col("b") == F.lit(root), F.col("b"))), F.min("b")).alias("a"))  # one row
    return d.crossJoin(F.broadcast(centre)).where("a <> b").select("a", "b")


def outcomes(df: DataFrame, key: str, reasons_col: str, order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(selected, rejected): rows without reasons in ``order``, rows with any by key. Both are sorted over ranges, not in one task."""
    none = F.size(F.coalesce(reasons_col, F.array().cast("array<string>"))) == 0
    return df.where(none).orderBy(*order), df.where(~none).withColumn(reasons_col, F.array_sort(F.array_distinct(reasons_col))).orderBy(key)
