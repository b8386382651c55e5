"""The relational half of facts about a caret: status, leak audit, quarantine, normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caretlake.functions.hashing import uniform

IDENT = r"[A-Za-z_][A-Za-z0-9_]*"


def identifiers(text: Column) -> Column:
    """Distinct identifiers of a text, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(f"({IDENT})"), F.lit(1))))


def leak_audit(df: DataFrame, facts: Column, target: Column, visible: Column) -> DataFrame:
    """Adds target_identifiers, mentioned (facts whose name stands in the target) and violations (of these the ones visible nowhere else)."""
    d = df.withColumn("target_identifiers", identifiers(target))
    d = d.withColumn("mentioned", F.array_sort(F.array_intersect(facts, F.col("target_identifiers"))))
    return d.withColumn("violations", F.array_sort(F.array_except(F.col("mentioned"), visible)))


def quarantine(df: DataFrame, facts: str, status: str = "status", reason: str = "reason") -> DataFrame:
    """Records with violations lose their facts and fail with a reason that names them."""
    bad = F.size("violations") > 0
    return (
        df.withColumn(reason, F.when(bad, F.concat(F.lit("leak_audit:"), F.array_join("violations", ","))).otherwise(F.col(reason)))
        .withColumn(status, F.when(bad, "failed").otherwise(F.col(status)))
        .withColumn(facts, F.when(bad, F.array().cast("array<string>")).otherwise(F.col(facts)))
        .withColumn("violations", F.when(bad, F.array().cast("array<string>")).otherwise(F.col("violations")))
    )


def status_of(receiver_known: Column, imports_resolved: Column, externals_resolved: Column) -> tuple[Column, Column]:
    """Status and reason: partially resolved for the first thing that is unknown, else resolved."""
    reason = F.when(~receiver_known, "unresolved_receiver_type").when(~imports_resolved, "unresolved_import").when(~externals_resolved, "external_imports_unresolved")
    return F.when(reason.isNull(), "resolved").otherwise("partially_resolved"), reason


def mirror_status(samples: DataFrame, records: DataFrame, policy: str, required: bool = False) -> DataFrame:
    """Samples with status and reason of their record under a policy; without one ``not_attempted`` / ``not_in_subset``.

    With ``required`` samples without a resolved record are dropped.
    """
    r = records.where(F.col("visibility_policy") == policy).select("sample_id", F.col("status").alias("semantic_status"), F.col("reason").alias("semantic_reason"))
    j = samples.drop("semantic_status", "semantic_reason").join(r, "sample_id", "left")
    none = F.col("semantic_status").isNull()
    j = j.withColumn("semantic_reason", F.when(none, "not_in_subset").otherwise(F.col("semantic_reason"))).withColumn("semantic_status", F.when(none, "not_attempted").otherwise(F.col("semantic_status")))
    return j.where(F.col("semantic_status").isin("resolved", "partially_resolved")) if required else j


def visible_before(facts: Column, caret: Column) -> Column:
    """Facts declared before the caret (strict prefix)."""
    return F.filter(facts, lambda x: x["declared_at"].isNull() | (x["declared_at"] < caret))


def limited(facts: Column, n: int = 48) -> tuple[Column, Column]:
    """At most ``n`` facts and whether some were left out."""
    return F.slice(facts, 1, n), F.size(facts) > n


def no_nulls(c: Column, kind: str) -> Column:
    return F.coalesce(c, F.array().cast(kind))


def in_subset(sample_id: Column, fraction: float, seed: str) -> Column:
    """Whether a sample belongs to the part that is enriched with facts."""
    return uniform(F.lit(seed), F.lit("semantic_subset"), sample_id) < F.lit(float(fraction))


def work_items(samples: DataFrame, chunk: int = 48) -> DataFrame:
    """(repository_id, project, chunk, sample_id): the samples of a package in runs of ``chunk``, in order of path and place."""
    w = Window.partitionBy("repository_id", "project").orderBy("relative_path", "caret_byte_offset", "sample_id")
    return samples.select("repository_id", "project", F.floor((F.row_number().over(w) - 1) / chunk).cast("int").alias("chunk"), "sample_id")


def package_files(files: DataFrame, most: int = 400) -> DataFrame:
    """(file_id, variant, files, reason): the files that a file is checked with.

    ``lib``: the package without tests; ``test``: with the tests of the package itself; ``xtest``: the tests of the
    package from outside. ``files`` is their number. A file that the build leaves out, or of a set of more than ``most``
    files, has a reason and no variant. Packages are counted with partial aggregation.
    """
    outside = F.col("is_test") & F.coalesce(F.col("package_name").endswith("_test"), F.lit(False))
    kind = F.when(outside, "xtest").when(F.col("is_test"), "test").otherwise("lib")
    f = files.select("file_id", "repository_id", "project", F.coalesce("build_match", F.lit(True)).alias("built"), kind.alias("variant"))
    n = f.where("built").groupBy("repository_id", "project").pivot("variant", ["lib", "test", "xtest"]).count().na.fill(0)
    j = f.join(n, ["repository_id", "project"], "left")
    size = F.when(F.col("variant") == "xtest", F.col("xtest")).when(F.col("variant") == "test", F.col("lib") + F.col("test")).otherwise(F.col("lib"))
    reason = F.when(~F.col("built"), "build_constraint_excluded").when(size > most, "package_too_large")
    return j.select("file_id", F.when(reason.isNull(), F.col("variant")).alias("variant"), F.when(reason.isNull(), size).alias("files"), reason.alias("reason"))


# What is no bracket of code in Go: comments and literals, open ones too.
_NO_CODE = r"""(?s)//[^\n]*|/\*.*?(?:\*/|\z)|"(?:[^"\\\n]|\\.)*(?:"|\n|\z)|`[^`]*(?:`|\z)|'(?:[^'\\\n]|\\.)*(?:'|\n|\z)"""


def open_brackets(prefix: Column) -> Column:
    """The brackets that close what a text leaves open, the innermost first."""
    signs = F.regexp_replace(F.regexp_replace(prefix, _NO_CODE, " "), r"[^(){}\[\]]", "")
    push = lambda c: F.when(c == "(", ")").when(c == "[", "]").otherwise("}")
    step = lambda acc, c: F.when(c.isin("(", "[", "{"), F.concat(push(c), acc)).when(c == "", acc).otherwise(F.substr(acc, F.lit(2)))
    return F.aggregate(F.split(signs, ""), F.lit(""), step)


def snapshot(before: Column, after: Column, policy: str) -> Column:
    """The text of a file without the target: what stands before and after it, or (``strict_prefix``) what stands before it and a line for each bracket left open."""
    if policy == "editor_snapshot":
        return F.concat(before, after)
    return F.concat(before, F.lit("\n"), F.regexp_replace(open_brackets(before), "(.)", "$1\n"))
