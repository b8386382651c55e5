"""The file filter: one ordered cascade of reasons, the first that holds is recorded."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caretlake.functions.regexes import any_of, globs, re2_to_java

# Default patterns of the file filter, in the RE2 dialect.
EXCLUDE = ["**/.git/**", "**/node_modules/**"]
TESTDATA = ["testdata/**", "**/testdata/**"]
VENDORED = ["vendor/**", "**/vendor/**", "**/third_party/**", "**/third-party/**", "**/_vendor/**"]
GENERATED = ["**/*.pb.go", "**/*.pb.gw.go", "**/*.pb.validate.go", "**/*_gen.go", "**/*.gen.go", "**/zz_generated*.go", "**/*_generated.go", "**/bindata.go"]
TESTS = ["**/*_test.go"]
MARKERS = [
    r"(?i)\b(auto-?generated|code generated|generated by)\b[^\n]{0,120}\bdo not (edit|modify)\b",
    r"(?i)\bdo not (edit|modify)\b[^\n]{0,120}\b(auto-?generated|generated)\b",
]
SECRETS = [
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"\bAKIA[0-9A-Z]{16}\b", r"\bgh[pousr]_[A-Za-z0-9]{36,}\b", r"\bgithub_pat_[A-Za-z0-9_]{60,}\b",
    r"\bxox[baprs]-[A-Za-z0-9-]{10,}", r"\bsk_live_[0-9a-zA-Z]{24,}\b", r"\bAIza[0-9A-Za-z_-]{35}\b", r"(?i)AccountKey=[A-Za-z0-9+/=]{20,}",
    r"\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
]
LINE_SECRET = r"""(?i)\b\w*(password|passwd|pwd|secret|apikey|api_key|accesstoken|access_token|authtoken|auth_token)\w*"?\s*(:=|=|:)\s*["`]([^"`\s{}%$]{8,})["`]"""
ALLOWED = ["MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "Unlicense", "ISC", "Zlib"]


#: Comments and blanks that may stand before a package clause, in Java's dialect; possessive, so that long headers need no stack.
HEAD = r"\A(?:[ \t\r\n]|//[^\n]*\n|/\*(?:[^*]|\*(?!/))*+\*/)*+"
PACKAGE = HEAD + r"package[ \t]+([\p{L}_][\p{L}\p{N}_]*)"


@dataclass(frozen=True)
class FilterConfig:
    exclude: list[str] = field(default_factory=lambda: EXCLUDE)
    testdata: list[str] = field(default_factory=lambda: TESTDATA)
    vendored: list[str] = field(default_factory=lambda: VENDORED)
    generated: list[str] = field(default_factory=lambda: GENERATED)
    markers: list[str] = field(default_factory=lambda: MARKERS)
    secrets: list[str] = field(default_factory=lambda: SECRETS)
    allowed: list[str] | None = None
    build_excluded: str = "keep"  # or "skip": files that the build context leaves out are skipped
    max_bytes: int = 1 << 20
    max_line: int = 2000
    marker_bytes: int = 4000


def matches(c: Column, pattern: str) -> Column:
    return c.rlike(re2_to_java(pattern))


def ignored_dir(path: Column) -> Column:
    """A directory (not the file name) that starts with an underscore or a dot."""
    return path.rlike(r"(?:^|/)[_.][^/]*/")


def path_reason(path: Column, size: Column, cfg: FilterConfig) -> Column:
    """Reasons that need no content; they come first, so that a source can skip reading."""
    return (
        F.when(matches(path, globs(cfg.exclude)), "excluded_path").when(ignored_dir(path), "go_ignored_dir").when(matches(path, globs(cfg.testdata)), "testdata_path")
        .when(matches(path, globs(cfg.vendored)), "vendored_path").when(size > cfg.max_bytes, "too_large").when(matches(path, globs(cfg.generated)), "generated_path")
    )


#: What a text must hold for a default pattern to be able to match; the patterns are tried only then.
SECRET_SIGNS = ["PRIVATE KEY-----", "AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "xox", "sk_live_", "AIza", "eyJ"]


def _may_hold(c: Column, signs: list[str]) -> Column:
    out = F.lit(False)
    for s in signs:
        out = out | c.contains(s)
    return out


def body_of(raw: Column) -> Column:
    """The text of a file without byte order mark; null if it is not UTF-8."""
    text = F.when(F.is_valid_utf8(raw.cast("string")), raw.cast("string"))
    return F.when(text.startswith("\ufeff"), F.substring(text, 2, 2**31 - 1)).otherwise(text)


def content_reason(raw: Column, body: Column, cfg: FilterConfig, licence: Column | None = None, build_match: Column | None = None) -> Column:
    """Reasons of the bytes of a file and its text (``body_of``), in order, after those of its path."""
    head = F.hex(F.substring(raw, 1, 2))
    longest = F.array_max(F.transform(F.split(body, "\n", -1), lambda x: F.octet_length(x) - F.when(x.endswith("\r"), 1).otherwise(0)))
    comments = F.regexp_extract(body, r"^((?:[ \t\r\n]|//[^\n]*\n|/\*(?:[^*]|\*(?!/))*+\*/)*+)package[ \t]", 1)
    strict = matches(F.concat(F.lit("\n"), comments), r"\n// Code generated [^\n]* DO NOT EDIT\.\r?\n")
    first = F.substring(raw, 1, cfg.marker_bytes).cast("string")
    first = F.when(F.is_valid_utf8(first), first).otherwise(F.substring(body, 1, cfg.marker_bytes))
    marked = strict | matches(first, any_of(cfg.markers))
    secret = matches(body, any_of(cfg.secrets))
    if cfg.markers == MARKERS:
        marked = F.contains(F.lower(body), F.lit("generated")) & marked
    if cfg.secrets == SECRETS:
        secret = (_may_hold(body, SECRET_SIGNS) | F.contains(F.lower(body), F.lit("accountkey="))) & secret
    out = (
        F.when(head.isin("FFFE", "FEFF"), "utf16_encoding")
        .when(F.contains(raw, F.lit(b"\x00")), "binary_nul").when(body.isNull(), "invalid_utf8")
        .when(body.contains("\r") & body.rlike(r"\r(?!\n|\z)|\r\r\n"), "lone_cr").when(~body.rlike(r"[^\s\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"), "empty")
        .when(~body.rlike(PACKAGE), "invalid_package_clause")
        .when(marked, "generated_marker")
    )
    if cfg.build_excluded == "skip" and build_match is not None:
        out = out.when(~F.coalesce(build_match, F.lit(True)), "build_excluded")
    out = out.when(longest > cfg.max_line, "long_lines")
    if cfg.allowed is not None and licence is not None:
        out = out.when(~F.coalesce(licence.isin(cfg.allowed), F.lit(False)), "license_not_allowed")
    return out.when(secret, "secret_detected")


def secret_detail(text: Column, patterns: list[str] = SECRETS) -> Column:
    """The first pattern that a text matches."""
    out = F.lit(None).cast("string")
    for p in reversed(patterns):
        out = F.when(matches(text, p), p).otherwise(out)
    return out


def decide(files: DataFrame, cfg: FilterConfig = FilterConfig(), repo: str = "repository_id", path: str = "relative_path", content: str = "content", licence: str | None = None, facts: bool = False) -> DataFrame:
    """``files`` with accepted, skip_reason, detail, duplicate_of, is_test and sha256; ``content`` is dropped.

    ``facts`` adds project, package_name, build_constraint, build_match and cgo; so does the setting that skips files
    which the build leaves out. ``detail`` is the pattern of a credential. One row per repository and path is expected then.

    Among the files of a repository that have no other reason, all but the first path of equal content are exact
    duplicates of it. Only hashes travel to that window, never contents. A null content is ``unreadable``.
    """
    made = ["project", "package_name", "build_constraint", "build_match", "cgo"] if facts or cfg.build_excluded == "skip" else []
    keep = [c for c in files.columns if c not in (content, "sha256", "bytes", "detail", *made)]
    d = files.select(*keep, F.col(content).cast("binary").alias("raw_"))
    if made:
        from caretlake.operators.gofiles import file_facts

        texts = files.select(F.col(repo).alias("r_"), F.col(path).alias("relative_path"), body_of(F.col(content).cast("binary")).alias("content"))
        told = file_facts(texts, keys=("r_", "relative_path")).withColumnRenamed("relative_path", "p_").drop("is_test")
        d = d.join(told, F.col(repo).eqNullSafe(F.col("r_")) & F.col(path).eqNullSafe(F.col("p_")), "left").drop("r_", "p_")
        keep += made
    raw = F.col("raw_")
    d = d.withColumn("path_", F.when(raw.isNull(), "unreadable").otherwise(path_reason(F.col(path), F.octet_length(raw), cfg)))
    d = d.withColumn("body_", F.when(F.col("path_").isNull(), body_of(raw)))  # its own column, so that it is made once
    held = F.when(F.col("path_").isNull(), content_reason(raw, F.col("body_"), cfg, F.col(licence) if licence else None, F.col("build_match") if made else None))
    d = d.withColumn("reason_", F.coalesce("path_", held))
    detail = F.when(F.col("reason_") == "secret_detected", secret_detail(F.col("body_"), cfg.secrets))
    d = d.select(*keep, "reason_", detail.alias("detail"), F.sha2(raw, 256).alias("sha256_"), F.octet_length(raw).alias("bytes_"))
    live = F.when(F.col("reason_").isNull(), F.col("sha256_"))
    w = Window.partitionBy(repo, live).orderBy(path)
    d = d.withColumn("first_", F.when(live.isNotNull(), F.first(path).over(w)))
    copy = F.col("first_").isNotNull() & (F.col("first_") != F.col(path))
    out = d.withColumn("skip_reason", F.when(copy, "exact_duplicate").otherwise(F.col("reason_"))).withColumn("duplicate_of", F.when(copy, F.col("first_")))
    return out.withColumn("accepted", F.col("skip_reason").isNull()).withColumn("is_test", matches(F.col(path), globs(TESTS))).withColumnRenamed("sha256_", "sha256").withColumnRenamed("bytes_", "bytes").drop("reason_", "first_")


def funnel(decided: DataFrame) -> DataFrame:
    """(counter, value): discovered and accepted files, accepted ones per flag, bytes in and accepted, skipped files per reason.

    Flags that ``decided`` does not have are not counted.
    """
    one = F.lit(1).cast("bigint")
    ok = F.col("accepted")
    cell = lambda name, v: F.struct((F.lit(name) if isinstance(name, str) else name).alias("c"), v.cast("bigint").alias("v"))
    cells = [cell("files.discovered", one), cell("bytes.discovered", F.coalesce("bytes", F.lit(0))), F.when(ok, cell("files.accepted", one)), F.when(ok & F.col("is_test"), cell("files.accepted_test", one)), F.when(ok, cell("bytes.accepted", F.col("bytes")))]
    if "cgo" in decided.columns:
        cells += [F.when(ok & F.col("cgo"), cell("files.accepted_cgo", one)), F.when(ok & ~F.col("build_match"), cell("files.accepted_build_excluded", one))]
    cells.append(F.when(~ok, cell(F.concat(F.lit("files.skipped."), "skip_reason"), one)))
    rows = F.filter(F.array(*cells), lambda x: x.isNotNull())
    return decided.select(F.explode(rows).alias("x")).groupBy(F.col("x.c").alias("counter")).agg(F.sum("x.v").alias("value"))
