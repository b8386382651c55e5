"""Checks of produced records: boolean columns, counted in one aggregate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretlake.functions.hashing import stable_id
from caretlake.functions.text import first_units, last_units, utf16_len
from caretlake.operators.golexer import WEIGHTS

EOL = {"LF": "\n", "CRLF": "\r\n", "EOF": ""}
FLAGS = "trivial_target target_starts_with_whitespace target_starts_with_closer trailing_whitespace target_has_comment file_has_syntax_errors non_ascii_target".split()
STATUSES = "resolved partially_resolved syntax_fallback failed".split()


def field_checks() -> dict[str, Column]:
    """Checks of a sample row alone."""
    c = F.col
    return {
        "schema_version": c("schema_version").rlike(r"sample/v1\z"),
        "language": c("language") == "go",
        "sample_id_format": c("sample_id").rlike(r"\A[0-9a-f]{32}\z"),
        "source_sha256_format": c("source_sha256").rlike(r"\A[0-9a-f]{64}\z"),
        "config_sha256_format": c("config_sha256").rlike(r"\A[0-9a-f]{64}\z"),
        "revision_format": c("revision").isNull() | c("revision").rlike(r"\A[0-9a-f]{40}\z"),
        "caret_kind": c("caret_kind").isin(*sorted(WEIGHTS)),
        "end_of_line": c("end_of_line").isin(*EOL),
        "split": c("split").isin("train", "validation", "test"),
        "quality_flags": ~F.exists("quality_flags", lambda x: ~x.isin(*FLAGS)),
        "target_not_empty": F.length("target_text") > 0,
        "target_one_line": ~c("target_text").rlike("[\r\n ]"),
        "target_not_padded": ~c("target_text").rlike("[ \t\x0b\x0c]\\z"),
        "target_size": utf16_len(c("target_text")) == c("target_end_utf16_offset") - c("caret_utf16_offset"),
        "column": c("caret_utf16_offset") - c("line_start_utf16_offset") == c("caret_column_utf16_zero_based"),
        "column_bytes": c("caret_byte_offset") - c("line_start_byte_offset") == c("caret_column_byte_zero_based"),
        "left_size": utf16_len(c("left_context")) == c("caret_utf16_offset") - c("left_context_start_utf16_offset"),
        "indentation": F.regexp_extract(F.substring_index("left_context", "\n", -1), "\\A[ \t\x0b\x0c]*", 0).startswith(c("indentation")) | c("indentation").isNull(),
        "sample_id": c("sample_id") == expected_id(),
    }


def expected_id() -> Column:
    parts = ["repository_id", "relative_path", "source_sha256", "caret_utf16_offset", "target_end_utf16_offset"]
    return stable_id(*[F.col(p).cast("string") for p in parts])


def report(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(check, rows, failed): every check over every row in one pass; a check that is null has failed."""
    sums = df.agg(F.count("*").alias("rows"), *[F.sum((~F.coalesce(v, F.lit(False))).cast("bigint")).alias(k) for k, v in checks.items()])
    cells = F.array(*[F.struct(F.lit(k).alias("check"), F.col("rows"), F.coalesce(F.col(k), F.lit(0)).alias("failed")) for k in checks])
    return sums.select(F.explode(cells).alias("x")).select("x.check", "x.rows", "x.failed")


def with_bom(files: DataFrame) -> DataFrame:
    """``files`` with ``bom``: the bytes before the content, by ``has_bom`` where it stands."""
    return files.withColumn("bom", F.when(F.col("has_bom"), 3).otherwise(0) if "has_bom" in files.columns else F.lit(0))


def reconstructed(samples: DataFrame, files: DataFrame) -> DataFrame:
    """Samples joined to the file they were cut from, with what its bytes say: target, left and right context.

    ``files`` has repository_id, relative_path, content and bom (bytes before the content). Only the needed columns move.
    A sample whose file is missing or has no content keeps its row; ``raw`` and what its file says are null, so that every check fails.
    """
    f = files.select("repository_id", "relative_path", F.col("content").cast("binary").alias("raw"), F.col("bom").alias("bom"))
    j = samples.join(f, ["repository_id", "relative_path"], "left")
    at = lambda x: (F.col(x) - F.col("bom")).cast("int")
    part = lambda a, b: F.substr(F.col("raw"), a + 1, b - a).cast("string")
    return (
        j.withColumn("file_target", part(at("caret_byte_offset"), at("target_end_byte_offset")))
        .withColumn("file_left", part(at("left_context_start_byte_offset"), at("caret_byte_offset")))
        .withColumn("file_right", part(at("target_end_byte_offset"), at("right_context_end_byte_offset")))
    )


def file_checks() -> dict[str, Column]:
    """Checks of a row of ``reconstructed`` against its file."""
    c, size = F.col, F.octet_length("raw") + F.col("bom")
    before = F.substr("raw", F.lit(1), (c("caret_byte_offset") - c("bom")).cast("int")).cast("string")
    tail = F.substr("raw", (c("target_end_byte_offset") - c("bom") + 1).cast("int")).cast("string")
    head, rest = F.substring_index(before, "\n", -1), F.substring_index(tail, "\n", 1)
    rest = F.when(F.contains(tail, F.lit("\n")), F.regexp_replace(rest, r"\r\z", "")).otherwise(rest)
    whole = F.when(c("bom") == 3, F.concat(F.lit(b"\xef\xbb\xbf"), c("raw"))).otherwise(c("raw"))
    return {
        "source_missing": c("raw").isNotNull(),
        "source_sha256": F.lower(F.trim("source_sha256")) == F.sha2(whole, 256),
        "offset_range": (c("caret_byte_offset") >= c("bom")) & (c("target_end_byte_offset") >= c("caret_byte_offset")) & (c("target_end_byte_offset") <= size),
        "reconstruction": c("file_target") == c("target_text"),
        "utf16_offset": (utf16_len(before) == c("caret_utf16_offset")) & (utf16_len(before) + utf16_len(c("target_text")) == c("target_end_utf16_offset")),
        "line_column": (F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) == c("caret_line_zero_based")) & (c("caret_byte_offset") - F.octet_length(head) == c("line_start_byte_offset"))
        & (F.octet_length(head) == c("caret_column_byte_zero_based")) & (utf16_len(head) == c("caret_column_utf16_zero_based")) & (c("target_end_byte_offset") + F.octet_length(rest) == c("line_end_byte_offset")),
        "blank_after_target": F.trim(rest, F.lit(" \t\x0b\x0c")) == "",
        "left_context": (c("file_left") == c("left_context")) & (c("left_context_truncated") == (c("left_context_start_byte_offset") > c("bom"))) & (c("left_context_start_utf16_offset") == c("caret_utf16_offset") - utf16_len(c("left_context"))),
        "right_context": (c("file_right") == c("right_context")) & (c("right_context_truncated") == (c("right_context_end_byte_offset") < size)) & (c("right_context_end_utf16_offset") == c("target_end_utf16_offset") + utf16_len(c("right_context"))),
    }


def semantic_checks(records: DataFrame, samples: DataFrame) -> DataFrame:
    """(check, rows, failed) of semantic records (sample_id, status, violations): known sample, known status, no violation left."""
    known = samples.select("sample_id", F.lit(True).alias("known")).distinct()
    j = records.join(known, "sample_id", "left")
    return report(j, {"semantic_orphan": F.col("known"), "semantic_status": F.col("status").isin(*STATUSES), "semantic_leakage": F.coalesce(F.size("violations"), F.lit(0)) == 0})


def windows(left: Column, right: Column, before: int, after: int) -> tuple[Column, Column]:
    """Left and right context by UTF-16 budgets, no surrogate pair cut."""
    return last_units(left, before), first_units(right, after)
