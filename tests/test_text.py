import re

import duckdb
import pytest
from pyspark.sql import functions as F

from caretlake.functions import hashing, regexes, text


@pytest.mark.parametrize(
    "glob, path, hit",
    [
        ("**/*.go", "a.go", True), ("**/*.go", "x/y/a.go", True), ("*.go", "x/a.go", False), ("vendor/**", "vendor/a/b.go", True), ("vendor/**", "vendor", False),
        ("**/vendor/**", "a/vendor/b.go", True), ("**/vendor/**", "vendored/b.go", False), ("a?c/*.go", "abc/x.go", True), ("a?c/*.go", "a/c/x.go", False), ("**/*.pb.go", "xpb.go", False),
    ],
)
def test_globs(glob, path, hit):
    assert bool(re.search(regexes.glob_to_regex(glob), path)) is hit


def test_word_boundaries_are_ascii_as_in_the_sql_engine(spark):
    words = ["épassword", "password", "xpassword", "password1", "a password.", "passwordé", "tail\n", "a\x0bb"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for p in (r"\bpassword\b", r"^tail$", r"a\sb", r"p[\w]+d", r"[^\s]ail"):
        got = {r["w"] for r in df.where(F.col("w").rlike(regexes.re2_to_java(p))).collect()}
        want = {w for w in words if duckdb.execute("SELECT regexp_matches(?, ?)", [w, p]).fetchone()[0]}
        assert got == want, p


def test_uniform_and_ids(spark):
    import hashlib

    r = spark.range(1).select(hashing.uniform(F.lit("1"), F.lit("b")).alias("u"), hashing.stable_id(F.lit("1"), F.lit("b")).alias("i")).first()
    h = hashlib.sha256(b"1\x1fb").hexdigest()
    assert r["u"] == (int(h[:14], 16) >> 3) / 2**53 and r["i"] == h[:32]


def test_offsets_round_trip_at_every_character():
    s = "a😀é \r\nb\tc"
    units = 0
    for k, c in enumerate(s):
        assert text.byte_of_utf16(s, units) == len(s[:k].encode())
        if ord(c) > 0xFFFF:
            assert text.byte_of_utf16(s, units + 1) is None
        units += len(c.encode("utf-16-le")) // 2
    assert text.byte_of_utf16(s, units) == len(s.encode()) and text.byte_of_utf16(s, units + 1) is None and text.byte_of_utf16(s, -1) is None


def test_windows_never_cut_a_surrogate_pair(spark):
    df = spark.createDataFrame([("ab😀cd",), ("",), (None,)], "t string")
    for n in range(1, 8):
        a, b = df.select(text.last_units(F.col("t"), n).alias("l"), text.first_units(F.col("t"), n).alias("f")).first()
        s = "ab😀cd"
        want_l = next(s[k:] for k in range(len(s) + 1) if len(s[k:].encode("utf-16-le")) // 2 <= n)
        want_f = next(s[:k] for k in range(len(s), -1, -1) if len(s[:k].encode("utf-16-le")) // 2 <= n)
        assert (a, b) == (want_l, want_f)


def test_line_table(spark):
    df = spark.createDataFrame([(1, "a\r\n😀é\n"), (2, ""), (3, None), (4, "x\ry\n\n")], "id bigint, t string")
    rows = {(r["id"], r["line"]): (r["start"], r["bytes"], r["u16_start"], r["content"], r["eol"]) for r in text.line_table(df, "id", "t").collect()}
    assert rows == {
        (1, 0): (0, 1, 0, "a", "CRLF"), (1, 1): (3, 6, 3, "😀é", "LF"), (1, 2): (10, 0, 7, "", "EOF"), (2, 0): (0, 0, 0, "", "EOF"),
        (4, 0): (0, 3, 0, "x\ry", "LF"), (4, 1): (4, 0, 4, "", "LF"), (4, 2): (5, 0, 5, "", "EOF"),
    }


def test_newline_style(spark):
    df = spark.createDataFrame([("a",), ("a\nb",), ("a\r\nb",), ("a\r\nb\n",)], "t string")
    assert [r[0] for r in df.select(text.newline_style(F.col("t"))).collect()] == ["none", "lf", "crlf", "mixed"]
