"""Queries of the dataset-building operators over the whole tables, each with SQL that says the same.

The tables hold produced records: corpus_files and discovery_files are files, samples are carets, jobs are repositories,
documents stand in for repository descriptions where names and descriptions are compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretlake.functions.hashing import stable_id, uniform
from caretlake.functions.regexes import any_of, globs, re2_to_java
from caretlake.functions.text import first_units, last_units, line_table, newline_style, rtrim_hspace, slug, utf16_len
from caretlake.operators import discovery as D
from caretlake.operators import extract, gofiles, rendering, repolicence, reports, sampling, selection, semantics, validation
from caretlake.operators.golexer import WEIGHTS, caret_table
from caretlake.operators.hashes import clean_hash
from caretlake.session import table
from caretlake.sources import records

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_U = "(CAST(('0x' || substr(sha256({0}), 1, 14)) AS UBIGINT) >> 3) / 9007199254740992.0"
_SEP = "chr(31)"


def usql(*parts: str) -> str:
    return _U.format(f" || {_SEP} || ".join(parts))


# ---- files ----------------------------------------------------------------------------------------------------------

_PATHS = f"""
CASE WHEN regexp_matches(p, {lit(globs(D.EXCLUDE))}) THEN 'excluded_path' WHEN regexp_matches(p, '(?:^|/)[_.][^/]*/') THEN 'go_ignored_dir'
 WHEN regexp_matches(p, {lit(globs(D.TESTDATA))}) THEN 'testdata_path' WHEN regexp_matches(p, {lit(globs(D.VENDORED))}) THEN 'vendored_path'
 WHEN n > 1048576 THEN 'too_large' WHEN regexp_matches(p, {lit(globs(D.GENERATED))}) THEN 'generated_path' END"""
_DECIDED = f"""
f AS (SELECT file_id, repository_id, relative_path AS p, content AS c, octet_length(encode(content)) AS n FROM corpus_files),
r AS (SELECT *, CASE WHEN c IS NULL THEN 'unreadable' ELSE coalesce({_PATHS}, CASE
  WHEN contains(c, chr(0)) THEN 'binary_nul'
  WHEN len(list_filter(string_split(c, chr(10)), lambda x: contains(regexp_replace(x, '\\r$', ''), chr(13)))) > 0 THEN 'lone_cr'
  WHEN trim(c, chr(10) || chr(13) || chr(9) || ' ' || chr(11) || chr(12)) = '' THEN 'empty'
  WHEN NOT regexp_matches(c, '^(?:[ \\t\\r\\n]|//[^\\n]*\\n|/\\*(?:[^*]|\\*+[^*/])*\\*+/)*package[ \\t]+[\\p{{L}}_][\\p{{L}}\\p{{N}}_]*') THEN 'invalid_package_clause'
  WHEN regexp_matches(chr(10) || regexp_extract(c, '^((?:[ \\t\\r\\n]|//[^\\n]*\\n|/\\*(?:[^*]|\\*+[^*/])*\\*+/)*)package[ \\t]', 1), '\\n// Code generated [^\\n]* DO NOT EDIT\\.\\r?\\n')
    OR regexp_matches(left(c, 4000), {lit(any_of(D.MARKERS))}) THEN 'generated_marker'
  WHEN list_max(list_transform(string_split(c, chr(10)), lambda x: octet_length(encode(regexp_replace(x, '\\r$', ''))))) > 2000 THEN 'long_lines'
  WHEN regexp_matches(c, {lit(any_of(D.SECRETS))}) THEN 'secret_detected' END) END AS why FROM f),
x AS (SELECT *, first_value(p) OVER (PARTITION BY repository_id, CASE WHEN why IS NULL THEN sha256(c) END ORDER BY p) AS firstp FROM r),
d AS (SELECT file_id, repository_id, p, n, c, CASE WHEN why IS NULL AND firstp <> p THEN 'exact_duplicate' ELSE why END AS skip_reason,
  CASE WHEN why IS NULL AND firstp <> p THEN firstp END AS duplicate_of, regexp_matches(p, {lit(globs(D.TESTS))}) AS is_test FROM x)
"""


def _decided(spark: SparkSession, d: str) -> DataFrame:
    return D.decide(table(spark, d, "corpus_files").select("file_id", "repository_id", "relative_path", "content"))


@query(f"WITH {_DECIDED} SELECT file_id, skip_reason, duplicate_of, is_test FROM d")
def discovery_records(spark, d):
    return _decided(spark, d).select("file_id", "skip_reason", "duplicate_of", "is_test")


@query(f"""WITH {_DECIDED} SELECT counter, CAST(sum(v) AS BIGINT) AS value FROM (
 SELECT 'files.discovered' AS counter, 1 AS v FROM d UNION ALL SELECT 'files.accepted', 1 FROM d WHERE skip_reason IS NULL
 UNION ALL SELECT 'files.accepted_test', 1 FROM d WHERE skip_reason IS NULL AND is_test UNION ALL SELECT 'bytes.accepted', n FROM d WHERE skip_reason IS NULL UNION ALL SELECT 'bytes.discovered', coalesce(n, 0) FROM d
 UNION ALL SELECT 'files.skipped.' || skip_reason, 1 FROM d WHERE skip_reason IS NOT NULL) GROUP BY counter""")
def discovery_funnel(spark, d):
    return D.funnel(_decided(spark, d))


@query(f"""SELECT repository_id, relative_path, {_PATHS} AS reason FROM (SELECT DISTINCT repository_id, relative_path, relative_path AS p, bytes AS n FROM discovery_files)""")
def path_reasons(spark, d):
    f = table(spark, d, "discovery_files").select("repository_id", "relative_path", "bytes").distinct()
    return f.select("repository_id", "relative_path", D.path_reason(F.col("relative_path"), F.col("bytes"), D.FilterConfig()).alias("reason"))


@query(f"SELECT file_id FROM corpus_files WHERE regexp_matches(content, {lit(any_of(D.MARKERS))})")
def generated_marker_scan(spark, d):
    return table(spark, d, "corpus_files").where(D.matches(F.col("content"), any_of(D.MARKERS))).select("file_id")


_DETAIL = "CASE " + " ".join(f"WHEN regexp_matches(content, {lit(p)}) THEN {lit(p)}" for p in D.SECRETS) + " END"


@query(f"SELECT file_id, {_DETAIL} AS detail FROM corpus_files WHERE {_DETAIL} IS NOT NULL")
def secret_scan(spark, d):
    return table(spark, d, "corpus_files").select("file_id", D.secret_detail(F.col("content")).alias("detail")).where("detail IS NOT NULL")


_LINES = "l AS (SELECT file_id, CAST(i - 1 AS INTEGER) AS line, regexp_replace(parts[i], '\\r$', '') AS content FROM (SELECT file_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT file_id, string_split(content, chr(10)) AS parts FROM corpus_files WHERE content IS NOT NULL)))"


@query(f"""WITH {_LINES} SELECT file_id, line FROM l WHERE len(list_filter(regexp_extract_all(content, {lit(D.LINE_SECRET)}, 3), lambda v: NOT regexp_full_match(v, '[A-Z0-9_]*'))) > 0""")
def secret_lines(spark, d):
    lines = line_table(table(spark, d, "corpus_files"), "file_id", "content")
    values = F.regexp_extract_all("content", F.lit(re2_to_java(D.LINE_SECRET)), F.lit(3))
    return lines.where(F.exists(values, lambda v: ~v.rlike(r"\A[A-Z0-9_]*\z"))).select("file_id", "line")


@query("""WITH p AS (SELECT file_id, string_split(content, chr(10)) AS parts FROM corpus_files WHERE content IS NOT NULL),
q AS (SELECT file_id, len(parts) AS m, unnest(range(1, len(parts) + 1)) AS i, parts[i] AS t FROM p),
z AS (SELECT file_id, m, i, t, regexp_replace(t, '\\r$', '') AS body, octet_length(encode(t)) + 1 AS b, length(t) + length(regexp_replace(t, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) + 1 AS u FROM q)
SELECT file_id, CAST(i - 1 AS INTEGER) AS line, CAST(sum(b) OVER w - b AS BIGINT) AS start, CAST(octet_length(encode(CASE WHEN i < m THEN body ELSE t END)) AS INTEGER) AS bytes, CAST(sum(u) OVER w - u AS BIGINT) AS u16_start,
 CASE WHEN i = m THEN 'EOF' WHEN body <> t THEN 'CRLF' ELSE 'LF' END AS eol FROM z WINDOW w AS (PARTITION BY file_id ORDER BY i)""")
def lines(spark, d):
    return line_table(table(spark, d, "corpus_files"), "file_id", "content").drop("content")


@query("""SELECT file_id, CASE WHEN lf = 0 THEN 'none' WHEN crlf = 0 THEN 'lf' WHEN crlf = lf THEN 'crlf' ELSE 'mixed' END AS newline_style, u16, CAST(lf + 1 AS BIGINT) AS lines, slug FROM (
 SELECT file_id, length(content) - length(replace(content, chr(10), '')) AS lf, (length(content) - length(replace(content, chr(13) || chr(10), ''))) // 2 AS crlf,
 CAST(length(content) + length(regexp_replace(content, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) AS INTEGER) AS u16, regexp_replace(relative_path, '[^A-Za-z0-9_.-]+', '__', 'g') AS slug FROM corpus_files WHERE content IS NOT NULL)""")
def newline_and_size_profile(spark, d):
    c = F.col("content")
    count = (F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1).cast("bigint")
    return table(spark, d, "corpus_files").where("content IS NOT NULL").select("file_id", newline_style(c).alias("newline_style"), utf16_len(c).alias("u16"), count.alias("lines"), slug(F.col("relative_path")).alias("slug"))


_SIGSQL = "CASE " + " ".join("WHEN " + " AND ".join([f"regexp_matches(t, {lit(p)})" for p in a] + [f"NOT regexp_matches(t, {lit(p)})" for p in n]) + f" THEN {lit(k)}" for k, a, n in repolicence.SIGNATURES) + " END"
_DETECT = f"""b AS (SELECT repository_id, file_name, trim(regexp_replace(body, '\\s+', ' ', 'g')) AS t FROM license_files WHERE regexp_matches(lower(file_name), '^(license|licence|copying)') AND octet_length(encode(body)) <= 262144),
s AS (SELECT repository_id, file_name, {_SIGSQL} AS spdx FROM b),
g AS (SELECT repository_id, file_name, spdx FROM (SELECT *, row_number() OVER (PARTITION BY repository_id ORDER BY file_name) AS k FROM s WHERE spdx IS NOT NULL) WHERE k = 1)"""


def _detected(spark, d):
    return repolicence.detect(table(spark, d, "license_files"))


@query(f"WITH {_DETECT} SELECT repository_id, file_name, spdx FROM g")
def licence_detect(spark, d):
    return _detected(spark, d)


_ALLOW = ", ".join(map(lit, D.ALLOWED))


@query(f"""WITH {_DETECT},
j AS (SELECT repo_id, max(license) AS declared FROM jobs GROUP BY repo_id),
v AS (SELECT repo_id, nullif(declared, '') AS declared, spdx, file_name FROM j LEFT JOIN g ON g.repository_id = j.repo_id),
w AS (SELECT repo_id, coalesce(spdx, declared) AS licence, CASE WHEN spdx IS NOT NULL AND declared IS NOT NULL AND lower(spdx) <> lower(declared) THEN 'license_conflict: declared ' || declared || ', detected ' || spdx || ' in ' || file_name
 WHEN spdx IS NOT NULL THEN 'detected:' || file_name WHEN declared IS NOT NULL THEN 'declared_only' ELSE 'license_unknown' END AS reason FROM v)
SELECT repo_id, licence, CASE WHEN reason LIKE 'license\\_%' ESCAPE '\\' OR licence IN ({_ALLOW}) THEN reason ELSE reason || ' (not allowlisted)' END AS reason, NOT reason LIKE 'license\\_%' ESCAPE '\\' AND coalesce(licence IN ({_ALLOW}), false) AS allowed FROM w""")
def licence_gate(spark, d):
    declared = table(spark, d, "jobs").groupBy(F.col("repo_id").alias("repository_id")).agg(F.max("license").alias("declared"))
    return repolicence.gate(declared, _detected(spark, d), D.ALLOWED).withColumnRenamed("repository_id", "repo_id")


_RESTR = " OR ".join(f"starts_with(license, {lit(p)})" for p in selection.RESTRICTED)


@query(f"""SELECT CASE WHEN license IN ({', '.join(map(lit, selection.PERMISSIVE))}) THEN 'permissive' WHEN {_RESTR} THEN 'restricted' ELSE 'unknown' END AS bucket, count(*) AS rows FROM jobs GROUP BY 1""")
def licence_buckets(spark, d):
    return reports.count_by(table(spark, d, "jobs"), selection.licence_bucket(F.col("license")).alias("bucket"))


# ---- lines and carets -----------------------------------------------------------------------------------------------

# A lexer in SQL, independent of the one in Python: comments, literals, words and single other signs, with where each starts.
_TOKENS = r"""tk AS (SELECT file_id, unnest(regexp_extract_all(content, '(?s)//[^\n]*|/\*.*?\*/|"(?:[^"\\\n]|\\.)*"|''(?:[^''\\\n]|\\.)*''|`[^`]*`|[\pL_][\pL\p{Nd}_]*|.')) AS t, generate_subscripts(regexp_extract_all(content, '(?s)//[^\n]*|/\*.*?\*/|"(?:[^"\\\n]|\\.)*"|''(?:[^''\\\n]|\\.)*''|`[^`]*`|[\pL_][\pL\p{Nd}_]*|.'), 1) AS i FROM corpus_files WHERE content IS NOT NULL),
tl AS (SELECT file_id, t, i, nl, CAST(coalesce(sum(nl) OVER w, 0) AS INTEGER) AS line, CAST(coalesce(sum(octet_length(encode(t))) OVER w, 0) AS BIGINT) AS o,
  CASE WHEN starts_with(t, '//') OR starts_with(t, '/*') THEN 'comment' WHEN starts_with(t, '`') THEN 'raw' WHEN trim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN 'space' ELSE 'code' END AS k
  FROM (SELECT *, length(t) - length(replace(t, chr(10), '')) AS nl FROM tk) WINDOW w AS (PARTITION BY file_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cv AS (SELECT file_id, line, max(k) AS k FROM (SELECT file_id, CAST(unnest(range(line + 1, line + nl + 1)) AS INTEGER) AS line, k FROM tl WHERE k IN ('raw', 'comment') AND nl > 0) GROUP BY ALL),
cl AS (SELECT file_id, line, min(o) AS first FROM tl WHERE k IN ('code', 'raw') GROUP BY ALL)"""
_WHY = """CASE WHEN cv.k = 'raw' THEN 'inside_raw_string' WHEN cv.k = 'comment' THEN 'inside_block_comment' WHEN trim(content, ' ' || chr(9) || chr(11) || chr(12)) = '' THEN 'blank'
 WHEN cl.first IS NULL AND (starts_with(t, '//go:build') OR starts_with(t, '// +build')) THEN 'build_constraint'
 WHEN cl.first IS NULL AND (starts_with(t, '//go:') OR starts_with(t, '//line ') OR starts_with(t, '//export ') OR starts_with(t, '//nolint')) THEN 'directive'
 WHEN cl.first IS NULL THEN 'comment'
 WHEN length(content) + length(regexp_replace(content, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) > 240 THEN 'too_long' END"""
_EXCL = f"{_LINES}, {_TOKENS}, e AS (SELECT l.file_id, l.line, content, cl.first, {_WHY} AS reason FROM (SELECT *, ltrim(content, ' ' || chr(9) || chr(11) || chr(12)) AS t FROM l) l LEFT JOIN cv USING (file_id, line) LEFT JOIN cl USING (file_id, line))"


@query(f"WITH {_EXCL} SELECT reason, count(*) AS rows FROM e WHERE reason IS NOT NULL GROUP BY reason")
def line_exclusions(spark, d):
    """Lines at which no caret may stand, by reason."""
    return reports.count_by(caret_table(table(spark, d, "corpus_files")).where("kind = 'line'"), "reason")


@query(f"WITH {_EXCL} SELECT file_id, 'line:' || reason AS reason, line AS line_zero_based, content AS line_text FROM (SELECT *, row_number() OVER (PARTITION BY file_id, reason ORDER BY line) AS k FROM e WHERE reason IS NOT NULL) WHERE k <= 25")
def exclusion_examples(spark, d):
    """At most 25 examples of a line's reason in a file: the feature itself."""
    return extract.exclusions(table(spark, d, "corpus_files")).where("caret_kind = ''").select("file_id", "reason", "line_zero_based", "line_text")


@query()
def caret_exclusions(spark, d):
    """At most 25 examples of a caret's reason in a file: the feature itself."""
    return extract.exclusions(table(spark, d, "corpus_files")).where("caret_kind <> ''").select("file_id", "reason", "line_zero_based", "byte_offset", "caret_kind", "line_text")


@query(f"WITH {_EXCL} SELECT file_id, line, first AS byte_offset FROM e WHERE reason IS NULL")
def line_start_carets(spark, d):
    """The first caret of each line of code, whatever its kind."""
    t = caret_table(table(spark, d, "corpus_files")).where("kind NOT IN ('line', 'probe')")
    return t.groupBy("file_id", "line").agg(F.min("byte_offset").alias("byte_offset"))


@query()
def caret_candidates(spark, d):
    """Carets of the Go lexer: candidates per kind and reason."""
    return reports.count_by(caret_table(table(spark, d, "corpus_files")), "kind", "reason")


@query()
def extracted_samples(spark, d):
    """The whole chain from files to sample records."""
    return extract.samples(table(spark, d, "corpus_files"), columns=["sample_id", "repository_id", "relative_path", "caret_byte_offset", "caret_kind", "caret_subkind", "target_text"])


@query()
def extracted_checks(spark, d):
    """Every record of the chain held against its file again: no check may fail."""
    files = table(spark, d, "corpus_files")
    again = validation.reconstructed(extract.samples(files), validation.with_bom(files))
    return validation.report(again, validation.field_checks() | validation.file_checks())


@query(r"""WITH b AS (SELECT file_id, unnest(regexp_extract_all(content, '(?ms)^import \(.*?^\)|^import [^(\n]*$')) AS b FROM corpus_files),
i AS (SELECT file_id, unnest(regexp_extract_all(b, '"([^"\n]+)"', 1)) AS path FROM b),
s AS (SELECT DISTINCT file_id, path, string_split(path, '/') AS parts FROM i)
SELECT file_id, path, replace(regexp_replace(string_split(CASE WHEN len(parts) > 1 AND regexp_full_match(parts[-1], 'v[0-9]+') THEN parts[-2] ELSE parts[-1] END, '.')[1], '^go-', ''), '-', '_') AS name FROM s""")
def import_names(spark, d):
    """The local name by which a Go import is used, of every import declaration of a file."""
    return gofiles.imports(table(spark, d, "corpus_files"))


@query(r"""SELECT file_id, nullif(regexp_extract(content, '^(?:[ \t\r\n]|//[^\n]*\n|/\*(?:[^*]|\*+[^*/])*\*+/)*package[ \t]+([\p{L}_][\p{L}\p{N}_]*)', 1), '') AS package_name, CASE WHEN contains(relative_path, '/') THEN regexp_replace(relative_path, '/[^/]*$', '') ELSE '.' END AS project,
nullif(regexp_extract(string_split(content, chr(10) || 'package ')[1], '(?m)^(//go:build [^\r\n]*)', 1), '') AS build_constraint, coalesce(regexp_matches(content, '(?m)^[ \t]*(?:import[ \t]+)?"C"[ \t]*\r?$'), false) AS cgo,
regexp_matches(relative_path, '^(?:[^/]+/)*[^/]*_test\.go$') AS is_test FROM corpus_files""")
def file_facts(spark, d):
    """Package, project, build constraint, cgo and test of every file (the data has no legacy constraints)."""
    return gofiles.file_facts(table(spark, d, "corpus_files")).drop("build_match")


@query("SELECT repository_id, relative_path, build_constraint, build_match FROM discovery_files WHERE build_match IS NOT NULL")
def build_match(spark, d):
    """Whether the build takes a file, from its recorded constraint, its name and cgo; the SQL reads what was recorded."""
    f = table(spark, d, "discovery_files").where("build_match IS NOT NULL").select("repository_id", "relative_path", "build_constraint", "cgo", gofiles.name_suffix(F.col("relative_path")).alias("suffix"))
    return gofiles.with_build_match(f, cgo_on=True).select("repository_id", "relative_path", "build_constraint", "build_match")


@query("SELECT is_test, build_match, count(*) AS rows FROM corpus_files GROUP BY ALL")
def build_counters(spark, d):
    return reports.count_by(table(spark, d, "corpus_files"), "is_test", "build_match")


@query("SELECT caret_kind, sample_id FROM (SELECT caret_kind, sample_id, row_number() OVER (PARTITION BY caret_kind ORDER BY length(target_text) DESC, sample_id) AS k FROM (SELECT DISTINCT caret_kind, sample_id, target_text FROM samples WHERE NOT is_test)) WHERE k = 1")
def pilot_pick(spark, d):
    """The first of each kind under a condition, by a total order."""
    s = table(spark, d, "samples").where("NOT is_test").select("caret_kind", "sample_id", F.length("target_text").alias("n")).distinct()
    return sampling.cap(s, ["caret_kind"], [F.desc("n"), F.col("sample_id")], 1).select("caret_kind", "sample_id")


# ---- samples --------------------------------------------------------------------------------------------------------


@query(f"SELECT sample_id, extracted_at, {usql('sample_id', lit('x'))} AS u, left(sha256(sample_id || {_SEP} || relative_path), 32) AS id FROM samples")
def uniform_hash(spark, d):
    return table(spark, d, "samples").select("sample_id", "extracted_at", uniform(F.col("sample_id"), F.lit("x")).alias("u"), stable_id(F.col("sample_id"), F.col("relative_path")).alias("id"))


@query(f"SELECT g, CASE WHEN u < 0.02 THEN 'validation' WHEN u < 0.04 THEN 'test' ELSE 'train' END AS split FROM (SELECT g, {usql(lit('20261009'), lit('repo_split'), 'g')} AS u FROM (SELECT DISTINCT lower(trim(grp)) AS g FROM jobs WHERE grp IS NOT NULL))")
def split_assignment(spark, d):
    g = table(spark, d, "jobs").where("grp IS NOT NULL").select(F.lower(F.trim("grp")).alias("g")).distinct()
    return g.select("g", sampling.split_of(F.col("g"), 0.02, 0.02).alias("split"))


_FRACTIONS = """t AS (SELECT repository_id, count(*) AS total, count(*) FILTER (is_test) AS tests FROM samples GROUP BY 1),
a AS (SELECT *, least(1.0::DOUBLE, 40.0::DOUBLE / total) AS k0, total - tests AS rest FROM t),
b AS (SELECT *, tests > 0 AND k0 * tests > 0.35::DOUBLE * k0 * total AS over FROM a),
c AS (SELECT *, CASE WHEN over AND rest > 0 THEN least(1.0::DOUBLE, (0.35::DOUBLE / (1 - 0.35::DOUBLE)) * rest / tests) ELSE 1.0::DOUBLE END AS test_keep FROM b),
k AS (SELECT repository_id, total, tests, test_keep, CASE WHEN over THEN least(1.0::DOUBLE, 40.0::DOUBLE / (rest + tests * test_keep)) ELSE k0 END AS keep FROM c)"""


def _fractions(spark, d):
    t = table(spark, d, "samples").groupBy("repository_id").agg(F.count("*").alias("total"), F.sum(F.col("is_test").cast("bigint")).alias("tests"))
    return sampling.thinning_fractions(t, 40, 0.35)


@query(f"WITH {_FRACTIONS} SELECT repository_id, total, tests, round(test_keep, 9) AS test_keep, round(keep, 9) AS keep FROM k")
def thinning_fractions(spark, d):
    return _fractions(spark, d).select("repository_id", "total", F.coalesce("tests", F.lit(0)).alias("tests"), F.round("test_keep", 9).alias("test_keep"), F.round("keep", 9).alias("keep"))


@query(f"WITH {_FRACTIONS} SELECT s.sample_id, s.extracted_at FROM samples s JOIN k USING (repository_id) WHERE {usql(lit('20261009'), lit('keep'), 's.sample_id')} < keep * CASE WHEN is_test THEN test_keep ELSE 1 END")
def thinned(spark, d):
    j = table(spark, d, "samples").select("sample_id", "repository_id", "is_test", "extracted_at").join(_fractions(spark, d).select("repository_id", "keep", "test_keep"), "repository_id")
    return sampling.thin(j, "sample_id", "is_test", F.col("keep"), F.col("test_keep")).select("sample_id", "extracted_at")


_W = "CASE caret_kind " + " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in WEIGHTS.items()) + " ELSE 0 END"
_SCORED = f"s AS (SELECT sample_id, extracted_at, repository_id, relative_path, caret_line_zero_based AS line, caret_byte_offset AS o, u / w AS score FROM (SELECT *, {usql(lit('20261009'), lit('caret'), 'source_sha256', 'CAST(caret_byte_offset AS VARCHAR)')} AS u, CAST({_W} AS DOUBLE) AS w FROM samples) WHERE w > 0)"


def _scored(spark, d):
    s = table(spark, d, "samples").select("sample_id", "extracted_at", "repository_id", "relative_path", "caret_kind", "source_sha256", F.col("caret_line_zero_based").alias("line"), F.col("caret_byte_offset").alias("o"))
    u = uniform(F.lit(str(sampling.SEED)), F.lit("caret"), F.col("source_sha256"), F.col("o").cast("string"))
    return s.withColumn("w", sampling.weight_of(F.col("caret_kind"), WEIGHTS)).where("w > 0").withColumn("score", u / F.col("w"))


_FILE = ["repository_id", "relative_path"]


@query(f"WITH {_SCORED} SELECT sample_id, extracted_at FROM (SELECT *, row_number() OVER (PARTITION BY repository_id, relative_path, line ORDER BY score, o, sample_id, extracted_at) AS k FROM s) WHERE k <= 1")
def line_cap(spark, d):
    """One sample a line: a cap is the operator."""
    return sampling.cap(_scored(spark, d), [*_FILE, "line"], [F.col(c) for c in ("score", "o", "sample_id", "extracted_at")], 1).select("sample_id", "extracted_at")


@query(f"WITH {_SCORED} SELECT sample_id, extracted_at FROM (SELECT *, row_number() OVER (PARTITION BY repository_id, relative_path ORDER BY score, o, sample_id, extracted_at) AS k FROM s) WHERE k <= 2")
def file_cap(spark, d):
    """Two samples a file: a cap is the operator."""
    return sampling.cap(_scored(spark, d), _FILE, [F.col(c) for c in ("score", "o", "sample_id", "extracted_at")], 2).select("sample_id", "extracted_at")


@query(f"SELECT sample_id FROM (SELECT DISTINCT sample_id, repository_id, relative_path, caret_byte_offset AS o, {usql(lit('20261009'), lit('repo_cap'), 'sample_id')} AS u FROM samples) QUALIFY row_number() OVER (PARTITION BY repository_id ORDER BY u, relative_path, o, sample_id) <= 10")
def repo_cap(spark, d):
    """Ten samples a repository: a cap is the operator."""
    s = table(spark, d, "samples").select("sample_id", "repository_id", "relative_path", "caret_byte_offset").distinct()
    return sampling.repo_cap(s, "repository_id", "sample_id", 10).select("sample_id")


_SP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)"
_KEYED = f"""s AS (SELECT DISTINCT sample_id, repository_id, relative_path, caret_byte_offset AS o, trim(string_split(left_context, chr(10))[-1] || target_text, {_SP}) AS t, octet_length(encode(ltrim(string_split(left_context, chr(10))[-1], ' ' || chr(9) || chr(11) || chr(12)))) AS c FROM samples)"""


@query(f"WITH {_KEYED} SELECT sample_id FROM s QUALIFY row_number() OVER (PARTITION BY repository_id, t, c ORDER BY relative_path, o, sample_id) = 1")
def line_target_dedup(spark, d):
    """The first sample of each trimmed line and caret column of a repository."""
    key = extract.line_key(F.substring_index("left_context", "\n", -1), F.col("target_text"))
    s = table(spark, d, "samples").select("sample_id", "repository_id", "relative_path", F.col("caret_byte_offset").alias("byte_offset"), key.alias("key")).distinct()
    return extract.first_of_lines(s).select("sample_id")


@query("""SELECT counter, count(*) AS value FROM (SELECT 'samples.total' AS counter FROM samples UNION ALL SELECT 'samples.kind.' || caret_kind FROM samples
UNION ALL SELECT 'samples.test_code' FROM samples WHERE is_test UNION ALL SELECT 'samples.flag.' || unnest(quality_flags) FROM samples) GROUP BY counter""")
def sample_counters(spark, d):
    return reports.sample_counters(table(spark, d, "samples"))


_FLAGS = """list_filter([CASE WHEN regexp_full_match(target_text, '[{}()\\[\\];,]*') THEN 'trivial_target' END, CASE WHEN regexp_matches(target_text, '^[ \\t\\x0B\\f]') THEN 'target_starts_with_whitespace' END,
CASE WHEN regexp_matches(target_text, '^[)\\]}]') THEN 'target_starts_with_closer' END, CASE WHEN line_end_byte_offset > target_end_byte_offset THEN 'trailing_whitespace' END, CASE WHEN list_contains(quality_flags, 'target_has_comment') THEN 'target_has_comment' END,
CASE WHEN list_contains(quality_flags, 'file_has_syntax_errors') THEN 'file_has_syntax_errors' END, CASE WHEN regexp_matches(target_text, '[^\\x00-\\x7F]') THEN 'non_ascii_target' END], lambda x: x IS NOT NULL)"""


@query(f"SELECT sample_id, extracted_at, array_to_string({_FLAGS}, ',') AS flags FROM samples")
def caret_flags(spark, d):
    """Flags of each sample; what only the file tells is taken from the record."""
    held = lambda x: F.array_contains("quality_flags", x)
    flags = extract.flags(F.col("target_text"), F.col("line_end_byte_offset") > F.col("target_end_byte_offset"), held("target_has_comment"), held("file_has_syntax_errors"))
    return table(spark, d, "samples").select("sample_id", "extracted_at", F.array_join(flags, ",").alias("flags"))


@query("""SELECT sample_id, extracted_at, right(left_context, 100) AS before, left(right_context, 40) AS after FROM samples""")
def context_windows(spark, d):
    """Contexts cut to 100 and 40 UTF-16 units (the data has no surrogate pairs, so that units are characters)."""
    return table(spark, d, "samples").select("sample_id", "extracted_at", last_units(F.col("left_context"), 100).alias("before"), first_units(F.col("right_context"), 40).alias("after"))


_RECON = """j AS (SELECT s.*, f.content IS NULL AS missing, encode(f.content) AS raw, CASE WHEN f.has_bom THEN 3 ELSE 0 END AS bom, caret_byte_offset AS a, target_end_byte_offset AS e, left_context_start_byte_offset AS l, right_context_end_byte_offset AS r
 FROM samples s LEFT JOIN corpus_files f USING (repository_id, relative_path))"""


@query(f"""WITH {_RECON} SELECT count(*) AS rows, count(*) FILTER (missing) AS missing, count(*) FILTER (raw[a - bom + 1 : e - bom] IS DISTINCT FROM encode(target_text)) AS bad_target, count(*) FILTER (raw[l - bom + 1 : a - bom] IS DISTINCT FROM encode(left_context)) AS bad_left,
 count(*) FILTER (raw[e - bom + 1 : r - bom] IS DISTINCT FROM encode(right_context)) AS bad_right FROM j""")
def reconstruction_check(spark, d):
    """Targets and contexts cut again from the bytes of the files; a sample without its file fails."""
    s = table(spark, d, "samples").select("sample_id", "repository_id", "relative_path", "target_text", "left_context", "right_context", "caret_byte_offset", "target_end_byte_offset", "left_context_start_byte_offset", "right_context_end_byte_offset")
    r = validation.reconstructed(s, validation.with_bom(table(spark, d, "corpus_files")))
    bad = lambda a, b: F.coalesce(F.sum((~F.col(a).eqNullSafe(F.col(b))).cast("bigint")), F.lit(0))
    return r.agg(F.count("*").alias("rows"), F.count(F.when(F.col("raw").isNull(), 1)).alias("missing"), bad("file_target", "target_text").alias("bad_target"), bad("file_left", "left_context").alias("bad_left"), bad("file_right", "right_context").alias("bad_right"))


_U16 = "(length({0}) + length(regexp_replace({0}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"
_FILE_CHECKS = {
    "source_missing": "NOT missing",
    "source_sha256": "lower(trim(source_sha256)) = CASE WHEN bom = 3 THEN sha256(from_hex('EFBBBF') || raw) ELSE sha256(decode(raw)) END",
    "offset_range": "a >= bom AND e >= a AND e <= octet_length(raw) + bom",
    "reconstruction": "raw[a - bom + 1 : e - bom] = encode(target_text)",
    "utf16_offset": f"{_U16.format('before')} = caret_utf16_offset AND {_U16.format('before')} + {_U16.format('target_text')} = target_end_utf16_offset",
    "line_column": f"length(before) - length(replace(before, chr(10), '')) = caret_line_zero_based AND a - octet_length(encode(head)) = line_start_byte_offset AND octet_length(encode(head)) = caret_column_byte_zero_based AND {_U16.format('head')} = caret_column_utf16_zero_based AND e + octet_length(encode(rest)) = line_end_byte_offset",
    "blank_after_target": "trim(rest, ' ' || chr(9) || chr(11) || chr(12)) = ''",
    "left_context": f"raw[l - bom + 1 : a - bom] = encode(left_context) AND left_context_truncated = (l > bom) AND left_context_start_utf16_offset = caret_utf16_offset - {_U16.format('left_context')}",
    "right_context": f"raw[e - bom + 1 : r - bom] = encode(right_context) AND right_context_truncated = (r < octet_length(raw) + bom) AND right_context_end_utf16_offset = target_end_utf16_offset + {_U16.format('right_context')}",
}


@query("WITH " + _RECON + """, h AS (SELECT *, decode(raw[1 : a - bom]) AS before, decode(raw[e - bom + 1 :]) AS tail FROM j),
k AS (SELECT *, string_split(before, chr(10))[-1] AS head, CASE WHEN contains(tail, chr(10)) THEN regexp_replace(string_split(tail, chr(10))[1], '\\r$', '') ELSE tail END AS rest FROM h) """
       + " UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) AS rows, count(*) FILTER (({v}) IS NOT TRUE) AS failed FROM k" for k, v in _FILE_CHECKS.items()))
def file_checks(spark, d):
    """Every recorded sample held against its file: hash, range, bytes, UTF-16 offsets, line and column, contexts."""
    again = validation.reconstructed(table(spark, d, "samples"), validation.with_bom(table(spark, d, "corpus_files")))
    return validation.report(again, validation.file_checks())


_ROW_CHECKS = {
    "schema_version": "regexp_matches(schema_version, 'sample/v1$')", "language": "language = 'go'", "sample_id_format": "regexp_full_match(sample_id, '[0-9a-f]{32}')", "source_sha256_format": "regexp_full_match(source_sha256, '[0-9a-f]{64}')",
    "config_sha256_format": "regexp_full_match(config_sha256, '[0-9a-f]{64}')", "revision_format": "revision IS NULL OR regexp_full_match(revision, '[0-9a-f]{40}')", "caret_kind": f"caret_kind IN ({', '.join(map(lit, WEIGHTS))})", "end_of_line": "end_of_line IN ('LF', 'CRLF', 'EOF')",
    "split": "split IN ('train', 'validation', 'test')", "quality_flags": f"len(list_filter(quality_flags, lambda x: x NOT IN ({', '.join(map(lit, validation.FLAGS))}))) = 0", "target_not_empty": "length(target_text) > 0", "target_one_line": "NOT regexp_matches(target_text, '[\\r\\n\\x{2028}]')",
    "target_not_padded": "rtrim(target_text, ' ' || chr(9) || chr(11) || chr(12)) = target_text", "target_size": f"{_U16.format('target_text')} = target_end_utf16_offset - caret_utf16_offset", "column": "caret_utf16_offset - line_start_utf16_offset = caret_column_utf16_zero_based",
    "column_bytes": "caret_byte_offset - line_start_byte_offset = caret_column_byte_zero_based", "left_size": f"{_U16.format('left_context')} = caret_utf16_offset - left_context_start_utf16_offset",
    "indentation": "indentation IS NULL OR starts_with(regexp_extract(string_split(left_context, chr(10))[-1], '^[ \\t\\x0B\\f]*'), indentation)",
    "sample_id": f"sample_id = left(sha256(repository_id || {_SEP} || relative_path || {_SEP} || source_sha256 || {_SEP} || caret_utf16_offset || {_SEP} || target_end_utf16_offset), 32)",
}


@query(" UNION ALL ".join(f"SELECT '{k}' AS \"check\", count(*) AS rows, count(*) FILTER (({v}) IS NOT TRUE) AS failed FROM samples" for k, v in _ROW_CHECKS.items()))
def sample_checks(spark, d):
    """Rows that fail each check of a sample record."""
    return validation.report(table(spark, d, "samples"), validation.field_checks())


@query("""WITH r AS (SELECT sample_id, semantic_status AS status, CASE WHEN caret_kind = 'probe' THEN ['x'] ELSE [] END AS violations FROM samples WHERE semantic_status <> 'not_attempted' UNION ALL SELECT repo_id, status, ['x'] FROM jobs)
SELECT 'semantic_orphan' AS "check", count(*) AS rows, count(*) FILTER (sample_id IS NULL OR sample_id NOT IN (SELECT sample_id FROM samples WHERE sample_id IS NOT NULL)) AS failed FROM r
UNION ALL SELECT 'semantic_status', count(*), count(*) FILTER ((status IN ('resolved', 'partially_resolved', 'syntax_fallback', 'failed')) IS NOT TRUE) FROM r UNION ALL SELECT 'semantic_leakage', count(*), count(*) FILTER (len(violations) > 0) FROM r""")
def semantic_checks(spark, d):
    """Records held against the samples they are about; jobs stand in for records of unknown samples with violations."""
    s, none = table(spark, d, "samples"), F.array().cast("array<string>")
    r = s.where("semantic_status <> 'not_attempted'").select("sample_id", F.col("semantic_status").alias("status"), none.alias("violations"))
    odd = table(spark, d, "jobs").select(F.col("repo_id").alias("sample_id"), "status", F.array(F.lit("x")).alias("violations"))
    return validation.semantic_checks(r.unionByName(odd), s)


@query(f"SELECT count(*) AS rows, count(*) FILTER (sample_id <> left(sha256(repository_id || {_SEP} || relative_path || {_SEP} || source_sha256 || {_SEP} || caret_utf16_offset || {_SEP} || target_end_utf16_offset), 32)) AS failed FROM samples")
def sample_id_check(spark, d):
    s = table(spark, d, "samples")
    return s.agg(F.count("*").alias("rows"), F.sum((F.col("sample_id") != validation.expected_id()).cast("bigint")).alias("failed"))


@query("SELECT sample_id, count(*) AS rows FROM samples GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, d):
    return reports.count_by(table(spark, d, "samples"), "sample_id").where("rows > 1")


@query("SELECT repository_id, relative_path FROM discovery_files WHERE accepted AND NOT EXISTS (SELECT 1 FROM corpus_files f WHERE f.repository_id = discovery_files.repository_id AND f.relative_path = discovery_files.relative_path) GROUP BY ALL")
def orphans(spark, d):
    """Accepted paths without a corpus file."""
    a = table(spark, d, "discovery_files").where("accepted").select("repository_id", "relative_path").distinct()
    return a.join(table(spark, d, "corpus_files").select("repository_id", "relative_path"), ["repository_id", "relative_path"], "left_anti")


_SPL = "CASE WHEN lower(trim(split)) IN ('eval', 'val') THEN 'validation' ELSE nullif(lower(trim(split)), '') END"


@query(f"SELECT lower(trim(split_group)) AS g, count(DISTINCT {_SPL}) AS splits FROM samples WHERE split_group IS NOT NULL AND split IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {_SPL}) > 1")
def group_split_leak(spark, d):
    from caretlake.functions.labels import clean_split

    s = table(spark, d, "samples").where("split_group IS NOT NULL AND split IS NOT NULL").select(F.lower(F.trim("split_group")).alias("g"), clean_split(F.col("split")).alias("s")).distinct()
    return s.groupBy("g").agg(F.count("s").alias("splits")).where("splits > 1")


# ---- facts ----------------------------------------------------------------------------------------------------------

_IDS = "list_sort(list_distinct(regexp_extract_all({0}, '[A-Za-z_][A-Za-z0-9_]*')))"
_AUDIT = f"""a AS (SELECT sample_id, extracted_at, {_IDS.format('right_context')} AS facts, {_IDS.format('target_text')} AS ids, {_IDS.format('left_context')} AS visible FROM samples),
v AS (SELECT *, list_sort(list_intersect(facts, ids)) AS mentioned FROM a), z AS (SELECT *, list_sort(list_filter(mentioned, lambda x: NOT list_contains(visible, x))) AS violations FROM v)"""


def _audited(spark, d):
    """Identifiers of the right context stand in for facts; what the left context names is visible."""
    s = table(spark, d, "samples").select("sample_id", "extracted_at", "target_text", semantics.identifiers(F.col("right_context")).alias("facts"), semantics.identifiers(F.col("left_context")).alias("visible"))
    return semantics.leak_audit(s, F.col("facts"), F.col("target_text"), F.col("visible"))


@query(f"WITH {_AUDIT} SELECT sample_id, extracted_at, array_to_string(ids, ',') AS target_identifiers, array_to_string(mentioned, ',') AS mentioned, array_to_string(violations, ',') AS violations FROM z")
def leak_audit(spark, d):
    return _audited(spark, d).select("sample_id", "extracted_at", *[F.array_join(c, ",").alias(c) for c in ("target_identifiers", "mentioned", "violations")])


@query(f"WITH {_AUDIT} SELECT sample_id, extracted_at, CASE WHEN len(violations) > 0 THEN 'failed' ELSE 'resolved' END AS status, CASE WHEN len(violations) > 0 THEN 'leak_audit:' || array_to_string(violations, ',') END AS reason, CASE WHEN len(violations) > 0 THEN 0 ELSE len(facts) END AS facts FROM z")
def quarantine(spark, d):
    q = semantics.quarantine(_audited(spark, d).withColumn("status", F.lit("resolved")).withColumn("reason", F.lit(None).cast("string")), "facts")
    return q.select("sample_id", "extracted_at", "status", "reason", F.size("facts").cast("bigint").alias("facts"))


_REC = "r AS (SELECT sample_id, max(semantic_status) AS status, max(semantic_reason) AS reason FROM samples WHERE is_test = false GROUP BY 1)"


def _records(spark, d):
    s = table(spark, d, "samples").where("NOT is_test").groupBy("sample_id").agg(F.max("semantic_status").alias("status"), F.max("semantic_reason").alias("reason"))
    return s.withColumn("visibility_policy", F.lit("editor_snapshot"))


@query(f"WITH {_REC} SELECT s.sample_id, s.extracted_at, coalesce(status, 'not_attempted') AS semantic_status, CASE WHEN status IS NULL THEN 'not_in_subset' ELSE reason END AS semantic_reason FROM samples s LEFT JOIN r USING (sample_id)")
def status_mirror(spark, d):
    return semantics.mirror_status(table(spark, d, "samples"), _records(spark, d), "editor_snapshot").select("sample_id", "extracted_at", "semantic_status", "semantic_reason")


@query(f"WITH {_REC} SELECT s.sample_id, s.extracted_at FROM samples s JOIN r USING (sample_id) WHERE status IN ('resolved', 'partially_resolved')")
def required_mode(spark, d):
    return semantics.mirror_status(table(spark, d, "samples"), _records(spark, d), "editor_snapshot", True).select("sample_id", "extracted_at")


@query("SELECT semantic_status, semantic_reason, count(*) AS rows FROM samples GROUP BY ALL")
def semantic_counters(spark, d):
    return reports.count_by(table(spark, d, "samples"), "semantic_status", "semantic_reason")


@query("""WITH a AS (SELECT sample_id, max(semantic_status) AS st, max_by(tags, extracted_at) AS tags FROM samples GROUP BY 1), b AS (SELECT sample_id, st, CASE WHEN sample_id < '8' THEN list_append(tags, 'x') WHEN sample_id < 'c' THEN [] ELSE tags END AS tags FROM a WHERE sample_id < 'f'),
j AS (SELECT a.sample_id AS ia, b.sample_id AS ib, a.st IS NOT DISTINCT FROM b.st AS same, len(list_filter(coalesce(a.tags, []), lambda x: NOT list_contains(coalesce(b.tags, []), x))) = 0 AS sub, len(list_filter(coalesce(b.tags, []), lambda x: NOT list_contains(coalesce(a.tags, []), x))) = 0 AS sup FROM a FULL JOIN b ON a.sample_id = b.sample_id)
SELECT CASE WHEN ib IS NULL THEN 'only_left' WHEN ia IS NULL THEN 'only_right' WHEN same AND sub AND sup THEN 'identical' WHEN same AND sub THEN 'subset' WHEN same AND sup THEN 'superset' ELSE 'different' END AS outcome, count(*) AS records FROM j GROUP BY 1""")
def fact_compare(spark, d):
    """Records compared with a changed copy of themselves; the copy is made from all of them by their id's first digit."""
    a = table(spark, d, "samples").groupBy("sample_id").agg(F.max("semantic_status").alias("st"), F.max_by("tags", "extracted_at").alias("tags"))
    changed = F.when(F.col("sample_id") < "8", F.array_append("tags", F.lit("x"))).when(F.col("sample_id") < "c", F.array().cast("array<string>")).otherwise(F.col("tags"))
    return reports.compare_records(a, a.where("sample_id < 'f'").withColumn("tags", changed), ["sample_id"], ["st"], ["tags"])


# ---- prompts --------------------------------------------------------------------------------------------------------

_CUT = """CASE WHEN length(left_context) <= 300 THEN left_context WHEN instr(right(left_context, 300), chr(10)) IN (0, 300) THEN right(left_context, 300) ELSE substr(right(left_context, 300), instr(right(left_context, 300), chr(10)) + 1) END"""


@query(f"SELECT sample_id, split, '<|go|><|path|>' || relative_path || chr(10) || '<|code|>' || chr(10) || {_CUT} || '<|complete|>' AS prompt, target_text || '<|eol|>' AS completion FROM samples")
def render_prompts(spark, d):
    return rendering.render(table(spark, d, "samples"), None, 300)


@query(f"SELECT split, count(*) AS rows, sum(length(target_text) + 7) AS completion_chars FROM samples GROUP BY split")
def render_summary(spark, d):
    r = rendering.render(table(spark, d, "samples"), None, 300)
    return r.groupBy("split").agg(F.count("*").alias("rows"), F.sum(F.length("completion")).alias("completion_chars"))


@query(f"SELECT sample_id, u FROM (SELECT DISTINCT sample_id, {usql(lit('preview'), 'sample_id')} - CASE WHEN semantic_status IN ('resolved', 'partially_resolved') THEN 1 ELSE 0 END AS u FROM samples) ORDER BY u, sample_id LIMIT 20")
def preview_topk(spark, d):
    """The twenty of a preview: a top-k report."""
    has = F.when(F.col("semantic_status").isin("resolved", "partially_resolved"), 1).otherwise(0)
    return table(spark, d, "samples").select("sample_id", (uniform(F.lit("preview"), F.col("sample_id")) - has).alias("u")).distinct().orderBy("u", "sample_id").limit(20)


@query("SELECT caret_kind, min(sample_id) AS sample_id FROM samples WHERE NOT is_test AND length(target_text) BETWEEN 10 AND 60 GROUP BY 1")
def example_pick(spark, d):
    return table(spark, d, "samples").where("NOT is_test AND length(target_text) BETWEEN 10 AND 60").groupBy("caret_kind").agg(F.min("sample_id").alias("sample_id"))


@query()
def budgeted_facts(spark, d):
    """Fact lines of each sample admitted into 120 units by priority; identifiers stand in for facts."""
    ids = semantics.identifiers
    line = lambda n, items: F.struct(F.lit(float(rendering.LINES[n][1])).alias("place"), F.lit(rendering.LINES[n][2]).alias("priority"), F.lit(rendering.LINES[n][0]).alias("key"), F.lit(rendering.LINES[n][3]).alias("sep"), items.alias("items"))
    facts = rendering.admit(F.array(line(1, ids(F.col("target_text"))), line(3, ids(F.substring_index("left_context", "\n", -3))), line(7, ids(F.col("right_context")))), 120)
    return table(spark, d, "samples").select("sample_id", "extracted_at", facts.alias("facts"))


_SAID = f"""a AS (SELECT sample_id, extracted_at, split, relative_path, left_context, left_context_truncated, target_text, semantic_status AS status, indentation, package_name, row_number() OVER (PARTITION BY sample_id ORDER BY extracted_at DESC, split DESC NULLS LAST) AS k FROM samples),
s AS (SELECT * FROM a WHERE k = 1),
f AS (SELECT *, {_IDS.format("string_split(left_context, chr(10))[-1]")} AS ids FROM s),
g AS (SELECT *, CASE WHEN status IN ('resolved', 'partially_resolved') THEN 'RET ' || package_name || chr(10) || CASE WHEN len(ids) > 0 THEN 'LOCAL ' || array_to_string(list_transform(ids[1:24], lambda x: x || ':int'), ' ') || chr(10) ELSE '' END ELSE '' END AS facts,
  CASE WHEN status IN ('resolved', 'partially_resolved') THEN greatest(len(ids) - 24, 0) ELSE 0 END AS dropped FROM f)"""


def _last_samples(spark, d):
    s = table(spark, d, "samples")
    return s.groupBy("sample_id").agg(F.max_by(F.struct(*[c for c in s.columns if c != "sample_id"]), F.struct("extracted_at", "split")).alias("s")).select("sample_id", "s.*")


def _made_records(s):
    """Records for the samples: identifiers of the caret's line stand in for locals, the package for a return type; a second policy and an earlier record must not show."""
    ids = semantics.identifiers(F.substring_index("left_context", "\n", -1))
    fact = F.transform(ids, lambda x: F.struct(x.alias("name"), F.lit("var").alias("kind"), F.lit("int").alias("type"), F.lit(None).cast("string").alias("signature")))
    none = {n: F.lit(None).cast(t).alias(n) for n, t in (x.split(" ", 1) for x in rendering.RECORD.replace("array<" + rendering.FACT + ">", "FACTS").replace("array<struct<name: string, members: FACTS>>", "TYPES").split(", "))if t not in ("FACTS", "TYPES")}
    facts = f"array<{rendering.FACT}>"
    row = lambda policy, place, ret: s.select("sample_id", F.col("semantic_status").alias("status"), F.lit(policy).alias("visibility_policy"), F.lit(place).alias("ordinal"), ret.alias("return_type"), fact.alias("locals"), *[none[n] for n in none if n != "return_type"], *[F.lit(None).cast(facts).alias(n) for n in ("parameters", "receiver_members", "members")], F.lit(None).cast(f"array<struct<name: string, members: {facts}>>").alias("context_types"))
    return row("editor_snapshot", 1, F.lit("old")).unionByName(row("editor_snapshot", 2, F.col("package_name"))).unionByName(row("strict_prefix", 3, F.lit("other")))


@query(f"""WITH {_SAID} SELECT sample_id, split, facts <> '' AS has_semantic, '<|go|><|path|>' || relative_path || chr(10) || CASE WHEN facts <> '' THEN '<|sem|>' || chr(10) || facts ELSE '' END || '<|code|>' || chr(10) || {_CUT} || '<|complete|>' AS prompt, target_text || '<|eol|>' AS completion,
 CAST(length({_CUT}) AS INTEGER) AS code_chars, length(left_context) > 300 OR left_context_truncated AS code_truncated, CAST(length(facts) AS INTEGER) AS semantic_chars, CAST(dropped AS INTEGER) AS semantic_items_dropped FROM g""")
def train_records(spark, d):
    """Prompts with the facts of resolved records of one policy, as many as the budget admits."""
    s = _last_samples(spark, d)
    r = rendering.train_records(s, _made_records(s), "editor_snapshot", 300, 100_000)
    return r.drop("schema_version", "caret_kind", "semantic_status")


@query(r"""WITH s AS (SELECT sample_id, extracted_at, left_context, regexp_replace(regexp_replace(left_context, '(?s)//[^\n]*|/\*.*?(?:\*/|\z)|"(?:[^"\\\n]|\\.)*(?:"|\n|\z)|`[^`]*(?:`|\z)|''(?:[^''\\\n]|\\.)*(?:''|\n|\z)', ' ', 'g'), '[^(){}\[\]]', '', 'g') AS b FROM samples)
SELECT sample_id, extracted_at, list_reduce(list_concat([''], list_filter(string_split(b, ''), lambda c: c <> '')), lambda acc, c: CASE c WHEN '(' THEN ')' || acc WHEN '[' THEN ']' || acc WHEN '{' THEN '}' || acc ELSE acc[2:] END) AS closers FROM s WHERE left_context IS NOT NULL""")
def strict_suffix(spark, d):
    """What closes the brackets that each left context leaves open."""
    return table(spark, d, "samples").where("left_context IS NOT NULL").select("sample_id", "extracted_at", semantics.open_brackets(F.col("left_context")).alias("closers"))


@query(f"SELECT sample_id, extracted_at FROM samples WHERE {usql(lit('20261009'), lit('semantic_subset'), 'sample_id')} < 0.15")
def semantic_subset(spark, d):
    """The part of the samples that is enriched: a sampling operator."""
    return table(spark, d, "samples").where(semantics.in_subset(F.col("sample_id"), 0.15, "20261009")).select("sample_id", "extracted_at")


@query("SELECT repository_id, project, CAST(floor((row_number() OVER (PARTITION BY repository_id, project ORDER BY relative_path, caret_byte_offset, sample_id) - 1) / 48) AS INTEGER) AS chunk, sample_id FROM (SELECT DISTINCT repository_id, project, relative_path, caret_byte_offset, sample_id FROM samples)")
def package_work_items(spark, d):
    s = table(spark, d, "samples").select("repository_id", "project", "relative_path", "caret_byte_offset", "sample_id").distinct()
    return semantics.work_items(s)


@query("""WITH f AS (SELECT file_id, repository_id, project, coalesce(build_match, true) AS built, CASE WHEN is_test AND coalesce(package_name LIKE '%$_test' ESCAPE '$', false) THEN 'xtest' WHEN is_test THEN 'test' ELSE 'lib' END AS v FROM corpus_files),
n AS (SELECT repository_id, project, count(*) FILTER (v = 'lib') AS l, count(*) FILTER (v = 'test') AS t, count(*) FILTER (v = 'xtest') AS x FROM f WHERE built GROUP BY ALL),
j AS (SELECT *, CASE v WHEN 'xtest' THEN x WHEN 'test' THEN l + t ELSE l END AS size FROM f LEFT JOIN n USING (repository_id, project)), r AS (SELECT *, CASE WHEN NOT built THEN 'build_constraint_excluded' WHEN size > 3 THEN 'package_too_large' END AS reason FROM j)
SELECT file_id, CASE WHEN reason IS NULL THEN v END AS variant, CASE WHEN reason IS NULL THEN size END AS files, reason FROM r""")
def package_file_sets(spark, d):
    """The files that each file is checked with; sets of more than three count as too large here."""
    return semantics.package_files(table(spark, d, "corpus_files"), 3)


@query("SELECT s.sample_id, s.extracted_at, s.semantic_status FROM samples s WHERE s.semantic_status <> 'failed' AND s.sample_id IN (SELECT sample_id FROM samples WHERE split = 'train')")
def kept_facts(spark, d):
    """Records of one policy of the samples that are kept; the status stands in for the policy."""
    s = table(spark, d, "samples")
    r = s.select("sample_id", "extracted_at", "semantic_status", F.when(F.col("semantic_status") != "failed", "editor_snapshot").otherwise("strict_prefix").alias("visibility_policy"))
    return records.kept_records(r, s.where("split = 'train'"), "editor_snapshot").drop("visibility_policy")


@query("""SELECT sample_id, extracted_at, {'t': list_sort(list_distinct(regexp_extract_all(target_text, '[A-Za-z_][A-Za-z0-9_]*')))}.t AS target_identifiers, CASE WHEN caret_subkind IS NULL OR caret_subkind = '' THEN 0 ELSE 1 END AS candidates, CASE WHEN caret_subkind <> '' THEN caret_kind || caret_subkind END AS signature, CAST(NULL AS VARCHAR) AS missing FROM samples""")
def packed_columns(spark, d):
    """Fact records in the columns of the published table, then projected to a schema that has one column more."""
    from pyspark.sql import types as T

    none = F.lit(None).cast("string")
    s = table(spark, d, "samples")
    r = s.select("sample_id", "extracted_at", F.struct(semantics.identifiers(F.col("target_text")).alias("target_identifiers"), F.array().cast("array<string>").alias("mentioned")).alias("leakage"), F.array().alias("receiver_members"), F.col("caret_kind").alias("call_name"), F.col("caret_subkind").alias("call_signature"), F.lit(1).alias("argument_index"), none.alias("parameter_name"), none.alias("expected_type"))
    p = records.packed_facts(r).withColumn("candidates", F.size("invocation_candidates")).withColumn("signature", F.try_element_at("invocation_candidates", F.lit(1))["signature"])
    fields = [("sample_id", T.StringType()), ("extracted_at", T.TimestampType()), ("target_identifiers", T.ArrayType(T.StringType())), ("candidates", T.IntegerType()), ("signature", T.StringType()), ("missing", T.StringType())]
    return records.project(p, T.StructType([T.StructField(*f) for f in fields]))


@query("SELECT repo_id, min(k) AS round FROM (SELECT repo_id, 0 AS k FROM jobs WHERE batch <= 4 UNION ALL SELECT repo_id, 1 FROM jobs WHERE batch > 4) WHERE repo_id NOT IN (SELECT repository_id FROM license_files WHERE repository_id IS NOT NULL) GROUP BY repo_id")
def remaining_repositories(spark, d):
    """Repositories of two manifests that were not done before, each once, from the first manifest that names it."""
    j = table(spark, d, "jobs")
    rounds = [j.where("batch <= 4").select("repo_id", F.lit(0).alias("round")), j.where("batch > 4").select("repo_id", F.lit(1).alias("round"))]
    return records.remaining(rounds, table(spark, d, "license_files").select(F.col("repository_id").alias("repo_id")), "repo_id")


# ---- repositories ---------------------------------------------------------------------------------------------------


@query(f"""WITH o AS (SELECT nullif(trim(regexp_replace(lower(trim(sha256)), '^sha256:', '')), '') AS h, batch, repo_id FROM file_owner)
SELECT h AS hash, min_by(repo_id, {{'b': batch, 'r': repo_id}}) AS repo_id FROM o WHERE h IS NOT NULL GROUP BY 1""")
def file_ownership(spark, d):
    o = table(spark, d, "file_owner").select(clean_hash(F.col("sha256")).alias("hash"), "batch", "repo_id").where("hash IS NOT NULL")
    return sampling.first_owner(o, "hash", "repo_id", ["batch"])


@query("""WITH o AS (SELECT nullif(trim(regexp_replace(lower(trim(sha256)), '^sha256:', '')), '') AS h, repo_id, min(batch) AS owned FROM file_owner WHERE repo_id IS NOT NULL GROUP BY 1, 2),
f AS (SELECT repository_id, relative_path, max(batch) AS batch FROM corpus_files GROUP BY 1, 2)
SELECT count(*) AS rows, count(*) FILTER (EXISTS (SELECT 1 FROM o WHERE o.h = nullif(trim(regexp_replace(lower(trim(s.source_sha256)), '^sha256:', '')), '') AND o.repo_id <> s.repository_id AND o.owned < f.batch)) AS owned_elsewhere
FROM samples s LEFT JOIN f USING (repository_id, relative_path)""")
def owned_elsewhere(spark, d):
    """Samples whose source another repository claimed in a batch before that of the sample's corpus file."""
    claims = table(spark, d, "file_owner").select(clean_hash(F.col("sha256")).alias("source_sha256"), F.col("repo_id").alias("owner"), "batch")
    o = claims.where("source_sha256 IS NOT NULL AND owner IS NOT NULL").groupBy("source_sha256", "owner").agg(F.min("batch").alias("owned"))
    f = table(spark, d, "corpus_files").groupBy("repository_id", "relative_path").agg(F.max("batch").alias("batch"))
    s = table(spark, d, "samples").select("sample_id", "repository_id", "relative_path", clean_hash(F.col("source_sha256")).alias("source_sha256"))
    owned = s.join(f, ["repository_id", "relative_path"]).alias("s").join(o.alias("o"), F.expr("s.source_sha256 = o.source_sha256 AND s.repository_id <> o.owner AND o.owned < s.batch"), "left_semi")
    return s.agg(F.count("*").alias("rows")).crossJoin(owned.agg(F.count("*").alias("owned_elsewhere")))  # one row each


_JOBS1 = "j AS (SELECT * FROM jobs QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY attempts DESC, started DESC NULLS LAST, status, samples) = 1)"


def _jobs(spark, d):
    return sampling.cap(table(spark, d, "jobs"), ["repo_id"], [F.desc("attempts"), F.desc_nulls_last("started"), F.col("status"), F.col("samples")], 1)


@query(f"WITH {_JOBS1} SELECT repo_id, before FROM (SELECT repo_id, CAST(coalesce(sum(coalesce(samples, 0)) OVER (ORDER BY repo_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM j) WHERE before < 10000")
def batch_assignment(spark, d):
    return sampling.batches(_jobs(spark, d).select("repo_id", "samples"), 5000).select("repo_id", "before")


@query("SELECT DISTINCT repo_id FROM jobs WHERE repo_id NOT IN (SELECT repository_id FROM license_files WHERE repository_id IS NOT NULL)")
def anti_jobs(spark, d):
    return table(spark, d, "jobs").select("repo_id").distinct().join(table(spark, d, "license_files").select(F.col("repository_id").alias("repo_id")), "repo_id", "left_anti")


@query("SELECT status, count(*) AS rows, CAST(sum(samples) AS BIGINT) AS samples, CAST(coalesce(sum(semantic) FILTER (reported = 1), 0) AS BIGINT) AS reported FROM jobs GROUP BY status")
def status_counts(spark, d):
    return table(spark, d, "jobs").groupBy("status").agg(F.count("*").alias("rows"), F.sum("samples").alias("samples"), F.coalesce(F.sum(F.when(F.col("reported") == 1, F.col("semantic"))), F.lit(0)).alias("reported"))


@query("SELECT repo_id, status, batch FROM jobs WHERE batch = 3 UNION ALL SELECT repo_id, status, batch FROM jobs WHERE batch <> 3 AND status IN ('skipped', 'failed') AND coalesce(reported, 0) = 0")
def provenance_union(spark, d):
    j = table(spark, d, "jobs").select("repo_id", "status", "batch", "reported")
    rest = j.where("batch <> 3 AND status IN ('skipped', 'failed') AND coalesce(reported, 0) = 0")
    return j.where("batch = 3").unionByName(rest).drop("reported")


@query("SELECT count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM (SELECT DISTINCT repository_id, relative_path, bytes FROM discovery_files) WHERE NOT regexp_matches(relative_path, '(^|/)(vendor|testdata|node_modules|\\.git)/') AND relative_path LIKE '%.go'")
def go_bytes(spark, d):
    f = table(spark, d, "discovery_files").select("repository_id", "relative_path", "bytes").distinct()
    f = f.where(F.col("relative_path").endswith(".go") & ~F.col("relative_path").rlike(r"(^|/)(vendor|testdata|node_modules|\.git)/"))
    return f.agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


@query("""WITH c AS (SELECT *, CASE WHEN has_bom THEN from_hex('EFBBBF') || encode(content) ELSE encode(content) END AS raw, length(content) - length(replace(content, chr(10), '')) AS lf, (length(content) - length(replace(content, chr(13) || chr(10), ''))) // 2 AS crlf FROM corpus_files WHERE content IS NOT NULL)
SELECT file_id, repository_id, relative_path, octet_length(raw) AS bytes, CASE WHEN has_bom THEN sha256(from_hex('EFBBBF') || encode(content)) ELSE sha256(content) END AS sha256, coalesce(has_bom, false) AS has_bom, CASE WHEN lf = 0 THEN 'none' WHEN crlf = 0 THEN 'lf' WHEN crlf = lf THEN 'crlf' ELSE 'mixed' END AS newline_style,
 CAST(lf + 1 AS INTEGER) AS lines, license, license_reason, content FROM c""")
def corpus_rows(spark, d):
    """Corpus records built from the texts: size and hash of the bytes, the byte order mark included."""
    f = table(spark, d, "corpus_files")
    return extract.corpus_records(f, licence=F.col("license"), reason=F.col("license_reason")).select("file_id", "repository_id", "relative_path", "bytes", "sha256", "has_bom", "newline_style", "lines", "license", "license_reason", "content")


@query("""SELECT count(*) AS rows, count(*) FILTER (bytes IS DISTINCT FROM size) AS bad_bytes, count(*) FILTER (h IS NOT NULL AND h <> hash) AS bad_hash FROM (
 SELECT bytes, octet_length(encode(content)) + CASE WHEN has_bom THEN 3 ELSE 0 END AS size, nullif(trim(regexp_replace(lower(trim(sha256)), '^sha256:', '')), '') AS h, CASE WHEN has_bom THEN sha256(from_hex('EFBBBF') || encode(content)) ELSE sha256(content) END AS hash FROM corpus_files WHERE content IS NOT NULL)""")
def corpus_check(spark, d):
    """Recorded size and hash of corpus files held against their bytes; a hash that is not recorded is not checked."""
    f = table(spark, d, "corpus_files")
    made = extract.corpus_records(f).select("file_id", F.col("bytes").alias("size"), F.col("sha256").alias("hash"))
    j = f.select("file_id", "bytes", clean_hash(F.col("sha256")).alias("h")).join(made, "file_id")
    bad = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    return j.agg(F.count("*").alias("rows"), bad(~F.col("bytes").eqNullSafe(F.col("size"))).alias("bad_bytes"), bad(F.coalesce(F.col("h") != F.col("hash"), F.lit(False))).alias("bad_hash"))


@query("""WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL)
SELECT event_type, max(n) AS rows, max(value) FILTER (i = floor(0.5 * (n - 1) + 0.5)) AS p50, max(value) FILTER (i = floor(0.95 * (n - 1) + 0.5)) AS p95, max(value) FILTER (i = floor(0.99 * (n - 1) + 0.5)) AS p99, max(value) AS max FROM r GROUP BY 1""")
def value_percentiles(spark, d):
    return reports.rank_percentiles(table(spark, d, "events"), ["event_type"], "value", {"p50": 0.5, "p95": 0.95, "p99": 0.99, "max": 1.0})


# ---- metadata rules -------------------------------------------------------------------------------------------------

_HITS = lambda ps: " + ".join(f"CAST(regexp_matches(hay, {lit(p)}) AS INTEGER)" for p in ps)


@query(f"""SELECT doc_id, CASE WHEN s > 0 AND b = 0 THEN 'strong' WHEN w >= 2 AND b = 0 THEN 'weak_twice' WHEN w > 0 THEN 'flag' END AS flag FROM (
 SELECT doc_id, {_HITS(selection.STRONG)} AS s, {_HITS(selection.WEAK)} AS w, {_HITS(selection.BENIGN)} AS b FROM (SELECT doc_id, lower(text) AS hay FROM documents WHERE text IS NOT NULL))""")
def content_flags(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", selection.content_flag(F.lower("text")).alias("flag"))


_CAT = "CASE " + " ".join(f"WHEN regexp_matches(text, {lit('(?i)' + p)}) THEN {lit(n)}" for n, p in selection.CATEGORIES) + " ELSE 'other' END"


@query(f"SELECT {_CAT} AS category, count(*) AS rows FROM documents WHERE text IS NOT NULL GROUP BY 1")
def category_rules(spark, d):
    return reports.count_by(table(spark, d, "documents").where("text IS NOT NULL"), selection.category(F.col("text")).alias("category"))


@query("""SELECT repo_id, CAST(round_even(1000 * (0.45 * least(1.0, log10(size_kb + 1) / log10(150001.0)) + 0.30 * greatest(0.0, least(1.0, date_diff('day', DATE '2024-10-09', CAST(substr(started, 1, 10) AS DATE)) / 730.0))
 + CASE WHEN repo_id LIKE '%labs/%' THEN 0.10 ELSE 0.0 END + 0.15 * ((CASE WHEN license <> '' THEN 0.5 ELSE 0.0 END + least(0.5, 0.1 * attempts)) * 1.0)), 0) AS INTEGER) AS priority FROM jobs WHERE started IS NOT NULL AND license IS NOT NULL""")
def priority_score(spark, d):
    """The score of metadata; sizes stand in for stars, attempts for topics."""
    j = table(spark, d, "jobs").where("started IS NOT NULL AND license IS NOT NULL")
    p = selection.priority(F.col("size_kb"), F.col("started"), F.col("repo_id").like("%labs/%"), F.col("license") != "", F.col("attempts"), F.lit(1.0))
    return j.select("repo_id", p.alias("priority"))


_TOK = "list_filter(list_distinct(string_split(regexp_replace(lower(full_name), '[^a-z0-9]+', ' ', 'g'), ' ')), lambda x: x <> '' AND x NOT IN (" + ", ".join(map(lit, selection.STOP_WORDS)) + "))"
_NAMES = f"n AS (SELECT DISTINCT repo_id, string_split(full_name, '/')[1] AS block, {_TOK} AS t FROM jobs)"


def _names(spark, d):
    j = table(spark, d, "jobs").select("repo_id", "full_name").distinct()
    return j.select("repo_id", F.substring_index("full_name", "/", 1).alias("block"), selection.token_set(F.col("full_name")).alias("t"))


_PAIRS = f"""{_NAMES}, e AS (SELECT x.repo_id AS a, y.repo_id AS b, len(list_intersect(x.t, y.t)) / len(list_distinct(list_concat(x.t, y.t))) AS similarity FROM n x JOIN n y ON x.block = y.block AND x.repo_id < y.repo_id)"""


@query(f"WITH {_PAIRS} SELECT a, b, round(similarity, 9) AS similarity FROM e WHERE similarity >= 0.5")
def jaccard_pairs(spark, d):
    """Names of one owner whose token sets are similar."""
    return selection.similar_in_blocks(_names(spark, d), "repo_id", "block", "t", 0.5).withColumn("similarity", F.round("similarity", 9))


@query(f"""WITH RECURSIVE {_PAIRS}, u AS (SELECT a, b FROM e WHERE similarity >= 0.5 UNION SELECT b, a FROM e WHERE similarity >= 0.5),
r AS (SELECT DISTINCT repo_id AS x, repo_id AS y FROM n UNION SELECT r.x, u.b FROM r JOIN u ON r.y = u.a) SELECT x AS repo_id, min(y) AS "group" FROM r GROUP BY x""")
def components(spark, d):
    n = _names(spark, d)
    return selection.groups(n, selection.similar_in_blocks(n, "repo_id", "block", "t", 0.5), "repo_id")


@query(f"WITH {_JOBS1} SELECT lower(trim(grp)) AS g, max_by(repo_id, {{'p': priority, 's': size_kb, 'n': repo_id}}) AS canonical FROM j WHERE grp IS NOT NULL GROUP BY 1")
def canonical(spark, d):
    j = _jobs(spark, d).where("grp IS NOT NULL").withColumn("g", F.lower(F.trim("grp")))
    return selection.canonical(j, "g", ["priority", "size_kb"], "repo_id")


@query(f"WITH {_JOBS1} SELECT repo_id, string_split(full_name, '/')[1] AS owner FROM j QUALIFY row_number() OVER (PARTITION BY string_split(full_name, '/')[1] ORDER BY priority DESC, size_kb DESC, repo_id) <= 2")
def owner_cap(spark, d):
    """Two repositories an owner: a cap is the operator."""
    return selection.owner_cap(_jobs(spark, d), F.substring_index("full_name", "/", 1), [F.desc("priority"), F.desc("size_kb"), F.col("repo_id")], 2).select("repo_id", "owner")


@query("""WITH t AS (SELECT doc_id, trim(regexp_replace(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9_\\s]', '', 'g'), '\\s+', ' ', 'g')) AS t FROM documents) SELECT a, doc_id AS b FROM t JOIN (SELECT t, min(doc_id) AS a FROM t WHERE length(t) >= 40 GROUP BY t) USING (t) WHERE a <> doc_id""")
def same_text_edges(spark, d):
    docs = table(spark, d, "documents").select("doc_id", selection.normal_text(F.regexp_replace("text", "[\x0b]", "")).alias("t"))
    return selection.same_text_edges(docs, "doc_id", "t")


@query("SELECT status, reason, count(*) AS rows, count(DISTINCT lower(trim(grp))) AS groups FROM jobs GROUP BY ALL")
def selection_report(spark, d):
    return table(spark, d, "jobs").groupBy("status", "reason").agg(F.count("*").alias("rows"), F.countDistinct(F.lower(F.trim("grp"))).alias("groups"))


_GATES = {"tiny": "size_kb < 20", "giant": "size_kb > 400000", "inactive": "started < '2025-01-01'", "no_samples": "samples = 0", "license_unknown": "license IS NULL OR trim(license) = ''"}


@query(f"""WITH g AS (SELECT repo_id, attempts, started, list_sort(list_filter([{', '.join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _GATES.items())}], lambda x: x IS NOT NULL)) AS r FROM jobs)
SELECT repo_id, attempts, started, array_to_string(r, ',') AS reasons, len(r) = 0 AS selected FROM g""")
def gate_reasons(spark, d):
    """All gates that each row fails, the thresholds being parameters; rows without any are selected."""
    j = table(spark, d, "jobs").select("repo_id", "attempts", "started", "priority", selection.reasons({n: F.expr(c) for n, c in _GATES.items()}).alias("r"))
    chosen, rejected = selection.outcomes(j, "repo_id", "r", [F.desc("priority"), F.col("repo_id")])
    return chosen.withColumn("selected", F.lit(True)).unionByName(rejected.withColumn("selected", F.lit(False))).select("repo_id", "attempts", "started", F.array_join("r", ",").alias("reasons"), "selected")


@query("""SELECT repo_id, attempts, started, CASE WHEN finished IS NULL THEN 'not_finished' WHEN cs_bytes > 1000000 THEN 'too_large:' || (cs_bytes >> 20) || 'MB' WHEN license IS NULL THEN 'license_not_allowed' WHEN samples = 0 THEN 'no_samples' END AS reason FROM jobs""")
def first_gate(spark, d):
    """The first gate that each row fails, with a detail."""
    rules = {"not_finished": F.col("finished").isNull(), "too_large": F.col("cs_bytes") > 1_000_000, "license_not_allowed": F.col("license").isNull(), "no_samples": F.col("samples") == 0}
    detail = {"too_large": F.concat(F.shiftright("cs_bytes", 20).cast("string"), F.lit("MB"))}
    return table(spark, d, "jobs").select("repo_id", "attempts", "started", selection.first_reason(rules, detail).alias("reason"))


@query("""WITH n AS (SELECT sample_id, extracted_at, lower(sample_id) AS l, regexp_replace(lower(sample_id), '[-_0-9]', '', 'g') AS s FROM samples)
SELECT sample_id, extracted_at, length(s) >= 10 AND regexp_matches(l, '[0-9]{3,}') AND length(regexp_replace(s, '[^aeiou]', '', 'g')) / length(s) < 0.22 AS odd FROM n WHERE length(s) > 0""")
def odd_names(spark, d):
    """Names that look made by chance; ids of samples stand in for owners."""
    c = F.col("sample_id")
    return table(spark, d, "samples").where(F.length(F.regexp_replace(F.lower(c), "[-_0-9]", "")) > 0).select(c, "extracted_at", selection.odd_name(c).alias("odd"))


@query("""WITH m AS (SELECT DISTINCT repo_id FROM jobs WHERE license LIKE 'BSD%' AND repo_id IS NOT NULL) SELECT a, repo_id AS b FROM m, (SELECT min(repo_id) AS a FROM m) WHERE a <> repo_id""")
def one_group_edges(spark, d):
    """Edges that tie all members of one family together; a family of licences stands in for forks of one project."""
    return selection.one_group(table(spark, d, "jobs").where("license LIKE 'BSD%'"), "repo_id", "no/such")
