"""The chain from files to samples; every record is held against its file again."""

from dataclasses import replace

from pyspark.sql import functions as F

from caretlake import schemas
from caretlake.config import Config, Sampling
from caretlake.operators import extract, validation
from caretlake.operators.golexer import WEIGHTS
from tests.test_operators import SRC

ALL = Config(left_units=40, right_units=10, sampling=Sampling(weights=dict.fromkeys(WEIGHTS, 1.0), per_line=0, per_file=0, trivial_keep=1.0))
COLS = "file_id bigint, repository_id string, relative_path string, content string, line int, score double"


def files(spark, n=1):
    texts = [SRC, SRC.replace("\n", "\r\n"), SRC.rstrip("\n"), SRC.replace("tail", "größe 😀 ende").replace('"a"', '"😀é"'), "", None, "}}} not go", 'package a\nvar password = "hunter2hunter2xyz"\nvar e = "APP_PASSWORD"\n', SRC]
    return spark.createDataFrame([(i, f"r{i % 2}", f"f{i}.go", t, 1, 1.0) for i, t in enumerate(texts * n)], COLS)


def failures(s, f):
    again = validation.reconstructed(s, validation.with_bom(f))
    return {r["check"]: r["failed"] for r in validation.report(again, validation.field_checks() | validation.file_checks()).collect() if r["failed"]}


def test_settings_are_in_force(spark):
    f = files(spark)
    n = lambda **kw: extract.samples(f, replace(ALL, sampling=replace(ALL.sampling, **kw)))
    assert n(test_keep=0.0).where("is_test").count() == 0
    t = spark.createDataFrame([(1, "r", "a_test.go", SRC, 1, 1.0), (2, "q", "a.go", SRC, 1, 1.0)], COLS)
    thin = extract.samples(t, replace(ALL, sampling=replace(ALL.sampling, test_keep=0.0)))
    assert {r[0] for r in thin.select("relative_path").distinct().collect()} == {"a.go"}
    assert n(max_target=5).where("length(target_text) > 5").count() == 0 and n(min_target=3).where("length(target_text) < 3").count() == 0
    assert n(max_line=20).where("line_end_byte_offset - line_start_byte_offset > 20").count() == 0
    ends = lambda d: d.where("caret_kind = 'identifier_partial'").count()
    assert ends(n(prefix_max=1)) < ends(n())


def test_a_line_at_another_depth_is_the_same_line(spark):
    body = "package a\n\nfunc f() {\n%scall(one, two)\n}\n"
    rows = [(1, "r", "a.go", body % "\t", 1, 1.0), (2, "r", "b.go", body % "\t\t  ", 1, 1.0), (3, "r", "c.go", body % "", 1, 1.0), (4, "q", "d.go", body % "\t", 1, 1.0)]
    s = extract.samples(spark.createDataFrame(rows, COLS), ALL).where("target_text LIKE 'call(%'")
    assert {(r["relative_path"], r["indentation"]) for r in s.collect()} == {("a.go", "\t"), ("d.go", "\t")}
    line = spark.createDataFrame([("\t\u00a0x", "y \u2003"), ("x", "y"), ("  x", "y\r"), ("x ", "y")], "h string, t string")
    keys = [r[0] for r in line.select(extract.line_key(F.col("h"), F.col("t"))).collect()]
    assert keys[1] == keys[2] != keys[3]


def test_marks_tags_and_splits(spark):
    src = "package a\n\nfunc F[T any](x T) {\n\tgo run(x)\n\tdefer stop()\n\tselect {\n\tcase c <- 1:\n\t\ty = T{a: 1}\n\t}\n\tf := func() { log.Printf(\"z\") }\n}\n\ntype S struct {\n\tA int\n}\n"
    f = spark.createDataFrame([(1, "r", "a.go", src, True, "a" * 40, " G ")], "file_id bigint, repository_id string, relative_path string, content string, has_bom boolean, revision string, split_group string")
    s = extract.samples(f, ALL)
    assert failures(s, f) == {} and s.count() > 40
    rows = s.collect()
    assert {r["split_group"] for r in rows} == {"g"} and {r["revision"] for r in rows} == {"a" * 40} and min(r["caret_byte_offset"] - r["caret_utf16_offset"] for r in rows) == 3
    tags = lambda text: {t for r in rows if r["target_text"].startswith(text) for t in r["tags"]}
    assert "generics" in tags(" any](x") and "goroutine" in tags("run(x)") and "defer" in tags("stop()") and {"select", "channel"} <= tags("c <- 1") and "composite_literal" in tags("1}") and {"closure", "log_call"} <= tags("\"z\")") and "struct_type" in tags("A int")
    assert {x.name for x in schemas.SAMPLE.fields} == set(s.columns) - {"file_id"}


def test_corpus_and_exclusion_records(spark):
    f = files(spark).withColumn("has_bom", F.col("file_id") == 0)
    c = {r["file_id"]: r for r in extract.corpus_records(f).collect()}
    assert 5 not in c and c[0]["bytes"] == len(SRC.encode()) + 3 and c[1]["newline_style"] == "crlf" and c[4]["lines"] == 1
    assert {x.name for x in schemas.CORPUS.fields} == set(extract.corpus_records(f).columns) - {"file_id"}
    e = extract.exclusions(f, replace(ALL, sampling=replace(ALL.sampling, examples=2))).collect()
    assert e and max(sum(1 for x in e if (x["file_id"], x["reason"]) == k) for k in {(x["file_id"], x["reason"]) for x in e}) == 2
    assert any(x["reason"] == "line:blank" and x["line_text"] == "" for x in e) and any(x["reason"] == "secret_detected" for x in e)


def test_every_candidate_is_reconstructed(spark):
    f = files(spark)
    s = extract.samples(f, ALL).cache()
    assert s.count() > 300 and failures(s, f) == {}
    assert s.select("sample_id").distinct().count() == s.count()
    kinds = {r[0] for r in s.select("caret_kind").distinct().collect()}
    assert kinds == set(WEIGHTS)
    assert {r[0] for r in s.select("end_of_line").distinct().collect()} == {"LF", "CRLF", "EOF"}
    assert s.where("relative_path = 'f8.go'").count() == 0  # all of it stands in f0.go of the same repository
    assert s.where("target_text LIKE '%hunter2%'").count() == 0
    assert s.where("left_context_truncated").count() > 0 and s.where("octet_length(encode(left_context, 'UTF-16BE')) > 80").count() == 0


def test_same_samples_for_any_partitioning_and_caps_hold(spark):
    f = files(spark)
    ids = [sorted(r[0] for r in extract.samples(f.repartition(n)).select("sample_id").collect()) for n in (1, 4)]
    assert ids[0] == ids[1] and ids[0]
    s = extract.samples(f, replace(ALL, sampling=replace(ALL.sampling, per_line=2, per_file=9, repo_cap=7)))
    per = s.groupBy("repository_id").count().collect()
    assert per and max(r["count"] for r in per) <= 7
    thin = extract.samples(f, replace(ALL, sampling=replace(ALL.sampling, keep=0.3)))
    assert 0 < thin.count() < 0.5 * extract.samples(f, ALL).count()
    assert extract.samples(f.limit(0)).count() == 0


def test_columns_of_the_caret_need_no_file(spark):
    f = files(spark)
    some = ["sample_id", "repository_id", "relative_path", "caret_byte_offset", "caret_kind", "caret_subkind", "target_text"]
    for cfg in (Config(), ALL, replace(ALL, sampling=replace(ALL.sampling, keep=0.5, repo_cap=40))):
        narrow = extract.samples(f, cfg, columns=some)
        rows = sorted(map(repr, narrow.collect()))
        assert rows and rows == sorted(map(repr, extract.samples(f, cfg).select(some).collect()))
        assert "Join" not in narrow._jdf.queryExecution().executedPlan().toString()  # contents and facts were joined to every caret
    assert extract.samples(f, ALL, columns=["sample_id", "left_context"]).columns == ["sample_id", "left_context"]


def test_plans_stay_in_the_jvm(spark):
    """Filters and caps that need no lexer use no Python and limit groups before they shuffle."""
    from caretlake.operators import discovery as D

    plan = D.decide(files(spark).select("repository_id", "relative_path", "content"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_file_facts(spark):
    from caretlake.operators import gofiles

    rows = [(1, "a/x_windows.go", "package a\n"), (2, "x_test.go", "//go:build linux && !cgo\n\npackage b\n"), (3, "d/x_linux_arm64.go", "package c\n"), (4, "y.go", '// +build darwin\n\npackage d\n\nimport "C"\n'), (5, "z_amd64_test.go", None), (6, None, "package e"), (7, "linux.go", "package f\n// //go:build windows\n")]
    got = {r["file_id"]: tuple(r)[1:] for r in gofiles.file_facts(spark.createDataFrame(rows, "file_id bigint, relative_path string, content string")).collect()}
    assert got[1] == ("a", "a", None, False, False, False) and got[2] == ("b", ".", "//go:build linux && !cgo", True, False, True) and got[3][3] is False
    assert got[4][2:5] == ("// +build darwin", False, True) and got[5] == (None, ".", None, True, False, True) and got[6][0] == "e" and got[7][2:4] == (None, True)
    assert gofiles.name_matches("a_linux_test.go") and not gofiles.name_matches("a_arm64.go") and gofiles.name_matches("linux.go") and gofiles.name_matches("a_b_amd64.go")
