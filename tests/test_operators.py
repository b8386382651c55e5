"""File filter, lexer, sampling, validation, rendering, selection, sources, settings and streaming on small fixtures."""

import json
import os

import pytest
from pyspark.sql import functions as F

from caretlake import config
from caretlake.operators import discovery as D
from caretlake.operators import golexer as G
from caretlake.operators import rendering, reports, sampling, selection, semantics, validation
from caretlake.sources import records, tree
from caretlake.streaming.ingest import ingest_drops

GO = "package a\n\nfunc A() {}\n"
TREE = {
    "_hidden/h.go": (GO, "go_ignored_dir"), "api.pb.go": (GO + "//pb", "generated_path"), "cmd/app/main.go": (GO + "// m", None), "cmd/app/main_copy.go": (GO + "// m", "exact_duplicate"),
    "generated.go": ("// Code generated by x. DO NOT EDIT.\n\n" + GO, "generated_marker"), "service_test.go": (GO + "// t", None), "template.go": ("package {{.Package}}\n", "invalid_package_clause"), "late.go": ("var x = `\npackage a\n`\n", "invalid_package_clause"), "inside.go": ("/*\npackage a\n*/\n", "invalid_package_clause"), "headed.go": ("/* x **/ // y\n\n/* z */package b\n", None), "testdata/data.go": (GO, "testdata_path"),
    "vendor/x/y.go": (GO, "vendored_path"), "crlf.go": ("package a\r\n\r\nvar x = 1\r\n", None), "lone.go": ("package a\rvar x = 1\n", "lone_cr"), "empty.go": (" \n\t\n", "empty"), "nul.go": ("package a\x00\n", "binary_nul"),
    "long.go": ("package a\n// " + "x" * 2100 + "\n", "long_lines"), "secret.go": ('package a\nvar k = "AKIA' + "A1" * 8 + '"\n', "secret_detected"), "big.go": ("package a\n" + "// x\n" * 300_000, "too_large"), ".git/x.go": (GO, None),
    "_file.go": (GO + "// underscore", None), "notes.txt": ("x", None),
}
RAW = {"utf16.go": (b"\xff\xfep\x00", "utf16_encoding"), "bad.go": (b"package a\n// \xff\n", "invalid_utf8"), "bom.go": ("﻿package a\n".encode(), None)}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    at = tmp_path_factory.mktemp("tree")
    for name, content in {**{k: v[0].encode() for k, v in TREE.items()}, **{k: v[0] for k, v in RAW.items()}}.items():
        os.makedirs(os.path.dirname(at / name), exist_ok=True)
        (at / name).write_bytes(content)
    os.symlink(at / "crlf.go", at / "link.go")
    return str(at)


def test_tree_to_decisions(spark, root):
    files = tree.read_tree(spark, root, repository="r")
    got = {r["relative_path"]: (r["skip_reason"], r["duplicate_of"]) for r in D.decide(files).collect()}
    want = {k: v[1] for k, v in {**TREE, **RAW}.items() if not k.startswith(".git/") and k.endswith(".go")}
    assert {k: v[0] for k, v in got.items()} == want and got["cmd/app/main_copy.go"][1] == "cmd/app/main.go"
    counters = {r["counter"]: r["value"] for r in D.funnel(D.decide(files)).collect()}
    assert counters["files.discovered"] == len(want) and counters["files.accepted"] == 7 - 1 and counters["files.accepted_test"] == 1 and counters["files.skipped.exact_duplicate"] == 1
    skipped = tree.read_tree(spark, root, maxBytes="1000000").where("content IS NULL").select("relative_path").collect()
    assert [r[0] for r in skipped] == ["big.go"]


def test_decide_with_licences_and_nothing(spark):
    rows = [("r", "a.go", GO, "MIT"), ("r", "b.go", GO + "//", "GPL-3.0"), ("r", "c.go", None, "MIT"), (None, "d.go", GO, None), ("r", None, GO + "///", "MIT")]
    df = spark.createDataFrame(rows, "repository_id string, relative_path string, content string, lic string")
    got = {r["relative_path"]: r["skip_reason"] for r in D.decide(df, D.FilterConfig(allowed=D.ALLOWED), licence="lic").collect()}
    assert got == {"a.go": None, "b.go": "license_not_allowed", "c.go": "unreadable", "d.go": "license_not_allowed", None: None}
    assert D.decide(df.limit(0)).count() == 0 and D.funnel(D.decide(df.limit(0))).count() == 0


SRC = '''package a

import (
	"fmt"
	"log"
)

/* block
comment */
type T struct {
	Name string
}

func (t *T) Run(n int, f func(int) error) error {
	if err := f(n); err != nil {
		return fmt.Errorf("run %d: %w", n, err)
	}
	x := []string{"a", "b"}
	m := map[string]int{"k": 1}
	log.Printf("got %v", x)
	for i := range x {
		go func() { t.Name = x[i] }()
	}
	s := `raw
string`
	_, _ = m, s // tail
	return nil
}
'''


def test_lexer_covers_every_sign():
    for src in (SRC, SRC.replace("\n", "\r\n"), "package é\nvar 世 = 'x' + \"\\\"\" // é", "`open", "/* open", '"open\nx', "a<<=b&^=c...", ""):
        tokens, _ = G.lex(src)
        assert all(src[t.start : t.end] == t.text for t in tokens)
        rest = list(src)
        for t in tokens:
            rest[t.start : t.end] = " " * (t.end - t.start)
        assert "".join(rest).strip(" \t\r\n\x0b\x0c") == ""


def test_caret_kinds():
    found, excluded = G.carets(SRC)
    at = {(c.line, c.kind, c.subkind) for c in found if c.reason is None}
    lines = SRC.split("\n")
    ln = lambda s: next(i for i, x in enumerate(lines) if s in x)
    for want in (
        (ln("if err"), "error_handling", "if_err_init"), (ln("return fmt"), "error_handling", "err_body_return"), (ln("Printf"), "log_message", "template_start"), (ln("Printf"), "log_message", "template_body"), (ln("go func"), "func_literal", "go"),
        (ln("Printf"), "member_access", "package"), (ln("[]string"), "composite_literal", "open"), (ln("[]string"), "composite_literal", "next"), (ln("map["), "composite_literal", "key_value"), (ln("if err"), "error_handling", "if_err_cond"), (ln("x := "), "after_operator", ":="),
        (ln("x := "), "line_start", "short_var_decl"), (ln("func (t"), "line_start", "method_decl"), (ln("func (t"), "argument_list", "params_open"), (ln("f(n)"), "argument_list", "call_open"), (ln("Name string"), "line_start", "field"),
    ):
        assert want in at, want
    assert ("inside_block_comment" in {r for _, r in excluded}) and ("inside_raw_string" in {r for _, r in excluded})
    assert {c.reason for c in found if c.kind == "probe"} >= {"in_string", "in_comment"}
    assert any(c.reason == "raw_multiline_string" for c in found)
    assert len({c.offset for c in found}) == len(found) or len({(c.offset, c.kind) for c in found}) == len(found)


@pytest.mark.parametrize("text", ["", "package", "}}}}((((", "func (", 'if x { "', "é" * 50, "x" * 100_000, "{" * 5000])
def test_broken_sources_never_crash(text):
    G.carets(text)


def test_caret_table_offsets_are_bytes(spark):
    df = spark.createDataFrame([(1, "package é\nvar x = 1\n"), (2, None), (3, "")], "file_id bigint, content string")
    rows = G.caret_table(df).where("kind = 'line_start'").orderBy("byte_offset").collect()
    assert [(r["line"], r["byte_offset"]) for r in rows] == [(0, 0), (1, 11)]


@pytest.mark.parametrize("text, ok", [("//go:build linux", True), ("//go:build windows || (linux && !cgo)", True), ("//go:build !linux", False), ("//go:build go1.21", True), ("// +build linux,amd64 windows ; // +build !cgo", True), ("// +build darwin", False), ("", False)])
def test_build_constraints(text, ok):
    assert G.build_matches(text) is ok


def test_caps_thinning_and_owners(spark):
    df = spark.createDataFrame([("f", i % 3, float(i % 5), i) for i in range(30)], "file string, line int, score double, o int")
    two = sampling.cap(df, ["file", "line"], [F.col("score"), F.col("o")], 2)
    assert two.count() == 6 and sampling.cap(df, ["file"], [F.col("o")], 0).count() == 30
    plan = two._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    f = sampling.thinning_fractions(spark.createDataFrame([(100, 0), (1000, 900), (10, 10)], "total bigint, tests bigint"), 500, 0.35).orderBy("total").collect()
    assert [round(r["keep"], 6) for r in f] == [1.0, 1.0, 1.0] and round(f[2]["test_keep"], 6) == round(0.35 / 0.65 * 100 / 900, 6)
    claims = spark.createDataFrame([("h", "b", 1), ("h", "a", 1), ("h", "z", 2), ("k", "z", 3)], "hash string, repo string, size int")
    assert {tuple(r) for r in sampling.first_owner(claims, "hash", "repo", ["size"]).collect()} == {("h", "a"), ("k", "z")}
    repos = spark.createDataFrame([(f"r{i:03}", 10 if i % 7 else None) for i in range(200)], "repo_id string, samples bigint")
    got = sampling.batches(repos, 300).orderBy("repo_id").collect()
    want, total = [], 0
    for i in range(200):
        if total < 600:
            want.append(f"r{i:03}")
        total += 10 if i % 7 else 0
    assert [r["repo_id"] for r in got] == want
    assert sampling.batches(repos.limit(0), 10).count() == 0


def test_a_changed_target_fails_the_checks(spark):
    content = "package a\n\tx := é + 1 \n"
    files = spark.createDataFrame([("r", "a.go", content, 0)], "repository_id string, relative_path string, content string, bom int")
    s = [("r", "a.go", 16, 23, 10, 23, "x", "é + 1", "\tx := ", "")]
    cols = "repository_id string, relative_path string, caret_byte_offset bigint, target_end_byte_offset bigint, left_context_start_byte_offset bigint, right_context_end_byte_offset bigint, sample_id string, target_text string, left_context string, right_context string"
    row = validation.reconstructed(spark.createDataFrame(s, cols), files).first()
    assert row["file_left"] == row["left_context"] and row["file_target"] == "é + 1 "[: len(row["file_target"])]
    assert row["file_target"] != "tampered"


def test_report_counts_failures(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    got = {r["check"]: (r["rows"], r["failed"]) for r in validation.report(df, {"small": F.col("x") < 3, "any": F.lit(True)}).collect()}
    assert got == {"small": (3, 2), "any": (3, 0)}


def test_prompts(spark):
    df = spark.createDataFrame([("s", "train", "a.go", "one\ntwo\nthree", "four", "x")], "sample_id string, split string, relative_path string, left_context string, target_text string, facts string")
    facts = spark.createDataFrame([("s", 1, "OLD x\n"), ("s", 2, "RET error\n")], "sample_id string, ordinal int, facts string")
    r = rendering.render(df.drop("facts"), facts).first()
    assert r["prompt"] == "<|go|><|path|>a.go\n<|sem|>\nRET error\n<|code|>\none\ntwo\nthree<|complete|>" and r["completion"] == "four<|eol|>"
    cut = lambda n: df.select(rendering.cut_code(F.col("left_context"), n)).first()[0]
    assert cut(9) == "three" and cut(10) == "two\nthree" and cut(5) == "three" and cut(100) == "one\ntwo\nthree" and cut(6) == "three"


def test_facts_are_admitted_by_priority_within_the_budget(spark):
    line = lambda place, prio, key, items: F.struct(F.lit(float(place)).alias("place"), F.lit(prio).alias("priority"), F.lit(key).alias("key"), F.lit(" ").alias("sep"), F.array(*map(F.lit, items)).alias("items"))
    lines = F.array(line(0, 5, "RET", ["error"]), line(1, 0, "EXPECT", ["int"]), line(3, 4, "LOCAL", ["a:int", "b:int", "c:int"]))
    out = lambda n: spark.range(1).select(rendering.admit(lines, n)).first()[0]
    assert out(1000) == "RET error\nEXPECT int\nLOCAL a:int b:int c:int\n" and out(30) == "EXPECT int\nLOCAL a:int b:int\n" and out(11) == "EXPECT int\n" and out(3) == ""


def test_leaks_are_quarantined(spark):
    df = spark.createDataFrame([("s", ["foo", "bar", "baz"], "foo(bar)", ["bar"], "resolved", None)], "id string, facts array<string>, target string, visible array<string>, status string, reason string")
    r = semantics.quarantine(semantics.leak_audit(df, F.col("facts"), F.col("target"), F.col("visible")), "facts").first()
    assert (r["status"], r["reason"], r["facts"], r["violations"]) == ("failed", "leak_audit:foo", [], [])


def test_selection(spark):
    df = spark.createDataFrame([("o/a-lib", "o", "a go lib for x y"), ("o/b", "o", "a go lib for x z"), ("o/c", "o", ""), ("p/d", "p", "x y"), ("p/e", None, "x y"), ("p/f", "p", None)], "name string, block string, text string")
    df = df.withColumn("t", selection.token_set(F.col("text")))
    got = {(r["a"], r["b"]) for r in selection.similar_in_blocks(df, "name", "block", "t", 0.3).collect()}
    assert got == {("o/a-lib", "o/b")}
    g = {r["name"]: r["group"] for r in selection.groups(df, selection.similar_in_blocks(df, "name", "block", "t", 0.3), "name").collect()}
    assert g["o/b"] == "o/a-lib" and g["p/e"] == "p/e"
    p = spark.createDataFrame([(149999, "2026-10-09T00:00:00Z", True, True, 9)], "s bigint, p string, o boolean, d boolean, t int")
    assert p.select(selection.priority(*[F.col(c) for c in "spodt"], F.lit(1.0))).first()[0] == 1000
    assert selection.similar_in_blocks(df.limit(0), "name", "block", "t", 0.5).count() == 0


def test_percentiles_and_comparison(spark):
    vals = [5.0, 1.0, 3.0, 3.0, 9.0, None]
    r = reports.rank_percentiles(spark.createDataFrame([("a", v) for v in vals], "g string, v double"), ["g"], "v", {"p50": 0.5, "p95": 0.95}).first()
    assert (r["rows"], r["p50"], r["p95"]) == (5, 3.0, 9.0)
    a = spark.createDataFrame([("1", "x", ["a"]), ("2", "x", ["a"]), ("3", "x", ["a", "b"]), ("4", "x", None), ("5", "y", ["a"])], "k string, s string, l array<string>")
    b = spark.createDataFrame([("1", "x", ["a"]), ("2", "x", ["b", "a"]), ("3", "x", ["a"]), ("5", "z", ["a"]), ("6", "x", [])], "k string, s string, l array<string>")
    got = {x["outcome"]: x["records"] for x in reports.compare_records(a, b, ["k"], ["s"], ["l"]).collect()}
    assert got == {"identical": 1, "subset": 1, "superset": 1, "only_left": 1, "different": 1, "only_right": 1}


def test_settings():
    c = config.load('{"seed": 7, "sampling": {"per_line": 3}}')
    assert c.seed == 7 and c.sampling.per_line == 3 and c.sha256() != config.Config().sha256() and len(c.sha256()) == 64
    for bad in ('{"sed": 1}', '{"sampling": {"x": 1}}', '{"test": 2}', '{"sampling": {"weights": {"nope": 1}}}', '{"secrets": ["("]}'):
        with pytest.raises(ValueError):
            config.load(bad)


def test_records(spark, tmp_path):
    df = spark.createDataFrame([("a", None, "train"), ("b<&", 2, "test")], "id string, n int, split string")
    records.write_jsonl(df, str(tmp_path / "x"), gzip=True)
    assert sorted(map(tuple, records.read_jsonl(spark, str(tmp_path / "x"), df.schema).collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(Exception, match="(?i)exists"):
        records.write_jsonl(df, str(tmp_path / "x"))
    (tmp_path / "broken.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n{"a": \n{"a": 4}\n')
    (tmp_path / "cut.jsonl").write_text('{"a": 1}\n{"a": 2')
    got = records.salvage(spark, str(tmp_path / "*.jsonl")).collect()
    assert sorted((os.path.basename(r["file"]), json.loads(r["value"])["a"]) for r in got) == [("broken.jsonl", 1), ("broken.jsonl", 2), ("cut.jsonl", 1)]
    records.write_split_parquet(df, str(tmp_path / "p"))
    assert sorted(os.listdir(tmp_path / "p"))[-2:] == ["split=test", "split=train"]
    records.publish(df, str(tmp_path / "out"))
    with pytest.raises(FileExistsError):
        records.publish(df, str(tmp_path / "out"))
    records.publish(df.limit(1), str(tmp_path / "out"), overwrite=True)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert tree.module_of("module example.com/x\n\ngo 1.22\n") == ("example.com/x", "1.22") and tree.module_of(None) == (None, None)


def test_revision(tmp_path):
    git = tmp_path / ".git"
    git.mkdir()
    assert tree.revision_of(str(tmp_path)) is None
    (git / "HEAD").write_text("ref: refs/heads/main\n")
    (git / "packed-refs").write_text("# pack\n" + "a" * 40 + " refs/heads/main\n")
    assert tree.revision_of(str(tmp_path)) == "a" * 40


def test_streaming_drops(spark, tmp_path):
    schema = "repository_id string, relative_path string, content string"
    for k, rows in enumerate(([("r", "a.go", GO)], [("r", "vendor/b.go", GO), ("r", "c.go", None)])):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        ingest_drops(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, str(tmp_path / "out"), str(tmp_path / "cp"))
        got = {r["relative_path"]: r["skip_reason"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
        assert got["a.go"] is None and len(got) == (1 if k == 0 else 3)
    assert got == {"a.go": None, "vendor/b.go": "vendored_path", "c.go": "unreadable"}
