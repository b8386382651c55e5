"""Facts as lines, snapshots without the target, and what goes to the published tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caretlake.operators import rendering as R
from caretlake.operators import semantics
from caretlake.sources import records


@pytest.mark.parametrize(
    "s, want",
    [
        ("Get(key K, opts ...Option[K, V]) *Item[K, V]", "Get(key K, opts ...Option[K, V])->*Item[K, V]"), ("Close()", "Close()"), ("Run(f func(int) error) (n int, err error)", "Run(f func(int) error)->(n int, err error)"), ("New[K comparable, V any](n int) *T[K, V]", "New[K comparable, V any](n int)->*T[K, V]"),
        ("plain", "plain"), ("open(a", "open(a"), ("x[3] y", "x[3] y"), ("M(m map[string][]int)  bool ", "M(m map[string][]int)->bool"), ("", ""), (None, None), ("f[func(int)](a) b", "f[func(int)](a)->b"),
    ],
)
def test_compact_signatures(spark, s, want):
    df = spark.createDataFrame([(s,)], "s string")
    assert df.select(R.compact_signature(F.col("s"))).first()[0] == want


def test_callees(spark):
    rows = [("Add", "(a int) error"), ("Map", "[T any](x T) T"), ("v", "Type"), (None, "(a int)"), ("n", None)]
    got = [r[0] for r in spark.createDataFrame(rows, "n string, s string").select(R.callee(F.col("n"), F.col("s"))).collect()]
    assert got == ["Add(a int)->error", "Map[T any](x T)->T", "v Type", "(a int)", None]


def one_record(spark, **given):
    full = dict.fromkeys([x.split(" ")[0] for x in ("return_type expected_type parameters locals receiver_members receiver_type receiver_kind members context_types call_signature call_name argument_index parameter_name").split()])
    return spark.createDataFrame([tuple((full | given).values())], R.RECORD)


FULL = {
    "return_type": "error", "expected_type": "string", "parameters": [("ctx", "param", "context.Context", None)], "locals": [("n", "var", "int", None), ("u", "var", None, None)], "receiver_members": [("name", "field", "string", None), ("Get", "method", None, "Get(k int) string")],
    "receiver_type": "http", "receiver_kind": "package", "members": [("Do", "func", None, "Do(r *Request) (*Response, error)"), ("Header", "type", "map", None)], "context_types": [("Opt", [("A", "field", "int", None)]), ("Empty", [])], "call_signature": "(a string) int", "call_name": "Len", "argument_index": 0, "parameter_name": "a",
}


def test_lines_stand_in_order_and_are_admitted_by_priority(spark):
    df = one_record(spark, **FULL)
    text = lambda budget, **kw: df.select(R.admitted(R.fact_lines(**kw), budget)).first()[0]
    whole = text(1000)
    assert whole["text"] == "RET error\nEXPECT string\nARG ctx:context.Context\nLOCAL n:int u\nFIELD name:string\nMETHOD Get(k int)->string\nRECV package http\nMEMBER Do(r *Request)->(*Response, error); Header\nTYPE Opt: A:int\nCALL Len(a string)->int @0 a:string\n"
    assert whole["dropped"] == 0 and "TYPE" not in text(1000, types=False)["text"]
    small = text(60)
    assert small["text"] == "EXPECT string\nRECV package http\nCALL" + whole["text"].split("CALL")[1] if len("EXPECT string\nRECV package http\n") + len("CALL Len(a string)->int @0 a:string\n") <= 60 else small["text"].startswith("EXPECT string\n")
    assert len(small["text"]) <= 60 and small["dropped"] > 0
    tight = df.select(R.admitted(R.fact_lines(), 1000, 1)).first()[0]
    assert tight["dropped"] == 2 and "LOCAL n:int\n" in tight["text"]
    assert one_record(spark).select(R.admitted(R.fact_lines(), 99)).first()[0].asDict() == {"text": "", "dropped": 0}
    assert df.select(R.debug_prompt()).first()[0].split("\n")[:4] == ["EXPECT string", "RECV http", "CALL (a string) int", "ARG ctx:context.Context"] and one_record(spark).select(R.debug_prompt()).first()[0] == ""


def test_only_resolved_records_of_the_policy_are_shown(spark):
    rec = one_record(spark, return_type="error").first()
    cols = "sample_id string, status string, visibility_policy string, ordinal int, " + R.RECORD
    rows = [("a", "resolved", "editor_snapshot", 1, *rec), ("b", "failed", "editor_snapshot", 1, *rec), ("c", "resolved", "strict_prefix", 1, *rec), ("d", "resolved", "editor_snapshot", 1, *rec), ("d", "failed", "editor_snapshot", 2, *rec), ("gone", "resolved", "editor_snapshot", 1, *rec)]
    s = spark.createDataFrame([(k, "train", "line_start", "resolved", "p.go", "x\ny" * 5, False, "t") for k in "abcde"], "sample_id string, split string, caret_kind string, semantic_status string, relative_path string, left_context string, left_context_truncated boolean, target_text string")
    t = {r["sample_id"]: r for r in R.train_records(s, spark.createDataFrame(rows, cols), code_units=6).collect()}
    assert {k: r["has_semantic"] for k, r in t.items()} == {"a": True, "b": False, "c": False, "d": False, "e": False}
    assert t["a"]["prompt"] == "<|go|><|path|>p.go\n<|sem|>\nRET error\n<|code|>\nyx\ny<|complete|>" and t["a"]["code_truncated"] and t["a"]["code_chars"] == 4 and t["a"]["semantic_chars"] == 10
    shown = spark.createDataFrame([("k", "a.go", 4, "resolved", "h<|code|>\n" + "\n".join(map(str, range(50))), "c")], "caret_kind string, relative_path string, caret_line_zero_based int, semantic_status string, prompt string, completion string").select(R.preview(3)).first()[0]
    assert shown == "## k `a.go:5` (resolved)\n\n```text\nh<|code|>\n…\n47\n48\n49\n```\n\nCOMPLETION: `c`\n"
    assert R.train_records(s.limit(0), spark.createDataFrame([], cols)).count() == 0


def test_snapshots(spark):
    df = spark.createDataFrame([("f(a, []int{\"(\", '[', `{`, // (\n", "x)"), ("", None), ("}})", "y"), ("a /* ( ", "z")], "b string, a string")
    assert [r[0] for r in df.select(semantics.open_brackets(F.col("b"))).collect()] == ["})", "", "", ""]
    assert df.select(semantics.snapshot(F.col("b"), F.col("a"), "strict_prefix")).first()[0].endswith("\n}\n)\n")
    assert df.select(semantics.snapshot(F.col("b"), F.col("a"), "editor_snapshot")).first()[0].endswith("x)")


def test_merging_and_manifests(spark, tmp_path):
    one, two = spark.createDataFrame([("a", "train", 1)], "id string, split string, n int"), spark.createDataFrame([("b", "test")], "id string, split string")
    records.merge_parquet([one, two], str(tmp_path / "m"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "m")).select("id", "split", "n").collect()} == {("a", "train", 1), ("b", "test", None)}
    records.write_json(spark, str(tmp_path / "x.json"), {"a": 1})
    records.write_json(spark, str(tmp_path / "x.json"), {"a": 2})
    assert (tmp_path / "x.json").read_text() == '{\n "a": 2\n}\n'
    p = records.project(one, T.StructType([T.StructField("n", T.LongType()), T.StructField("gone", T.StringType())]))
    assert p.first().asDict() == {"n": 1, "gone": None}
    m = [spark.createDataFrame(x, "repository_id string, v int") for x in ([("a", 1), ("b", 2), ("b", 1), (None, 9)], [("b", 7), ("c", 3)])]
    got = {r["repository_id"]: r["v"] for r in records.remaining(m, spark.createDataFrame([("a",), (None,)], "repository_id string")).collect()}
    assert got == {"b": 1, "c": 3, None: 9}


def test_gates_and_groups(spark):
    from caretlake.operators import selection as G

    df = spark.createDataFrame([("a", 1, None), ("b", 500, "x"), ("c", None, "x"), ("xkcdqrtplmn1234", 50, "x")], "k string, n int, t string")
    rules = {"small": F.col("n") < 10, "no_text": F.col("t").isNull(), "large": F.col("n") > 100}
    r = df.withColumn("r", G.reasons(rules)).withColumn("f", G.first_reason(rules, {"large": F.col("n")}))
    got = {x["k"]: (x["r"], x["f"]) for x in r.collect()}
    assert got == {"a": (["no_text", "small"], "small"), "b": (["large"], "large:500"), "c": ([], None), "xkcdqrtplmn1234": ([], None)}
    chosen, rejected = G.outcomes(r, "k", "r", [F.desc_nulls_last("n")])
    assert [x["k"] for x in chosen.collect()] == ["xkcdqrtplmn1234", "c"] and [x["k"] for x in rejected.collect()] == ["a", "b"]
    assert [x["o"] for x in df.select(G.odd_name(F.col("k")).alias("o")).collect()] == [False, False, False, True]
    edges = lambda root: {tuple(x) for x in G.one_group(df.limit(3), "k", root).collect()}
    assert edges(None) == {("a", "b"), ("a", "c")} and edges("b") == {("b", "a"), ("b", "c")} and edges("z") == edges(None)
