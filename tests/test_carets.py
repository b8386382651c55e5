"""Kinds of carets that the reference tells apart, far from where a statement starts too."""

from caretlake.operators import golexer as G

LONG = ", ".join(f"a{i}" for i in range(60))
SRC = f"""package p

func run(err error) error {{
	if errors.Is(err, io.EOF) {{
		work()
		if deep {{
			return nil
		}}
		return err
	}}
	if errors.As(err, &t) && ok {{
		plain()
	}}
	if err := f({LONG}); err != nil {{
		stop()
	}}
	for {", ".join(f"a{i}" for i in range(9))} = range g() {{
	}}
	func() {{ once() }}()
	x := func() int {{ return 1 }}()
	defer func() {{ late() }}()
	s.list[{LONG.replace(", ", " + ")}] = 1
	call()
	y := 2
	return nil
}}
"""


def test_kinds_of_error_handling_and_long_statements():
    lines = SRC.split("\n")
    at = {(lines[c.line].strip()[:12], c.kind, c.subkind) for c in G.carets(SRC, max_line=5000, max_target=5000)[0] if c.reason is None}
    for want in (
        ("if errors.Is", "error_handling", "if_err_is"), ("if errors.Is", "error_handling", "if_err_cond"), ("work()", "error_handling", "err_body_call_stmt"), ("if deep {", "error_handling", "err_body_if"), ("return nil", "error_handling", "err_return"),
        ("return err", "error_handling", "err_body_return"), ("if errors.As", "line_start", "if"), ("plain()", "line_start", "call_stmt"), ("if err := f(", "error_handling", "if_err_init"), ("if err := f(", "error_handling", "if_err_cond"),
        ("stop()", "error_handling", "err_body_call_stmt"), ("for a0, a1, ", "line_start", "range_for"), ("func() { onc", "func_literal", "immediately_invoked"), ("x := func() ", "func_literal", "immediately_invoked"), ("defer func()", "func_literal", "defer"),
        ("s.list[a0 + ", "line_start", "assignment"), ("call()", "line_start", "call_stmt"), ("y := 2", "line_start", "short_var_decl"),
    ):
        assert want in at, want


def test_syntax_errors_reach_the_flags(spark):
    assert not G.has_syntax_errors(SRC) and not G.has_syntax_errors('package p\nvar s, r = "a\\\\", \'\\\'\' // }\n')
    for bad in (SRC[:-3], SRC + "}", "package p\nvar s = \"open\nx", "package p\nvar a = `open", "package p\n/* open", "package p\nvar a = 1 # 2", "func f() {}"):
        assert G.has_syntax_errors(bad), bad
    from caretlake.operators.extract import samples

    rows = [(1, "r", "a.go", SRC + "}\n"), (2, "r2", "b.go", SRC)]
    got = samples(spark.createDataFrame(rows, "file_id bigint, repository_id string, relative_path string, content string")).select("file_id", "quality_flags").collect()
    assert {r["file_id"] for r in got} == {1, 2} and all(("file_has_syntax_errors" in r["quality_flags"]) == (r["file_id"] == 1) for r in got)
