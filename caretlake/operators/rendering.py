"""Prompts and completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretlake.functions.text import last_units, utf16_len

# Marks of the prompt layout.
GO, PATH, SEM, CODE, COMPLETE, EOL = "<|go|>", "<|path|>", "<|sem|>", "<|code|>", "<|complete|>", "<|eol|>"
# Lines of facts: key, place in the prompt, priority (0 is admitted first), what joins their items.
LINES = [("RET", 0, 5, " "), ("EXPECT", 1, 0, " "), ("ARG", 2, 3, " "), ("LOCAL", 3, 4, " "), ("FIELD", 4, 7, " "), ("METHOD", 6, 9, "; "), ("RECV", 7, 1, " "), ("MEMBER", 8, 6, "; "), ("CALL", 9, 2, " | ")]
TYPE = ("TYPE", 8.5, 8, "; ")  # one line a context type, a hundredth of a place apart


def cut_code(left: Column, units: int) -> Column:
    """The last ``units`` UTF-16 units, from the line after the cut on unless that leaves nothing."""
    cut = last_units(left, units)
    first = F.instr(cut, F.lit("\n"))
    whole = utf16_len(left) <= units
    return F.when(whole | (first == 0) | (first == F.length(cut)), cut).otherwise(F.substr(cut, first + 1))


def prompt(path: Column, facts: Column | None, left: Column) -> Column:
    sem = F.when(F.length(F.coalesce(facts, F.lit(""))) > 0, F.concat(F.lit(SEM + "\n"), facts)).otherwise("") if facts is not None else F.lit("")
    return F.concat(F.lit(GO + PATH), path, F.lit("\n"), sem, F.lit(CODE + "\n"), left, F.lit(COMPLETE))


def completion(target: Column) -> Column:
    return F.concat(target, F.lit(EOL))


def admitted(lines: Column, budget: int, most: int = 24) -> Column:
    """struct(text, dropped): greedy admission of fact lines by priority within a budget of UTF-16 units.

    ``lines`` is an array of struct(place, priority, key, sep, items). A line costs its text and a line end; it has at
    most ``most`` items, and one that does not fit loses items from its end until it does, and is left out if none
    remain. The text holds the admitted lines in the order of their places; ``dropped`` counts the items left out. A
    fold over the array, in the JVM.
    """
    text = lambda key, sep, items: F.concat(key, F.lit(" "), F.call_function("array_join", items, sep))
    by_priority = F.array_sort(F.transform(lines, lambda x: F.struct(x["priority"].alias("p"), x["place"].alias("o"), x["key"].alias("key"), x["sep"].alias("sep"), x["items"].alias("items"))))

    def step(acc: Column, x: Column) -> Column:
        held = F.slice(x["items"], 1, most)
        tries = F.transform(F.sequence(F.size(held), F.lit(0), F.lit(-1)), lambda n: F.slice(held, 1, n))
        fits = F.filter(tries, lambda t: (F.size(t) > 0) & (utf16_units(text(x["key"], x["sep"], t)) + 1 <= acc["left"]))
        best = F.get(fits, F.lit(0))
        line = text(x["key"], x["sep"], best)
        took = best.isNotNull()
        return F.struct(
            F.when(took, acc["left"] - utf16_units(line) - 1).otherwise(acc["left"]).alias("left"),
            F.when(took, F.concat(acc["out"], F.array(F.struct(x["o"].alias("o"), line.alias("line"))))).otherwise(acc["out"]).alias("out"),
            (acc["dropped"] + F.size(x["items"]) - F.when(took, F.size(best)).otherwise(0)).alias("dropped"),
        )

    start = F.struct(F.lit(budget).alias("left"), F.expr("CAST(array() AS array<struct<o: double, line: string>>)").alias("out"), F.lit(0).alias("dropped"))
    done = F.aggregate(by_priority, start, step)
    return F.struct(F.array_join(F.transform(F.array_sort(done["out"]), lambda x: F.concat(x["line"], F.lit("\n"))), "").alias("text"), done["dropped"].alias("dropped"))


def admit(lines: Column, budget: int, most: int = 24) -> Column:
    """The text of ``admitted``."""
    return admitted(lines, budget, most)["text"]


def closing(s: Column, start: Column, opens: str, closes: str) -> Column:
    """The place (from 1) of the bracket that closes the one at ``start``; 0 if none does."""

    def step(acc: Column, c: Column) -> Column:
        depth = acc["depth"] + F.when(c == opens, 1).when(c == closes, -1).otherwise(0)
        found = F.when(acc["found"] > 0, acc["found"]).when((c == closes) & (depth == 0), acc["at"]).otherwise(0)
        return F.struct(depth.alias("depth"), (acc["at"] + 1).alias("at"), found.alias("found"))

    first = F.struct(F.lit(0).alias("depth"), start.cast("int").alias("at"), F.lit(0).alias("found"))
    return F.aggregate(F.split(F.substr(s, start), ""), first, step)["found"]


def _let(c: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(c), use)[0]


def compact_signature(s: Column) -> Column:
    """``Name(params) results`` as ``Name(params)->results``; type parameters before the parameters stay, other texts too."""

    def parameters(s: Column) -> Column:
        first, square = F.instr(s, F.lit("(")), F.instr(s, F.lit("["))
        past = lambda end: F.when(end > 0, F.nullif(F.instr(F.substr(s, end), F.lit("(")), F.lit(0)) + end - 1)
        return F.when((square > 0) & (square < first), F.coalesce(_let(closing(s, square, "[", "]"), past), first)).otherwise(first)

    def cut(s: Column, close: Column) -> Column:
        rest = F.trim(F.substr(s, close + 1))
        return F.when(close == 0, s).when(rest == "", F.substr(s, F.lit(1), close)).otherwise(F.concat(F.substr(s, F.lit(1), close), F.lit("->"), rest))

    close = lambda s: _let(parameters(s), lambda start: F.when(start > 0, closing(s, start, "(", ")")).otherwise(0))
    return _let(s, lambda s: _let(close(s), lambda end: cut(s, end)))


def callee(name: Column, signature: Column) -> Column:
    """A call's name before its signature in compact form; a signature that is not anonymous follows after a blank."""
    bare = signature.startswith("(") | signature.startswith("[")
    return F.when(name.isNull(), signature).when(bare, compact_signature(F.concat(name, signature))).otherwise(F.concat(name, F.lit(" "), signature))


def typed(facts: Column) -> Column:
    """``name:type`` of each fact, the name alone where no type is known."""
    return F.transform(facts, lambda f: F.concat(f["name"], F.coalesce(F.concat(F.lit(":"), f["type"]), F.lit(""))))


def compact(facts: Column) -> Column:
    """The signature of each fact in compact form, else its name, with its type unless it is a type itself."""
    return F.transform(facts, lambda f: F.when(f["signature"].isNotNull(), compact_signature(f["signature"])).when(f["kind"] == "type", f["name"]).otherwise(F.concat(f["name"], F.coalesce(F.concat(F.lit(":"), f["type"]), F.lit("")))))


FACT = "struct<name: string, kind: string, type: string, signature: string>"
#: Columns of a record of facts about a caret, beside sample_id, visibility_policy, status and ordinal.
RECORD = (
    f"return_type string, expected_type string, parameters array<{FACT}>, locals array<{FACT}>, receiver_members array<{FACT}>, receiver_type string, receiver_kind string, members array<{FACT}>, "
    f"context_types array<struct<name: string, members: array<{FACT}>>>, call_signature string, call_name string, argument_index int, parameter_name string"
)


def fact_lines(types: bool = True) -> Column:
    """The lines of a record (columns of ``RECORD``) for ``admitted``: one a key, context types each one of their own; empty ones are left out."""
    c, text = F.col, lambda x: F.array(x)
    none = F.expr("CAST(array() AS array<string>)")
    place = {key: (p, order, sep) for key, p, order, sep in LINES}

    def line(key: str, items: Column) -> Column:
        p, order, sep = place[key]
        return F.struct(F.lit(float(p)).alias("place"), F.lit(order).alias("priority"), F.lit(key).alias("key"), F.lit(sep).alias("sep"), F.filter(F.coalesce(items, none), lambda x: x.isNotNull() & (x != "")).alias("items"))

    method = lambda f: F.coalesce(f["kind"] == "method", F.lit(False))
    recv = F.when(c("receiver_kind").isin("package", "type"), F.concat("receiver_kind", F.lit(" "), "receiver_type")).otherwise(c("receiver_type"))
    call = F.concat(
        callee(c("call_name"), c("call_signature")), F.coalesce(F.concat(F.lit(" @"), c("argument_index").cast("string")), F.lit("")),
        F.coalesce(F.concat(F.lit(" "), "parameter_name", F.coalesce(F.concat(F.lit(":"), "expected_type"), F.lit(""))), F.lit("")),
    )
    lines = F.array(
        line("RET", text(c("return_type"))), line("EXPECT", text(c("expected_type"))), line("ARG", typed(c("parameters"))), line("LOCAL", typed(c("locals"))), line("FIELD", typed(F.filter("receiver_members", lambda f: ~method(f)))),
        line("METHOD", compact(F.filter("receiver_members", method))), line("RECV", text(recv)), line("MEMBER", compact(c("members"))), line("CALL", text(call)),
    )
    if types:
        p, order, sep = TYPE[1:]
        each = F.transform(F.coalesce("context_types", F.expr(f"CAST(array() AS array<struct<name: string, members: array<{FACT}>>>)")), lambda t, i: F.struct((F.lit(p) + i * 0.01).alias("place"), F.lit(order).alias("priority"), F.concat(F.lit(TYPE[0] + " "), t["name"], F.lit(":")).alias("key"), F.lit(sep).alias("sep"), F.filter(F.coalesce(compact(t["members"]), none), lambda x: x.isNotNull() & (x != "")).alias("items")))
        lines = F.concat(lines, each)
    return F.filter(lines, lambda x: F.size(x["items"]) > 0)


def debug_prompt() -> Column:
    """The lines of a record in a fixed order, without budget, joined by line ends; for reading only."""
    c = F.col
    said = lambda facts: F.transform(F.coalesce(facts, F.expr(f"CAST(array() AS array<{FACT}>)")), lambda f: F.coalesce(f["signature"], F.concat(f["name"], F.lit(":"), f["type"]), f["name"]))
    one = lambda key, v: F.when(v.isNotNull(), F.concat(F.lit(key + " "), v))
    many = lambda key, items: F.when(F.size(items) > 0, F.concat(key if isinstance(key, Column) else F.lit(key), F.lit(" "), F.array_join(items, " ")))
    types = F.transform(F.coalesce("context_types", F.expr(f"CAST(array() AS array<struct<name: string, members: array<{FACT}>>>)")), lambda t: many(F.concat(F.lit("TYPE "), t["name"], F.lit(":")), said(t["members"])))
    lines = F.array(
        one("EXPECT", c("expected_type")), one("RECV", c("receiver_type")), one("CALL", c("call_signature")), many("ARG", said(c("parameters"))), many("LOCAL", said(c("locals"))), one("RET", c("return_type")),
        many("MEMBER", said(c("members"))), many("THIS", said(c("receiver_members"))),
    )
    return F.array_join(F.filter(F.concat(lines, types), lambda x: x.isNotNull()), "\n")


def utf16_units(c: Column) -> Column:
    return utf16_len(c)


def render(samples: DataFrame, facts: DataFrame | None = None, code_units: int = 4000) -> DataFrame:
    """(sample_id, split, prompt, completion); facts (sample_id, facts) of the last record of a sample are put in."""
    s = samples
    if facts is not None:
        s = s.join(facts.groupBy("sample_id").agg(F.max_by("facts", "ordinal").alias("facts")), "sample_id", "left")
    return s.select("sample_id", "split", prompt(F.col("relative_path"), F.col("facts") if facts is not None else None, cut_code(F.col("left_context"), code_units)).alias("prompt"), completion(F.col("target_text")).alias("completion"))


def chosen_records(records: DataFrame, policy: str) -> DataFrame:
    """The last record (by ``ordinal``) of each sample under a visibility policy; earlier ones and other policies do not count."""
    r = records.where(F.col("visibility_policy") == policy)
    return r.groupBy("sample_id").agg(F.max_by(F.struct(*[c for c in r.columns if c != "sample_id"]), "ordinal").alias("r")).select("sample_id", "r.*")


def train_records(samples: DataFrame, records: DataFrame, policy: str = "editor_snapshot", code_units: int = 4000, fact_units: int = 1200, most: int = 24, types: bool = True) -> DataFrame:
    """One training record per sample, with the facts of its record under ``policy`` if that is resolved, at least in part.

    Facts of failed records are never shown. A sample without record has a prompt without facts.
    """
    shown = F.col("status").isin("resolved", "partially_resolved")
    r = chosen_records(records, policy).where(shown).select("sample_id", admitted(fact_lines(types), fact_units, most).alias("facts"))
    text, code = F.coalesce("facts.text", F.lit("")), cut_code(F.col("left_context"), code_units)
    cut = (utf16_len(F.col("left_context")) > code_units) | F.col("left_context_truncated")
    return samples.join(r, "sample_id", "left").select(
        F.lit("caretlake-train/v1").alias("schema_version"), "sample_id", "split", "caret_kind", "semantic_status", (text != "").alias("has_semantic"), prompt(F.col("relative_path"), text, code).alias("prompt"), completion(F.col("target_text")).alias("completion"),
        utf16_len(code).alias("code_chars"), cut.alias("code_truncated"), utf16_len(text).alias("semantic_chars"), F.coalesce("facts.dropped", F.lit(0)).alias("semantic_items_dropped"),
    )


def preview(lines: int = 40) -> Column:
    """A section of a preview for a row of (caret_kind, relative_path, caret_line_zero_based, semantic_status, prompt, completion): the prompt's head and its last lines of code."""
    mark = F.lit(CODE + "\n")
    head, code = F.substring_index("prompt", CODE + "\n", 1), F.substr("prompt", F.instr("prompt", mark) + F.length(mark))
    rows = F.split(code, "\n", -1)
    tail = F.when(F.size(rows) > lines, F.concat(F.array(F.lit("\u2026")), F.slice(rows, -lines, lines))).otherwise(rows)
    shown = F.when(F.contains("prompt", mark), F.concat(head, mark, F.array_join(tail, "\n"))).otherwise(F.col("prompt"))
    where = F.concat("relative_path", F.lit(":"), (F.col("caret_line_zero_based") + 1).cast("string"))
    return F.concat(F.lit("## "), "caret_kind", F.lit(" `"), where, F.lit("` ("), "semantic_status", F.lit(")\n\n```text\n"), shown, F.lit("\n```\n\nCOMPLETION: `"), "completion", F.lit("`\n"))
