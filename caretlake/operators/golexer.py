"""Go tokens, and the carets at which a line may be completed.

The lexer follows the public Go language specification. What a full parser would tell is read off the tokens: brackets
know whether they belong to a call, parameters, an index, a composite literal or a block by what stands before them, and
a line's statement kind by how it starts. In files with syntax errors carets are a best effort.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from caretlake.functions.regexes import re2_to_java
from caretlake.operators.discovery import LINE_SECRET
from caretlake.session import spread

KEYWORDS = frozenset("break case chan const continue default defer else fallthrough for func go goto if import interface map package range return select struct switch type var".split())
# Operators and keywords after which a caret stands.
AFTER_OPERATOR = frozenset("= := += -= *= /= %= &= |= ^= <<= >>= &^= == != < > <= >= && || <-".split())
AFTER_KEYWORD = frozenset("return go defer range case var const type else func import package goto chan map".split())
CONTROL = frozenset("if for switch select".split())
# Functions whose argument of this index is a message, and names of loggers and error constructors.
FORMAT_FUNCS = dict.fromkeys("Printf Sprintf Errorf Fatalf Panicf Logf Infof Debugf Warnf Warningf Tracef Noticef Criticalf Skipf Msgf".split(), 0) | {"Fprintf": 1, "Appendf": 1}
MESSAGE_FUNCS = dict.fromkeys("Info Debug Warn Warning Error Fatal Panic Print Println Trace Msg Log".split(), 0) | dict.fromkeys("InfoContext DebugContext WarnContext ErrorContext".split(), 1)
LOGGER = re.compile(r"(?i)^(log|slog|logger|l|lg|logrus|zap|klog|glog|log15|zerolog|t|b|tb|s|sugar)$|(?i:log(ger)?)$")
ERROR_FUNCS = frozenset("New Wrap Wrapf Errorf WithMessage WithMessagef Is As Join Unwrap WithStack".split())
# Priority of caret kinds (0 wins) and weight of each in sampling.
PRIORITY = {k: i for i, k in enumerate("log_message error_handling func_literal member_access line_start control_flow composite_literal argument_list after_keyword after_operator identifier_partial token_boundary".split())}
WEIGHTS = {
    "line_start": 0.7, "identifier_partial": 0.035, "member_access": 0.8, "argument_list": 0.5, "composite_literal": 0.4, "after_keyword": 0.5,
    "after_operator": 0.4, "control_flow": 0.6, "func_literal": 0.8, "error_handling": 0.6, "log_message": 1.0, "token_boundary": 0.02,
}

_TOKEN = re.compile(
    r"[ \t\r\n\x0b\x0c]*+(?:(?P<ident>[^\W\d]\w*)|(?P<comment>//[^\n]*|/\*.*?(?:\*/|\Z))|(?P<raw>`[^`]*(?:`|\Z))|(?P<string>\"(?:[^\"\\\n]|\\.)*(?:\"|(?=\n)|\Z))|(?P<char>'(?:[^'\\\n]|\\.)*(?:'|(?=\n)|\Z))"
    r"|(?P<number>0[xX][\da-fA-F_]*(?:\.[\da-fA-F_]*)?(?:[pP][+-]?\d+)?i?|0[bBoO][\d_]+i?|(?:\d[\d_]*\.?[\d_]*|\.\d[\d_]*)(?:[eE][+-]?\d+)?i?)"
    r"|(?P<op><<=|>>=|&\^=|\.\.\.|:=|\+=|-=|\*=|/=|%=|&=|\|=|\^=|==|!=|<=|>=|&&|\|\||<-|\+\+|--|<<|>>|&\^|[-+*/%&|^<>=!()\[\]{},;.:~])|(?P<end>\Z)|(?P<bad>.))",
    re.S,
)


_BRACKETS, _CLOSERS = frozenset("()[]{}"), {")": "(", "]": "[", "}": "{"}


class Token(NamedTuple):
    kind: str  # ident, keyword, op, number, string, raw, char, comment
    start: int
    end: int
    text: str


def lex(src: str) -> tuple[list[Token], int]:
    """Tokens with their places (in characters) and the number of signs that belong to none."""
    out, bad, new = [], 0, tuple.__new__
    for m in _TOKEN.finditer(src):
        kind, text = m.lastgroup, m[m.lastindex]
        end = m.end()
        start = end - len(text)
        if kind == "ident":
            if text in KEYWORDS:
                kind = "keyword"
        elif kind == "comment":
            if text.endswith("\r") and text.startswith("//"):
                text, end = text[:-1], end - 1
        elif kind == "bad":
            bad += text != "﻿"
            continue
        elif kind == "end":
            continue
        out.append(new(Token, (kind, start, end, text)))
    return out, bad


def brackets(code: list[Token]) -> tuple[list[str], list[str]]:
    """For each token: what kind its bracket opens ("" if none), and the innermost open kind before it."""
    opens, inside, stack = [], [], []
    for i, (what, _, _, text) in enumerate(code):
        inside.append(stack[-1] if stack else "")
        if what != "op" or text not in _BRACKETS:
            opens.append("")
            continue
        kind = ""
        prev = code[i - 1] if i else None
        if text == "(":
            if prev and prev.kind == "keyword" and prev.text == "func":
                kind = "params"
            elif prev and (prev.kind == "ident" or prev.text in (")", "]", "}")):
                before = code[i - 2] if i > 1 else None
                decl = before and (before.text == "func" or (before.text == ")" and _receiver(code, i - 2)))
                kind = "params" if decl else "call"
            else:
                kind = "paren"
        elif text == "[":
            kind = "index"
        elif text == "{":
            kind = "composite" if _composite(code, i, stack) else "block"
        elif stack:
            stack.pop()
        if kind:
            stack.append(kind)
        opens.append(kind)
    return opens, inside


def _receiver(code: list[Token], close: int) -> bool:
    depth = 0
    for k in range(close, -1, -1):
        depth += (code[k].text == ")") - (code[k].text == "(")
        if depth == 0:
            return k > 0 and code[k - 1].text == "func"
    return False


def _composite(code: list[Token], i: int, stack: list[str]) -> bool:
    """Whether the brace at ``i`` starts a composite literal."""
    prev = code[i - 1] if i else None
    if prev is None or prev.text in (")", "else", "interface", "struct", "select", "switch", "for", ";") or prev.kind == "keyword" and prev.text != "map":
        return False
    if prev.text in ("{", ",", ":", "(", "[") and prev.kind == "op":
        return bool(stack) and stack[-1] in ("composite", "call", "index") or prev.text != "{"
    if prev.kind != "ident" and prev.text not in ("]", "}"):
        return False
    depth = 0
    for k in range(i - 1, -1, -1):  # back to where the statement starts
        t = code[k]
        if t.kind == "op" and t.text in (")", "]", "}"):
            if t.text == "}" and depth == 0 and k < i - 1:
                return True
            depth += 1
        elif t.kind == "op" and t.text in ("(", "[", "{"):
            if depth == 0:
                return True
            depth -= 1
        elif depth == 0 and t.kind == "keyword":
            if t.text in ("if", "for", "switch", "select", "func", "struct", "interface", "type"):
                return False
            if t.text not in ("map", "chan", "range"):
                return True
    return True


def pairs(code: list[Token]) -> tuple[dict[int, int], list[int]]:
    """The place of the bracket that closes each opening one, and for each token the place of the innermost open one (-1 if none)."""
    close, parent, stack = {}, [], []
    for i, (kind, _, _, text) in enumerate(code):
        at = kind == "op" and text in _BRACKETS
        if at and text in _CLOSERS and stack:
            close[stack.pop()] = i
        parent.append(stack[-1] if stack else -1)
        if at and text not in _CLOSERS:
            stack.append(i)
    return close, parent


#: Operators and keywords with which a statement can end.
_ENDS = frozenset(") ] } ++ -- break continue fallthrough return".split())


def line_breaks(src: str, code: list[Token]) -> list[bool]:
    """For each token whether a statement ends with it: the language puts a semicolon at such line ends."""
    following = [t.start for t in code[1:]] + [len(src)]
    return [nxt > end and (text in _ENDS or kind not in ("op", "keyword")) and src.find("\n", end, nxt) >= 0 for (kind, _, end, text), nxt in zip(code, following)]


def body_of(code: list[Token], close: dict[int, int], i: int) -> int:
    """The place of the brace that opens the body of the statement or function literal at ``i`` (-1 if there is none)."""
    k, literal = i + 1, False
    while k < len(code):
        t = code[k]
        if t.kind == "keyword" and t.text == "func":
            literal = True
        elif t.kind == "op":
            if t.text in (")", "]", "}") or code[i].text == "func" and t.text not in ("(", "[", "{", "*", ".", "<-"):
                return -1
            if t.text == "{":
                q = k - 1
                while q > i + 1 and code[q].kind == "ident" and code[q - 1].text == ".":
                    q -= 2
                typed = code[i].text != "func" and code[q].kind == "ident" and code[q - 1].text == "]"
                if not literal and not typed and code[k - 1].text not in ("struct", "interface"):
                    return k
                literal = literal and code[k - 1].text in ("struct", "interface")
            if t.text in ("(", "[", "{"):
                if k not in close:
                    return -1
                k = close[k]
        k += 1
    return -1


def statement_kind(code: list[Token], i: int, inside: str, close: dict[int, int], breaks: list[bool]) -> str:
    """Kind of the statement that starts with token ``i``."""
    t = code[i]
    nxt = code[i + 1] if i + 1 < len(code) else None
    if t.kind == "op":
        names = {"}": "closing_brace", ")": "closing_paren", "]": "closing_bracket", ".": "method_chain", "{": "block"}
        if t.text in names:
            return names[t.text]
        return "expr_stmt" if t.text in ("*", "<-", "&", "(") else "continuation"
    if t.kind == "keyword":
        if t.text == "func":
            return "method_decl" if nxt and nxt.text == "(" and inside == "" else "func_decl" if inside == "" else "func_literal"
        named = {
            "go": "go", "defer": "defer", "return": "return", "if": "if", "for": "for", "switch": "switch", "select": "select", "case": "case", "default": "case", "package": "package",
            "var": "var_decl", "const": "const_decl", "type": "type_decl", "import": "import_decl", "else": "else",
        }
        if t.text == "for" and _has_range(code, close, i):
            return "range_for"
        return named.get(t.text, "branch" if t.text in ("break", "continue", "goto", "fallthrough") else "local_decl")
    if inside in ("call", "params"):
        return "call_argument"
    if inside == "composite":
        return "key_value" if nxt and nxt.text == ":" else "composite_element"
    if t.kind in ("string", "raw") and inside == "paren":
        return "import_spec"
    if nxt and nxt.text == ":" and inside == "block":
        return "label"
    k = i
    while k < len(code):
        x = code[k]
        if x.kind == "op":
            if x.text == ":=":
                return "short_var_decl"
            if x.text in AFTER_OPERATOR and (x.text.endswith("=") and x.text not in ("==", "!=", "<=", ">=")):
                return "assignment" if inside in ("block", "") else "value_spec"
            if x.text in ("++", "--"):
                return "inc_dec"
            if x.text == "<-" and k > i:
                return "send"
            if x.text in (";", ")", "]", "}"):
                break
            if x.text in ("(", "[", "{"):
                k = close.get(k, len(code))
        if k < len(code) and breaks[k]:
            break
        k += 1
    if nxt and nxt.text in ("(", "."):
        return "call_stmt"
    return "field" if nxt and nxt.kind in ("ident", "keyword") else "expr_stmt"


def _has_range(code: list[Token], close: dict[int, int], i: int) -> bool:
    k, end = i + 1, body_of(code, close, i)
    while k < end:
        if code[k].kind == "keyword" and code[k].text == "range":
            return True
        k = close.get(k, k) + 1
    return False


def _error_spans(code: list[Token], close: dict[int, int]) -> list[tuple[int, int, int, str]]:
    """(if, open, close, subkind) places among the tokens of ``if err != nil { ... }`` and ``if errors.Is(...) { ... }``, with or without a statement before the test."""
    out = []
    for i, t in enumerate(code):
        if t.kind == "keyword" and t.text == "if":
            brace = body_of(code, close, i)
            if brace < 0:
                continue
            k = first = i + 1
            while k < brace:
                if code[k].text == ";" and code[k].kind == "op":
                    first = k + 1
                k = close.get(k, k) + 1
            cond, kind = code[first:brace], ""
            if len(cond) == 3 and cond[0].kind == "ident" and cond[0].text.endswith(("err", "Err")) and cond[1].text == "!=" and cond[2].text == "nil":
                kind = "if_err_init" if first > i + 1 else "if_err_check"
            else:
                k = 0  # a chain of names: [x.]errors.Is or As, called, and nothing after the call
                while k + 2 < len(cond) and cond[k].kind == "ident" and cond[k + 1].text == ".":
                    k += 2
                if k >= 2 and cond[k].text in ("Is", "As") and cond[k - 2].text == "errors" and k + 1 < len(cond) and cond[k + 1].text == "(" and close.get(first + k + 1) == brace - 1:
                    kind = "if_err_is"
            if kind:
                out.append((i, brace, close.get(brace, len(code)), kind))
    return out


def has_syntax_errors(src: str | None, tokens: list[Token] | None = None, bad: int = 0) -> bool:
    """Whether the tokens tell that the file cannot be parsed: stray signs, open literals or comments, brackets that do not match."""
    if tokens is None:
        tokens, bad = lex(src)
    stack = []
    for kind, _, _, text in tokens:
        if kind == "op":
            if text in _BRACKETS:
                if text not in _CLOSERS:
                    stack.append(text)
                elif not stack or stack.pop() != _CLOSERS[text]:
                    return True
        elif kind == "comment":
            if text.startswith("/*") and (len(text) < 4 or not text.endswith("*/")):
                return True
        elif kind in ("string", "char", "raw") and (len(text) < 2 or text[-1] != text[0] or kind != "raw" and "\\" in text and re.search(r"(?<!\\)(?:\\\\)*\\.\Z", text, re.S)):
            return True
    code = next((t for t in tokens if t.kind != "comment"), None)
    return bad > 0 or bool(stack) or code is None or code.text != "package"


class Caret(NamedTuple):
    offset: int
    line: int
    kind: str
    subkind: str | None
    priority: int
    seq: int
    reason: str | None
    trivial: bool = False
    score: float = 0.0


_SECRET = re.compile(re2_to_java(LINE_SECRET).replace(r"\z", r"\Z"))
_TRIVIAL = frozenset("{}()[];,")


def has_secret(line: str) -> bool:
    """A literal given to a secret name, unless it is the name of a variable."""
    return ('"' in line or "`" in line) and ("=" in line or ":" in line) and any(not re.fullmatch(r"[A-Z0-9_]*", m[3]) for m in _SECRET.finditer(line))


class Parsed:
    """What is known of a file before its carets are looked for: tokens, brackets, statements, lines, log literals. Offsets are characters."""

    def __init__(self, src: str):
        self.src = src
        self.tokens, self.bad = lex(src)
        self.code = code = [t for t in self.tokens if t.kind != "comment"]
        self.opens, self.inside = brackets(code)
        self.close, self.parent = pairs(code)
        self.breaks = line_breaks(src, code)
        self.errors = _error_spans(code, self.close)
        self.starts = [0] + [m.end() for m in re.finditer("\n", src)]
        ends = [s - 1 for s in self.starts[1:]] + [len(src)]
        self.ends = [e - 1 if e > s and src[e - 1] == "\r" and e < len(src) else e for s, e in zip(self.starts, ends)]
        self.messages = self._messages()

    def line_of(self, offset: int) -> int:
        return bisect_right(self.starts, offset) - 1

    def _messages(self) -> dict[int, tuple[str, str]]:
        """{token: (what, function)} of the literals that are a message or build an error; what is template or error."""
        out, commas = {}, {}
        for i, ((kind, _, _, text), p) in enumerate(zip(self.code, self.parent)):
            if kind == "op":
                if text == "," and p >= 0:
                    commas[p] = commas.get(p, 0) + 1
            elif kind in ("string", "raw") and p > 0 and self.opens[p] == "call":
                arg = commas.get(p, 0)
                name = self.code[p - 1].text
                receiver = self.code[p - 3].text if p > 2 and self.code[p - 2].text == "." else ""
                if FORMAT_FUNCS.get(name) == arg or (MESSAGE_FUNCS.get(name) == arg and LOGGER.search(receiver)):
                    out[i] = ("template", name)
                elif name in ERROR_FUNCS and receiver in ("errors", "fmt", "xerrors"):
                    out[i] = ("error", name)
        return out

    def spans(self) -> list[tuple[int, int, str]]:
        """(start, end, tag) of the parts of a file that give carets within them a tag, by start."""
        code, close, out = self.code, self.close, []

        def add(first: int, last: int, tag: str) -> None:
            if 0 <= first < len(code):
                out.append((code[first].start, code[min(last, len(code) - 1)].end, tag))

        for _, o, c, _ in self.errors:
            add(o, c, "error_handling")
        for i, t in enumerate(code):
            if t.kind == "keyword":
                if t.text in ("switch", "select", "func"):
                    brace = body_of(code, close, i)
                    if brace >= 0 and t.text != "func":
                        add(i, close.get(brace, len(code)), t.text)
                    elif brace >= 0 and self.inside[i] != "":
                        add(brace, close.get(brace, len(code)), "closure")
                elif t.text in ("go", "defer"):
                    k = i + 1
                    while k < len(code) and not self.breaks[k]:
                        k = close.get(k, k) + (0 if k in close and self.breaks[min(close[k], len(code) - 1)] else 1)
                    add(i, k, "goroutine" if t.text == "go" else "defer")
                elif t.text in ("struct", "interface") and i + 1 < len(code) and code[i + 1].text == "{":
                    add(i, close.get(i + 1, len(code)), t.text + "_type")
            elif t.text == "{" and self.opens[i] == "composite":
                k = i
                while k > 0 and (code[k - 1].kind == "ident" or code[k - 1].text in (".", "]", "map", "*")):
                    k = self.parent_open(k - 1) if code[k - 1].text == "]" else k - 1
                add(k, close.get(i, len(code)), "composite_literal")
            elif t.text == "[" and i > 1 and code[i - 1].kind == "ident" and code[i - 2].text in ("func", "type") and i + 2 < len(code) and code[i + 1].kind == "ident" and code[i + 2].text != "]":
                add(i, close.get(i, len(code)), "generics")
        return sorted(out)

    def parent_open(self, closing: int) -> int:
        """The bracket that the one at ``closing`` closes."""
        if not hasattr(self, "_opened"):
            self._opened = {c: o for o, c in self.close.items()}
        return self._opened.get(closing, closing)


_LITERALS = frozenset(("comment", "string", "raw", "char"))
_PARTIAL, _BOUNDARY = PRIORITY["identifier_partial"], PRIORITY["token_boundary"]


@lru_cache(1 << 16)
def _parts(name: str, prefix_max: int) -> tuple[int, ...]:
    """Where a name can be cut: after its first signs, underscores and small letters before capitals."""
    return tuple(k for k in range(1, len(name)) if k <= prefix_max or name[k - 1] == "_" or name[k].isupper() and name[k - 1].islower())


def carets(src: str | Parsed, prefix_max: int = 4, max_line: int = 240, min_target: int = 1, max_target: int = 200, keep: tuple[Callable[[int, str], float | None], Callable[[float, str, bool], float | None]] | None = None) -> tuple[list[Caret], list[tuple[int, str]]]:
    """Candidates of one file (with the reason why the place is none, if so) and excluded lines (line, reason).

    With ``keep`` only the candidates that are none for no reason and get a number from it are returned, with the number
    as ``score``. Its first function gives an offset and a kind the number that is drawn, or None if no target there is
    kept; the second gives that number, the kind and whether the target is trivial the score, or None.
    """
    f = src if isinstance(src, Parsed) else Parsed(src)
    src, tokens, code, opens, inside, close, parent, breaks = f.src, f.tokens, f.code, f.opens, f.inside, f.close, f.parent, f.breaks
    plain, starts, ends, line_of = src.isascii(), f.starts, f.ends, f.line_of
    heads, bodies = {h: kind for h, _, _, kind in f.errors}, {o for _, o, _, _ in f.errors}
    reach, inner = 0, set()  # tokens inside the body of an error check
    for _, o, c, _ in f.errors:
        inner.update(range(max(o + 1, reach), c))
        reach = max(reach, c)
    covered: dict[int, str] = {}
    wide: dict[int, list[Token]] = {}
    literals: dict[int, list[Token]] = {}
    for t in tokens:
        if t[0] in _LITERALS:
            first = line_of(t.start)
            literals.setdefault(first, []).append(t)
            if t.kind in ("raw", "comment") and "\n" in t.text:
                wide.setdefault(first, []).append(t)
                for k in range(first + 1, line_of(max(t.end - 1, t.start)) + 1):
                    covered[k] = "inside_raw_string" if t.kind == "raw" else "inside_block_comment"
    by_line: dict[int, list[int]] = {}
    row, past = 0, starts[1] if len(starts) > 1 else len(src) + 1
    for i, t in enumerate(code):
        while t[1] >= past:
            row += 1
            past = starts[row + 1] if row + 1 < len(starts) else len(src) + 1
        by_line.setdefault(row, []).append(i)
    out: list[Caret] = []
    excluded: list[tuple[int, str]] = []
    imports = {m.rsplit("/", 1)[-1].removeprefix("go-").split(".")[0].replace("-", "_") for m in re.findall(r'"([\w./-]+)"', src[: src.find("func ")] if "func " in src else src)}
    draw, weigh = keep or (None, None)

    def add(off: int, kind: str, sub: str | None = None, force: bool = False) -> None:
        if ls <= off <= le:
            old = found.get(off)
            if force or old is None or old[0] > PRIORITY[kind]:
                found[off] = (-1 if force else PRIORITY[kind], kind, sub, len(found))

    def after(off: int) -> int:
        while off < le and src[off] in " \t\x0b\x0c":
            off += 1
        return off

    for ln, (ls, le) in enumerate(zip(starts, ends)):
        body = src[ls:le]
        if ln in covered:
            excluded.append((ln, covered[ln]))
            continue
        if not body.strip(" \t\x0b\x0c"):
            excluded.append((ln, "blank"))
            continue
        toks = by_line.get(ln, [])
        if not toks:
            text = body.lstrip()
            excluded.append((ln, "build_constraint" if text.startswith(("//go:build", "// +build")) else "directive" if text.startswith(("//go:", "//line ", "//export ", "//nolint")) else "comment"))
            continue
        if le - ls > max_line or not plain and len(body.encode("utf-16-le")) // 2 > max_line:
            excluded.append((ln, "too_long"))
            continue
        found: dict[int, tuple[int, str, str | None, int]] = {}  # offset: priority, kind, subkind, seq

        for n, i in enumerate(toks):
            t = code[i]
            prev = code[i - 1] if i else None
            if n == 0:
                kind = statement_kind(code, i, inside[i], close, breaks)
                if i in heads:
                    add(t.start, "error_handling", heads[i])
                elif parent[i] in bodies and t.text != "}" and (i - 1 == parent[i] or breaks[i - 1] or prev.text == ";"):
                    add(t.start, "error_handling", "err_body_" + kind)
                else:
                    add(t.start, "line_start", kind)
            if t.kind == "ident":
                for k in _parts(t.text, prefix_max):  # no other candidate stands within a name
                    if draw is None or draw(t.start + k, "identifier_partial") is not None:
                        found[t.start + k] = (_PARTIAL, "identifier_partial", None, len(found))
            elif t.kind == "keyword":
                if t.text == "func" and inside[i] != "" and prev is not None:
                    where = {"return": "return", "go": "go", "defer": "defer", "=": "assignment", ":=": "assignment", ":": "composite_element"}
                    brace = body_of(code, close, i)
                    end = close.get(brace, len(code))
                    called = brace >= 0 and end + 1 < len(code) and code[end + 1].text == "(" and prev.text not in ("go", "defer")
                    add(t.start, "func_literal", "immediately_invoked" if called else where.get(prev.text, "call_argument" if inside[i] == "call" else "composite_element" if inside[i] == "composite" else "expression"))
                if src[t.end : t.end + 1] == " ":
                    if t.text in CONTROL:
                        add(after(t.end), *(("error_handling", "if_err_cond") if i in heads and i + 1 < len(code) and after(t.end) == code[i + 1].start else ("control_flow", t.text)))
                    elif t.text in AFTER_KEYWORD:
                        add(after(t.end), *(("error_handling", "err_return") if i in inner and t.text == "return" else ("after_keyword", t.text)))
            elif t.kind == "op":
                if t.text == ".":
                    sub = "package" if prev and prev.text in imports else "call_result" if prev and prev.text == ")" else "value"
                    if i + 1 < len(code) and code[i + 1].text == "(":
                        sub = "type_assertion"
                    add(t.end, "member_access", sub)
                elif t.text == "(" and opens[i] in ("call", "params"):
                    add(t.end, "argument_list", opens[i] + "_open")
                elif t.text == "," and inside[i] in ("call", "params"):
                    add(after(t.end), "argument_list", inside[i] + "_next")
                elif t.text == "{" and opens[i] == "composite":
                    add(t.end, "composite_literal", "open")
                elif t.text == "," and inside[i] == "composite":
                    add(after(t.end), "composite_literal", "next")
                elif t.text == ":" and inside[i] == "composite":
                    add(after(t.end), "composite_literal", "key_value")
                if t.text in AFTER_OPERATOR:
                    add(after(t.end), "after_operator", t.text)
            elif i in f.messages:
                what, name = f.messages[i]
                if what == "template":
                    add(t.start, "log_message", "template_start", True)
                    if t.kind == "string":
                        add(t.start + 1, "log_message", "template_body", True)
                else:
                    add(t.start, "error_handling", "err_construct:" + name)
            if t.end not in found and t.end <= le:  # the last of all kinds
                found[t.end] = (_BOUNDARY, "token_boundary", None, len(found))
        lits = literals.get(ln, [])
        if keep is None:
            for x in lits:  # places inside literals, to count what is left out
                if x.start + 1 <= le:
                    found.setdefault(x.start + 1, (98, "probe", None, 0))
        trimmed = len(body.rstrip(" \t\x0b\x0c")) + ls
        long = wide.get(ln, [])
        secret = insides = None  # found out when needed: most candidates are not drawn
        for off, (priority, kind, sub, seq) in sorted(found.items()) if keep is None else found.items():
            score = 0.0
            if keep is None:
                target = src[off:trimmed]
                trivial = _TRIVIAL.issuperset(target)
            else:
                if off >= trimmed or (u := draw(off, kind)) is None:
                    continue
                target = src[off:trimmed]
                trivial = _TRIVIAL.issuperset(target)
                if (score := weigh(u, kind, trivial)) is None:
                    continue
            if secret is None:
                secret = has_secret(body)
                insides = [(code[i].start, code[i].end) for i in toks if code[i].kind in ("ident", "number", "keyword", "op") and code[i].end - code[i].start > 1]
            if secret and keep is not None:
                break
            reason = None
            if sub != "template_body":
                for x in lits:
                    if x.start < off < x.end:
                        reason = {"comment": "in_comment", "raw": "in_raw_string", "string": "in_string", "char": "in_rune_literal"}[x.kind]
                if reason is None and kind != "identifier_partial" and any(a < off < b for a, b in insides):
                    reason = "caret_inside_token"
            if reason is None and not target:
                reason = "empty_target"
            if reason is None and long:
                w = next((w for w in long if off <= w.start < le and w.end > off), None)
                if w is not None:
                    reason = "raw_multiline_string" if w.kind == "raw" else "multiline_comment"
            if reason is None:
                n = len(target) if plain else len(target.encode("utf-16-le")) // 2
                reason = "target_too_long" if n > max_target else "empty_target" if n < min_target else "secret_detected" if secret else "probe_unclassified" if kind == "probe" else None
            if keep is None or reason is None:
                out.append(Caret(off, ln, kind, sub, priority, seq, reason, trivial, score))
    return out, excluded


def caret_table(files: DataFrame, id_col: str = "file_id", content: str = "content", carry: list[str] = (), **limits: int) -> DataFrame:
    """(id, *carry, line, byte_offset, line_start, kind, subkind, priority, seq, reason, trivial, syntax_errors): one row per candidate and excluded line.

    Of several candidates at one place the one of the best priority stands, of equal ones the first. Excluded lines have
    kind ``line``. Offsets are bytes. A null content has no rows; a file that cannot be read as Go
    still gives what its tokens tell. ``limits`` are those of ``carets``.
    """
    held = [files.schema[c] for c in (id_col, *carry)]
    names = [*(f.name for f in held), "line", "byte_offset", "line_start", "kind", "subkind", "priority", "seq", "reason", "trivial", "syntax_errors"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
        for b in batches:
            cols: list[list] = [[] for _ in types]
            at: list[int] = []

            def made() -> pa.RecordBatch:
                pick = pa.array(at, pa.int64())
                return pa.RecordBatch.from_arrays([*(b.column(k).take(pick) for k in range(len(held))), *(pa.array(c, t) for c, t in zip(cols, types))], names=names)

            for i in range(b.num_rows):
                src = b.column(len(held))[i].as_py()
                if src is None:
                    continue
                if len(at) >= 50_000:  # a file has hundreds of rows: a batch of files would fill the worker's memory
                    yield made()
                    cols, at = [[] for _ in types], []
                parsed = Parsed(src)
                found, excluded = carets(parsed, **limits)
                broken = has_syntax_errors(None, parsed.tokens, parsed.bad)
                wide = None if src.isascii() else [0]
                if wide is not None:
                    for ch in src:
                        wide.append(wide[-1] + len(ch.encode("utf-8", "surrogatepass")))
                starts = parsed.starts
                place = lambda p: p if wide is None else wide[p]
                for c in found:
                    at.append(i)
                    for col, v in zip(cols, (c.line, place(c.offset), place(starts[c.line]), c.kind, c.subkind, c.priority, c.seq, c.reason, c.trivial, broken)):
                        col.append(v)
                for ln, why in excluded:
                    at.append(i)
                    for col, v in zip(cols, (ln, place(starts[ln]), place(starts[ln]), "line", None, 99, 0, why, False, broken)):
                        col.append(v)
            yield made()

    first = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held)
    return spread(files.select(id_col, *carry, content)).mapInArrow(run, f"{first}, line int, byte_offset bigint, line_start bigint, kind string, subkind string, priority int, seq int, reason string, trivial boolean, syntax_errors boolean")


def build_matches(constraint: str, tags: frozenset[str] = frozenset({"linux", "amd64", "unix", "gc"})) -> bool:
    """Whether a build expression holds: ``!``, ``&&``, ``||`` and parentheses; legacy lines joined by ``;`` are all needed."""
    if "//go:build" not in constraint and "+build" in constraint or ";" in constraint:
        groups = [re.sub(r"^\s*//\s*\+build\s+", "", g) for g in constraint.split(";")]
        one = lambda w: all((x.lstrip("!") in tags or re.fullmatch(r"go1\.\d+", x.lstrip("!")) is not None) != x.startswith("!") for x in w.split(","))
        return all(any(one(w) for w in g.split()) for g in groups if g.strip())
    toks = re.findall(r"&&|\|\||!|\(|\)|[\w.]+", re.sub(r"^\s*//go:build\s*", "", constraint))

    def either(k: int) -> tuple[bool, int]:
        v, k = both(k)
        while k < len(toks) and toks[k] == "||":
            w, k = both(k + 1)
            v = v or w
        return v, k

    def both(k: int) -> tuple[bool, int]:
        v, k = unit(k)
        while k < len(toks) and toks[k] == "&&":
            w, k = unit(k + 1)
            v = v and w
        return v, k

    def unit(k: int) -> tuple[bool, int]:
        if k >= len(toks):
            return False, k
        if toks[k] == "!":
            v, k = unit(k + 1)
            return not v, k
        if toks[k] == "(":
            v, k = either(k + 1)
            return v, k + 1
        return toks[k] in tags or bool(re.fullmatch(r"go1(?:\.\d+)?", toks[k])), k + 1

    return either(0)[0]
