"""Regular expressions and globs that mean the same in every engine.

Patterns are written in the RE2 dialect, which DuckDB also speaks; ``re2_to_java`` gives Spark a pattern of equal meaning.
"""

from __future__ import annotations

_WORD = "[A-Za-z0-9_]"
_BOUNDARY = f"(?:(?<!{_WORD})(?={_WORD})|(?<={_WORD})(?!{_WORD}))"
_OUTSIDE = {"b": _BOUNDARY, "B": f"(?!{_BOUNDARY})", "s": r"[\t\n\f\r ]", "S": r"[^\t\n\f\r ]", "w": _WORD, "W": "[^A-Za-z0-9_]", "z": r"\z"}
_INSIDE = {"s": r"\t\n\f\r ", "w": "A-Za-z0-9_"}


def re2_to_java(pattern: str) -> str:
    """Word boundaries and classes are ASCII, ``$`` is the end of the text, ``.`` anything but a line feed."""
    out, i, inside = [], 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            n = pattern[i + 1]
            out.append((_INSIDE if inside else _OUTSIDE).get(n, c + n))
            i += 2
            continue
        if inside:
            if c == "]":
                inside = False
            elif c == "[" or c == "&":
                c = "\\" + c  # neither unions nor intersections of classes
            out.append(c)
        elif c == "[":
            inside = True
            out.append(c)
            for extra in ("^", "]"):  # a bracket that comes first is a sign like any other
                if pattern[i + 1 : i + 2] == extra:
                    i += 1
                    out.append(extra if extra == "^" else "\\]")
        elif c == "$":
            out.append(r"\z")
        elif c == ".":
            out.append(r"[^\n]")
        else:
            out.append(c)
        i += 1
    return "".join(out)


def glob_to_regex(glob: str) -> str:
    """A path glob as an anchored pattern: ``**/`` any directories, a trailing ``/**`` anything below, ``*`` and ``?`` within a name."""
    out, i = ["^"], 0
    while i < len(glob):
        if glob.startswith("**/", i):
            out.append("(?:[^/]+/)*")
            i += 3
        elif glob[i:] == "/**":
            out.append("/.+")
            break
        elif glob.startswith("**", i):
            out.append(".*")
            i += 2
        elif glob[i] == "*":
            out.append("[^/]*")
            i += 1
        elif glob[i] == "?":
            out.append("[^/]")
            i += 1
        else:
            out.append("\\" + glob[i] if glob[i] in r".+()[]{}^$|\\" else glob[i])
            i += 1
    return "".join(out) + "$"


def any_of(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def globs(patterns: list[str]) -> str:
    return any_of([glob_to_regex(p) for p in patterns])
