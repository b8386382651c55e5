"""Facts of a Go file that need no parser: package, project, build constraint and whether it holds, cgo, test."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretlake.functions.regexes import globs
from caretlake.operators.discovery import PACKAGE, TESTS, matches
from caretlake.operators.golexer import build_matches

# Operating systems and architectures that a file name may end with.
SYSTEMS = "aix android darwin dragonfly freebsd illumos ios js linux netbsd openbsd plan9 solaris wasip1 windows".split()
MACHINES = "386 amd64 arm arm64 loong64 mips mips64 mips64le mipsle ppc64 ppc64le riscv64 s390x wasm".split()


def package_name(content: Column) -> Column:
    """The name in the package clause, which only comments and blanks may precede."""
    return F.nullif(F.regexp_extract(content, PACKAGE, 1), F.lit(""))


def project(path: Column) -> Column:
    """The directory of a file, ``.`` at the root."""
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, "/[^/]*$", "")).otherwise(".")


def build_constraint(content: Column) -> Column:
    """The go:build line before the package clause, or the legacy lines joined by `` ; ``; null without one."""
    head = F.substring_index(content, "\npackage ", 1)
    new = F.regexp_extract(head, r"(?m)^(//go:build [^\r\n]*)", 1)
    old = F.array_join(F.regexp_extract_all(head, F.lit(r"(?m)^(// ?\+build [^\r\n]*)"), F.lit(1)), " ; ")
    return F.when(new != "", new).when(old != "", old)


def uses_cgo(content: Column) -> Column:
    return content.rlike(r'(?m)^[ \t]*(?:import[ \t]+)?"C"[ \t]*\r?$')


def imports(files: DataFrame, id_col: str = "file_id") -> DataFrame:
    """(id, path, name): every path that an import declaration of a file names, and the name by which it is used if it has no other."""
    blocks = F.regexp_extract_all("content", F.lit(r"(?ms)(^import \(.*?^\)|^import [^(\n]*$)"), F.lit(1))
    i = files.select(id_col, F.explode(blocks).alias("b")).select(id_col, F.explode(F.regexp_extract_all("b", F.lit('"([^"\n]+)"'), F.lit(1))).alias("path")).distinct()
    parts = F.split("path", "/")
    last = F.when((F.size(parts) > 1) & F.element_at(parts, -1).rlike(r"\Av[0-9]+\z"), F.try_element_at(parts, F.lit(-2))).otherwise(F.element_at(parts, -1))
    return i.select(id_col, "path", F.replace(F.regexp_replace(F.substring_index(last, ".", 1), r"\Ago-", ""), F.lit("-"), F.lit("_")).alias("name"))


def name_matches(path: str, system: str = "linux", machine: str = "amd64") -> bool:
    """Whether the file name's system and machine suffixes allow the build."""
    parts = re.sub(r"(_test)?\.go$", "", path.rsplit("/", 1)[-1]).split("_")[1:]
    if len(parts) >= 2 and parts[-2] in SYSTEMS and parts[-1] in MACHINES:
        return parts[-2] == system and parts[-1] == machine
    if parts and parts[-1] in SYSTEMS:
        return parts[-1] == system
    return not (parts and parts[-1] in MACHINES) or parts[-1] == machine


def file_facts(files: DataFrame, cgo_on: bool = False, keys: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """(*keys, package_name, project, build_constraint, build_match, cgo, is_test).

    A null content has only what its path tells.
    """
    c, p = F.col("content"), F.col("relative_path")
    f = files.select(*keys, package_name(c).alias("package_name"), project(p).alias("project"), build_constraint(c).alias("build_constraint"), F.coalesce(uses_cgo(c), F.lit(False)).alias("cgo"), matches(p, globs(TESTS)).alias("is_test"), name_suffix(p).alias("suffix"))

    return with_build_match(f, cgo_on).select(*keys, "package_name", "project", "build_constraint", "build_match", "cgo", "is_test")


def with_build_match(f: DataFrame, cgo_on: bool = False) -> DataFrame:
    """``f`` (build_constraint, suffix, cgo) with ``build_match``; each distinct pair of constraint and suffix is evaluated once."""

    def evaluate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in frames:
            d["holds"] = [name_matches("x" + s) and (not b or build_matches(b)) for b, s in zip(d["b"], d["s"])]
            yield d

    cases = f.select(F.coalesce("build_constraint", F.lit("")).alias("b"), F.coalesce("suffix", F.lit("")).alias("s")).distinct().mapInPandas(evaluate, "b string, s string, holds boolean")
    j = f.join(cases, (F.coalesce("build_constraint", F.lit("")) == F.col("b")) & (F.coalesce("suffix", F.lit("")) == F.col("s"))).drop("b", "s")
    return j.withColumn("build_match", F.col("holds") if cgo_on else F.col("holds") & ~F.coalesce("cgo", F.lit(False))).drop("holds")


def name_suffix(path: Column) -> Column:
    """The part of a file name that may name a system, a machine or a test."""
    return F.regexp_extract(path, r"((?:_[a-z0-9]+){0,3}\.go)$", 1)


def tags(place: Column, is_test: Column, build_match: Column, cgo: Column) -> Column:
    """Sorted tags of a caret: those of its place, and those of its file."""
    found = F.filter(F.array(F.when(is_test, "test_code"), F.when(~build_match, "build_excluded"), F.when(cgo, "cgo")), lambda x: x.isNotNull())
    return F.array_sort(F.array_union(place, found))
