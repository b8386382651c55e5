"""Files that nobody wrote by hand: machine-generated, minified, vendored, or data blobs saved as code.

Evidence is the path, what an earlier scan recorded, and the content. Notices are found in the comments before the
package clause by one multi-pattern automaton; code that speaks of, writes or detects such notices has them elsewhere.
Minified text and blobs are told by the part of the file that they fill.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretlake.session import spread

# Directories of third-party code, anywhere in a path, in lower case.
VENDORED_DIRS = "vendor _vendor vendored third_party third-party thirdparty _third_party 3rdparty 3rd_party external externals godeps node_modules bower_components".split()
# Endings and beginnings of file names that generators and minifiers give, in lower case.
GENERATED_ENDS = (
    ".pb.go .pb.gw.go .pb.validate.go _grpc.pb.go .gen.go _gen.go _generated.go .generated.go _easyjson.go _ffjson.go "
    "_stringer.go _msgp.go .capnp.go .twirp.go .connect.go _enumer.go .xo.go .sql.go"
).split()
GENERATED_STARTS = "zz_generated. zz_generated_ generated. bindata_assetfs".split()
GENERATED_NAMES = "bindata.go generated.go wire_gen.go".split()
MINIFIED_ENDS = ".min.go .min.js .min.css _bundle.go .bundle.js .bundle.go -min.js".split()
LOCK_FILES = "go.sum package-lock.json yarn.lock pnpm-lock.yaml gopkg.lock glide.lock composer.lock cargo.lock poetry.lock gemfile.lock".split()
# Reasons of the earlier scan that say the same, after cleaning.
REASONS = {"vendored_path": "vendored", "generated_path": "generated", "generated_marker": "generated"}

# Phrases of notices, in lower case. A strong one is enough; of the others two different ones must meet.
STRONG = {
    "generated": [
        "@generated", "<auto-generated", "autogenerated", "auto-generated", "automatically generated", "machine-written", "machine generated",
        "machine-generated", "automatisch erzeugt", "automatisch generiert", "généré automatiquement", "generado automáticamente", "gerado automaticamente",
        "сгенерировано автоматически", "автоматически сгенерирован", "自动生成", "自動生成",
    ],
    "vendored": [
        "vendored from", "vendored copy", "third-party code", "third party code", "copied verbatim from", "imported verbatim from", "send fixes upstream",
        "keep in step with upstream", "do not change here, change upstream",
    ],
}
WEAK = {
    "generated": [
        "code generated", "generated by", "generated from", "generated with", "generated file", "file is generated", "was generated", "do not edit", "don't edit",
        "not be edited", "do not modify", "don't modify", "do not change", "by hand", "manually", "manual changes", "will be overwritten", "edit is lost",
        "edits are lost", "changes will be lost", "was produced by", "produced by", "during the build", "runs again", "next run", "regenerate", "nicht von hand",
        "nicht ändern", "written by", "nicht bearbeiten", "generiert von", "erzeugt von", "ne pas modifier", "généré par", "no editar", "no modificar",
        "generado por", "não editar", "gerado por", "не редактировать", "не изменять", "сгенерировано", "请勿编辑", "由工具生成",
    ],
    "vendored": ["imported from", "copied from", "taken from", "forked from", "mirrored from", "origin ", "upstream", "module proxy", "local changes", "(tag ", "at commit "],
}

_HEAD = re.compile(r"﻿?(?:\s+|//[^\n]*|/\*.*?\*/)*", re.S)
_FROM = re.compile(r"(?im)^[\s/*#]*(?:vendored|imported|copied|forked|mirrored|taken)\s+(?:verbatim\s+)?from\s+\S*[\w-]\.[\w-]+/\S+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_NUMBERS = re.compile(r"(?:[+-]?(?:\d[\d_]*\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*,\s*){5,}[+-]?[\d.eE]*")
LONG_LINE, FILLED, LEAST_BLOB = 160, 0.5, 512


def automaton(groups: dict[str, dict[str, list[str]]]):
    """One automaton over all phrases; its values are (kind, strength, phrase)."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for strength, kinds in groups.items():
        for kind, phrases in kinds.items():
            for p in phrases:
                a.add_word(p, (kind, strength, p))
    a.make_automaton()
    return a


_automaton = None


def notice(text: str | None) -> str | None:
    """"generated" or "vendored" if the text (comments, a recorded detail) carries such a notice."""
    global _automaton
    if not text:
        return None
    if _automaton is None:
        _automaton = automaton({"strong": STRONG, "weak": WEAK})
    weak: dict[str, set[str]] = {}
    for _, (kind, strength, phrase) in _automaton.iter(re.sub(r"\s+", " ", text.lower())):
        if strength == "strong":
            return kind
        weak.setdefault(kind, set()).add(phrase)
    for kind, found in weak.items():
        if len(found) > 1:
            return kind
    return "vendored" if _FROM.search(text) else None


def header(content: str) -> str:
    """Comments and blanks before the package clause."""
    return _HEAD.match(content)[0]


def _is_data(line: str) -> bool:
    """A line of byte values, escapes or base64 text."""
    n = len(line)
    if "0x" in line or "\\x" in line or "0X" in line:
        return (line.count("0x") + line.count("0X")) * 5 >= 0.7 * n or line.count("\\x") * 4 >= 0.6 * n
    bare = line.strip("\"'`+, \t")
    if len(bare) >= 40 and " " not in bare:
        return bool(_BASE64.fullmatch(bare)) and any(map(str.isdigit, bare)) and bare.lower() != bare != bare.upper()
    return bool(_NUMBERS.fullmatch(line))


def filled(content: str) -> tuple[float, float]:
    """Parts of the content in long lines, and in literal data."""
    n = len(content)
    if not n:
        return 0.0, 0.0
    lines = [x for x in content.split("\n") if len(x) >= 32]
    long = sum(len(x) for x in lines if len(x) >= LONG_LINE)
    blob = sum(len(x) for x in lines if _is_data(x.strip()))
    return long / n, (blob / n if blob >= LEAST_BLOB else 0.0)


def content_kind(content: str | None) -> str | None:
    """generated, vendored, blob, minified, or None."""
    if not content:
        return None
    if kind := notice(header(content)):
        return kind
    long, blob = filled(content)
    return "blob" if blob >= FILLED else "minified" if long >= FILLED else None


def path_kind(path: Column) -> Column:
    """What the path alone tells."""
    p = F.lower(path)
    dirs = F.slice(F.split(p, "/"), 1, F.greatest(F.size(F.split(p, "/")) - 1, F.lit(0)))
    name = F.element_at(F.split(p, "/"), -1)
    any_of = lambda how, words: F.greatest(*[how(F.lit(w)) for w in words]) if len(words) > 1 else how(F.lit(words[0]))
    return (
        F.when(F.arrays_overlap(dirs, F.array(*map(F.lit, VENDORED_DIRS))), "vendored")
        .when(any_of(name.endswith, MINIFIED_ENDS), "minified")
        .when(any_of(name.endswith, GENERATED_ENDS) | any_of(name.startswith, GENERATED_STARTS) | name.isin(GENERATED_NAMES), "generated")
        .when(name.isin(LOCK_FILES), "generated")
    )


def reason_kind(reason: Column) -> Column:
    """What a recorded reason tells, however it is spelled."""
    r = F.regexp_replace(F.lower(F.trim(reason)), r"[\s-]+", "_")
    out = F.lit(None).cast("string")
    for k, v in REASONS.items():
        out = F.when(r == k, v).otherwise(out)
    return out


def contents_kinds(files: DataFrame) -> DataFrame:
    """(repository_id, relative_path, content_kind) of the files whose content tells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kinds = [content_kind(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(kinds, pa.string())], names=["repository_id", "relative_path", "content_kind"])

    return spread(files.select("repository_id", "relative_path", "content")).mapInArrow(run, "repository_id string, relative_path string, content_kind string").where("content_kind IS NOT NULL")


def not_by_hand(discovery: DataFrame, files: DataFrame) -> DataFrame:
    """(repository_id, relative_path, kind, evidence): one row per path of ``discovery`` that nobody wrote by hand.

    ``evidence`` is path, reason, detail or content, the first that tells. Repeated rows of a path count together; rows
    without repository or path are dropped; a path without content is judged by the rest.
    """
    rows = discovery.where("repository_id IS NOT NULL AND relative_path IS NOT NULL").select(
        "repository_id", "relative_path", path_kind(F.col("relative_path")).alias("by_path"), reason_kind(F.col("skip_reason")).alias("by_reason"), "detail"
    )

    def details(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([notice(t) for t in b.column(0).to_pylist()], pa.string())], names=["detail", "by_detail"])

    known = rows.select("detail").where("detail IS NOT NULL").distinct().mapInArrow(details, "detail string, by_detail string").where("by_detail IS NOT NULL")
    rows = rows.join(known, "detail", "left").drop("detail")
    paths = rows.groupBy("repository_id", "relative_path").agg(F.max("by_path").alias("by_path"), F.max("by_reason").alias("by_reason"), F.max("by_detail").alias("by_detail"))
    told = contents_kinds(files).groupBy("repository_id", "relative_path").agg(F.max("content_kind").alias("by_content"))
    j = paths.join(told, ["repository_id", "relative_path"], "left")
    names = ["by_path", "by_reason", "by_detail", "by_content"]
    evidence = F.coalesce(*[F.when(F.col(c).isNotNull(), c[3:]) for c in names])
    return j.select("repository_id", "relative_path", F.coalesce(*names).alias("kind"), evidence.alias("evidence")).where("kind IS NOT NULL")
