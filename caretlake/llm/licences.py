"""The licence of each code file and repository, with conflicts and unknowns.

The comment blocks before a file's package clause are masked: years, holders, and every word that no licence's name or
text is made of. Equal blocks are grouped, each distinct block is identified once, and its label is joined back to the
files. Licence files and the recorded free-text licence of a repository go through the same naming rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretlake.session import materialise, spread

SALTS = 16

# SPDX identifiers that are known, in lower case without "-only", "-or-later" and "+".
SPDX = (
    "0BSD AFL-3.0 AGPL-3.0 Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 CC-BY-4.0 "
    "CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 GPL-2.0 GPL-3.0 ISC LGPL-2.0 LGPL-2.1 LGPL-3.0 MIT "
    "MIT-0 MPL-1.1 MPL-2.0 MS-PL NCSA OFL-1.1 PostgreSQL Python-2.0 Unlicense UPL-1.0 WTFPL X11 Zlib"
).split()
_SPDX = {s.lower(): s for s in SPDX}

# Names of licences in running text, tried in this order on text without comment signs; a matched
# stretch is not looked at again. ``{v}`` stands for a version number.
_L = r"licen[cs]e"
_V = r"(?:,?\s*\(?(?:version|ver\.?|v\.?)?\s*-?\s*(\d(?:\.\d)?)(?:\.0)?\)?)?"
NAMES: list[tuple[str, str]] = [
    ("AGPL", rf"(?i:(?:gnu\s+)?affero\s+general\s+public\s+{_L}|\b(?:gnu\s+)?agpl){_V}"),
    ("LGPL", rf"(?i:(?:gnu\s+)?(?:lesser|library)\s+general\s+public\s+{_L}|\b(?:gnu\s+)?lgpl){_V}"),
    ("GPL", rf"(?i:(?:gnu\s+)?general\s+public\s+{_L}|\b(?:gnu\s+)?gpl){_V}"),
    ("MPL", rf"(?i:mozilla\s+public\s+{_L}|\bmpl\b){_V}"),
    ("Apache", rf"(?i:\bapache(?:\s+software)?(?:\s+public)?\s+{_L}|\basl\b|\bapache(?=[\s-]*v?2)){_V}"),
    ("EPL", rf"(?i:eclipse\s+public\s+{_L}){_V}"),
    ("BSD-2-Clause", rf"(?i:\b(?:2|two)[\s-]+clause\s+bsd\b|\bsimplified\s+bsd\b|\bfreebsd\s+{_L}|\bbsd[\s-]+(?:2|two)[\s-]+clause\b|\bbsd\s+{_L}\s*\(?2[\s-]clause)"),
    ("BSD-3-Clause", rf"(?i:\b(?:3|three)[\s-]+clause\s+bsd\b|\b(?:new|modified|revised)\s+bsd\b|\bbsd[\s-]+(?:3|three)[\s-]+clause\b|\bbsd\s+{_L}\s*\(?3[\s-]clause)"),
    ("BSD-3-Clause", r"(?i:redistribution and use in source and binary forms\b.*?(?:neither the name|names of (?:its|the) contributors))"),
    ("BSD-2-Clause", r"(?i:redistribution and use in source and binary forms)"),
    ("BSD", rf"(?i:\bbsd[\s-]+(?:style\s+)?{_L}|\bbsd[\s-]style\b)"),
    ("0BSD", rf"\b0BSD\b|(?i:zero[\s-]clause\s+bsd)"),
    ("MIT", rf"\bMIT(?:[\s/-]+X11)?[\s-]+(?i:{_L})|\(MIT\)|(?i:\bexpat\b(?:\s+{_L})?)|(?i:{_L})\s*:?\s*\(?MIT\b|(?i:under)\s+(?:the\s+)?MIT\b|(?i:permission is hereby granted, free of charge, to any person obtaining a copy)"),
    ("0BSD", r"(?i:permission to use, copy, modify, and/?(?:or)? distribute this software for any purpose with or without fee is hereby granted\.)"),
    ("ISC", rf"\bISC[\s-]+(?i:{_L})|(?i:{_L})\s*:?\s*ISC\b|(?i:under)\s+(?:the\s+)?ISC\b|(?i:permission to use, copy, modify, and/?(?:or)? distribute this software for any purpose with or without fee)"),
    ("Unlicense", r"(?i:\b(?:the\s+)?unlicense\b|this is free and unencumbered software)"),
    ("Zlib", r"(?i:this software is provided .?as-is.?, without any express or implied warranty\b.*?altered source versions must be plainly marked)"),
    ("Zlib", rf"(?i:\bzlib(?:/libpng)?\s+{_L}|{_L}\s*:?\s*zlib\b)"),
    ("BSL-1.0", rf"(?i:boost\s+software\s+{_L})"),
    ("CC0-1.0", r"(?i:\bcc0\b|creative\s+commons\s+zero)"),
    ("WTFPL", r"\bWTFPL\b"),
]
_NAMES = [(k, re.compile(p)) for k, p in NAMES]
#: Versions meant where a family is named without one; several, since any of them fits.
FAMILIES = {
    "AGPL": ["3.0"], "LGPL": ["2.1", "3.0"], "GPL": ["2.0", "3.0"], "MPL": ["2.0"], "Apache": ["2.0"], "EPL": ["1.0", "2.0"],
}
#: Recorded licences that say that nothing is known.
NOTHING = {"", "none", "other", "noassertion", "unknown", "null", "n/a", "na", "-", "unlicensed", "proprietary", "see license", "custom"}

#: Words that licences are named by: those of the patterns and identifiers above. Others are masked.
_WORDS = {w.lower() for text in [*(p.replace(r"\b", " ").replace(r"\s", " ") for _, p in NAMES), *SPDX] for w in re.findall(r"[A-Za-z0-9]{2,}", text)} | {"license", "licence", "licenses", "licences", "licensed", "version", "ver", "libpng"}
_WORD = re.compile(r"[^\W_][\w.'@+/-]*")
_VERSION = re.compile(r"v?\d(?:\.\d){0,2}\.?", re.I)
_SPDX_LINE = re.compile(r"(?i)SPDX-License-Identifier:\s*([^\n*]+)")
_SIGNS = re.compile(r"(?m)^[ \t]*(?://+|/\*+|\*+/|\*+(?!/)|#+)[ \t]?|\*+/")
_HEAD = re.compile(r"\ufeff?(?:\s+|//[^\n]*|/\*.*?\*/)*", re.S)
_OPEN = re.compile(r"/\*.*\Z", re.S)
_YEARS = re.compile(r"\b(?:19|20)\d\d(?:\s*[-,]\s*(?:19|20)?\d\d)*\b")
_HOLDER = re.compile(r"(?:[A-Z][\w'.-]*[ \t]+){1,5}(?=(?:authors|contributors|developers)\b)")


def spdx_ids(expression: str) -> set[str]:
    """Licences of an SPDX expression; both sides of OR and AND count, exceptions do not."""
    out: set[str] = set()
    for part in re.split(r"(?i)\s+(?:or|and)\s+|[()/,;|]", re.sub(r"(?i)\s+with\s+[\w.-]+", "", expression)):
        t = re.sub(r"(?:-only|-or-later|\+)$", "", part.strip().strip(".").lower())
        if t in _SPDX:
            out.add(_SPDX[t])
    return out


def licences_in(text: str | None) -> set[str]:
    """Licences that a text names; "only" and "or later" make no difference. Copyright lines alone name nothing."""
    if not text:
        return set()
    out: set[str] = set()
    for m in _SPDX_LINE.finditer(text):
        out |= spdx_ids(m[1].strip())
    flat = re.sub(r"\s+", " ", _SIGNS.sub(" ", _SPDX_LINE.sub(" ", text)))
    for name, rx in _NAMES:
        def take(m: re.Match, name=name) -> str:
            if name in FAMILIES:
                v = m[1] if m.lastindex else None
                v = v if v is None or "." in v else v + ".0"
                for x in [v] if v else FAMILIES[name]:
                    out.add(f"{name}-{x}")
            elif name == "BSD":
                out.update(("BSD-2-Clause", "BSD-3-Clause"))
            else:
                out.add(name)
            return " "

        flat = rx.sub(take, flat)
    return out


def recorded_licences(value: str | None) -> set[str]:
    """Licences of a free-text field: an SPDX expression, a short name, or running text."""
    t = (value or "").strip()
    if t.lower() in NOTHING:
        return set()
    if ids := spdx_ids(t):
        return ids
    short = re.sub(r"[\s_-]+", "", t.lower())
    for name, versions in FAMILIES.items():
        if m := re.fullmatch(rf"(?:gnu)?{name.lower()}(?:licen[cs]e)?,?(?:version)?v?(\d(?:\.\d)?)?(?:only|orlater|\+)?", short):
            v = m[1]
            return {f"{name}-{x}" for x in ([v if "." in v else v + ".0"] if v else versions)}
    return licences_in(t) or licences_in(f"{t} license") or (spdx_ids(t.split()[0]) if t.split() else set())


def masked_words(text: str) -> str:
    """``text`` with "_" for each run of words that take no part in naming a licence; lines with an SPDX identifier stay."""

    def keep(m: re.Match) -> str:
        w = m[0]
        return w if _VERSION.fullmatch(w) or any(x.lower() in _WORDS for x in re.split(r"[^A-Za-z0-9]+", w) if x) else "_"

    lines = [x if "SPDX-License-Identifier" in x else _WORD.sub(keep, x) for x in text.split("\n")]
    return re.sub(r"_(?:[\s,;:.'\"()]*_)+", "_", "\n".join(lines))


def header_block(content: str | None) -> str:
    """The comments before the package clause, masked; "" where there are none."""
    if not content:
        return ""
    head = _HEAD.match(content)[0]
    rest = content[len(head):]
    if rest.startswith("/*"):
        head += rest  # a comment that never ends
    if "//" not in head and "/*" not in head:
        return ""
    head = _SIGNS.sub(" ", _HOLDER.sub("_ ", _YEARS.sub("_", head.replace("\r\n", "\n"))))
    return re.sub(r"\s*\n\s*", "\n", re.sub(r"[ \t]+", " ", masked_words(head))).strip()


def _labels(df: DataFrame, key: str, text: str, how) -> DataFrame:
    """(key, licences) with ``how`` applied once to each row of ``df``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({key: f[key], "licences": [sorted(how(t)) for t in f["__text"]]})

    return df.select(key, F.col(text).alias("__text")).mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, licences array<string>")


def notices(files: DataFrame) -> DataFrame:
    """(file_id, licences) of the files whose own notice names a licence."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads = [header_block(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(heads, pa.string())], names=["file_id", "block"])

    found = spread(files.select(F.col("file_id").cast("bigint").alias("file_id"), "content")).mapInArrow(blocks, "file_id bigint, block string").where("block <> ''")
    found = materialise(found.withColumn("digest", F.unhex(F.md5("block"))), "headers")  # read twice; texts are scanned once
    distinct = found.groupBy("digest").agg(F.first("block").alias("block"))
    known = _labels(distinct, "digest", "block", licences_in).where("size(licences) > 0")
    # One block may stand in a third of all files: its files are spread over SALTS parts, each of which has the label.
    salted = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = found.select("file_id", "digest", F.pmod(F.xxhash64("file_id"), F.lit(SALTS)).cast("int").alias("salt")).join(salted, ["digest", "salt"])
    return named.select("file_id", "licences")


def repository_sources(license_files: DataFrame, jobs: DataFrame) -> DataFrame:
    """(repository_id, files, recorded): licences of the licence files and of the recorded field; null where none is named.

    Each distinct body and each distinct recorded value is identified once.
    """
    bodies = license_files.where("repository_id IS NOT NULL").select("repository_id", F.unhex(F.md5("body")).alias("digest"), "body")
    body = _labels(bodies.groupBy("digest").agg(F.first("body").alias("body")), "digest", "body", licences_in)
    of_files = bodies.select("repository_id", "digest").join(body, "digest").groupBy("repository_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("licences")))).alias("files"))
    rows = jobs.where("repo_id IS NOT NULL AND license IS NOT NULL").select(F.col("repo_id").alias("repository_id"), "license").distinct()
    value = _labels(rows.select("license").distinct(), "license", "license", recorded_licences)
    of_jobs = rows.join(value, "license").groupBy("repository_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("licences")))).alias("recorded"))
    empty = lambda c: F.when(F.size(c) > 0, F.col(c))
    return of_files.join(of_jobs, "repository_id", "full").select("repository_id", empty("files").alias("files"), empty("recorded").alias("recorded"))


def _judge(df: DataFrame, sources: list[str], keep: list[str]) -> DataFrame:
    given = F.filter(F.array(*sources), lambda x: x.isNotNull())
    common = F.aggregate(F.slice(given, 2, 99), F.element_at(given, 1), lambda acc, x: F.array_intersect(acc, x))
    df = df.withColumn("given", F.size(given)).withColumn("common", F.when(F.size(given) > 0, common))
    finding = F.when(F.col("given") == 0, "unknown").when(F.size("common") == 0, "conflict").otherwise("agreed")
    return df.select(*keep, F.coalesce("common", F.array().cast("array<string>")).alias("licences"), finding.alias("finding"))


def file_licences(files: DataFrame, license_files: DataFrame, jobs: DataFrame) -> DataFrame:
    """(file_id, repository_id, licences, finding) of every file.

    ``licences`` is what all sources allow; ``finding`` is agreed, conflict (no licence is in all sources) or unknown
    (no source names one). Files of null repository have only their notice.
    """
    base = files.select(F.col("file_id").cast("bigint").alias("file_id"), "repository_id")
    all_of = base.join(notices(files).withColumnRenamed("licences", "notice"), "file_id", "left").join(repository_sources(license_files, jobs), "repository_id", "left")
    return _judge(all_of, ["notice", "files", "recorded"], ["file_id", "repository_id"])


def repository_licences(license_files: DataFrame, jobs: DataFrame) -> DataFrame:
    """(repository_id, licences, finding) of every repository that licence files or jobs name."""
    named = jobs.select(F.col("repo_id").alias("repository_id")).union(license_files.select("repository_id")).where("repository_id IS NOT NULL").distinct()
    return _judge(named.join(repository_sources(license_files, jobs), "repository_id", "left"), ["files", "recorded"], ["repository_id"])
