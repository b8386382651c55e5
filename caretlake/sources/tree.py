"""A source tree as a table: a Python data source that sees hidden and underscored paths and filters before it reads."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from caretlake.functions.regexes import glob_to_regex

SCHEMA = "repository_id string, relative_path string, bytes bigint, content binary, error string, revision string, module_path string"
PER_TASK = 64 << 20
TREES_A_TASK = 8


class _Files(InputPartition):
    """Files of one tree, or whole trees that the task walks itself."""

    def __init__(self, root: str = "", repo: str = "", files: list[tuple[str, str, int]] = (), trees: list[tuple[str, str]] = ()):
        self.root, self.repo, self.files, self.trees = root, repo, list(files), list(trees)


class TreeReader(DataSourceReader):
    """Options: path (one tree, or a folder of trees with ``trees=true``), include (globs joined by ``;``), maxBytes, repository."""

    def __init__(self, options: dict):
        self.root = options["path"].removeprefix("file://")
        self.trees = options.get("trees", "false").lower() == "true"
        self.include = [re.compile(glob_to_regex(g)) for g in options.get("include", "**/*.go").split(";")]
        self.most = int(options.get("maxbytes", options.get("maxBytes", 0)) or 0)
        self.repository = options.get("repository", "local/unknown")

    def _walk(self, root: str) -> Iterator[tuple[str, str, int]]:
        for at, dirs, names in os.walk(root):
            dirs[:] = sorted(d for d in dirs if d != ".git" and not os.path.islink(os.path.join(at, d)))
            for n in sorted(names):
                full = os.path.join(at, n)
                rel = os.path.relpath(full, root).replace(os.sep, "/")
                if os.path.isfile(full) and not os.path.islink(full) and any(rx.search(rel) for rx in self.include):
                    yield rel, full, os.path.getsize(full)

    def partitions(self) -> list[InputPartition]:
        """Of many trees the driver lists only their names, ``TREES_A_TASK`` a task; one tree is listed, about 64 MB of files a task."""
        if self.trees:
            roots = [(os.path.join(self.root, d), d) for d in sorted(os.listdir(self.root)) if os.path.isdir(os.path.join(self.root, d))]
            return [_Files(trees=roots[k : k + TREES_A_TASK]) for k in range(0, len(roots), TREES_A_TASK)] or [_Files()]
        out, now, size = [], [], 0
        for f in self._walk(self.root):
            now.append(f)
            size += f[2]
            if size >= PER_TASK:
                out.append(_Files(self.root, self.repository, now))
                now, size = [], 0
        return [*out, _Files(self.root, self.repository, now)] if now or not out else out

    def read(self, partition: _Files) -> Iterator[tuple]:
        """A file larger than maxBytes is listed without content; one that cannot be read has an error. Every row has its tree's commit and module."""
        for root, repo, files in [(partition.root, partition.repo, partition.files)] if partition.files else [(r, n, self._walk(r)) for r, n in partition.trees]:
            revision, module = revision_of(root), module_of(_text(os.path.join(root, "go.mod")))[0]
            for rel, full, size in files:
                if self.most and size > self.most:
                    yield repo, rel, size, None, None, revision, module
                    continue
                try:
                    with open(full, "rb") as f:
                        yield repo, rel, size, f.read(), None, revision, module
                except OSError as e:
                    yield repo, rel, size, None, str(e), revision, module


def _text(path: str) -> str | None:
    try:
        with open(path, encoding="utf-8", errors="replace") as f:
            return f.read()
    except OSError:
        return None


class TreeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "source_tree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TreeReader:
        return TreeReader(self.options)


def read_tree(spark: SparkSession, path: str, **options: str):
    spark.dataSource.register(TreeSource)
    r = spark.read.format("source_tree").option("path", path)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def module_of(go_mod: str | None) -> tuple[str | None, str | None]:
    """Module path and language version of a go.mod text."""
    if not go_mod:
        return None, None
    m = re.search(r"(?m)^\s*module\s+\"?([^\s\"]+)", go_mod)
    v = re.search(r"(?m)^\s*go\s+(\d[\w.]*)", go_mod)
    return (m[1] if m else None), (v[1] if v else None)


def revision_of(root: str) -> str | None:
    """The commit that a work tree stands on, read from its files: HEAD, the ref it names, or packed refs."""
    git = os.path.join(root, ".git")

    def text(name: str) -> str | None:
        try:
            with open(os.path.join(git, name)) as f:
                return f.read().strip()
        except OSError:
            return None

    head = text("HEAD")
    if head and head.startswith("ref: "):
        ref = head[5:].strip()
        head = text(ref) or next((x.split()[0] for x in (text("packed-refs") or "").splitlines() if x.endswith(" " + ref)), None)
    return head if head and re.fullmatch(r"[0-9a-f]{40}", head) else None


