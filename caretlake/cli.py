"""Command line: ``python -m caretlake.cli VERB``. Verbs: config, discover, extract, validate, render."""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caretlake import config
from caretlake.operators import discovery, extract, rendering, reports, validation
from caretlake.session import discard, local_session, materialise
from caretlake.sources import records
from caretlake.sources.records import publish, write_split_parquet
from caretlake.sources.tree import read_tree


def _files(spark: SparkSession, path: str, trees: bool) -> DataFrame:
    """A source tree, or Parquet files with repository_id, relative_path and content, and a licence where they have one."""
    if path.endswith(".parquet"):
        df = spark.read.parquet(path)
        return df.select("repository_id", "relative_path", F.col("content").cast("binary").alias("content"), *[c for c in ("license", "revision", "split_group") if c in df.columns])
    return read_tree(spark, path, trees=str(trees).lower()).select("repository_id", "relative_path", "content", "revision")


def _rules(cfg: config.Config) -> discovery.FilterConfig:
    return discovery.FilterConfig(markers=cfg.markers, secrets=cfg.secrets, max_bytes=cfg.max_bytes, max_line=cfg.max_line_bytes, allowed=cfg.allowed, build_excluded=cfg.build_excluded)


def discover(spark: SparkSession, files: DataFrame, cfg: config.Config) -> DataFrame:
    """Decisions with the facts of each file. With ``allowed`` licences, files without a licence column have none."""
    if cfg.allowed is not None and "license" not in files.columns:
        files = files.withColumn("license", F.lit(None).cast("string"))
    return discovery.decide(files, _rules(cfg), licence="license" if cfg.allowed is not None else None, facts=True)


def accepted_texts(spark: SparkSession, files: DataFrame, cfg: config.Config) -> DataFrame:
    """The accepted files as texts without byte order mark, named by a hash of repository and path."""
    accepted = discover(spark, files, cfg).where("accepted").select("repository_id", "relative_path")
    texts = files.join(accepted, ["repository_id", "relative_path"], "left_semi")
    text = F.col("content").cast("string")
    rest = [c for c in files.columns if c not in ("content", "repository_id", "relative_path")]
    return texts.select(F.xxhash64("repository_id", "relative_path").alias("file_id"), "repository_id", "relative_path", *rest, text.startswith("\ufeff").alias("has_bom"), F.regexp_replace(text, "\\A\ufeff", "").alias("content"))


def validate(samples: DataFrame, files: DataFrame | None = None) -> tuple[dict[str, int], bool]:
    """Failures per check, and whether there are none. Repeated ids and groups in two splits count too.

    With ``files`` every record is held against the bytes of its file as well; a missing file is a failure.
    """
    checks = validation.field_checks()
    if files is not None:
        text = F.col("content").cast("string")
        texts = files.select("repository_id", "relative_path", F.regexp_replace(text, "\\A\ufeff", "").alias("content"), F.when(text.startswith("\ufeff"), 3).otherwise(0).alias("bom"))
        held, checks = validation.reconstructed(samples, texts), checks | validation.file_checks()
    failed = {r["check"]: r["failed"] for r in validation.report(held if files is not None else samples, checks).collect() if r["failed"]}
    twice = samples.groupBy("sample_id").count().where("count > 1").count()
    torn = samples.groupBy("split_group").agg(F.countDistinct("split").alias("n")).where("n > 1").count()
    failed |= {k: v for k, v in (("duplicate_sample_id", twice), ("group_in_two_splits", torn)) if v}
    return failed, not failed


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="caretlake")
    verbs = p.add_subparsers(dest="verb", required=True)
    for name, needs_out in (("config", False), ("discover", True), ("extract", True), ("validate", False), ("render", True)):
        v = verbs.add_parser(name)
        v.add_argument("--config", help="JSON file over the defaults")
        if name != "config":
            v.add_argument("--input", required=True)
        if name in ("discover", "extract"):
            v.add_argument("--trees", action="store_true", help="input is a folder of source trees, one a repository")
        if name == "validate":
            v.add_argument("--files", help="the source tree or Parquet files that the records were cut from")
            v.add_argument("--trees", action="store_true", help="files is a folder of source trees, one a repository")
        if name == "extract":
            v.add_argument("--corpus", help="also write corpus records here")
            v.add_argument("--manifest", help="write settings, counters and throughput as JSON here")
            v.add_argument("--exclusions", help="also write examples of what was left out here")
        if needs_out:
            v.add_argument("--out", required=True)
            v.add_argument("--overwrite", action="store_true")
        if name == "render":
            v.add_argument("--code-units", type=int, default=4000)
    a = p.parse_args(argv)
    try:
        cfg = config.load(open(a.config).read() if a.config else "{}")
    except (ValueError, OSError) as e:
        print(e, file=sys.stderr)
        return 2
    if a.verb == "config":
        print(json.dumps(dataclasses.asdict(cfg) | {"sha256": cfg.sha256()}, indent=1, sort_keys=True))
        return 0
    spark = spark or local_session()
    if a.verb == "validate":
        failed, ok = validate(spark.read.parquet(a.input), _files(spark, a.files, a.trees) if a.files else None)
        print(json.dumps({"ok": ok, "failed": failed}, sort_keys=True))
        return 0 if ok else 1
    if a.verb == "render":
        write_split_parquet(rendering.render(spark.read.parquet(a.input), None, a.code_units), a.out, a.overwrite)
        return 0
    files = _files(spark, a.input, a.trees)
    if a.verb == "discover":
        publish(discover(spark, files, cfg), a.out, a.overwrite)
        return 0
    texts = materialise(accepted_texts(spark, files, cfg), "accepted")
    start = time.time()
    publish(extract.in_source_order(extract.samples(texts, cfg).drop("file_id")), a.out, a.overwrite)
    seconds = time.time() - start
    if a.corpus:
        publish(extract.corpus_records(texts, cfg, F.col("license") if "license" in texts.columns else None).drop("file_id"), a.corpus, a.overwrite)
    if a.exclusions:
        publish(extract.exclusions(texts, cfg).drop("file_id"), a.exclusions, a.overwrite)
    counters = reports.sample_counters(spark.read.parquet(a.out))
    told = json.loads(records.summary_json(counters, config_sha256=cfg.sha256(), seed=cfg.seed, throughput=reports.throughput(spark.read.parquet(a.out).count(), texts, seconds)))
    if a.manifest:
        records.write_json(spark, a.manifest, told | {"config": dataclasses.asdict(cfg), "generator": extract.GENERATOR, "outputs": [x for x in (a.out, a.corpus, a.exclusions) if x]})
    print(json.dumps(told, sort_keys=True))
    discard(texts)
    return 0


if __name__ == "__main__":
    sys.exit(main())
