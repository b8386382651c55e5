"""Reading and writing records: JSON lines, salvage of broken files, Parquet sinks, manifests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caretlake.operators.sampling import cap


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Plain or gzip, blank lines skipped; a line that does not fit the schema fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str, gzip: bool = False) -> None:
    """One object a line, nulls written; refuses to overwrite."""
    df.write.option("ignoreNullFields", "false").option("compression", "gzip" if gzip else "none").mode("errorifexists").json(path)


def salvage(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): of each file the complete lines before its first broken one.

    A file is read whole by one task, since what counts is the order of its lines; files stand beside each other.
    """
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    done = F.when(F.col("value").endswith("\n"), F.col("value")).otherwise(F.concat(F.expr("left(value, length(value) - length(substring_index(value, '\\n', -1)))")))
    lines = files.select("file", F.posexplode(F.split(done, "\n", -1)).alias("line", "value")).where("value <> ''")
    ok = F.try_parse_json("value").isNotNull()
    first_bad = lines.where(~ok).groupBy("file").agg(F.min("line").alias("bad"))
    return lines.join(first_bad, "file", "left").where("bad IS NULL OR line < bad").select("file", "line", "value")


def read_manifest(spark: SparkSession, path: str, key: str = "repository_id") -> DataFrame:
    """Repositories of a JSON-lines manifest, the first row of each id by content order."""
    m = spark.read.json(path)
    return cap(m, [key], [F.to_json(F.struct(*m.columns))], 1)


def write_split_parquet(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """One folder a split, zstd; rows of a split are spread over tasks, so that a large split is no single file."""
    df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "zstd").partitionBy("split").parquet(path)


def project(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema in its order and types; what ``df`` does not have is null, what else it has is left out."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def kept_records(records: DataFrame, samples: DataFrame, policy: str | None = None) -> DataFrame:
    """Records of samples that are kept, of one visibility policy if it is given."""
    r = records if policy is None else records.where(F.col("visibility_policy") == policy)
    return r.join(samples.select("sample_id").distinct(), "sample_id", "left_semi")


def packed_facts(records: DataFrame) -> DataFrame:
    """Records of facts in the columns of the published table: what the audit found, the receiver's members as those of ``this``, the call as the one candidate."""
    call = F.struct(
        F.concat(F.coalesce("call_name", F.lit("")), "call_signature").alias("signature"), F.col("argument_index").alias("argument_index"), F.col("parameter_name").alias("parameter_name"), F.col("expected_type").alias("parameter_type")
    )
    none = F.array().cast("array<struct<signature: string, argument_index: int, parameter_name: string, parameter_type: string>>")
    r = records.withColumn("invocation_candidates", F.when(F.coalesce("call_signature", F.lit("")) != "", F.array(call)).otherwise(none))
    r = r.withColumn("target_identifiers", F.col("leakage.target_identifiers")).withColumn("covered_target_identifiers", F.col("leakage.mentioned"))
    return r.withColumnRenamed("receiver_members", "this_members").withColumn("snapshot_syntax_errors", F.lit(None).cast("int")).drop("leakage", "call_name", "call_signature", "argument_index", "parameter_name")


def remaining(manifests: list[DataFrame], done: DataFrame, key: str = "repository_id") -> DataFrame:
    """Rows of several manifests whose key is in none of ``done``, each key once: the row of the first manifest, then by content."""
    every = None
    for k, m in enumerate(manifests):
        m = m.withColumn("round_", F.lit(k))
        every = m if every is None else every.unionByName(m, allowMissingColumns=True)
    fresh = every.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")
    return cap(fresh, [key], [F.col("round_"), F.to_json(F.struct(*[c for c in fresh.columns if c != "round_"]))], 1).drop("round_")


def merge_parquet(parts: list[DataFrame], path: str, overwrite: bool = False, rows_per_file: int = 2_000_000) -> None:
    """Tables of several repositories of one kind as one, a folder a split; missing columns are null. Files are cut by rows, row groups by bytes."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    every.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy("split").parquet(path)


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """One JSON text in one file of whatever file system ``path`` lies on; an existing file is replaced."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True)
    try:
        out.write(bytearray(json.dumps(value, indent=1, sort_keys=True).encode() + b"\n"))
    finally:
        out.close()


def publish(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Written beside the target, then renamed: readers see all or nothing; an existing target is refused without ``overwrite``.

    With it the old target is moved away before and deleted after the new one stands; if that fails it is moved back.
    """
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target) and not overwrite:
        raise FileExistsError(path)
    staging = path.rstrip("/") + ".staging"
    df.write.mode("overwrite").option("compression", "zstd").parquet(staging)
    at, old = (spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + x) for x in (".staging", ".old"))
    held = fs.exists(target)
    if held:
        fs.delete(old, True)
        fs.rename(target, old)
    if not fs.rename(at, target):
        if held:
            fs.rename(old, target)
        raise OSError(f"cannot rename {staging}")
    if held:
        fs.delete(old, True)


def summary_json(counters: DataFrame, **more) -> str:
    """Counters (a bounded number of names) and other facts as one JSON text."""
    return json.dumps({"counters": {r["counter"]: r["value"] for r in counters.collect()}, **more}, sort_keys=True)
