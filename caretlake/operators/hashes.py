"""Content hashes as they stand in the tables: letter case, outer blanks and a leading ``sha256:`` do not matter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_hash(c: Column) -> Column:
    """The bare lower-case hash; null for null or blank."""
    t = F.trim(F.regexp_replace(F.lower(F.trim(c)), r"^sha256:", ""))
    return F.when(t != "", t)


def file_hashes(files: DataFrame, discovery: DataFrame) -> DataFrame:
    """(file_id, hash): the hash of each corpus file; a null one is read from the discovery row of the same path.

    Only files without a hash are looked up, so that little is moved.
    """
    own = files.select("file_id", "repository_id", "relative_path", clean_hash(F.col("sha256")).alias("hash"))
    known = own.where("hash IS NOT NULL").select("file_id", "hash")
    found = discovery.groupBy("repository_id", "relative_path").agg(F.max_by(clean_hash(F.col("sha256")), F.when(F.col("sha256").isNotNull(), F.coalesce("scanned_at", F.timestamp_seconds(F.lit(0))))).alias("hash"))
    return known.unionByName(own.where("hash IS NULL").drop("hash").join(found.where("hash IS NOT NULL"), ["repository_id", "relative_path"]).select("file_id", "hash"))
