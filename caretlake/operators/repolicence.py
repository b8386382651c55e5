"""The licence of a repository from its root files and its declared identifier, by ordered signatures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretlake.operators.discovery import matches

# Licence signatures in order: identifier, patterns that must all match, patterns of which none may.
SIGNATURES = [
    ("Apache-2.0", [r"(?i)apache license", r"(?i)version 2\.0"], []), ("MPL-2.0", [r"(?i)mozilla public license,? (version|v\.?) ?2\.0"], []),
    ("AGPL-3.0", [r"(?i)gnu affero general public license"], []), ("LGPL-3.0", [r"(?i)gnu lesser general public license"], []),
    ("GPL-3.0", [r"(?i)gnu general public license", r"(?i)version 3"], []), ("GPL-2.0", [r"(?i)gnu general public license", r"(?i)version 2"], []),
    ("Unlicense", [r"(?i)this is free and unencumbered software released into the public domain"], []),
    ("0BSD", [r"(?i)permission to use, copy, modify, and/or distribute this software for any purpose with or without fee", r"(?i)zero-clause|0bsd"], []),
    ("ISC", [r"(?i)permission to use, copy, modify, and(/or)? distribute this software for any purpose with or without fee"], []),
    ("MIT", [r"(?i)permission is hereby granted, free of charge", r"(?i)the above copyright notice and this permission notice shall be\s+included"], []),
    ("BSD-3-Clause", [r"(?i)redistribution and use in source and binary forms", r"(?i)(neither the name|names of (its|the) contributors)"], []),
    ("BSD-2-Clause", [r"(?i)redistribution and use in source and binary forms"], [r"(?i)(neither the name|names of (its|the) contributors)"]),
    ("Zlib", [r"(?i)this software is provided 'as-is', without any express or implied", r"(?i)altered source versions must be plainly marked"], []),
]
FILE_NAMES, MOST_BYTES = "^(license|licence|copying)", 262144


def detect(license_files: DataFrame) -> DataFrame:
    """(repository_id, file_name, spdx): the first signature that holds in the first file, by name, in which one does.

    Only root files named like a licence of at most 256 KiB count; white space is collapsed. A null body names nothing.
    """
    b = license_files.where(F.lower("file_name").rlike(FILE_NAMES) & (F.octet_length("body") <= MOST_BYTES))
    t = F.trim(F.regexp_replace("body", r"[\t\n\f\r ]+", " "))
    out = F.lit(None).cast("string")
    for spdx, needs, bars in reversed(SIGNATURES):
        cond = F.lit(True)
        for p in needs:
            cond = cond & matches(t, p)
        for p in bars:
            cond = cond & ~matches(t, p)
        out = F.when(cond, spdx).otherwise(out)
    s = b.select("repository_id", "file_name", out.alias("spdx")).where("spdx IS NOT NULL")
    return s.groupBy("repository_id").agg(F.min_by(F.struct("file_name", "spdx"), "file_name").alias("x")).select("repository_id", "x.file_name", "x.spdx")


def gate(declared: DataFrame, detected: DataFrame, allowed: list[str]) -> DataFrame:
    """(repository_id, licence, reason, allowed) for ``declared`` (repository_id, declared); a blank declaration is none."""
    v = declared.withColumn("declared", F.nullif("declared", F.lit(""))).join(detected, "repository_id", "left")
    conflict = F.col("spdx").isNotNull() & F.col("declared").isNotNull() & (F.lower("spdx") != F.lower("declared"))
    reason = (
        F.when(conflict, F.concat(F.lit("license_conflict: declared "), "declared", F.lit(", detected "), "spdx", F.lit(" in "), "file_name"))
        .when(F.col("spdx").isNotNull(), F.concat(F.lit("detected:"), "file_name")).when(F.col("declared").isNotNull(), "declared_only").otherwise("license_unknown")
    )
    w = v.select("repository_id", F.coalesce("spdx", "declared").alias("licence"), reason.alias("reason"))
    fine, open_ = F.coalesce(F.col("licence").isin(*allowed), F.lit(False)), ~F.col("reason").startswith("license_")
    return w.select("repository_id", "licence", F.when(~open_ | fine, F.col("reason")).otherwise(F.concat("reason", F.lit(" (not allowlisted)"))).alias("reason"), (open_ & fine).alias("allowed"))
