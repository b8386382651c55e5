"""Queries over small tables."""

import pytest

from caretlake.operators import validation
from caretlake.plans import dataset_queries


@pytest.fixture
def tables(spark, tmp_path):
    def write(**rows):
        for name, (data, schema) in rows.items():
            spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def test_owned_elsewhere_reads_claims_of_all_batches(spark, tables):
    files = [("r1", "a.go", 5), ("r2", "b.go", 5), ("r3", "c.go", 1), ("r4", "d.go", 5), ("r5", "e.go", None)]
    claims = [
        (" SHA256:AA", "r9", 3), ("aa", "r9", 7), ("aa", "r1", 0),  # r9 first claims it in batch 3, before the file
        ("bb", "r9", 5), ("bb", "r2", 0),  # only in the same batch
        ("cc", "r9", 2), ("dd", "r9", 0), ("ee", "r9", 0), (None, "r9", 0), ("bb", None, 0),
    ]
    samples = [("s1", "r1", "a.go", "aa"), ("s2", "r1", "a.go", "aa"), ("s3", "r2", "b.go", "bb"), ("s4", "r3", "c.go", "cc"), ("s5", "r4", "d.go", "dd"), ("s6", "r5", "e.go", "ee"), ("s7", "r1", "gone.go", "dd"), ("s8", "r1", "a.go", "aa")]
    d = tables(
        corpus_files=(files, "repository_id string, relative_path string, batch int"),
        file_owner=(claims, "sha256 string, repo_id string, batch int"),
        samples=([(*s, None) for s in samples], "sample_id string, repository_id string, relative_path string, source_sha256 string, extracted_at timestamp"),
    )
    assert tuple(dataset_queries.owned_elsewhere(spark, d).first()) == (8, 4)


def test_samples_without_a_file_are_not_passed_over(spark):
    cols = "sample_id string, repository_id string, relative_path string, caret_byte_offset bigint, target_end_byte_offset bigint, left_context_start_byte_offset bigint, right_context_end_byte_offset bigint"
    samples = spark.createDataFrame([("s1", "r", "a.go", 1, 2, 0, 3), ("s2", "r", "gone.go", 1, 2, 0, 3)], cols)
    files = spark.createDataFrame([("r", "a.go", "abc", 0)], "repository_id string, relative_path string, content string, bom int")
    assert {r["sample_id"]: r["file_target"] for r in validation.reconstructed(samples, files).collect()} == {"s1": "b", "s2": None}
