"""Record schemas. Names and types are fixed; a column marked nullable may be null, and is then written as null."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, B, A = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.ArrayType(T.StringType())


def _schema(spec: str) -> T.StructType:
    kinds = {"s": S, "i": I, "l": L, "b": B, "a": A}
    fields = []
    for item in spec.split():
        name, kind = item.split(":")
        fields.append(T.StructField(name, kinds[kind[0]], kind.endswith("?")))
    return T.StructType(fields)


# Fields of the record kinds (s text, i int, l bigint, b boolean, a texts; ? nullable).
DISCOVERY = _schema("schema_version:s relative_path:s accepted:b skip_reason:s? detail:s? bytes:l sha256:s? duplicate_of:s? is_test:b project:s package_name:s? build_constraint:s? build_match:b? cgo:b")
SAMPLE = _schema(
    "schema_version:s sample_id:s language:s repository_id:s revision:s? relative_path:s project:s package_name:s is_test:b source_sha256:s caret_utf16_offset:i caret_byte_offset:l "
    "caret_line_zero_based:i caret_column_utf16_zero_based:i caret_column_byte_zero_based:i target_end_utf16_offset:i target_end_byte_offset:l line_start_utf16_offset:i line_start_byte_offset:l "
    "line_end_utf16_offset:i line_end_byte_offset:l caret_kind:s caret_subkind:s? tags:a left_context_start_utf16_offset:i left_context_start_byte_offset:l left_context_truncated:b left_context:s "
    "target_text:s right_context:s right_context_end_utf16_offset:i right_context_end_byte_offset:l right_context_truncated:b end_of_line:s indentation:s quality_flags:a split:s split_group:s "
    "build_constraint:s? build_match:b? semantic_status:s semantic_reason:s? config_version:s config_sha256:s generator:s"
)
CORPUS = _schema(
    "schema_version:s repository_id:s revision:s? relative_path:s language:s sha256:s bytes:l license:s? license_reason:s? encoding:s has_bom:b newline_style:s project:s package_name:s is_test:b split:s "
    "lines:i build_constraint:s? build_match:b? content:s content_normalized:b"
)
EXCLUSION = _schema("schema_version:s relative_path:s line_zero_based:i byte_offset:i reason:s caret_kind:s line_text:s")
TRAIN = _schema("sample_id:s split:s prompt:s completion:s")
