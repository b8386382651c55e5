"""Sizes of texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from caretlake.session import spread

VOCABULARY = os.environ.get("CARETLAKE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the pre-tokenizer pattern that belongs to the vocabulary file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_loaded: dict = {}


def encoding(vocabulary: str | bytes = VOCABULARY):
    """The tokenizer of a rank file (its path or its bytes), made once a process."""
    key = vocabulary if isinstance(vocabulary, str) else hashlib.sha256(vocabulary).hexdigest()
    if key not in _loaded:
        import tiktoken

        if isinstance(vocabulary, str):
            with open(vocabulary, "rb") as f:
                vocabulary = f.read()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        _loaded[key] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[key]


PIECE_CHARS = 1 << 18


def count_tokens(text: str | None, enc) -> int:
    """Tokens of a whole text; a very long one is cut before white space that follows a word, where the pattern cuts anyway."""
    if not text:
        return 0
    if len(text) <= PIECE_CHARS:
        return len(enc.encode_ordinary(text))
    total, at = 0, 0
    while at < len(text):
        end = min(at + PIECE_CHARS, len(text))
        if end < len(text):
            cut = text.rfind(" ", at + 1, end)
            while cut > at and text[cut - 1].isspace():
                cut -= 1
            end = cut if cut > at else end
        total += len(enc.encode_ordinary(text[at:end]))
        at = end
    return total


def token_sizes(documents: DataFrame, id_col: str = "doc_id", text: str = "text", keep: list[str] = (), vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, *keep, tokens) of every row; null and empty texts have 0 tokens. A text met again within a task is not tokenized again.

    The vocabulary file is read where this is called and sent to the executors (about 1 MB), which need not have it.
    """
    with open(vocabulary, "rb") as f:
        held = documents.sparkSession.sparkContext.broadcast(f.read())
    fields = [documents.schema[c] for c in (id_col, *keep)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", tokens bigint"
    k = len(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen = encoding(held.value), {}
        for b in batches:
            out = []
            for t in b.column(k).to_pylist():
                key = (hash(t), len(t or ""))
                if key not in seen:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen[key] = count_tokens(t, enc)
                out.append(seen[key])
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(out, pa.int64())], names=[*(f.name for f in fields), "tokens"])

    return spread(documents.select(id_col, *keep, text)).mapInArrow(run, schema)
