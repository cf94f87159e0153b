"""Token counts of texts under a public tokenizer read from a vocabulary file."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.textbatch import by_volume

#: Rank file of a byte-level BPE for many languages. Every executor must see the path.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How text is split before merges; the published pattern of this family (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(path: str):
    """The encoding of a rank file, loaded once in a process."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(texts: list[str | None], path: str) -> np.ndarray:
    encode = encoding(path).encode_ordinary
    return np.fromiter((len(encode(t)) if t else 0 for t in texts), np.int64, len(texts))


def with_token_counts(rows: DataFrame, text: str, into: str = "n_tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """``rows`` with the number of tokens of ``text`` in place of the text; null counts 0."""
    kept = [c for c in rows.columns if c != text]
    if into in kept:
        raise ValueError(f"the column {into} is there already")
    schema = rows.select(*kept, F.lit(0).cast("long").alias(into)).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, text):
            tokens = count_tokens(batch.column(batch.schema.get_field_index(text)).to_pylist(), tokenizer)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(tokens)], [*kept, into])

    return rows.select(*kept, text).mapInArrow(count, schema)
