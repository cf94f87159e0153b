"""Views of Arrow text columns as numpy arrays, shared by the operators here."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: White space as str.isspace() has it (fixed values).
SPACES = np.array(
    [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    dtype=np.uint32,
)


def utf8_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a text column, without copying text.

    A null row has no bytes.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of per-byte flags in each row."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def by_volume(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that one has about ``most_bytes`` of text, or a single row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        _, offsets = utf8_view(column)
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + most_bytes, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in one array, and where each text starts (one more than texts)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return points, starts


def is_space(points: np.ndarray) -> np.ndarray:
    out = np.isin(points, SPACES[SPACES > 255])
    out |= np.isin(points, SPACES[SPACES <= 255])
    return out
