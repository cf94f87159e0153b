"""Items packed into containers of fixed capacity (problem 8).

Method. Karmarkar-Karp differencing for many windows: every item starts as a
partial partition with one filled window. The two partial partitions of the
largest imbalance are merged, the fullest windows of one onto the emptiest of
the other, until one is left, whose windows are nearly equal. There are as many
windows as the total needs at least; while the fullest exceeds the capacity,
the window count rises and the differencing is done again.

An item above the capacity is cut first, into pieces that each fit: before a
word where the tokens allow it, so that a piece has the tokens it had within
its text. No other item is split.

Scale: items are spread by a hash of their id over groups of about
``ITEMS_PER_GROUP``, which bounds the work of one task whatever the size of the
input and however uneven the sources; the loss is less than a window a group.
Only ids and sizes are shuffled. Texts meet their windows afterwards
(``container_texts``), by id and then by container, whose size is bounded.

Nulls and ties: a null or empty text has no tokens and is no item. Equal items
are ordered by id and piece, so the same input gives the same containers.
Repeated rows are items of their own. An empty table gives no containers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.textbatch import by_volume
from lexmill.llm.tokenizers import TOKENIZER, encoding
from lexmill.session import shuffle_width

ITEMS_PER_GROUP = 2000


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window number of every item by multiway differencing."""
    n = len(sizes)
    if windows == 1:
        return np.zeros(n, np.int64)
    # a partial partition: sums of its windows, ascending, and for every window the items as a tree
    heap: list[tuple[int, int]] = []
    sums: dict[int, np.ndarray] = {}
    children: dict[int, tuple] = {}
    for i in range(n):
        start = np.zeros(windows, np.int64)
        start[-1] = sizes[i]
        sums[i] = start
        heap.append((-int(sizes[i]), i))
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(both, kind="stable")
        both = both[order]
        children[made] = (a, b, order)
        sums[made] = both - both[0]
        heapq.heappush(heap, (-int(both[-1] - both[0]), made))
        made += 1
    # from the last partition down: the window that each slot of a partition went to
    out = np.empty(n, np.int64)
    stack = [(heap[0][1], np.arange(windows))]
    while stack:
        node, window = stack.pop()
        if node < n:
            out[node] = window[-1]
            continue
        a, b, order = children.pop(node)
        placed = np.empty(windows, np.int64)
        placed[order] = window
        stack.append((a, placed))
        stack.append((b, placed[::-1]))
    return out


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window number of every item; no window exceeds the capacity (sizes do not, either)."""
    if len(sizes) == 0:
        return np.empty(0, np.int64)
    full = sizes >= capacity
    rest = np.flatnonzero(~full)
    out = np.empty(len(sizes), np.int64)
    windows = 0
    if len(rest):
        windows = max(1, -(-int(sizes[rest].sum()) // capacity))
        while True:
            placed = difference(sizes[rest], windows)
            if np.bincount(placed, sizes[rest], windows).max() <= capacity:
                break
            windows += max(1, windows // 100)
        _, out[rest] = np.unique(placed, return_inverse=True)
        windows = int(out[rest].max()) + 1
    out[full] = windows + np.arange(int(full.sum()))
    return out


#: Characters that are tokenized for each token of the capacity, and tokens beyond it that the cut of a stretch may touch.
WINDOW_CHARS, MARGIN = 6, 16


def token_pieces(text: str, capacity: int, path: str) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of the pieces of a text, in characters; one piece if it fits."""
    own = encoding(path)
    out: list[tuple[int, int, int]] = []
    start = 0
    while start < len(text):
        tokens, reach = _window(own, text, start, capacity)
        if reach == len(text) and len(tokens) <= capacity:
            out.append((start, reach, len(tokens)))
            break
        take = capacity
        while True:
            pieces = own.decode_tokens_bytes(tokens[: take + 1])
            word = next((k for k in range(take, take // 2, -1) if pieces[k][:1] in (b" ", b"\n")), take)
            head = b"".join(pieces[:word])
            chars = len(head.decode("utf-8", "ignore"))
            count = len(own.encode_ordinary(text[start : start + chars]))
            if chars and count <= capacity:
                break
            take -= max(1, count - capacity)
            if take < 1:
                raise ValueError("the capacity is below the tokens of a single character")
        out.append((start, start + chars, count))
        start += chars
    return out


def _window(own, text: str, start: int, capacity: int) -> tuple[list[int], int]:
    """Tokens from ``start`` on, more than the capacity unless the text ends before, and where they end.

    Only a stretch in proportion to the capacity is tokenized, so the time for a text is in proportion to its length.
    """
    length = WINDOW_CHARS * capacity
    while True:
        reach = min(len(text), start + length)
        tokens = own.encode_ordinary(text[start:reach])
        if reach == len(text) or len(tokens) > capacity + MARGIN:
            return tokens, reach
        length *= 2


def sized_items(rows: DataFrame, doc_id: str, text: str, capacity: int, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, piece_no, start, end, n_tokens`` of every item that has tokens."""
    base = rows.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.length("text") > 0)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, "text"):
            items = [(i, k + 1, *p) for i, t in enumerate(batch.column(1).to_pylist()) for k, p in enumerate(token_pieces(t, capacity, tokenizer))]
            row, number, start, end, tokens = (np.array(x, np.int64) for x in zip(*items))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(number.astype(np.int32)), *(pa.array(x) for x in (start, end, tokens))],
                ["doc_id", "piece_no", "start", "end", "n_tokens"],
            )

    kind = dict(base.dtypes)["doc_id"]
    return base.mapInArrow(measure, f"doc_id {kind}, piece_no int, start long, end long, n_tokens long")


def containers(items: DataFrame, capacity: int, n_rows: int, items_per_group: int = ITEMS_PER_GROUP) -> DataFrame:
    """``container_id, doc_id, piece_no, start, end, n_tokens`` of every item.

    ``n_rows``: about how many items there are; it sets the number of groups.
    """
    groups = max(1, -(-n_rows // items_per_group))
    kind = dict(items.dtypes)["doc_id"]

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["n_tokens", "doc_id", "piece_no", "start"], ascending=[False, True, True, True])
        window = pack(part["n_tokens"].to_numpy(np.int64), capacity)
        return part.assign(container_id=part["group"].to_numpy(np.int64) * (1 << 32) + window)[
            ["container_id", "doc_id", "piece_no", "start", "end", "n_tokens"]
        ]

    grouped = items.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(groups)))
    width = shuffle_width(items.sparkSession, n_rows, 10 * items_per_group)
    return (
        grouped.repartition(width, "group")
        .groupBy("group")
        .applyInPandas(fill, f"container_id long, doc_id {kind}, piece_no int, start long, end long, n_tokens long")
    )


def container_use(packed: DataFrame, capacity: int) -> DataFrame:
    """Items, tokens and unused tokens of every container."""
    return packed.groupBy("container_id").agg(
        F.count("*").alias("n_items"), F.sum("n_tokens").alias("n_tokens"), (F.lit(capacity) - F.sum("n_tokens")).alias("unused")
    )


def container_texts(packed: DataFrame, rows: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``container_id, n_tokens, doc_ids, texts``: the content of every container, items in order of id."""
    texts = rows.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("whole"))
    item = F.struct("doc_id", "piece_no", F.expr("substring(whole, int(start) + 1, int(end - start))").alias("text"), "n_tokens")
    held = packed.join(texts, "doc_id").groupBy("container_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return held.select(
        "container_id",
        F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x["n_tokens"]).alias("n_tokens"),
        F.col("items.doc_id").alias("doc_ids"),
        F.col("items.text").alias("texts"),
    )
