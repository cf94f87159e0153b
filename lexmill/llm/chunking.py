"""Splitting oversized texts at natural boundaries (problem 5).

Every text longer than ``max_size`` characters is cut into pieces of at most
``max_size``; a piece starts exactly ``overlap`` characters before the end of
the one before it. A cut lies after white space where there is any, by
preference after a blank line, then a line, then a sentence, then a word: of
the cuts that a piece can reach, the farthest of the strongest kind in the
second half of the piece is taken, else the farthest of any kind. A first piece
is longer than the overlap, so that every piece brings new text.

Method: pointer doubling. All boundaries of all texts of a batch are nodes of
one array. Each is joined to its farthest legal successor (one binary search
over the array gives all of them). Squaring the successor table again and
again, while the set of reached nodes doubles, derives the greedy cuts of all
texts at once in log2(pieces) rounds, however long a single text is.

Where a run without white space is longer than a piece can reach, the forced
cuts are nodes too: from the last boundary before the run every
``max_size - overlap`` characters.

Scale: no shuffle at all; texts that fit are passed on in the JVM, and only the
others reach Python, in blocks of bounded volume.

Nulls, ties and edges: a null text has no piece, an empty or fitting one has
one piece. Repeated rows are cut alike. Kinds tie by position, never by chance.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.textbatch import by_volume, code_points, is_space

#: Ends of sentences in the two languages (fixed values).
STOPS = np.array([ord(c) for c in ".!?;؟؛"], dtype=np.uint32)
FORCED, WORD, SENTENCE, LINE, PARAGRAPH = 1, 2, 3, 4, 5


def boundaries(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions after which white space ends or a line breaks, and their kinds."""
    if not len(points):
        return np.empty(0, np.int64), np.empty(0, np.int8)
    space = is_space(points)
    newline = points == 10
    following = np.empty_like(space)
    following[:-1] = space[1:]
    following[-1] = False
    cut = np.flatnonzero(space & ~following)  # last white space of each run
    run_start = np.maximum.accumulate(np.where(~space, np.arange(len(points)), -1))[cut] + 1
    lines = np.concatenate([[0], np.cumsum(newline)])
    breaks = lines[cut + 1] - lines[run_start]
    before = points[np.maximum(run_start - 1, 0)]
    kind = np.where(breaks >= 2, PARAGRAPH, np.where(breaks == 1, LINE, np.where(np.isin(before, STOPS), SENTENCE, WORD)))
    return cut + 1, kind.astype(np.int8)


def greedy_cuts(points: np.ndarray, starts: np.ndarray, max_size: int, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, end of each piece (in its text) and longest run without white space of each text."""
    n_texts = len(starts) - 1
    place, kind = boundaries(points, starts)
    text = np.searchsorted(starts, place, side="left") - 1
    # a first piece no longer than the overlap would lie wholly within the second
    inner = (place < starts[text + 1]) & (place > starts[text] + overlap)
    place, kind, text = place[inner], kind[inner], text[inner]
    longest = np.zeros(n_texts, np.int64)
    filled = np.flatnonzero(starts[1:] > starts[:-1])
    if len(filled):
        at = np.arange(len(points))
        broken = np.where(is_space(points), at, -1)
        heads = starts[filled]
        broken[heads] = np.maximum(broken[heads], heads - 1)  # a text's start bounds runs, too
        longest[filled] = np.maximum.reduceat(at - np.maximum.accumulate(broken), heads)
    # nodes: starts, boundaries, forced cuts, ends
    node = np.concatenate([starts[:-1], place, starts[1:]])
    owner = np.concatenate([np.arange(n_texts), text, np.arange(n_texts)])
    strength = np.concatenate([np.zeros(n_texts, np.int8), kind, np.full(n_texts, 9, np.int8)])
    order = np.lexsort((strength, node, owner))
    node, owner, strength = node[order], owner[order], strength[order]
    step = max_size - overlap
    same = owner[:-1] == owner[1:]
    room = np.where(strength[:-1] == 0, max_size, step)  # the first piece has no overlap
    wide = np.flatnonzero(same & (np.diff(node) > room))
    if len(wide):
        forced, forced_owner = [], []
        for i in wide:
            more = np.arange(node[i] + room[i], node[i + 1], step)
            forced.append(more)
            forced_owner.append(np.full(len(more), owner[i]))
        node = np.concatenate([node, *forced])
        owner = np.concatenate([owner, *forced_owner])
        strength = np.concatenate([strength, np.full(len(node) - len(strength), FORCED, np.int8)])
        order = np.lexsort((strength, node, owner))
        node, owner, strength = node[order], owner[order], strength[order]
    index = np.arange(len(node))
    last = np.searchsorted(owner, np.arange(n_texts), side="right") - 1
    begin = np.where(strength == 0, node, node - overlap)
    limit = begin + max_size
    # node numbers grow with position over all texts, so one search serves every node
    reach = np.minimum(np.searchsorted(node, limit, side="right") - 1, last[owner])
    succ = np.maximum(reach, index)
    done = node[last[owner]] <= limit
    middle = begin + max_size // 2
    chosen = np.zeros(len(node), bool)
    for level in (PARAGRAPH, LINE, SENTENCE, WORD):
        latest = np.maximum.accumulate(np.where((strength >= level) & (strength < 9), index, -1))[np.maximum(reach, 0)]
        good = ~chosen & ~done & (latest > index) & ((node[latest] > middle) | (level == WORD))
        succ = np.where(good, latest, succ)
        chosen |= good
    succ = np.where(done, last[owner], succ)
    succ[last] = last
    reached = np.zeros(len(node), bool)
    reached[np.searchsorted(owner, np.arange(n_texts), side="left")] = True
    while True:
        more = reached.copy()
        more[succ[np.flatnonzero(reached)]] = True
        if (more == reached).all():
            break
        reached, succ = more, succ[succ]
    at = np.flatnonzero(reached & (strength > 0))
    return owner[at], node[at] - starts[owner[at]], longest


def _pieces(max_size: int, overlap: int, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, "text"):
            ids = batch.column(0)
            texts = batch.column(1).to_pylist()
            points, starts = code_points(texts)
            owner, end, longest = greedy_cuts(points, starts, max_size, overlap)
            first = np.concatenate([[True], owner[1:] != owner[:-1]])
            number = np.arange(len(owner)) - np.maximum.accumulate(np.where(first, np.arange(len(owner)), 0))
            begin = np.where(first, 0, np.concatenate([[0], end[:-1]]) - overlap)
            if with_text:
                columns = [
                    ids.take(pa.array(owner)),
                    pa.array((number + 1).astype(np.int32)),
                    pa.array(begin),
                    pa.array(end),
                    pa.array([texts[o][b:e] for o, b, e in zip(owner.tolist(), begin.tolist(), end.tolist())], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["row_id", "piece_no", "start", "end", "piece"])
            else:
                count = np.bincount(owner, minlength=len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.array(count), pa.array(longest)], ["row_id", "n_pieces", "longest_run"])

    return cut


def _oversized(rows: DataFrame, row_id: str, text: str, max_size: int, overlap: int) -> DataFrame:
    if not 0 <= overlap < max_size:
        raise ValueError("overlap must be at least 0 and below max_size")
    return rows.select(F.col(row_id).cast("long").alias("row_id"), F.col(text).alias("text")).filter(F.length("text") > max_size)


def split_pieces(rows: DataFrame, row_id: str, text: str, max_size: int, overlap: int) -> DataFrame:
    """``row_id, piece_no, start, end, piece`` of every text that is not null."""
    long = _oversized(rows, row_id, text, max_size, overlap)
    short = rows.filter(F.length(text) <= max_size).select(
        F.col(row_id).cast("long").alias("row_id"),
        F.lit(1).alias("piece_no"),
        F.lit(0).cast("long").alias("start"),
        F.length(text).cast("long").alias("end"),
        F.col(text).alias("piece"),
    )
    cut = long.mapInArrow(
        _pieces(max_size, overlap, True), "row_id long, piece_no int, start long, end long, piece string"
    )
    return short.unionByName(cut)


def piece_counts(rows: DataFrame, row_id: str, text: str, max_size: int, overlap: int) -> DataFrame:
    """``row_id, n_pieces, longest_run`` of every text that must be cut."""
    return _oversized(rows, row_id, text, max_size, overlap).mapInArrow(
        _pieces(max_size, overlap, False), "row_id long, n_pieces long, longest_run long"
    )


def rebuilt(pieces: DataFrame, most: int, overlap: int) -> DataFrame:
    """``row_id, text, within_size, overlaps``: texts put together from their pieces, and whether sizes and overlaps are kept."""
    piece = F.struct("piece_no", "start", "end", "piece")
    whole = pieces.groupBy("row_id").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    new = F.transform("pieces", lambda p: F.substring(p["piece"], F.when(p["piece_no"] == 1, 1).otherwise(overlap + 1), F.length(p["piece"])))
    neighbours = F.arrays_zip(F.slice("pieces", 1, F.size("pieces") - 1).alias("a"), F.slice("pieces", 2, F.size("pieces")).alias("b"))
    shared = F.forall(
        neighbours, lambda n: (n["b"]["start"] == n["a"]["end"] - overlap) & (F.right(n["a"]["piece"], F.lit(overlap)) == F.left(n["b"]["piece"], F.lit(overlap)))
    )
    within = F.forall("pieces", lambda p: F.length(p["piece"]) <= most)
    return whole.select("row_id", F.array_join(new, "").alias("text"), within.alias("within_size"), shared.alias("overlaps"))
