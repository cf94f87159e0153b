import random

import numpy as np
import pytest

from lexmill.llm.chunking import LINE, PARAGRAPH, SENTENCE, WORD, boundaries, greedy_cuts, piece_counts, rebuilt, split_pieces
from lexmill.llm.textbatch import code_points


def one_by_one(text, max_size, overlap):
    """The same cuts, found one after the other."""
    points, starts = code_points([text])
    place, kind = boundaries(points, starts)
    kinds = {int(p): int(k) for p, k in zip(place, kind) if p < len(text)}
    cuts, e = [], 0
    while True:
        begin = e - overlap if e else 0
        limit = begin + max_size
        if limit >= len(text):
            return [*cuts, len(text)]
        best = None
        for level in (PARAGRAPH, LINE, SENTENCE):
            near = [p for p, k in kinds.items() if k >= level and max(e, overlap) < p <= limit]
            if near and max(near) > begin + max_size // 2:
                best = max(near)
                break
        if best is None:
            near = [p for p in kinds if max(e, overlap) < p <= limit]
            best = max(near) if near else limit
        cuts.append(best)
        e = best


@pytest.mark.parametrize("max_size,overlap", [(20, 5), (50, 0), (33, 32), (7, 3)])
def test_same_cuts_as_one_by_one(max_size, overlap):
    rng = random.Random(max_size)
    texts = ["", "x" * 300, " " * 90, "a b " * 40 + "y" * 200 + " c." * 30]
    for _ in range(60):
        words = ["".join(rng.choices("abçدم", k=rng.choice([1, 3, 5, 9, 40]))) for _ in range(rng.randrange(1, 60))]
        texts.append("".join(w + rng.choice([" ", " ", ". ", "\n", "\n\n", " ", "  "]) for w in words))
    points, starts = code_points(texts)
    owner, end, longest = greedy_cuts(points, starts, max_size, overlap)
    for i, text in enumerate(texts):
        assert end[owner == i].tolist() == (one_by_one(text, max_size, overlap) if text else end[owner == i].tolist())
        assert longest[i] == max(map(len, text.split()), default=0)


def test_pieces_cover_and_overlap(spark):
    rows = [(1, None, "q"), (2, "", "q"), (3, "fits", "q"), (4, "w " * 5000, "q"), (4, "w " * 5000, "q"), (5, "z" * 1001, "q")]
    df = spark.createDataFrame(rows, "id long, text string, piece string")
    out = split_pieces(df, "id", "text", 100, 10).collect()
    by = {}
    for r in out:
        by.setdefault(r.row_id, []).append(r)
    assert 1 not in by and [r.piece for r in by[2]] == [""] and [r.piece for r in by[3]] == ["fits"]
    for k, text in ((5, "z" * 1001),):
        pieces = sorted(by[k], key=lambda r: r.piece_no)
        joined = pieces[0].piece
        for a, b in zip(pieces, pieces[1:]):
            assert b.start == a.end - 10 and a.piece[-10:] == b.piece[:10]
            joined += b.piece[10:]
        assert joined == text and all(len(r.piece) <= 100 for r in pieces)
    counts = {r.row_id: r for r in piece_counts(df, "id", "text", 100, 10).collect()}
    assert set(counts) == {4, 5} and counts[5].longest_run == 1001 and counts[4].longest_run == 1


def test_empty_table_and_bad_overlap(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert split_pieces(df, "id", "text", 100, 10).count() == 0
    with pytest.raises(ValueError):
        split_pieces(df, "id", "text", 10, 10)


def test_boundary_kinds():
    points, starts = code_points(["a b. c\nd\n\n e"])
    place, kind = boundaries(points, starts)
    assert place.tolist() == [2, 5, 7, 11] and kind.tolist() == [WORD, SENTENCE, LINE, PARAGRAPH]
    assert isinstance(place, np.ndarray)


def test_pieces_rebuild_their_texts(spark):
    rows = [(1, "mot " * 500), (2, "x" * 700), (3, ""), (4, None), (5, "a. b\n\n" * 90), (6, "court")]
    df = spark.createDataFrame(rows, "id long, t string")
    good = {r.row_id: (r.text, r.within_size, r.overlaps) for r in rebuilt(split_pieces(df, "id", "t", 100, 15), 100, 15).collect()}
    assert good == {i: (t, True, True) for i, t in rows if t is not None}
    bad = spark.createDataFrame([(1, 1, 0, 5, "abcde"), (1, 2, 4, 9, "xfghi")], "row_id long, piece_no int, start long, end long, piece string")
    row = rebuilt(bad, 4, 2).first()
    assert not row.within_size and not row.overlaps
