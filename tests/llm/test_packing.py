import random

import numpy as np
import pytest

from lexmill.llm import packing
from lexmill.llm.packing import container_texts, container_use, containers, difference, pack, sized_items, token_pieces
from lexmill.llm.tokenizers import TOKENIZER, encoding


def one_by_one(sizes, windows):
    """Differencing with plain lists instead of arrays and trees."""
    import heapq

    heap = []
    for i, s in enumerate(sizes):
        parts = [(0, [])] * (windows - 1) + [(s, [i])]
        heap.append((-s, i, parts))
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        merged = [(x[0] + y[0], x[1] + y[1]) for x, y in zip(a, b[::-1])]
        merged = sorted(merged, key=lambda p: p[0])
        merged = [(s - merged[0][0], items) for s, items in merged]
        heapq.heappush(heap, (-merged[-1][0], n, merged))
        n += 1
    return sorted(sorted(items) for _, items in heap[0][2])


@pytest.mark.parametrize("windows", [2, 3, 7])
def test_same_windows_as_one_by_one(windows):
    rng = random.Random(windows)
    sizes = [rng.randrange(1, 1000) for _ in range(40)]
    placed = difference(np.array(sizes), windows)
    assert sorted(np.flatnonzero(placed == w).tolist() for w in range(windows)) == one_by_one(sizes, windows)


def test_no_window_exceeds_the_capacity():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 600, 900)
    placed = pack(sizes, 1000)
    sums = np.bincount(placed, sizes)
    assert sums.max() <= 1000 and len(sums) <= np.ceil(sizes.sum() / 1000) * 1.12 and (sums > 0).all()
    assert sorted(pack(np.array([1000, 1000, 3]), 1000).tolist()) == [0, 1, 2] and len(pack(np.empty(0, int), 5)) == 0


def test_pieces_round_trip():
    text = "Le comité fixe les modalités. الغرفة المدنية " * 80 + "x" * 500 + "𝔘" * 300
    pieces = token_pieces(text, 50, TOKENIZER)
    assert "".join(text[a:b] for a, b, _ in pieces) == text
    assert all(0 < n <= 50 and len(encoding(TOKENIZER).encode_ordinary(text[a:b])) == n for a, b, n in pieces)


def test_containers(spark):
    rows = [(i, "mot " * (i % 70 + 1), "e") for i in range(500)] + [(900, None, "e"), (901, "", "e"), (902, "long texte " * 300, "e"), (3, "mot " * 4, "e")]
    df = spark.createDataFrame(rows, "id long, text string, n_tokens string")
    items = sized_items(df, "id", "text", 100)
    packed = containers(items, 100, 500, items_per_group=150)
    use = container_use(packed, 100).collect()
    assert all(0 < r.n_tokens <= 100 and r.unused == 100 - r.n_tokens for r in use)
    assert packed.count() == items.count() and packed.filter("doc_id = 3").count() == 2
    content = container_texts(packed, df.dropDuplicates(["id"]), "id", "text").collect()
    assert sum(len(r.texts) for r in content) == items.count()
    pieces = sorted((p.start, t) for r in content for d, t in zip(r.doc_ids, r.texts) if d == 902 for p in items.filter("doc_id = 902").collect() if ("long texte " * 300)[p.start : p.end] == t)
    assert pieces and all(len(encoding(TOKENIZER).encode_ordinary(t)) <= 100 for _, t in pieces)
    assert containers(items.limit(0), 100, 0).count() == 0


def test_a_long_text_is_tokenized_in_proportion_to_its_length(monkeypatch):
    own, seen = encoding(TOKENIZER), []

    class Counting:
        def encode_ordinary(self, text):
            seen.append(len(text))
            return own.encode_ordinary(text)

        def decode_tokens_bytes(self, tokens):
            return own.decode_tokens_bytes(tokens)

    monkeypatch.setattr(packing, "encoding", lambda path: Counting())
    for text in ("le registre des déclarations " * 20_000, "x" * 60_000, " " * 50_000 + "fin", "المادة الأولى " * 9_000):
        seen.clear()
        pieces = token_pieces(text, 64, TOKENIZER)
        assert pieces[0][0] == 0 and pieces[-1][1] == len(text) and all(a[1] == b[0] for a, b in zip(pieces, pieces[1:]))
        assert all(0 < n <= 64 and n == len(own.encode_ordinary(text[a:b])) for a, b, n in pieces)
        assert sum(seen) < 60 * len(text)


def test_short_texts_are_one_piece():
    assert token_pieces("abc", 64, TOKENIZER) == [(0, 3, len(encoding(TOKENIZER).encode_ordinary("abc")))] and token_pieces("", 64, TOKENIZER) == []
