import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm.chunking import greedy_cuts
from lexmill.llm.lookalikes import one_form
from lexmill.llm.packing import difference, pack
from lexmill.llm.textbatch import code_points
from lexmill.llm.vocabulary import Automaton, ReferenceTrie

LETTERS = "abz éà٣²— \n.-المدأ" + "аеоМи" + "αν" + "ｄﬁﻻ ​́ٔی"
ORDINARY = "abcXYZ 09.,;-'éèàçô\nالمدنيةأإؤئىء١٢²—°"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=LETTERS, max_size=40))
def test_one_form_is_stable(text):
    once = one_form(text)[0]
    assert one_form(once)[0] == once


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=ORDINARY, max_size=60))
def test_ordinary_text_stays(text):
    assert one_form(text)[0] == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab .\n", max_size=80), max_size=6), st.integers(2, 25), st.data())
def test_pieces_cover_texts(texts, most, data):
    overlap = data.draw(st.integers(0, most - 1))
    points, starts = code_points(texts)
    owner, end, _ = greedy_cuts(points, starts, most, overlap)
    for i, text in enumerate(texts):
        cuts = end[owner == i].tolist()
        begins = [0, *[c - overlap for c in cuts[:-1]]]
        if text:
            assert cuts[-1] == len(text) and all(b >= 0 and 0 < c - b <= most for b, c in zip(begins, cuts)) and cuts == sorted(set(cuts))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=40), st.integers(1, 6))
def test_windows(sizes, windows):
    sizes = np.array(sizes)
    placed = difference(sizes, windows)
    assert placed.min() >= 0 and placed.max() < windows
    loads = np.bincount(placed, sizes, windows)
    assert loads.max() - loads.min() <= sizes.max()
    assert np.bincount(pack(sizes, 100), sizes).max() <= 100


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abc", max_size=7), st.text(alphabet="abc", min_size=1, max_size=7), st.integers(0, 3))
def test_search_is_symmetric(a, b, most):
    there = ReferenceTrie([(0, b)], letters=str).search(a, most)
    back = ReferenceTrie([(0, a)], letters=str).search(b, most) if a else {0: len(b)} if len(b) <= most else {}
    assert there == back and Automaton(most).most == most
