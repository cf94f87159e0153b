"""Free-entered values mapped to a reference list (problem 1).

Every spelling of the reference entries, aliases included, is a path of one
trie, in number proportional to an entry's words: what may or may not stand before each word, as the Arabic article, is taken off
values and entries alike. A value is searched with a Levenshtein automaton that walks the trie: the
automaton's state is the set of (offset, errors) positions still possible, its
transitions depend only on where the next letter occurs in the coming letters
of the value, so they are computed once and kept. All entries within a
distance that depends on the value's length are returned, nearest first.
Swapped neighbours count as one error.

Before the search values and paths are folded alike: compatibility forms,
marks, case, stretching, spaces and punctuation do not count, nor do Arabic
letters that are typed for each other. Text that was typed back to front is
searched in both directions, a value in two languages also by its halves.

Scale: the list is the only thing that every task holds; it is refused beyond
``MOST_ENTRIES``. Values are mapped where they are, without a shuffle; a task
searches each distinct value once, so a value that a third of all rows have
costs one search a task.

Nulls: a null value gives no candidates, as does one that holds no letter.
Ties: by distance, then by entry id, so a tie has one result. Extra columns of
any name are kept by ``join``-free projection.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_ENTRIES = 100_000
#: Distinct values whose result a task keeps.
MEMO = 200_000

#: Arabic letters typed for one another (fixed values).
ARABIC_FOLD = str.maketrans({"ة": "ه", "ى": "ي", "ی": "ي", "ک": "ك", "ـ": None, "ھ": "ه", "ہ": "ه"})
ARABIC = re.compile(r"[ء-ي]")


def light_fold(value: str) -> str:
    """Compatibility forms, marks, case and invisible characters away; spaces single."""
    text = unicodedata.normalize("NFKC", value)
    text = "".join(
        c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) not in ("Mn", "Cf")
    )
    return re.sub(r"[\s_]+", " ", text.translate(ARABIC_FOLD).casefold()).strip()


def fold(value: str) -> str:
    """Letters only, folded."""
    return "".join(c for c in light_fold(value) if c.isalpha())


def without_articles(text: str) -> str:
    """Folded text whose words have lost the Arabic article, also behind "and"."""
    return " ".join("و" + w[3:] if w.startswith("وال") else w[2:] if w.startswith("ال") else w for w in text.split(" "))


def allowed_errors(length: int) -> int:
    """Errors allowed in a folded value of this many letters."""
    return 0 if length <= 3 else 1 if length <= 5 else 2 if length <= 20 else 3


class Automaton:
    """Transitions of the Levenshtein automaton for up to ``most`` errors."""

    def __init__(self, most: int):
        self.most = most
        self.window = 2 * most + 2
        self.start = ((0, 0, False),)
        self._kept: dict = {}

    def step(self, state: tuple, seen: int, n: int) -> tuple[tuple, int] | None:
        """Next state and how far its offsets moved on; None when no position is left.

        ``seen``: bits of the ``n`` coming letters of the value that are the letter read.
        """
        key = (state, seen, n)
        if key not in self._kept:
            self._kept[key] = self._step(state, [bool(seen >> i & 1) for i in range(n)])
        return self._kept[key]

    def _step(self, state: tuple, seen: list[bool]) -> tuple[tuple, int] | None:
        k, n = self.most, len(seen)
        out: dict[tuple[int, bool], int] = {}

        def put(i: int, e: int, swapping: bool = False) -> None:
            if e <= k and i <= n and e < out.get((i, swapping), k + 1):
                out[i, swapping] = e

        for i, e, swapping in state:
            if swapping:
                if i < n and seen[i]:
                    put(i + 2, e)
                continue
            if i < n and seen[i]:
                put(i + 1, e)
                continue  # a match is never worse than an error here
            put(i + 1, e + 1)
            put(i, e + 1)
            for j in range(1, k - e + 1):
                if i + j < n and seen[i + j]:
                    put(i + j + 1, e + j)
            if i + 1 < n and seen[i + 1]:
                put(i, e + 1, True)
        left = [
            (i, e, s)
            for (i, s), e in out.items()
            if s or not any(f < e and abs(i - j) <= e - f and not t for (j, t), f in out.items())
        ]
        if not left:
            return None
        base = min(i for i, _, _ in left)
        return tuple(sorted((i - base, e, s) for i, e, s in left)), base

    def accepts(self, state: tuple, rest: int) -> int | None:
        """Distance if ``rest`` letters of the value are left, or None."""
        found = [e + rest - i for i, e, s in state if not s and rest >= i and e + rest - i <= self.most]
        return min(found, default=None)


class ReferenceTrie:
    """Spellings of entries; ``entries``: (id, spelling) pairs with aliases among them."""

    def __init__(self, entries: Iterable[tuple[int, str]], letters: Callable[[str], str] = fold):
        self.root: dict = {}
        for entry, spelling in entries:
            node = self.root
            for c in letters(spelling):
                node = node.setdefault(c, {})
            if node is not self.root:
                node.setdefault("", set()).add(entry)
        self._automata: dict[int, Automaton] = {}

    def search(self, folded: str, most: int) -> dict[int, int]:
        """Distance of every entry within ``most`` errors."""
        automaton = self._automata.setdefault(most, Automaton(most))
        found: dict[int, int] = {}
        stack = [(self.root, automaton.start, 0)]
        length, window, step = len(folded), automaton.window, automaton.step
        places: dict[str, int] = {}  # bits of the places where a letter stands
        for i, c in enumerate(folded):
            places[c] = places.get(c, 0) | 1 << i
        while stack:
            node, state, base = stack.pop()
            n = max(0, min(window, length - base))
            coming = (1 << n) - 1
            for letter, child in node.items():
                if letter == "":
                    distance = automaton.accepts(state, length - base)
                    if distance is not None:
                        for entry in child:
                            found[entry] = min(distance, found.get(entry, distance))
                    continue
                moved = step(state, places.get(letter, 0) >> base & coming, n)
                if moved is not None:
                    stack.append((child, moved[0], base + moved[1]))
        return found


class Matcher:
    """All readings of a value searched in the trie; results are kept."""

    def __init__(self, entries: Iterable[tuple[int, str]], noise: Iterable[str] = (), errors: Callable[[int], int] = allowed_errors):
        self.trie = ReferenceTrie(entries)
        self.noise = [re.compile(x) for x in noise]
        self.errors = errors
        self._kept: dict[str, list[tuple[int, int]]] = {}

    def readings(self, value: str) -> list[str]:
        """Folded forms to search: whole, without noise, halves, back to front."""
        text = light_fold(value)
        for pattern in self.noise:
            text = pattern.sub(" ", text).strip()
        parts = [text, *(re.split(r"\s[/|]\s", text) if re.search(r"\s[/|]\s", text) else [])]
        out = []
        for part in parts:
            for pattern in self.noise:
                part = pattern.sub(" ", part).strip()
            letters = "".join(c for c in part if c.isalpha())
            out.append(letters)
            if ARABIC.search(letters):
                out.append("".join(c for c in without_articles(part) if c.isalpha()))
                out.append(letters[::-1])
        return [x for x in dict.fromkeys(out) if x]

    def candidates(self, value: str) -> list[tuple[int, int]]:
        """(entry, distance) of all entries near enough, nearest first."""
        if value not in self._kept:
            best: dict[int, int] = {}
            for letters in self.readings(value):
                for entry, distance in self.trie.search(letters, self.errors(len(letters))).items():
                    best[entry] = min(distance, best.get(entry, distance))
            if len(self._kept) >= MEMO:
                self._kept.clear()
            self._kept[value] = sorted(best.items(), key=lambda x: (x[1], x[0]))
        return self._kept[value]


def map_values(value: Column, entries: list[tuple[int, str]], noise: Iterable[str] = ()) -> Column:
    """``array<struct<entry_id int, distance int>>`` of the entries near ``value``, nearest first."""
    if len(entries) > MOST_ENTRIES:
        raise ValueError(f"the reference list has {len(entries)} spellings; at most {MOST_ENTRIES} are held in memory")
    noise = list(noise)
    held: list[Matcher] = []  # made once a task

    @F.pandas_udf("array<struct<entry_id:int,distance:int>>")
    def search(values: pd.Series) -> pd.Series:
        if not held:
            held.append(Matcher(entries, noise))
        found = [None if v is None else [{"entry_id": e, "distance": d} for e, d in held[0].candidates(v)] for v in values]
        return pd.Series(found, dtype=object)

    return search(value)


# --- the court chambers ---------------------------------------------------------------------

#: Words of chamber names that are left out, shortened or inflected when typed (fixed values).
HEADS_FR = ("chambre", "chambres", "commission", "conseil")
SHORT_FR = ("ch", "chbre", "chre", "chb")
HEADS_AR = ("غرفة", "غرف", "لجنة", "مجلس")
SHORT_AR = ("غ",)
#: What is typed around a chamber's name, in folded text (fixed values).
CHAMBER_NOISE = (
    r"^\W*\d+\s*[.)]\s*",
    r"^\W*قرار\s+",
    r"[\s\W]*\(?\b(?:القسم|قسم)\s+\S+\s*$",
    r"[\s\W]*\bق\s*\d+\s*$",
    r"[\s\W]*\(?\bsect(?:ion)?\.?\s*\d+\s*\)?\s*$",
    r"[\s\W]*\(?\b\d+\s*(?:ere|eme|re|e)\s+section\s*\)?\s*$",
)


def chamber_spellings(chamber_id: int, label_ar: str, label_fr: str) -> list[tuple[int, str]]:
    """The labels and the ways they are shortened: articles, head words and their abbreviations."""
    out = {label_fr}
    head, _, rest = label_fr.partition(" ")
    if fold(head) in HEADS_FR:
        out |= {rest, *(f"{short} {rest}" for short in SHORT_FR)}
    # a value is searched with its articles and without them, so that any choice of articles is found where the rest is right;
    # amid errors the label's own articles count, the head's and one more left out or not
    words = light_fold(label_ar).split()
    bare = without_articles(light_fold(label_ar)).split()
    full = [w if w != b else "ال" + w for w, b in zip(words, bare)]
    forms = [words, bare]
    for head in dict.fromkeys((*words[:1], *bare[:1], *full[:1])):
        rest = list(zip(words, bare))[1:]
        forms.append([head, *words[1:]])
        forms += [[head, *(b if i == k else w for k, (w, b) in enumerate(rest))] for i, (w, b) in enumerate(rest) if w != b]
    for form in forms:
        out.add(" ".join(form))
        if len(form) > 1 and bare[0] in map(fold, HEADS_AR):
            out |= {" ".join(form[1:]), *(" ".join([short, *form[1:]]) for short in SHORT_AR)}
    return [(chamber_id, x) for x in sorted(out) if x]


def chamber_rows(reference: DataFrame) -> list:
    """Every row of the reference list, whose size is checked first."""
    rows = reference.select("chamber_id", "label_ar", "label_fr").limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError("the reference list is too long to be held in memory")
    return rows


def chamber_labels(reference: DataFrame) -> list[str]:
    """All labels of the reference list, whose size is checked first."""
    return [x for r in chamber_rows(reference) for x in (r.label_ar, r.label_fr) if x]


def chamber_entries(reference: DataFrame) -> list[tuple[int, str]]:
    """Spellings of every row of the reference list."""
    return [x for r in chamber_rows(reference) for x in chamber_spellings(r.chamber_id, r.label_ar or "", r.label_fr or "")]


def map_chambers(rows: DataFrame, value: str, reference: DataFrame, into: str = "chambers") -> DataFrame:
    """``rows`` with the chambers near ``value`` in the new column ``into``."""
    if into in rows.columns:
        raise ValueError(f"the column {into} is there already")
    return rows.withColumn(into, map_values(F.col(value), chamber_entries(reference), CHAMBER_NOISE))
