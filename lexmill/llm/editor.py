"""A character editor: an averaged perceptron that predicts keep, replace, delete and insert for the letters of a word.

A hypothesis is a sequence of operations, one for each letter, that differs from
keeping all at one place of one or two letters. Those that lead to a word of the
lexicon are tried, and those that put right a confusion seen in training, wherever
they lead. Each operation has its letter, its neighbours and its kind as features;
what the operations lead to adds whether it is a word and how the triples of
letters there compare with those of other words.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterable

from lexmill.llm.perceptron import AveragedPerceptron

#: Times that a confusion must be seen in training to be tried where no known word results.
LEAST_CONFUSED = 2

#: Letters that scans show as one character (fixed values).
LIGATURES = {"\ufb00": "ff", "\ufb01": "fi", "\ufb02": "fl"}
Near = list[tuple[str, int]]


def share_size(n: float, total: float) -> int:
    """Size of a count as digits of its number in a million."""
    return 0 if n <= 0 else 1 + max(0, int(math.log10(max(1.0, n / max(total, 1.0) * 1e6))))


def place(word: str, other: str) -> tuple[int, str, str]:
    """Where two words differ, what stands there in the one and in the other."""
    most = min(len(word), len(other))
    a = next((i for i in range(most) if word[i] != other[i]), most)
    b = next((i for i in range(most - a) if word[-1 - i] != other[-1 - i]), most - a)
    return a, word[a : len(word) - b], other[a : len(other) - b]


def operations(old: str, new: str) -> list[str]:
    """Operations on the letters ``old`` that give ``new``."""
    out = [f"R{o}{n}" for o, n in zip(old, new)]
    out += [f"D{o}" for o in old[len(new) :]]
    return out + [f"I{n}" for n in new[len(old) :]]


def triples(word: str) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + 3] for i in range(len(marked) - 2)]


def whole_form(word: str) -> str:
    """A word with ligatures that were read as one character spelled out."""
    return unicodedata.normalize("NFKC", word)


class CharacterEditor:
    """``grams``: in how many lexicon words a triple of letters is; ``confused``: letters read, and what they may be."""

    def __init__(self, grams: dict[str, int], confused: dict[str, list[str]], model: AveragedPerceptron | None = None):
        self.grams, self.confused, self.model = grams, confused, model or AveragedPerceptron()

    def _odd(self, word: str, at: int, length: int, absent: list[str]) -> int:
        """How common the rarest triple around ``length`` letters is, words left out that are taken as absent."""
        marked = f"^{word}$"
        least = min(
            (self.grams.get(t, 0) - absent.count(t) for i in range(max(0, at - 1), min(at + length + 1, len(marked) - 2)) for t in (marked[i : i + 3],)),
            default=0,
        )
        return 0 if least <= 0 else 1 if least < 3 else 2 if least < 12 else 3

    def hypotheses(self, word: str, near: Near) -> list[tuple[str, int]]:
        """Words that the operations tried lead to, with the size of their count (0: no known word)."""
        found = dict(near)
        for at in range(len(word) + 1):
            for length in (0, 1, 2):
                old = word[at : at + length]
                if len(old) == length:
                    for new in self.confused.get(old, ()):
                        found.setdefault(word[:at] + new + word[at + length :], 0)
        found.pop(word, None)
        return [(w, n) for w, n in found.items() if len(w) >= 2]

    def features(self, word: str, found: list[tuple[str, int]], absent: str | None = None) -> list[list[str]]:
        """Features of keeping all letters, then of each hypothesis."""
        gone = triples(absent) if absent else []
        signs = sorted({c for c in word if not c.isalpha() and c not in "'’-"})
        length = min(len(word), 10)
        out = [["keep", f"keep odd={bool(signs)}", f"keep len={length}", f"keep triple={self._odd(word, 0, len(word), gone)}", *(f"keep {c}" for c in signs)]]
        for other, size in found:
            at, old, new = place(word, other)
            done = operations(old, new)
            kind = "form" if old and whole_form(old) == new else "".join(o[0] for o in done)
            known = size > 0
            left, right = word[at - 1 : at] if at else "^", word[at + len(old) : at + len(old) + 1] or "$"
            before, after = self._odd(word, at, len(old), gone), self._odd(other, at, len(new), gone)
            sign = any(not c.isalpha() for c in old)
            row = [
                kind,
                f"{kind} known={known}",
                f"{kind} size={size} len={length}",
                f"size={size}",
                f"sign={sign} known={known}",
                f"{kind} odd={bool(signs)} sign={sign}",
                f"{kind} first={at == 0} last={at + len(old) == len(word)}",
                f"triple={before}{after} known={known}",
                f"triple={before}{after} {kind}",
                f"{old}>{new}",
                f"{old}>{new} last={at + len(old) == len(word)}",
                f"{old}>{new} known={known}",
                f"{old}>{new} {before}{after}",
            ]
            for o in done:
                row += [o, f"{o} odd={bool(signs)}", f"{left}{o}", f"{o}{right}"]
            out.append(row)
        return out

    def edit(self, word: str, near: Near) -> str:
        """The word with the operations that score best; of equal ones all letters kept."""
        found = self.hypotheses(word, near)
        if not found:
            return word
        best = self.model.best(self.features(word, found))
        return found[best - 1][0] if best else word


def learn_confusions(pairs: Iterable[tuple[str, str]]) -> dict[str, list[str]]:
    seen = Counter((old, new) for word, right in pairs if word != right for _, old, new in (place(word, right),) if len(old) <= 2 and len(new) <= 2 and len(old) + len(new) < 4)
    out: dict[str, list[str]] = {}
    for (old, new), n in sorted(seen.items()):
        if n >= LEAST_CONFUSED:
            out.setdefault(old, []).append(new)
    return out


def train_characters(
    aligned: list[tuple[str, str]], lexicon: dict[str, Near], near: dict[str, Near], plain: list[str], grams: dict[str, int]
) -> CharacterEditor:
    """The editor from words aligned to right ones, lexicon words taken as unknown, and unknown words of one frequent reading (``plain``).

    ``near``: known words one place away of each word, ``lexicon``: the same of lexicon words.
    """
    editor = CharacterEditor(grams, {**learn_confusions(aligned), **{k: [v] for k, v in LIGATURES.items()}})
    examples: list[tuple[list[list[str]], int]] = []

    def add(word: str, right: str, others: Near, absent: str | None = None) -> None:
        found = editor.hypotheses(word, others)
        spelled = [word, *(w for w, _ in found)]
        if found and (right in spelled or absent):
            examples.append((editor.features(word, found, absent), spelled.index(right) if right in spelled else 0))

    for word, right in aligned:
        others = near.get(word, [])
        add(word, right, others)
        if word != right:  # as if its true form were no known word
            add(word, right, [x for x in others if x[0] != right], right)
    for word, others in sorted(lexicon.items()):
        add(word, word, others, word)
        for ligature, letters in LIGATURES.items():
            if letters in word:  # the same word, scanned with a ligature
                joined = word.replace(letters, ligature, 1)
                add(joined, word, [(word, 3)])
                add(joined, word, [], word)
    for word in plain:
        add(word, near[word][0][0], near[word])
    editor.model.train(examples)
    return editor
