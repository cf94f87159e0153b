"""Running headers and page numbers: an averaged perceptron judges each line by its form and its place on the page.

Place: how far the line is from the ends of the text and of its estimated page,
whether it stands between an open line and one that goes on, beside a page
number, between blank lines, whether its number is a page of the text and the
page that is due there. Form: its digits and signs without letters, its gap and
what follows, how many texts have the like, words of chamber names, letters.
The score alone decides.

Labels come from texts with a clean form. The lines are laid along its words:
a line found there is body, one that is not and interrupts a sentence is
furniture, and so are lines like those that do; lines whose like is often left
out and never interrupts a sentence are not.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

from lexmill.llm.perceptron import AveragedPerceptron
from lexmill.llm.scantext import MOST_LINE, _DIGITS, bare, break_of, find_words, head_part, skeleton

#: Marks that end a sentence or open a list (fixed values).
STOPS = ".:!?؟;؛"
#: Times that a form of line must be left out of clean texts, without interrupting one, to be learned as no furniture.
LEAST_LEFT = 3
#: Share of its numbers that must be pages of their texts for a form to be one of page numbers.
NUMBERING = 0.8
#: Groups of letters that a line is judged by.
MOST_LETTERS = 11
#: Results that a task keeps.
MEMO = 100_000
_SIGNS = re.compile(r"[\W_]+")
_LETTERS = re.compile(r"[^\W\d_]+\.?")


class Labels:
    """Names that running headers may carry, and their words."""

    def __init__(self, names: Iterable[str]):
        self.names = list(names)
        self.whole = {" ".join(bare(w) for w in find_words(name)) for name in self.names}
        self.words = {w for name in self.whole for w in name.split(" ")}
        self._of: dict[str, bool] = {}

    def among(self, words: list[str]) -> int:
        """How many of the words are words of names."""
        of, n = self._of, 0
        for word in words:
            if word not in of:
                if len(of) > MEMO:
                    of.clear()
                of[word] = bare(word) in self.words
            n += of[word]
        return n


class Layout:
    """A text's lines with what the features need of them."""

    def __init__(self, lines: list[str], pages: tuple[int | None, int | None], entry: bool, words: list[list[str]], labels: Labels, seen: dict[str, int]):
        self.lines, self.pages, self.entry, self.words, self.labels, self.seen = lines, pages, entry, words, labels, seen
        self.text = [x.strip() for x in lines]
        self.width = max(map(len, self.text), default=1) or 1
        self.forms = [skeleton(x) if len(x) <= MOST_LINE else "" for x in lines]
        self.body = [k for k, x in enumerate(self.text) if x]
        self.rank = {k: i for i, k in enumerate(self.body)}
        self.kinds = {k: self._kind(k) for k in self.body}
        first, last = pages
        self.count = 1 if first is None or last is None or last < first else last - first + 1
        #: Lines whose number is a page of the text.
        self.numbered = {k for k, (_, n) in self.kinds.items() if n is not None and self.place(n, k)[0] == "True"}

    def _kind(self, k: int) -> tuple[str, int | None]:
        """Form of what may be a page number on a line, and the number."""
        form = self.forms[k]
        if not form:
            return "long", None
        head, gap, tail = form.partition("  ")
        part = tail if gap else form
        if "9" not in part or not gap and len(form) > 8:
            if gap:
                return "gap", None
            return ("end 9" if form[-2:] == " 9" else "words" if any(map(str.isalpha, form)) else form[:4]), None
        number = _DIGITS.findall(self.text[k])
        if part.count("9") != 1 or len(number[-1]) > 4:
            return f"many {bool(gap)}", None
        return f"{bool(gap)} {part[:10]}", int(number[-1])

    def place(self, number: int | None, k: int) -> tuple[str, str]:
        """Whether a number is a page of the text, and how far it is from the page that is due at line ``k``."""
        first, last = self.pages
        if number is None or first is None:
            return "none" if number is None else "unknown", "none"
        inside = first <= number <= (last if last is not None else first)
        due = first + self.count * k // max(1, len(self.lines))
        return f"{inside}", str(min(2, abs(number - due))) if inside else "far"

    def like(self, k: int) -> tuple[str, str, str]:
        """What lines are alike in."""
        kind, number = self.kinds[k]
        inside = self.place(number, k)[0]
        if self.named(k)[1] == "whole":
            return "name", "", inside
        gap = "  " in self.forms[k]
        return head_part(self.forms[k]), "" if gap else kind, inside

    def named(self, k: int) -> tuple[list[str], str]:
        """Words of a line before its gap, and how much of them names of the list make up."""
        form = self.forms[k]
        if not form:
            return [], "long"
        words = self.words[k]
        if "  " in form:
            words = words[: len(find_words(head_part(form)))]
        if "9" in form:
            words = [w for w in words if not w.isdigit()]
        n = self.labels.among(words)
        if n == len(words):
            return words, "none" if not n else "whole" if " ".join(map(bare, words)) in self.labels.whole else "all"
        return words, "none" if not n else "half" if 2 * n >= len(words) else "few"

    def attributes(self, k: int) -> tuple:
        at = self.rank[k]
        kind, number = self.kinds[k]
        inside, due = self.place(number, k)
        text = self.text[k]
        before = self.body[at - 1] if at else None
        after = self.body[at + 1] if at + 1 < len(self.body) else None
        is_open = before is not None and self.text[before][-1] not in STOPS
        goes_on = "none" if after is None else "lower" if self.text[after][0].islower() else "upper" if self.text[after][0].isupper() else "other"
        words, own = self.named(k)
        beside = before in self.numbered or after in self.numbered
        pages = self.count * k / max(1, len(self.lines))
        end = text[-1]
        return (
            kind,
            inside,
            due,
            self.seen.get(head_part(self.forms[k]), 0),
            bool(words),
            "9" in self.forms[k] or not self.forms[k] and _DIGITS.search(text) is not None,
            own,
            min(5, len(text) * 5 // self.width),
            (k > 0 and not self.text[k - 1], k + 1 < len(self.text) and not self.text[k + 1]),
            is_open,
            goes_on,
            end if end in ".:,،-؛;" else "letter" if end.isalpha() else "digit" if end.isdigit() else "other",
            min(k, 2),
            min(len(self.lines) - 1 - k, 2),
            f"{min(at, 3)}" if self.entry else "page",
            beside,
            int(pages % 1 * 4) if self.count > 1 else "one",
        )

    def letters(self, k: int) -> list[str]:
        squeezed = _SIGNS.sub("", head_part(self.forms[k])[:40])[: MOST_LETTERS + 3].lower()
        return [squeezed[i : i + 4] for i in range(max(1, len(squeezed) - 3))]


def spelled_features(a: tuple) -> list[str]:
    kind, inside, due, seen, words, digits, own, width, blank, is_open, goes_on, end, top, bottom, entry, beside, phase = a
    return [
        "furniture",
        f"kind={kind}",
        f"kind={kind} inside={inside}",
        f"kind={kind} inside={inside} open={is_open}",
        f"shape={_LETTERS.sub('a', kind)} inside={inside}",
        f"inside={inside} words={words} gap={kind[:4]}",
        f"inside={inside} words={words} open={is_open}",
        f"inside={inside} width={width} words={words}",
        f"due={due} words={words}",
        f"due={due} width={width}",
        f"seen={seen} words={words} digits={digits}",
        f"seen={seen} end={end}",
        f"seen={seen} inside={inside}",
        f"own={own}",
        f"own={own} width={width}",
        f"own={own} end={end} digits={digits}",
        f"own={own} entry={entry} kind={kind[:5]}",
        f"own={own} open={is_open} end={end}",
        f"own={own} seen={seen}",
        f"width={width} open={is_open} end={end}",
        f"blank={blank}",
        f"blank={blank} width={width}",
        f"open={is_open} on={goes_on}",
        f"end={end} words={words}",
        f"top={top} kind={kind[:5]}",
        f"bottom={bottom} kind={kind[:5]}",
        f"entry={entry} end={end} words={words}",
        f"entry={entry} own={own} seen={seen}",
        f"beside={beside} own={own}",
        f"beside={beside} seen={seen} words={words}",
        f"phase={phase} words={words}",
    ]


class FurnitureModel:
    def __init__(self, model: AveragedPerceptron | None = None):
        self.model = model or AveragedPerceptron()
        self._kept: dict[tuple, float] = {}
        #: What the letters of a line can add at most.
        self._letters = MOST_LETTERS * max((w for f, w in self.model.weights.items() if "=" not in f), default=0.0)

    def lines(self, layout: Layout) -> list[bool]:
        """Which lines are furniture."""
        out = [False] * len(layout.lines)
        get = self.model.weights.get
        for k in layout.body:
            attributes = layout.attributes(k)
            score = self._kept.get(attributes)
            if score is None:
                if len(self._kept) > MEMO:
                    self._kept.clear()
                score = self._kept[attributes] = self.model.score(spelled_features(attributes))
            if score + self._letters > 0:  # else no letters make it furniture
                for f in layout.letters(k):
                    score += get(f, 0.0)
                out[k] = score > 0
        return out


def features(layout: Layout, k: int) -> list[str]:
    return spelled_features(layout.attributes(k)) + layout.letters(k)


# --- labels ---------------------------------------------------------------------------------


def alike(word: str, other: str) -> bool:
    """Whether two words differ in at most one place of two letters."""
    if word == other:
        return True
    if abs(len(word) - len(other)) > 2:
        return False
    most = min(len(word), len(other))
    a = 0
    while a < most and word[a] == other[a]:
        a += 1
    b = 0
    while b < most - a and word[-1 - b] == other[-1 - b]:
        b += 1
    return max(len(word), len(other)) - a - b <= 2 and a + b >= 1


class Alignment:
    """Lines of a scanned text laid along the words of its clean form: which lines are there, pairs of words, breaks."""

    def __init__(self, lines: list[str], clean: list[str]):
        self.aligned = [False] * len(lines)
        self.pairs: list[tuple[str, str]] = []
        self.breaks: list[tuple[str, str, str, bool]] = []
        at, pending = 0, None
        for k, line in enumerate(lines):
            words = [bare(w) for w in find_words(line)]
            if not words:
                continue
            broken = break_of(line)
            best: tuple[int, int, list] | None = None
            for start in (at, at + 1, at + 2, at - 1):
                if 0 <= start < len(clean):
                    found = self._walk(words, clean, start, pending, broken)
                    if best is None or found[0] > best[0]:
                        best = found
            if best is None or 2 * best[0] <= len(words):
                continue
            self.aligned[k] = True
            if pending is not None:
                head, mark, tail_joined = pending.head, pending.mark, bare(pending.head) + words[0]
                self.breaks.append((head, mark, words[0], at < len(clean) and alike(tail_joined, clean[at].replace("-", ""))))
            self.pairs += best[2]
            at, pending = best[1], broken

    def _walk(self, words: list[str], clean: list[str], start: int, pending, broken) -> tuple[int, int, list]:
        """Words of a line that agree with ``clean`` from ``start``, where the line ends there, and the pairs."""
        at, agree, pairs = start, 0, []
        for i, word in enumerate(words):
            if at >= len(clean):
                break
            if i == 0 and pending is not None and alike(bare(pending.head) + word, clean[at].replace("-", "")):
                agree += 1
                at += 1
            elif i == len(words) - 1 and broken is not None:
                piece = bare(broken.head)
                if clean[at].startswith(piece[:2]) and clean[at] != piece:
                    agree += 1
                elif alike(piece, clean[at]):
                    agree += 1
                    at += 1
            elif alike(word, clean[at]):
                pairs.append((word, clean[at]))
                agree += 1
                at += 1
            elif at + 1 < len(clean) and alike(word, clean[at + 1]):
                pairs.append((word, clean[at + 1]))
                agree += 1
                at += 2
            elif i + 1 < len(words) and alike(words[i + 1], clean[at]):
                pass  # a word too many
            else:
                at += 1
        return agree, at, pairs


def line_labels(laid: list[tuple[Layout, list[bool]]]) -> tuple[list[tuple[Layout, int, bool]], set[tuple]]:
    """Labelled lines of entries laid along their clean forms, and the forms of lines that interrupt a sentence."""
    interrupt: Counter = Counter()
    apart: Counter = Counter()
    left: list[tuple[Layout, int, bool]] = []
    out: list[tuple[Layout, int, bool]] = []
    for layout, aligned in laid:
        for k in layout.body:
            if aligned[k]:
                out.append((layout, k, False))
                continue
            before = next((j for j in reversed(layout.body[: layout.rank[k]]) if aligned[j]), None)
            after = next((j for j in layout.body[layout.rank[k] + 1 :] if aligned[j]), None)
            cuts = before is not None and after is not None and layout.text[before][-1] not in STOPS
            (interrupt if cuts else apart)[layout.like(k)] += 1
            left.append((layout, k, cuts))
    for layout, k, cuts in left:
        form = layout.like(k)
        if cuts:
            out.append((layout, k, True))
        elif layout.rank[k] == 0:
            out.append((layout, k, False))  # an entry begins with its head
        elif form in interrupt:
            out.append((layout, k, True))
        elif apart[form] >= LEAST_LEFT:
            out.append((layout, k, False))
    return out, set(interrupt)


def train_lines(laid: list[tuple[Layout, list[bool]]], pages: list[Layout]) -> FurnitureModel:
    """From entries with a clean form and, by forms of lines learned there, pages without one."""
    labelled, forms = line_labels(laid)

    def laid_lines() -> Iterator[tuple[list[list[str]], int]]:
        return (([[], features(layout, k)], int(label)) for layout, k, label in labelled)

    first = AveragedPerceptron().train(laid_lines())
    inside: dict[tuple, list[bool]] = {}
    for layout in pages:
        for k in layout.body:
            kind, number = layout.kinds[k]
            if number is not None:
                inside.setdefault((head_part(layout.forms[k]), kind), []).append(layout.place(number, k)[0] == "True")
    # what mostly numbers the pages of its text is a form of page number
    numbering = {form for form, found in inside.items() if len(found) >= LEAST_LEFT and sum(found) >= NUMBERING * len(found)}

    def agreeing() -> Iterator[tuple[list[list[str]], int]]:
        """Lines of the pages on which form and place agree."""
        for layout in pages:
            for k in layout.body:
                row = features(layout, k)
                on_page = layout.place(layout.kinds[k][1], k)[0] == "True"
                known = layout.like(k) in forms or on_page and (head_part(layout.forms[k]), layout.kinds[k][0]) in numbering
                if known == (first.score(row) > 0) and (known or not on_page) or known and on_page:
                    yield [[], row], int(known)

    return FurnitureModel(AveragedPerceptron().train(chain(laid_lines(), agreeing())))
