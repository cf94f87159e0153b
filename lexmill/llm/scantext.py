"""Lines, words and broken words of scanned text, and what of them is looked up in corpus-wide tables."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

#: Characters that break a word at a line's end (fixed values).
BREAKS = "­‐¬ـ-"
#: Lines of furniture that may lie between the halves of a broken word.
GAP_LINES = 5
#: Longer lines are no running headers, longer strings of letters no words.
MOST_LINE, MOST_WORD = 120, 40
#: Share of the longest line's length below which a line is short.
SHORT = 0.85
_WORD = re.compile(r"[^\s.,;:()\[\]{}«»،؛؟\"]+")
_BREAK = re.compile(rf"([^\s{BREAKS}]+?)([{BREAKS}]+)\s*$")
_DIGITS = re.compile(r"[0-9٠-٩]+")
_GAP = re.compile(r"\s{2,}")

find_words = _WORD.findall


@lru_cache(maxsize=200_000)
def bare(word: str) -> str:
    """A word in lower case without marks above and below letters that are no part of them."""
    if word.isascii():
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFC", word) if unicodedata.category(c) != "Mn").lower()


def is_word(word: str) -> bool:
    """Whether a bare word is made of letters rather than digits, and not too long for one."""
    if not 3 <= len(word) <= MOST_WORD or word[-1] in BREAKS:
        return False
    letters = sum(map(str.isalpha, word))
    return letters >= 2 and letters > sum(map(str.isdigit, word))


def skeleton(line: str) -> str:
    """A line with digits alike and gaps of one width."""
    text = line.strip()
    return _GAP.sub("  ", _DIGITS.sub("9", text)) if text else ""


def head_part(form: str) -> str:
    """What a skeleton has before its first gap."""
    return form.split("  ", 1)[0]


class Break:
    """A line that ends in a mark after a piece of a word."""

    __slots__ = ("head", "mark", "start")

    def __init__(self, head: str, mark: str, start: int):
        self.head, self.mark, self.start = head, mark, start


def break_of(line: str) -> Break | None:
    stripped = line.rstrip()
    if stripped[-1:] not in BREAKS or not stripped:
        return None
    found = _BREAK.search(line)
    if not found or not found[1][-1:].isalpha():
        return None
    pieces = find_words(found[1])
    head = pieces[-1] if pieces else found[1]
    return Break(head, found[2], found.end(1) - len(head))


def wholes(head: str, tail: str) -> tuple[str, str]:
    """A broken word joined, and joined as a compound."""
    return bare(head + tail), bare(f"{head}-{tail}")


def possible_breaks(lines: list[str], words: list[list[str]]):
    """``head, tail, near`` of every broken word, whatever of the lines between turns out to be furniture.

    ``near``: only lines that are shorter than most or have digits lie between.
    """
    width = 0
    for k, line in enumerate(lines):
        broken = break_of(line)
        if broken:
            width = width or max(map(len, lines))
            seen, near = 0, True
            for j in range(k + 1, len(lines)):
                if lines[j].strip():
                    if words[j]:
                        yield broken.head, words[j][0], near
                    near = near and (len(lines[j]) < SHORT * width or _DIGITS.search(lines[j]) is not None)
                    seen += 1
                    if seen > GAP_LINES:
                        break


def looked_up(text: str) -> tuple[list[str], list[str], list[str], list[str]]:
    """Words, bare pieces and wholes of words that a break may have split, those wholes to be edited, heads of the short lines."""
    lines = text.split("\n")
    words = [find_words(line) for line in lines]
    split: list[str] = []
    joined: list[str] = []
    for head, tail, near in possible_breaks(lines, words):
        both = wholes(head, tail)
        split += [bare(head), bare(tail), *both]
        if near:
            joined += both
    heads = [head_part(skeleton(line)) for line in lines if 0 < len(line) <= MOST_LINE]
    return [w for row in words for w in row], split, joined, [h for h in heads if h]
