"""Patterns in a form that Java and RE2 read alike."""

from __future__ import annotations

import re

#: What ``\s`` stands for: white space of any kind.
SPACE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def portable(pattern: str) -> str:
    """``\\s`` and ``\\S`` spelled out, in brackets and outside."""
    pattern = pattern.replace(r"[\s\S]", r"[\x{0}-\x{10FFFF}]")
    out, inside, i = [], False, 0
    while i < len(pattern):
        two = pattern[i : i + 2]
        if two == r"\s":
            out.append(SPACE if inside else f"[{SPACE}]")
            i += 2
        elif two == r"\S":
            out.append(f"[^{SPACE}]")
            i += 2
        elif pattern[i] == "\\":
            out.append(two)
            i += 2
        else:
            inside = {"[": True, "]": False}.get(pattern[i], inside)
            out.append(pattern[i])
            i += 1
    return "".join(out)


def boundless(pattern: str) -> str:
    """A portable pattern for RE2, whose word boundary knows ASCII only: a final ``\\b`` spelled out."""
    return re.sub(r"\\b$", r"(?:[^\\p{L}\\p{N}_]|$)", portable(pattern))
