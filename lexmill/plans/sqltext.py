"""SQL snippets shared by the queries' SQL (RE2 syntax)."""

from __future__ import annotations

from lexmill.functions.fixed import LIGATURES, ODD_SPACES, STRIP


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '\A[{STRIP}\n]+|[{STRIP}\n]+\z', '', 'g')"


def clean(x: str) -> str:
    spaced = rf"regexp_replace(regexp_replace({x}, '[{ODD_SPACES}]', ' ', 'g'), '\r\n?', chr(10), 'g')"
    lines = rf"regexp_replace(regexp_replace({spaced}, '[ \t]+', ' ', 'g'), '(?m)^[{STRIP}]+|[{STRIP}]+$', '', 'g')"
    return f"nullif({strip(f'''regexp_replace({lines}, '{chr(92)}n{{3,}}', chr(10) || chr(10), 'g')''')}, '')"


def ligatures(x: str) -> str:
    for forms, letters in LIGATURES:
        x = f"regexp_replace({x}, '[{forms}]', '{letters}', 'g')"
    return x


def found(x: str, pattern: str, group: int = 1, flags: str = "") -> str:
    return f"nullif(regexp_extract({x}, {quoted(flags + pattern)}, {group}), '')"


def padded(x: str, width: int) -> str:
    return f"CASE WHEN length(CAST({x} AS VARCHAR)) < {width} THEN lpad(CAST({x} AS VARCHAR), {width}, '0') ELSE CAST({x} AS VARCHAR) END"


def slug(x: str, default: str, lower: bool = True) -> str:
    kept = f"regexp_replace(CAST({x} AS VARCHAR), '[^0-9a-zA-Z_-]', '', 'g')"
    return f"coalesce(nullif({'lower(' + kept + ')' if lower else kept}, ''), '{default}')"


def mapping(pairs: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in pairs.items()) + "}"


def language(x: str) -> str:
    """AR or FR from a language code in any spelling."""
    return f"CASE WHEN lower({x}) LIKE 'ar%' THEN 'AR' WHEN lower({x}) LIKE 'fr%' THEN 'FR' END"


def sqlite_keywords(x: str, between: str) -> str:
    items = f"list_filter(list_transform(regexp_split_to_array({x}, '{between}'), lambda k: {strip('k')}), lambda k: k <> '')"
    escaped = f"list_transform({items}, lambda k: CAST(to_json(k) AS VARCHAR))"
    return f"CASE WHEN nullif({x}, '') IS NULL THEN NULL WHEN starts_with({strip(x)}, '[') THEN {x} ELSE '[' || coalesce(array_to_string({escaped}, ', '), '') || ']' END"
