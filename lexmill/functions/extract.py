"""Extraction from text and HTML: dispositions, parties, references, links, pages, records."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from lexmill.functions.fixed import (
    ADVERSARY_INSIDE, ADVERSARY_START, CHAMBER_CLASSES, COUNCIL_FIELDS, DISPOSITION_COUNCIL, DISPOSITION_REVIEW, ITEM_LABELS,
    NODE_TYPES, ORGANISATIONS, REFERENCE_ARTICLE, REFERENCE_LABEL, REFERENCE_VISA, SECTION_LABELS,
)
from lexmill.functions.patterns import portable
from lexmill.functions.text import clean_text, strip


def disposition(text: Column, source: str) -> Column:
    """EXT-01: from the first formula of the operative part to the end, cleaned."""
    pattern = {"review": DISPOSITION_REVIEW, "council": DISPOSITION_COUNCIL}[source]
    return clean_text(F.regexp_substr(text, F.lit(portable(pattern))))


def parties(text: Column) -> Column:
    """EXT-02: the first three party lines of the first 2500 characters.

    Lines with an adversary's mark count; lines with an organisation only while
    one to three party lines have been seen.
    """
    lines = F.transform(F.split(F.substring(text, 1, 2500), "\n"), strip)
    lines = F.filter(lines, lambda x: (x != "") & ~F.startswith(x, F.lit("#")) & ~F.startswith(x, F.lit("![")))

    def has(line: Column, words: tuple[str, ...], test) -> Column:
        out = F.lit(False)
        for word in words:
            out = out | test(line, F.lit(word))
        return out

    def add(seen: Column, line: Column) -> Column:
        adversary = has(line, ADVERSARY_INSIDE, F.contains) | has(line, ADVERSARY_START, F.startswith)
        follows = has(line, ORGANISATIONS, F.contains) & F.size(seen).between(1, 3)
        return F.when(adversary | follows, F.concat(seen, F.array(line))).otherwise(seen)

    found = F.aggregate(lines, F.array().cast("array<string>"), add)
    return clean_text(F.nullif(F.array_join(F.slice(found, 1, 3), " | "), F.lit("")))


def legal_references(text: Column) -> Column:
    """EXT-03: label lines, visas of the first 3000 characters, articles of texts; the first eight, each once."""

    def every(source: Column, pattern: str) -> Column:
        found = F.regexp_extract_all(source, F.lit(portable(pattern)), F.lit(1))
        return F.filter(F.transform(found, clean_text), lambda x: x.isNotNull())

    found = F.concat(every(text, REFERENCE_LABEL), every(F.substring(text, 1, 3000), REFERENCE_VISA), every(text, REFERENCE_ARTICLE))
    return F.nullif(F.array_join(F.slice(F.array_distinct(found), 1, 8), " | "), F.lit(""))


def hrefs(html: Column) -> Column:
    """All link targets of a page."""
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), F.lit(1))


def absolute(href: Column, base: str) -> Column:
    """A link target against a site: absolute as it is, from the root, or below the base."""
    site = "/".join(base.split("/")[:3])
    return (
        F.when(href.rlike(r"^[a-z][a-z0-9+.-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.lit(site.split("//")[0]), href))
        .when(F.startswith(href, F.lit("/")), F.concat(F.lit(site), href))
        .otherwise(F.concat(F.lit(base.rstrip("/") + "/"), href))
    )


def canonical_url(href: Column, base: str) -> Column:
    """EXT-06: absolute, without query and fragment, with a slash at the end."""
    url = F.substring_index(F.substring_index(absolute(href, base), "#", 1), "?", 1)
    return F.when(F.endswith(url, F.lit("/")), url).otherwise(F.concat(url, F.lit("/")))


def decision_urls(html: Column, base: str) -> Column:
    """EXT-06: canonical URLs of the decisions that a page links to, each once."""
    urls = F.transform(hrefs(html), lambda h: canonical_url(h, base))
    return F.array_distinct(F.filter(urls, lambda u: u.rlike(r"/decision/[^/]+/?$")))


def last_page(html: Column, paths: bool = True) -> Column:
    """EXT-07: the highest page in the pagination block, 1 without one; ``paths`` also reads ``/page/n``."""
    block = F.regexp_extract(html, r"""(?s)<div[^>]*class=["'][^"']*\bpagination\b[^"']*["'][^>]*>(.*?)</div>""", 1)
    links = F.regexp_extract_all(block, F.lit(r"""(<a\s[^>]*\bpage-numbers\b[^>]*>)"""), F.lit(1))
    number = r"(?:paged=|/page/)(\d+)" if paths else r"paged=(\d+)"
    found = F.transform(links, lambda a: F.regexp_extract(a, number, 1).try_cast("int"))
    return F.coalesce(F.array_max(found), F.lit(1))


def issue_numbers(html: Column, language: Column) -> Column:
    """EXT-08: issue numbers of an annual index: calls in links, else in scripts, else (AR) options of the form."""
    call = r"""MaxWin\(['"](\d+)['"]\)"""
    in_links = F.flatten(F.transform(F.regexp_extract_all(html, F.lit(r"""(<a\s[^>]*>)"""), F.lit(1)), lambda a: F.regexp_extract_all(a, F.lit(call), F.lit(1))))
    scripts = F.regexp_extract_all(html, F.lit(r"(?s)<script[^>]*>(.*?)</script>"), F.lit(1))
    in_scripts = F.flatten(F.transform(scripts, lambda s: F.regexp_extract_all(s, F.lit(call), F.lit(1))))
    form = F.regexp_extract(html, r"""(?s)<form[^>]*name=["']zFrm2["'][^>]*>(.*?)</form>""", 1)
    select = F.regexp_extract(form, r"""(?s)<select[^>]*name=["']znjo["'][^>]*>(.*?)</select>""", 1)
    options = F.regexp_extract_all(select, F.lit(r"""<option[^>]*value=["'](\d+)["']"""), F.lit(1))
    options = F.reverse(F.array_sort(F.transform(F.array_distinct(options), lambda o: o.cast("int"))))
    options = F.transform(options, lambda o: o.cast("string"))
    found = F.when(F.size(in_links) > 0, in_links).when(F.size(in_scripts) > 0, in_scripts).when(language == "AR", options).otherwise(in_links)
    return F.transform(found, lambda n: F.when(F.length(n) < 3, F.lpad(n, 3, "0")).otherwise(n))


def pdf_links(html: Column, base: str, embedded: bool = False) -> Column:
    """EXT-09: PDF targets of links and quoted URLs, on request of embedded frames and quoted paths too."""
    is_pdf = lambda u: F.contains(F.lower(u), F.lit(".pdf"))
    found = F.array_union(
        F.filter(F.transform(hrefs(html), lambda h: absolute(h, base)), is_pdf),
        F.regexp_extract_all(html, F.lit(r"""["'](https?://[^"']+?\.pdf[^"']*)["']"""), F.lit(1)),
    )
    if embedded:
        frames = F.regexp_extract_all(html, F.lit(r"""(?i)<(?:iframe|embed|object)\s[^>]*?(?:src|data)=["']([^"']+)["']"""), F.lit(1))
        paths = F.regexp_extract_all(html, F.lit(r"""["'](/[^"']*?\.pdf[^"']*)["']"""), F.lit(1))
        more = F.transform(F.concat(F.filter(frames, is_pdf), paths), lambda h: absolute(h, base))
        found = F.array_union(found, more)
    return F.array_sort(F.array_distinct(found))


def link_kind(title: Column, href: Column) -> Column:
    """EXT-10: pdf, guide or null for a link of the archive page."""
    lower = F.lower(href)
    guide = F.lit(False)
    for word in ("دليل", "فهرس", "فهارس"):
        guide = guide | F.contains(title, F.lit(word))
    for word in ("dail", "fihris", "index", "guide"):
        guide = guide | F.contains(href, F.lit(word))
    return F.when(F.endswith(lower, F.lit(".pdf")) | F.contains(lower, F.lit(".pdf?")), "pdf").when(guide, "guide")


# --- pages as trees -------------------------------------------------------------------------

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class Node:
    """An element with its children; text is a string among them."""

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def walk(self):
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def strings(self):
        for child in self.children:
            if isinstance(child, Node):
                yield from child.strings()
            else:
                yield child

    def text(self, between: str = "") -> str:
        return between.join(s for s in (x.strip() for x in self.strings()) if s)

    def find(self, test) -> Node | None:
        return next((n for n in self.walk() if test(n)), None)


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node is not self.root and node.name != tag:
            node = node.parent
        if node is not self.root:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def tree(html: str) -> Node:
    parser = _Tree()
    parser.feed(html)
    parser.close()
    return parser.root


def _clean(text: str | None) -> str | None:
    if text is None:
        return None
    text = re.sub("[\u00a0\u2000-\u200b\u202f\u205f\u3000\ufeff]", " ", text).replace("\r\n", "\n").replace("\r", "\n")
    for forms, letters in (("ﻵﻶﻻﻼ", "لا"), ("ﻷﻸ", "لأ"), ("ﻹﻺ", "لإ")):
        text = re.sub(f"[{forms}]", letters, text)
    text = "\n".join(re.sub(r"[ \t]+", " ", line).strip() for line in text.split("\n"))
    return re.sub(r"\n{3,}", "\n\n", text).strip() or None


_COURT_FIELDS = [*ITEM_LABELS.values(), *SECTION_LABELS.values()]
COURT_RECORD = StructType(
    [StructField(n, StringType()) for n in ("chamber", "chamber_class", *dict.fromkeys(_COURT_FIELDS), "text", "_error")]
    + [StructField("extra_sections", MapType(StringType(), StringType()))]
)
COUNCIL_RECORD = StructType([StructField(n, StringType()) for n in ("node_type", *COUNCIL_FIELDS, "pdf_url", "text", "_error")])


def court_record(html: str) -> dict:
    """EXT-04: fields of a court page. A page that is none has only ``_error``."""
    root = tree(html)
    article = root.find(lambda n: n.name == "article" and "id" in n.attrs) or root.find(lambda n: n.name == "article")
    if article is None or "decision" not in article.classes():
        return {"_error": "no decision"}
    content = article.find(lambda n: n.name == "div" and "entry-content" in n.classes())
    if content is None:
        return {"_error": "no content"}
    out: dict = {"extra_sections": {}}
    known = [c for c in article.classes() if any(c == p or c.removeprefix(p + "-").isdigit() and c.startswith(p + "-") for p in CHAMBER_CLASSES)]
    if known:
        out["chamber_class"] = known[0]
        out["chamber"] = next(v for k, v in CHAMBER_CLASSES.items() if known[0].startswith(k))
    order = list(content.walk())
    for item in (n for n in order if n.name == "li"):
        text = _clean(item.text(" "))
        if text and ":" in text:
            label, _, value = text.partition(":")
            field = next((f for known_label, f in ITEM_LABELS.items() if label.strip().startswith(known_label)), None)
            if field:
                out[field] = _clean(value)
    heads = [n for n in order if n.name == "h5"]
    for k, head in enumerate(heads):
        label = (_clean(head.text(" ")) or "").rstrip(":").strip()
        paragraphs = [n for n in head.parent.walk() if n.name == "p"] if head.parent is not None and head.parent.name == "li" else []
        if not paragraphs and k + 1 < len(heads):
            between = order[order.index(head) + 1 : order.index(heads[k + 1])]
            paragraphs = [n for n in between if n.name == "p"]
        value = _clean("\n".join(p.text("\n") for p in paragraphs))
        field = next((f for known_label, f in SECTION_LABELS.items() if label.startswith(known_label)), None)
        if field:
            out[field] = value
        else:
            out["extra_sections"][label or "sans_titre"] = value
    out["text"] = _clean(content.text("\n"))
    return out


def council_record(html: str) -> dict:
    """EXT-05: fields of an administrative court page. A page that is none has only ``_error``."""
    article = tree(html).find(lambda n: n.name == "article")
    kind = next((c for c in article.classes() if c in NODE_TYPES), None) if article is not None else None
    if kind is None:
        return {"_error": "no node of a known type"}

    def marked(node: Node, *names: str) -> bool:
        return any(name in (node.attrs.get("class") or "") for name in names)

    def field(name: str) -> str | None:
        box = article.find(lambda n: n.name == "div" and marked(n, f"field--name-{name}"))
        if box is None:
            return None
        items = [t for t in (n.text() for n in box.walk() if marked(n, "field--item", "field__item")) if t]
        if items:
            return " - ".join(items)
        label = box.find(lambda n: marked(n, "field--label", "field__label"))
        whole = box.text()
        return (whole[len(label.text()) :].strip() if label is not None else whole.strip()) or None

    out = {"node_type": kind} | {k: _clean(v) if (v := field(name)) is not None else None for k, name in COUNCIL_FIELDS.items()}
    links = [n.attrs["href"] for n in article.walk() if n.name == "a" and ".pdf" in n.attrs.get("href", "").lower()]
    out["pdf_url"] = links[0] if links else None
    out["text"] = _clean(article.text("\n"))
    return out


def _records(parse, schema: StructType):
    names = schema.names

    @F.pandas_udf(schema)
    def records(html: pd.Series) -> pd.DataFrame:
        rows = [parse(h) if h is not None else {"_error": "no page"} for h in html]
        return pd.DataFrame([{n: r.get(n) for n in names} for r in rows], columns=names, dtype=object)

    return records


def court_page(html: Column) -> Column:
    return _records(court_record, COURT_RECORD)(html)


def council_page(html: Column) -> Column:
    return _records(council_record, COUNCIL_RECORD)(html)


def logical_name(kind: Column, year: Column, number: Column, url: Column, pdf_url: Column) -> Column:
    """SNK-15: a stable file name for a review resource."""
    short = {"REVUE": "revue", "SPECIAL_ISSUE": "special", "GUIDE": "guide", "INDEX": "index"}
    name = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in short.items() for x in p]), kind), F.lit("autre"))
    suffix = F.substring(F.sha2(url, 256), 1, 8)
    stem = F.regexp_replace(F.element_at(F.split(F.substring_index(pdf_url, "?", 1), "/"), -1), r"\.[^.]*$", "")
    stem = F.substring(F.regexp_replace(stem, r"(?U)[^\w-]", "_"), 1, 40)
    has_year, has_number = F.coalesce(year, F.lit(0)) != 0, F.coalesce(number, F.lit(0)) != 0
    return (
        F.when(has_year & has_number, F.concat(name, F.lit("_"), year, F.lit("_"), F.when(number < 10, F.concat(F.lit("0"), number)).otherwise(number.cast("string")), F.lit(".pdf")))
        .when(has_year, F.concat(name, F.lit("_"), year, F.lit("_"), suffix, F.lit(".pdf")))
        .otherwise(F.concat(name, F.lit("_"), stem, F.lit("_"), suffix, F.lit(".pdf")))
    )


def url_slug(url: Column) -> Column:
    """SNK-17: a file name for a URL's path."""
    path = F.try_url_decode(F.regexp_extract(url, r"^[a-z]+://[^/]*([^?#]*)", 1))
    name = F.regexp_replace(F.replace(F.regexp_replace(path, r"^/+|/+$", ""), F.lit("/"), F.lit("_")), r"(?U)[^\w.-]", "_")
    return F.coalesce(F.nullif(F.substring(name, 1, 120), F.lit("")), F.lit("root"))


def archive_name(url: Column) -> Column:
    """SNK-13: the archived page of a URL."""
    return F.concat(F.substring(F.sha2(url, 256), 1, 16), F.lit(".html"))


def attachment_name(nid: Column, url: Column) -> Column:
    """SNK-18: the file name of a node's attachment."""
    return F.concat(F.lit("nid_"), nid.cast("string"), F.lit("_"), F.regexp_extract(F.substring_index(url, "?", 1), "[^/]+$", 0))


def page_issue(title: Column) -> Column:
    """Issue number and year in a decoded title, as a struct."""
    pattern = r"عدد[-\s]?(\d{2})[-\s]?(\d{4})"
    return F.struct(F.regexp_extract(title, pattern, 1).try_cast("int").alias("number"), F.regexp_extract(title, pattern, 2).try_cast("int").alias("year"))
