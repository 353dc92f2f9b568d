"""HTML pages to article fields and links, on the standard library's parser in Arrow batches.

A page becomes a small tree; rules pick nodes by the selectors that source configurations use: tag, .class,
#id, [attribute], [attribute='value'], descendants and lists of these. Unclosed tags are tolerated.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from ..functions.dates import parse

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Tags whose start ends an open paragraph.
_BLOCK = set("p div section article main ul ol table h1 h2 h3 h4 h5 h6 blockquote header footer nav aside form pre hr dl figure".split())
#: Where a date may stand, where bodies are, and what isn't part of them.
DATE_METAS = (("property", "article:published_time"), ("name", "datePublished"), ("itemprop", "datePublished"), ("property", "og:article:published_time"))
MODIFIED_METAS = (("property", "article:modified_time"), ("name", "dateModified"), ("itemprop", "dateModified"), ("property", "og:updated_time"))
DATE_SELECTORS = ("time[datetime]", "[itemprop='datePublished']", "[property='article:published_time']")
BODY_SELECTORS = (".entry-content", ".post-content", "article .content", "#sports_article_writeup", ".article__writeup", ".story_main .article-body", ".story_main .article_body")
EXCLUDED = (
    "nav, footer, header, aside, sidebar, .sidebar, .ads, .ad, .advertisement, .social-share, .comments, .related, .newsletter, .subscribe, .caption, "
    ".byline, .author, .dateline, .timestamp, .publication-date, .tags, .share, .photo-credit, .embed, .video, script, style, form"
)


class Node:
    """An element; its children are elements and strings."""

    __slots__ = ("tag", "attrs", "parent", "children", "classes")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        self.classes = frozenset(attrs.get("class", "").split())

    def nodes(self) -> Iterator[Node]:
        """All elements below, in document order."""
        todo = [c for c in reversed(self.children) if isinstance(c, Node)]
        while todo:
            node = todo.pop()
            yield node
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]

    def strings(self) -> Iterator[str]:
        todo: list = list(reversed(self.children))
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                yield x
            elif x.tag not in ("script", "style"):
                todo += reversed(x.children)

    def text(self) -> str:
        """The strings in it, trimmed, with a blank between."""
        return " ".join(filter(None, (clean(s) for s in self.strings())))


_STEP = re.compile(r"(?P<tag>[\w-]+|\*)?(?P<rest>(?:[.#][\w-]+|\[[^\]]+\])*)")
_PART = re.compile(r"\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)|\[\s*(?P<attr>[\w:-]+)\s*(?:=\s*(?P<value>\"[^\"]*\"|'[^']*'|[^\]]*))?\]")


class Selector:
    """A list of descendant chains. What it can't read matches nothing."""

    def __init__(self, text: str):
        self.chains = [chain for chain in (self._chain(part) for part in text.split(",")) if chain]

    @staticmethod
    def _chain(text: str) -> list[tuple]:
        steps = []
        for word in re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", text.strip()):
            m = _STEP.fullmatch(word)
            if not m:
                return []
            parts = [p.groupdict() for p in _PART.finditer(m["rest"])]
            steps.append((None if m["tag"] in (None, "*") else m["tag"].lower(), parts))
        return steps

    @staticmethod
    def _fits(node: Node, step: tuple) -> bool:
        tag, parts = step
        if tag and node.tag != tag:
            return False
        for p in parts:
            if p["cls"]:
                if p["cls"] not in node.classes:
                    return False
            elif p["id"]:
                if node.attrs.get("id") != p["id"]:
                    return False
            elif p["attr"].lower() not in node.attrs or (p["value"] is not None and node.attrs[p["attr"].lower()] != p["value"].strip("\"' ")):
                return False
        return True

    def matches(self, node: Node) -> bool:
        for chain in self.chains:
            if not self._fits(node, chain[-1]):
                continue
            left, up = len(chain) - 2, node.parent
            while left >= 0 and up is not None:
                left -= self._fits(up, chain[left])
                up = up.parent
            if left < 0:
                return True
        return False

    def all(self, root: Node) -> list[Node]:
        return [n for n in root.nodes() if self.matches(n)] if self.chains else []

    def first(self, root: Node) -> Node | None:
        return next((n for n in root.nodes() if self.matches(n)), None) if self.chains else None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def _close(self, tag: str, within: tuple[str, ...] = ()) -> None:
        node = self.at
        while node is not self.root and node.tag != tag:
            if node.tag in within:
                return
            node = node.parent
        if node is not self.root:
            self.at = node.parent

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self._close("p", ("div", "section", "article", "td", "li", "body", "button"))
        if tag == "li":
            self._close("li", ("ul", "ol"))
        node = Node(tag, {k.lower(): v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        self._close(tag)

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def undo(root: Node) -> None:
    """Take a tree apart: nodes and parents refer to each other, so it would stay until the collector of cycles runs."""
    todo = [root]
    while todo:
        node = todo.pop()
        todo += [c for c in node.children if isinstance(c, Node)]
        node.children, node.parent = [], None


def clean(text: str) -> str:
    return " ".join(text.split())


def _articles(root: Node) -> list[dict]:
    """JSON-LD nodes of an article type."""
    found, todo = [], []
    for script in root.nodes():
        if script.tag == "script" and script.attrs.get("type") == "application/ld+json":
            try:
                todo.append(json.loads("".join(c for c in script.children if isinstance(c, str))))
            except ValueError:
                continue
    while todo:
        node = todo.pop(0)
        if isinstance(node, list):
            todo[:0] = node
        elif isinstance(node, dict):
            kinds = node.get("@type") or []
            if any("article" in str(k).lower() for k in (kinds if isinstance(kinds, list) else [kinds])):
                found.append(node)
            if node.get("@graph"):
                todo.insert(0, node["@graph"])
    return found


def _author(value) -> str:
    if isinstance(value, dict):
        return str(value.get("name") or "")
    if isinstance(value, list):
        return ", ".join(filter(None, map(_author, value)))
    return str(value or "")


def dates_of(root: Node, articles: list[dict], metas: dict, selector: str = "") -> list[tuple[str, str]]:
    """The texts that may be the publication date, in order of trust, each with where it stands."""
    out = [(str(a.get("datePublished") or a.get("dateCreated")).strip(), "jsonld") for a in articles if a.get("datePublished") or a.get("dateCreated")]
    out += [(metas[m], "meta") for m in DATE_METAS if metas.get(m)]
    for wanted in (*filter(None, (x.strip() for x in selector.split(","))), *DATE_SELECTORS):
        node = Selector(wanted).first(root)
        value = node and (node.attrs.get("datetime") or node.attrs.get("content") or node.text()).strip()
        if value:
            out.append((value, "selector"))
    return out


def body_of(root: Node, selector: str = "") -> tuple[str, str | None]:
    """The text of the body, a line for each paragraph, and the selector that found it."""
    best, most, by = None, 0, None
    for wanted in (*filter(None, (x.strip() for x in selector.split(","))), *BODY_SELECTORS):
        node = Selector(wanted).first(root)
        if node is not None:
            score = sum(len(n.text()) for n in node.nodes() if n.tag == "p") or len(node.text())
            if score > most:
                best, most, by = node, score, wanted
    if best is None:
        best, by = next((n for n in root.nodes() if n.tag == "article"), None) or next((n for n in root.nodes() if n.tag == "body"), None) or root, "article|body"
    excluded = Selector(EXCLUDED)
    for node in [n for n in best.nodes() if excluded.matches(n)]:
        if node in node.parent.children:
            node.parent.children.remove(node)
    lines = [t for t in (n.text() for n in best.nodes() if n.tag == "p") if t]
    lines = lines or [t for t in (c.text() for c in best.children if isinstance(c, Node) and c.tag in ("div", "section", "li")) if t]
    return "\n".join(lines or filter(None, [best.text()])), by


def select_links(root: Node, selector: str, base: str) -> list[str]:
    """Absolute links of what a selector finds: anchors, or the first anchor within."""
    out = []
    for node in Selector(selector).all(root):
        anchor = node if node.tag == "a" else next((n for n in node.nodes() if n.tag == "a"), None)
        href = anchor.attrs.get("href", "").strip() if anchor is not None else ""
        if href:
            out.append(resolve(base, href))
    return list(dict.fromkeys(out))


def next_link(root: Node, selector: str, base: str) -> str | None:
    """Where the listing's next page is."""
    node = Selector(selector).first(root)
    href = node and (node.attrs.get("href") or next((n.attrs["href"] for n in node.nodes() if n.tag == "a" and n.attrs.get("href")), None))
    return resolve(base, href.strip()) if href else None


def extract(html: str | None, url: str = "", body_selector: str = "", date_selector: str = "") -> dict:
    """Article fields and absolute links of a page."""
    root = tree(html)
    try:
        return _extract(root, url, body_selector, date_selector)
    finally:
        undo(root)


def _extract(root: Node, url: str, body_selector: str, date_selector: str) -> dict:
    metas: dict[tuple[str, str], str] = {}
    canonical = base = title = None
    links = []
    for n in root.nodes():
        if n.tag == "meta":
            for key in ("property", "name", "itemprop"):
                if n.attrs.get(key):
                    metas.setdefault((key, n.attrs[key]), n.attrs.get("content", "").strip())
        elif n.tag == "link" and "canonical" in n.attrs.get("rel", "").lower().split():
            canonical = canonical or n.attrs.get("href", "").strip() or None
        elif n.tag == "base" and n.attrs.get("href", "").strip():
            base = base or n.attrs["href"].strip()
        elif n.tag == "title":
            title = title or n.text()
        elif n.tag == "a" and "href" in n.attrs:
            links.append((n.attrs["href"].strip(), n.text()[:500], clean(n.attrs.get("rel", ""))[:200]))
    articles = _articles(root)
    first = lambda xs: next((str(x).strip() for x in xs if x and str(x).strip()), None)
    dates = dates_of(root, articles, metas, date_selector)
    date, origin = next((d for d in dates if parse(d[0])), dates[0] if dates else (None, "missing"))
    within = resolve(url, base or "")
    body, by = body_of(root, body_selector)
    return {
        "headline": first([*(a.get("headline") for a in articles), metas.get(("property", "og:title")), title]),
        "author": first([*(_author(a.get("author")) for a in articles), metas.get(("name", "author")), metas.get(("itemprop", "author"))]),
        "published": date,
        "date_source": origin,
        "modified": first([*(a.get("dateModified") or a.get("dateUpdated") for a in articles), *(metas.get(m) for m in MODIFIED_METAS)]),
        "canonical": canonical,
        "body": body,
        "body_selector": by,
        "links": [{"href": resolve(within, h), "text": t, "rel": r, "base": base} for h, t, r in links],
    }


#: Bytes of HTML whose pages are held as Python objects at a time; a batch may hold 10,000 pages.
SLICE = 480_000
_LINK = pa.struct([("href", pa.string()), ("text", pa.string()), ("rel", pa.string()), ("base", pa.string())])
_FIELDS = ["headline", "author", "published", "date_source", "modified", "canonical", "body", "body_selector"]


def slices(batches: Iterator[pa.RecordBatch], column: str = "html", most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a slice holds about `most` bytes of a column, one row at least; freed memory goes back."""
    for batch in batches:
        start, held = 0, 0
        for i, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
            if i > start and held + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)
        pa.default_memory_pool().release_unused()


def extract_pages(pages: DataFrame, body_selector: str = "", date_selector: str = "") -> DataFrame:
    """page_id, url and the fields and links of each page (page_id, url, html).

    A column body_selector or date_selector of pages, as a source's configuration gives it, goes before the arguments.
    """
    chosen = [c for c in ("body_selector", "date_selector") if c in pages.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            urls = batch.column("url").to_pylist()
            given = {c: batch.column(c).to_pylist() if c in chosen else [d] * len(urls) for c, d in (("body_selector", body_selector), ("date_selector", date_selector))}
            rows = [extract(h, u or "", b or "", d or "") for h, u, b, d in zip(batch.column("html").to_pylist(), urls, given["body_selector"], given["date_selector"], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *(pa.array([r[f] for r in rows], pa.string()) for f in _FIELDS), pa.array([r["links"] for r in rows], pa.list_(_LINK))], names=["page_id", "url", *_FIELDS, "links"])

    return pages.select("page_id", "url", "html", *chosen).mapInArrow(run, "page_id bigint, url string, " + ", ".join(f"{f} string" for f in _FIELDS) + ", links array<struct<href string, text string, rel string, base string>>")


def extract_listings(pages: DataFrame, link_selector: str, next_selector: str = "") -> DataFrame:
    """page_id, url, links and next_url of archive listings."""

    def listed(html: str | None, url: str) -> tuple[list[str], str | None]:
        root = tree(html)
        try:
            return select_links(root, link_selector, url), next_link(root, next_selector, url) if next_selector else None
        finally:
            undo(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            urls = [u or "" for u in batch.column("url").to_pylist()]
            found = [listed(h, u) for h, u in zip(batch.column("html").to_pylist(), urls, strict=True)]
            links, after = [x for x, _ in found], [x for _, x in found]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(links, pa.list_(pa.string())), pa.array(after, pa.string())], names=["page_id", "url", "links", "next_url"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id bigint, url string, links array<string>, next_url string")


def resolve(base: str, href: str) -> str:
    """href against base; what can't be parsed stays as it is."""
    try:
        return urljoin(base, href)
    except ValueError:
        return href
