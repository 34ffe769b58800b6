"""Body text and lead image of web pages, with the standard library's parser, in one Arrow-batched pass."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
DROPPED_TEXT = {"script", "style", "noscript"}
DROPPED_BODY = {"script", "style", "noscript", "iframe", "svg", "video", "nav", "header", "footer", "aside", "form"}
DROPPED_TOKENS = {"nav", "footer", "header", "sidebar", "comment", "related", "share", "ad", "ads", "banner", "player", "vod"}
DECLARED = ['[itemprop="articleBody"]', "#newsViewArea", "#articleBody", ".article_body", ".article-body", ".article-content", ".news_body", ".news-body"]
BY_DOMAIN = {"yna.co.kr": [".story-news.article"], "seoul.co.kr": ["#articleContent"], "donga.com": [".news_view"], "hani.co.kr": [".article-text"]}
CANDIDATES = ("article", "main", "section", "div")
LAZY = ("src", "data-src", "data-original", "data-lazy-src", "data-url")
LEAST_BODY, WORD_SCORE = 200, 5
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)

    def walk(self) -> Iterator[Node]:
        todo: list[Node] = [self]
        while todo:
            node = todo.pop()
            yield node
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self, skip: Callable[[Node], bool]) -> str:
        out: list[str] = []
        todo: list[Node | str] = [self]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                out.append(node)
            elif node is self or not skip(node):
                todo += reversed(node.children)
        return " ".join(" ".join(out).split())


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                break

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def dropped(node: Node) -> bool:
    """Not part of a body: by tag, or by a token of class or id."""
    if node.tag in DROPPED_BODY:
        return True
    hint = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower()
    return not DROPPED_TOKENS.isdisjoint(re.split(r"[\s_-]+", hint))


def selects(selector: str, node: Node) -> bool:
    """Attribute, id and (joined) class selectors."""
    if selector.startswith("["):
        name, _, value = selector[1:-1].partition("=")
        return node.attrs.get(name.lower()) == value.strip('"')
    if selector.startswith("#"):
        return node.attrs.get("id") == selector[1:]
    return set(selector[1:].split(".")) <= set(node.attrs.get("class", "").split())


def to_text(html: str | None) -> str:
    """Plain text of a fragment; a bare URL has none, and text without markup is only collapsed."""
    if not html or urlparse(html.strip()).scheme in ("http", "https"):
        return ""
    if "<" not in html and ">" not in html:
        return " ".join(html.split())
    return parse(html).text(lambda n: n.tag in DROPPED_TEXT)


def _embedded(html: str) -> dict | None:
    """The JSON object that a page assigns to its global content variable."""
    at = re.search(r"Fusion\.globalContent\s*=\s*", html)
    if not at:
        return None
    try:
        value, _ = json.JSONDecoder().raw_decode(html, at.end())
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def _element_texts(elements: list) -> list[str]:
    out: list[str] = []
    for e in elements:
        if isinstance(e, dict):
            if e.get("type") == "text" and e.get("content"):
                out.append(to_text(str(e["content"])))
            if isinstance(e.get("content_elements"), list):
                out += _element_texts(e["content_elements"])
    return [t for t in out if t]


def selectors_for(url: str | None) -> list[str]:
    host = urlparse(url or "").netloc.lower()
    return next((s for d, s in BY_DOMAIN.items() if host == d or host.endswith("." + d)), [])


def body(html: str | None, url: str | None = None, tree: Node | None = None) -> tuple[str, str]:
    """(which way found it, text): embedded JSON, the publisher's container, a declared container, the best-scoring block, all."""
    if not html:
        return "empty", ""
    data = _embedded(html)
    if data and (text := "\n".join(_element_texts(data.get("content_elements") or []))):
        return "embedded", text
    tree = tree or parse(html)
    nodes = list(tree.walk())
    for way, selectors in (("publisher", selectors_for(url)), ("declared", DECLARED)):
        for s in selectors:
            node = next((n for n in nodes if selects(s, n)), None)
            if node is not None and len(text := node.text(dropped)) >= LEAST_BODY:
                return way, text
    best, best_score = "", 0
    kept: list[Node] = []
    todo = [tree]
    while todo:
        node = todo.pop()
        kept.append(node)
        todo += [c for c in node.children if isinstance(c, Node) and not dropped(c)]
    for tag in CANDIDATES:
        for node in kept:
            if node.tag == tag and len(text := node.text(dropped)) >= LEAST_BODY and (score := len(text) + WORD_SCORE * len(text.split())) > best_score:
                best, best_score = text, score
    if best:
        return "scored", best
    container = next((n for n in nodes if n.tag == "body"), tree)
    return "whole", container.text(dropped)


def _allowed(value: str, base: str | None) -> str:
    """Absolute URL of an image, empty if it has none that can be fetched. A value without a host takes the page's scheme."""
    raw = (value or "").strip()
    scheme = m[1].lower() if (m := re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", raw)) else ""
    if not raw or scheme not in ("", "http", "https", "file"):
        return ""
    page = base if urlparse(base or "").scheme in ("http", "https") else "https://" if raw[:2] == "//" else base
    out = raw if scheme else urljoin(page, raw) if page else raw
    return out if re.match(r"(?:https?|file):", out) else ""


def unwanted(url: str) -> bool:
    """Icons, profile pictures, placeholders and interface images."""
    from strata.functions import web

    where = urlparse(url.lower())
    folders = where.path.strip("/").split("/")
    stem = re.sub(r"(?:[-_]\d+)?(?:\.[^.]*)?$", "", folders[-1])
    words = {w.rstrip("0123456789 ") for w in re.findall(r"[^/_.-]+", where.netloc + "/" + where.path)}
    tests = (
        any(where.path.endswith(e) for e in web.ICON_ENDINGS),
        any(f in web.PROFILE_SEGMENTS for f in folders),
        stem in web.PLACEHOLDER_STEMS,
        any(w in web.NOISE_TOKENS for w in words),
    )
    return any(tests)


def _number(value: str | None) -> int | None:
    m = re.match(r"\s*(\d+)", value or "")
    return int(m[1]) if m else None


def _in_node(node: Node, base: str | None) -> str:
    from strata.functions import web

    for img in node.walk():
        if img.tag != "img":
            continue
        w, h = _number(img.attrs.get("width")), _number(img.attrs.get("height"))
        if w is not None and h is not None and (w < web.SMALL_WIDTH or h < web.SMALL_HEIGHT):
            continue
        values = [img.attrs.get(a, "") for a in LAZY]
        values.append(next((u for c in img.attrs.get("srcset", "").split(",") if (u := c.strip().split(" ")[0])), ""))
        for value in values:
            url = _allowed(value, base)
            if url and not unwanted(url):
                return url
    return ""


def image(html: str | None, url: str | None = None, tree: Node | None = None) -> tuple[str, str]:
    """(where it came from, URL): embedded JSON, declared container, article or main, page metadata."""
    if not html:
        return "none", ""
    data = _embedded(html) or {}
    for e in [(data.get("promo_items") or {}).get("basic"), *(data.get("content_elements") or [])]:
        if isinstance(e, dict) and e.get("type", "image") == "image" and (found := _allowed(str(e.get("url") or ""), url)) and not unwanted(found):
            return "embedded", found
    tree = tree or parse(html)
    nodes = list(tree.walk())
    for s in DECLARED:
        node = next((n for n in nodes if selects(s, n)), None)
        if node is not None and (found := _in_node(node, url)):
            return "declared", found
    for tag in ("article", "main"):
        for node in nodes:
            if node.tag == tag and (found := _in_node(node, url)):
                return tag, found
    for name in ("og:image", "twitter:image"):
        for node in nodes:
            if node.tag == "meta" and name in (node.attrs.get("property"), node.attrs.get("name")):
                found = _allowed(node.attrs.get("content", ""), url)
                if found and not unwanted(found):
                    return "meta", found
    return "none", ""


@F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in ("way", "body", "image_source", "image", "plain")]))
def extract(html: pd.Series, url: pd.Series) -> pd.DataFrame:
    """Body, lead image and plain text of each page; the page is parsed once."""
    rows = []
    for h, u in zip(html, url):
        tree = parse(h) if h else None
        way, text = body(h, u, tree)
        source, picture = image(h, u, tree)
        rows.append((way, text, source, picture, to_text(h)))
    return pd.DataFrame(rows, columns=["way", "body", "image_source", "image", "plain"])
