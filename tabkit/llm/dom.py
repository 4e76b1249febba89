"""A small HTML reader: elements in page order, their text runs, and features of each.

It follows what browsers do where pages are careless: void elements, paragraphs and list
items left open, raw text of scripts and styles, stray end tags, and pages cut off in
the middle (an unfinished tag at the end is no text).
"""

from __future__ import annotations

import html
import re

import numpy as np

# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe noembed noframes xmp".split())
RCDATA = {"title", "textarea"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = HEADINGS | set(
    "html body p div section article main header footer aside nav ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption form fieldset legend address details summary hr center dialog menu search".split()
)
# A start tag on the left closes an open element on the right, unless a fence stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Words in class, id and role that speak against or for main text.
AGAINST = set(
    "ad ads adv advert advertisement adverts banner breadcrumb breadcrumbs byline comment comments consent cookie cookies "
    "disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted recommended related reply replies respond search share sharing sidebar signup "
    "skip social sponsor sponsored subscribe tags toolbar widget widgets complementary contentinfo alert".split()
)
FOR = set("article body content entry hentry main post story text".split())
TAGS_AGAINST = {"nav", "aside", "footer", "header", "form", "button", "select", "label", "dialog", "menu", "search", "fieldset"}
TAGS_FOR = {"article", "main"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?)*+)(>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
WORDS = re.compile(r"[a-z]+")
# Where no text stands by itself, what may stand there, and what an end tag never closes.
OUTSIDE = {"#root", "html"}
HEAD_TAGS = {"html", "head", "body", "title", "meta", "link", "script", "style", "base", "noscript", "template", "frameset"}
STAYS_OPEN = {"body", "html"}
LABEL = "data-train-label"


class Page:
    """Elements as parallel lists; ``runs`` are (element, text) in page order."""

    def __init__(self, source: str):
        self.tags: list[str] = ["#root"]
        self.parents: list[int] = [-1]
        self.against: list[int] = [0]
        self.for_: list[int] = [0]
        self.labels: list[int] = [-1]
        self.runs: list[tuple[int, str]] = []
        self.implied = -1  # the body, where the page has no tag for it
        self._read(source)

    def _read(self, source: str) -> None:
        stack, at, low = [0], 0, None
        while True:
            found = TOKEN.search(source, at)
            text = source[at : found.start()] if found else source[at:]
            if self.tags[stack[-1]] in OUTSIDE and text and not text.isspace():
                self._imply_body(stack)
            self._text(stack[-1], text)
            if found is None:
                return
            at = found.end()
            tag = found[2]
            if tag is None or not found[4]:  # a comment, a declaration, or an unfinished tag
                if found.end() == len(source):
                    return
                continue
            tag = tag.lower()
            if found[1]:
                if tag not in STAYS_OPEN:  # what follows the body's end still belongs to it
                    self._close(stack, tag)
                continue
            if self.tags[stack[-1]] in OUTSIDE and tag not in HEAD_TAGS:
                self._imply_body(stack)
            self._make_room(stack, tag)
            node = self._add(stack[-1], tag, found[3])
            if tag in RAW or tag in RCDATA:
                low = low or source.lower()
                end = low.find(f"</{tag}", at)
                if end < 0:
                    return
                if tag == "textarea":
                    self._text(node, source[at:end])
                stop = low.find(">", end)
                at = stop + 1 if stop >= 0 else len(source)
            elif tag not in VOID:
                stack.append(node)

    def _imply_body(self, stack: list[int]) -> None:
        """Open the body that the page left out, as browsers do."""
        self.implied = self._add(stack[-1], "body", "")
        stack.append(self.implied)

    def _text(self, node: int, text: str) -> None:
        if text:
            self.runs.append((node, html.unescape(text) if "&" in text else text))

    def _add(self, parent: int, tag: str, attributes: str) -> int:
        against = for_ = 0
        label = self.labels[parent]
        if "=" in attributes:
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name in ("class", "id", "role"):
                    words = WORDS.findall((a or b or c).lower())
                    against += sum(w in AGAINST for w in words)
                    for_ += sum(w in FOR for w in words)
                elif name == LABEL:
                    label = int(a)
        self.tags.append(tag)
        self.parents.append(parent)
        self.against.append(against)
        self.for_.append(for_)
        self.labels.append(label)
        if tag == "br":
            self.runs.append((parent, " "))
        elif tag in BLOCKS:
            self.runs.append((len(self.tags) - 1, ""))  # a block starts even if it stays empty
        return len(self.tags) - 1

    def _make_room(self, stack: list[int], tag: str) -> None:
        if tag in BLOCKS:
            self._pop(stack, {"p"}, {"table", "td", "th", "button", "article", "div", "section", "li"})
        if tag in HEADINGS and self.tags[stack[-1]] in HEADINGS:
            self._leave(stack)
        if tag in CLOSES:
            self._pop(stack, *CLOSES[tag])

    def _pop(self, stack: list[int], wanted: set[str], fence: set[str]) -> None:
        """Close up to the outermost of the wanted elements above the nearest fence."""
        place = None
        for i in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[i]]
            if tag in wanted:
                place = i
            elif tag in fence:
                break
        if place is not None:
            while len(stack) > place:
                self._leave(stack)

    def _leave(self, stack: list[int]) -> None:
        node = stack.pop()
        if self.tags[node] in BLOCKS:
            self.runs.append((stack[-1], ""))  # a block ends: what follows is another

    def _close(self, stack: list[int], tag: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            open_tag = self.tags[stack[i]]
            if open_tag == tag:
                while len(stack) > i:
                    self._leave(stack)
                return
            if tag not in BLOCKS and open_tag in BLOCKS:
                return  # formatting does not close what holds it


NAMES = (
    "depth", "log_text", "links", "elements", "against", "for", "above_against", "above_for", "tag_against", "tag_for",
    "above_tag_against", "above_tag_for", "is_p", "is_heading", "is_list", "is_table", "is_box", "place", "log_siblings",
    "of_parent", "of_page", "log_paragraphs", "punctuation", "alike", "inputs", "inside_links",
)
PUNCTUATION = re.compile(r"[.,;:!?]")


def features(page: Page) -> np.ndarray:
    """One row per element: subtree density, attribute words, depth and sibling statistics."""
    n = len(page.tags)
    parents = np.array(page.parents)
    own = np.zeros(n)
    marks = np.zeros(n)
    for node, text in page.runs:
        if text:
            own[node] += len(text) - text.count(" ")
            marks[node] += len(PUNCTUATION.findall(text))
    tags = page.tags
    link = np.array([t == "a" for t in tags])
    p = np.array([t == "p" for t in tags], float)
    inputs = np.array([t in ("input", "button", "select", "textarea") for t in tags], float)
    tag_against = np.array([t in TAGS_AGAINST for t in tags], float)
    tag_for = np.array([t in TAGS_FOR for t in tags], float)
    against, for_ = np.array(page.against, float), np.array(page.for_, float)
    depth = np.zeros(n)
    above = np.zeros((4, n))
    inside_link = link.copy()
    for i in range(1, n):
        up = parents[i]
        depth[i] = depth[up] + 1
        above[:, i] = np.maximum(above[:, up], (against[up], for_[up], tag_against[up], tag_for[up]))
        inside_link[i] |= inside_link[up]
    sums = np.stack([own, np.where(inside_link, own, 0.0), np.ones(n), p, marks, inputs])
    for i in range(n - 1, 0, -1):
        sums[:, parents[i]] += sums[:, i]
    text, linked, elements, paragraphs, punctuation, fields = sums
    siblings = np.bincount(parents[1:], minlength=n)
    seen = np.zeros(n)
    place = np.zeros(n)
    kinds: dict[tuple[int, str], int] = {}
    for i in range(1, n):
        place[i] = seen[parents[i]]
        seen[parents[i]] += 1
        kinds[parents[i], tags[i]] = kinds.get((parents[i], tags[i]), 0) + 1
    around = np.ones(n)
    around[1:] = siblings[parents[1:]]
    alike = np.array([1] + [kinds[parents[i], tags[i]] for i in range(1, n)]) / around
    up_text = np.ones(n)
    up_text[1:] = text[parents[1:]]
    has = np.maximum(text, 1)
    return np.stack(
        [
            depth, np.log1p(text), linked / has, elements * 100 / has, against, for_, above[0], above[1], tag_against,
            tag_for, above[2], above[3], p, np.array([t in HEADINGS for t in tags], float),
            np.array([t in ("ul", "ol", "li", "dl") for t in tags], float),
            np.array([t in ("table", "tr", "td", "th") for t in tags], float),
            np.array([t in ("div", "section") for t in tags], float),
            place / around, np.log1p(around), text / np.maximum(up_text, 1), text / max(text[0], 1), np.log1p(paragraphs),
            punctuation * 100 / has, alike, fields, inside_link.astype(float),
        ],
        axis=1,
    )
