"""A small forgiving HTML reader: elements, their text, and where blocks begin."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp".split())
#: Their text is never part of a page's text.
HIDDEN = RAW | frozenset("head svg math button select option datalist object canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br caption".split())
# What an opening tag closes, and the elements that the search for it does not leave.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table html body article main section aside nav div header footer form menu".split())
_ENDS_P = BLOCK - {"br", "html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "summary", "caption"}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?", re.S)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)")
_PLAIN = re.compile(r"""[^>"'=]*+(?:=\s*+)?""")
_ATTRIBUTE = re.compile(r"""([^\s/=]++)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]*+))?""")
_USED = frozenset("class id role itemprop aria-label data-role hidden style".split())
_TOKEN = re.compile(r"[a-z]+")


class Element:
    __slots__ = ("tag", "parent", "children", "parts", "tokens", "hidden", "at")

    def __init__(self, tag: str, parent: "Element | None", attributes: str = ""):
        self.tag, self.parent, self.children, self.parts = tag, parent, [], []
        self.tokens: frozenset[str] = frozenset()
        self.hidden = tag in HIDDEN
        self.at = 0
        if attributes:
            found = [(k.lower(), v.strip("\"'")) for k, v in _ATTRIBUTE.findall(attributes) if k.lower() in _USED]
            named = " ".join(v for k, v in found if k not in ("style", "hidden"))
            named = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", named).lower()
            self.tokens = frozenset(_TOKEN.findall(named))
            self.hidden |= any(k == "hidden" or k == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v, re.I) for k, v in found)


def _tag_end(html: str, at: int, last: int) -> int:
    """The ">" that ends a tag whose attributes begin here: the first one outside quoted values; -1 if none follows.

    A quote opens a value only after "="; one that is not closed before the last ">" of the page stands for itself, so that
    a ">" is always found and nothing is read twice.
    """
    while at < last:
        m = _PLAIN.match(html, at)
        at = m.end()
        c = html[at] if at < len(html) else ">"
        if c in "\"'" and m.group().rstrip().endswith("=") and at < (close := html.find(c, at + 1, last)):
            at = close
        elif c == ">":
            break
        at += 1
    return at if at <= last else -1


def parse(html: str) -> list[Element]:
    """All elements in page order, the root first.  An element's parts are its texts (str) and child elements."""
    root = Element("html", None)
    out, top, at = [root], root, 0
    open_tags: Counter[str] = Counter()

    def text(piece: str) -> None:
        if piece:
            top.parts.append(unescape(piece))

    def leave(to: Element) -> None:
        nonlocal top
        while top is not to:
            open_tags[top.tag] -= 1
            top = top.parent

    def close(tags: tuple[str, ...], stop: frozenset[str] = frozenset()) -> None:
        if not any(open_tags[t] for t in tags):  # a stray end tag costs no walk to the root
            return
        e = top
        while e is not root:
            if e.tag in tags:
                leave(e.parent)
                return
            if e.tag in stop:
                return
            e = e.parent

    n = len(html)
    last = html.rfind(">")
    while at < n:
        begin = html.find("<", at)
        if begin < 0 or begin > last and not html.startswith("<!--", begin):
            break
        m = _NAME.match(html, begin)
        end = _tag_end(html, m.end(), last) if m else -1
        if m and end < 0 or not m and not (markup := _MARKUP.match(html, begin)):
            text(html[at : begin + 1])
            at = begin + 1
            continue
        text(html[at:begin])
        if not m:
            at = markup.end()
            if markup.group().startswith("<![CDATA["):
                text(markup.group()[9:].removesuffix("]]>"))
            continue
        attributes, at = html[m.end() : end], end + 1
        tag = m.group(2).lower()
        if m.group(1):
            if tag == "br":
                top.parts.append("\n")
            elif tag != "html" and tag != "body":
                close((tag,), frozenset() if tag in BLOCK else frozenset(("td", "th", "article", "main")))
            continue
        if tag == "html" or tag == "body" and any(e.tag == "body" for e in out[:8]):
            continue
        if tag in _ENDS_P:
            close(("p",), _SCOPE | {"td", "th", "li", "blockquote"})
        if tag in _CLOSES:
            close(_CLOSES[tag], _SCOPE - {"div"} if tag == "li" else _SCOPE)
        if tag in ("body", "nav", "header", "main", "article", "div") and top.tag == "head":
            leave(root)
        element = Element(tag, top, attributes)
        element.at = len(out)
        top.children.append(element)
        top.parts.append(element)
        out.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else n
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            top = element
            open_tags[tag] += 1
    text(html[at:])
    return out


def own_texts(elements: list[Element]) -> list[str]:
    """For each element, its own text with that of inline descendants left out."""
    return [" ".join(p for p in e.parts if isinstance(p, str)) for e in elements]


def text_of(elements: list[Element], keep: list[bool]) -> str:
    """Texts of kept elements in page order: one space for white space, blocks joined by one space.

    keep: by element; hidden elements and what they hold are never kept.
    """
    pieces: list[str] = []
    stack: list[object] = [elements[0]]
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            pieces.append(part)
        elif keep[part.at] and not part.hidden:
            block = part.tag in BLOCK
            inside = part.parts
            if block:
                stack.append("\n")
            for p in reversed(inside):
                stack.append(p)
            if block:
                stack.append("\n")
    return " ".join("".join(pieces).split())
