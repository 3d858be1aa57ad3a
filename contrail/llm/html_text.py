"""Operator 5: main text of web pages by tree scoring.

Method
------
Pages are dealt out by Spark and each is handled by itself. ``parse`` builds a
tolerant element tree (unclosed ``p`` and ``li``, void elements, raw text of
scripts, truncated pages). Elements that hold no article by their tag, role,
``hidden`` mark or class and id words are set aside. Each paragraph (text that
stands directly in a block) passes points to its ancestors: 1, plus one for
each comma, plus one for each 100 characters up to 3; the parent gets all of
them, the grandparent half, the next a third of that and so on. A container's
points are discounted by its link density, and the best one is the article; it
is widened to an ``article`` or ``main`` element around it. Siblings with a
fifth of its points, or that are long paragraphs with few links, are kept too.
Lists and boxes in it that are mostly links are left out.

Result: the kept blocks in page order joined by one ``\\n``, white space inside a
block turned into one blank. Cases: a null or empty page, or one without text,
gives an empty string; very deep or long pages are walked without recursion, each
element a fixed number of times (sums go up from children to parents in one walk);
every row is handled by itself, so nulls and repeated rows in the other columns
do no harm; columns other than ``page_id``, ``url`` and ``html`` are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>|<[!?][^>]*+(?:>|\Z)", re.S)
HINT = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: A start tag of these ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split())
#: Of these, a start tag ends an open one of the group in the same parent.
ENDS_PEER = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table tr tbody thead body html article section div main aside".split())
ASIDE = frozenset(
    "head nav header footer aside form menu dialog button select datalist template svg canvas object video audio map".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
OFF = re.compile(
    r"(?<![a-z])(?:ad|ads|adv|advert\w*|adsense|banner\w*|breadcrumb\w*|byline-share|combx|comment\w*|community|consent\w*|cookie\w*|disqus\w*|extra|feedback|foot|footer\w*|gdpr|header\w*|legal|login\w*|masthead|menu\w*|modal\w*|nav|navbar|navigation|newsletter\w*|notice\w*|notification\w*|outbrain|overlay|pager|pagination|popup\w*|promo\w*|reader-?comments?|related\w*|remark|replies|reply|rss|share\w*|sharing|shoutbox|side|sidebar\w*|signup\w*|skyscraper|social\w*|sponsor\w*|subscri\w*|taboola|toc|toolbar|widget\w*)(?![a-z])", re.I)
ON = re.compile(r"(?<![a-z])(?:article\w*|body|content|entry|main|post|story|text)(?![a-z])", re.I)
WIDEN = ("article", "main")


class Node:
    __slots__ = ("tag", "parent", "kids", "off", "chars", "linked", "points", "passed")

    def __init__(self, tag: str, parent: Node | None, off: bool = False) -> None:
        self.tag, self.parent, self.off = tag, parent, off
        self.kids: list[Node | str] = []
        self.chars = self.linked = 0
        self.points = self.passed = 0.0  # passed: what of the points below goes up to it


def _set_aside(tag: str, attrs: str, inside: bool) -> bool:
    """Is this element no part of an article? ``inside``: it stands in an article or main element."""
    if tag in ASIDE:
        return not (tag == "header" and inside)
    if not attrs or tag in ("html", "body", *WIDEN):
        return False
    words = ""
    for name, value in HINT.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if name in ("class", "id"):
            words += " " + value.replace("_", "-")
    return bool(OFF.search(words)) and not (ON.search(words) and not re.search(r"comment|sidebar|cookie", words, re.I))


def parse(page: str) -> Node:
    """The element tree; text is kept undecoded as strings among the children."""
    root = node = Node("#root", None)
    at, articles, held = 0, 0, Counter()  # held: open elements by tag
    while m := TOKEN.search(page, at):
        if m.start() > at:
            node.kids.append(page[at:m.start()])
        at = m.end()
        if not (tag := m[2]):
            continue
        tag = tag.lower()
        if m[1]:  # an end tag closes the nearest open element of its name
            if held[tag]:
                while True:
                    closed, node = node, node.parent
                    articles -= closed.tag in WIDEN
                    held[closed.tag] -= 1
                    if closed.tag == tag:
                        break
            continue
        if tag in RAW:  # up to its end tag, whatever stands between
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        closes = ("p",) if tag in ENDS_P else ()
        closes += ENDS_PEER.get(tag, ())
        if any(held[t] for t in closes):
            up = node
            while up is not root and up.tag not in closes and up.tag not in SCOPE:
                up = up.parent
            if up is not root and up.tag in closes:
                while node is not up.parent:
                    held[node.tag] -= 1
                    node = node.parent
        child = Node(tag, node, _set_aside(tag, m[3], articles > 0))
        node.kids.append(child)
        if tag not in VOID and not m[3].endswith("/"):
            node = child
            articles += tag in WIDEN
            held[tag] += 1
    if at < len(page):
        rest = page[at:]
        cut = re.search(r"<[a-zA-Z/!?][^>]*\Z", rest)  # a tag that the page's end cuts off
        node.kids.append(rest[:cut.start()] if cut else rest)
    return root


def _in_order(top: Node) -> Iterator[tuple[Node | str, Node, bool]]:
    """(child, parent, left) below a node in page order: an element comes before (False) and after (True) its own children."""
    stack: list[tuple[Node | str, Node, bool]] = [(k, top, False) for k in reversed(top.kids)]
    while stack:
        kid, parent, left = stack.pop()
        yield kid, parent, left
        if isinstance(kid, Node) and not left and not kid.off:
            stack.append((kid, parent, True))
            stack.extend((k, kid, False) for k in reversed(kid.kids))


def _clean(parts: list[str]) -> str:
    return " ".join(unescape("".join(parts)).split())


def _blocks(top: Node) -> Iterator[tuple[Node, str, int]]:
    """(block element, its text, characters of it in links) of each run of text between block borders."""
    block, parts, links, linked = top, [], 0, 0
    for kid, _, left in _in_order(top):
        if isinstance(kid, str):
            parts.append(kid)
            linked += len(kid) * (links > 0)
        elif kid.off:
            continue
        elif kid.tag in INLINE:
            if kid.tag == "a":
                links += -1 if left else 1
            elif kid.tag == "br":
                parts.append(" ")
        else:
            if parts and (text := _clean(parts)):
                yield block, text, min(linked, len(text))
            parts, linked = [], 0
            block = kid.parent if left else kid
    if parts and (text := _clean(parts)):
        yield block, text, min(linked, len(text))


def _density(n: Node) -> float:
    return n.linked / n.chars if n.chars else 0.0


def main_text(page: str | None) -> str:
    """The article's blocks, joined by ``\\n``."""
    if not page:
        return ""
    root = parse(page)
    best = None
    for block, text, linked in _blocks(root):
        up = (block if block.tag not in ("p", "pre", "li", "td", "h1", "h2", "h3", "h4", "h5", "h6") else block.parent) or block
        block.chars += len(text)
        block.linked += linked
        up.points += 1 + text.count(",") + min(len(text) / 100, 3)
    for kid, _, left in _in_order(root):
        if isinstance(kid, Node) and left:  # its children are done: own points go to the parent by half, passed ones by a third
            up = kid.parent
            up.chars += kid.chars
            up.linked += kid.linked
            own, kid.points = kid.points, kid.points + kid.passed
            up.passed += own / 2 + kid.passed / 3
    for kid, _, left in _in_order(root):
        if isinstance(kid, Node) and not left and not kid.off and kid.points and kid.tag != "html":
            kid.points *= 1 - _density(kid)
            if best is None or kid.points > best.points:
                best = kid
    if best is None:  # no block element at all: bare text
        kept = [root]
    else:
        up = best
        while up is not None:
            if up.tag in WIDEN:
                best = up
            up = up.parent
        parent = best.parent
        kept = [best] if best.tag in ("body", *WIDEN) else [
            k for k in parent.kids if isinstance(k, Node) and not k.off and (
                k is best or k.points >= max(10.0, best.points / 5) and _density(k) < 0.5
                or k.tag == "p" and k.chars > 80 and _density(k) < 0.25)]
        if best.tag in WIDEN:
            kept = [k for k in parent.kids if isinstance(k, Node) and not k.off and (k is best or k.tag == best.tag and k.points >= best.points / 5)]
    out = []
    for top in kept:
        for kid, _, left in _in_order(top):
            if isinstance(kid, Node) and not left and kid.tag in ("ul", "ol", "div", "section", "table", "dl") and kid.chars and _density(kid) > 0.5:
                kid.off = True
        out.extend(text for _, text, _ in _blocks(top))
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each page."""
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [main_text(h.as_py()) for h in b.column("html")]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
