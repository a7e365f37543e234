"""Main text of web pages by a minimum cut.

A page is cut into text blocks. A linear classifier gives each block a cost
for being called content and one for being called boilerplate; they become the
capacities to the two terminals. Neighbouring blocks, and blocks under the
same parent, are tied by smoothness edges. The minimum cut (Dinic's maximum
flow) is the labelling of least total cost.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mallscope.llm.common import in_arrow, sub_batches, text_bytes

_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9-]*)")
# what can end a tag or a stretch of it
_EVENT = re.compile("[<>\"']")
# raw text goes with its tags and, like a comment, runs to the end of the page
# without an end
_RAW = {tag: re.compile(f"</{tag}\\s*>", re.I) for tag in ("script", "style", "textarea")}
# elements that are passed over whole if they have an end tag; a head needs none,
# what it may hold shows no text
_SKIPPED = frozenset("title noscript template iframe svg select object".split())
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|itemprop|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_WORDS = re.compile(r"[a-z]+")

_BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption address fieldset legend form nav header footer aside menu dialog "
    "details summary hr center hgroup search".split())
_VOID = frozenset("hr br img input meta link source area base col embed track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset button search header".split())
_BOILER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert newsletter subscribe subscription signup login popup modal overlay share "
    "sharing social menu nav navbar navigation navigational breadcrumb breadcrumbs pagination pager sidebar widget "
    "widgets related recommended recommendations comment comments reply replies respond disqus footer masthead "
    "topbar copyright complementary contentinfo search toolbar skip outbrain taboola teaser".split())
_CONTENT_NAMES = frozenset("article articlebody main content post entry story text body prose".split())
# elements whose own names say nothing against what they hold
_ROOTS = frozenset("html body article main".split())


class _Node:
    """An open block element and what its ancestors say."""
    __slots__ = ("tag", "tagged", "named", "inside", "content", "hidden", "number")

    def __init__(self, tag, up, attrs, number):
        names = set()
        hidden = up.hidden if up else False
        if attrs:
            for name, value in _ATTR.findall(attrs):
                name, value = name.lower(), value.strip("\"'").lower()
                if name in ("class", "id", "role", "itemprop"):
                    names.update(_WORDS.findall(value))
                elif name == "hidden" or name == "aria-hidden" and value == "true" or (
                        name == "style" and "display:none" in value.replace(" ", "")):
                    hidden = True
        named = tag not in _ROOTS and bool(names & _BOILER_NAMES)
        tagged = tag in _BOILER_TAGS
        if tag == "header" and up and up.content and not named:
            tagged = False      # the heading of the article itself
        self.tag, self.number, self.hidden = tag, number, hidden
        self.tagged = bool(up and up.tagged) or tagged
        self.named = bool(up and up.named) or named
        self.inside = bool(up and up.inside) or tag in ("article", "main")
        if self.inside and not (up and up.inside):
            self.named = False  # names of wrappers around the article say nothing against it
        self.content = bool(up and up.content) or tag in ("article", "main") or bool(names & _CONTENT_NAMES)

    @property
    def boiler(self):
        return self.tagged or self.named


def _tag_end(html: str, at: int) -> int:
    """Where a tag ends whose name ends at ``at``; -1 if it is no tag.

    A quote counts after an equals sign. A ``<`` outside quotes says that the
    tag before it was none (``a <b and c``); every stretch is looked at once.
    """
    while True:
        m = _EVENT.search(html, at)
        if m is None or m.group() == "<":
            return -1
        if m.group() == ">":
            return m.end()
        at, k = m.end(), m.start() - 1
        # white space between the sign and the quote: a short look back
        while k >= 0 and html[k] in " \t\r\n" and m.start() - k < 8:
            k -= 1
        if k >= 0 and html[k] == "=":
            close = html.find(m.group(), at)
            if close >= 0:
                at = close + 1


def _marks(html: str) -> list[tuple[int, int, str, bool, str]]:
    """(start, end, element, whether an end tag, attributes) of the markup in
    page order; comments, raw text and declarations have no element."""
    out = []
    at, last = html.find("<"), html.rfind(">")
    while at >= 0:
        end, tag, closing, attrs = -1, "", False, ""
        m = _NAME.match(html, at)
        if m:
            end = _tag_end(html, m.end())
            if end >= 0:
                tag, closing, attrs = m.group(2).lower(), bool(m.group(1)), html[m.end():end - 1]
                if tag in _RAW and not closing and attrs[:1] in ("", "/", " ", "\t", "\r", "\n", "\f"):
                    close = _RAW[tag].search(html, end)
                    end, tag, attrs = close.end() if close else len(html), "", ""
        elif html.startswith("<!--", at):
            close = html.find("-->", at + 4)
            end = close + 3 if close >= 0 else len(html)
        elif html[at + 1:at + 2] in ("!", "?") and at < last:
            end = html.find(">", at) + 1
        if end >= 0:
            out.append((at, end, tag, closing, attrs))
        at = html.find("<", max(end, at + 1))
    return out


def _ends(marks: list[tuple[int, int, str, bool, str]]) -> dict[int, int]:
    """Start of each element to be passed over -> end of its end tag."""
    ends: dict[int, int] = {}
    open_: dict[str, list[int]] = {tag: [] for tag in _SKIPPED}
    for start, end, tag, closing, attrs in marks:
        if tag not in _SKIPPED:
            continue
        if not closing:
            if tag != "svg" or not attrs.endswith("/"):
                open_[tag].append(start)
        elif open_[tag]:
            ends[open_[tag].pop()] = end
    return ends


def blocks(html: str) -> list[tuple[str, _Node, int]]:
    """(text, parent element, characters inside links) in page order.

    Work grows with the page: each character is scanned a bounded number of
    times, an end tag without a start costs nothing.
    """
    stack = [_Node("html", None, "", 0)]
    depth = Counter()           # open elements above the root, by name
    out: list[tuple[str, _Node, int]] = []
    parts: list[str] = []
    linked = made = 0
    in_link = in_button = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append((text, stack[-1], linked))
            parts.clear()
        linked = 0

    at = 0
    marks = _marks(html)
    ends = _ends(marks)
    for start, end, tag, closing, attrs in marks:
        if start < at:
            continue
        if start > at and not in_button:
            parts.append(html[at:start])
            if in_link:
                linked += start - at
        at = end
        if not tag:
            continue
        if tag not in _BLOCKS:
            if tag in _SKIPPED:
                at = ends.get(start, at)
            elif tag == "br" or tag in ("td", "option"):
                parts.append("\n")
            elif tag == "a":
                in_link = 0 if closing else 1
            elif tag == "button":
                in_button = 0 if closing else 1
            continue
        flush()
        in_link = in_button = 0
        if closing:
            while depth[tag]:
                last = stack.pop().tag
                depth[last] -= 1
                if last == tag:
                    break
            continue
        # a block element ends an open paragraph, an item ends an open item
        if stack[-1].tag == "p" or stack[-1].tag in _HEADINGS and tag in _HEADINGS or (
                tag in ("li", "dt", "dd", "tr", "td", "th") and stack[-1].tag == tag):
            depth[stack.pop().tag] -= 1
        if tag not in _VOID:
            made += 1
            depth[tag] += 1
            stack.append(_Node(tag, stack[-1], attrs, made))
    if at < len(html) and not in_button:
        parts.append(html[at:])
    flush()
    return out


def content_score(text: str, node: _Node, linked: int) -> float:
    """The classifier: over 0 for content, a larger size for more certainty."""
    if node.hidden:
        return -12.0
    score = -0.6
    score += 3.5 if node.content else 0.0
    score -= 9.0 if node.boiler else 0.0
    words = text.count(" ") + 1
    score += min(words, 40) * 0.06
    if text[-1] in ".!?\"”»:…":
        score += 0.4
    if node.tag in ("p", "blockquote", "pre"):
        score += 0.5
    elif node.tag in _HEADINGS:
        score += 0.3
    score -= 3.0 * min(1.0, linked / max(1, len(text)))
    if "©" in text[:40] or text[:9].lower() == "copyright":
        score -= 3.0
    return score


def min_cut(score: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source's side of a minimum cut.

    ``score`` over 0 is capacity from the source, below 0 to the sink; an
    edge carries its weight either way.
    """
    n = len(score)
    if min(score, default=0) >= 0 or max(score) <= 0:
        return [max(score) > 0] * n if n else []
    supply = [max(s, 0.0) for s in score]
    demand = [max(-s, 0.0) for s in score]
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for a, b, w in edges:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to += [b, a]
        room += [w, w]
    tiny = 1e-9
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if supply[i] > tiny)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            reached = reached or demand[i] > tiny
            for e in out[i]:
                j = to[e]
                if room[e] > tiny and level[j] < 0:
                    level[j] = level[i] + 1
                    queue.append(j)
        if not reached:
            return [x >= 0 for x in level]
        nth = [0] * n
        for s in range(n):
            while supply[s] > tiny and level[s] == 0:
                path, i = [], s
                while demand[i] <= tiny:
                    while nth[i] < len(out[i]):
                        e = out[i][nth[i]]
                        if room[e] > tiny and level[to[e]] == level[i] + 1:
                            break
                        nth[i] += 1
                    else:
                        if not path:
                            break
                        i = to[path.pop() ^ 1]
                        nth[i] += 1
                        continue
                    path.append(e)
                    i = to[e]
                if demand[i] <= tiny:
                    break
                flow = min([supply[s], demand[i], *(room[e] for e in path)])
                supply[s] -= flow
                demand[i] -= flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def label_blocks(found: list[tuple[str, _Node, int]], near: float = 0.4, sibling: float = 0.5) -> list[bool]:
    """Content or not, per block: ``near`` ties neighbours in page order,
    ``sibling`` ties a block to the last one under the same parent."""
    score = [content_score(*b) for b in found]
    edges, last = [], {}
    for i, (_, node, _) in enumerate(found):
        if i:
            edges.append((i - 1, i, near))
        if node.number in last:
            edges.append((last[node.number], i, sibling))
        last[node.number] = i
    return min_cut(score, edges)


def page_text(html: str) -> str:
    """The content blocks of one page, joined by line feeds."""
    found = blocks(html)
    return "\n".join(b[0] for b, keep in zip(found, label_blocks(found), strict=True) if keep)


def _extract_task(batches):
    for batch in sub_batches(batches, "html"):
        texts = [page_text(h.decode("utf-8", "replace")) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, type=pa.string()),
             pa.array([len(t) for t in texts], type=pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points), one row per row of ``pages``.

    A null or empty html, or a page without content, gives an empty text; a
    ``<`` that starts no tag is text, however often it occurs; null ids and urls stay null; rows that repeat are extracted each; an
    empty table gives no rows. Other columns are not read.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        text_bytes("html").alias("html"))
    return in_arrow(rows, _extract_task, "page_id bigint, url string, text string, n_chars bigint")
