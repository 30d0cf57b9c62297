"""Main text of web pages by tag-path ratios.

A page is read as blocks of text, each with the path of block elements above it.
For every path the text length and the punctuation per block are added up over
the page, smoothed over the blocks in page order, weakened by the share of link
text and fused to one score. Paths over a threshold are content, and so are
headings in front of it; the smallest container that holds all of it is the
article. Blocks of content are kept unless their path is made of links or they
stand in an element for menus, forms, notices, adverts, comments and the like.

An element is of that kind by its tag, or by a word in its class, id or role. A
word counts only where all elements with it hold a minor share of the page's
content, or outside an article or main element that holds enough of it, and never
drops the article or main element with most of the content, nor what that stands in.

Text: character references decoded, white space inside a block made one space
and trimmed, blocks joined by a line feed in page order; ``<br>`` is white space.
Defined results: a null or empty page has the empty text; a page without tags is
one block; elements left open end with their parent; end tags without a start
are skipped; an unclosed script or comment reaches to the end; a quote in a tag that
is never closed is an ordinary character; columns of the
same name as an output column are replaced.
"""

from __future__ import annotations

import html
import re
from math import log, sqrt

from pyspark.sql import DataFrame, types as T

from .common import add_columns

# Elements without content, with raw content, inside lines, and never part of an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style title textarea noscript iframe template svg math object canvas audio video select"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q ruby rb rp rt rtc s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset("head nav header footer aside form button menu dialog fieldset datalist frameset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("html body article main section div td center".split())
#: Words in class, id or role that mark an element as no part of the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs footer sidebar sidebars widget widgets complementary contentinfo search comment "
    "comments commentlist disqus respond reply replies cookie cookies consent gdpr notice notices alert popup modal "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations trending "
    "pagination pager toolbar skip masthead topbar copyright disclaimer".split()
)
#: A path whose smoothed score is below this share of the best one is no content.
THRESHOLD = 0.15
#: A word whose elements hold this share of all content or more marks none of them.
MAJOR = 0.5
#: An article or main element with this share of all content tells apart what is outside it, whatever that holds.
ENOUGH = 0.1
#: A path with this share of link text is a list of links.
LINKS = 0.9

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_QUOTED = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in RAW.split()}
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
_PUNCTUATION = re.compile(r"[.,;:!?。，；：！？、]")
# Start tags that end an open element of the listed kinds.
_CLOSES = {k: frozenset(v.split()) for k, v in {"li": "li p", "dt": "dt dd p", "dd": "dt dd p", "tr": "tr td th p", "td": "td th p", "th": "td th p", "option": "option"}.items()}


class _Element:
    __slots__ = ("tag", "parent", "path", "dropped", "marks", "mass")

    def __init__(self, tag: str, parent: _Element | None, dropped: bool, marks: frozenset = frozenset()):
        self.tag, self.parent, self.dropped, self.marks, self.mass = tag, parent, dropped, marks, 0
        self.path = (parent.path if parent else "") + "/" + tag

    def above(self):
        """The element and all that it stands in."""
        own = self
        while own:
            yield own
            own = own.parent


def _marks(rest: str) -> tuple[bool, frozenset]:
    """Whether attributes hide an element, and the words in them that may mark it as no part of the article."""
    hidden, words = False, set()
    for m in _ATTR.finditer(rest):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden":
            hidden |= value.lower() != "false"
        elif name == "aria-hidden":
            hidden |= value.strip().lower() == "true"
        elif name == "style":
            hidden |= bool(_HIDDEN.search(value))
        elif name in ("class", "id", "role"):
            words.update(w.lower() for w in _WORDS.findall(value))
    return hidden, frozenset(words & MARKS)


def _markup(page: str):
    """(start, end, tag, whether it is an end tag, attributes) of all markup; no tag for comments, declarations and raw elements.

    Tags end at the first ``>`` outside quotes. Once a quote turns out to be
    unclosed, quotes mean nothing in the rest of the page, so no text is read twice.
    """
    at, size, last, quotes = 0, len(page), page.rfind(">"), True
    while (start := page.find("<", at)) >= 0:
        at = start + 1
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            yield start, at, None, False, ""
        elif start > last:
            return
        elif name := _NAME.match(page, start):
            whole = _QUOTED.match(page, name.end()) if quotes else None
            quotes = whole is not None
            end = whole.end() if whole else page.find(">", name.end()) + 1
            tag, at = name[2].lower(), end
            if tag in _RAW_END and not name[1]:
                close = _RAW_END[tag].search(page, end)
                at = close.end() if close else size
                yield start, at, None, False, ""
            else:
                yield start, at, tag, bool(name[1]), page[name.end() : end - 1]
        elif page[start + 1 : start + 2] in ("!", "?", "/"):
            at = page.find(">", start) + 1
            yield start, at, None, False, ""


def blocks(page: str) -> list[tuple[_Element, str, int]]:
    """(element, text, characters of it inside links) of every block that is not in a dropped element."""
    root = _Element("", None, False)
    stack, out, text, linked = [root], [], [], [0, 0]  # linked: depth of links, characters

    def flush():
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined and not stack[-1].dropped:
                out.append((stack[-1], joined, min(linked[1], len(joined))))
            text.clear()
            linked[1] = 0

    def add(part: str):
        if part and not stack[-1].dropped:
            text.append(part)
            if linked[0] > 0:
                linked[1] += len(part)

    at = 0
    for start, end, tag, ends, rest in _markup(page):
        add(page[at:start])
        at = end
        if tag is None:
            continue
        if tag in INLINE:
            if tag == "br":
                add(" ")
            elif tag == "a":
                linked[0] = 0 if ends else 1
            elif not ends and rest and stack[-1].tag not in INLINE and any(marks := _marks(rest)) and not rest.endswith("/"):
                flush()
                stack.append(_Element(tag, stack[-1], stack[-1].dropped or marks[0], marks[1]))
            elif ends and stack[-1].tag == tag:
                flush()
                stack.pop()
            continue
        flush()
        linked[0] = 0
        if ends:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if stack[depth].dropped and not stack[depth - 1].dropped and tag in INLINE:
                    break
        elif tag not in VOID:
            closes = _CLOSES.get(tag)
            while len(stack) > 1 and (stack[-1].tag in INLINE or stack[-1].tag == "p" or closes and stack[-1].tag in closes):
                stack.pop()
            if rest.endswith("/") and tag not in CONTAINERS:
                continue
            above = stack[-1]
            inside = any(e.tag in ("article", "main") for e in stack) if tag == "header" else False
            hidden, marks = _marks(rest) if rest and tag not in ("html", "body") else (False, frozenset())
            stack.append(_Element(tag, above, above.dropped or (tag in DROPPED and not inside) or hidden, marks))
        elif tag in VOID:
            add(" ")
    add(page[at:])
    flush()
    return out


def _content(found: list) -> list[bool]:
    """Of each block, whether its path's score passes the threshold and the path is no list of links."""
    sums: dict[str, list[float]] = {}
    for element, text, linked in found:
        s = sums.setdefault(element.path, [0, 0, 0, 0])
        s[0] += 1
        s[1] += len(text)
        s[2] += len(_PUNCTUATION.findall(text))
        s[3] += linked
    ratio = {p: sqrt(chars / n * (1 + marks / n)) * (1 - links / chars) for p, (n, chars, marks, links) in sums.items()}
    row = [ratio[e.path] for e, _, _ in found]
    smooth = [(a + 2 * b + c) / 4 for a, b, c in zip([row[0], *row], row, [*row[1:], row[-1]])]
    fused: dict[str, float] = {}
    for (element, _, _), s in zip(found, smooth):
        n, _, marks, links = sums[element.path]
        own = s * log(2 + marks / n) if links < LINKS * sums[element.path][1] else 0.0
        fused[element.path] = fused.get(element.path, 0.0) + own / n
    bar = THRESHOLD * max(fused.values())
    links = {p for p, (n, chars, _, linked) in sums.items() if linked >= LINKS * chars and n > 1}
    return [fused[e.path] >= bar and e.path not in links for e, _, _ in found]


def _unmarked(found: list) -> list:
    """The blocks without those in elements that a word of their attributes marks."""
    if not any(e.marks for element, _, _ in found for e in element.above()):
        return found
    total, held, main = 0, {}, None
    for (element, text, _), passes in zip(found, _content(found)):
        if not passes:
            continue
        total += len(text)
        for word in {w for e in element.above() for w in e.marks}:
            held[word] = held.get(word, 0) + len(text)
        for e in element.above():
            e.mass += len(text)
            if e.tag in ("article", "main") and (main is None or e.mass > main.mass):
                main = e
    spared = set(map(id, main.above())) if main else set()
    apart = main is not None and main.mass >= ENOUGH * total

    def minor(e: _Element) -> bool:
        if not e.marks or id(e) in spared:
            return False
        return apart and main not in e.above() or any(held.get(w, 0) < MAJOR * total for w in e.marks)

    gone: dict[int, bool] = {}

    def dropped(e: _Element | None) -> bool:
        steps = []
        while e and id(e) not in gone:
            steps.append(e)
            e = e.parent
        out = bool(e) and gone[id(e)]
        for e in reversed(steps):
            out = gone[id(e)] = out or minor(e)
        return out

    return [b for b in found if not dropped(b[0])] if total else found


def extract(page: str | None) -> str:
    """The article text of one page."""
    found = _unmarked(blocks(page or ""))
    if not found:
        return ""
    passes = _content(found)
    for i in range(len(found) - 2, -1, -1):  # a heading goes with what it stands before
        passes[i] |= found[i][0].tag in HEADINGS and passes[i + 1] and found[i][2] < LINKS * len(found[i][1])
    return "\n".join(text for (_, text, _), kept in zip(found, passes) if kept)


def extract_text(df: DataFrame, source: str = "html", text: str = "text") -> DataFrame:
    """Add the article text of each page; rows do not move."""
    return add_columns(df, lambda: lambda pages: {text: [extract(x) for x in pages]}, source, **{text: T.StringType()})
