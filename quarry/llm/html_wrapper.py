"""HTML extraction by union-free wrappers, one inferred from all pages of a host.

A page is a row of blocks: texts between block elements, in the tree of the block
elements above them. A wrapper is a union-free expression over such trees: elements,
optional groups, repeated groups and text slots. Two wrappers are aligned: texts that are equal
stay fixed, texts that differ become slots, tags that differ become repeated groups
(alike neighbours) or optional groups. A slot keeps the texts that all pages with it have there
(in a repeated group: at any of its places): these are the host's template, if two different
pages at least are its witnesses. All other blocks fill slots. A page's main text
are its slots in the article (``article``, else ``main`` or an element that says so,
else the body).

Siblings that are too many to align (``_CELLS``, ``_SIBLINGS``) are generalised to a repeated group of
optional elements, one for each name, which any row of them fits; all their texts take part.

Element names and class words only decide what the wrapper leaves open: slots
under a menu, header, footer, sidebar, notice, advert, form, script, style or
comment section are left out. A class, id or role counts as a whole (all its words
must be listed), and an element that holds most of the article's slots is
never left out. Inside ``article`` and ``main``, a template that would take half
of the element's text or more is not believed (copies of one article); a
page of which nothing is left keeps the texts that names and words alone allow.

Each task aligns its pages to one wrapper a host, whose size follows the host's markup and not
its number of pages; these are merged by (host,
salt) and then by host, streaming, so a host with a third of all pages is
many small merges. All pages take part. Wrappers are joined to the pages by
host; Spark broadcasts them only below its size threshold.

Defined results: null html counts as empty (empty text, 0 characters); a null
url has the empty host; pages without any element are text of the body; rows
that repeat are extracted each, and are one witness; an empty table gives no rows.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.tokens import texts_of
from quarry.llm.url_filter import host_path

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|</([a-zA-Z][^\s/>]*)[^>]*>"
                    r"|<([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>|<[a-zA-Z!?/][^>]*\Z|[^<]+|<", re.S)
_MARK = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[a-z]+")

# HTML's element kinds.
RAW = {"script", "style", "textarea", "iframe", "noframes", "xmp", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2",
            "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
ITEMS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
         "option": {"select"}}
BOILERPLATE = {"nav", "footer", "aside", "form", "script", "style", "noscript", "iframe", "button", "select", "textarea",
               "template", "head", "title", "svg", "menu", "dialog", "object", "noframes", "xmp"}
BOILERPLATE_MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
                     "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "masthead",
                     "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup",
                     "promo", "promoted", "related", "reply", "replies", "share", "sharing", "sidebar", "signup", "social",
                     "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget", "complementary", "contentinfo",
                     "search"}
ARTICLE_MARKS = {"article", "content", "main", "post", "story", "entry"}
PLAIN_MARKS = {"area", "bar", "block", "body", "bottom", "box", "container", "global", "inner", "left", "links", "list", "main",
               "outer", "page", "primary", "right", "secondary", "section", "site", "text", "top", "wrap", "wrapper"}
COMMENT_MARKS = {"comment", "comments", "disqus", "reply", "replies"}
NEVER = RAW | {"head", "noscript", "template", "svg", "object", "select", "button"}  # of BOILERPLATE: no text of the page's own

_FOLD = 6  # longest group, in items, that is looked for when repeats are folded
_DEPTH = 48  # the elements below stand in a wrapper as one, by all their names
_CELLS, _SIBLINGS = 400, 24  # siblings with more pairs to align, or more in the result, are generalised without their order


def tokens(source: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest) of a page: 'open' with its marks, 'close', 'text'."""
    at, n = 0, len(source)
    while at < n:
        m = _TOKEN.match(source, at)
        at = m.end()
        name = m.group(1) or m.group(4)
        if name:
            name = name.lower()
            attributes = m.group(2) if m.group(1) else m.group(5)
            marks = " ".join(sorted({w for x in _MARK.finditer(attributes) for w in
                                     _DIGITS.sub("", (x.group(2) or x.group(3) or x.group(4) or "").lower()).split()})) \
                if "=" in attributes else ""
            yield "open", name, marks
            if attributes.rstrip().endswith("/") and name not in INLINE and name not in CLOSES_P:
                if name not in VOID:
                    yield "close", name, ""
            elif name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
                if at < (end.start() if end else n):
                    yield "text", "", source[at:end.start() if end else n]
                at = end.end() if end else n
                yield "close", name, ""
        elif m.group(3):
            yield "close", m.group(3).lower(), ""
        elif (text := m.group(0))[0] != "<" or text == "<":
            yield "text", "", text


class Walker:
    """The elements open at a place of the stream, with HTML's implied ends."""

    def __init__(self):
        self.path: list[tuple[str, str]] = []  # (name, name and marks)

    def open(self, name: str, marks: str) -> None:
        names = [x[0] for x in self.path]
        if name in CLOSES_P and "p" in names:
            del self.path[len(names) - 1 - names[::-1].index("p"):]
        elif name in ITEMS:
            for i in range(len(names) - 1, -1, -1):
                if names[i] in ITEMS[name]:
                    break
                if names[i] == name or {names[i], name} <= {"dt", "dd"} or {names[i], name} <= {"td", "th"}:
                    del self.path[i:]
                    break
        if name not in VOID:
            self.path.append((name, f"{name} {marks}" if marks else name))

    def close(self, name: str) -> None:
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i][0] == name:
                del self.path[i:]
                return


# A wrapper is a tuple of items: "#" (a text slot of which nothing else is kept), ("t", (least, most, *texts)) a text
# slot with the least and the greatest hash of the pages that have it and the texts, as hashes, that all of these
# have there, or a pair of a kind and a tuple: ("=", (element, *items)) an element, ("?", items) an optional group,
# ("+", items) a repeated group.

def fold(items: tuple) -> tuple:
    """Repeats next to each other become repeated groups."""
    out = list(items)
    for size in range(1, min(_FOLD, len(out)) + 1):
        i = 0
        while i + size <= len(out):
            body = tuple(out[i:i + size])
            group = body[0][1] if size == 1 and body[0][0] == "+" else body
            j = i + size
            while tuple(out[j:j + size]) == body or out[j:j + 1] == [("+", group)]:
                j += size if tuple(out[j:j + size]) == body else 1
            if j > i + size:
                out[i:j] = [("+", group)]
            i += 1
    return tuple(out)


def stream(source: str) -> tuple:
    """A page's elements and text slots, folded."""
    walker, open_ = Walker(), [["", []]]  # (element, items so far) from the page down

    def leave(depth: int) -> None:
        while len(open_) > depth + 1:
            element, items = open_.pop()
            open_[-1][1].append(("=", (element, *fold(tuple(items)))))

    for kind, name, rest in tokens(source):
        if kind == "text":
            if rest.strip() and open_[-1][1][-1:] != ["#"]:
                open_[-1][1].append("#")
            continue
        before = list(walker.path)
        if kind == "open":
            walker.open(name, rest)
        else:
            walker.close(name)
        same = 0
        while same < min(len(before), len(walker.path)) and before[same] is walker.path[same]:
            same += 1
        leave(same)
        for _, element in walker.path[len(open_) - 1:_DEPTH]:
            open_.append([element, []])
    leave(0)
    return fold(tuple(open_[0][1]))


def _bare(item) -> tuple:
    """The items of an optional or repeated group, else the item itself."""
    while item[0] in "?+" and (item[0] == "+" or len(item[1]) == 1):
        if len(item[1]) > 1:
            return item[1]
        item = item[1][0]
    return (item,)


def _alike(p, q) -> bool:
    """Items that one item can stand for: slots, the same element, groups that begin and end so."""
    if p[0] == q[0] and p[0] in "=t":
        return p[0] == "t" or p[1][0] == q[1][0]
    if p == q:
        return True
    a, b = _bare(p), _bare(q)
    if len(a) == len(b) == 1:
        a, b = a[0], b[0]
        return a == b or a[0] == b[0] == "t" or a[0] == b[0] == "=" and a[1][0] == b[1][0]
    return len(a) > 1 and len(b) > 1 and _alike(a[0], b[0]) and _alike(a[-1], b[-1])


def _unsure(item):
    """The item without the texts of its slots."""
    if isinstance(item, str):
        return item
    return ("t", item[1][:2]) if item[0] == "t" else (item[0], tuple(_unsure(x) for x in item[1]))


def _kinds(item) -> set[str]:
    kinds = set()
    while item[0] in "?+" and len(item[1]) == 1:
        kinds.add(item[0])
        item = item[1][0]
    return kinds | {item[0]}


def _join(p, q, within: bool = False):
    """One item for two that are alike: their contents aligned, repeated or optional if one of them is.
    ``within``: both are on the same pages, which have the texts of either (an optional one's are not sure)."""
    if p[0] == q[0] == "=":
        return ("=", (p[1][0], *align(p[1][1:], q[1][1:], within)))
    if p[0] == q[0] == "t":
        x, y = p[1], q[1]
        texts = x[2:] if x[2:] == y[2:] else sorted(set(x[2:]) | set(y[2:]) if within else set(x[2:]) & set(y[2:]))
        return ("t", (min(x[0], y[0]), max(x[1], y[1]), *texts))
    if p == q and not (within and p[0] == "?"):
        return p
    one, two = _kinds(p), _kinds(q)
    if within:
        p, q = (_unsure(x) if "?" in kinds else x for x, kinds in ((p, one), (q, two)))
    kinds = one | two if not within or one & two & {"?"} else (one | two) - {"?"}
    a, b = _bare(p), _bare(q)
    if len(a) == len(b) == 1:
        both = a if a == b else (_join(a[0], b[0], within),)
    else:
        both = align(a, b, within)
    if "+" in kinds:
        both = (("+", both),)
    if "?" in kinds and both[0][0] != "?":
        return ("?", both)
    return both[0] if len(both) == 1 else ("+", both)


def runs(items: tuple) -> tuple:
    """Alike items (or groups of them) next to each other become repeated groups, with the texts of all."""
    out = list(items)
    for size in range(1, min(_FOLD, len(out) // 2) + 1):
        i = 0
        while i + 2 * size <= len(out):
            if all(_alike(out[i + k], out[i + size + k]) for k in range(size)):
                if size == 1:
                    joined = _join(out[i], out[i + 1], True)
                    out[i:i + 2] = [joined if "+" in _kinds(joined) else ("+", (joined,))]
                else:
                    body = tuple(_join(out[i + k], out[i + size + k], True) for k in range(size))
                    while len(out) >= i + 3 * size and all(_alike(body[k], out[i + 2 * size + k]) for k in range(size)):
                        body = tuple(_join(body[k], out[i + 2 * size + k], True) for k in range(size))
                        del out[i + 2 * size:i + 3 * size]
                    out[i:i + 2 * size] = [("+", body)]
            else:
                i += 1
    return tuple(out)


def _any_order(items: tuple) -> tuple:
    """The items as one repeated group of optional ones, one for each element or slot, by name."""
    found: dict[str, tuple] = {}

    def add(item, sure: bool) -> None:
        if item[0] in "?+":
            for x in item[1]:
                add(x, sure and item[0] != "?")
            return
        name = item[1][0] if item[0] == "=" else "#"
        item = item if sure else _unsure(item)
        found[name] = _join(found[name], item, True) if name in found else item

    whole = len(items) == 1 and items[0][0] == "+" and all(x[0] == "?" and len(x[1]) == 1 for x in items[0][1])
    for item in [x[1][0] for x in items[0][1]] if whole else items:
        add(item, True)
    return (("+", tuple(("?", (found[x],)) for x in sorted(found))),)


def _is_any_order(items: tuple) -> bool:
    return len(items) == 1 and items[0][0] == "+" and len(items[0][1]) > 1 and all(x[0] == "?" for x in items[0][1])


def _longest(a: tuple, b: tuple) -> list[list[int]]:
    """The length of the longest common part of what follows each two places."""
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if _alike(a[i], b[j]) else max(best[i + 1][j], best[i][j + 1])
    return best


def _repeats(a: tuple, b: tuple, best: list[list[int]]) -> bool:
    """True if an item outside the longest common part is like its neighbour: one of a repeated group."""
    def like(items: tuple, i: int) -> bool:
        return i > 0 and _alike(items[i - 1], items[i]) or i + 1 < len(items) and _alike(items[i], items[i + 1])

    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and _alike(a[i], b[j]):
            i, j = i + 1, j + 1
        elif j >= len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            if like(a, i):
                return True
            i += 1
        else:
            if like(b, j):
                return True
            j += 1
    return False


def align(a: tuple, b: tuple, within: bool = False) -> tuple:
    """The wrapper of both: position by position if their tags agree; else alike neighbours are repeated groups,
    the longest common part is joined, the rest optional."""
    if a == b:
        return a
    if len(a) == len(b) and all(_alike(x, y) for x, y in zip(a, b)) and not _is_any_order(a):
        return tuple(_join(x, y, within) for x, y in zip(a, b))
    any_order = a and b and (_is_any_order(a) or _is_any_order(b))
    best = _longest(a, b) if not any_order and len(a) * len(b) <= _CELLS else None
    if best is None or _repeats(a, b, best):
        a, b = runs(a), runs(b)
        if any_order or len(a) * len(b) > _CELLS:
            one, two = ({_name(x): x for x in _any_order(items)[0][1]} for items in (a, b))
            return (("+", tuple(_join(one[k], two[k], within) if k in one and k in two else one.get(k) or two[k]
                                for k in sorted({*one, *two}))),)
        best = _longest(a, b)
    n, m = len(a), len(b)
    out: list = []
    i = j = 0

    def optional(item) -> None:
        if out and item != "#" and _alike(out[-1], item):  # repeats its neighbour: a repeated group
            joined = _join(out[-1], item)
            out[-1] = joined if _core(joined)[0] == "+" else ("+", (joined,))
        else:
            out.append(item if item[0] == "?" else ("?", (item,)))

    while i < n or j < m:
        if i < n and j < m and _alike(a[i], b[j]):
            out.append(_join(a[i], b[j], within))
            i, j = i + 1, j + 1
        elif j >= m or i < n and best[i + 1][j] >= best[i][j + 1]:
            optional(a[i])
            i += 1
        else:
            optional(b[j])
            j += 1
    out = fold(tuple(out))
    return out if len(out) <= _SIBLINGS or "#" in out else _any_order(out)


def _name(item) -> str:
    """The name of an optional item of a group in any order."""
    item = item[1][0]
    return item[1][0] if item[0] == "=" else "#"


def _core(item):
    return item[1][0] if item[0] == "?" and len(item[1]) == 1 else item


def slots(wrapper: tuple) -> set[tuple[str, ...]]:
    """The paths of the wrapper's text slots."""
    found: set[tuple[str, ...]] = set()

    def walk(items: Iterable, path: tuple[str, ...]) -> None:
        for item in items:
            if item == "#":
                found.add(path)
            elif item[0] == "=":
                walk(item[1][1:], (*path, item[1][0]))
            else:
                walk(item[1], path)
    walk(wrapper, ())
    return found


def _marked(marks: list[str], listed: set[str]) -> bool:
    """True if a mark (one whole class, id or role) has listed words and, besides, plain ones only."""
    for mark in marks:
        said = set(_WORD.findall(mark))
        if said & listed and said <= listed | PLAIN_MARKS:
            return True
    return False


@lru_cache(100_000)
def _article(element: str) -> int:
    """How surely an element is the article: 3 article, 2 main, 1 by its marks, 0 not."""
    name, *marks = element.split(" ")
    if name == "article":
        return 3
    if name == "main":
        return 2
    return int(name in {"div", "section", "td"} and _marked(marks, ARTICLE_MARKS) and not _marked(marks, BOILERPLATE_MARKS))


@lru_cache(100_000)
def _boilerplate(element: str) -> int:
    """2 for an element that never holds main text, 1 for one that says it is boilerplate, else 0."""
    name, *marks = element.split(" ")
    if name in NEVER:
        return 2
    return int(name in BOILERPLATE or name == "header"
               or name not in {"html", "body", "article", "main"} and _marked(marks, BOILERPLATE_MARKS))


Path = tuple[tuple[str, str], ...]


def blocks(source: str) -> list[list[tuple[Path, str]]]:
    """The texts of a page, each with the elements above it, by blocks."""
    walker, out, part = Walker(), [], []
    for kind, name, rest in tokens(source):
        if kind == "text":
            part.append((tuple(walker.path), rest))
            continue
        if name not in INLINE and part:
            out.append(part)
            part = []
        if kind == "open":
            walker.open(name, rest)
        else:
            walker.close(name)
    return [*out, part] if part else out


def _plain(text: str) -> str:
    return _SPACE.sub(" ", html.unescape(text)).strip()


def _place(path: Path) -> tuple[str, ...]:
    """The names of the block elements of a path; those below ``_DEPTH`` as one."""
    names = tuple(x[0] for x in path if x[0] not in INLINE)
    return names if len(names) <= _DEPTH else (*names[:_DEPTH - 1], "/".join(names[_DEPTH - 1:]))


def _key(block: list[tuple[Path, str]]) -> tuple[tuple[str, ...], int] | None:
    """(names of the block elements, hash of the text) of a block that has a text of the page's own."""
    place = _place(block[0][0])
    if not NEVER.isdisjoint(place) or len(place) == _DEPTH and not NEVER.isdisjoint(place[-1].split("/")):
        return None
    text = _plain("".join(t for _, t in block))
    return (place, xxhash.xxh64_intdigest(text)) if text else None


def template_of(source: str) -> dict[str, tuple]:
    """The wrapper of one page: the tree of its blocks, every text fixed."""
    found = [(tuple(x for x in block[0][0] if x[0] not in INLINE), *key) for block in blocks(source) if (key := _key(block))]
    if not found:
        return {}
    page = xxhash.xxh64_intdigest(repr([key for _, *key in found]))
    open_: list[list] = [["", []]]  # (element, items so far) from the page down
    last: Path = ()

    def leave(depth: int) -> None:
        while len(open_) > depth + 1:
            element, items = open_.pop()
            open_[-1][1].append(("=", (element, *items)))

    for path, place, text in found:
        same = 0
        while same < min(len(last), len(path)) and last[same] is path[same]:
            same += 1
        # of the elements that stand as one, all must be the same
        leave(same if len(place) < _DEPTH or same < _DEPTH or last == path and same == len(path) else _DEPTH - 1)
        for name in place[len(open_) - 1:]:
            open_.append([name, []])
        open_[-1][1].append(("t", (page, page, text)))
        last = path
    leave(0)
    return {"wrapper": tuple(open_[0][1])}


def common(a: dict, b: dict) -> dict:
    """The wrapper of the pages of both."""
    return {"wrapper": align(a["wrapper"], b["wrapper"])} if a and b else a or b


def fixed(wrapper: tuple) -> dict[tuple[str, ...], set[int]]:
    """The texts of the wrapper's slots that two different pages at least have, by the place of the slot."""
    found: dict[tuple[str, ...], set[int]] = {}

    def walk(items: Iterable, path: tuple[str, ...]) -> None:
        for item in items:
            if item[0] == "t":
                least, most, *texts = item[1]
                if least != most and texts:
                    found.setdefault(path, set()).update(texts)
            elif item[0] == "=":
                walk(item[1][1:], (*path, item[1][0]))
            else:
                walk(item[1], path)
    walk(wrapper, ())
    return found


class Extractor:
    """Cuts the main texts out of the pages of one host, by its wrapper."""

    def __init__(self, template: dict[str, tuple]):
        self.fixed = fixed(template.get("wrapper", ()))

    def text(self, source: str) -> str:
        page = blocks(source)
        own = []  # blocks that fill the wrapper's slots
        for block in page:
            key = _key(block)
            own.append(key is None or key[1] not in self.fixed.get(key[0], ()))
        found = self._main(page, own)
        return found or self._main(page, [True] * len(page))

    def _main(self, page: list, own: list[bool]) -> str:
        rank = max((_article(x[1]) for block in page for path, text in block if text.strip() and not _never(path) for x in path),
                   default=0)
        found = self._slots(page, own, rank)
        return found if found or not rank else self._slots(page, own, 0)

    def _slots(self, page: list, own: list[bool], rank: int) -> str:
        """The blocks of the page's own in its articles (the body for rank 0)."""
        texts = []  # (block, path, text, first element of the article in the path) of the articles
        for n, block in enumerate(page):
            for path, text in block:
                at = next((i for i, x in enumerate(path) if _article(x[1]) >= rank), len(path)) if rank else 0
                if (not rank or at < len(path)) and not _never(path):
                    texts.append((n, path, text, at))
        if rank > 1:  # copies of one article are no template
            all_, left = Counter(), Counter()
            for n, path, text, at in texts:
                all_[id(path[at])] += len(text.strip())
                left[id(path[at])] += own[n] * len(text.strip())
            kept = [(n, p, t, at) for n, p, t, at in texts if own[n] or 2 * left[id(p[at])] <= all_[id(p[at])]]
        else:
            kept = [x for x in texts if own[x[0]]]
        if not rank:
            kept = [x for x in kept if not any(y[0] == "header" or y[0] in BOILERPLATE and y[0] != "form" for y in x[1])]
        # an element that says it is boilerplate is none if it holds most of the article's text (comments: all of it)
        holds, total = Counter(), 0
        for _, path, text, _ in kept:
            size = len(text.strip())
            total += size
            for x in path:
                holds[id(x)] += size
        out: dict[int, list[str]] = {}
        for n, path, text, at in kept:
            for i, x in enumerate(path):
                if not _boilerplate(x[1]) or rank and i > at and x[0] == "header":  # an article's own header holds its title
                    continue
                if holds[id(x)] < total if _marked(x[1].split(" ")[1:], COMMENT_MARKS) else 2 * holds[id(x)] <= total:
                    break
            else:
                out.setdefault(n, []).append(text)
        return " ".join(b for b in (_plain("".join(x)) for x in out.values()) if b)


def _never(path: Path) -> bool:
    return any(_boilerplate(x[1]) == 2 for x in path)


def _dump(wrapper: tuple) -> str:
    return json.dumps(wrapper, separators=(",", ":"))


def _load(text: str) -> tuple:
    def of(x):
        return tuple(of(z) for z in x) if isinstance(x, list) else x
    return of(json.loads(text))


def _write(template: dict) -> str:
    return _dump(template.get("wrapper", ()))


def _read(text: str) -> dict:
    wrapper = _load(text)
    return {"wrapper": wrapper} if wrapper else {}


_HOSTS = 20_000


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One template a host and task (more if a task meets very many hosts)."""
    made: dict[str, dict] = {}
    task = TaskContext.get().partitionId()

    def out():
        hosts = list(made)
        return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array([task % 64] * len(hosts), pa.int32()),
                                           pa.array([_write(made[h]) for h in hosts], pa.string())],
                                          names=["host", "salt", "template"])

    for b in batches:
        for host, page in zip(texts_of(b.column("host")), texts_of(b.column("html"))):
            made[host] = common(made.get(host, {}), template_of(page))
        if len(made) > _HOSTS:
            yield out()
            made.clear()
    yield out()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Templates sorted by host, made one a host."""
    now, template, done = None, {}, []
    for b in batches:
        for host, text in zip(b.column("host").to_pylist(), b.column("template").to_pylist()):
            if host != now:
                if now is not None:
                    done.append((now, _write(template)))
                now, template = host, _read(text)
            else:
                template = common(template, _read(text))
    if now is not None:
        done.append((now, _write(template)))
    for at in range(0, len(done), 1000):
        h, w = zip(*done[at:at + 1000])
        yield pa.RecordBatch.from_arrays([pa.array(h, pa.string()), pa.array(w, pa.string())], names=["host", "template"])


def infer_templates(pages: DataFrame) -> DataFrame:
    """(host, template) from frames with host and html, over all pages."""
    partial = pages.select("host", "html").mapInArrow(_partial, "host string, salt int, template string")
    salted = partial.repartition("host", "salt").sortWithinPartitions("host").mapInArrow(_merge, "host string, template string")
    return salted.repartition("host").sortWithinPartitions("host").mapInArrow(_merge, "host string, template string")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars for each row of ``pages``."""
    from quarry.llm.common import written

    host, _ = host_path(pages[url_col])
    slim = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), host.alias("host"),
                        pages[html_col].cast("string").alias("html"))
    templates, _ = written(infer_templates(slim), "wrappers")
    joined = slim.join(templates, "host", "left").select("page_id", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[str, Extractor] = {}
        for b in batches:
            out = []
            for page, template in zip(texts_of(b.column("html")), texts_of(b.column("template"))):
                if template not in ready:
                    if len(ready) > 1000:
                        ready.clear()
                    ready[template] = Extractor(_read(template) if template else {})
                out.append(ready[template].text(page))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())],
                                             names=["page_id", "url", "text"])

    schema = slim.select("page_id", "url").withColumn("text", F.lit("")).schema
    return joined.mapInArrow(run, schema).withColumn("n_chars", F.char_length("text").cast("long"))
