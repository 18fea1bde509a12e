"""Main text of web pages, by wrappers inferred for each host.

A page is read as a stream of tags and texts; its balanced stretches nest. A wrapper is a
regular expression without alternatives over such streams: tags in order, some of them
optional, some repeated (alone or as a group), and text slots, which hold either one fixed
text or whatever varies. It starts as the stream of one page and is aligned with page after
page: where texts differ, a slot becomes free; where tags differ, a stretch that occurs
again and again becomes a repeated group and any other an optional one. Wrappers are aligned
with each other the same way, so every task folds its own pages, and the results are folded
in rounds for each host, some at a time. All pages take part, and no task ever holds a host's
pages. Where pages vary without end, what varies becomes one repeated group of optional parts, so
a wrapper has a part for each kind of tag at most.

The wrapper tells which of its parts is the article: the part that the markup names as such, and
of several the main one; else the smallest part that has all of the free text outside links
and beside what the markup names as something else. A page is then read along its host's
wrapper, and the text of what falls on the article is its main text.
"""

from __future__ import annotations

import functools
import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Generator, Iterator
from hashlib import blake2b
from operator import add

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import Batches, arrow_batches, extended
from starload.session import stored

MAX_GROUP = 4  # tags of a repeated group
MAX_PARTS = 64  # parts of an element that pages vary in; with more they may come in any order
ANY = "(*)"  # the group of parts in any order
_TABLE = 250_000  # places of an alignment's table
_FOLDED = 64  # wrappers that a task folds into one
_HELD_HOSTS = 2000  # hosts whose wrappers a task folds at a time

# -- fixed values of HTML

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section "
    "table ul".split()
)
# A start tag closes the nearest open element of these, unless one of the others is nearer.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Parts of a page that are never its main text, by tag and by words of class, id and role. A
# word, all that stands between blanks, tells if each of its pieces between marks is a kind or says
# where or how such a part stands, and one is a kind: "reader-comments" and "cookie-bar" do,
# "related-work" and "has-sidebar" do not.
BOILERPLATE_TAGS = frozenset(
    "head nav footer aside form script style noscript template iframe svg object embed "
    "canvas audio video button select textarea title menu dialog".split()
)
COMMENT_KINDS = frozenset(
    "comment comments commentlist commenter commentary-list disqus replies usercomments".split()
)
KINDS = COMMENT_KINDS | frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsbygoogle banner breadcrumb "
    "breadcrumbs cookie cookies cookiebar cookieconsent footer header masthead menu modal nav navbar "
    "navigation newsletter notice notices notification notifications popup promo promos promoted "
    "promotion related share sharing sidebar sidebars social sponsor sponsored sponsors subscribe "
    "toolbar widget widgets".split()
)
STANDING = frozenset(
    "area articles bar block bottom box buttons consent container content form global inner item left "
    "links list main message outer overlay page panel policy post posts reader readers right row section "
    "signup site slot stories thread top user users wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER_BY_WORD = HEADINGS | {"", "html", "body", "main"}
# What names the article, the surest first: a tag, or a word of class, id, role or itemprop.
ARTICLE_NAMES = ("article", "articlebody", "main")
_SAME_NAME = {"article-body": "articlebody", "main-content": "main", "main-body": "main", "main-text": "main"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)"
    r"((?>[^>=]+|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|))*+)(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop)\s*=\s*(\"[^\"]*|'[^']*|[^\s\"'>]+)", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}
_WORD = re.compile(r"[a-z]+")
TEXT = "#"


# -- pages


class Element:
    """A tag with what it holds: elements and texts (whether in a link, the raw text)."""

    __slots__ = ("name", "signature", "children")

    def __init__(self, name: str, signature: str):
        self.name, self.signature = name, signature
        self.children: list[Element | tuple[list[str], int]] = []


@functools.lru_cache(maxsize=4096)
def signature(name: str, attributes: str) -> str:
    """The tag and the words of its class, id, role and itemprop, without numbers."""
    named = " ".join(value[1:] if value[:1] in "\"'" else value for _, value in _NAMED.findall(attributes))
    words = {"-".join(_WORD.findall(w)) for w in named.lower().split()} - {""}
    return ".".join([name, *sorted(words)])


def parse(page: str) -> Element:
    """The page's elements. Inline tags leave no trace but in the texts they stand in; a
    line break ends a text. Scripts, styles and comments are left out."""
    root = Element("", "")
    stack = [root]
    places: dict[str, list[int]] = {}  # where in the stack the open elements of a name are
    pieces: list[str] = []
    linked, in_link, at = 0, False, 0

    def end_text() -> None:
        nonlocal linked
        if pieces:
            text = "".join(pieces)
            if not text.isspace():
                stack[-1].children.append((text, linked))
            pieces.clear()
        linked = 0

    def close(names, unless=()) -> None:
        depth, bar = (max((places[n][-1] for n in some if places.get(n)), default=0) for some in (names, unless))
        if depth > bar:
            end_text()
            for element in stack[depth:]:
                places[element.name].pop()
            del stack[depth:]

    while True:
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else len(page)]
        if text:
            pieces.append(text)
            if in_link:
                linked += len(text)
        if not token:
            break
        at = token.end()
        name = token.group(2)
        if name is None:
            continue
        name = name.lower()
        if name in INLINE:
            if name == "a":
                in_link = not token.group(1)
            continue
        if token.group(1):
            if name == "p" and not places.get("p"):
                end_text()
            else:
                close((name,))
            continue
        if name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        end_text()
        if name in VOID:
            continue
        if name in CLOSES_P:
            close(("p",), ("table", "td", "th", "li", "button"))
        if name in IMPLIED_END:
            close(*IMPLIED_END[name])
        in_link = False
        element = Element(name, signature(name, token.group(3)))
        stack[-1].children.append(element)
        places.setdefault(name, []).append(len(stack))
        stack.append(element)
    end_text()
    return root


def clean(text: str) -> str:
    """Character references decoded, white space as single blanks, none at the ends."""
    return " ".join(html.unescape(text).split())


# -- wrappers


class Part:
    """A tag, a text slot or a group of a wrapper.

    `free` counts the characters of the texts of a free slot that are not in links, `fixed`
    is the hash of a slot's only text so far, `pages` the number of pages that have the part,
    at least.
    """

    __slots__ = (
        "signature", "children", "optional", "repeated", "free", "fixed", "pages", "article",
    )

    def __init__(self, signature, children=(), optional=False, repeated=False, free=0, fixed=None, pages=1):
        self.signature, self.children = signature, list(children)
        self.optional, self.repeated = optional, repeated
        self.free, self.fixed, self.pages = free, fixed, pages
        self.article = False

    @property
    def is_group(self) -> bool:
        return self.signature[:1] == "("

    def to_list(self) -> list[list]:
        """All parts, every one before its children, with the number of these."""
        return [
            [
                p.signature, p.optional + 2 * p.repeated + 4 * p.article,
                p.free, p.fixed, p.pages, len(p.children),
            ]
            for p in outermost_first(self)
        ]

    @classmethod
    def from_list(cls, saved: list[list]) -> Part:
        waiting: list[Part] = []  # roots of what has been read from the end, the last one first
        for name, flags, free, fixed, pages, n in reversed(saved):
            children = waiting[len(waiting) - n :][::-1]
            del waiting[len(waiting) - n :]
            part = cls(name, children, bool(flags & 1), bool(flags & 2), free, fixed, pages)
            part.article = bool(flags & 4)
            waiting.append(part)
        return waiting[0]


def outermost_first(top):
    """An element or a part with all those in it, every one before its children, in order."""
    stack = [top]
    while stack:
        one = stack.pop()
        yield one
        stack += [c for c in reversed(one.children) if not isinstance(c, tuple)]


def _run(call: Generator):
    """What a generator returns that yields the calls it needs the results of. Pages nest
    deeper than Python's calls may."""
    calls, result = [call], None
    while calls:
        try:
            call = calls[-1].send(result)
        except StopIteration as end:
            calls.pop()
            result = end.value
        else:
            calls.append(call)
            result = None
    return result


def to_wrapper(element: Element) -> Part:
    """The wrapper that fits this element alone."""
    made: dict[int, Part] = {}
    for one in reversed(list(outermost_first(element))):
        children = []
        for child in one.children:
            if isinstance(child, Element):
                children.append(made.pop(id(child)))
            else:
                text, linked = child
                fixed = blake2b(clean(text).encode(errors="replace"), digest_size=8).hexdigest()
                # A title may link to its own page.
                free = len(text) - (0 if one.name == "h1" else linked)
                children.append(Part(TEXT, free=free, fixed=fixed))
        made[id(one)] = Part(one.signature, fold_repeats(children))
    return made[id(element)]


def merge(a: Part, b: Part) -> Part:
    """One part that fits whatever either of two parts of equal signature fits."""
    return _run(_merge(a, b))


def fold_repeats(parts: list[Part]) -> list[Part]:
    """Runs of equal tags, or of equal groups of tags, become one repeated part."""
    if len(parts) < 2:
        return list(parts)
    return _run(_fold_repeats(parts))


def _merge(a: Part, b: Part, pages: Callable = add) -> Generator:
    """`pages` is max for parts that the same pages may have, as in a row of repeats."""
    children = ()
    if a.children or b.children:
        children = yield _align(a.children, b.children, pages)
    return Part(
        a.signature,
        children,
        a.optional or b.optional,
        a.repeated or b.repeated,
        a.free + b.free,
        a.fixed if a.fixed == b.fixed else None,
        pages(a.pages, b.pages),
    )


def _fold_repeats(parts: list[Part]) -> Generator:
    for width in range(1, MAX_GROUP + 1):
        names = [p.signature for p in parts]
        folded: list[Part] = []
        at = 0
        while at < len(parts):
            unit = names[at : at + width]
            end = at + width
            while names[end : end + width] == unit and len(unit) == width:
                end += width
            if end == at + width or (width > 1 and any(p.is_group for p in parts[at : at + width])):
                folded.append(parts[at])
                at += 1
                continue
            merged = parts[at : at + width]
            for other in range(at + width, end, width):
                turn = zip(merged, parts[other : other + width], strict=True)
                merged = []
                for x, y in turn:
                    merged.append((yield _merge(x, y, max)))
            if width == 1:
                merged[0].repeated = True
                folded.append(merged[0])
            else:
                folded.append(Part("(" + " ".join(unit) + ")", merged, repeated=True))
            at = end
        parts = folded
    return parts


def _grouped(parts: list[Part], groups: list[Part]) -> list[Part]:
    """`parts` with stretches that are one turn of a known group put into such a group."""
    for group in groups:
        unit = [c.signature for c in group.children]
        names = [p.signature for p in parts]
        found: list[Part] = []
        at = 0
        while at < len(parts):
            if names[at : at + len(unit)] == unit:
                found.append(Part(group.signature, parts[at : at + len(unit)], repeated=True))
                at += len(unit)
            else:
                found.append(parts[at])
                at += 1
        parts = found
    return parts


def _align(a: list[Part], b: list[Part], pages: Callable) -> Generator:
    """Two sequences of parts as one: what both have in common order is merged, the rest
    becomes optional."""
    if [p.signature for p in a] != [p.signature for p in b]:
        known = {p.signature for p in a} ^ {p.signature for p in b}
        a, b = (
            _grouped(x, [g for g in y if g.is_group and g.signature in known])
            for x, y in ((a, b), (b, a))
        )
    if any(p.signature == ANY for p in (*a, *b)):
        return [(yield _merge((yield _any_of(a)), (yield _any_of(b)), pages))]
    common = _common([p.signature for p in a], [p.signature for p in b])
    result: list[Part] = []
    i = j = 0
    for x, y in [*common, (len(a), len(b))]:
        for part in [*a[i:x], *b[j:y]]:
            part.optional = True
            result.append(part)
        if x < len(a):
            result.append((yield _merge(a[x], b[y], pages)))
        i, j = x + 1, y + 1
    if len(common) < max(len(a), len(b)):
        result = yield _fold_repeats(result)
        if len(result) > MAX_PARTS:
            return [(yield _any_of(result))]
    return result


def _any_of(parts: list[Part]) -> Generator:
    """A repeated group in which each of the parts' tags occurs once and may be left out: it fits
    them in any order. Pages that vary without end come to one, and a wrapper stops growing."""
    found: dict[str, Part] = {}
    flat = [c for p in parts for c in (p.children if p.is_group else [p])]
    for part in flat:
        if part.signature in found:
            part = yield _merge(found[part.signature], part, max)
        part.optional = part.repeated = True
        found[part.signature] = part
    return Part(ANY, [found[name] for name in sorted(found)], repeated=True)


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """The places of a common subsequence: a longest one, or for long sequences the longest in
    which the n-th of equal tags meets the n-th. Space and time stay about linear."""
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    middle_a, middle_b = a[first : len(a) - last], b[first : len(b) - last]
    small = len(middle_a) * len(middle_b) <= _TABLE
    middle = (_longest_common if small else _paired_common)(middle_a, middle_b)
    return [
        *((i, i) for i in range(first)),
        *((first + i, first + j) for i, j in middle),
        *((len(a) - n, len(b) - n) for n in range(last, 0, -1)),
    ]


def _paired_common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Equal tags are paired by their number among equals; of the pairs the longest ascending row."""
    places: dict[tuple[str, int], int] = {}
    seen: Counter = Counter()
    for j, name in enumerate(b):
        places[name, seen[name]] = j
        seen[name] += 1
    seen.clear()
    pairs: list[tuple[int, int, int]] = []  # place in a and b, and the pair before
    ends: list[int] = []  # the pair that a row of that length ends in, with the least place in b
    least: list[int] = []
    for i, name in enumerate(a):
        j = places.get((name, seen[name]))
        seen[name] += 1
        if j is None:
            continue
        length = bisect_left(least, j)
        pairs.append((i, j, ends[length - 1] if length else -1))
        if length == len(least):
            least.append(j)
            ends.append(len(pairs) - 1)
        else:
            least[length], ends[length] = j, len(pairs) - 1
    found, at = [], ends[-1] if ends else -1
    while at >= 0:
        i, j, at = pairs[at]
        found.append((i, j))
    return found[::-1]


def _longest_common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    longest = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            if a[i] == b[j]:
                longest[i][j] = longest[i + 1][j + 1] + 1
            else:
                longest[i][j] = max(longest[i + 1][j], longest[i][j + 1])
    found, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j] and longest[i][j] == longest[i + 1][j + 1] + 1:
            found.append((i, j))
            i, j = i + 1, j + 1
        elif longest[i + 1][j] >= longest[i][j + 1]:
            i += 1
        else:
            j += 1
    return found


# -- the article


@functools.lru_cache(maxsize=4096)
def is_boilerplate(signature: str, inside: bool = False) -> bool:
    """By tag or words; `inside` an article its own header belongs to it. An article is one by
    words only if they call it a comment."""
    name, *words = signature.split(".")
    if name in BOILERPLATE_TAGS or (name == "header" and not inside):
        return True
    if name in NEVER_BY_WORD:
        return False
    kinds = COMMENT_KINDS if name == "article" else KINDS
    for word in words:
        pieces = set(word.split("-"))
        if not (kinds.isdisjoint(pieces) or pieces - KINDS - STANDING or (inside and word == "header")):
            return True
    return False


def _is_named(signature: str, name: str) -> bool:
    tag, *words = signature.split(".")
    if name == "article" or tag in HEADINGS:
        return tag == name
    return tag == name or name in {_SAME_NAME.get(w, w) for w in words}


def _free_text(wrapper: Part) -> dict[int, int]:
    """By id of each part, its characters outside links that may belong to an article: all but
    boilerplate and what is the same on every page of the host. None where no text differs."""
    free: dict[int, int] = {}
    order = list(outermost_first(wrapper))
    differs = any(p.signature == TEXT and p.fixed is None for p in order)
    for part in reversed(order):
        if part.signature == TEXT:
            same = part.fixed is not None and part.pages == wrapper.pages
            free[id(part)] = part.free if differs and not same else 0
        elif not part.is_group and is_boilerplate(part.signature):
            free[id(part)] = 0
        else:
            free[id(part)] = sum(free[id(c)] for c in part.children)
    return free


def _named_parts(wrapper: Part, name: str) -> list[Part]:
    """The outermost parts of that name which are not boilerplate, in page order."""
    found, stack = [], [wrapper]
    while stack:
        part = stack.pop()
        if is_boilerplate(part.signature):
            continue
        if _is_named(part.signature, name):
            found.append(part)
        else:
            stack += reversed(part.children)
    return found


def _main_one(parts: list[Part], free: dict[int, int]) -> Part:
    """Of several parts that are named article the main one: repeated ones are comments or
    teasers, where there is another; else the one with the page's title, or with the most text."""
    single = [p for p in parts if not p.repeated] or parts
    titled = [p for p in single if any(c.signature.split(".")[0] == "h1" for c in outermost_first(p))]
    return max(titled or single, key=lambda p: free[id(p)])


def mark_article(wrapper: Part) -> Part:
    """Set `article` on the part that holds the main text."""
    free = _free_text(wrapper)
    for name in ARTICLE_NAMES:
        if parts := _named_parts(wrapper, name):
            _main_one(parts, free).article = True
            return wrapper
    whole, part = free[id(wrapper)], wrapper
    while whole:
        # Paragraphs, which repeat or hold text themselves, are too small to be an article.
        inner = [
            c
            for c in part.children
            if not c.repeated
            and not any(own.signature == TEXT for own in c.children)
            and free[id(c)] == whole
        ]
        if not inner:
            break
        part = inner[0]
    part.article = True
    return wrapper


def main_text(page: str | None, wrapper: Part) -> str:
    """The text of what falls on the wrapper's article; of a page where nothing does, of all
    that is not boilerplate."""
    if not page:
        return ""
    root = parse(page)
    blocks: list[str] = []
    for element in _articles(root, wrapper) or [root]:
        _gather(element, blocks, any(_is_named(element.signature, name) for name in ARTICLE_NAMES))
    return " ".join(filter(None, map(clean, blocks)))


def _gather(element: Element, blocks: list[str], inside: bool = False) -> None:
    """All texts of an element but boilerplate."""
    places = [iter(element.children)]
    while places:
        child = next(places[-1], None)
        if child is None:
            places.pop()
        elif not isinstance(child, Element):
            blocks.append(child[0])
        elif not is_boilerplate(child.signature, inside):
            places.append(iter(child.children))


class _Place:
    """Where the tags in an element are on its part of the wrapper."""

    __slots__ = ("children", "slots", "turns", "at")

    def __init__(self, element: Element, part: Part | None):
        self.children = iter(element.children)
        self.slots: list[Part] = []
        self.turns: list[int] = []  # where the group of a slot begins, if it is in one
        self.at = 0
        for child in part.children if part else ():
            own = child.children if child.is_group else [child]
            self.turns += [len(self.slots) if child.is_group else -1] * len(own)
            self.slots += own

    def part_of(self, element: Element) -> Part | None:
        """The part of the next element, if the wrapper has one."""
        found = _next(self.slots, self.turns, self.at, element.signature)
        if found is None:
            return None
        self.at = found if self.slots[found].repeated else found + 1
        return self.slots[found]


def _articles(root: Element, wrapper: Part) -> list[Element]:
    """Walk a page along its wrapper: what falls on the article. Of several elements that do,
    those with a heading, if there are any: others are comments beside them."""
    if wrapper.article:
        return [root]
    found, places = [], [_Place(root, wrapper)]
    while places:
        child = next(places[-1].children, None)
        if child is None:
            places.pop()
        elif isinstance(child, Element) and (part := places[-1].part_of(child)):
            if part.article:
                found.append(child)
            else:
                places.append(_Place(child, part))
    if len(found) > 1:
        headed = [e for e in found if any(c.name in HEADINGS for c in outermost_first(e))]
        found = headed or found
    return found


def _next(slots: list[Part], turns: list[int], at: int, signature: str) -> int | None:
    """The slot of the next tag: from here on, else from the start of the group just left."""
    for place in range(at, len(slots)):
        if slots[place].signature == signature:
            return place
    last = min(at, len(slots)) - 1
    again = max(turns[last] if last >= 0 else -1, turns[at] if at < len(slots) else -1)
    if again >= 0:
        for place in range(again, min(at, len(slots))):
            if slots[place].signature == signature:
                return place
    return None


# -- on Spark


def host_of(url: str) -> Column:
    """Lower-case host of a URL; empty where there is none."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


def _dump(wrapper: Part) -> str:
    return json.dumps(wrapper.to_list(), separators=(",", ":"))


def _load(saved: str) -> Part:
    return Part.from_list(json.loads(saved))


def _fold_pages(batches: Batches) -> Batches:
    held: dict[str, Part] = {}

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held)), pa.array([_dump(w) for w in held.values()])],
            names=["host", "wrapper"],
        )

    for batch in batches:
        for host, page in zip(batch.column(0), batch.column(1), strict=True):
            name, wrapper = host.as_py(), to_wrapper(parse(page.as_py()))
            held[name] = merge(held[name], wrapper) if name in held else wrapper
        if len(held) >= _HELD_HOSTS:
            yield flush()
            held.clear()
    if held:
        yield flush()


def _fold_wrappers(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    saved = sorted(rows["wrapper"])
    folded = functools.reduce(merge, map(_load, saved[1:]), _load(saved[0]))
    return pd.DataFrame({"host": [key[0]], "wrapper": [_dump(folded)]})


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, wrapper (JSON, with the article marked): a row for every host with a page.

    Pages without a host in their URL count as one host. Null or empty pages teach nothing.
    """
    full = pages.select(host_of(url_col).alias("host"), F.col(html_col).alias("html")).filter(
        F.length("html") > 0
    )
    schema = "host STRING, wrapper STRING"
    folded = stored(full.mapInArrow(_fold_pages, schema), "wrappers")
    # A task gives one wrapper a host; rounds fold about `_FOLDED` of a host's, whatever their number.
    most = folded.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    while most > 1:
        most = -(-most // _FOLDED)
        salted = folded.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(most)).cast("int"))
        folded = stored(salted.groupBy("host", "salt").applyInPandas(_fold_wrappers, schema), "wrappers")

    def decide(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        marked = [_dump(mark_article(_load(w.as_py()))) for w in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marked)], names=["host", "wrapper"])

    return folded.mapInArrow(arrow_batches(decide), schema)


@functools.lru_cache(maxsize=4096)
def _loaded(saved: str) -> Part:
    return _load(saved)


def extract_main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    max_broadcast_bytes: int = 64 << 20,
) -> DataFrame:
    """id, url, host, text (empty if there is none) and n_chars, its code points, per page.

    A null or empty page has an empty text. Every row is read by itself along its host's
    wrapper: repeated rows repeat, null ids and URLs stay. Other columns are ignored. The
    wrappers go to all tasks if they are small together; else they meet the pages in a join.
    """
    spark = pages.sparkSession
    wrappers = stored(infer_wrappers(pages, url_col, html_col), "wrappers")
    size = wrappers.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    source = pages.select(
        F.col(id_col), F.col(url_col), host_of(url_col).alias("host"), F.col(html_col).alias("html")
    )
    nothing = Part("")
    if size <= max_broadcast_bytes:
        known = spark.sparkContext.broadcast({r["host"]: r["wrapper"] for r in wrappers.collect()})
        source = source.withColumn("wrapper", F.lit(None).cast("string"))
    else:
        known = None
        source = source.join(wrappers, "host", "left").select(*source.columns, "wrapper")

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = []
        for host, page, saved in zip(*batch.columns[2:], strict=True):
            own = known.value.get(host.as_py()) if known else saved.as_py()
            texts.append(main_text(page.as_py(), _loaded(own) if own else nothing))
        columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *columns], names=[id_col, url_col, "host", "text", "n_chars"]
        )

    kept = source.select(id_col, url_col, "host")
    schema = extended(kept, text=T.StringType(), n_chars=T.LongType())
    return source.mapInArrow(arrow_batches(read), schema)
