"""HTML extraction by wrappers: union-free regular expressions inferred from pages of the same host.

A page is a stream of block tags and text slots.  Sequences that follow themselves fold into a
repeated group.  The wrapper of a host starts as the stream of one page and is aligned with one
page after another: what matches stays, what only one side has becomes optional, and texts become
slots that remember whether they ever changed and how much of them was links.  Wrappers of parts
of a host's pages align in the same way, so every task infers its own and the hosts merge them.
A page is then matched with its host's wrapper, and the slots of the article give the text.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import materialise

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|select|button)\b[^>]*(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z][^>]*\Z",
    re.S | re.I,
)
_MARK = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)

INLINE = set(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta source track wbr".split())
# An opening tag ends an open element of these names, up to the nearest element of the last names.
ENDS = {
    **dict.fromkeys("p div ul ol dl table h1 h2 h3 h4 h5 h6 section article aside header footer nav form blockquote pre figure main hr address".split(), ({"p"}, set())),
    "li": ({"li", "p"}, {"ul", "ol"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements, and words of class, id or role names, whose text is no part of an article.
ASIDE_TAGS = set("head nav footer aside form dialog menu header".split())
ASIDE_WORDS = set(
    "ad ads advert advertisement advertising adsense sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr notice notices "
    "popup modal overlay nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars widget widgets related recommended recommendations "
    "share sharing social footer header masthead contentinfo complementary comment comments commentlist reply replies discussion disqus respond "
    "newsletter subscribe subscription login signup signin search searchform pagination pager paging toolbar copyright skip".split()
)
MAIN_WORDS = set("article main content post entry story maincontent articlebody storybody postbody".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# No name makes these an aside.
ARTICLE_TAGS = HEADINGS | {"html", "body", "main", "article"}
# Ids are often made of a heading's words, so an id tells an aside only on a container and if all its words do, or say no more than these.
NO_CONTAINER = set("p li dt dd td th tr blockquote pre figure figcaption caption".split())
PLAIN_WORDS = set(
    "site page blog post posts article articles story stories main content top bottom left right box bar wrapper wrap container area block section "
    "list items item links inner outer module panel primary secondary global slot unit buttons icons form recent user js".split()
)
# A class that says what an element has or lacks says nothing of the element.
HAVING = {"has", "with", "no", "without"}
LONGEST_PERIOD = 24
# A slot outside of article and main parts, or in a main part beside an article, whose text never changes on
# at least so many pages with different articles belongs to the template.
SAME_PAGES = 5


@dataclass
class Slot:
    """A text: its places in a page, or what is known of it over the pages of a host."""

    path: tuple[str, ...]
    places: list[int] = field(default_factory=list)
    pages: int = 0
    chars: int = 0
    links: int = 0
    same: int | None = None
    optional: bool = False
    # Digests of the articles it was the same with, the least SAME_PAGES of them.
    articles: list[int] = field(default_factory=list)

    key = "#"


@dataclass
class Group:
    """A repeated sequence."""

    body: list
    optional: bool = False

    @property
    def key(self):
        return ("+", *(_key(x) for x in self.body))


@dataclass
class Tag:
    label: str
    optional: bool = False

    @property
    def key(self):
        return self.label


def _key(item):
    return item.key


def _label(name: str, rest: str) -> tuple[str, bool]:
    """Name of a tag with the words of its class, id and role, and whether they make it an aside.

    Among the words ! stands for an aside, ^ for a header and * for an article or main part.
    """
    words: set[str] = set()
    aside: set[str] = set()
    main = False
    for m in _MARK.finditer(rest):
        value = (m[2] or m[3] or m[4] or "").lower()
        for token in value.split():
            parts = {w for w in re.split(r"[^a-z0-9]+", token) if w}
            words |= parts
            if name in HEADINGS or parts & HAVING:
                continue
            main |= name not in NO_CONTAINER and bool(parts & MAIN_WORDS)
            told = parts & ASIDE_WORDS
            if m[1].lower() == "id" and (name in NO_CONTAINER or not all(w in ASIDE_WORDS or w in PLAIN_WORDS or w.isdigit() for w in parts)):
                continue
            if name not in ARTICLE_TAGS:
                aside |= told
    signs = (["!"] if aside - {"header"} else ["^"] if aside else []) + ["*"] * main
    return ".".join([name, *signs, *sorted(words)]), bool(aside)


_short_label = lru_cache(1 << 14)(_label)


@dataclass
class Page:
    items: list
    texts: list[str]
    links: list[int]


def read_page(source: str) -> Page:
    """Block tags and texts of a page; broken markup never fails, open elements end with the page."""
    items: list = []
    texts: list[str] = []
    links: list[int] = []
    stack: list[str] = []
    labels: list[str] = []
    pieces: list[str] = []
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            items.append(Slot(tuple(labels), [len(texts)]))
            texts.append(text)
            links.append(min(linked, len(text)))
        pieces.clear()
        linked = 0

    def end(depth: int) -> None:
        while len(stack) > depth:
            flush()
            items.append(Tag("/" + labels.pop()))
            stack.pop()

    def say(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw)
        pieces.append(text)
        if in_link:
            linked += len(text.strip())

    at = 0
    for found in _PIECE.finditer(source):
        if found.start() > at:
            say(source[at : found.start()])
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        label, aside = (_short_label if len(found["rest"]) < 500 else _label)(name, found["rest"])
        if name in INLINE and not aside:
            if name == "a":
                in_link = 0 if found["close"] else 1
            elif name == "br":
                pieces.append(" ")
            # The end of an inline element that was taken as a block.
            if found["close"] and name in stack and stack[-1] == name:
                end(len(stack) - 1)
            continue
        if found["close"]:
            if name in stack:
                end(len(stack) - 1 - stack[::-1].index(name))
            continue
        flush()
        closed, until = ENDS.get(name, (set(), set()))
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth] in until or not (stack[depth] in closed or stack[depth] in INLINE):
                break
            if stack[depth] in closed:
                end(depth)
        items.append(Tag(label))
        if name in VOID or found["rest"].endswith("/"):
            continue
        stack.append(name)
        labels.append(label)
    if at < len(source):
        say(source[at:])
    end(0)
    flush()
    return Page(fold(items), texts, links)


def _join(kept, other):
    """Put the places of an equal item into ``kept``."""
    if isinstance(kept, Slot):
        kept.places.extend(other.places)
    elif isinstance(kept, Group):
        for x, y in zip(kept.body, other.body):
            _join(x, y)


def fold(items: Iterable) -> list:
    """Sequences that repeat at once become a Group."""
    out: list = []
    keys: list = []
    for item in items:
        out.append(item)
        keys.append(_key(item))
        again = isinstance(item, Tag) and item.label.startswith("/")
        while again:
            again, last = False, keys[-1]
            for period in range(1, min(LONGEST_PERIOD, len(out) - 1) + 1):
                earlier = keys[-period - 1]
                if type(earlier) is tuple and earlier[-1] == last and earlier[1:] == tuple(keys[-period:]):
                    for x, y in zip(out[-period - 1].body, out[-period:]):
                        _join(x, y)
                    del out[-period:], keys[-period:]
                    again = True
                    break
                if earlier == last and 2 * period <= len(out) and keys[-period:] == keys[-2 * period : -period]:
                    first, second = out[-2 * period : -period], out[-period:]
                    for x, y in zip(first, second):
                        _join(x, y)
                    group = Group(first)
                    out[-2 * period :], keys[-2 * period :] = [group], [group.key]
                    again = True
                    break
    return out


def _bodies(items: Iterable) -> set[tuple]:
    return {x.key[1:] for x in items if isinstance(x, Group)}


def _lifted(items: list, bodies: set[tuple]) -> list:
    """Single occurrences of sequences that repeat elsewhere become groups of one."""
    for body in sorted(bodies, key=lambda b: (-len(b), str(b))):
        out, at = [], 0
        while at < len(items):
            part = items[at : at + len(body)]
            if len(part) == len(body) and not isinstance(part[0], Group) and tuple(map(_key, part)) == body:
                out.append(Group(part, optional=any(x.optional for x in part)))
                at += len(body)
            else:
                out.append(items[at])
                at += 1
        items = out
    return items


def align(wrapper: list, page: list) -> list[tuple]:
    """Pairs of items in order, None where one side has none."""
    wrapper, page = _lifted(wrapper, _bodies(page)), _lifted(page, _bodies(wrapper))
    ids: dict = {}
    a, b = ([ids.setdefault(_key(x), len(ids)) for x in side] for side in (wrapper, page))
    out, i, j = [], 0, 0
    for block in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks():
        out += [(x, None) for x in wrapper[i : block.a]] + [(None, y) for y in page[j : block.b]]
        out += list(zip(wrapper[block.a : block.a + block.size], page[block.b : block.b + block.size]))
        i, j = block.a + block.size, block.b + block.size
    return out


def _slots(items: Iterable) -> Iterator[Slot]:
    for item in items:
        if isinstance(item, Slot):
            yield item
        elif isinstance(item, Group):
            yield from _slots(item.body)


def _add(known, other):
    """What two matching items tell together."""
    known.optional |= other.optional
    for x, y in zip(_slots([known]), _slots([other])):
        x.same = y.same if not x.pages else x.same if x.same == y.same or not y.pages else None
        x.articles = sorted({*x.articles, *y.articles})[:SAME_PAGES] if x.same is not None else []
        x.pages, x.chars, x.links = x.pages + y.pages, x.chars + y.chars, x.links + y.links
    return known


def generalise(wrapper: list | None, other: list) -> list:
    """The wrapper that also covers ``other``; what only one of them has becomes optional."""
    if wrapper is None:
        return other
    out = []
    for x, y in align(wrapper, other):
        if x is not None and y is not None:
            out.append(_add(x, y))
        else:
            one = x if y is None else y
            one.optional = True
            out.append(one)
    return out


def observe(page: Page) -> list:
    """The page's items as a wrapper of one page."""
    slots = [(s, _region(s.path)) for s in _slots(page.items)]
    best = max((r for _, r in slots), default=0)
    article = zlib.crc32("\n".join(page.texts[i] for i in sorted(i for s, r in slots if r == best for i in s.places)).encode("utf-8", "replace"))
    for slot, region in slots:
        text = [page.texts[i] for i in slot.places]
        slot.pages, slot.chars, slot.links = 1, sum(map(len, text)), sum(page.links[i] for i in slot.places)
        slot.same = zlib.crc32("\n".join(text).encode("utf-8", "replace"))
        slot.places, slot.articles = [], [article] if region == 1 or region == 2 < best else []
    return page.items


def dump(items: list) -> str:
    def plain(x):
        if isinstance(x, Tag):
            return [x.label, x.optional]
        if isinstance(x, Group):
            return ["+", x.optional, [plain(y) for y in x.body]]
        return ["#", x.optional, list(x.path), x.pages, x.chars, x.links, x.same, x.articles]

    return json.dumps([plain(x) for x in items], ensure_ascii=False, separators=(",", ":"))


def load(text: str) -> list:
    def item(x):
        if x[0] == "+":
            return Group([item(y) for y in x[2]], x[1])
        if x[0] == "#":
            return Slot(tuple(x[2]), [], x[3], x[4], x[5], x[6], x[1], x[7])
        return Tag(x[0], x[1])

    return [item(x) for x in json.loads(text)]


def expression(items: list) -> str:
    """The wrapper as a regular expression over tags, with # for texts."""
    out = []
    for x in items:
        one = f"<{x.label}>" if isinstance(x, Tag) else "#" if isinstance(x, Slot) else f"({expression(x.body)})+"
        out.append(f"({one})?" if x.optional else one)
    return "".join(out)


@lru_cache(1 << 16)
def _region(path: tuple[str, ...]) -> int:
    """0 no article text, 1 no sign, 2 in a main part, 3 in an article."""
    level, heading = 1, bool(path) and path[-1].split(".")[0] in HEADINGS
    for label in path:
        name, _, marks = label.partition(".")
        signs = set(marks.split("."))
        # A heading inside the header of an article is part of it.
        if "!" in signs and not (heading and name == "header") or "^" in signs and not (heading and (level > 1 or name == "header")):
            return 0
        if name in ASIDE_TAGS and not (name == "header" and level > 1 and heading):
            return 0
        if name == "article":
            level = 3
        elif level < 2 and (name == "main" or "*" in signs):
            level = 2
    return level


def article_slots(wrapper: list) -> set[int]:
    """Ids of the slots of a wrapper that may hold article text where they lie outside of article and main parts,
    or in a main part beside an article."""
    slots = [s for s in _slots(wrapper) if _region(s.path)]
    changing = any(s.same is None and s.pages > 1 for s in slots)
    out = set()
    for s in slots:
        template = changing and s.same is not None and len(s.articles) >= SAME_PAGES
        linked = 2 * s.links > s.chars
        if _region(s.path) == 3 or not template and not linked:
            out.add(id(s))
    return out


def extract(wrapper: list, page: Page, good: set[int]) -> str:
    """Texts of the page's slots that match article slots of the wrapper, in the best region the page has.

    What a main part has beside an article belongs to the text unless the wrapper tells it is template or links.
    """
    chosen: list[tuple[int, int]] = []
    best = max((_region(s.path) for s in _slots(page.items)), default=0)
    for known, own in align(wrapper, page.items):
        if own is None:
            continue
        theirs = list(_slots([known])) if known is not None else []
        for k, slot in enumerate(_slots([own])):
            region = _region(slot.path)
            if region and region >= min(best, 2) and (region > 1 and region == best or known is None or id(theirs[k]) in good):
                chosen += slot.places
    return "\n".join(page.texts[i] for i in sorted(chosen))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wrappers: dict[str, list] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"host": pa.array(list(wrappers), pa.string()), "wrapper": pa.array([dump(w) for w in wrappers.values()], pa.string())})

    for batch in batches:
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1)):
            wrappers[host] = generalise(wrappers.get(host), observe(read_page(source.as_py() or "")))
        if len(wrappers) > 20_000:
            yield out()
            wrappers.clear()
    yield out()


def _host(url: str):
    return F.coalesce(F.lower(F.try_parse_url(F.col(url), F.lit("HOST"))), F.lit(""))


def infer(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """(host, wrapper) of every host, in a written table; a host's group has a row for each task that saw it."""
    parts = pages.select(_host(url).alias("host"), F.col(source).alias("html")).mapInArrow(_learn, "host string, wrapper string")

    def merge(key: tuple, parts: pa.Table) -> pa.Table:
        whole = None
        for text in sorted(parts.column("wrapper").to_pylist()):
            whole = generalise(whole, load(text))
        return pa.table({"host": [key[0].as_py()], "wrapper": [dump(whole or [])]})

    return materialise(materialise(parts, "wrapper-parts").groupBy("host").applyInArrow(merge, "host string, wrapper string"), "wrappers")


# Wrappers up to this size in all are shipped to the executors, more of them meet the pages in a join.
BROADCAST_BYTES = 16 << 20


def main_text(pages: DataFrame, keep: list[str], url: str = "url", source: str = "html") -> DataFrame:
    """``keep`` columns with text, the article of every page.

    Wrappers are inferred from the same pages.  Character references are decoded, white space
    inside a block becomes one space, and blocks are joined by a line break.  A null or empty page
    has an empty text; a page without a host belongs to the host without a name.
    """
    wrappers = infer(pages, url, source)
    rows = pages.select(_host(url).alias("_host"), F.col(source).alias("_html"), *keep)
    size = wrappers.agg(F.sum(F.length("wrapper"))).first()[0] or 0
    shared = None
    if size <= BROADCAST_BYTES:
        shared = pages.sparkSession.sparkContext.broadcast({r["host"]: r["wrapper"] for r in wrappers.collect()})
        rows = rows.withColumn("_wrapper", F.lit(None).cast("string"))
    else:
        rows = rows.join(wrappers.select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper")), "_host")
    rows = rows.select("_host", "_html", "_wrapper", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[str, tuple] = {}
        for batch in batches:
            out = []
            for host, source_text, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if host not in ready:
                    if len(ready) > 5_000:
                        ready.clear()
                    wrapper = load(own.as_py() if shared is None else shared.value[host])
                    ready[host] = wrapper, article_slots(wrapper)
                out.append(extract(ready[host][0], read_page(source_text.as_py() or ""), ready[host][1]))
            yield pa.RecordBatch.from_arrays([*batch.columns[3:], pa.array(out, pa.string())], names=[*keep, "text"])

    return rows.mapInArrow(run, pages.select(*keep).schema.add("text", "string"))
