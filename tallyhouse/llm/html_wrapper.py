"""Main text of web pages through wrappers inferred per host.

Pages of one host come from the same template. A wrapper is a union-free regular
expression over tags and text: starting from one page, the others are aligned with it
one by one. Where they agree a token stays as it is; a text that differs becomes a
slot; neighbours of one shape become a repeated group; what only some pages have
becomes optional. Every page is aligned: tasks merge the pages they read into partial
wrappers, which are merged in a tree. The slots show where a host keeps its article, a
slot remembers lines that nearly all pages have in it, and the article of every page of
the host is read from there without those lines.
"""

from __future__ import annotations

import html as entities
import pickle
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import release, small, stored
from tallyhouse.llm.url_filter import url_parts

# Partial wrappers merged in one task, and hosts whose wrappers a task holds at once.
FAN_IN = 64
HELD_HOSTS = 500
# A line is part of a template if this share of at least so many pages have it.
CONSTANT_SHARE = 0.8
CONSTANT_PAGES = 5
# Elements nested deeper are read in place, as siblings.
MAX_DEPTH = 120
# Sibling lists whose product is larger are aligned by occurrence, in n log n.
ALIGN_CELLS = 250_000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_MARK = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
# Elements by how HTML treats them.
SILENT = set("script style noscript template textarea select iframe svg math object head title canvas audio video".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# An opening tag ends an open element of the second kind, up to the boundary elements.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDS = set("html body article section main div ul ol dl table blockquote aside nav header footer form figure td th li".split())
# Elements and names of parts that are not the article.
ASIDE = set("nav footer aside form button dialog menu fieldset".split())
ASIDE_NAMES = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disqus footer masthead menu modal nav navbar navigation newsletter notice notices pagination pager "
    "popup promo promotion related replies respond share sharing sidebar skip social sponsor sponsored subscribe toolbar "
    "widget contentinfo complementary search".split()
)
# Names of asides that are also names of prose: with paragraphs and no form they are prose.
WEAK_NAMES = set("search skip social toolbar".split())
# A form around one of these is a frame of the page.
FRAMED = set("article main h1 header footer nav".split())
MAIN_NAMES = set("article content entry main post story".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())


class Element:
    __slots__ = ("tag", "names", "kids", "repeated", "optional", "pages", "shape", "frame", "prose", "form")

    def __init__(self, tag: str, names: tuple[str, ...] = ()):
        self.tag, self.names, self.kids = tag, names, []
        self.repeated = self.optional = False
        self.pages = 1
        self.shape = ".".join((tag, *names))
        # What it holds: parts of a page's frame, paragraphs, a form.
        self.frame = self.prose = self.form = False


class Text:
    """Words of a page; in a wrapper, words that all pages have or else a slot.

    ``lines`` counts, for each text that stood here, the pages that had it.
    """

    __slots__ = ("words", "slot", "mass", "optional", "pages", "lines")
    shape = "#text"

    def __init__(self, words: str):
        self.words, self.slot, self.mass, self.optional, self.pages = words, False, len(words), False, 1
        self.lines = {words: 1}


def _marks(marks: str) -> tuple[tuple[str, ...], bool]:
    """Words of class, id and role, and whether the element is hidden."""
    words, hidden = set(), False
    for name, *values in _MARK.findall(marks):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id", "role"):
            words.update(w for w in re.split(r"[^a-z]+", value.lower()) if w)
        hidden = hidden or name == "hidden" or (name == "style" and bool(_UNSEEN.search(value)))
    return tuple(sorted(words)), hidden


def parse(html: str | None) -> Element:
    """The tree of a page. Unclosed and misnested tags end where HTML would end them.

    A hidden element is parsed like others but hangs on nothing. Below ``MAX_DEPTH``
    text and elements are kept in place, as siblings; asides there hang on nothing.
    """
    root = Element("#page")
    stack, at, html = [root], 0, html or ""

    def close(depth: int):
        if len(stack) > MAX_DEPTH and any(e.tag not in INLINE for e in stack[max(depth, MAX_DEPTH) :]):
            stack[MAX_DEPTH - 1].kids.append(Element("div"))
        del stack[depth:]

    def add(raw: str):
        if raw:
            stack[-1].kids.append(Text(entities.unescape(raw)))

    while m := _TOKEN.search(html, at):
        add(html[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        marks = m[3] if m[2] else m[6]
        if m[1] or m[4]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == name:
                    close(depth)
                    break
                # The end of an inline element or a paragraph does not end what holds it.
                if (name in INLINE or name == "p") and stack[depth].tag in BOUNDS:
                    break
            continue
        closed = name in VOID or (marks or "").endswith("/")
        if name in SILENT:
            if not closed:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        ends = ENDS.get(name) or (set() if name in INLINE else {"p"})
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in ends:
                close(depth)
                break
            if stack[depth].tag in BOUNDS:
                break
        words, hidden = _marks(marks or "")
        element = Element(name, words)
        if name in FRAMED or name in ("p", "form", "input"):
            for holder in stack[1:]:
                holder.frame |= name in FRAMED
                holder.prose |= name == "p"
                holder.form |= name in ("form", "input")
        deep = len(stack) >= MAX_DEPTH
        if not hidden and not (deep and is_aside(element, True)):
            stack[-1].kids.append(element)
            if deep:
                element = Element(name, words)
                element.kids = stack[-1].kids
        if not closed:
            stack.append(element)
    add(html[at:])
    return root


def _aligned(a: list, b: list) -> list[tuple[object, object]]:
    """Pairs of two sibling lists by shape, in order (a longest common subsequence).

    Of very long lists the k-th siblings of a shape are paired, as far as pairs are in order.
    """
    n, m = len(a), len(b)
    if [k.shape for k in a] == [k.shape for k in b]:
        return list(zip(a, b))
    if n * m > ALIGN_CELLS:
        return _by_occurrence(a, b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i].shape == b[j].shape else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i].shape == b[j].shape and best[i][j] == best[i + 1][j + 1] + 1:
            out.append((a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append((a[i], None))
            i += 1
        else:
            out.append((None, b[j]))
            j += 1
    return out


def _by_occurrence(a: list, b: list) -> list[tuple[object, object]]:
    where, seen = defaultdict(list), Counter()
    for j, kid in enumerate(b):
        where[kid.shape].append(j)
    ends, tails, back, pairs = [], [], [], []
    for i, kid in enumerate(a):
        k = seen[kid.shape]
        seen[kid.shape] += 1
        if k < len(where[kid.shape]):
            j = where[kid.shape][k]
            at = bisect_left(ends, j)
            back.append(tails[at - 1] if at else -1)
            pairs.append((i, j))
            ends[at : at + 1], tails[at : at + 1] = [j], [len(pairs) - 1]
    kept, at = [], tails[-1] if tails else -1
    while at >= 0:
        kept.append(pairs[at])
        at = back[at]
    out, i, j = [], 0, 0
    for x, y in [*reversed(kept), (len(a), len(b))]:
        out += [(k, None) for k in a[i:x]] + [(None, k) for k in b[j:y]]
        if x < len(a):
            out.append((a[x], b[y]))
        i, j = x + 1, y + 1
    return out


def _merge(w, p, pages: bool = False):
    """Generalise ``w`` so that it also fits ``p``: a part of the same page, or of other ``pages``."""
    w.pages = w.pages + p.pages if pages else max(w.pages, p.pages)
    if isinstance(w, Text):
        w.slot = w.slot or p.slot or w.words != p.words
        w.mass += p.mass
        for line, n in p.lines.items():
            w.lines[line] = w.lines.get(line, 0) + n if pages else max(w.lines.get(line, 0), n)
    else:
        w.repeated = w.repeated or p.repeated
        w.frame, w.prose, w.form = w.frame or p.frame, w.prose or p.prose, w.form or p.form
        w.kids = _siblings(w.kids, p.kids, pages)
    w.optional = w.optional or p.optional
    return w


def _siblings(a: list, b: list, pages: bool) -> list:
    out = []
    for x, y in _aligned(a, b):
        if x is not None and y is not None:
            out.append(_merge(x, y, pages))
        else:
            lone = x if x is not None else y
            lone.optional = True
            out.append(lone)
    return _folded(out)


def _folded(kids: list) -> list:
    """Neighbours that repeat, one by one or in short sequences, become one repeated group."""
    for period in (1, 2, 3):
        out = []
        for kid in kids:
            out.append(kid)
            ours, before = out[-period:], out[-2 * period : -period]
            if (
                len(out) >= 2 * period
                and [k.shape for k in ours] == [k.shape for k in before]
                and any(isinstance(k, Element) for k in ours)
            ):
                del out[-period:]
                for x, y in zip(before, ours):
                    _merge(x, y)
                    if isinstance(x, Element):
                        x.repeated = True
        kids = out
    return kids


def _fold(element: Element) -> Element:
    kids = []
    for kid in element.kids:
        if isinstance(kid, Text):
            words = " ".join(kid.words.split())
            if words:
                kids.append(Text(words))
        else:
            kids.append(_fold(kid))
    element.kids = _folded(kids)
    return element


def infer(pages: list[str | None]) -> Element:
    """The wrapper of some pages."""
    wrapper = None
    for page in pages:
        tree = _fold(parse(page))
        wrapper = tree if wrapper is None else _merge(wrapper, tree, True)
    return wrapper


def pruned(wrapper: Element) -> Element:
    """A wrapper small enough to be sent: without words of slots that vary from page to
    page, and without parts that fewer than one page in a hundred has."""
    least, waiting = wrapper.pages / 100, [wrapper]
    while waiting:
        node = waiting.pop()
        if isinstance(node, Text):
            if wrapper.pages > 1:
                node.lines = {k: n for k, n in node.lines.items() if 2 * n >= wrapper.pages}
            if node.slot:
                node.words = ""
        else:
            node.kids = [k for k in node.kids if not k.optional or k.pages >= least]
            waiting += node.kids
    return wrapper


def constant_lines(wrapper: Element) -> list[str]:
    """Texts that nearly all pages of a host have at one place."""
    out, waiting = set(), [wrapper]
    while waiting and wrapper.pages >= CONSTANT_PAGES:
        node = waiting.pop()
        if isinstance(node, Text):
            out.update(k for k, n in node.lines.items() if n >= CONSTANT_SHARE * wrapper.pages)
        else:
            waiting += node.kids
    return sorted(out)


def expression(node) -> str:
    """The wrapper written as a union-free regular expression."""
    if isinstance(node, Text):
        body = "#slot" if node.slot else re.sub(r"([()?+#<>])", r"\\\1", node.words)
        return f"({body})?" if node.optional else body
    inner = "".join(expression(k) for k in node.kids)
    body = inner if node.tag == "#page" else f"<{node.shape}>{inner}</{node.tag}>"
    if node.repeated:
        return f"({body}){'*' if node.optional else '+'}"
    return f"({body})?" if node.optional else body


def is_aside(element: Element, inside: bool = False) -> bool:
    """True for menus, adverts and the like; a header only outside the article."""
    if element.tag == "form" and element.frame:
        return False
    if element.tag in ASIDE or (element.tag == "header" and not inside):
        return True
    if element.tag in ("html", "body", "main", "article"):
        return False
    names = ASIDE_NAMES.intersection(element.names)
    return bool(names) and not (names <= WEAK_NAMES and element.prose and not element.form)


def _mass(node, slots: bool = True) -> float:
    """Text by which a part speaks for itself: words in slots fully, constant ones little."""
    if isinstance(node, Text):
        return node.mass if node.slot or not slots else 0.2 * node.mass
    if is_aside(node, True):
        return 0.0
    total = sum(_mass(k, slots) for k in node.kids)
    return 0.2 * total if node.tag == "a" else total


def article_path(wrapper: Element) -> list[str]:
    """Shapes from the page down to the element that holds the article."""
    return article_paths(wrapper)[0]


def article_paths(wrapper: Element) -> list[list[str]]:
    """Places of the article, best first: a host may have several templates."""
    named: list[tuple[float, list[str]]] = []

    def walk(node: Element, path: list[str]):
        for kid in node.kids:
            if isinstance(kid, Element) and not is_aside(kid):
                here = [*path, kid.shape]
                level = 3 if kid.tag == "article" else 2 if kid.tag == "main" else 1 if MAIN_NAMES.intersection(kid.names) else 0
                if level and _mass(kid):
                    named.append((level, _mass(kid), -len(here), here))
                walk(kid, here)

    walk(wrapper, [])
    if named:
        return [path for *_, path in sorted(named, reverse=True)]
    # No part says what it is: go down as long as one part holds most of the text.
    node, path = wrapper, []
    while True:
        parts = [k for k in node.kids if isinstance(k, Element) and not is_aside(k) and k.tag not in INLINE]
        if not parts:
            return [path]
        top = max(parts, key=_mass)
        if top.tag == "p" or top.repeated or _mass(top) < 0.6 * max(_mass(node), 1e-9):
            return [path]
        node, path = top, [*path, top.shape]


def article_text(page: Element, path: list[str], constant: frozenset[str] = frozenset()) -> str | None:
    """Blocks of the article in page order, or None if the page has no such place.

    Blocks that are ``constant`` on the host are left out, headings and a page that
    would lose half of its text excepted.
    """
    found = [page]
    for shape in path:
        found = [k for f in found for k in f.kids if isinstance(k, Element) and k.shape == shape]
    if not found:
        return None
    blocks: list[list[str]] = [[]]
    headings: set[int] = set()

    def walk(node: Element):
        for kid in node.kids:
            if isinstance(kid, Text):
                blocks[-1].append(kid.words)
            elif kid.tag == "br":
                blocks[-1].append(" ")
            elif not is_aside(kid, True):
                if kid.tag not in INLINE:
                    blocks.append([])
                    if kid.tag in HEADINGS:
                        headings.add(len(blocks) - 1)
                walk(kid)
                if kid.tag not in INLINE:
                    blocks.append([])

    for element in found:
        blocks.append([])
        walk(element)
    texts = [" ".join("".join(b).split()) for b in blocks]
    whole = " ".join(filter(None, texts))
    if constant:
        kept = [
            t for i, (t, b) in enumerate(zip(texts, blocks))
            if t and (i in headings or any(w and w not in constant for w in (" ".join(x.split()) for x in b)))
        ]
        rest = " ".join(kept)
        if 2 * len(rest) >= len(whole):
            return rest
    return whole


def page_text(html: str | None, paths: list[list[str]] | None, constant: frozenset[str]) -> str:
    """The text at the first of a host's places that the page has, else by a wrapper of its own."""
    if not html:
        return ""
    page = parse(html)
    for path in paths or []:
        text = article_text(page, path, constant)
        if text:
            return text
    text = article_text(page, article_path(infer([html])), constant)
    return text or ""


def wrappers(pages: DataFrame) -> DataFrame:
    """Per host: host, paths (to the article), constant (lines), wrapper (its expression), n_pages.

    Every page is aligned where it is read; no page is shuffled. Partial wrappers of a
    host are merged ``FAN_IN`` at a time, so a host with a third of all pages is no
    larger group than others.
    """

    def read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Element] = {}

        def emptied():
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array([pickle.dumps(pruned(w)) for w in held.values()], pa.binary())],
                names=["host", "part"],
            )
            held.clear()
            return out

        for batch in batches:
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                tree = _fold(parse(html))
                held[host] = _merge(held[host], tree, True) if host in held else tree
                if held[host].pages % FAN_IN == 0:
                    pruned(held[host])
                if len(held) >= HELD_HOSTS:
                    yield emptied()
        if held:
            yield emptied()

    def merge_parts(rows: pd.DataFrame) -> pd.DataFrame:
        wrapper = None
        for part in rows.sort_values("id")["part"]:
            part = pickle.loads(part)
            wrapper = part if wrapper is None else _merge(wrapper, part, True)
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "part": [pickle.dumps(pruned(wrapper))]})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [pickle.loads(p) for p in batch.column("part").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array([article_paths(w) for w in trees], pa.list_(pa.list_(pa.string()))),
                 pa.array([constant_lines(w) for w in trees], pa.list_(pa.string())),
                 pa.array([expression(w) for w in trees], pa.string()), pa.array([w.pages for w in trees], pa.int64())],
                names=["host", "paths", "constant", "wrapper", "n_pages"],
            )

    parts = stored(pages.select("host", "html").mapInArrow(read_pages, "host string, part binary"), "partial")
    while True:
        counts = stored(parts.groupBy("host").agg(F.count(F.lit(1)).alias("_n")), "hosts")
        most = counts.agg(F.max("_n")).first()[0] or 0
        if most <= 1:
            break
        parted = parts.withColumn("id", F.xxhash64("part")).join(counts, "host")
        salted = parted.withColumn("_salt", F.pmod("id", F.ceil(F.col("_n") / FAN_IN)))
        merged = salted.select("host", "id", "part", "_salt").groupBy("host", "_salt")
        before, parts = parts, stored(merged.applyInPandas(merge_parts, "host string, part binary"), "partial")
        release(before, counts)
    return parts.mapInArrow(
        finish, "host string, paths array<array<string>>, constant array<string>, wrapper string, n_pages long"
    )


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    A null or empty page has an empty text. Pages without host are one host. A page in
    which the places its host keeps articles in are missing gets a wrapper of its own.
    Repeated rows are read each for itself and count each in the wrapper; an empty table
    gives no rows; further columns are not read. Pages of any length are read whole:
    lines of siblings too long for a full alignment are aligned by occurrence, elements
    nested too deep are read in place. The order in which pages are merged depends on
    how the table is split, so an optional part may stand elsewhere in the wrapper.
    """
    host, _ = url_parts(F.col("url"))
    own = pages.select("page_id", "url", "html").withColumn("host", host)
    known = stored(wrappers(own.filter("html is not null")).select("host", "paths", "constant"), "wrappers")

    def read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("html", "paths", "constant")))
            texts = [page_text(html, paths, frozenset(constant or ())) for html, paths, constant in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    found = own.join(small(known), "host", "left").select("page_id", "url", "html", "paths", "constant")
    kind = pages.schema["page_id"].dataType.simpleString()
    return found.mapInArrow(read_pages, f"page_id {kind}, url string, text string, n_chars long")
