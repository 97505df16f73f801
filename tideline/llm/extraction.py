"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page is a stream of structural tags and text slots.  Its *shape* is that stream with equal
neighbours and repeated runs of neighbours as repeated groups, and with texts replaced by slots.  The streams of a
host are aligned one after another: where two differ, the side whose token comes later in
the other gives an optional part, equal neighbours become repeated, and differing texts a slot.  The result, the
host's wrapper, is a union-free regular expression; each slot knows on how many pages it stands,
how much of it is links, and whether its text is the same on all of them.

Shapes and their counts are combined within tasks before they are exchanged, so a host with a third of
all pages costs a row for each shape and task.  Shapes of a host are merged in buckets of some
``FAN`` of them, round by round, in the order of their text, so the wrapper does not depend on how rows are dealt.

A page is read by its host's wrapper: the slots of its shape are aligned with those of the wrapper,
and the slots that belong to the article are kept.  The article is what ``article`` elements hold; where there is none, a
``main`` element, else an element named as content, else the innermost element that holds
most of the host's changing text; in the last two, slots of unchanging text (on three
pages or more) and of links are left out.  Parts whose tag or name says menu, header, footer, sidebar, notice, advert,
form or reader comments are left out everywhere; a header inside the article stays if it holds a heading.

Cases: null or empty html gives an empty text; a null url is the empty host; hosts are compared as in ``urls``.  Tags are read
as browsers do: missing end tags are implied, raw text (script, style) ends at its end tag, a tag that the
page breaks off is dropped, character references without semicolon are known as in HTML 5.  Elements
nested more than 100 deep belong to the one at that depth (their texts are kept as blocks).  Texts of any length are whole.
Repeated rows and ids are judged each by itself.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import importable, materialize, partitions, pick, small

DEPTH = 100
FAN = 256
FLUSH = 16 << 20  # characters of shapes that a task holds before it passes them on
UNCHANGING = 3  # pages

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|))*+)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# fixed values: elements and names of HTML pages
BLOCKS = set("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav noscript ol optgroup option p pre
section select summary svg table tbody td template tfoot th thead tr ul video audio canvas object""".split())
RAW = set("script style title textarea iframe xmp noembed noframes".split())
CLOSE_P = BLOCKS - set("button caption head html body li dd dt noscript object optgroup option svg tbody td tfoot th thead tr video audio canvas legend".split()) | {"li", "dd", "dt", "hr"}
IN_HEAD = set("title meta link style script base noscript template".split())
CONTAINERS = {"div", "section"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SCOPES = {"table", "td", "th", "caption", "html", "template"}
AWAY_TAGS = set("""head nav header footer aside form fieldset button select option optgroup legend dialog menu noscript svg
template video audio canvas object""".split())
AWAY = set("""nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar header masthead banner topbar footer
colophon copyright sidebar aside widget widgets rail ad ads adv advert adverts advertisement advertising advertorial sponsor
sponsored promo promotion promoted cookie cookies consent gdpr notice notices alert popup modal overlay newsletter
subscribe subscription signup login comment comments commentlist disqus respond reply replies share sharing
social related recommended recommendations search form pagination pager hidden complementary contentinfo""".split())
KEPT_HEADERS = {"header", "banner", "masthead"}
ADVERTS = set("ad ads adv advert adverts advertisement sponsored promo".split())
CONTENT = set("article content post entry story maincontent articlebody".split())


class Node:
    """An element, a repeated group of elements, or a text slot (key ``#``) of a shape."""

    __slots__ = ("key", "opt", "rep", "kids", "stat")

    def __init__(self, key, kids, stat=None, opt=False, rep=False):
        self.key, self.kids, self.stat, self.opt, self.rep = key, kids, stat, opt, rep

    def plain(self):
        q = self.opt + 2 * self.rep
        return [self.key, q] if self.kids is None else [self.key, q, [k.plain() for k in self.kids]]

    def slots(self):
        if self.kids is None:
            yield self
        else:
            for k in self.kids:
                yield from k.slots()


def read(plain, stats: Iterator) -> Node:
    """The node of ``plain()``; its slots take their statistics from ``stats`` in order."""
    key, q, *kids = plain
    node = Node(key, None, opt=bool(q & 1), rep=bool(q & 2))
    if kids:
        node.kids = [read(k, stats) for k in kids[0]]
    else:
        node.stat = next(stats)
    return node


def expression(node: Node) -> str:
    """The wrapper as text: ``<tag>...</tag>``, ``( ... )`` for groups, ``#`` for slots, with ``?``, ``+``, ``*``."""
    mark = ("", "?", "+", "*")[node.opt + 2 * node.rep]
    if node.kids is None:
        return "#" + mark
    inner = "".join(expression(k) for k in node.kids)
    if node.key.startswith("("):
        return f"({inner}){mark}"
    whole = f"<{node.key}>{inner}</{node.key.split('.')[0]}>"
    return f"({whole}){mark}" if mark else whole


# ---- alignment
def merge(a: Node, b: Node) -> Node:
    """``a``, made to match what ``b`` matches too; ``b`` is used up."""
    a.opt, a.rep = a.opt or b.opt, a.rep or b.rep
    if a.kids is None:
        a.stat = joined(a.stat, b.stat)
    else:
        a.kids = align(a.kids, b.kids)
    return a


def joined(s, t):
    """Statistics of a slot: pages, runs, characters, those in links, least and greatest hash; or its runs on one page."""
    if isinstance(s, list):
        s += t
        return s
    return s[0] + t[0], s[1] + t[1], s[2] + t[2], s[3] + t[3], min(s[4], t[4]), max(s[5], t[5])


def align(a: list[Node], b: list[Node]) -> list[Node]:
    """Two sequences as one, in order; at a mismatch the shorter of the two ways to go on becomes optional."""
    at = [{}, {}]
    for where, side in zip(at, (a, b)):
        for i, node in enumerate(side):
            where.setdefault(node.key, []).append(i)

    def later(side: int, key: str, start: int):
        found = at[side].get(key, ())
        k = bisect_left(found, start)
        return found[k] if k < len(found) else None

    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b):
            if a[i].key == b[j].key:
                out.append(merge(a[i], b[j]))
                i, j = i + 1, j + 1
                continue
            p, q = later(1, a[i].key, j), later(0, b[j].key, i)
            take_b = p is not None and (q is None or p - j <= q - i)
            skip_a, skip_b = (0, p - j) if take_b else (q - i, 0) if q is not None else (1, 1)
        else:
            skip_a, skip_b = len(a) - i, len(b) - j
        for node in a[i : i + skip_a] + b[j : j + skip_b]:
            node.opt = True
            out.append(node)
        i, j = i + skip_a, j + skip_b
    return repeated(out)


def repeated(nodes: list[Node]) -> list[Node]:
    """Equal neighbours as one repeated node; containers without a meaning of their own must hold the same, too."""
    out = []
    for node in nodes:
        if out and out[-1].key == node.key and (
                node.key.split(".", 1)[0] not in CONTAINERS or [k.key for k in out[-1].kids] == [k.key for k in node.kids]):
            opt = out[-1].opt and node.opt
            merge(out[-1], node)
            out[-1].rep, out[-1].opt = True, opt
        else:
            out.append(node)
    return out


def squares(nodes: list[Node]) -> list[Node]:
    """Repeated runs of neighbours as repeated groups."""
    out, last, groups = [], {}, []  # where a key stood last, and where the groups are
    for node in repeated(nodes):
        out.append(node)
        while True:
            n = len(out) - 1 - groups[-1] if groups else 0
            if n and n == len(out[-1 - n].kids) and out[-1 - n].key == group_key(out[-n:]):
                run = out[-n:]
                del out[-n:]
                out[-1].kids = align(out[-1].kids, run)
                break
            key = out[-1].key
            before = last.get(key, len(out))
            n = len(out) - 1 - before if before < len(out) - 1 and out[before].key == key else 0
            if n < 2 or len(out) < 2 * n or any(out[-1 - k].key != out[-1 - k - n].key for k in range(n)):
                last[key] = len(out) - 1
                break
            first, second = out[-2 * n : -n], out[-n:]
            del out[-2 * n :]
            while groups and groups[-1] >= len(out):
                groups.pop()
            groups.append(len(out))
            out.append(Node(group_key(first), [merge(x, y) for x, y in zip(first, second)], rep=True))
    return out


def group_key(nodes: list[Node]) -> str:
    return "(" + " ".join(n.key for n in nodes) + ")"


# ---- pages
_KEYS: dict[tuple[str, str], tuple[str, bool]] = {}


def element(name: str, attributes: str) -> tuple[str, bool]:
    """The key of an element (tag and names, digits as 0), and whether it is named as an advert or hidden."""
    got = _KEYS.get((name, attributes))
    if got is None:
        words = []
        for m in ATTRIBUTE.finditer(attributes):
            words += re.split(r"[^a-z0-9]+", CAMEL.sub("-", next(x for x in (*m.groups()[1:], "") if x is not None)).lower())
        if re.search(r"(^|\s)hidden(\s|=|/|$)|display\s*:\s*none", attributes, re.I):
            words.append("hidden")
        words = sorted({re.sub("[0-9]+", "0", w) for w in words if w})
        got = ".".join([name, *words]), bool(ADVERTS.intersection(words)) or "hidden" in words
        if len(_KEYS) > 50_000:
            _KEYS.clear()
        _KEYS[name, attributes] = got
    return got


class Page:
    """The blocks of text of a page, and its tree of structural elements."""

    def __init__(self, html: str):
        self.texts: list[str] = []
        self.links: list[int] = []
        self.root = Node("html", [])
        self.stack: list[tuple[str, Node]] = [("html", self.root)]
        self.open = Counter(["html"])
        self.buffer, self.linked, self.in_link = [], 0, 0
        self.dropped: list[str] = []  # open inline elements named as adverts, outermost first
        pos, n = 0, len(html)
        for_end = {}
        while pos < n:
            m = TOKEN.search(html, pos)
            self.text(html[pos : m.start() if m else n])
            if not m:
                break
            pos = m.end()
            if not m[2] or not m[4]:
                continue
            name = m[2].lower()
            if name in RAW and not m[1]:
                self.start(name, "")
                if name not in for_end:
                    for_end[name] = re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I)
                end = for_end[name].search(html, pos)
                pos = end.end() if end else n
            elif m[1]:
                self.end(name)
            else:
                self.start(name, m[3])
        self.flush()

    def text(self, raw: str) -> None:
        if raw and not self.dropped:
            piece = unescape(raw) if "&" in raw else raw
            self.buffer.append(piece)
            if self.in_link:
                self.linked += len(piece)

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.stack[-1][1].kids.append(Node("#", None, [len(self.texts)]))
                self.texts.append(text)
                self.links.append(min(self.linked, len(text)))
            self.buffer, self.linked = [], 0

    def start(self, name: str, attributes: str) -> None:
        if self.open["head"] and name not in IN_HEAD and name != "head":
            self.close("head")
        if name == "a":
            self.in_link = 1
        elif name in ("br", "hr"):
            self.text(" ")
        if name in CLOSE_P and self.open["p"]:
            self.close("p", SCOPES | {"button"})
        if name not in BLOCKS:
            if name == "hr":
                self.flush()
            elif self.dropped:
                if name == self.dropped[0]:
                    self.dropped.append(name)
            elif name in ("a", "span", "ins") and element(name, attributes)[1]:
                self.dropped.append(name)
            return
        self.dropped = []
        self.flush()
        if name in ("html", "body") and self.open[name]:
            return
        if name == "li" and self.open["li"]:
            self.close("li", SCOPES | {"ul", "ol", "menu", "dir"})
        elif name in ("dd", "dt"):
            self.close("dd", SCOPES | {"dl"}) or self.close("dt", SCOPES | {"dl"})
        elif name in ("td", "th"):
            self.close("td", {"table", "html"}) or self.close("th", {"table", "html"})
        elif name in ("tr", "tbody", "thead", "tfoot"):
            for inner in ("tr",) if name == "tr" else ("tbody", "thead", "tfoot"):
                self.close(inner, {"table", "html"})
        elif name in HEADINGS and self.stack[-1][0] in HEADINGS:
            self.close(self.stack[-1][0])
        elif name == "option":
            self.close("option", {"select", "html"})
        node = self.stack[-1][1]
        if len(self.stack) < DEPTH:
            node = Node(element(name, attributes)[0], [])
            self.stack[-1][1].kids.append(node)
        self.stack.append((name, node))
        self.open[name] += 1

    def end(self, name: str) -> None:
        if name == "a":
            self.in_link = 0
        if name not in BLOCKS:
            if self.dropped and name == self.dropped[-1]:
                self.dropped.pop()
            return
        if name in ("html", "body"):
            return
        self.dropped = []
        self.flush()
        table = {"table", "html"} if name in ("tr", "tbody", "thead", "tfoot", "td", "th", "caption") else {"html"}
        self.close(name, table if name == "table" or len(table) > 1 else SCOPES | ({"ul", "ol"} if name == "li" else set()))

    def close(self, name: str, scopes=frozenset({"html"})) -> bool:
        """End the innermost element of this name, and all in it, unless one of ``scopes`` stands between."""
        if not self.open[name]:
            return False
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == name:
                self.flush()
                for inner, _ in self.stack[i:]:
                    self.open[inner] -= 1
                del self.stack[i:]
                return True
            if self.stack[i][0] in scopes:
                return False
        return False

    def shape(self) -> Node:
        """The tree without elements that hold no text, its repetitions as groups; slots hold the numbers of their texts."""
        def fold(node: Node) -> Node | None:
            if node.kids is None:
                return node
            kids = [k for k in map(fold, node.kids) if k is not None]
            if not kids:
                return None
            node.kids = squares(kids)
            return node

        return fold(self.root) or Node("html", [])


def page_stats(page: Page, slot: Node):
    hashes = [xxhash.xxh3_64_intdigest(page.texts[i].encode()) >> 1 for i in slot.stat]
    return (1, len(hashes), sum(len(page.texts[i]) for i in slot.stat), sum(page.links[i] for i in slot.stat), min(hashes), max(hashes))


def shape_text(shape: Node) -> str:
    return json.dumps(shape.plain(), separators=(",", ":"))


# ---- the article
def wanted(shape: Node) -> list[bool]:
    """For each slot of a shape, with the statistics of its wrapper: whether it belongs to the article."""
    def tag(node: Node) -> str:
        return node.key.split(".", 1)[0]

    def names(node: Node) -> set[str]:
        return set(node.key.split(".")[1:])

    def holds(node: Node, tags: set[str]) -> bool:
        return any(tag(k) in tags or holds(k, tags) for k in node.kids or ())

    def away(node: Node, inside: bool, strict: bool) -> bool:
        t, said = tag(node), names(node) & AWAY
        if node.kids is None or node.key.startswith("(") or t in HEADINGS or t in ("html", "body", "main"):
            return False
        if inside and (t == "header" or said) and t not in AWAY_TAGS - {"header"} and said <= KEPT_HEADERS and holds(node, HEADINGS):
            return False
        if not strict and (said or t == "form") and t not in ("nav", "aside", "footer", "header") and not said & {"comment", "comments"} and holds(node, {"article", "main"}):
            return False
        return t in AWAY_TAGS or bool(said)

    def roots(node: Node, fits, strict: bool) -> Iterator[Node]:
        """The outermost nodes that fit, outside of parts that are left out."""
        for k in node.kids or ():
            if away(k, False, strict):
                continue
            if k.kids is not None and not k.key.startswith("(") and fits(k):
                yield k
            else:
                yield from roots(k, fits, strict)

    def take(node: Node, changing_only: bool) -> None:
        for k in node.kids:
            if k.kids is None:
                if not changing_only or (changes(k) and 2 * k.stat[3] <= k.stat[2]):
                    chosen.add(id(k))
            elif not away(k, True, True):
                take(k, changing_only)

    def changes(slot: Node) -> bool:
        return alike or slot.stat[0] < UNCHANGING or slot.stat[4] != slot.stat[5]

    def weight(node: Node) -> int:
        """Characters of changing text outside of links and of parts that are left out."""
        if node.kids is None:
            return max(node.stat[2] - 2 * node.stat[3], 0) if changes(node) else 0
        return sum(weight(k) for k in node.kids if not away(k, False, False))

    chosen: set[int] = set()
    alike = False
    named = [lambda k: tag(k) == "article", lambda k: tag(k) == "main" or "main" in names(k)]
    for fits in named:
        for strict in (True, False):
            found = list(roots(shape, fits, strict))
            if found:
                for node in found:
                    take(node, False)
                return [id(s) in chosen for s in shape.slots()]
    alike = not any(map(changes, shape.slots()))  # all pages say the same
    whole = weight(shape)
    found = [k for k in roots(shape, lambda k: bool(names(k) & CONTENT), False) if 2 * weight(k) > whole]
    node = found[0] if found else shape
    while not found:  # down to the innermost element with most of the text
        inner = [k for k in node.kids or () if k.kids is not None and not k.rep and not away(k, False, False) and 5 * weight(k) > 4 * whole]
        if not inner or tag(inner[0]) in HEADINGS | {"p"}:
            break
        node = inner[0]
    if node.kids:
        take(node, True)
    return [id(s) in chosen for s in shape.slots()]


# ---- in tasks
_SHAPES = "host string, shape string, stats array<struct<pages:long,runs:long,chars:long,linked:long,lo:long,hi:long>>"
_STATS = pa.list_(pa.struct([(k, pa.int64()) for k in ("pages", "runs", "chars", "linked", "lo", "hi")]))
_FIELDS = ("pages", "runs", "chars", "linked", "lo", "hi")


def _shape_batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
        pa.array([[dict(zip(_FIELDS, s)) for s in r[2]] for r in rows], _STATS)], ["host", "shape", "stats"])


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages -> shapes of each host and their statistics, combined within the task."""
    held, size = {}, 0
    for batch in batches:
        for host, html in zip(batch.column("host"), batch.column("html")):
            page = Page(html.as_py() or "")
            shape = page.shape()
            key = host.as_py(), shape_text(shape)
            stats = [page_stats(page, s) for s in shape.slots()]
            old = held.get(key)
            if old is None:
                size += len(key[1])
            held[key] = stats if old is None else [joined(s, t) for s, t in zip(old, stats)]
            if size > FLUSH:
                yield _shape_batch([(*k, v) for k, v in held.items()])
                held, size = {}, 0
    if held:
        yield _shape_batch([(*k, v) for k, v in held.items()])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, len(batch), 64):
            yield from batch.slice(at, 64).to_pylist()


def _tuples(stats: list[dict]) -> list[tuple]:
    return [tuple(s[f] for f in _FIELDS) for s in stats]


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of host and shape -> one for each of these."""
    for (host, shape), rows in groupby(_rows(batches), key=lambda r: (r["host"], r["shape"])):
        total = None
        for row in rows:
            stats = _tuples(row["stats"])
            total = stats if total is None else [joined(s, t) for s, t in zip(total, stats)]
        yield _shape_batch([(host, shape, total)])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of host, bucket and shape -> one wrapper for each host and bucket."""
    for (host, _), rows in groupby(_rows(batches), key=lambda r: (r["host"], r["bucket"])):
        wrapper = None
        for row in rows:
            node = read(json.loads(row["shape"]), iter(_tuples(row["stats"])))
            wrapper = node if wrapper is None else merge(wrapper, node)
        yield _shape_batch([(host, shape_text(wrapper), [s.stat for s in wrapper.slots()])])


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shapes with their host's wrapper -> which of their slots belong to the article."""
    for batch in batches:
        out = []
        for row in _rows([batch]):
            plain = json.loads(row["shape"])
            places = read(plain, iter([[i] for i in range(len(row["stats"]))]))
            pattern = read(json.loads(row["wrapper"]), iter([[-1 - i] for i in range(len(row["wrapper_stats"]))]))
            known, mine = _tuples(row["wrapper_stats"]), _tuples(row["stats"])
            stats = list(mine)
            for slot in merge(pattern, places).slots():  # which slots of the shape fell on which of the wrapper
                of_wrapper = [known[-1 - i] for i in slot.stat if i < 0]
                for i in slot.stat:
                    if i >= 0 and of_wrapper:
                        total = of_wrapper[0]
                        for s in of_wrapper[1:]:
                            total = joined(total, s)
                        stats[i] = total
            flags = wanted(read(plain, iter(stats)))
            out.append((row["host"], shape_key(row["shape"]), flags))
        yield pa.RecordBatch.from_arrays([
            pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()),
            pa.array([o[2] for o in out], pa.list_(pa.bool_()))], ["host", "shape_key", "flags"])


def shape_key(text: str) -> str:
    return xxhash.xxh3_128_hexdigest(text.encode())


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages -> the same with their shape and their texts, each with its slot."""
    for batch in batches:
        for at in range(0, len(batch), 64):
            part, keys, blocks = batch.slice(at, 64), [], []
            for html in part.column("html"):
                page = Page(html.as_py() or "")
                shape = page.shape()
                owner = [0] * len(page.texts)
                for k, slot in enumerate(shape.slots()):
                    for i in slot.stat:
                        owner[i] = k
                keys.append(shape_key(shape_text(shape)))
                blocks.append([{"slot": s, "text": t} for s, t in zip(owner, page.texts)])
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id").cast(pa.int64()), part.column("url").cast(pa.string()), part.column("host").cast(pa.string()),
                 pa.array(keys, pa.string()), pa.array(blocks, pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())])))],
                ["page_id", "url", "host", "shape_key", "blocks"])


# ---- on tables
def with_host(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, host``."""
    rows = pick(pages, page_id="page_id", url="url", html="html")
    host = F.translate(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return rows.withColumn("host", host)


def shapes(pages: DataFrame) -> DataFrame:
    """``host, shape, stats``: the distinct shapes of each host, as a table."""
    n = partitions(pages.sparkSession)
    parts = with_host(pages).select("host", "html").mapInArrow(_shapes, _SHAPES)
    dealt = parts.repartition(n, "host", F.xxhash64("shape")).sortWithinPartitions("host", "shape")
    return materialize(dealt.mapInArrow(_combined, _SHAPES), "shapes")


def infer(found: DataFrame) -> DataFrame:
    """``host, shape, stats``: one wrapper for each host, from its ``shapes``."""
    spark = found.sparkSession
    while True:
        most = found.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        bucket = F.pmod(F.xxhash64("shape"), F.lit(max(-(-most // FAN), 1)))
        dealt = found.withColumn("bucket", bucket).repartition(partitions(spark), "host", "bucket")
        found = materialize(dealt.sortWithinPartitions("host", "bucket", "shape").mapInArrow(_merged, _SHAPES), "wrappers")
        if most <= FAN:
            return found


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper, n_slots``: each host's wrapper as a regular expression over tags."""
    importable(pages.sparkSession)

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            nodes = [read(json.loads(r["shape"]), iter(_tuples(r["stats"]))) for r in rows]
            yield pa.RecordBatch.from_arrays([
                pa.array([r["host"] for r in rows], pa.string()), pa.array(map(expression, nodes), pa.string()),
                pa.array([sum(1 for _ in n.slots()) for n in nodes], pa.int64())], ["host", "wrapper", "n_slots"])

    return infer(shapes(pages)).mapInArrow(run, "host string, wrapper string, n_slots long")


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``."""
    importable(pages.sparkSession)
    found = shapes(pages)
    made = infer(found).select("host", F.col("shape").alias("wrapper"), F.col("stats").alias("wrapper_stats"))
    made = small(made, entries=F.size("wrapper_stats") * 8)
    judged = found.join(made, "host").mapInArrow(_judged, "host string, shape_key string, flags array<boolean>")
    judged = materialize(judged, "judged")
    read_pages = with_host(pages).mapInArrow(
        _blocks, "page_id long, url string, host string, shape_key string, blocks array<struct<slot:int,text:string>>")
    kept = F.expr("transform(filter(blocks, b -> flags[b.slot]), b -> b.text)")
    return read_pages.join(small(judged, entries=F.size("flags")), ["host", "shape_key"]).select(
        "page_id", "url", F.array_join(kept, "\n\n").alias("text")).withColumn("n_chars", F.length("text").cast("long"))
