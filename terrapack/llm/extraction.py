"""HTML extraction by union-free wrappers, inferred for each host.

The pages of a host are aligned one after another as trees of tags and texts. Neighbours of one kind become a repeated
group, what some pages lack becomes optional, and texts that differ become slots; a text that more than half of the
pages with its region agree on is template.
"""

from __future__ import annotations

import bisect
import html as entities
import json
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import add_in_arrow, stored, table

#: Pages, or wrappers of parts of a host, that one alignment takes; a host's parts are aligned again until one is left.
FAN_IN = 256
#: Pages that must agree on a text before it counts as template.
CONSTANT_PAGES = 3
#: A text on fewer than one in so many of its region's pages is a slot's; template is what more than half have.
RARE = 8
#: Regions, blocks and marked elements around a text that tell where it lies: the outermost so many. Text is lost at no depth.
DEPTH = 64
#: Pairs of nodes of two regions that are all compared; in larger regions nodes that both have once lead.
CELLS_COMPARED = 1 << 18
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(/?)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
MAY_MARK = re.compile(r"(?i)class|id|role")
RAW = {"script", "style", "textarea", "noscript", "template", "svg", "iframe", "object", "select", "title", "head"}
INLINE = set("a abbr b bdi bdo big button cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: Elements that stand for a region; the others are blocks within one.
REGIONS = set("html body div section article main nav header footer aside form table ul ol dl figure details dialog menu fieldset".split())
#: Elements that a new one ends where their end tag was left out, and the elements beyond which nothing is ended.
CELLS = {"td", "th", "caption"}
NOT_INLINE: set[str] = set()  # stands for all others
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
ENDS = {"li": (("li",), REGIONS), "dt": (("dt", "dd"), REGIONS), "dd": (("dt", "dd"), REGIONS), "td": (("td", "th"), REGIONS | {"tr"}), "th": (("td", "th"), REGIONS | {"tr"}), "tr": (("tr",), REGIONS)}
ENDS |= {t: (("thead", "tbody", "tfoot", "caption"), REGIONS) for t in ("thead", "tbody", "tfoot")} | {h: (HEADINGS, REGIONS | CELLS) for h in HEADINGS}
NOT_MAIN = set("nav header footer aside form menu dialog button fieldset".split())
#: Words of classes, ids and roles that mark what is not the article.
NOT_MAIN_WORDS = set(
    "ad ads advert advertisement adverts sponsor sponsored promo promotion banner sidebar side menu nav navbar navigation breadcrumb breadcrumbs header footer masthead cookie cookies consent notice notices alert popup modal "
    "comment comments reply replies disqus respond share sharing social related recommended newsletter subscribe login signup search widget toolbar pagination pager contentinfo complementary".split()
)


#: Words that may stand beside such a word in one name: comment-list, site-header. With any other word the name says
#: something else: has-sidebar, ad-free, side-effects.
BESIDE = set("list item items box container wrapper wrap block area section bar slot unit site page post global main top bottom left right inner outer content text form link links button buttons icon icons posts articles primary secondary desktop mobile".split())


def named(attributes: str) -> dict[str, str]:
    """The values of class, id and role; the first of each counts."""
    out: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            out.setdefault(name.lower(), entities.unescape("".join(values)))
    return out


def parts_of(name: str) -> list[str]:
    return re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())


def words_of(attributes: str) -> list[str]:
    return [w for value in named(attributes).values() for w in parts_of(value)]


def marks(value: str, in_article: bool) -> bool:
    """Whether one of the names, as a whole, says that this is not the article. An article may have a header of its own."""
    for name in value.split():
        parts = parts_of(name)
        says = {w for w in parts if w in NOT_MAIN_WORDS and not (w == "header" and (in_article or "post" in parts))}
        if says and all(w in NOT_MAIN_WORDS or w in BESIDE for w in parts):
            return True
    return False


def mark_of(tag: str, names: dict[str, str], in_article: bool) -> str:
    if tag in NOT_MAIN and not (tag == "header" and in_article):
        return "sure"
    if any(marks(names.get(a, ""), in_article) for a in ("class", "role")):
        return "sure"
    if marks(names.get("id", ""), in_article):
        return "sure" if not in_article else "" if tag in INLINE or tag in HEADINGS else "by id"
    return ""


class Element(NamedTuple):
    tag: str
    label: str | None  # of a region
    main: bool
    mark: str  # "sure", "by id" (an article's headings have ids too, so pages must agree on the region), or empty
    number: int  # in page order
    depth: int  # regions down to it


class Block(NamedTuple):
    path: tuple[str, ...]  # labels of the regions it lies in
    tag: str  # tags of the blocks it lies in within the innermost region
    text: str
    inside: tuple[Element, ...]  # the articles and marked elements it lies in


class Open:
    """The elements that are open, and where the last ones of each kind are: nothing is searched for from the top."""

    def __init__(self):
        self.stack: list[Element] = []
        self.labels: list[str] = []  # of the regions
        self.chain: list[tuple[int, Element]] = []  # articles and marked elements with their places
        self.places: dict[str, list[int]] = {}
        self.regions: list[int] = []
        self.outer: list[int] = []  # elements that are not inline
        self.articles = self.number = 0

    def inline_on_top(self) -> bool:
        return bool(self.stack) and self.stack[-1].tag in INLINE

    def push(self, tag: str, label: str | None, main: bool, mark: str) -> None:
        self.number += 1
        e, at = Element(tag, label, main, mark, self.number, len(self.labels) + (label is not None)), len(self.stack)
        self.stack.append(e)
        self.places.setdefault(tag, []).append(at)
        if label is not None:
            self.labels.append(label)
        if tag in REGIONS:
            self.regions.append(at)
        if tag not in INLINE:
            self.outer.append(at)
        if main or mark:
            self.chain.append((at, e))
        self.articles += main

    def cut(self, to: int) -> None:
        """Closes all from that place on."""
        while len(self.stack) > to:
            e, at = self.stack.pop(), len(self.stack)
            self.places[e.tag].pop()
            if e.label is not None:
                self.labels.pop()
            for places in (self.regions, self.outer):
                if places and places[-1] == at:
                    places.pop()
            if self.chain and self.chain[-1][0] == at:
                self.chain.pop()
            self.articles -= e.main

    def last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def close(self, tags: tuple[str, ...], stops: set[str]) -> None:
        """Closes the last of these, unless a stop is open within it."""
        at = self.last(tags)
        if stops is NOT_INLINE:
            stop = self.outer[-1] if self.outer else -1
        elif stops:
            stop = max(self.regions[-1] if self.regions else -1, self.last(stops - REGIONS))
        else:
            stop = -1
        if at >= 0 and at >= stop:
            self.cut(at)

    def around(self) -> tuple[tuple[str, ...], str, tuple[Element, ...]]:
        """Where a block lies: its regions, its blocks within the innermost region, and its articles and marked elements."""
        top = len(self.stack)
        while top and self.stack[top - 1].tag in INLINE:
            top -= 1
        tags: list[str] = []
        at = top - 1
        while at >= 0 and self.stack[at].label is None and len(tags) < DEPTH:
            tags.append(self.stack[at].tag + "#" * (self.stack[at].mark == "by id"))
            at -= 1
        n = len(self.chain)
        while n and self.chain[n - 1][0] >= top:
            n -= 1
        return tuple(self.labels[:DEPTH]), ".".join(reversed(tags)), tuple(e for _, e in self.chain[: min(n, DEPTH)])


def blocks(page: str) -> list[Block]:
    """Blocks in page order. Scripts, styles, comments and the head give none. White space in a block is one space.

    A region's end tag closes what is open within it, a block's end tag what is open up to the next region; an end tag
    without its start is passed over. Blocks whose end tags may be left out end as HTML has it.
    """
    out: list[Block] = []
    now = Open()
    parts: list[str] = []
    absent: set[str] = set()  # tags that are not closed any more, and a body that does not come

    def end_block():
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                path, tag, inside = now.around()
                out.append(Block(path, tag, text, inside))

    def say(text: str) -> None:
        if not now.inline_on_top():  # only marked inline elements, and those within them, are on the stack
            parts.append(text)

    def ahead(name: str, pattern: str, at: int) -> re.Match | None:
        found = None if name in absent else re.compile(pattern, re.I).search(page, at)
        if found is None:
            absent.add(name)
        return found

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if m[3] is None:
            if m[1]:
                say(m[1].replace("&", "&amp;"))
            continue
        tag, closing = m[3].lower(), bool(m[2])
        if tag in INLINE:
            within = now.inline_on_top()
            if closing and within:
                now.close((tag,), NOT_INLINE)
            elif not closing and tag not in VOID:
                mark = ""
                if tag in NOT_MAIN or (m[4] and MAY_MARK.search(m[4]) and not now.places.get("pre")):  # highlighted code has comments
                    mark = mark_of(tag, named(m[4] or ""), now.articles > 0)
                if mark or within:
                    now.push(tag, None, False, mark)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        end_block()
        if tag in RAW and not closing and not m[5]:
            closes = ahead(tag, rf"</{tag}\s*>", at)
            inner = ahead("body", r"<body\b", at) if tag == "head" else None
            at = inner.start() if inner and (not closes or inner.start() < closes.start()) else closes.end() if closes else size if tag != "head" else at
        elif tag in VOID or tag in RAW:
            pass
        elif closing:
            now.close((tag,), set() if tag in REGIONS else REGIONS)
        else:
            now.close(("p",), REGIONS | CELLS)
            if tag in ENDS:
                now.close(*ENDS[tag])
            label = None
            main = False
            names = named(m[4]) if m[4] and tag not in ("html", "body") and MAY_MARK.search(m[4]) else {}
            mark = mark_of(tag, names, now.articles > 0) if tag != "main" else ""
            if tag in REGIONS:
                own = [w for value in names.values() for w in parts_of(value)]
                label = ".".join([tag, *own[:3]])
                main = tag in ("article", "main") or "articlebody" in "".join(own)
            now.push(tag, label, main, mark)
    end_block()
    return out


# A wrapper is [label, times, children, pages]: times is 1, ? (optional), + or * (repeated). A text is ["#", times, hash,
# pages, tag, tally] while it is constant and has None for the hash as a slot; tag is its block's, and the tally holds
# the pages of each of its texts, so that a page that deviates takes away no other page's count.


def text_hash(text: str) -> str:
    return f"{zlib.crc32(text.encode('utf-8', 'replace')):x}"


def page_tree(found: list[Block]) -> list:
    """The page's own wrapper: its regions and texts in order. What a page repeats counts as one page, at its first place."""
    root: list = ["", "1", [], 1]
    seen = set()
    for path, tag, text, _ in found:
        node = root
        for depth, label in enumerate(path, 1):
            if not node[2] or node[2][-1][0] != label:
                node[2].append([label, "1", [], int(path[:depth] not in seen)])
                seen.add(path[:depth])
            node = node[2][-1]
        key = text_hash(text)
        node[2].append(["#", "1", key, 1, tag, {key: int((path, tag, key) not in seen)}])
        seen.add((path, tag, key))
    return root


def _times(a: str, b: str) -> str:
    many, none = a in "+*" or b in "+*", a in "?*" or b in "?*"
    return "*" if many and none else "+" if many else "?" if none else "1"


def _constant(n: list, pages: int) -> bool:
    """Whether a text is one that pages have agreed on and that is no rarity among the region's pages."""
    return n[2] is not None and n[3] > 1 and RARE * n[3] >= pages


def _meet(x: list, y: list, fixed: bool) -> int:
    """How well two nodes of one region agree. A constant text agrees with the same text alone, a slot with its tag's texts."""
    if x[0] != y[0]:
        return 0
    if x[0] != "#":
        return 2
    if x[4] != y[4]:
        return 0
    few, many = (x[5], y[5]) if len(x[5]) < len(y[5]) else (y[5], x[5])
    return 3 if any(h in many for h in few) else 0 if fixed else 1


def _joined(x: list, y: list, times: str, pages: int) -> list:
    """The text or slot that covers two of one tag."""
    tally = dict(x[5])
    for h, n in y[5].items():
        tally[h] = tally.get(h, 0) + n
    return ["#", times, x[2] if x[2] == y[2] else None, pages, x[4], tally]


def _compared(x: list, y: list, fix_x: list[bool], fix_y: list[bool]) -> list[tuple[int, int]]:
    """The best common order of two lists of nodes: pairs that agree, over all pairs."""
    meets = [[_meet(n, m, f or g) for m, g in zip(y, fix_y, strict=True)] for n, f in zip(x, fix_x, strict=True)]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        row, under, meet = best[i], best[i + 1], meets[i]
        for j in range(len(y) - 1, -1, -1):
            skip = under[j] if under[j] > row[j + 1] else row[j + 1]
            row[j] = max(skip, under[j + 1] + meet[j]) if meet[j] else skip
    out, i, j = [], 0, 0
    while i < len(x) and j < len(y):
        if meets[i][j] and best[i][j] == best[i + 1][j + 1] + meets[i][j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _paired(x: list, y: list, fix_x: list[bool], fix_y: list[bool]) -> list[tuple[int, int]]:
    """Pairs of nodes that agree, in order. Long lists are parted at nodes that each has once, as far as those come in one
    order; where there are none, nodes of one kind are paired as they come."""
    if len(x) * len(y) <= CELLS_COMPARED:
        return _compared(x, y, fix_x, fix_y)
    once = []
    for nodes in (x, y):
        places: dict[tuple, list[int]] = {}
        for k, n in enumerate(nodes):
            places.setdefault((n[0], n[4], n[2]) if n[0] == "#" else (n[0],), []).append(k)
        once.append({key: p[0] for key, p in places.items() if len(p) == 1})
    anchors = _rising([(i, once[1][key]) for key, i in sorted(once[0].items(), key=lambda e: e[1]) if key in once[1] and _meet(x[i], y[once[1][key]], fix_x[i] or fix_y[once[1][key]])])
    if not anchors:
        kinds: dict[tuple, list[int]] = {}
        for j, n in enumerate(y):
            kinds.setdefault((n[0], n[4] if n[0] == "#" else ""), []).append(j)
        out, at = [], 0
        for i, n in enumerate(x):
            same = kinds.get((n[0], n[4] if n[0] == "#" else ""), [])
            k = bisect.bisect_left(same, at)
            if k < len(same) and _meet(n, y[same[k]], fix_x[i] or fix_y[same[k]]):
                out.append((i, same[k]))
                at = same[k] + 1
        return out
    out, low = [], (0, 0)
    for i, j in [*anchors, (len(x), len(y))]:
        between = _paired(x[low[0] : i], y[low[1] : j], fix_x[low[0] : i], fix_y[low[1] : j])
        out += [(low[0] + p, low[1] + q) for p, q in between]
        if i < len(x):
            out.append((i, j))
        low = (i + 1, j + 1)
    return out


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest part of pairs (by rising first value) whose second values rise too."""
    ends, tails, back = [], [], []
    for k, (_, j) in enumerate(pairs):
        at = bisect.bisect_left(ends, j)
        back.append(tails[at - 1] if at else -1)
        ends[at : at + 1], tails[at : at + 1] = [j], [k]
    out, k = [], tails[-1] if tails else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list, b: list) -> list:
    """The least wrapper of this form that covers both: nodes that agree are merged in order, the others become optional."""
    x, y, pages = a[2], b[2], a[3] + b[3]
    fix_x, fix_y = ([n[0] == "#" and _constant(n, w[3]) for n in w[2]] for w in (a, b))
    out, low = [], (0, 0)
    lone = lambda n: [n[0], _times(n[1], "?"), *n[2:]]
    for i, j in [*_paired(x, y, fix_x, fix_y), (len(x), len(y))]:
        out += [lone(n) for n in [*x[low[0] : i], *y[low[1] : j]]]
        if i < len(x):
            times = _times(x[i][1], y[j][1])
            out.append(_joined(x[i], y[j], times, x[i][3] + y[j][3]) if x[i][0] == "#" else [x[i][0], times, *align(x[i], y[j])[2:]])
        low = (i + 1, j + 1)
    folded: list = []
    for n in out:  # neighbours that alignment has brought together
        p = folded[-1] if folded and folded[-1][0] == n[0] else None
        if p is None or (n[0] == "#" and (p[4] != n[4] or _constant(p, pages) or _constant(n, pages))):
            folded.append(n)
        elif n[0] == "#":
            times = "*" if p[1] in "?*" and n[1] in "?*" else "+"
            folded[-1] = _joined(p, n, times, max(p[3], n[3]))
        else:
            folded[-1] = [n[0], "*", *align(p, n)[2:]]
    return [a[0], _times(a[1], b[1]), folded, pages]


def pruned(wrapper: list) -> list:
    """The wrapper without the counts of texts that few of a region's pages have: its size is then bounded by a page's."""
    out: list = []
    for n in wrapper[2]:
        if n[0] == "#":
            n = [*n[:5], {h: k for h, k in n[5].items() if RARE * k >= wrapper[3]}]
            if n[2] is not None and n[2] not in n[5]:
                n[2] = None
            if out and out[-1][0] == "#" and out[-1][4] == n[4] and n[2] is None and out[-1][2] is None:
                out[-1] = _joined(out[-1], n, "*" if out[-1][1] in "?*" and n[1] in "?*" else "+", max(out[-1][3], n[3]))
                continue
            out.append(n)
        else:
            out.append(pruned(n))
    return [*wrapper[:2], out, wrapper[3]]


def template_texts(wrapper: list) -> list[tuple[str, str, str]]:
    """(path, tag, hash) of the texts that most pages with their region agree on, CONSTANT_PAGES at least.

    With an empty hash: regions (and an empty tag) and blocks that are marked by id on CONSTANT_PAGES pages.
    """
    pages: dict[str, int] = {}
    texts: dict[tuple[str, str, str], int] = {}
    by_id: dict[tuple[str, str, str], int] = {}

    def walk(node: list, path: tuple[str, ...]) -> None:
        at = "/".join(path)
        pages[at] = pages.get(at, 0) + node[3]
        for n in node[2]:
            if n[0] != "#":
                walk(n, (*path, n[0]))
                continue
            if "#" in n[4]:
                by_id[at, n[4], ""] = max(by_id.get((at, n[4], ""), 0), n[3])
            for h, k in n[5].items():
                texts[at, n[4], h] = texts.get((at, n[4], h), 0) + k

    walk(wrapper, ())
    regions = [(at, "", "") for at, k in pages.items() if k >= CONSTANT_PAGES and not NOT_MAIN_WORDS.isdisjoint(at.rsplit("/", 1)[-1].split("."))]
    regions += [t for t, k in by_id.items() if k >= CONSTANT_PAGES]
    return regions + [t for t, k in texts.items() if k >= CONSTANT_PAGES and 2 * k > pages[t[0]]]


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the host's wrapper as JSON, from all pages (host, html).

    Equal trees of a host count once. A host's pages are dealt into parts of about FAN_IN by a hash, each part is aligned by itself, and the parts'
    wrappers likewise until each host has one: no task aligns a large host alone.
    """
    spread = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def trees():
        return lambda htmls: [[json.dumps(page_tree(blocks(h or ""))) for h in htmls]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree = None, None
        rows: tuple[list, list] = ([], [])
        for b in batches:
            for host, part, text in zip(b.column("host").to_pylist(), b.column("part").to_pylist(), b.column("wrapper").to_pylist(), strict=True):
                new = json.loads(text)
                if key == (host, part):
                    tree = align(tree, new)
                else:
                    if key is not None:
                        rows[0].append(key[0])
                        rows[1].append(json.dumps(pruned(tree)))
                    key, tree = (host, part), new
        if key is not None:
            rows[0].append(key[0])
            rows[1].append(json.dumps(pruned(tree)))
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.string())], names=["host", "wrapper"])

    now = stored(add_in_arrow(pages.select("host", "html"), ["html"], {"wrapper": "string"}, trees).select("host", "wrapper"), "page-trees")
    while True:
        now = now.distinct()  # equal pages tell nothing of what is template
        sizes = now.groupBy("host").agg(F.ceil(F.count("*") / F.lit(FAN_IN)).alias("parts"))
        most = sizes.agg(F.max("parts")).first()[0] or 1
        parts = now.join(sizes.withColumnRenamed("host", "__tp_host"), F.col("host") == F.col("__tp_host")).withColumn("part", F.pmod(F.xxhash64("wrapper"), "parts"))
        now = stored(parts.repartition(spread, "host", "part").sortWithinPartitions("host", "part", "wrapper").select("host", "part", "wrapper").mapInArrow(run, "host string, wrapper string"), "wrappers")
        if most <= 1:
            return now


def host_of(url: str = "url"):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def size_of(found: list[Block]) -> int:
    return sum(len(b.text) for b in found)


def chosen(found: list[Block], template: set[tuple[str, str, str]]) -> list[Block]:
    """What is main text among a page's blocks that are no template.

    Marked elements are left out, but not those around the page's main article, which is the largest one if it holds
    more than all that is unmarked outside of it: a page's layout is no sidebar. Of the rest, articles are the main text
    if what lies outside them is no larger than the largest. If it is more than twice as large they are cards or
    replies, and the outside is the main text. In between, and where the page has a <main>, both are kept.
    """

    def marked(b: Block, e: Element) -> bool:
        if e.mark != "by id":
            return e.mark == "sure"
        return ("/".join(b.path[: e.depth]), "", "") in template if e.label is not None else ("/".join(b.path), b.tag, "") in template

    def free(b: Block, around: frozenset[int] | set[int] = frozenset()) -> bool:
        return not any(marked(b, e) and e.number not in around for e in b.inside)

    articles: dict[int, list[Block]] = {}
    around: dict[int, set[int]] = {}
    for b in found:
        first = next((k for k, e in enumerate(b.inside) if e.main), None)
        if first is not None:
            outer = {e.number for e in b.inside[:first]}
            if free(b, outer):
                articles.setdefault(b.inside[first].number, []).append(b)
                around[b.inside[first].number] = outer
    layout: set[int] = set()
    if articles:
        best = max(articles, key=lambda k: (size_of(articles[k]), -k))
        if size_of(articles[best]) > size_of([b for b in found if free(b) and all(e.number != best for e in b.inside)]):
            layout = around[best]
    found = [b for b in found if free(b, layout)]
    outside = [b for b in found if not any(e.main for e in b.inside)]
    pieces: dict[Element, int] = {}
    for b in found:
        first = next((e for e in b.inside if e.main), None)
        if first is not None:
            pieces[first] = pieces.get(first, 0) + len(b.text)
    largest = max(pieces, key=lambda e: (pieces[e], -e.number), default=None)
    if largest is None or (size_of(outside) > 2 * pieces[largest] and all(e.tag == "article" for e in pieces)):
        return outside
    return found if size_of(outside) > pieces[largest] else [b for b in found if any(e.main for e in b.inside)]


def main_text(page: str | None, template: set[tuple[str, str, str]]) -> str:
    """The blocks that the wrapper does not tell as template, of the article where the page has one, joined by line feeds."""
    found = [b for b in blocks(page or "") if ("/".join(b.path), b.tag, text_hash(b.text)) not in template]
    return "\n".join(b.text for b in chosen(found, template))


def extract(pages: DataFrame) -> DataFrame:
    """All columns of `pages` (url, html and others) with `text`, the main text, and `n_chars`, its code points.

    A null or empty html gives an empty text. Pages without a host (null or other urls) form one host of their own.
    Repeated rows are pages like others. Elements may be nested to any depth and left open. A host's wrapper tells its template texts; regions are told by their tags and
    by the words of their classes, ids and roles. Column names that start with __tp_ are reserved.
    """
    rows = pages.withColumn("__tp_host", host_of())
    wrappers = infer_wrappers(rows.select(F.col("__tp_host").alias("host"), "html"))

    def templates():
        return lambda found: [[json.dumps(template_texts(json.loads(w))) for w in found]]

    known = add_in_arrow(wrappers, ["wrapper"], {"template": "string"}, templates).select(F.col("host").alias("__tp_of"), F.col("template").alias("__tp_template"))
    rows = rows.join(stored(known, "templates"), F.col("__tp_host") == F.col("__tp_of"), "left")

    def work():
        sets: dict[str, set] = {}

        def texts(htmls: list, found: list) -> list:
            sets.clear()
            for t in set(found):
                sets[t] = {tuple(x) for x in json.loads(t or "[]")}
            out = [main_text(h, sets[t]) for h, t in zip(htmls, found, strict=True)]
            return [out, [len(x) for x in out]]

        return texts

    return add_in_arrow(rows, ["html", "__tp_template"], {"text": "string", "n_chars": "bigint"}, work).drop("__tp_host", "__tp_of", "__tp_template")


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
