"""Main-text extraction by wrapper induction over the pages of a host.

Pages of one host come from one template. Every page's DOM is reduced to slots
(repeated siblings with the same key are one slot) at full depth; the frame of
a host is the union of the slot trees of all its pages, so a slot is aligned by
its path of keys. All pages of the host that have a slot vote on it: how often
its text was the same. Constant slots are template; varying slots are content,
unless their markup names them (menus, headers, footers, sidebars, notices,
adverts, forms, comments) or nearly all their text is links. A second pass over
the pages drops the template and reads the text of what is left, from the
article and main elements where a page has some. Inside these only what repeats
the host's constant text and is less than half of them is template, and nothing
if the element repeats as a whole (the same article on several pages of a host
is still an article). Elsewhere a slot with half or more of the page's text is
template only if it repeats the constant text and other text is left.

Votes are summed inside a task before they are shuffled: a row per host, path
and different text. The wrappers hold one row per host with the paths that are
template or links; their size is known when the second pass is planned, so
Spark broadcasts them below its limit and otherwise shuffles pages by host,
where AQE splits a large host.

Defined cases: null or empty html gives an empty text; a null url makes a host
of its own; a host with one page has no votes and only the markup rules;
repeated rows are extracted each; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Collection, Iterator
from functools import lru_cache
from hashlib import blake2b
from html import unescape
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearcast.session import materialize

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*>|([^<]+|<)", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
# fixed values: element kinds of HTML and the names that mark boilerplate
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math object select".split())
BLOCK = frozenset("""html head body address article aside blockquote center dd details dialog dir div dl dt fieldset
 figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody
 td tfoot th thead tr ul caption legend""".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
HOLDS = frozenset("ul ol dl table menu dir article section div body main".split())
DROPPED = frozenset("head nav footer aside form menu dialog button fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = frozenset("""nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead banner ad ads advert
 adverts advertisement sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal
 newsletter subscribe signup login comment comments disqus reply replies respond share sharing social related
 recommended widget toolbar search pagination pager skip hidden""".split())
WORDS = re.compile(r"[a-z]+")
DEPTH = 200
#: A slot is template if at least this share of the other pages that have it, and two at least, repeat its text.
CONSTANT_SHARE, LINK_SHARE = 0.6, 0.7


class Node:
    __slots__ = ("tag", "key", "parent", "children", "dropped", "main", "block", "links", "depth")

    def __init__(self, tag, key, parent, dropped, block):
        self.tag, self.key, self.parent, self.dropped, self.block = tag, key, parent, dropped, block
        self.children: list = []
        self.main = False
        self.links = 0
        self.depth = parent.depth + 1 if parent else 0


@lru_cache(maxsize=20_000)
def described(tag: str, attributes: str) -> tuple[str, int, bool]:
    """Slot key, whether the element is boilerplate (1: by its names; 2: always), whether it is the main element."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    names = WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", f"{found.get('class', '')} {found.get('id', '')}").lower())
    role = found.get("role", "").lower()
    key = tag + "".join(f".{n}" for n in sorted(set(names)))
    main = tag in ("article", "main") or role == "main"
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    dropped = 2 if tag in DROPPED or hidden else 0
    if not dropped and (role in ROLES or not NAMES.isdisjoint(names)) and tag not in ("html", "body", "main"):
        dropped = 1
    return key, dropped, main and dropped != 1


def parse(html: str) -> Node:
    """A tree of block elements and of inline elements that are boilerplate; text runs are strings."""
    root = here = Node("", "", None, 0, True)
    link, at, end = False, 0, len(html)
    search = TOKEN.match
    while at < end:
        m = search(html, at)
        if m is None:
            here.children.append(html[at])
            at += 1
            continue
        at = m.end()
        if m[7] is not None:
            here.children.append(m[7])
            if link:
                here.links += len(m[7])
            continue
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if tag == "a":
                link = False
            block, n = tag in BLOCK, here
            while n.parent and n.tag != tag and (block or not n.block):
                n = n.parent
            if n.parent and n.tag == tag:
                here = n.parent
            continue
        attributes = m[3] if m[2] else m[6]
        if tag in RAW:
            if not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                at = close.end() if close else end
            continue
        if tag == "br":
            here.children.append(" ")
            continue
        if tag == "a":
            link = True
        if tag in VOID:
            if tag == "hr":
                here.children.append(Node("hr", "hr", here, 0, True))
            continue
        block = tag in BLOCK
        key, dropped, main = described(tag, attributes) if attributes or tag in DROPPED or block else (tag, 0, False)
        if not block and not dropped:
            continue
        if block:
            n = here
            while n.parent and not n.block:
                n = n.parent
            if n.tag == "p":
                here = n.parent
            ends = CLOSES.get(tag)
            if ends:
                n = here
                while n.parent and n.tag not in HOLDS:
                    if n.tag in ends:
                        here = n.parent
                    n = n.parent
        if tag == "header" and not dropped:
            n = here
            while n.parent and not n.main:
                n = n.parent
            dropped = 0 if n.parent else 2
        node = Node(tag, key, here, dropped, block)
        here.children.append(node)
        if main:
            node.main = True
            n = here
            while n and n.dropped == 1:  # a wrapper named after its sidebar still holds the article
                n.dropped, n = 0, n.parent
        if here.depth < DEPTH and not (len(attributes) and attributes[-1] == "/" and not block):
            here = node
    return root


class Slot:
    __slots__ = ("key", "children", "crc", "chars", "links", "number")

    def __init__(self, key):
        self.key, self.children, self.crc, self.chars, self.links, self.number = key, {}, 0, 0, 0, -1


def slots(root: Node) -> tuple[Slot, dict[int, Slot]]:
    """The page's slot tree, and the slot of each node by the node's ``id``."""
    top, of = Slot(""), {}
    todo = [(root, top)]
    of[id(root)] = top
    while todo:
        node, slot = todo.pop()
        slot.links += node.links
        for c in node.children:
            if isinstance(c, str):
                if not c.isspace():
                    slot.crc = crc32(c.strip().encode("utf-8", "surrogatepass"), slot.crc)
                    slot.chars += len(c)
            else:
                s = slot.children.setdefault(c.key, None) or Slot(c.key)
                slot.children[c.key] = of[id(c)] = s
                todo.append((c, s))
    close(top)
    return top, of


def close(slot: Slot) -> None:
    """Add up what lies below each slot."""
    for s in slot.children.values():
        close(s)
        slot.crc = crc32(s.crc.to_bytes(4, "little"), slot.crc)
        slot.chars += s.chars
        slot.links += s.links


@lru_cache(maxsize=100_000)
def path(above: int, key: str) -> int:
    """Name of a slot: a hash of the keys from the root down to it."""
    return int.from_bytes(blake2b(b"%d %b" % (above, key.encode("utf-8", "surrogatepass")), digest_size=8).digest(), "little", signed=True)


def paths(top: Slot) -> Iterator[tuple[int, Slot]]:
    """All slots of a page by path."""
    todo = [(0, top)]
    while todo:
        above, s = todo.pop()
        yield above, s
        todo += [(path(above, c.key), c) for c in s.children.values()]


def checksum(s: Slot) -> int:
    """Stands for the text below a slot; 0 if there is none."""
    return s.crc | (s.chars & 0x7FFFFFFF) << 32 if s.chars else 0


def numbered(packed: list) -> list:
    """[key, checksum, children, number] in document order."""
    count = 0

    def walk(p: list) -> list:
        nonlocal count
        number, count = count, count + 1
        return [p[0], p[1], [walk(c) for c in p[2]], number]
    return walk(packed)


def matched(a: list, b: Slot) -> tuple[int, list]:
    """Simple tree matching: size of the largest ordered matching of two trees and its pairs."""
    left, right = a[2], list(b.children.values())
    keys = {s.key for s in right}
    left = [x for x in left if x[0] in keys]
    keys = {x[0] for x in left}
    right = [s for s in right if s.key in keys]
    pairs = [(a, b)]
    if [x[0] for x in left] == [s.key for s in right]:  # same keys in the same order: all match
        size = 1
        for x, s in zip(left, right, strict=True):
            n, p = matched(x, s)
            size += n
            pairs += p
        return size, pairs
    best: list[list[tuple[int, list]]] = [[(0, [])] * (len(right) + 1)]
    for x in left:
        row = [(0, [])]
        for j, s in enumerate(right):
            top = max(best[-1][j + 1], row[j], key=lambda v: v[0])
            if x[0] == s.key:
                n, p = matched(x, s)
                if best[-1][j][0] + n > top[0]:
                    top = best[-1][j][0] + n, best[-1][j][1] + p
            row.append(top)
        best.append(row)
    return 1 + best[-1][-1][0], pairs + best[-1][-1][1]


def text_of(html: str | None, template: dict[int, int] | None, links: Collection[int]) -> str:
    """The main text of one page; ``template`` has the constant text of each template path of the host."""
    if not html:
        return ""
    root = parse(html)
    regions = main_regions(root)
    if not (template if regions else template or links):
        return text_below(regions or [root], ())
    top, of = slots(root)
    at = {id(s): p for p, s in paths(top)}

    def repeats(s: Slot) -> bool:
        return s.chars > 0 and template.get(at[id(s)]) == checksum(s)

    if regions:
        whole = {id(s): s for r in regions if not repeats(s := of[id(r)])}
        banned = {id(n) for r in regions if id(of[id(r)]) in whole for n in nodes(r)
                  if n is not r and repeats(s := of[id(n)]) and 2 * s.chars < of[id(r)].chars}
        return text_below(regions, banned)
    small = {n for n, s in of.items() if s is not top and 2 * s.chars < top.chars and (at[id(s)] in template or at[id(s)] in links)}
    large = {n for n, s in of.items() if s is not top and 2 * s.chars >= top.chars and repeats(s)}
    # a page that repeats others as a whole still has its largest part for a text
    return text_below([root], small | large) or text_below([root], small)


def text_below(regions: list[Node], banned: Collection[int]) -> str:
    blocks: list[str] = []
    for r in regions:
        read(r, banned, blocks)
    return "\n".join(blocks)


def nodes(region: Node) -> Iterator[Node]:
    todo = [region]
    while todo:
        n = todo.pop()
        yield n
        todo += [c for c in n.children if not isinstance(c, str)]


def main_regions(root: Node) -> list[Node]:
    """Outermost articles that are not boilerplate and outermost main elements without such an article, in page order."""
    found, holds, todo = [], set(), [(root, None)]
    while todo:
        n, within = todo.pop()
        if n.dropped:
            continue
        if n.main and (within is None or n.tag == "article"):
            found.append(n)
            if within is not None:
                holds.add(id(within))
            if n.tag == "article":
                continue
            within = n
        todo += [(c, within) for c in reversed(n.children) if not isinstance(c, str)]
    return [n for n in found if id(n) not in holds]


def read(region: Node, banned: Collection[int], blocks: list[str]) -> None:
    """Append the blocks of text below a node in page order."""
    run: list[str] = []

    def flush() -> None:
        if run:
            s = "".join(run)
            run.clear()
            if s := " ".join((unescape(s) if "&" in s else s).split()):
                blocks.append(s)

    todo: list = [region]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            run.append(n)
        elif n is None:
            flush()
        elif n.block:
            flush()
            if not n.dropped and id(n) not in banned:
                todo.append(None)
                todo += reversed(n.children)
        # an inline element is a node only because it is boilerplate
    flush()


def host_of(url: str = "url"):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def induce(pages: DataFrame) -> DataFrame:
    """host, rules: one row per host that has a template or links. ``pages`` has host and html."""
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = defaultdict(lambda: [0, 0, 0])
        for b in batches:
            for host, html in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for p, s in paths(slots(parse(html))[0]):
                    v = sums[host, p, checksum(s)]
                    v[0] += 1
                    v[1] += s.chars
                    v[2] += s.links
                if len(sums) > 50_000:
                    yield votes(sums)
                    sums.clear()
        yield votes(sums)

    counted = pages.where("html <> ''").select("host", "html").mapInArrow(
        vote, "host string, path long, text long, n long, chars long, links long")
    texts = counted.groupBy("host", "path", "text").agg(*(F.sum(c).alias(c) for c in ("n", "chars", "links")))
    # how many pages have the path, and the text that most of them have there
    slot = texts.groupBy("host", "path").agg(
        *(F.sum(c).alias(c) for c in ("n", "chars", "links")),
        F.max(F.when(F.col("text") != 0, F.struct("n", "text"))).alias("most"))
    others = F.col("n") - 1
    rules = slot.where("path <> 0").select(
        "host", "path", F.when(F.col("most.n") - 1 >= F.greatest(F.lit(2), CONSTANT_SHARE * others), F.col("most.text")).alias("template"),
        (F.col("links") > LINK_SHARE * F.greatest(F.col("chars"), F.lit(1))).alias("links"))
    return materialize(rules.where("template is not null or links").groupBy("host").agg(
        F.collect_list(F.struct("path", "template", "links")).alias("rules")))


def votes(sums: dict) -> pa.RecordBatch:
    rows = [(*k, *v) for k, v in sums.items()]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    kinds = [pa.string(), *[pa.int64()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      names=["host", "path", "text", "n", "chars", "links"])


def wrapper(rules: list | None) -> tuple[dict[int, int], set[int]]:
    """The constant text of each template path, and the paths that are links."""
    rules = rules or ()
    return {r["path"]: r["template"] for r in rules if r["template"] is not None}, {r["path"] for r in rules if r["links"]}


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url and text of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).withColumn("host", host_of())
    wrappers = induce(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for b in batches:
            texts = []
            for html, host, rules in zip(*(c for c in b.columns[2:]), strict=True):
                host = host.as_py()
                if host not in known:
                    if len(known) > 500:
                        known.clear()
                    known[host] = wrapper(rules.as_py())
                texts.append(text_of(html.as_py(), *known[host]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])
    joined = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "host", "rules")
    return joined.mapInArrow(run, "page_id long, url string, text string")
