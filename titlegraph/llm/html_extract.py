"""Operator 3: the main text of web pages, by site style trees.

1. Each page is parsed into a tree. A node's place in its site's style tree is its host with its chain of tags, classes
   and ids, as a 64-bit number.
2. The pages of one host are merged. A place's presentation importance is the entropy of the child sequences that it has
   on the host's pages, its content importance the entropy of what stands there, times the part of the pages' text that
   it holds: menus, notices and footers have one form, or a few, and little text, even where their words change from page
   to page. Counts are summed by (place, content, form) first, so a hot host is spread over all tasks, and only its
   places, not its pages, meet.
3. Branches of low importance go, but not inside an article: its headings, bylines and the like may be the same on all
   pages of a site and still belong to it. There, on sites with too few pages for entropies, and for places of middling
   importance, the page's own marks decide: elements such as nav and footer, roles, and classes and ids that name menus,
   headers, footers, sidebars, notices, adverts, forms or comments. Classes and ids that only may be marks, such as the
   id 'side-effects' or the class 'related' in an article, need a place with contents of no more than middling importance
   beside.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, slabs, tidy
from .url_filter import canonical

#: A place is boilerplate if its importance is below LOW on at least MIN_PAGES different pages of the host.
LOW, MIN_PAGES = 0.2, 5
#: A class or id that may be a mark is one if the importance of the place's contents is below CONFIRMED.
CONFIRMED = 0.5
#: Flags of a place: it goes outside of articles, it confirms a mark that is not sure.
OUTSIDE, CONFIRMS = 1, 4
#: Places of 12 bytes up to which their table is broadcast (as a Python dict, about 100 bytes each); a larger one is joined by shuffle.
BROADCAST_PLACES = 500_000

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"\s+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title xmp iframe noframes".split())
#: Elements without text of the page.
_NO_TEXT = frozenset("head script style noscript template textarea title xmp iframe noframes select svg canvas object".split())
_SKIP = frozenset("head script style noscript template textarea title xmp iframe noframes nav header footer aside form menu button select input svg canvas object dialog".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
#: A start tag closes an open element of these kinds, up to the nearest of the second set.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
_MARK = re.compile(
    r"nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|side|widget|ads?|advert(?:s|isements?|ising|orials?)?|banner|promo(?:s|tions?|tional|ted)?|sponsor(?:s|ed|ship)?|cookies?|consent|notice|popup|modal|newsletter|subscribe|share|social|comments?|replies|disqus|related|login|signup|search|toolbar|copyright|disclaimer|pagination|pager",
    re.I,
)
#: Marks that are also words of headings, from which ids are made.
_WEAK = frozenset("side search related modal navigation notice consent copyright disclaimer advertising promotion sponsorship".split())
_UNMARKED = frozenset("html body article main h1 h2 h3 h4 h5 h6 hgroup".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alertdialog alert toolbar".split())


class Node:
    __slots__ = ("tag", "place", "skip", "weak", "inside", "children", "parent", "near")

    def __init__(self, tag: str, place: int, skip: bool, weak: bool, parent: Node | None):
        self.tag, self.place, self.skip, self.weak, self.children, self.parent = tag, place, skip, weak, [], parent
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        # the nearest open element of each kind that a start tag may close
        self.near = {} if parent is None else parent.near
        change = {k: None for k, v in self.near.items() if v is not None and tag in _CLOSES[k][1]}
        change |= {k: self for k, (kinds, _) in _CLOSES.items() if tag in kinds}
        if change:
            self.near = self.near | change


def marked(name: str, classes: str, own_id: str, inside: bool) -> tuple[bool, bool]:
    """Whether class and id mark an element as no part of the text: surely, and if the style tree confirms it.

    A whole class or id that is a mark is sure, but for weak marks in ids and inside an article; so is a class of which a
    part is a mark that is not weak, outside of articles. Other parts are not sure. Headings are never marked.
    """
    sure = weak = False
    if name not in _UNMARKED:
        for token, free in [*((c, not inside) for c in classes.split()), (own_id.strip(), False)]:
            found = [x.lower() for x in re.split("[_-]", token) if _MARK.fullmatch(x)]
            strong = any(x not in _WEAK for x in found)
            weak = weak or bool(found)
            sure = sure or strong and (free or found == [token.lower()]) or free and found == [token.lower()]
    return sure, weak


class _Tokens:
    """Tags of a page in order, in time that grows with its length alone, however broken it is."""

    def __init__(self, page: str):
        self.page, self.patience, self.absent = page, 50, set()

    def after_end_tag(self, name: str, at: int) -> int | None:
        """Where the next end tag of that name ends; None if there is none."""
        if name in self.absent:
            return None
        found = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(self.page, at)
        if found is None:
            self.absent.add(name)
            return None
        return found.end()

    def __iter__(self) -> Iterator[tuple[int, int, str, bool, str]]:
        """(start, end, name, whether it ends an element, attributes); comments and the like have an empty name. A next
        search begins at self.at."""
        page, self.at = self.page, 0
        while (start := page.find("<", self.at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                self.at = len(page) if end < 0 else end + 3
                yield start, self.at, "", False, ""
                continue
            m = _TAG.match(page, start)
            if m is None and not page.startswith(("<!", "<?"), start):
                self.at = start + 1
                yield start, start, "", False, ""  # no tag: a plain character
                continue
            body = start + 2 if m is None else m.end()
            quoted = _REST.match(page, body) if m is not None and self.patience else None
            if quoted is None:
                self.patience -= m is not None and self.patience > 0
                end = page.find(">", body)
                if end < 0:  # nothing can be a tag from here on
                    return
                end += 1
            else:
                end = quoted.end()
            self.at = end
            yield start, end, "" if m is None else m.group(2).lower(), m is not None and bool(m.group(1)), page[body : end - 1]


def parse(page: str, site: str = "") -> Node:
    """The page's tree of block elements, and of marked inline ones; other inline elements leave their text in their parents."""
    root = Node("#", xxhash.xxh64_intdigest(site.encode("utf-8", "surrogatepass")), False, False, None)
    node, text, opened = root, 0, Counter()
    tokens = _Tokens(page)

    def close(last: Node) -> Node:
        """last and all in it end here."""
        up = node
        while up is not last:
            opened[up.tag] -= 1
            up = up.parent
        opened[last.tag] -= 1
        return last.parent

    for start, end, name, ends, attributes in tokens:
        if start > text:
            node.children.append(page[text:start])
        text = end
        if not name:
            continue
        if ends:
            if opened[name]:
                up = node
                while up.tag != name:
                    up = up.parent
                node = close(up)
            elif name == "p":
                node.children.append(None)
            continue
        if name in _RAW:
            if not attributes.endswith("/") or name not in ("iframe", "title"):
                after = tokens.after_end_tag(name, end)
                tokens.at = text = len(page) if after is None else after
            continue
        if name == "br":
            node.children.append(" ")
            continue
        if name in _VOID:
            if name == "hr":
                node.children.append(None)
            continue
        block = name in _BLOCK
        if not block and name in _SKIP:  # such as button and select: up to the end tag, if there is one
            after = tokens.after_end_tag(name, end)
            if after is not None:
                tokens.at = text = after
            continue
        label, skip, weak = name, name in _SKIP, False
        if attributes.strip(" /\n\t"):
            attrs = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(attributes)}
            marks = " ".join(attrs[k] for k in ("class", "id") if k in attrs)
            label += "." + marks if marks else ""
            skip = skip or attrs.get("role", "").lower() in _ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true"
            if marks:
                sure, weak = marked(name, attrs.get("class", ""), attrs.get("id", ""), node.inside)
                skip = skip or sure
        if not block and not (skip and not attributes.endswith("/")):
            continue
        if block:
            if name in _CLOSES:
                last = node.near.get(name)
                if last is not None:
                    node = close(last)
            elif node.tag == "p" or node.tag in _HEADINGS and name in _HEADINGS:
                node = close(node)
        child = Node(name, xxhash.xxh64_intdigest(label.encode("utf-8", "surrogatepass"), node.place), skip, weak, node)
        node.children.append(child)
        opened[name] += 1
        node = child
    if text < len(page):
        node.children.append(page[text:])
    return root


def _main(root: Node, goes: Callable[[Node], bool]) -> list[Node]:
    """The outermost article elements; else the main element; else the page."""
    for tag in ("article", "main"):
        found, todo = [], [root]
        while todo:
            n = todo.pop()
            if goes(n):
                continue
            if n.tag == tag:
                found.append(n)
            else:
                todo += [c for c in reversed(n.children) if isinstance(c, Node)]
        if found:
            return found
    return [root]


def _clean(raw: str) -> str:
    return _SPACE.sub(" ", entities.unescape(raw)).strip(" ")


def blocks(root: Node, low: dict[int, int] | None = None, marks: bool = True) -> list[str]:
    """The page's blocks of text in order, without branches that the tree's places in low, or the page's own marks, remove.

    low: flags by place. Without marks the tree alone decides, but for what holds no text of the page, such as scripts.
    """
    low = low or {}

    def goes(n: Node) -> bool:
        flags = low.get(n.place, 0)
        if flags & OUTSIDE and not n.inside:
            return True
        return n.tag in _NO_TEXT or marks and (n.skip or n.weak and bool(flags & CONFIRMS))

    out: list[str] = []
    for top in _main(root, goes) if marks else [root]:
        todo, text = [(top, 0)], []
        while todo:
            n, i = todo.pop()
            while i < len(n.children):
                c = n.children[i]
                i += 1
                if isinstance(c, str):
                    text.append(c)
                    continue
                inline = isinstance(c, Node) and c.tag not in _BLOCK
                if not inline:
                    out.append(_clean("".join(text)))
                    text = []
                if c is not None and not goes(c):
                    todo += [(n, i)]
                    n, i = c, 0
            if n.tag in _BLOCK or not todo:
                out.append(_clean("".join(text)))
                text = []
    return [x for x in out if x]


def places(root: Node) -> list[tuple[int, int, int, int, str]]:
    """(place, hash of its contents, hash of its presentation, characters, tag) of every place of the page that has text.

    A place's contents are what stands in its elements, its presentation the tags and classes of their children in order.
    """
    own: dict[int, list] = {}
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += [c for c in n.children if isinstance(c, Node)]
    inner: dict[int, tuple[bytes, int]] = {}
    for n in reversed(order):  # children before parents; a node's content is the hash of its parts
        parts, size = [], 0
        for c in n.children:
            if isinstance(c, Node):
                raw, more = inner[id(c)]
            else:
                raw = (c or "").strip().encode("utf-8", "surrogatepass")
                more = len(raw)
            parts.append(raw)
            size += more
        inner[id(n)] = content = (xxhash.xxh64_digest(b"\x1f".join(parts)) if size else b"", size)
        if size:
            held = own.setdefault(n.place, [[], [], 0, n.tag])
            held[0].append(content[0])
            held[1].append(np.array([c.place for c in n.children if isinstance(c, Node)], np.uint64).tobytes())
            held[2] += size
    return [(p, xxhash.xxh64_intdigest(b"|".join(c)), xxhash.xxh64_intdigest(b"|".join(f)), size, tag) for p, (c, f, size, tag) in own.items()]


def style_tree(pages: DataFrame) -> DataFrame:
    """(place, tag, pages, presentation, content, share, importance) from (host, html): the merged style trees of all hosts.

    A place is a host with a chain of tags, classes and ids. Pages that are equal in all their blocks count once.
    presentation is the entropy of the place's child sequences, content that of what stands there, both over the most it
    could be, log(pages); share is the part of the pages' characters that stands there. importance is
    presentation + (1 - presentation) * content * share.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        names = ["place", "content", "form", "page", "size", "whole", "tag"]

        def emit() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True)) if held else [[]] * 7
            out = pa.RecordBatch.from_arrays([*(pa.array(np.array(columns[i], np.uint64).view(np.int64)) for i in range(4)), pa.array(columns[4], pa.int64()), pa.array(columns[5], pa.int64()), pa.array(columns[6], pa.string())], names=names)
            held.clear()
            return out

        for b in slabs(batches, 1):
            for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                root = parse(page or "", host)
                found = places(root)
                text = xxhash.xxh64_intdigest("\n".join(blocks(root)).encode("utf-8", "surrogatepass"))
                whole = max((size for _, _, _, size, _ in found), default=0)
                held += [(place, content, form, text, size, whole, tag) for place, content, form, size, tag in found]
                if len(held) > 100_000:
                    yield emit()
        yield emit()

    rows = pages.select("host", "html").mapInArrow(tidy(count), "place long, content long, form long, page long, size long, whole long, tag string")
    rows = rows.groupBy("place", "content", "form", "page").agg(F.max("size").alias("size"), F.max("whole").alias("whole"), F.max("tag").alias("tag"))
    rows = cut(rows.groupBy("place", "content", "form").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), F.sum("whole").alias("whole"), F.max("tag").alias("tag")), "style-tree")

    def entropy(of: str) -> DataFrame:
        n, total = rows.groupBy("place", of).agg(F.sum("n").alias("n"), F.sum("size").alias("size"), F.sum("whole").alias("whole"), F.max("tag").alias("tag")), F.sum("n")
        value = F.when(total > 1, (F.log(total) - F.sum(F.col("n") * F.log("n")) / total) / F.log(total)).otherwise(1.0)
        return n.groupBy("place").agg(value.alias(of), total.alias("pages"), (F.sum("size") / F.sum("whole")).alias("share"), F.max("tag").alias("tag"))

    both = entropy("content").join(entropy("form").select("place", F.col("form").alias("presentation")), "place")
    importance = F.col("presentation") + (1 - F.col("presentation")) * F.col("content") * F.col("share")
    return both.select("place", "tag", "pages", "presentation", "content", "share", importance.alias("importance"))


def low_places(tree: DataFrame, low: float = LOW, min_pages: int = MIN_PAGES) -> DataFrame:
    """(place, flags) of the places of a style_tree() on at least min_pages pages that remove a branch.

    Outside of articles a place goes if its importance is below low (a heading: if its content is). CONFIRMS, with contents
    of no more than middling importance, lets a mark that is not sure count, inside too.
    """
    heading = F.col("tag").isin(sorted(_HEADINGS))
    outside = F.when(heading | F.col("tag").isin("article", "main", "body", "html", "#"), F.col("content")).otherwise(F.col("importance")) < low
    flags = F.when(outside, OUTSIDE).otherwise(0) + F.when(F.col("content") < CONFIRMED, CONFIRMS).otherwise(0)
    return tree.where(F.col("pages") >= min_pages).select("place", flags.cast("int").alias("flags")).where("flags > 0")


def extract(pages: DataFrame, low: float = LOW, min_pages: int = MIN_PAGES, url_col: str = "url", html_col: str = "html", tree: bool = True, marks: bool = True) -> DataFrame:
    """pages without its html, with text (blocks joined by a newline; empty if none) and n_chars (code points) added.

    Null html is empty. Pages without a host are merged with each other. Columns named text and n_chars are replaced;
    repeated rows each get a row; an empty table gives none. Texts are whole, whatever their length. tree and marks switch
    the style tree, or the page's own marks and article elements, off.
    """
    keep = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    host, k = canonical(F.col(url_col))[0], len(keep)
    rows = pages.select(*keep, F.col(html_col).cast("string").alias("__html"), host.alias("__at"))
    sent, joined = None, None
    if tree:
        found = cut(low_places(style_tree(pages.select(host.alias("host"), F.col(html_col).cast("string").alias("html"))), low, min_pages), "low-places")
        if found.count() <= BROADCAST_PLACES:
            held = found.toArrow()
            sent = pages.sparkSession.sparkContext.broadcast(dict(zip(np.asarray(held.column(0)).view(np.uint64).tolist(), held.column(1).to_pylist(), strict=True)))
        else:
            joined = found

    by_page = joined is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slabs(batches, k):
            own = ({} if sent is None else sent.value for _ in range(b.num_rows)) if not by_page else ({x["place"] & (1 << 64) - 1: x["flags"] for x in own or ()} for own in b.column(k + 2).to_pylist())
            texts = ["\n".join(blocks(parse(h or "", at), low, marks)) for h, at, low in zip(b.column(k).to_pylist(), b.column(k + 1).to_pylist(), own, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=[f"c{i}" for i in range(k + 2)])

    if joined is not None:  # each page with those of its own places that are low
        rows = rows.withColumn("__m", F.monotonically_increasing_id())
        rows = cut(rows, "pages")

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slabs(batches, 1):
                own = [[n[0] for n in places(parse(h or "", at))] for h, at in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
                lists = pa.array([np.array(x, np.uint64).view(np.int64) for x in own], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([b.column(0), lists], names=["__m", "own"])

        asked = rows.select("__m", "__html", "__at").mapInArrow(tidy(listed), "__m long, own array<long>").select("__m", F.explode("own").alias("place"))
        mine = asked.join(joined, "place").groupBy("__m").agg(F.collect_list(F.struct("place", "flags")).alias("__low"))  # a page's own places
        rows = rows.join(mine, "__m", "left").select(*keep, "__html", "__at", "__low")
    schema = ", ".join([f"c{i} {pages.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)] + [f"c{k} string, c{k + 1} long"])
    return rows.toDF(*[f"c{i}" for i in range(len(rows.columns))]).mapInArrow(tidy(run), schema).toDF(*keep, "text", "n_chars")
