"""Main text of web pages: site templates found by recurring subtrees, page furniture by its markup."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from keyloom.llm.common import cut, small_enough, type_of

# HTML elements by role, and words in names of classes that mark page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt figcaption tr td th".split())
SENTENCES = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())
FURNITURE = frozenset("head nav footer aside form script style noscript template iframe button select textarea input svg canvas dialog object embed noembed noframes menu title datalist audio video map xmp".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
REMARKS = frozenset("comment comments respond disqus reply replies".split())
MARKS = REMARKS | frozenset(
    "nav navbar navigation menu submenu sidebar sidenav aside footer header masthead topbar banner ad ads adv advert adverts advertisement advertisements adsense sponsor sponsored "
    "promo promotion cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended recommendations breadcrumb breadcrumbs widget widgets pagination pager toolbar skip".split()
)
BESIDE = frozenset(
    "a all app area article articles bar block blog body bottom box btn button buttons card cards col column container content cta entry feed fixed for form global google group head icon icons inner "
    "item items js large left link links list main media mini mobile of one our page pages panel policy post posts primary rail reader readers right row secondary section site slot small sticky stories "
    "sub tags text the thread title to top topics ui unit us user users warning web wrap wrapper you your".split()
)
OWN_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select", "datalist"}}

TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
TAG_STOP = re.compile(r"[>\"']")
DECLARED = re.compile(r"<[!?]")
#: An ordinary tag: a short name, and attributes of bounded length without brackets in quotes. It never looks far, and gives nothing back.
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]{0,30}+)(?=[\s/>])((?:[^<>\"']{1,300}+|\"[^\"<>]{0,300}+\"|'[^'<>]{0,300}+'){0,24}+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACES = re.compile(r"\s+")
NAME = re.compile(r"[a-z]+")
#: Templates that go to all tasks at most; more are joined page by page.
BROADCAST_ROWS = 200_000


@lru_cache(maxsize=50_000)
def marks_of(name: str) -> tuple[frozenset[str], bool]:
    """The marks in one class or id, and whether it holds nothing else.

    A name counts as a whole: words beside the marks must be such as place them ("site-footer"). One that says something
    else ("share-price"), or what a layout has ("no-sidebar"), marks nothing.
    """
    words = set(NAME.findall(name.lower()))
    found = words & MARKS
    return (frozenset(found), found == words) if found and words <= MARKS | BESIDE else (frozenset(), False)


class Node:
    """An element: its tag, what its tag and markup say of it, and its children, elements and strings.

    ``drop`` is furniture by tag, ``marked`` by markup, ``remarks`` marks readers' comments and ``header`` a header. ``mass`` is the
    number of characters of its text, furniture by tag left out; ``headed`` says whether a main heading lies in it.
    """

    __slots__ = ("tag", "drop", "marked", "remarks", "header", "key", "children", "hash", "main", "mass", "headed")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag, self.children, self.key, self.hash, self.main = tag, [], "", 0, tag == "main"
        self.mass, self.headed = 0, False
        self.drop, self.marked, self.remarks, self.header = tag in FURNITURE, False, False, tag == "header"
        if attributes and "=" in attributes or "hidden" in attributes:
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
            role = found.get("role", "").lower()
            self.main = self.main or role == "main"
            self.key = found.get("class", "") + "#" + found.get("id", "")
            names = set()
            for name in (*found.get("class", "").split(), found.get("id", "")):
                own, whole = marks_of(name)
                if whole or tag not in SENTENCES:
                    names |= own
            if tag == "article":
                self.marked = self.remarks = bool(names & REMARKS)
            elif tag not in ("html", "body", "main"):
                hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
                # a header may hold the article's own title, so that is for the reader of the tree to say
                self.header = self.header or names == {"header"}
                self.marked = bool(names - {"header"}) or role in ROLES or hidden
                self.remarks = bool(names & REMARKS)


class Tags:
    """Finds where tags end, over a page from left to right, and looks at no character more than a few times.

    A tag whose quotes or brackets don't close is none; the places that showed it are kept, as every later tag that meets one of
    them, in the same state, fails as well.
    """

    def __init__(self, html: str) -> None:
        self.html, self.last, self.doomed = html, html.rfind(">"), set()
        self.special, self.since = -1, 0

    def _next(self, at: int) -> int:
        """The next quote or closing bracket from ``at`` on."""
        if not (self.since <= at <= self.special):
            m = TAG_STOP.search(self.html, at)
            self.since, self.special = at, m.start() if m else len(self.html)
        return self.special

    def end(self, at: int) -> int:
        """The place of the bracket that closes the tag whose name ends at ``at``, or -1."""
        opened = []
        while at <= self.last:
            stop = self._next(at)
            if stop >= len(self.html) or stop in self.doomed:
                break
            if self.html[stop] == ">":
                return stop
            opened.append(stop)
            at = self.html.find(self.html[stop], stop + 1) + 1
            if not at:
                break
        self.doomed.update(opened)
        return -1


class Open:
    """The elements that are open, and where in their stack those of a tag lie."""

    def __init__(self, root: Node) -> None:
        self.stack, self.places, self.walls = [root], {}, [0]

    def place(self, tags) -> int:
        """The innermost open element of these tags, or -1."""
        best = -1
        for t in tags:
            if (found := self.places.get(t)) and found[-1] > best:
                best = found[-1]
        return best

    def push(self, node: Node) -> None:
        at = len(self.stack)
        self.stack.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag != "p" and (node.tag in BLOCK or node.tag in ("td", "th", "button")):
            self.walls.append(at)

    def close(self, at: int) -> None:
        """Closes the element at ``at`` and all in it."""
        while len(self.stack) > at:
            self.places[self.stack.pop().tag].pop()
            if self.walls[-1] >= len(self.stack):
                self.walls.pop()


def parse(html: str) -> Node:
    """The element tree of a page, with the end tags that HTML implies, in time linear in its length.

    A ``<`` that begins no tag, and one whose tag does not close, is text; a comment that does not close is the rest.
    """
    root = Node("#root")
    open_, tags = Open(root), Tags(html)
    begin = at = 0
    n = len(html)

    def text(until: int) -> None:
        if until > begin:
            open_.stack[-1].children.append(unescape(html[begin:until]))

    while (lt := html.find("<", at)) >= 0:
        if html.startswith(("<!", "<?"), lt):
            closing = "-->" if html.startswith("<!--", lt) else ">"
            end = html.find(closing, lt + 4 if len(closing) == 3 else lt)
            text(lt)
            begin = at = end + len(closing) if end >= 0 else n
            continue
        if plain := PLAIN_TAG.match(html, lt):
            ends, tag, attributes, gt = plain[1], plain[2].lower(), plain[3], plain.end() - 1
        else:
            ends = html.startswith("</", lt)
            name = TAG_NAME.match(html, lt + 1 + ends)
            if not name:
                at = lt + 1
                continue
            gt = tags.end(name.end())
            if gt < 0:
                # no tag begins in its name either
                inner = DECLARED.search(html, lt + 1, name.end())
                at = inner.start() if inner else name.end()
                continue
            tag, attributes = name[0].lower(), html[name.end() : gt]
        text(lt)
        begin = at = gt + 1
        if ends:
            if (k := open_.place((tag,))) > 0:
                open_.close(k)
            continue
        if tag in BLOCK and (k := open_.place(("p",))) > open_.walls[-1]:
            open_.close(k)
        if tag in OWN_END:
            while (k := open_.place(OWN_END[tag])) > open_.place(STOPS[tag]):
                open_.close(k)
                if tag != "tr":
                    break
        node = Node(tag, attributes)
        if node.marked and open_.place(("pre",)) > 0:
            node.marked = False  # listings colour their comments
        open_.stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            begin = at = end.end() if end else n
        elif tag not in VOID and not attributes.endswith("/"):
            open_.push(node)
    text(n)
    weigh(root)
    return root


def weigh(top: Node) -> None:
    """Gives every element its ``mass`` and whether it is ``headed``, from the innermost outwards."""
    order = [top]
    for node in order:
        order += [c for c in node.children if type(c) is Node]
    for node in reversed(order):
        mass, headed = 0, node.tag in ("h1", "h2")
        for c in node.children:
            if type(c) is str:
                mass += len(c.strip())
            else:
                headed = headed or c.headed
                if not c.drop:
                    mass += c.mass
        node.mass, node.headed = mass, headed


def hash_subtrees(top: Node) -> None:
    """Gives every element below ``top`` the hash of its subtree: tag, class, id, text and children."""
    stack: list[tuple[Node, bool]] = [(top, False)]
    while stack:
        node, done = stack.pop()
        if not done:
            stack.append((node, True))
            stack += [(c, False) for c in node.children if isinstance(c, Node)]
            continue
        parts = [node.tag, node.key]
        parts += [f"{c.hash:x}" if isinstance(c, Node) else SPACES.sub(" ", c).strip() for c in node.children]
        node.hash = xxh64_intdigest("\x1f".join(parts).encode("utf-8", "replace"))


def _find(root: Node, wanted, passes) -> list[Node]:
    """Outermost elements that are ``wanted``, below elements that let one pass."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if not passes(node):
            continue
        if wanted(node):
            found.append(node)
            continue
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return found


def _main(root: Node) -> list[Node]:
    """The articles outside furniture and other articles, else the main elements, else the whole page.

    Where marks hide all of them, a mark was that of a layout ("with-sidebar"): then only tags count.
    """
    for passes in (lambda x: not x.drop and not x.marked, lambda x: not x.drop):
        for wanted in (lambda x: x.tag == "article", lambda x: x.main):
            if found := _find(root, wanted, passes):
                return found
    return [root]


#: Runs of text ``(edge, text, place)``, and the hashes of subtrees with the place of the subtree that each lies in, or -1.
Outline = tuple[list[list], list[int], list[int]]


def outline(html: str | None) -> Outline:
    """The text of the main part as runs ``(edge, text, place)``, and the subtrees that they lie in.

    A block begins at an edge; a place is the innermost subtree of a run, whose others follow from what each lies in. Furniture by tag
    or markup is left out, and white space is one space. Where markup alone would leave nothing, it says nothing. In an
    article or main element single prose elements are no subtrees, as sites do quote themselves, nor is what holds most of
    its text.
    """
    if not html:
        return [], [], []
    root = parse(html)
    tops = _main(root)
    for top in tops:
        hash_subtrees(top)
    found = _runs(tops, root, True)
    return found if found[0] else _runs(tops, root, False)


def _runs(tops: list[Node], root: Node, markup: bool) -> Outline:
    runs: list[list] = []
    hashes: list[int] = []
    within: list[int] = []
    for top in tops:
        chosen, most = top is not root, 0.7 * top.mass
        edge = True
        stack: list[tuple[Node | str | None, int]] = [(top, -1)]
        while stack:
            node, place = stack.pop()
            if node is None:
                edge = True
            elif isinstance(node, str):
                if edge and not (node := node.lstrip()):
                    continue
                if not edge and runs[-1][2] == place:
                    runs[-1][1].append(node)
                else:
                    runs.append([edge, [node], place])
                edge = False
            elif node.tag == "br":
                stack.append((" ", place))
            else:
                if node is not top:
                    if _left_out(node, chosen, most, markup):
                        continue
                    if not chosen or node.tag not in PROSE and node.mass < most:
                        hashes.append(node.hash)
                        within.append(place)
                        place = len(hashes) - 1
                if node.tag in BLOCK:
                    edge = True
                    stack.append((None, place))
                stack += [(c, place) for c in reversed(node.children)]
                if node.tag in ("td", "th"):
                    stack.append((" ", place))
    return [[e, SPACES.sub(" ", "".join(t)), p] for e, t, p in runs], hashes, within


def _left_out(node: Node, chosen: bool, most: float, markup: bool) -> bool:
    if node.drop:
        return True
    if not markup:
        return False
    # what holds most of the text is a layout named after its parts, but for readers' comments, which may outgrow a text
    if node.marked and (node.remarks or node.mass < most):
        return True
    return node.header and not (chosen and node.headed)


def join_runs(found: Outline, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks of an outline's runs outside the subtrees in ``templates``, one a line."""
    runs, hashes, within = found
    gone = np.zeros(len(hashes) + 1, dtype=bool)
    if templates:
        for i, (h, up) in enumerate(zip(hashes, within)):
            # what lies at -1 lies in none, which is the last place
            gone[i] = h in templates or gone[up]
    blocks: list[str] = []
    own: list[str] = []
    for edge, text, place in runs:
        if edge:
            blocks.append("".join(own))
            own.clear()
        if not gone[place]:
            own.append(text)
    blocks.append("".join(own))
    return "\n".join(x for b in blocks if (x := SPACES.sub(" ", b).strip()))


def main_text(html: str | None, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks of the main part of one page, without furniture and without subtrees whose hash is in ``templates``."""
    return join_runs(outline(html), templates)


OUTLINES = "edges array<boolean>, texts array<string>, places array<int>, hashes array<bigint>, within array<int>"


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``page_id, url, version, host`` and ``OUTLINES``: pages parsed once."""
    for batch in batches:
        found = [outline(html.as_py()) for html in batch.column(4)]
        parts = [pa.array([[r[k] for r in runs] for runs, _, _ in found], pa.list_(t)) for k, t in enumerate((pa.bool_(), pa.string(), pa.int32()))]
        parts.append(pa.array([np.array(h, dtype=np.uint64).view(np.int64) for _, h, _ in found], pa.list_(pa.int64())))
        parts.append(pa.array([w for _, _, w in found], pa.list_(pa.int32())))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *parts], ["page_id", "url", "version", "host", "edges", "texts", "places", "hashes", "within"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for edges, runs, places, hashes, within, templates in zip(*(batch.column(i).to_pylist() for i in range(2, 8))):
            texts.append(join_runs((list(zip(edges, runs, places)), hashes, within), frozenset(templates or ())))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def many(pages: Column, share: float, growth: float, least: int) -> Column:
    """Pages of a host of ``pages`` that make a subtree its template: a share of a small host, ``growth`` roots of a large one."""
    return F.greatest(F.lit(float(least)), F.least(share * pages, growth * F.sqrt(pages)))


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    share: float = 0.2,
    growth: float = 4.0,
    least: int = 8,
) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    Each page is parsed once. Elements that their tag, role, class or id marks as menus, headers, footers, sidebars,
    notices, adverts, forms or comments go. The text comes from the articles, else the main elements, else the page, in runs
    with the hashes of the subtrees they lie in. Spark counts the pages of each host with a hash; one on ``many`` of them,
    which is fewer than ``share`` on a large host that has several sections, is site template, and its runs go. Blocks come
    in page order, white space in a block as one space.

    The counts are grouped by host and hash with partial sums. A page meets its host's templates by a broadcast if they are
    few, else by its own hashes, so a host with a third of all pages is no task of its own; html is never shuffled. Null or
    empty html gives an empty text; a null or malformed url counts as one host; repeated rows give repeated rows; an empty
    table gives none; other columns are ignored.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    version = F.xxhash64(F.coalesce(F.col(html_col), F.lit("")))
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), version.alias("version"), host.alias("host"), F.col(html_col).alias("html"))
    kind = type_of(pages, id_col)
    parsed = cut(base.mapInArrow(_outlines, f"page_id {kind}, url string, version bigint, host string, {OUTLINES}"))
    each = parsed.select("page_id", "version", "host", F.explode(F.array_distinct("hashes")).alias("hash"))
    counts = each.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    hosts = parsed.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    templates = cut(counts.join(small_enough(hosts, BROADCAST_ROWS), "host").where(F.col("n") >= many(F.col("pages"), share, growth, least)).select("host", "hash"))
    if templates.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        by_host = templates.groupBy("host").agg(F.collect_list("hash").alias("all"))
        joined = parsed.join(F.broadcast(by_host), "host", "left").withColumn("templates", F.array_intersect("hashes", "all"))
    else:
        own = each.join(templates, ["host", "hash"]).groupBy(F.col("page_id").alias("t_id"), F.col("version").alias("t_version"), F.col("host").alias("t_host")).agg(F.collect_set("hash").alias("templates"))
        joined = parsed.join(own, F.col("page_id").eqNullSafe(F.col("t_id")) & (F.col("version") == F.col("t_version")) & (F.col("host") == F.col("t_host")), "left")
    return joined.select("page_id", "url", "edges", "texts", "places", "hashes", "within", "templates").mapInArrow(_joined, f"page_id {kind}, url string, text string, n_chars bigint")
