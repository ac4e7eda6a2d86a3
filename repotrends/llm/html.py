"""Main text of web pages by wrapper induction.

Pages of a host are aligned, by simple tree matching, with a tree of the host that represents them
best. What most share is the host's template; varying nodes are slots, and the deepest element that
holds all varying text outside of navigation is the host's content region. Template texts inside it
go. Pages and trees meet in joins by host; only outlines (tags, checksums and lengths of texts) are
compared.
"""

import marshal
import re
from html import unescape
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import map_rows, stored

# Element names and words of class, id and role.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SKIPPED = {"script", "style", "noscript", "template", "svg", "iframe", "object", "head", "title"}
BOILERPLATE = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "textarea"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
    "u", "var", "wbr"}
CLOSES = {  # an open element that a new one ends
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}}
MARKED = {
    "ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
    "cookie", "cookies", "footer", "header", "masthead", "menu", "nav", "navbar", "navigation", "newsletter", "notice",
    "pagination", "popup", "promo", "related", "share", "sharing", "sidebar", "social", "sponsor", "sponsored",
    "subscribe", "toolbar", "widget", "contentinfo", "complementary", "search", "disqus", "reply", "replies",
    "respond", "responses", "gdpr", "signup", "recommended", "trending"}
# Words that may stand beside one of MARKED in a name; any other, as in "no-sidebar", makes it another name.
BESIDE = {
    "reader", "readers", "user", "users", "thread", "threads", "form", "button", "buttons", "story", "stories", "slot",
    "unit", "policy", "icons",
    "site", "page", "global", "main", "top", "bottom", "left", "right", "block", "box", "bar", "list", "area", "section",
    "container", "wrapper", "wrap", "inner", "item", "items", "post", "posts", "article", "articles", "links"}
CONTENT = ("html", "body", "main", "article")

OWN = "own-"
BY_NAME, BY_TAG, MARK = 1, 2, 4
RICH = 10
VECTORS = 4096  # pairs of two lists of children from which their alignment is worked on by vectors
FEW = 5  # different pages of a host that a text must stand on before it is left out as template

# What follows an element's name, up to its end: a quote opens only after `=`, as in browsers. No part
# is tried twice, and a tag that never ends goes on to the end of the page, so the work is linear.
_REST = r"""[^>=]*+(?:=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|object|title|textarea)\b{_REST}"
    rf"(?:>.*?(?:</\1\s*+>|\Z)|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({_REST})(?:>|\Z)|<[!?][^>]*+(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


class Node:
    """An element: its tag, whether its class, id or role marks it as boilerplate, and its children,
    which are nodes and texts. The page's root, html, body, main, article and what they stand in are
    not marked, but for articles on a page that has others (or a main part) outside of boilerplate."""

    __slots__ = ("tag", "marked", "children")

    def __init__(self, tag, marked=""):
        self.tag, self.marked, self.children = tag, marked, []


def _marked(attributes: str) -> str:
    """The class, id or role that marks an element, empty if none does."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for token in "".join(values).lower().split():
                own = {w for w in re.split(r"[^a-z]+", token) if w}
                if not MARKED.isdisjoint(own) and own <= MARKED | BESIDE:
                    return token
    return ""


def parse(html: str) -> Node:
    """A lenient tree: unknown end tags are left out, missing ones added, as browsers do in outline."""
    root = Node("#root")
    stack, at = [root], 0
    articles, found = [], False

    def text(upto):
        if upto > at:
            stack[-1].children.append(html[at:upto])

    for m in _TOKEN.finditer(html):
        text(m.start())
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if m[2]:
            depth = next((n for n in range(len(stack) - 1, 0, -1) if stack[n].tag in (tag, OWN + tag)), 0)
            if depth:
                del stack[depth:]
            continue
        if tag in CLOSES and stack[-1].tag in CLOSES[tag]:
            stack.pop()
        elif tag not in INLINE:  # a block ends an open paragraph and the inline elements in it
            depth = next((n for n in range(len(stack) - 1, 0, -1) if stack[n].tag not in INLINE), 0)
            if depth and stack[depth].tag == "p":
                del stack[depth:]
        if tag == "header" and any(n.tag == "article" for n in stack):
            tag = OWN + tag   # an article's own header, with its headline, is content
        node = Node(tag, _marked(m[4]) if m[4] else "")
        stack[-1].children.append(node)
        if tag in CONTENT:
            above = [*stack, node]
            if tag != "article":
                for n in above:
                    n.marked = ""
            else:
                articles.append(above)
            if tag in ("article", "main"):
                found = found or not any(n.marked or n.tag in BOILERPLATE for n in above)
        if tag not in VOID and tag not in SKIPPED and not m[4].rstrip().endswith("/"):
            stack.append(node)
    text(len(html))
    if not found:
        for above in articles:
            for n in above:
                n.marked = ""
    return root


def outline(html: str) -> list:
    """A page's elements in preorder, as (parent, tag, boilerplate, checksum of own text, length of
    own text, linked, mark). boilerplate is 0, BY_NAME below an element marked by its name, BY_TAG below
    one of BOILERPLATE, and with MARK added the marked element itself."""
    out = []

    def walk(node, parent, barred, linked):
        own = _own(node)
        barred = BY_TAG if node.tag in BOILERPLATE else barred or BY_NAME * bool(node.marked)
        linked = linked or node.tag == "a"
        number = len(out)
        out.append((parent, node.tag, barred + MARK * bool(node.marked), crc32(own.encode()), len(own), linked, node.marked))
        for child in node.children:
            if isinstance(child, Node) and child.tag not in SKIPPED:
                todo.append((child, number, barred, linked))

    todo = [(parse(html), -1, 0, False)]
    while todo:
        walk(*todo.pop())
    return out


def _children(outline) -> list:
    out = [[] for _ in outline]
    for n, entry in enumerate(outline):
        if entry[0] >= 0:
            out[entry[0]].append(n)
    return out


def _structures(outline, kids, known: dict) -> list:
    """A number for each element's subtree: the same for subtrees of the same tags."""
    out = [0] * len(outline)
    for n in range(len(outline) - 1, -1, -1):   # preorder: children come after their parents
        out[n] = known.setdefault((outline[n][1], tuple([out[k] for k in kids[n]])), len(known))
    return out


class _Alignment:
    """Best alignments of lists of subtrees, in order, so that the matched ones have most elements.

    Subtrees go by the numbers of their structures, `of[number]` being (tag, children). A list is worked on
    row by row; rows of long lists are vectors, of which the square root of their number is kept, and the
    rows between two of them are made again where the way back passes. So the memory is that of a few
    rows, and the alignment exact however long the lists are.
    """

    def __init__(self, of):
        self.of, self.size = of, {}   # pairs without common children are not kept: their size is 1

    def _ends(self, ka, kb):
        """How many childless elements of one tag stand at both beginnings, and at both ends of the rest; they can
        as well be paired there."""
        def plain(p, q):
            return self.of[p][0] == self.of[q][0] and not self.of[p][1] and not self.of[q][1]

        front = back = 0
        least = min(len(ka), len(kb))
        while front < least and plain(ka[front], kb[front]):
            front += 1
        while back < least - front and plain(ka[-1 - back], kb[-1 - back]):
            back += 1
        return front, back

    def _row(self, p, kb, above):
        out, left, tag = [0], 0, self.of[p][0]
        for j, q in enumerate(kb):
            here = above[j] + self.size.get((p, q), 1) if tag == self.of[q][0] else 0
            left = max(left, here, above[j + 1])
            out.append(left)
        return out

    def _rows(self, ka, kb):
        """A function that gives the row after `p` from the row above."""
        if len(ka) * len(kb) < VECTORS:
            return (lambda p, above: self._row(p, kb, above)), [0] * (len(kb) + 1)
        different, place = np.unique(kb, return_inverse=True)
        known = {}

        def after(p, above):
            if p not in known:
                if len(known) * len(different) > VECTORS * 100:
                    known.clear()
                known[p] = np.array([self.size.get((p, q), 1) if self.of[p][0] == self.of[q][0] else 0
                                     for q in different.tolist()], np.int32)
            gain = known[p][place]
            here = np.where(gain > 0, above[:-1] + gain, 0)
            out = np.zeros_like(above)
            np.maximum.accumulate(np.maximum(here, above[1:]), out=out[1:])
            return out

        return after, np.zeros(len(kb) + 1, np.int32)

    def score(self, ka, kb) -> int:
        front, back = self._ends(ka, kb)
        ka, kb = ka[front:len(ka) - back], kb[front:len(kb) - back]
        if not ka or not kb:
            return front + back
        after, row = self._rows(ka, kb)
        for p in ka:
            row = after(p, row)
        return front + back + int(row[-1])

    def pairs(self, ka, kb) -> list:
        """The places of the elements that are paired."""
        front, back = self._ends(ka, kb)
        out = [(n, n) for n in range(front)] + [(len(ka) - n, len(kb) - n) for n in range(1, back + 1)]
        ka, kb = ka[front:len(ka) - back], kb[front:len(kb) - back]
        if not ka or not kb:
            return out
        after, row = self._rows(ka, kb)
        step = int(len(ka) ** 0.5) + 1
        kept = []
        for i, p in enumerate(ka):
            if i % step == 0:
                kept.append(row)
            row = after(p, row)
        i, j, first = len(ka), len(kb), len(ka) + 1
        while i and j:
            if i - 1 < first:   # the rows from a kept one on
                first = (i - 1) // step * step
                table = [kept[first // step]]
                for p in ka[first:i]:
                    table.append(after(p, table[-1]))
            if table[i - first][j] == table[i - 1 - first][j]:
                i -= 1
            elif table[i - first][j] == table[i - first][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                out.append((front + i, front + j))
        return out


def match(a, b) -> list:
    """Simple tree matching of two outlines: pairs of matched elements, roots first.

    Children are aligned in order so that the matched subtrees have most elements, exactly and at
    every size. Sizes are worked out once for each pair of different structures that can meet, the
    lowest first.
    """
    kids_a, kids_b = _children(a), _children(b)
    known = {}
    kind_a, kind_b = _structures(a, kids_a, known), _structures(b, kids_b, known)
    of, height = list(known), []
    for _, inner in of:
        height.append(1 + max((height[k] for k in inner), default=0))
    # Pairs that can match: same tag, and parents that can.
    todo, met = [(kind_a[0], kind_b[0])], {(kind_a[0], kind_b[0])}
    while todo:
        x, y = todo.pop()
        inner_a, inner_b = ({k for k in of[n][1] if of[k][1]} for n in (x, y))
        for p in inner_a:
            for q in inner_b:
                if of[p][0] == of[q][0] and (p, q) not in met:
                    met.add((p, q))
                    todo.append((p, q))
    alignment = _Alignment(of)
    for x, y in sorted(met, key=lambda pair: height[pair[0]]):
        alignment.size[x, y] = 1 + alignment.score(of[x][1], of[y][1])
    out, todo, best = [], [(0, 0)], {}
    while todo:
        x, y = todo.pop()
        out.append((x, y))
        if kids_a[x] and kids_b[y]:
            pair = kind_a[x], kind_b[y]
            if pair not in best:
                best[pair] = alignment.pairs(of[pair[0]][1], of[pair[1]][1])
            todo += [(kids_a[x][i], kids_b[y][j]) for i, j in best[pair]]
    return out


def _path(outline, n: int) -> str:
    """Tags from the root to an element."""
    out = []
    while n >= 0:
        out.append(outline[n][1])
        n = outline[n][0]
    return "/".join(reversed(out))


def shape(outline) -> int:
    """A checksum of a page's outline without repeated paths: what pages of one template have in common.
    A path goes by its depth and a checksum of its tags, so deep pages take no more memory than others."""
    paths, seen = [], {}
    for parent, tag, *_ in outline:
        depth, above = paths[parent] if parent >= 0 else (0, 0)
        paths.append((depth + 1, crc32(b"/" + tag.encode(), above)))
        if tag not in INLINE:
            seen[paths[-1]] = None
    return crc32(repr(list(seen)).encode())


def _own(node: Node) -> str:
    return " ".join("".join(c for c in node.children if isinstance(c, str)).split())


def _key(path: str, check: int) -> int:
    """A path and the checksum of a text, as one number."""
    return crc32(path.encode()) >> 1 << 32 | check


def _blocks(node: Node, path: str, out: list, template=frozenset()) -> None:
    """Texts of the blocks under a node, in order, without boilerplate, as (text, whether all of it
    stands in template elements)."""
    now, todo, varies = [], [(node, path, False)], False

    def flush():
        nonlocal varies
        joined = " ".join(unescape("".join(now)).split())
        if joined:
            out.append((joined, not varies))
        now.clear()
        varies = False

    while todo:
        item, path, leaving = todo.pop()
        if isinstance(item, str):
            now.append(item)
            varies = varies or (not leaving and not item.isspace())
            continue
        block = item.tag not in INLINE
        if block:
            flush()
        if leaving:
            continue
        if item is not node and (item.marked or item.tag in BOILERPLATE or item.tag in SKIPPED):
            continue
        if item.tag == "br":
            now.append(" ")
        if block:
            todo.append((item, path, True))
        known = bool(template) and _key(path, crc32(_own(item).encode())) in template
        todo += [(c, path, known) if isinstance(c, str) else (c, f"{path}/{c.tag}", False)
                 for c in reversed(item.children)]
    flush()


def extract(html: str, region: str | None, template=(), free=()) -> str:
    """Text of a page's content region: of the elements on the host's path, else of its articles
    or main part, else of the whole page; boilerplate elements inside go, and blocks with nothing
    but texts of the host's template. A path that leads to no article gives way to the page's own
    articles. A page that would lose most of its text with the template is a near copy of others and
    keeps it. What `free` names is not barred by its mark."""
    root = parse(html)
    found, todo = {"path": [], "article": [], "main": []}, [(root, root.tag, False)]
    while todo:
        node, path, barred = todo.pop()
        if node.marked and f"{path}.{node.marked}" in free:
            node.marked = ""
        barred = barred or node.marked or node.tag in BOILERPLATE
        if not barred:
            if path == region:
                found["path"].append((path, node))
            elif node.tag in ("article", "main"):
                found[node.tag].append((path, node))
        todo += [(c, f"{path}/{c.tag}", barred) for c in reversed(node.children)
                 if isinstance(c, Node) and c.tag not in SKIPPED]
    own = found["article"] or found["main"]
    if found["path"] and (not own or not {"article", "main"}.isdisjoint(region.split("/"))):
        nodes = found["path"]
    else:
        nodes = [(p, n) for p, n in own if not any(p != q and p.startswith(q + "/") for q, _ in own)]
    out = []
    for path, node in nodes or [(root.tag, root)]:
        _blocks(node, path, out, frozenset(template))
    varying = [t for t, known in out if not known]
    most = 2 * sum(map(len, varying)) >= sum(len(t) for t, _ in out)
    return "\n".join(varying if most else [t for t, _ in out])


def _host(url="url"):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))


def _region(nodes) -> tuple[str | None, list, list]:
    """The content region of a host's representative outline, its template texts (see `_key`) and
    the paths, with their marks, of elements that their names don't bar, from what its alignments add up to.

    Texts that most pages share are template; to leave them out of pages, there must be FEW different
    ones. The region is the deepest element that holds all varying text outside boilerplate and
    links, but no deeper than an article or main part. A marked element whose varying text is RICH
    times as long as all that is not barred is content whatever its name, the marked ones in it aside.
    """
    outline = [(n["parent"], n["tag"]) for n in nodes]
    shared = [n["own"] != 0 and 2 * n["same"] > n["pages"] > 2 for n in nodes]
    free, within = [], []  # per element, the mark that bars it: an element's number, -1 for none, -2 for a tag
    for i, n in enumerate(nodes):
        above = within[n["parent"]] if n["parent"] >= 0 else -1
        within.append(-2 if n["barred"] & BY_TAG or above == -2 else i if n["barred"] & MARK else above)
    weight = [0 if same or n["linked"] else n["chars"] for n, same in zip(nodes, shared)]
    under = {}
    for i, n in enumerate(nodes):
        under[within[i]] = under.get(within[i], 0) + n["added"] + weight[i]
    # Outermost marks only: what is marked inside a marked element stays out.
    rich = {m for m, chars in under.items() if m >= 0 and chars > RICH * under.get(-1, 0)
            and (nodes[m]["parent"] < 0 or within[nodes[m]["parent"]] == -1)}
    if rich:
        best = max(rich, key=lambda m: (under[m], -m))
        free = [f"{_path(outline, best)}.{nodes[best]['mark']}"]
        rich = {m for m in under if m >= 0 and f"{_path(outline, m)}.{nodes[m]['mark']}" == free[0]}
    held = [w + n["added"] if m == -1 or m in rich else 0 for w, n, m in zip(weight, nodes, within)]
    for n in range(len(nodes) - 1, 0, -1):
        held[outline[n][0]] += held[n]
    template = sorted({
        _key(_path(outline, i), n["own"])
        for i, (n, same) in enumerate(zip(nodes, shared)) if same and n["pages"] >= FEW})
    # Elements on one path are one slot: text of repeated siblings is added to their first.
    if not held or held[0] <= 0:
        return None, template, free
    kids, at = _children(outline), 0
    while outline[at][1] not in ("article", "main"):
        below = [c for c in kids[at] if held[c] == held[0]]
        if not below or outline[below[0]][1] in INLINE or outline[below[0]][1] == "p":
            break
        at = below[0]
    return _path(outline, at), template, free


def _sums(a, b):
    """What the alignment of a page b says of a representative a: (node, same, chars, added) for each
    matched node: whether its text stands there or in a sibling of its tag, how long the page's is,
    and the length of the text below in elements that match nothing."""
    pairs = match(a, b)
    of = {y: x for x, y in pairs}
    beside = {(b[y][0], b[y][1], b[y][3]) for y in range(len(b))}
    added = dict.fromkeys(of.values(), 0)
    for y, (parent, _, barred, _, chars, linked, _) in enumerate(b):
        if y not in of:
            of[y] = of[parent]  # preorder: parents come first
            if chars and barred == a[of[y]][2] & ~MARK and not barred & BY_TAG and not linked:
                added[of[y]] += chars
    return [(x, (b[y][0], a[x][1], a[x][3]) in beside, b[y][4], added[x]) for x, y in pairs]


def induce(pages: DataFrame) -> DataFrame:
    """`(host, region, template, free)`: each host's content region as a path of tags, null if it has
    no text, its template texts, and the paths and marks of elements that their names don't bar.

    A host is represented by the outline, smallest by hash, of its most frequent shape. All its
    pages' outlines are aligned with it; per element of the representative it is counted on how many
    pages it has the same text, and how long its texts are. Identical outlines count once, so copies
    of one page don't make its text a template.
    """
    def outlines(hosts, pages):
        trees = [outline(h) for h in pages]
        yield hosts, [shape(t) for t in trees], [marshal.dumps(t) for t in trees]

    found = stored(map_rows(
        pages.select(_host().alias("host"), F.coalesce("html", F.lit("")).alias("html")), outlines,
        "host string, shape long, tree binary"), "outlines").dropDuplicates(["host", "tree"])
    found = stored(found, "different-outlines")
    shapes = found.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("tree"), F.col("tree").alias("tree"))).alias("least"))
    chosen = stored(shapes.groupBy("host").agg(F.max(F.struct("n", "shape", "least")).alias("best")).select(
        "host", F.col("best.least.tree").alias("model")), "models")

    def aligned(hosts, trees, models):
        known, sums = {}, {}
        for host, tree, model in zip(hosts, trees, models):
            a = known[model] if model in known else known.setdefault(model, marshal.loads(model))
            b = marshal.loads(tree)
            for x, same, chars, added in _sums(a, b):
                own = sums.setdefault((host, x), [0, 0, 0, 0])
                own[0] += same
                own[1] += 1
                own[2] += chars
                own[3] += added
        if sums:
            yield *zip(*sums), *zip(*sums.values())

    def elements(hosts, models):
        for host, model in zip(hosts, models):
            parent, tag, barred, own, _, linked, mark = zip(*marshal.loads(model))
            yield [host] * len(tag), range(len(tag)), parent, tag, barred, own, linked, mark

    sums = map_rows(found.select("host", "tree").join(chosen, "host"), aligned,
                    "host string, node int, same long, pages long, chars long, added long").groupBy("host", "node").agg(
        *(F.sum(c).alias(c) for c in ("same", "pages", "chars", "added")))
    nodes = map_rows(
        chosen, elements,
        "host string, node int, parent int, tag string, barred int, own long, linked boolean, mark string")
    nodes = nodes.join(sums, ["host", "node"], "left").select("host", F.struct(
        "node", "parent", "tag", "barred", "own", "linked", "mark",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("same", "pages", "chars", "added"))).alias("s"))
    # One list for each host, as long as its representative has elements.
    lists = nodes.groupBy("host").agg(F.sort_array(F.collect_list("s")).alias("nodes"))

    def regions(hosts, nodes):
        yield hosts, *zip(*map(_region, nodes))

    return map_rows(lists, regions, "host string, region string, template array<long>, free array<string>")


def main_text(pages: DataFrame) -> DataFrame:
    """One row for each row of `pages`: page_id, url, text, n_chars.

    The text is the content region's (see `induce`) without menus, headers, footers, sidebars,
    notices, adverts, forms, scripts, styles and comments, and without the host's template texts. Character references are decoded, white
    space in a block becomes one space, blocks are joined by line feeds. Null or empty html gives an
    empty text. A null url is a host of its own. Repeated rows stay; other columns are not read.
    """
    host = stored(induce(pages), "wrappers").withColumnRenamed("host", "of")

    def rows(ids, urls, htmls, *wrappers):
        texts = [extract(h or "", r, t or (), f or ()) for h, r, t, f in zip(htmls, *wrappers)]
        yield ids, urls, texts, [len(t) for t in texts]

    # The wrappers are a stored table: Spark broadcasts it only if its files are small.
    named = pages.select("page_id", "url", "html", _host().alias("host"))
    joined = named.join(host, named["host"] == host["of"], "left").select(
        "page_id", "url", "html", "region", "template", "free")
    return map_rows(joined, rows, "page_id long, url string, text string, n_chars long")
