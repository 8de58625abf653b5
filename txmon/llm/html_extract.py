"""Main-text extraction by wrapper induction.

All different pages of a host count, layout by layout (the containers of the main text), on how many
of them a node stands with the same text at the same path.  Nodes constant on most of a layout's pages
are template, nodes whose text varies are slots; this holds inside a marked article too, for whole
nodes.  Copies of one main text count once, and where the constant text is half of all main text the
pages are near copies and nothing is template.  Menus, adverts, forms and comments are told by their
element and class names.

On layouts that mark no article all pages are also aligned by simple tree matching; runs of like siblings
count as one node, so a list of 500 paragraphs aligns with one of 5.  Pages with like trees add up their
texts node by node, in plain sums; the different trees of a layout are aligned in groups of about
``GROUP`` and the trees of the groups again, until one is left.  Nodes of the aligned tree that hold links
rather than prose are menus.

Counts are aggregated before they travel by host; only wrappers (small) do.  A host with a third of all
pages costs no more to learn than any other, and its pages stay spread over the tasks.
"""

from __future__ import annotations

import html as html_lib
import json
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import read, staged
from txmon.llm.url_filter import split_url

#: Trees aligned by one task at a time.
GROUP = 16
DEPTH = 150
#: A text is template on MOST hundredths of the pages that have its path, and on so many different pages
#: at least: outside and inside a marked article.
MOST = 80
LEAST = {False: 2, True: 4}

#: Fixed values of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg")
INLINE = set("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strong "
             "sub sup time tt u var wbr".split())
BLOCKS = set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
             "hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
#: Elements that are not the article, and words of which a class, id or role that marks such an element
#: consists: "comments" and "cookie-notice" do, "has-sidebar" and "related-wide" do not.
CHROME_TAGS = set("head nav footer aside form script style noscript iframe template svg button select textarea "
                  "input dialog title".split())
CHROME_WORDS = set("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie consent "
                   "disqus footer header login masthead menu modal nav navbar navigation newsletter notice "
                   "pagination popup promo related share sharing sidebar social sponsor sponsored subscribe "
                   "toolbar widget complementary contentinfo dialog search".split())
ARTICLE_WORDS = set("article main body content entry page post story text".split())
SPACE = re.compile(r"[\x20\x09-\x0D]+")
_NAME = re.compile(r"[a-zA-Z][^\s/>\"'<]*")
_STOP = re.compile("[>\"']")
_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
_MARK = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


class Node:
    __slots__ = ("tag", "sig", "marks", "items")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag = tag
        names = (n for m in _MARK.finditer(attrs) for n in (m[1] or m[2] or m[3] or "").lower().split()) if attrs else ()
        # whole names, their words joined by hyphens
        self.marks = [w for n in names if (w := "-".join(filter(None, re.split(r"[^a-z]+", n))))]
        self.sig = f"{tag}.{'.'.join(self.marks)}" if self.marks else tag
        self.items: list[Node | str] = []  # elements and texts


class Tags:
    """The tags of a page from left to right, in time linear in the page whatever is left unclosed.

    A tag ends at the first ``>`` outside quotes.  Only quotes and ``>`` decide where that is, so what a
    scan in vain has met of them is kept (``dead``) and never walked again.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.stop = -1  # the next quote or > at or behind the last place asked for
        self.dead: set[int] = set()  # quotes from which, standing outside of quotes, no tag ends

    def _end(self, at: int) -> int:
        if self.stop < at:
            m = _STOP.search(self.page, at)
            self.stop = m.start() if m else len(self.page)
        s, met = self.stop, []
        while s < len(self.page) and s not in self.dead:
            if self.page[s] == ">":
                return s
            met.append(s)
            close = self.page.find(self.page[s], s + 1)
            m = _STOP.search(self.page, close + 1) if close >= 0 else None
            s = m.start() if m else len(self.page)
        self.dead.update(met)
        return -1

    def next(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        """(start, end, closing, tag, attributes) of the first tag, comment or declaration from ``at`` on;
        tag None for the last two."""
        page = self.page
        while (i := page.find("<", at)) >= 0:
            if page.startswith("<!--", i):
                end = page.find("-->", i + 4)
                return i, len(page) if end < 0 else end + 3, False, None, ""
            if i > self.last and page.find("<!--", i) < 0:
                return None
            if page[i + 1:i + 2] in ("!", "?"):
                if i < self.last:
                    return i, page.find(">", i) + 1, False, None, ""
            else:
                closing = page.startswith("/", i + 1)
                name = _NAME.match(page, i + 1 + closing)
                end = self._end(name.end()) if name and i < self.last else -1
                if end >= 0:
                    return i, end + 1, closing, name[0], page[name.end():end]
            at = i + 1
        return None


def parse(page: str) -> Node:
    """A forgiving DOM: comments go, raw elements keep no text, unclosed elements end with their block.

    Elements below ``DEPTH`` become siblings, so that no page exhausts the stack; what stands inside
    such a menu or advert stays inside it.
    """
    root = Node("#root")
    stack, at, tags = [root], 0, Tags(page)
    deeper: list[str] = []  # open elements beyond DEPTH, so that their closing tags close no outer one
    open_deeper: Counter[str] = Counter()
    aside: tuple[int, Node] | None = None  # the outermost open element beyond DEPTH that is chrome

    def cut(n: int) -> None:
        nonlocal aside
        while len(deeper) > n:
            open_deeper[deeper.pop()] -= 1
        if aside and len(deeper) < aside[0]:
            aside = None

    while (found := tags.next(at)) is not None:
        start, end, closing, name, attrs = found
        into = aside[1] if aside else stack[-1]
        if start > at:
            into.items.append(page[at:start])
        at = end
        if name is None:
            continue
        tag = name.lower()
        if closing:
            if open_deeper[tag] > 0:
                cut(len(deeper) - 1 - next(i for i, t in enumerate(reversed(deeper)) if t == tag))
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    cut(0)
                    break
            continue
        if tag in BLOCKS and not deeper:  # a block ends an open paragraph and what inline elements it left open
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag not in INLINE:
                    break
        for i in range(len(stack) - 1, 0, -1) if not deeper else ():
            if stack[i].tag in CLOSES.get(tag, ()):
                del stack[i:]
                break
            if stack[i].tag in BLOCKS:
                break
        node = Node(tag, attrs)
        (aside[1] if aside else stack[-1]).items.append(node)
        if tag in VOID or attrs.endswith("/") and tag in ("svg", "path"):
            continue
        if tag in RAW:
            stop = _END[tag].search(page, at)  # not in page.lower(): some letters lower to two
            close = page.find(">", stop.start()) if stop else -1
            at = len(page) if close < 0 else close + 1
            continue
        if len(stack) < DEPTH:
            stack.append(node)
        else:
            deeper.append(tag)
            open_deeper[tag] += 1
            if aside is None and is_chrome(tag, node.marks):
                aside = len(deeper), node
    if at < len(page):
        (aside[1] if aside else stack[-1]).items.append(page[at:])
    return root


def clean(text: str) -> str:
    return SPACE.sub(" ", html_lib.unescape(text)).strip(" ")


class Shape:
    """A run of like sibling elements: their common signature and the runs below them."""

    __slots__ = ("sig", "tag", "marks", "nodes", "below")

    def __init__(self, nodes: list[Node]):
        self.sig, self.tag, self.marks, self.nodes = nodes[0].sig, nodes[0].tag, nodes[0].marks, nodes
        runs: list[list[Node]] = []
        for n in nodes:
            for x in n.items:
                if isinstance(x, Node) and x.tag not in RAW:
                    if runs and runs[-1][0].sig == x.sig:
                        runs[-1].append(x)
                    else:
                        runs.append([x])
        self.below = [Shape(r) for r in runs]

    def texts(self) -> set[str]:
        return {t for n in self.nodes for x in n.items if isinstance(x, str) and (t := clean(x))}


def match(a: list, b: list, sig=lambda x: x.sig, below=lambda x: x.below) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching of two lists of trees: the largest number of node pairs with like
    signatures that keeps order and ancestry, and the pairs of the top level."""
    pairs, best = {}, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        row, up = best[i + 1], best[i]
        for j, y in enumerate(b):
            row[j + 1] = max(up[j + 1], row[j])
            if sig(x) == sig(y):
                w = 1 + match(below(x), below(y), sig, below)[0]
                if up[j] + w > row[j + 1]:
                    row[j + 1] = up[j] + w
                    pairs[i, j] = w
    out, i, j = [], len(a), len(b)
    while i and j:
        if (i - 1, j - 1) in pairs and best[i][j] == best[i - 1][j - 1] + pairs[i - 1, j - 1]:
            out.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return best[len(a)][len(b)], out[::-1]


class Slot:
    """A wrapper node: how much text of the aligned pages it holds, and how much of it in links."""

    __slots__ = ("sig", "tag", "marks", "own", "linked", "below")

    def __init__(self, tag: str, marks: list[str], own: int, linked: int, below: list[Slot]):
        self.sig = f"{tag}.{'.'.join(marks)}" if marks else tag
        self.tag, self.marks, self.own, self.linked, self.below = tag, marks, own, linked, below

    @classmethod
    def of(cls, s: Shape) -> Slot:
        own = sum(map(len, s.texts()))
        return cls(s.tag, s.marks, own, own if s.tag == "a" else 0, [cls.of(x) for x in s.below])

    @classmethod
    def load(cls, tree: list, sizes: Iterator[tuple[int, int]]) -> Slot:
        """From [tag, marks, children] and the sizes of its nodes from the top, depth first."""
        own, linked = next(sizes)
        return cls(tree[0], tree[1], own, linked, [cls.load(x, sizes) for x in tree[2]])

    def tree(self) -> list:
        return [self.tag, self.marks, [x.tree() for x in self.below]]

    def sizes(self) -> list[tuple[int, int]]:
        return [(self.own, self.linked), *(p for x in self.below for p in x.sizes())]

    def align(self, s: Slot) -> None:
        self.own += s.own
        self.linked += s.linked
        pairs = dict((j, i) for i, j in match(self.below, s.below)[1])
        merged, at = [], 0
        for j, x in enumerate(s.below):
            if j in pairs:
                merged += self.below[at:pairs[j] + 1]
                self.below[pairs[j]].align(x)
                at = pairs[j] + 1
            else:
                merged.append(x)
        self.below = merged + self.below[at:]

    def totals(self) -> tuple[int, int]:
        parts = [x.totals() for x in self.below]
        linked = sum(p[1] for p in parts) if self.tag != "a" else self.own + sum(p[0] for p in parts)
        return self.own + sum(p[0] for p in parts), linked


def is_chrome(tag: str, marks: list[str]) -> bool:
    return tag in CHROME_TAGS or tag not in ("#root", "html", "body", "main", "article") and any(
        CHROME_WORDS.issuperset(m.split("-")) for m in marks)


def is_article(tag: str, marks: list[str]) -> bool:
    return tag in ("article", "main") or any(
        ("main" in w or "article" in w) and ARTICLE_WORDS.issuperset(w) for w in (m.split("-") for m in marks))


def holders(root) -> set[int]:
    """The elements (ids of Shape or Slot) that are or hold the article: no class word makes them chrome.
    Articles inside elements named as chrome (teasers) count only where there is no other."""
    def seek(x, by_name: bool, out: set[int]) -> bool:
        if x.tag in CHROME_TAGS or by_name and is_chrome(x.tag, x.marks):
            return False
        below = [seek(y, by_name, out) for y in x.below]
        if any(below) or is_article(x.tag, x.marks):
            out.add(id(x))
            return True
        return False

    for by_name in (True, False):
        out: set[int] = set()
        if seek(root, by_name, out):
            return out
    return set()


def aligned(slots: list[Slot]) -> Slot:
    root = slots[0]
    for x in slots[1:]:
        root.align(x)
    return root


def induce(pages: list[str]) -> list:
    """The wrapper of pages of one layout, as nested [signature, kind, children]."""
    slots = [Slot.of(Shape([parse(p)])) for p in pages]
    return labelled(aligned(slots))[0] if slots else ["#root", "content", []]


def labelled(root: Slot) -> tuple[list, int]:
    """The wrapper of an aligned tree, and how many nodes are menus because of their links."""
    hold, menus = holders(root), 0

    def label(s: Slot, inside: bool) -> list:
        nonlocal menus
        inner = inside or is_article(s.tag, s.marks)
        own, linked = s.totals()
        kind = "content"
        if id(s) not in hold and is_chrome(s.tag, s.marks) or s.tag == "header" and not inside:
            kind = "chrome"
        elif not hold and s.tag not in ("#root", "html", "body") and s.tag not in INLINE and own and linked > 0.5 * own:
            kind = "chrome"
            menus += 1
        return [s.sig, kind, [] if kind == "chrome" else [label(x, inner) for x in s.below]]

    return label(root, False), menus


def _hash(*parts) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")) >> 1


class Page:
    """A page with the kind (chrome, outside, content) and the path of each of its runs."""

    def __init__(self, html: str):
        self.root = Shape([parse(html)])
        self.hold = holders(self.root)
        self.marked = bool(self.hold)
        self.runs: list[tuple[Shape, int, str]] = []
        self._digests: dict[int, tuple[int, int]] = {}
        boxes: set[int] = set()

        def place(s: Shape, above: int, depth: int, inside: bool) -> None:
            inner = inside or id(s) in self.hold and is_article(s.tag, s.marks)
            path = _hash(above, s.sig)
            if id(s) not in self.hold and is_chrome(s.tag, s.marks) or s.tag == "header" and not inside:
                self.runs.append((s, path, "chrome"))
                return
            self.runs.append((s, path, "content" if inner or not self.marked else "outside"))
            if inner and not inside if self.marked else s.tag in ("div", "section", "table", "center") and depth <= 4:
                boxes.add(path)
            for x in s.below:
                place(x, path, depth + 1, inner)

        place(self.root, 0, 0, False)
        self.layout = _hash(self.marked, *sorted(boxes))

    def digest(self, n: Node) -> tuple[int, int]:
        """Hash of all text of a node, chrome below it left out (0 if none), and the size of the text
        of its own and of its inline elements."""
        if id(n) not in self._digests:
            parts, size = [], 0
            for x in n.items:
                if isinstance(x, str):
                    if t := " ".join(x.split()):
                        parts.append(t)
                        size += len(t)
                elif x.tag not in RAW and not is_chrome(x.tag, x.marks):
                    d, more = self.digest(x)
                    if d:
                        parts.append(f"{x.sig}\x1e{d}")
                        size += more if x.tag in INLINE else 0
            self._digests[id(n)] = (_hash(*parts), size) if parts else (0, 0)
        return self._digests[id(n)]

    def node_key(self, s: Shape, path: int, n: Node) -> int:
        """The key of a whole node with its text; 0 for what is never template as a whole."""
        if s.tag in INLINE or s.tag in ("#root", "html", "body") or id(s) in self.hold:
            return 0
        d = self.digest(n)[0]
        return _hash(path, "node", d) if d else 0

    def features(self) -> tuple[int, list[tuple[int, int, int]]]:
        """The unit that copies of the main text share, and (path, key, size) of its texts: key 0 for the
        path itself, path 0 for the whole."""
        items, total, whole = {}, 0, []
        for s, path, kind in self.runs:
            if kind != "content":
                continue
            items[path, 0] = 0
            for n in s.nodes:
                size = self.digest(n)[1] if s.tag not in INLINE else 0
                total += size
                if id(s) in self.hold or s is self.root:
                    whole.append(self.digest(n)[0])
                if key := self.node_key(s, path, n):
                    items[path, key] = items.get((path, key), 0) + (size if self.marked else 0)
            if not self.marked:
                for t in s.texts():
                    items[path, _hash(path, "text", t)] = len(t)
        items[0, 0] = total
        out = sorted((p, k, size) for (p, k), size in items.items())
        return _hash(self.layout, *whole, *out), out


def extract(html: str, wrapper: list, template: frozenset = frozenset()) -> str:
    return read_out(Page(html), wrapper, template)


def read_out(page: Page, wrapper: list | None, template: frozenset) -> str:
    """The texts of the page's content slots, blocks in page order joined by one blank."""
    label: dict[int, tuple[str, int, Shape]] = {}
    menus: set[int] = set()

    def menu(s: Shape, w: list) -> None:
        pairs = match(w[2], s.below, lambda x: x[0] if isinstance(x, list) else x.sig,
                      lambda x: x[2] if isinstance(x, list) else x.below)[1]
        for i, j in pairs:
            if w[2][i][1] == "chrome":
                menus.add(id(s.below[j]))
            else:
                menu(s.below[j], w[2][i])

    if wrapper is not None and not page.marked:
        menu(page.root, wrapper)
    for s, path, kind in page.runs:
        for n in s.nodes:
            label[id(n)] = ("chrome" if id(s) in menus else kind, path, s)
    out: list[str] = []
    todo: list = [page.root.nodes[0]]
    while todo:
        x = todo.pop()
        if isinstance(x, tuple):
            text, (kind, path, _) = x
            if kind == "content" and not (template and not page.marked and _hash(path, "text", clean(text)) in template):
                out.append(html_lib.unescape(text))
        elif x is None:
            out.append(" ")
        elif x.tag not in RAW:
            kind, path, s = here = label[id(x)]
            if kind == "chrome" or kind == "content" and template and page.node_key(s, path, x) in template:
                out.append(" ")
                continue
            if x.tag not in INLINE:
                todo.append(None)
            todo += [(i, here) if isinstance(i, str) else i for i in reversed(x.items)]
            if x.tag not in INLINE:
                todo.append(None)
    return SPACE.sub(" ", "".join(out)).strip(" ")


def wrappers(pages: DataFrame) -> DataFrame:
    """host, trees, template: the aligned tree of every layout and the keys of its constant texts."""

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for host, h, html in zip(batch["host"], batch["h"], batch["html"], strict=True):
                page = Page(html)
                unit, items = page.features()
                slot = None if page.marked else Slot.of(page.root)
                out.append((host, page.layout, page.marked, unit, [{"path": p, "key": k, "size": n} for p, k, n in items],
                            {"h": h, "tree": slot and json.dumps(slot.tree()), "sizes": slot and _sizes(slot)}))
            yield pd.DataFrame(out, columns=["host", "layout", "marked", "unit", "items", "slot"])

    hashed = pages.where("html <> ''").select("host", F.xxhash64("html").alias("h"), "html")
    units = staged(hashed.mapInPandas(
        features, "host string, layout bigint, marked boolean, unit bigint, "
        f"items array<struct<path:bigint,key:bigint,size:bigint>>, slot struct<h:bigint,tree:string,sizes:{SIZES}>").groupBy(
        "host", "layout", "marked", "unit").agg(F.first("items").alias("items"), F.min("slot").alias("slot")), "units")

    # counts over all different main texts of a layout, and over those of the host (layout 0)
    level = ["host", "layout", "marked"]
    each = units.select("host", "marked", F.explode(F.array("layout", F.lit(0).cast("bigint"))).alias("layout"), "items")
    counts = staged(each.select(*level, F.explode("items").alias("i")).select(*level, "i.path", "i.key", "i.size").groupBy(
        *level, "path", "key").agg(F.count("*").alias("n"), F.sum("size").alias("chars")).where("n > 1"), "counts")
    paths = counts.where("key = 0 AND path <> 0").select(*level, "path", F.col("n").alias("pages"))
    constant = counts.where("key <> 0").join(paths, [*level, "path"]).where(
        F.col("n") >= F.when(F.col("marked"), LEAST[True]).otherwise(LEAST[False])).where(
        F.col("n") * 100 >= F.col("pages") * MOST)
    # near copies of one main text share most of it: that is no template
    whole = counts.where("path = 0").select(*level, F.col("chars").alias("all"))
    keys = constant.groupBy(*level).agg(F.sum("chars").alias("chars"), F.collect_list("key").alias("keys")).join(
        whole, level).where("2 * chars < all")
    template = keys.groupBy("host").agg(F.to_json(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("template"))

    trees = menus(units.where("NOT marked").select("host", "layout", "slot.tree", "slot.sizes")).groupBy("host").agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("layout", "wrapper")))).alias("trees"))
    return trees.join(template, "host", "full_outer")


SIZES = "array<struct<own:bigint,linked:bigint>>"


def _sizes(slot: Slot) -> list[dict]:
    return [{"own": own, "linked": linked} for own, linked in slot.sizes()]


def menus(pages: DataFrame) -> DataFrame:
    """host, layout (text), wrapper: the aligned tree of all ``pages`` (host, layout, tree, sizes) of a layout,
    where it finds menus; the others tell nothing that element and class names don't."""
    level = ["host", "layout"]
    kinds = pages.withColumn("k", F.xxhash64("tree"))
    sums = kinds.select(*level, "k", F.posexplode("sizes").alias("at", "size")).groupBy(*level, "k", "at").agg(
        F.sum("size.own").alias("own"), F.sum("size.linked").alias("linked")).groupBy(*level, "k").agg(
        F.sort_array(F.collect_list(F.struct("at", "own", "linked"))).alias("sizes"))
    slots = kinds.groupBy(*level, "k").agg(F.first("tree").alias("tree")).join(sums, [*level, "k"]).select(
        *level, "k", "tree", F.transform("sizes", lambda x: F.struct(x["own"].alias("own"), x["linked"].alias("linked"))).alias("sizes"))

    def loaded(group: pd.DataFrame) -> Slot:
        group = group.sort_values("k")
        return aligned([Slot.load(json.loads(t), iter([(x["own"], x["linked"]) for x in sizes]))
                        for t, sizes in zip(group["tree"], group["sizes"], strict=True)])

    def together(group: pd.DataFrame) -> pd.DataFrame:
        slot = loaded(group)
        return pd.DataFrame([(group["host"].iloc[0], group["layout"].iloc[0], group["k"].min(),
                              json.dumps(slot.tree()), _sizes(slot))], columns=[*level, "k", "tree", "sizes"])

    def last(group: pd.DataFrame) -> pd.DataFrame:
        wrapper, found = labelled(loaded(group))
        return pd.DataFrame([(group["host"].iloc[0], str(group["layout"].iloc[0]), json.dumps(wrapper))][:found],
                            columns=["host", "layout", "wrapper"])

    turn = 0
    while True:  # a round leaves a GROUPth of the trees
        slots = staged(slots, "slots")
        counts = slots.groupBy(*level).agg(F.ceil(F.count("*") / GROUP).alias("groups"))
        if (counts.agg(F.max("groups")).first()[0] or 0) <= 1:
            return slots.groupBy(*level).applyInPandas(last, "host string, layout string, wrapper string")
        turn += 1
        dealt = slots.join(counts, level).withColumn("_g", F.pmod(F.xxhash64("k", F.lit(turn)), F.col("groups")))
        slots = dealt.groupBy(*level, "_g").applyInPandas(together, slots.schema)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    Null or empty html gives an empty text; pages whose url names no host share a wrapper; a host
    with one page is read by element and class names alone; repeated rows keep their rows; an empty
    table gives an empty result; other columns are ignored.
    """
    host, _ = split_url(F.col("url"))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    learned = staged(wrappers(rows), "wrappers")

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple, tuple] = {}
        for batch in batches:
            out = []
            for html, *wrapper in zip(batch["html"], batch["trees"], batch["template"], strict=True):
                if (w := tuple(wrapper)) not in known:
                    if len(known) > 1000:
                        known.clear()
                    trees = json.loads(w[0]) if w[0] else {}
                    known[w] = ({int(k): json.loads(t) for k, t in trees.items()}, frozenset(json.loads(w[1]) if w[1] else ()))
                trees, template = known[w]
                page = Page(html)
                out.append(read_out(page, trees.get(page.layout), template))
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": out})

    got = rows.join(learned, "host", "left").select("page_id", "url", "html", "trees", "template").mapInPandas(
        texts, "page_id bigint, url string, text string")
    return got.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read(spark, sf_dir, "pages"))
