"""Main text of web pages: site templates by subtree hashes per host, then block text."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cinerank.llm.common import materialize

NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
SPECIAL = re.compile(r"[>\"']")
ATTR = re.compile(r"([a-zA-Z_:@.-][\w:@.-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACES = re.compile(r"\s+")
DIGITS = re.compile(r"\d+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp noembed noframes".split())
HIDDEN = frozenset("head script style title textarea noscript template iframe object svg math canvas audio video select button".split())
CHROME = frozenset("nav footer aside form dialog menu fieldset".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements of running text: in a page's marked article they are its content, however often they recur.
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote".split())
PARAGRAPH = frozenset("p pre blockquote".split())
#: An opening tag closes an open element of these kinds.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CHROME_NAME = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|banner|sponsor|sponsored|promo|cookie|cookies|consent|notice|popup|modal|"
                         r"overlay|sidebar|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|header|footer|masthead|comment|comments|disqus|replies|"
                         r"share|sharing|social|newsletter|subscribe|related|recommended|login|signup|search|pagination|skip)(?:$|[\s_-])", re.I)
CHROME_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: str):
        self.tag, self.attrs, self.kids = tag, attrs, []


class Tags:
    """The tags of a text, comments and declarations, in order; each character is looked at a bounded number of times.

    A ">" inside quotes doesn't end a tag, unless a quote is never closed, or no ">" follows: then the tags before that place end at the next ">"."""

    def __init__(self, source: str):
        self.source, self.last, self.broken = source, source.rfind(">"), -1

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, slash, name, attributes) of the first tag from ``at`` on; the name is empty if it is no element's."""
        s = self.source
        at = s.find("<", at)
        while at >= 0:
            if s.startswith("<!--", at):
                end = s.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(s), "", "", ""
            if at > self.last:
                at = s.find("<!--", at)
                continue
            if s[at + 1:at + 2] in ("!", "?"):
                return at, s.find(">", at) + 1, "", "", ""
            if (m := NAME.match(s, at + 1)) and (end := self._end(m.end())) >= 0:
                return at, end + 1, m[1], m[2], s[m.end():end]
            at = s.find("<", at + 1)
        return None

    def _end(self, begin: int) -> int:
        at = begin
        while at > self.broken:
            m = SPECIAL.search(self.source, at)
            if m and m[0] == ">":
                return m.start()
            close = self.source.find(m[0], m.end()) if m else -1
            if close < 0:
                self.broken = m.start() if m else len(self.source)
                break
            at = close + 1
        return self.source.find(">", begin)


def parse(source: str) -> Node:
    """A forgiving element tree: children are nodes or strings. Unclosed elements end with their parent."""
    root, tags = Node("#root", ""), Tags(source)
    stack, names, at = [root], {}, 0
    while at < len(source):
        m = tags.next(at)
        if not m:
            stack[-1].kids.append(source[at:])
            break
        if m[0] > at:
            stack[-1].kids.append(source[at:m[0]])
        at = m[1]
        if not m[3]:
            continue
        tag = m[3].lower()
        if m[2]:
            if names.get(tag):
                while stack[-1].tag != tag:
                    names[stack.pop().tag] -= 1
                names[stack.pop().tag] -= 1
            continue
        if tag in BLOCK and names.get("p"):
            _close(stack, names, {"p"}, {"td", "th", "li", "div", "article", "section", "body"})
        if tag in CLOSES:
            _close(stack, names, CLOSES[tag], {"ul", "ol", "dl", "table", "select"})
        node = Node(tag, m[4])
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
        elif tag not in VOID and not m[4].endswith("/"):
            stack.append(node)
            names[tag] = names.get(tag, 0) + 1
    return root


def _close(stack: list[Node], names: dict, kinds: set, stop: set) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in kinds:
            for n in stack[k:]:
                names[n.tag] -= 1
            del stack[k:]
            return
        if stack[k].tag in stop:
            return


def attributes(node: Node) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(node.attrs)} if node.attrs else {}


def is_chrome(node: Node, inside: bool, by_name: bool = True) -> bool:
    """Without ``by_name``: elements that are never text, and hidden ones. With it also menus, notices, adverts, forms, comments and the like by element, role, class or id."""
    if node.tag in HIDDEN or by_name and (node.tag in CHROME or (node.tag == "header" and not inside)):
        return True
    if not node.attrs or node.tag in ("html", "body", "article", "main") and "comment" not in node.attrs:
        return False
    a = attributes(node)
    if "hidden" in a or a.get("aria-hidden") == "true" or by_name and a.get("role", "").lower() in CHROME_ROLE:
        return True
    return by_name and bool(CHROME_NAME.search(a.get("class", "")) or CHROME_NAME.search(a.get("id", "")))


def main_nodes(root: Node) -> list[Node]:
    """The outermost articles, else main elements, that aren't chrome; none if the page names no main part."""
    for kinds in (("article",), ("main",)):
        found, todo = [], [root]
        while todo:
            n = todo.pop()
            if n.tag in HIDDEN or n.tag in CHROME or (n.tag in kinds and is_chrome(n, True)):
                continue
            if n.tag in kinds or kinds == ("main",) and 'role="main"' in n.attrs:
                found.append(n)
            else:
                todo.extend(k for k in reversed(n.kids) if isinstance(k, Node))
        if found:
            return _without_teasers(found)
    return []


def _without_teasers(parts: list[Node], share: float = 0.25) -> list[Node]:
    """Of several main parts, those that link elsewhere and hold less than ``share`` of the longest one's text are teasers."""
    if len(parts) < 2:
        return parts
    size, linked = [], []
    for part in parts:
        n, link, todo = 0, False, [part]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                n += len(x.strip())
            elif x.tag not in HIDDEN:
                link |= x.tag == "a"
                todo.extend(x.kids)
        size.append(n)
        linked.append(link)
    return [p for p, n, link in zip(parts, size, linked, strict=True) if not link or n >= share * max(size)]


def subtree_hashes(root: Node) -> dict[int, int]:
    """id(node) -> hash of its tag, attributes and content, for the block elements with text. Walks without recursion."""
    out: dict[int, int] = {}
    done: dict[int, bytes] = {}
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        n, ready = todo.pop()
        if not ready:
            todo.append((n, True))
            todo.extend((k, False) for k in n.kids if isinstance(k, Node))
            continue
        h = xxhash.xxh64(f"{n.tag} {SPACES.sub(' ', n.attrs).strip()}".encode("utf-8", "surrogatepass"))
        filled = False
        for k in n.kids:
            if isinstance(k, Node):
                part = done.pop(id(k))
                filled |= part[8:] == b"1"
                h.update(part[:8])
            elif t := SPACES.sub(" ", k).strip():
                filled = True
                h.update(t.encode("utf-8", "surrogatepass"))
        done[id(n)] = h.digest() + (b"1" if filled else b"0")
        if filled and n.tag in BLOCK and n.tag not in ("html", "body"):
            out[id(n)] = h.intdigest() - (1 << 63)
    return out


def menu_shapes(root: Node, min_links: int = 3, min_share: float = 0.5) -> dict[int, int]:
    """id(node) -> hash of its shape, for the block elements with at least ``min_links`` links that hold ``min_share`` of its text.

    A shape is the element's tag and class, digits masked, and its children's shapes, equal neighbours as one, without any
    words: a menu whose entries are another page's own still has the shape of its site's other menus."""
    out: dict[int, int] = {}
    done: dict[int, tuple[bytes, int, int, int]] = {}  # shape, text, text in links, links
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        n, ready = todo.pop()
        if not ready:
            todo.append((n, True))
            todo.extend((k, False) for k in n.kids if isinstance(k, Node))
            continue
        h = xxhash.xxh64(f"shape {n.tag} {DIGITS.sub('0', attributes(n).get('class', ''))}".encode("utf-8", "surrogatepass"))
        before, size, linked, links = b"", 0, 0, 0
        for k in n.kids:
            if isinstance(k, str):
                size += len(k.strip())
                continue
            shape, a, b, c = done.pop(id(k))
            size, linked, links = size + a, linked + b, links + c
            if shape != before:
                h.update(shape)
            before = shape
        if n.tag == "a":
            linked, links = size, links + 1
        done[id(n)] = h.digest(), size, linked, links
        if links >= min_links and linked >= min_share * size and n.tag in BLOCK and n.tag not in ("html", "body"):
            out[id(n)] = h.intdigest() - (1 << 63)
    return out


def inside_of(top: list[Node]) -> set[int]:
    """id() of all elements in the parts ``top``, themselves included."""
    out, todo = set(), list(top)
    while todo:
        n = todo.pop()
        out.add(id(n))
        todo.extend(k for k in n.kids if isinstance(k, Node))
    return out


def block_text(top: list[Node], inside: bool, drop: set[int], by_name: bool = True) -> str:
    """The text blocks below ``top`` in page order; chrome and the nodes in ``drop`` are left out."""
    blocks: list[str] = []
    run: list[str] = []

    def flush() -> None:
        t = SPACES.sub(" ", html.unescape("".join(run))).strip()
        if t:
            blocks.append(t)
        run.clear()

    todo: list = [k for n in reversed(top) for k in (None, n)]
    while todo:
        n = todo.pop()
        if n is None:
            flush()
        elif isinstance(n, str):
            run.append(n)
        elif n.tag == "br":
            run.append(" ")
        elif id(n) in drop or is_chrome(n, inside, by_name):
            if n.tag in BLOCK:
                flush()
        else:
            if n.tag in BLOCK:
                flush()
                todo.append(None)
            todo.extend(reversed(n.kids))
    flush()
    return "\n\n".join(blocks)


def on_site(site: int, h: int) -> int:
    """A subtree's hash on its site: the same subtree on another site differs."""
    x = (h ^ (site * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
    return x - (1 << 64) if x >> 63 else x


def extract(source: str, templates: frozenset[int] | set[int], site: int = 0, by_name: bool = True, main_only: bool = True) -> str:
    """Main text of one page: subtrees whose ``on_site`` hash is in ``templates`` go, then chrome, then, if the page
    marks its article or main part, all else. The running text of a marked part (``PROSE``) is never taken for a template
    by itself, nor is an element around it that holds nothing else, so articles that share passages, and pages that copy
    an article, keep them; a recurring box of lists or other text goes with its headings and paragraphs (``running_text``). ``by_name`` and
    ``main_only`` can be switched off to see what the templates do by themselves."""
    root = parse(source)
    top = main_nodes(root) if main_only else []
    drop = {k for k, h in subtree_hashes(root).items() if on_site(site, h) in templates} if templates else set()
    if drop and top:
        drop -= running_text(top, drop)
    if templates:  # a menu's shape counts outside the main part only: an article may hold a list of links
        menus = {k for k, h in menu_shapes(root).items() if on_site(site, h) in templates}
        drop |= menus - inside_of(top) if menus else menus
    return block_text(top or [root], bool(top), drop, by_name)


def running_text(top: list[Node], drop: set[int]) -> set[int]:
    """id() of the nodes that stay though they recur: those in ``top``, the running text inside them and what this holds,
    and elements around it that hold nothing else. An element with running text and other text, such as a heading, a list
    and a paragraph, is a box like any other, and goes whole. If the boxes of ``drop`` leave a part no paragraph, and less
    other text than they hold, they are the article itself: they are opened, and only the boxes inside them can go."""
    keep: set[int] = set()
    for part in top:
        keep.add(id(part))
        opened: list[Node] = [part]
        left, loose = False, 0
        while opened:
            boxes: list[tuple[Node, int, int]] = []
            todo: list[tuple[Node, bool]] = [(k, False) for n in opened for k in n.kids if isinstance(k, Node)]
            loose += sum(len(k.strip()) for n in opened for k in n.kids if isinstance(k, str))
            while todo:
                n, prose = todo.pop()
                if is_chrome(n, True):
                    continue
                prose |= n.tag in PROSE
                if prose:
                    keep.add(id(n))
                elif id(n) in drop:
                    running, other = _held(n)
                    if other or not running:
                        boxes.append((n, running, other))
                        continue
                    keep.add(id(n))
                size = sum(len(k.strip()) for k in n.kids if isinstance(k, str))
                left |= prose and n.tag in PARAGRAPH and size > 0
                loose += size
                todo.extend((k, prose) for k in n.kids if isinstance(k, Node))
            opened = [n for n, running, _ in boxes if running]
            if left or loose >= sum(running + other for _, running, other in boxes):
                break
            keep.update(id(n) for n in opened)
    return keep


def _held(box: Node) -> tuple[int, int]:
    """The length of a box's running text, and of its other text without chrome."""
    found = [0, 0]
    todo: list[tuple[Node, bool]] = [(box, False)]
    while todo:
        n, prose = todo.pop()
        if n is not box and is_chrome(n, True):
            continue
        prose |= n.tag in PROSE
        found[not prose] += sum(len(k.strip()) for k in n.kids if isinstance(k, str))
        todo.extend((k, prose) for k in n.kids if isinstance(k, Node))
    return found[0], found[1]


def host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def hashes_of(source: str, site: int) -> set[int]:
    """The page's subtrees, by content and, if they are menus, by shape, as hashes of their site."""
    root = parse(source)
    return {on_site(site, h) for found in (subtree_hashes(root), menu_shapes(root)) for h in found.values()}


def page_hashes(pages: DataFrame) -> DataFrame:
    """Rows (page, site, trees) from (page, site, html): the distinct subtrees and menu shapes of each page, hashed with their site."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted(hashes_of(t.as_py(), s.as_py())) for s, t in zip(b.column(1), b.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(found, pa.list_(pa.int64()))], ["page", "site", "trees"])

    return pages.select("page", "site", "html").mapInArrow(run, "page long, site long, trees array<long>")


def extract_pages(pages: DataFrame, min_pages: int = 5, min_share: float = 0.2, broadcast_trees: int = 100_000, by_name: bool = True, main_only: bool = True) -> DataFrame:
    """``pages`` without its html, plus text, for every row. Null html gives "". Extra columns pass through; a column
    named text is replaced.

    A subtree is a template of its host if at least ``min_pages`` different pages and ``min_share`` of the host's
    different pages hold it. Copies of a page count once. Counts are combined map-side, so a host with a third of
    all pages is spread over all tasks. Hosts, pages and subtrees travel as 64-bit hashes. Up to ``broadcast_trees``
    templates (800 kB) are counted and broadcast, and the html is never shuffled; beyond that each page meets the list of
    its own templates, at most its subtrees, in a join. Null or odd urls share the host ""."""
    pages = pages.drop("text")
    keep = [f for f in pages.schema.fields if f.name != "html"]
    site = F.xxhash64(host(F.col("url")))
    keyed = pages.select(F.coalesce("html", F.lit("")).alias("_html"), site.alias("_site"), *[f"`{f.name}`" for f in keep])
    keyed = keyed.withColumn("_page", F.xxhash64("_site", "_html"))
    found = materialize(page_hashes(keyed.select(F.col("_page").alias("page"), F.col("_site").alias("site"), F.col("_html").alias("html"))), "subtrees")
    one = found.groupBy("page").agg(F.first("site").alias("site"), F.first("trees").alias("trees"))
    rows = one.select("page", "site", F.explode("trees").alias("tree"))
    pages_of = one.groupBy("site").agg(F.count("*").alias("n_pages"))
    common = rows.groupBy("tree").agg(F.count("*").alias("n"), F.min("site").alias("site")).where(F.col("n") >= min_pages)
    common = materialize(common.join(pages_of, "site").where(F.col("n") >= min_share * F.col("n_pages")).select("tree"), "templates")
    few = [r.tree for r in common.limit(broadcast_trees + 1).collect()]
    names = [f.name for f in keep]
    out = StructType([*keep, StructField("text", StringType())])
    if len(few) <= broadcast_trees:
        known = pages.sparkSession.sparkContext.broadcast(np.array(few, np.int64))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees = frozenset(known.value.tolist())
            for b in batches:
                text = [extract(h.as_py(), trees, s.as_py(), by_name, main_only) for h, s in zip(b.column(0), b.column(1), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns[2:], pa.array(text, pa.string())], [*names, "text"])

        return keyed.drop("_page").mapInArrow(run, out)

    def run_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [extract(h.as_py(), set(t.as_py() or ()), s.as_py(), by_name, main_only) for h, s, t in zip(b.column(0), b.column(1), b.column(2), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[3:], pa.array(text, pa.string())], [*names, "text"])

    lists = rows.select("page", "tree").join(common, "tree").groupBy("page").agg(F.collect_set("tree").alias("_templates"))
    joined = keyed.join(lists.withColumnRenamed("page", "_page"), "_page", "left")
    return joined.select("_html", "_site", "_templates", *[f"`{n}`" for n in names]).mapInArrow(run_lists, out)


def html_digest(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its code points."""
    return extract_pages(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
