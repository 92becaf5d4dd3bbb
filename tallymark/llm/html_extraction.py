"""Main text of pages by a site style tree.

The DOMs of a host are merged into one tree. A node of it is a tag path with class and role names,
as in /html/body/div.ad. For each node two entropies over the host's pages tell how much it varies:

* presentation: entropy of the ways its children are laid out (the distinct runs of child tags),
* content: entropy of the texts that stand under it.

Both are divided by the entropy of as many different values as there are pages, so they lie between
0 and 1, and the importance of a node is the larger one. A branch that repeats itself over the pages
of the host scores near 0. Varying branches that are no content by their very kind (navigation, page
headers and footers, sidebars, notices, adverts, forms, comments of readers) keep their kind's
importance of 0, however often their words change. Kinds are told by tag and by whole class, id and
role names: all words of a name must be listed, so 'cookie-notice' and 'left-sidebar' count and
'has-sidebar' and 'entry-header' do not. A branch of a listed kind stays, and is weighed like others,
if it holds the page's main, or its largest article with a quarter of its text, or most of its paragraph text and a quarter of all its
text; branches of readers' comments need the former, and what is never shown stays out.
Branches below `min_importance` are removed from each page, if the host shows them on at least
`min_pages` pages; with fewer, nothing is known about them and only their kind counts.

What is left is cut into blocks at block tags. White space inside a block becomes one space, the
blocks are joined by an empty line. Character references are decoded, also in cut-off pages.

Copies of a page on a host count as one page, so they make neither the article repeat itself nor the
host look larger.

How it is spread. Pages are parsed where they are read; their nodes are reduced to one row per host
and digest of the page, and counts per host, node and value are added up by Spark, both partially
before the shuffle. Only nodes to be removed are listed per host, and pages
are joined with their host's list, which is broadcast while small; beyond that a hot host is split by skew handling, as nothing gathers its pages.

Edge cases. A missing page is empty text; a missing URL is a host of its own; repeated rows count
as one page of the host and give a row each; broken markup is read as far as it goes; elements more
than 40 deep count with their ancestor at that depth in the tree; a page's time grows with its length, however
deep it is; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import frames
from tallymark.operators.staging import stage

MIN_IMPORTANCE = 0.05
MIN_PAGES = 20
_DEEPEST = 40

#: Fixed words: tags of HTML by what they do.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSHOWN = set("head script style noscript template iframe object svg canvas audio video math map".split())
OTHER_KIND = set("nav footer aside form button select textarea input dialog menu".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html"}
#: Words in class, id and role names of branches that are no article.
OTHER_NAMES = set(
    "ad ads advert advertisement advertising adverts sponsor sponsored promo promotion banner cookie cookies consent"
    " notice notices gdpr nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer masthead header topbar"
    " comment comments reply replies disqus respond share sharing social related recommended newsletter subscribe"
    " signup login popup modal overlay pagination pager widget search form toolbar complementary contentinfo".split()
)
#: Words that say where a branch stands or how it is drawn, allowed beside those.
PLACE_NAMES = set("site left right top bottom container box bar block list links".split())
#: Branches of readers' words, which can be longer than the article.
READER_NAMES = set("comment comments reply replies disqus respond".split())
_NAME = re.compile(r"[a-z]{2,}")


class Node:
    __slots__ = ("tag", "path", "children", "other", "readers")

    def __init__(self, tag: str, path: str, other: bool, readers: bool = False):
        self.tag, self.path, self.children, self.other, self.readers = tag, path, [], other, readers


def _listed(name: str) -> set[str]:
    """The words of a class, id or role name that make it a listed kind; none if it says something else."""
    found = set(_NAME.findall(name))
    return found & OTHER_NAMES if found <= OTHER_NAMES | PLACE_NAMES else set()


class _Tree(HTMLParser):
    """Elements of a page; unclosed and misplaced tags are put right as far as blocks need it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", "", False)
        self.stack = [self.root]
        self.open: dict[str, list[int]] = {}  # places of the open elements of each tag in the stack

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P and self.open.get("p"):
            self._close("p", BLOCK - {"p"})
        if tag == "li":
            self._close("li", {"ul", "ol", "menu"})
        if tag in ("td", "th", "tr"):
            for cell in ("td", "th") if tag != "tr" else ("td", "th", "tr"):
                self._close(cell, {"table"})
        if tag in ("dt", "dd"):
            self._close("dt", {"dl"})
            self._close("dd", {"dl"})
        fields = {k: (v or "").lower() for k, v in attrs if k in ("class", "id", "role")}
        names = {w for v in fields.values() for name in v.split() for w in _listed(name)}
        inside = bool(self.open.get("article") or self.open.get("main"))
        other = tag in UNSHOWN or tag in OTHER_KIND
        other |= bool(names) and tag not in ("html", "body", "article", "main")
        other |= tag == "header" and not inside
        style = fields.get("class", "") or fields.get("role", "")
        label = tag + ("." + "_".join(style.split()) if style else "")
        parent = self.stack[-1]
        node = Node(tag, f"{parent.path}/{label}" if len(self.stack) <= _DEEPEST else parent.path, other, bool(names & READER_NAMES))
        parent.children.append(node)
        if tag not in VOID:
            self.open.setdefault(tag, []).append(len(self.stack))
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._close(tag, {"table"} if tag in ("td", "th", "tr", "p") else set())

    def _close(self, tag: str, stop: set) -> None:
        """Close the innermost open element of a tag, unless one of the stop tags is open inside it."""
        places = self.open.get(tag)
        if places and not any(self.open[t][-1] > places[-1] for t in stop if t != tag and self.open.get(t)):
            at = places[-1]
            for node in reversed(self.stack[at:]):
                self.open[node.tag].pop()
            del self.stack[at:]

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    _keep_content(tree.root)
    return tree.root


def _keep_content(root: Node) -> None:
    """Take back the kind of branches that hold the page's content."""
    nodes = list(elements(root))
    if not any(n.other and n.tag not in UNSHOWN for n in nodes):
        return
    sizes: dict[int, tuple[int, int]] = {}  # shown characters under each node, and those in paragraphs
    best: tuple = (False, 0, None)
    for node in reversed(nodes):
        shown = paragraphs = 0
        for child in () if node.tag in UNSHOWN else node.children:
            if isinstance(child, str):
                shown += len("".join(child.split()))
            else:
                shown, paragraphs = shown + sizes[id(child)][0], paragraphs + sizes[id(child)][1]
        sizes[id(node)] = shown, shown if node.tag == "p" else paragraphs
        if node.tag in ("main", "article") and (node.tag == "main", shown) > best[:2]:
            best = node.tag == "main", shown, node
    shown, paragraphs = sizes[id(root)]
    holders = {id(best[2])} if best[0] or 4 * best[1] >= shown else set()
    for node in reversed(nodes):
        if any(id(c) in holders for c in node.children if isinstance(c, Node)):
            holders.add(id(node))
    for node in nodes:
        if node.other and node.tag not in UNSHOWN:
            mine = sizes[id(node)]
            most = 2 * mine[1] > paragraphs and 4 * mine[0] >= shown and not node.readers
            node.other = not (id(node) in holders or most)


def elements(node: Node):
    stack = [node]
    while stack:
        top = stack.pop()
        yield top
        stack.extend(c for c in top.children if isinstance(c, Node))


def main_text(root: Node, removed: set[str]) -> str:
    blocks, now = [], []

    def end():
        text = " ".join("".join(now).split())
        if text:
            blocks.append(text)
        now.clear()

    stack: list = [root]
    while stack:
        top = stack.pop()
        if top is None:
            end()
        elif isinstance(top, str):
            now.append(top)
        elif top.tag == "br":
            now.append(" ")
        elif top.other or top.path in removed:
            if top.tag in BLOCK:
                end()
        else:
            if top.tag in BLOCK:
                end()
                stack.append(None)
            stack.extend(reversed(top.children))
    end()
    return "\n\n".join(blocks)


def _observe(batches):
    """Per host and distinct page: layout and text of each node path."""
    for batch in batches:
        out: dict[tuple, list] = {}
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            page = host, xxhash.xxh128_digest(html)
            if page in out:
                continue
            seen: dict[str, tuple] = {}
            below: dict[int, bytes] = {}  # digest of the texts under each node
            for node in reversed(list(elements(parse(html)))):  # children before parents
                content = xxhash.xxh64()
                for child in node.children:
                    if isinstance(child, str):
                        content.update(" ".join(child.split()))
                    elif child.tag not in UNSHOWN:
                        content.update(below[id(child)])
                below[id(node)] = content.digest()
                if node.path and not node.other:
                    layout, text = seen.setdefault(node.path, (xxhash.xxh64(), xxhash.xxh64()))
                    layout.update(" ".join(c.tag if isinstance(c, Node) else "#" for c in node.children) + ";")
                    text.update(below[id(node)])
            out[page] = [(p, *(h.intdigest() - (1 << 63) for h in two)) for p, two in seen.items()]
        nodes = [n for part in out.values() for n in part]
        offsets = [0]
        for part in out.values():
            offsets.append(offsets[-1] + len(part))
        lists = (
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array([n[i] for n in nodes], t))
            for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))
        )
        keys = pa.array([k[0] for k in out], pa.string()), pa.array([k[1] for k in out], pa.binary())
        yield pa.RecordBatch.from_arrays([*keys, *lists], ["host", "page", "path", "layout", "text"])


def style_tree(pages: DataFrame) -> DataFrame:
    """Importance of each node of each host's merged tree, from a frame of host and html."""
    schema = "host string, page binary, path array<string>, layout array<long>, text array<long>"
    nodes = pages.select("host", "html").mapInArrow(_observe, schema).dropDuplicates(["host", "page"])
    nodes = nodes.select("host", F.explode(F.arrays_zip("path", "layout", "text")).alias("node"))
    seen = nodes.select(
        "host", F.col("node.path").alias("path"), F.posexplode(F.array("node.layout", "node.text")).alias("kind", "value")
    )
    counts = seen.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n"))
    entropy = counts.groupBy("host", "path", "kind").agg(
        F.sum("n").alias("pages"), F.sum(F.col("n") * F.ln("n")).alias("nln")
    )
    entropy = entropy.withColumn("entropy", F.ln("pages") - F.col("nln") / F.col("pages"))
    share = F.when(F.col("pages") > 1, F.col("entropy") / F.ln("pages")).otherwise(1.0)
    return (
        entropy.withColumn("share", share)
        .groupBy("host", "path")
        .agg(
            F.max("pages").alias("pages"),
            F.max(F.when(F.col("kind") == 0, F.col("share"))).alias("presentation"),
            F.max(F.when(F.col("kind") == 1, F.col("share"))).alias("content"),
        )
        .withColumn("importance", F.greatest("presentation", "content"))
    )


def _cut(batches):
    for batch in batches:
        out = []
        for html, removed in zip(batch.column("html").to_pylist(), batch.column("removed").to_pylist()):
            out.append(main_text(parse(html), set(removed or ())))
        columns = [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])


def extract(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    min_importance: float = MIN_IMPORTANCE,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    url = pages[url_column].cast("string")
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(
        pages[id_column].alias("page_id"),
        pages[url_column].alias("url"),
        F.coalesce(host, F.lit("")).alias("host"),
        frames.plain_text(pages, html_column).alias("html"),
    )
    low = style_tree(rows).where((F.col("pages") >= min_pages) & (F.col("importance") < min_importance))
    # written, so that Spark knows its size and moves it to the pages where it is small enough for that
    lists = stage(low.groupBy("host").agg(F.collect_list("path").alias("removed")), "html")
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType())])
    found = rows.join(lists, "host", "left").mapInArrow(_cut, schema)
    return found.withColumn("n_chars", F.length("text").cast("long"))
