"""Main text of web pages by composite text density.

A page is read into a tree of its block elements (inline formatting is transparent). For every node:

    C characters, LC of them in links, T tags below it, LT of them links (each 1 at least where it divides)
    density = C/T * log_b(C/LC * T/LT),  b = ln(C/(C-LC) * LC + LC_body/C_body * C + e)

and each node's density sum adds the densities of its children. The subtree with the largest sum is the
main one; where articles or a main element hold a twentieth of the text, it is looked for in those only. The least density on the
path from it to the body is the threshold: whatever hangs off that path and is at least as dense belongs to the text too.

Where the path leads through an article or main, all of the outermost one belongs to the text but elements with half of their
characters in links, and outside it only the other articles of the page, unless they are teasers (their first line or half of
them is in links) or stand in what is left out, and, if there is none inside, the first h1 with less than half in links. In a page
without article and main less than half in links is enough; boilerplate that nothing marks so stays.

What by its element or role is navigation, header, footer, sidebar, advert or code is no part of the tree. What a class or id
names so in full goes with all it holds, unless it holds main or the largest article; an h1 in it stays if the page has no other.
Reader comments are named by words of their own, alone or at an end of a name, on containers only: a paragraph or quotation
called so belongs to its article. Where another class name says so only in part, the element goes if half of its text is in
links, or if it has under a tenth of the page's and stands outside an article. A form goes unless the page is wrapped in it:
it then holds an article, main or h1, or paragraphs and half of the page's text. Formulas are text of their block; buttons,
scripts and the like go without cutting the block that they stand in.

One mapInArrow stage, no shuffle; a page is held at a time, its tree as flat arrays without recursion.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexisift.llm.common import block_slices, small_batches, table, unused, without

SLICE_BYTES = 4 << 20

#: Elements by their role in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym area b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr map math semantics annotation annotation-xml mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle mpadded mphantom menclose "
    "msub msup msubsup munder mover munderover mtable mtr mtd".split()
)
SKIPPED_INLINE = frozenset("annotation annotation-xml".split())
SKIPPED = frozenset("head nav aside footer dialog menu".split())
#: Left out, too, but part of the line that they stand in.
SKIPPED_IN_LINE = frozenset("script style noscript template iframe object embed svg canvas audio video button select textarea input datalist progress meter source track param".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
COMMENTS = frozenset("comment comments reply replies disqus respond".split())
#: Elements that a class of COMMENTS can leave out.
CONTAINERS = frozenset("article details div dl li ol section table tr ul".split())
SKIPPED_CLASSES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer "
    "cookie cookies consent notice notices popup modal newsletter subscribe signup login share sharing social related recommended comment comments disqus reply replies respond widget".split()
)
#: An opening tag that ends an open element of these, up to the given container.
CLOSES = {
    "li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select",)),
}
SPACES = re.compile(r"\s+")
WORDS = re.compile(r"[a-z]+")
#: What may stand in a head; anything else ends one that isn't closed.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: An article or main with this share of the text is where the main part is looked for.
LEAST_SHARE = 0.05
#: First words of class names that speak of the layout around an element.
LAYOUT = frozenset("has have no not with without show hide".split())


def class_role(tag: str, attrs) -> str:
    """What the class and id say of an element: "comments", "out", "last" or "part" by which words of a name are known, or "".

    Names all of whose words are in SKIPPED_CLASSES leave the element out, and so do those that begin or end in a word of
    COMMENTS, on containers. Others only make it suspect: those that end in such a word ("last") or have one elsewhere
    ("part"). Names that begin with a layout word say nothing.
    """
    role = ""
    for name, value in attrs:
        if name in ("class", "id") and value:
            for token in value.lower().split():
                words = WORDS.findall(token)
                if not words or words[0] in LAYOUT:
                    continue
                if words[0] in COMMENTS or words[-1] in COMMENTS:
                    if tag in CONTAINERS:
                        return "comments"
                    continue
                known = [w in SKIPPED_CLASSES for w in words]
                if all(known):
                    role = "out"
                elif role != "out":
                    role = "last" if known[-1] else role or ("part" if any(known) else "")
    return role


def is_skipped(tag: str, attrs, within: bool) -> bool:
    """Whether an element is left out whatever it holds; within: whether it stands in an article or main element."""
    if tag in SKIPPED or tag == "header" and not within:
        return True
    return any(name == "role" and value and value.strip().lower() in SKIPPED_ROLES for name, value in attrs)


class Tree(HTMLParser):
    """Flat arrays of a page's block elements, in page order: parents come before children."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.own_tags, self.own_links, self.tag = [-1], [0], [0], [""]
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters in links
        self.open: list[tuple[str, int, bool]] = []  # tag, node, whether left out
        self.roles: dict[int, str] = {}  # what the class names of nodes say
        self.outside: set[int] = set()  # of those, the ones outside articles
        self.forms: set[int] = set()
        self.counts: dict[str, int] = {}
        self.hidden = 0  # open elements of SKIPPED_IN_LINE
        self.text: list[str] = []
        self.linked: list[str] = []

    def node(self) -> int:
        return self.open[-1][1] if self.open else 0

    def flush(self):
        text = SPACES.sub(" ", "".join(self.text)).strip()
        if text:
            self.blocks.append((self.node(), text, len(SPACES.sub(" ", "".join(self.linked)).strip())))
        self.text.clear()
        self.linked.clear()

    def pop(self):
        tag = self.open[-1][0]
        if tag in SKIPPED_IN_LINE:
            self.hidden -= 1
        elif tag not in INLINE and not self.hidden:
            self.flush()
        self.open.pop()
        self.counts[tag] -= 1

    def close_upto(self, tags, stop):
        if not any(self.counts.get(t) for t in tags):
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in tags:
                while len(self.open) > i:
                    self.pop()
                return
            if self.open[i][0] in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "body" or self.open and self.open[-1][0] == "head" and tag not in IN_HEAD and tag not in ("head", "html"):
            self.close_upto(("head",), ())
        if tag in INLINE:
            if tag == "br":
                self.text.append(" ")
                return
            if tag == "a":
                self.close_upto(("a",), ())
                self.own_links[self.node()] += 1
                self.own_tags[self.node()] += 1
            if tag not in VOID:
                self.open.append((tag, self.node(), tag in SKIPPED_INLINE or bool(self.open) and self.open[-1][2]))
                self.counts[tag] = self.counts.get(tag, 0) + 1
            return
        if tag in SKIPPED_IN_LINE or self.hidden:
            if tag not in VOID:
                self.open.append((tag, self.node(), True))
                self.counts[tag] = self.counts.get(tag, 0) + 1
                self.hidden += tag in SKIPPED_IN_LINE
            return
        self.close_upto(("p",), ("td", "th", "table", "button", "object", "template"))
        if tag in CLOSES:
            self.close_upto(*CLOSES[tag])
        if tag in ("html", "body"):
            return
        self.flush()
        out = self.open[-1][2] if self.open else False
        if tag in VOID:
            return
        within = bool(self.counts.get("article") or self.counts.get("main"))
        out = out or is_skipped(tag, attrs, within)
        node = self.node()
        if not out:
            self.parent.append(node)
            self.own_tags[node] += 1
            self.own_tags.append(0)
            self.own_links.append(0)
            self.tag.append(tag)
            node = len(self.parent) - 1
            role = class_role(tag, attrs)
            if role and tag != "main" and (tag != "article" or role == "comments"):
                self.roles[node] = role
                if not within:
                    self.outside.add(node)
            if tag == "form":
                self.forms.add(node)
        self.open.append((tag, node, out))
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash does not close an element in HTML

    def handle_endtag(self, tag):
        if self.counts.get(tag):
            while self.open[-1][0] != tag:
                self.pop()
            self.pop()
        elif tag not in INLINE and tag not in SKIPPED_IN_LINE and not self.hidden:
            self.flush()

    def handle_data(self, data):
        if self.open and self.open[-1][0] == "head" and data.strip():
            self.close_upto(("head",), ())
        if self.open and self.open[-1][2]:
            return
        self.text.append(data)
        if self.counts.get("a"):
            self.linked.append(data)

    def close(self):
        super().close()
        while self.open:
            self.pop()
        self.flush()


def without_marked(tree: Tree) -> None:
    """Take out what class names mark, as the module's docstring says, and forms that don't wrap the page."""
    n = len(tree.parent)
    chars, linked = [0] * n, [0] * n
    heads, paragraphs, holds_main = [t in ("article", "main", "h1") for t in tree.tag], [t == "p" for t in tree.tag], [t == "main" for t in tree.tag]
    for node, text, in_links in tree.blocks:
        chars[node] += len(text)
        linked[node] += min(in_links, len(text))
    for i in range(n - 1, 0, -1):
        up = tree.parent[i]
        chars[up] += chars[i]
        linked[up] += linked[i]
        heads[up] |= heads[i]
        paragraphs[up] |= paragraphs[i]
        holds_main[up] |= holds_main[i]
    commented = [False] * n
    for i in range(1, n):
        commented[i] = commented[tree.parent[i]] or tree.roles.get(i) == "comments" and not holds_main[i]
    largest = max((i for i in range(n) if tree.tag[i] == "article" and not commented[i]), key=lambda i: (chars[i] - linked[i], -i), default=0)
    holds_largest = set()
    while largest > 0:
        holds_largest.add(largest)
        largest = tree.parent[largest]
    gone = list(commented)
    for i in range(1, n):
        role = tree.roles.get(i)
        by_role = role == "out" and not holds_main[i] and i not in holds_largest or role in ("last", "part") and (
            linked[i] * 2 >= chars[i] or role == "last" and i in tree.outside and chars[i] * 10 < chars[0]
        )
        form = i in tree.forms and not heads[i] and not (paragraphs[i] and chars[i] * 2 >= chars[0])
        gone[i] = gone[i] or gone[tree.parent[i]] or by_role or form
    titles = [i for i in range(1, n) if tree.tag[i] == "h1" and chars[i] and not commented[i]]
    if titles and all(gone[i] for i in titles):
        gone[titles[0]] = False
    for i in range(1, n):
        if gone[i]:
            tree.own_tags[i] = tree.own_links[i] = 0
            tree.own_tags[tree.parent[i]] -= not gone[tree.parent[i]]
            tree.tag[i] = ""
    tree.blocks = [x for x in tree.blocks if not gone[x[0]]]


def density(chars: int, linked: int, tags: int, link_tags: int, body_ratio: float) -> float:
    if not chars:
        return 0.0
    plain = max(chars - linked, 1)
    base = math.log(math.log(chars / plain * max(linked, 1) + body_ratio * chars + math.e))
    return chars / max(tags, 1) * math.log(chars / max(linked, 1) * max(tags, 1) / max(link_tags, 1)) / base


def main_blocks(html: str) -> list[str]:
    """The blocks of a page's main text, in page order."""
    tree = Tree()
    tree.feed(html)
    tree.close()
    if tree.roles or tree.forms:
        without_marked(tree)
    n = len(tree.parent)
    if not tree.blocks:
        return []
    chars, linked, tags, links = [0] * n, [0] * n, list(tree.own_tags), list(tree.own_links)
    for node, text, in_links in tree.blocks:
        chars[node] += len(text)
        linked[node] += min(in_links, len(text))
    for i in range(n - 1, 0, -1):
        up = tree.parent[i]
        chars[up] += chars[i]
        linked[up] += linked[i]
        tags[up] += tags[i]
        links[up] += links[i]
    ratio = linked[0] / max(chars[0], 1)
    dense = [density(chars[i], linked[i], tags[i], links[i], ratio) for i in range(n)]
    sums, has_children = [0.0] * n, [False] * n
    for i in range(1, n):
        sums[tree.parent[i]] += dense[i]
        has_children[tree.parent[i]] = True
    for node, text, in_links in tree.blocks:  # text beside child elements counts as a child of its own
        if has_children[node]:
            sums[node] += density(len(text), in_links, 1, 1, ratio)
    first_of = [None] * n  # each node's first block, as (characters, characters in links)
    for node, text, in_links in tree.blocks:
        at = node
        while at >= 0 and first_of[at] is None:
            first_of[at] = len(text), in_links
            at = tree.parent[at]
    mostly_linked = [linked[i] * 2 >= chars[i] for i in range(n)]
    full = [i for i in range(n) if chars[i] and (tree.tag[i] == "main" or tree.tag[i] == "article" and not mostly_linked[i] and first_of[i][1] * 2 < first_of[i][0])]
    searched = list(range(n))
    if any(chars[i] >= LEAST_SHARE * chars[0] for i in full):
        inside = [False] * n
        for i in full:
            inside[i] = True
        for i in range(1, n):
            inside[i] = inside[i] or inside[tree.parent[i]]
        searched = [i for i in range(n) if inside[i]]
    best = max(searched, key=lambda i: (sums[i], -i)) if any(sums[i] > 0 for i in searched) else searched[0]
    path, at = [], best
    while at >= 0:
        path.append(at)
        at = tree.parent[at]
    least = min(dense[i] for i in path)
    on_path = set(path)
    whole = next((k for k in range(len(path) - 1, -1, -1) if tree.tag[path[k]] in ("article", "main")), None)
    article = whole is not None
    within = set(path[: whole + 1] if article else path)  # nodes of the path of which all goes in but links
    others = set(full) if article else set()
    taken, inside = [False] * n, [False] * n
    for i in range(n):
        up = tree.parent[i]
        inside[i] = up >= 0 and inside[up] or article and i == path[whole]
        if i == best or up >= 0 and taken[up] or i in others and i not in on_path and not inside[i]:
            taken[i] = True
        elif up in on_path and i not in on_path and chars[i] and (inside[i] or not article):
            plain = not mostly_linked[i] and up in within
            taken[i] = plain or dense[i] >= least and dense[i] > 0
    if not any(tree.tag[i] == "h1" and chars[i] and (inside[i] if article else taken[i]) for i in range(n)):
        title = next((i for i in range(n) if tree.tag[i] == "h1" and chars[i] and not mostly_linked[i]), None)
        if title is not None:
            taken[title] = True
            for i in range(title + 1, n):
                taken[i] = taken[i] or taken[tree.parent[i]]

    def stays(node: int, text: str, in_links: int) -> bool:
        if taken[node] or node not in on_path:
            return taken[node]
        if article and not inside[node]:
            return False
        return node in within and in_links * 2 < len(text) or density(len(text), in_links, 1, 1, ratio) >= least

    return [text for node, text, in_links in tree.blocks if stays(node, text, in_links)]


def main_text(html: str | None) -> str:
    return "\n\n".join(main_blocks(html)) if html else ""


def extract_main_text(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Add the main text of a column of pages; null, empty and text-free pages give an empty text.

    Columns of df named like the output are replaced; repeated rows are kept, each with its own text.
    """
    page = unused(df, "page")
    rows = without(df.withColumn(page, F.coalesce(df[html].cast("string"), F.lit(""))), [text])
    kept = [f for f in rows.schema.fields if f.name != page]
    out = T.StructType([*kept, T.StructField(text, T.StringType())])

    def run(batches):
        for batch in batches:
            pages = batch.column(page)
            for a, b in block_slices(pc.binary_length(pages).to_pylist(), SLICE_BYTES):
                found = [main_text(x) for x in pages.slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name).slice(a, b - a) for f in kept], pa.array(found, pa.string())], names=out.names)

    return rows.mapInArrow(run, out)


def op4_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    small_batches(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
