"""Main texts of web pages by site style trees.

Pages of one host are built from the same templates. Their element trees are merged: nodes with the
same path of tags, classes and ids are one node of the site's style tree. A node with children is
important as far as its presentation (the sequence of its children's styles) differs between pages,
a node with text as far as its text does, both measured by entropy to the base of the number of
pages that have the node. A branch's importance mixes its own with that of its children, weighted by
how many pages have them. Branches whose importance is low are boilerplate and are removed from each
page of the site. Pages of one host with the same texts count once, so that copies of an article
don't make it look like a template. Nodes that too few pages of a host have are judged by the tree
of all hosts, if enough pages of several hosts have them; there, pages with the same texts count
once over all hosts, so that a syndicated article doesn't look like a template either.

What HTML's elements name as navigation, header, footer, side matter, form, script, style or frame
is of no importance in any tree, and neither is what a class, id or role names as readers' comments.
Sidebars by name go wherever a page has other text than headings outside named elements. Other elements
than article and main with a class, id or role that is such a word are of less importance: theirs
is multiplied by `NAMED`, and the entropy decides. Where it can't, or finds them low only so, they go
unless they hold most of the text of their page that is left. Where a page marks its article or main
part, and that holds most of what is left, what lies outside is left out.

The tree is never built as a whole: Spark counts (host, node, value) rows, and entropies are sums
over groups. Pages are read in time and memory proportional to their length, however malformed.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tonearm.llm.blocks import mapped, runs, written
from tonearm.llm.texts import batch

LEAST_PAGES = 8
LEAST_HOSTS = 3
LOW = 0.2
DECAY = 0.9
NAMED = 0.5
#: Hosts and branches that may be broadcast to the pages; with more, pages are shuffled by host.
BROADCAST_ENTRIES = 200_000

# Element names of HTML by what they mean for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
NOISE_TAGS = frozenset(
    "nav header footer aside form script style noscript template iframe object embed svg canvas button select textarea "
    "option datalist dialog menu head title noembed noframes audio video map".split()
)
MAIN_TAGS = frozenset(("article", "main"))
UNNAMED = MAIN_TAGS | {"html", "body"}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("table", "tr"))),
    "th": (frozenset(("td", "th")), frozenset(("table", "tr"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
}
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login register share sharing social "
    "sidebar aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer "
    "comment comments commentlist reply replies respond disqus discussion related recommended recommendations pagination "
    "pager paging search searchform toolbar skip copyright legal disclaimer form".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus discussion".split())
SIDE_WORDS = frozenset("sidebar aside complementary".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
CLOSING_OR_QUOTE = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
DIGITS = re.compile(r"\d+")


class Markup:
    """The tags of a page in order, found in time proportional to its length.

    Quotes hide the end of a tag; where that leaves a tag without an end, it ends at the first `>`. What
    was searched for in vain or found further on is remembered, so that no part is searched again for
    each of many broken tags.
    """

    def __init__(self, source: str):
        self.source = source
        self._next: dict[str, int] = {}
        self._special = -1
        self._endless: set[int] = set()

    def next(self, what: str, at: int) -> int:
        """The first place of `what` from `at` on, or the page's size; asked for places in ascending order."""
        found = self._next.get(what, -1)
        if found < at:
            found = self.source.find(what, at)
            self._next[what] = found = len(self.source) if found < 0 else found
        return found

    def _end_outside_quotes(self, at: int) -> int:
        """The place of the `>` that ends a tag whose name ends at `at`, quotes respected; -1 without one."""
        source, size, seen = self.source, len(self.source), []
        if self._special < at:
            found = CLOSING_OR_QUOTE.search(source, at)
            self._special = found.start() if found else size
        place = self._special
        while place < size and source[place] != ">":
            # From this quote on, an earlier tag has found no end.
            if place in self._endless:
                break
            seen.append(place)
            closing = source.find(source[place], place + 1)
            found = CLOSING_OR_QUOTE.search(source, closing + 1) if closing >= 0 else None
            place = found.start() if found else size
        else:
            if place < size:
                return place
        self._endless.update(seen)
        return -1

    def tags(self) -> Iterator[tuple[str, str, str, bool]]:
        """(text before, name, what follows the name, is an end tag) of each tag; the name is empty for character
        data, which is given as its text, and at the end of the page."""
        source, size, at, text = self.source, len(self.source), 0, 0
        while True:
            start = source.find("<", at)
            if start < 0 or start + 1 == size:
                yield source[text:], "", "", False
                return
            first = source[start + 1]
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                yield source[text:start], "", "", False
                at = text = size if end < 0 else end + 3
                continue
            if source.startswith("<![CDATA[", start) and (end := self.next("]]>", start + 9)) < size:
                yield source[text:start] + html_entities.escape(source[start + 9 : end]), "", "", False
                at = text = end + 3
                continue
            close = self.next(">", start + 1)
            if close == size:
                at = start + 1
                continue
            if first in "!?":
                yield source[text:start], "", "", False
                at = text = close + 1
                continue
            ending = first == "/"
            name = TAG_NAME.match(source, start + 1 + ending)
            if not name:
                at = start + 1
                continue
            end = self._end_outside_quotes(name.end())
            if end < 0:
                end = close
            jump = yield source[text:start], name.group().lower(), source[name.end() : end + 1], ending
            at = text = end + 1
            if jump:
                # The content of this element is no markup.
                found = re.compile(f"</{jump}\\b[^>]*>?", re.IGNORECASE).search(source, at)
                at = text = found.end() if found else size
                yield "", "", "", False


def _style(tag: str, rest: str) -> tuple[str, frozenset[str]]:
    """The name of an element's node, and the words of its class, id or role that say that it isn't main text."""
    said = set()
    name = tag
    if len(rest) > 1:
        for key, *values in ATTRIBUTE.findall(rest):
            key, value = key.lower(), "".join(values)
            if key == "hidden":
                continue
            said |= (NOISE_ROLES if key == "role" else NOISE_WORDS).intersection(value.lower().split())
            name += f" {key}={DIGITS.sub('0', ' '.join(sorted(value.split())))}"
    return name, frozenset() if tag in UNNAMED else frozenset(said)


class Block:
    """A run of text in one block element."""

    __slots__ = ("node", "noise", "main", "text")

    def __init__(self, node, noise: bool, main: bool, text: str):
        self.node, self.noise, self.main, self.text = node, noise, main, text


class Node:
    """An element of one page; `name` is a hash of its path of styles. Noise and main hold for all below. `solid` is
    the nearest element from here up that isn't inline, `top` the nearest that is a block or named."""

    __slots__ = ("tag", "name", "up", "depth", "noise", "named", "side", "main", "solid", "top", "children")

    def __init__(self, tag: str, style: str, up, said: frozenset[str]):
        self.tag, self.up = tag, up
        self.name = node_name(f"{up.name}>{style}" if up else style)
        self.depth = up.depth + 1 if up else 0
        inner_title = tag == "header" and up is not None and up.main
        self.named = bool(said)
        self.noise = bool(up and up.noise) or (tag in NOISE_TAGS and not inner_title) or not said.isdisjoint(COMMENT_WORDS)
        self.side = not said.isdisjoint(SIDE_WORDS)
        self.main = bool(up and up.main) or tag in MAIN_TAGS
        self.solid = self if tag not in INLINE else up.solid
        self.top = self if tag not in INLINE or self.named else up.top
        self.children = []
        if up:
            up.children.append(style)


def page_blocks(source: str) -> tuple[list[Block], list[Node]]:
    """The blocks of text of a page in order, and its elements, each after the one it lies in."""
    root = Node("", "", None, frozenset())
    stack, blocks, nodes, held = [root], [], [root], []
    places: dict[str, list[int]] = {}

    def flush():
        text = " ".join(html_entities.unescape("".join(held)).split())
        held.clear()
        if text:
            blocks.append(Block(stack[-1].top, stack[-1].noise, stack[-1].main, text))

    def close(upto: int):
        if any(n.tag not in INLINE or n.noise or n.named for n in stack[upto:]):
            flush()
        for n in stack[upto:]:
            places[n.tag].pop()
        del stack[upto:]

    def innermost(tags: frozenset[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def implied(tag: str):
        """Ends elements that the start of this one ends."""
        if tag in CLOSES_P:
            if stack[-1].solid.tag == "p":
                close(stack[-1].solid.depth)
        elif tag in SIBLINGS:
            ends, bounds = SIBLINGS[tag]
            last = innermost(ends)
            if last > innermost(bounds):
                close(last)

    tags = Markup(source).tags()
    for before, tag, rest, ending in tags:
        held.append(before)
        if not tag:
            continue
        if ending:
            if places.get(tag):
                close(places[tag][-1])
            continue
        implied(tag)
        if tag == "br" or tag == "wbr":
            held.append(" " if tag == "br" else "")
            continue
        style, said = _style(tag, rest)
        if tag not in INLINE or tag in NOISE_TAGS or said:
            flush()
        if tag in VOID or rest.endswith("/>") and tag in ("svg", "path"):
            continue
        node = Node(tag, style, stack[-1], said)
        nodes.append(node)
        if tag in RAW:
            tags.send(tag)
            continue
        places.setdefault(tag, []).append(len(stack))
        stack.append(node)
    flush()
    return blocks, nodes


def main_text(source: str, low: frozenset[int] = frozenset(), strong: frozenset[int] = frozenset()) -> str:
    """The text of a page's important blocks, one blank line between them. `low` names branches that are removed,
    `strong` those that are important in spite of their names."""
    blocks, nodes = page_blocks(source)

    def below(chosen) -> set[Node]:
        """The chosen elements and all that lie in them."""
        found = set()
        for n in nodes:
            if n.up in found or chosen(n):
                found.add(n)
        return found

    gone = below(lambda n: n.name in low) if low else set()
    kept = [b for b in blocks if not b.noise and b.node not in gone]
    if any(n.named for n in nodes):
        named = below(lambda n: n.named)
        if any(b.node not in named and b.node.tag not in HEADINGS for b in kept):
            aside = below(lambda n: n.side)
            kept = [b for b in kept if b.node not in aside]
        held, size = dict.fromkeys(nodes, 0), sum(len(b.text) for b in kept)
        for b in kept:
            held[b.node] += len(b.text)
        for n in reversed(nodes):
            if n.up is not None:
                held[n.up] += held[n]
        gone = below(lambda n: n.named and 2 * held[n] <= size and n.name not in strong)
        kept = [b for b in kept if b.node not in gone]
    marked = [b for b in kept if b.main]
    if 2 * sum(len(b.text) for b in marked) > sum(len(b.text) for b in kept):
        kept = marked
    return "\n\n".join(b.text for b in kept)


def node_name(value: str) -> int:
    return xxhash.xxh64_intdigest(value) - (1 << 63)


def host_of(url: Column) -> Column:
    """The lower-case host of a URL; the empty string where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _node_values(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page a hash of its texts, and (node, parent, depth, named, is text, value) of its nodes outside noise."""
    kind = pa.list_(pa.struct([
        ("node", pa.int64()), ("parent", pa.int64()), ("depth", pa.int32()), ("named", pa.bool_()), ("leaf", pa.bool_()),
        ("value", pa.int64()),
    ]))
    for rows in batches:
        hosts, copies, lists = [], [], []
        for host, source in zip(rows.column("host").to_pylist(), rows.column("html").to_pylist()):
            blocks, nodes = page_blocks(source)
            parts, texts, info = {}, {}, {}
            for n in nodes:
                if not n.noise and n.up is not None:
                    parts.setdefault(n.name, set()).update(n.children)
                    info[n.name] = (n.name, n.up.name, n.depth, n.named)
            clean = [b for b in blocks if not b.noise and b.node.up is not None]
            for b in clean:
                texts.setdefault(b.node.name, set()).add(b.text)
            out = []
            for name, styles in parts.items():
                if styles:
                    out.append((*info[name], False, node_name("|".join(sorted(styles)))))
                out += [(*info[name], True, node_name(t)) for t in texts.get(name, ())]
            hosts.append(host)
            copies.append(node_name("\n".join(b.text for b in clean)))
            lists.append([dict(zip(("node", "parent", "depth", "named", "leaf", "value"), o)) for o in out])
        yield batch(host=(hosts, pa.string()), copy=(copies, pa.int64()), nodes=(lists, kind))


def _importance(counts: DataFrame, key: list[str]) -> DataFrame:
    """Importance of each node's text and shape, and the pages that have the node, from rows (key, node, value, n)."""
    leaf, n = F.col("leaf"), F.col("n")
    sums = counts.groupBy(*key, "node", "parent", "depth", "named").agg(
        F.sum(F.when(leaf, n)).alias("texts"), F.avg(F.when(leaf, F.log(n))).alias("log_text"),
        F.sum(F.when(~leaf, n)).alias("shapes"), F.sum(F.when(~leaf, n * F.log(n))).alias("n_log_shape"),
    )
    # A node without children has no shape; its texts are as many as its pages, or more.
    sums = sums.withColumn("pages", F.coalesce("shapes", "texts"))
    m = F.log(F.greatest("pages", F.lit(2)).cast("double"))
    entropy = (F.log(F.greatest("shapes", F.lit(1)).cast("double")) - F.col("n_log_shape") / F.col("shapes")) / m
    return sums.select(
        *key, "node", "parent", "depth", "named", "pages", (1 - F.col("log_text") / m).alias("text"),
        F.when(F.col("shapes").isNotNull(), F.least(entropy, F.lit(1.0))).alias("shape"),
    )


def _low_branches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the nodes of each host, deepest first, the names of the branches of low importance, and of those that
    are important (`strong`) in spite of their names."""
    hosts, nodes, strong = [], [], []

    def found() -> pa.RecordBatch:
        return batch(host=(hosts, pa.string()), node=(nodes, pa.int64()), strong=(strong, pa.bool_()))

    for host, members in runs(batches, "host"):
        below = {}
        for row in members:
            children, texts = below.pop(row["node"], None), row["text"]
            parts = [(texts, row["pages"])] if texts is not None else []
            parts += children or []
            inner = sum(i * w for i, w in parts) / sum(w for _, w in parts) if parts else 0.0
            shape = row["shape"]
            total = inner if shape is None or not children else (1 - DECAY) * shape + DECAY * inner
            lowered = NAMED * total if row["named"] else total
            if parts:
                below.setdefault(row["parent"], []).append((lowered, row["pages"]))
            if row["judged"] and parts and (total < LOW or (row["named"] and lowered >= LOW)):
                hosts.append(host)
                nodes.append(row["node"])
                strong.append(total >= LOW)
        if len(nodes) > 10_000:
            yield found()
            hosts, nodes, strong = [], [], []
    if nodes:
        yield found()


def _counted(pages: DataFrame, key: list[str]) -> DataFrame:
    """Rows (key, node, value, n) of the nodes of pages."""
    return pages.select(*key, F.explode("nodes").alias("v")).groupBy(
        *key, "v.node", "v.parent", "v.depth", "v.named", "v.leaf", "v.value"
    ).agg(F.count("*").alias("n"))


def low_branches(pages: DataFrame) -> DataFrame:
    """(host, low, strong) of hosts with branches of low importance, or important ones with names that say otherwise."""
    schema = (
        "host string, copy long, nodes array<struct<node: bigint, parent: bigint, depth: int, named: boolean, "
        "leaf: boolean, value: bigint>>"
    )
    values = pages.select("host", "html").transform(mapped, _node_values, schema)
    once = written(values.groupBy("host", "copy").agg(F.first("nodes").alias("nodes")), "style-pages")
    sites = written(_importance(_counted(once, ["host"]), ["host"]), "style-nodes")
    # Over all hosts, a text and its page count once; of hosts with the same page the first one stands for it.
    pooled = once.groupBy("copy").agg(F.min_by("nodes", "host").alias("nodes"))
    hosts = sites.groupBy("node").agg(F.count("*").alias("hosts"))
    everywhere = _importance(_counted(pooled, []), []).join(hosts, "node")
    everywhere = everywhere.where((F.col("pages") >= LEAST_PAGES) & (F.col("hosts") >= LEAST_HOSTS)).select(
        "node", F.col("text").alias("pool_text"), F.col("shape").alias("pool_shape"), F.lit(True).alias("pooled")
    )

    # Where a host has few pages with a node, its text and shape are judged by those of all hosts.
    few = F.col("pages") < LEAST_PAGES
    by_pool = sites.where(few).join(everywhere, "node", "left").withColumn("judged", F.coalesce("pooled", F.lit(False)))
    known = ["host", "node", "parent", "depth", "named", "pages"]
    by_pool = by_pool.select(
        *known, *(F.when(F.col("judged"), F.col(f"pool_{c}")).otherwise(F.col(c)).alias(c) for c in ("text", "shape")), "judged"
    )
    each = sites.where(~few).select(*known, "text", "shape", F.lit(True).alias("judged")).unionByName(by_pool)
    ordered = each.repartition("host").sortWithinPartitions("host", F.desc("depth"))
    both = ordered.transform(mapped, _low_branches, "host string, node bigint, strong boolean")
    lists = (F.collect_set(F.when(F.col("strong") == v, F.col("node"))).alias(c) for c, v in (("low", False), ("strong", True)))
    return written(both.groupBy("host").agg(*lists), "style-low")


def extract(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text and n_chars (code points).

    Character references are decoded, white space within a block becomes one space, and blocks are
    joined by a blank line. Null and empty html gives an empty text. Repeated pages give the same text
    each. Pages without a host (a null or relative url) form one site. Malformed pages are read like any other,
    in time proportional to their length. An empty table gives no rows.
    """
    pages = df.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("html"), host_of(F.col(url)).alias("host"),
    )
    by_host = low_branches(pages)
    entries = by_host.agg(F.coalesce(F.sum(1 + F.size("low") + F.size("strong")), F.lit(0))).first()[0]
    side = F.broadcast(by_host) if entries <= BROADCAST_ENTRIES else by_host

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[str, tuple[frozenset[int], frozenset[int]]] = {}
        for rows in batches:
            texts = []
            columns = (rows.column(c).to_pylist() for c in ("host", "html", "low", "strong"))
            for host, source, low, strong in zip(*columns):
                if host not in sets:
                    if len(sets) > 10_000:
                        sets.clear()
                    sets[host] = frozenset(low or ()), frozenset(strong or ())
                texts.append(main_text(source, *sets[host]))
            yield batch(
                page_id=rows.column("page_id"), url=rows.column("url"), text=(texts, pa.string()),
                n_chars=([len(t) for t in texts], pa.int64()),
            )

    joined = pages.join(side, "host", "left").select("page_id", "url", "host", "html", "low", "strong")
    return joined.transform(mapped, run, "page_id long, url string, text string, n_chars long")
