"""Main text of web pages by wrapper induction over the pages of a host.

Every page is folded into a tree of its blocks and aligned by simple tree matching with
one reference page of its host. Whole trees are aligned, menus and footers too. A text that
occurs at the same node of at least SHARE of the host's pages with any text is template; the
other texts of the node are its varying slot. A host needs MIN_PAGES pages of different
content before its constant texts count as template, so a line that a few copies share stays.

Content is what varies, where most of it varies: the wrapper names the smallest part of the
reference that holds MOST of the host's varying text. Parts that hold at least half of it are
content whatever their names. Otherwise, and on hosts without a wrapper, elements (menus,
footers, forms, scripts, ...) and names in class, id or role (advert, sidebar, notice,
comments, ...) tell what stands beside the article. Where a page has an article or main
element, only that is read.

A null html gives an empty text, a null url or one without host belongs to the host "".
Repeated rows are extracted each; an empty table gives an empty result; other columns are
ignored.
"""

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import column, ship_library, stored
from daybook.llm.html_tree import (
    ASIDE,
    DROPPED,
    HEADINGS,
    TOPICS,
    Node,
    Shape,
    align,
    blocks_of,
    dump,
    fold,
    hash_text,
    load,
    parse,
)
from daybook.llm.url_filter import split_url

# Pages of different content that must agree before a text counts as template.
MIN_PAGES = 8
# Of a host's pages of different content, those that must have a text of the template.
SHARE = 0.95
# Of a host's varying text, what its main part holds, and what makes any part content.
MOST, HALF = 0.8, 0.5
_BATCH = 256


def _regions(node: Node, wanted) -> list[Node]:
    """The outermost nodes that are wanted, outside of what stands beside the article."""
    found, todo = [], [node]
    while todo:
        current = todo.pop()
        for part in reversed(current.parts):
            if isinstance(part, Node) and not part.beside_article:
                todo.append(part)
        if wanted(current):
            found.append(current)
            for _ in [p for p in current.parts if isinstance(p, Node) and not p.beside_article]:
                todo.pop()
    return found


def main_regions(root: Node, induced: frozenset[int] = frozenset()) -> list[Node]:
    """The parts to read; induced has the ids of nodes that the host's wrapper names."""
    for wanted in (
        lambda n: n.tag == "article",
        lambda n: n.tag == "main" or "main" in n.names and n.tag not in ("html", "body"),
        lambda n: id(n) in induced,
        lambda n: n.tag == "body",
    ):
        regions = _regions(root, wanted)
        if regions:
            return regions
    return [root]


def content_blocks(
    root: Node,
    template: frozenset[tuple[int, int]] = frozenset(),
    induced: frozenset[int] = frozenset(),
) -> list[str]:
    """Texts of the main regions in page order, without those of the template.

    template has (id of a node, hash of a text) pairs.
    """
    found: list[str] = []

    def read(node: Node, headings_only: bool) -> None:
        for part in blocks_of(node):
            if isinstance(part, str):
                if headings_only and node.tag not in HEADINGS:
                    continue
                if (id(node), hash_text(part)) not in template if template else True:
                    found.append(part)
            elif not part.beside_article:
                read(part, headings_only or part.tag == "header")

    for region in main_regions(root, induced):
        # Of a header within an article only its headings are the article's.
        read(region, False)
    return found


def _walk(node: Node) -> Iterator[Node]:
    todo = [node]
    while todo:
        current = todo.pop()
        yield current
        todo += [part for part in current.parts if isinstance(part, Node)]


def extract(page: str | None, wrapper: str | None = None) -> str:
    """The main text, blocks joined by two line breaks.

    Where all of a page's text has the name of a topic (see TOPICS), it is read.
    """
    root = parse(page or "")
    template, induced = set(), set()
    if wrapper is not None:
        reference, constant, region, content = json.loads(wrapper)
        constant, content = {(node, text) for node, text in constant}, set(content)
        for number, matched in align(load(reference), fold(root)):
            for text in set(matched.texts):
                if (number, text) in constant:
                    template |= {(id(node), text) for node in matched.nodes}
            for node in matched.nodes:
                node.is_content = number in content
            if number == region:
                induced |= {id(node) for node in matched.nodes}
    found = content_blocks(root, frozenset(template), frozenset(induced))
    if not found:
        topics = [n for n in _walk(root) if n.tokens and n.tag not in DROPPED and n.tokens & ASIDE <= TOPICS]
        for node in topics:
            node.is_content = True
        if topics:
            found = content_blocks(root, frozenset(template), frozenset(induced))
    return "\n\n".join(found)


def _host(url: str | None) -> str:
    return split_url(url or "")[0]


def induce_wrappers(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(host, wrapper): of every host with enough pages its reference tree, the constant texts, the node with
    most of the varying text, and the nodes that hold half of it."""
    ship_library(pages.sparkSession)

    def outlines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for link, page in zip(batch["url"], batch["html"]):
                shape = fold(parse(page or ""))
                texts: list = []

                def collect(node: Shape) -> list:
                    texts.extend(node.texts)
                    own = sorted(dict(zip(node.texts, node.sizes)).items())
                    return [node.label, [collect(c) for c in node.children], own]

                tree = collect(shape)
                if not texts:
                    continue
                outline = hash_text(json.dumps(dump(shape)))
                rows.append((_host(link), hash_text(json.dumps(texts)), outline, json.dumps(tree)))
            yield pd.DataFrame(rows, columns=["host", "content", "outline", "tree"])

    # Pages without key or of one content would only repeat each other.
    read = pages.select(
        column(url).cast("string").alias("url"), column(html).cast("string").alias("html")
    )
    outlined = stored(
        read.mapInPandas(outlines, "host string, content long, outline long, tree string")
        .groupBy("host", "content")
        .agg(F.min("tree").alias("tree"), F.min_by("outline", "tree").alias("outline"))
    )
    # The reference has the outline that most pages have, so no odd page is chosen.
    hosts = stored(
        outlined.groupBy("host", "outline")
        .agg(F.count("*").alias("alike"), F.min_by("tree", "content").alias("tree"))
        .groupBy("host")
        .agg(
            F.sum("alike").alias("pages"),
            F.max_by("tree", F.struct("alike", "outline")).alias("reference"),
        )
        .where(F.col("pages") >= MIN_PAGES)
    )

    def constants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, tree, reference in zip(batch["host"], batch["tree"], batch["reference"]):
                for number, matched in align(_shape(reference), _shape(tree)):
                    own = dict(zip(matched.texts, matched.sizes))
                    rows += [(host, number, text, size) for text, size in own.items()]
            yield pd.DataFrame(rows, columns=["host", "node", "text", "size"])

    # Only the pages of hosts that can have a template; Spark splits a hot host.
    aligned = outlined.join(hosts, "host").select("host", "tree", "reference")
    counted = (
        aligned.mapInPandas(constants, "host string, node int, text long, size long")
        .groupBy("host", "node", "text")
        .agg(F.count("*").alias("found"), F.max("size").alias("size"))
    )
    marked = stored(
        counted.join(hosts.select("host", "pages"), "host").withColumn(
            "constant", F.col("found") >= F.col("pages") * SHARE
        )
    )
    # A page holds SHARE of its host's constant texts on average, so the list is little longer.
    lists = marked.groupBy("host").agg(
        F.sort_array(
            F.collect_list(F.when(F.col("constant"), F.struct("node", "text")))
        ).alias("constant")
    )
    # As many rows a host as its reference has nodes.
    amounts = (
        marked.where(~F.col("constant"))
        .groupBy("host", "node")
        .agg(F.sum(F.col("size") * F.col("found")).alias("amount"))
        .groupBy("host")
        .agg(F.collect_list(F.struct("node", "amount")).alias("amounts"))
    )

    @F.pandas_udf("string")
    def wrappers(references: pd.Series, constant: pd.Series, amounts: pd.Series) -> pd.Series:
        found = []
        for reference, texts, varying in zip(references, constant, amounts):
            shape = _shape(reference)
            by_node = {int(x["node"]): int(x["amount"]) for x in varying} if varying is not None else {}
            region, content = varying_parts(shape, by_node)
            pairs = [[int(x["node"]), int(x["text"])] for x in texts]
            found.append(json.dumps([dump(shape), pairs, region, content]))
        return pd.Series(found)

    joined = lists.join(hosts, "host").join(amounts, "host", "left")
    return joined.select("host", wrappers("reference", "constant", "amounts").alias("wrapper"))


def varying_parts(reference: Shape, amounts: dict[int, int]) -> tuple[int | None, list[int]]:
    """Of nodes, numbered in page order, with amounts of varying text: the smallest part that
    holds MOST of all, and all that hold HALF of it (None and none if nothing varies)."""
    below: list[int] = []

    def add(shape: Shape) -> int:
        number = len(below)
        below.append(0)
        below[number] = amounts.get(number, 0) + sum(add(child) for child in shape.children)
        return below[number]

    total = add(reference)
    if not total:
        return None, []
    # Of parts within each other the later number is the inner one; no two others hold MOST.
    region = max(number for number, amount in enumerate(below) if amount >= MOST * total)
    return region, [number for number, amount in enumerate(below) if amount >= HALF * total]


def _shape(tree: str) -> Shape:
    def build(value: list) -> Shape:
        texts, sizes = [text for text, _ in value[2]], [size for _, size in value[2]]
        return Shape(value[0], [build(child) for child in value[1]], texts, sizes)

    return build(json.loads(tree))


def extract_pages(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Per row: the key, url, text (empty if none) and n_chars, its code points."""
    wrappers = stored(induce_wrappers(pages, key, url, html))

    @F.pandas_udf("string")
    def host_of(urls: pd.Series) -> pd.Series:
        return pd.Series([_host(value) for value in urls])

    @F.pandas_udf("string")
    def main_text(contents: pd.Series, wrapper: pd.Series) -> pd.Series:
        return pd.Series([extract(page, known) for page, known in zip(contents, wrapper)])

    rows = pages.select(
        column(key).alias("key"),
        column(url).cast("string").alias("url"),
        column(html).cast("string").alias("html"),
        host_of(column(url).cast("string")).alias("host"),
    )
    # Wrappers are stored, so Spark knows their size: few enough and they are broadcast.
    known = rows.join(wrappers, "host", "left")
    return known.select(
        F.col("key").alias(key), "url", main_text("html", "wrapper").alias("text")
    ).withColumn("n_chars", F.length("text").cast("long"))
