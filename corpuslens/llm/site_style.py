"""Main text of pages with the help of a style tree per site.

The pages of a host are merged into one tree: a node is a path of tags and classes. A node's
presentation importance is the entropy of the child sequences that pages show there, its
content importance one minus the mean entropy of its texts and links over the pages; both
to the base of the number of distinct pages, so what every page repeats weighs nothing and
what each page has for itself weighs one. A branch's importance is the mean over its nodes,
weighted by pages and falling with depth; branches below ``LEAST`` are cut from each page.

What a page marks as its article is the frame in which branches are cut; elements that by
their tag, role or whole class names are no article text are left out as well. A branch stays if it
holds most of a page's article text, and so do paragraphs and headings that stand directly
in the article: pages that quote or copy each other keep their text.

Defined cases: a null or empty page has an empty text; identical pages of a host count
once in its tree; pages without host are no site; repeated rows have rows each; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.dom import Page
from corpuslens.session import materialise

LEAST = 0.25
LEAST_PAGES = 8  # distinct pages that show a node, before it can be judged
DECAY = 0.9
DEPTH = 32  # levels over which a node weighs on a branch; further up its weight is below 4 %
SALTS = 32

# What is no article text by its kind or name.
NO_TEXT = set("nav footer aside form button select input label fieldset dialog menu object embed canvas audio video head option".split())
NO_ROLE = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
# Whole class names or ids; a name that only holds such a word, as "has-sidebar" or "post-header", tells nothing.
NO_NAME = set(
    "nav navbar navigation menu submenu masthead topbar footer site-footer site-header site-nav main-menu sidebar site-sidebar aside "
    "ad ads advert adverts advertisement advertising adsense adslot adbox ad-box ad-slot ad-banner ad-container ad-wrapper "
    "banner sponsor sponsored sponsors promo cookie cookies cookie-notice cookie-banner cookie-consent consent gdpr "
    "popup modal newsletter newsletter-signup subscribe subscription signup signin login share sharing share-buttons social-share "
    "comment comments comment-body comment-list comments-area disqus disqus-thread respond replies reply "
    "related related-posts related-articles recommended recommendations breadcrumb breadcrumbs "
    "pagination pager post-navigation toolbar widget widgets skip-link search-form searchform hidden".split()
)
ROOTS = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PROSE = HEADINGS | {"p", "blockquote", "pre", "ul", "ol", "li", "dl", "dt", "dd", "table", "tbody", "thead", "tr", "td", "th", "figure", "figcaption"}

NODES = "host string, node long, kind string, feature long, page long, cnt long, above array<long>"


def _hash(text: str) -> int:
    digest = xxhash.xxh64_intdigest(text)
    return digest - (1 << 64) if digest >> 63 else digest


def _out_of_place(page: Page, i: int) -> bool:
    """Whether an element is no article text by its tag, role, whole class names or visibility."""
    e = page.elements[i]
    return _no_text(page, i) or e.tag not in ("html", "body", "#root") and not NO_NAME.isdisjoint(e.whole)


def _no_text(page: Page, i: int) -> bool:
    """The same by tag, role or visibility alone."""
    e = page.elements[i]
    return e.tag not in ("html", "body", "#root") and (e.tag in NO_TEXT or e.hidden or not NO_ROLE.isdisjoint(e.role))


def _roots(page: Page) -> list[int]:
    """The outermost articles of a page, or what stands for them; the body if nothing is marked.

    No class or id around an article speaks against it; one of its own does if other articles are left.
    """
    elements = page.elements
    marked = [i for i, e in enumerate(elements) if e.tag in ROOTS or "main" in e.names and e.tag in ("div", "section")]

    def stands(i: int) -> bool:
        named = elements[i].tag not in ROOTS
        refused = _out_of_place if named else _no_text
        return not any(refused(page, k) or elements[k].tag == "header" for k in page.above(i)[1:]) and not (named and refused(page, i))

    good = [i for i in marked if stands(i)]
    articles = [i for i in good if elements[i].tag == "article"] or good
    found = set(articles)
    outer = [i for i in articles if not any(k in found for k in page.above(i)[1:])]
    return [i for i in outer if not _out_of_place(page, i)] or outer or [0]


def _article_blocks(page: Page) -> tuple[list[tuple[int, str]], list[bool]]:
    """Blocks of the article, and per element whether it lies below the article's root.

    Parents precede their children, so one walk settles every element.
    """
    roots = set(_roots(page))
    size = len(page.elements)
    below, bad, header, heading = ([False] * size for _ in range(4))
    for i, e in enumerate(page.elements):
        up = e.parent
        if up < 0 or i in roots:
            continue
        if up in roots or below[up]:
            below[i] = True
            bad[i] = bad[up] or _out_of_place(page, i)
            header[i] = header[up] or e.tag == "header" or "header" in e.whole
            heading[i] = heading[up] or e.tag in HEADINGS
    out = []
    for element, text in page.blocks:
        if not (below[element] or element in roots) or bad[element]:
            continue
        if header[element] and (0 in roots or not heading[element]):
            continue
        out.append((element, text))
    return out, below


def _branches(page: Page, element: int, below: list[bool]) -> list[int]:
    """Nodes by which a block can be cut: what it lies in, up to prose that stands directly in the article."""
    path = []
    while element > 0 and below[element]:
        path.append(page.elements[element])
        element = page.elements[element].parent
    while path and path[-1].tag in PROSE and not path[-1].names:
        path.pop()
    return [e.node for e in path]


def extract(source: str, cut: frozenset[int] = frozenset()) -> str:
    """Main text of a page; ``cut`` names the nodes of its site that are to go."""
    page = Page(source)
    blocks, below = _article_blocks(page)
    if cut:
        whole = sum(len(t) for _, t in blocks)
        nodes = [cut.intersection(_branches(page, i, below)) for i, _ in blocks]
        held: Counter[int] = Counter()
        for (_, text), own in zip(blocks, nodes):
            for node in own:
                held[node] += len(text)
        gone = {node for node, size in held.items() if 2 * size <= whole}
        blocks = [b for b, own in zip(blocks, nodes) if gone.isdisjoint(own)]
    return "\n".join(t for _, t in blocks)


def page_nodes(host: str, source: str) -> Iterator[tuple]:
    """What one page adds to the tree of its host: per node its style, its texts and links."""
    page = Page(source)
    digest = _hash(source)
    style: dict[int, list[str]] = {}
    above: dict[int, list[int]] = {}
    for i, e in enumerate(page.elements[1:], 1):
        children = "+".join(t for t, before in zip(e.children, [None, *e.children]) if t != before)
        style.setdefault(e.node, []).append(children)
        if e.node not in above:
            above[e.node] = [page.elements[k].node for k in page.above(i, DEPTH)]
    texts: Counter[tuple[int, str]] = Counter()
    for element, text in page.blocks:
        texts[page.elements[element].node, re.sub("[0-9]+", "0", text.lower())] += 1
    for node, styles in style.items():
        yield host, node, "style", _hash("|".join(s for s, before in zip(styles, [None, *styles]) if s != before)), digest, 1, above[node]
    for (node, text), n in texts.items():
        yield host, node, "text", _hash(text), digest, n, None


def tree(pages: DataFrame) -> DataFrame:
    """``(host, node, importance, pages)`` of every branch of every site."""
    names = [x.split()[0] for x in NODES.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, source in zip(batch.host, batch.html):
                rows += page_nodes(host, source)
            yield pd.DataFrame(rows, columns=names)

    seen = pages.filter("host <> '' and html <> ''").select("host", "html").mapInPandas(run, NODES)
    distinct = seen.groupBy("host", "node", "kind", "feature", "page").agg(F.max("cnt").alias("cnt"), F.first("above").alias("above"))
    features = distinct.groupBy("host", "node", "kind", "feature").agg(
        F.sum("cnt").alias("total"), F.sum(F.col("cnt") * F.log("cnt")).alias("weighted"), F.first("above", ignorenulls=True).alias("above")
    )
    features = materialise(features, "site-features")
    style = F.col("kind") == "style"
    nodes = features.groupBy("host", "node").agg(
        F.sum(F.when(style, F.col("total"))).alias("pages"),
        F.sum(F.when(style, F.col("total") * F.log("total"))).alias("style_weighted"),
        F.count(F.when(~style, 1)).alias("texts"),
        F.sum(F.when(~style, F.log("total") - F.col("weighted") / F.col("total"))).alias("text_entropy"),
        F.first("above", ignorenulls=True).alias("above"),
    )
    size = F.log("pages")
    presentation = (size - F.col("style_weighted") / F.col("pages")) / size
    content = 1 - F.col("text_entropy") / F.col("texts") / size
    own = F.when(F.col("pages") < 2, 1.0).when(F.col("texts") > 0, content).otherwise(presentation)
    nodes = nodes.withColumn("own", own)
    spread = nodes.select("host", "pages", "own", F.posexplode("above").alias("depth", "node"))
    weight = F.col("pages") * F.pow(F.lit(DECAY), F.col("depth"))
    return spread.groupBy("host", "node").agg(
        (F.sum(weight * F.col("own")) / F.sum(weight)).alias("importance"),
        F.max(F.when(F.col("depth") == 0, F.col("pages"))).alias("pages"),
    )


def main_text(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)`` of every page."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))
    given = pages.select("page_id", "url", host.alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    low = tree(given).filter((F.col("importance") < LEAST) & (F.col("pages") >= LEAST_PAGES))
    cuts = low.groupBy("host").agg(F.collect_list("node").alias("cut"))
    cuts = cuts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cuts = materialise(cuts, "site-cuts")  # its size is known then: Spark broadcasts it if it is small
    salted = given.withColumn("salt", F.pmod(F.hash("page_id"), F.lit(SALTS)))
    joined = salted.join(cuts, ["host", "salt"], "left").select("page_id", "url", "html", "cut")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cut = [frozenset(c) if c is not None else frozenset() for c in batch.cut]
            text = [extract(h, c) for h, c in zip(batch.html, cut)]
            yield pd.DataFrame({"page_id": batch.page_id, "url": batch.url, "text": text})

    out = joined.withColumn("page_id", F.col("page_id").cast("string"))
    return out.mapInPandas(run, "page_id string, url string, text string").select(
        F.col("page_id").cast(kinds["page_id"]).alias("page_id"), "url", "text"
    )
