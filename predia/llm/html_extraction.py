"""HTML extraction: the article of a page, as flat text blocks that a decision tree keeps or drops.

A page is cut into flat blocks: the text between two tags that start or end a block, white space made single, character
references decoded. A block is described by its words, the share of them inside links, the same two numbers of the block
before and after it, whether it is a heading, and what its enclosing elements are named: how many are named as a menu,
notice, advert, comment or the like, and whether it lies inside an article, outside of one, or on a page without any.
A decision tree, fitted on the labelled table below, says which blocks are the article. Pages do not depend on each
other, so they are one pass without a shuffle; the tree is the only thing sent to tasks.

Defined results: a null or empty page, and one without article, gives empty text; text within scripts, styles, comments
of the markup and controls of forms is never a block; a page that breaks off gives the blocks up to there, a tag that
breaks off is no text; `<` before anything but a tag is text; a line break element is white space of its block; very
long pages are read whole; repeated rows and null ids are rows like others; no pages give no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Elements as the HTML standard names them.
BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section summary table tbody td tfoot th thead title tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = set("""audio button canvas datalist head iframe noembed noframes noscript object script select style svg
    template textarea title video""".split())
RAW = set("iframe noembed noframes script style textarea title".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

# Names that mark an element, as an element, a class, an id or a role.
CONTENT = set("article content entry main post story".split())
CONTENT_PART = CONTENT | {"body", "text"}
MARGIN = set("""ad ads adv advert advertisement advertising adsense aside banner billboard breadcrumb breadcrumbs
    captcha comment commentlist comments consent contentinfo cookie cookies copyright disclaimer
    dialog disqus feedback footer form gdpr legal login masthead menu modal nav navbar navigation newsletter notice
    notification outbrain pager pagination paywall popular popup privacy promo promoted promotion recommend
    recommendations recommended related replies reply respond search share sharing sidebar signup skip social sponsor
    sponsored subscribe subscription taboola tags toolbar topbar tracking trending widget widgets""".split())
NOT_A_MARK = set("category has is no not tag tagged topic type with without".split())

_TAG = re.compile(
    r"""<(?:!--(?:-?>|.*?--!?>|.*)|(?:[!?]|/(?![A-Za-z]))[^>]*+(?:>|\Z)"""
    r"""|(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+)(>|\Z))""", re.S)
_NAMED = re.compile(r"""\b(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}

FEATURES = ("margin", "place", "words", "linked", "words_before", "linked_before", "words_after", "linked_after",
            "heading")


def marks(name: str, attributes: str = "", inside: bool = False) -> tuple[int, int]:
    """Whether an element is named as margin, and as the article: 0 or 1 each.

    ``with-sidebar`` names what an element has, not what it is; html and body name the page. A header ``inside`` an
    article is the article's own.
    """
    if name in ("html", "body"):
        return 0, 0
    article = name in ("article", "main")
    content, margin = int(article), int(name in MARGIN or name == "header" and not inside)
    for _, *values in _NAMED.findall(attributes) if "=" in attributes else ():
        for value in "".join(values).lower().split():
            words = [w for w in re.split(r"[-_:]+", value) if w]
            if not words or words[0] in NOT_A_MARK:
                continue
            margin |= any(w in MARGIN for w in (words[:1] if article else words))
            margin |= "header" in words and not inside and CONTENT.isdisjoint(words)
            content |= CONTENT_PART.issuperset(words) and not CONTENT.isdisjoint(words)
    return int(margin), int(content and not margin)


class _Open:
    """The open elements of a page and what they are named as."""

    def __init__(self):
        self.stack: list[tuple[str, int, int, int]] = []
        self.names: Counter = Counter()

    def top(self) -> tuple[int, int, int]:
        return self.stack[-1][1:] if self.stack else (0, 0, 0)

    def push(self, name: str, margin: int, content: int) -> None:
        m, c, hidden = self.top()
        if name in ("article", "main"):  # some pages are one form as a whole
            m -= self.names["form"]
        self.stack.append((name, m + margin, c + content, hidden + (name in NO_TEXT)))
        self.names[name] += 1

    def pop(self, name: str) -> None:
        while self.names[name]:
            last = self.stack.pop()[0]
            self.names[last] -= 1
            if last == name:
                return


def blocks_of(page: str | None) -> list[dict]:
    """The flat blocks of a page in order: text, words, linked (their share), heading, margin, content."""
    page, found, pieces = page or "", [], []
    opened, heading, linked_now, at = _Open(), 0, False, 0

    def close() -> None:
        nonlocal pieces
        parts = [(html.unescape(part), link) for part, link in pieces]
        joined = " ".join("".join(part for part, _ in parts).split())
        if joined:
            words = joined.count(" ") + 1
            linked = sum(len(part.split()) for part, link in parts if link)
            margin, content, _ = opened.top()
            found.append({"text": joined, "words": words, "linked": min(1.0, linked / words), "heading": heading,
                          "margin": margin, "content": content})
        pieces = []

    def text(part: str) -> None:
        if part and not opened.top()[2]:
            pieces.append((part, linked_now))

    while True:
        tag = _TAG.search(page, at)
        if tag is None:
            text(page[at:])
            break
        text(page[at:tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            close()
            if opened.names["p"] and not tag[1]:
                opened.pop("p")
        if name == "br":
            text(" ")
        elif name == "a":
            linked_now = not tag[1] and "href" in tag[3].lower()
        elif name in HEADINGS:
            heading = 0 if tag[1] else 1
        if tag[1]:
            opened.pop(name)
        elif name not in VOID and tag[4]:
            opened.push(name, *marks(name, tag[3], opened.top()[1] > 0))
            if name in RAW:
                end = _ENDS[name].search(page, at)
                at = end.start() if end else len(page)
    close()
    return found


def features_of(blocks: list[dict]) -> list[tuple]:
    """The features of each block, in the order of FEATURES; beyond the ends of a page there is an empty block."""
    has_article = any(b["content"] and not b["margin"] for b in blocks)
    sizes = [(0, 0.0), *((b["words"], b["linked"]) for b in blocks), (0, 0.0)]
    return [
        (b["margin"], (1 if b["content"] else -1) if has_article else 0, *sizes[i + 1], *sizes[i], *sizes[i + 2],
         b["heading"])
        for i, b in enumerate(blocks)
    ]


# The labelled table: the blocks of small pages, one row a block. A row has the elements that enclose the block (with
# a class after a dot), its words, how many of them are links, and 1 where it belongs to the article. Labelled by hand.
LABELLED = {
    "news": [
        ("header", 4, 4, 0), ("nav/li", 1, 1, 0), ("nav/li", 2, 2, 0), ("nav/li", 1, 1, 0), ("div.ad", 9, 0, 0),
        ("article/h1", 8, 0, 1), ("article/p", 64, 0, 1), ("article/p", 3, 0, 1), ("article/p", 41, 2, 1),
        ("article/h2", 2, 0, 1), ("article/p", 1, 0, 1), ("article/aside", 22, 9, 0), ("article/p", 87, 0, 1),
        ("article/p", 6, 6, 1), ("div.related/li", 7, 7, 0), ("div.related/li", 9, 9, 0), ("footer", 12, 0, 0)],
    "blog with comments": [
        ("nav.menu/li", 1, 1, 0), ("nav.menu/li", 1, 1, 0), ("main/h1", 5, 0, 1), ("main/p", 33, 0, 1),
        ("main/div.share", 4, 4, 0), ("main/p", 120, 3, 1), ("main/li", 4, 0, 1), ("main/li", 2, 0, 1),
        ("main/li", 5, 5, 1), ("div.comments/h2", 2, 0, 0), ("div.comments/article.comment", 45, 0, 0),
        ("div.comments/p", 70, 0, 0), ("div.comments/p", 2, 0, 0), ("div.comments/form", 3, 0, 0),
        ("aside.sidebar/p", 30, 0, 0), ("aside.sidebar/li", 3, 3, 0), ("footer/p", 25, 2, 0)],
    "one short paragraph": [
        ("nav/li", 1, 1, 0), ("div.ad", 14, 0, 0), ("article/h1", 1, 0, 1), ("article/p", 1, 0, 1), ("footer", 16, 0, 0)],
    "notice before the article": [
        ("div.cookie-notice/p", 38, 3, 0), ("div.banner", 11, 0, 0), ("div", 6, 0, 0), ("article/h1", 10, 0, 1),
        ("article/p", 52, 0, 1), ("article/blockquote", 18, 0, 1), ("article/td", 2, 0, 1), ("article/p", 15, 15, 1),
        ("div", 20, 0, 0), ("p", 31, 0, 0), ("footer", 8, 1, 0)],
    "long margin": [
        ("header/p", 24, 0, 0), ("header/li", 2, 2, 0), ("aside/p", 90, 0, 0), ("main/h1", 6, 0, 1),
        ("main/p", 12, 0, 1), ("main/p", 4, 0, 1), ("div.newsletter/p", 44, 0, 0), ("footer/p", 130, 0, 0)],
    "no article element": [
        ("div/a", 2, 2, 0), ("div/a", 1, 1, 0), ("div/a", 3, 3, 0), ("div/h1", 7, 0, 1), ("div/p", 58, 0, 1),
        ("div/p", 9, 0, 1), ("div/p", 77, 14, 1), ("div.sidebar/p", 35, 0, 0), ("div/p", 49, 5, 1),
        ("div/p", 20, 6, 1), ("div/p", 30, 0, 1), ("div/li", 4, 4, 0), ("div/li", 5, 5, 0), ("div/p", 4, 0, 0)],
    "plain page": [
        ("td/a", 1, 1, 0), ("td/a", 2, 2, 0), ("h1", 4, 0, 1), ("p", 95, 1, 1), ("p", 40, 0, 1), ("p", 11, 0, 1),
        ("h2", 3, 0, 1), ("p", 66, 9, 1), ("p", 18, 2, 1), ("td/a", 2, 2, 0), ("td/a", 2, 2, 0),
        ("div.footer", 21, 0, 0)],
    "plain list of links": [
        ("li", 3, 3, 0), ("li", 6, 6, 0), ("li", 4, 4, 0), ("li", 12, 12, 0), ("li", 2, 2, 0), ("p", 3, 1, 0)],
    "plain text": [("p", 28, 0, 1), ("p", 17, 0, 1), ("div", 36, 0, 1), ("p", 14, 0, 1)],
    "breaks off in a short paragraph": [
        ("nav/li", 1, 1, 0), ("article/h1", 3, 0, 1), ("article/p", 2, 0, 1), ("article/p", 1, 0, 1)],
    "breaks off in a link": [
        ("div.ad", 8, 0, 0), ("main/h1", 9, 0, 1), ("main/p", 25, 0, 1), ("main/p", 4, 4, 1)],
    "breaks off after a link": [
        ("nav/li", 1, 1, 0), ("article/h1", 6, 0, 1), ("article/p", 48, 3, 1), ("article/p", 5, 5, 1),
        ("article/p", 3, 0, 1)],
    "breaks off after a paragraph with links": [
        ("nav/li", 1, 1, 0), ("article/h1", 6, 0, 1), ("article/p", 48, 3, 1), ("article/p", 26, 0, 1)],
    "plain, ends after a paragraph with links": [
        ("a", 1, 1, 0), ("h1", 5, 0, 1), ("p", 39, 0, 1), ("p", 22, 3, 1), ("p", 15, 0, 1)],
    "ends with a remark": [("nav/li", 1, 1, 0), ("article/p", 19, 0, 1), ("article/p", 2, 0, 1), ("div", 3, 0, 0)],
    "short and plain": [("li", 1, 1, 0), ("li", 1, 1, 0), ("h1", 2, 0, 1), ("p", 7, 0, 1), ("p", 13, 0, 1)],
}


def labelled_blocks(spark: SparkSession) -> DataFrame:
    """The labelled table with the features that a page's blocks get: page, features array<double>, label double."""
    rows = []
    for page, table in LABELLED.items():
        blocks = []
        for path, words, links, _ in table:
            margin = content = 0
            for step in path.split("/"):
                name, _, mark = step.partition(".")
                m, c = marks(name, f' class="{mark}"' if mark else "", content > 0)
                margin, content = margin + m, content + c
            blocks.append({"words": words, "linked": links / words, "heading": int(name in HEADINGS),
                           "margin": margin, "content": content})
        rows += [(page, [float(x) for x in f], float(row[3])) for f, row in zip(features_of(blocks), table)]
    return spark.createDataFrame(rows, "page string, features array<double>, label double")


def fit_tree(spark: SparkSession, depth: int = 6) -> tuple | float:
    """The tree fitted on the labelled table: a label, or (feature, threshold, tree up to it, tree beyond it)."""
    table = labelled_blocks(spark).select(array_to_vector("features").alias("features"), "label").coalesce(1)
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=128, minInstancesPerNode=1, seed=1).fit(table)

    def read(node) -> tuple | float:
        if node.subtreeDepth() == 0:
            return node.prediction()
        split = node.split()
        return split.featureIndex(), split.threshold(), read(node.leftChild()), read(node.rightChild())

    return read(model._java_obj.rootNode())


def decide(tree: tuple | float, features: tuple) -> bool:
    while not isinstance(tree, float):
        feature, threshold, up_to, beyond = tree
        tree = up_to if features[feature] <= threshold else beyond
    return tree > 0.5


BLOCK_ROWS = ("page_id long, url string, position long, text string, margin long, place long, words long, "
              "linked double, words_before long, linked_before double, words_after long, linked_after double, "
              "heading long, kept boolean")


def page_blocks(pages: DataFrame, tree: tuple | float | None = None) -> DataFrame:
    """Every block of every page, in page order, with its features and whether it is kept."""
    tree = fit_tree(pages.sparkSession) if tree is None else tree

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page_id, url, page in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html"))):
                blocks = blocks_of(page)
                features = features_of(blocks)
                if blocks:
                    own = [[page_id] * len(blocks), [url] * len(blocks), list(range(len(blocks))),
                           [b["text"] for b in blocks], *map(list, zip(*features)), [decide(tree, f) for f in features]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(values, kind) for values, kind in zip(own, schema.types)], schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("position", pa.int64()), ("text", pa.string()),
                        *((name, pa.float64() if name.startswith("linked") else pa.int64()) for name in FEATURES),
                        ("kept", pa.bool_())])
    return _given(pages).mapInArrow(cut, BLOCK_ROWS)


def extract(pages: DataFrame, tree: tuple | float | None = None) -> DataFrame:
    """page_id, url, text: the kept blocks of each page, one a line; n_chars: its code points."""
    tree = fit_tree(pages.sparkSession) if tree is None else tree

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = []
                for page in part["html"]:
                    blocks = blocks_of(page.as_py())
                    texts.append("\n".join(
                        b["text"] for b, f in zip(blocks, features_of(blocks)) if decide(tree, f)))
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return _given(pages).mapInArrow(read, "page_id long, url string, text string, n_chars long")


def _given(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
