"""Main text of web pages from flat text blocks.

A page is cut into blocks at block-level tags. A block has its word count and link density, those of its neighbours,
and what the elements around it say of themselves (tag names, and words of class, id and role). A decision tree
fitted to a small labelled table says which blocks belong to the article. Pages never leave their row.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession

from skytally.llm.rows import binary

# Element names of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
RAW_TAGS = frozenset("script style textarea title noscript template iframe svg annotation annotation-xml xmp noembed noframes".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never part of an article.
OUTSIDE_TAGS = frozenset("nav footer aside form menu button select option input label dialog fieldset legend datalist".split())
INSIDE_TAGS = frozenset("article main".split())
#: Words of class, id or role attributes, as whole words or the start of one.
OUTSIDE_WORDS = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?\w*|advertis\w*|banner\w*|promo\w*|sponsor\w*|cookie\w*|consent\w*|gdpr\w*|notices?|popup\w*|modal\w*|"
    r"newsletter\w*|subscri\w*|signup\w*|login\w*|nav\w*|menu\w*|breadcrumb\w*|side-?bar\w*|aside|complementary|footer\w*|"
    r"foot|masthead\w*|site-?header\w*|page-?header\w*|top-?bar\w*|header|comments?\w*|disqus\w*|replies|respond|discussion|"
    r"share\w*|sharing|social\w*|related\w*|recommend\w*|widget\w*|copyright\w*|legal|disclaimer\w*|contentinfo|toolbar\w*|"
    r"search\w*|pagination|pager|tags|alert\w*|form)(?![a-z])"
)
#: Of these, what an ``article`` or ``main`` element itself may be.
NOT_ARTICLE = re.compile(r"(?:^|[^a-z])(?:comment|reply|ad|advert|promo|teaser|related|sidebar)(?![a-z])")
#: Topics of an article, which blog systems add to its classes.
TOPICS = re.compile(r"(?<![\w-])(?:category|tag)-[\w-]+")
#: Headers of articles, as opposed to those of pages.
ARTICLE_HEADER = re.compile(r"(?<![\w-])(?:entry|post|article)-?header(?![\w-])")
BESIDE = re.compile(r"\b(?:has|with|without|no)-[\w-]+")
INSIDE_WORDS = re.compile(
    r"(?:^|[^a-z])(?:articles?|article-?\w*|post|post-?(?:body|content|text)|entry|entry-?content|content|main|main-?content|"
    r"story\w*|body-?text|text|prose)(?![a-z])"
)
# Inside an article a word counts only as the name of a widget: the whole of a class, or together with words of layout.
#: What names there are made of, besides words for what lies outside.
LAYOUT = frozenset(
    "area article articles bar block body bottom box button buttons col container content count desktop entry group head heading "
    "icon icons img image inline inner item items label labels large left lg link links list main md media mobile outer page post "
    "posts primary right row secondary section site slot sm small stories story text thread title top unit wrap wrapper".split()
)
#: Words for what readers write: they count on every element, also in its id.
READERS = re.compile(r"comments?|commentlist|disqus|repl(?:y|ies)|respond")
#: Words for advertisements and calls to subscribe.
PAID = re.compile(r"ads?|adverts?\w*|advertis\w*|promo\w*|sponsor\w*|banner\w*|newsletter\w*|subscri\w*|cookie\w*|consent\w*|share\w*")
#: Elements that are parts of an article whatever their id, and whatever topic their class names.
PARTS_OF_TEXT = frozenset("section p h1 h2 h3 h4 h5 h6 figure figcaption blockquote pre table details".split())
#: Asides that belong to the article around them.
INSETS = re.compile(r"(?:^|[^a-z])(?:pull-?quotes?|quotes?|epigraph|side-?notes?|margin-?notes?|foot-?notes?|notes?|callout|tip|definition|example)(?![a-z])")
TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|\Z)",
    re.DOTALL,
)
LABEL = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.IGNORECASE)
#: Elements that a new block of the same kind ends, when their own end tag is left out.
CLOSED_BY = {"p": BLOCK_TAGS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option"}}


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    outside: int
    inside: int
    heading: int


class _Open(NamedTuple):
    tag: str
    outside: int
    inside: int


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, with character references decoded and white space turned into single spaces."""
    out: list[Block] = []
    stack: list[_Open] = []
    links = 0
    parts: list[tuple[str, int]] = []
    heading = 0

    def flush() -> None:
        nonlocal heading
        if parts:
            text = " ".join(html.unescape("".join(p for p, _ in parts)).split())
            if text:
                linked = sum(len(html.unescape(p).split()) for p, in_link in parts if in_link)
                top = stack[-1] if stack else _Open("", 0, 0)
                words = len(text.split(" "))
                out.append(Block(text, words, min(linked, words), top.outside, top.inside, heading))
            parts.clear()
        heading = 0

    at, end = 0, len(page)
    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            mark = end
        if mark > at:
            parts.append((page[at:mark], links > 0))
        if mark == end:
            break
        token = TOKEN.match(page, mark)
        if token is None:  # a bare "<" is text
            parts.append(("&lt;", links > 0))
            at = mark + 1
            continue
        at = token.end()
        if token.group(2) is None:
            continue
        closing, tag, attributes = token.group(1), token.group(2).lower(), token.group(3)
        if tag in RAW_TAGS and not closing:
            if not attributes.rstrip().endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
                at = stop.end() if stop else end
            continue
        if tag == "a":
            links = max(0, links - 1) if closing else 1
            continue
        if tag in ("br", "img"):
            parts.append((" ", False))
            continue
        above = stack[-1] if stack else _Open("", 0, 0)
        said, label = ("", "") if closing else _labels(attributes, tag)
        hidden = not closing and bool(HIDDEN.search(attributes))
        if tag not in BLOCK_TAGS and tag not in OUTSIDE_TAGS:
            # An inline element is part of the text around it, unless it says that it is something else.
            if not (any(o.tag == tag for o in stack) if closing else hidden or not above.inside and OUTSIDE_WORDS.search(said)):
                continue
        flush()
        if tag in BLOCK_TAGS:
            links = 0
        if closing:
            if any(o.tag == tag for o in stack):
                while stack.pop().tag != tag:
                    pass
            continue
        while stack and tag in CLOSED_BY.get(stack[-1].tag, ()):
            stack.pop()
        heading = int(tag in ("h1", "h2", "h3", "h4", "h5", "h6"))
        if tag in VOID_TAGS or attributes.rstrip().endswith("/"):
            continue
        above = stack[-1] if stack else _Open("", 0, 0)
        inside = int(above.inside or tag in INSIDE_TAGS or bool(INSIDE_WORDS.search(label)))
        if tag in INSIDE_TAGS:
            named = bool(NOT_ARTICLE.search(said))
        elif above.inside:
            named = _widget(attributes, tag)
        else:
            named = tag not in ("body", "html") and bool(OUTSIDE_WORDS.search(said))
        inset = tag == "aside" and above.inside and bool(INSETS.search(label))
        outside = int(
            above.outside
            or (tag in OUTSIDE_TAGS and not inset)
            or (tag == "header" and not above.inside and not ARTICLE_HEADER.search(label))
            or named
            or hidden
        )
        stack.append(_Open(tag, outside, inside))
    flush()
    return out


def _labels(attributes: str, tag: str) -> tuple[str, str]:
    """Words of the attributes that name an element, but for those that name what it lacks or lies beside.

    Of an article, the words of its topics are left out. The first text has no headers of articles, the second has.
    """
    said = " ".join(a or b or c for _, a, b, c in LABEL.findall(attributes)).lower() if attributes else ""
    said = BESIDE.sub(" ", said)
    bare = TOPICS.sub(" ", said)
    if bare != said and (tag in INSIDE_TAGS or INSIDE_WORDS.search(bare)):
        said = bare
    return ARTICLE_HEADER.sub(" ", said), said


def _widget(attributes: str, tag: str) -> bool:
    """Whether an element inside an article names itself as something that does not belong to it.

    A name counts as a whole: ``related-posts`` and ``social`` are widgets, ``related-work`` and ``social-history`` are topics.
    Topics of blog systems and headers are none. Of elements that are parts of a text only what readers write counts, and
    advertisements and the like by class.
    """
    for attribute, *values in LABEL.findall(attributes):
        kind = attribute.lower()
        said = ARTICLE_HEADER.sub(" ", TOPICS.sub(" ", BESIDE.sub(" ", "".join(values).lower())))
        for name in said.split() if kind in ("class", "id", "role") else ():
            words = [w for w in re.split("[-_]+", name) if w]
            known = [w for w in words if w != "header" and (OUTSIDE_WORDS.fullmatch(w) or READERS.fullmatch(w))]
            if not known or any(w not in known and w not in LAYOUT and w != "header" for w in words):
                continue
            if tag not in PARTS_OF_TEXT or any(READERS.fullmatch(w) for w in known):
                return True
            if kind == "class" and any(PAID.fullmatch(w) for w in known):
                return True
    return False


FEATURES = (
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
    "outside", "inside", "inside_page", "heading",
)


def features(page: list[Block]) -> list[tuple[float, ...]]:
    """One vector for each block; before the first and after the last block there are no words."""
    own = [(float(b.words), b.linked / b.words) for b in page]
    edge = (0.0, 0.0)
    any_inside = float(any(b.inside and not b.outside for b in page))
    return [
        (*own[i], *(own[i - 1] if i else edge), *(own[i + 1] if i + 1 < len(own) else edge),
         float(b.outside), float(b.inside), any_inside, float(b.heading))
        for i, b in enumerate(page)
    ]


# A branch is (feature, threshold, at most, above), a leaf the class.
Tree = tuple | float


def fit(spark: SparkSession, labelled: list[tuple[str, list[int]]], depth: int = 12) -> Tree:
    """Decision tree for pages whose blocks carry a label each: 1 in the article, 0 outside.

    The labelled table is small by intent: a person labels it. Its size does not follow the corpus.
    """
    rows = []
    for page, labels in labelled:
        found = blocks(page)
        if len(found) != len(labels):
            raise ValueError(f"{len(labels)} labels for {len(found)} blocks: {[b.text for b in found]}")
        rows += [(*x, float(y)) for x, y in zip(features(found), labels, strict=True)]
    table = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in (*FEATURES, "label")))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(table)
    model = DecisionTreeClassifier(maxDepth=depth, seed=1).fit(vectors)

    def read(node) -> Tree:
        if node.numDescendants() == 0:
            return node.prediction()
        split = node.split()
        return (split.featureIndex(), split.threshold(), read(node.leftChild()), read(node.rightChild()))

    return read(model._java_obj.rootNode())


def decide(tree: Tree, vector: tuple[float, ...]) -> bool:
    while isinstance(tree, tuple):
        feature, threshold, low, high = tree
        tree = low if vector[feature] <= threshold else high
    return tree > 0.5


def main_text(page: str, tree: Tree) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, x in zip(found, features(found), strict=True) if decide(tree, x))


def extract(pages: DataFrame, tree: Tree, html_col: str = "html") -> DataFrame:
    """``pages`` without its html, with ``text`` (the main text; empty if there is none) and ``n_chars`` (code points).

    Blocks are joined by ``\\n`` in page order. NULL or empty html gives an empty text. Columns named ``text`` or
    ``n_chars`` are replaced, other columns and repeated rows stay. An empty table gives an empty table.
    """
    rest = [c for c in pages.columns if c != html_col and c.lower() not in ("text", "n_chars")]
    ordered = pages.select(*rest, html_col)
    schema = ordered.select(*rest).schema
    names = [*rest, "text", "n_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.decode("utf-8", "replace"), tree) for x in binary(batch.column(len(rest)))]
            columns = [batch.column(i) for i in range(len(rest))]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return ordered.mapInArrow(run, schema.add("text", "string").add("n_chars", "long"))
