"""Main text of web pages as the maximum-scoring run of tokens.

A page is a sequence of tags and words.  Words score positive and tags negative; the run of
highest sum, found in one scan, is the content region.  The weights are log-odds learnt from
pages whose author marked the article (``<article>`` or ``<main>``): for a word by the kind of
element it stands in, for a tag by its name.  An element whose name, class, id or role says that
it is no part of an article (an advert or a form between paragraphs) scores as one tag, and what
is in it is left out of the text.  Class, id and role do not tell of an element that wraps the
content.

Learning is a Spark count over all pages; what reaches the driver is one row per tag name and
kind of element, both from fixed lists.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import columns, ship, slices

# Names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
BOILERPLATE = frozenset("nav header footer aside form menu dialog button select fieldset head".split())
ARTICLE = ("article", "main")
# Elements that hold a page's content whatever their class, id or role.
WHOLE = frozenset(["html", "body", *ARTICLE])
SPLITTING = frozenset(
    "p div article main section nav header footer aside form ul ol li dl dt dd table tr td th thead tbody h1 h2 h3 h4 h5 "
    "h6 blockquote pre figure figcaption address details summary hr body html head".split()
)
# Words in a class, id or role that mark an element as no part of the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo banner sidebar nav navbar navigation menu breadcrumb "
    "breadcrumbs header footer cookie cookies consent notice popup modal overlay newsletter subscribe signup login form "
    "comment comments reply replies disqus share sharing social related recommended widget toolbar pagination "
    "contentinfo complementary search alert".split()
)
# Of these, the words that mark an element within an article as advert, reader comments or a way elsewhere; the others also
# name parts of a text: an alert, a menu, a form of words.
INNER_MARKS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo sidebar nav navbar navigation breadcrumb breadcrumbs newsletter "
    "subscribe comment comments disqus share sharing social related recommended pagination".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What holds other blocks; within an article only such can be marked, never a paragraph, an item or words of a line.
CONTAINERS = frozenset("div section aside ul ol dl table figure details".split())
# Elements that a later sibling of the same kind, or the end of their parent, closes.
_CLOSED_BY_BLOCK = frozenset(["p"])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # A raw element that closes itself is empty, unless its own close tag comes before any other tag.
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>]*/>(?![^<]*</(?P=raw)\s*>)|[^>]*>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+", re.I)

# Log-odds are cut to these, so that no single tag outweighs a sentence; elements never seen take the first two.
WORD_WEIGHT, TAG_WEIGHT, WEAKEST_TAG, STRONGEST_TAG = 1.0, -1.0, -0.05, -3.0
INLINE_WEIGHT = -0.25
BOILER = "boilerplate"


def _kind(name: str, article: int) -> str:
    """``boilerplate`` or the element's name; the header of an article is part of it."""
    if name in BOILERPLATE and not (article and name == "header"):
        return BOILER
    return name if name in SPLITTING or name in INLINE else "other"


def _marked(name: str, rest: str, article: int) -> bool:
    """Whether class, id or role say that the element is no part of the article."""
    if not rest or name in WHOLE or name in HEADINGS or article and name not in CONTAINERS:
        return False
    marks = INNER_MARKS if article else MARKS
    return any(
        w.lower() in marks for found in _NAMED.finditer(rest) for w in _WORD.findall(found[1] or found[2] or found[3] or "")
    )


def tokens(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """(tag, text, element, article) in order: a tag name with its slash, or a text with tag ''.

    ``element`` is the kind of the closest block element around a text, ``boilerplate`` if any
    element around it is of that kind; ``article`` tells whether an article element is around it.

    An element marked by class, id or role is boilerplate unless it holds the page's largest
    article element or most of the page's words; outside a page's only article element it is so
    whatever its words.
    """
    # Name, kind and, of a marked element, its number.
    stack: list[tuple[str, str, int]] = []
    boiler = article = 0
    at = 0
    # By number (0: the page): the marked element around it, its words, whether an article is around it.
    parent, words, inside_article = [0], [0], [False]
    # Of every outermost article element: its words, the marked element around it.
    articles: list[list[int]] = []
    held: list[tuple[str, str, str, bool, int]] = []
    mark = 0

    def element() -> str:
        if boiler:
            return BOILER
        return next((kind for _, kind, _ in reversed(stack) if kind not in INLINE), "body")

    def drop() -> None:
        nonlocal boiler, article, mark
        name, kind, number = stack.pop()
        boiler -= kind == BOILER
        article -= name in ARTICLE
        if number:
            mark = parent[number]

    def add(tag: str, text: str, kind: str) -> None:
        held.append((tag, text, kind, article > 0, mark))
        if not tag and kind != BOILER:
            n = len(text.split())
            words[mark] += n
            if article:
                articles[-1][0] += n

    for found in _TOKEN.finditer(page):
        if found.start() > at:
            add("", page[at : found.start()], element())
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            add((found["raw"] or "!").lower(), "", BOILER)
            continue
        if found["close"]:
            if any(n == name for n, _, _ in stack):
                while stack[-1][0] != name:
                    drop()
                drop()
            add("/" + name, "", element())
            continue
        if name in SPLITTING:
            for closing in _CLOSED_BY_BLOCK | ({name} if name in ("li", "dt", "dd", "tr", "td", "th") else set()):
                inside = [n for n, _, _ in stack]
                if closing in inside and not {"table", "ul", "ol"} & set(inside[len(inside) - inside[::-1].index(closing) :]):
                    while stack[-1][0] != closing:
                        drop()
                    drop()
        rest = found["rest"]
        if name not in VOID and not rest.rstrip().endswith("/"):
            kind, number = _kind(name, article), 0
            if kind != BOILER and _marked(name, rest, article):
                number = len(parent)
                parent.append(mark)
                words.append(0)
                inside_article.append(article > 0)
                mark = number
            if name in ARTICLE and not article:
                articles.append([0, 0 if boiler else mark])
            stack.append((name, kind, number))
            boiler += kind == BOILER
            article += name in ARTICLE
        add(name, "", element())
    if at < len(page):
        add("", page[at:], element())

    for number in range(len(parent) - 1, 0, -1):
        words[parent[number]] += words[number]
    wraps = set()
    number = max(articles)[1] if articles else 0
    while number:
        wraps.add(number)
        number = parent[number]
    out = [False] * len(parent)
    for number in range(1, len(parent)):
        few = 2 * words[number] <= words[0] or len(articles) == 1 and articles[0][0] > 0 and not inside_article[number]
        out[number] = out[parent[number]] or number not in wraps and few
    for tag, text, kind, within, number in held:
        yield tag, text, BOILER if out[number] else kind, within


def learn(pages: DataFrame) -> dict[str, float]:
    """Weights of words by element (key ``w:element``) and of tags (key ``t:name``).

    Only pages with an article element teach.  Without such pages the weights are +1 and -1.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple[str, bool]] = Counter()
        for batch in batches:
            for _, texts in slices(batch, "html"):
                for page in texts:
                    own: Counter[tuple[str, bool]] = Counter()
                    for tag, text, element, article in tokens(page):
                        if element == BOILER:
                            continue
                        if not tag:
                            own["w:" + element, article] += len(text.split())
                        elif tag.strip("/") in SPLITTING | INLINE | VOID:
                            own["t:" + tag.strip("/"), article] += 1
                    if any(article for _, article in own):
                        held.update(own)
        rows = [(key, article, n) for (key, article), n in held.items()]
        yield pa.RecordBatch.from_pydict(
            {"key": pa.array([r[0] for r in rows], pa.string()), "article": pa.array([r[1] for r in rows], pa.bool_()), "n": pa.array([r[2] for r in rows], pa.int64())}
        )

    counted = columns(pages, html="string").mapInArrow(count, "key string, article boolean, n bigint")
    rows = counted.groupBy("key", "article").agg(F.sum("n").alias("n")).collect()
    seen: dict[str, list[int]] = {}
    for row in rows:
        seen.setdefault(row["key"], [0, 0])[int(row["article"])] = row["n"]
    weights = {}
    for key, (outside, inside) in seen.items():
        odds = math.log(inside + 1) - math.log(outside + 1)
        # Tags are negative whatever their odds; a word is so only in elements that articles do not hold.
        limits = (-WORD_WEIGHT, WORD_WEIGHT) if key[0] == "w" else (STRONGEST_TAG, WEAKEST_TAG)
        weights[key] = min(max(odds, limits[0]), limits[1])
    return weights


def score(token: tuple[str, str, str, bool], weights: dict[str, float]) -> float:
    """What a token adds to a run; an element of boilerplate costs its closing tag, whatever is in it."""
    tag, text, element, article = token
    if element == BOILER:
        return 0.0
    if tag:
        name = tag.strip("/")
        if article and name == "header":
            # What pages teach of this tag is of headers outside.
            return WEAKEST_TAG
        # An article's own tags that no page has taught are as weak as its others.
        unseen = WEAKEST_TAG if article else INLINE_WEIGHT if name in INLINE else TAG_WEIGHT
        return min(weights.get("t:" + name, unseen), 0.0)
    return weights.get("w:" + element, WORD_WEIGHT) * len(text.split())


def region(page: str, weights: dict[str, float]) -> list[tuple[str, str, str, bool]]:
    """The tokens of the best run, by one scan; empty if no run scores above 0."""
    run = list(tokens(page))
    best, best_span, total, start = 0.0, (0, 0), 0.0, 0
    for place, token in enumerate(run):
        total += score(token, weights)
        if total <= 0:
            total, start = 0.0, place + 1
        elif total > best:
            best, best_span = total, (start, place + 1)
    return run[slice(*best_span)]


def main_text(page: str, weights: dict[str, float]) -> str:
    """Blocks of the region joined by an empty line, white space within a block as one space."""
    blocks, held = [], []

    def close() -> None:
        words = entities.unescape("".join(held)).split()
        if words:
            blocks.append(" ".join(words))
        held.clear()

    for tag, text, element, _ in region(page, weights):
        name = tag.strip("/")
        if tag:
            if name in SPLITTING:
                close()
            elif name == "br":
                held.append(" ")
        elif element != BOILER:
            held.append(text)
    close()
    return "\n\n".join(blocks)


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row.

    Null html is an empty page and gives an empty text, as does a page without words; ids and
    urls pass as they are, repeated rows each give their row; an empty table gives none.  Other
    columns are not read.
    """
    weights = learn(pages) if weights is None else weights

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "html"):
                found = [main_text(page, weights) for page in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return columns(pages, page_id="bigint", url="string", html="string").mapInArrow(
        rows, "page_id bigint, url string, text string, n_chars bigint"
    )


ship(__name__)
