"""Main text of web pages: the maximum-scoring run of words and tags.

A page is read as a line of tags and text runs. A run scores the weight of its place
for each word, a tag costs a little, and a named section (an advert, a menu, a form,
comments or the like) costs its words' weights up to a limit. One linear scan finds the
contiguous stretch with the highest sum, which is the article. Text inside it that
stands in a named section is left out, and no other.

The weights come from labelled pages: those whose own markup says where the article
is (``article`` or ``main``). Words are counted by place inside and outside of it over
all such pages; a place's weight is the log of the smoothed ratio. A place is the block's
tag, its share of linked words and its length in three steps each, and the kind of the
section; each labelled page is counted a second time without kinds, so that unnamed menus and
adverts are known by their shape. Places are pairs of fixed lists, so the table that reaches
every task is small whatever the input. Words in an article that the page itself marks have
the highest weight. A page that has no place with a positive weight is
scored by the weights of places never seen.

A section's kind comes from its tag, class, id or role, and holds for all below. Not so
for mere wrappers: an element around ``main``, or around an ``article`` where the page
has none outside of named sections, unless it lies in an article itself; and a form or
an element of a compound name (``has-sidebar``) that holds more than half of the words,
unless the page's article is marked elsewhere. Within an article a compound name counts only if
all its parts say a kind or a container (``comments-area``, not ``notice-board``), and a
menu named so has links. Text between two marked articles is left out, unless it scores more
than all of them.

Defined cases: null or empty html gives an empty text; a page without words gives an
empty text; broken or cut-off markup is read as far as it goes; repeated rows give
repeated results; other columns are kept unless they carry a result's name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.llm.common import read_table
from tierline.llm.word_ids import strings, text_batches

_TOKENS = re.compile(
    r"""<!--.*?(?:-->|\Z)
    | <(?P<raw>script|style|title|textarea)\b(?:[^>"']|"[^"]*"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)
    | <[!?][^>]*(?:>|\Z)
    | <(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9]*)(?P<attributes>(?:[^>"']|"[^"]*"|'[^']*')*+(?=>|\Z)|[^>]*)(?:>|\Z)
    | (?P<text>[^<]+|<)""",
    re.S | re.I | re.X,
)
_NAMING = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z]+")

VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
PLACES = {"p", "li", "td", "th", "dd", "dt", "blockquote", "pre", "figcaption", *HEADINGS}
ARTICLE = {"article", "main"}
#: Elements, and words in a class, id or role, that say a section is not the article.
KIND_OF_TAG = {"nav": "menu", "menu": "menu", "footer": "footer", "header": "header", "aside": "sidebar", "form": "form", "dialog": "notice"}
KIND_OF_TAG |= dict.fromkeys("noscript template iframe object svg select button".split(), "control")
KIND_WORDS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar pagination pager toc",
    "footer": "footer copyright legal colophon",
    "header": "header masthead topbar",
    "sidebar": "sidebar aside related recommended recommendations widget trending complementary",
    "notice": "notice cookie cookies consent gdpr alert popup modal banner disclaimer overlay paywall",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsense",
    "form": "form newsletter subscribe subscription signup login search",
    "comments": "comment comments disqus respond replies",
    "share": "share sharing social",
}
_KIND_BY_WORD = {w: k for k, ws in KIND_WORDS.items() for w in ws.split()}
CONTAINERS = set("area bar block box body btn button buttons col column container content entry field group holder icon icons inner inline item items link links list module outer panel post posts row section slot text title unit wrap wrapper left right top bottom main".split())
PRIOR_WORDS = 20.0
#: Log odds of a word's place before any count: in a named section, in a block mostly of links, elsewhere.
NAMED, LINKED, PLAIN = -2.0, -1.0, 1.0
LENGTHS = (5, 20)  # words of a block, where its length makes a step
LIMIT = 3.0
TAG_COST = -0.2
SECTION_LIMIT = -LIMIT  # what one named section costs at most, so that an advert doesn't end its article


class _Element:
    """An element. ``named`` is the kind that it would give its section, ``exact`` whether a whole name or its tag says so;
    ``words``, ``main`` and ``article`` tell what it holds. ``kind`` is known when the page has been read."""

    __slots__ = ("name", "parent", "named", "exact", "articles", "place", "link", "words", "linked", "main", "article", "kind")

    def __init__(self, name: str = "", parent: _Element | None = None, named: str = "", exact: bool = False):
        self.name, self.parent, self.named, self.exact, self.kind = name, parent, named, exact, ""
        self.articles = (parent.articles if parent else 0) + (name in ARTICLE)
        self.link = name == "a" or bool(parent and parent.link)
        if name in PLACES or not parent:
            self.place = name
        elif name in INLINE or name in ("html", "body", *ARTICLE):
            self.place = parent.place
        else:
            self.place = parent.place if parent.place in PLACES else "box"
        self.words = self.linked = 0
        self.main, self.article = name == "main", name == "article"


def _named(name: str, attributes: str, within: bool) -> tuple[str, bool]:
    """The kind that an element's tag or names say, and whether it's the tag or a whole name that says so. A form says it
    of its fields, and a name like ``has-sidebar`` may stand on what lies around one. ``within``: in an article."""
    kind, exact = KIND_OF_TAG.get(name, ""), name in KIND_OF_TAG and name != "form"
    for m in _NAMING.finditer(attributes) if attributes else ():
        names = (m[1] or m[2] or m[3] or "").lower()
        for one in names.split():
            words = _PARTS.findall(one)
            if not within or all(w in _KIND_BY_WORD or w in CONTAINERS for w in words):
                kind = kind or next((_KIND_BY_WORD[w] for w in words if w in _KIND_BY_WORD), "")
        exact = exact or any(word in _KIND_BY_WORD for word in names.split())
    return kind, exact


class _Open:
    """The elements of a page, and which are open; forgiving about what is never closed."""

    def __init__(self) -> None:
        self.top = _Element()
        self.all = [self.top]
        self._stack = [self.top]
        self._count: Counter[str] = Counter()

    @property
    def last(self) -> _Element:
        return self._stack[-1]

    def _pop_to(self, name: str) -> None:
        while True:
            top = self._stack.pop()
            self._count[top.name] -= 1
            if top.name == name:
                break

    def open(self, name: str, attributes: str) -> None:
        if name not in INLINE and name != "br" and self._count["p"]:
            self._pop_to("p")
        elif name == "li" and self.last.name == "li":
            self._pop_to("li")
        if name in VOID:
            return
        kind, exact = _named(name, attributes, bool(self.last.articles))
        if name in ("html", "body", "article", "main") or (kind == "header" and self.last.articles):
            kind = ""
        self._stack.append(_Element(name, self.last, kind, exact))
        self.all.append(self.last)
        self._count[name] += 1

    def close(self, name: str) -> None:
        if self._count[name]:
            self._pop_to(name)

    def see_kinds(self) -> None:
        """Sections by their names, but for mere wrappers of the page's content."""
        for e in reversed(self.all[1:]):
            up = e.parent
            up.words, up.linked, up.main, up.article = up.words + e.words, up.linked + e.linked, up.main or e.main, up.article or e.article
        half, marked = self.top.words / 2, self.top.main or self.top.article

        def resolve(held: bool) -> bool:
            """Whether an article or main lies in no named section. ``held``: an article makes its wrapper one, as main does."""
            found = False
            for e in self.all[1:]:
                holds = not e.articles and (e.main or (held and e.article))
                wraps = holds or (not e.exact and e.words > half and (e.articles or e.article or not marked))
                unlinked = e.articles and e.named == "menu" and e.name not in KIND_OF_TAG and not e.linked
                e.kind = e.parent.kind or ("" if wraps or unlinked else e.named)
                found = found or (e.name in ARTICLE and not e.kind)
            return found

        # Articles within a sidebar or the like are teasers if the page has another that is in none.
        if not resolve(False) and self.top.article:
            resolve(True)


def _step(value: float, steps: tuple[float, ...]) -> int:
    return sum(value >= x for x in steps)


def tokens(html: str) -> Iterator[tuple[str, str, str, str, bool]]:
    """``(text, tag, kind, shape, inside)``: text runs have tag "", tags have text "". inside: in a marked article.

    The shape is a block's tag, its share of linked words and its length.
    """
    around = _Open()
    line, block = [], [0, 0]  # a block's words and linked words
    for m in _TOKENS.finditer(html):
        if (text := m["text"]) is not None:
            e, n = around.last, len(text.split())
            linked = n if e.link else 0
            e.words, e.linked = e.words + n, e.linked + linked
            block[0] += n
            block[1] += linked
            line.append((text, "", e, block))
        elif m["name"]:
            name = m["name"].lower()
            if m["close"]:
                around.close(name)
            else:
                around.open(name, m["attributes"])
            if name not in INLINE and name != "br":
                block = [0, 0]
            line.append(("", name, around.last, block))
    around.see_kinds()
    for text, name, e, (words, linked) in line:
        if text:
            links = 2 if 2 * linked >= words > 0 else int(linked > 0)
            yield text, "", e.kind, f"{e.place}|{links}|{_step(words, LENGTHS)}", bool(e.articles and not e.kind)
        else:
            yield "", name, e.kind, "", False


def _counts(pages: list[str]) -> Counter:
    """Words by (place, inside) over those of ``pages`` that mark their article."""
    total: Counter = Counter()
    for html in pages:
        if not re.search(r"<(?:article|main)\b", html, re.I):
            continue
        for text, _, kind, shape, inside in tokens(html):
            if text and (n := len(text.split())):
                total[f"{kind}|{shape}", inside] += n
                total[f"|{shape}", inside] += n
    return total


def learn_weights(df: DataFrame, html_col: str = "html") -> dict[str, float]:
    """The weight of a word by place, from all labelled pages of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in text_batches(batches, "html"):
            total += _counts(strings(batch, "html"))
        if total:
            rows = [(p, n if i else 0, 0 if i else n) for (p, i), n in total.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)],
                names=["place", "inside", "outside"],
            )

    counted = df.select(F.col(html_col).cast("string").alias("html")).mapInArrow(run, "place string, inside bigint, outside bigint")
    # At most one row per section kind, block tag and steps.
    rows = counted.groupBy("place").agg(F.sum("inside"), F.sum("outside")).collect()
    return {place: _weight(place, inside, outside) for place, inside, outside in rows}


def _weight(place: str, inside: int, outside: int) -> float:
    kind, _, links, _ = place.split("|")
    odds = math.exp(NAMED if kind else LINKED if links == "2" else PLAIN)
    share = odds / (1 + odds)
    w = math.log((inside + PRIOR_WORDS * share) / (outside + PRIOR_WORDS * (1 - share)))
    return max(-LIMIT, min(LIMIT, w))


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """First and one past the last place of the contiguous stretch with the largest sum; (0, 0) if none is positive.

    Of equal sums the first stretch is taken, and of those the shortest.
    """
    best, where, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, where = total, (start, i + 1)
    return where


def _best(line: list[tuple[str, str, str, str, bool]], weights: dict[str, float]) -> tuple[list[float], int, int]:
    of = {p: weights.get(p, _weight(p, 0, 0)) for p in {f"{kind}|{shape}" for text, _, kind, shape, _ in line if text}}
    scores, left = [], SECTION_LIMIT
    for text, _, kind, shape, inside in line:
        score = len(text.split()) * (LIMIT if inside else of[f"{kind}|{shape}"]) if text else TAG_COST
        if not text and not kind:
            left = SECTION_LIMIT  # outside of any named section
        elif score < 0 and kind:
            score = max(score, left)
            left -= score
        scores.append(score)
    return scores, *best_stretch(scores)


def main_text(html: str, weights: dict[str, float]) -> str:
    line = list(tokens(html))
    scores, first, end = _best(line, weights)
    if first == end and weights:
        scores, first, end = _best(line, {})
    marked = [i for i in range(first, end) if line[i][4]]
    between = range(marked[0], marked[-1]) if marked else range(0)
    # What lies between marked articles, in no section of any kind.
    apart = {i for i in between if line[i][0] and not line[i][2] and not line[i][4]}
    if sum(scores[i] for i in apart) > sum(scores[i] for i in marked):
        apart = set()
    blocks, block = [], []
    for i in range(first, end):
        text, tag, kind, _, _ = line[i]
        if text:
            if not kind and i not in apart:  # whatever the weight of its place
                block.append(unescape(text))
        elif tag == "br":
            block.append(" ")
        elif tag not in INLINE:
            blocks.append(block)
            block = []
    blocks.append(block)
    return "\n".join(t for b in blocks if (t := " ".join("".join(b).split())))


def extract(df: DataFrame, html_col: str = "html", *, weights: dict[str, float] | None = None) -> DataFrame:
    """``df`` with ``text``, the main text of ``html_col``; weights are learned from ``df`` unless given."""
    weights = learn_weights(df, html_col) if weights is None else weights
    kept = [c for c in df.columns if c.lower() != "text"]
    given = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), F.col(html_col).cast("string").alias("html"))
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "html"):
            texts = pa.array([main_text(h, weights) for h in strings(batch, "html")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=schema.names)

    return given.mapInArrow(run, schema).toDF(*kept, "text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    weights = learn_weights(pages)
    # The html goes in as a column of its own; only the ids and the text come back.
    found = extract(pages.select("page_id", "url", F.col("html")), weights=weights)
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
