"""The main text of web pages: the contiguous region of a page with the highest score.

A page is a sequence of words and tags. Words score positive, tags negative; how much is learned
from pages whose article is marked by an <article> element, by how much more often each kind of
word and tag stands inside of it than outside. Words in links, and in elements that are by name
or class not part of an article, count against the region like tags. One scan finds the region
of the highest sum. Its text is taken without those elements; inside an <article> or <main> they
count nothing, so that a block of any size leaves what stands before and after it.
"""

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.frames import fresh, small_batches

# Fixed names of HTML elements.
RAW = "script style noscript template textarea iframe title svg select".split()
VOID = set("area base br col embed hr img input link meta source track wbr param".split())
BOILERPLATE = set("nav footer aside button menu dialog head".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em embed font i img ins kbd label mark"
    " object param q s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements of formulas: inline, and without a score, as a formula has more tags than words.
FORMULA = set(
    "math maction menclose merror mfenced mfrac mglyph mi mmultiscripts mn mo mover mpadded mphantom"
    " mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder"
    " munderover none semantics annotation annotation-xml".split()
)
#: Names in class, id and role that say an element is no part of an article. They stand alone
#: ("widget"), together ("nav-menu") or with words of FRAMES ("ad-box"). With any other word they
#: say nothing: "share-price", "has-sidebar", "widget-text-editor".
READERS = set("comment comments reply replies discussion disqus respond responses".split())
APART = READERS | set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo"
    " promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription"
    " signup share sharing social sidebar sidenav rail widget widgets related recommended"
    " recommendations menu nav navbar navigation navigationbar breadcrumb breadcrumbs footer"
    " contentinfo complementary login search toolbar pagination pager".split()
)
#: The same, but only outside of an article, which may have a header of its own.
HEADERS = set("header masthead topbar hero".split())
#: Names that no wrapper of an article has: they need not give way to it, see Page.
SURE = READERS | set("cookie cookies consent gdpr".split())
FRAMES = set(
    "area articles bar block bottom box button buttons center col column container cta desktop div"
    " fixed floating follow form global google gpt group holder icon icons inline inner item items js"
    " leaderboard left link links list main media mobile module mpu outer panel posts primary prompt"
    " rectangle region right row secondary site slot sticky stories tools top unit wrap wrapper zone".split()
)
#: Frames whose header is their title.
OWNERS = set("article entry page post section story".split())
ARTICLES = {"article", "main"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
SIGN = re.compile(r"[a-z]+")
SIGNS = APART | HEADERS
NAMING = SIGNS | FRAMES | OWNERS

#: Smallest loss of a tag, the losses of an inline tag and of any other that are seen as often
#: inside of articles as outside, and how much less or more a tag may lose for being seen on one
#: side; a word gains 1.
LEAST, INLINE_TAG, TAG, SPREAD = 0.05, 0.2, 1.0, 3.0
#: Seen on either side of an article before anything is counted, as a share of all that is: what
#: keeps odds from being extreme where few pages, or pages all alike, are labelled.
PRIOR = 0.002
#: Kinds of words.
WORD, LINKED, OUTSIDE = "word", "linked word", "word apart"
WORDS = (WORD, LINKED, OUTSIDE)


class Page:
    """The tokens of a page in order: kind, number of them, text, block and whether in an article.

    An element that by name, or as a form or header, would stand apart does not if it holds most of
    the plain words of the page: those not in links nor in BOILERPLATE. It still stands apart if
    words beside it say what the article is: those of the only <article>, or of <main> if there is
    no <article>; for an element of a SURE name, those of any.
    """

    def __init__(self, source: str):
        self._read(source, set())
        if wide := self._wide():
            self._read(source, wide)

    def _wide(self) -> set[int]:
        """The numbers of the elements that hold too much to stand apart."""
        while self.named:
            self._settle(False)
        one = 2 if self.articles == 1 else 1 if self.articles == 0 else None
        return {
            number
            for number, held, sure, inner in self.held
            if 2 * held[0] > self.plain[0]
            and not (sure and self.plain[1] > held[1])
            and not (one and not inner[one - 1] and self.plain[one] > held[one])
        }

    def _settle(self, closed: bool) -> None:
        """Ends the last named element. If it was never closed, it ends before an article in it."""
        _, number, before, articles, sure, inner = self.named.pop()
        after = self.begun[articles] if not closed and len(self.begun) > articles else self.plain
        held = [now - then for now, then in zip(after, before)]
        self.held.append((number, held, sure, inner))

    def _read(self, source: str, wide: set[int]) -> None:
        self.wide = wide
        self.number = 0  # of the element
        #: Plain words so far: all, in articles and main elements, in articles.
        self.plain = (0, 0, 0)
        self.within = self.boilerplate = 0  # how deep the article or main element, and BOILERPLATE is
        self.begun: list[tuple[int, int, int]] = []  # plain where articles and mains begin
        #: Open elements that may stand apart: depth, number, plain and articles before, whether
        #: the name is sure, and whether they are in a main element or article, and in an article.
        self.named: list[tuple] = []
        self.held: list[tuple] = []
        self.tokens: list[tuple[str, int, str, int, bool]] = []
        self.articles = 0
        self.block = 0
        self.open: list[str] = []
        self.apart = 0  # how deep the element is that stands apart; 0 if none does
        self.readers = False  # whether it holds readers' comments
        self.article = 0  # how deep the article is
        self.links = 0
        at = 0
        for found in TOKEN.finditer(source):
            if found.start() > at:
                self._text(source[at : found.start()])
            at = found.end()
            if found["name"]:
                name = found["name"].lower()
                if found["end"]:
                    self._close(name)
                else:
                    self._open(name, found["attributes"])
            elif found["raw"] and found["raw"].lower() != "svg":
                self.block += 1
        if at < len(source):
            self._text(source[at:])

    def _text(self, text: str) -> None:
        text = html.unescape(text)
        n = len(text.split())
        kind = OUTSIDE if self.apart else LINKED if self.links else WORD
        if not self.links and not self.boilerplate:
            some, marked, told = self.plain
            self.plain = (some + n, marked + n * bool(self.within), told + n * bool(self.article))
        if not (self.apart and self.within):
            self.tokens.append((kind, n, text, self.block, bool(self.article)))

    def _tag(self, name: str, apart: bool) -> None:
        """Tags of elements that stand apart are none of the page's tokens."""
        if name.removeprefix("/") in FORMULA:
            return
        if name.removeprefix("/") not in INLINE:
            self.block += 1
        if apart:
            return
        if name == "br":
            self.tokens.append((WORD, 0, " ", self.block, bool(self.article)))
        elif name not in ARTICLES:
            self.tokens.append((f"<{name}>", 1, "", self.block, bool(self.article)))

    def _open(self, name: str, attributes: str) -> None:
        if name not in VOID and not (name in FORMULA and attributes.endswith("/")):
            self.open.append(name)
            depth = len(self.open)
            self.number += 1
            signs = _signs(attributes) if attributes else set()
            apart = bool(signs & APART) or name == "form"
            if not self.article:
                apart = apart or name == "header" or bool(signs & HEADERS)
            if name in ARTICLES or name in ("html", "body"):
                apart = bool(signs & READERS) and name not in ("html", "body")
            if apart and name not in BOILERPLATE:
                sure = bool(signs & SURE)
                inner = (bool(self.within), bool(self.article))
                self.named.append((depth, self.number, self.plain, len(self.begun), sure, inner))
                apart = self.number not in self.wide
            apart = apart or name in BOILERPLATE
            if name in ARTICLES and not apart and not self.readers:
                # What is left open before an article ends there.
                self.apart = self.boilerplate = 0
                self.begun.append(self.plain)
                self.within = self.within or depth
            if name in BOILERPLATE and not self.boilerplate:
                self.boilerplate = depth
            if apart and not self.apart:
                self.apart, self.readers = depth, bool(signs & READERS)
            if name == "article" and not self.apart and not self.article:
                self.article = depth
                self.articles += 1
            if name == "a":
                self.links += 1
        self._tag(name, bool(self.apart))

    def _close(self, name: str) -> None:
        apart = bool(self.apart)
        if name in self.open:
            while True:
                depth, last = len(self.open), self.open.pop()
                if last == "a":
                    self.links -= 1
                if depth == self.apart:
                    self.apart, self.readers = 0, False
                if depth == self.boilerplate:
                    self.boilerplate = 0
                if self.named and self.named[-1][0] == depth:
                    self._settle(last == name)
                if last == name:
                    break
        self._tag(f"/{name}", apart)
        if self.article > len(self.open):
            self.article = 0
        if self.within > len(self.open):
            self.within = 0


def _signs(attributes: str) -> set[str]:
    signs = set()
    for found in NAMED.findall(attributes):
        for name in "".join(found).lower().split():
            parts = set(SIGN.findall(name))
            if (here := parts & SIGNS) and parts <= NAMING:
                signs |= here - HEADERS if parts & OWNERS else here
    return signs


def counted(source: str) -> Counter:
    """How often each kind stands inside and outside the article: {(kind, inside): n}.

    Empty if the page does not have exactly one article.
    """
    page, counts = Page(source), Counter()
    if page.articles == 1:
        for kind, n, _, _, inside in page.tokens:
            counts[kind if kind in WORDS or kind.strip("</>") in KNOWN else OTHER, inside] += n
    return counts


#: Tags that have a weight of their own.
KNOWN = INLINE | VOID | BOILERPLATE | set(
    "p div section header h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tfoot tr td th body"
    " html form blockquote pre figure figcaption address details summary caption center fieldset".split()
)
OTHER = "<other>"


def weights_of(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """The score of every kind, from how often it is seen inside and outside of articles.

    Plain words gain 1. A tag loses TAG or INLINE_TAG, and up to SPREAD more or less by the
    logarithm of how much likelier it is outside, but LEAST at least; words in links or apart
    lose like tags. Both sides are taken to have seen PRIOR of all before. Tags never seen lose
    what tags do: a menu of more tags than words counts against the region, whatever its name.
    """
    inside, outside = (sum(n for (_, there), n in counts.items() if there == side) for side in (True, False))
    found = {WORD: 1.0, OTHER: -TAG, LINKED: -TAG, OUTSIDE: -TAG}
    for name in KNOWN - ARTICLES:
        loss = -INLINE_TAG if name in INLINE else -TAG
        found |= {f"<{name}>": loss, f"</{name}>": loss}
    if not inside or not outside:
        return found
    for kind in {kind for kind, _ in counts} - {WORD}:
        here = counts.get((kind, True), 0) / inside + PRIOR
        there = counts.get((kind, False), 0) / outside + PRIOR
        odds = max(-SPREAD, min(SPREAD, math.log(there / here)))
        found[kind] = -max(LEAST, odds - found.get(kind, -TAG))
    return found


def main_text(source: str, weights: dict[str, float]) -> str:
    """The text of the highest scoring region: blocks of single-spaced words, two line ends
    between them. Of equal regions the first and longest.

    Where a page has one article, and most of its plain words in it, words beside it count like
    those apart, and tags within it lose LEAST.
    """
    page = Page(source)
    told = page.articles == 1 and 2 * page.plain[2] > page.plain[0]
    best = total = 0.0
    first = start = end = 0
    for i, (kind, n, _, _, inside) in enumerate(page.tokens):
        if total < 0:
            total, first = 0.0, i
        weight = weights.get(kind, weights[OTHER])
        if told and kind == WORD and not inside:
            weight = weights[OUTSIDE]
        elif told and inside and kind not in WORDS:
            weight = -LEAST
        total += n * weight
        if total >= best and total > 0:
            best, start, end = total, first, i + 1
    blocks: dict[int, list[str]] = {}
    for kind, _, text, block, _ in page.tokens[start:end]:
        if kind != OUTSIDE and text:
            blocks.setdefault(block, []).append(text)
    joined = (" ".join("".join(texts).split()) for texts in blocks.values())
    return "\n\n".join(text for text in joined if text)


def learn(pages: DataFrame) -> dict[str, float]:
    """Weights from all pages (html) that have exactly one article. Kinds are few, whatever the
    pages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in small_batches(batches, "html"):
            for source in batch.column("html").to_pylist():
                if source:
                    total.update(counted(source))
        rows = [{"kind": k, "inside": inside, "n": n} for (k, inside), n in total.items()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows)

    counts = pages.select("html").mapInArrow(count, "kind string, inside boolean, n long")
    rows = counts.groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect()
    return weights_of({(row["kind"], row["inside"]): row["n"] for row in rows})


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Adds text, the main text of html, to pages (html and any other columns).

    A column called text is replaced. weights: learned from the pages themselves if not given.
    A null, empty or blank html has an empty text, as has a page without words. Character
    references are decoded. Nothing is cut off, however long a page is. No rows, no result.
    """
    weights = weights or learn(pages)
    plain = pages.drop("text")
    source = fresh(plain, "extracted_html")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, source):
            texts = [main_text(page or "", weights) for page in batch.column(source).to_pylist()]
            yield batch.drop_columns([source]).append_column("text", pa.array(texts, pa.string()))

    sent = plain.withColumn(source, F.col("html"))
    return sent.mapInArrow(run, ", ".join([*fields, "text string"]))
