"""Main-text extraction by a maximum-scoring subsequence.

A page is read as a sequence of blocks of words and tags.  The words of a block score
the log-odds of standing in the main text, given what the block looks like: the tag
around it, its length, whether its words are links, whether it ends as a sentence
does, and what the mark-up around it says (navigation, header, footer, sidebar, form,
notices, adverts, reader comments, hidden parts, by tag, role, class or id).  Tags
score negative, the more so the more often they stand outside.  All these weights are
learned from labelled pages (a page with the lines of its text), starting from a
prior.  One linear scan finds the contiguous region of highest total score; nothing
but scripts, styles and the like is cut beforehand.

An element whose mark-up says that it is no article text is scanned by itself: its
own best region counts for it if that outweighs the element's tag, and otherwise it
is stepped over at the cost of that tag.  So a wrapper that only hints at a sidebar is
read (its words score), and a comment section inside an article is not, by one rule
for any size.  The headings of a header inside an article are not held against it.

Blocks end at block-level tags; white space inside a block becomes one space and
blocks are joined by two newlines.  Character references are decoded.

Defined results: NULL or empty html, and pages without a block that scores above
zero, give the empty text; of regions with equal score the first, and of these the
longest, is taken; unclosed comments, scripts and elements end with the page (an
element also ends where the article or body begins or ends); repeated pages give the
same text; without labelled pages the weights are the prior's.
"""

from __future__ import annotations

import html as entities
import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, pieces, table

MAX_LABELLED = 512  # labelled pages that the weights are fitted on, taken by hash
SMOOTH = 1.0
PRIOR_WORDS = 20.0  # words that a prior log-odds counts for
MOST, LEAST = 2.0, -4.0  # a feature's log-odds stay within these

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>", re.S | re.I)
ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORDS_OF_NAME = re.compile(r"[a-z]+")

BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
                       "h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTER_TAGS = frozenset("html body main article".split())
EXCLUDED_TAGS = frozenset("nav header footer aside form button select menu dialog head object canvas".split())
DOUBTFUL_ROLES = frozenset("form banner complementary".split())
DOUBTFUL_TAGS = frozenset("header aside form object dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
EXCLUDED_NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
                           "sidebar footer header masthead breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal overlay "
                           "newsletter subscribe subscription paywall share sharing social related recommended comment comments commentlist disqus "
                           "reply replies respond discussion widget login signup search pagination pager copyright toolbar skip".split())
EXCLUDED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# what a fit starts from: log-odds of a word's features, pseudo-counts (inside, outside) of a tag
BLOCK_PRIOR = {"p": 2.0, "blockquote": 2.0, "li": 2.0, "dd": 2.0, "pre": 2.0, "article": 2.0, "main": 2.0, "": 2.0, "heading": 2.0, "figcaption": 1.0, "td": 0.5,
               "body": 2.0, "option": -2.0, "legend": -2.0}
BLOCK_OTHER = -1.0  # a block that stands in a div, say
LENGTH_PRIOR = {2: -0.3, 5: -0.3, 10: -0.3, 20: 0.7, math.inf: 1.5}  # by the words of a block, up to
LINK_PRIOR = {True: -3.0, False: 0.0}
SENTENCE_PRIOR = {True: 0.7, False: 0.0}
TAG_PRIOR = {"excluded": (1.0, 4.0), "p": (4.0, 1.0), "br": (2.0, 1.0), "b": (2.0, 1.0), "i": (2.0, 1.0), "a": (1.0, 2.0), "li": (2.0, 2.0), "div": (1.0, 2.0), "article": (1.0, 2.0)} | {h: (9.0, 1.0) for h in ("h1", "h2", "h3", "h4", "h5", "h6")}
OTHER = (1.0, 2.0)
SENTENCE_ENDS = tuple(".!?\u2026\u3002\uff01\uff1f\u0964\"'\u201d\u00bb")


SURE, DOUBTFUL, HEADER, ASIDE = "sure", "doubtful", "header", "aside"
# what an element's mark-up takes from each of its words
HINTS = {SURE: -9.0, HEADER: -7.0, ASIDE: -7.0, DOUBTFUL: -0.5, None: 0.0}


def excluded(tag: str, attrs: str) -> str | None:
    """SURE, DOUBTFUL or HEADER (doubtful, and only a header) for an element that
    its mark-up excludes."""
    found = HEADER if tag == "header" else ASIDE if tag == "aside" else DOUBTFUL if tag in DOUBTFUL_TAGS else SURE if tag in EXCLUDED_TAGS else None
    if not attrs or tag in OUTER_TAGS:
        return found
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return SURE
        if name == "style" and "display:none" in value.replace(" ", ""):
            return SURE
        if name == "role" and value in EXCLUDED_ROLES:
            if value not in DOUBTFUL_ROLES:
                return SURE
            found = found or DOUBTFUL
        if name in ("class", "id"):
            for token in value.split():
                words = WORDS_OF_NAME.findall(token)
                listed = EXCLUDED_NAMES.intersection(words)
                if listed == {"header"}:
                    found = found or (HEADER if len(set(words)) == 1 or words[-1] == "header" else DOUBTFUL)
                elif listed and len(listed) == len(set(words)):
                    return SURE
                elif listed:
                    found = found or DOUBTFUL
    return found


class Block:
    """Words between block-level tags: what they look like and what they say."""

    def __init__(self, tag: str, hint: str | None):
        self.tag, self.hint, self.parts, self.linked = tag, hint, [], 0

    def add(self, text: str, link: bool) -> None:
        self.parts.append(text)
        if link:
            self.linked += len(text.split())

    def close(self) -> None:
        self.text = squeeze("".join(self.parts))
        self.words = self.text.count(" ") + 1 if self.text else 0

    def features(self) -> tuple:
        kind = "heading" if self.tag in HEADINGS else self.tag
        length = next(n for n in LENGTH_PRIOR if self.words <= n)
        return (("block", kind), ("length", None if kind == "heading" else length), ("link", 2 * self.linked >= max(self.words, 1)),
                ("sentence", None if kind == "heading" else self.text.endswith(SENTENCE_ENDS)))


class Element:
    """An element that its mark-up speaks against, or the page: blocks, tags and elements."""

    def __init__(self, tag: str, level: int, hint: str | None):
        self.tag, self.level, self.hint = tag, level, hint
        self.content: list = []
        self.block: Block | None = None
        self.score, self.region = 0.0, (0, 0)


def parse(page: str) -> Element:
    """The page as a sequence of blocks, tag names and elements."""
    root = Element("", 0, None)
    stack, level, blocks, articles, linked = [root], Counter(), [""], 0, 0

    def hint() -> str | None:
        own = min((e.hint for e in stack), key=HINTS.__getitem__)
        return None if own == HEADER and articles > 0 and blocks[-1] in HEADINGS else own

    def flush() -> None:
        top = stack[-1]
        if top.block is not None:
            top.block.close()
            if top.block.words:
                top.content.append(top.block)
            top.block = None

    def words(text: str) -> None:
        top = stack[-1]
        if top.block is None:
            top.block = Block(blocks[-1], hint())
        top.block.add(text, linked > 0)

    def leave(n: int) -> None:
        """Close the elements above place ``n`` of the stack."""
        while len(stack) > n:
            flush()
            done = stack.pop()
            stack[-1].content.append(done)

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            words(page[at:m.start()])
        at = m.end()
        if m["tag"] is None:
            if m["raw"]:
                stack[-1].content.append("excluded")
            continue
        tag, closing, ended = m["tag"].lower(), bool(m["close"]), False
        void = tag in VOID_TAGS or m["attrs"].endswith("/")
        if tag == "br":
            words(" ")
        if tag in BLOCK_TAGS:
            flush()
        if tag in OUTER_TAGS:
            leave(1)
            flush()
            level.clear()
        if tag in ("article", "main"):
            articles = max(0, articles + (-1 if closing else 1))
        if closing and not void:
            level[tag] -= 1
            ends = next((i for i in range(1, len(stack)) if stack[i].tag == tag and stack[i].level > level[tag]), len(stack))
            ended = ends < len(stack)
            leave(ends)
            if tag in blocks[1:]:
                del blocks[len(blocks) - 1 - blocks[::-1].index(tag):]
            linked = max(0, linked - (tag == "a"))
        elif not void:
            level[tag] += 1
            linked += tag == "a"
            if tag in BLOCK_TAGS:
                if tag in ("p", "li", "dt", "dd", "td", "tr", "option") and blocks[-1] == tag or blocks[-1] == "p":
                    blocks.pop()
                blocks.append(tag)
            if (found := excluded(tag, m["attrs"])) is not None:
                stack.append(Element(tag, level[tag], found))
        if not closing or not ended:  # an element's tag counts once
            stack[-1].content.append(tag)
    if at < len(page):
        words(page[at:])
    leave(1)
    flush()
    return root


def squeeze(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def _flat(element: Element) -> Iterator:
    for x in element.content:
        if isinstance(x, Element):
            yield "excluded"
            yield from _flat(x)
        else:
            yield x


def token_counts(page: str, lines: set[str]) -> tuple[Counter, Counter]:
    """Features of words, and tags, inside and outside the main text of a labelled page.
    A tag is inside when the main text has begun and goes on behind it.  The labels say
    nothing about headings; words that the mark-up speaks against count for that alone."""
    inside, outside, between = Counter(), Counter(), Counter()
    begun = False
    for x in _flat(parse(page)):
        if isinstance(x, str):
            between["tag", x] += x not in HEADINGS
            continue
        if x.tag in HEADINGS:
            continue
        side = inside if x.text in lines else outside
        (inside if side is inside and begun else outside).update(between)
        between.clear()
        begun = begun or side is inside
        if x.hint is None:
            side.update({f: x.words for f in x.features()})
    outside.update(between)
    return inside, outside


class Weights:
    def __init__(self, inside: Counter, outside: Counter):
        def odds(kind: str, value, prior: float) -> float:
            share = 1 / (1 + math.exp(-prior))
            own = math.log((inside[kind, value] + PRIOR_WORDS * share) / (outside[kind, value] + PRIOR_WORDS * (1 - share)))
            return max(LEAST, min(MOST, own))

        blocks = {*BLOCK_PRIOR, *(v for k, v in {*inside, *outside} if k == "block")}
        self.word = {("block", t): odds("block", t, BLOCK_PRIOR.get(t, BLOCK_OTHER)) for t in blocks}
        for kind, priors in (("length", LENGTH_PRIOR), ("link", LINK_PRIOR), ("sentence", SENTENCE_PRIOR)):
            self.word |= {(kind, v): odds(kind, v, x) for v, x in priors.items()}
        self.tags = {}
        for t in {*TAG_PRIOR, *(v for k, v in {*inside, *outside} if k == "tag")}:
            plus, minus = (n["tag", t] + SMOOTH * x for n, x in zip((inside, outside), TAG_PRIOR.get(t, OTHER)))
            # a tag never scores above zero: the more often it stands outside, the less
            self.tags[t] = -0.1 - math.log1p(min(minus / plus, 1e13))
        self.other = -0.1 - math.log1p(OTHER[1] / OTHER[0])

    def of_tag(self, tag: str) -> float:
        return self.tags.get(tag, self.other)

    def of_block(self, block: Block) -> float:
        per_word = HINTS[block.hint] + sum(self.word.get(f, BLOCK_OTHER if f[0] == "block" else 0.0) for f in block.features())
        return block.words * per_word


def best_region(scores: list[float]) -> tuple[int, int]:
    """[begin, end) of the contiguous run with the highest sum (empty if none is
    positive): the first of equals, as long as possible."""
    best, at, begin, total = 0.0, (0, 0), 0, 0.0
    for i, s in enumerate(scores):
        if total < 0 or i == 0:
            begin, total = i, 0.0
        total += s
        if total > best or total == best and at[0] == begin and best > 0:
            best, at = total, (begin, i + 1)
    return at


def scan(element: Element, weights: Weights) -> None:
    """Score and region of an element, those of the elements in it first."""
    cost = -weights.of_tag("excluded")
    todo, order = [element], []
    while todo:  # children behind their parents; read backwards below
        order.append(todo.pop())
        todo += [x for x in order[-1].content if isinstance(x, Element)]
    for e in reversed(order):
        scores = [weights.of_tag(x) if isinstance(x, str) else weights.of_block(x) if isinstance(x, Block) else max(x.score - cost, -cost) for x in e.content]
        e.region = best_region(scores)
        e.score = sum(scores[slice(*e.region)])


def texts(element: Element, weights: Weights) -> Iterator[str]:
    """Blocks of the element's region; elements that don't outweigh their tag are stepped over."""
    cost, at = -weights.of_tag("excluded"), [iter(element.content[slice(*element.region)])]
    while at:
        x = next(at[-1], None)
        if x is None:
            at.pop()
        elif isinstance(x, Block):
            yield x.text
        elif isinstance(x, Element) and x.score > cost:
            at.append(iter(x.content[slice(*x.region)]))


def main_text(page: str | None, weights: Weights) -> str:
    if not page:
        return ""
    root = parse(page)
    scan(root, weights)
    return "\n\n".join(texts(root, weights))


def fit(labelled: DataFrame, html: str = "html", lines: str = "lines") -> Weights:
    """Weights from rows (html, lines: array of the main text's lines).  Counts come to
    the driver: a few rows per tag name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = Counter(), Counter()
        for batch in batches:
            for page, wanted in zip(batch.column("html").to_pylist(), batch.column("lines").to_pylist()):
                for total, part in zip(totals, token_counts(page or "", {squeeze(x) for x in wanted or () if x} - {""})):
                    total.update(part)
        rows = [(kind, json.dumps(v), side, n) for side, total in enumerate(totals) for (kind, v), n in total.items()]
        k, v, s, n = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.string()), pa.array(v, pa.string()), pa.array(s, pa.int32()), pa.array(n, pa.int64())],
                                         names=["kind", "value", "side", "n"])

    counts = labelled.select(F.col(html).alias("html"), F.col(lines).alias("lines")).mapInArrow(run, "kind string, value string, side int, n long")
    sides = Counter(), Counter()
    for r in counts.groupBy("kind", "value", "side").agg(F.sum("n").alias("n")).collect():
        sides[r["side"]][r["kind"], json.loads(r["value"])] += r["n"]
    return Weights(*sides)


def extract(pages: DataFrame, weights: Weights, carry: list[str], html: str = "html") -> DataFrame:
    """``carry`` columns of every page plus text and n_chars."""
    clash = {"text", "n_chars"} & set(carry)
    if clash:
        raise ValueError(f"columns {sorted(clash)} clash with the result's")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [main_text(p, weights) for p in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=[*carry, "text", "n_chars"])

    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in carry)
    return pages.select(*dict.fromkeys([*carry, html])).mapInArrow(run, f"{fields}, text string, n_chars long")


def labelled_pages(pages: DataFrame, docs: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """Pages whose address ends in the number of a document have that document's
    lines as their main text; ``limit`` of them, taken by a hash of the page."""
    number = F.regexp_extract("url", r"/([0-9]{1,18})(?:[/.?#][^/]*)?$", 1)
    chosen = (pages.select("page_id", number.alias("no")).where("no <> ''")
              .select("page_id", F.col("no").cast("long").alias("doc_id")).dropDuplicates(["page_id"])
              .orderBy(F.xxhash64("page_id"), "page_id").limit(limit))
    bodies = docs.select("doc_id", F.split("text", "\n").alias("lines")).join(F.broadcast(chosen), "doc_id")  # at most ``limit`` rows
    return pages.select("page_id", "html").join(F.broadcast(chosen.select("page_id")), "page_id").join(bodies.select("page_id", "lines"), "page_id")


def query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    weights = fit(labelled_pages(pages, documents(spark, sf_dir)))
    return extract(pages, weights, ["page_id", "url"])
