"""Main text of web pages by a maximum-scoring subsequence (operator 13).

A page is read once as a sequence of tags and words. Every word scores above zero,
every tag below zero, and the contiguous stretch with the largest sum is the content
region (one pass over prefix sums). The scores come from labelled pages: those with
exactly one ``article`` or ``main`` element mark their own content, and one Spark
aggregation counts, for each kind of token, how many lie inside (over an even sample of
about ``SAMPLE`` pages; the scores are ratios of its counts).

* a word scores P(inside | word), a word of a link P(inside | word of a link);
* a tag scores log P(inside | tag name). The tags ``article`` and ``main`` bound the label, so they lie outside;
* elements that are no content by their name (``nav``, ``footer``, ``aside``, ``form`` ...) or by
  a word of their class, id or role (``DROPPED_NAMES``) leave the sequence as one
  token, which scores like a tag, and leave the text. A header goes unless it stands inside
  an ``article`` or ``main``. A class does not drop an element that holds the page's only ``article`` or ``main``, unless it names comments.

Shares are smoothed by one token inside and one outside and are at least ``FLOOR``, so a
tag that no labelled page has scores log 1/2, and the table is bounded by the tag names
of ``TAGS`` (any other is "other"). If half the words of the region lie in one
``article`` or ``main`` element, the smallest such element is the text: a region must not lose the
tables and lists at an article's ends. Otherwise the region is, widened to the smallest ``div``, ``section`` or
table cell around it if that adds more plain words than words of links.

Character references are decoded; white space inside a block becomes one blank; ``br`` is
white space; blocks are joined by a line break. Nothing else is dropped or cut.

Edge cases: a null or empty page, or one without words outside dropped elements, has the
empty text; an open tag, comment or script at the end of a cut page runs to its end; end tags
without a start are ignored; an element that is never closed ends with its parent, a dropped one
also at the next ``article`` or ``main``; very long pages are read whole, in time linear in their length; where
two stretches score alike the first one is taken; repeated rows are pages of their own; an empty table
gives an empty result, and without labelled pages every share is one half; other columns are ignored or, in
``extract_text``, passed through, whatever their names.
"""

from __future__ import annotations

import html as _html
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLOOR = 0.001  # least share of a token kind inside the content
SAMPLE = 20_000  # pages, drawn evenly, that the scores are learned from; all of them if there are fewer

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
                   "template tfoot th thead title tr ul".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
DROPPED_TAGS = frozenset("nav footer aside form script style title head template svg button select option input textarea noscript iframe noembed "
                         "noframes object embed audio video canvas map dialog menu".split())
CONTENT_TAGS = frozenset(["article", "main"])
# Words of class, id and role attributes that name what is not the article.
DROPPED_NAMES = frozenset("ad ads adv advert adverts advertisement advertisements advertising adbox adsense banner breadcrumb breadcrumbs "
                          "cookie cookies consent gdpr footer foot form "
                          "masthead menu menubar menus modal nav navbar navigation navi newsletter notice notices notification alert popup overlay promo "
                          "promotion promoted related recommended search share sharing sidebar sidebars sidenav skip social sponsor sponsored "
                          "sponsors subscribe subscription toolbar topbar widget widgets complementary contentinfo signup login pagination pager".split())
COMMENT_NAMES = frozenset("comment comments commentlist respond disqus discussion replies".split())
#: Tags that have a score of their own.
TAGS = tuple(sorted(BLOCKS | INLINE | VOID | RAW | DROPPED_TAGS | CONTENT_TAGS)) + ("other",)
KNOWN = frozenset(TAGS)
BOXES = frozenset(["div", "section", "td"])
ROOTS = frozenset(["html", "body"])
UNDROPPED = ROOTS | CONTENT_TAGS  # a class never drops these, unless it names comments ...
WORD, LINKED = "#word", "#linked"  # kinds of token that are no tags
NOTHING = (False, False, False, False)
NO_ENDS = (frozenset(), frozenset())
BOUNDS = frozenset("table ul ol dl select html body article main section div".split())
#: Start tags that end an open element: which ones, and what hides them.
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, a, b in (
    ("li", "li", "ul ol menu dir"), ("dt", "dt dd", "dl"), ("dd", "dt dd", "dl"), ("tr", "tr td th", "table"), ("td", "td th", "table tr"),
    ("th", "td th", "table tr"), ("option", "option", "select"), ("p", "p", ""))}

TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""(?:^|[\s/"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
NAME_PARTS = re.compile(r"[a-z]+")
NEGATED = re.compile(r"\b(?:has|with|no|without)[-_]+[a-z]+")  # ... nor does a class that only says what else there is
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


def named(attributes: str) -> tuple[bool, bool, bool, bool]:
    """What class, id and role say: no content, comments, a header, the content itself."""
    words: set[str] = set()
    content = False
    for m in ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        content |= m[1].lower() == "role" and value.strip().lower() in CONTENT_TAGS
        words.update(NAME_PARTS.findall(NEGATED.sub(" ", HUMP.sub("-", value).lower())))
    return not DROPPED_NAMES.isdisjoint(words), not COMMENT_NAMES.isdisjoint(words), "header" in words, content


class Element:
    __slots__ = ("name", "first", "end", "closed", "drop", "content", "inside", "parent_drop")

    def __init__(self, name, first, drop, content, inside):
        self.name, self.first, self.end, self.closed = name, first, None, False
        self.drop = drop  # "tag", "class" or ""
        self.content = content
        self.inside = inside  # within an article or main


class Page:
    """A page as a sequence of tokens.

    ``kinds``: the tag's name, "" for a text piece; ``pieces``: (block number, text, linked) of text
    pieces; ``dropped`` and ``content``: disjoint, and possibly nested, elements as (first token, end token, name)."""

    __slots__ = ("kinds", "pieces", "dropped", "content", "boxes")

    def __init__(self, source: str):
        self.kinds: list[str] = []
        self.pieces: list[tuple[int, str, bool] | None] = []
        self.boxes: list[tuple[int, int]] = []
        self._settle(self._elements(source))

    def _elements(self, source: str) -> list[Element]:
        """Reads all tokens; returns the elements that are dropped or content."""
        kinds, pieces = self.kinds, self.pieces
        stack: list[Element] = []
        depth: Counter = Counter()
        held: list[Element] = []
        block = links = contents = 0

        def close(height: int, explicit: bool) -> None:
            """Ends all elements from ``height`` up; the lowest by its own end tag if ``explicit``."""
            nonlocal links, contents
            while len(stack) > height:
                e = stack.pop()
                depth[e.name] -= 1
                e.end = len(kinds)
                if e.name in BOXES:
                    self.boxes.append((e.first + 1, e.end))
                e.closed = explicit and len(stack) == height
                links -= e.name == "a"
                contents -= e.content

        def text(piece: str, linked: bool) -> None:
            kinds.append("")
            pieces.append((block, piece, linked))

        at, size = 0, len(source)
        while at < size:
            m = TOKEN.search(source, at)
            until = m.start() if m else size
            if until > at:
                piece = source[at:until]
                text(_html.unescape(piece) if "&" in piece else piece, links > 0)
            if m is None:
                break
            at = m.end()
            if m[2] is None:
                continue
            name = m[2].lower()
            if m[1]:  # an end tag; without a start it says nothing
                if depth[name]:
                    height = len(stack) - 1
                    while stack[height].name != name:
                        height -= 1
                    close(height, True)
                    kinds.append(name)
                    pieces.append(None)
                block += name in BLOCKS
                continue
            if name in BLOCKS:
                block += 1
                ends, stops = CLOSES.get(name, NO_ENDS)
                if depth["p"] or ends and any(depth[x] for x in ends):
                    self._implied(stack, ends, stops, name, close)
            kinds.append(name)
            pieces.append(None)
            if name == "br":
                text(" ", False)
            if name in VOID:
                continue
            no, comments, header, main = named(m[3]) if "=" in m[3] else NOTHING
            main = main or name in CONTENT_TAGS
            drop = ""
            if comments and name not in ROOTS:
                drop = "tag"
            elif name in DROPPED_TAGS:
                drop = "" if main else "tag"
            elif name == "header":
                drop = "" if contents else "tag"
            elif (no or header and not contents) and name not in UNDROPPED:
                drop = "class"
            e = Element(name, len(kinds) - 1, drop, main, contents > 0)
            contents += main
            if drop or main:
                held.append(e)
            if name in RAW:
                end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(source, at)
                at = end.start() if end else size
            stack.append(e)
            depth[name] += 1
            links += name == "a"
        close(0, False)
        return held

    @staticmethod
    def _implied(stack, ends, stops, name, close) -> None:
        """A start tag that ends an open ``li``, ``td``, ``p`` ... before it."""
        height = len(stack) - 1
        found = None
        while height >= 0:
            open_ = stack[height].name
            if open_ in ends or open_ == "p" and name in BLOCKS:
                found = height
                if open_ != "p" or "p" in ends:
                    break
            elif open_ in stops or (open_ not in INLINE and (name not in CLOSES or name == "p" or open_ in BOUNDS)):
                break
            height -= 1
        if found is not None:
            close(found, False)

    def _settle(self, held: list[Element]) -> None:
        """Which elements are dropped after all: outermost ones, cut at content that they only hold for want of an end tag."""
        free = self._free(held, ("tag", "class"))
        if not free and any(e.content and e.drop != "class" for e in held):
            for e in held:  # a wrapper whose class names something else holds the only content
                if e.drop == "class" and any(c.content and not c.drop and e.first < c.first < e.end for c in held):
                    e.drop = ""
        starts = [e.first for e in held if e.content and not e.drop]
        self.dropped, upto = [], 0
        for e in held:
            if e.drop and e.first >= upto:
                end = e.end
                if not e.closed:
                    k = bisect_right(starts, e.first)
                    if k < len(starts) and starts[k] < end:
                        end = starts[k]
                self.dropped.append((e.first, end, e.name))
                upto = end
        self.content = [(e.first + 1, e.end, e.name) for e in self._free(held, None)]

    def _free(self, held, drops):
        """Content elements outside all dropped ones."""
        out, upto = [], -1
        spans = self.dropped if drops is None else None
        if spans is not None:
            firsts = [s[0] for s in spans]
            for e in held:
                if e.content and not e.drop:
                    k = bisect_right(firsts, e.first) - 1
                    if k < 0 or spans[k][1] <= e.first:
                        out.append(e)
            return out
        starts = [e.first for e in held if e.content and not e.drop]
        for e in held:
            if e.drop in drops and e.first >= upto:
                k = bisect_right(starts, e.first)
                upto = starts[k] if not e.closed and k < len(starts) and starts[k] < e.end else e.end
            elif e.content and not e.drop and e.first >= upto:
                out.append(e)
        return out

    def tokens(self):
        """(kind, words, token number, end) of the sequence in which each dropped element is one token."""
        at, k = 0, 0
        kinds, pieces, dropped = self.kinds, self.pieces, self.dropped
        while at < len(kinds):
            if k < len(dropped) and dropped[k][0] == at:
                first, end, name = dropped[k]
                k += 1
                yield "#" + (name if name in KNOWN else "other"), 1, first, max(end, first + 1)
                at = max(end, first + 1)
                continue
            piece = pieces[at]
            if piece is None:
                yield kinds[at] if kinds[at] in KNOWN else "other", 1, at, at + 1
            elif n := len(piece[1].split()):
                yield LINKED if piece[2] else WORD, n, at, at + 1
            at += 1

    def region(self, weights: dict[str, float]) -> tuple[int, int]:
        """First and end token of the content."""
        seq = list(self.tokens())
        if not seq:
            return 0, 0
        score = np.array([weights[k] * n for k, n, _, _ in seq])
        words = np.array([n if k in (WORD, LINKED) else 0 for k, n, _, _ in seq])
        if not words.any():
            return 0, 0
        up = np.cumsum(score)
        before = np.concatenate([[0.0], up[:-1]])
        low = np.minimum.accumulate(before)
        j = int(np.argmax(up - low))
        i = int(np.flatnonzero(before[:j + 1] == low[j])[-1])
        first, end = seq[i][2], seq[j][3]
        starts = [s[2] for s in seq]
        plain, linked = (np.concatenate([[0], np.cumsum(np.where([s[0] == kind for s in seq], words, 0))]) for kind in (WORD, LINKED))

        def within(sums, a: int, b: int) -> int:
            return int(sums[bisect_left(starts, b)] - sums[bisect_left(starts, a)]) if b > a else 0

        own = within(plain, first, end) + within(linked, first, end)
        best = min(((a, b) for a, b, _ in self.content if 2 * sum(within(x, max(a, first), min(b, end)) for x in (plain, linked)) >= own),
                   key=lambda s: s[1] - s[0], default=None)
        if best is None and (around := min(((a, b) for a, b in self.boxes if a <= first and end <= b), key=lambda s: s[1] - s[0], default=None)):
            if within(plain, *around) - within(plain, first, end) > within(linked, *around) - within(linked, first, end):
                best = around
        return best or (first, end)

    def text(self, weights: dict[str, float]) -> str:
        first, end = self.region(weights)
        blocks: list[str] = []
        now, parts, skip, k = None, [], 0, 0
        for at in range(first, end):
            while k < len(self.dropped) and self.dropped[k][1] <= at:
                k += 1
            if k < len(self.dropped) and self.dropped[k][0] <= at or self.pieces[at] is None:
                continue
            block, piece, _ = self.pieces[at]
            if block != now:
                blocks.append(" ".join("".join(parts).split()))
                now, parts = block, []
            parts.append(piece)
        blocks.append(" ".join("".join(parts).split()))
        return "\n".join(b for b in blocks if b)


def counted(page: Page, counts: Counter, inside: Counter) -> None:
    """Adds a page with one content element to the counts by kind of token."""
    if len(page.content) != 1:
        return
    a, b, _ = page.content[0]
    for kind, n, first, end in page.tokens():
        counts[kind] += n
        if a <= first and end <= b:
            inside[kind] += n


COUNTS = T.StructType([T.StructField("kind", T.StringType()), T.StructField("inside", T.LongType()), T.StructField("all", T.LongType())])


def learn_weights(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> dict[str, float]:
    """Score of each kind of token from the labelled ones among about ``sample`` pages; a table of at most
    ``2 * len(TAGS) + 2`` rows reaches the driver."""
    share = sample / max(pages.count(), 1)
    if share < 1:
        pages = pages.filter(F.rand(7) < share)

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(COUNTS)
        counts, inside = Counter(), Counter()
        for batch in batches:
            for source in batch.column(0):
                counted(Page(source.as_py() or ""), counts, inside)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([inside[k] for k in counts], pa.int64()),
                                          pa.array(list(counts.values()), pa.int64())], schema=arrow)

    found = pages.select(F.col(html_col).cast("string")).mapInArrow(work, COUNTS).groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("all").alias("all"))
    return weights_of({r["kind"]: (r["inside"], r["all"]) for r in found.collect()})


def weights_of(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Words above zero, tags below."""
    out = {}
    for kind in (WORD, LINKED, *TAGS, *("#" + t for t in TAGS)):
        inside, total = counts.get(kind, (0, 0))
        share = max((inside + 1) / (total + 2), FLOOR)
        out[kind] = share if kind in (WORD, LINKED) else math.log(share)
    return out


def extract_text(pages: DataFrame, html_col: str = "html", weights: dict[str, float] | None = None) -> DataFrame:
    """The input rows (struct ``row``) with their main text, ``main_text``."""
    weights = weights or learn_weights(pages, html_col)
    schema = T.StructType([T.StructField("row", pages.schema), T.StructField("main_text", T.StringType())])

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([Page(x.as_py() or "").text(weights) for x in batch.column(1)], arrow.field(1).type)], schema=arrow)

    return pages.select(F.struct("*").alias("row"), F.col(html_col).cast("string").alias("html")).mapInArrow(work, schema)


def text_digest(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    made = extract_text(pages.select("page_id", "url", F.col("html").cast("string").alias("html")))
    return made.select("row.page_id", "row.url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
