"""Main text of web pages by the maximum-scoring subsequence (operator 13).

A page is read as a sequence of words and tags. Words score above zero and tags below; the contiguous
stretch with the highest sum, found by one scan, is the content region, and its blocks are the text. The
weights are logarithms of how often a kind of word or tag lies inside and outside the content of labelled
pages: pages that mark their article themselves, each read twice, as it is and with the names of its
landmarks (``nav``, ``article``, ``footer``, classes) taken away, so that plain pages are learned too.

Elements that no reader takes for content (scripts, forms, menus, adverts, reader comments, ...) are left
out of the sequence, inside the region too; each leaves one tag-like mark behind.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from nestloom.llm.common import materialize

# Names of HTML elements and the words that sites use for parts around the content.
RAW = "script style title textarea noscript template iframe svg math canvas object noembed noframes xmp".split()
BLOCKS = (
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead tr ul"
).split()
INLINE = "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
APART = "head nav aside footer form button select menu dialog audio video".split()
HINTS = (
    "ad ads adv advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disclaimer disqus footer form gdpr legal login masthead menu menubar modal nav navbar navigation newsletter notice "
    "notices notification overlay pager pagination popup promo promotion recommended related replies respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget complementary contentinfo alert"
).split()
_HEADERS = {"header", "banner"}
_LANDMARKS = {"nav", "aside", "footer", "header", "article", "main", "section"}
_WHOLE = {"html", "body", "article", "main"}  # never left out for the words in their attributes

_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)
    | <(?P<raw>{"|".join(RAW)})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)
    | <(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]{{0,4096}}"|'[^']{{0,4096}}')*+>|[^>]*>)
    | <[!?/][^>]*>""",
    re.DOTALL | re.IGNORECASE | re.VERBOSE,
)
_ATTRIBUTE = re.compile(r"""([a-z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_PIECES = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
_KNOWN = {*BLOCKS, *INLINE, *VOID}
_BLOCKS, _APART, _HINTS, _VOID = set(BLOCKS), set(APART), set(HINTS), set(VOID)


@dataclass
class Tag:
    """A start or end tag; ``words`` are those of its class, id and role, ``twin`` the place of its end tag."""

    name: str
    closes: bool
    words: set[str] = field(default_factory=set)
    hidden: bool = False
    twin: int = -1


def _tag(match: re.Match) -> Tag:
    name, closes = match["name"].lower(), bool(match["end"])
    words, hidden, rest = set(), False, match["rest"]
    if not closes and len(rest) > 1:
        for key, value in _ATTRIBUTE.findall(rest):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id", "role"):
                words.update(w.lower() for w in _PIECES.findall(value))
            elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
                hidden = True
    return Tag(name, closes, words, hidden)


def read_page(text: str) -> list[str | Tag]:
    """Texts and tags in page order, start and end tags knowing each other; raw text and comments are left out.

    An end tag closes the last open element of its name; elements that are never closed have no twin.
    """
    items: list[str | Tag] = []
    open_: dict[str, list[int]] = {}
    at = 0
    for match in _TOKEN.finditer(text):
        if match.start() > at:
            items.append(text[at : match.start()])
        at = match.end()
        if not match["name"]:
            continue
        tag = _tag(match)
        if tag.closes and open_.get(tag.name):
            tag.twin = open_[tag.name].pop()
            items[tag.twin].twin = len(items)
        elif not tag.closes and tag.name not in _VOID:
            open_.setdefault(tag.name, []).append(len(items))
        items.append(tag)
    if at < len(text):
        items.append(text[at:])
    return items


def _left_out(tag: Tag, within: bool) -> bool:
    """Whether an element is no content by its name, class, id or role; a header inside an article is its title."""
    if tag.name in _APART or tag.hidden:
        return True
    if tag.name in _WHOLE:
        return False
    return bool(tag.words & _HINTS) or (not within and (tag.name == "header" or bool(tag.words & _HEADERS)))


@dataclass
class Token:
    """``kind`` carries the weight, ``count`` how often; ``text`` only for words; ``breaks``: ends a block."""

    kind: str
    count: int
    text: str = ""
    breaks: bool = False
    inside: bool = False


def _size(words: int) -> str:
    return "few" if words < 4 else "some" if words < 12 else "many"


def tokens(text: str, bare: bool = False) -> list[Token]:
    """The sequence that is scored. ``inside`` tells what lies in an article that the page marks itself.

    ``bare`` reads landmarks as plain ``div`` and no attributes.
    """
    items = read_page(text)
    articles = [(i, x.twin) for i, x in enumerate(items) if isinstance(x, Tag) and not x.closes and x.name == "article"]
    marked = articles[0] if len(articles) == 1 else (-1, -1)
    if bare:
        items = [x if isinstance(x, str) else Tag("div" if x.name in _LANDMARKS else x.name, x.closes, twin=x.twin) for x in items]
    found: list[Token] = []
    links, within, at = 0, 0, 0
    while at < len(items):
        item, inside = items[at], marked[0] < at < marked[1]
        if isinstance(item, str):
            found.append(Token(f"word {'link' if links > 0 else 'text'}", 0, item, False, inside))
            at += 1
            continue
        if not item.closes and _left_out(item, within > 0):
            found.append(Token("tag cut", 1, "", item.name in _BLOCKS, inside))
            at = max(at, item.twin) + 1
            continue
        if item.twin >= 0:
            step = -1 if item.closes else 1
            links += step * (item.name == "a")
            within += step * (item.name in ("article", "main"))
        name = item.name if item.name in _KNOWN else "other"
        blank = " " if item.name == "br" else ""
        found.append(Token(f"tag {'/' if item.closes else ''}{name}", 1, blank, item.name in _BLOCKS, inside))
        at += 1
    # the number of words of its block is part of the kind of a word
    start = 0
    for end in range(len(found) + 1):
        if end == len(found) or found[end].breaks:
            words = [t for t in found[start:end] if t.kind.startswith("word")]
            for t in words:
                t.text = entities.unescape(t.text)
                t.count = len(t.text.split())
            total = sum(t.count for t in words)
            for t in words:
                t.kind += " " + _size(total)
            start = end + 1
    return found


def blocks(found: list[Token]) -> str:
    """Text of the blocks of a region, white space inside a block as one space, one line each."""
    lines: list[list[str]] = [[]]
    for t in found:
        if t.breaks:
            lines.append([])
        elif t.text:
            lines[-1].append(t.text)
    kept = (" ".join("".join(line).split()) for line in lines)
    return "\n".join(line for line in kept if line)


LEAST, MOST = 0.05, 12.0  # bounds of a weight


@dataclass
class PageModel:
    """Weight per kind of token: words at least ``LEAST``, tags at most ``-LEAST``; ``scale`` multiplies tags.

    A tag that labelled pages do not have counts ``-LEAST``: nothing is known against it. So does what was left
    out, as its words cannot come back.
    """

    weights: dict[str, float]
    scale: float = 1.0

    def weight(self, t: Token) -> float:
        if t.kind.startswith("word"):
            return t.count * self.weights.get(t.kind, 1.0)
        return self.scale * t.count * self.weights.get(t.kind, -LEAST if self.weights else -1.0)

    def region(self, found: list[Token]) -> tuple[int, int]:
        """Start and end of the stretch with the highest sum, the first and shortest of several; empty if none is above 0."""
        best, begin, end = 0.0, 0, 0
        total, start = 0.0, 0
        for i, t in enumerate(found):
            if total <= 0:
                total, start = 0.0, i
            total += self.weight(t)
            if total > best:
                best, begin, end = total, start, i + 1
        return begin, end

    def text(self, page: str | None) -> str:
        found = tokens(page or "")
        begin, end = self.region(found)
        return blocks(found[begin:end])


SCALES = (1.0, 2.0, 4.0, 8.0, 16.0)


def _each(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""


def fit(pages: DataFrame, sample: int = 2000, html_col: str = "html", id_col: str = "page_id") -> PageModel:
    """Weights from at most about ``sample`` pages that mark one article, chosen by a hash of their id.

    Without such pages every word counts 1 and every tag -1. Only counts per kind of token reach the driver,
    and the kinds are a fixed list.
    """
    text = F.col(f"`{html_col}`")
    labelled = pages.where(text.rlike(r"(?i)<article[\s>]")).select(F.col(f"`{id_col}`").alias("id"), text.alias("html"))
    total = labelled.count()
    if not total:
        return PageModel({})
    place = F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1_000_000))
    # the few labelled pages serve twice and are written once
    chosen = materialize(labelled.where(place < int(1_000_000 * min(1.0, sample / total)) + 1).select("html"), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside, outside = Counter(), Counter()
            for page in _each(batch.column(0)):
                for bare in (False, True):
                    for t in tokens(page, bare):
                        (inside if t.inside else outside)[t.kind] += t.count
            kinds = sorted({*inside, *outside})
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.string()), pa.array([inside[k] for k in kinds], pa.int64()), pa.array([outside[k] for k in kinds], pa.int64())],
                ["kind", "inside", "outside"],
            )

    counts = chosen.mapInArrow(count, "kind string, inside bigint, outside bigint").groupBy("kind").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o"))
    weights = {}
    for r in counts.collect():
        odds = math.log((r["i"] + 0.5) / (r["o"] + 0.5))
        if r["kind"] == "tag cut":
            continue
        weights[r["kind"]] = max(odds, LEAST) if r["kind"].startswith("word") else min(max(odds, -MOST), -LEAST)

    models = [PageModel(weights, s) for s in SCALES]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right, wrong = [0] * len(models), [0] * len(models)
            for page in _each(batch.column(0)):
                for bare in (False, True):
                    found = tokens(page, bare)
                    for k, m in enumerate(models):
                        begin, end = m.region(found)
                        for i, t in enumerate(found):
                            if t.kind.startswith("word") and t.count:
                                (right if t.inside == (begin <= i < end) else wrong)[k] += t.count
            yield pa.RecordBatch.from_arrays([pa.array(range(len(models)), pa.int32()), pa.array(right, pa.int64()), pa.array(wrong, pa.int64())], ["k", "r", "w"])

    judged = chosen.mapInArrow(judge, "k int, r bigint, w bigint").groupBy("k").agg(F.sum("w").alias("w")).collect()
    return models[min(judged, key=lambda r: (r["w"], r["k"]))["k"]] if judged else models[0]


def extract(pages: DataFrame, model: PageModel, html_col: str = "html") -> DataFrame:
    """Every row of ``pages`` without its html, with ``text`` and ``n_chars``.

    Null or empty html, or a page without words: empty text. Whole pages are read, whatever their length.
    Repeated rows each get their text. Other columns stay as they are, except ``text`` and ``n_chars``, which
    the result replaces. Empty table: no rows.
    """
    kept = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    # plain names inside: those of the caller may hold any sign
    rows = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate([*kept, html_col])])
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [model.text(page) for page in _each(part.columns[-1])]
                columns = [*part.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(read, schema).toDF(*kept, "text", "n_chars")
