"""Main text of HTML pages by two passes of rules over their blocks.

A page is cut into blocks of text at block-level tags. What its markup itself sets apart (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles, hidden parts and reader comments, by tag, role, class or id) is
no block. Then:

1. Length, link density and the density of stop words decide a block: much linked blocks are bad, unlinked ones of
   some length are good if they hold stop words, and bad if not. Inside the page's declared article (`article`,
   `main` and their roles) doubt is in the block's favour: only linked list items are bad, and long text without stop
   words stays open. Blocks outside a declared article are bad where it holds text. On a page none of whose blocks
   holds stop words, in a language without a list, their density decides nothing.
2. Open blocks take the label of the nearest decided block of the same article or page, a heading that of the next
   one; between two as near the good one counts, and without any the block is kept.

The good blocks, each with its white space folded, are the text, one a line. Nothing is cut off.

Results for odd input: a null or empty page, or one without good blocks, has the empty text; a page cut off inside a
tag, comment or script ends there; text before, after or without `html` and `body` counts; unclosed tags end where
the next block makes them end. Every part of the scan passes a page of any length and nesting a fixed number of
times. Repeated rows each give a row, null ids and addresses stay null, other columns are ignored.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from larder.llm.common import column_of, map_texts, texts

MIN_WORDS = 20
MIN_STOP_DENSITY = 0.1
MAX_LINK_DENSITY = 0.33

# Frequent words by language.
STOP_WORDS = {
    "en": "a an and are as at be but by for from had has have he her his in is it not of on or she that the their "
          "they this to was we were which will with you",
    "de": "aber als am an auch auf aus bei das dass dem den der des die ein eine einer er es für hat ich im in ist "
          "mit nach nicht noch nur oder sich sie sind so und von war wie wir zu zum zur",
    "fr": "au aux avec ce cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas "
          "plus pour qui que sa se ses son sont sur un une vous",
    "es": "al como con de del el ella en es esta este ha la las lo los más me no o para pero por que se si sin son "
          "su sus un una y",
}
_STOP = frozenset(word for some in STOP_WORDS.values() for word in some.split())

# Tag names by what they mean here.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea iframe noscript noembed noframes xmp".split())
FRAME_TAGS = frozenset(
    "nav footer aside form fieldset legend label button select dialog menu search template svg canvas object audio "
    "video map".split())
FRAME_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words in class or id that mark a part of the frame around an article.
LAYOUT_NAMES = frozenset(
    "aside breadcrumb breadcrumbs copyright footer header login masthead menu menubar nav navbar navigation navi "
    "pager pagination search sidebar skip toolbar topbar widget widgets".split())
EXTRA_NAMES = frozenset(
    "ad adbox adsbygoogle ads advert advertisement advertising adverts alert alerts banner banners comment comments "
    "commentlist consent cookie cookies disclaimer discussion disqus gdpr lightbox modal newsletter notice notices "
    "notification overlay popup promo promotion recommended related replies reply respond share sharing signup social "
    "sponsor sponsored subscribe subscription teaser teasers".split())
HEADER_NAMES = frozenset("header masthead".split())
NEGATED = frozenset("has no with without".split())

_ATTRIBUTES = r"(?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')|=)*+"
_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)(" + _ATTRIBUTES + ")>")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[^\W\d_]+")
_LONG_NUMBER = re.compile(r"&#0*+[0-9]{8,};?|&#[xX]0*+[0-9a-fA-F]{7,};?")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW_TAGS}
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Block:
    """Text of one block, white space folded, and what the rules look at."""

    text: str
    linked: int
    main: bool
    heading: bool
    title: bool
    item: bool


def decoded(text: str) -> str:
    """Character references replaced as browsers do."""
    if "&" not in text:
        return text
    return html.unescape(_LONG_NUMBER.sub("�", text))


def attributes_at(page: str, place: int) -> list[tuple[str, str]]:
    """Names in small letters and values of the attributes of the start tag whose name begins at a place."""
    m = _TAG.match(page, place)
    return [(a[1].lower(), decoded(a[2] or a[3] or a[4] or "")) for a in _ATTRIBUTE.finditer(m[3])] if m else []


def _marks(attributes: str) -> tuple[set[str], str, bool, bool]:
    """Words of class and id, the role, whether it is hidden, and whether it declares the article's body."""
    names: set[str] = set()
    role, hidden, body = "", False, False
    for m in _ATTRIBUTE.finditer(attributes):
        key = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if key in ("class", "id"):
            for one in value.split():
                parts = _NAME_PART.findall(_CAMEL.sub(" ", one).lower())
                names.update(part for k, part in enumerate(parts) if not (k and parts[k - 1] in NEGATED))
        elif key == "role":
            role = value.strip().lower()
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and _HIDDEN_STYLE.search(value):
            hidden = True
        elif key == "itemprop":
            body = value == "articleBody"
    return names, role, hidden, body


class Scanner:
    """One pass over a page: open elements, and the blocks outside the frame.

    Of each open element: its tag, whether it is inside the declared article, whether it belongs to the frame, and
    whether an article inside may end that."""

    def __init__(self):
        self.blocks: list[Block] = []
        self._open: list[tuple[str, bool, bool, bool]] = [("", False, False, False)]
        # Places of each open tag in the stack, and of all block-level ones.
        self._places: dict[str, list[int]] = {}
        self._block_places: list[int] = []
        self._parts: list[str] = []
        self._linked: list[str] = []
        self._tag = ""
        self._breaks = 0

    def _last(self, tag: str) -> int:
        places = self._places.get(tag)
        return places[-1] if places else -1

    def _flush(self) -> None:
        if self._parts:
            words = decoded_words(self._parts)
            if words:
                linked = sum(map(len, decoded_words(self._linked))) if self._linked else 0
                _, main, _, _ = self._open[-1]
                self.blocks.append(Block(" ".join(words), linked, main, self._tag in HEADINGS, self._tag == "h1",
                                         bool(self._places.get("li"))))
            self._parts, self._linked = [], []
        self._breaks = 0

    def text(self, text: str) -> None:
        if self._open[-1][2]:
            return
        self._parts.append(text)
        if self._breaks and not text.isspace():
            self._breaks = 0
        if self._places.get("a"):
            self._linked.append(text)

    def _close_to(self, place: int) -> None:
        while len(self._open) > place:
            tag = self._open.pop()[0]
            if tag:
                self._places[tag].pop()
            if self._block_places and self._block_places[-1] == len(self._open):
                self._block_places.pop()

    def _close_implied(self, tag: str) -> None:
        """Elements that a start of this tag ends."""
        if tag in BLOCK_TAGS and (place := self._last("p")) >= 0:
            self._close_to(place)
        for ended, holders in _IMPLIED.get(tag, ()):
            place = self._last(ended)
            if place > max([self._last(h) for h in holders]):
                self._close_to(place)

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._parts.append(" ")
            self._breaks += 1
            if self._breaks > 1:
                self._flush()
            return
        block = tag in BLOCK_TAGS
        if block:
            self._flush()
            self._close_implied(tag)
        if tag in VOID_TAGS:
            return
        _, main, frame, may_end = self._open[-1]
        names, role, hidden, body = _marks(attributes) if attributes and tag != "a" else (set(), "", False, False)
        declares = tag in ("article", "main") or role in ("article", "main") or body
        extra = not EXTRA_NAMES.isdisjoint(names)
        if declares or tag in ("html", "body"):
            # The article itself may be named after the layout around it, but not a comment or an advert.
            if declares and (extra or hidden):
                frame, may_end = True, False
            elif declares and frame and may_end:
                frame = False
        elif not frame:
            by_name = LAYOUT_NAMES - HEADER_NAMES if main else LAYOUT_NAMES
            if hidden or extra or tag in FRAME_TAGS or tag == "header" and not main:
                frame, may_end = True, tag == "form"
            elif role in FRAME_ROLES or not by_name.isdisjoint(names):
                frame, may_end = True, not role
        if not frame and declares:
            main = True
        place = len(self._open)
        self._open.append((tag, main, frame, may_end))
        self._places.setdefault(tag, []).append(place)
        if block:
            self._block_places.append(place)
            self._tag = tag

    def end(self, tag: str) -> None:
        block = tag in BLOCK_TAGS
        if block:
            self._flush()
            self._tag = ""
        place = self._last(tag)
        if place < 0:
            return
        if block:
            if tag not in _TABLE and place < self._last("table"):
                return
            self._close_to(place)
        elif tag in FRAME_TAGS or not self._block_places or self._block_places[-1] < place:
            self._close_to(place)
        else:
            # An inline element around blocks: its end leaves the blocks open.
            self._places[tag].pop()
            self._open[place] = ("", *self._open[place][1:])

    def finish(self) -> list[Block]:
        self._flush()
        return self.blocks


# Start tag, the elements it ends, and the elements that hold them together.
_TABLE = frozenset("table caption thead tbody tfoot tr td th".split())
_CELLS = (("td", ("table", "tr")), ("th", ("table", "tr")))
_IMPLIED = {
    "li": (("li", ("ul", "ol", "menu")),),
    "dt": (("dt", ("dl",)), ("dd", ("dl",))), "dd": (("dt", ("dl",)), ("dd", ("dl",))),
    "td": _CELLS, "th": _CELLS, "tr": (*_CELLS, ("tr", ("table",))),
    "tbody": (*_CELLS, ("tr", ("table",))), "tfoot": (*_CELLS, ("tr", ("table",))),
    "option": (("option", ("select",)),),
}


def decoded_words(parts: list[str]) -> list[str]:
    return decoded("".join(parts)).split()


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page outside its frame, in page order."""
    scanner = Scanner()
    at, n = 0, len(page)
    while at < n:
        mark = page.find("<", at)
        if mark < 0:
            scanner.text(page[at:])
            break
        if mark > at:
            scanner.text(page[at:mark])
        m = _TAG.match(page, mark + 1)
        if m:
            at = m.end()
            tag = m[2].lower()
            if m[1]:
                scanner.end(tag)
            elif tag in RAW_TAGS:
                ended = _RAW_END[tag].search(page, at)
                if not ended:
                    break
                at = page.find(">", ended.end())
                if at < 0:
                    break
                at += 1
            else:
                scanner.start(tag, m[3])
            continue
        following = page[mark + 1:mark + 2]
        if page.startswith("<!--", mark):
            at = page.find("-->", mark + 4)
            if at < 0:
                break
            at += 3
        elif following in ("!", "?", "/"):
            at = page.find(">", mark)
            if at < 0:
                break
            at += 1
        elif following.isalpha() and following.isascii():
            # A tag that never ends.
            break
        else:
            scanner.text("<")
            at = mark + 1
    return scanner.finish()


GOOD, OPEN, BAD = 1, 0, -1


def _first_pass(words: np.ndarray, stops: np.ndarray, linked: np.ndarray, main: np.ndarray, title: np.ndarray,
                item: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Labels by length, link density and stop words."""
    much_linked = linked > MAX_LINK_DENSITY
    long = (words >= MIN_WORDS) & ~much_linked
    dense = stops >= MIN_STOP_DENSITY * np.maximum(words, 1)
    known = np.zeros(page[-1] + 1, bool)
    known[page[long & dense]] = True
    label = np.full(len(words), OPEN)
    label[long & (dense | ~known[page])] = GOOD
    label[long & ~dense & known[page] & ~main] = BAD
    label[much_linked & (item | ~main)] = BAD
    label[title & main] = GOOD
    return label


def _second_pass(label: np.ndarray, heading: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Open blocks take the label of the nearest decided block of their page."""
    n = len(label)
    place = np.arange(n)
    decided = label != OPEN
    before = np.maximum.accumulate(np.where(decided, place, -1))
    after = np.minimum.accumulate(np.where(decided, place, n)[::-1])[::-1]
    has_before = (before >= 0) & (page[before] == page)
    has_after = (after < n) & (page[np.minimum(after, n - 1)] == page)
    label_before = np.where(has_before, label[before], GOOD)
    label_after = np.where(has_after, label[np.minimum(after, n - 1)], GOOD)
    far = np.int64(n + 1)
    to_before = np.where(has_before, place - before, far)
    to_after = np.where(has_after, after - place, far)
    nearest = np.where(to_before < to_after, label_before, label_after)
    nearest = np.where(to_before == to_after, np.maximum(label_before, label_after), nearest)
    nearest = np.where(heading & has_after, label_after, nearest)
    return np.where(decided, label, nearest)


def main_texts(pages: list[str]) -> list[str]:
    """The main text of each page."""
    found = [blocks_of(page) for page in pages]
    flat = [block for some in found for block in some]
    if not flat:
        return [""] * len(pages)
    page = np.repeat(np.arange(len(pages)), [len(some) for some in found])
    words = [_WORD.findall(block.text.lower()) for block in flat]
    main, heading, title, item = (np.array([getattr(block, name) for block in flat])
                                  for name in ("main", "heading", "title", "item"))
    label = _first_pass(
        np.array([len(some) for some in words]), np.array([len([w for w in some if w in _STOP]) for some in words]),
        np.array([block.linked / len(block.text) for block in flat]), main, title, item, page)
    # The declared article where it holds text; the whole page elsewhere.
    declared = np.zeros(len(pages), bool)
    declared[page[main & (label != BAD)]] = True
    inside = np.flatnonzero(main == declared[page])
    good = inside[_second_pass(label[inside], heading[inside], page[inside]) == GOOD]
    lines: list[list[str]] = [[] for _ in pages]
    for number in good.tolist():
        lines[page[number]].append(flat[number].text)
    return ["\n".join(some) for some in lines]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    schema = T.StructType([*pages.select("page_id", "url").schema, T.StructField("text", T.StringType()),
                           T.StructField("n_chars", T.LongType())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = main_texts(texts(batch, "html"))
        return pa.RecordBatch.from_arrays(
            [column_of(batch, "page_id"), column_of(batch, "url"), pa.array(found, pa.string()),
             pa.array([len(text) for text in found], pa.int64())], names=schema.names)

    return map_texts(pages.select("page_id", "url", "html"), run, schema, column="html")
