"""Main text of web pages by tag-path ratios.

A page is read into blocks, each with the path of its block elements from the root. For each path,
text length and punctuation of all its blocks are summed and set against the number of blocks:
article paragraphs share a path with much text and punctuation, menus one with little. Both ratios
are smoothed over neighbouring blocks, multiplied, and cut at a share of their standard
deviation. What is above votes for the content element: the innermost one that holds nearly
all of that text. Its blocks are the main text, but for links and what elements mark as menus,
headers, footers, sidebars, notices, adverts, forms or reader comments.

Class names and ids that sound like such parts lower the score of a block: within the content
element it stays if it still reaches the cut. An id within an article, or a name on a heading, says nothing,
since generators make ids from headings. Such blocks don't vote. Elements are numbered as they begin and know their parent, so
that all that concerns an element's inside is summed in one pass, and time grows in line with the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of the standard deviation that content reaches, of that text in the content element, of links in a block at most.
CUT, INSIDE, LINKED = 0.5, 0.9, 0.6
#: What is left of the score of a block whose class or id sounds like something else than main text.
NAMED_SHARE = 0.25

# Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe xmp noframes".split())
#: What they hold is no text of the page; they stand within a block and do not end it.
SILENT = frozenset("template svg math object select button option audio video canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big center cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
DROPPED = frozenset("nav footer aside form menu dialog header fieldset".split())
#: Elements that end where another one begins.
ENDS = {
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}),
    "th": frozenset({"td", "th"}),
}
#: Elements beyond which none is ended so.
HOLDERS = frozenset({"ul", "ol", "dl", "table", "menu"})
HEADINGS = frozenset({"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"})
ARTICLES = frozenset({"article", "main"})
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|"
    r"foot|footer|masthead|site-header|page-header|topbar|comments?|comment-\w+|replies|reply|respond|disqus|discussion|share|sharing|social|related|recommend\w*|"
    r"newsletter|subscri\w+|popup|modal|overlay|login|signin|signup|search|pagination|pager|copyright|legal|widget|toolbar|skip-link|hidden)(?:$|[\s_-])",
    re.I,
)
#: Class names that tell what a page has beside or in an element, not what the element is.
STATES = re.compile(r"(?:^|(?<=[\s_-]))(?:with|without|no|has|is|not)[_-][a-z]+", re.I)
#: Readers' comments are no main text, however long: by class, and by ids that are no heading's.
REPLIES = re.compile(r"(?:^|[\s_-])(?:comments?|comment-\w+|replies|reply|respond|disqus|discussion)(?:$|[\s_-])", re.I)
THREADS = re.compile(r"\s*(?:comments?(?:[-_]?(?:list|section|area|thread|\d+))?|replies|respond|disqus(?:[-_]thread)?)\s*", re.I)
#: Share of a page's text from which an element is content in spite of its class or id.
MOST = 0.5
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
# A quote counts after an equals sign only.
_REST = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*'|(?!["'])))*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_STOPS = re.compile(r"[.,;:!?、。，：；！？]")
_ZEROS, _BEYOND = re.compile(r"&#0+(?=[0-9])"), re.compile(r"&#[0-9]{8,};?")

SURE, REPLY, NAMED = 3, 2, 1


def _mark(tag: str, attributes: str, in_article: bool) -> int:
    """How an element is marked as no main text: surely by its name or role, as readers' comments, or by class or id; 0 if not."""
    if tag in SILENT or tag in RAW or tag in DROPPED and not (tag == "header" and in_article):
        return SURE
    mark = 0
    for name, *values in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name not in ("class", "id", "role", "hidden", "aria-hidden"):
            continue
        value = "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "role" and value.lower() in ROLES:
            return SURE
        if name in ("class", "id") and tag not in ARTICLES and tag not in HEADINGS:
            replies = REPLIES.search(STATES.sub(" ", value)) if name == "class" else THREADS.fullmatch(value)
            if replies:
                mark = REPLY
            elif not (name == "id" and in_article) and MARKED.search(STATES.sub(" ", value)):
                mark = max(mark, NAMED)
    return mark


def _decoded(text: str) -> str:
    """Text with character references replaced, white space as one space, trimmed."""
    if "&" in text:
        text = html.unescape(_BEYOND.sub("\ufffd", _ZEROS.sub("&#", text)))
    return " ".join(text.split())


class Page:
    """Elements of a page in the order in which they begin, and its blocks of text in page order.

    Element 0 is the root. Of each element: tag, parent, number of its path of tags, mark, and whether it is or lies in
    an article or main. Of each block: element, text, and how many characters are link text. What an element
    surely marks as something else has no blocks.
    """

    def __init__(self, page: str):
        self.tags, self.parents, self.paths, self.marks, self.article = [""], [0], [0], [0], [False]
        self.at, self.texts, self.linked = [], [], []
        self._names: dict[tuple[int, str], int] = {}
        self._stack = [0]
        self._open: dict[str, int] = {}
        self._stops: list[int] = []  # depths of open elements that end others or keep them from being ended
        self._buffer: list[str] = []
        self._sure, self._link, self._link_size = 0, 0, 0
        self._read(page)

    def _say(self, text: str) -> None:
        if text and not self._sure:
            self._buffer.append(text)
            if self._link:
                self._link_size += len(_decoded(text))

    def _close(self) -> None:
        if self._sure or not self._buffer:
            return
        text = _decoded("".join(self._buffer))
        if text:
            self.at.append(self._stack[-1])
            self.texts.append(text)
            self.linked.append(self._link_size)
        self._buffer, self._link_size = [], 0

    def _push(self, tag: str, attributes: str) -> None:
        above = self._stack[-1]
        in_article = self.article[above]
        # The root of a page is never marked.
        mark = 0 if tag in ("html", "body") else _mark(tag, attributes, in_article)
        if tag not in SILENT and tag not in RAW:
            self._close()
        if tag in ENDS or tag in HOLDERS:
            self._stops.append(len(self._stack))
        path = (self.paths[above], tag)
        self._stack.append(len(self.tags))
        self.tags.append(tag)
        self.parents.append(above)
        self.paths.append(self._names.setdefault(path, len(self._names) + 1))
        self.marks.append(mark)
        self.article.append(in_article or tag in ARTICLES)
        self._open[tag] = self._open.get(tag, 0) + 1
        self._sure += mark == SURE

    def _pop_to(self, depth: int) -> None:
        """End the elements from this depth on. A link ends with the element that it began in."""
        while len(self._stack) > depth:
            self._close()
            number = self._stack.pop()
            self._open[self.tags[number]] -= 1
            self._sure -= self.marks[number] == SURE
            if self._stops and self._stops[-1] == len(self._stack):
                self._stops.pop()
            if self._link > len(self._stack):
                self._link = 0

    def _ended(self, tag: str) -> None:
        if tag == "a":
            self._link = 0
        if tag in INLINE or tag in VOID:
            return
        if self._open.get(tag):
            depth = len(self._stack) - 1
            while self.tags[self._stack[depth]] != tag:
                depth -= 1
            self._pop_to(depth)
        else:
            self._close()

    def _begun(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag in ("br", "hr"):
                self._say(" ")
            return
        if tag in INLINE:
            if tag == "a" and re.search(r"\bhref\b", attributes, re.I):
                self._link = len(self._stack)
            return
        if tag not in SILENT and tag not in RAW and self.tags[self._stack[-1]] == "p":
            self._pop_to(len(self._stack) - 1)
        if tag in ENDS:
            for depth in reversed(self._stops):
                if self.tags[self._stack[depth]] in ENDS[tag]:
                    self._pop_to(depth)
                    break
                if self.tags[self._stack[depth]] in HOLDERS:
                    break
        if not attributes.rstrip().endswith("/"):
            self._push(tag, attributes)

    def _read(self, page: str) -> None:
        """Read a page. Each search for an end moves on or, once it finds nothing, is not made again."""
        at, quotes, endless = 0, True, set()
        while True:
            begin = page.find("<", at)
            end = page.find(">", begin) if begin >= 0 else -1
            if end < 0:
                # No tag ends any more; a comment without end reaches to the end of the page.
                comment = page.find("<!--", at)
                self._say(page[at:] if comment < 0 else page[at:comment])
                break
            self._say(page[at:begin])
            if page.startswith("<!--", begin):
                end = page.find("-->", begin + 4)
                if end < 0:
                    break
                at = end + 3
                continue
            if page[begin + 1] in "!?":
                at = end + 1
                continue
            name = _NAME.match(page, begin + 1, end)
            if name is None:
                self._say("<")
                at = begin + 1
                continue
            rest = _REST.match(page, name.end()) if quotes and end > name.end() else None
            if rest is None:
                # A quote without end: from here on tags end at the next ">", whatever is quoted.
                quotes = quotes and end == name.end()
                attributes, at = page[name.end() : end], end + 1
            else:
                attributes, at = rest[1], rest.end()
            tag = name[2].lower()
            if name[1]:
                self._ended(tag)
                continue
            if tag in RAW and tag not in endless and not attributes.rstrip().endswith("/"):
                closing = re.compile(rf"</{tag}\s*+>", re.I).search(page, at)
                if closing:
                    at = closing.end()
                    continue
                endless.add(tag)  # It ends with its parent.
            self._begun(tag, attributes)
        self._pop_to(1)
        self._close()

    def summed(self, values: list[int] | np.ndarray) -> list[int]:
        """Of each element, the sum of values of the blocks within it."""
        sums = [0] * len(self.tags)
        for at, value in zip(self.at, values, strict=True):
            sums[at] += int(value)
        for number in range(len(sums) - 1, 0, -1):
            sums[self.parents[number]] += sums[number]
        return sums

    def last(self) -> list[int]:
        """Of each element, the last element within it, which may be itself."""
        last = list(range(len(self.tags)))
        for number in range(len(last) - 1, 0, -1):
            last[self.parents[number]] = max(last[self.parents[number]], last[number])
        return last

    def keep(self, kept: list[bool]) -> None:
        """Keep some of the blocks."""
        self.at, self.texts, self.linked = ([x for x, k in zip(xs, kept, strict=True) if k] for xs in (self.at, self.texts, self.linked))


def _smooth(values: np.ndarray) -> np.ndarray:
    """Gaussian weights over the block before and after."""
    padded = np.pad(values, 1, mode="edge")
    return 0.25 * padded[:-2] + 0.5 * padded[1:-1] + 0.25 * padded[2:]


def scores(paths: list[int], texts: list[str], linked: list[int], named: list[bool]) -> np.ndarray:
    """Fused path ratio of each block, lowered where a class or id sounds like something else."""
    path = np.unique(np.array(paths), return_inverse=True)[1]
    length = np.array([max(0, len(t) - k) for t, k in zip(texts, linked, strict=True)], dtype=np.float64)
    stops = np.array([len(_STOPS.findall(t)) for t in texts], dtype=np.float64)
    many = np.bincount(path)
    text_ratio, stop_ratio = (np.bincount(path, weights=x) / many for x in (length, stops))
    # Each block counts by its path and by itself.
    text, stop = np.sqrt(text_ratio[path] * length), np.sqrt(stop_ratio[path] * stops)
    return _smooth(text) * (1 + _smooth(stop)) * np.where(named, NAMED_SHARE, 1.0)


def _named(page: Page) -> list[bool]:
    """Drop readers' comments; of each block left, whether a class or id sounds like something else.

    A name does not count on an element that an article or main lies in, nor on one that holds most of the
    text. If only comments are there, or most of the text would be named, no name counts.
    """
    own = [max(0, len(t) - k) for t, k in zip(page.texts, page.linked, strict=True)]
    held, total = page.summed(own), sum(own)
    blocks_in = page.summed([1] * len(own))
    around = [False] * len(page.tags)
    for number in range(len(page.tags) - 1, 0, -1):
        above = page.parents[number]
        around[above] = around[above] or around[number] or page.tags[number] in ARTICLES and blocks_in[number] > 0
    marks = [0] * len(page.tags)
    for number in range(1, len(marks)):
        mark = page.marks[number]
        if mark == NAMED and (around[number] or held[number] >= MOST * total):
            mark = 0
        marks[number] = max(mark, marks[page.parents[number]])
    kept = [marks[at] < REPLY for at in page.at]
    if not any(kept):
        return [False] * len(kept)
    page.keep(kept)
    named = [marks[at] == NAMED for at in page.at]
    own = [max(0, len(t) - k) for t, k in zip(page.texts, page.linked, strict=True)]
    if sum(size for size, n in zip(own, named, strict=True) if n) >= MOST * sum(own):
        named = [False] * len(named)
    return named


def _content(page: Page, kept: list[bool], good: list[bool]) -> int:
    """The content element: 0 if the whole page is.

    It is the innermost one with nearly all text that votes (good); if that is one block, its parent; then the article
    or main that it lies in, or its outermost parent that adds mostly content: blocks that vote, are on a path of votes
    or are headings.
    """
    sizes = [len(t) for t in page.texts]
    voted = page.summed([s if g else 0 for s, g in zip(sizes, good, strict=True)])
    # An element with nearly all of the text has only one child that can have it too.
    content = max(n for n, size in enumerate(voted) if size >= INSIDE * voted[0])
    if page.summed(kept)[content] == 1 and page.parents[content]:
        content = page.parents[content]
    chain = [content]
    while chain[-1]:
        chain.append(page.parents[chain[-1]])
    for wanted in ("article", "main"):
        for number in chain:
            if page.tags[number] == wanted:
                return number
    heading = [False] * len(page.tags)
    for number in range(1, len(heading)):
        heading[number] = heading[page.parents[number]] or page.tags[number] in HEADINGS
    paths = {page.paths[at] for at, g in zip(page.at, good, strict=True) if g}
    every = page.summed([s if k else 0 for s, k in zip(sizes, kept, strict=True)])
    like = page.summed([s if k and (page.paths[at] in paths or heading[at]) else 0 for s, k, at in zip(sizes, kept, page.at, strict=True)])
    for inner, outer in pairwise(chain):
        if page.tags[outer] in ("", "html", "body") or 2 * (like[outer] - like[inner]) < every[outer] - every[inner]:
            return inner
    return content


def main_text(text: str | None) -> str:
    """The main text of one page; empty if there is none."""
    page = Page(text or "")
    if not page.texts:
        return ""
    named = _named(page)
    link = [k >= LINKED * len(t) for t, k in zip(page.texts, page.linked, strict=True)]
    kept = [not x for x in link]
    if not any(kept):
        kept = [page.article[at] for at in page.at]
    if not any(kept):
        return ""
    paths = [page.paths[at] for at in page.at]
    score = scores(*([x for x, k in zip(xs, kept, strict=True) if k] for xs in (paths, page.texts, page.linked, named)))
    votes = score >= CUT * score.std()
    if not votes.any():
        votes[:] = True
    told = iter(votes.tolist())
    good = [next(told) if k else False for k in kept]
    # What is named as something else has no say in where the content is.
    voters = [g and not n for g, n in zip(good, named, strict=True)]
    if not any(voters):
        voters = [k and not n for k, n in zip(kept, named, strict=True)]
    content = _content(page, kept, voters if any(voters) else kept)
    last = page.last()[content]
    # Links of a menu lie on a path of links; an article's own blocks of links are part of it.
    size, linked = {}, {}
    for path, block, k in zip(paths, page.texts, page.linked, strict=True):
        size[path], linked[path] = size.get(path, 0) + len(block), linked.get(path, 0) + k
    out = []
    for k, (at, path) in enumerate(zip(page.at, paths, strict=True)):
        if content <= at <= last and (not link[k] or page.article[at] or linked[path] < LINKED * size[path]) and (good[k] or not named[k]):
            out.append(page.texts[k])
    return "\n\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """The columns page_id and url of pages, text and n_chars (its code points).

    One row for each row of pages. A null or empty page, or one without main text, gives an empty text. Other
    columns are not read.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    narrow = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = dict(narrow.dtypes)
    return narrow.mapInArrow(read, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
