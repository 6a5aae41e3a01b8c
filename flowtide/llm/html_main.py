"""Main text of web pages as the maximum-scoring run of words and tags.

A page becomes a sequence of tags and stretches of text. Words score positive and tags negative by
default; the weights are log-odds learned from labelled pages: a word's weight depends on its innermost
container (tag and class, backing off to the tag), a tag's on its name. Labelled pages are those that
mark their content themselves with one article or main element, out of a sample of about ``LABELLED`` pages
(those with the smallest key hashes); the labels are never read when a page is scored. One scan of running sums finds the best
contiguous region. Elements inside it that are no content (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, comments) are left out. A notice, sidebar or form by its class or name that holds
an article or main element, or most words of a page without one, is none: the weights decide. Within an article or main
element a name that may as well belong to the text (header, side, legal; notice or search on a heading or a word) is no
verdict either, and what is left out there costs the region nothing. An open head ends where other elements or text begin.
Time is linear in the page: a tag ends at the next ``<`` outside of quotes, and end tags are looked up once. Character references are decoded, white space
in a block becomes one space, blocks are joined by one space.

A null or empty page, or one without any positive run, has the empty text. Unclosed and stray tags are
tolerated. Rows are independent: repeated rows repeat, ties between regions go to the first one, an
empty table gives an empty result, without labelled pages the default weights hold. Only page_id, url
and html are read.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtide.llm.tables import slices

LABELLED = 4000
WORD, TAG, DROPPED = 1.0, -1.0, -2.0
LIMIT = 6.0

CONTENT = ("article", "main")
RAW = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "object", "canvas", "math")
NO_CONTENT = frozenset(RAW) | {
    "head", "title", "nav", "header", "footer", "aside", "form", "button", "select", "option", "input",
    "menu", "dialog", "fieldset", "audio", "video"}
CONTAINERS = NO_CONTENT | {"html", "body", "article", "main", "section", "div", "ul", "ol", "dl", "table", "figure",
                           "blockquote", "td", "details"}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
_NOISE = (
    r"(?:ads?|advert~|sponsor~|promo~|banner~|cookie~|consent|notice~|popup|modal|nav~|menu~|breadcrumb~|header|masthead|"
    r"footer|sidebar~|side|widget~|related|share~|sharing|social|comment~|disqus|respond|repl(?:y|ies)|newsletter|"
    r"subscribe~|signup|login|search|pagination|pager|toolbar|copyright|legal)")
_PLACE = (r"(?:site|page|main|top|bottom|left|right|global|primary|secondary|mobile|desktop|post|entry|article|box|bar|lists?|"
          r"links?|items?|blocks?|area|wrap|wrapper|container|section|inner|buttons?|icons?|text|title|content|panel|slot|"
          r"unit|\d[^\W_]*)")


def _noise(*left_out: str) -> re.Pattern:
    """A whole token of class, id or role that names a notice, menu or the like; states (no-sidebar, comment-open) do not."""
    names = [n for n in _NOISE[3:-1].split("|") if n.rstrip("~") not in left_out]
    noise = f"(?:{'|'.join(names)})".replace("~", r"[^\W_]*")
    return re.compile(rf"(?:^|(?<=\s))(?:{_PLACE}[_-]+)*{noise}(?:[_-]+(?:{noise}|{_PLACE}))*(?=\s|$)", re.IGNORECASE)


#: Within an article some names may belong to its text: of any element, and of headings and words.
NOISE = _noise()
NOISE_IN_TEXT = _noise("header", "side", "legal")
NOISE_ON_WORDS = _noise("header", "side", "legal", "notice", "search", "consent")
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
IN_HEAD = frozenset("head title base basefont bgsound link meta script style noscript noframes template".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.DOTALL)
_ATTRIBUTE = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
_CUT_OFF = re.compile(r"</?[a-zA-Z][^<>]*\Z")
_END = {name: re.compile(rf"</{name}[\s/>]", re.IGNORECASE) for name in RAW}


_BLOCK_START = re.compile(rf"</?(?:p|li|h[1-6]|dt|dd|tr|{'|'.join(sorted(CONTAINERS))})[\s/>]", re.IGNORECASE)


@lru_cache(maxsize=256)
def _close(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}[\s/>]", re.IGNORECASE)


class Finder:
    """Next matches of patterns in a page for places that only move on: each stretch of the page is searched once."""

    def __init__(self, page: str) -> None:
        self.page, self.next = page, {}

    def start(self, pattern: re.Pattern, at: int) -> int | None:
        known = self.next.get(pattern, -1)
        if known is not None and known < at:
            found = pattern.search(self.page, at)
            known = self.next[pattern] = found.start() if found else None
        return known


class Token:
    """A tag (``text`` is None) or a stretch of text."""

    __slots__ = ("text", "name", "container", "dropped", "content", "hard")

    def __init__(self, text: str | None, name: str, container: str, dropped: bool, content: bool, hard: bool = False) -> None:
        self.text, self.name, self.container, self.dropped, self.content = text, name, container, dropped, content
        self.hard = hard  # dropped by the kind of element, not by its class


def tokens(page: str) -> list[Token]:
    """The page as tags and texts, each with its innermost container and whether it is dropped or labelled.

    An element whose class speaks of noise, or a form, stays if it holds an article or main element, or most words of
    a page without one.
    """
    out, noisy, articles = _parsed(page, frozenset())
    if not noisy:
        return out
    words = list(accumulate((0 if t.text is None or t.hard else len(t.text.split()) for t in out), initial=0))
    spared = frozenset(at for at, low, high in noisy if bisect_left(articles, low) < bisect_left(articles, high)
                       or not articles and 2 * (words[high] - words[low]) > words[-1])
    return _parsed(page, spared)[0] if spared else out


def _parsed(page: str, spared: frozenset[int]) -> tuple[list[Token], list[list[int]], list[int]]:
    """The tokens; place in the page, first and end token of each element dropped as noise; the articles' tokens."""
    out: list[Token] = []
    noisy: list[list[int]] = []
    articles: list[int] = []
    # name, key, dropped, content, hard, its number among the noisy
    stack: list[tuple[str, str, bool, bool, bool, int]] = [("", "", False, False, False, -1)]
    opened: Counter[str] = Counter()
    at, size, finder = 0, len(page), Finder(page)

    def pop() -> tuple:
        opened[stack[-1][0]] -= 1
        return stack.pop()

    def text(part: str) -> None:
        if part:
            if stack[-1][0] == "head" and part.strip():
                pop()
            _, key, dropped, content, hard, _ = stack[-1]
            out.append(Token(part, "", key, dropped, content, hard))

    def noise(start: int) -> int:
        noisy.append([start, len(out), size])
        return len(noisy) - 1

    while at < size:
        found = _PIECE.search(page, at)
        if not found:
            break
        text(page[at:found.start()])
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if stack[-1][0] == "head" and name not in IN_HEAD and not found["close"]:
            pop()  # </head> may be left out
        _, key, dropped, content, hard, _ = stack[-1]
        if found["close"]:
            if name in CONTAINERS and opened[name] > 0:
                while True:
                    ended = pop()
                    if ended[5] >= 0:
                        noisy[ended[5]][2] = len(out)
                    if ended[0] == name:
                        break  # what was not closed ends here
            out.append(Token(None, "/" + name, stack[-1][1], stack[-1][2], stack[-1][3]))
            continue
        rest = found["rest"]
        marks = " ".join(a or b or c for a, b, c in _ATTRIBUTE.findall(rest))
        hard = hard or name in NO_CONTENT and name != "form" or bool(_HIDDEN.search(rest))
        names_noise = (NOISE if not content else NOISE_ON_WORDS if name in INLINE or name in HEADINGS else NOISE_IN_TEXT)
        named = bool(names_noise.search(marks))
        soft = not hard and found.start() not in spared and (
            name == "form" or named and name not in ("html", "body", *CONTENT))
        gone = dropped or hard or soft
        if name in CONTENT and not hard and not named:
            articles.append(len(out))
        if name in RAW:
            if not rest.endswith("/"):
                end = finder.start(_END[name], at)
                at = size if end is None else end
            out.append(Token(None, name, key, True, content, True))
            continue
        number = noise(found.start()) if soft and name not in VOID else -1
        out.append(Token(None, name, key, gone, content, hard))
        if name in VOID:
            continue
        if name in CONTAINERS:
            opened[name] += 1
            stack.append((name, f"{name}.{marks}" if marks else name, gone, content or name in CONTENT, hard, number))
        elif gone and not dropped:  # a paragraph, item or inline element that is no content: up to its end
            stop = finder.start(_BLOCK_START, at) if name not in INLINE else None
            ends = [x for x in (finder.start(_close(name), at), stop) if x is not None]
            if ends:
                part = page[at:min(ends)]
                if part:
                    out.append(Token(re.sub(r"<[^>]*>", " ", part), "", f"{name}.{marks}", True, content, hard))
                at = min(ends)
            if number >= 0:
                noisy[number][2] = len(out)
        elif number >= 0:
            noisy[number][2] = len(out)
    text(_CUT_OFF.sub("", page[at:]))
    for element in noisy:
        element[2] = min(element[2], len(out))
    return out, noisy, articles


def features(token: Token) -> tuple[str, str]:
    """The exact feature of a token and the one it backs off to."""
    if token.text is None:
        return f"t:{token.name}", "t:"
    return f"w:{token.container}", f"w:{token.container.partition('.')[0]}"


class Weights:
    """Scores of words and tags, with defaults for what training has not met."""

    def __init__(self, learned: dict[str, float] | None = None) -> None:
        self.learned = learned or {}

    def of(self, token: Token) -> float:
        n = 1 if token.text is None else len(token.text.split())
        if token.dropped:  # inside an article it parts nothing
            return 0.0 if token.content else DROPPED if token.text is None else TAG * n
        exact, wide = features(token)
        base = self.learned.get(exact)
        if base is None:
            base = self.learned.get(wide) if wide != "t:" else None
        return n * (base if base is not None else TAG if token.text is None else WORD)


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and end position of the contiguous run with the largest positive sum."""
    best, low, high = 0.0, 0, 0
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, low, high = total, start, i + 1
    return low, high


def main_text(page: str | None, weights: Weights) -> str:
    """The text of the best run of a page, without the elements that are no content."""
    if not page:
        return ""
    parts = tokens(page)
    low, high = best_run([weights.of(t) for t in parts])
    text = []
    for t in parts[low:high]:
        if t.text is None:
            if t.name.lstrip("/") not in INLINE:
                text.append(" ")
        elif not t.dropped:
            text.append(entities.unescape(t.text))
        else:
            text.append(" ")
    return " ".join("".join(text).split())


def is_labelled(parts: list[Token]) -> bool:
    """Whether a page marks its content itself, with one article or else one main element."""
    names = Counter(t.name for t in parts if t.name in CONTENT)
    return names["article"] == 1 or not names["article"] and names["main"] == 1


def sampled(pages: DataFrame, about: int = LABELLED) -> DataFrame:
    """The html of about ``about`` pages, those with the smallest key hashes.

    The share of hashes follows from the number of pages, so no page travels and the sample keeps its size.
    """
    share = min(1.0, about / max(1, pages.count()))
    return (pages.filter(F.pmod(F.xxhash64(F.col("page_id").cast("long"), F.lit(5)), F.lit(1 << 40)) < share * (1 << 40))
            .filter("html is not null").select(F.col("html").cast("string").alias("html")))


def fit(pages: DataFrame, about: int = LABELLED) -> Weights:
    """Log-odds of words and tags inside against outside the labelled content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                parts = tokens(page)
                for t in parts if is_labelled(parts) else ():
                    if not t.dropped:
                        n = 1 if t.text is None else len(t.text.split())
                        for name in set(features(t)):
                            (inside if t.content else outside)[name] += n
        names = sorted({*inside, *outside})
        yield pa.RecordBatch.from_pydict({
            "name": pa.array(names, pa.string()), "inside": pa.array([inside[x] for x in names], pa.int64()),
            "outside": pa.array([outside[x] for x in names], pa.int64())})

    rows = (sampled(pages, about).mapInArrow(run, "name string, inside long, outside long")
            .groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
            .filter("inside + outside > 0").collect())  # features of about `about` pages
    learned = {}
    for r in rows:
        odds = math.log((r["inside"] + 0.5) / (r["outside"] + 0.5))
        odds = max(-LIMIT, min(LIMIT, odds))
        # Tags stay costs: they only differ in how much they cost.
        learned[r["name"]] = odds if r["name"].startswith("w:") else min(-0.05, TAG * (1 + max(-0.9, -odds / LIMIT)))
    return Weights(learned)


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """page_id, url and main text of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)  # features of a bounded number of pages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(x, shared.value) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(x) for x in texts], pa.int64())})

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
