"""Main text of HTML pages from flat text blocks and a decision tree.

A page is read once, from tag to tag, into a flat list of blocks: runs of text
between block-level tags.  A block is described by its word count and link
density, the same of its neighbours, and one hint of what its tags say: 1 inside
an article, 0 nothing, -1 inside a wrapper named for something else on a page
without an article, -2 inside an element made for something else, or a thing so
named in or beside an article.  A decision tree, trained on the small labelled table below, keeps or drops it.
No hint decides alone: the table has both labels under each.  Long prose among
long prose stays under a misleading mark, and runs of bare links go from an
article too.

Text is decoded, its white space becomes single spaces, and the kept blocks are
joined by a space.  Scripts, styles and comments in the markup are no text,
nor is what stands in the head, in choices, drawings and other objects; where
their end tag is left out, they end as in a browser: with their parent, at the
body, or at once if self-closed.  Hidden elements and reader comments are no
text of the page either: a comment reads like an article, only its mark tells.

Edge cases: null or empty html gives an empty text; a script, style, textarea,
title or comment that is never closed ends with the page; a page without tags is one block; a null page_id or url is
carried along; repeated rows are rows of their own; a page of any length is
read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import lean, slices, small_batches

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "hint"]
#: Labelled blocks, in the order of FEATURES, then 1 for main text.
LABELLED = """
120 0.00   80 0.00   95 0.00  1 1
 60 0.02  120 0.00    0 0.00  1 1
  1 0.00   70 0.00   40 0.00  1 1
  2 0.00    9 0.00    0 0.00  1 1
  9 0.00    6 1.00  110 0.00  1 1
  4 0.00   50 0.00   60 0.00  1 1
  3 0.00    0 0.00    0 0.00  1 1
 14 0.50   80 0.00   90 0.00  1 1
  6 1.00   75 0.00   33 0.00  1 1
  2 1.00   40 0.00   60 0.00  1 1
  5 0.00    5 0.00    5 0.00  1 1
 45 0.10   30 0.00    2 0.00  1 1
  1 0.00    2 0.00   17 0.00  1 1
  1 0.00    2 0.50    2 0.50  1 1
  2 0.50    1 0.00    2 1.00  1 1
  2 0.00    2 1.00   20 0.00  1 1
  1 0.00    8 1.00    1 1.00  1 1
  1 0.00    1 1.00    1 1.00  1 1
 60 0.00    1 1.00    8 1.00  1 1
 33 0.10    3 0.00    1 1.00  1 1
  4 0.00    2 0.00    3 0.00  1 1
  3 0.00    1 1.00    2 1.00  1 1
  1 0.00    1 0.00    1 0.00  1 1
 10 0.60   12 0.80   15 0.70  1 1
  6 0.00    3 1.00    1 0.00  1 1
  2 1.00    1 1.00    1 1.00  1 0
  1 1.00    2 1.00    2 1.00  1 0
  3 1.00    3 1.00    4 1.00  1 0
  6 1.00    5 1.00    7 1.00  1 0
  1 1.00    1 1.00   60 0.00  1 0
  2 1.00    3 1.00    0 0.00  1 0
  5 1.00    6 1.00    2 0.00  1 0
  4 1.00    2 1.00   12 0.00  1 0
150 0.00   60 0.00   40 0.00  0 1
 90 0.05    8 0.00   70 0.00  0 1
 45 0.00   70 0.02   55 0.00  0 1
 30 0.10   25 0.00   35 0.00  0 1
 22 0.00   80 0.00    4 0.00  0 1
 18 0.00   60 0.00   50 0.00  0 1
 16 0.00    9 0.00   12 0.00  0 1
 12 0.00   40 0.00   30 0.00  0 1
  6 0.00   50 0.00   45 0.00  0 1
  2 0.00   60 0.00   35 0.00  0 1
  3 0.00   45 0.00   80 0.00  0 1
  9 0.00    2 1.00   80 0.00  0 1
  3 0.00    1 1.00   51 0.00  0 1
  3 0.00    1 1.00   30 0.00  0 1
  4 0.00    0 0.00   25 0.00  0 1
 11 0.00    0 0.00    0 0.00  0 1
 25 0.00    0 0.00    2 1.00  0 1
  5 0.00   60 0.00   70 0.00  0 1
  7 0.00    1 1.00   40 0.00  0 1
  1 1.00    1 1.00    1 1.00  0 0
  2 1.00    2 1.00    2 1.00  0 0
  3 1.00    1 1.00   60 0.00  0 0
  4 1.00   70 0.00    2 1.00  0 0
  8 0.90    5 0.80    9 1.00  0 0
 20 0.80   10 0.90   10 0.80  0 0
 35 0.70    4 1.00    3 1.00  0 0
 15 0.60   60 0.00    2 1.00  0 0
  4 0.00    1 1.00    1 1.00  0 0
  3 0.00    2 1.00    4 1.00  0 0
  2 0.00    3 0.00    4 0.00  0 0
  6 0.00    2 0.00    3 1.00  0 0
  5 0.20    4 0.00    0 0.00  0 0
  4 0.00    2 1.00    3 0.00  0 0
  2 1.00   17 0.00    0 0.00  0 0
  3 1.00   45 0.00    0 0.00  0 0
  5 1.00    0 0.00   70 0.00  0 0
  9 0.80    0 0.00    6 0.00  0 0
  3 0.00    3 1.00    0 0.00  0 0
  2 0.00    0 0.00    2 0.00  0 0
  4 0.50   30 0.00    5 0.60  0 0
  1 1.00   25 0.00    1 0.00  0 0
  2 0.00   12 1.00   20 0.90  0 0
 75 0.00   65 0.00   80 0.00 -1 1
 75 0.00  300 0.00  400 0.00 -1 1
400 0.00   90 0.00  600 0.00 -1 1
 90 0.00   70 0.00  300 0.00 -1 1
 65 0.00  120 0.00  110 0.00 -1 1
 70 0.00  900 0.00   70 0.00 -1 1
160 0.00  150 0.00  200 0.00 -1 1
120 0.02   90 0.00   70 0.00 -1 1
220 0.00  140 0.05   95 0.00 -1 1
 80 0.04  110 0.00   64 0.00 -1 1
  8 0.00   40 0.00   12 0.00 -1 0
  4 0.00 2300 0.00 1800 0.00 -1 0
 12 0.00  150 0.00  180 0.00 -1 0
 25 0.00  300 0.00  120 0.00 -1 0
  1 0.00  110 0.00   90 0.00 -1 0
 40 0.00  200 0.00  500 0.00 -1 0
 50 0.00  130 0.00   95 0.00 -1 0
  7 0.00   90 0.00  400 0.00 -1 0
 16 0.00   70 0.00   85 0.00 -1 0
 20 0.00   90 0.00   70 0.00 -1 0
 45 0.00   90 0.00   80 0.00 -1 0
 40 0.00   90 0.00   20 0.00 -1 0
 95 0.02   12 0.10   70 0.00 -1 0
 90 0.00  110 0.00   10 0.00 -1 0
 70 0.70   80 0.00   75 0.00 -1 0
130 0.40   90 0.00   90 0.10 -1 0
 14 0.00   60 0.00    0 0.00 -1 0
  3 0.00    8 0.00   10 0.30 -1 0
 20 0.40    2 1.00   15 0.00 -1 0
  5 0.00    0 0.00    2 1.00 -1 0
  1 1.00    1 1.00    8 0.00 -1 0
220 0.00  180 0.00  240 0.00 -2 1
230 0.00  600 0.00  700 0.00 -2 1
900 0.00 1200 0.00  700 0.00 -2 1
210 0.00  160 0.00  150 0.00 -2 1
260 0.00  170 0.00  900 0.00 -2 1
300 0.03  210 0.00  190 0.02 -2 1
450 0.00  320 0.05  260 0.00 -2 1
  8 0.00   40 0.00   12 0.00 -2 0
120 0.00  300 0.00  400 0.00 -2 0
160 0.00  250 0.00  250 0.00 -2 0
 60 0.00  500 0.00  800 0.00 -2 0
  2 0.00 2300 0.00 1800 0.00 -2 0
 10 0.00  200 0.00  150 0.00 -2 0
 24 0.00  400 0.00   90 0.00 -2 0
  5 0.00   90 0.00  170 0.00 -2 0
 45 0.00  140 0.00  130 0.00 -2 0
 90 0.00  300 0.00  120 0.00 -2 0
  1 0.00  120 0.00  300 0.00 -2 0
 70 0.00  160 0.00  220 0.00 -2 0
 30 0.00   90 0.00   70 0.00 -2 0
 75 0.00   60 0.00   60 0.00 -2 0
 90 0.00  250 0.00  200 0.00 -2 0
120 0.00  100 0.00  110 0.00 -2 0
240 0.00  200 0.00   20 0.00 -2 0
230 0.00   15 0.00  190 0.00 -2 0
  2 1.00   50 0.00    2 1.00 -2 0
  3 0.00   20 0.00   20 0.00 -2 0
 25 0.05   14 0.00   18 0.00 -2 0
 12 0.00    3 0.00   60 0.00 -2 0
  1 1.00    1 1.00    1 1.00 -2 0
  8 0.00    1 1.00    9 0.00 -2 0
"""

#: Elements of plain text, up to their end tag, and elements with markup, whose text is not the page's own.
RAW = set("script style textarea title".split())
NOT_TEXT = set("noscript template select option iframe object svg canvas head".split())
#: What a head may hold: any other start ends it.  Elements that are followed only as parents.
IN_HEAD = RAW - {"textarea"} | set("base basefont bgsound link meta noscript template head".split())
FOLLOWED = {"datalist", "optgroup", "foreignobject"}
#: Starts that end a drawing.
NOT_DRAWN = set("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 hr i img li main menu article section ol p pre ruby
s small span strong strike sub sup table tt u ul var""".split())
#: Elements, and class, id or role words, that say the same.
ASIDE = set("nav footer aside form button menu dialog fieldset label input".split())
SAYS_ASIDE = set("""ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner nav navbar navigation
menu breadcrumb breadcrumbs sidebar sidebars widget widgets aside footer header masthead topbar cookie cookies consent gdpr notice notices notification
alert popup modal overlay newsletter subscribe subscription signup login search form comment comments reply replies disqus discussion
respond share sharing social related recommended recommendations pagination pager toolbar skip hidden legal copyright contentinfo complementary""".split())
SAYS_COMMENT = set("comment comments reply replies".split())
#: Words that alone say nothing inside an article, and what may follow the word that names a thing.
UNSURE = {"discussion", "notice", "notices"}
TAIL = set("list item items box links link buttons button bar area form".split())
BLOCK = set("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: A start that an open element of its kind ends, and what it does not reach across.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "optgroup": {"option", "optgroup"}}
FENCE = set("article aside body datalist div dl footer form header html main nav ol section select table ul".split())

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)")
#: In a tag: a quoted value, which may hold < and > and is of any length, or the tag's end.
INSIDE = re.compile(r"=\s*([\"'])|[<>]")
OTHER = re.compile(r"<[!?/][^<>]*>")
RAW_END = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in RAW}
MARKS = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPLIT = re.compile(r"[^a-z]+")


def says(token: str) -> set[str]:
    """What a class token names: the known words of one whose last word is
    known (sidebar, left-sidebar; not has-sidebar, sidebar-layout)."""
    parts = [x for x in SPLIT.split(token) if x]
    if set(parts[:-1]) & {"has", "no", "not", "with", "without", "hide"}:
        return set()
    while len(parts) > 1 and parts[-1] in TAIL and parts[-1] not in SAYS_ASIDE:
        parts.pop()
    return set(parts) & SAYS_ASIDE if parts and parts[-1] in SAYS_ASIDE else set()


def marks(attrs: str) -> tuple[set[str], bool]:
    """What class, id and role say, and whether the element is hidden."""
    found, hidden = set(), False
    for name, *values in MARKS.findall(attrs):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id", "role"):
            for token in value.split():
                found |= says(token)
        elif name == "style":
            hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
    return found, hidden


class Tags:
    """The tags of a page in order: (start, end, whether an end tag, name,
    attributes); comments and the like have no name.  Reading is linear."""

    def __init__(self, page: str):
        self.page, self.at, self.unclosed = page, 0, set()

    def __iter__(self):
        return self

    def __next__(self) -> tuple[int, int, bool, str, str]:
        page = self.page
        while (start := page.find("<", self.at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                self.at = end + 3 if end >= 0 else len(page)
                return start, self.at, False, "", ""
            m = NAME.match(page, start)
            if m:
                end = self.end_of(m.end())
                if end is not None:
                    self.at = end + page.startswith(">", end)
                    return start, self.at, bool(m[1]), m[2].lower(), page[m.end():end]
            elif other := OTHER.match(page, start):
                self.at = other.end()
                return start, self.at, False, "", ""
            self.at = start + 1
        raise StopIteration

    def end_of(self, at: int) -> int | None:
        """Where the tag with attributes from ``at`` on ends: at the next > or,
        after a quoted value, <.  None if it is no tag."""
        page, quoted = self.page, False
        while m := INSIDE.search(page, at):
            if not m[1]:
                return m.start() if quoted or m[0] == ">" else None
            quoted = True
            close = -1 if m[1] in self.unclosed else page.find(m[1], m.end())
            if close < 0:  # there is none up to the page's end
                self.unclosed.add(m[1])
            at = max(close + 1, m.end())
        return len(page) if quoted else None

    def skip_raw(self, name: str) -> None:
        """Go to the end tag of an element of plain text."""
        m = RAW_END[name].search(self.page, self.at)
        self.at = m.start() if m else len(self.page)


def blocks(page: str) -> list[tuple[str, int, int, int]]:
    """(text, words, words in links, hint) of each block."""
    out: list[tuple] = []
    # open elements: (name, inside an article, inside something else (1 by a wrapper's mark, 2 by the element's own kind,
    # 3 hidden or a reader's comment), inside what is no text)
    stack: list[tuple[str, int, int, int]] = []
    text: list[str] = []
    linked: list[str] = []
    link = 0
    state = (0, 0)

    def flush() -> None:
        whole = " ".join(html.unescape("".join(text)).split())
        article, aside = state
        if whole and aside < 3:
            hint = -min(aside + article, 2) if aside else article
            out.append((whole, len(whole.split()), len(" ".join(linked).split()), hint))
        text.clear()
        linked.clear()

    def say(s: str) -> None:
        if stack and stack[-1][0] == "head" and s.strip():
            stack.pop()
        if s and not (stack and stack[-1][3]):
            text.append(s)
            if link:
                linked.append(html.unescape(s))
    at, tags = 0, Tags(page)
    for start, end, closing, name, attrs in tags:
        say(page[at:start])
        at = end
        if not name:
            continue
        if not closing:
            if stack and stack[-1][0] == "head" and name not in IN_HEAD:
                stack.pop()
            if stack and stack[-1][0] == "svg" and name in NOT_DRAWN:
                stack.pop()
            if name == "body" and all(x[0] != "body" for x in stack):
                del stack[next((k for k, x in enumerate(stack) if x[3]), len(stack)):]
        skip = stack[-1][3] if stack else 0
        own_end = attrs.endswith("/")
        if name in RAW:
            if not closing and not (own_end and any(x[0] == "svg" for x in stack)):
                tags.skip_raw(name)
                at = tags.at
            continue
        if not skip:
            if name == "br":
                text.append(" ")
                continue
            if name == "a":
                link = 0 if closing else 1
                continue
            if name in BLOCK:
                flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if stack[k][0] in FENCE and name not in FENCE:
                    break
        elif name not in VOID:
            if name in CLOSES:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in CLOSES[name]:
                        del stack[k:]
                        break
                    if stack[k][0] in FENCE or stack[k][0] in NOT_TEXT:
                        break
            article, aside, skip = stack[-1][1:] if stack else (0, 0, 0)
            if skip or name in NOT_TEXT or name in FOLLOWED:
                if not own_end and (name in BLOCK or name in NOT_TEXT or name in FOLLOWED):
                    stack.append((name, article, aside, int(skip or name in NOT_TEXT)))
                continue
            words, hidden = marks(attrs)
            if name in ("article", "main"):
                # what a wrapper's class says does not hold for the article in it, but a
                # comment may be an article of its own, and one inside another is a part of it
                if aside == 1 and not any(x[0] == "article" for x in stack):
                    aside = 0
                if hidden or words & SAYS_COMMENT:
                    aside = 3
                article = 1
            elif name in ("html", "body"):
                pass
            elif hidden or words & SAYS_COMMENT:
                aside = 3
            elif name in ASIDE and name != "form":
                aside = max(aside, 2)
            elif name == "form" or words - {"header"} - (UNSURE if article else set()):
                aside = max(aside, 1)
            elif (name == "header" or "header" in words) and not article:
                aside = max(aside, 1)
            if name in BLOCK or (article, aside) != (stack[-1][1:3] if stack else (0, 0)):
                if name not in BLOCK:  # an inline element of another kind starts a block too
                    flush()
                stack.append((name, article, aside, 0))
        new = stack[-1][1:3] if stack else (0, 0)
        if new != state:
            flush()
            state = new
    say(page[at:])
    flush()
    if any(x[3] == 1 for x in out):  # beside an article, a name of a wrapper says as much as an element
        out = [(*x[:3], -2 if x[3] < 0 else x[3]) for x in out]
    return out


def features(found: list[tuple]) -> np.ndarray:
    """One row of FEATURES per block of a page."""
    b = np.array([x[1:] for x in found], float).reshape(len(found), 3)
    words, density = b[:, 0], b[:, 1] / np.maximum(b[:, 0], 1)
    before = lambda x: np.concatenate(([0.0], x[:-1]))
    after = lambda x: np.concatenate((x[1:], [0.0]))
    return np.stack([words, density, before(words), before(density), after(words), after(density), b[:, 2]], axis=1)


def train_tree(x: np.ndarray, y: np.ndarray, depth: int = 8):
    """A classification tree by Gini impurity: a share at a leaf, else
    (feature, threshold, tree up to it, tree above)."""
    if depth == 0 or len(set(y.tolist())) < 2:
        return float(y.mean())
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= t
            impurity = sum(m.sum() * y[m].mean() * (1 - y[m].mean()) for m in (low, ~low))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, t, low)
    if best is None:
        return float(y.mean())
    _, f, t, low = best
    return f, t, train_tree(x[low], y[low], depth - 1), train_tree(x[~low], y[~low], depth - 1)


def predict(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, t, low, high = tree
    return np.where(x[:, f] <= t, predict(low, x), predict(high, x))


def labelled_tree():
    table = np.array([[float(v) for v in line.split()] for line in LABELLED.strip().split("\n")])
    return train_tree(table[:, :-1], table[:, -1])


def main_text(page: str, tree) -> str:
    found = blocks(page)
    if not found:
        return ""
    keep = predict(tree, features(found)) > 0.5
    return " ".join(b[0] for b, k in zip(found, keep) if k)


def _extract(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column("html")
            for s, e in slices(pages):
                text = [main_text(p or "", tree) for p in pages.slice(s, e - s).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("page_id").slice(s, e - s), batch.column("url").slice(s, e - s),
                                                  pa.array(text, pa.string()), pa.array(list(map(len, text)), pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    small_batches(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(lean(_extract(labelled_tree())), "page_id long, url string, text string, n_chars long")
