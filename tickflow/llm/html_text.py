"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines (one per block). The text lengths of ``WINDOW``
successive lines are summed; where the sums surge above a threshold there is
text, which reaches back to the last dive to zero and on to the next, and the
lines between are kept. Lines
of menus, notices, adverts, forms and the like weigh nothing. A line of a marked
article weighs the surge threshold on top, so that it is a surge by itself; what
lies outside the mark is kept where its own sums surge.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.common import map_rows

WINDOW = 3
SURGE_SHARE = 0.25       # of the middle line's length
SURGE_CHARS = 80         # a sentence: a higher surge is asked of no page
LINK_SHARE = 0.5         # more link text than this makes a line a menu line

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|"
                 r"<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:\"[^\"<]*+\"|'[^'<]*+'|[^<>\"'])*+)>|"
                 r"<(/?)([A-Za-z][A-Za-z0-9:-]*+)([^>]*+)>|<[!?][^>]*+>", re.S)
NAMES = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|"
                    r"display\s*:\s*none", re.I)
PART = re.compile(r"[A-Za-z0-9]+")

RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
OFF = frozenset("head nav footer aside noscript template svg math select button dialog menu "
                "object canvas audio video datalist map".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir "
                  "div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
                  "head header hgroup hr html legend li main menu nav noscript ol optgroup option "
                  "p pre section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE = frozenset("ad ads advert advertisement adverts advertorial banner breadcrumb breadcrumbs "
                  "byline comment comments consent cookie cookies copyright disclaimer discussion "
                  "disqus footer header masthead menu menubar modal nav navbar navigation "
                  "newsletter notice notices notification outbrain pager pagination popup promo "
                  "recommended related replies reply respond search share sharing sidebar signup "
                  "skip social sponsor sponsored subscribe taboola toolbar widget".split())
WHOLE = frozenset("html body article main p h1 h2 h3 h4 h5 h6 b i em strong a br".split())
MARKS = frozenset(("article", "main"))
#: Words that say where or how, not what: "site-footer", "comment-list-12".
PLACE = frozenset("area bar block body bottom box btn button buttons card col column container "
                  "content div element entry form global group icon icons inner item items "
                  "left link links list main message module outer page panel policy post posts "
                  "primary right row secondary section site slot text top unit user wrap wrapper".split())
MAIN = frozenset("main content article post entry story text page body maincontent".split())
#: Roles that paragraphs of an article have as well; there they only lose the mark's bonus.
SOFT = frozenset("byline copyright disclaimer discussion footer header notice notices notification "
                 "recommended related replies reply respond search share sharing signup skip "
                 "social".split())
TALK = frozenset("comment comments disqus replies reply".split())
SALE = frozenset("ad ads advert advertisement adverts advertorial consent cookie cookies modal "
                 "newsletter outbrain popup promo sponsor sponsored subscribe taboola".split())
HOLDERS = frozenset(("form", "named", "sale", "talk"))
COVER = 0.5              # see _resolved


def _roles(attrs: str) -> list[frozenset[str]]:
    """The words of each whole class, id and role, numbers left out."""
    names = [n for m in NAMES.finditer(attrs) for n in (m[1] or m[2] or m[3] or "").split()]
    return [frozenset(w.lower() for w in PART.findall(n) if not w.isdigit()) for n in names]


def _noise(name: str, attrs: str, marks: int, nested: bool) -> str:
    """How an element is noise: '' (not), 'off' (always), 'form', 'named', 'sale'
    or 'talk' (reader comments), or 'soft' (in an article; judged by its links)."""
    if name == "form":
        return "form"
    if name in OFF or name == "header" and not marks:
        return "off"
    if not attrs:
        return ""
    if HIDDEN.search(attrs):
        return "" if name in ("html", "body") else "off"
    if name in ("html", "body", "main"):
        return ""
    roles = _roles(attrs)
    whole = [r for r in roles if r & NOISE and r <= NOISE | PLACE]
    if name == "article":
        own = roles if nested else whole
        return "talk" if any(r & TALK for r in own) else ""
    if not whole or any(len(r) == 1 and r <= MAIN for r in roles):
        return ""
    if marks and all(r & NOISE <= SOFT for r in whole):
        return "soft"
    if any(r & TALK for r in whole):
        return "talk"
    return "sale" if any(r & SALE for r in whole) else "named"


def _resolved(found: list[tuple]) -> list[tuple[str, int, bool, bool]]:
    """Lines with their noise decided. A form hides neither an article in it nor
    most of the page's text; nor does a named element, unless the page has an
    article that nothing hides. Adverts and comments are shown only where the
    page has no other text (adverts also where they hold its only article)."""
    held: Counter = Counter()
    every, clear = 0, False
    for text, linked, off, over, marks, _ in found:
        if not off:
            clear = clear or marks > 0 and all(k == "form" and n < marks for _, k, n in over)
            if linked <= LINK_SHARE * len(text):
                every += len(text)
                held.update({x: len(text) for x in over})

    def hides(x: tuple, marks: int) -> bool:
        _, kind, outer = x
        if outer < marks and (kind == "form" or kind != "talk" and not clear):
            return False
        if kind == "form" or kind == "named" and not clear:
            return held[x] <= COVER * every
        return clear or held[x] < every

    return [(text, linked, off or any(hides(x, marks) for x in over), marks > 0 and not soft)
            for text, linked, off, over, marks, soft in found]


def lines_of(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, link characters, noise, inside an article) per non-empty line."""
    out: list[tuple] = []
    line: list[str] = []
    stack: list[tuple[str, str]] = []
    over: list[tuple[int, str, int]] = []      # open forms and named elements, marks around
    off = soft = marks = links = linked = 0

    def flush():
        nonlocal linked
        if line:
            text = " ".join("".join(line).split())
            if text:
                out.append((text, linked, off > 0, tuple(over), marks, soft > 0))
            line.clear()
        linked = 0

    def say(piece: str):
        nonlocal linked
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            line.append(piece)
            if links:
                linked += len(piece)

    at, size = 0, len(page)
    while at < size:
        m = TAG.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        attrs, closes = m[3] or m[6] or "", bool(m[1] or m[4])
        if name in BLOCK:
            flush()
        if closes:
            if any(n == name for n, _ in stack):
                while True:
                    n, kind = stack.pop()
                    off -= kind == "off"
                    soft -= kind == "soft"
                    if kind in HOLDERS:
                        over.pop()
                    marks -= n in MARKS
                    links -= n == "a"
                    if n == name:
                        break
            continue
        if name in RAW:
            end = re.compile(f"</{name}", re.I).search(page, at)
            at = end.start() if end else size
            continue
        if name in VOID or attrs.endswith("/"):
            continue
        if name == "a" and links:          # links do not nest
            links -= 1
            stack = [x for i, x in enumerate(stack)
                     if i != max(k for k, y in enumerate(stack) if y[0] == "a")]
        if name in ("p", "li", "b", "i") and name in WHOLE and not attrs:
            continue                       # often left open; they carry no state
        nested = name == "article" and any(n == name for n, _ in stack)
        kind = _noise(name, attrs, marks, nested)
        stack.append((name, kind))
        off += kind == "off"
        soft += kind == "soft"
        if kind in HOLDERS:
            over.append((at, kind, marks))
        marks += name in MARKS
        links += name == "a"
    flush()
    return _resolved(out)


def _surge(weights: list[int]) -> float:
    """The threshold: a share of the middle line's length, which no single line
    can raise, and never more than a sentence."""
    some = sorted(w for w in weights if w)
    return max(1, min(SURGE_CHARS, SURGE_SHARE * some[(len(some) - 1) // 2])) if some else 1


def main_text(page: str | None) -> str:
    """Blocks of the main text in page order, joined by one space."""
    lines = lines_of(page) if page else []
    weights = [len(text) if not off and (inside or linked <= LINK_SHARE * len(text)) else 0
               for text, linked, off, inside in lines]
    surge = _surge(weights)
    bonus = [w + surge * (w > 0 and x[3]) for w, x in zip(weights, lines)]
    sums = [sum(bonus[i:i + WINDOW]) for i in range(len(bonus))]
    kept: list[str] = []
    i = 0
    while i < len(lines):
        start = i
        while i < len(lines) and sums[i]:            # from dive to dive
            i += 1
        if max(sums[start:i], default=0) >= surge:
            kept += [lines[k][0] for k in range(start, i) if weights[k]]
        i += 1
    return " ".join(kept)


def extract_text(df: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (empty if none), n_chars.

    A null or empty page gives empty text; null ids and urls are kept; repeated
    rows stay; an empty table gives none; other columns are ignored. A tag that
    is never closed ends with the element around it or with the page."""
    def make():
        def fn(ids, urls, pages):
            texts = [main_text(p) for p in pages]
            return [ids, urls, texts, [len(t) for t in texts]]
        return fn

    kind = df.schema["page_id"].dataType.simpleString()
    return map_rows(df, [F.col("page_id"), F.col("url").cast("string"),
                         F.col("html").cast("string")],
                    f"page_id {kind}, url string, text string, n_chars long", make)
