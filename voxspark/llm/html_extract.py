"""Main text of HTML pages by line-block distribution.

Markup is stripped to lines (one per block element); a line's length counts its characters,
outside ``article`` and ``main`` only those outside links.  The lengths are summed over a sliding window of lines; a surge point is
where the sum leaves zero, a dive point where it falls back, and the text between the two
is kept.  Lines of menus, headers, footers, sidebars, notices, adverts, forms and reader
comments have length zero, as has any line outside ``article`` or ``main`` where the page
has one.  Without such an element, the text from the first to the last surge whose window
sums reach a share of the page's highest counts, and from there on either side every surge
that reaches this share of the one beside it.

Script, style and other raw text runs to its end tag, or to the page's end.  A button, option,
drawing or the like without an end tag ends at the next block or end tag.

Defined results: null and empty pages give empty text; unclosed or broken markup is read
as far as it goes (a cut tag at the end is dropped); repeated rows give repeated results.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW, SHARE = 3, 0.2

_ATTRS = r"""(?:[^<>"']|"[^"]*"|'[^']*')*"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRS})>|<[!?][^>]*>|<[a-zA-Z/!?][^<>]*\Z", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

# fixed values: element names and naming habits of web pages
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub "
                   "sup time tt u var wbr acronym big img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template svg math head title iframe object select textarea button canvas "
                    "audio video map option".split())
RAW = frozenset("script style textarea title iframe".split())     # these run to the end if not closed
SINGLE = frozenset("button option select map audio video canvas".split())   # a start tag closes the last one
#: Start tags that end an unclosed element of SKIPPED.
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 "
                  "h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table tbody td th thead tr ul".split())
OUTER = frozenset("nav footer aside form menu dialog fieldset".split())
_OUTER_WORD = (
    r"(?:ads?|advert\w*|adsense|banner\w*|sponsor\w*|promo\w*|menu\w*|nav|navbar|navigation|topnav|breadcrumbs?|"
    r"side-?bar\w*|foot|footer\w*|masthead|site-?header|page-?header|top-?bar|comments?|comment-?list|disqus\w*|respond|replies|cookies?\w*|"
    r"consent|gdpr|notices?|popup\w*|modal\w*|overlay|newsletter\w*|subscribe\w*|signup|share\w*|sharing|social\w*|"
    r"related\w*|recommend\w*|widget\w*|toolbar|pagination|pager|skip-?link|login\w*|search\w*)")
_OUTER_NAME = re.compile(rf"(?:^|[_-]){_OUTER_WORD}(?=$|[_-])", re.I)
_MODIFIER = re.compile(r"(?:has|no|not|with|without)[_-]|elementor-widget(?:-wrap|-container)?(?=$|-)", re.I)
#: Words that may stand beside it in the name of a block of furniture inside an article.
_PLAIN_WORD = frozenset("area articles bar block box btn button buttons container content form group icons inline inner items left links list "
               "main message posts right row section site slot stories top bottom text title unit wrap wrapper".split())
_ONE_WORD = re.compile(r"(?<=side)-(?=bar)|(?<=top)-(?=bar)|(?<=site)-(?=header)|(?<=page)-(?=header)|(?<=comment)-(?=list)|(?<=skip)-(?=link)", re.I)
_WHOLE_WORD = re.compile(_OUTER_WORD, re.I)
_OUTER_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
BODY = frozenset(("article", "main"))


@lru_cache(1 << 16)
def _outer_name(names: str, inside: bool) -> bool:
    """Does a class or id name furniture?  Inside an article the whole of a name has to say so; what
    a wrapper has or lacks (``has-sidebar``) says nothing of the wrapper."""
    for x in names.split():
        m = _MODIFIER.match(x)
        if m and m[0][-1] in "_-":
            continue
        x = x[m.end():] if m else x
        if not _OUTER_NAME.search(x):
            continue
        if not inside or all(not w or w.lower() in _PLAIN_WORD or _WHOLE_WORD.fullmatch(w)
                             for w in re.split("[_-]", _ONE_WORD.sub("", x))):
            return True
    return False


def _ends(page: str, name: str) -> dict[int, int]:
    """Where each element of this name that has an end tag ends, by where its start tag begins."""
    out: dict[int, int] = {}
    opened: list[int] = []
    for m in re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])[^>]*>?", re.I).finditer(page):
        if m[1]:
            if opened:
                out[opened.pop()] = m.end()
        else:
            if name in SINGLE:
                opened.clear()
            opened.append(m.start())
    return out


def _outer(name: str, attrs: str, inside: bool) -> bool:
    """Does this element hold page furniture?"""
    if name in OUTER or name == "header" and not inside:
        return True
    if name in ("body", "html", *BODY) or not attrs.strip():
        return False
    got = {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTR.finditer(attrs)}
    return ("hidden" in got or got.get("aria-hidden") == "true" or got.get("role", "").lower() in _OUTER_ROLE
            or re.search(r"display\s*:\s*none", got.get("style", ""), re.I) is not None
            or any(_outer_name(got.get(k, ""), inside) for k in ("class", "id")))


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """(text, length outside furniture and, but for article and main, outside links; inside article
    or main) of every line with text."""
    out: list = []
    buf: list[str] = []
    free = links = 0                     # characters outside and inside links, of the line
    stack: list[tuple[str, bool]] = []   # open elements, with their furniture flag
    opened: Counter = Counter()          # open elements by name
    outer = body = link = 0              # how many open elements are furniture, body, links
    ends: dict[str, dict[int, int]] = {}
    mute = False                         # inside an unclosed element of SKIPPED

    def cut():
        nonlocal free, links
        text = " ".join(html.unescape("".join(buf)).split())
        if text:
            out.append((text, 0 if outer else free + links if body else free, body > 0))
        buf.clear()
        free = links = 0

    def say(s: str):
        nonlocal free, links
        if s and not mute:
            buf.append(s)
            n = len("".join(s.split()))
            if link:
                links += n
            else:
                free += n

    def pop() -> str:
        nonlocal outer, body, link
        x, flag = stack.pop()
        opened[x] -= 1
        outer -= flag
        body -= x in BODY
        link -= x == "a"
        return x

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, attrs = m[2].lower(), m[3]
        if name in SKIPPED:
            if not m[1] and not attrs.rstrip().endswith("/"):
                if name in RAW:
                    close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                    if close:
                        at = close.end()
                    elif name != "title":
                        break
                    continue
                if name not in ends:
                    ends[name] = _ends(page, name)
                if m.start() in ends[name]:
                    at = ends[name][m.start()]
                elif name != "head":
                    mute = True
            continue
        if name in BLOCK or m[1] and opened[name]:
            mute = False
        if name not in INLINE:
            cut()
        if m[1]:
            while opened[name] and pop() != name:
                pass
        elif name not in VOID and not attrs.rstrip().endswith("/"):
            if name in ("p", "li", "a") and stack and stack[-1][0] == name:   # closed by the next one
                pop()
            flag = _outer(name, attrs, body > 0)
            if name in INLINE and name != "a" and not flag:
                continue
            stack.append((name, flag))
            opened[name] += 1
            outer += flag
            body += name in BODY
            link += name == "a"
    cut()
    return out


def kept_lines(lines: list[tuple[str, int, bool]], window: int = WINDOW, share: float = SHARE) -> list[str]:
    """The lines between surge and dive points."""
    marked = any(b and n for _, n, b in lines)
    sizes = [n if b or not marked else 0 for _, n, b in lines]
    sums, run = [], 0
    for i, n in enumerate(sizes):
        run += n - (sizes[i - window] if i >= window else 0)
        sums.append(run)                 # over the lines i - window + 1 .. i
    runs, i = [], 0                      # (surge, dive, highest sum)
    while i < len(sums):
        if not sums[i]:
            i += 1
            continue
        dive = i
        while dive < len(sums) and sums[dive]:
            dive += 1
        runs.append((i, dive, max(sums[i:dive])))
        i = dive
    if not marked and runs:
        floor = share * max(r[2] for r in runs)
        high = [k for k, r in enumerate(runs) if r[2] >= floor]
        lo, hi = high[0], high[-1]
        while lo and runs[lo - 1][2] >= share * runs[lo][2]:
            lo -= 1
        while hi + 1 < len(runs) and runs[hi + 1][2] >= share * runs[hi][2]:
            hi += 1
        runs = runs[lo:hi + 1]
    return [lines[k][0] for i, dive, _ in runs for k in range(i, dive) if sizes[k]]


def main_text(page: str | None, window: int = WINDOW, share: float = SHARE) -> str:
    return "\n".join(kept_lines(lines_of(page or ""), window, share))


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """``(id, url, text, n_chars)`` for every row, whole page each; no shuffle."""
    src = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = pa.array([main_text(h.as_py(), window, share) for h in b.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), text], ["id", "url", "text"])

    out = src.mapInArrow(run, f"id {kind}, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
