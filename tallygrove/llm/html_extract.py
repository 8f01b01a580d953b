"""Main text of HTML pages from flat text blocks.

A page is cut into a flat list of blocks at block-level tags. Each block is described
by its word count and link density, those of the block before and after it, whether it
stands inside an article or main element (and whether the page has one), inside an
element whose tag, role, class or id names boilerplate, and whether it is a heading. A
decision tree over these, grown by Gini impurity and free to take any feature at any level,
tells content from boilerplate; contents are joined in page order.

A class, id or role names boilerplate only as a whole (no-sidebar is no sidebar), and what
holds an article is no boilerplate for what it is called.

The labelled table is small and made by rule: SAMPLES pages are put together from
fragments of known label (FRAGMENTS) in the order pages have them, cut into blocks as any page
is, and each block gets its fragment's label. Half of the pages have no article element, and
much of their boilerplate has no name, so that words, links and neighbours must tell.

Defined results: null or empty html gives an empty text; unclosed tags are closed by
their container, an unclosed comment or script runs to the end; a tree's tie goes to the
feature that comes first, a leaf's to content; repeated rows each get
a row; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ._common import slim

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "in_article", "page_has_article", "boilerplate", "heading")
DEPTH = 10
LEAF = 4
SAMPLES = 300
# Fragments of sample pages. w is a run of 12 to 400 words, s one of 2 to 11, x one word.
TOP = ["<header><h2>s</h2>s</header>", "<header>x</header>", "<nav><ul><li><a>x</a></li><li><a>x</a></li><li><a>s</a></li></ul></nav>", "<ul class=menu><li><a>x</a><li><a>x</a></ul>"]
TOP += ["<div class=ad>s</div>", "<div class=banner>w</div>", "<div id=cookie-notice><p>w</p><button>x</button></div>", "<form>s<p>w</p></form>", "<div role=search>x</div>"]
BOTTOM = ["<footer>s</footer>", "<footer><p>w</p><p>s</p></footer>", "<footer><a>x</a><a>s</a></footer>", "<aside><h3>s</h3><p>w</p><p>x</p></aside>", "<div class=related><a>s</a><br><a>s</a></div>"]
BOTTOM += ["<section id=comments><h3>s</h3><p>w</p><p>x</p><p>w</p><p>s</p></section>", "<div class=newsletter><p>w</p></div>", "<div class=sidebar><p>w</p><p>w</p></div>", "<div class=share><a>x</a></div>"]
BOTTOM += ["<footer>s <a>s</a> w</footer>", "<footer>w<br>s <a>s</a></footer>", "<div class=comments><p>w <a>s</a> s</p><p><a>s</a></p><p>s <a>x</a></p><p><a>x</a></p></div>", "<aside><p>w <a>s</a></p><p><a>s</a> s</p></aside>"]
MAIN = ["<h2>s</h2>", "<h3>x</h3>", "<p>w</p>", "<p>w</p>", "<p>s</p>", "<p>x</p>", "<p>w <a>s</a> s</p>", "<ul><li>s</li><li>w</li></ul>", "<blockquote>w</blockquote>"]
IN_ARTICLE = ["<p><a>s</a></p>", "<p><a>x</a><br><a>x</a></p>", "<p>w<br>s</p>"]
#: Outside articles and named by nothing: only words and links tell.
LOOSE = ["<div><p><a>s</a></p><p>s</p><p><a>s</a></p><p>x</p><p><a>s</a></p></div>", "<ul><li><a>x</a><li><a>s</a><li><a>x</a></ul>", "<div><a>s</a> <a>s</a></div>", "<div><a>x</a></div>"]
#: Content outside articles that its neighbours tell: a link between long texts.
BETWEEN = ["<p>w</p><p><a>s</a></p><p>w</p>"]
#: Lists of links around pages of either kind, half of them in elements that say nothing.
LINKS = ["<ul><li><a>x</a><li><a>x</a><li><a>s</a><li><a>x</a><li><a>x</a></ul>", "<div><p><a>s</a></p><p><a>x</a></p><p><a>s</a></p><p><a>s</a></p></div>", "<nav><ul><li><a>x</a><li><a>x</a><li><a>s</a><li><a>x</a></ul></nav>", "<div class=related><p><a>s</a></p><p><a>s</a></p><p><a>s</a></p></div>"]
#: Beside an article and named by nothing.
BESIDE = ["<div>s</div>", "<p>w</p>", "<h2>s</h2>", "<div><a>s</a></div>", "<p>x</p>"]
# Names of elements and of their classes, ids and roles.
_RAW = "script|style|title|template|textarea|select"
_BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_HOLD = _BLOCK - frozenset("br hr p li option dt dd td th tr h1 h2 h3 h4 h5 h6".split())
_OFF = frozenset("nav footer aside form menu dialog button fieldset".split())
_FIRM = frozenset("nav footer aside".split())
_NAMES = frozenset(
    "nav navbar navigation menu footer header masthead sidebar aside ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login search share sharing social related recommended comment comments respond reply replies disqus breadcrumb breadcrumbs pagination pager toolbar widget widgets copyright disclaimer complementary contentinfo skip hidden".split()
)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<[/!?a-zA-Z][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!\s*important\s*)?(?:;|$)", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _boilerplate_name(token: str) -> bool:
    """Whether a class, id or role is a name of boilerplate, or a compound of nothing else: no-sidebar, post-ad-free and related-work are none."""
    parts = [w.lower() for w in _WORDS.findall(token)]
    return bool(parts) and all(w in _NAMES for w in parts)


def _named(attributes: str) -> tuple[bool, bool]:
    """Of an element: whether it is hidden, and whether one of its classes, its id or its role names boilerplate."""
    named = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _HIDDEN.search(value):
            return True, named
        named = named or name in ("class", "id", "role") and any(map(_boilerplate_name, value.split()))
    return False, named


def blocks(page: str):
    """Flat blocks of a page: (text, words, words in links, in article, in boilerplate, heading), in order."""
    out: list[tuple[str, int, int, bool, bool, bool]] = []
    stack: list[tuple[str, bool, bool, bool]] = []  # tag, inside an article, inside boilerplate, and so even for an article in it
    parts: list[str] = []
    linked: list[str] = []
    state = {"link": 0, "heading": False}

    def close() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                n = len(html.unescape(" ".join(linked)).split())
                article, off = stack[-1][1:3] if stack else (False, False)
                words = len(text.split())
                out.append((text, words, min(n, words), article, off, state["heading"]))
            parts.clear()
            linked.clear()

    def add(text: str) -> None:
        if text:
            parts.append(text)
            if state["link"]:
                linked.append(text)

    at = 0
    for m in _TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if m[1]:
            if m[1].lower() == "title":
                close()
            continue
        if tag == "a":
            state["link"] = 0 if m[2] else 1
        if tag not in _BLOCK:
            continue
        close()
        if tag[0] == "h" and tag[1:].isdigit():
            state["heading"] = not m[2]
        if tag == "br" or tag == "hr":
            continue
        state["link"] = 0 if m[2] else state["link"]
        if m[2]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        else:
            article, off, firm = stack[-1][1:] if stack else (False, False, False)
            hidden, called = _named(m[4] or "")
            if tag in ("article", "main") and not article:  # what holds an article is no boilerplate for what it is called
                off = firm
            firm = firm or hidden or tag in _FIRM
            named = hidden or tag in _OFF or tag == "header" and not article or called and tag not in ("body", "html", "main", "article")
            if tag in _HOLD:
                stack.append((tag, article or tag in ("article", "main"), off or named, firm))
            elif named:  # an element that may stay open: its own block alone
                stack.append((tag, article, True, firm))
            elif stack and stack[-1][0] == tag:  # the same kind of element opens anew
                stack.pop()
    add(page[at:])
    close()
    return out


def describe(found: list) -> list[list[float]]:
    """FEATURES of each block."""
    density = [b[2] / max(1, b[1]) for b in found]
    has = float(any(b[3] for b in found))
    out = []
    for i, b in enumerate(found):
        before = (found[i - 1][1], density[i - 1]) if i else (0, 0.0)
        after = (found[i + 1][1], density[i + 1]) if i + 1 < len(found) else (0, 0.0)
        out.append([b[1], density[i], *before, *after, float(b[3]), has, float(b[4]), float(b[5])])
    return out


def labelled(samples: int = SAMPLES, seed: int = 1) -> list[tuple]:
    """The labelled table: FEATURES in order, then 1 for content and 0 for boilerplate."""
    rng = random.Random(seed)
    out: list[tuple] = []

    def fill(fragment: str, label: int) -> str:
        """Runs of words for w, s and x; each word is its fragment's label, so each block shows its own."""
        spans = {"w": (12, 400), "s": (2, 11), "x": (1, 1)}
        size = lambda least, most: round(least * (most / least) ** rng.random())
        word = lambda m: " ".join([str(label)] * size(*spans[m[0]]))
        return re.sub(r"(?<![\w</=-])[wsx](?![\w=>-])|(?<=>)[wsx](?=<)", word, fragment)

    def some(fragments, most: int, label: int) -> str:
        return "".join(fill(x, label) for x in rng.sample(fragments, rng.randint(0, min(most, len(fragments)))))

    for k in range(samples):
        article = k % 2 > 0
        top, bottom = (() if rng.random() < 0.35 else x for x in (TOP, BOTTOM))  # many pages have nothing before or after
        inside = "".join(fill(x, 1) for x in rng.choices(MAIN + (IN_ARTICLE if article else BETWEEN), k=rng.choice((1, 1, 3, 5, 9))))
        inside = (fill("<h1>s</h1>", 1) if rng.random() < 0.6 else "") + inside
        lists = [fill(x, 0) for x in rng.choices(LINKS, k=rng.randint(0, 3))], [fill(x, 0) for x in rng.choices(LINKS, k=rng.randint(0, 3))]
        if article:
            tag = "main" if k % 7 == 0 else "article"
            inside = (some(TOP[2:], 2, 0) if k % 4 == 1 else "") + inside + (some(BOTTOM, 3, 0) if k % 4 == 3 else "")
            body = some(BESIDE if top else (), 1, 0) + f"<{tag}>{inside}</{tag}>" + some(BESIDE if bottom else (), 2, 0)
        else:
            body = some(LOOSE if top else (), 1, 0) + f"<div>{inside}</div>" + some(LOOSE if bottom else (), 2, 0)
        found = blocks("".join(lists[0]) + some(top, 4, 0) + body + some(bottom, 4, 0) + "".join(lists[1]))
        out += [(*row, int(b[0][0])) for b, row in zip(found, describe(found))]
    return out


def grow(rows: list[tuple], depth: int = DEPTH, features=None):
    """A decision tree by Gini impurity: (feature, threshold, tree up to it, tree above it), or the label. Every level takes whichever feature is best."""
    table = np.array(rows, float)
    return _grow(table[:, :-1], table[:, -1], depth, range(len(FEATURES)) if features is None else features)


def _best(x: np.ndarray, y: np.ndarray, features) -> tuple[float, int, float] | None:
    """(impurity left, feature, threshold) of the best split into parts of LEAF rows, if it lowers impurity by a hundredth."""
    n, ones = len(y), y.sum()
    now = ones * (1 - ones / n)
    best = None
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        v, c = x[order, f], np.cumsum(y[order])[:-1]
        k = np.arange(1, n)
        may = (v[1:] > v[:-1]) & (k >= LEAF) & (n - k >= LEAF)
        cost = np.where(may, c * (1 - c / k) + (ones - c) * (1 - (ones - c) / (n - k)), np.inf)
        at = int(cost.argmin()) if n > 1 else 0
        if n > 1 and cost[at] < (best[0] if best else 0.99 * now) - 1e-9:
            best = float(cost[at]), f, float((v[at] + v[at + 1]) / 2)
    return best


def _grow(x: np.ndarray, y: np.ndarray, depth: int, features):
    most = int(2 * y.sum() >= len(y))
    if depth == 0 or y.min() == y.max():
        return most
    best = _best(x, y, features)
    if not best:
        return most
    low = x[:, best[1]] <= best[2]
    return best[1], best[2], _grow(x[low], y[low], depth - 1, features), _grow(x[~low], y[~low], depth - 1, features)


def decide(tree, row) -> int:
    while not isinstance(tree, int):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(page: str, tree) -> str:
    found = blocks(page)
    return " ".join(b[0] for b, row in zip(found, describe(found)) if decide(tree, row))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of each row."""
    tree = grow(labelled())

    @arrow_udf("string")
    def text(page: pa.Array) -> pa.Array:
        return pa.array([main_text(x.as_py() or "", tree) for x in page], pa.string())

    rows = slim(pages, page_id=id_col, url=url_col, html=html_col).select("page_id", "url", text("html").alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
