"""Main text of web pages: flat text blocks, described by their word count and
link density and those of their neighbours, classified by a decision tree that
is trained on a small labelled table."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML element names by their role.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "select", "object"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br"}
CONTAINERS = {"nav", "header", "footer", "aside", "form", "article", "main", "section", "div", "ul", "ol", "dl", "table", "figure", "details", "dialog", "body", "menu"}
CHROME = {"nav", "footer", "aside", "form", "menu", "dialog", "button"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: Words in class, id and role that name what is not the article, at any length: what readers
#: wrote, other parts with texts of their own, and the layout around an article.
_WORD = r"(?:^|[^a-z])(?:%s)(?:[^a-z]|$)"
READERS = re.compile(_WORD % "comments?|replies|reply|respond|disqus|reviews?|guestbook")
OTHER = re.compile(
    _WORD % "ads?|adverts?|advertisement|sponsor(?:ed)?|promos?|promotion|banner|breadcrumbs?|cookies?|consent|gdpr|notices?|alert|popup|modal|newsletter|subscribe|subscription|"
    "signup|login|share|social|related|recommended|pagination|pager|tags|form|search"
)
LAYOUT = re.compile(_WORD % "nav|navigation|navbar|menu|header|masthead|footer|sidebar|aside|widget|complementary|contentinfo")
#: Class words that tell a state or the want of a part, and headers of the text itself.
STATE = re.compile(r"(?:^|[-_])(?:no|not|has|have|is|with|without|hide|js)[-_]|[-_](?:closed|open|hidden|collapsed|enabled|disabled|active|inactive|on|off)$|^(?:entry|post|article|story)[-_]+header$")
#: Elements that end an open p, and where an open element of a name may end at most.
ENDS_P = CONTAINERS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "hr", "address", "fieldset", "li", "dt", "dd"}
WITHIN = {"p": CONTAINERS, "li": {"ul", "ol", "menu"}}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTR = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

FEATURES = ("words", "links", "prev_words", "prev_links", "next_words", "next_links", "article", "chrome", "heading")
#: Labelled blocks: the features above, then 1 for main text and 0 for the rest.
LABELLED = [
    (1, 1.0, 0, 0.0, 1, 1.0, 0, 1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 1, 0, 0), (2, 1.0, 1, 1.0, 8, 0.0, 0, 1, 0, 0), (3, 1.0, 3, 1.0, 3, 1.0, 0, 0, 0, 0),
    (8, 0.0, 1, 1.0, 9, 0.0, 0, 1, 0, 0), (11, 0.0, 1, 1.0, 5, 0.0, 0, 1, 0, 0), (40, 0.0, 1, 1.0, 9, 0.0, 0, 1, 0, 0), (90, 0.1, 60, 0.0, 70, 0.0, 0, 1, 0, 0),
    (9, 0.0, 8, 0.0, 60, 0.0, 1, 0, 1, 1), (2, 0.0, 10, 0.0, 3, 0.0, 1, 0, 1, 1), (12, 0.0, 1, 1.0, 1, 0.0, 1, 0, 1, 1), (5, 0.0, 30, 0.0, 20, 0.0, 1, 0, 1, 1),
    (1, 0.0, 9, 0.0, 1, 0.0, 1, 0, 0, 1), (3, 0.0, 1, 0.0, 120, 0.0, 1, 0, 0, 1), (25, 0.0, 9, 0.0, 40, 0.0, 1, 0, 0, 1), (140, 0.0, 60, 0.0, 9, 0.0, 1, 0, 0, 1),
    (60, 0.05, 30, 0.0, 80, 0.0, 1, 0, 0, 1), (300, 0.0, 12, 0.0, 8, 0.0, 1, 0, 0, 1), (18, 0.3, 40, 0.0, 55, 0.0, 1, 0, 0, 1), (6, 0.0, 60, 0.0, 10, 0.0, 1, 0, 0, 1),
    (4, 1.0, 80, 0.0, 70, 0.0, 1, 0, 0, 1), (10, 0.0, 60, 0.0, 50, 0.0, 1, 1, 0, 0), (30, 0.0, 20, 0.0, 25, 0.0, 1, 1, 0, 0), (2, 0.0, 30, 0.0, 40, 0.0, 1, 1, 0, 0),
    (45, 0.0, 3, 0.0, 50, 0.0, 1, 1, 0, 0), (120, 0.0, 90, 0.0, 60, 0.0, 1, 1, 0, 0), (3, 1.0, 40, 0.0, 3, 1.0, 1, 1, 0, 0), (4, 0.0, 30, 0.0, 1, 1.0, 1, 1, 1, 0),
    (60, 0.0, 50, 0.0, 70, 0.0, 0, 0, 0, 1), (25, 0.0, 60, 0.0, 40, 0.0, 0, 0, 0, 1), (120, 0.02, 9, 0.0, 6, 0.0, 0, 0, 0, 1), (30, 0.1, 3, 1.0, 60, 0.0, 0, 0, 0, 1),
    (8, 0.0, 60, 0.0, 90, 0.0, 0, 0, 0, 1), (5, 0.0, 45, 0.0, 70, 0.0, 0, 0, 1, 1), (9, 0.0, 1, 1.0, 80, 0.0, 0, 0, 1, 1), (16, 0.0, 80, 0.0, 60, 0.0, 0, 0, 0, 1),
    (4, 0.0, 2, 1.0, 3, 1.0, 0, 0, 0, 0), (6, 0.0, 5, 1.0, 2, 1.0, 0, 0, 0, 0), (3, 0.0, 0, 0.0, 2, 1.0, 0, 0, 0, 0), (12, 0.9, 10, 0.8, 14, 1.0, 0, 0, 0, 0),
    (20, 0.8, 3, 1.0, 3, 1.0, 0, 0, 0, 0), (35, 0.7, 60, 0.0, 8, 1.0, 0, 0, 0, 0), (9, 0.0, 120, 0.0, 0, 0.0, 0, 1, 0, 0), (11, 0.1, 80, 0.0, 2, 1.0, 0, 1, 0, 0),
    (50, 0.0, 100, 0.0, 0, 0.0, 0, 1, 0, 0), (5, 0.0, 3, 0.0, 2, 1.0, 0, 1, 1, 0), (2, 0.5, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (7, 0.0, 0, 0.0, 5, 1.0, 0, 1, 1, 0),
    # text and headings before link lists, linked footers and linked menus; the last words of an article
    (60, 0.0, 50, 0.0, 2, 1.0, 1, 0, 0, 1), (25, 0.0, 90, 0.0, 1, 1.0, 1, 0, 0, 1), (140, 0.0, 70, 0.0, 6, 1.0, 1, 0, 0, 1), (12, 0.1, 40, 0.0, 3, 1.0, 1, 0, 0, 1),
    (1, 0.0, 30, 0.0, 1, 1.0, 1, 0, 0, 1), (5, 0.0, 60, 0.0, 4, 1.0, 1, 0, 1, 1), (9, 0.0, 1, 1.0, 5, 1.0, 1, 0, 1, 1), (45, 0.0, 2, 1.0, 3, 1.0, 1, 0, 0, 1),
    (80, 0.0, 60, 0.0, 2, 1.0, 0, 0, 0, 1), (35, 0.0, 40, 0.0, 1, 1.0, 0, 0, 0, 1), (120, 0.05, 90, 0.0, 5, 1.0, 0, 0, 0, 1), (28, 0.0, 3, 1.0, 4, 1.0, 0, 0, 0, 1),
    (55, 0.2, 1, 1.0, 1, 1.0, 0, 0, 0, 1), (16, 0.0, 70, 0.0, 2, 1.0, 0, 0, 0, 1), (14, 0.0, 60, 0.0, 3, 0.9, 0, 0, 0, 1), (15, 0.0, 35, 0.0, 1, 1.0, 0, 0, 0, 1),
    # linked blocks before plain text: menus outside nav, link lists, teasers
    (1, 1.0, 1, 1.0, 9, 0.0, 0, 0, 0, 0), (2, 1.0, 2, 1.0, 60, 0.0, 0, 0, 0, 0), (3, 1.0, 0, 0.0, 40, 0.0, 0, 0, 0, 0), (5, 1.0, 60, 0.0, 30, 0.0, 0, 0, 0, 0),
    (8, 0.9, 7, 1.0, 120, 0.0, 0, 0, 0, 0), (20, 0.8, 3, 1.0, 50, 0.0, 0, 0, 0, 0), (2, 1.0, 80, 0.0, 6, 0.0, 0, 0, 0, 0), (1, 1.0, 9, 0.0, 0, 0.0, 0, 0, 0, 0),
    # linked blocks in an article: a link list in it, a linked title, one linked line; the last entry of a list
    (3, 1.0, 3, 1.0, 8, 0.0, 1, 0, 0, 0), (4, 1.0, 5, 1.0, 40, 0.0, 1, 0, 0, 0), (3, 1.0, 4, 1.0, 0, 0.0, 1, 0, 0, 0), (2, 1.0, 2, 1.0, 60, 0.0, 1, 0, 0, 0),
    (6, 1.0, 3, 0.9, 4, 0.0, 1, 0, 0, 0), (3, 1.0, 40, 0.0, 0, 0.0, 1, 0, 0, 1),
    (3, 1.0, 3, 1.0, 3, 1.0, 1, 0, 0, 0), (5, 1.0, 40, 0.0, 4, 1.0, 1, 0, 0, 0), (2, 1.0, 6, 1.0, 4, 1.0, 1, 0, 0, 0), (7, 1.0, 2, 0.0, 8, 1.0, 1, 0, 0, 0),
    (6, 1.0, 30, 0.0, 60, 0.0, 1, 0, 1, 1), (8, 1.0, 1, 1.0, 50, 0.0, 1, 0, 1, 1), (12, 0.8, 70, 0.0, 40, 0.0, 1, 0, 0, 1), (5, 1.0, 90, 0.0, 30, 0.0, 1, 0, 0, 1),
    (4, 1.0, 30, 0.0, 8, 0.0, 1, 0, 0, 1), (6, 1.0, 1, 1.0, 12, 0.0, 1, 0, 1, 1), (3, 1.0, 20, 0.0, 2, 0.0, 1, 0, 0, 1), (9, 0.7, 15, 0.0, 14, 0.0, 1, 0, 0, 1),
    (2, 0.0, 10, 0.0, 1, 1.0, 1, 0, 0, 1), (3, 0.0, 6, 0.0, 2, 1.0, 1, 0, 0, 1), (4, 0.0, 3, 0.0, 1, 1.0, 1, 0, 0, 1), (2, 0.0, 1, 1.0, 5, 1.0, 1, 0, 1, 1),
    # short plain words among links, captions of menus
    (1, 0.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), (2, 0.0, 9, 0.0, 2, 1.0, 0, 0, 1, 0), (3, 0.0, 60, 0.0, 3, 1.0, 0, 0, 1, 0), (5, 0.2, 4, 1.0, 1, 1.0, 0, 0, 0, 0),
    # short headings and lines of text outside an article
    (5, 0.0, 45, 0.0, 20, 0.0, 0, 0, 1, 1), (4, 0.0, 60, 0.0, 12, 0.0, 0, 0, 1, 1), (3, 0.0, 40, 0.0, 9, 0.0, 0, 0, 0, 1), (6, 0.0, 12, 0.0, 10, 0.0, 0, 0, 0, 1),
    (4, 0.0, 1, 1.0, 18, 0.0, 0, 0, 1, 1), (2, 0.0, 30, 0.0, 0, 0.0, 0, 0, 0, 1), (5, 0.0, 60, 0.0, 2, 1.0, 0, 0, 0, 1), (3, 0.0, 45, 0.0, 4, 1.0, 0, 0, 0, 1),
    (4, 0.0, 50, 0.0, 2, 0.0, 0, 0, 0, 1), (3, 0.0, 20, 0.0, 1, 0.0, 0, 0, 0, 1), (6, 0.0, 9, 0.0, 3, 0.0, 0, 0, 0, 1), (1, 0.0, 60, 0.0, 0, 0.0, 0, 0, 0, 1),
    (2, 0.0, 5, 1.0, 6, 1.0, 0, 0, 0, 0), (3, 0.0, 2, 1.0, 8, 1.0, 0, 0, 0, 0), (1, 0.0, 4, 1.0, 9, 0.9, 0, 0, 1, 0), (4, 0.0, 20, 0.0, 1, 1.0, 0, 0, 0, 1),
    # plain text after links
    (40, 0.0, 2, 1.0, 60, 0.0, 0, 0, 0, 1), (22, 0.0, 1, 1.0, 8, 0.0, 0, 0, 0, 1), (70, 0.0, 3, 1.0, 0, 0.0, 0, 0, 0, 1), (18, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
]


@dataclass
class Tree:
    share: float
    feature: int = -1
    cut: float = 0.0
    low: Tree | None = field(default=None, repr=False)
    high: Tree | None = field(default=None, repr=False)

    def score(self, x) -> float:
        node = self
        while node.feature >= 0:
            node = node.low if x[node.feature] <= node.cut else node.high
        return node.share


def train_tree(rows, depth: int = 5, least: int = 1) -> Tree:
    """Decision tree by Gini impurity over the labelled rows."""
    ones = sum(r[-1] for r in rows)
    node = Tree(ones / len(rows))
    if depth == 0 or ones in (0, len(rows)):
        return node

    def impurity(part) -> float:
        p = sum(r[-1] for r in part) / len(part)
        return len(part) * p * (1 - p)

    best = (impurity(rows) - 1e-9, None, 0.0)
    for f in range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:], strict=False):
            cut = (a + b) / 2
            low, high = [r for r in rows if r[f] <= cut], [r for r in rows if r[f] > cut]
            if min(len(low), len(high)) >= least and (v := impurity(low) + impurity(high)) < best[0]:
                best = (v, f, cut)
    if best[1] is not None:
        node.feature, node.cut = best[1], best[2]
        node.low = train_tree([r for r in rows if r[best[1]] <= best[2]], depth - 1, least)
        node.high = train_tree([r for r in rows if r[best[1]] > best[2]], depth - 1, least)
    return node


def hinted(attributes: str) -> str:
    """What class, id or role say an element is: ``readers``, ``other``, ``layout`` or nothing."""
    marks = [m for m in " ".join(x for a in ATTR.findall(attributes) for x in a).lower().split() if not STATE.search(m)]
    for kind, pattern in (("readers", READERS), ("other", OTHER), ("layout", LAYOUT)):
        if any(pattern.search(m) for m in marks):
            return kind
    return ""


@dataclass
class Place:
    """An open element, and what it and those around it say about its blocks."""

    name: str
    article: bool = False
    chrome: bool = False
    readers: bool = False
    other: bool = False
    layout: tuple[tuple[int, bool], ...] = ()  # layout elements around it: number, and whether opened in an article


def blocks(page: str) -> list[dict]:
    """Flat text blocks of a page: text, words, linked words, and whether the
    block is in an article, in page furniture, or a heading.

    What readers wrote, adverts, notices and the like are furniture by their class,
    id or role, whatever their length; only an article inside a wrapper named so
    starts anew (never inside readers' parts). A layout word also names wrappers of
    the text: such an element stays if it holds the page's article, or if hardly any
    text lies outside of layout elements (see ``_judge_layout``)."""
    out: list[dict] = []
    parts: list[tuple[str, bool]] = []
    open_: list[Place] = []
    layouts = 0
    links, at, heading = 0, 0, False

    def flush() -> None:
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                on = open_[-1] if open_ else Place("")
                linked = sum(len(p.split()) for p, l in parts if l)
                words = len(text.split())
                out.append({"text": text, "words": words, "links": min(1.0, linked / words), "article": int(on.article), "chrome": int(on.chrome or on.readers or on.other), "heading": int(heading), "layout": on.layout})
            parts.clear()

    def leave(name: str) -> None:
        for i in range(len(open_) - 1, -1, -1):
            if open_[i].name == name:
                del open_[i:]
                break
            if open_[i].name in WITHIN.get(name, ()):
                break

    def add(raw: str) -> None:
        if raw:
            parts.append((html.unescape(raw), links > 0))

    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        closing = bool(m[1])
        if name in RAW:
            if not closing and not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{name}[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            if name == "title":
                flush()
            continue
        if name == "a":
            links = 0 if closing else 1
        elif name == "br":
            parts.append((" ", links > 0))
        if name in INLINE:
            continue
        flush()
        links = 0
        if name == "head" and closing:
            parts.clear()
        if re.fullmatch("h[1-6]", name):
            heading = not closing
        elif name in ("p", "li", "div", "td"):
            heading = False
        if name in VOID:
            continue
        if not closing:
            # an open p ends before a block, an open li before the next li
            if name in ENDS_P:
                leave("p")
            if name == "li":
                leave("li")
        if closing:
            leave(name)
        elif name in CONTAINERS or name in WITHIN or name in CHROME or hinted(m[3]):
            on = open_[-1] if open_ else Place("")
            own = "" if name in ("html", "body") else hinted(m[3])
            article, other, layout = on.article, on.other, on.layout
            if name in ("article", "main"):
                # the article in a wrapper named so is no furniture, unless it is named so itself
                article, other = True, False
            if own == "layout":
                layouts += 1
                layout = (*layout, (layouts, on.article))
            chrome = on.chrome or name in CHROME or (name == "header" and not on.article)
            open_.append(Place(name, article, chrome, on.readers or own == "readers", other or own == "other", layout))
    flush()
    _judge_layout(out)
    return out


#: Plain words outside of layout elements that are a text of their own.
OWN_TEXT = 30


def _judge_layout(found: list[dict]) -> None:
    """Blocks of layout elements become furniture. Elements around the page's
    article stay; and where less than ``OWN_TEXT`` plain words lie outside of layout
    elements (in the article, if there is one), so do those in the article, or one
    with at least half of the page's plain words."""
    plain = [0.0 if b["chrome"] else b["words"] * (1.0 - b["links"]) for b in found]
    has_article = any(b["article"] and not b["chrome"] for b in found)
    around, share, bare = set(), {}, 0.0
    for b, n in zip(found, plain, strict=True):
        for e, inside in b["layout"]:
            share[e] = share.get(e, 0.0) + n
            if b["article"] and not b["chrome"] and not inside:
                around.add(e)
    for b, n in zip(found, plain, strict=True):
        if all(e in around for e, _ in b["layout"]) and (b["article"] or not has_article):
            bare += n

    def furniture(e: int, inside: bool) -> bool:
        if e in around:
            return False
        if bare >= OWN_TEXT:
            return True
        return not inside if has_article else 2 * share[e] < sum(plain) or not share[e]

    for b in found:
        if any(furniture(e, inside) for e, inside in b.pop("layout")):
            b["chrome"] = 1


def main_text(page: str, tree: Tree) -> str:
    found = blocks(page)
    kept = []
    for i, b in enumerate(found):
        p, n = (found[i - 1] if i else None), (found[i + 1] if i + 1 < len(found) else None)
        x = (b["words"], b["links"], p["words"] if p else 0, p["links"] if p else 0.0, n["words"] if n else 0, n["links"] if n else 0.0, b["article"], b["chrome"], b["heading"])
        if tree.score(x) >= 0.5:
            kept.append(b["text"])
    return "\n".join(kept)


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html_column: str = "html", labelled=LABELLED, depth: int = 5) -> DataFrame:
    """``page_id, url, text``, one row per input row.

    Defined results: null and empty html give empty text; broken markup is read
    as far as it goes; a comment, script or style that is not closed runs to
    the end; rows that repeat give equal rows; an empty table gives an empty
    result; other columns are ignored.
    """
    tree = train_tree([tuple(r) for r in labelled], depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py() or "", tree) for h in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = pages.schema[page_id].dataType.simpleString()
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html_column).cast("string").alias("html"))
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string")
