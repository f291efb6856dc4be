"""Main text of web pages by a maximum-scoring run of words and tags.

A page is a sequence of words and tags. Words score their weight (positive in plain
text, less or negative in links and outside the page's article), tags score negative;
one linear scan finds the contiguous run with the greatest sum, and the words in it
are the text. Weights are log-odds of content against boilerplate, learned from
labelled pages: those with exactly one article (or main) element, whose words are
content and all others boilerplate. Counts cover all labelled pages; the features are
a fixed list of tags and word contexts, so the table of weights has a fixed size.

Elements that are never main text take no part, however long they are: scripts, styles,
navigation, page headers and footers, asides, forms, and elements whose class, id or role
names an advert, menu, sidebar, notice or comment section; articles inside them (teasers,
comments) neither, unless the page has no other. A class that speaks of such a part without
being it (no-sidebar, search-result, share-price) is none of these, and names that main text
may bear too (PARTS) do not count where they leave no word. On a page with articles, words
between them are no text.

Text: character references are decoded, white space inside a block becomes one blank,
blocks are trimmed and joined in page order by an empty line. Nulls, empties, ties,
repeats: a null page is empty; a page without words gives the empty text; of equal
sums the first, longest run is taken; each row is answered; without labelled pages
the default weights hold; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import prepare

# Element names of the HTML standard by their role.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
         "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1",
         "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main",
         "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead",
         "tr", "ul"}
INLINE = {"a", "abbr", "b", "br", "cite", "code", "em", "font", "i", "img", "label", "q", "s",
          "small", "span", "strong", "sub", "sup", "td", "th", "time", "u"}
NEVER = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "svg",
         "head", "object", "audio", "video", "canvas", "map"}
#: Words in class, id or role that mark an element as something else than main text
#: whatever stands beside them.
HINTS = {"ad", "ads", "advert", "advertisement", "advertising", "adsense", "sponsor", "sponsored",
         "cookie", "cookies", "consent", "gdpr", "newsletter", "subscribe", "signup", "paywall",
         "navbar", "breadcrumb", "breadcrumbs", "masthead", "topbar", "toolbar", "pagination",
         "contentinfo", "complementary"}
#: Words that do so alone or with others of these sets and of PLACES only, and not beside a
#: name in MAIN.
MAIN = {"main", "article"}
PARTS = {"sidebar", "promo", "promotion", "banner", "notice", "notices", "alert", "popup", "modal", "overlay",
         "login", "menu", "nav", "navigation", "footer", "share", "sharing", "social", "related",
         "recommended", "widget", "pager", "search", "form", "hidden"}
COMMENT_HINTS = {"comment", "comments", "commentlist", "disqus", "respond", "replies", "reply",
                 "discussion"}
#: Words that say where and in what shape a part stands.
PLACES = {"area", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "card",
          "cards", "column", "container", "content", "desktop", "dialog", "element", "fixed",
          "global", "group", "header", "icons", "inner", "item", "items", "left", "link", "links",
          "list", "media", "message", "mobile", "module", "outer", "panel", "posts", "primary",
          "right", "row", "secondary", "section", "site", "sticky", "stories", "text", "title",
          "tools", "top", "unit", "wrap", "wrapper"}
#: Words before a hint that say of an element what it has or has not, and words after it
#: that make it another thing.
BEFORE = {"no", "not", "non", "has", "have", "with", "without", "hide", "show", "is"}
AFTER = {"result", "results", "page", "layout"}
#: Weights of features without labelled cases: a word, a word in a link, a word inside
#: and outside the article of a page that has one, a tag.
DEFAULTS = {"word": 1.0, "word:link": -0.5, "word:in": 1.0, "word:out": -1.0, "tag": -2.0}
#: Weights lie between these, and a tag's is at most the last.
LOWEST, HIGHEST, LEAST_COST = -4.0, 4.0, -0.01

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true",
                     re.IGNORECASE)
_NAME = re.compile("[a-z]+")


def _names_part(token: str, sure: bool) -> bool:
    """Whether a class, id or role names a part that is not main text (``sure``: always)."""
    names = _NAME.findall(token)
    if not names or names[-1] in AFTER or any(n in BEFORE for n in names[:-1]):
        return False
    if any(n in HINTS or n in COMMENT_HINTS for n in names):
        return True
    return not sure and any(n in PARTS for n in names) and all(n in PARTS or n in PLACES for n in names)


def _hinted(attributes: str, sure: bool) -> bool:
    """Whether the attributes mark an element as hidden or no main text.

    ``sure``: names in PARTS do not count; nor do they beside a name in MAIN.
    """
    if not attributes or attributes.isspace():
        return False
    if _HIDDEN.search(_ATTRIBUTE.sub("", attributes)):
        return True
    tokens = [token for _, value in _ATTRIBUTE.findall(attributes)
              for token in value.strip("\"'").lower().split()]
    sure = sure or any(token in MAIN for token in tokens)
    return any(_names_part(token, sure) for token in tokens)


def parse(page: str | None) -> tuple[list[tuple], int]:
    """(items, number of article elements, or else of main elements) of a page.

    Items: ("text", text, skipped, in_article, in_link) and ("tag", name, skipped,
    in_article, in_link). Unclosed and misplaced tags are taken as they come. Articles in
    skipped elements count only where there is none outside them.
    """
    for sure in (False, True):
        items, articles, inner = _scan(page or "", sure, enter=False)
        if not articles and inner:
            items, articles, _ = _scan(page or "", sure, enter=True)
        if any(kind == "text" and not skipped and (inside or not articles)
               and not what.isspace() for kind, what, skipped, inside, _ in items):
            break
    return items, articles


def _scan(page: str, sure: bool, enter: bool) -> tuple[list[tuple], int, int]:
    """Items and articles of a page, and the articles inside skipped elements.

    ``sure``: names in PARTS do not count. ``enter``: an article ends the skipped element
    that it is in.
    """
    items: list[tuple] = []
    articles = mains = inner = depth = links = at = 0
    skip, nested = None, 0
    position = 0
    while True:
        m = _TAG.search(page, position)
        text = page[at:m.start()] if m else page[at:]
        if text:
            items.append(("text", text, skip is not None, depth > 0, links > 0))
        if not m:
            return items, articles or mains, inner
        at = position = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                items.append(("text", m[0][9:-3], skip is not None, depth > 0, links > 0))
            continue
        closing, name = bool(m[1]), m[2].lower()
        if name in RAW and not closing:
            end = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.IGNORECASE).search(page, at)
            close = page.find(">", end.end()) if end else -1
            at = position = close + 1 if close >= 0 else len(page)
            continue
        container = name in ("article", "main")
        if skip is not None:
            inner += container and not closing
            if container and not closing and enter or closing and name in ("body", "html"):
                skip = None
            elif skip == "p" and name in BLOCK:
                skip = None
                if closing and name == "p":
                    continue
            elif skip == "li" and (name in ("ul", "ol") and closing or name == "li"):
                skip = None
                if closing and name == "li":
                    continue
            elif name == skip and name not in VOID:
                nested += -1 if closing else 1
                if nested == 0:
                    skip = None
        if skip is None and not closing and name not in VOID:
            if name in NEVER or (name not in ("body", "html") and not (container and enter)
                                 and _hinted(m[3], sure)):
                skip, nested = name, 1
                inner += container
        skipped = skip is not None
        if not skipped:
            if container:
                if not closing:
                    articles, mains = articles + (name == "article"), mains + (name == "main")
                depth = max(0, depth + (-1 if closing else 1))
            elif name == "a":
                links = 0 if closing else 1
        items.append(("tag", name, skipped, depth > 0, links > 0))


def _feature(name: str) -> str:
    return name if name in BLOCK or name in INLINE or name in NEVER else "other"


def label_counts(page: str | None) -> Counter:
    """(feature, is content) counts of a labelled page; empty for other pages."""
    items, articles = parse(page)
    counts: Counter = Counter()
    if articles != 1:
        return counts
    for kind, what, skipped, inside, link in items:
        content = inside and not skipped
        if kind == "tag":
            counts[_feature(what), content] += 1
            continue
        n = len(what.split())
        if n:
            counts["word:link" if link else "word", content] += n
            if not skipped:
                counts["word:in" if inside else "word:out", content] += n
    return counts


def learn_weights(pages: DataFrame, page_col: str = "html") -> dict[str, float]:
    """Weights of all features, from all labelled pages."""
    prepare(pages.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                total.update(label_counts(page.as_py()))
        rows = [(f, n if content else 0, 0 if content else n) for (f, content), n in total.items()]
        cols = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.int64())], names=["feature", "content", "other"])

    # At most one row for each feature of the fixed list.
    rows = (pages.select(page_col).mapInArrow(run, "feature string, content long, other long")
            .groupBy("feature").agg(F.sum("content").alias("content"),
                                    F.sum("other").alias("other")).collect())
    counts = {r["feature"]: (r["content"], r["other"]) for r in rows}
    weights = dict(DEFAULTS)
    if not counts:
        return weights
    sums = [sum(c[i] for f, c in counts.items() if f not in ("word:in", "word:out")) + 1
            for i in (0, 1)]
    for feature, (content, other) in counts.items():
        odds = log((content + 0.5) / sums[0]) - log((other + 0.5) / sums[1])
        odds = min(HIGHEST, max(LOWEST, odds))
        weights[feature] = odds if feature.startswith("word") else min(LEAST_COST, odds)
    weights["word"] = max(0.5, weights["word"])
    return weights


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The words of the best run, block by block."""
    items, articles = parse(page)
    best = total = 0.0
    start = low = end = 0
    for i, (kind, what, skipped, inside, link) in enumerate(items):
        if skipped:
            continue
        if kind == "tag":
            # Every tag inside an article is content on a labelled page: the least cost.
            total += (LEAST_COST if articles and inside
                      else weights.get(_feature(what), weights["tag"]))
        else:
            n = len(what.split())
            if not n:
                continue
            weight = weights["word:link" if link else "word"]
            if articles:
                weight = weights["word:in" if inside else "word:out"]
            total += n * weight
        if total <= 0:
            total, low = 0.0, i + 1
        elif total > best:
            best, start, end = total, low, i + 1
    blocks: list[str] = []
    words: list[str] = []
    for kind, what, skipped, inside, _ in items[start:end]:
        if kind == "text":
            if not skipped and (inside or not articles):
                words.append(entities.unescape(what))
        elif what in BLOCK:
            blocks.append("".join(words))
            words = []
        elif what in ("br", "td", "th"):
            words.append(" ")
    blocks.append("".join(words))
    return "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def extract(pages: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id",
            url_col: str = "url", page_col: str = "html") -> DataFrame:
    """page_id, url, text of every page; weights are learned from ``pages`` if not given."""
    prepare(pages.sparkSession)
    if weights is None:
        weights = learn_weights(pages, page_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(p.as_py(), weights) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(page_col).alias("html"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
