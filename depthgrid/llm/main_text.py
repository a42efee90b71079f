"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

Each block element is a node with features of its place (depth, order, siblings), its subtree
(text and link density, tags, punctuation, controls), its tag and its ancestors' tags, and hashed
class, id and role tokens of its own and its ancestors. Boosted trees give each node a
probability of holding main text. Decoding maximises the sum of log probabilities under the rule
that below a dropped node everything is dropped, by one pass up and one down the tree, so that an
ancestor and a descendant never contradict each other. The kept nodes' blocks are the text.

Training pages come from the given table: at most SAMPLE_PAGES pages (a documented bound, those
of the smallest md5 of the id) are cut into their parts where their markup names them, and the
parts are laid out anew in LAYOUTS drawn structures, whose parts are known. Scoring is one pass over every
page without a shuffle.

Defined cases: a null or empty page has an empty text; broken or cut-off markup is read as far as
it goes; without a training page nothing is known to be clutter and all text is kept; white space
(Unicode's included) becomes one space; rows are read each on their own, so ties and repeats need
no rule; a very long page is read whole, in time and memory linear in its elements; an empty table
gives an empty table; other columns are carried on request.
"""

from __future__ import annotations

import html
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthgrid.llm import words
from depthgrid.llm.dom import Page, read
from depthgrid.llm.shared import stored
from depthgrid.llm.trees import Forest, fit_forest

SAMPLE_PAGES, LAYOUTS, SEED = 240, 960, 5
TOKEN_BITS = 64
#: Log probability that it costs to drop a node whose parent is kept.
CHANGE = 1.0

TAGS = (
    "html div article main section nav header footer aside form ul ol li p h1 h2 h3 table tr td "
    "blockquote pre figure figcaption dl"
).split()
ABOVE = "nav header footer aside form article main section ul ol table figure blockquote".split()
_TAG_NO, _ABOVE_NO = {t: k for k, t in enumerate(TAGS)}, {t: k for k, t in enumerate(ABOVE)}
NUMBERS = 26
FEATURES = NUMBERS + len(TAGS) + len(ABOVE) + 2 * TOKEN_BITS
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_STOPS = str.maketrans("", "", ".,;:!?")


def _slot(token: str) -> int:
    return zlib.crc32(token.encode()) % TOKEN_BITS


def features(page: Page) -> np.ndarray:
    """One row per node."""
    n = len(page.tags)
    parent = np.array(page.parents)
    own, own_links, segments, stops = (np.zeros(n) for _ in range(4))
    for owner, text, linked in zip(page.owners, page.texts, page.linked):
        own[owner] += len(text)
        own_links[owner] += linked
        segments[owner] += 1
        stops[owner] += len(text) - len(text.translate(_STOPS))
    controls = np.array(page.controls, float)
    heads = np.array([t in _HEADINGS for t in page.tags], float)
    paragraphs = np.array([t == "p" for t in page.tags], float)
    text, links, blocks, marks, below = own.copy(), own_links.copy(), segments.copy(), stops.copy(), np.ones(n)
    depth, children = np.zeros(n), np.zeros(n)
    sums = (text, links, blocks, marks, below, controls, heads, paragraphs)
    for k in range(n - 1, 0, -1):
        up = page.parents[k]
        children[up] += 1
        for total in sums:
            total[up] += total[k]
    x = np.zeros((n, FEATURES), np.float32)
    tags, above = x[:, NUMBERS : NUMBERS + len(TAGS)], x[:, NUMBERS + len(TAGS) :]
    tokens = above[:, len(ABOVE) + TOKEN_BITS :]
    inherited, passed = above[:, : len(ABOVE)], above[:, len(ABOVE) : len(ABOVE) + TOKEN_BITS]
    seen = np.zeros(n)
    place, count, same = np.zeros(n), np.ones(n), np.ones(n)
    before, after, around = np.zeros(n), np.zeros(n), np.zeros(n)
    families: dict[int, list[int]] = {}
    for k, tag in enumerate(page.tags):
        up = page.parents[k]
        if up >= 0:
            depth[k] = depth[up] + 1
            inherited[k] = inherited[up]
            passed[k] = passed[up]
            families.setdefault(up, []).append(k)
        if tag in _TAG_NO:
            tags[k, _TAG_NO[tag]] = 1
        if tag in _ABOVE_NO:
            inherited[k, _ABOVE_NO[tag]] = 1
        for token in page.names[k]:
            tokens[k, _slot(token)] = 1
            passed[k, _slot(token)] = 1
    for up, family in families.items():
        kinds = [page.tags[k] for k in family]
        often = Counter(kinds)
        whole = sum(text[k] for k in family)
        for i, k in enumerate(family):
            place[k], count[k] = i / len(family), len(family)
            same[k] = often[kinds[i]] / len(family)
            before[k] = text[family[i - 1]] if i else 0
            after[k] = text[family[i + 1]] if i + 1 < len(family) else 0
            around[k] = text[k] / (whole + 1)
    position = 0.0
    first = np.zeros(n)
    at = 0
    for k in range(n):
        while at < len(page.owners) and page.owners[at] < k:
            position += len(page.texts[at])
            at += 1
        first[k] = position
    total = max(text[0], 1.0)
    up_text = text[np.maximum(parent, 0)]
    columns = (
        depth, np.arange(n) / n, first / total, np.log1p(own), np.log1p(text), text / total,
        links / (text + 1), own_links / (own + 1), np.log1p(below), np.log1p(text / below), children,
        marks / (text + 1), np.log1p(text / (blocks + 1)), place, np.log1p(count), same, around,
        np.log1p(before), np.log1p(after), controls, heads, paragraphs, text / (up_text + 1),
        np.log1p(blocks), stops / (own + 1), np.full(n, np.log1p(total)),
    )
    for k, column in enumerate(columns):
        x[:, k] = column
    return x


def kept_nodes(page: Page, margins: np.ndarray, change: float = CHANGE) -> list[bool]:
    """The best choice for all nodes in which no child of a dropped node is kept.

    Dropping a child of a kept node costs ``change``, so that a lone doubtful block stays with
    its surroundings.
    """
    keep = -np.logaddexp(0, -margins)
    drop = -np.logaddexp(0, margins)
    keep, drop = keep.tolist(), drop.tolist()
    for k in range(len(keep) - 1, 0, -1):
        up = page.parents[k]
        keep[up] += max(keep[k], drop[k] - change)
        drop[up] += drop[k]
    out = []
    for k, up in enumerate(page.parents):
        out.append(keep[k] >= drop[k] if up < 0 else out[up] and keep[k] >= drop[k] - change)
    return out


def assemble(page: Page, kept: list[bool]) -> str:
    return "\n\n".join(t for o, t in zip(page.owners, page.texts) if kept[o])


# ---------------------------------------------------------------- training pages

# Layouts: names that sites give to the parts of a page. (element, attributes)
MAIN = [
    ("article", ""), ("article", ' class="post"'), ("main", ""), ("main", ' id="main"'),
    ("div", ' class="content"'), ("div", ' id="content"'), ("div", ' class="article-body"'),
    ("div", ' class="entry-content"'), ("section", ' class="story"'), ("div", ' class="post-text"'),
    ("div", ' role="main"'), ("div", ""),
]
CLUTTER = {
    "menu": [("nav", ""), ("div", ' class="menu"'), ("div", ' id="navbar"'), ("ul", ' class="nav"'), ("div", ' class="breadcrumbs"')],
    "header": [("header", ""), ("div", ' class="header"'), ("div", ' id="masthead"'), ("header", ' class="site-header"')],
    "footer": [("footer", ""), ("div", ' class="footer"'), ("div", ' id="footer"'), ("div", ' class="copyright"')],
    "sidebar": [("aside", ""), ("div", ' class="sidebar"'), ("div", ' id="sidebar"'), ("div", ' class="related"'), ("div", ' class="widget"'), ("section", ' class="recommended"')],
    "notice": [("div", ' class="cookie-notice"'), ("div", ' class="notice"'), ("div", ' class="banner"'), ("section", ' class="alert"'), ("div", ' id="consent"'), ("p", ' class="disclaimer"')],
    "advert": [("div", ' class="ad"'), ("div", ' class="advert"'), ("div", ' class="ads"'), ("aside", ' class="sponsored"'), ("div", ' class="promo"'), ("div", ' id="advertisement"')],
    "form": [("form", ""), ("form", ' class="newsletter"'), ("form", ' class="search"'), ("div", ' class="subscribe"'), ("div", ' class="login"')],
    "comments": [("section", ' class="comments"'), ("div", ' id="comments"'), ("div", ' class="comment-list"'), ("ol", ' class="replies"'), ("div", ' class="discussion"')],
    "share": [("div", ' class="share"'), ("ul", ' class="social"'), ("div", ' class="tags"')],
}


def page_parts(page: Page) -> tuple[list[str], list[str]]:
    """(main blocks, other blocks) of a page whose markup has an article or main element."""
    inside = []
    for tag, up in zip(page.tags, page.parents):
        inside.append(tag in ("article", "main") or (up >= 0 and inside[up]))
    main = [t for o, t in zip(page.owners, page.texts) if inside[o]]
    return main, [t for o, t in zip(page.owners, page.texts) if not inside[o]]


def _short(draw, pool: list[str], most: int) -> str:
    ws = pool[draw.integers(len(pool))].split()
    size = int(draw.integers(1, most + 1))
    begin = int(draw.integers(max(len(ws) - size, 0) + 1))
    return html.escape(" ".join(ws[begin : begin + size]))


def _clutter(draw, kind: str, pool: list[str]) -> str:
    tag, names = CLUTTER[kind][draw.integers(len(CLUTTER[kind]))]
    some = lambda most: _short(draw, pool, most)
    several = range(int(draw.integers(2, 8)))
    if kind in ("menu", "share") or (kind == "sidebar" and draw.random() < 0.5):
        inner = "".join(f'<li><a href="/{k}">{some(3)}</a></li>' for k in several)
        inner = inner if tag == "ul" else f"<ul>{inner}</ul>" if draw.random() < 0.7 else inner.replace("li>", "span>")
    elif kind == "comments":
        wrap = "li" if tag == "ol" else "div"
        inner = f"<h3>{some(2)}</h3>" * (draw.random() < 0.5) + "".join(
            f'<{wrap} class="comment"><p>{some(3)}</p><p>{some(60)}</p></{wrap}>' for _ in several
        )
    elif kind == "form":
        inner = f"<p>{some(12)}</p><label>{some(2)}</label><input type=text><button>{some(2)}</button>"
    elif kind == "sidebar":
        inner = f"<h3>{some(3)}</h3>" + "".join(f"<p>{some(40)}</p>" for _ in several)
    elif kind == "header":
        inner = f"<p>{some(4)}</p>" if draw.random() < 0.6 else f'<h1>{some(4)}</h1><a href="/">{some(2)}</a>'
    else:
        inner = some(25) if draw.random() < 0.5 or tag == "p" else f"<p>{some(25)}</p>" * int(draw.integers(1, 3))
    return f"<{tag}{names}>{inner}</{tag}>"


def layout(draw, main: list[str], pool: list[str]) -> tuple[str, str]:
    """(page, main part's own first marker) with the parts in a drawn structure.

    The main part's own element carries data-main, clutter inside it data-off; both are read by
    the labelling only.
    """
    pick = lambda kinds, p: "".join(_clutter(draw, k, pool) for k in kinds if draw.random() < p)
    body = []
    for k, block in enumerate(main):
        text, roll = html.escape(block, quote=False), draw.random()
        if k == 0 and roll < 0.8:
            body.append(f"<h1>{text}</h1>")
        elif roll < 0.06:
            body.append(f"<h2>{_short(draw, main, 6)}</h2><p>{text}</p>")
        elif roll < 0.1:
            body.append(f"<blockquote><p>{text}</p></blockquote>")
        elif roll < 0.14:
            body.append("<ul>" + "".join(f"<li>{_short(draw, main, 15)}</li>" for _ in range(3)) + "</ul>")
        elif roll < 0.17:
            body.append(f"<p><b>{text}<br>")
        elif roll < 0.2:
            body.append(f"<div>{text}</div>")
        else:
            body.append(f"<p>{text}</p>")
        if draw.random() < 0.06:
            kind = ("advert", "share", "notice", "form", "sidebar")[draw.integers(5)]
            body.append(f"<!--off-->{_clutter(draw, kind, pool)}<!--on-->")
    tail = [k for k in ("share", "comments") if draw.random() < 0.25]
    body += [f"<!--off-->{_clutter(draw, k, pool)}<!--on-->" for k in tail]
    tag, names = MAIN[draw.integers(len(MAIN))]
    core = f"<!--on--><{tag}{names}>{''.join(body)}</{tag}><!--off-->"
    before = pick(["header", "menu", "notice", "advert", "sidebar", "form"], 0.45)
    after = pick(["comments", "sidebar", "share", "advert", "form", "menu", "notice", "footer"], 0.4)
    inner = f"{before}{core}{after}"
    if draw.random() < 0.4:
        inner = f'<div class="{("page", "container", "wrapper", "layout", "row")[draw.integers(5)]}">{inner}</div>'
    return f"<html><body>{inner}</body></html>"


def labelled(source: str) -> tuple[Page, np.ndarray]:
    """A laid-out page and its nodes' labels: whether the node holds some main text."""
    marked = source.replace("<!--on-->", "\x01").replace("<!--off-->", "\x02")
    page = read(marked)
    label, on = np.zeros(len(page.tags)), False
    owners, texts, linked = [], [], []
    for owner, text, links in zip(page.owners, page.texts, page.linked):
        state = on
        for c in text:
            if c in "\x01\x02":
                on = c == "\x01"
        bare = " ".join(text.replace("\x01", " ").replace("\x02", " ").split())
        if not bare:
            continue
        # marks stand between elements, at the border of a segment's text
        state = on if text[0] in "\x01\x02" else state
        owners.append(owner)
        texts.append(bare)
        linked.append(min(links, len(bare)))
        if state:
            label[owner] = 1
    page.owners, page.texts, page.linked = owners, texts, linked
    for k in range(len(label) - 1, 0, -1):
        label[page.parents[k]] = max(label[page.parents[k]], label[k])
    return page, label


def train(sources: list[str], seed: int = SEED) -> Forest | None:
    """Fit on new layouts of the given pages' parts, and on the pages as they are."""
    draw, rows, labels, parts = np.random.default_rng(seed), [], [], []
    for source in sources:
        page = read(source)
        main, other = page_parts(page)
        if main and other:
            parts.append((page, main, other))
    if not parts:
        return None
    pool = [t for _, main, other in parts for t in (*other, *main[:3])]
    each = -(-LAYOUTS // len(parts))
    for page, main, _ in parts:
        inside = np.zeros(len(page.tags))
        for k, (tag, up) in enumerate(zip(page.tags, page.parents)):
            inside[k] = tag in ("article", "main") or (up >= 0 and inside[up])
        for k in range(len(inside) - 1, 0, -1):
            inside[page.parents[k]] = max(inside[page.parents[k]], inside[k])
        rows.append(features(page))
        labels.append(inside)
        for _ in range(each):
            size = int(draw.integers(1, min(len(main), 30) + 1))
            begin = int(draw.integers(len(main) - size + 1))
            new, label = labelled(layout(draw, main[begin : begin + size], pool))
            rows.append(features(new))
            labels.append(label)
    return fit_forest(np.concatenate(rows), np.concatenate(labels))


def extract(source: str, forest: Forest | None) -> str:
    """Main text of one page."""
    return extract_all([source], forest)[0]


def extract_all(sources: list[str], forest: Forest | None) -> list[str]:
    pages = [read(s) for s in sources]
    if forest is None:
        return [assemble(p, [True] * len(p.tags)) for p in pages]
    tables = [features(p) for p in pages]
    margins = forest.margins(np.concatenate(tables)) if tables else []
    ends = np.cumsum([len(t) for t in tables])
    return [
        assemble(p, kept_nodes(p, margins[e - len(t) : e])) for p, t, e in zip(pages, tables, ends)
    ]


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Forest | None:
    """Train on at most SAMPLE_PAGES pages."""
    named = pages.select(F.col(id_col).alias("__id"), F.col(html_col).alias("__html")).filter(
        F.col("__id").isNotNull() & F.lower(F.col("__html")).rlike("<(article|main)[ >]")
    )
    order = F.md5(F.concat(F.lit("pages:"), F.col("__id").cast("string")))
    ids = stored(named.select("__id").distinct().orderBy(order, "__id").limit(SAMPLE_PAGES))
    found = named.join(F.broadcast(ids), "__id").groupBy("__id").agg(F.min("__html").alias("__html"))
    return train([r["__html"] for r in found.orderBy("__id").collect()])


def main_texts(
    pages: DataFrame, forest: Forest | None, html_col: str = "html", text_col: str = "main_text"
) -> DataFrame:
    """``pages`` with the column ``text_col``; one pass over every whole page."""
    shared = pages.sparkSession.sparkContext.broadcast(forest)  # fixed by the number of trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, html_col):
                sources = [s or "" for s in part.column(html_col).to_pylist()]
                texts = pa.array(extract_all(sources, shared.value), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, text_col])

    schema = pages.schema.fromJson(pages.schema.jsonValue()).add(text_col, "string")
    return pages.mapInArrow(run, schema)
