"""A forgiving HTML reader: block elements as nodes, their inline text as segments."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe svg template select object".split())
CONTROLS = frozenset("button input select textarea option fieldset".split())
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SCOPE = frozenset("ul ol dl table body html td th div article section main aside nav".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)",
    re.S,
)
_LOOSE = re.compile(r"<([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """Block elements in page order (a parent before its children) and their text segments."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    names: list[tuple[str, ...]] = field(default_factory=list)
    controls: list[int] = field(default_factory=list)
    owners: list[int] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


def _tokens_of(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    found = (a or b or c for a, b, c in _NAMES.findall(attributes))
    return tuple(w.lower() for value in found for w in _PIECE.findall(value))


def read(source: str) -> Page:
    """Build the page; unclosed, misnested and cut-off markup never fails."""
    page = Page()
    open_tags: list[tuple[str, int]] = [("html", 0)]  # element, its block node
    page.tags.append("html")
    page.parents.append(-1)
    page.names.append(())
    page.controls.append(0)
    held: Counter[str] = Counter()  # open tags by name
    run: list[str] = []
    links, in_link = 0, 0

    def flush():
        nonlocal links
        if run:
            text = " ".join("".join(run).split())
            if text:
                page.owners.append(open_tags[-1][1])
                page.texts.append(text)
                page.linked.append(min(links, len(text)))
            run.clear()
        links = 0

    def close_to(depth: int):
        nonlocal in_link
        for tag, _ in open_tags[depth:]:
            in_link -= tag == "a"
            held[tag] -= 1
        if any(tag not in INLINE for tag, _ in open_tags[depth:]):
            flush()
        del open_tags[depth:]

    def close_open(which: frozenset, scope: frozenset):
        if not any(held[tag] for tag in which):
            return
        for depth in range(len(open_tags) - 1, 0, -1):
            tag = open_tags[depth][0]
            if tag in which:
                close_to(depth)
                return
            if tag in scope:
                return

    at, end = 0, len(source)
    while at < end:
        cut = source.find("<", at)
        if cut < 0:
            cut = end
        if cut > at:
            text = html.unescape(source[at:cut]) if "&" in source[at:cut] else source[at:cut]
            run.append(text)
            links += len(text) if in_link else 0
            at = cut
            continue
        found = _TOKEN.match(source, at)
        if found is None or (found.group(2) and found.group(4) == "" and ">" in source[at:]):
            found = _LOOSE.match(source, at)  # an unbalanced quote: the tag ends at the next ">"
            if found is None:
                run.append("<")
                at += 1
                continue
            closing, tag, attributes, done = None, found.group(1), found.group(2), found.group(3)
        else:
            closing, tag, attributes, done = found.groups()
        at = found.end()
        if closing:
            name = closing.lower()
            if not held[name]:  # a look at all open tags for each such end would be quadratic
                if name == "p":
                    flush()
                continue
            for depth in range(len(open_tags) - 1, 0, -1):
                if open_tags[depth][0] == name:
                    close_to(depth)
                    break
                if name in INLINE and open_tags[depth][0] not in INLINE:
                    break
            continue
        if not tag or not done:
            continue  # comment, declaration, or a tag cut off at the page's end
        name = tag.lower()
        if name in RAW:
            stop = re.compile(f"</{re.escape(name)}\\b[^>]*(?:>|\\Z)", re.I).search(source, at)
            if name in CONTROLS:
                page.controls[open_tags[-1][1]] += 1
            at = stop.end() if stop else end
            continue
        if name == "br":
            run.append(" ")
            continue
        if name in CONTROLS:
            page.controls[open_tags[-1][1]] += 1
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in ("html", "body", "head"):
            flush()
            if name != "html" and _tokens_of(attributes):
                page.names[0] += _tokens_of(attributes)
            continue
        if name in INLINE:
            if not attributes.rstrip().endswith("/"):
                open_tags.append((name, open_tags[-1][1]))
                held[name] += 1
                in_link += name == "a"
            continue
        if name in CLOSED_BY:
            close_open(CLOSED_BY[name], frozenset("ul ol dl table".split()))
        close_open(frozenset(["p"]), SCOPE)
        flush()
        page.tags.append(name)
        page.parents.append(open_tags[-1][1])
        page.names.append(_tokens_of(attributes))
        page.controls.append(0)
        open_tags.append((name, len(page.tags) - 1))
        held[name] += 1
    flush()
    return page
