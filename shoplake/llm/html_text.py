"""Main text of web pages by tag-path ratios.

Every text node is filed under its root-to-leaf tag path (with class and id). Per page and path, text length and punctuation are
averaged over the path's nodes; the averages are smoothed along the page, fused with what the path's tags and names say, and
paths whose fused ratio reaches a share of the page's largest are content. Names of classes and ids, and where a page has content
containers being outside of them, are weights. Headings, lists and short paragraphs that belong to selected blocks are kept with them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import mapped, slices

#: Share of a page's largest fused ratio that a path must reach.
SHARE = 0.25
#: Smoothing along the page, in text nodes.
SIGMA = 1.0
#: Of a path's text, the most that may be link text, outside of long texts.
MOST_LINKED = 0.5
#: Weights of paths that are named like boilerplate, and of those outside of the page's content containers.
NAMED = 0.1
OUTSIDE = 0.1
#: A tag that encloses more than this share of the page's text is not judged by its names.
MOST_TEXT = 0.5

# --- fixed values: what HTML and common page layouts call things --------------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening tag ends an open element of these kinds, if it is nearer than the named container.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
BOILERPLATE_TAGS = frozenset("nav footer aside form button label fieldset dialog menu head".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs pagination pager header masthead footer foot sidebar side widget aside related recommended recommendations comment comments "
    "disqus reply replies respond reactions share sharing social cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login search form toolbar copyright legal disclaimer skip tags tagcloud".split()
)
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
CONTENT_TAGS = frozenset(["article", "main"])
#: Whole classes or ids of what readers wrote, whatever its share of the page.
COMMENTS = re.compile(r"(comments?|replies|disqus\w*|respond)([-_](list|area|section|thread|threads|block|box|wrap|wrapper|container|content|body|text|form|item|entry|\d+))*")
#: Names that inside of a content container mean a part of it.
HEADING_NAMES = frozenset(["header", "masthead"])
#: Blocks of these kinds are kept with selected ones.
PROSE_TAGS = frozenset("h1 h2 h3 h4 h5 h6 p li dd dt blockquote pre figcaption td th caption details summary".split())
#: Of these, all but list items may be nothing but a link inside of a content container; lists of links are menus.
LINK_LISTS = frozenset(["li"])
CONTENT_NAMES = frozenset(["articlebody", "article-body", "article-content", "post-content", "entry-content", "main-content", "story-body"])
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？]")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|itemprop|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?(?=[\s/]|$)", re.I)
_NAMES = re.compile(r"[a-z0-9]+")
#: The characters that Unicode calls white space.
_BLANKS = " \t\n\r\f\v\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_WHITE = re.compile(f"[{_BLANKS}]+")


@dataclass(frozen=True)
class Step:
    """One tag of a path."""

    tag: str
    name: str  # tag with class and id, as paths are compared
    boilerplate: bool
    content: bool
    names: frozenset[str]  # those that boilerplate has


def _step(tag: str, rest: str, seen: dict[tuple[str, str], Step]) -> Step:
    if (tag, rest) not in seen:
        found = {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(rest)} if rest else {}
        named = f"{found.get('class', '')} {found.get('id', '')}".lower()
        words = set(_NAMES.findall(named))
        hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
        content = tag in CONTENT_TAGS or bool(CONTENT_NAMES & {*named.split(), found.get("itemprop", "").lower()})
        poor = hidden or tag in BOILERPLATE_TAGS or found.get("role", "").lower() in BOILERPLATE_ROLES
        comment = tag not in ("html", "body", "main") and any(COMMENTS.fullmatch(name) for name in named.split())
        names = frozenset() if tag in ("html", "body") or tag in CONTENT_TAGS else frozenset(words & BOILERPLATE_NAMES)
        seen[tag, rest] = Step(tag, f"{tag}.{named.strip()}", comment or (poor and not (content and tag in CONTENT_TAGS)), content and not comment, names)
    return seen[tag, rest]


@dataclass
class Element:
    """An element with boilerplate names: the length of its text, and whether it encloses a content container."""

    length: int = 0
    holds: bool = False


@dataclass
class Node:
    """A text node: its path, whether a content container and boilerplate enclose it, link text, block number and text.

    ``named``: whether a name says boilerplate; ``tag``: the block it stands in; ``home``: number of the innermost content container, or 0.
    """

    path: tuple[str, ...]
    inside: bool
    poor: bool
    linked: bool
    block: int
    text: str
    tag: str = ""
    home: int = 0
    named: bool = False


def text_nodes(html: str) -> list[Node]:
    """The page's text nodes in order. Elements that HTML closes by itself are closed; an end tag without a start is passed over."""
    nodes: list[Node] = []
    stack: list[Step] = []
    open_as: list[tuple[Element | None, int]] = []  # along with the stack: the element if it has names, and the innermost container
    under: list[list[Element]] = []  # of each node
    homes = 0
    seen: dict[tuple[str, str], Step] = {}
    block = at = 0

    def text(raw: str) -> None:
        if raw:
            inside = any(s.content for s in stack)
            first = next((k for k, s in enumerate(stack) if s.content), len(stack))
            # A heading group inside the article belongs to it; a page's own header does not.
            poor = any(s.boilerplate for s in stack) or any(s.tag == "header" for s in stack[:first])
            tag = next((s.tag for s in reversed(stack) if s.tag in BLOCKS), "")
            home = open_as[-1][1] if open_as else 0
            nodes.append(Node(tuple(s.name for s in stack), inside, poor, any(s.tag == "a" for s in stack), block, unescape(raw), tag, home))
            # Inside a container, a heading group's name is none of boilerplate.
            under.append([e for k, (e, _) in enumerate(open_as) if e and (k < first or stack[k].names - HEADING_NAMES)])
            for e, _ in open_as:
                if e:
                    e.length += len(raw.strip())

    def judged() -> list[Node]:
        most = MOST_TEXT * sum(len(n.text.strip()) for n in nodes)
        for n, elements in zip(nodes, under, strict=True):
            n.named = any(not e.holds and e.length <= most for e in elements)
        return nodes

    while True:
        m = _TOKEN.search(html, at)
        if not m:
            text(html[at:])
            return judged()
        text(html[at : m.start()])
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        closing = bool(m["close"] or m["close2"])
        block += tag in BLOCKS
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    del stack[k:], open_as[k:]
                    break
                # An inline end tag does not reach past the block it stands in.
                if tag not in BLOCKS and stack[k].tag in BLOCKS:
                    break
            continue
        rest = m["rest"] if m["tag"] else m["rest2"]
        if tag in BLOCKS and tag != "br":
            kinds, until = CLOSES.get(tag, (frozenset(), frozenset()))
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == "p" or stack[k].tag in kinds:
                    del stack[k:], open_as[k:]
                    break
                if stack[k].tag in until or (stack[k].tag in BLOCKS and tag not in CLOSES):
                    break
        if tag in RAW and not rest.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in VOID:
            step = _step(tag, rest, seen)
            home = open_as[-1][1] if open_as else 0
            if step.content:
                homes += 1
                home = homes
                for e, _ in open_as:
                    if e:
                        e.holds = True
            stack.append(step)
            open_as.append((Element() if step.names else None, home))


def _ratios(nodes: list[Node]) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Path number of each node, each path's fused ratio, and its share of link text."""
    numbers: dict[tuple, int] = {}
    of = [numbers.setdefault((n.path, n.inside, n.poor, n.named), len(numbers)) for n in nodes]
    length = np.array([len(n.text.strip()) for n in nodes], float)
    marks = np.array([len(PUNCTUATION.findall(n.text)) for n in nodes], float)
    linked = np.array([n.linked for n in nodes], float)
    paths, count = len(numbers), np.bincount(of)
    ratio = np.bincount(of, length, paths) / count * (1.0 + np.bincount(of, marks, paths) / count)
    # Along the page a node takes on some of its neighbours' path ratio; a path has the mean over its nodes.
    window = np.exp(-0.5 * (np.arange(-3, 4) / SIGMA) ** 2)
    smooth = np.convolve(ratio[of], window, "same")[: len(of)] if len(of) > 6 else np.convolve(ratio[of], window)[3 : 3 + len(of)]
    smooth /= np.convolve(np.ones(len(of)), window)[3 : 3 + len(of)]
    mean = np.bincount(of, smooth, paths) / count
    own = np.bincount(of, length, paths)
    link_share = np.bincount(of, length * linked, paths) / np.maximum(own, 1.0)
    first = {p: n for n, p in zip(reversed(nodes), reversed(of), strict=True)}
    marked = any(n.inside and not n.poor for n in nodes)
    prior = np.array([(not first[p].poor) * (NAMED if first[p].named else 1.0) * (OUTSIDE if marked and not first[p].inside else 1.0) for p in range(paths)])
    return of, np.sqrt(ratio * mean) * prior, link_share


def _with_them(groups: dict[int, list[Node]], chosen: set[int]) -> set[int]:
    """Blocks of prose that belong to the chosen ones: in their container or, outside of containers, between two or headings right before one.

    Neither boilerplate nor mostly links.
    """
    homes = {groups[b][0].home for b in chosen} - {0}
    outside = [b for b in chosen if not groups[b][0].home]
    first, last = min(outside, default=0), max(outside, default=0)
    found: set[int] = set()
    above = False  # whether the block below is kept
    for b in sorted(groups, reverse=True):
        nodes = groups[b]
        size = sum(len(n.text) for n in nodes)
        linked = sum(len(n.text) for n in nodes if n.linked)
        prose = nodes[0].tag in PROSE_TAGS and not any(n.poor or n.named for n in nodes)
        prose &= linked <= MOST_LINKED * size or (nodes[0].home in homes and nodes[0].tag not in LINK_LISTS)
        heading = nodes[0].tag[:1] == "h"
        near = nodes[0].home in homes or (not nodes[0].home and (first < b < last or (above and heading)))
        if b not in chosen and prose and near:
            found.add(b)
        above = (b in chosen or b in found) and not nodes[0].home
    return found


def extract(html: str | None, share: float = SHARE) -> str:
    """The main text: content blocks with white space made single blanks, joined by line ends. NULL and empty pages give ''."""
    nodes = [n for n in text_nodes(html or "") if n.text]
    worded = [n for n in nodes if n.text.strip(_BLANKS)]
    if not worded:
        return ""
    of, fused, link_share = _ratios(worded)
    least = share * fused.max(initial=0.0)
    good = [f > 0 and f >= least and not (l > MOST_LINKED and f < 1.0) for f, l in zip(fused, link_share, strict=True)]
    groups: dict[int, list[Node]] = {}
    for n in worded:
        groups.setdefault(n.block, []).append(n)
    chosen = {n.block for n, p in zip(worded, of, strict=True) if good[p]}
    chosen |= _with_them(groups, chosen)
    blocks: dict[int, list[str]] = {}
    for n in nodes:
        if n.block in chosen and not n.poor:
            blocks.setdefault(n.block, []).append(n.text)
    lines = (_WHITE.sub(" ", "".join(parts)).strip(_BLANKS) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def _extracted(batches: Iterator[pa.RecordBatch], share: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [extract(h, share) for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], ["page_id", "url", "text", "n_chars"]
        )


def main_text(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html; other columns are not read).

    A NULL or empty html gives an empty text. Repeated rows each come back. Markup that is cut off ends with the page. An empty
    table gives no rows.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return mapped(rows, lambda b: _extracted(b, share), "page_id long, url string, text string, n_chars long")
