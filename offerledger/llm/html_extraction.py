"""HTML extraction: a tree-structured graphical model over the DOM, trained from labelled pages.

Pages are parsed tolerantly (unclosed and stray tags, raw-text elements, comments).  Every block-level
element is a binary variable, content or not, with a potential from its own features (tag, words in
class, id and role, text, links, punctuation, place in the page) and one for each parent-child pair,
by the kind of the child.  Sum-product messages pass from the leaves up and from the root down, over
all pages of an Arrow batch at once, level by level; a block's text is kept if the marginal of its
element is at least CONTENT_FROM.  Potentials are fitted by maximum likelihood, with exact marginals, on
labelled pages (html_training).

Text: character references decoded, white space inside a block (a line break element counts as white
space) becomes one space, blocks are trimmed and joined in page order by one \\n.

Cases: null and empty html give ''; repeated rows each get a row; null ids and urls are kept; broken
markup never fails, and an element that isn't closed ends with its parent; a comment without an end reaches to the end
of the page, and what looks like a tag without one is text; a very long page is read whole, in time linear in its
length; a page of one bare paragraph, where nothing tells content from notices, gives ''; an empty table gives an empty result; other columns, whatever their names, are not
looked at.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerledger.llm import html_training, kernel, learn, shared

CONTENT_FROM = 0.5
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^\"'<>]++|\"[^\"]*+\"|'[^']*+')*+)/?>|<(/?)([a-zA-Z][\w:-]*)([^>]*)>", re.S)
_LABELS = re.compile(r"""(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_BODY = re.compile(r"<body\b", re.I)
_MARKED = re.compile(r"""data-y\s*=\s*"([01])\"""")

# Kinds of elements.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: what stands in these is no text of the page; an unclosed script or style reaches to the end, as in browsers
RAW = set("script style template iframe head title textarea".split())
TO_END = {"script", "style"}
_END = {tag: re.compile(rf"</{tag}\b[^>]*>", re.I) for tag in RAW}
KINDS = {
    "root": "html body",
    "nav": "nav menu",
    "header": "header",
    "footer": "footer",
    "aside": "aside",
    "form": "form fieldset dialog button label legend select optgroup option",
    "article": "article main",
    "section": "section div center td th table tbody thead tfoot tr figure details hgroup address",
    "paragraph": "p blockquote pre dd dt summary figcaption",
    "heading": "h1 h2 h3 h4 h5 h6",
    "list": "ul ol dl",
    "item": "li",
}
KIND_OF = {tag: i for i, tags in enumerate(KINDS.values()) for tag in tags.split()}
# Words in class, id and role that say what an element is for.
CUES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toolbar tabs pagination pager toc skip",
    "head": "header masthead banner logo branding topbar hero",
    "foot": "footer foot bottom copyright legal colophon contentinfo",
    "side": "sidebar side aside widget related recommended trending rail complementary more popular",
    "advert": "ad ads advert adverts advertisement promo promotion sponsor sponsored banner affiliate",
    "notice": "notice notices cookie cookies consent gdpr alert popup modal overlay subscribe newsletter signup paywall disclaimer message",
    "comment": "comment comments reply replies respond discussion disqus thread feedback",
    "form": "form search login register contact input",
    "share": "share sharing social follow tags meta byline author date",
    "main": "article content main post entry story body text page prose",
}
CUE_OF: dict[str, list[int]] = {}
for _i, _words in enumerate(CUES.values()):
    for _w in _words.split():
        CUE_OF.setdefault(_w, []).append(_i)
#: an opening tag ends an open paragraph, and open elements of the same row; other blocks end lists of choices
CHOICES = {"select", "optgroup", "option"}
CLOSES = {"option": {"option"}, "optgroup": {"option", "optgroup"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
N_FEATURES = len(KINDS) + 2 * len(CUES) + 13


@dataclass
class Element:
    tag: str
    parent: int
    cues: list[int] = field(default_factory=list)
    label: int | None = None
    chars: int = 0
    links: int = 0
    stops: int = 0
    words: int = 0
    hidden: bool = False


def parse(page: str) -> tuple[list[Element], list[tuple[int, str]]]:
    """Block elements in page order (the first is the root), and (element, text) of each text block."""
    elements, blocks = [Element("html", -1)], []
    # Open block elements: (tag, number, links open in it).  Inline elements need no place: they end with their block.
    stack: list[list] = [["html", 0, 0]]
    n_open = Counter(html=1)
    pieces: list[str] = []
    at, size, in_link = 0, len(page), 0
    # Behind the last > there is no tag, so no search for the end of one goes there; what isn't found once never will be.
    last = page.rfind(">") + 1
    missing: set[str] = set()

    def found(name: str, pattern: re.Pattern, end: int) -> re.Match | None:
        m = None if name in missing else pattern.search(page, at, end)
        if m is None:
            missing.add(name)
        return m

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                e = elements[stack[-1][1]]
                e.chars += len(text)
                e.words += text.count(" ") + 1
                e.stops += sum(map(text.count, ".!?,;:"))
                blocks.append((stack[-1][1], text))

    def close_top() -> None:
        nonlocal in_link
        flush()
        tag, _, links = stack.pop()
        n_open[tag] -= 1
        in_link -= links

    for m in _TOKEN.finditer(page, 0, last):
        if m.start() < at:
            continue
        if m[0].startswith("<!--") and not m[0].endswith("-->", 4):
            pieces.append(page[at : m.start()])
            at = size  # a comment without an end
            break
        if m.start() > at:
            pieces.append(page[at : m.start()])
            if in_link > 0:
                elements[stack[-1][1]].links += m.start() - at
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        is_end, rest = bool(m[1] or m[4]), m[3] or m[6] or ""
        if is_end:
            if tag in KIND_OF and tag != "html" and n_open[tag]:
                while stack[-1][0] != tag:
                    close_top()
                close_top()
            elif tag == "a" and stack[-1][2]:
                stack[-1][2] -= 1
                in_link -= 1
        elif tag in RAW and not rest.endswith("/"):
            end = found(f"/{tag}", _END[tag], last)
            if end:
                at = end.end()
            elif tag in TO_END:
                at = size
            elif tag == "head":
                body = found("body", _BODY, last)
                at = body.start() if body else at
            pieces.append(" ")
        elif tag == "br" or tag == "wbr":
            pieces.append(" " if tag == "br" else "")
        elif tag in VOID:
            if tag == "hr":
                flush()
        elif tag in KIND_OF:
            if tag == "html" or (tag == "body" and n_open["body"]):
                continue
            flush()
            ends = CLOSES.get(tag, CHOICES)
            while stack[-1][0] == "p" or stack[-1][0] in ends or (stack[-1][0] in CHOICES and tag not in CHOICES):
                close_top()
            parent = stack[-1][1]
            cues = [c for m_ in _LABELS.finditer(rest) for w in _WORD.findall(m_[1] or m_[2] or m_[3] or "") for c in CUE_OF.get(w.lower(), ())]
            mark = _MARKED.search(rest)
            elements.append(Element(tag, parent, sorted(set(cues)), int(mark[1]) if mark else elements[parent].label, hidden="hidden" in rest or "display:none" in rest.replace(" ", "")))
            stack.append([tag, len(elements) - 1, 0])
            n_open[tag] += 1
        elif tag == "a":
            stack[-1][2] += 1
            in_link += 1
    if at < size:
        comment = page.find("<!--", max(at, last))
        pieces.append(page[at : comment if comment >= 0 else size])
    flush()
    return elements, blocks


@dataclass
class Forest:
    """Elements of many pages: features, parents (-1: root), kinds of the parent-child pairs, and levels."""

    x: np.ndarray
    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]


def forest_of(pages: list[list[Element]]) -> Forest:
    total = sum(map(len, pages))
    x, parent, kind = np.zeros((total, N_FEATURES)), np.full(total, -1), np.zeros(total, np.int64)
    depth, base = np.zeros(total, np.int64), 0
    n_kinds, n_cues = len(KINDS), len(CUES)
    for elements in pages:
        n = len(elements)
        chars = np.array([e.chars for e in elements], float)
        links = np.array([min(e.links, e.chars) for e in elements], float)
        under = [set(e.cues) for e in elements]
        for i in range(1, n):  # parents come before children
            p = elements[i].parent
            parent[base + i], depth[base + i] = base + p, depth[base + p] + 1
            under[i] |= under[p]
        all_chars, all_links = chars.copy(), links.copy()
        for i in range(n - 1, 0, -1):
            all_chars[elements[i].parent] += all_chars[i]
            all_links[elements[i].parent] += all_links[i]
        most = max(all_chars[0], 1)
        before = np.cumsum(chars) - chars
        for i, e in enumerate(elements):
            row = x[base + i]
            k = KIND_OF.get(e.tag, KIND_OF["div"])
            kind[base + i] = k
            row[k] = 1
            row[[n_kinds + c for c in e.cues]] = 1
            row[[n_kinds + n_cues + c for c in under[i]]] = 1
            row[n_kinds + 2 * n_cues :] = (
                1, np.log1p(e.chars) / 5, links[i] / chars[i] if chars[i] else 0, all_links[i] / all_chars[i] if all_chars[i] else 0,
                np.log1p(e.words) / 5, min(e.stops / max(e.words, 1), 0.5), all_chars[i] / most, e.hidden, chars[i] == 0,
                before[i] / most < 0.05, before[i] / most > 0.9, e.words > 12, min(depth[base + i], 10) / 10,
            )
        base += n
    return Forest(x, parent, kind, [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)])


def messages(f: Forest, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Sum-product over the forest: log beliefs (n, 2), upward parts (n, 2), messages to parents (n, 2), log partition."""
    up = np.zeros((len(unary), 2))
    up[:, 1] = unary
    to_parent = np.zeros_like(up)
    for nodes in reversed(f.levels[1:]):
        sent = np.logaddexp.reduce(pair[f.kind[nodes]] + up[nodes][:, None, :], axis=2)
        to_parent[nodes] = sent
        np.add.at(up, f.parent[nodes], sent)
    belief = up.copy()
    for nodes in f.levels[1:]:
        rest = belief[f.parent[nodes]] - to_parent[nodes]
        belief[nodes] += np.logaddexp.reduce(pair[f.kind[nodes]] + rest[:, :, None], axis=1)
    roots = f.levels[0]
    return belief, up, to_parent, float(np.logaddexp.reduce(up[roots], axis=1).sum())


def marginals(f: Forest, w: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Probability of content of every element."""
    belief = messages(f, f.x @ w, pair)[0]
    return learn.sigmoid(belief[:, 1] - belief[:, 0])


def fit(pages: list[str], penalty: float = 0.003) -> tuple[np.ndarray, np.ndarray]:
    """Potentials of the likeliest model of labelled pages (elements carry data-y, inherited downwards)."""
    parsed = [parse(p)[0] for p in pages]
    f = forest_of(parsed)
    y = np.array([e.label or 0 for elements in parsed for e in elements])
    child = np.flatnonzero(f.parent >= 0)
    kinds, n_kinds = f.kind[child], len(KINDS)
    seen = np.zeros((n_kinds, 2, 2))
    np.add.at(seen, (kinds, y[f.parent[child]], y[child]), 1)

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        w, pair = p[:N_FEATURES], p[N_FEATURES:].reshape(n_kinds, 2, 2)
        belief, up, to_parent, log_z = messages(f, f.x @ w, pair)
        prob = learn.sigmoid(belief[:, 1] - belief[:, 0])
        both = pair[kinds] + (belief[f.parent[child]] - to_parent[child])[:, :, None] + up[child][:, None, :]
        both = np.exp(both - np.logaddexp.reduce(both.reshape(len(child), 4), axis=1)[:, None, None])
        expected = np.zeros_like(seen)
        np.add.at(expected, kinds, both)
        value = log_z - float((f.x @ w) @ y) - float((pair * seen).sum()) + penalty * len(pages) / 2 * float(p @ p)
        return value / len(y), np.r_[f.x.T @ (prob - y) + penalty * len(pages) * w, (expected - seen).ravel() + penalty * len(pages) * pair.ravel()] / len(y)

    p = learn.minimise(loss, np.zeros(N_FEATURES + 4 * n_kinds), steps=120, tolerance=1e-5)
    return p[:N_FEATURES], p[N_FEATURES:].reshape(n_kinds, 2, 2)


def extract(pages: list[str], model: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """Main text of each page."""
    parsed = [parse(p) for p in pages]
    if not parsed:
        return []
    content = marginals(forest_of([elements for elements, _ in parsed]), *model) >= CONTENT_FROM
    out, base = [], 0
    for elements, blocks in parsed:
        out.append("\n".join(text for e, text in blocks if content[base + e]))
        base += len(elements)
    return out


def main_texts(pages: DataFrame, labelled: list[str] | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(fit(labelled or html_training.labelled_pages()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in kernel.slices(whole, "html", 1 << 20):
                texts = extract(batch.column("html").to_pylist(), sent.value)
                yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(work, "page_id long, url string, text string, n_chars long")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(shared.table(spark, sf_dir, "pages"))
