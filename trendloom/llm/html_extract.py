"""Main text of web pages by a graphical model on the DOM tree.

Every element is article or not. Unary potentials come from its tag, its class and id words and its text, pairwise
ones from the step between parent and child; sum-product messages up and down the tree give exact marginals. The
weights are trained by gradient ascent on the log-likelihood of labelled pages. Names that training never saw carry
no weight, so blocks under them are judged by their tags, texts and neighbours.
"""

from __future__ import annotations

import collections
import functools
import re
from collections.abc import Iterator, Mapping
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trendloom.llm.labelled_pages import pages as labelled_pages

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end the block before them and after them.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose text is never shown as running text, whatever the model says; a form that holds most of a page's text is none of them.
SILENT = frozenset("script style template head title noscript textarea select button input iframe object svg math canvas audio video form".split())
#: An open element that a start tag ends, and the elements beyond which it is not looked for.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: What may stand in a head; any other start tag, and text, ends an open head.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
FENCE = frozenset("article aside body div section main td th table ul ol li form header footer nav blockquote figure html dd dt button".split())
PAGES = 400
#: Features and tags on fewer training pages than this carry no weight, as those that training never saw.
LEAST_PAGES = 4
SEED = 20240611
STEPS = 200
SPLIT = re.compile(r"[^a-z]+")


class Dom(HTMLParser):
    """Elements in page order: parent, tag, class and id words; and the text pieces with their elements.

    The labels of ``data-y`` are read on labelled pages only; elsewhere it is an attribute like any other.
    """

    def __init__(self, labelled: bool) -> None:
        super().__init__(convert_charrefs=True)
        self.labelled = labelled
        self.parent, self.tag, self.names, self.label = [-1], ["#root"], [()], [0]
        self.pieces: list[tuple[int, str | None]] = []
        self.open = [0]
        self.places = collections.defaultdict(list)

    def _push(self, node: int) -> None:
        self.places[self.tag[node]].append(len(self.open))
        self.open.append(node)

    def _cut(self, place: int) -> None:
        """Close the open elements from ``place`` on; each element is closed once, so pages take time in proportion to their length."""
        while len(self.open) > place:
            self.places[self.tag[self.open.pop()]].pop()

    def _last(self, tags) -> int:
        """Where the innermost open element among ``tags`` stands, 0 if there is none."""
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=0)

    def _end_block(self) -> None:
        self.pieces.append((0, None))

    def _end_head(self) -> None:
        if self.tag[self.open[-1]] == "head":
            self._end_block()
            self._cut(len(self.open) - 1)

    def handle_starttag(self, tag, attrs):
        if tag not in HEAD:
            self._end_head()
        if tag in BLOCKS:
            self._end_block()
            if tag != "p" and tag in ENDS:
                self._pop_to(*ENDS[tag])
            elif tag not in ("option",):
                self._pop_to({"p"}, FENCE)
        names, label = (), 0
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += tuple(x for x in SPLIT.split(value.lower()) if x)
            elif key == "data-y" and self.labelled:
                label = int(value)
            elif key == "hidden":
                names += ("hidden",)
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        self.names.append(names)
        self.label.append(label)
        if tag == "br":
            self.pieces.append((self.open[-1], " "))
        if tag not in VOID:
            self._push(len(self.tag) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _pop_to(self, tags, fence) -> None:
        place = self._last(tags)
        if place and place >= self._last(fence):
            self._cut(place)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._end_block()
        if place := self._last((tag,)):
            self._cut(place)

    def parse_html_declaration(self, i):
        """Where the ``<!...`` at i, which is no comment, ends: at the next ``>`` or with the page, and CDATA of svg and math at ``]]>``."""
        foreign = self._last(("svg", "math")) > 0
        end = "]]>" if foreign and self.rawdata.startswith("<![CDATA[", i) else ">"
        at = self.rawdata.find(end, i + 2)
        return len(self.rawdata) if at < 0 else at + len(end)

    def handle_data(self, data):
        if data.strip(" \t\n\f\r"):
            self._end_head()
        self.pieces.append((self.open[-1], data))


def parse(html: str, labelled: bool = True) -> Dom:
    dom = Dom(labelled)
    dom.feed(html)
    dom.close()
    return dom


def features(dom: Dom) -> list[list[str]]:
    """What holds of each element: its tag, names, amounts of own and linked text, and its parent's tag."""
    n = len(dom.tag)
    own, stops = [0] * n, [0] * n
    for node, text in dom.pieces:
        if text is not None:
            own[node] += len(text)
            stops[node] += text.count(".") + text.count(",")
    linked, full = [0] * n, list(own)
    for i in range(n - 1, 0, -1):
        if dom.tag[i] == "a":
            linked[i] = full[i]
        full[dom.parent[i]] += full[i]
        linked[dom.parent[i]] += linked[i]
    out = []
    for i in range(n):
        tag, above = dom.tag[i], max(dom.parent[i], 0)
        share = 0 if not full[i] else 1 + int(3 * linked[i] / full[i])
        found = ["bias", "t " + tag, f"o {min(own[i], 255).bit_length()}", f"f {min(full[i], 255).bit_length()}", f"l {share}", f"s {min(stops[i], 3).bit_length()}"]
        found += ["c " + x for x in dom.names[i]]
        found.append("u " + dom.tag[above])
        out.append(found)
    return out


class Known:
    """Slots of the features and of the tags that stand on at least ``LEAST_PAGES`` of the training pages; tags have slot 0 for any other."""

    def __init__(self, doms: list[Dom]) -> None:
        words = collections.Counter(x for dom in doms for x in {x for found in features(dom) for x in found})
        tags = collections.Counter(x for dom in doms for x in set(dom.tag))
        self.words = {x: i for i, x in enumerate(sorted(x for x, n in words.items() if n >= LEAST_PAGES))}
        self.tags = {x: i for i, x in enumerate(sorted(x for x, n in tags.items() if n >= LEAST_PAGES), 1)}


class Forest:
    """Pages side by side as one forest, with nodes sorted by depth so that messages go level by level."""

    def __init__(self, doms: list[Dom], words: Mapping[str, int], tags: Mapping[str, int]) -> None:
        parent, slots, rows, kind, start = [], [], [], [], 0
        for dom in doms:
            parent.append(np.array(dom.parent) + np.where(np.array(dom.parent) >= 0, start, 0))
            for i, found in enumerate(features(dom)):
                found = [words[x] for x in found if x in words]
                slots += found
                rows += [start + i] * len(found)
            kind += [tags.get(tag, 0) for tag in dom.tag]
            start += len(dom.tag)
        self.parent = np.concatenate(parent)
        self.rows, self.slots, self.kind, self.count = np.array(rows, np.int64), np.array(slots, np.int64), np.array(kind), start
        depth = np.zeros(start, np.int64)
        for i, above in enumerate(self.parent.tolist()):
            if above >= 0:
                depth[i] = depth[above] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth))[:-1])

    def unary(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.slots], self.count)

    def marginals(self, unary: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(article) of every node, and P(parent, child) of every edge as (nodes, 2, 2); sum-product, exact on trees."""
        pair = steps[self.kind]
        up, to_parent = np.stack([np.zeros_like(unary), unary], 1), np.zeros((self.count, 2))
        for level in self.levels[:0:-1]:
            joint = pair[level] + up[level][:, None, :]
            to_parent[level] = np.logaddexp(joint[:, :, 0], joint[:, :, 1])
            np.add.at(up, self.parent[level], to_parent[level])
        down = np.zeros((self.count, 2))
        both = np.zeros((self.count, 2, 2))
        for level in self.levels[1:]:
            above = self.parent[level]
            rest = down[above] + up[above] - to_parent[level]
            joint = rest[:, :, None] + pair[level]
            down[level] = np.logaddexp(joint[:, 0], joint[:, 1])
            joint = joint + up[level][:, None, :]
            joint -= joint.max((1, 2), keepdims=True)
            joint = np.exp(joint)
            both[level] = joint / joint.sum((1, 2), keepdims=True)
        belief = up + down
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -60, 60))), both


class Model(NamedTuple):
    """Weights of features and of steps from parent to child, and the slots they stand in."""

    unary: np.ndarray
    steps: np.ndarray
    words: dict[str, int]
    tags: dict[str, int]

    def forest(self, doms: list[Dom]) -> Forest:
        return Forest(doms, self.words, self.tags)

    def article(self, forest: Forest) -> np.ndarray:
        return forest.marginals(forest.unary(self.unary), self.steps)[0]


@functools.lru_cache(maxsize=2)
def trained(count: int = PAGES, seed: int = SEED) -> Model:
    """The model of ``count`` labelled pages: observed minus expected features, by Adam."""
    doms = [parse(x) for x in labelled_pages(count, seed)]
    known = Known(doms)
    forest, y = Forest(doms, known.words, known.tags), np.concatenate([d.label for d in doms])
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((forest.count, 2, 2))
    seen[child, y[forest.parent[child]], y[child]] = 1
    size, kinds = len(known.words), len(known.tags) + 1
    weights = [np.zeros(size), np.zeros((kinds, 2, 2))]
    slope, square = [0.0, 0.0], [0.0, 0.0]
    for step in range(1, STEPS + 1):
        single, both = forest.marginals(forest.unary(weights[0]), weights[1])
        grads = [np.bincount(forest.slots, (y - single)[forest.rows], size), np.zeros((kinds, 2, 2))]
        np.add.at(grads[1], forest.kind[child], (seen - both)[child])
        for i, g in enumerate(grads):
            g = g / count - 0.002 * weights[i]
            slope[i], square[i] = 0.9 * slope[i] + 0.1 * g, 0.99 * square[i] + 0.01 * g * g
            weights[i] = weights[i] + 0.1 * (slope[i] / (1 - 0.9**step)) / (np.sqrt(square[i] / (1 - 0.99**step)) + 1e-8)
    return Model(*weights, known.words, known.tags)


def _open_wide_forms(dom: Dom) -> None:
    """Forms with more than half of the shown text of a page stand around the page itself: from here on they are divs, for the model to decide."""
    if "form" not in dom.tag:
        return
    hidden, held = _silent(dom, SILENT - {"form"}), [0] * len(dom.tag)
    for node, text in dom.pieces:
        if text is not None and not hidden[node]:
            held[node] += len("".join(text.split()))
    for i in range(len(held) - 1, 0, -1):
        held[dom.parent[i]] += held[i]
    for i, tag in enumerate(dom.tag):
        if tag == "form" and 2 * held[i] > held[0]:
            dom.tag[i] = "div"


def _silent(dom: Dom, tags: frozenset = SILENT) -> list[bool]:
    out = [False] * len(dom.tag)
    for i in range(1, len(out)):
        out[i] = out[dom.parent[i]] or dom.tag[i] in tags
    return out


def texts(htmls: list[str], model: Model) -> list[str]:
    """Article text of every page: blocks joined by line feeds, white space within a block as one space."""
    doms = [parse(x, labelled=False) for x in htmls]
    for dom in doms:
        _open_wide_forms(dom)
    article = model.article(model.forest(doms)) > 0.5
    out, start = [], 0
    for dom in doms:
        silent, blocks, block = _silent(dom), [], []
        for node, text in [*dom.pieces, (0, None)]:
            if text is None:
                if block and (line := " ".join("".join(block).split())):
                    blocks.append(line)
                block = []
            elif article[start + node] and not silent[node]:
                block.append(text)
        out.append("\n".join(blocks))
        start += len(dom.tag)
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page.

    NULL html is an empty page; a page without an article has empty text. Whole pages are read; unclosed, stray and cut tags
    are taken as browsers do. Rows may repeat, other columns are not read, an empty table gives no rows.
    """
    model = trained()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = texts([x or "" for x in part.column(2).to_pylist()], model)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    columns = [F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html")]
    return pages.select(*columns).mapInArrow(read, "page_id long, url string, text string, n_chars long")
