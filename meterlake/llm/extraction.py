"""Main text of web pages: boosted trees over the nodes of the page, decoded from the root so that no choice contradicts another.

Two models give each block element and each run of text the log odds that some and that all of its text is main text. They
see the node itself (its element, the words of its attributes, depth, length, links), its subtree (text for each element,
leaves, controls), its place in the page, its siblings and the words of the elements around it. A node is then ``in`` (all its
text stays), ``out`` (none does) or ``split`` between its children; below a node that is in or out nothing is chosen any
more. The best consistent choice for a page is found from the leaves up and read from the root down.

No labelled pages are given, so the trees are fitted to pages of known main text (``layouts``), whose number is a parameter.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterlake.llm import boosting, layouts
from meterlake.llm.dom import HEADINGS, RUN, Forest
from meterlake.llm.text import other_columns, per_chunk, rows_of, with_row

#: Pages that the trees are fitted to, and the seed they follow from.
TRAINING_PAGES, SEED = 600, 7
TREES, DEPTH, RATE = 60, 5, 0.2
#: A word or element seen in so few training nodes counts for half.
PRIOR = 12.0
_CHUNK = 1 << 20


@dataclass(frozen=True)
class Words:
    """How much more often an element or a word of an attribute goes with main text, as log odds."""

    tags: dict[str, float]
    names: dict[str, float]

    def of_nodes(self, forest: Forest) -> np.ndarray:
        """Of each node: the value of its element, the smallest and largest of its words, and these over all elements around it."""
        rows = np.zeros((len(forest.tag), 6))
        for k, (tag, names, parent) in enumerate(zip(forest.tag, forest.tokens, forest.parent)):
            values = [self.names.get(t, 0.0) for t in names]
            low, high, kind = min(values, default=0.0), max(values, default=0.0), self.tags.get(tag, 0.0)
            if parent < 0:
                around = (0.0, 0.0, 0.0)
            else:
                up = rows[parent]
                around = (min(up[3], up[1]), max(up[4], up[2]), min(up[5], up[0]))
            rows[k] = (kind, low, high, *around)
        return rows


def features(forest: Forest, words: Words) -> np.ndarray:
    """nodes x features."""
    a = forest.arrays()
    parent, end, depth, page = a["parent"], a["end"], a["depth"], a["page"]
    n = len(parent)
    at = np.arange(n)
    up = np.maximum(parent, 0)
    chars = np.fromiter(map(len, forest.text), np.int64, n)
    run = chars > 0
    counts = np.stack([
        chars, np.array(forest.link_chars, np.int64), run, ~run, np.array(forest.inputs, np.int64),
        np.fromiter((sum(map(t.count, ".,;:!?。、")) if t else 0 for t in forest.text), np.int64, n),
        np.fromiter((t.count(" ") + 1 if t else 0 for t in forest.text), np.int64, n),
        np.fromiter((t in HEADINGS for t in forest.tag), bool, n), np.fromiter((t == "p" for t in forest.tag), bool, n),
        np.fromiter((t == "li" for t in forest.tag), bool, n), np.fromiter(("©" in t for t in forest.text), bool, n),
    ]).astype(np.float64)
    running = np.concatenate([np.zeros((len(counts), 1)), counts.cumsum(axis=1)], axis=1)
    sub = running[:, end] - running[:, at]
    text, linked, leaves, elements, inputs, marks, spaced, headings, paragraphs, items, signs = sub
    first = np.array(forest.pages, np.int64)[page]
    whole = text[first]
    safe = np.maximum(text, 1)
    before = running[0, at] - running[0, first]
    # siblings: nodes with one parent, in page order
    children = np.bincount(up[parent >= 0], minlength=n)
    order = np.argsort(up, kind="stable")
    order = order[parent[order] >= 0]
    index = np.zeros(n)
    index[order] = np.arange(len(order)) - np.searchsorted(up[order], up[order])
    siblings = np.maximum(children[up], 1)
    codes = np.unique(np.array(forest.tag), return_inverse=True)[1].ravel()
    _, kin, of_kin = np.unique(up * (codes.max() + 1) + codes, return_inverse=True, return_counts=True)[0:3]
    same = of_kin[kin.ravel()] / siblings
    longest = np.zeros(n)
    np.maximum.at(longest, up[parent >= 0], text[parent >= 0])
    share_of_page = text / np.maximum(whole, 1)
    log = np.log1p
    own = words.of_nodes(forest)
    return np.column_stack([
        own, depth, run, log(text), log(spaced), linked / safe, marks / safe, safe / np.maximum(spaced, 1), log(leaves), log(elements),
        log(text / np.maximum(elements, 1)), log(text / np.maximum(leaves, 1)), inputs, log(headings), log(paragraphs), items / np.maximum(leaves, 1),
        signs / np.maximum(leaves, 1), share_of_page, before / np.maximum(whole, 1), (before + text) / np.maximum(whole, 1),
        log(children), log(siblings), index / siblings, same, text / np.maximum(text[up], 1), text / np.maximum(longest[up], 1),
        log(text[up] / siblings), linked[up] / safe[up], log(text[up]), log(paragraphs[up]), inputs[up], own[up, 0], np.log1p(whole),
    ])


@dataclass(frozen=True)
class Model:
    words: Words
    some: boosting.Boosted
    all: boosting.Boosted

    def log_odds(self, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
        rows = features(forest, self.words)
        return self.some.log_odds(self.some.binned(rows)), self.all.log_odds(self.all.binned(rows))


def _word_values(keys: list[tuple], main: np.ndarray) -> dict[str, float]:
    seen: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for names, share in zip(keys, main.tolist()):
        for name in names:
            seen[name][0] += share
            seen[name][1] += 1
    return {k: float(np.log((m + PRIOR / 2) / (n - m + PRIOR / 2))) * n / (n + PRIOR) for k, (m, n) in seen.items()}


@functools.lru_cache(maxsize=4)
def trained(n_pages: int = TRAINING_PAGES, seed: int = SEED, trees: int = TREES) -> Model:
    """The model fitted to so many pages of known main text; the same for the same parameters."""
    forest = Forest()
    for page in layouts.pages(n_pages, seed):
        forest.add(page)
    main = np.fromiter((t.startswith(layouts.MARK) for t in forest.text), bool, len(forest.text))
    forest.text = [t.removeprefix(layouts.MARK) for t in forest.text]
    a = forest.arrays()
    running = np.concatenate([np.zeros((2, 1)), np.cumsum([main, [bool(t) for t in forest.text]], axis=1)], axis=1)
    inside, leaves = running[:, a["end"]] - running[:, np.arange(len(main))]
    full = leaves > 0
    share = inside[full] / leaves[full]
    tags = [(t,) for t, f in zip(forest.tag, full) if f]
    names = [t for t, f in zip(forest.tokens, full) if f]
    words = Words(_word_values(tags, share), _word_values(names, share))
    rows = features(forest, words)[full]
    fitted = [boosting.fit(rows, target.astype(np.float64), trees=trees, depth=DEPTH, rate=RATE) for target in (share > 0, share == 1)]
    return Model(words, *fitted)


def decode(forest: Forest, some: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """True for the runs of text that stay.

    The score of a choice is the sum of log probabilities of all nodes below: a node that is in or out takes its whole subtree
    with it, one that is split leaves each child its best choice. A run is in or out.
    """
    a = forest.arrays()
    parent, end = a["parent"], a["end"]
    n = len(parent)
    run = np.fromiter(map(bool, forest.text), bool, n)
    running = np.concatenate([[0], run.cumsum()])
    full = running[end] > running[np.arange(n)]
    p_some, p_all = (np.clip(1 / (1 + np.exp(-x)), 1e-4, 1 - 1e-4) for x in (some, whole))
    sums = []
    for score in (np.log(1 - p_some), np.log(p_all)):
        total = np.concatenate([[0.0], np.where(full, score, 0).cumsum()])
        sums.append(total[end] - total[:-1])
    apart = np.log(np.maximum(p_some - p_all, 1e-4))
    out_sum, in_sum, split = sums[0].tolist(), sums[1].tolist(), np.where(run, -np.inf, apart).tolist()
    ups, below, choice = parent.tolist(), [0.0] * n, [0] * n
    for k in range(n - 1, -1, -1):
        if not full[k]:
            continue
        best = out_sum[k]
        if in_sum[k] > best:
            best, choice[k] = in_sum[k], 1
        if split[k] + below[k] > best:
            best, choice[k] = split[k] + below[k], 2
        if ups[k] >= 0:
            below[ups[k]] += best
    for k in range(n):
        up = ups[k]
        if up >= 0 and choice[up] != 2:
            choice[k] = choice[up]
    return run & (np.array(choice) == 1)


def main_blocks(pages: list[str], model: Model) -> list[list[str]]:
    """The blocks of main text of each page."""
    forest = Forest()
    for page in pages:
        forest.add(page)
    found: list[list[str]] = [[] for _ in pages]
    if pages:
        keep = decode(forest, *model.log_odds(forest))
        owner = forest.arrays()["page"]
        for k in np.flatnonzero(keep).tolist():
            found[owner[k]].append(forest.text[k])
    return found


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", *, n_training: int = TRAINING_PAGES, carry: bool = False) -> DataFrame:
    """(id, text, n_blocks): the main text of each page.

    Blocks are runs of text between block elements, in page order, joined by an empty line; their character references are
    decoded and white space (line breaks, too) is one space. Scripts, styles, titles, controls and comments of the markup are
    never text. Null and empty pages, and pages without main text, have an empty text. Markup that is not closed ends where
    its parent does. Bytes that are not UTF-8 are replaced. Rows come one for one, repeated rows get equal texts. With
    ``carry`` the other columns follow as ``row``.
    """
    rows = rows_of(pages, id_col, html_col, *other_columns(pages, html_col, carry))
    model = pages.sparkSession.sparkContext.broadcast(trained(n_training))

    def read(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        blocks = main_blocks([t.decode("utf-8", "replace") for t in texts], model.value)
        columns = {
            "id": batch.column("id"), "text": pa.array(["\n\n".join(b) for b in blocks], pa.string()),
            "n_blocks": pa.array([len(b) for b in blocks], pa.int64()),
        } | ({"row": batch.column("row")} if carry else {})
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return rows.mapInArrow(per_chunk(read, _CHUNK), with_row("id long, text string, n_blocks long", rows))
