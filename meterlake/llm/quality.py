"""Quality rules on repetition: a suffix array of each text's words and its longest common prefixes.

Texts of a chunk are sorted together, each word named by its text as well, so that no common prefix
reaches from one text into another. The deepest prefix interval that holds a suffix gives the longest
repeated substring that starts there; the union of those spans is what is repeated.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterlake.llm.text import WORD_BYTES, Blob, covered, mix, per_chunk, rows_of

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 0.30
MAX_LONGEST = 100


def suffix_array(names: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of all suffixes by prefix doubling, and the ranks of their first 1, 2, 4, ... words."""
    ranks = np.unique(names, return_inverse=True)[1].astype(np.int64)
    levels, n, size = [ranks.astype(np.int32)], len(names), 1
    while n and size < n and int(ranks.max()) + 1 < n:
        follow = np.zeros(n, np.int64)
        follow[:-size] = ranks[size:] + 1
        ranks = np.unique(ranks * (n + 1) + follow, return_inverse=True)[1].astype(np.int64)
        levels.append(ranks.astype(np.int32))
        size *= 2
    order = np.empty(n, np.int64)
    order[ranks] = np.arange(n)
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The longest common prefix of each suffix in the order with the one before; 0 for the first."""
    n = len(order)
    left, right, length = order[:-1].copy(), order[1:].copy(), np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (left < n) & (right < n)
        same = inside.copy()
        same[inside] = levels[k][left[inside]] == levels[k][right[inside]]
        step = same.astype(np.int64) << k
        left, right, length = left + step, right + step, length + step
    return np.concatenate([[0], length])[:n]


def longest_repeats(names: np.ndarray) -> np.ndarray:
    """For each place the length of the longest substring that starts there and occurs elsewhere too."""
    order, levels = suffix_array(names)
    lcp = common_prefixes(order, levels)
    deepest = np.maximum(lcp, np.append(lcp[1:], 0)) if len(lcp) else lcp
    found = np.empty(len(names), np.int64)
    found[order] = deepest
    return found


def repetition(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
    window: int = WINDOW, min_words: int = MIN_WORDS, max_repeated: float = MAX_REPEATED, max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, repeated_chars, longest_repeat, spans, base_failed, kept).

    Repeats have at least ``window`` words; ``spans`` are the maximal runs of repeated words as word ranges
    [start, end). ``base_failed``: fewer than ``min_words`` words, or over 30 % of them repeated. ``kept``: not that,
    at most ``max_repeated`` of the word characters repeated, no repeat of over ``max_longest`` words. Null and
    empty texts have no words and fail. Rows come one for one.
    """

    def measure(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        blob = Blob(texts)
        words = blob.words(WORD_BYTES)
        n, last = len(words.starts), words.first + words.counts
        sums = lambda x: np.concatenate([[0], np.cumsum(x)])
        chars = sums(words.mask & ((blob.data & 0xC0) != 0x80))
        symbols = sums(SYMBOLS[blob.data])
        length = longest_repeats(mix(words.hashes() + mix(words.doc.astype(np.uint64) + np.uint64(1))))
        length[length < window] = 0
        at = np.flatnonzero(length)
        hit = covered(at, length[at], n)
        word_chars = chars[words.ends] - chars[words.starts]
        repeated, repeated_chars = sums(hit), sums(np.where(hit, word_chars, 0))
        longest = np.zeros(len(texts), np.int64)
        np.maximum.at(longest, words.doc[at], length[at])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
        spans = [[] for _ in texts]
        for a, b in zip(edges[0::2].tolist(), edges[1::2].tolist()):
            while a < b:  # a run goes on over the border of two texts
                doc = int(words.doc[a])
                stop, first = min(b, int(last[doc])), int(words.first[doc])
                spans[doc].append({"start": a - first, "end": stop - first})
                a = stop
        n_repeat = repeated[last] - repeated[words.first]
        total = chars[blob.ends] - chars[blob.starts]
        shared = repeated_chars[last] - repeated_chars[words.first]
        failed = (words.counts < min_words) | (100 * n_repeat > 30 * words.counts)
        kept = ~failed & (shared <= max_repeated * total) & (longest <= max_longest)
        columns = {
            "id": batch.column("id"), "n_words": words.counts, "word_chars": total, "n_symbols": symbols[blob.ends] - symbols[blob.starts],
            "n_dup_lines": np.array([_repeated_lines(t) for t in texts], np.int64), "n_repeat_words": n_repeat, "repeated_chars": shared,
            "longest_repeat": longest, "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "base_failed": failed, "kept": kept,
        }
        return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns.values()], names=list(columns))

    return rows_of(docs, id_col, text_col).mapInArrow(
        per_chunk(measure),
        "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, repeated_chars long, "
        "longest_repeat long, spans array<struct<start:long,end:long>>, base_failed boolean, kept boolean",
    )


def _repeated_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))
