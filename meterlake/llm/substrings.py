"""Substring dedup with fixed-block anchors: passages of words that an earlier document holds as well.

Every document is reference and probe. Its non-overlapping blocks of ``block`` words, at places that are
multiples of ``block``, form the index; with ``window >= 2 * block - 1`` each repeated window of the earlier
document contains one of them. All rolling windows of ``block`` words probe the index: first a Bloom filter
in the scan, whose size follows the texts up to a bound, then an exact grouping of the hits by hash and document. Around the anchors that
two documents share, hits are extended: the windows there are compared by 96-bit hashes, and adjacent equal
windows join to maximal repeats.

A chunk of documents settles repeats among its own at once, so that a passage found in a third of all
documents is shuffled once for each chunk and not for each document. Windows around anchors of many chunks are
dealt to shares by document; only the first documents of the shares then meet in one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm import filters
from meterlake.llm.text import WORD_BYTES, Blob, Words, chunks, covered, keyed, mix, per_chunk, rolling, signed
from meterlake.sources.scratch import materialize

WINDOW = 50
#: Bits for each shared anchor in the filter for the last pass, where one false anchor would send on ``block`` windows around it.
ANCHOR_BITS = 64
#: Bytes of a word with the space behind it, for an estimate of how many blocks the texts have.
WORD_BYTES_ON_AVERAGE = 5
#: Chunks that hold an anchor from which its windows are dealt to shares; decides where rows meet, not what is found.
FREQUENT = 256
SHARES = 64
_CHUNK = 2 << 20
_SECOND_BASE = 0xA0761D6478BD642F


class _Probe:
    """Words of texts and the hashes of all their runs of ``block`` words; runs never cross texts."""

    def __init__(self, texts: list[bytes], block: int):
        self.words: Words = Blob(texts).words(WORD_BYTES)
        self.hashes = self.words.hashes()
        self.left = self.words.left()
        self.runs = rolling(self.hashes, block)
        self.whole = self.left[: len(self.runs)] >= block
        self.offset = np.arange(len(self.runs)) - self.words.first[self.words.doc[: len(self.runs)]]


def _index_filter(rows: DataFrame, block: int, max_bits: int) -> filters.Filter:
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]

    def blocks(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, texts in chunks(batch):
            probe = _Probe(texts, block)
            yield probe.runs[probe.whole & (probe.offset % block == 0)]

    return filters.build(rows.select("text"), blocks, filters.bits_for(size // (block * WORD_BYTES_ON_AVERAGE), max_bits))


def shared_anchors(rows: DataFrame, block: int, max_bits: int) -> DataFrame:
    """(anchor, n): hashes of index blocks that rolling windows of two documents or more hold, and in how many chunks."""
    index = rows.sparkSession.sparkContext.broadcast(_index_filter(rows, block, max_bits))

    def probe(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        found = _Probe(texts, block)
        at = np.flatnonzero(found.whole)
        at = at[index.value.holds(found.runs[at])]
        ids = batch.column("id").to_numpy()[found.words.doc[at]]
        # of each anchor the smallest and the largest document of the chunk are enough
        order = np.lexsort((ids, found.runs[at]))
        anchors, ids = found.runs[at][order], ids[order]
        new = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]])) if len(anchors) else np.zeros(0, np.int64)
        last = np.append(new[1:], len(anchors))[: len(new)] - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(anchors[new])), pa.array(ids[new]), pa.array(ids[last])], names=["anchor", "low", "high"]
        )

    hits = rows.mapInArrow(per_chunk(probe, _CHUNK), "anchor long, low long, high long")
    held = hits.groupBy("anchor").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("n"))
    return held.filter("low < high").select("anchor", "n")


def later_than_first(found: DataFrame) -> DataFrame:
    """The rows that are settled (``run`` > 0) or of whose window a smaller id is there.

    Rows with ``share`` > 0 are compared within their share first, and the smallest ids of the shares with each other,
    so that one window is never one group. Both branches read one shuffle of the rows.
    """
    window = ["first", "second"]
    first_here = F.min("id").over(Window.partitionBy(*window, "share", F.col("run") > 0))
    dealt = found.withColumn("owner", first_here).withColumn("later", (F.col("run") > 0) | (F.col("id") > F.col("owner")))
    columns = ["id", "key", "start", "run"]
    leaders = dealt.filter(~F.col("later") & (F.col("share") > 0)).select(*window, *columns)
    beaten = leaders.withColumn("owner", F.min("id").over(Window.partitionBy(*window))).filter(F.col("id") > F.col("owner"))
    return dealt.filter("later").select(*columns).union(beaten.select(*columns))


def repeated_windows(rows: DataFrame, window: int, block: int, max_bits: int, frequent_from: int) -> DataFrame:
    """(id, key, start, run): runs of windows, by the place of their first word, that a smaller id holds as well."""
    anchors = materialize(shared_anchors(rows, block, max_bits), "anchors")
    sc, column = rows.sparkSession.sparkContext, filters.hash_column("anchor")
    often = anchors.filter(F.col("n") >= frequent_from)
    n_shared, n_often = anchors.count(), often.count()
    shared: Broadcast = sc.broadcast(filters.build(anchors, column, filters.bits_for(n_shared, max_bits, ANCHOR_BITS)))
    frequent: Broadcast = sc.broadcast(filters.build(often, column, filters.bits_for(n_often, max_bits)))

    def candidates(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        found = _Probe(texts, block)
        at = np.flatnonzero(found.whole)
        at = at[shared.value.holds(found.runs[at])]
        # windows that contain an anchor and lie within one text
        low = np.maximum(at - (window - block), at - found.offset[at])
        near = covered(low, at - low + 1, len(found.runs))
        hot = frequent.value.holds(found.runs[at])
        often = covered(low[hot], (at - low + 1)[hot], len(found.runs))
        first = rolling(found.hashes, window)
        near = near[: len(first)] & (found.left[: len(first)] >= window)
        at = np.flatnonzero(near)
        second = rolling(found.hashes, window, _SECOND_BASE)[at].astype(np.uint32).view(np.int32)
        first, doc = first[at], found.words.doc[at]
        ids = batch.column("id").to_numpy()[doc]
        order = np.lexsort((ids, second, first))
        first, second, ids, doc, at = first[order], second[order], ids[order], doc[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        smallest = ids[np.flatnonzero(new)][np.cumsum(new) - 1] if len(at) else ids
        open_ = ids == smallest
        # settled here: another document of this chunk has the window and a smaller id
        sure = np.sort(at[~open_])
        breaks = np.ones(len(sure), bool)
        breaks[1:] = (np.diff(sure) != 1) | (np.diff(found.words.doc[sure]) != 0)
        begin = np.flatnonzero(breaks)
        runs = np.append(begin[1:], len(sure))[: len(begin)] - begin
        sure = sure[begin]
        place = np.concatenate([at[open_], sure])
        docs = found.words.doc[place]
        start = (place - found.words.first[docs]).astype(np.int32)
        keys = batch.column("key").to_numpy()[docs].view(np.uint64)
        share = np.where(often[place], 1 + mix(keys) % np.uint64(SHARES), 0)
        share[open_.sum() :] = 0
        spread = (start.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ keys
        return pa.RecordBatch.from_arrays(
            [
                pa.array(signed(np.concatenate([first[open_], spread[open_.sum() :]]))),
                pa.array(np.concatenate([second[open_], np.zeros(len(sure), np.int32)])),
                batch.column("id").take(pa.array(docs)), batch.column("key").take(pa.array(docs)), pa.array(start),
                pa.array(np.concatenate([np.zeros(open_.sum(), np.int32), runs.astype(np.int32)])), pa.array(share.astype(np.int8)),
            ],
            names=["first", "second", "id", "key", "start", "run", "share"],
        )

    found = rows.mapInArrow(per_chunk(candidates, _CHUNK), "first long, second int, id long, key long, start int, run int, share byte")
    return later_than_first(found).withColumn("run", F.greatest("run", F.lit(1)))


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = WINDOW, max_bits: int = filters.MAX_BITS,
    frequent: int = FREQUENT,
) -> DataFrame:
    """(id, key, n_words, n_removed, kept): texts without the words inside windows that a smaller id holds.

    Words are separated by ASCII white space and compared unchanged. Windows are judged on the input, so of three
    copies the first stays. ``kept`` joins the words that stay by one space; a text of which nothing repeats is
    normalised in the same way. Null and empty texts have no words. Documents of equal id never remove each
    other's words; null ids count as one largest id. Rows come one for one.
    """
    rows = keyed(docs, id_col, text_col)
    block = (window + 1) // 2
    if window < 3:
        raise ValueError("windows start at 3 words")
    runs = repeated_windows(rows, window, block, max_bits, frequent).groupBy("id", "key").agg(F.collect_list(F.struct("start", "run")).alias("runs"))
    joined = rows.join(runs.hint("shuffle_hash"), ["id", "key"], "left").select("id", "key", "text", "runs.start", "runs.run")

    def cut(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        n_words, n_removed, kept = [], [], []
        for text, starts, lengths in zip(texts, batch.column("start"), batch.column("run")):
            words = text.split()
            n_words.append(len(words))
            if starts.values is not None:
                gone = covered(starts.values.to_numpy().astype(np.int64), lengths.values.to_numpy() + np.int64(window - 1), len(words))
                n_removed.append(int(gone.sum()))
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            else:
                n_removed.append(0)
            kept.append(b" ".join(words))
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
            names=["id", "key", "n_words", "n_removed", "kept"],
        )

    return joined.mapInArrow(per_chunk(cut, 16 << 20), "id long, key long, n_words long, n_removed long, kept binary")
