"""Benchmark decontamination: normalised word windows of the test items, looked up in every document.

The windows of the items are spelled and hashed in Spark. Their distinct hashes are a broadcast set (a Bloom filter of bounded
size where they are too many for one), and one pass over the documents looks every window up in it. What it finds is
spelled, one row for each chunk and window, and verified by a join with the items' windows on hash and words. Hits of
a document are gathered by its id; texts are not shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm import filters
from meterlake.llm.text import ALNUM_BYTES, Blob, mix, other_columns, per_chunk, rolling, rows_of, signed, with_row
from meterlake.sources.scratch import materialize

WINDOW = 13
#: Hashes in an exact broadcast set, 8 bytes each; more are held by a filter.
MAX_HASHES = 1 << 22

_KINDS = ALNUM_BYTES.copy()
_KINDS[0x41:0x5B] = True
_HIT = pa.struct([("id", pa.int64()), ("key", pa.int64()), ("pos", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())])


def _spelled(blob: Blob, words) -> list[bytes]:
    return [blob.bytes[a:b].lower() for a, b in zip(words.starts.tolist(), words.ends.tolist())]


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(size, hash, words, items): the distinct windows of all items; an item of fewer words, but not none, is one window."""

    def spell(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        blob = Blob(texts)
        words = blob.words(_KINDS)
        hashes, left, spelled = words.hashes(lower=True), words.left(), _spelled(blob, words)
        size, hash_, at, of = [], [], [], []
        for n in sorted({window, *words.counts[(words.counts > 0) & (words.counts < window)].tolist()}):
            rolled = rolling(hashes, n)
            place = np.flatnonzero(left[: len(rolled)] >= n) if n == window else words.first[words.counts == n]
            size.append(np.full(len(place), n))
            hash_.append(rolled[place])
            at += [b" ".join(spelled[k : k + n]) for k in place.tolist()]
            of.append(words.doc[place] if len(place) else np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(size).astype(np.int32)), pa.array(signed(np.concatenate(hash_))), pa.array(at, pa.binary()),
             batch.column("item").take(pa.array(np.concatenate(of)))],
            names=["size", "hash", "words", "item"],
        )

    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("binary").alias("text"))
    windows = items.filter("text is not null").mapInArrow(per_chunk(spell), "size int, hash long, words binary, item string")
    return windows.groupBy("size", "hash", "words").agg(F.collect_set("item").alias("items"))


@dataclass(frozen=True)
class Known:
    """The hashes of the items' windows: for each size a sorted array, or a filter for all."""

    sizes: tuple[int, ...]
    exact: dict[int, np.ndarray] | None
    some: filters.Filter | None

    def holds(self, size: int, rolled: np.ndarray) -> np.ndarray:
        if self.some is not None:
            return self.some.holds(mix(rolled + np.uint64(size)))
        own = self.exact[size]
        return own[np.minimum(np.searchsorted(own, rolled), len(own) - 1)] == rolled


def known_hashes(windows: DataFrame, max_hashes: int, max_bits: int) -> Known:
    """What is broadcast: at most ``max_hashes`` hashes through the driver, or a filter of at most ``max_bits``."""
    distinct = windows.select("size", "hash").distinct()
    counted = {r.size: r.n for r in distinct.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes, n = tuple(sorted(counted)), sum(counted.values())
    if n > max_hashes:

        def hashes(batch: pa.RecordBatch):
            yield mix(batch.column("hash").to_numpy().view(np.uint64) + batch.column("size").to_numpy().astype(np.uint64))

        return Known(sizes, None, filters.build(distinct, hashes, filters.bits_for(n, max_bits)))
    table = distinct.toPandas()
    size, hash_ = table["size"].to_numpy(), table["hash"].to_numpy(np.int64).view(np.uint64)
    return Known(sizes, {s: np.sort(hash_[size == s]) for s in sizes}, None)


def _candidates(rows: DataFrame, known) -> DataFrame:
    """A row for each document, (id, key, n_words), and for each window of a chunk that may be an item's one with all its places."""

    def look_up(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        blob = Blob(texts)
        words = blob.words(_KINDS)
        hashes, left = words.hashes(lower=True), words.left()
        spelled = None
        found: dict[tuple[int, int, bytes], list[int]] = {}
        for size in known.value.sizes:
            rolled = rolling(hashes, size)
            for at in np.flatnonzero(known.value.holds(size, rolled) & (left[: len(rolled)] >= size)).tolist():
                spelled = _spelled(blob, words) if spelled is None else spelled
                found.setdefault((size, int(rolled[at]), b" ".join(spelled[at : at + size])), []).append(at)
        n, m = len(texts), len(found)
        size = np.fromiter((s for s, _, _ in found), np.int64, m)
        counts = np.fromiter(map(len, found.values()), np.int64, m)
        at = np.fromiter((a for places in found.values() for a in places), np.int64, int(counts.sum()))
        doc = words.doc[at]
        last = at + np.repeat(size, counts) - 1
        hits = pa.StructArray.from_arrays(
            [batch.column("id").take(pa.array(doc)), batch.column("key").take(pa.array(doc)), pa.array((at - words.first[doc]).astype(np.int32)),
             pa.array(words.starts[at] - blob.starts[doc]), pa.array(words.ends[last] - blob.starts[doc])],
            fields=list(_HIT),
        )
        offsets = np.concatenate([np.zeros(n, np.int64), [0], np.cumsum(counts)]).astype(np.int32)
        marks = lambda values, kind: pa.concat_arrays([pa.nulls(n, kind), pa.array(values, kind)])
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([batch.column("id"), pa.nulls(m, pa.int64())]), pa.concat_arrays([batch.column("key"), pa.nulls(m, pa.int64())]),
             pa.concat_arrays([pa.array(words.counts, pa.int64()), pa.nulls(m, pa.int64())]), marks(size, pa.int32()),
             marks(signed(np.fromiter((h for _, h, _ in found), np.uint64, m)), pa.int64()), marks([w for _, _, w in found], pa.binary()),
             pa.ListArray.from_arrays(pa.array(offsets), hits)],
            names=["id", "key", "n_words", "size", "hash", "words", "at"],
        )

    schema = "id long, key long, n_words long, size int, hash long, words binary, at array<struct<id:long,key:long,pos:int,start:long,stop:long>>"
    return rows.mapInArrow(per_chunk(look_up), schema)


def _spans(batches):
    """Positions of hit windows as the number of hit words and maximal runs of bytes."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        n_hit, spans = [], []
        for hits in batch.column("hits").to_pylist():
            total, runs, upto = 0, [], -1
            for hit in sorted(hits or (), key=lambda h: (h["pos"], h["size"])):
                end = hit["pos"] + hit["size"]
                if hit["pos"] > upto or not runs:
                    runs.append({"start": hit["start"], "end": hit["stop"]})
                    total += hit["size"]
                    upto = end
                elif end > upto:
                    total += end - upto
                    upto, runs[-1]["end"] = end, hit["stop"]
            n_hit.append(total)
            spans.append(runs)
        columns = [batch.column(c) for c in ("id", "key", "n_words")] + [pa.array(n_hit, pa.int64()), batch.column("items"), pa.array(spans, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "n_words", "n_hit", "items", "spans"])


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", *, window: int = WINDOW, max_hashes: int = MAX_HASHES,
    max_bits: int = filters.MAX_BITS, carry: bool = False,
) -> DataFrame:
    """(id, key, n_words, n_hit, items, spans): the words of each document inside a benchmark window; ``key`` is its text's hash.

    Words are runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased. An item with fewer
    words than ``window`` is one window; one without words has none. ``spans`` are byte ranges [start, end) of
    maximal runs of hit words. Null texts have no words; null items are skipped, a null item id is ''. Repeated
    rows each get their result, null ids stay null. With ``carry`` the text and, as ``row``, the other columns follow.
    """
    rows = rows_of(docs, id_col, text_col, _text_key(text_col).alias("key"), *other_columns(docs, text_col, carry))
    windows = materialize(benchmark_windows(benchmark, item_col, item_text_col, window), "benchmark-windows")
    known = docs.sparkSession.sparkContext.broadcast(known_hashes(windows, max_hashes, max_bits))
    found = materialize(_candidates(rows.select("id", "key", "text"), known), "decontamination")
    verified = found.filter("size IS NOT NULL").select("size", "hash", "words", "at").join(windows, ["size", "hash", "words"])
    hits = verified.select(F.inline("at"), "size", "items").groupBy("id", "key").agg(
        F.collect_set(F.struct("pos", "size", "start", "stop")).alias("hits"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")
    )
    hits = hits.withColumnsRenamed({"id": "hit_id", "key": "hit_key"})
    marked = found.filter("size IS NULL").select("id", "key", "n_words")
    joined = marked.join(hits, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")), "left")
    joined = joined.select("id", "key", "n_words", "hits", F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    result = joined.mapInArrow(_spans, "id long, key long, n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>")
    if not carry:
        return result
    result = result.dropDuplicates(["id", "key"]).withColumnsRenamed({"id": "hit_id", "key": "hit_key"})
    whole = rows.join(result.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key")), "left")
    return whole.select("id", "key", "n_words", "n_hit", "items", "spans", "text", "row")


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")))


def without_contaminated(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, one_in: int = 20) -> DataFrame:
    """The rows of the documents, all columns as they are, but for those that ``found`` (``benchmark_hits``) shows contaminated.

    The contaminated rows' ids are written first: few as a rule, they are then broadcast by their known size, and no text is
    shuffled; where they are many, the planner joins otherwise.
    """
    bad = materialize(found.filter(contaminated(one_in)).select(F.col("id").alias("bad_id"), F.col("key").alias("bad_key")).distinct(), "contaminated")
    same = F.col(id_col).cast("long").eqNullSafe(bad["bad_id"]) & (_text_key(text_col) == bad["bad_key"])
    return docs.join(bad, same, "left_anti")


def contaminated(one_in: int = 20) -> Column:
    """The rule on the columns of ``benchmark_hits``: words are hit, and at least one in so many."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * one_in >= F.col("n_words"))
