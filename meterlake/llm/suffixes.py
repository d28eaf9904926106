"""Suffix-array dedup: byte strings of a fixed length that start earlier, found by sorting suffixes in blocks.

A string of ``size`` bytes holds ``size - GRAM + 1`` grams, of which the one with the smallest hash is its anchor;
equal strings have equal anchors at equal places. So only texts around anchors that occur twice are sorted,
and the suffixes that begin with one anchor are one bucket. A task sorts the buckets of a block: by their first
``PERIOD`` bytes, and where these tie, by the ranks of a difference-cover sample of the block's text, which were
computed beforehand. Common prefixes to the right of an anchor and, by the same sort of the reversed texts, to its
left give for every string around it the earliest equal one. Memory is bounded by the block.

Occurrences with the same surroundings (by 128 bits of hashes) are settled in the scan and on arrival, so a passage found
in a third of all texts costs one row for each batch, and only surroundings that differ are sorted. The occurrences
of an anchor that is frequent with ever other surroundings are dealt to as many shares as they fill blocks;
strings that are first in their share are then compared between shares.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm import filters
from meterlake.llm.text import BYTE_VALUES, Blob, chunks, covered, keyed, mix, per_chunk, rolling, signed, span_hashes
from meterlake.sources.scratch import materialize

SIZE = 100
GRAM = 20
#: Occurrences in a block on average, and those of one anchor from which it is dealt to as many shares as it fills blocks.
BLOCK, FREQUENT = 10_000, 20_000
_CHUNK = 1 << 19
_HELD = 100_000

#: A difference cover: any two residues modulo PERIOD have a shift that takes both into COVER.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_SHIFT = np.array([[next(s for s in range(PERIOD) if _IN_COVER[(a + s) % PERIOD] and _IN_COVER[(b + s) % PERIOD]) for b in range(PERIOD)] for a in range(PERIOD)])


# the sort


def _words_at(text: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
    """The first PERIOD bytes at each place, as big-endian integers."""
    eight = np.lib.stride_tricks.sliding_window_view(text, 8)
    return [np.ascontiguousarray(eight[places + k]).view(">u8").ravel().astype(np.uint64) for k in (0, 8, 16, PERIOD - 8)]


def _dense(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Ranks from 0, the same for places with equal keys, given their order."""
    new = np.zeros(len(order), bool)
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def sample_ranks(text: np.ndarray, n: int) -> np.ndarray:
    """For each of the first n places: the rank of its suffix among the cover sample, -1 outside the sample.

    The text goes on with at least 2 * PERIOD zeros. Ranks by the first PERIOD bytes are doubled until all differ.
    """
    places = np.flatnonzero(_IN_COVER[np.arange(n) % PERIOD])
    ranks = np.full(n + PERIOD, -1, np.int64)
    if not len(places):
        return ranks
    words = _words_at(text, places)
    own = _dense(np.lexsort(words[::-1]), *words)
    step = PERIOD
    while own.max() + 1 < len(places):
        ranks[places] = own
        # places + step are sample places too; a suffix that ends before comes first, the shortest in front
        follow = np.where(places + step < n, ranks[np.minimum(places + step, n)] + step + 1, n - places)
        key = own * (len(places) + step + 2) + follow
        own = _dense(np.argsort(key, kind="stable"), key)
        step *= 2
    ranks[places] = own
    return ranks


def sort_suffixes(text: np.ndarray, n: int, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """The order of the suffixes at ``starts``, bucket by bucket.

    Within a bucket by the first PERIOD bytes; suffixes that tie are placed by counting, for each pair of
    residues, the sample ranks below their own at the shift that the cover has for the pair.
    """
    words = _words_at(text, starts)
    order = np.lexsort([*words[::-1], bucket])
    group = _dense(order, bucket, *words)
    size = np.bincount(group)
    tied = np.flatnonzero(size[group] > 1)
    if not len(tied):
        return order
    ranks = sample_ranks(text, n)
    scale = len(ranks) + 2
    residue = starts[tied] % PERIOD
    classes = []
    for r in np.unique(residue):
        own = tied[residue == r]
        own = own[np.argsort(group[own] * scale + ranks[starts[own] + _SHIFT[r, r]], kind="stable")]
        classes.append((int(r), own))
    below = np.zeros(len(starts), np.int64)
    for r, own in classes:
        for q, other in classes:
            shift = _SHIFT[r, q]
            theirs = group[other] * scale + ranks[starts[other] + shift] + 1
            mine = group[own] * scale
            # classes in front also count where a suffix is equal, which only one suffix given twice is
            upto = np.searchsorted(theirs, mine + ranks[starts[own] + shift] + 1, "right" if q < r else "left")
            if q == r:
                upto = np.arange(len(own))
            below[own] += upto - np.searchsorted(theirs, mine, "left")
    first = np.cumsum(size) - size
    at = first[group] + below
    single = np.flatnonzero(size[group] == 1)
    at[single] = first[group[single]]
    result = np.empty(len(starts), np.int64)
    result[at] = np.arange(len(starts))
    return result


def _sorted_rows(rows: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of bytes by their suffix sort, and the common prefix of each with the one before; -1 at a new bucket."""
    m, width = rows.shape
    text = np.concatenate([rows.ravel(), np.zeros(3 * PERIOD, np.uint8)])
    order = sort_suffixes(text, m * width, np.arange(m) * width, bucket)
    differ = rows[order[1:]] != rows[order[:-1]]
    lcp = np.where(differ.any(1), differ.argmax(1), width)
    lcp[bucket[order[1:]] != bucket[order[:-1]]] = -1
    return order, np.concatenate([[-1], lcp])


def _classes(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    """Of each row the number of its class of rows with a common prefix of ``depth``."""
    found = np.empty(len(order), np.int64)
    found[order] = np.cumsum(lcp < depth)
    return found


def earlier_strings(right: np.ndarray, left: np.ndarray, n_right: np.ndarray, n_left: np.ndarray, bucket: np.ndarray, when: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(whole, earlier), rows x places: whether the string that starts so many bytes before the anchor lies in the row's
    text, and whether a row of the bucket with a smaller ``when`` has an equal one. Rows come in the order of ``when``.

    ``right`` is the text from the anchor on, ``left`` the reversed text before it, both filled up with zeros.
    """
    by_right, by_left = _sorted_rows(right, bucket), _sorted_rows(left, bucket)
    whole = np.zeros((len(bucket), size - GRAM + 1), bool)
    earlier = np.zeros_like(whole)
    for back in range(size - GRAM + 1):
        rows = np.flatnonzero((n_left >= back) & (n_right >= size - back))
        if not len(rows):
            continue
        whole[rows, back] = True
        same = _classes(*by_left, back)[rows] * (len(bucket) + 1) + _classes(*by_right, size - back)[rows]
        _, first, of = np.unique(same, return_index=True, return_inverse=True)
        earlier[rows, back] = when[rows] > when[rows[first[of]]]
    return whole, earlier


# the scan


def grams(data: bytes) -> np.ndarray:
    """A hash of the GRAM bytes from each place on."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    at = lambda k: np.ndarray((n,), "<u8", data, k, (1,))
    h = at(0) * np.uint64(0x9E3779B97F4A7C15) + at(8) * np.uint64(0xD1342543DE82EF95) + at(GRAM - 8) * np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _extremes(values: np.ndarray, width: int, best) -> np.ndarray:
    """The best of each run of ``width`` values."""
    size = 1
    while 2 * size <= width:
        values = best(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return best(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(blob: Blob, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, hashes and texts of the grams that have the smallest hash in some string of ``size`` bytes."""
    hashes = grams(blob.bytes)
    span = size - GRAM + 1
    if len(hashes) < span:
        return np.zeros(0, np.int64), hashes[:0], np.zeros(0, np.int64)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    smallest = _extremes(short, span, np.minimum)
    # strings that reach into the next text do not count
    steps = np.zeros(len(smallest) + 1, np.int32)
    long = blob.lengths >= size
    np.add.at(steps, blob.starts[long], 1)
    np.add.at(steps, blob.ends[long] - size + 1, -1)
    smallest[np.cumsum(steps[:-1]) == 0] = 0
    padded = np.concatenate([np.zeros(span - 1, np.uint32), smallest, np.zeros(span - 1, np.uint32)])
    places = np.flatnonzero((_extremes(padded, span, np.maximum) == short) & (short > 0))
    # a gram of hash 0 is never chosen, so strings whose smallest is 0 are all given by it
    zero = np.flatnonzero(short == 0)
    places = np.union1d(places, zero) if len(zero) else places
    text = np.searchsorted(blob.starts, places, "right") - 1
    inside = places + GRAM <= blob.ends[text]
    return places[inside], hashes[places[inside]], text[inside]


def repeated_anchors(rows: DataFrame, size: int) -> DataFrame:
    """(anchor, n) of anchors that occur twice or more."""

    def run(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        found, n = np.unique(anchors(Blob(texts), size)[1], return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(signed(found)), pa.array(n)], names=["anchor", "n"])

    return rows.select("text").mapInArrow(per_chunk(run, _CHUNK), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")


_OCCURRENCE = "anchor long, around long, id long, key long, place long, n_left int, text binary, stop long"
_OCCURRENCE_NAMES = ["anchor", "around", "id", "key", "place", "n_left", "text", "stop"]


def merged_ranges(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ranges of each document, overlapping and touching ones joined."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    shift = (int(stop.max()) + 2) * np.unique(doc, return_inverse=True)[1].astype(np.int64)
    reach = np.maximum.accumulate(stop + shift)
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] + shift[1:] > reach[:-1]
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(doc)) - 1
    return doc[begin], start[begin], reach[last] - shift[last]


class _Occurrences:
    """Occurrences of repeated anchors with the text around them, gathered over chunks."""

    def __init__(self):
        self.parts: list[tuple] = []
        self.count = 0

    def add(self, blob: Blob, part: pa.RecordBatch, repeated: filters.Filter, size: int) -> None:
        places, hashes, text = anchors(blob, size)
        again = repeated.holds(hashes)
        places, hashes, text = places[again], hashes[again], text[again]
        low = np.maximum(places - (size - GRAM), blob.starts[text])
        high = np.minimum(places + size, blob.ends[text])
        around = mix(span_hashes(BYTE_VALUES[blob.data], low, high) ^ (places - low).astype(np.uint64))
        ids, keys = (part.column(c).to_numpy()[text] for c in ("id", "key"))
        self.parts.append((hashes, around, ids, keys, places - blob.starts[text], places - low, high - low, low, blob.bytes))
        self.count += len(places)

    def batch(self) -> pa.RecordBatch:
        """First occurrences with their text; the others as ranges that are settled, without anchor and text."""
        hashes, around, ids, keys, place, n_left, length = (np.concatenate([p[k] for p in self.parts]) for k in range(7))
        source = np.repeat(np.arange(len(self.parts)), [len(p[0]) for p in self.parts])
        low = np.concatenate([p[7] for p in self.parts])
        order = np.lexsort((keys, place, ids, around, hashes))
        same = np.zeros(len(order), bool)
        same[1:] = (hashes[order[1:]] == hashes[order[:-1]]) & (around[order[1:]] == around[order[:-1]])
        first = order[np.flatnonzero(~same)][np.cumsum(~same) - 1] if len(order) else order
        later = (ids[order] != ids[first]) | (place[order] != place[first])
        once = ~later
        once[1:] &= ~(same[1:] & (ids[order[1:]] == ids[order[:-1]]) & (place[order[1:]] == place[order[:-1]]) & (keys[order[1:]] == keys[order[:-1]]))
        one, gone = order[once], order[later]
        docs, of = np.unique(np.stack([ids[gone], keys[gone]], 1), axis=0, return_inverse=True)
        doc, start, stop = merged_ranges(of.ravel(), place[gone] - n_left[gone], place[gone] - n_left[gone] + length[gone])
        texts = [self.parts[s][8][a : a + n] for s, a, n in zip(source[one].tolist(), low[one].tolist(), length[one].tolist())]
        zeros, n = np.zeros(len(doc), np.int64), len(one)
        ranges = np.concatenate([np.zeros(n, bool), np.ones(len(doc), bool)])
        columns = [
            pa.array(np.concatenate([signed(hashes[one]), zeros]), mask=ranges), pa.array(np.concatenate([signed(around[one]), zeros]), mask=ranges),
            pa.array(np.concatenate([ids[one], docs[doc, 0] if len(doc) else zeros])), pa.array(np.concatenate([keys[one], docs[doc, 1] if len(doc) else zeros])),
            pa.array(np.concatenate([place[one], start])), pa.array(np.concatenate([n_left[one], zeros]).astype(np.int32)),
            pa.array(texts + [None] * len(doc), pa.binary()), pa.array(np.concatenate([np.zeros(n, np.int64), stop])),
        ]
        self.parts, self.count = [], 0
        return pa.RecordBatch.from_arrays(columns, names=_OCCURRENCE_NAMES)


def occurrences(rows: DataFrame, repeated, size: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Occurrences()
        for batch in batches:
            for part, texts in chunks(batch, _CHUNK):
                held.add(Blob(texts), part, repeated.value, size)
                if held.count > _HELD:
                    yield held.batch()
        if held.parts:
            yield held.batch()

    return rows.mapInArrow(run, _OCCURRENCE)


def dealt(found: DataFrame, frequent: DataFrame, block: int, blocks: int) -> DataFrame:
    """Occurrences with ``block`` and ``frequent``: buckets are dealt to blocks whole, but those of frequent anchors in shares.

    A frequent anchor (anchor, n) gets a share for each ``block`` of its occurrences, by their surroundings; so whatever
    its number, no share is larger than a block on average.
    """
    n = F.col("n")
    share = F.when(n.isNotNull(), F.pmod("around", F.ceil(n / block))).otherwise(F.lit(0).cast("long"))
    place = F.when(F.col("text").isNull(), F.xxhash64("id", "place")).otherwise(F.xxhash64("anchor", share))
    joined = found.join(frequent, "anchor", "left")
    return joined.select(*found.columns, n.isNotNull().alias("frequent"), F.pmod(place, F.lit(blocks).cast("long")).alias("block"))


# the blocks

_RESULT = "first long, second int, id long, key long, start long, stop long, open boolean"


def _filled(texts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(len(texts), width)


def _result(*parts: tuple) -> pa.Table:
    names = ["first", "second", "id", "key", "start", "stop", "open"]
    kinds = [np.int64, np.int32, np.int64, np.int64, np.int64, np.int64, bool]
    return pa.table({n: np.concatenate([np.asarray(p[k], kind) for p in parts]) for k, (n, kind) in enumerate(zip(names, kinds))})


def _settled(ids: np.ndarray, keys: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple:
    none = np.zeros(len(ids))
    return none, none, ids, keys, start, stop, none


def work_on_block(group: pa.Table, size: int) -> pa.Table:
    """Ranges of a block that are removed, and (``open``) the strings of frequent anchors that are first in it."""
    group = group.combine_chunks()
    ranges = group.filter(pa.compute.is_null(group["text"]))
    group = group.filter(pa.compute.is_valid(group["text"]))
    column = lambda t, c: t[c].to_numpy()
    found = [_settled(*(column(ranges, c) for c in ("id", "key", "place", "stop")))]
    anchor, around, ids, keys, place, n_left, often = (column(group, c) for c in ("anchor", "around", "id", "key", "place", "n_left", "frequent"))
    texts = group["text"].to_pylist()
    n_left = n_left.astype(np.int64)
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    order = np.lexsort((place, ids, around, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (anchor[order[1:]] != anchor[order[:-1]]) | (around[order[1:]] != around[order[:-1]])
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    later = (ids[order] != ids[first]) | (place[order] != place[first])
    gone, rest = order[later], order[~later]
    found.append(_settled(ids[gone], keys[gone], place[gone] - n_left[gone], place[gone] - n_left[gone] + length[gone]))
    # buckets with other surroundings than one; with frequent anchors, other blocks have more
    _, of, contexts = np.unique(anchor[rest], return_inverse=True, return_counts=True)
    rest = rest[(contexts[of] > 1) | often[rest]]
    rest = rest[np.lexsort((keys[rest], place[rest], ids[rest]))]
    if len(rest):
        when = np.zeros(len(rest), np.int64)
        when[1:] = np.cumsum((np.diff(ids[rest]) != 0) | (np.diff(place[rest]) != 0))
        before = size - GRAM
        right = _filled([texts[k][n_left[k] :] for k in rest.tolist()], size)
        left = _filled([texts[k][: n_left[k]][::-1] for k in rest.tolist()], before)
        bucket = np.unique(anchor[rest], return_inverse=True)[1]
        whole, earlier = earlier_strings(right, left, length[rest] - n_left[rest], n_left[rest], bucket, when, size)
        edges = np.diff(np.pad(earlier.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, low = np.nonzero(edges == 1)
        high = np.nonzero(edges == -1)[1] - 1
        found.append(_settled(ids[rest[row]], keys[rest[row]], place[rest[row]] - high, place[rest[row]] - low + size))
        row, back = np.nonzero(whole & ~earlier & often[rest][:, None])
        if len(row):
            line = np.hstack([left[:, ::-1], right])
            values = BYTE_VALUES[np.concatenate([line.ravel(), np.zeros(size, np.uint8)])]
            at = row * line.shape[1] + before - back
            one, two = signed(rolling(values, size)[at]), rolling(values, size, 0xA0761D6478BD642F)[at].astype(np.uint32).view(np.int32)
            start = place[rest[row]] - back
            found.append((one, two, ids[rest[row]], keys[rest[row]], start, start + size, np.ones(len(row))))
    return _result(*found)


def removed_ranges(rows: DataFrame, size: int, max_bits: int, block: int, frequent_from: int) -> DataFrame:
    """(id, key, start, stop): bytes inside strings of ``size`` bytes that start earlier as well."""
    sc = rows.sparkSession.sparkContext
    known = materialize(repeated_anchors(rows, size), "anchors")
    distinct, total = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    repeated = sc.broadcast(filters.build(known, filters.hash_column("anchor"), filters.bits_for(distinct, max_bits)))
    frequent = materialize(known.filter(F.col("n") >= frequent_from), "frequent-anchors")
    found = occurrences(rows, repeated, size)
    if not filters.fits(distinct, max_bits):
        # the filter lets more pass than it should: what only seems repeated goes before it is dealt
        found = found.join(known.select("anchor", F.lit(True).alias("repeats")), "anchor", "left").filter("repeats or text is null").drop("repeats")
    blocks = dealt(found, frequent, block, int(total // block) + 1)
    worked = materialize(blocks.groupBy("block").applyInArrow(lambda group: work_on_block(group, size), _RESULT), "ranges")
    owner = F.min(F.struct("id", "start")).over(Window.partitionBy("first", "second"))
    between = worked.filter("open").withColumn("owner", owner).filter(F.struct("id", "start") > F.col("owner"))
    columns = ("id", "key", "start", "stop")
    return worked.filter("not open").select(*columns).union(between.select(*columns))


def dedup_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
    size: int = SIZE, max_bits: int = filters.MAX_BITS, block: int = BLOCK, frequent: int = FREQUENT,
) -> DataFrame:
    """(id, key, n_bytes, n_removed, spans, kept): texts without the bytes inside strings that start earlier as well.

    A string is ``size`` bytes of the UTF-8 text of one document. It starts earlier in a document of a smaller id, or
    at a smaller place of a document of the same id; overlaps count, and strings are judged on the input. ``spans`` are
    the maximal removed runs. Null and empty texts have no bytes. Rows of equal id count as one document, so equal rows
    never remove each other; null ids count as one largest id. ``kept`` may not be UTF-8. Rows come one for one.
    """
    if size < 2 * GRAM:
        raise ValueError(f"strings start at {2 * GRAM} bytes")
    rows = keyed(docs, id_col, text_col)
    ranges = removed_ranges(rows, size, max_bits, block, frequent).groupBy("id", "key").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    joined = rows.join(ranges.hint("shuffle_hash"), ["id", "key"], "left").select("id", "key", "text", "ranges.start", "ranges.stop")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        n_removed, spans, kept = [], [], []
        for text, starts, stops in zip(texts, batch.column("start"), batch.column("stop")):
            runs, stay = [], text
            if starts.values is not None:
                low = starts.values.to_numpy()
                gone = covered(low, stops.values.to_numpy() - low, len(text))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))).tolist()
                runs = [{"start": a, "end": b} for a, b in zip(edges[0::2], edges[1::2])]
                stay = np.frombuffer(text, np.uint8)[~gone].tobytes()
            n_removed.append(len(text) - len(stay))
            spans.append(runs)
            kept.append(stay)
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("key"), pa.array([len(t) for t in texts], pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(spans, kind), pa.array(kept, pa.binary())],
            names=["id", "key", "n_bytes", "n_removed", "spans", "kept"],
        )

    return joined.mapInArrow(per_chunk(cut, 16 << 20), "id long, key long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
