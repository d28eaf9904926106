"""Bloom filters whose size follows the number of hashes.

``second_sightings`` finds the hashes that occur twice. Hashes alone are dealt to tasks by an exchange; each task holds a
filter of those it has seen, which grows in slices, and sends on what it meets again. So no task and no broadcast
holds a filter of the whole table.

``build`` makes a filter of given hashes to be broadcast, of ``BITS_PER_KEY`` bits for each and at most ``MAX_BITS``. Tasks send
their non-empty segments compressed; segments merge in three rounds of bounded groups.

A filter only ever gives too much: whoever uses it confirms exactly, so its size decides cost and not results.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: With three places for each key and so many bits, one in sixty other hashes passes.
HASHES = 3
BITS_PER_KEY = 10
#: 64 MB: what a broadcast filter may take in the driver and in each Python worker.
MIN_BITS, MAX_BITS = 1 << 18, 1 << 29
FAN_IN = 64
_HELD = 1 << 20
_GATHERED = 1 << 16

_SCHEMA = "part long, segment int, bits binary"
_FIELDS = pa.schema([("part", pa.int64()), ("segment", pa.int32()), ("bits", pa.binary())])


def bits_for(n: int, most: int = MAX_BITS, per_key: int = BITS_PER_KEY) -> int:
    """A power of two of at least ``per_key`` bits for each of n keys, within the bounds."""
    return min(max(1 << (per_key * max(n, 1) - 1).bit_length(), MIN_BITS), max(most, MIN_BITS))


def fits(n: int, most: int = MAX_BITS) -> bool:
    """Whether a filter of n keys within the bound still has ``BITS_PER_KEY`` bits for each."""
    return BITS_PER_KEY * n <= most


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64(bits - 1)
    second = (hashes >> np.uint64(32)) | np.uint64(1)
    return [((hashes + np.uint64(k) * second) & mask).astype(np.int64) for k in range(HASHES)]


class Filter:
    """A bit array; ``holds`` is true for every hash it was given and for few others."""

    def __init__(self, packed: np.ndarray, bits: int):
        self.packed, self.bits = packed, bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in _places(hashes, self.bits):
            found &= (self.packed[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
        return found

    def add(self, hashes: np.ndarray) -> None:
        for place in _places(hashes, self.bits):
            np.bitwise_or.at(self.packed, place >> 3, (128 >> (place & 7)).astype(np.uint8))

    def fill(self) -> float:
        return float(np.bitwise_count(self.packed).sum()) / self.bits


class Seen:
    """A filter that grows: once a slice has the keys it was made for, the next is twice as large."""

    def __init__(self, first: int = 1 << 20):
        self.slices: list[Filter] = []
        self.next_bits, self.room = first, 0

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        found = np.zeros(len(hashes), bool)
        for one in self.slices:
            found |= one.holds(hashes)
        return found

    def add(self, hashes: np.ndarray) -> None:
        """Hashes that are not held yet."""
        while len(hashes):
            if not self.room:
                self.slices.append(Filter(np.zeros(self.next_bits // 8, np.uint8), self.next_bits))
                self.room, self.next_bits = self.next_bits // BITS_PER_KEY, 2 * self.next_bits
            self.slices[-1].add(hashes[: self.room])
            taken = min(self.room, len(hashes))
            self.room, hashes = self.room - taken, hashes[taken:]


def _gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= _GATHERED:
            yield _columns(held)
            held, size = [], 0
    if size:
        yield _columns(held)


def _columns(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("hash", "n"))


def second_sightings(hashed: DataFrame) -> DataFrame:
    """(hash), distinct: all that ``hashed`` (hash long, n long) holds in two rows, or in one with n > 1, and few others.

    A hash may come in as many rows as chunks hold it; the task it is dealt to streams them and keeps its bits alone.
    """

    def sift(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for hashes, n in _gathered(batches):
            distinct, at, times = np.unique(hashes.view(np.uint64), return_index=True, return_counts=True)
            known = seen.holds(distinct)
            seen.add(distinct[~known])
            again = distinct[known | (times > 1) | (n[at] > 1)]
            yield pa.RecordBatch.from_arrays([pa.array(again.view(np.int64))], names=["hash"])

    return hashed.repartition("hash").mapInArrow(sift, "hash long").distinct()


def _row(part: int, segment: int, packed: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"part": part, "segment": segment, "bits": zlib.compress(packed.tobytes(), 1)}], _FIELDS)


def _segments(hashes: list[np.ndarray], bits: int, size: int, part: int) -> Iterator[pa.RecordBatch]:
    places = np.unique(np.concatenate([p for h in hashes for p in _places(h, bits)]))
    cuts = np.searchsorted(places, np.arange(0, bits + 1, size))
    for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        own = np.zeros(size, bool)
        own[places[cuts[k] : cuts[k + 1]] - k * size] = True
        yield _row(part, k, np.packbits(own))


def _merge(group: pa.Table) -> pa.Table:
    rows = group.to_pylist()
    bits = np.frombuffer(zlib.decompress(rows[0]["bits"]), np.uint8)
    for row in rows[1:]:
        bits = bits | np.frombuffer(zlib.decompress(row["bits"]), np.uint8)
    return pa.Table.from_batches([_row(rows[0]["part"] // FAN_IN, rows[0]["segment"], bits)])


def build(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], Iterable[np.ndarray]], bits: int) -> Filter:
    """The filter of all hashes that ``hashes_of`` gives for the batches of the rows.

    ``bits`` is a power of two of at least ``MIN_BITS``; the driver receives so many bits, compressed.
    """
    size = max(MIN_BITS, bits >> 8)

    def collect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            for hashes in hashes_of(batch):
                held.append(hashes)
                count += len(hashes)
                if count >= _HELD:
                    yield from _segments(held, bits, size, part)
                    held, count = [], 0
        if count:
            yield from _segments(held, bits, size, part)

    parts = rows.mapInArrow(collect, _SCHEMA)
    for _ in range(2):
        parts = parts.groupBy("segment", F.floor(F.col("part") / FAN_IN)).applyInArrow(_merge, _SCHEMA)
    parts = parts.groupBy("segment").applyInArrow(_merge, _SCHEMA)
    whole = np.zeros(bits // 8, np.uint8)
    for row in parts.select("segment", "bits").collect():
        at = row.segment * (size // 8)
        whole[at : at + size // 8] = np.frombuffer(zlib.decompress(bytes(row.bits)), np.uint8)
    return Filter(whole, bits)


def hash_column(name: str) -> Callable[[pa.RecordBatch], Iterator[np.ndarray]]:
    """``hashes_of`` for rows that have their hashes in a column of longs."""

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield batch.column(name).to_numpy().view(np.uint64)

    return hashes
