"""Whole texts as byte arrays: chunks of a batch, words, their hashes and rolling windows, in numpy.

Every kernel here works on a part of a batch at a time, whatever the size of an Arrow batch;
one text longer than that is a chunk of its own, so no text is ever cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BYTES = 1 << 19
LAST_ID = (1 << 63) - 1
BATCH_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: True for bytes of the words [^\x20\x09-\x0D]+.
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[list(SPACES)] = False
#: True for bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing.
ALNUM_BYTES = np.zeros(256, bool)
ALNUM_BYTES[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _short_batches(docs: DataFrame) -> None:
    """Texts are long: Arrow batches of this session get no more than so many rows."""
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_ROWS)) <= BATCH_ROWS:
        conf.set(_BATCH_ROWS, str(BATCH_ROWS))


def rows_of(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """The two columns that an operator reads, as ``id`` (long) and ``text`` (binary); others may have any name."""
    _short_batches(docs)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"), *more)


def other_columns(docs: DataFrame, text_col: str, carry: bool = True) -> list[Column]:
    """All columns but the text as one struct ``row``, whatever their names; nothing without ``carry``."""
    return [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")] if carry else []


def with_row(result: str, rows: DataFrame) -> T.StructType:
    """The schema of a result, with the struct ``row`` where the rows carry it."""
    schema = T.StructType.fromDDL(result)
    return schema.add("row", rows.schema["row"].dataType) if "row" in rows.columns else schema


def restored(found: DataFrame, docs: DataFrame, text_col: str, text: Column) -> DataFrame:
    """Rows with a carried ``row`` as rows of the documents' columns, with another text."""
    kind = docs.schema[text_col].dataType
    return found.select(*[text.cast(kind).alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """``rows_of`` and ``key``, a hash of the text: with ``id`` it names a row; equal rows share it.

    A null id counts as the largest, a null text as empty.
    """
    _short_batches(docs)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"), *more
    )


def chunks(batch: pa.RecordBatch, limit: int = CHUNK_BYTES, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with their texts; null is empty."""
    texts = [t if t is not None else b"" for t in batch.column(column).to_pylist()]
    low, size = 0, 0
    for i, t in enumerate(texts):
        if i > low and size + len(t) > limit:
            yield batch.slice(low, i - low), texts[low:i]
            low, size = i, 0
        size += len(t) + 1
    if low < len(texts):
        yield batch.slice(low), texts[low:]


def per_chunk(kernel: Callable[[pa.RecordBatch, list[bytes]], pa.RecordBatch], limit: int = CHUNK_BYTES, column: str = "text"):
    """A ``mapInArrow`` function that runs the kernel on each chunk."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, limit, column):
                yield kernel(part, texts)

    return run


class Blob:
    """Texts one after the other, each followed by a line feed."""

    def __init__(self, texts: list[bytes]):
        self.bytes = b"\n".join(texts) + b"\n"
        self.data = np.frombuffer(self.bytes, np.uint8)
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + 1)[:-1]]).astype(np.int64)
        self.ends = self.starts + self.lengths

    def words(self, kinds: np.ndarray) -> "Words":
        mask = kinds[self.data]
        edges = np.flatnonzero(mask[1:] != mask[:-1]) + 1
        if len(mask) and mask[0]:
            edges = np.concatenate([[0], edges])
        return Words(self, edges[0::2].astype(np.int64), edges[1::2].astype(np.int64), mask)


class Words:
    """Words of a blob: byte ranges, and for each text the range of its words."""

    def __init__(self, blob: Blob, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray):
        self.blob, self.starts, self.ends, self.mask = blob, starts, ends, mask
        self.first = np.searchsorted(starts, blob.starts)
        self.counts = np.diff(np.concatenate([self.first, [len(starts)]]))
        self.doc = np.repeat(np.arange(len(blob.starts)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        return span_hashes((LOWER_VALUES if lower else BYTE_VALUES)[self.blob.data], self.starts, self.ends)

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return (self.first + self.counts)[self.doc] - np.arange(len(self.starts))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[0x41:0x5B] = BYTE_VALUES[0x61:0x7B]

_BASE = 0xD1342543DE82EF95
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 2))
        table = np.full(size, base, np.uint64)
        table[0] = 1
        _POWERS[base] = np.multiply.accumulate(table)
    return _POWERS[base][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the values in each range, the same wherever the range lies."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), out=sums[1:])
    inverse = _powers(pow(_BASE, -1, 1 << 64), len(values) + 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def rolling(values: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` values; by doubling, so in log(width) steps."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, done, part, size, power = np.zeros(n, np.uint64), 0, values, 1, base
    while True:
        if width & size:
            total = total * np.uint64(power) + part[done : done + n]
            done += size
        if 2 * size > width:
            return mix(total)
        part = part[:-size] * np.uint64(power) + part[size:]
        power = power * power % (1 << 64)
        size *= 2


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """True where one of the ranges [start, start + length) lies over 0..n-1."""
    steps = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(starts + lengths, minlength=n + 1)[: n + 1]
    return np.cumsum(steps)[:n] > 0


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
