"""Line dedup: lines that many documents share, found with two Bloom filters and confirmed exactly.

One pass deals the hashes of line keys, and nothing else, to tasks that hold a filter of those seen once; what they
meet in a second document makes the second filter, of keys seen twice, which is broadcast. Another pass
sends on only the keys that the second filter holds; those are counted exactly, one row per document and
key, with partial sums in the map tasks, so a line found in a third of all documents costs no more than
another. The decisions go back to the documents by their id. Where keys seen twice are too many for a
broadcast, the pass sends all keys with their hashes and a join keeps those seen twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm import filters
from meterlake.llm.text import SPACES, keyed, other_columns, per_chunk, signed, with_row
from meterlake.sources.scratch import materialize

SHORT_KEY = 64


def line_key(line: bytes) -> bytes:
    return line.strip(SPACES).lower()


def _code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode())


def _keys(text: bytes, min_chars: int) -> set[bytes]:
    found = {line_key(line) for line in text.split(b"\n")}
    found.discard(b"")
    return found if min_chars <= 1 else {k for k in found if _code_points(k) >= min_chars}


def _name(key: bytes) -> bytes:
    """The key itself, or the SHA-256 of a long one."""
    return b"=" + key if len(key) <= SHORT_KEY else b"#" + hashlib.sha256(key).digest()


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))


def _batch_hashes(batch: pa.RecordBatch, min_chars: int) -> pa.RecordBatch:
    """(hash, n): the hashes of the batch's keys, with the number of its documents that hold them."""
    held = [_hashes(list(_keys(text, min_chars))) for text in batch.column("text").to_pylist()]
    found, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(signed(found)), pa.array(n.astype(np.int64))], names=["hash", "n"])


def suspected_lines(rows: DataFrame, min_chars: int, max_bits: int) -> DataFrame:
    """(id, key, line): the key names of each document that another document seems to hold as well."""
    hashed = rows.select("text").mapInArrow(lambda batches: (_batch_hashes(b, min_chars) for b in batches), "hash long, n long")
    twice = materialize(filters.second_sightings(hashed), "lines-seen-twice")
    n = twice.count()
    held = None
    if filters.fits(n, max_bits):
        held = rows.sparkSession.sparkContext.broadcast(filters.build(twice, filters.hash_column("hash"), filters.bits_for(n, max_bits)))

    def suspects(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, names, hashes = [], [], [np.zeros(0, np.uint64)]
            for i, text in enumerate(batch.column("text").to_pylist()):
                keys = list(_keys(text, min_chars))
                if not keys:
                    continue
                own = _hashes(keys)
                again = np.flatnonzero(held.value.holds(own)) if held else np.arange(len(keys))
                at.extend([i] * len(again))
                names.extend(_name(keys[k]) for k in again.tolist())
                hashes.append(own[again])
            taken = batch.select(["id", "key"]).take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(names, pa.binary()), pa.array(signed(np.concatenate(hashes)))], names=["id", "key", "line", "hash"]
            )

    found = rows.mapInArrow(suspects, "id long, key long, line binary, hash long")
    return (found if held else found.join(twice, "hash", "left_semi")).select("id", "key", "line")


def repeated_lines(rows: DataFrame, min_chars: int, min_docs: int, max_bits: int) -> DataFrame:
    """(id, key, dropped, keepers): for each row of ``keyed`` documents with repeated lines, their key names.

    ``keepers`` are those whose first document (smallest id) this row is.
    """

    found = materialize(suspected_lines(rows, min_chars, max_bits), "lines")
    repeated = found.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).filter(F.col("n") >= max(min_docs, 2))
    repeated = materialize(repeated.select("line", "first"), "repeated-lines")
    return (
        found.join(repeated, "line")
        .groupBy("id", "key")
        .agg(F.collect_set("line").alias("dropped"), F.collect_set(F.when(F.col("first") == F.col("id"), F.col("line"))).alias("keepers"))
    )


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
    min_chars: int = 1, min_docs: int = 10, keep_first: bool = False, max_bits: int = filters.MAX_BITS, carry: bool = False,
) -> DataFrame:
    """(id, key, n_lines, n_dropped, kept): texts without the lines that at least ``min_docs`` documents hold.

    A line's key is the line stripped of ASCII white space, A-Z lower-cased; keys under ``min_chars`` code
    points stay. Every row counts as a document, also a repeated one. With ``keep_first`` the document of the
    smallest id keeps its first such line. Null and empty texts are one empty line. A text whose lines all go
    is empty. Rows come one for one; null ids are the largest long. With ``carry`` the other columns follow as ``row``.
    """
    rows = keyed(docs, id_col, text_col, *other_columns(docs, text_col, carry))
    if min_docs < 2:
        raise ValueError("min_docs starts at 2")
    lines = repeated_lines(rows.select("id", "key", "text"), min_chars, min_docs, max_bits)
    joined = rows.join(lines.hint("shuffle_hash"), ["id", "key"], "left")

    def cut(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        n_lines, n_dropped, kept = [], [], []
        for text, dropped, keepers in zip(texts, batch.column("dropped").to_pylist(), batch.column("keepers").to_pylist()):
            lines = text.split(b"\n")
            n_lines.append(len(lines))
            if dropped:
                gone, first = set(dropped), set(keepers or ()) if keep_first else set()
                stay = []
                for line in lines:
                    name = _name(line_key(line))
                    if name not in gone:
                        stay.append(line)
                    elif name in first:
                        first.discard(name)
                        stay.append(line)
                text = b"\n".join(stay)
                n_dropped.append(len(lines) - len(stay))
            else:
                n_dropped.append(0)
            kept.append(text)
        columns = {
            "id": batch.column("id"), "key": batch.column("key"), "n_lines": pa.array(n_lines, pa.int64()),
            "n_dropped": pa.array(n_dropped, pa.int64()), "kept": pa.array(kept, pa.binary()),
        } | ({"row": batch.column("row")} if carry else {})
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    result = with_row("id long, key long, n_lines long, n_dropped long, kept binary", rows)
    return joined.mapInArrow(per_chunk(cut, 16 << 20), result)
