"""BPE encoding and decoding with forced boundaries.

A byte pair that occurs inside no vocabulary token can never be bridged by a merge, so a piece of text is
cut between its two bytes; the fragments are encoded independently and their ids concatenated. The
tokenizer's own cuts (its special tokens, then its pattern) come first, as its file prescribes.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkContext
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.text import chunks, rows_of

#: Pieces that a task remembers at the start of a chunk; with more it starts afresh.
REMEMBERED = 100_000
NO_RANK = (1 << 31) - 1
#: Fixed: the pattern of byte-level tokenizer files that say ``use_regex``.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Vocabulary:
    """A byte-level BPE vocabulary read from a tokenizer file; small, and the same for every task."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as handle:
            spec = json.load(handle)
        kind, model = spec["pre_tokenizer"], spec["model"]
        plain = kind["type"] == "ByteLevel" and kind["use_regex"] and not kind["add_prefix_space"] and spec["normalizer"] is None
        if not plain or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError(f"{file}: only plain byte-level BPE is supported")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word", "normalized")):
            raise ValueError(f"{file}: special tokens that take in their surroundings are not supported")
        letter_bytes = {c: b for b, c in byte_letters().items()}
        spell = lambda token: bytes(letter_bytes[c] for c in token)
        self.ids = {spell(token): i for token, i in model["vocab"].items() if token not in self.special}
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        pairs = [(self.ids[spell(a)], self.ids[spell(b)], self.ids[spell(a + b)]) for a, b in merges]
        left, right, self.made = (np.array(x, np.int64) for x in zip(*pairs))
        made_at = dict(zip(self.made.tolist(), range(len(self.made))))
        if any(max(made_at.get(a, -1), made_at.get(b, -1)) >= rank for rank, (a, b, _) in enumerate(pairs)):
            raise ValueError(f"{file}: a merge comes before the merge that makes its parts")
        self.ranks = _PairTable(left << 32 | right)
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        self.spelled = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.inside = np.zeros((256, 256), bool)
        for token in self.ids:
            pair = np.frombuffer(token, np.uint8)
            self.inside[pair[:-1], pair[1:]] = True

    def merge(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and ids of the tokens of fragments, given by where each starts; no merge crosses a start.

        All fragments advance together: each round merges in every fragment the pair of lowest rank, at all its
        places from the left. A pair made by a merge ranks after it, so this is the order of single merges.
        """
        ids, places, n = self.of_byte[data], np.arange(len(data)), len(data)
        fragment = np.zeros(n, np.int64)
        fragment[starts] = 1
        fragment = np.cumsum(fragment) - 1
        done_places, done_ids = [], []
        while len(ids):
            rank = np.full(len(ids), NO_RANK, np.int64)
            inner = np.flatnonzero(fragment[1:] == fragment[:-1])
            rank[inner] = self.ranks.find(ids[inner] << 32 | ids[inner + 1])
            first = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
            sizes = np.diff(np.append(first, len(ids)))
            lowest = np.minimum.reduceat(rank, first)
            going = np.repeat(lowest < NO_RANK, sizes)
            done_places.append(places[~going])
            done_ids.append(ids[~going])
            hit = going & (rank == np.repeat(lowest, sizes))
            at = np.flatnonzero(hit)
            # of adjacent hits, as in a run of one byte, every second one would reuse a token
            run = np.concatenate([[True], np.diff(at) > 1]) if len(at) else np.zeros(0, bool)
            if len(at) and not run.all():
                begin = at[run][np.cumsum(run) - 1]
                at = at[(at - begin) % 2 == 0]
            ids[at] = self.made[rank[at]]
            going[at + 1] = False
            ids, places, fragment = ids[going], places[going], fragment[going]
        if not done_ids:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        places, ids = np.concatenate(done_places), np.concatenate(done_ids)
        order = np.argsort(places, kind="stable")
        return places[order], ids[order]


class _PairTable:
    """Ranks of pairs in two hash tables without collisions: what collides in the first is in the second."""

    BITS = 18

    def __init__(self, keys: np.ndarray):
        self.tables = []
        ranks, factor = np.arange(len(keys)), 0x9E3779B97F4A7C15
        while len(keys):
            slots = self._slots(keys, factor)
            _, first = np.unique(slots, return_index=True)
            table = np.full(1 << self.BITS, -1, np.int64)
            values = np.full(1 << self.BITS, NO_RANK, np.int32)
            table[slots[first]], values[slots[first]] = keys[first], ranks[first]
            self.tables.append((factor, table, values))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, ranks = keys[rest], ranks[rest]
            factor = (factor * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) % (1 << 64) | 1

    def _slots(self, keys: np.ndarray, factor: int) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(factor)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The rank of each pair, or NO_RANK."""
        found = np.full(len(keys), NO_RANK, np.int32)
        for factor, table, values in self.tables:
            slots = self._slots(keys, factor)
            same = table[slots] == keys
            found[same] = values[slots[same]]
        return found


@functools.lru_cache(1)
def shared_vocabulary(context: SparkContext, file: str) -> Broadcast:
    """The vocabulary, read on the driver and sent to the executors, which need no such file."""
    return context.broadcast(Vocabulary(file))


@functools.lru_cache(1)
def shared_spelling(context: SparkContext, file: str) -> Broadcast:
    """The bytes of each id alone, for tasks that only decode."""
    return context.broadcast(shared_vocabulary(context, file).value.spelled)


class Encoder:
    """Encodes texts; remembers the ids of pieces and encodes all new pieces of a call together."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.pattern = regex.compile(PATTERN)
        # a special token is cut out wherever it stands, so no piece is ever spelled like one
        self.special = {token: np.int32(i).tobytes() for token, i in vocabulary.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.known = dict(self.special)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers in native order."""
        if len(self.known) > REMEMBERED:
            self.known = dict(self.special)
        pieces = list(map(self.pieces, texts))
        new = list({p for found in pieces for p in found if p not in self.known})
        self.known.update(zip(new, self.encode_pieces([p.encode() for p in new])))
        return [b"".join(map(self.known.__getitem__, found)) for found in pieces]

    def pieces(self, text: str) -> list[str]:
        if not any(token in text for token in self.special):
            return self.pattern.findall(text)
        parts = self.cuts.split(text)  # every second part is a special token
        return [p for k, part in enumerate(parts) for p in ([part] if k % 2 else self.pattern.findall(part))]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(lengths)
        starts = self.fragment_starts(data, ends - lengths)
        places, ids = self.vocabulary.merge(data, starts)
        bounds = np.searchsorted(places, np.concatenate([[0], ends])).tolist()
        packed = ids.astype(np.int32).tobytes()
        return [packed[4 * a : 4 * b] for a, b in zip(bounds, bounds[1:])]

    def fragment_starts(self, data: np.ndarray, piece_starts: np.ndarray) -> np.ndarray:
        """Where pieces start and where a forced boundary lies inside them."""
        starts = np.zeros(len(data), bool)
        starts[1:] = ~self.vocabulary.inside[data[:-1], data[1:]]
        starts[piece_starts] = True
        return np.flatnonzero(starts)


def encode(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of each whole text, as the tokenizers library gives them without added tokens.

    Special tokens written out in a text become their ids. Null and empty texts have no ids; bytes that are not UTF-8 count
    as U+FFFD. Rows come one for one.
    """
    held = shared_vocabulary(docs.sparkSession.sparkContext, tokenizer_file)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held.value)
        for batch in batches:
            for part, texts in chunks(batch):
                packed = encoder.encode([t.decode("utf-8", "replace") for t in texts])
                offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("id"), ids], names=["id", "ids"])

    return rows_of(docs, id_col, text_col).mapInArrow(run, "id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer_file: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, text): the text of the ids, special tokens included; bytes that are not UTF-8 become U+FFFD.

    Null ids decode to the empty text, an unknown id raises KeyError.
    """
    held = shared_spelling(encoded.sparkSession.sparkContext, tokenizer_file)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = held.value
        known = np.zeros(max(spelled) + 1, bool)
        known[list(spelled)] = True
        table = pa.array([spelled.get(i) for i in range(len(known))], pa.binary())
        for batch in batches:
            column = batch.column("ids")
            ids, cuts = column.values, column.offsets.to_numpy()
            ids = ids.slice(cuts[0], cuts[-1] - cuts[0])
            places = ids.to_numpy()
            strange = (places < 0) | (places >= len(known))
            strange[~strange] = ~known[places[~strange]]
            if strange.any():
                raise KeyError(int(places[strange][0]))
            # the spellings side by side; a text is the bytes between the offsets of its first and last id
            side = table.take(ids)
            ends = np.frombuffer(side.buffers()[1], np.int32)[side.offset : side.offset + len(side) + 1]
            data, at = memoryview(side.buffers()[2] or b""), ends[cuts - cuts[0]].tolist()
            texts = ["" if null else str(data[a:b], "utf-8", "replace") for a, b, null in zip(at, at[1:], column.is_null().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("ids"), pa.array(texts, pa.string())], names=["id", "ids", "text"])

    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "id long, ids array<int>, text string")
