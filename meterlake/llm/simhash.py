"""SimHash near-dedup: exact comparison of fingerprints in tiles.

Two fingerprints within ``radius`` bits agree on ``agree`` of any ``radius + agree`` blocks of bits, so all
links lie within cells of equal blocks. Cells are compared in tiles ordered by population count, by numpy
exclusive-or and bit counts; tile pairs whose counts differ by more than the radius are skipped. Small cells
share tiles; cells too large for a task are split into pairs of parts. A task sends on only a spanning forest of the links it found, never
the pairs. Components come from star contraction on tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.text import keyed, per_chunk, signed
from meterlake.sources.scratch import materialize

SEED = 42
SHINGLE = 4
RADIUS = 4
AGREE = 2
#: Fingerprints in a tile: of one large cell, and of several small ones.
TILE, SMALL_TILE = 512, 64
#: Fingerprints in one comparison; a larger cell is split.
PART = 8192


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits; a bit is 1 if it is set in over half of the shingles' hashes. No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        digests = xxhash.xxh64_digest(b" ".join(words), SEED)
    else:
        line = b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths)
        starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
        ends = (ends - 1)[shingle - 1 :].tolist()
        digests = b"".join([xxhash.xxh64_digest(line[a:b], SEED) for a, b in zip(starts, ends)])
    bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(bits)).tobytes(), "big")


def fingerprints(rows: DataFrame, shingle: int) -> DataFrame:
    """(id, key, fp) of ``keyed`` rows."""

    def run(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        found = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(signed(found))], names=["id", "key", "fp"])

    return rows.mapInArrow(per_chunk(run), "id long, key long, fp long")


class Forest:
    """Union-find over 0..n-1 that takes links in arrays."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                shorter = self.label[self.label]
                if (shorter == self.label).all():
                    break
                self.label = shorter


def tile_links(cells: np.ndarray, fps: np.ndarray, radius: int, tile: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Links within cells as a forest: the places of linked fingerprints and the place each is joined to; and how many
    pairs of tiles were compared and skipped.

    The rows are put in the order of cell and population count and cut into tiles. Of the pairs of tiles that share a cell,
    those whose counts in it differ beyond the radius are skipped; the others are compared by exclusive-or and bit counts.
    """
    weight = np.bitwise_count(fps)
    order = np.lexsort((weight, cells))
    cells, fps, weight = cells[order], fps[order], weight[order].astype(np.int64)
    forest, n, compared, skipped = Forest(len(fps)), len(fps), 0, 0
    for a in range(0, n, tile):
        last = min(a + tile, n) - 1
        for b in range(a, n, tile):
            if b > a and cells[b] != cells[last]:
                break
            if b > a and weight[b] - weight[last] > radius:
                # the cell's remaining rows are heavier still
                skipped += (int(np.searchsorted(cells, cells[last], "right")) - 1 - b) // tile + 1
                break
            compared += 1
            near = np.bitwise_count(fps[a : a + tile, None] ^ fps[None, b : b + tile]) <= radius
            near &= cells[a : a + tile, None] == cells[None, b : b + tile]
            i, j = np.nonzero(near)
            apart = i + a < j + b
            if apart.any():
                forest.join(i[apart] + a, j[apart] + b)
    linked = np.flatnonzero(forest.label != np.arange(n))
    return order[linked], order[forest.label[linked]], compared, skipped


def _compare(batches: Iterable[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell: cells smaller than a large tile share small tiles, larger ones are cut into large tiles."""
    fields = ["node", "root"]

    def links(cells: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        sizes = np.diff(np.append(starts, len(cells)))
        small = np.repeat((sizes < TILE) & (sizes > 1), sizes)
        parts = [(cells[small], fps[small], SMALL_TILE)]
        parts += [(cells[a : a + n], fps[a : a + n], TILE) for a, n in zip(starts[sizes >= TILE].tolist(), sizes[sizes >= TILE].tolist())]
        for own_cells, own, tile in parts:
            node, root, _, _ = tile_links(own_cells, own, radius, tile)
            if len(node):
                yield pa.RecordBatch.from_arrays([pa.array(signed(own[node])), pa.array(signed(own[root]))], names=fields)

    held_cells, held_fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        cells = np.concatenate([held_cells, batch.column("cell").to_numpy()])
        fps = np.concatenate([held_fps, batch.column("fp").to_numpy().view(np.uint64)])
        if not len(cells):
            continue
        open_from = int(np.searchsorted(cells, cells[-1]))
        if open_from:
            yield from links(cells[:open_from], fps[:open_from])
        held_cells, held_fps = cells[open_from:], fps[open_from:]
    if len(held_cells):
        yield from links(held_cells, held_fps)


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, agree: int = AGREE, part: int = PART) -> DataFrame:
    """(node, root): links that connect exactly the distinct fingerprints of ``fp`` within ``radius`` bits."""
    blocks = np.array_split(np.arange(64), radius + agree)
    masks = [int(sum(1 << int(bit) for bit in block)) for block in blocks]
    cells = []
    for k, chosen in enumerate(combinations(masks, agree)):
        mask = sum(chosen)
        cells.append(F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))))
    dealt = fps.select("fp", F.explode(F.array(*cells)).alias("cell"))
    # cells of more than `part` fingerprints: each row goes to every pair of parts that holds its own
    large = dealt.groupBy("cell").count().filter(F.col("count") > part).select("cell", F.ceil(F.col("count") / part).cast("int").alias("parts"))
    mine, other = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")), F.col("other")
    split = (
        dealt.join(materialize(large, "large-cells"), "cell", "left")
        .select("fp", "cell", mine.alias("mine"), F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))).alias("other"))
        .select("fp", F.when(F.col("mine").isNull(), F.col("cell")).otherwise(F.xxhash64("cell", F.least("mine", other), F.greatest("mine", other))).alias("cell"))
    )
    return split.repartition("cell").sortWithinPartitions("cell").mapInArrow(lambda batches: _compare(batches, radius), "node long, root long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all linked nodes but the roots: the smallest node of each connected component.

    Large-star and small-star steps alternate until the links stay as they are; each step is a grouped minimum
    and a join on the node, written to a table in the shared folder.
    """

    def star(pairs: DataFrame, both_ways: bool) -> DataFrame:
        a, b = F.greatest("node", "root"), F.least("node", "root")
        pairs = pairs.select(a.alias("u"), b.alias("v"))
        if both_ways:
            pairs = pairs.union(pairs.select("v", "u"))
        smallest = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = pairs.join(smallest, "u")
        if both_ways:
            moved = joined.filter("v > u").select(F.col("v").alias("node"), F.col("m").alias("root"))
        else:
            moved = joined.select("v", "m").union(smallest.select("u", "m")).toDF("node", "root")
        return moved.filter("node <> root").distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())

    now = materialize(links.filter("node <> root").distinct(), "links")
    before, known = None, state(now)
    while known != before and known[0]:
        now = materialize(star(star(now, True), False), "links")
        before, known = known, state(now)
    return now


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE, radius: int = RADIUS, agree: int = AGREE,
) -> DataFrame:
    """(id, key, fp, component_id, component_key): each row's fingerprint and the first row of its component.

    Texts are A-Z lower-cased, split at ASCII white space, and hashed in shingles of ``shingle`` words (XXH64,
    seed 42); a shorter text is one shingle. Fingerprints link at ``radius`` bits or fewer; links are transitive.
    Null, empty and blank texts have fingerprint 0 and link like any other. The first row is that of the smallest
    (id, key); a null id counts as the largest long. Rows come one for one.
    """
    found = materialize(fingerprints(keyed(docs, id_col, text_col), shingle), "fingerprints")
    distinct = materialize(found.groupBy("fp").agg(F.min(F.struct("id", "key")).alias("first")), "distinct-fingerprints")
    roots = components(fingerprint_links(distinct.select("fp"), radius, agree))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("of"))
    named = materialize(rooted.join(firsts, "root").select("fp", F.col("of.id").alias("component_id"), F.col("of.key").alias("component_key")), "components")
    return found.join(named, "fp").select("id", "key", "fp", "component_id", "component_key")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of the documents without all but the first row of each group of near duplicates.

    Of rows equal in id and text, whatever their other columns, one stays, and which one is not defined.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    firsts = found.filter("id = component_id and key = component_key").select("id", "key").distinct()
    rows = keyed(docs, id_col, text_col, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).drop("text")
    return rows.join(firsts, ["id", "key"], "left_semi").dropDuplicates(["id", "key"]).select("row.*")
