"""The operators that compare documents with each other, against plain Python."""

from __future__ import annotations

import brute
import numpy as np
import pytest
from texts import pairs, prose
from pyspark.sql import functions as F

from meterlake.llm import filters, lines, queries, simhash, substrings
from meterlake.llm.text import LAST_ID


def columns(frame, *names):
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)


def kept(frame, *names):
    return columns(frame, *names, F.sha2("kept", 256))


def test_lines(hard_docs):
    found = lines.dedup_lines(hard_docs)
    assert kept(found, "id", "n_lines", "n_dropped") == sorted(brute.line_dedup(pairs(hard_docs)), key=repr)
    assert found.filter("n_dropped > 0").count() == 14


def test_lines_given_texts(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    assert columns(queries.op5_line_dedup(spark, sf_dir), "*") == sorted(brute.line_dedup(pairs(docs)), key=repr)


def test_lines_keep_first_and_min_chars(spark):
    rows = [(k, f"\nkeep me\nx\nown {k}\nkeep me ") for k in (3, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first = {r.id: bytes(r.kept).decode() for r in lines.dedup_lines(docs, min_docs=2, keep_first=True).collect()}
    assert first == {1: "\nkeep me\nx\nown 1", 2: "\nown 2", 3: "\nown 3"}
    longer = {r.id: bytes(r.kept).decode() for r in lines.dedup_lines(docs, min_docs=3, min_chars=2).collect()}
    assert longer == {k: f"\nx\nown {k}" for k in (1, 2, 3)}


def test_lines_odd_rows(odd_docs, no_docs):
    got = kept(lines.dedup_lines(odd_docs, min_docs=4), "id", "n_lines", "n_dropped")
    rows = [(LAST_ID if r.doc_id is None else r.doc_id, r.text) for r in odd_docs.collect()]
    assert got == sorted(brute.line_dedup(rows, 4), key=repr)
    assert lines.dedup_lines(no_docs).count() == 0


def test_a_full_filter_changes_nothing(hard_docs, monkeypatch):
    monkeypatch.setattr(filters.Filter, "holds", lambda self, hashes: np.ones(len(hashes), bool))
    assert kept(lines.dedup_lines(hard_docs), "id", "n_lines", "n_dropped") == sorted(brute.line_dedup(pairs(hard_docs)), key=repr)


def test_lines_that_do_not_fit_a_broadcast(hard_docs):
    found = lines.dedup_lines(hard_docs, max_bits=1)
    assert kept(found, "id", "n_lines", "n_dropped") == sorted(brute.line_dedup(pairs(hard_docs)), key=repr)
    rows = simhash.keyed(hard_docs, "doc_id", "text").select("id", "key", "text")
    joined, looked_up = (columns(lines.suspected_lines(rows, 1, bits), "*") for bits in (1, filters.MAX_BITS))
    assert set(joined) <= set(looked_up) and len(looked_up) < len(joined) + 10


def hashes(frame):
    return np.array([r[0] for r in frame.collect()], np.int64).view(np.uint64)


def test_a_filter_knows_all_it_was_given(spark):
    frame = spark.range(3000, numPartitions=5).select(F.xxhash64("id").alias("h")).union(spark.range(500).select(F.xxhash64("id").alias("h")))
    found = filters.build(frame, filters.hash_column("h"), filters.bits_for(3000))
    known, other = (hashes(spark.range(a, b).select(F.xxhash64("id"))) for a, b in ((0, 3000), (3000, 9000)))
    assert found.holds(known).all() and found.holds(other).mean() < 0.05


def test_filter_sizes_follow_the_keys():
    assert filters.bits_for(0) == filters.MIN_BITS and filters.bits_for(10**6) >= 10**7 and filters.bits_for(10**6) <= 2 * 10**7
    assert filters.bits_for(10**12) == filters.MAX_BITS and filters.fits(10**7) and not filters.fits(10**9)


@pytest.mark.parametrize("scale", [1, 1000])
def test_suspects_stay_the_true_repeats_at_any_size(spark, scale):
    """2,000 or 2,000,000 hashes, a tenth of them twice: the fill of the slices and the false suspects stay."""
    n = 2000 * scale
    once = spark.range(n, numPartitions=8).select(F.xxhash64("id").alias("hash"), F.lit(1).cast("long").alias("n"))
    again = spark.range(0, n, 10, numPartitions=3).select(F.xxhash64("id").alias("hash"), F.lit(1).cast("long").alias("n"))
    found = filters.second_sightings(once.union(again).union(spark.createDataFrame([(7, 2)], "hash long, n long")))
    true = spark.range(0, n, 10).select(F.xxhash64("id").alias("hash"))
    assert true.join(found, "hash", "left_anti").count() == 0 and found.filter("hash = 7").count() == 1
    assert found.count() <= 1.1 * (n // 10) + 1
    seen = filters.Seen(1 << 18)
    for part in np.array_split(hashes(once.select("hash").limit(n)), 5):
        seen.add(part)
    assert all(s.fill() < 0.3 for s in seen.slices) and (scale == 1 or len(seen.slices) > 2)


def test_substrings(hard_docs):
    found = substrings.dedup_substrings(hard_docs)
    expected = sorted(brute.substring_dedup(pairs(hard_docs)), key=repr)
    assert kept(found, "id", "n_words", "n_removed") == expected
    assert sum(r[2] > 0 for r in expected) > 5


@pytest.mark.parametrize("window", [3, 4, 13, 51])
def test_substrings_other_windows(spark, window):
    docs = spark.createDataFrame([(k, prose(k % 7, 40 + 3 * k) + " " + prose(90 + k // 5, 60)) for k in range(40)], "doc_id long, text string").repartition(6)
    found = substrings.dedup_substrings(docs, window=window)
    assert kept(found, "id", "n_words", "n_removed") == sorted(brute.substring_dedup(pairs(docs), window), key=repr)


def test_substrings_of_frequent_anchors(spark, hard_docs):
    found = substrings.dedup_substrings(hard_docs.repartition(9), frequent=1)
    assert kept(found, "id", "n_words", "n_removed") == sorted(brute.substring_dedup(pairs(hard_docs)), key=repr)
    docs = spark.createDataFrame([(200 - k, f"{prose(k, 30)} {prose(500, 90)} {prose(1000 + k % 9, 60)}") for k in range(200)], "doc_id long, text string")
    found = substrings.dedup_substrings(docs.repartition(20), frequent=10)
    assert kept(found, "id", "n_words", "n_removed") == sorted(brute.substring_dedup(pairs(docs)), key=repr)


def test_substrings_frequent_windows_shuffle_once(spark):
    """The rows of both branches come from one run of the kernel and one exchange."""
    rows = [(1, 1, k, k, 0, 0, 1 + k % 3) for k in range(300)] + [(2, 2, k, k, 1, 4, 0) for k in range(5)]
    found = spark.createDataFrame(rows, "first long, second int, id long, key long, start int, run int, share byte")
    found = found.repartition(4).mapInArrow(lambda batches: batches, found.schema)
    later = substrings.later_than_first(found)
    assert sorted(r.id for r in later.collect()) == sorted([*range(1, 300), *range(5)])
    plan = later._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan


def test_substrings_given_texts(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    expected = sorted(brute.substring_dedup(pairs(docs)), key=repr)
    assert columns(queries.op3_substring_dedup(spark, sf_dir), "*") == expected
    assert any(r[2] for r in expected)


def test_substrings_odd_rows(odd_docs, no_docs):
    got = sorted((r.id, r.n_removed) for r in substrings.dedup_substrings(odd_docs).collect())
    assert got == [(5, 0), (5, 0), (5, 0), (7, 80), (LAST_ID, 0), (LAST_ID, 80)]
    assert substrings.dedup_substrings(no_docs).count() == 0


def prints(found):
    return columns(found, "id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")


def test_simhash(hard_docs):
    assert prints(simhash.near_duplicates(hard_docs)) == sorted(brute.simhash(pairs(hard_docs)), key=repr)


def test_simhash_given_texts(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    expected = sorted(brute.simhash(pairs(docs)), key=repr)
    assert columns(queries.op9_simhash_near_dedup(spark, sf_dir), "*") == expected
    assert any(r[0] != r[2] for r in expected)


def test_simhash_odd_rows(odd_docs, no_docs):
    got = sorted((r.id, r.component_id) for r in simhash.near_duplicates(odd_docs).collect())
    assert got == [(5, 5), (5, 5), (5, 5), (7, 5), (LAST_ID, 5), (LAST_ID, LAST_ID)]
    assert simhash.near_duplicates(no_docs).count() == 0


def some_prints(n, seed):
    """Chains and balls of near fingerprints among random ones."""
    r = np.random.default_rng(seed)
    found = list(r.integers(0, 1 << 63, n // 3, dtype=np.uint64))
    while len(found) < n:
        x = int(found[r.integers(0, len(found))])
        for bit in r.integers(0, 64, r.integers(1, 7)):
            x ^= 1 << int(bit)
        found.append(np.uint64(x))
    return np.unique(np.array(found, np.uint64))


def roots(fps, radius):
    forest = simhash.Forest(len(fps))
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= radius)
    forest.join(i, j)
    signed = fps.view(np.int64)
    lowest = {}
    for k, label in enumerate(forest.label):
        lowest[label] = min(lowest.get(label, signed[k]), signed[k])
    return {int(signed[k]): int(lowest[label]) for k, label in enumerate(forest.label)}


@pytest.mark.parametrize("agree, part", [(1, 8192), (2, 8192), (2, 40), (1, 60)])
def test_links_and_components(spark, agree, part):
    fps = some_prints(700, agree)
    frame = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = {r.node: r.root for r in simhash.components(simhash.fingerprint_links(frame, 4, agree, part)).collect()}
    assert {x: found.get(x, x) for x in fps.view(np.int64).tolist()} == roots(fps, 4)


@pytest.mark.parametrize("tile", [1, 7, 64, 512])
def test_tiles_skip_nothing_that_links(tile):
    fps = some_prints(1500, 3)
    cells = np.sort(np.random.default_rng(1).integers(0, 40, len(fps)))
    cells[900:] = 99
    cells.sort()
    node, root, compared, skipped = simhash.tile_links(cells, fps, 4, tile)
    forest, whole = simhash.Forest(len(fps)), simhash.Forest(len(fps))
    forest.join(node, root)
    near = (np.bitwise_count(fps[:, None] ^ fps[None]) <= 4) & (cells[:, None] == cells[None])
    whole.join(*np.nonzero(near))
    assert (forest.label == whole.label).all() and len(node) < len(fps)
    assert compared and (skipped or tile > 64)


def test_tiles_of_the_given_texts(spark, sf_dir):
    """Every link of the given texts comes from a compared pair of tiles; lighter and heavier tiles of a cell are skipped."""
    prints_of = simhash.fingerprints(simhash.keyed(queries.documents(spark, sf_dir), "doc_id", "text"), 4)
    fps = np.unique(np.array([r.fp for r in prints_of.collect()], np.int64).view(np.uint64))
    one_cell = np.zeros(len(fps), np.int64)
    node, root, compared, skipped = simhash.tile_links(one_cell, fps, 4, 8)
    tiles = -(-len(fps) // 8)
    assert compared + skipped == tiles * (tiles + 1) // 2 and skipped > 0
    forest = simhash.Forest(len(fps))
    forest.join(node, root)
    whole = roots(fps, 4)
    assert len(set(forest.label.tolist())) == len(set(whole.values()))
