"""Suffix-array dedup against plain Python, and its sort against sorted suffixes."""

from __future__ import annotations

import brute
import numpy as np
import pytest
from texts import pairs, prose
from pyspark.sql import functions as F

from meterlake.llm import queries, suffixes
from meterlake.llm.text import LAST_ID, Blob

def removed(frame):
    return sorted(tuple(r) for r in frame.select("id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect())


def test_cover():
    assert len({(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER}) == suffixes.PERIOD


@pytest.mark.parametrize("seed, letters, n", [(0, 2, 400), (1, 3, 900), (2, 1, 150), (3, 200, 300)])
def test_sort_suffixes(seed, letters, n):
    r = np.random.default_rng(seed)
    text = r.integers(1, 1 + letters, n).astype(np.uint8)
    if seed == 1:
        text[text == 1] = 0
        text[-1] = 9
    text[n // 2 : n - 1] = text[: n - 1 - n // 2]  # long ties at all residues
    padded = np.concatenate([text, np.zeros(4 * suffixes.PERIOD, np.uint8)])
    starts = r.permutation(n)[: n * 3 // 4]
    bucket = r.integers(0, 3, len(starts))
    order = suffixes.sort_suffixes(padded, n, starts, bucket)
    expected = sorted(range(len(starts)), key=lambda k: (bucket[k], text[starts[k] :].tobytes()))
    assert order.tolist() == expected


def test_anchors_are_in_every_string():
    texts = [prose(k, 30 + k).encode() for k in range(6)] + [b"z" * 130, b"", b"ab" * 70, b"short"]
    blob = Blob(texts)
    places, _, of = suffixes.anchors(blob, 100)
    for k, t in enumerate(texts):
        own = places[of == k] - blob.starts[k]
        for at in range(len(t) - 99):
            assert ((own >= at) & (own <= at + 80)).any()
    assert len(places) < 0.6 * len(blob.bytes)


@pytest.mark.parametrize("options", [{}, {"frequent": 2}, {"block": 50}, {"frequent": 3, "block": 30}, {"max_bits": 1 << 18, "frequent": 2, "block": 7}])
def test_bytes(hard_docs, options):
    found = suffixes.dedup_bytes(hard_docs, **options)
    expected = sorted(brute.byte_dedup(pairs(hard_docs)))
    assert removed(found) == expected
    assert sum(r[2] > 0 for r in expected) > 8


@pytest.mark.parametrize("size", [40, 57])
def test_other_sizes(spark, size):
    texts = [prose(k % 5, 20 + k) + "x" * (7 * k) + prose(40 + k // 4, 12) + "\0" * k for k in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = suffixes.dedup_bytes(docs, size=size)
    assert removed(found) == sorted(brute.byte_dedup(pairs(docs), size))


def test_spans(spark):
    a, b = prose(1, 30).replace("é", "e"), prose(2, 30).replace("é", "e")
    docs = spark.createDataFrame([(1, a), (2, f"{b}{a}")], "doc_id long, text string")
    rows = {r.id: r for r in suffixes.dedup_bytes(docs).collect()}
    assert rows[1].spans == [] and [(s.start, s.end) for s in rows[2].spans] == [(len(b), len(b) + len(a))]
    assert bytes(rows[2].kept).decode() == b


def test_given_texts(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    expected = sorted(brute.byte_dedup(pairs(docs)))
    assert sorted(tuple(r) for r in queries.op2_suffix_array_dedup(spark, sf_dir).collect()) == expected
    assert any(r[2] for r in expected)


def test_odd_rows(odd_docs, no_docs):
    got = sorted((r.id, r.n_bytes > 0, r.n_removed == r.n_bytes) for r in suffixes.dedup_bytes(odd_docs).collect())
    assert got == [(5, True, False), (5, True, False), (5, True, False), (7, True, True), (LAST_ID, False, True), (LAST_ID, True, True)]
    assert suffixes.dedup_bytes(no_docs).count() == 0


def test_an_anchor_with_ever_other_surroundings_is_dealt_to_bounded_blocks(spark):
    """One gram stands in every text, each time between other bytes: its shares are as many as it fills blocks."""
    gram = "QQQQQQQQQQQQQQQQQQQQ"
    for n in (600, 6000):
        docs = spark.range(n, numPartitions=4).selectExpr("id AS doc_id", f"concat(sha2(CAST(id AS STRING), 256), '{gram}', sha2(CAST(-id AS STRING), 256)) AS text")
        rows = suffixes.keyed(docs, "doc_id", "text")
        places, hashes, _ = suffixes.anchors(Blob([("a" * 90 + gram + "b" * 90).encode()]), 100)
        anchor = int(suffixes.grams(gram.encode()).view(np.int64)[0])
        found = spark.range(n, numPartitions=4).selectExpr(
            f"CAST({anchor} AS LONG) AS anchor", "xxhash64(id) AS around", "id", "id AS key", "0L AS place", "0 AS n_left", f"CAST('{gram}' AS BINARY) AS text", "0L AS stop"
        )
        frequent = spark.createDataFrame([(anchor, n)], "anchor long, n long")
        sizes = [r["count"] for r in suffixes.dealt(found, frequent, 100, n // 100 + 1).groupBy("block").count().collect()]
        assert max(sizes) <= 6 * 100 and sum(sizes) == n
        assert rows.count() == n and len(places) == len(hashes)


def test_settled_ranges_are_dealt_by_their_document(spark):
    found = spark.range(1000).selectExpr("CAST(NULL AS LONG) AS anchor", "CAST(NULL AS LONG) AS around", "id", "id AS key", "id AS place", "0 AS n_left", "CAST(NULL AS BINARY) AS text", "id + 100 AS stop")
    dealt = suffixes.dealt(found, spark.createDataFrame([(0, 10**6)], "anchor long, n long"), 100, 20)
    assert dealt.filter("frequent").count() == 0 and max(r["count"] for r in dealt.groupBy("block").count().collect()) < 120
