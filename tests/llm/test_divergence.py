"""The divergence of sources against plain Python."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from texts import prose

from meterlake.llm import divergence, queries


def found(frame):
    return sorted(tuple(r) for r in frame.select("lang", "source", "part", "item", "value", "rank").collect())


def given(docs):
    return [(r.text, r.lang, r.source) for r in docs.collect()]


def test_given_texts(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    got = found(queries.op13_source_divergence(spark, sf_dir))
    assert got == sorted(brute.divergence(given(docs))) and {r[2] for r in got} == {"pair", "term"}


@pytest.fixture(scope="module")
def mixed(spark):
    r = random.Random(4)
    rows = [(k, prose(k, r.randrange(1, 60)) + " Übung ÉTÉ_x2y", r.choice(["en", "de", None]), r.choice("abcdef") if k % 5 else "hot", 1, "clash") for k in range(300)]
    rows += [(1, None, "en", "empty", 1, "x"), (1, "", "en", "empty", 1, "x"), (None, "1 2 _ 3", "fr", None, 1, "x"), (2, "alone", "it", "one", 1, "x")]
    rows += rows[:7]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long, term string").repartition(5)


@pytest.mark.parametrize("settings", [{}, {"block": 3}, {"block": 7, "columns": 5}, {"columns": 8}])
def test_blocks_and_tiles_change_nothing(mixed, settings):
    expected = sorted(brute.divergence(given(mixed), 10, 4))
    assert found(divergence.audit(mixed, min_docs=10, top_terms=4, **settings)) == expected
    assert ("en", "empty") in {r[:2] for r in expected} and ("de", "empty") not in {r[:2] for r in expected}


def test_languages_without_terms(mixed):
    got = found(divergence.audit(mixed, min_docs=10_000))
    assert got == sorted(brute.divergence(given(mixed), 10_000)) and {r[4] for r in got} == {0}


def test_odd_rows(spark, no_docs):
    from pyspark.sql import functions as F

    empty = no_docs.withColumn("source", F.lit("s"))
    assert divergence.audit(empty).count() == 0
    alone = spark.createDataFrame([(1, None, None, None)], "doc_id long, text string, lang string, source string")
    assert divergence.audit(alone).count() == 0


def test_ties_by_utf8(spark):
    words = "ä b a \U0001F600x ￿y zz".split()
    rows = [(k, " ".join(words), "en", s) for k in range(2) for s in ("ä", "a", "\U0001F600", "￿")] + [(9, "qq", "en", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert found(divergence.audit(docs, min_docs=1)) == sorted(brute.divergence(given(docs), 1))


def test_a_text_longer_than_a_chunk(spark):
    long = " ".join(prose(k, 900) for k in range(400))
    assert len(long.encode()) > divergence._CHUNK
    rows = [(1, long, "en", "a"), (2, prose(3, 50), "en", "b"), (3, long + " x", "en", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)
    assert found(divergence.audit(docs, min_docs=2)) == sorted(brute.divergence(given(docs), 2))


def test_large_counts_stay_exact(spark):
    n, total, terms = 10**14 + 7, 9 * 10**17 + 3, 10**9 + 9
    frame = spark.createDataFrame([(n, total, terms), (0, 0, 0), (0, 0, 3)], "n long, total long, terms long").coalesce(1)
    from pyspark.sql import functions as F

    got = [r.p for r in frame.select(divergence.probability(F.col("n"), F.col("total"), F.col("terms")).alias("p")).collect()]
    assert got == [1 + 10**9 * (n + 5) // (total + 5 * terms), 1, 1 + 10**9 // 3]


def test_joint_tables_count_pairs_of_levels():
    r = np.random.default_rng(2)
    counts = r.integers(0, 4, (50, 3))
    cells = counts + np.array([0, 4, 8])
    whole = np.zeros((12, 12), np.int64)
    for i, j, table in divergence.joint_tables(cells, 12, 5):
        whole[i : i + table.shape[0], j : j + table.shape[1]] = table
    for a in range(4):
        for b in range(4):
            assert whole[a, 8 + b] == ((counts[:, 0] == a) & (counts[:, 2] == b)).sum()
    prices = np.where(counts > 0, counts * 10**9 // 7, np.array([3, 4, 5]))
    direct = np.abs(prices[:, :, None] - prices[:, None, :]).sum(axis=0)
    for limit in (1, 4, 1000):
        assert (divergence.distances(counts, prices, limit) == direct).all()
