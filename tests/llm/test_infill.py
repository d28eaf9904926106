"""Fill-in-the-middle against plain Python, and its way back."""

from __future__ import annotations

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import pairs, prose

from meterlake.llm import infill, queries


def found(docs):
    rows = infill.restore(infill.fill_in_middle(docs))
    return sorted((tuple(r) for r in rows.select("id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256), F.sha2("text", 256)).collect()), key=repr)


def test_hard_texts(hard_docs):
    expected = sorted(brute.fill_in_middle(pairs(hard_docs)), key=repr)
    assert found(hard_docs) == expected
    assert {r[2] for r in expected} == {"plain", "psm", "spm"}


def test_given_texts(spark, sf_dir):
    got = queries.op12_fill_in_middle(spark, sf_dir)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    expected = sorted(brute.fill_in_middle(pairs(queries.documents(spark, sf_dir))), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert found(odd_docs) == sorted(brute.fill_in_middle(rows), key=repr)
    assert infill.restore(infill.fill_in_middle(no_docs)).count() == 0


def test_texts_with_sentinels_and_parts_of_them(spark):
    rows = [(k, t) for k in range(40) for t in ("a <P> b c", "x<S>", "<M>", "a < P > <S <P M> >S> b", "< S>a <P", "<<P >> é <", "  lead and trail \n ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(docs)
    assert got == sorted(brute.fill_in_middle(rows), key=repr)
    whole = {brute.sha(t) for t in ("a <P> b c", "x<S>", "<M>")}
    assert {r[2] for r in got if r[6] in whole} == {"plain"} and {r[2] for r in got if r[6] not in whole} == {"plain", "psm", "spm"}


def test_a_text_longer_than_a_chunk(spark):
    long = "\n".join(f"{prose(k, 400)} é" for k in range(900))
    assert len(long.encode()) > 2 * infill._CHUNK
    rows = [(k, f"{long} {k}") for k in range(6)] + [(9, "short one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = found(docs)
    assert got == sorted(brute.fill_in_middle(rows), key=repr) and {r[2] for r in got} > {"plain"}


def test_shares_and_carried_columns(spark):
    docs = spark.createDataFrame([(k, prose(k, 20), "x", k) for k in range(60)], "doc_id long, text string, form string, n long")
    every = infill.fill_in_middle(docs, cut_share=100, spm_share=0, seed=7, carry=True)
    rows = infill.restore(every).collect()
    assert {r.form for r in rows} == {"psm"} and all(r.row.form == "x" and r.row.n == r.id for r in rows)
    assert {r.id: bytes(r.text).decode() for r in rows} == dict(pairs(docs))
    assert infill.fill_in_middle(docs, cut_share=0).filter("form <> 'plain'").count() == 0


@pytest.mark.parametrize("low, between, high", [(0, 3, 9), (2, 2, 7), (2, 7, 7), (1, 6, 9), (4, 4, 4)])
def test_rotation(low, between, high):
    data = bytearray(range(9))
    infill.rotate(data, low, between, high)
    assert list(data) == [*range(low), *range(between, high), *range(low, between), *range(high, 9)]


def test_every_pair_of_cuts_comes_back():
    text = "ab <c> é d".encode()
    for low in range(len(text) + 1):
        for high in range(low, len(text) + 1):
            for form in (infill.PSM, infill.SPM):
                assert infill.rearrange(infill.arrange(text, low, high, form), form) == text


def test_units_end_where_words_do():
    ends = infill.unit_ends([b"", b" ", b"a", b" a\tb ", b"\x1ca \x85"])
    assert [e.tolist() for e in ends] == [[], [1], [1], [2, 4, 5], [2, 4]] and all(isinstance(e, np.ndarray) for e in ends)
