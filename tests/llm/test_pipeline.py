"""The pipeline's stages against plain Python, each on its own input."""

from __future__ import annotations

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterlake.llm import langid, queries
from meterlake.llm.tokenizers import tokenizer_file


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    """What each stage was given, and the last result."""
    given = [queries.documents(spark, sf_dir)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, given[-1], sf_dir).write.parquet(path)
        given.append(spark.read.parquet(path))
    return given


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_columns_stay(tables):
    for frame in tables[:-1]:
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in tables[0].schema]


def test_language_id(spark, tables):
    found = langid.identify(tables[0], queries.language_model(tables[0])).collect()
    kept = {r.id for r in found if r.lang_pred != "und" and r.score >= 0.5}
    assert rows(tables[1]) == {i: r for i, r in rows(tables[0]).items() if i in kept}
    assert len(kept) > 150


def test_line_dedup(tables):
    before, after = rows(tables[1]), rows(tables[2])
    expected = {i: digest for i, _, _, digest in brute.line_dedup([(i, r.text) for i, r in before.items()])}
    assert {i: brute.sha(r.text) for i, r in after.items()} == expected
    assert all(r.n_chars == len(r.text) and r.lang == before[i].lang for i, r in after.items())


def test_near_dedup(tables):
    before, after = rows(tables[2]), rows(tables[3])
    groups = brute.simhash([(i, r.text) for i, r in sorted(before.items())])
    assert after == {i: before[i] for i, _, first in groups if first == i} and len(after) < len(before)


def test_decontamination(spark, sf_dir, tables):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    before, after = rows(tables[3]), rows(tables[4])
    bad = {r[0] for r in brute.decontamination([(i, r.text) for i, r in before.items()], items) if r[-1]}
    assert after == {i: r for i, r in before.items() if i not in bad} and bad


def test_bpe(tables):
    expected = sorted(brute.bpe([(i, r.text) for i, r in rows(tables[4]).items()], tokenizer_file("byte_bpe_50k.json")))
    assert sorted(tuple(r) for r in tables[5].drop("ids").collect()) == expected
    assert tables[5].filter(F.size("ids") != F.col("n_tokens")).count() == 0


def test_run(spark, sf_dir, tables):
    found = corpus_pipeline.run(spark, sf_dir)
    assert sorted(found.drop("ids").collect()) == sorted(tables[5].drop("ids").collect())


def test_stages_take_odd_rows(spark, sf_dir):
    schema = queries.documents(spark, sf_dir).withColumn("row", F.lit(1)).withColumn("id", F.lit("x")).schema
    odd = spark.createDataFrame([(None, None, None, None, None, 1, "x"), (1, "", "en", "s", 0, 1, "y"), (1, "", "en", "s", 0, 1, "y"), (2, "a b", None, None, None, 2, "z")], schema)
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, sf_dir).columns == schema.names
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, sf_dir).count() <= docs.count()
