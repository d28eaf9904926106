"""A training-text pipeline over ``documents``: each stage applies one operator to all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import bpe, decontaminate, langid, lines, simhash
from meterlake.llm.queries import documents, language_model
from meterlake.llm.text import restored
from meterlake.llm.tokenizers import tokenizer_file
from meterlake.sources.scratch import materialize

#: A text is rejected if less of it than this is in its main language.
MIN_LANGUAGE_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of a recognised language; those without a letter, and those of which no language has half, go."""
    found = langid.identify(docs, language_model(docs), carry=True)
    kept = found.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SHARE))
    return restored(kept, docs, "text", F.col("text"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten documents or more hold; every document stays, with its new length."""
    found = restored(lines.dedup_lines(docs, min_chars=1, min_docs=10, carry=True), docs, "text", F.col("kept"))
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id."""
    return simhash.one_of_each_group(docs, shingle=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which fewer than one word in twenty stands in a benchmark window."""
    found = decontaminate.benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return decontaminate.without_contaminated(docs, found)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of each text that is left."""
    file = tokenizer_file("byte_bpe_50k.json")
    both = bpe.decode(bpe.encode(docs, file), file)
    return both.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: Not expressible in SQL: a fitted model, XXH64 fingerprints and BPE. The tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
