"""One text of over 2 MB, longer than any chunk, beside short ones that share parts of it, through every operator of documents."""

from __future__ import annotations

import brute
import pytest
from pyspark.sql import functions as F
from texts import pairs, prose

from meterlake.llm import bpe, decontaminate, langid, lines, lm, quality, queries, simhash, substrings, suffixes
from meterlake.llm.tokenizers import tokenizer_file

FILE = tokenizer_file("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def long_docs(spark):
    parts = [prose(1000 + k, 100) for k in range(3100)]
    line = "A line that eleven documents hold"
    whole = "\n".join([*parts[:1500], line, parts[3], *parts[1500:], parts[2999]])
    assert len(whole.encode()) > 2 << 20
    rows = [(50, whole, "xx"), (3, f"start {parts[2500]} end", "xx"), (90, f"{parts[10]}\n{parts[11]}", "yy"), (91, parts[3000], "yy"), (92, "", "xx"), (93, None, "xx")]
    rows += [(k, f"{prose(k, 25)}\n {line.upper()} \n", "yy") for k in range(60, 72)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).persist()


def rows(frame, *names):
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=repr)


def test_bpe(long_docs):
    both = bpe.decode(bpe.encode(long_docs, FILE), FILE)
    got = rows(both, "id", F.size("ids"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256), F.sha2("text", 256))
    assert got == sorted(brute.bpe(pairs(long_docs), FILE), key=repr)


def removed_bytes(docs, size=100):
    """As ``brute.byte_dedup``, with strings named by their hash, for want of memory."""
    first = {}
    ordered = sorted(((i, (t or "").encode()) for i, t in docs), key=lambda d: d[0])
    for i, data in ordered:
        for at in range(len(data) - size + 1):
            first.setdefault(hash(data[at : at + size]), (i, at))
    for i, data in ordered:
        gone, upto = 0, 0
        for at in range(len(data) - size + 1):
            if first[hash(data[at : at + size])] < (i, at):
                gone += at + size - max(upto, at)
                upto = at + size
        yield i, len(data), gone


def test_suffix_array_dedup(long_docs):
    got = rows(suffixes.dedup_bytes(long_docs), "id", "n_bytes", "n_removed")
    assert got == sorted(removed_bytes(pairs(long_docs)), key=repr) and sum(r[2] > 0 for r in got) >= 3


def test_substring_dedup(long_docs):
    got = rows(substrings.dedup_substrings(long_docs), "id", "n_words", "n_removed", F.sha2("kept", 256))
    assert got == sorted(brute.substring_dedup(pairs(long_docs)), key=repr) and sum(r[2] > 0 for r in got) == 3


def test_line_dedup(long_docs):
    got = rows(lines.dedup_lines(long_docs), "id", "n_lines", "n_dropped", F.sha2("kept", 256))
    assert got == sorted(brute.line_dedup(pairs(long_docs)), key=repr) and sum(r[2] > 0 for r in got) == 13


def test_quality(long_docs):
    names = ("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert rows(quality.repetition(long_docs), *names) == sorted(brute.quality(pairs(long_docs)), key=repr)


def test_decontamination(spark, long_docs):
    items = [(1, prose(1700, 100)), (2, prose(4099, 30)), (3, "eleven documents"), (4, "not there at all")]
    found = decontaminate.benchmark_hits(long_docs, spark.createDataFrame(items, "item_id int, text string"))
    got = rows(found, "id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256), decontaminate.contaminated())
    assert got == sorted(brute.decontamination(pairs(long_docs), items), key=repr) and sum(r[2] > 0 for r in got) == 13


def test_language_id(long_docs):
    docs = [tuple(r) for r in long_docs.select("doc_id", "text", "lang").collect()]
    got = {r.id: (r.lang_pred, round(r.score, 5)) for r in langid.identify(long_docs, queries.language_model(long_docs)).collect()}
    assert got == {i: (lang, round(score, 5)) for i, lang, score in brute.language_id(docs)}


def test_simhash(long_docs):
    got = rows(simhash.near_duplicates(long_docs), "id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    assert got == sorted(brute.simhash(pairs(long_docs)), key=repr)


def test_lm_scoring(long_docs):
    held_out = {60, 61, 92}
    found = lm.score(long_docs, F.col("doc_id").isin(held_out), FILE, rounds=2)
    got = {r.id: r for r in found.collect()}
    for i, n_tokens, n_known, total, base in brute.base_scores(pairs(long_docs), held_out):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n_tokens, n_known, total, i in held_out)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
