from __future__ import annotations

import os
import sys

import pytest

sys.path.append(os.path.dirname(os.path.abspath(__file__)))

from texts import prose  # noqa: E402


@pytest.fixture(scope="session")
def hard_docs(spark):
    """(doc_id, text) with nulls, empty and long texts, ties, shared passages, odd characters, and columns of clashing names."""
    shared, other = prose(1, 70), prose(2, 120)
    texts = [
        None, "", " \t\n ", "one", "ONE", "a b c", "\n\n", "日本語 テスト 😀", "<|endoftext|> x <|endoftext|>", "x" * 350, "ab" * 200,
        shared, shared, f"{prose(3, 40)} {shared} {prose(4, 40)}", f"{prose(5, 11)}\n{other}\n{prose(6, 30)}", other,
        f"{other} {other}", f"{prose(7, 5)} {shared} {shared} {other}", prose(8, 9000), prose(8, 9000) + " end", prose(9, 300),
        prose(9, 300).replace("alpha", "omega", 1), " ".join(["same"] * 400), "tab\tand  double  spaces\r\nnext\x0bline\x0cend",
        "MiXed CASE line\nfoo\nMIXED case LINE \n foo", "é" * 120 + " " + "é" * 120, "# * $ % & | < > ## text", "it's we'll they'd I'm 123 456",
    ]
    texts += [f"{prose(20 + k, 15)}\n  Boilerplate line, the Same {'everywhere' if k % 2 else 'EVERYWHERE'}\n{prose(50 + k, 12)}" for k in range(14)]
    rows = [(k, t, "en", k, "clash", 1.0) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id long, key string, n_words double").repartition(4)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Repeated rows, a repeated id with another text, and null ids."""
    same = prose(1, 80)
    rows = [(5, same), (5, same), (5, "other"), (None, same), (None, None), (7, same)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
