"""Language ID: script ranges narrow the candidates, Viterbi over per-word scores labels spans.

A word's score in a language is the log probability of its byte trigrams under counts taken from all
training texts. A language is a candidate for a word if it uses the word's script. The Viterbi path over
the words of a text pays a penalty for each switch, so mixed texts fall into few spans.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.text import Blob, other_columns, per_chunk, rows_of, with_row

UNDETERMINED = "und"
#: Trigrams hash into so many buckets; the model is so many floats for each language.
BUCKETS = 1 << 16
SMOOTHING = 0.1
SWITCH_PENALTY = 12.0
#: A language uses a script if this share of its words is written in it.
MIN_SCRIPT_SHARE = 0.01
CHUNK = 2 << 20

LATIN, GREEK, CYRILLIC, HEBREW, ARABIC, INDIC, THAI, KANA, HAN, HANGUL, OTHER = range(1, 12)
SCRIPTS = 12

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_ASCII_LETTERS = _LETTERS.copy()
_ASCII_LETTERS[0x80:] = False
#: The script that the first byte of a UTF-8 character shows; E0 and E3 need the second byte.
_LEAD = np.zeros(256, np.uint8)
_LEAD[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)]] = LATIN
_LEAD[[0xCE, 0xCF]] = GREEK
_LEAD[0xD0:0xD4] = CYRILLIC
_LEAD[0xD7] = HEBREW
_LEAD[0xD8:0xDC] = ARABIC
_LEAD[[0xCA, 0xCB, 0xCC, 0xCD, 0xD4, 0xD5, 0xD6, 0xDC, 0xDD, 0xDE, 0xDF, 0xE1, 0xE2, *range(0xEE, 0xF5)]] = OTHER
_LEAD[0xE4:0xEA] = HAN
_LEAD[0xEA:0xEE] = HANGUL
_E0 = np.full(256, OTHER, np.uint8)
_E0[0xA4:0xB8] = INDIC
_E0[0xB8:0xBC] = THAI
_E3 = np.full(256, HAN, np.uint8)
_E3[0x81:0x84] = KANA


@dataclass
class Model:
    languages: list[str]
    #: languages x buckets: log probability of a trigram.
    trigrams: np.ndarray
    #: scripts x languages: whether the language is a candidate.
    candidates: np.ndarray


class _Features:
    """Words of texts with the trigram bucket of each byte and the script of each word."""

    def __init__(self, texts: list[bytes]):
        blob = Blob([t.decode("utf-8", "replace").lower().encode() for t in texts])
        self.words = blob.words(_LETTERS)
        data, mask = blob.data, self.words.mask
        letters = np.where(mask, data, 0x20).astype(np.uint32)
        before, after = np.empty_like(letters), np.empty_like(letters)
        before[1:], before[:1], after[:-1], after[-1:] = letters[:-1], 0x20, letters[1:], 0x20
        gram = (before << np.uint32(16)) | (letters << np.uint32(8)) | after
        self.buckets = ((gram * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int32)
        script = _LEAD[data]
        for lead, table in ((0xE0, _E0), (0xE3, _E3)):
            at = np.flatnonzero(data[:-1] == lead)
            script[at] = table[data[at + 1]]
        self.scripts = np.maximum.reduceat(script, self.words.starts) if len(self.words.starts) else np.zeros(0, np.uint8)
        self.mask = mask

    def sums(self, values: np.ndarray) -> np.ndarray:
        values[~self.mask] = 0
        return np.add.reduceat(values, self.words.starts) if len(self.words.starts) else np.zeros(0, np.float32)


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """A model from all given rows with a language and a text. Counts are summed in Spark; the driver gets at
    most ``BUCKETS`` numbers for each language. Without such rows the model has no languages."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, texts in _by_language(batch):
                features = _Features(texts)
                total = sums.setdefault(part, np.zeros(BUCKETS + SCRIPTS, np.int64))
                total[:BUCKETS] += np.bincount(features.buckets[features.mask], minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(features.scripts, minlength=SCRIPTS)
        for language, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at], pa.int64())],
                names=["language", "place", "n"],
            )

    rows = docs.select(F.col(lang_col).cast("string").alias("language"), F.col(text_col).cast("binary").alias("text"))
    counted = rows.filter("language is not null and text is not null").mapInArrow(count, "language string, place int, n long")
    table = counted.groupBy("language", "place").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["language"].unique())
    counts = np.zeros((len(languages), BUCKETS + SCRIPTS))
    counts[np.searchsorted(languages, table["language"]) if languages else [], table["place"].to_numpy(int)] = table["n"]
    grams, scripts = counts[:, :BUCKETS], counts[:, BUCKETS:]
    logs = np.log((grams + SMOOTHING) / (grams.sum(1, keepdims=True) + SMOOTHING * BUCKETS))
    candidates = (scripts >= MIN_SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)).T & (scripts.T > 0)
    candidates[~candidates.any(1)] = True
    return Model(languages, logs.astype(np.float32), candidates)


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for language, text in zip(batch.column("language").to_pylist(), batch.column("text").to_pylist()):
        held.setdefault(language, []).append(text)
        sizes[language] = sizes.get(language, 0) + len(text)
        if sizes[language] > CHUNK:
            yield language, held.pop(language)
            sizes[language] = 0
    yield from held.items()


def viterbi(scores: np.ndarray, first: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word; all texts advance together, the longest in front."""
    n, languages = scores.shape
    labels = np.zeros(n, np.int16)
    order = np.argsort(-counts, kind="stable")
    first, counts = first[order], counts[order]
    longest = int(counts[0]) if len(counts) else 0
    if not n or languages < 2:
        return labels
    active = np.searchsorted(-counts, -np.arange(longest), side="left")
    best = scores[first[: active[0]]].astype(np.float64)
    back = np.zeros(n, np.int16)  # of each word: the best language of the word before
    stay = np.zeros((n, languages), bool)
    for t in range(1, longest):
        at = first[: active[t]] + t
        best = best[: active[t]]
        top = best.argmax(1)
        moved = best[np.arange(len(at)), top] - penalty
        back[at] = top
        stay[at] = best >= moved[:, None]
        best = np.maximum(best, moved[:, None]) + scores[at]
        ended = slice(active[t + 1] if t + 1 < longest else 0, active[t])
        labels[at[ended]] = best[ended].argmax(1)
    single = counts == 1
    labels[first[single]] = scores[first[single]].argmax(1)
    for t in range(longest - 1, 0, -1):
        at = first[: active[t]] + t
        now = labels[at]
        labels[at - 1] = np.where(stay[at, now], now, back[at])
    return labels


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *, switch_penalty: float = SWITCH_PENALTY, carry: bool = False,
) -> DataFrame:
    """(id, lang_pred, score, spans): the language with most letters in the labelled spans, ties by name.

    ``score`` is its share of the letter bytes; ``spans`` are (start, end, lang) of the lower-cased text in bytes.
    ``und`` with score 0 and no spans: null or empty texts, texts without a letter, or a model without languages.
    Rows come one for one. With ``carry`` the text and, as ``row``, the other columns follow.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kinds = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])

    def predict(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        known = held.value
        features = _Features(texts)
        words = features.words
        names, scores, spans = [UNDETERMINED] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
        if known.languages and len(words.starts):
            emission = np.stack([features.sums(row[features.buckets]) for row in known.trigrams], 1)
            emission[~known.candidates[features.scripts]] -= 1e4
            labels = viterbi(emission, words.first, words.counts, switch_penalty)
            weights = np.bincount(words.doc * len(known.languages) + labels, words.ends - words.starts, len(texts) * len(known.languages))
            weights = weights.reshape(len(texts), -1)
            new = np.ones(len(labels), bool)
            new[1:] = (labels[1:] != labels[:-1]) | (words.doc[1:] != words.doc[:-1])
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(labels)) - 1
            shift = words.blob.starts
            for a, b in zip(begin.tolist(), end.tolist()):
                doc = words.doc[a]
                spans[doc].append({"start": int(words.starts[a] - shift[doc]), "end": int(words.ends[b] - shift[doc]), "lang": known.languages[labels[a]]})
            for i, text in enumerate(texts):
                if words.counts[i] and _has_letter(text):
                    k = int(weights[i].argmax())
                    names[i], scores[i] = known.languages[k], weights[i, k] / weights[i].sum()
                else:
                    spans[i] = []
        columns = {
            "id": batch.column("id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64()),
            "spans": pa.array(spans, pa.list_(kinds)),
        } | ({"text": batch.column("text"), "row": batch.column("row")} if carry else {})
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    rows = rows_of(docs, id_col, text_col, *other_columns(docs, text_col, carry))
    result = "id long, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>"
    return rows.mapInArrow(per_chunk(predict, CHUNK), with_row(result + (", text binary" if carry else ""), rows))


def _has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTERS[np.frombuffer(text, np.uint8)].any()) or any(map(str.isalpha, text.decode("utf-8", "replace")))
