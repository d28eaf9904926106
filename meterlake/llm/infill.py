"""Fill-in-the-middle by rotation: a text is cut at two units, and its parts change places in one byte array.

A unit is a word with the ASCII white space before it; white space at the end of a text is a unit of its own. The scan
for unit ends runs over all texts of a chunk at once. Each text then becomes a byte array with a sentinel before each
part, ``<P>prefix<M>middle<S>suffix``, and one rotation (two segments reversed, then both together) brings it into its
form: ``<P>prefix<S>suffix<M>middle`` (psm) exchanges the last two parts, ``<S>suffix<P>prefix<M>middle`` (spm) the
suffix with all before it. A text that holds a sentinel stays plain, so the sentinels of an output are found again,
and the inverse rotation restores the text byte by byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterlake.llm.text import WORD_BYTES, Blob, other_columns, per_chunk, rows_of, with_row

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_WIDTH = 3
PLAIN, PSM, SPM = "plain", "psm", "spm"
SEED = 42
#: Percent of texts that are cut, and of the cut texts that take the form spm.
CUT_SHARE, SPM_SHARE = 50, 80
_CHUNK = 1 << 20


def unit_ends(texts: list[bytes]) -> list[np.ndarray]:
    """Where the units of each text end, as byte places of the text."""
    blob = Blob(texts)
    words = blob.words(WORD_BYTES)
    found = []
    for start, length, first, count in zip(blob.starts.tolist(), blob.lengths.tolist(), words.first.tolist(), words.counts.tolist()):
        ends = words.ends[first : first + count] - start
        if length and (not count or ends[-1] < length):
            ends = np.append(ends, length)
        found.append(ends)
    return found


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits that depend on the seed and the id alone; a null id is spelled as nothing."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[k : k + 4]) for k in range(0, 16, 4)]


def _reverse(view: np.ndarray, low: int, high: int) -> None:
    half = (high - low) // 2
    front = view[low : low + half].copy()
    view[low : low + half] = view[high - half : high][::-1]
    view[high - half : high] = front[::-1]


def rotate(data: bytearray, low: int, between: int, high: int) -> None:
    """Exchange the segments [low, between) and [between, high) in place, by three reversals."""
    view = np.frombuffer(data, np.uint8)
    _reverse(view, low, between)
    _reverse(view, between, high)
    _reverse(view, low, high)


def holds_sentinel(text: bytes) -> bool:
    return PREFIX in text or SUFFIX in text or MIDDLE in text


def arrange(text: bytes, low: int, high: int, form: str) -> bytes:
    """The text in psm or spm form, its middle being the bytes [low, high)."""
    data = bytearray(text)
    data[high:high] = SUFFIX
    data[low:low] = MIDDLE
    data[0:0] = PREFIX
    middle, suffix = low + _WIDTH, high + 2 * _WIDTH
    rotate(data, middle if form == PSM else 0, suffix, len(data))
    return bytes(data)


def rearrange(output: bytes, form: str) -> bytes:
    """The text an output was made from, found from the output and its form alone."""
    if form == PLAIN:
        return output
    data = bytearray(output)
    if form == PSM:
        middle, between = data.index(SUFFIX), data.index(MIDDLE)
        rotate(data, middle, between, len(data))
    else:
        between = data.index(PREFIX)
        rotate(data, 0, between, len(data))
        middle = data.index(MIDDLE)
    suffix = data.index(SUFFIX, middle)
    for place in (suffix, middle, 0):
        del data[place : place + _WIDTH]
    return bytes(data)


def _code_points(data: bytes) -> int:
    return len(data) if data.isascii() else int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
    seed: int = SEED, cut_share: int = CUT_SHARE, spm_share: int = SPM_SHARE, carry: bool = False,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): each text, cut into prefix, middle and suffix, in its form.

    ``n`` counts the units. The prefix ends after the smaller of two draws modulo n + 1, the middle after the larger, so
    parts may be empty; ``cut_share`` percent of the texts are cut by the third draw, and by the fourth ``spm_share`` percent
    of these are spm, the others psm. Empty and null texts and texts that hold a sentinel are plain: the output is the text
    and the lengths (in code points) are null. Draws depend on the id: rows of one id share them, null ids are spelled
    as nothing. Rows come one for one. With ``carry`` the other columns follow as ``row``.
    """
    rows = rows_of(docs, id_col, text_col, *other_columns(docs, text_col, carry))

    def cut(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        n, forms, prefixes, middles, outputs = [], [], [], [], []
        for doc_id, text, ends in zip(batch.column("id").to_pylist(), texts, unit_ends(texts)):
            one, two, three, four = draws(seed, doc_id)
            units = len(ends)
            n.append(units)
            if not units or three % 100 >= cut_share or holds_sentinel(text):
                forms.append(PLAIN)
                prefixes.append(None)
                middles.append(None)
                outputs.append(text)
                continue
            low, high = (int(ends[k - 1]) if k else 0 for k in sorted((one % (units + 1), two % (units + 1))))
            forms.append(SPM if four % 100 < spm_share else PSM)
            prefixes.append(_code_points(text[:low]))
            middles.append(_code_points(text[low:high]))
            outputs.append(arrange(text, low, high, forms[-1]))
        columns = {
            "id": batch.column("id"), "n": pa.array(n, pa.int64()), "form": pa.array(forms, pa.string()), "prefix_chars": pa.array(prefixes, pa.int64()),
            "middle_chars": pa.array(middles, pa.int64()), "output": pa.array(outputs, pa.binary()),
        } | ({"row": batch.column("row")} if carry else {})
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return rows.mapInArrow(per_chunk(cut, _CHUNK), with_row("id long, n long, form string, prefix_chars long, middle_chars long, output binary", rows))


def restore(examples: DataFrame) -> DataFrame:
    """The examples with ``text`` (binary), rebuilt from ``output`` and ``form``."""
    schema = type(examples.schema)(list(examples.schema.fields)).add("text", "binary")

    def undo(batch: pa.RecordBatch, outputs: list[bytes]) -> pa.RecordBatch:
        texts = [rearrange(output, form) for output, form in zip(outputs, batch.column("form").to_pylist())]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "text"])

    return examples.mapInArrow(per_chunk(undo, _CHUNK, "output"), schema)
