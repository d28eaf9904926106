"""Source divergence audit: how differently the sources of a language use its terms, from one-hot level products.

Terms are counted by (language, source) in the scan and once more in a shuffle; a language keeps the terms that enough of
its documents hold. For a block of terms, a row for each, the indicator columns are (source, count level): a one where the
source has the term so many times, level 0 included. The columns' matrix times its transpose is then the joint table of
levels for every pair of sources at once; it is computed in float32 tiles, exact since a block has fewer than 2**24 terms.
Each cell, so many terms with level a here and level b there, is priced by the distance of the two smoothed
probabilities, as integers, and the prices of a pair of sources add up over blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.text import Blob, per_chunk, rows_of
from meterlake.sources.scratch import materialize

MIN_DOCS = 30
TOP_TERMS = 50
#: Probabilities are integers, parts of this.
UNIT = 1_000_000_000
#: Terms in a block on average, and columns of a matrix from which the block's terms are divided.
BLOCK, COLUMNS = 1024, 1024
_CHUNK = 2 << 20

#: True for bytes of the terms [^\x00-\x40\x5B-\x60\x7B-\x7F]+.
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term (binary) and documents that hold it; every row is a document.

    Documents of a chunk are counted together, so a term of a group is one row for each chunk before the shuffle.
    """
    group = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"))]
    rows = rows_of(docs.select(F.lit(0).alias("at"), F.col(text_col).alias("words"), *group), "at", "words", F.col("lang"), F.col("source"))

    def count(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        pairs = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["lang", "source"]).to_pylist()
        names: dict[tuple, int] = {}
        group = np.array([names.setdefault((p["lang"], p["source"]), len(names)) for p in pairs], np.int64)
        blob = Blob(texts)
        words = blob.words(TERM_BYTES)
        hashes = words.hashes(lower=True)
        # occurrences in each document, then in each group
        order = np.lexsort((words.doc, hashes))
        h, doc = hashes[order], words.doc[order]
        new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])) if len(h) else np.zeros(0, np.int64)
        h, at, n = h[new], order[new], np.diff(np.append(new, len(order)))
        owner = group[words.doc[at]]
        order = np.lexsort((owner, h))
        h, owner, at, n = h[order], owner[order], at[order], n[order]
        new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])) if len(h) else new
        held = np.diff(np.append(new, len(h)))
        n = np.add.reduceat(n, new) if len(new) else n
        terms = [blob.bytes[a:b].lower() for a, b in zip(words.starts[at[new]].tolist(), words.ends[at[new]].tolist())]
        listed = list(names) or [("", "")]
        owner = pa.array(owner[new])
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in listed], pa.string()).take(owner), pa.array([p[1] for p in listed], pa.string()).take(owner),
             pa.array(terms, pa.binary()), pa.array(n, pa.int64()), pa.array(held, pa.int64())],
            names=["lang", "source", "term", "n", "docs"],
        )

    counted = rows.mapInArrow(per_chunk(count, _CHUNK), "lang string, source string, term binary, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 5) / (total + 5 * terms)), exact; 1 where there is no term."""
    wide = lambda c: c.cast("decimal(19,0)")
    share = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * (wide(n) + 5), F.nullif(wide(total) + 5 * wide(terms), F.lit(0).cast("decimal(19,0)")))
    return F.lit(1).cast("long") + F.coalesce(share.cast("long"), F.lit(0))


# the products


def _parts(total: np.ndarray, columns_of, limit: int) -> Iterator[np.ndarray]:
    """Terms in the order of their totals, divided until the columns of a part are few; one term is never divided."""
    open_parts = [np.argsort(total, kind="stable")]
    while open_parts:
        part = open_parts.pop()
        if len(part) > 1 and columns_of(part) > limit:
            open_parts += [part[: len(part) // 2], part[len(part) // 2 :]]
        else:
            yield part


def joint_tables(columns: np.ndarray, width: int, tile: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, column, table): tiles, on and above the diagonal, of the indicator matrix transposed times itself.

    ``columns`` are the numbers of the columns that hold a one, of each term (row) one for every source.
    """
    one_hot = np.zeros((len(columns), width), np.float32)
    np.put_along_axis(one_hot, columns, 1, axis=1)
    for i in range(0, width, tile):
        for j in range(i, width, tile):
            yield i, j, (one_hot[:, i : i + tile].T @ one_hot[:, j : j + tile]).astype(np.int64)


def distances(counts: np.ndarray, prices: np.ndarray, limit: int = COLUMNS) -> np.ndarray:
    """sources x sources: for each pair the sum over terms of the distance of their prices.

    ``counts`` (terms x sources) are the levels and ``prices`` their prices, the same wherever source and level are.
    """
    n_terms, n_sources = counts.shape
    found = np.zeros((n_sources, n_sources), np.int64)

    def columns(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each cell its column, and of each column its source and its price."""
        cell, owner, price, upto = np.empty((len(part), n_sources), np.int64), [], [], 0
        for s in range(n_sources):
            levels, at, of = np.unique(counts[part, s], return_index=True, return_inverse=True)
            cell[:, s] = of.ravel() + upto
            upto += len(levels)
            owner.append(np.full(len(levels), s))
            price.append(prices[part[at], s])
        return cell, np.concatenate(owner), np.concatenate(price)

    def width(part: np.ndarray) -> int:
        ordered = np.sort(counts[part], axis=0)
        return int((ordered[1:] != ordered[:-1]).sum()) + n_sources

    for part in _parts(counts.sum(axis=1), width, max(limit, n_sources)) if n_terms and n_sources else ():
        cell, owner, price = columns(part)
        for i, j, table in joint_tables(cell, len(owner), limit):
            rows, cols = slice(i, i + table.shape[0]), slice(j, j + table.shape[1])
            priced = table * np.abs(price[rows, None] - price[None, cols])
            a, b = owner[rows], owner[cols]
            first_a = np.flatnonzero(np.diff(a, prepend=-1))
            first_b = np.flatnonzero(np.diff(b, prepend=-1))
            sums = np.add.reduceat(np.add.reduceat(priced, first_a, axis=0), first_b, axis=1)
            found[np.ix_(a[first_a], b[first_b])] += sums
            if i != j:
                found[np.ix_(b[first_b], a[first_a])] += sums.T
    return found


def _block_distances(group: pa.Table, limit: int) -> pa.Table:
    """Of a block of terms: the priced joint tables of all pairs of sources, (lang, one, other, value), one < other."""
    source = group["source"].to_pandas()
    names = sorted(set(source))
    number = {name: k for k, name in enumerate(names)}
    at = source.map(number).to_numpy()
    n, p = group["n"].to_numpy(), group["p"].to_numpy()
    unused = group["term"].is_null().to_numpy()
    zero = np.zeros(len(names), np.int64)
    zero[at[unused]] = p[unused]
    codes = group["term"].filter(pa.array(~unused)).combine_chunks().dictionary_encode()
    n_terms = len(codes.dictionary)
    row, col = codes.indices.to_numpy(), at[~unused]
    counts = np.zeros((n_terms, len(names)), np.int64)
    prices = np.tile(zero, (n_terms, 1))
    counts[row, col], prices[row, col] = n[~unused], p[~unused]
    found = distances(counts, prices, limit)
    one, other = np.triu_indices(len(names), 1)
    label = pa.array(names, pa.string())
    lang = pa.array([group["lang"][0].as_py()], pa.string()).take(pa.array(np.zeros(len(one), np.int64)))
    return pa.table({"lang": lang, "one": label.take(pa.array(one)), "other": label.take(pa.array(other)), "value": found[one, other]})


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", *,
    min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block: int = BLOCK, columns: int = COLUMNS,
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) that occurs.

    Terms are runs of ASCII letters and non-ASCII characters, A-Z lower-cased; a language keeps those that at least
    ``min_docs`` of its documents hold. With ``n`` occurrences of a term, ``N`` of all V kept terms, its probability is
    1 + floor(10**9 * (n + 5) / (N + 5 V)). Part ``pair``: the other sources of the language, by the sum over the kept terms of
    the distance of the two probabilities (0 without terms). Part ``term``: the ``top_terms`` kept terms that the source uses
    with a higher probability than the whole language, by the difference. Ties are ranked by the item's UTF-8 bytes.

    Null text, language and source are empty strings. Every row is a document, also a repeated one. A language of one source
    has no pairs; an empty table gives no rows. A pair of sources costs one row for each block of terms.
    """
    counted = term_counts(docs, text_col, lang_col, source_col)
    whole = Window.partitionBy("lang", "term")
    kept = counted.withColumns({"held": F.sum("docs").over(whole), "total": F.sum("n").over(whole)}).filter(F.col("held") >= min_docs)
    kept = materialize(kept.select("lang", "source", "term", "n", "total"), "terms")
    group = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"))]
    groups = docs.select(*group).distinct()
    used = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    # a language's count of a term stands in each of its rows, so it is taken once for each term
    vocabulary = kept.groupBy("lang", "term").agg(F.first("total").alias("total"))
    languages = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_n"))
    sizes = groups.join(used, ["lang", "source"], "left").join(languages, "lang", "left")
    sizes = materialize(sizes.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("group_n", "terms", "lang_n")]), "groups")

    blocks = F.greatest(F.ceil(F.col("terms") / block), F.lit(1)).cast("long")
    used_rows = kept.join(sizes, ["lang", "source"])
    p = probability(F.col("n"), F.col("group_n"), F.col("terms"))
    cells = used_rows.select("lang", F.pmod(F.xxhash64("term"), blocks).alias("block"), "source", "term", "n", p.alias("p"))
    # every source stands in every block, with its price of a term it lacks
    unused = sizes.select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("block"), "source", F.lit(None).cast("binary").alias("term"),
        F.lit(0).cast("long").alias("n"), probability(F.lit(0), F.col("group_n"), F.col("terms")).alias("p"),
    )
    priced = cells.unionByName(unused).groupBy("lang", "block").applyInArrow(
        lambda table: _block_distances(table, columns), "lang string, one string, other string, value long"
    )
    summed = priced.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))
    both = F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("one").alias("item")))
    pairs = summed.select("lang", F.inline(both), "value")

    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    q = probability(F.col("total"), F.col("lang_n"), F.col("terms"))
    terms = used_rows.select("lang", "source", F.col("term").cast("string").alias("item"), (p - q).alias("value")).filter("value > 0")
    terms = terms.withColumn("rank", ranked).filter(F.col("rank") <= top_terms)
    columns_out = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select("*", F.lit("pair").alias("part"), ranked.alias("rank")).select(*columns_out).unionByName(
        terms.withColumn("part", F.lit("term")).select(*columns_out)
    )
