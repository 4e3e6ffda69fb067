"""Operator 12, ranked lexical search: item rows times document impacts as dense float64 tiles, exact in integers.

Terms are words of letters, digits and characters beyond ASCII, A-Z lower-cased. N counts the documents with a term, L
their terms, n a document's terms, df the documents holding a term, tf its occurrences in the document:

    w = floor(1000 ln((2N + 2) / (2df + 1)))   m = 10 + (90 n N) div L   score = sum of w ((10^9 tf) div (1000 tf + 8 m))

over the item's distinct terms. The items are packed into blocks of at most ``BLOCK_CELLS`` (items x distinct terms) and ``BLOCK_TERMS``
terms (a single larger item is a block of its own); the vocabulary of a block is numbered compactly. Per block, one
pass over the texts keeps each document's n and the counts of the block's terms as a small table; N, L and df are Spark aggregates
of it. A second pass lays out tiles of ``TILE_TERMS`` terms by ``TILE_DOCS`` documents, whose cells are ``w * impact``, and multiplies
the items' 0/1 rows with them by BLAS. A cell is below 2^36, so a tile's sums stay below 2^53 (``TILE_TERMS`` is checked)
and are exact in float64; tiles are added up as 64-bit integers.

Top k: per task and item the k best by score, then smallest doc_id, are kept across tiles; every document that
equals the k-th score is compared by its id, so ties are safe. Tasks hand on k rows an item, which are ranked per group of
documents and then per item.

Defined results: null or empty text has no terms. Rows that repeat a doc_id are documents each; rows that repeat an item_id are
one item with the terms of all; a null item_id is an item. A null doc_id ranks after all others on equal scores.
Empty tables, and items without terms or hits, give no rows. Other columns, of whatever name, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import as_bytes, ascii_words, map_texts, prepare, stored

TOP_K = 10
#: Bounds of a block of items: cells of its 0/1 rows (float64), and distinct terms.
BLOCK_CELLS = 1 << 22
BLOCK_TERMS = 1 << 17
#: Sides of a tile of impacts: 8 MB of float64.
TILE_TERMS = 1024
TILE_DOCS = 1024
#: Bytes of one text that are split into words at a time.
PIECE_BYTES = 4 << 20
#: Groups of documents in the first ranking of the tasks' rows.
SALT = 32
#: Upper bounds of w (N < 2^62) and of an impact, as powers of two.
_WEIGHT_BITS, _IMPACT_BITS = 16, 20


def pieces(data: bytes, limit: int = PIECE_BYTES):
    """The text in parts of about ``limit`` bytes, cut at white space or another character that is in no word."""
    lo = 0
    while len(data) - lo > limit:
        at = lo + limit
        while at < len(data) and (data[at] >= 0x80 or chr(data[at]).isalnum()):
            at += 1
        yield data[lo:at]
        lo = at
    yield data[lo:] if lo else data


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, terms)`` of the items that have a term, sorted by id."""
    def of(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([sorted({w.decode() for w in ascii_words(x)}) for x in as_bytes(texts)], pa.list_(pa.string()))]

    each = map_texts(items, of, [("terms", T.ArrayType(T.StringType()))], {"item_id": F.col("item_id")})
    return (each.select("item_id", F.explode("terms").alias("term")).groupBy("item_id")
            .agg(F.sort_array(F.collect_set("term")).alias("terms")).orderBy("item_id"))


def blocks(terms: DataFrame, cells: int = BLOCK_CELLS, most: int = BLOCK_TERMS):
    """Blocks ``(item ids, vocabulary, rows of term numbers)``; one block and one partition are on the driver at a time."""
    ids, vocabulary, rows = [], {}, []
    for r in terms.toLocalIterator():
        fresh = sum(t not in vocabulary for t in r["terms"])
        if ids and ((len(ids) + 1) * (len(vocabulary) + fresh) > cells or len(vocabulary) + fresh > most):
            yield ids, vocabulary, rows
            ids, vocabulary, rows = [], {}, []
        ids.append(r["item_id"])
        rows.append([vocabulary.setdefault(t, len(vocabulary)) for t in r["terms"]])
    if ids:
        yield ids, vocabulary, rows


def term_counts(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """``(doc_id, n, terms, tfs)``: all terms of a document, and the numbers and counts of those in the vocabulary."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast({t.encode(): k for t, k in vocabulary.items()})
    size = len(vocabulary)

    def of(texts: pa.Array) -> list[pa.Array]:
        get = shared.value.get
        n, ends, terms, tfs = [], [0], [], []
        for data in as_bytes(texts):
            count, seen = 0, np.zeros(0, np.int64)
            totals = np.zeros(0, np.int64)
            for part in pieces(data):
                words = ascii_words(part)
                count += len(words)
                at = np.fromiter((k for k in map(get, words) if k is not None), np.int64)
                if len(seen) or len(data) > PIECE_BYTES:
                    seen, totals = _add(seen, totals, at)
                else:
                    seen, totals = np.unique(at, return_counts=True)
            n.append(count)
            terms.append(seen.astype(np.int32))
            tfs.append(totals)
            ends.append(ends[-1] + len(seen))
        offsets = pa.array(ends, pa.int32())
        flat = np.concatenate(terms) if terms else np.zeros(0, np.int32)
        return [pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(tfs) if tfs else np.zeros(0, np.int64), pa.int64()))]

    def _add(seen, totals, at):
        dense = np.zeros(size, np.int64)
        dense[seen] = totals
        dense += np.bincount(at, minlength=size)
        seen = np.flatnonzero(dense)
        return seen, dense[seen]

    return map_texts(docs, of, [("n", T.LongType()), ("terms", T.ArrayType(T.IntegerType())), ("tfs", T.ArrayType(T.LongType()))],
                     {"doc_id": F.col("doc_id").cast("long")})


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The integer impact of each (document, term): tf and the document's n, elementwise."""
    if len(n) and 90 * int(n.max()) * n_docs >= 1 << 63:
        m = np.array([10 + 90 * int(x) * n_docs // n_terms for x in n], np.int64)
    else:
        m = 10 + 90 * n * n_docs // max(n_terms, 1)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Best:
    """The k best documents of each item so far, by score, then by id (null ids last)."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in range(items)]
        self.least = np.ones(items, np.int64)  # the score that a document must reach

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """scores: items x documents."""
        for i in np.flatnonzero((scores >= self.least[:, None]).any(axis=1)):
            new = np.flatnonzero(scores[i] >= self.least[i])
            s, x, d = self.rows[i]
            s, x, d = np.concatenate([s, scores[i, new]]), np.concatenate([x, null[new]]), np.concatenate([d, ids[new]])
            best = np.lexsort((d, x, -s))[:self.k]
            self.rows[i] = s[best], x[best], d[best]
            if len(best) == self.k:
                self.least[i] = s[best[-1]]


def multiply(rows: np.ndarray, term: np.ndarray, doc: np.ndarray, cell: np.ndarray, n_docs: int, tile: int = TILE_TERMS) -> np.ndarray:
    """Exact scores (items x documents): 0/1 ``rows`` times the matrix with ``cell`` at (term, doc), tile by tile."""
    if tile.bit_length() + _WEIGHT_BITS + _IMPACT_BITS > 53:
        raise ValueError("a tile of so many terms could exceed 2^53")
    total = np.zeros((len(rows), n_docs), np.int64)
    order = np.argsort(term, kind="stable")
    term, doc, cell = term[order], doc[order], cell[order]
    for lo in range(0, rows.shape[1], tile):
        hi = min(lo + tile, rows.shape[1])
        a, b = np.searchsorted(term, [lo, hi])
        if a == b:
            continue
        dense = np.zeros((hi - lo, n_docs))
        dense[term[a:b] - lo, doc[a:b]] = cell[a:b]
        total += (rows[:, lo:hi] @ dense).astype(np.int64)
    return total


def _ranked(counts: DataFrame, rows: list[list[int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``(item, doc_id, score)``: each task's k best documents per item of the block."""
    shared = counts.sparkSession.sparkContext.broadcast((rows, weights))

    def run(batches):
        rows, weights = shared.value
        items = np.zeros((len(rows), len(weights)))
        for i, r in enumerate(rows):
            items[i, r] = 1.0
        best = Best(len(rows), k)
        for batch in batches:
            for lo in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(lo, TILE_DOCS)
                lists, tfs = part.column("terms"), part.column("tfs")
                term, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy()
                held = np.diff(lists.offsets.to_numpy())
                doc = np.repeat(np.arange(part.num_rows), held)
                n = np.repeat(part.column("n").to_numpy(), held)
                cell = weights[term] * impacts(tf, n, n_docs, n_terms)
                null = part.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                ids = part.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
                best.add(multiply(items, term, doc, cell, part.num_rows), ids, null)
        for i, (s, x, d) in enumerate(best.rows):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), i, np.int32)), pa.array(d, pa.int64(), mask=x), pa.array(s)],
                                                 names=["item", "doc_id", "score"])

    return counts.mapInArrow(run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP_K, cells: int = BLOCK_CELLS, most: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the k best documents of each item with a score above 0."""
    spark = docs.sparkSession
    prepare(spark)
    kind = items.schema["item_id"].dataType
    found, size = None, None
    for ids, vocabulary, rows in blocks(stored(item_terms(items), "lexical-items"), cells, most):
        counts = stored(term_counts(docs, vocabulary), "lexical-counts")
        if size is None:  # of all texts, whatever the block
            size = counts.filter("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        df = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        w = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * size["docs"] + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0))))
        table = df.select("term", w.cast("long").alias("w")).toArrow()  # a row per term of the block
        weights = np.zeros(len(vocabulary), np.int64)
        weights[table.column("term").to_numpy()] = table.column("w").to_numpy()
        names = spark.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", kind)]))
        part = _ranked(counts, rows, weights, size["docs"], size["terms"], k).join(F.broadcast(names), "item").select("item_id", "doc_id", "score")
        part = stored(part, "lexical-best")
        found = part if found is None else found.unionByName(part)
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    found = spark.createDataFrame([], schema) if found is None else found
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
