"""Document-term matrix and TF-IDF weights in long form.

w(d, t) = tf(d, t) * (ln((1 + n) / (1 + df(t))) + 1), then each document's weights are divided by
their L2 norm; a document without terms keeps no weights (an all-zero row). ``n`` counts documents
with at least one raw token.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.index import TextIndex, combined_rows, term_stats
from quarry.operators.store import BLOCK_BITS, Snapshot
from quarry.session import written


def doc_term_matrix(index: TextIndex) -> DataFrame:
    """``(doc_id, term, tf)``; documents with no surviving term appear once with a null term and
    tf 0. The text is read once: an index that is not stored yet is stored without its positions first, with its documents' marks."""
    stored = written(combined_rows(index).select("doc_id", "term", "tf"), "matrix")
    tf = stored.filter(F.col("term").isNotNull())
    empty = stored.filter(F.col("term").isNull()).join(tf.select("doc_id").distinct(), "doc_id", "left_anti").select(
        "doc_id", F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("tf"))
    return tf.unionByName(empty)


def idf_table(postings: DataFrame, n_docs: int) -> DataFrame:
    """``(term, idf)`` with the smoothed idf."""
    n1 = float(n_docs) + 1.0
    return term_stats(postings).select(
        "term", (F.log(F.lit(n1) / (F.col("df").cast("double") + F.lit(1.0))) + F.lit(1.0)).alias("idf"))


def tfidf(index: TextIndex, n_docs: int | None = None) -> DataFrame:
    """``(doc_id, term, w)`` L2-normalized TF-IDF weights.

    The idf table has one row per term; Spark broadcasts it if its size allows, otherwise joins by a
    shuffle (AQE splits hot terms). The row norm is a window per document,
    so one document's terms are one group (bounded by that document's vocabulary).
    """
    n = index.num_docs() if n_docs is None else n_docs
    idf = idf_table(index.postings, n)
    raw = index.postings.select("doc_id", "term", "tf").join(idf, "term").select(
        "doc_id", "term", (F.col("tf").cast("double") * F.col("idf")).alias("r"))
    norm = F.sqrt(F.sum(F.col("r") * F.col("r")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "term", (F.col("r") / norm).alias("w"))


def idf_of(index: Snapshot) -> DataFrame:
    """``(term_id, idf)`` of a stored index."""
    n1 = float(index.docs.count()) + 1.0
    return index.id_stats().select("term_id", (F.log(F.lit(n1) / (F.col("df").cast("double") + F.lit(1.0))) + F.lit(1.0)).alias("idf"))


def stored_vectors(index: Snapshot) -> DataFrame:
    """``(doc_id, terms, ws)`` of every document of a stored index: its term ids in order with their TF-IDF weights, of norm 1.

    The idf table is one row per term id. Blocks join it (Spark broadcasts it if it is small), move whole to the range of documents they
    belong to, and become rows by document there: no posting is a row of its own. Where some rows of the index do not count any more, or it has
    fewer ranges than there are cores, the postings that count join it, and each document becomes one row. The norm is taken inside the row. Documents without terms have empty arrays."""
    ranges = index.docs.agg(F.countDistinct(F.shiftright("doc_id", BLOCK_BITS))).first()[0]
    if index.hidden is None and ranges >= index.spark.sparkContext.defaultParallelism:
        return _vectors_by_range(index)
    raw = index.id_postings().join(idf_of(index), "term_id").select("doc_id", "term_id", (F.col("tf").cast("double") * F.col("idf")).alias("r"))
    rows = raw.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("term_id", "r"))).alias("e"))
    norm = F.sqrt(F.aggregate("e", F.lit(0.0), lambda acc, x: acc + x["r"] * x["r"]))
    rows = rows.select("doc_id", "e", norm.alias("norm"))
    return index.docs.join(rows, "doc_id", "left").select(
        "doc_id", F.coalesce(F.col("e.term_id"), F.array().cast("array<bigint>")).alias("terms"),
        F.coalesce(F.transform("e", lambda x: x["r"] / F.col("norm")), F.array().cast("array<double>")).alias("ws"))


def _vectors_by_range(index: Snapshot) -> DataFrame:
    """``stored_vectors`` of an index all of whose rows count."""
    bits = BLOCK_BITS

    def vectors(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        docs = table["docs"].combine_chunks()
        lens = np.asarray(docs.value_lengths())
        offsets = docs.flatten().to_numpy()
        term, idf = (np.repeat(table[c].to_numpy(), lens) for c in ("term_id", "idf"))
        tf = table["tfs"].combine_chunks().flatten().to_numpy()
        first = table["block"][0].as_py() << bits
        # term ids ascend, so they do in each document; its mark, of term 0, comes first
        order = np.argsort(offsets, kind="stable")
        offsets, term, r = offsets[order], term[order], (tf * idf)[order]
        begin = np.flatnonzero(np.r_[True, offsets[1:] != offsets[:-1]])
        length = np.diff(np.r_[begin, len(offsets)])
        ws = r / np.repeat(np.maximum(np.sqrt(np.add.reduceat(r * r, begin)), np.finfo(float).tiny), length)
        marked, real = term[begin] == 0, term != 0
        keep = real & np.repeat(marked, length)
        ends = np.r_[0, np.cumsum((length - 1)[marked])]
        ids, terms, ws = first + offsets[begin][marked].astype(np.int64), term[keep], ws[keep]
        for lo in range(0, len(ids), 1000):
            some = ends[lo:lo + 1001]
            cut = pa.array((some - some[0]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[lo:lo + 1000]), pa.ListArray.from_arrays(cut, pa.array(terms[some[0]:some[-1]])),
                 pa.ListArray.from_arrays(cut, pa.array(ws[some[0]:some[-1]]))], names=["doc_id", "terms", "ws"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for lo, hi in zip(cuts, cuts[1:]):
                if held and hi > lo and held[-1].column("block")[0].as_py() != blocks[lo]:
                    yield from vectors(pa.Table.from_batches(held))
                    held = []
                if hi > lo:
                    held.append(batch.slice(lo, hi - lo))
        if held:
            yield from vectors(pa.Table.from_batches(held))

    marks = index.docs.select(F.shiftright("doc_id", bits).alias("block"), F.lit(0).cast("bigint").alias("term_id"),
                              F.array(F.col("doc_id").bitwiseAND(F.lit((1 << bits) - 1)).cast("int")).alias("docs"),
                              F.array(F.lit(0).cast("bigint")).alias("tfs"), F.lit(0.0).alias("idf"))
    rows = index.blocks.select("block", "term_id", "docs", "tfs").join(idf_of(index), "term_id").select("block", "term_id", "docs", "tfs", "idf")
    moved = rows.unionByName(marks).repartition("block").sortWithinPartitions("block", "term_id")
    return moved.mapInArrow(run, "doc_id bigint, terms array<bigint>, ws array<double>")


def weights_of(vectors: DataFrame, index: Snapshot) -> DataFrame:
    """``(doc_id, term, w)`` of stored vectors."""
    rows = vectors.select("doc_id", F.explode(F.arrays_zip("terms", "ws")).alias("e"))
    return rows.select("doc_id", F.col("e.terms").alias("term_id"), F.col("e.ws").alias("w")).join(
        index.dictionary, "term_id").select("doc_id", "term", "w")
