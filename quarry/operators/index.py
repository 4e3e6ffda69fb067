"""Positional inverted index.

The index is a bundle of DataFrames in long form:

* ``postings``  ``(term STRING, doc_id BIGINT, positions ARRAY<BIGINT>, tf BIGINT)``, one row per
  (term, document). A frequent term is spread over many rows, so no row or group holds a whole
  postings list.
* ``docs``      ``(doc_id BIGINT)``: documents with at least one raw token (they count, even if all
  their tokens are dropped by normalization).

Building groups by (term, doc_id). Each document's tokens come from one scan task, so the partial
aggregate before the shuffle already reduces tokens to one row per (term, doc): the shuffle moves
postings, not tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.normalize import ALL_TECHNIQUES, PORTER_STEMMING, Technique, normalize
from quarry.functions.porter import word_stemmer
from quarry.operators.positions import tokenize_docs, tokenize_docs_marked, tokenize_pages
from quarry.plans.ordering import dense_index, nth_smallest

# Fixed value: a text yields at least one token iff it holds a character that is not white space
# (every such character starts a token of the tokenizer pattern).
HAS_TOKEN_PATTERN = r"[^\s\x0B\p{Z}]"
# Token rows that a task groups at a time, if they are not all of one document.
GROUP_ROWS = 1 << 18
# The same where they become blocks: the more documents are grouped at a time, the fewer rows share a block.
BLOCK_ROWS = 1 << 20
# Words whose stems a task keeps.
STEM_WORDS = 1 << 18


@dataclass
class TextIndex:
    postings: DataFrame
    docs: DataFrame
    # postings plus one null-term row per non-empty document, from a single pass over the text
    combined: DataFrame | None = None

    @property
    def terms(self) -> DataFrame:
        return term_stats(self.postings)

    def num_docs(self) -> int:
        return self.docs.count()


def write_index(index: TextIndex, path: str, sort_by_term: bool = True, positions: bool = True) -> None:
    """Store the index as parquet: ``{path}/postings`` and ``{path}/docs``.

    With ``sort_by_term`` the postings are range partitioned and sorted by (term, doc_id), so each
    file and row group covers a narrow term range and parquet min/max statistics prune term lookups.
    Without ``positions`` only ``(term, doc_id, tf)`` is stored (all that TF-IDF, clustering and
    AND search need); the build then skips collecting positions altogether (Catalyst prunes it).
    There is one layout: the document list is stored as null-term rows of the postings table. With a
    ``combined`` aggregate (one-page documents) these come from the same pass, so the text is read once.
    """
    cols = ["term", "doc_id", "tf"] + (["positions"] if positions else [])
    table = combined_rows(index).select(*cols)
    if sort_by_term:
        table = table.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id")
    table.write.mode("overwrite").parquet(f"{path}/postings")


def combined_rows(index: TextIndex) -> DataFrame:
    """Postings plus one null-term row per document of the list."""
    if index.combined is not None:
        return index.combined
    marks = index.docs.select(F.lit(None).cast("string").alias("term"), "doc_id",
                              F.array(F.lit(0).cast("bigint")).alias("positions"), F.lit(1).cast("bigint").alias("tf"))
    return index.postings.select("term", "doc_id", "positions", F.col("tf").cast("bigint").alias("tf")).unionByName(marks)


def read_index(spark, path: str) -> TextIndex:
    """Read an index written by ``write_index`` (scans prune columns and push term filters)."""
    table = spark.read.parquet(f"{path}/postings")
    return TextIndex(table.filter(F.col("term").isNotNull()),
                     table.filter(F.col("term").isNull()).select("doc_id"))


def nonempty_docs(docs: DataFrame, text_col: str = "text", unique_ids: bool = False) -> DataFrame:
    """Ids of documents (or pages) whose text yields at least one token. A table of pages needs
    the ``distinct``; a table with one row per document (``unique_ids``) does not, and skips the
    shuffle."""
    ids = docs.filter(F.col(text_col).rlike(HAS_TOKEN_PATTERN)).select("doc_id")
    return ids if unique_ids else ids.distinct()


def normalized_terms(tokens: DataFrame, techniques: Sequence[Technique] = ALL_TECHNIQUES) -> DataFrame:
    """``(doc_id, pos, term)`` for tokens surviving normalization."""
    return normalize(tokens, "token", "term", techniques).select("doc_id", "pos", "term")


def build_postings(terms: DataFrame) -> DataFrame:
    """``(term, doc_id, positions, tf)`` from ``(doc_id, pos, term)``."""
    return (terms.groupBy("term", "doc_id")
            .agg(F.sort_array(F.collect_list("pos")).alias("positions"),
                 F.count(F.lit(1)).alias("tf")))


def stem_lookup(limit: int = STEM_WORDS) -> Callable[[pa.Array], pa.Array]:
    """The stems of an array of words (nulls stay): its distinct words are looked up, and a word is stemmed when it first comes.
    At most about ``limit`` words are kept."""
    stem = word_stemmer()
    known: dict[str, str] = {}

    def stems(words: pa.Array) -> pa.Array:
        codes = words.dictionary_encode()
        distinct = codes.dictionary.to_pylist()
        if len(known) > limit:
            known.clear()
        found = list(map(known.get, distinct))
        if None in found:
            for i, w in enumerate(distinct):
                if found[i] is None:
                    found[i] = known[w] = stem(w)
        return pa.array(found, pa.string()).take(codes.indices)

    return stems


def stemmed(terms: DataFrame, limit: int = STEM_WORDS) -> DataFrame:
    """``(doc_id, pos, term)`` with the words stemmed as ``porter_stem`` does, each distinct word of a task once."""
    stems = stem_lookup(limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["pos"], stems(b["term"])], names=["doc_id", "pos", "term"])

    return terms.select("doc_id", "pos", "term").mapInArrow(run, "doc_id bigint, pos bigint, term string")


def stem_last(techniques: Sequence[Technique] | Technique) -> tuple[Sequence[Technique], bool]:
    """The techniques without a stemmer that comes last, and whether there was one."""
    techniques = [techniques] if isinstance(techniques, Technique) else list(techniques)
    last = bool(techniques) and techniques[-1] is PORTER_STEMMING
    return techniques[:-1] if last else techniques, last


def task_groups(rows: int, stem: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.Table]]:
    """A function of a task's ``(doc_id, pos, term)`` batches: ``(term, doc_id, positions, tf)`` tables, each from about ``rows`` rows (more,
    if one document has more) that hold documents whole; with ``stem``, by the stems of the words."""
    stems = stem_lookup() if stem else None

    def grouped(table: pa.Table) -> pa.Table:
        if stems:
            table = table.set_column(2, "term", stems(table.combine_chunks()["term"].combine_chunks()))
        g = table.group_by(["term", "doc_id"], use_threads=False).aggregate([("pos", "list"), ("pos", "count")]).combine_chunks()
        return pa.Table.from_arrays([g["term"], g["doc_id"], g["pos_list"], g["pos_count"]], names=["term", "doc_id", "positions", "tf"])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, n = [], 0
        for batch in batches:
            held, n = [*held, batch], n + batch.num_rows
            if n < rows:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = table["doc_id"].to_numpy()
            cut = int((last != last[-1]).nonzero()[0][-1]) + 1 if last[0] != last[-1] else 0     # before the last, maybe unfinished document
            if cut:
                yield grouped(table.slice(0, cut))
            held, n = table.slice(cut).to_batches(), 0 if cut else n
        if held:
            yield grouped(pa.Table.from_batches(held).combine_chunks())

    return groups


def grouped_in_place(terms: DataFrame, rows: int = GROUP_ROWS, stem: bool = False) -> DataFrame:
    """``build_postings`` of ``(doc_id, pos, term)`` rows that come from texts with different ids and have not been shuffled since: a
    document's rows follow each other in one task, in order, and are grouped there (with ``stem``, by the stems of the words)."""
    groups = task_groups(rows, stem)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches):
            yield from g.to_batches()

    return terms.select("doc_id", "pos", "term").mapInArrow(run, "term string, doc_id bigint, positions array<bigint>, tf bigint")


def blocked_in_place(terms: DataFrame, bits: int, rows: int = BLOCK_ROWS, stem: bool = False) -> DataFrame:
    """``grouped_in_place`` as blocks: the postings of a term in one range of ``2 ** bits`` ids that are grouped at a time are a row
    ``(term, block, docs, tfs, positions)``, ``docs`` being ascending offsets in the range. Several rows may share a term and a block."""
    groups = task_groups(rows, stem)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches):
            words = g["term"].combine_chunks().dictionary_encode()
            codes, ids = words.indices.fill_null(len(words.dictionary)).to_numpy(), g["doc_id"].to_numpy()
            order = np.lexsort((ids, codes))
            codes, ids = codes[order], ids[order]
            blocks = ids >> bits
            first = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])])
            ends = pa.array(np.r_[first, len(ids)].astype(np.int32))
            held = g.select(["tf", "positions"]).take(pa.array(order)).combine_chunks()
            yield from pa.Table.from_arrays(
                [g["term"].take(pa.array(order[first])), pa.array(blocks[first]),
                 pa.ListArray.from_arrays(ends, pa.array((ids & ((1 << bits) - 1)).astype(np.int32))),
                 pa.ListArray.from_arrays(ends, held["tf"].combine_chunks()),
                 pa.ListArray.from_arrays(ends, held["positions"].combine_chunks())],
                names=["term", "block", "docs", "tfs", "positions"]).combine_chunks().to_batches(max_chunksize=1 << 14)

    return terms.select("doc_id", "pos", "term").mapInArrow(
        run, "term string, block bigint, docs array<int>, tfs array<bigint>, positions array<array<bigint>>")


def repeated_ids(docs: DataFrame) -> bool:
    """Whether an id comes more than once (only ids are read)."""
    return not docs.groupBy("doc_id").count().filter("count > 1").isEmpty()


def build_index(docs: DataFrame, techniques: Sequence[Technique] = ALL_TECHNIQUES, unique_ids: bool = False) -> TextIndex:
    """Index one-page documents ``(doc_id, text)``; rows with a null id or text are left out
    (``split_rejects`` lists them).

    ``postings`` and ``docs`` are lazy and independent (``docs`` is a cheap check on the text).
    ``combined`` yields both from one pass over the text: each non-empty document contributes a
    marker that passes normalization untouched and aggregates to a null-term row; ``write_index``
    stores it, so materializing an index reads the text once.

    With ``unique_ids`` (see ``repeated_ids``) the postings are grouped where the text is read, without a shuffle. A stemmer that
    comes last is then applied to the distinct words of a task (``stem_lookup``), not to each token."""
    docs = split_rejects(docs)[0]
    techniques, stem = stem_last(techniques) if unique_ids else (techniques, False)
    terms = marked_terms(docs, techniques)
    combined = grouped_in_place(terms, stem=stem) if unique_ids else build_postings(terms)
    return TextIndex(combined.filter(F.col("term").isNotNull()), nonempty_docs(docs, unique_ids=True), combined)


def marked_terms(docs: DataFrame, techniques: Sequence[Technique] | Technique) -> DataFrame:
    """``(doc_id, pos, term)`` of one-page documents and a null-term row at position 0 for each that is not empty."""
    return normalize(tokenize_docs_marked(docs), "token", "term", techniques, marker="__m").select("doc_id", "pos", "term")


def build_blocks(docs: DataFrame, bits: int, techniques: Sequence[Technique] = ALL_TECHNIQUES) -> DataFrame:
    """``combined`` of ``build_index(unique_ids=True)`` as the rows of ``blocked_in_place``."""
    techniques, stem = stem_last(techniques)
    return blocked_in_place(marked_terms(split_rejects(docs)[0], techniques), bits, stem=stem)


def build_paged_index(pages: DataFrame, techniques: Sequence[Technique] = ALL_TECHNIQUES,
                      quarantine: bool = False) -> TextIndex:
    """Index multi-page documents ``(doc_id, page_no, text)``; positions run across pages. With
    ``quarantine`` a document with a bad page is left out whole (``split_page_rejects`` lists it);
    without, a null text is a blank page. A page without a document id is always left out."""
    pages = split_page_rejects(pages)[0] if quarantine else pages.filter(F.col("doc_id").isNotNull())
    techniques, stem = stem_last(techniques)
    terms = normalized_terms(tokenize_pages(pages), techniques)
    return TextIndex(build_postings(stemmed(terms) if stem else terms), nonempty_docs(pages))


def merge_postings(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union postings tables; a (term, doc) present in several gets the positions of all.
    With one table this compacts it (e.g. the deltas of a stream)."""
    cols = ["term", "doc_id", "positions", "tf"]
    union = first.select(*cols)
    for other in others:
        union = union.unionByName(other.select(*cols))
    return (union.groupBy("term", "doc_id")
            .agg(F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions"),
                 F.sum("tf").cast("bigint").alias("tf")))


def merge_indexes(a: TextIndex, b: TextIndex) -> TextIndex:
    return TextIndex(merge_postings(a.postings, b.postings),
                     a.docs.unionByName(b.docs).distinct())


def term_stats(postings: DataFrame) -> DataFrame:
    """``(term, df, cf)`` document and collection frequency per term."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"),
                                        F.sum("tf").cast("bigint").alias("cf"))


def collection_stats(index: TextIndex) -> DataFrame:
    """One row ``(n_docs, n_terms, n_postings, n_tokens)``. Each figure is a partial+final
    aggregate; the four one-row results are combined by a join on a constant key."""
    p = index.postings.agg(F.countDistinct("term").alias("n_terms"),
                           F.count(F.lit(1)).alias("n_postings"),
                           F.sum("tf").cast("bigint").alias("n_tokens")).withColumn("k", F.lit(1))
    d = index.docs.agg(F.count(F.lit(1)).alias("n_docs")).withColumn("k", F.lit(1))
    return d.join(p, "k").drop("k")


def term_lookup(postings: DataFrame, term: str) -> DataFrame:
    """Postings of one exact term (a pushed-down equality when postings are stored by term)."""
    return postings.filter(F.col("term") == F.lit(term))


def doc_limit(docs: DataFrame, n: int) -> DataFrame:
    """The first ``n`` non-empty documents in id order (``docs``: ``(doc_id, text)``)."""
    if n < 1:
        raise ValueError("the document limit must be at least 1")
    ne = nonempty_docs(docs)
    cut = nth_smallest(ne, ["doc_id"], n)
    return ne if cut is None else ne.filter(F.col("doc_id") <= cut[0])


def dense_doc_ids(docs: DataFrame) -> DataFrame:
    """``(doc_id, dense_id)``, 1..n over non-empty documents in id order."""
    return dense_index(nonempty_docs(docs), ["doc_id"], "dense_id")


def vocabulary_cut(terms: DataFrame, capacity: int | None) -> tuple[int, int] | None:
    """The last ``(doc_id, pos)`` indexed before the vocabulary reaches ``capacity`` terms.

    Sequential indexing stops right after the token that introduces the capacity-th distinct term.
    That token is the capacity-th smallest first occurrence ``(doc_id, pos)`` over all terms, found
    with one aggregate and a distributed ranking. ``None`` when the cap is never reached.
    """
    if capacity is None:
        return None
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    firsts = terms.groupBy("term").agg(F.min(F.struct("doc_id", "pos")).alias("first")).select(
        "term", F.col("first.doc_id").alias("fd"), F.col("first.pos").alias("fp"))
    return nth_smallest(firsts, ["fd", "fp"], capacity)


def vocabulary_cap(terms: DataFrame, capacity: int | None) -> DataFrame:
    """Keep the term occurrences indexed under a vocabulary cap (all of them if never reached)."""
    cut = vocabulary_cut(terms, capacity)
    if cut is None:
        return terms
    fd, fp = cut
    return terms.filter((F.col("doc_id") < fd) | ((F.col("doc_id") == fd) & (F.col("pos") <= fp)))


def capped_docs(docs: DataFrame, cut: tuple[int, int] | None) -> DataFrame:
    """Documents counted under a vocabulary cap: non-empty ones up to and including the cut doc."""
    ne = nonempty_docs(docs)
    return ne if cut is None else ne.filter(F.col("doc_id") <= cut[0])


def split_rejects(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good, rejects)``; a document with a null id or null text is rejected as a whole."""
    bad = F.col("doc_id").isNull() | F.col("text").isNull()
    good = docs.filter(~bad)
    rejects = docs.filter(bad).select(
        "doc_id", F.when(F.col("doc_id").isNull(), F.lit("null_id")).otherwise(F.lit("null_text"))
        .alias("reason"))
    return good, rejects


def split_page_rejects(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """X10 for multi-page documents: a document is atomic, so one page with a null text (or a null
    page number) rejects all of its pages. Pages with a null document id are rejected on their own.
    Returns ``(good_pages, rejects)`` with rejects ``(doc_id, page_no, reason)``."""
    bad_page = F.col("text").isNull() | F.col("page_no").isNull()
    keyed = pages.filter(F.col("doc_id").isNotNull())
    bad_docs = keyed.filter(bad_page).select("doc_id").distinct()
    good = keyed.join(bad_docs, "doc_id", "left_anti")
    in_bad_doc = keyed.join(bad_docs, "doc_id", "left_semi").select(
        "doc_id", "page_no",
        F.when(bad_page, F.lit("null_text")).otherwise(F.lit("document_rejected")).alias("reason"))
    no_id = pages.filter(F.col("doc_id").isNull()).select("doc_id", "page_no", F.lit("null_id").alias("reason"))
    return good, in_bad_doc.unionByName(no_id)
