"""Conjunctive (AND) keyword search over a batch of queries.

Queries are a table ``(query_id BIGINT, query STRING)``; they go through the same tokenizer and
normalization as documents. Every query gets a status:

* ``invalid``       no term survives normalization,
* ``missing_term``  some term is not in the vocabulary (no result at all),
* ``empty``         all terms exist but no document holds all of them,
* ``hits``          at least one document holds all terms.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.normalize import ALL_TECHNIQUES, Technique, normalize
from quarry.operators.positions import tokenize_docs
from quarry.operators.store import Snapshot, doc_of
from quarry.session import reliable_checkpoint


def query_terms(queries: DataFrame, techniques: Sequence[Technique] = ALL_TECHNIQUES) -> DataFrame:
    """Q1: ``(query_id, pos, term)`` with ``pos`` the raw token position (1-based)."""
    docs = queries.select(F.col("query_id").alias("doc_id"), F.trim(F.col("query")).alias("text"))
    toks = tokenize_docs(docs)
    return (normalize(toks, "token", "term", techniques)
            .select(F.col("doc_id").alias("query_id"), "pos", "term"))


def query_postings(qterms: DataFrame) -> DataFrame:
    """Q7: each query as a one-document index: ``(query_id, term, qpos)``, positions 0-based over
    the normalized terms. A query is small, so one window group per query is bounded."""
    w = Window.partitionBy("query_id").orderBy("pos")
    return qterms.select("query_id", "term", (F.row_number().over(w) - 1).cast("bigint").alias("qpos"))


def _distinct_terms(qterms: DataFrame) -> DataFrame:
    return qterms.select("query_id", "term").distinct()


def and_division(qterms: DataFrame, postings: DataFrame) -> DataFrame:
    """Q3: ``(query_id, doc_id)`` of documents holding every term of the query.

    Relational division: join the distinct (query, term) pairs to the postings of those terms and
    keep (query, doc) groups that matched every term. How the sides are joined is left to Spark.
    """
    qt = _distinct_terms(qterms)
    n_terms = qt.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_terms"))
    matched = (query_word_postings(qterms, postings).join(qt, "term")
               .groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("n_match")))
    return (matched.join(n_terms, "query_id")
            .filter(F.col("n_match") == F.col("n_terms")).select("query_id", "doc_id"))


# A batch using at most this many distinct words filters the postings with a literal IN list, which
# Spark pushes into the parquet scan of a stored index: as single values up to ten words, as their
# range beyond. Larger batches use a semi-join.
PUSHDOWN_MAX_WORDS = 1_000


def query_word_postings(qterms: DataFrame, postings: DataFrame) -> DataFrame:
    """``(term, doc_id)`` postings of the words used by the query batch: a pushed-down IN filter for a
    bounded word list, else a semi-join."""
    qwords = qterms.select("term").distinct()
    words = [r["term"] for r in qwords.limit(PUSHDOWN_MAX_WORDS + 1).collect()]
    if len(words) <= PUSHDOWN_MAX_WORDS:
        return postings.select("term", "doc_id").filter(F.col("term").isin(words))
    return postings.select("term", "doc_id").join(qwords, "term", "left_semi")


def and_rarest_first(qterms: DataFrame, postings: DataFrame) -> DataFrame:
    """Q3 with Q5's rarest-first order, for a batch of queries.

    Each query starts from the postings of its rarest term (smallest df, ties by term), which bounds
    the candidates; every candidate (query, doc) is then checked against the other terms with a
    semi-join on (term, doc_id). Document frequencies are counted only for the query words, and the
    work follows the rarest list, not the longest.
    """
    qt = _distinct_terms(qterms)
    relevant = query_word_postings(qterms, postings)
    qdf = relevant.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    stats = qt.join(qdf, "term", "left")
    per_query = stats.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_terms"),
        F.count("df").alias("n_known"),
        F.min_by("term", F.struct("df", "term")).alias("pivot"))
    complete = per_query.filter(F.col("n_terms") == F.col("n_known"))
    cand = (relevant.join(complete.select("query_id", F.col("pivot").alias("term"), "n_terms"), "term")
            .select("query_id", "doc_id", "n_terms"))
    probes = cand.join(qt, "query_id").filter(F.col("n_terms") > 1)
    # Candidates are bounded by each query's rarest list, and (term, doc_id) is unique in the postings:
    # the join neither repeats probes nor meets a hot key.
    matched = probes.join(relevant, ["term", "doc_id"], "left_semi")
    verified = (matched.groupBy("query_id", "doc_id", "n_terms").agg(F.count(F.lit(1)).alias("n_match"))
                .filter(F.col("n_match") == F.col("n_terms")).select("query_id", "doc_id"))
    singles = cand.filter(F.col("n_terms") == 1).select("query_id", "doc_id")
    return verified.unionByName(singles)


def query_ids(qterms: DataFrame, index: Snapshot) -> DataFrame:
    """``(query_id, term, term_id)`` of the distinct query terms that some document of the stored index holds."""
    qt = _distinct_terms(qterms)
    words = [r["term"] for r in qt.select("term").distinct().limit(PUSHDOWN_MAX_WORDS + 1).collect()]
    known = index.dictionary
    if len(words) <= PUSHDOWN_MAX_WORDS:
        known = known.filter(F.col("term").isin(words))
    found = qt.join(known, "term").select("query_id", "term", "term_id")
    if index.hidden is None:    # every term of the dictionary came with a document that still counts
        return found
    alive = index.id_postings(blocks=blocks_of(index.blocks, found)).select("term_id").distinct()
    return found.join(alive, "term_id", "left_semi").select("query_id", "term", "term_id")


def blocks_of(blocks: DataFrame, ids: DataFrame) -> DataFrame:
    """The blocks of these terms: a pushed-down list while it is bounded, else a semi-join."""
    terms = ids.select("term_id").distinct()
    listed = [r["term_id"] for r in terms.limit(PUSHDOWN_MAX_WORDS + 1).collect()]
    if len(listed) <= PUSHDOWN_MAX_WORDS:
        return blocks.filter(F.col("term_id").isin(listed))
    return blocks.join(terms, "term_id", "left_semi")


def touched_blocks(qterms: DataFrame, index: Snapshot, ids: DataFrame | None = None) -> DataFrame:
    """``(query_id, n_terms, gen, block, term_id)``: the blocks that a conjunction has to read. A range of documents counts if
    all terms of the query have a block there and the blocks' smallest and greatest documents leave a common stretch;
    only these numbers are read, not the documents."""
    ids = query_ids(qterms, index) if ids is None else ids
    wanted = _distinct_terms(qterms).groupBy("query_id").agg(F.count(F.lit(1)).alias("n_terms"))
    known = ids.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_known"))
    whole = wanted.join(known, "query_id").filter(F.col("n_terms") == F.col("n_known")).select("query_id", "n_terms")
    pairs = ids.join(whole, "query_id").select("query_id", "n_terms", "term_id")
    heads = blocks_of(index.blocks.select("gen", "term_id", "block", "min_doc", "max_doc"), pairs)
    met = (heads.join(pairs, "term_id").groupBy("query_id", "n_terms", "gen", "block")
           .agg(F.count(F.lit(1)).alias("n"), F.max("min_doc").alias("lo"), F.min("max_doc").alias("hi"))
           .filter((F.col("n") == F.col("n_terms")) & (F.col("lo") <= F.col("hi"))))
    return met.select("query_id", "gen", "block").join(pairs, "query_id").select("query_id", "n_terms", "gen", "block", "term_id")


def and_blocks(qterms: DataFrame, index: Snapshot, ids: DataFrame | None = None) -> DataFrame:
    """Q3 on a stored index: ``(query_id, doc_id)`` of documents holding every term of the query. The touched blocks are
    fetched (their terms and ranges are pushed into the scan while they are a bounded list) and intersected range by
    range, the shortest first; no group holds more than one range of one query."""
    touched = reliable_checkpoint(touched_blocks(qterms, index, ids))
    blocks = blocks_of(index.blocks.select("gen", "term_id", "block", "docs"), touched)
    ranges = [r["block"] for r in touched.select("block").distinct().limit(PUSHDOWN_MAX_WORDS + 1).collect()]
    if len(ranges) <= PUSHDOWN_MAX_WORDS:
        blocks = blocks.filter(F.col("block").isin(ranges))
    found = touched.join(blocks, ["gen", "term_id", "block"]).groupBy("query_id", "gen", "block").agg(
        F.array_sort(F.collect_list(F.struct(F.size("docs").alias("n"), "docs"))).alias("lists"))
    common = F.aggregate(F.slice("lists", 2, F.size("lists")), F.col("lists")[0]["docs"], lambda acc, x: F.array_intersect(acc, x["docs"]))
    hits = found.select("query_id", "gen", "block", F.explode(common).alias("o"))
    return index.live(hits.select("query_id", "gen", doc_of(F.col("block"), F.col("o")).alias("doc_id"))).select("query_id", "doc_id")


def shared_beginnings(paths: DataFrame) -> DataFrame:
    """``(path, cuts)``: the distinct paths and the lengths of their beginnings that are nodes of the batch's prefix tree: where
    paths part or one ends. Terms between two nodes are one edge, so the tree is as deep as paths part, not as they are long."""
    distinct = paths.select("path").distinct()
    steps = distinct.select("path", F.explode(F.sequence(F.lit(1), F.size("path"))).alias("cut")).select(
        "path", "cut", F.slice("path", F.lit(1), F.col("cut")).alias("node"), F.get("path", F.col("cut")).alias("next"))
    nodes = (steps.groupBy("node").agg(F.min("next").alias("lo"), F.max("next").alias("hi"), F.max(F.col("next").isNull()).alias("ends"))
             .filter(F.col("ends") | (F.col("lo") != F.col("hi"))).select("node"))
    return (steps.select("path", "cut", "node").join(nodes, "node", "left_semi").groupBy("path")
            .agg(F.array_sort(F.collect_list("cut")).alias("cuts")))


def shared_lists(asked: DataFrame, blocks: DataFrame) -> list[DataFrame]:
    """The prefix tree of a batch, a level of nodes at a time: ``(node, size, n_lists, gen, block, docs)``, ``docs`` being the offsets of
    the documents that hold all terms of the node (also when there are none) and ``n_lists`` the lists met on its edge.

    ``asked`` is ``(query_id, gen, block, path, cuts)``: the ranges that a query has to look at, its terms in order and the lengths
    that are nodes. An edge is intersected once per range, however many queries go through it; a branch without
    documents ends. The levels stop where no branch has documents left."""
    levels: list[DataFrame] = []
    while True:
        i = len(levels) + 1
        since = F.col("cuts")[i - 2] if levels else F.lit(0)
        edges = asked.filter(F.size("cuts") >= i).select(
            F.slice("path", F.lit(1), F.col("cuts")[i - 1]).alias("node"), F.slice("path", F.lit(1), since).alias("parent"),
            F.slice("path", since + 1, F.col("cuts")[i - 1] - since).alias("edge"), "gen", "block").distinct()
        if levels:
            above = levels[-1].filter(F.size("docs") > 0).select(F.col("node").alias("parent"), "gen", "block", F.col("docs").alias("kept"))
            edges = edges.join(above, ["parent", "gen", "block"])
        else:
            edges = edges.withColumn("kept", F.lit(None).cast("array<int>"))
        met = (edges.select("node", "gen", "block", "kept", F.explode("edge").alias("term_id")).join(blocks, ["gen", "term_id", "block"])
               .groupBy("node", "gen", "block").agg(F.first("kept").alias("kept"),  # one value per node and range
                                                    F.array_sort(F.collect_list(F.struct(F.size("docs").alias("n"), "docs"))).alias("lists")))
        start = F.coalesce("kept", F.col("lists")[0]["docs"])
        level = reliable_checkpoint(met.select(
            "node", F.size("node").alias("size"), (F.size("lists") - F.lit(0 if levels else 1)).alias("n_lists"), "gen", "block",
            F.aggregate("lists", start, lambda acc, x: F.array_intersect(acc, x["docs"])).alias("docs")))
        if level.isEmpty():
            return levels
        levels.append(level)


def and_shared(qterms: DataFrame, index: Snapshot, ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Q3/Q5 for a batch whose queries share terms: ``(query_id, doc_id)`` as from ``and_blocks``, and the work done.

    A query's terms are put in order of their document frequency, rarest first (ties by term id), so that queries with
    the same rare terms begin alike; every such beginning is intersected once (``shared_lists``). The work is ``(level, n_shared,
    n_alone)``: lists intersected for the nodes of that level of the tree, and how many it would have been query by query.
    """
    touched = reliable_checkpoint(touched_blocks(qterms, index, ids))
    blocks = blocks_of(index.blocks.select("gen", "term_id", "block", "n", "docs"), touched)
    ranges = [r["block"] for r in touched.select("block").distinct().limit(PUSHDOWN_MAX_WORDS + 1).collect()]
    if len(ranges) <= PUSHDOWN_MAX_WORDS:
        blocks = blocks.filter(F.col("block").isin(ranges))
    heads = blocks_of(index.blocks.select("term_id", "n"), touched).groupBy("term_id").agg(F.sum("n").alias("df"))
    paths = reliable_checkpoint(
        touched.select("query_id", "term_id").distinct().join(heads, "term_id").groupBy("query_id")
        .agg(F.array_sort(F.collect_list(F.struct("df", "term_id"))).alias("terms")).select("query_id", F.col("terms.term_id").alias("path")))
    asked = reliable_checkpoint(touched.select("query_id", "gen", "block").distinct().join(paths, "query_id")
                                .join(shared_beginnings(paths), "path"))
    levels = shared_lists(asked, blocks.drop("n"))
    spark = asked.sparkSession
    hits = spark.createDataFrame([], "query_id bigint, gen bigint, block bigint, o int")
    work = spark.createDataFrame([], "level int, n_shared bigint, n_alone bigint")
    for i, level in enumerate(levels, 1):
        ended = asked.filter(F.size("cuts") == i).join(level.withColumnRenamed("node", "path"), ["path", "gen", "block"])
        hits = hits.unionByName(ended.select("query_id", "gen", "block", F.explode("docs").alias("o")))
        through = (asked.filter(F.size("cuts") >= i).select(F.slice("path", F.lit(1), F.col("cuts")[i - 1]).alias("node"), "gen", "block")
                   .groupBy("node", "gen", "block").agg(F.count(F.lit(1)).alias("n")))
        work = work.unionByName(level.select("node", "gen", "block", "n_lists").join(through, ["node", "gen", "block"]).agg(
            F.lit(i).alias("level"), F.sum("n_lists").cast("bigint").alias("n_shared"),
            F.sum(F.col("n_lists") * F.col("n")).cast("bigint").alias("n_alone")))
    live = index.live(hits.select("query_id", "gen", doc_of(F.col("block"), F.col("o")).alias("doc_id")))
    return live.select("query_id", "doc_id"), work


def block_status(queries: DataFrame, qterms: DataFrame, hits: DataFrame, ids: DataFrame) -> DataFrame:
    """``query_status`` from the query terms that a stored index knows (``query_ids``)."""
    return query_status(queries, qterms, hits, ids.select("term", F.lit(0).cast("bigint").alias("doc_id")))


def and_chain(terms: Sequence[str], postings: DataFrame) -> DataFrame | None:
    """Q3/Q5 for one query given as normalized terms: ``(doc_id)`` of documents holding all terms,
    or ``None`` when a term is missing (as distinct from an empty result).

    The terms' document frequencies (one row per query term, counted from postings filtered to the
    query terms, which a stored index prunes by parquet statistics) decide the order: the rarest
    list is the start, and each further term is a ``left_semi`` join, so every step shrinks the
    candidates.
    """
    uniq = sorted(set(terms))
    if not uniq:
        return None
    dfs = {r["term"]: r["df"] for r in
           postings.filter(F.col("term").isin(uniq)).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}
    if len(dfs) < len(uniq):
        return None
    order = sorted(uniq, key=lambda t: (dfs[t], t))
    result = postings.filter(F.col("term") == F.lit(order[0])).select("doc_id")
    for t in order[1:]:
        result = result.join(postings.filter(F.col("term") == F.lit(t)).select("doc_id"), "doc_id", "left_semi")
    return result


def query_status(queries: DataFrame, qterms: DataFrame, hits: DataFrame, postings: DataFrame) -> DataFrame:
    """Q2/Q4: ``(query_id, status, n_terms, n_hits)`` for every query of the batch."""
    qt = _distinct_terms(qterms)
    in_vocab = query_word_postings(qterms, postings).select("term").distinct()
    known = (qt.join(in_vocab, "term", "left_semi").groupBy("query_id")
             .agg(F.count(F.lit(1)).alias("n_known")))
    nt = qt.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_terms"))
    nh = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_hits"))
    q = (queries.select("query_id").join(nt, "query_id", "left").join(known, "query_id", "left")
         .join(nh, "query_id", "left")
         .select("query_id",
                 F.coalesce("n_terms", F.lit(0)).cast("bigint").alias("n_terms"),
                 F.coalesce("n_known", F.lit(0)).cast("bigint").alias("n_known"),
                 F.coalesce("n_hits", F.lit(0)).cast("bigint").alias("n_hits")))
    status = (F.when(F.col("n_terms") == 0, F.lit("invalid"))
              .when(F.col("n_known") < F.col("n_terms"), F.lit("missing_term"))
              .when(F.col("n_hits") == 0, F.lit("empty"))
              .otherwise(F.lit("hits")))
    return q.select("query_id", status.alias("status"), "n_terms", "n_hits")


def session_union(hits: DataFrame) -> DataFrame:
    """Q6: distinct documents retrieved over all queries of a session."""
    return hits.select("doc_id").distinct()
