"""The query catalog: every operator as a callable ``(spark, sf_dir) -> DataFrame``.

Each entry reads the driver's tables (whole tables, whole texts). Result columns are named and typed
to match the SQL oracle in ``quarry.plans.oracle``: integers BIGINT, weights rounded to 6 places,
arrays rendered as strings.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.normalize import (
    CASEFOLDING, FIRST_STOP_WORDS_FILTER, NO_STEM_TECHNIQUES, REMOVE_NUMBERS, REST_STOP_WORDS_FILTER,
    normalize,
)
from quarry.functions.porter import porter_stem
from quarry.operators import cluster, kmeans, links, render, search, seeding, seen, store, tfidf
from quarry.operators import index as ix
from quarry.operators.positions import tokenize_docs, tokenize_pages
from quarry.session import reliable_checkpoint, shared_scratch_path
from quarry.sources import tables, textformats
from quarry.streaming import ingest

# The query batch run against ``documents`` (one per status the search can report).
QUERY_SET = [
    (1, "en er"), (2, "ha th st"), (3, "eau tion"), (4, "en EN en"), (5, "für ción"),
    (6, "zzzz en"), (7, "the of"), (8, "3.14 ,"), (9, ""),
]
# Whole ``benchmark`` passages are also asked as queries, with ids offset by this value.
BENCHMARK_QUERY_OFFSET = 1000
LOOKUP_TERM = "en"
LINK_DOMAIN = "example.com"
DOC_LIMIT = 50
VOCAB_CAPACITY = 1000
SQL_KMEANS_K = 10
SEEDED_K = 5
CHAIN_QUERY_ID = 2
DELIVERIES = 3

# Fixed rows that join the given tables where these hold no such case: links in every notation and one
# per rule, rejected rows of each kind, and pages that repeat or lack a number.
LINK_PAGE = (
    -1, "https://repo.example.com/view/dir/page.html?x=1#top",
    "<A HREF='/papers/Thesis.PDF.pdf'>1</A><a class=\"n\" href=/view/year/2021.html>2</a><area href=\"https://repo.example.com/id/eprint/7/\">"
    "<a href=\"../thesis_type/\">4</a><a href=\"./x/../../document_subtype/\">5</a><a href=\"/id/eprint/7/pic.jpg\">denied</a>"
    "<a href=\"/view/year/2021.html\">again</a><a href=\"mailto:a@example.com\">m</a><a href=\"#top\">t</a><a data-href=\"/no\">n</a>"
    "<link href=\"/s.css\"><a href=\"?page=2&amp;size=9\">q</a><a href=\"//cdn.example.com/a.pdf#p2\">c</a><a href=\"http://other.test/b.pdf\">o</a>"
    "<a href=\"javascript:void(0)\">j</a><a href=\"up.pdf\">u</a>")
REJECT_ROWS = [(None, "no id"), (-1, None), (None, None)]
REJECT_PAGES = [(-1, 1, "good page"), (-1, 2, None), (-2, None, "no number"), (None, 1, "no id")]
ODD_PAGES = [(-1, 1, "a b"), (-1, 1, "c"), (-2, None, "y z"), (-2, 1, "x"), (-3, 4096, "late"), (-3, 2, "early bird")]


def positions_str(col: str = "positions"):
    return F.array_join(F.transform(F.col(col), lambda x: x.cast("string")), ",")


def postings_out(p: DataFrame) -> DataFrame:
    return p.select("term", "doc_id", F.col("tf").cast("bigint").alias("tf"),
                    positions_str().alias("positions"))


# ---------------------------------------------------------------------------------------------
# inputs

def docs(spark: SparkSession, sf: str) -> DataFrame:
    return tables.documents(spark, sf)


def raw_tokens(spark, sf):
    return tokenize_docs(docs(spark, sf))


def doc_index(spark, sf) -> ix.TextIndex:
    """The index of ``documents``, built by whoever reads it."""
    read = docs(spark, sf)
    return ix.build_index(read, unique_ids=not ix.repeated_ids(ix.split_rejects(read)[0]))


def stored_index(spark, sf) -> store.Snapshot:
    """The stored index of ``documents``: built by the first query of an application that needs it, read by all later ones
    (search, TF-IDF, clustering), as a deployment builds once and queries. It is named after the table's path, size
    and time, so a table that changes gets an index of its own."""
    source = tables.table_path(sf, "documents")
    fs, folder = store.file_system(spark, source)
    size, status = fs.getContentSummary(folder), fs.getFileStatus(folder)
    state = f"{source} {size.getLength()} {size.getFileCount()} {status.getModificationTime()}"
    name = hashlib.sha256(f"{spark.sparkContext.applicationId} {state}".encode()).hexdigest()[:20]
    path = shared_scratch_path(spark, f"index-{name}")
    if not store.read_manifest(spark, path)["generation"]:
        store.commit(spark, path, docs(spark, sf), batch_id=0)
    return store.snapshot(spark, path)


def deliveries(spark, sf, parts: int) -> list[DataFrame]:
    """``documents`` as deliveries of consecutive ids, in the order of their arrival."""
    every = docs(spark, sf)
    lo, hi = every.agg(F.min("doc_id"), F.max("doc_id")).first()
    lo, hi = lo or 0, hi or 0
    edges = [lo + (hi + 1 - lo) * k // parts for k in range(parts + 1)]
    # ids that are null go with the first
    return [every.filter(F.col("doc_id").between(a, b - 1) | (F.col("doc_id").isNull() if a == lo else F.lit(False)))
            for a, b in zip(edges, edges[1:])]


def _delivered(spark, sf, **kw) -> store.Snapshot:
    """An index that got ``documents`` in deliveries, each of them twice."""
    path = shared_scratch_path(spark, f"deliveries-{uuid.uuid4().hex}")
    for number, part in enumerate(deliveries(spark, sf, DELIVERIES)):
        for _ in range(2):
            store.commit(spark, path, part, batch_id=number, fanout=2, **kw)
    return store.snapshot(spark, path)


def query_table(spark: SparkSession, sf: str) -> DataFrame:
    fixed = spark.createDataFrame(QUERY_SET, "query_id BIGINT, query STRING")
    bench = tables.read_table(spark, sf, "benchmark").select(
        (F.col("item_id") + F.lit(BENCHMARK_QUERY_OFFSET)).cast("bigint").alias("query_id"),
        F.col("text").alias("query"))
    return fixed.unionByName(bench)


# ---------------------------------------------------------------------------------------------
# T, N

def q_tokens(spark, sf):
    return raw_tokens(spark, sf)


def q_tokens_paged(spark, sf):
    odd = spark.createDataFrame(ODD_PAGES, "doc_id BIGINT, page_no BIGINT, text STRING")
    return tokenize_pages(tables.conversation_pages(spark, sf).unionByName(odd))


def q_remove_numbers(spark, sf):
    return normalize(raw_tokens(spark, sf), "token", "term", [REMOVE_NUMBERS]).select("doc_id", "pos", "term")


def q_casefold(spark, sf):
    return normalize(raw_tokens(spark, sf), "token", "term", [CASEFOLDING]).select("doc_id", "pos", "term")


def q_stop30(spark, sf):
    return normalize(raw_tokens(spark, sf), "token", "term",
                     [CASEFOLDING, FIRST_STOP_WORDS_FILTER]).select("doc_id", "pos", "term")


def q_stop_rest(spark, sf):
    return normalize(raw_tokens(spark, sf), "token", "term",
                     [CASEFOLDING, REST_STOP_WORDS_FILTER]).select("doc_id", "pos", "term")


def q_normalize_nostem(spark, sf):
    return ix.normalized_terms(raw_tokens(spark, sf), NO_STEM_TECHNIQUES)


def q_normalize(spark, sf):
    return ix.normalized_terms(raw_tokens(spark, sf))


def q_porter_vocab(spark, sf):
    vocab = q_normalize_nostem(spark, sf).select("term").distinct()
    return porter_stem(vocab, "term", "stem")


# ---------------------------------------------------------------------------------------------
# X

def q_postings(spark, sf):
    return postings_out(doc_index(spark, sf).postings)


def q_merge_postings(spark, sf):
    a = doc_index(spark, sf)
    b = ix.build_paged_index(tables.conversation_pages(spark, sf), quarantine=True)
    return postings_out(ix.merge_postings(a.postings, b.postings))


def q_term_stats(spark, sf):
    return doc_index(spark, sf).terms


def q_collection_stats(spark, sf):
    return ix.collection_stats(doc_index(spark, sf))


def q_term_lookup(spark, sf):
    return postings_out(stored_index(spark, sf).lookup(LOOKUP_TERM))


def q_term_dictionary(spark, sf):
    idx = stored_index(spark, sf)
    return idx.dictionary.join(idx.id_stats(), "term_id").select("term", "term_id", "df", "cf")


def q_segment_ingest(spark, sf):
    return postings_out(_delivered(spark, sf).postings())


def q_capped_ingest(spark, sf):
    return postings_out(_delivered(spark, sf, capacity=VOCAB_CAPACITY).postings())


def q_arrival_numbers(spark, sf):
    return _delivered(spark, sf).numbers


def q_limited_ingest(spark, sf):
    return _delivered(spark, sf, limit=DOC_LIMIT).docs


def q_index_dump(spark, sf):
    return render.index_dump(doc_index(spark, sf).postings)


def q_postings_parts(spark, sf):
    return render.postings_parts(doc_index(spark, sf).postings)


# ---------------------------------------------------------------------------------------------
# Q

def _asked(spark, sf, only: int | None = None):
    """``(queries, qterms, index, ids)``: the batch (or one query of it), its terms, and those that the stored index knows."""
    queries = query_table(spark, sf)
    queries = queries if only is None else queries.filter(F.col("query_id") == only)
    qterms = reliable_checkpoint(search.query_terms(queries))
    index = stored_index(spark, sf)
    return queries, qterms, index, reliable_checkpoint(search.query_ids(qterms, index))


def _search(spark, sf):
    """The batch answered from the touched blocks of the stored index: ``(queries, qterms, hits, ids)``."""
    queries, qterms, index, ids = _asked(spark, sf)
    return queries, qterms, reliable_checkpoint(search.and_blocks(qterms, index, ids)), ids


def _word_postings(spark, sf, only: int | None = None):
    """``(qterms, postings)``: the postings of the words of the batch (or of one query of it) alone, in long form, stored."""
    _, qterms, index, ids = _asked(spark, sf, only)
    rows = index.id_postings(blocks=search.blocks_of(index.blocks, ids)).join(ids.select("term", "term_id").distinct(), "term_id")
    return qterms, reliable_checkpoint(rows.select("term", "doc_id"))


def q_query_terms(spark, sf):
    return search.query_terms(query_table(spark, sf))


def q_query_postings(spark, sf):
    return search.query_postings(search.query_terms(query_table(spark, sf)))


def q_and_query(spark, sf):
    return search.and_division(*_word_postings(spark, sf))


def q_and_query_semijoin(spark, sf):
    return search.and_rarest_first(*_word_postings(spark, sf))


def q_and_blocks(spark, sf):
    return _search(spark, sf)[2]


def _shared(spark, sf):
    _, qterms, index, ids = _asked(spark, sf)
    return search.and_shared(qterms, index, ids)


def q_and_shared(spark, sf):
    return _shared(spark, sf)[0]


def q_and_shared_work(spark, sf):
    return _shared(spark, sf)[1]


def _status(spark, sf):
    queries, qterms, hits, ids = _search(spark, sf)
    return search.block_status(queries, qterms, hits, ids), hits


def q_query_status(spark, sf):
    return _status(spark, sf)[0]


def q_result_text(spark, sf):
    return render.result_text(*_status(spark, sf))


def q_result_parts(spark, sf):
    return render.result_parts(_search(spark, sf)[2])


def q_and_chain(spark, sf):
    terms, postings = _word_postings(spark, sf, CHAIN_QUERY_ID)
    return search.and_chain([r["term"] for r in terms.collect()], postings)


def q_session_union(spark, sf):
    return search.session_union(_search(spark, sf)[2])


def q_session_text(spark, sf):
    return render.session_text(search.session_union(_search(spark, sf)[2]))


def q_session_parts(spark, sf):
    return render.session_parts(search.session_union(_search(spark, sf)[2]))


# ---------------------------------------------------------------------------------------------
# C

def _vectors(spark, sf):
    """``(index, vectors)``: the stored index and its TF-IDF vectors, stored by document."""
    idx = stored_index(spark, sf)
    path = shared_scratch_path(spark, f"tfidf-{uuid.uuid4().hex}")
    vectors = tfidf.stored_vectors(idx)
    vectors.write.parquet(path)
    return idx, spark.read.schema(vectors.schema).parquet(path)


def q_doc_term_matrix(spark, sf):
    return tfidf.doc_term_matrix(doc_index(spark, sf))


def q_tfidf(spark, sf):
    idx = stored_index(spark, sf)
    return tfidf.weights_of(tfidf.stored_vectors(idx), idx).select("doc_id", "term", F.round("w", 6).alias("w"))


def _sql_kmeans(spark, sf):
    """``(labels, centroids)``, the centroids by term. The vectors are packed as they are made, not stored before."""
    idx = stored_index(spark, sf)
    labels, cents, _ = kmeans.fit(tfidf.stored_vectors(idx), {SQL_KMEANS_K: SQL_KMEANS_K}, df=cluster.document_frequencies(idx))
    return labels.select("doc_id", "cluster"), cluster.by_term(cents, idx.dictionary).select("cluster", "term", "w")


def q_kmeans_assign(spark, sf):
    return _sql_kmeans(spark, sf)[0]


def q_kmeans_centroids(spark, sf):
    cents = _sql_kmeans(spark, sf)[1]
    return cents.select("cluster", "term", F.round("w", 6).alias("w"))


def q_kmeans_seeds(spark, sf):
    return seeding.seeds(_vectors(spark, sf)[1], SEEDED_K)


def q_kmeans_best(spark, sf):
    idx, vectors = _vectors(spark, sf)
    return seeding.best_run(vectors, SEEDED_K, df=cluster.document_frequencies(idx))[0]


def q_cluster_members(spark, sf):
    return cluster.members_lines(spark, _sql_kmeans(spark, sf)[0], SQL_KMEANS_K)


def q_cluster_member_parts(spark, sf):
    return render.member_parts(_sql_kmeans(spark, sf)[0])


def q_cluster_top_terms(spark, sf):
    return cluster.top_terms_lines(_sql_kmeans(spark, sf)[1])


def _ml(k):
    def run(spark, sf):
        idx, vectors = _vectors(spark, sf)
        return cluster.stored_ml_labels(vectors, idx)(k)
    run.__name__ = f"q_kmeans_ml_k{k}"
    return run


def q_kmeans_guard(spark, sf):
    found = stored_index(spark, sf).docs
    return cluster.guard_lines(spark, found, (*cluster.DEFAULT_KS, found.count() + 1))


def q_kmeans_ml_check(spark, sf):
    idx, vectors = _vectors(spark, sf)
    return cluster.ml_check(spark, vectors, idx, cluster.DEFAULT_KS)


def q_cluster_report_sql(spark, sf):
    idx = stored_index(spark, sf)
    return cluster.stored_report(spark, tfidf.stored_vectors(idx), idx, cluster.DEFAULT_KS)


def q_cluster_report(spark, sf):
    idx, vectors = _vectors(spark, sf)
    return cluster.stored_ml_report(spark, vectors, idx, cluster.DEFAULT_KS)


# ---------------------------------------------------------------------------------------------
# I, S, X9, X10

def _links(spark, sf):
    fixed = spark.createDataFrame([LINK_PAGE], "page_id BIGINT, url STRING, html STRING")
    return links.extract_links(tables.web_pages(spark, sf).unionByName(fixed))


def q_links(spark, sf):
    return _links(spark, sf)


def q_link_domain(spark, sf):
    lk = _links(spark, sf)
    return lk.filter(links.in_domain(F.col("url"), LINK_DOMAIN)).select(
        "page_id", "link_no", "url", links.host_of(F.col("url")).alias("host"))


def q_link_class(spark, sf):
    rule, cls = links.classify(F.col("url"))
    return _links(spark, sf).select("page_id", "link_no", "url", rule.alias("rule"), cls.alias("class"))


def q_select_links(spark, sf):
    return links.select_links(_links(spark, sf), LINK_DOMAIN, DOC_LIMIT)


def q_url_dedupe(spark, sf):
    return links.dedupe_urls(_links(spark, sf))


def q_seen_urls(spark, sf):
    found = reliable_checkpoint(_links(spark, sf))
    lo, hi = found.agg(F.min("page_id"), F.max("page_id")).first()
    edges = [lo + (hi + 1 - lo) * k // DELIVERIES for k in range(DELIVERIES + 1)]
    path = shared_scratch_path(spark, f"seen-{uuid.uuid4().hex}")
    for number, (a, b) in enumerate(zip(edges, edges[1:])):
        for _ in range(2):      # each delivery comes twice
            seen.take(spark, path, found.filter(F.col("page_id").between(a, b - 1)), number)
    return seen.seen_urls(spark, path).select("url", "page_id", "link_no")


def q_url_filename(spark, sf):
    p = tables.web_pages(spark, sf)
    return p.select("page_id", "url", links.file_name(F.col("page_id"), F.col("url")).alias("file_name"))


def _nonempty_pages(spark, sf):
    p = tables.web_pages(spark, sf)
    ne = ix.nonempty_docs(p.select(F.col("page_id").alias("doc_id"), F.col("html").alias("text")))
    return p.select(F.col("page_id").alias("doc_id"), "url").join(ne, "doc_id", "left_semi")


def q_manifest_lines(spark, sf):
    return textformats.manifest_lines(_nonempty_pages(spark, sf))


def q_manifest_roundtrip(spark, sf):
    path = shared_scratch_path(spark, f"manifest-{uuid.uuid4().hex}")
    textformats.write_manifest(_nonempty_pages(spark, sf), path, append=True)
    return textformats.read_manifest(spark, path)


def q_token_log_lines(spark, sf):
    return textformats.token_log_lines(raw_tokens(spark, sf))


def q_token_log_roundtrip(spark, sf):
    path = shared_scratch_path(spark, f"tokenlog-{uuid.uuid4().hex}")
    read = docs(spark, sf)
    if ix.repeated_ids(ix.split_rejects(read)[0]):
        textformats.write_token_log(tokenize_docs(read), path)
    else:       # texts are moved, not the many times longer lines of their tokens
        textformats.write_token_log(tokenize_docs(textformats.ordered_texts(read)), path, in_order=True)
    return textformats.read_token_log(spark, path)


def q_nonempty_docs(spark, sf):
    return ix.nonempty_docs(docs(spark, sf))


def q_doc_limit(spark, sf):
    return ix.doc_limit(docs(spark, sf), DOC_LIMIT)


def q_dense_ids(spark, sf):
    return ix.dense_doc_ids(docs(spark, sf))


def q_vocab_cap(spark, sf):
    terms = ix.normalized_terms(raw_tokens(spark, sf))
    return postings_out(ix.build_postings(ix.vocabulary_cap(terms, VOCAB_CAPACITY)))


def q_rejects(spark, sf):
    fixed = spark.createDataFrame(REJECT_ROWS, "doc_id BIGINT, text STRING")
    return ix.split_rejects(tables.read_table(spark, sf, "documents").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text").unionByName(fixed))[1]


def q_page_rejects(spark, sf):
    pages = tables.read_table(spark, sf, "conversations").select(
        F.col("conv_id").cast("bigint").alias("doc_id"), F.col("turn").cast("bigint").alias("page_no"), "text")
    fixed = spark.createDataFrame(REJECT_PAGES, "doc_id BIGINT, page_no BIGINT, text STRING")
    return ix.split_page_rejects(pages.unionByName(fixed))[1]


def _streamed(spark, sf) -> str:
    out = shared_scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    q = ingest.start_ingest(spark, ingest.file_glob(tables.table_path(sf, "documents")), f"{out}/index", f"{out}/checkpoint")
    q.awaitTermination()
    return f"{out}/index"


def q_stream_ingest(spark, sf):
    return postings_out(ingest.compacted_postings(spark, _streamed(spark, sf)))


def q_stream_stats(spark, sf):
    return ix.collection_stats(ingest.compacted_index(spark, _streamed(spark, sf)))


CATALOG = {
    "tokens": q_tokens,
    "tokens_paged": q_tokens_paged,
    "remove_numbers": q_remove_numbers,
    "casefold": q_casefold,
    "stop30": q_stop30,
    "stop_rest": q_stop_rest,
    "porter_vocab": q_porter_vocab,
    "normalize_nostem": q_normalize_nostem,
    "normalize": q_normalize,
    "postings": q_postings,
    "merge_postings": q_merge_postings,
    "term_stats": q_term_stats,
    "collection_stats": q_collection_stats,
    "term_lookup": q_term_lookup,
    "term_dictionary": q_term_dictionary,
    "segment_ingest": q_segment_ingest,
    "capped_ingest": q_capped_ingest,
    "limited_ingest": q_limited_ingest,
    "arrival_numbers": q_arrival_numbers,
    "index_dump": q_index_dump,
    "postings_parts": q_postings_parts,
    "query_terms": q_query_terms,
    "query_postings": q_query_postings,
    "query_status": q_query_status,
    "and_query": q_and_query,
    "and_query_semijoin": q_and_query_semijoin,
    "and_blocks": q_and_blocks,
    "and_shared": q_and_shared,
    "and_shared_work": q_and_shared_work,
    "result_text": q_result_text,
    "result_parts": q_result_parts,
    "and_chain": q_and_chain,
    "session_parts": q_session_parts,
    "session_union": q_session_union,
    "session_text": q_session_text,
    "doc_term_matrix": q_doc_term_matrix,
    "tfidf": q_tfidf,
    "kmeans_assign": q_kmeans_assign,
    "kmeans_centroids": q_kmeans_centroids,
    "kmeans_seeds": q_kmeans_seeds,
    "kmeans_best": q_kmeans_best,
    "cluster_members": q_cluster_members,
    "cluster_member_parts": q_cluster_member_parts,
    "kmeans_ml_check": q_kmeans_ml_check,
    "cluster_top_terms": q_cluster_top_terms,
    "kmeans_ml_k2": _ml(2),
    "kmeans_ml_k10": _ml(10),
    "kmeans_ml_k20": _ml(20),
    "kmeans_guard": q_kmeans_guard,
    "cluster_report": q_cluster_report,
    "cluster_report_sql": q_cluster_report_sql,
    "links": q_links,
    "link_domain": q_link_domain,
    "link_class": q_link_class,
    "url_dedupe": q_url_dedupe,
    "seen_urls": q_seen_urls,
    "select_links": q_select_links,
    "url_filename": q_url_filename,
    "manifest_lines": q_manifest_lines,
    "manifest_roundtrip": q_manifest_roundtrip,
    "token_log_lines": q_token_log_lines,
    "token_log_roundtrip": q_token_log_roundtrip,
    "nonempty_docs": q_nonempty_docs,
    "doc_limit": q_doc_limit,
    "dense_ids": q_dense_ids,
    "vocab_cap": q_vocab_cap,
    "rejects": q_rejects,
    "page_rejects": q_page_rejects,
    "stream_ingest": q_stream_ingest,
    "stream_stats": q_stream_stats,
}
