
from pyspark.sql import functions as F

from quarry.functions.normalize import NO_STEM_TECHNIQUES
from quarry.operators import index as ix
from quarry.operators.positions import tokenize_docs, tokenize_pages
from quarry.operators.render import index_dump, postings_parts
from quarry.operators.store import block_rows

DOCS_A = [(1, "Open access. Open Access is open!"), (2, "Access denied; the door is open")]
DOCS_B = [(3, "Thank you for your interest."), (4, "Open  doors"), (5, "   ")]


def as_dict(postings):
    return {(r.term, r.doc_id): list(r.positions) for r in postings.collect()}


def test_postings_positions(spark, docs_factory):
    idx = ix.build_index(docs_factory(DOCS_A))
    p = as_dict(idx.postings)
    assert p[("open", 1)] == [1, 4, 7]
    assert p[("access", 1)] == [2, 5]
    assert p[("access", 2)] == [1]
    assert ("is", 1) not in p     # stop word, but it used position 6


def test_merge_equals_union_build(spark, docs_factory):
    a = ix.build_index(docs_factory(DOCS_A))
    b = ix.build_index(docs_factory(DOCS_B))
    both = ix.build_index(docs_factory(DOCS_A + DOCS_B))
    assert as_dict(ix.merge_postings(a.postings, b.postings)) == as_dict(both.postings)


def test_merge_same_doc_concatenates(spark, docs_factory):
    a = ix.build_index(docs_factory([(1, "open x")]))
    b = ix.build_index(docs_factory([(1, "y y open")]))
    assert as_dict(ix.merge_postings(a.postings, b.postings))[("open", 1)] == [1, 3]


def test_tf_sums_to_surviving_tokens(spark, docs_factory):
    d = docs_factory(DOCS_A + DOCS_B)
    idx = ix.build_index(d)
    n = ix.normalized_terms(tokenize_docs(d)).count()
    assert idx.postings.agg(F.sum("tf")).first()[0] == n


def test_docs_count_all_nonempty(spark, docs_factory):
    idx = ix.build_index(docs_factory(DOCS_A + DOCS_B + [(6, "the of and")]))
    assert sorted(r.doc_id for r in idx.docs.collect()) == [1, 2, 3, 4, 6]
    stats = ix.collection_stats(idx).first()
    assert stats.n_docs == 5


def test_paged_positions_run_across_pages(spark):
    pages = spark.createDataFrame(
        [(1, 1, "alpha beta"), (1, 2, "  "), (1, 3, "gamma alpha"), (2, 1, "   "), (3, 1, "the of"),
         (4, 1, None), (4, 2, "delta")],
        "doc_id BIGINT, page_no BIGINT, text STRING")
    toks = {(r.doc_id, r.pos): r.token for r in tokenize_pages(pages).collect()}
    assert toks == {(1, 1): "alpha", (1, 2): "beta", (1, 3): "gamma", (1, 4): "alpha",
                    (3, 1): "the", (3, 2): "of", (4, 1): "delta"}
    idx = ix.build_paged_index(pages, NO_STEM_TECHNIQUES)
    assert as_dict(idx.postings)[("alpha", 1)] == [1, 4]
    assert sorted(r.doc_id for r in idx.docs.collect()) == [1, 3, 4]


def test_index_dump_format(spark, docs_factory):
    idx = ix.build_index(docs_factory([(1, "open x open"), (3, "open")]))
    lines = {r.term: r.line for r in index_dump(idx.postings).collect()}
    assert lines["open"] == "open (2) --> 1[1, 3], 3[1]"


def test_doc_limit_and_dense_ids(spark, docs_factory):
    d = docs_factory([(10, "a"), (3, " "), (7, "b"), (42, "c"), (5, "d")])
    assert sorted(r.doc_id for r in ix.doc_limit(d, 2).collect()) == [5, 7]
    assert {r.doc_id: r.dense_id for r in ix.dense_doc_ids(d).collect()} == {5: 1, 7: 2, 10: 3, 42: 4}


def sequential_cap(terms_rows, capacity):
    """Brute force: index tokens one by one, stop when the vocabulary holds ``capacity`` terms."""
    vocab, kept = set(), []
    for doc, pos, term in sorted(terms_rows):
        if len(vocab) == capacity:
            break
        vocab.add(term)
        kept.append((doc, pos, term))
    return sorted(kept)


def test_vocabulary_cap_matches_sequential(spark, docs_factory):
    d = docs_factory([(1, "alpha beta alpha gamma"), (2, "beta delta epsilon alpha"), (3, "zeta eta alpha")])
    terms = ix.normalized_terms(tokenize_docs(d),
                                NO_STEM_TECHNIQUES)
    rows = [(r.doc_id, r.pos, r.term) for r in terms.collect()]
    for cap in [1, 2, 3, 4, 5, 6, 7, 100]:
        got = sorted((r.doc_id, r.pos, r.term) for r in ix.vocabulary_cap(terms, cap).collect())
        assert got == sequential_cap(rows, cap), cap


def test_rejects(spark):
    d = spark.createDataFrame([(1, "ok"), (None, "x"), (3, None)], "doc_id BIGINT, text STRING")
    good, bad = ix.split_rejects(d)
    assert [r.doc_id for r in good.collect()] == [1]
    assert sorted((r.doc_id or -1, r.reason) for r in bad.collect()) == [(-1, "null_id"), (3, "null_text")]


def test_write_read_index_prunes(spark, docs_factory, tmp_path):
    idx = ix.build_index(docs_factory(DOCS_A + DOCS_B))
    ix.write_index(idx, str(tmp_path / "idx"))
    back = ix.read_index(spark, str(tmp_path / "idx"))
    assert as_dict(back.postings) == as_dict(idx.postings)
    plan = back.postings.filter("term = 'open'").select("doc_id", "tf")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(term), EqualTo(term,open)]" in plan
    assert "ReadSchema: struct<term:string,doc_id:bigint,tf:bigint>" in plan


def test_nth_smallest(spark):
    from quarry.plans import ordering
    df = spark.range(1, 500).selectExpr("id * 3 AS a", "id % 7 AS b")
    assert ordering.nth_smallest(df, ["a"], 10) == (30,)
    assert ordering.nth_smallest(df, ["a"], 1000) is None
    assert ordering.nth_smallest(df, ["b", "a"], 499) == (6, 1490 - 2)


def test_page_rejects_are_atomic(spark):
    pages = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, None), (1, 3, "c"), (2, 1, "ok"), (None, 1, "x")],
        "doc_id BIGINT, page_no BIGINT, text STRING")
    good, bad = ix.split_page_rejects(pages)
    assert sorted((r.doc_id, r.page_no) for r in good.collect()) == [(2, 1)]
    assert sorted((r.doc_id or -1, r.page_no, r.reason) for r in bad.collect()) == [
        (-1, 1, "null_id"), (1, 1, "document_rejected"), (1, 2, "null_text"), (1, 3, "document_rejected")]


def test_written_index_keeps_documents_in_one_table(spark, docs_factory, tmp_path):
    idx = ix.build_index(docs_factory(DOCS_A + DOCS_B + [(6, "the of and"), (7, None)]))
    ix.write_index(idx, str(tmp_path / "one"), sort_by_term=False, positions=False)
    assert not (tmp_path / "one" / "docs").exists()
    back = ix.read_index(spark, str(tmp_path / "one"))
    assert sorted(r.doc_id for r in back.docs.collect()) == [1, 2, 3, 4, 6]
    assert sorted(r.doc_id for r in idx.docs.collect()) == [1, 2, 3, 4, 6]
    assert back.postings.filter("term IS NULL").count() == 0
    assert {(r.term, r.doc_id) for r in back.postings.collect()} == {(r.term, r.doc_id) for r in idx.postings.collect()}


def test_ordered_concat_across_buckets(spark):
    from quarry.operators.render import ordered_concat
    ids = [9000, 3, 4097, 12289, 4096, 1]
    df = spark.createDataFrame([(1, i, str(i)) for i in ids], "k BIGINT, o BIGINT, s STRING")
    row = ordered_concat(df, ["k"], "o", "s", ", ", "line", count_col="n").first()
    assert row.line == ", ".join(str(i) for i in sorted(ids)) and row.n == len(ids)


def _expected_positions(pages):
    """Brute force: 1-based positions running over each document's pages in page order."""
    import re as _re
    out, by_doc = {}, {}
    for d, p, t in pages:
        by_doc.setdefault(d, []).append((p, t))
    for d, ps in by_doc.items():
        pos = 0
        for _, t in sorted(ps):
            for tok in _re.findall(r"\S+", t or ""):
                pos += 1
                out[(d, pos)] = tok
    return out


def test_paged_offsets_across_buckets(spark, monkeypatch):
    from quarry.operators import positions
    pages = [(1, 1, "a b"), (1, 4095, "c"), (1, 4096, "d e f"), (1, 4097, ""), (1, 9000, "g"),
             (1, 12289, "h i"), (2, 5000, "x y"), (2, 3, "z")]
    df = spark.createDataFrame(pages, "doc_id BIGINT, page_no BIGINT, text STRING")
    got = {(r.doc_id, r.pos): r.token for r in positions.tokenize_pages(df).collect()}
    assert got == _expected_positions(pages)
    monkeypatch.setattr(positions, "PAGE_BUCKET", 2)
    many = [(7, p, " ".join(f"w{p}x{j}" for j in range(p % 3))) for p in range(1, 40)]
    df2 = spark.createDataFrame(many, "doc_id BIGINT, page_no BIGINT, text STRING")
    got2 = {(r.doc_id, r.pos): r.token for r in positions.tokenize_pages(df2).collect()}
    assert got2 == _expected_positions(many)


def test_capped_docs_and_merge_indexes(spark, docs_factory):
    d = docs_factory([(1, "alpha beta"), (2, "the of"), (3, "gamma delta"), (4, "epsilon")])
    terms = ix.normalized_terms(tokenize_docs(d), NO_STEM_TECHNIQUES)
    cut = ix.vocabulary_cut(terms, 3)
    assert cut == (3, 1)                                   # "gamma" is the third term
    assert sorted(r.doc_id for r in ix.capped_docs(d, cut).collect()) == [1, 2, 3]
    assert ix.vocabulary_cut(terms, 100) is None
    a = ix.build_index(docs_factory([(1, "alpha beta")]), NO_STEM_TECHNIQUES)
    b = ix.build_index(docs_factory([(1, "beta"), (2, "gamma")]), NO_STEM_TECHNIQUES)
    m = ix.merge_indexes(a, b)
    assert as_dict(m.postings)[("beta", 1)] == [1, 2]
    assert sorted(r.doc_id for r in m.docs.collect()) == [1, 2]


def test_repeated_and_unnumbered_pages_keep_their_tokens(spark):
    pages = spark.createDataFrame([(1, 1, "a b"), (1, 1, "c"), (2, None, "y z"), (2, 1, "x"), (None, 3, "n")],
                                  "doc_id BIGINT, page_no BIGINT, text STRING")
    got = sorted(((r.doc_id or 0, r.pos, r.token) for r in tokenize_pages(pages).collect()))
    assert got == [(0, 1, "n"), (1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "y"), (2, 2, "z"), (2, 3, "x")]
    assert sorted(r.doc_id for r in ix.build_paged_index(pages, quarantine=True).docs.collect()) == [1]


def test_index_written_over_another_holds_only_the_new_one(spark, docs_factory, tmp_path):
    path = str(tmp_path / "idx")
    merged = ix.merge_indexes(ix.build_index(docs_factory(DOCS_A)), ix.build_index(docs_factory(DOCS_B)))
    ix.write_index(merged, path)
    back = ix.read_index(spark, path)
    assert sorted(r.doc_id for r in back.docs.collect()) == [1, 2, 3, 4]
    assert as_dict(back.postings) == as_dict(merged.postings)
    ix.write_index(ix.build_index(docs_factory([(9, "open river")])), path)
    back = ix.read_index(spark, path)
    assert [r.doc_id for r in back.docs.collect()] == [9]
    assert as_dict(back.postings) == {("open", 9): [1], ("river", 9): [2]}


def test_bad_documents_stay_out_of_the_index(spark):
    d = spark.createDataFrame([(1, "open"), (None, "river"), (None, "river"), (3, None)], "doc_id BIGINT, text STRING")
    idx = ix.build_index(d)
    assert as_dict(idx.postings) == {("open", 1): [1]} and [r.doc_id for r in idx.docs.collect()] == [1]


def test_bounded_lines_cut_long_lists(spark, monkeypatch):
    from quarry.operators import render
    df = spark.createDataFrame([(1, i, str(i)) for i in (0, 5, 9, 10, 31)], "k BIGINT, o BIGINT, s STRING")
    got = sorted(tuple(r) for r in render.bounded_lines(df, ["k"], "o", "s", ",", bucket_width=10).collect())
    assert got == [(1, 0, 3, "0,5,9"), (1, 1, 1, "10"), (1, 3, 1, "31")]


def test_long_pages_are_cut_without_changing_tokens_or_positions(spark):
    import random

    from quarry.operators import positions

    rng = random.Random(6)
    bits = ["a.b.c", "1,000,000", "it's", "--", "...", "peer-reviewed", "Ünïcode", "日本語", "x", "\t", "\n\n", " ", " ", "(y)", "éé", "." * 9, "-" * 7]
    pages = [(d, p, "".join(rng.choice(bits) + rng.choice([" ", "", "\n", "  "]) for _ in range(rng.randrange(0, 60)))) for d in range(4) for p in range(5)]
    pages += [(9, 1, "word " * 40), (9, 1, "other word " * 30), (9, 2, "no_space" * 50), (9, 3, None), (9, 4, "end")]
    df = spark.createDataFrame(pages, "doc_id BIGINT, page_no BIGINT, text STRING")
    whole = sorted(tuple(r) for r in tokenize_pages(df).collect())
    for size in (1, 7, 50):
        assert sorted(tuple(r) for r in tokenize_pages(df, piece_chars=size).collect()) == whole
    cut = positions.page_pieces(df.filter("doc_id = 9"), piece_chars=20).collect()
    assert max(len(r.part) for r in cut if "no_space" not in r.part) <= 20 + len("other")
    assert "".join(r.part for r in sorted((r for r in cut if r.page_no == 4), key=lambda r: r.piece)) == "end"


def test_grouped_in_place_equals_the_shuffled_postings(spark, docs_factory):
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 11}" for j in range(i % 40))) for i in range(300)] + [(900, "x y " * 500), (901, None), (902, "the of")]
    docs = docs_factory(rows)
    want = sorted((r.term or "", r.doc_id, list(r.positions), r.tf) for r in ix.build_index(docs).combined.collect())
    got = ix.build_index(docs, unique_ids=True)
    assert sorted((r.term or "", r.doc_id, list(r.positions), r.tf) for r in got.combined.collect()) == want
    assert got.combined.schema.simpleString() == "struct<term:string,doc_id:bigint,positions:array<bigint>,tf:bigint>"
    assert "Exchange" not in got.postings._jdf.queryExecution().executedPlan().toString()
    terms = ix.normalized_terms(ix.tokenize_docs(docs.coalesce(1)))
    for n in (1, 64, 1000):     # documents that end within, at and beyond a piece
        small = sorted((r.term, r.doc_id, list(r.positions), r.tf) for r in ix.grouped_in_place(terms, n).collect())
        assert small == [x for x in want if x[0]]


def test_repeated_ids(docs_factory):
    assert ix.repeated_ids(docs_factory([(1, "a"), (1, "b")])) and not ix.repeated_ids(docs_factory([(1, "a"), (2, "a")]))


def test_a_build_stems_distinct_words_not_tokens(spark, docs_factory):
    docs = docs_factory([(i, f"Generalizations of relational happiness {i % 3} ponies, sky hopping! word{i} ponies") for i in range(60)])
    want = as_dict(ix.build_postings(ix.normalized_terms(tokenize_docs(docs))))     # the stemmer as column expressions
    pages = docs.withColumn("page_no", F.lit(1).cast("bigint"))
    for idx in (ix.build_index(docs, unique_ids=True), ix.build_paged_index(pages)):
        assert as_dict(idx.postings) == want
        assert "__pw" not in idx.postings._jdf.queryExecution().optimizedPlan().toString()
    few = ix.stemmed(ix.normalized_terms(tokenize_docs(docs), NO_STEM_TECHNIQUES).repartition(1), limit=1)
    assert as_dict(ix.build_postings(few)) == want


def test_blocks_and_lines_are_grouped_after_the_shuffle(spark, docs_factory):
    postings = ix.build_index(docs_factory(DOCS_A + DOCS_B), unique_ids=True).postings
    for df in (block_rows(postings, 1, "term"), postings_parts(postings)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and plan.rindex("ObjectHashAggregate") < plan.index("Exchange hashpartitioning")
