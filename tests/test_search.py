import random

from quarry.functions.normalize import NO_STEM_TECHNIQUES
from quarry.operators import index as ix
from quarry.operators import search, store
from quarry.operators.render import result_text, session_text

WORDS = ["open", "access", "door", "window", "river", "stone", "cloud", "paper", "light", "sound"]


def corpus(n=60, seed=7):
    rnd = random.Random(seed)
    return [(i, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 8)))) for i in range(n)]


def brute(docs, query_terms):
    sets = [{d for d, t in docs if w in t.split()} for w in query_terms]
    return sorted(set.intersection(*sets)) if sets else []


def test_and_query_matches_brute_force(spark, docs_factory):
    docs = corpus()
    idx = ix.build_index(docs_factory(docs), NO_STEM_TECHNIQUES)
    rnd = random.Random(3)
    qs = [(i, " ".join(rnd.sample(WORDS, rnd.randint(1, 3)))) for i in range(30)]
    queries = spark.createDataFrame(qs, "query_id BIGINT, query STRING")
    qterms = search.query_terms(queries, NO_STEM_TECHNIQUES)
    for hits in (search.and_division(qterms, idx.postings),
                 search.and_rarest_first(qterms, idx.postings)):
        got = {}
        for r in hits.collect():
            got.setdefault(r.query_id, []).append(r.doc_id)
        for qid, q in qs:
            assert sorted(got.get(qid, [])) == brute(docs, q.split()), q


def test_statuses(spark, docs_factory):
    idx = ix.build_index(docs_factory([(1, "Open access"), (50, "Thank you for your interest.")]))
    qs = [(1, "open access"), (2, "accessible"), (3, "thank interest"), (4, "open interest"),
          (5, "open zebra"), (6, "the of"), (7, "Open OPEN open"), (8, "   ")]
    queries = spark.createDataFrame(qs, "query_id BIGINT, query STRING")
    qterms = search.query_terms(queries)
    hits = search.and_rarest_first(qterms, idx.postings)
    st = {r.query_id: (r.status, r.n_hits) for r in search.query_status(queries, qterms, hits, idx.postings).collect()}
    assert st == {1: ("hits", 1), 2: ("hits", 1), 3: ("hits", 1), 4: ("empty", 0), 5: ("missing_term", 0),
                  6: ("invalid", 0), 7: ("hits", 1), 8: ("invalid", 0)}
    lines = {r.query_id: r.line for r in result_text(search.query_status(queries, qterms, hits, idx.postings), hits).collect()}
    assert lines[3] == "Retrieved Document IDs (1): 50"
    assert lines[5] == "No documents returned."
    assert session_text(search.session_union(hits)).first().line == "Documents retrieved (2): 1, 50"


def test_session_text_empty(spark):
    empty = spark.createDataFrame([], "query_id BIGINT, doc_id BIGINT")
    assert session_text(search.session_union(empty)).first().line == \
        "No documents were retrieved during your session."


def test_query_postings_zero_based(spark):
    queries = spark.createDataFrame([(1, "the open and access")], "query_id BIGINT, query STRING")
    rows = search.query_postings(search.query_terms(queries)).orderBy("qpos").collect()
    assert [(r.term, r.qpos) for r in rows] == [("open", 0), ("access", 1)]


def test_and_chain_matches_brute_force(spark, docs_factory):
    docs = corpus(seed=11)
    idx = ix.build_index(docs_factory(docs), NO_STEM_TECHNIQUES)
    for q in (["open", "river"], ["stone"], ["cloud", "paper", "light"], ["open", "open"]):
        got = sorted(r.doc_id for r in search.and_chain(q, idx.postings).collect())
        assert got == brute(docs, q)
    assert search.and_chain(["open", "zebra"], idx.postings) is None
    assert search.and_chain([], idx.postings) is None


def test_query_words_pushed_into_stored_index(spark, docs_factory, tmp_path):
    docs = corpus(seed=5)
    idx = ix.build_index(docs_factory(docs), NO_STEM_TECHNIQUES)
    ix.write_index(idx, str(tmp_path / "idx"), sort_by_term=True, positions=False)
    stored = ix.read_index(spark, str(tmp_path / "idx"))
    queries = spark.createDataFrame([(1, "open river"), (2, "stone")], "query_id BIGINT, query STRING")
    qterms = search.query_terms(queries, NO_STEM_TECHNIQUES)
    rel = search.query_word_postings(qterms, stored.postings)
    plan = rel._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "In(term" in plan
    hits = {(r.query_id, r.doc_id) for r in search.and_division(qterms, stored.postings).collect()}
    want = {(1, d) for d in brute(docs, ["open", "river"])} | {(2, d) for d in brute(docs, ["stone"])}
    assert hits == want


def test_large_batch_paths_match_brute_force(spark, docs_factory, monkeypatch, request):
    """Force the paths taken when the batch is too large to broadcast or to list as literals."""
    docs = corpus(seed=13)
    idx = ix.build_index(docs_factory(docs), NO_STEM_TECHNIQUES)
    rnd = random.Random(9)
    qs = [(i, " ".join(rnd.sample(WORDS, rnd.randint(1, 3)))) for i in range(20)]
    queries = spark.createDataFrame(qs, "query_id BIGINT, query STRING")
    qterms = search.query_terms(queries, NO_STEM_TECHNIQUES)
    monkeypatch.setattr(search, "PUSHDOWN_MAX_WORDS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    for hits in (search.and_division(qterms, idx.postings), search.and_rarest_first(qterms, idx.postings)):
        got = {}
        for r in hits.collect():
            got.setdefault(r.query_id, []).append(r.doc_id)
        for qid, q in qs:
            assert sorted(got.get(qid, [])) == brute(docs, q.split()), q


def test_shared_beginnings_are_intersected_once(spark, docs_factory, tmp_path):
    """Hits as one by one; the lists met per level are counted by hand on the prefix tree."""
    docs = [(d * 1500, t) for d, t in corpus(80, seed=21)]  # several ranges of documents
    store.commit(spark, str(tmp_path / "idx"), docs_factory(docs), batch_id=0, techniques=NO_STEM_TECHNIQUES)
    index = store.snapshot(spark, str(tmp_path / "idx"))
    rnd = random.Random(4)
    qs = [(i, " ".join(rnd.sample(WORDS[:6], rnd.randint(1, 5)))) for i in range(60)] + [(100, "open zebra"), (101, "the"), (102, "")]
    qterms = search.query_terms(spark.createDataFrame(qs, "query_id BIGINT, query STRING"), NO_STEM_TECHNIQUES)
    hits, work = search.and_shared(qterms, index)
    pairs = [(r.query_id, r.doc_id) for r in hits.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(i, d) for i, q in qs[:60] for d in brute(docs, q.split())}
    assert set(pairs) == {tuple(r) for r in search.and_blocks(qterms, index).collect()}

    holds = {w: {d for d, t in docs if w in t.split()} for w in WORDS}
    order = {w: (len(holds[w]), w) for w in WORDS}  # ids are given in the order of the words
    asked = []
    for _, q in qs[:60]:
        path = tuple(sorted(q.split(), key=order.get))
        for block in {d // 4096 for d, _ in docs}:
            lists = [{d for d in holds[w] if d // 4096 == block} for w in path]
            if all(lists) and max(map(min, lists)) <= min(map(max, lists)):
                asked.append((path, block, lists))
    paths = {p for p, _, _ in asked}
    after = {}
    for p in paths:
        for i in range(1, len(p) + 1):
            after.setdefault(p[:i], set()).add(p[i] if i < len(p) else None)
    once, alone = {}, {}
    for p, block, lists in asked:
        since = 0
        nodes = [i for i in range(1, len(p) + 1) if len(after[p[:i]]) > 1 or None in after[p[:i]]]
        for level, i in enumerate(nodes, 1):
            if since and not set.intersection(*lists[:since]):
                break
            n = i - since - (level == 1)
            once.setdefault(level, {})[p[:i], block] = n
            alone[level] = alone.get(level, 0) + n
            since = i
    want = {k: (sum(v.values()), alone[k]) for k, v in once.items()}
    got = {r.level: (r.n_shared, r.n_alone) for r in work.collect()}
    assert got == want and len(want) > 2 and sum(a for a, _ in want.values()) < sum(b for _, b in want.values())


def test_shared_beginnings_without_queries_or_documents(spark, docs_factory, tmp_path):
    store.commit(spark, str(tmp_path / "idx"), docs_factory([(1, "open river"), (2, "open")]), batch_id=0)
    index = store.snapshot(spark, str(tmp_path / "idx"))
    none = search.query_terms(spark.createDataFrame([], "query_id BIGINT, query STRING"))
    assert [f.count() for f in search.and_shared(none, index)] == [0, 0]
    one = search.query_terms(spark.createDataFrame([(1, "open"), (2, "zebra")], "query_id BIGINT, query STRING"))
    hits, work = search.and_shared(one, index)
    assert {tuple(r) for r in hits.collect()} == {(1, 1), (1, 2)}
    assert [tuple(r) for r in work.collect()] == [(1, 0, 0)]


def test_chain_fetches_the_postings_of_its_own_words(spark, tmp_path):
    from quarry.plans import catalog
    spark.createDataFrame([(1, "ha th st open"), (2, "ha th"), (3, "open river")], "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "open river")], "item_id BIGINT, text STRING").write.parquet(str(tmp_path / "benchmark.parquet"))
    terms, postings = catalog._word_postings(spark, str(tmp_path), catalog.CHAIN_QUERY_ID)
    assert {r.query_id for r in terms.collect()} == {catalog.CHAIN_QUERY_ID}
    assert {r.term for r in postings.collect()} == {"ha", "th", "st"}
    assert [r.doc_id for r in catalog.q_and_chain(spark, str(tmp_path)).collect()] == [1]
