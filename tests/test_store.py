import random
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.functions.normalize import NO_STEM_TECHNIQUES
from quarry.operators import index as ix
from quarry.operators import search, store

WORDS = ["open", "access", "door", "window", "river", "stone", "cloud", "paper", "light", "sound"]


def scratch():
    return tempfile.mkdtemp(prefix="quarry-test-") + "/index"


def texts(n, seed, first=0):
    rng = random.Random(seed)
    return [(first + i, " ".join(rng.choice(WORDS) + str(rng.randrange(3) or "") for _ in range(rng.randrange(0, 7)))) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING")


def content(index):
    return {(r.term, r.doc_id): (r.tf, list(r.positions)) for r in index.postings().collect()}


def expected(spark, rows):
    built = ix.build_index(frame(spark, rows))
    return {(r.term, r.doc_id): (r.tf, list(r.positions)) for r in built.postings.collect()}


def test_deliveries_equal_one_build_and_ids_stay(spark):
    path, now, ids, numbers = scratch(), {}, {}, {}
    rng = random.Random(5)
    for b in range(6):
        rows = texts(8, b, first=8 * b - 20) + [(rng.randrange(-20, 8 * b - 12), "open again %d" % b)]    # one comes again
        rows = list(dict(rows).items())
        store.commit(spark, path, frame(spark, rows), batch_id=b, fanout=3)
        now.update(rows)
        snap = store.snapshot(spark, path)
        seen = {r.term: r.term_id for r in snap.dictionary.collect()}
        assert ids.items() <= seen.items() and sorted(seen.values()) == list(range(1, len(seen) + 1))
        nos = {r.doc_id: r.doc_no for r in snap.numbers.collect()}
        assert numbers.items() <= nos.items() and sorted(nos.values()) == list(range(1, len(nos) + 1))
        assert len(snap.manifest["segments"]) <= 2 * 2 and len(snap.manifest["dictionary"]) <= 2 * 2
        ids, numbers = seen, nos
    assert content(snap) == expected(spark, list(now.items()))
    assert {r.doc_id for r in snap.docs.collect()} == {d for d, t in now.items() if t}
    stats = {(r.term, r.df, r.cf) for r in snap.term_stats().collect()}
    assert stats == {(r.term, r.df, r.cf) for r in ix.term_stats(ix.build_index(frame(spark, list(now.items()))).postings).collect()}
    # the same after everything is merged, and after the folders of old generations are gone
    store.compact(spark, path, fanout=2)
    store.vacuum(spark, path)
    last = store.snapshot(spark, path)
    assert content(last) == content(snap := last) == expected(spark, list(now.items()))
    assert {r.term: r.term_id for r in last.dictionary.collect()} == ids


def test_replay_and_failure_before_the_commit_change_nothing(spark, monkeypatch):
    path = scratch()
    store.commit(spark, path, frame(spark, [(1, "open river"), (2, "stone")]), batch_id=0)
    before = store.snapshot(spark, path)
    kept = content(before)
    assert store.commit(spark, path, frame(spark, [(9, "other text")]), batch_id=0)["generation"] == before.manifest["generation"]

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:      # everything written but the manifest
        m.setattr(store, "publish", fails)
        with pytest.raises(RuntimeError):
            store.commit(spark, path, frame(spark, [(1, "new words"), (3, "cloud")]), batch_id=1)
    assert content(store.snapshot(spark, path)) == kept
    store.commit(spark, path, frame(spark, [(1, "new words"), (3, "cloud")]), batch_id=1)
    assert content(before) == kept        # a reader of the old generation still sees all of it
    after = store.snapshot(spark, path)
    assert {k for k in content(after)} == {("new", 1), ("word", 1), ("stone", 2), ("cloud", 3)}
    assert {r.doc_id: r.doc_no for r in after.numbers.collect()} == {1: 1, 2: 2, 3: 3}
    assert store.vacuum(spark, path) > 0   # the failed delivery's folders
    assert content(store.snapshot(spark, path)) == content(after)


def test_second_writer_is_refused(spark):
    path = scratch()
    m = store.commit(spark, path, frame(spark, [(1, "open")]))
    with pytest.raises(store.ConcurrentCommit):
        store.publish(spark, path, m)


def test_withdrawn_empty_and_rejected_documents_disappear(spark):
    path = scratch()
    store.commit(spark, path, frame(spark, [(1, "open"), (2, "open river"), (3, "stone"), (4, "light")]), batch_id=0)
    gone = frame(spark, [(4, None)]).select("doc_id")
    store.commit(spark, path, frame(spark, [(1, ""), (2, None), (None, "x")]), batch_id=1, withdrawn=gone)
    snap = store.snapshot(spark, path)
    assert content(snap) == expected(spark, [(3, "stone")])
    assert [tuple(r) for r in snap.term_stats().collect()] == [("stone", 1, 1)]
    assert sorted((r.doc_id or 0, r.reason, r.batch_id) for r in snap.rejects.collect()) == [(0, "null_id", 1), (2, "null_text", 1)]
    queries = spark.createDataFrame([(1, "open"), (2, "stone"), (3, "the")], "query_id BIGINT, query STRING")
    qterms = search.query_terms(queries)
    ids = search.query_ids(qterms, snap)
    hits = search.and_blocks(qterms, snap, ids)
    status = {r.query_id: r.status for r in search.block_status(queries, qterms, hits, ids).collect()}
    assert status == {1: "missing_term", 2: "hits", 3: "invalid"}


@pytest.mark.parametrize("sizes, capacities", [([40], (1, 500)), ([7, 33], (6,)), ([1, 2, 7, 30], (17,))])
def test_capacity_while_documents_arrive(spark, sizes, capacities):
    rows = texts(40, 9)
    for capacity in capacities:
        terms = ix.normalized_terms(ix.tokenize_docs(frame(spark, rows)))
        want = {(r.term, r.doc_id): (r.tf, list(r.positions)) for r in ix.build_postings(ix.vocabulary_cap(terms, capacity)).collect()}
        docs = {r.doc_id for r in ix.capped_docs(frame(spark, rows), ix.vocabulary_cut(terms, capacity)).collect()}
        path, lo = scratch(), 0
        for b, n in enumerate(sizes):
            for _ in range(2):      # each is replayed
                store.commit(spark, path, frame(spark, rows[lo:lo + n]), batch_id=b, capacity=capacity)
            lo += n
        snap = store.snapshot(spark, path)
        assert content(snap) == want
        assert {r.doc_id for r in snap.docs.collect()} == docs
        assert snap.dictionary.count() == min(capacity, len({t for t, _ in expected(spark, rows)}))


def test_document_limit_while_documents_arrive(spark):
    rows = texts(30, 4)
    want = [r.doc_id for r in ix.doc_limit(frame(spark, rows), 11).orderBy("doc_id").collect()]
    path = scratch()
    for b, lo in enumerate(range(0, 30, 7)):
        store.commit(spark, path, frame(spark, rows[lo:lo + 7]), batch_id=b, limit=11)
    snap = store.snapshot(spark, path)
    assert sorted(r.doc_id for r in snap.docs.collect()) == want
    assert {r.doc_id: r.doc_no for r in snap.numbers.collect()} == {d: i + 1 for i, d in enumerate(want)}


def test_conjunctions_on_blocks_equal_the_division(spark):
    rng = random.Random(3)
    rows = [(d * 700 - 9000, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 8)))) for d in range(60)]
    path = scratch()
    for b in range(3):
        store.commit(spark, path, frame(spark, rows[b * 20:b * 20 + 20] + [(rows[0][0], f"open stone batch{b}")] * (b > 0)), batch_id=b, techniques=NO_STEM_TECHNIQUES)
    snap = store.snapshot(spark, path)
    queries = spark.createDataFrame([(i, " ".join(rng.sample(WORDS, rng.randint(1, 4)))) for i in range(30)] + [(99, "open zebra"), (98, "the")],
                                    "query_id BIGINT, query STRING")
    qterms = search.query_terms(queries, NO_STEM_TECHNIQUES)
    got = sorted(tuple(r) for r in search.and_blocks(qterms, snap).collect())
    assert got == sorted(tuple(r) for r in search.and_division(qterms, snap.postings()).collect())
    assert len(got) > 30


def test_a_rare_term_reads_few_blocks_of_a_frequent_one(spark):
    rows = [(d, "common words here" + (" needle" if d in (5000, 61_000) else "")) for d in range(0, 80_000, 40)]
    path = scratch()
    store.commit(spark, path, frame(spark, rows), techniques=NO_STEM_TECHNIQUES)
    snap = store.snapshot(spark, path)
    qterms = search.query_terms(spark.createDataFrame([(1, "common needle")], "query_id BIGINT, query STRING"), NO_STEM_TECHNIQUES)
    ids = {r.term: r.term_id for r in search.query_ids(qterms, snap).collect()}
    every = snap.blocks.filter(F.col("term_id") == ids["common"]).count()
    touched = [r.block for r in search.touched_blocks(qterms, snap).filter(F.col("term_id") == ids["common"]).collect()]
    assert every == 20 and sorted(touched) == [1, 14]
    hits = search.and_blocks(qterms, snap)
    assert sorted(r.doc_id for r in hits.collect()) == [5000, 61_000]
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "In(block, [1,14])" in plan and "In(term_id" in plan      # pushed into the scan
    assert {r.doc_id for r in snap.lookup("needle").collect()} == {5000, 61_000} and snap.lookup("zebra").count() == 0


def test_rows_of_one_block_are_joined_by_one_shuffle(spark):
    rng = random.Random(8)
    postings = [(t, d, sorted(rng.sample(range(1, 50), rng.randint(1, 4)))) for t in range(1, 30) for d in rng.sample(range(-9000, 9000), 60)]
    long = spark.createDataFrame([(t, d, p, len(p)) for t, d, p in postings], "term_id BIGINT, doc_id BIGINT, positions ARRAY<BIGINT>, tf BIGINT")
    parts = {}          # each block comes in up to five rows, whose documents lie between each other
    for t, d, p in sorted(postings):
        parts.setdefault((t, d >> store.BLOCK_BITS, rng.randrange(5)), []).append((d & (store.BLOCK_DOCS - 1), len(p), p))
    rows = [(t, b, *map(list, zip(*e))) for (t, b, _), e in parts.items()]
    rng.shuffle(rows)
    staged = spark.createDataFrame(rows, "term_id BIGINT, block BIGINT, docs ARRAY<INT>, tfs ARRAY<BIGINT>, positions ARRAY<ARRAY<BIGINT>>")
    with_batches = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for n in ("2", with_batches):       # blocks that run across batches
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
            joined = store.joined_blocks(staged.repartition(3), 7)
            cols = joined.columns
            assert sorted(map(str, joined.collect())) == sorted(map(str, store.block_rows(long, 7).select(*cols).collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", with_batches)
    assert store.joined_blocks(staged, 7)._jdf.queryExecution().executedPlan().toString().count("Exchange rangepartitioning") == 1
    assert store.joined_blocks(staged.limit(0), 7).count() == 0


def test_a_delivery_stages_blocks_and_its_terms_are_named_by_block(spark, monkeypatch):
    """A frequent term reaches the shuffles of a delivery, and of a reader, as rows of many documents."""
    seen, joined_blocks = [], store.joined_blocks

    def watched(rows, gen):
        seen.append((rows.count(), rows.agg(F.sum(F.size("docs"))).first()[0]))
        return joined_blocks(rows, gen)

    monkeypatch.setattr(store, "joined_blocks", watched)
    path, rows = scratch(), [(d, "common words here") for d in range(2000)]
    store.commit(spark, path, frame(spark, rows), batch_id=0, techniques=NO_STEM_TECHNIQUES)
    (n, postings), = seen
    assert postings == 2000 * len(ix.normalized_terms(ix.tokenize_docs(frame(spark, rows[:1])), NO_STEM_TECHNIQUES).collect())
    assert n <= postings / 100
    plan = store.snapshot(spark, path).postings()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")      # the join lies below


def test_blocks_of_any_group_size_hold_the_same_postings(spark):
    rows = texts(60, 3, first=-20) + [(9000 + d, "open door open") for d in range(5)]
    terms = ix.marked_terms(frame(spark, rows), NO_STEM_TECHNIQUES)
    want = sorted((r.term or "", r.doc_id, r.tf, list(r.positions)) for r in ix.grouped_in_place(terms).collect())
    for n in (1, 7, 1 << 20):
        blocks = ix.blocked_in_place(terms, store.BLOCK_BITS, n)
        assert sorted((r.term or "", r.doc_id, r.tf, list(r.positions)) for r in store.entry_rows(blocks, "term").collect()) == want
        assert all(list(r.docs) == sorted(set(r.docs)) for r in blocks.collect())
