import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.functions.normalize import NO_STEM_TECHNIQUES
from quarry.operators import cluster, index as ix, tfidf

DOCS = [(1, "apple banana apple"), (2, "banana cherry"), (3, "cherry cherry date"), (4, "the of"),
        (5, "apple date"), (6, "elder fig fig"), (7, "fig grape"), (8, "apple banana apple")]


@pytest.fixture(scope="module")
def weights(spark):
    d = spark.createDataFrame(DOCS, "doc_id BIGINT, text STRING")
    idx = ix.build_index(d, NO_STEM_TECHNIQUES)
    return idx, tfidf.tfidf(idx)


def test_tfidf_matches_formula(weights):
    idx, w = weights
    docs = {d: t.split() for d, t in DOCS if d != 4}
    n = len(DOCS)   # doc 4 has raw tokens, so it counts
    df = Counter(t for ts in docs.values() for t in set(ts))
    got = {(r.doc_id, r.term): r.w for r in w.collect()}
    for d, ts in docs.items():
        raw = {t: c * (math.log((1 + n) / (1 + df[t])) + 1) for t, c in Counter(ts).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        for t, v in raw.items():
            assert got[(d, t)] == pytest.approx(v / norm, abs=1e-12)


def test_unit_norm(weights):
    _, w = weights
    for r in w.groupBy("doc_id").agg(F.sum(F.col("w") * F.col("w")).alias("s")).collect():
        assert r.s == pytest.approx(1.0)


def test_doc_term_matrix_keeps_zero_rows(weights):
    idx, _ = weights
    m = tfidf.doc_term_matrix(idx)
    zero = [r for r in m.collect() if r.term is None]
    assert [(r.doc_id, r.tf) for r in zero] == [(4, 0)]


def test_doc_term_matrix_reads_the_text_once(spark, docs_factory):
    plan = tfidf.doc_term_matrix(ix.build_index(docs_factory(DOCS)))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "RLIKE" not in plan


def test_kmeans_sql_invariants(spark, weights):
    idx, w = weights
    labels, cents = cluster.kmeans_sql(w, idx.docs, 3, 2)
    lab = {r.doc_id: r.cluster for r in labels.collect()}
    assert set(lab) == {d for d, _ in DOCS}
    assert all(0 <= c < 3 for c in lab.values())
    assert lab[1] == lab[8]                                  # identical documents
    labels2, _ = cluster.kmeans_sql(w, idx.docs, 3, 2)
    assert {r.doc_id: r.cluster for r in labels2.collect()} == lab   # deterministic
    lines = {r.cluster: r.line for r in cluster.members_lines(spark, labels, 4).collect()}
    assert lines[3] == "Cluster 3: No documents"
    tops = cluster.top_terms_lines(cents).collect()
    assert all(": " in r.line for r in tops)


def test_kmeans_ml(spark, weights):
    idx, w = weights
    labels, cents, model = cluster.kmeans_ml(w, idx.docs, 2)
    lab = {r.doc_id: r.cluster for r in labels.collect()}
    assert set(lab) == {d for d, _ in DOCS} and set(lab.values()) <= {0, 1}


def test_guard(spark, weights):
    idx, _ = weights
    rows = cluster.guard_lines(spark, idx.docs, (2, 10, 20)).collect()
    assert [r.k for r in rows] == [2, 10]
    assert rows[1].line.startswith("Error: Cannot perform k-means clustering when k > total documents collected.")
    assert rows[1].line.endswith("(k = 10; Total Documents Collected = 8)")


def test_cluster_report_layout(spark, weights):
    idx, w = weights
    rep = cluster.cluster_report(spark, w, idx.docs, (2, 10))
    rows = sorted(rep.collect(), key=lambda r: (r.k, r.section, r.cluster))
    assert rows[0].line == "k = 2"
    members = [r.line for r in rows if r.k == 2 and r.section == 1]
    assert len(members) == 2 and all(m.startswith(f"Cluster {i}: ") for i, m in enumerate(members))
    assert rows[-1].k == 10 and rows[-1].line.startswith("Error: Cannot perform k-means clustering")
    tops = [r.line for r in rows if r.k == 2 and r.section == 2]
    assert tops[0].startswith("Cluster 0:\n")


def sse(weights, labels, cents):
    """Sum over documents of the squared distance to their centroid (zero rows included)."""
    w = {}
    for r in weights.collect():
        w.setdefault(r.doc_id, {})[r.term] = r.w
    c = {}
    for r in cents.collect():
        c.setdefault(r.cluster, {})[r.term] = r.w
    total = 0.0
    for r in labels.collect():
        x, m = w.get(r.doc_id, {}), c.get(r.cluster, {})
        total += sum((x.get(t, 0.0) - m.get(t, 0.0)) ** 2 for t in set(x) | set(m))
    return total


def test_kmeans_sql_cost_does_not_increase(spark, weights):
    idx, w = weights
    costs = []
    for it in range(0, 4):
        labels, cents = cluster.kmeans_sql(w, idx.docs, 3, it)
        costs.append(sse(w, labels, cluster.centroids_of(w, labels)))
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:])), costs


def test_kmeans_sql_stops_at_a_fixed_point(spark, weights):
    idx, w = weights
    labels, cents = cluster.kmeans_sql(w, idx.docs, 3)
    lab = {r.doc_id: r.cluster for r in labels.collect()}
    again = {r.doc_id: r.cluster for r in cluster.assign(w, idx.docs, cents, 3).collect()}
    means = {(r.cluster, r.term): r.w for r in cluster.centroids_of(w, labels).collect()}
    assert again == lab
    got = {(r.cluster, r.term): r.w for r in cents.collect() if r.cluster in set(lab.values())}
    assert set(got) == set(means) and all(abs(got[k] - means[k]) < 1e-12 for k in got)


def test_assign_equals_brute_force(spark, weights):
    idx, w = weights
    cents = cluster.centroids_of(w, cluster.seeds(w, 4))
    x, c = {}, {}
    for r in w.collect():
        x.setdefault(r.doc_id, {})[r.term] = r.w
    for r in cents.collect():
        c.setdefault(r.cluster, {})[r.term] = r.w
    for r in cluster.assign(w, idx.docs, cents, 4).collect():
        v = x.get(r.doc_id, {})
        score = {k: round(sum(a * a for a in m.values()) - 2 * sum(v.get(t, 0) * a for t, a in m.items()), 9) for k, m in c.items()}
        assert r.cluster == min(score, key=lambda k: (score[k], k))


def test_ml_invariants_hold(spark, weights):
    idx, w = weights
    rows = cluster.ml_invariants(spark, w, idx.docs, (2, 3, 10)).collect()
    assert [tuple(r) for r in rows] == [(2, 8, True, True), (3, 8, True, True)]


def test_vectors_need_no_python(spark, weights):
    idx, w = weights
    vectors = cluster.ml_vectors(w, idx.docs)
    plan = vectors._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = {r.doc_id: r.features for r in vectors.collect()}
    assert got[4].numNonzeros() == 0 and abs(got[1].norm(2) - 1) < 1e-9


def test_cluster_report_sql_guard(spark, weights):
    idx, w = weights
    rows = sorted(cluster.cluster_report_sql(spark, w, idx.docs, (2, 10, 20)).collect(),
                  key=lambda r: (r.k, r.section, r.cluster))
    assert [r.k for r in rows].count(20) == 0
    assert rows[-1].k == 10 and rows[-1].line.endswith("(k = 10; Total Documents Collected = 8)")
    assert [r.line for r in rows if r.k == 2 and r.section == 0] == ["k = 2"]


def test_top_terms_two_level_matches_brute_force(spark):
    import random as _r
    rnd = _r.Random(4)
    rows = [(c, f"t{i:03d}", float(rnd.choice([0.5, 0.25, 0.125, rnd.random()])))
            for c in range(3) for i in range(120)]
    cents = spark.createDataFrame(rows, "cluster BIGINT, term STRING, w DOUBLE")
    got = {}
    for r in cluster.top_terms(cents, n=7, salt=4).collect():
        got.setdefault(r.cluster, []).append((r.rank, r.term))
    for c in range(3):
        want = sorted([(t, w) for cc, t, w in rows if cc == c and w > 0], key=lambda x: (-round(x[1], 9), x[0]))[:7]
        assert [t for _, t in sorted(got[c])] == [t for t, _ in want]


def test_shuffle_join_paths_equal_broadcast_paths(spark, weights, request):
    idx, w = weights
    base_w = {(r.doc_id, r.term): r.w for r in w.collect()}
    base_l, _ = cluster.kmeans_sql(w, idx.docs, 3, 2)
    base_labels = {r.doc_id: r.cluster for r in base_l.collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    w2 = tfidf.tfidf(idx)
    got = {(r.doc_id, r.term): r.w for r in w2.collect()}
    assert set(got) == set(base_w) and all(abs(got[k] - base_w[k]) < 1e-12 for k in got)
    l2, _ = cluster.kmeans_sql(w2, idx.docs, 3, 2)
    assert {r.doc_id: r.cluster for r in l2.collect()} == base_labels


def test_ml_labels_beyond_the_bound_of_dense_centres(spark, tmp_path, monkeypatch):
    from quarry.operators import store
    rows = [(d, " ".join(f"{home}{(d * 7 + j) % 5}" for j in range(3) for home in ("red", "blue")[d % 2:d % 2 + 1])) for d in range(30)]
    store.commit(spark, str(tmp_path / "i"), spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), batch_id=0)
    idx = store.snapshot(spark, str(tmp_path / "i"))
    tfidf.stored_vectors(idx).write.parquet(str(tmp_path / "v"))
    vectors = spark.read.parquet(str(tmp_path / "v"))
    monkeypatch.setattr(cluster, "ML_CENTER_BYTES", 0)
    lab = {r.doc_id: r.cluster for r in cluster.stored_ml_labels(vectors, idx)(2).collect()}
    assert set(lab) == set(range(30)) and len({lab[d] for d in range(0, 30, 2)}) == len({lab[d] for d in range(1, 30, 2)}) == 1 and lab[0] != lab[1]
    assert [tuple(r) for r in cluster.ml_check(spark, vectors, idx, (2, 3)).collect()] == [(2, 30, True, True), (3, 30, True, True)]


def test_ml_fits_of_all_k_share_their_steps(spark, tmp_path, monkeypatch):
    from quarry.operators import kmeans, seeding, store
    rows = [(d, " ".join(f"w{(d * 7 + j * (d % 4)) % 11}" for j in range(4))) for d in range(30)] + [(30, "7 8")]
    store.commit(spark, str(tmp_path / "i"), spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), batch_id=0)
    idx = store.snapshot(spark, str(tmp_path / "i"))
    tfidf.stored_vectors(idx).write.parquet(str(tmp_path / "v"))
    vectors = spark.read.parquet(str(tmp_path / "v"))
    drawn = {(r.run, r.doc_id, r.cluster) for r in seeding.seeds_by_k(vectors, [2, 3]).collect()}
    assert drawn == {(k, r.doc_id, r.cluster) for k in (2, 3) for r in seeding.seeds(vectors, k, 1).collect()}
    fits, fit = [], kmeans.fit
    monkeypatch.setattr(kmeans, "fit", lambda v, ks, *a, **kw: fits.append(dict(ks)) or fit(v, ks, *a, **kw))
    monkeypatch.setattr(cluster, "ML_STEP_BYTES", 0, raising=False)
    report = cluster.stored_ml_report(spark, vectors, idx, (2, 3, 40)).collect()
    assert fits == [{2: 2, 3: 3}]
    assert sorted({r.k for r in report}) == [2, 3, 40] and sum(r.section == 1 for r in report) == 5


def test_stored_vectors_of_ranges_equal_those_of_postings(spark, tmp_path):
    from quarry.operators import store
    # ids of two ranges and below 0, two deliveries, a document without terms
    first = [(d, f"alpha beta{d % 3} beta{d % 3} gamma{d}") for d in (-5, 1, 2, 4095, 4096, 9000)] + [(7, "12 3.5")]
    for n, rows in enumerate((first, [(3, "alpha delta"), (4097, "beta1")])):
        store.commit(spark, str(tmp_path / "i"), spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), batch_id=n)
    idx = store.snapshot(spark, str(tmp_path / "i"))
    frame = tfidf.stored_vectors(idx)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan       # no posting is a row
    got = {r.doc_id: dict(zip(r.terms, r.ws)) for r in frame.collect()}
    assert got[7] == {} and len(got) == 9
    weights = tfidf.tfidf(idx.index()).join(idx.dictionary, "term").collect()
    want = {}
    for r in weights:
        want.setdefault(r.doc_id, {})[r.term_id] = r.w
    assert {d: set(x) for d, x in got.items() if x} == {d: set(x) for d, x in want.items()}
    assert all(abs(got[d][t] - w) < 1e-12 for d, x in want.items() for t, w in x.items())
