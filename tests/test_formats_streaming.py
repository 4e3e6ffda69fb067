import tempfile

from quarry.operators import index as ix
from quarry.sources import textformats
from quarry.streaming import ingest


def test_token_log_roundtrip(spark, docs_factory):
    toks = spark.createDataFrame([("a / b", 1, 1), ("x", 1, 2), ("/", 2, 1)], "token STRING, doc_id BIGINT, pos BIGINT")
    lines = {r.line for r in textformats.token_log_lines(toks).collect()}
    assert "a / b / Doc ID: 1 / Pos: 1" in lines
    path = tempfile.mkdtemp(prefix="quarry-test-") + "/log"
    textformats.write_token_log(toks, path)
    back = sorted((r.token, r.doc_id, r.pos) for r in textformats.read_token_log(spark, path).collect())
    assert back == [("/", 2, 1), ("a / b", 1, 1), ("x", 1, 2)]


def test_manifest_roundtrip(spark):
    docs = spark.createDataFrame([(1, "https://x.org/a.pdf"), (2, "https://x.org/b) c.pdf")], "doc_id BIGINT, url STRING")
    path = tempfile.mkdtemp(prefix="quarry-test-") + "/links"
    textformats.write_manifest(docs, path)
    assert sorted(tuple(r) for r in textformats.read_manifest(spark, path).collect()) == \
        [(1, "https://x.org/a.pdf"), (2, "https://x.org/b) c.pdf")]


def test_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="quarry-test-")
    rows = [(i, f"open access {i} river stone" * (i % 3 + 1), "en", "s", 10) for i in range(40)]
    df = spark.createDataFrame(rows, ingest.DOC_SCHEMA)
    for part in range(3):   # three files -> three micro-batches
        df.filter(df.doc_id % 3 == part).coalesce(1).write.parquet(f"{base}/src/part{part}")
    q = ingest.start_ingest(spark, f"{base}/src/*", f"{base}/out", f"{base}/ckpt", max_files_per_trigger=1)
    q.awaitTermination()
    streamed = {(r.term, r.doc_id): list(r.positions) for r in ingest.compacted_postings(spark, f"{base}/out").collect()}
    batch = ix.build_index(df.select("doc_id", "text"))
    assert streamed == {(r.term, r.doc_id): list(r.positions) for r in batch.postings.collect()}


def test_report_sinks(spark, docs_factory):
    from quarry.operators.render import index_dump
    idx = ix.build_index(docs_factory([(1, "zeta alpha"), (2, "alpha mid")]))
    path = tempfile.mkdtemp(prefix="quarry-test-") + "/dump"
    textformats.write_index_dump(index_dump(idx.postings), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == ["alpha (2) --> 1[2], 2[1]", "mid (1) --> 2[2]", "zeta (1) --> 1[1]"]


def test_replayed_batch_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="quarry-test-")
    docs = spark.createDataFrame([(1, "open access"), (2, "open")], "doc_id BIGINT, text STRING")
    ingest.commit_batch(docs, 0, base)
    ingest.commit_batch(docs, 0, base)          # replay of batch 0 after a failure
    got = sorted((r.term, r.doc_id, r.tf) for r in ingest.compacted_postings(spark, base).collect())
    assert got == [("access", 1, 1), ("open", 1, 1), ("open", 2, 1)]


def test_redelivered_documents_and_rejects(spark):
    base = tempfile.mkdtemp(prefix="quarry-test-")
    schema = "doc_id BIGINT, text STRING"
    ingest.commit_batch(spark.createDataFrame([(1, "open river"), (1, "open river"), (2, "stone"), (None, "x"), (None, "x"), (3, None)], schema), 0, base)
    ingest.commit_batch(spark.createDataFrame([(1, "open river"), (2, ""), (4, "cloud cloud")], schema), 1, base)
    index = ingest.compacted_index(spark, base)
    assert sorted((r.term, r.doc_id, list(r.positions)) for r in index.postings.collect()) == [
        ("cloud", 4, [1, 2]), ("open", 1, [1]), ("river", 1, [2])]
    assert sorted(r.doc_id for r in index.docs.collect()) == [1, 4]      # document 2 was delivered empty
    assert sorted((r.reason, r.doc_id or 0) for r in ingest.rejected(spark, base).collect()) == [
        ("null_id", 0), ("null_id", 0), ("null_text", 3)]


def test_token_log_keeps_odd_characters_and_lists_rejects(spark):
    toks = spark.createDataFrame([("a\u0085b", 1, 1), ("\u2028", 1, 2), ("c", 1, 3)], "token STRING, doc_id BIGINT, pos BIGINT")
    path = tempfile.mkdtemp(prefix="quarry-test-") + "/log"
    textformats.write_token_log(toks, path)
    spark.createDataFrame([("no log line",)], "value STRING").write.mode("append").text(path)
    back = sorted((r.pos, r.token) for r in textformats.read_token_log(spark, path).collect())
    assert back == [(1, "a\u0085b"), (2, "\u2028"), (3, "c")]
    assert [r.line for r in textformats.read_rejected_lines(spark, path).collect()] == ["no log line"]


def test_per_document_token_log_and_sinks(spark):
    toks = spark.createDataFrame([("b", 2, 1), ("a", 1, 1), ("c", 1, 2)], "token STRING, doc_id BIGINT, pos BIGINT")
    path = tempfile.mkdtemp(prefix="quarry-test-") + "/bydoc"
    textformats.write_token_log(toks, path, per_document=True)
    back = sorted((r.token, r.doc_id, r.pos) for r in textformats.read_token_log(spark, path).collect())
    assert back == [("a", 1, 1), ("b", 2, 1), ("c", 1, 2)]
    res = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "query_id BIGINT, line STRING")
    rpath = tempfile.mkdtemp(prefix="quarry-test-") + "/res"
    textformats.write_results(res, rpath)
    assert [r.value for r in spark.read.text(rpath).collect()] == ["a", "b", "c"]
    rep = spark.createDataFrame([(10, 1, 0, "m10"), (2, 0, -1, "k = 2"), (2, 1, 1, "m1"), (2, 1, 0, "m0")],
                                "k BIGINT, section INT, cluster BIGINT, line STRING")
    cpath = tempfile.mkdtemp(prefix="quarry-test-") + "/rep"
    textformats.write_cluster_report(rep, cpath)
    assert [r.value for r in spark.read.text(cpath).collect()] == ["k = 2", "m0", "m1", "m10"]


def test_file_glob_matches_only_that_file():
    import fnmatch
    g = ingest.file_glob("/data/sf/documents.parquet")
    assert g == "/data/sf/[d]ocuments.parquet"
    assert fnmatch.fnmatch("/data/sf/documents.parquet", g)
    assert not fnmatch.fnmatch("/data/sf/pages.parquet", g)


def test_token_log_of_ordered_texts_moves_no_lines(spark, tmp_path):
    from quarry.operators.positions import tokenize_docs
    from quarry.plans import catalog
    rows = [(d, f"one two{d} one / three") for d in range(20, 0, -1)] + [(21, None), (None, "x")]
    (tmp_path / "t").mkdir()
    spark.createDataFrame(rows, "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "t/documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "t/documents.parquet"))
    path = str(tmp_path / "log")
    tokens = tokenize_docs(textformats.ordered_texts(docs))
    textformats.write_token_log(tokens, path, in_order=True)
    assert all(f.name.endswith(".gz") for f in (tmp_path / "log").glob("part-*"))
    want = [(r.token, r.doc_id, r.pos) for r in tokenize_docs(docs).filter("doc_id IS NOT NULL").collect()]
    back = [(r.token, r.doc_id, r.pos) for f in sorted((tmp_path / "log").glob("part-*")) for r in textformats.read_token_log(spark, str(f)).collect()]
    assert back == sorted(want, key=lambda r: r[1:])       # the log is in order of documents and positions
    assert sorted(map(tuple, catalog.q_token_log_roundtrip(spark, str(tmp_path / "t")).collect())) == sorted(want)
    spark.createDataFrame([*rows, (3, "once more")], "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "u/documents.parquet"))
    assert catalog.q_token_log_roundtrip(spark, str(tmp_path / "u")).count() == len(want) + 2
