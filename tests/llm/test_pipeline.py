import random
import zlib

import numpy as np
import pytest

from tests.llm.helpers import DOC_SCHEMA, prose
from tests.llm.test_decontam import brute as brute_contamination
from tests.llm.test_pii import brute as brute_spans
from tests.llm.test_quality import brute as brute_measures
from tests.llm.test_sentencepiece import PATH, plain_viterbi
from tests.llm.test_simhash import brute_components, plain_fingerprint

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture
def tables(spark, tmp_path):
    rng = random.Random(1)
    fresh = lambda n: " ".join("w%d" % rng.randrange(10**7) for _ in range(n))
    items = [(k, prose(rng, 30)) for k in range(5)]
    rows = [(i, fresh(120), "en", "src%d" % (i % 3), 1) for i in range(20)]
    rows += [(100 + i, rows[i][1], "en", "src0", 1) for i in range(6)]  # exact copies
    rows += [(150 + i, rows[i + 6][1] + " tail", "en", "src0", 1) for i in range(4)]  # near copies
    rows += [(200 + i, items[i][1] + " " + fresh(100), "en", "src1", 1) for i in range(5)]  # contaminated
    rows += [(300 + i, fresh(60) + f" write to p{i}@corp.example or +1 (555) 123-450{i} " + fresh(60), "en", "src2", 1) for i in range(5)]
    rows += [(400, "short", "en", "src0", 1), (401, None, None, None, None), (402, "", "en", "src0", 0), (403, "a b c " * 60, "en", "src0", 1),
             (404, " ".join(w + "###" for w in fresh(80).split()), "en", "src1", 1), (0, rows[0][1], "en", "src0", 1)]
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    return rows, items, str(tmp_path)


def expected(rows, items):
    def good(text):
        n, chars, symbols, _, repeat = brute_measures(text)
        return n >= 50 and 100 * repeat <= 50 * n and 100 * symbols <= 10 * n and 2 <= chars / n <= 12

    kept = {(r[0], r[1]) for r in rows if good(r[1])}  # exact repetitions go with the near-duplicates
    comp = brute_components([(d, plain_fingerprint(t)) for d, t in sorted(kept)])
    kept = {(d, t) for d, t in kept if dict(comp)[d] == d}
    return {d: t for d, t in kept if not next(b for b in brute_contamination([(d, t)], items))[4]}


def test_pipeline_equals_its_stages_by_brute_force(spark, tables):
    rows, items, path = tables
    out = corpus_pipeline.run(spark, path)
    got = {r.doc_id: r for r in out.collect()}
    want = expected(rows, items)
    assert out.count() == len(got) and set(got) == set(want)
    model = __import__("quarry.llm.sentencepiece", fromlist=["Model"]).Model(PATH)
    for doc, text in want.items():
        r = got[doc]
        if not brute_spans(text):
            assert r.text == text
        assert not brute_spans(r.text) and r.round_trip
        assert list(r.ids) == plain_viterbi(model, r.text)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, np.int32).tobytes()) and r.n_pieces == len(r.ids)


def test_stages_return_the_columns_of_documents(spark, tables):
    _, _, path = tables
    docs = spark.read.parquet(f"{path}/documents.parquet").selectExpr("*", "1 AS kept", "'x' AS component_id", "2 AS spans", "3 AS row")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        out.count()


def test_stages_on_an_empty_table(spark, tables):
    _, _, path = tables
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0, name
