import random
import re
from collections import Counter

from pyspark.sql import functions as F

from quarry.llm import quality
from tests.llm.helpers import awkward, docs_of, prose

SPLIT = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = SPLIT.findall(text)
    lines = [x for x in text.split("\n") if SPLIT.search(x)]
    tri = Counter(zip(w, w[1:], w[2:]))
    cover = {k for i, t in enumerate(zip(w, w[1:], w[2:])) if tri[t] > 1 for k in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))


def cases():
    rng = random.Random(2)
    few = lambda n, k: " ".join("w%d" % rng.randrange(k) for _ in range(n))
    texts = [few(n, k) for n in (1, 2, 3, 4, 7, 60, 400) for k in (1, 2, 3, 8, 30)]
    texts += ["a b c a b c", "a a a a", "x\n\nx\n x\nx", "\x0ba\x0c b\r\nc\x1fd\xa0e", "** ## |x| <y>", prose(rng, 200), "l1\nl1\nl2\nl1"]
    return list(enumerate(texts, 100)) + awkward()


def test_measures_match_brute_force(spark):
    docs = cases()
    got = quality.measures(docs_of(spark, docs), {"doc_id": F.col("doc_id")}).collect()
    rows = sorted([(r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got], key=repr)
    assert rows == sorted([(d, brute(t)) for d, t in docs], key=repr)


def test_base_rule_and_native_plan(spark):
    docs = cases()
    frame = quality.verdicts(docs_of(spark, docs), {"doc_id": F.col("doc_id")})
    want = sorted([(d, b[0] < 50 or 100 * b[4] > 50 * b[0]) for d, b in ((d, brute(t)) for d, t in docs)], key=repr)
    rows = frame.collect()
    assert sorted([(r.doc_id, r.base_failed) for r in rows], key=repr) == want
    assert not any(r.kept for r in rows if r.base_failed)
    assert not re.search("Python|Arrow|Pandas", frame._jdf.queryExecution().toString())


def clean(rng):
    return " ".join("w%d" % rng.randrange(10**6) for _ in range(80))


def test_host_rates_follow_the_beta_prior(spark):
    judged = spark.createDataFrame([("a", i < 1) for i in range(10)] + [("b", i < 18) for i in range(20)] + [(None, True)],
                                   "host string, any_failed boolean")
    got = {r.host: r.rate for r in quality.host_rates(judged, "host").collect()}
    raw = {"a": 0.1, "b": 0.9, None: 1.0}
    m = sum(raw.values()) / 3
    v = sum((x - m) ** 2 for x in raw.values()) / 3
    s = m * (1 - m) / v - 1
    for host, n in (("a", 10), ("b", 20), (None, 1)):
        k = raw[host] * n
        assert abs(got[host] - ((k + m * s) / (n + s) if v < m * (1 - m) else got[host])) < 1e-12
        assert 0 <= got[host] <= 1


def test_bad_host_rejects_soft_failures_only(spark):
    rng = random.Random(6)
    soft = lambda: "\n".join([" ".join("w%d" % rng.randrange(10**6) for _ in range(20))] * 2 + [clean(rng)])  # noqa: E731  one line twice of three
    rows = [(i, "too short", "en", "bad", 1) for i in range(30)]
    rows += [(100, clean(rng), "en", "bad", 1), (101, soft(), "en", "bad", 1)]
    rows += [(200 + i, clean(rng), "en", "good", 1) for i in range(30)] + [(300, soft(), "en", "good", 1)]
    frame = docs_of(spark, rows).withColumn("kept", F.lit("clash"))
    kept = quality.keep_good(frame)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == frame.columns
    assert 100 in ids and 101 not in ids and 300 in ids and not ids & set(range(30)) and set(range(200, 230)) <= ids


def test_empty_table_and_one_host(spark):
    assert quality.keep_good(docs_of(spark, [])).count() == 0
    assert quality.keep_good(docs_of(spark, [(1, clean(random.Random(1)))])).count() == 1
