import random
import tempfile

from quarry.operators import seen


def test_each_url_once_over_all_deliveries(spark, monkeypatch):
    monkeypatch.setattr(seen, "WORDS", 4)      # so small that the filter errs
    rng = random.Random(2)
    path, want, errors = tempfile.mkdtemp(prefix="quarry-test-") + "/seen", {}, 0
    for b in range(4):
        rows = [(100 * b + i, i % 3, f"https://x.test/{rng.randrange(150)}.pdf") for i in range(80)] + [(100 * b + 90, 0, None)]
        links = spark.createDataFrame(rows, "page_id BIGINT, link_no BIGINT, url STRING")
        again = len({u for _, _, u in rows if u in want})
        m = seen.take(spark, path, links, b)
        assert m["found"] == again and m["checked"] >= again
        errors += m["checked"] - again
        assert seen.take(spark, path, links, b)["generation"] == m["generation"]     # a replay
        for page, no, url in sorted(r for r in rows if r[2]):
            want.setdefault(url, (page, no))
    got = {r.url: (r.page_id, r.link_no) for r in seen.seen_urls(spark, path).collect()}
    assert got == want and seen.seen_urls(spark, path).count() == len(want)
    assert errors > 0


def test_the_filter_spares_most_comparisons(spark):
    path = tempfile.mkdtemp(prefix="quarry-test-") + "/seen"
    frame = lambda lo, hi: spark.range(lo, hi).selectExpr("id AS page_id", "0L AS link_no", "concat('https://x.test/', id) AS url")
    seen.take(spark, path, frame(0, 20_000), 0)
    m = seen.take(spark, path, frame(19_990, 40_000), 1)
    assert m["found"] == 10 and m["checked"] < 10 + 200
    assert seen.seen_urls(spark, path).count() == 40_000
