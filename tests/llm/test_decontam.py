import hashlib
import random
import re

from quarry.llm import decontam
from tests.llm.helpers import awkward, docs_of, prose

F_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return F_WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, bench):
    wins = {}
    for item, text in bench:
        w = words(text)
        if item is not None and w:
            for i in range(max(1, len(w) - 12)):
                wins.setdefault(tuple(w[i:i + 13]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, items = set(), set()
        for win, who in wins.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    items |= who
        out.append((doc, len(w), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def run(spark, docs, bench, **kw):
    from pyspark.sql import functions as F
    b = spark.createDataFrame(bench, "item_id BIGINT, text STRING")
    got = decontam.contamination(docs_of(spark, docs), b, {"doc_id": F.col("doc_id")}, **kw).collect()
    return sorted([(r.doc_id, r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in got], key=repr), got


def sample():
    rng = random.Random(1)
    items = [prose(rng, n) for n in (30, 13, 14, 5, 1, 40)]
    docs = [(10 + i, prose(rng, 40) + "\n" + items[i % 6].upper() + ". " + prose(rng, 30 * i)) for i in range(12)]
    docs += [(40, items[0][:-3]), (41, prose(rng, 700) + " " + items[1]), (42, prose(rng, 80))]
    return docs, list(enumerate(items)) + [(7, None), (8, "  ,, "), (None, items[0]), (0, items[0]), (9, items[5])]


def test_matches_brute_force(spark):
    docs, bench = sample()
    docs = docs + [d for d in awkward() if d[0] != 5]
    got, _ = run(spark, docs, bench)
    assert got == brute(docs, bench)


def test_blocks_of_windows_give_the_same(spark):
    docs, bench = sample()
    assert run(spark, docs, bench, max_windows=20)[0] == run(spark, docs, bench)[0]


def test_spans_point_into_the_original(spark):
    docs, bench = sample()
    text = dict(docs)
    for r in run(spark, docs, bench)[1]:
        assert sum(len(words(text[r.doc_id][s.start:s.end])) for s in r.spans) == r.n_hit


def test_empty_tables_and_long_text(spark):
    docs, bench = sample()
    assert run(spark, [], bench)[0] == []
    got, _ = run(spark, awkward(), [])
    assert len(got) == 10 and not any(r[4] for r in got)


def test_removal_keeps_columns_and_clean_rows(spark):
    docs, bench = sample()
    frame = docs_of(spark, docs).selectExpr("*", "1 AS n_words", "'x' AS row")
    kept = decontam.remove_contaminated(frame, spark.createDataFrame(bench, "item_id BIGINT, text STRING"))
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(b[0] for b in brute(docs, bench) if not b[4])


def test_query_digest(spark, tmp_path):
    from quarry.llm.queries import op10_decontamination
    docs, bench = sample()
    docs_of(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {d: hashlib.sha256(",".join(sorted(map(str, i))).encode()).hexdigest() for d, _, _, i, _ in brute(docs, bench)}
    assert {r.doc_id: r.items_sha256 for r in op10_decontamination(spark, str(tmp_path)).collect()} == want
