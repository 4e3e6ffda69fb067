import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import lexical
from tests.llm.helpers import awkward, docs_of, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    ds = [(d, words(t)) for d, t in docs]
    n_docs, n_all = sum(bool(w) for _, w in ds), sum(len(w) for _, w in ds)
    df = {}
    for _, w in ds:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(words(t))
    out = []
    for i, q in terms.items():
        rows = []
        for d, w in ds:
            score = 0
            for t in q & set(w):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 10 + 90 * len(w) * n_docs // n_all
                score += weight * (1_000_000_000 * w.count(t) // (1000 * w.count(t) + 8 * m))
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        for r, (s, _, _, d) in enumerate(sorted(rows)[:k]):
            out.append((i, r + 1, d, -s))
    return sorted(out, key=repr)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id BIGINT, text STRING").withColumn("rank", F.lit(0))


def found(spark, docs, items, **kw):
    frame = docs_of(spark, docs).withColumn("n", F.lit("clash")).withColumn("score", F.lit("clash"))
    return sorted((tuple(r) for r in lexical.search(frame, items_of(spark, items), **kw).collect()), key=repr)


def some(seed=5):
    rng = random.Random(seed)
    docs = [(i, prose(rng, rng.randrange(1, 80))) for i in range(120)]
    docs += [(200 + i, "tie tie tie one") for i in range(25)] + [(300 + i, t) for i, t in docs[:10]]
    items = [(i, prose(rng, rng.randrange(1, 30))) for i in range(25)] + [(40, "tie"), (41, None), (42, "..."), (None, "tie one"), (43, "nowhereword"), (44, "on"), (44, "tie")]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = some()
    docs = docs + [(d, (t or "")[:5000]) for d, t in awkward()]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, docs, items, k=3) == brute(docs, items, 3)


def test_items_in_many_blocks(spark):
    docs, items = some(6)
    assert found(spark, docs, items, cells=40, most=30) == brute(docs, items)


def test_tiles_of_any_size_are_exact():
    rng = np.random.default_rng(1)
    rows = (rng.random((7, 50)) < 0.4).astype(float)
    term, doc = np.nonzero(rng.random((50, 13)) < 0.3)
    cell = rng.integers(0, 1 << 36, len(term))
    dense = np.zeros((50, 13), object)
    dense[term, doc] = cell
    want = rows.astype(int).astype(object) @ dense
    for tile in (1, 7, 64, 1024):
        assert (lexical.multiply(rows, term, doc, cell, 13, tile) == want).all()
    with pytest.raises(ValueError):
        lexical.multiply(rows, term, doc, cell, 13, 1 << 20)


def test_ties_across_tiles_and_long_texts(monkeypatch):
    best = lexical.Best(1, 2)
    for ids in ([9, 8], [3, 7], [1]):
        best.add(np.full((1, len(ids)), 5), np.array(ids), np.zeros(len(ids), bool))
    best.add(np.array([[5]]), np.array([0]), np.array([True]))  # a null id ranks last
    assert best.rows[0][2].tolist() == [1, 3]
    data = prose(random.Random(1), 500).encode()
    for limit in (1, 10, 1000):
        assert [w for p in lexical.pieces(data, limit) for w in p.split()] == data.split()


def test_large_collections_do_not_overflow():
    n = np.array([10**7], np.int64)
    assert lexical.impacts(np.array([5]), n, 10**12, 10**15).tolist() == [5 * 10**9 // (5000 + 8 * (10 + 90 * 10**7 * 10**12 // 10**15))]


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
