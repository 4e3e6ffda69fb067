import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quarry.llm import line_dedup
from tests.llm.helpers import awkward, docs_of, prose

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows, min_chars=10, min_docs=2):
    holders = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if d is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(holders.get(key(x), ())) < min_docs or min(holders[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(docs, **kw):
    return sorted((tuple(r) for r in line_dedup.dedup(docs, {"doc_id": F.col("doc_id")}, **kw).collect()), key=repr)


def shared_lines(seed=1, n=60):
    rng = random.Random(seed)
    common = [prose(rng, rng.randrange(1, 12)) for _ in range(15)] + ["short", "ÄÖÜ not lowered", "exactly 10", "  Padded Line Here \t", "\x0bx padded line here\r"]
    rows = []
    for i in range(n):
        lines = [rng.choice(common) if rng.random() < 0.5 else prose(rng, 5) for _ in range(rng.randrange(1, 12))]
        rows.append((rng.randrange(n), "\n".join(x.upper() if rng.random() < 0.3 else x for x in lines)))
    return rows


@pytest.mark.parametrize("kw", [{}, {"min_docs": 3}, {"min_chars": 1}])
def test_matches_brute_force(spark, kw):
    rows = shared_lines() + awkward() + [(None, "exactly 10\nexactly 10"), (7, "\n\n"), (8, "a line that repeats\na line that repeats\n")]
    docs = docs_of(spark, rows).withColumn("id", F.lit("x")).withColumn("gone", F.lit(1)).withColumn("n_lines", F.lit(1)).withColumn("th", F.lit(2))
    assert found(docs, **kw) == brute(rows, **kw)


def test_rows_keep_their_columns(spark):
    rows = [(2, "the same long line\nown line of two"), (1, "The same LONG line  \nown line of one"), (3, None)]
    docs = docs_of(spark, rows).withColumn("kept", F.lit("k"))
    out = line_dedup.dedup_rows(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: rows[1][1], 2: "own line of two", 3: None}


def test_one_line_in_all_documents_and_a_long_document(spark):
    rng = random.Random(2)
    rows = [(i, "a line that everyone has\n" + prose(rng, 8)) for i in range(400)] + [(900, "\n".join(["a line that everyone has"] * 20_000 + ["end"]))]
    got = found(docs_of(spark, rows))
    assert got == brute(rows)
    assert hashlib.sha256(dict((r[0], r[3]) for r in got)[900].encode()).hexdigest() == hashlib.sha256(b"end").hexdigest()


def test_no_python_in_the_plan_and_one_exchange_of_the_lines(spark):
    plan = line_dedup.dedup(docs_of(spark, shared_lines()), {"doc_id": F.col("doc_id")})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    assert found(docs_of(spark, [])) == []
