import random

from pyspark.sql import functions as F

from quarry.llm import licenses as lic
from tests.llm.helpers import awkward, docs_of, prose


def brute_align(body, seq):
    """Best local alignment over all diagonals, by the same scores."""
    best, h = 0, [[0] * (len(seq) + 1) for _ in range(len(body) + 1)]
    for i in range(1, len(body) + 1):
        for j in range(1, len(seq) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if body[i - 1] == seq[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_banded_alignment_scores_like_the_full_one_near_the_diagonal():
    rng = random.Random(1)
    for _ in range(200):
        body = [rng.randrange(1, 9) for _ in range(rng.randrange(3, 30))]
        seq = [0] * 5 + [w for w in body if rng.random() > 0.1] + [0] * 3
        hit = lic.align(body, seq, -15, 15)
        assert hit and seq[hit[0]] and hit[2] <= hit[1] - hit[0]
        gaps = (hit[1] - hit[0]) - hit[2]
        assert hit[2] - gaps >= brute_align(body, seq) - gaps - len(body) // 3


def test_winnowing_guarantee():
    rng = random.Random(2)
    for _ in range(100):
        h = [rng.randrange(50) for _ in range(rng.randrange(1, 40))]
        kept = set(lic.winnow(h, 4))
        assert all(kept & set(range(lo, lo + 4)) for lo in range(max(0, len(h) - 3)) if lo + 4 <= len(h)) and kept


def found(spark, docs):
    rows = lic.licenses(docs_of(spark, docs), lic.template_table(spark), {"doc_id": F.col("doc_id")}).collect()
    return {r.doc_id: r.finds for r in rows}, rows


def test_planted_templates_are_found_with_their_spans(spark):
    rng = random.Random(3)
    docs, want = [], {}
    for i, (name, body) in enumerate(lic.TEMPLATES):
        head = prose(rng, rng.randrange(0, 300))
        text = f"{head}\n{body}.\n{prose(rng, 50)}"
        docs.append((100 + i, text))
        want[100 + i] = (name, text.index(body), len(body))
    got, _ = found(spark, docs)
    for doc, (name, at, size) in want.items():
        assert [f.license for f in got[doc]] == [name], doc
        f = got[doc][0]
        assert f.start == at and abs(f.end - (at + size)) <= 2 and f.coverage == 1.0


def test_back_to_back_notices_are_all_found():
    index = lic.Index(lic.TEMPLATES)
    for t, (name, text) in enumerate(lic.TEMPLATES):
        n = len(lic.words_of(text))
        for copies in (1, 2, 3, 7) if n < 20 else (1, 2):
            for between in ([], [0], [0] * 3):
                seq = []
                for _ in range(copies):
                    seq += index.bodies[t] + between
                full, lo = [], 0  # by alignments over all diagonals, copy by copy
                while lo < len(seq):
                    hit = lic.align(index.bodies[t], seq[lo:lo + n], -n, n)
                    full.append((t, lo + hit[0], lo + hit[1], hit[2]))
                    lo += n + len(between)
                got = index.find(seq)
                assert [(index.names[x], a, b, m) for x, a, b, m in got] == [(name, a, b, m) for _, a, b, m in full], (text, copies)


def test_changed_copies_and_clean_texts(spark):
    rng = random.Random(4)
    body = next(b for n, b in lic.TEMPLATES if n == "MIT" and len(b) > 200).split()
    for k in range(0, len(body), 12):
        body[k] = "changed"
    docs = [(1, prose(rng, 40) + " " + " ".join(body)), (2, prose(rng, 900)), (3, "licensed under nothing at all, the license is a word"), *awkward()[2:]]
    got, rows = found(spark, docs)
    assert [f.license for f in got[1]] == ["MIT"] and 0.6 <= got[1][0].coverage < 1
    assert got[2] == [] and got[3] == [] and len(rows) == len(docs)


def test_empty_table_and_no_templates(spark):
    assert found(spark, [])[1] == []
    none = spark.createDataFrame([], "license string, text string")
    assert [r.finds for r in lic.licenses(docs_of(spark, [(1, "x")]), none, {"doc_id": F.col("doc_id")}).collect()] == [[]]


def full_search(index, seq):
    """Finds by alignments of whole texts with every template over all diagonals, without candidates."""
    out = []
    for t, body in enumerate(index.bodies):
        todo = [(0, len(seq))]
        while todo:
            lo, hi = todo.pop()
            hit = lic.align(body, seq[lo:hi], -len(body), hi - lo) if hi - lo >= lic.least(body) else None
            if hit and hit[2] >= lic.least(body):
                a, b = lo + hit[0], lo + hit[1]
                if all(lic.holds(seq[a:b], p) for p in index.telling[t]):
                    out.append((t, a, b, hit[2]))
                todo += [(lo, a), (b, hi)]
    kept = []
    for h in sorted(out, key=lambda h: (-h[3], -h[3] / len(index.bodies[h[0]]), index.names[h[0]], h[1])):
        if all(h[2] <= k[1] or k[2] <= h[1] for k in kept):
            kept.append(h)
    return sorted((index.names[t], a, b, m) for t, a, b, m in kept)


def test_whole_texts_against_the_full_alignment():
    index = lic.Index(lic.TEMPLATES)
    rng = random.Random(6)
    short = [i for i, b in enumerate(index.bodies) if len(b) < 60]
    for _ in range(6):
        seq = [0] * rng.randrange(0, 20)
        for t in rng.sample(short, 3):
            body = list(index.bodies[t])
            if rng.random() < 0.5:
                body[rng.randrange(len(body))] = 0
            seq += body + [0] * rng.randrange(2, 20)
        assert sorted((index.names[t], a, b, m) for t, a, b, m in index.find(seq)) == full_search(index, seq)


def test_neighbours_get_their_own_name_or_none(spark):
    said = [("Licensed under CC BY-SA 4.0", ["CC-BY-SA-4.0"]), ("Licensed under CC BY 3.0", ["CC-BY-3.0"]), ("Licensed under CC BY 2.5", []),
            ("This work is licensed under the GNU General Public License, version 2", ["GPL-2.0"]),
            ("This work is licensed under the GNU Lesser General Public License, version 3", ["LGPL-3.0"]),
            ("This work is licensed under the GNU General Public License, version 1", []),
            ("released under the Apache License", []), ("Licensed under the Apache License, Version 1.1", []),
            ("Released under the BSD License", []), ("Released under the Artistic License", []),
            ("Released under the MIT License.", ["MIT"]), ("Licensed under the BSD 2-Clause License", ["BSD-2-Clause"]),
            (lic._BSD_TWO + lic._BSD_DISCLAIMER, ["BSD-2-Clause"]), (lic._BSD_TWO + lic._BSD_THIRD + lic._BSD_DISCLAIMER, ["BSD-3-Clause"])]
    got, _ = found(spark, [(i, f"Some words before. {text}\nand some after") for i, (text, _) in enumerate(said)])
    assert [[f.license for f in got[i]] for i in range(len(said))] == [names for _, names in said]
