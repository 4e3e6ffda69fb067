import random
import re

from pyspark.sql import functions as F

from quarry.llm import pii
from tests.llm.helpers import awkward, docs_of

#: The contract's patterns, written plainly.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def brute(text):
    text = text or ""
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_match_the_patterns():
    rng = random.Random(1)
    pieces = ["a.b@c.de", "x@y", "@", "a@b@c.d", "..@-.-", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.3.255", "4111 1111 1111 1111",
              "4111-1111-1111-1111", "4111111111111112", "+1 (555) 123-4567", "+1", "++49 30 1234567", "12", "ü", " ", "\n", ".", "-", "é@ü.de", "a@b.c.", "9" * 40]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 9)))
        assert [s[:3] for s in pii.base_spans(text)] == brute(text), text


def test_long_runs_do_not_stall():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1" + "(" * 200_000, "@" * 200_000, "a@" * 100_000):
        pii.base_spans(text)


def frame(spark):
    filler = lambda i, n: " ".join(f"w{(i * 37 + k * 11) % 400}x" for k in range(n))
    rows = [(1000 + i, f"{filler(i, 30)} the common words") for i in range(60)]
    # the name stands beside the address in several different texts and nowhere else
    rows += [(100 + i, f"{filler(i, 12)} ask Quillfeather the common jane@corp.example now {filler(i + 7, 12)}") for i in range(3)]
    rows += [(200, "a mail to once@corp.example from Zanzibarine today")]
    return rows


def test_disclosing_terms_are_found_by_co_occurrence(spark):
    got = {r.doc_id: r for r in pii.personal_data(docs_of(spark, frame(spark)), {"doc_id": F.col("doc_id")}).collect()}
    text = dict(frame(spark))
    for i in (100, 101, 102):
        found = {text[i][t.start:t.end]: t.action for t in got[i].terms}
        assert found["Quillfeather"] == "remove" and "common" not in found and "the" not in found
    assert got[200].terms == [] and [s.kind for s in got[200].spans] == ["email"]  # one text is no evidence
    assert not any(got[1000 + i].terms or got[1000 + i].spans for i in range(60))


def test_scores_match_brute_force(spark):
    rows = frame(spark)
    from math import log2
    pairs, n_e, n_t = {}, {}, {}
    for doc, text in rows:
        ctx = {(e, t) for e, t, _, _ in pii.contexts(text, pii.base_spans(text))}
        for e, t in ctx:
            pairs[e, t] = pairs.get((e, t), 0) + 1
        for e in {e for e, _ in ctx}:
            n_e[e] = n_e.get(e, 0) + 1
        for t in {w.decode() for w in pii.ascii_words(text.encode())}:
            n_t[t] = n_t.get(t, 0) + 1
    want = set()
    for (e, t), n in pairs.items():
        ic, pmi = log2(len(rows) / n_e[e]), log2(n * len(rows) / (n_e[e] * n_t[t]))
        if n >= pii.MIN_TEXTS and ic > 0 and pmi >= pii.GENERALISE * ic:
            want.add((e, t, "remove" if pmi >= pii.REMOVE * ic or len(t) <= pii.PREFIX else "generalise"))
    docs = docs_of(spark, rows)
    found = pii.detect(docs, {"doc_id": F.col("doc_id")})
    assert {tuple(r) for r in pii.disclosures(docs, found).collect()} == want and want


def test_a_disclosing_term_is_marked_everywhere_in_documents_of_the_entity(spark):
    filler = lambda i, n: " ".join(f"w{(i * 37 + k * 11) % 400}x" for k in range(n))
    rows = [(1000 + i, f"{filler(i, 30)} common words 12") for i in range(60)]
    rows += [(100 + i, f"Dear Quillfeather, common {filler(i, 40)} jane@corp.example {filler(i + 7, 40)} Qx 7731 and QUILLFEATHER")
             for i in range(3)]
    rows += [(103, rows[-1][1])] * 2  # repeated rows count as rows on both sides
    docs = docs_of(spark, rows)
    got = {r.doc_id: r for r in pii.personal_data(docs, {"doc_id": F.col("doc_id")}).collect()}
    for i in (100, 101, 102, 103):
        text = dict(rows)[i]
        marked = [text[t.start:t.end].lower() for t in got[i].terms if t.action == "remove"]
        assert marked.count("quillfeather") == 2 and "qx" in marked and "7731" in marked and "common" not in marked
    clean = {r.doc_id: r.text.lower() for r in pii.sanitise(docs).collect()}
    assert not any(w in clean[i] for i in (100, 101, 102, 103) for w in ("quillfeather", "qx", "7731"))


def test_sanitised_texts_hold_no_personal_data(spark):
    rows = frame(spark) + awkward() + [(300, "card 4111 1111 1111 1111 and 10.0.0.1, +1 (555) 123-4567.")]
    docs = docs_of(spark, rows).withColumn("spans", F.lit("mine")).withColumn("row", F.lit(1))
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows) and {r.spans for r in got} == {"mine"}
    by = {r.doc_id: r for r in got}
    assert by[300].text == "card [CARD] and [IP], [PHONE]." and by[300].n_chars == len(by[300].text)
    assert "Quillfeather" not in by[101].text and "jane" not in by[101].text
    assert by[1].text is None and by[2].text == "" and by[1000].text == dict(frame(spark))[1000]
    assert not any(brute(r.text) for r in got)
    assert sum(r.doc_id == 4 for r in got) == 2


def test_mask_merges_overlaps():
    assert pii.mask("abcdefghij", [{"start": 2, "end": 6, "kind": "ip"}, {"start": 4, "end": 8, "kind": "card"}], []) == "ab[IP]ij"


def test_query_and_empty_table(spark, tmp_path):
    import hashlib

    from quarry.llm.queries import op8_pii
    rows = awkward() + [(300, "b@c.de 1.2.3.4 a@b.cd")]
    docs_of(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = op8_pii(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    r = next(r for r in got if r.doc_id == 300)
    assert r.spans == "email:0:6,email:15:21,ip:7:14" and r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    assert pii.personal_data(docs_of(spark, []), {"doc_id": F.col("doc_id")}).count() == 0
