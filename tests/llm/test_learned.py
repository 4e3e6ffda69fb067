import random
import zlib

import numpy as np
import pytest

from quarry.llm import langid, toxicity
from tests.llm.helpers import awkward, docs_of

SOUNDS = {"en": ["the", "and", "ing", "tion", "er", "wh"], "fr": ["eau", "oi", "é", "que", "ç", "aux"], "de": ["sch", "ung", "ä", "keit", "pf", "ß"]}


def text_in(rng, lang, n=40):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def language_rows():
    rng = random.Random(1)
    rows = []
    for i in range(300):
        lang = rng.choice(list(SOUNDS))
        rows.append((i, text_in(rng, lang), lang, "s", 1))
    return rows + [(1000 + k, t, None, None, None) for k, (_, t) in enumerate(awkward())] + [(2000, "123 456 !!", "en", "s", 1), (2000, "123 456 !!", "en", "s", 1)]


def test_language_of_held_out_texts(spark, language_rows):
    got = langid.languages(docs_of(spark, language_rows).withColumnRenamed("n_chars", "score"))
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(language_rows)
    truth = {r[0]: r[2] for r in language_rows if r[0] < 1000}
    held = [d for d in truth if by[d].held_out]
    assert held and all(by[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d in truth)
    assert sum(by[d].lang_pred == truth[d] for d in held) >= 0.98 * len(held)
    assert by[1000].lang_pred == by[2000].lang_pred == "und" and by[2000].score == 0
    assert all(r.lang_pred in {"und", *SOUNDS} and 0 <= r.score <= 1 for r in by.values())


def test_language_ids_do_not_leak(spark, language_rows):
    """Held-out rows teach nothing: with their labels garbled, predictions stay."""
    garbled = [(d, t, "xx" if zlib.crc32(str(d).encode()) % 4 == 2 and lang else lang, s, n) for d, t, lang, s, n in language_rows]
    a, b = (sorted(map(repr, langid.languages(docs_of(spark, rows)).select("doc_id", "lang_pred").collect())) for rows in (language_rows, garbled))
    assert a == b


def test_pieces_of_long_texts_count_once(monkeypatch):
    text = text_in(random.Random(2), "fr", 500)
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "_PIECE", 97)
    assert (langid.gram_counts(text) == whole).all()
    assert langid.gram_counts("") is None and langid.gram_counts("12 !") is None


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(0)
    rows = [(np.array([y, 5 + int(rng.integers(0, 40))]), np.array([0.9, 0.3]), int(y)) for y in rng.integers(0, 3, 400)]
    z, n = np.zeros((64, 3)), np.zeros((64, 3))
    langid.ftrl_pass(rows, z, n)
    w = langid.weights_of(z, n)
    assert (w[:3].argmax(axis=1) == [0, 1, 2]).all() and (w[50:] == 0).all()


def test_nothing_to_learn(spark):
    got = langid.languages(docs_of(spark, [(1, "abc", None, "s", 1)])).collect()
    assert [r.lang_pred for r in got] == ["und"]
    assert langid.languages(docs_of(spark, [])).count() == 0


def toxic_rows(rng, n=600):
    stems, docs, labels = ["blarg", "snork"], [], []
    for i in range(n):
        words = text_in(rng, "en", 30).split()
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(stems) + "".join(rng.choice(SOUNDS["en"]) for _ in range(2)))
        docs.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_of_held_out_texts(spark):
    docs, labels = toxic_rows(random.Random(3))
    extra = [(5000 + k, t, None, None, None) for k, (_, t) in enumerate(awkward())]
    frame = spark.createDataFrame(labels + [(0, 1, None), (9999, 1, 1)], "doc_id BIGINT, quality INT, toxic INT")
    got = toxicity.toxicity(docs_of(spark, docs + extra).withColumnRenamed("n_chars", "score"), frame)
    by = {r.doc_id: r for r in got.collect()}
    truth = {d: y for d, _, y in labels}
    held = [d for d in truth if by[d].held_out]
    assert all(by[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d in truth)
    assert sum(by[d].predicted == truth[d] for d in held) >= 0.97 * len(held)
    assert all(by[d].predicted == int(by[d].score >= 0.7) and 0 <= by[d].score <= 1 for d in by)
    assert by[5000].score == by[5001].score and got.count() == len(docs) + len(extra)


def test_label_model_repairs_a_noisy_annotator(spark):
    """Six independent voters outvote a label that is wrong for one document in ten."""
    rng = random.Random(4)
    rows, truth = [], []
    for _ in range(1500):
        y = rng.random() < 0.4
        votes = [j for j in range(6) if rng.random() < (0.85 if y else 0.05)]
        noisy = int(y) ^ (rng.random() < 0.1)
        rows.append((votes, noisy, 1))
        truth.append(int(y))
    frame = spark.createDataFrame(rows, "votes array<int>, y int, n long").groupBy("votes", "y").sum("n").withColumnRenamed("sum(n)", "n")
    model = toxicity.fit_label_model(frame, 6, 600, 1500)
    fired = np.zeros((len(rows), 7))
    for i, (votes, y, _) in enumerate(rows):
        fired[i, votes] = 1
        fired[i, 6] = y
    right = ((model.posterior(fired) > 0.5).astype(int) == truth).mean()
    assert right > 0.97 > np.mean([r[1] == t for r, t in zip(rows, truth)])


def test_correlated_votes_count_less(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(800):
        y = rng.random() < 0.5
        a, b = rng.random() < (0.8 if y else 0.2), rng.random() < (0.8 if y else 0.2)
        rows.append((([0, 1, 2] if a else []) + ([3] if b else []), int(y), 1))  # three copies of one voter
    frame = spark.createDataFrame(rows, "votes array<int>, y int, n long")
    model = toxicity.fit_label_model(frame, 4, 400, 800)
    assert (model.weight[:3] < 0.4).all() and model.weight[3] > 0.9


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    got = toxicity.toxicity(docs_of(spark, awkward()), none).collect()
    assert len(got) == 10 and len({r.score for r in got}) == 1
    assert toxicity.toxicity(docs_of(spark, []), none).count() == 0


def test_vectors_and_steps_equal_plain_ones():
    """TF-IDF by a dictionary of n-grams, FTRL one coordinate at a time."""
    text, idf = "Où est-ce que l'eau? " * 3, np.linspace(0.5, 2.0, langid.BUCKETS)
    flat = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    counts = {}
    for n in langid.GRAMS:
        for i in range(len(flat) - n + 1):
            h = 0
            for c in flat[i:i + n]:
                h = (h * 0x100000001B3 & (1 << 64) - 1) ^ ord(c)
            b = ((h + n) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - (langid.BUCKETS - 1).bit_length())
            counts[b] = counts.get(b, 0) + 1
    plain = {b: (1 + np.log(k)) * idf[b] for b, k in counts.items()}
    norm = sum(x * x for x in plain.values()) ** 0.5
    at, x = langid.vector(text, idf)
    assert sorted(plain) == at.tolist() and np.allclose([plain[b] / norm for b in sorted(plain)], x)

    rng = np.random.default_rng(3)
    rows = [(rng.choice(30, 4, replace=False), rng.random(4), int(rng.integers(0, 3))) for _ in range(40)]
    z, n = np.zeros((30, 3)), np.zeros((30, 3))
    langid.ftrl_pass(rows, z, n)
    pz, pn = [[0.0] * 3 for _ in range(30)], [[0.0] * 3 for _ in range(30)]

    def weight(b, c):
        if abs(pz[b][c]) <= langid.L1:
            return 0.0
        return -(pz[b][c] - np.sign(pz[b][c]) * langid.L1) / ((langid.BETA + pn[b][c] ** 0.5) / langid.ALPHA + langid.L2)

    for at, x, y in rows:
        w = {(b, c): weight(b, c) for b in at for c in range(3)}
        e = [np.exp(sum(v * w[b, c] for b, v in zip(at, x))) for c in range(3)]
        for b, v in zip(at, x):
            for c in range(3):
                g = v * (e[c] / sum(e) - (c == y))
                sigma = ((pn[b][c] + g * g) ** 0.5 - pn[b][c] ** 0.5) / langid.ALPHA
                pz[b][c] += g - sigma * w[b, c]
                pn[b][c] += g * g
    assert np.allclose(z, pz) and np.allclose(n, pn)


def test_rare_languages_are_learned(spark):
    """A language with one text in 200 gets all its texts into a sample of one in 15."""
    rng = random.Random(11)
    rows = [(i, text_in(rng, "de" if i % 200 == 3 else ("en", "fr")[i % 2], 25), None, "s", 1) for i in range(4000)]
    rows = [(d, t, "de" if d % 200 == 3 else ("en", "fr")[d % 2], s, n) for d, t, _, s, n in rows]
    by = {r.doc_id: r for r in langid.languages(docs_of(spark, rows), max_train=270).collect()}
    rare = [d for d in by if d % 200 == 3]
    assert sum(by[d].lang_pred == "de" for d in rare) == len(rare)
    assert sum(by[d].lang_pred == lang for d, _, lang, _, _ in rows) >= 0.98 * len(rows)
    assert langid.quota([5, 100, 100], 105) == 50 and langid.quota([3, 4], 100) == 4 and langid.quota([], 5) == 0
