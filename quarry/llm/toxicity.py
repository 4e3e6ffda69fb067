"""Operator 1, toxicity by weak supervision.

1. Voters. On labelled training documents, words, word beginnings and document patterns (shouting, stretched letters,
   runs of exclamation marks) are counted per label. A feature that passes a G-test at the level where none of all
   counted features would pass by chance becomes a lexicon or pattern voter; the strongest ``VOTERS`` vote on the label.
   The label itself is one more voter, the annotator, whose accuracy is estimated like the others'.
2. Label model. A two-class generative model with a firing rate per voter and class, fitted by EM. Voters that fire
   together within a class (word and its beginning, say) are correlated: each vote's log ratio is divided by one plus
   its correlations, so that a cluster of dependent voters counts about once. It gives each document a
   posterior label.
3. Classifier. A logistic regression (Spark ML) over all passing features, trained on the posterior labels: each
   document once as toxic and once as clean, weighted by its posterior.

Sample bound: at most about ``max_train`` labelled documents are used to fit (all, if there are fewer), chosen by hash.
The models held by driver and tasks are bounded by ``VOTERS`` and ``FEATURES``. Scoring reads every whole text.

Defined results: null and empty texts get the score of a text without features. Labels of one document that
differ count as toxic if any does. Without both classes in training, the score is the smoothed share of toxic ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import crc_of_id, map_texts, prepare, slices, stored, text_hash

MAX_TRAIN = 20_000
VOTERS = 256
FEATURES = 4096
BEGINNINGS = (3, 4, 5, 6, 7)
#: Numbers of occurrences that make a feature of their own.
OFTEN = (2, 3)
EM_ROUNDS = 8
#: Tasks over the vote patterns, of which there are at most as many as training documents.
PATTERN_TASKS = 4
PREDICT_AT = 0.7
#: Distinct features that a task counts, and words whose features a worker keeps, before it starts anew.
COUNTER_KEYS = 300_000
CACHE_WORDS = 300_000

WORD = re.compile(r"[^\W\d_]+")
STRETCHED = re.compile(r"([^\W\d_])\1\1\1")
BANGS = re.compile(r"[!?]{3,}")

_CACHES: dict[str, dict] = {}


def word_features(word: str) -> list[str]:
    return ["w:" + word] + ["p:" + word[:k] for k in BEGINNINGS if len(word) > k]


def pattern_features(text: str, words: list[str]) -> list[str]:
    out = []
    if STRETCHED.search(text):
        out.append("x:stretched")
    if BANGS.search(text):
        out.append("x:bangs")
    if len(words) >= 5 and sum(w.isupper() for w in words) > 0.3 * len(words):
        out.append("x:shouting")
    return out


def often(feature: str, n: int) -> list[str]:
    """The feature, and a feature of its own for each number of occurrences that it reaches."""
    return [feature] + [f"{feature}#{k}" for k in OFTEN if n >= k]


def features(text: str) -> set[str]:
    """All features of a text, each once."""
    words = WORD.findall(text)
    counts: Counter = Counter()
    for w, n in Counter(w.lower() for w in words).items():
        for f in word_features(w):
            counts[f] += n
    out = set(pattern_features(text, words))
    for f, n in counts.items():
        out.update(often(f, n))
    return out


def known_features(text: str, vocabulary: dict[str, int], bases: set[str], cache: dict[str, tuple]) -> set[int]:
    """The features of a text that are in the vocabulary; words are looked up once per worker. ``bases`` holds the
    features without their numbers of occurrences."""
    words = WORD.findall(text)
    found = {vocabulary[p] for p in pattern_features(text, words) if p in vocabulary}
    if len(cache) > CACHE_WORDS:
        cache.clear()
    get = cache.get
    counts: dict[str, int] = {}
    for w, n in Counter(words).items():
        hit = get(w)
        if hit is None:
            hit = cache[w] = tuple(f for f in word_features(w.lower()) if f in bases)
        for f in hit:
            counts[f] = counts.get(f, 0) + n
    for f, n in counts.items():
        found.update(vocabulary[x] for x in often(f, n) if x in vocabulary)
    return found


def bases_of(vocabulary: dict[str, int]) -> set[str]:
    return {f.split("#")[0] for f in vocabulary}


def _cache(key: str) -> dict:
    if key not in _CACHES:
        _CACHES.clear()
        _CACHES[key] = {}
    return _CACHES[key]


def training_rows(docs: DataFrame, labels: DataFrame, held_out, max_train: int) -> DataFrame:
    """``(doc_id, text, y)``: labelled documents outside the held-out part, about ``max_train`` at most."""
    known = labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y"))
    known = known.filter(~held_out & F.col("doc_id").isNotNull())
    share = min(1.0, max_train / max(1, known.count()))
    # a 31-bit hash below the share's part of its range
    known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) < F.lit(int(share * (1 << 31))))
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id")
            .withColumn("h", text_hash()).dropDuplicates(["doc_id", "h"]).drop("h"))


def count_features(rows: DataFrame) -> DataFrame:
    """``(feature, pos, neg)``: documents of each class with the feature."""
    def run(batches):
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def flush():
            keys = list(counts[0].keys() | counts[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string())] + [pa.array([counts[y][k] for k in keys], pa.int64()) for y in (1, 0)], names=["feature", "pos", "neg"])
            counts[0].clear()
            counts[1].clear()
            return out

        for batch in batches:
            for part in slices(batch, "text"):
                for text, y in zip(part.column("text").to_pylist(), part.column("y").to_pylist()):
                    counts[y].update(features(text))
                    if len(counts[0]) + len(counts[1]) > COUNTER_KEYS:
                        yield flush()
        if counts[0] or counts[1]:
            yield flush()

    return (rows.select("text", "y").mapInArrow(run, "feature string, pos long, neg long")
            .groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def select_features(counts: DataFrame, n_pos: int, n_neg: int, limit: int) -> list[tuple[str, int, int]]:
    """The features that pass the G-test, the strongest first (ties by name): ``(feature, pos, neg)``."""
    n = n_pos + n_neg

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    fires = F.col("pos") + F.col("neg")
    g = 2 * (part(F.col("pos"), fires * n_pos / n) + part(F.col("neg"), fires * n_neg / n)
             + part(n_pos - F.col("pos"), (n - fires) * n_pos / n) + part(n_neg - F.col("neg"), (n - fires) * n_neg / n))
    tested = counts.withColumn("g", g)
    level = 2 * math.log(max(2, counts.count()))
    rows = tested.filter((F.col("g") > level) & (fires >= 3)).orderBy(F.desc("g"), "feature").limit(limit).collect()
    return [(r["feature"], r["pos"], r["neg"]) for r in rows]


class LabelModel:
    """Class prior, firing rates ``(voters, 2)`` and the weight of each vote; the annotator is the last voter."""

    def __init__(self, prior: float, rates: np.ndarray):
        self.prior, self.rates = prior, rates
        self.weight = np.ones(len(rates))

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        """P(toxic) of rows of a 0/1 matrix of votes."""
        on = np.log(self.rates[:, 1] / self.rates[:, 0])
        off = np.log((1 - self.rates[:, 1]) / (1 - self.rates[:, 0]))
        z = math.log(self.prior / (1 - self.prior)) + fired @ (self.weight * on) + (1 - fired) @ (self.weight * off)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _votes(batch: pa.RecordBatch, m: int) -> np.ndarray:
    out = np.zeros((batch.num_rows, m + 1))
    for i, ids in enumerate(batch.column("votes").to_pylist()):
        out[i, ids] = 1
    out[:, m] = batch.column("y").to_numpy()
    return out


def fit_label_model(votes: DataFrame, m: int, n_pos: int, n: int) -> LabelModel:
    """EM over distinct vote patterns ``(votes, y, n)``; each round is one aggregate over them."""
    model = LabelModel(0.5, np.full((m + 1, 2), 0.5))

    def totals(expect) -> dict[str, np.ndarray]:
        """Sums over the patterns of what ``expect`` makes of them, by name."""
        def run(batches):
            sums: dict[str, np.ndarray] = {}
            for batch in batches:
                for name, values in expect(_votes(batch, m), batch.column("n").to_numpy().astype(float)).items():
                    flat = np.asarray(values, float).ravel()
                    sums[name] = sums[name] + flat if name in sums else flat
            for name, flat in sums.items():  # only what is not zero
                at = np.flatnonzero(flat)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(flat[at])], names=["name", "i", "x"])

        rows = (votes.coalesce(PATTERN_TASKS).mapInArrow(run, "name string, i long, x double")
                .groupBy("name", "i").agg(F.sum("x").alias("x")).collect())
        out = {"n": np.zeros(2), "f1": np.zeros(m + 1), "f0": np.zeros(m + 1), "c1": np.zeros((m + 1) ** 2), "c0": np.zeros((m + 1) ** 2)}
        for r in rows:
            out[r["name"]][r["i"]] = r["x"]
        return out

    def rates(t: dict[str, np.ndarray]) -> tuple[float, np.ndarray]:
        n1, n0 = t["n"][0], t["n"][1]
        theta = np.stack([(t["f0"] + 0.5) / (n0 + 1), (t["f1"] + 0.5) / (n1 + 1)], axis=1)
        return (n1 + 0.5) / (n0 + n1 + 1), np.clip(theta, 1e-6, 1 - 1e-6)

    def expected(p: np.ndarray, fired: np.ndarray, k: np.ndarray) -> dict:
        return {"n": [(p * k).sum(), ((1 - p) * k).sum()], "f1": (p * k) @ fired, "f0": ((1 - p) * k) @ fired}

    # the first rates take the annotator at his word, up to a tenth
    model.prior, model.rates = rates(totals(lambda f, k: expected(0.1 + 0.8 * f[:, m], f, k)))
    t = totals(lambda f, k: {"n": [(f[:, m] * k).sum(), ((1 - f[:, m]) * k).sum()],
                             "c1": (f * (f[:, m] * k)[:, None]).T @ f, "c0": (f * ((1 - f[:, m]) * k)[:, None]).T @ f})
    # correlation of the votes within each class; a vote counts less the more others move with it
    for name, size in (("c1", t["n"][0]), ("c0", t["n"][1])):
        c = t[name].reshape(m + 1, m + 1) / max(size, 1.0)
        mean = np.diag(c)
        sd = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
        rho = np.clip((c - np.outer(mean, mean)) / np.outer(sd, sd), 0, 1)
        rho[mean * size < 2, :] = rho[:, mean * size < 2] = 0
        np.fill_diagonal(rho, 0)
        rho[m, :] = rho[:, m] = 0
        rho[rho < 0.1] = 0
        model.weight = np.minimum(model.weight, 1 / (1 + rho.sum(axis=1)))
    for _ in range(EM_ROUNDS):
        now = LabelModel(model.prior, model.rates)
        now.weight = model.weight
        model.prior, model.rates = rates(totals(lambda f, k, now=now: expected(now.posterior(f), f, k)))
    return model


def fit(docs: DataFrame, labels: DataFrame, held_out, max_train: int = MAX_TRAIN) -> tuple[dict[str, int], np.ndarray, float]:
    """Vocabulary, weights and intercept of the classifier."""
    prepare(docs.sparkSession)
    rows = stored(training_rows(docs, labels, held_out, max_train), "toxicity-train")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("pos")).first()
    n, n_pos = size["n"], size["pos"]
    base = math.log((n_pos + 0.5) / (n - n_pos + 0.5))
    if not 0 < n_pos < n:
        return {}, np.empty(0), base
    chosen = select_features(stored(count_features(rows), "toxicity-counts"), n_pos, n - n_pos, FEATURES)
    if not chosen:
        return {}, np.empty(0), base
    vocabulary = {f: i for i, (f, _, _) in enumerate(chosen)}
    m = min(VOTERS, len(chosen))

    def found(texts: pa.Array) -> list[pa.Array]:
        cache: dict = {}
        bases = bases_of(vocabulary)
        return [pa.array([sorted(known_features(t, vocabulary, bases, cache)) for t in texts.to_pylist()], pa.list_(pa.int32()))]

    seen = stored(map_texts(rows, found, [("ids", T.ArrayType(T.IntegerType()))], {"y": F.col("y")})
                  .withColumn("votes", F.filter("ids", lambda i: i < m)), "toxicity-votes")
    model = fit_label_model(stored(seen.groupBy("votes", "y").agg(F.count(F.lit(1)).alias("n")), "toxicity-patterns"), m, n_pos, n)

    def posterior(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("ids"), pa.array(model.posterior(_votes(batch, m)))], names=["ids", "p"])

    soft = seen.mapInArrow(posterior, "ids array<int>, p double")
    both = soft.select(F.transform("ids", lambda i: i.cast("string")).alias("names"), F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight")))).alias("s")).select("names", "s.*")
    vectors = CountVectorizerModel.from_vocabulary([str(i) for i in range(len(chosen))], "names", "features")
    learner = LogisticRegression(maxIter=100, regParam=1e-6, elasticNetParam=0.0, standardization=False, weightCol="weight")
    line = learner.fit(vectors.transform(both.filter("weight > 1e-6")).select("label", "weight", "features"))
    return vocabulary, line.coefficients.toArray(), float(line.intercept)


def held_out_rows(column: str = "doc_id"):
    return F.coalesce(crc_of_id(column) % 3 == 1, F.lit(False))


def score(docs: DataFrame, carry: dict[str, object], vocabulary: dict[str, int], weights: np.ndarray, intercept: float) -> DataFrame:
    """``carry`` columns plus ``score``, from the text alone."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocabulary, weights.tolist(), intercept))
    key = str(hash((tuple(vocabulary), float(weights.sum()), intercept)))

    def of(texts: pa.Array) -> list[pa.Array]:
        words, w, b = shared.value
        cache, bases = _cache(key), bases_of(words)
        out = []
        for text in texts.to_pylist():
            z = b + sum(w[i] for i in sorted(known_features(text, words, bases, cache)))
            out.append(1 / (1 + math.exp(-min(60.0, max(-60.0, z)))))
        return [pa.array(out, pa.float64())]

    return map_texts(docs, of, [("score", T.DoubleType())], carry)


def toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every document; learns outside the held-out part."""
    vocabulary, weights, intercept = fit(docs, labels, held_out_rows(), max_train)
    out = score(docs, {"doc_id": F.col("doc_id")}, vocabulary, weights, intercept)
    return out.select("doc_id", held_out_rows().alias("held_out"), "score", (F.col("score") >= PREDICT_AT).cast("int").alias("predicted"))
