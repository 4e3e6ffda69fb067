"""Operator 3, language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed 1- to 3-grams of the lower-cased letters, runs of other characters being one space. Document
frequencies are counted over all permitted labelled texts. Weights are trained with the follow-the-regularised-
leader rule (per-coordinate rates, elastic-net penalty): ``GROUPS - 1`` groups of the sample each run an epoch from the
common state, then the states are averaged; the last group is kept for temperature calibration.

Bounds: about ``max_train`` texts are used to fit, chosen by hash within each language: all languages get the same number, rare ones
all of their texts, and what these leave over goes to the others. The temperature is calibrated with weights that restore the
languages' shares. State and weights are ``BUCKETS`` x languages numbers, at most ``MAX_LANGUAGES`` languages (an error beyond). Prediction reads every whole text; a long one is read in pieces of a fixed length.

Defined results: ``und`` with score 0 if a text is null or has no letter, or if nothing could be learned. Equal
scores go to the first language in order. Rows that repeat are predicted each; in training they count once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import crc_of_id, map_texts, prepare, slices, stored, text_hash

MAX_TRAIN = 8_000
MAX_LANGUAGES = 1_000
GRAMS = (1, 2, 3)
BUCKETS = 1 << 15
GROUPS = 9
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-4, 1e-4
TEMPERATURES = np.exp(np.linspace(np.log(0.05), np.log(5.0), 80))
UNKNOWN = "und"
_PIECE = 1 << 18

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters; made once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def _hashed(codes: np.ndarray) -> np.ndarray:
    """Buckets of all n-grams of a code-point array."""
    out, h = [], np.zeros(len(codes), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if len(codes) < n:
            break
        h = (h[:len(codes) - n + 1] * np.uint64(0x100000001B3)) ^ codes[n - 1:].astype(np.uint64)
        if n in GRAMS:
            mixed = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            out.append((mixed >> np.uint64(64 - (BUCKETS - 1).bit_length())).astype(np.int64))
    return np.concatenate(out)


def gram_counts(text: str) -> np.ndarray | None:
    """Counts per bucket, or None without a letter. Pieces overlap so that no n-gram is lost or counted twice."""
    counts = None
    reach = max(GRAMS) - 1
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    keep = letter | np.r_[True, letter[:-1]]
    flat = np.where(letter, codes, 32)[keep]
    flat = np.pad(flat, (int(letter[0]), int(letter[-1])), constant_values=32)
    for lo in range(0, len(flat), _PIECE):
        part = np.bincount(_hashed(flat[lo:lo + _PIECE + reach]), minlength=BUCKETS)
        if lo + _PIECE < len(flat):
            part -= np.bincount(_hashed(flat[lo + _PIECE:lo + _PIECE + reach]), minlength=BUCKETS)
        counts = part if counts is None else counts + part
    return counts


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Sparse TF-IDF vector of unit length: buckets and values."""
    counts = gram_counts(text)
    if counts is None:
        return None
    at = np.flatnonzero(counts)
    x = (1 + np.log(counts[at])) * idf[at]
    norm = np.sqrt((x * x).sum())
    return (at, x / norm) if norm > 0 else (at, x)


def held_out_rows(column: str = "doc_id"):
    return F.coalesce(crc_of_id(column) % 4 == 2, F.lit(False))


def permitted(docs: DataFrame) -> DataFrame:
    return docs.filter(~held_out_rows() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", "text", "lang")


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Texts per bucket and texts in all, summed within tasks first."""
    def run(batches):
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    counts = gram_counts(text)
                    if counts is not None:
                        seen += counts > 0
                        n += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at]), pa.array(np.r_[n, seen[at]])], names=["bucket", "n"])

    sums = rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(BUCKETS), 0
    for r in sums:
        if r["bucket"] < 0:
            n = r["n"]
        else:
            df[r["bucket"]] = r["n"]
    return df, n


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The leader of the regularised past losses: exact zeros where the L1 penalty outweighs them."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def ftrl_pass(rows: list[tuple[np.ndarray, np.ndarray, int]], z: np.ndarray, n: np.ndarray) -> None:
    """One online pass over the rows; changes the state in place."""
    for at, x, y in rows:
        za, na = z[at], n[at]
        w = weights_of(za, na)
        s = x @ w
        p = np.exp(s - s.max())
        p /= p.sum()
        p[y] -= 1
        g = x[:, None] * p[None, :]
        sigma = (np.sqrt(na + g * g) - np.sqrt(na)) / ALPHA
        z[at] = za + g - sigma * w
        n[at] = na + g * g


def _vectors(group: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray, int]]:
    return [(np.asarray(a), np.asarray(x, float), int(y)) for a, x, y in zip(group["at"], group["x"], group["y"])]


def quota(sizes: list[int], limit: int) -> float:
    """The largest number ``q`` for which ``min(size, q)`` adds up to the limit at most (the largest size, if all fit)."""
    left = limit
    for i, size in enumerate(sorted(sizes)):
        q = left / (len(sizes) - i)
        if size > q:
            return q
        left -= size
    return float(max(sizes, default=0))


def fit(docs: DataFrame, max_train: int = MAX_TRAIN) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """Languages, inverse document frequencies, weights ``(buckets, languages)`` and temperature."""
    prepare(docs.sparkSession)
    spark = docs.sparkSession
    rows = permitted(docs)
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = [r["lang"] for r in sizes]
    df, n_docs = document_frequencies(rows)
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    if not langs or not n_docs:
        return [], idf, np.zeros((BUCKETS, 0)), 1.0
    each = quota([r["n"] for r in sizes], max_train)
    shares = [min(1.0, each / r["n"]) for r in sizes]
    hashed = F.pmod(F.xxhash64("doc_id", text_hash()), F.lit(1 << 31))
    shared = spark.sparkContext.broadcast((langs, idf))

    def of(texts: pa.Array) -> list[pa.Array]:
        _, scale = shared.value
        found = [vector(t, scale) for t in texts.to_pylist()]
        return [pa.array([None if v is None else v[0] for v in found], pa.list_(pa.int32())),
                pa.array([None if v is None else v[1].astype(np.float32) for v in found], pa.list_(pa.float32()))]

    number = F.array_position(F.lit(langs), F.col("lang")).cast("int") - 1
    below = F.get(F.lit([int(x * (1 << 31)) for x in shares]), number)
    chosen = (rows.withColumn("k", hashed).filter(F.col("k") < below)
              .withColumn("h", text_hash()).dropDuplicates(["doc_id", "h"]))
    sample = stored(map_texts(chosen, of, [("at", T.ArrayType(T.IntegerType())), ("x", T.ArrayType(T.FloatType()))],
                              {"doc_id": F.col("doc_id"), "y": number,
                               "grp": F.pmod(F.xxhash64("doc_id", F.lit("group")), F.lit(GROUPS)).cast("int")})
                    .filter("at IS NOT NULL"), "langid-sample")
    shape = (BUCKETS, len(langs))
    z, n = np.zeros(shape), np.zeros(shape)
    for _ in range(EPOCHS):
        state = spark.sparkContext.broadcast((z.astype(np.float32), n.astype(np.float32)))

        def epoch(group: pd.DataFrame) -> pd.DataFrame:
            own_z, own_n = (a.astype(float) for a in state.value)
            ftrl_pass(_vectors(group.sort_values("doc_id")), own_z, own_n)
            return pd.DataFrame({"z": [own_z.astype(np.float32).tobytes()], "n": [own_n.astype(np.float32).tobytes()], "rows": [len(group)]})

        # one row per group: the number of groups is fixed
        parts = (sample.filter(F.col("grp") < GROUPS - 1).groupBy("grp")
                 .applyInPandas(epoch, "z binary, n binary, rows long").collect())
        total = sum(r["rows"] for r in parts)
        if not total:
            break
        z = sum(np.frombuffer(r["z"], np.float32).reshape(shape) * (r["rows"] / total) for r in parts).astype(float)
        n = sum(np.frombuffer(r["n"], np.float32).reshape(shape) * (r["rows"] / total) for r in parts).astype(float)
    w = weights_of(z, n)
    return langs, idf, w, calibrate(sample.filter(F.col("grp") == GROUPS - 1), w, [1 / x for x in shares])


def calibrate(rows: DataFrame, w: np.ndarray, stands_for: list[float]) -> float:
    """The temperature with the least log loss on rows that were not trained on; a row of language ``y`` counts ``stands_for[y]`` times."""
    shared = rows.sparkSession.sparkContext.broadcast(w)

    def losses(batches):
        total, n = np.zeros(len(TEMPERATURES)), 0
        for batch in batches:
            for at, x, y in zip(*(batch.column(c).to_pylist() for c in ("at", "x", "y"))):
                s = np.asarray(x) @ shared.value[at]
                scaled = s[None, :] / TEMPERATURES[:, None]
                top = scaled.max(axis=1)
                total += stands_for[y] * (np.log(np.exp(scaled - top[:, None]).sum(axis=1)) + top - scaled[:, y])
                n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "loss"])

    best = rows.select("at", "x", "y").mapInArrow(losses, "i long, loss double").groupBy("i").agg(F.sum("loss").alias("loss")).orderBy("loss", "i").first()
    return float(TEMPERATURES[best["i"]]) if best else 1.0


def predict(docs: DataFrame, carry: dict[str, object], langs: list[str], idf: np.ndarray, w: np.ndarray, temperature: float) -> DataFrame:
    """``carry`` columns plus ``lang_pred`` and ``score``, from the text alone."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((langs, idf, w, temperature))

    def of(texts: pa.Array) -> list[pa.Array]:
        names, scale, weights, t = shared.value
        lang, score = [], []
        for text in texts.to_pylist():
            v = vector(text, scale) if names else None
            if v is None:
                lang.append(UNKNOWN)
                score.append(0.0)
                continue
            s = v[1] @ weights[v[0]] / t
            p = np.exp(s - s.max())
            best = int(p.argmax())
            lang.append(names[best])
            score.append(float(p[best] / p.sum()))
        return [pa.array(lang, pa.string()), pa.array(score, pa.float64())]

    return map_texts(docs, of, [("lang_pred", T.StringType()), ("score", T.DoubleType())], carry)


def languages(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every document; learns outside the held-out part."""
    out = predict(docs, {"doc_id": F.col("doc_id")}, *fit(docs, max_train))
    return out.select("doc_id", held_out_rows().alias("held_out"), "lang_pred", "score")
