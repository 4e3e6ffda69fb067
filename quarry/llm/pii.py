"""Operator 8, personal data: patterns, then information-theoretic sanitisation of what surrounds them.

Base spans: e-mail, IP address, card and phone numbers by fixed patterns. Each distinct value found is a protected
entity. Every term (word with a letter or digit) of a document that holds an entity is a context of it. From the whole corpus,

    PMI(entity; term) = log2( n(entity, term) * N / (n(entity) * n(term)) )   and   IC(entity) = log2( N / n(entity) )

with n counting documents (rows). PMI equals IC when the term occurs only in documents of the entity, so that it tells
which one it is. A term seen with the entity in ``MIN_TEXTS`` different texts is disclosed from
PMI >= GENERALISE * IC on: it is cut to its first ``PREFIX`` characters; from PMI >= REMOVE * IC on, or if it is that
short, it is removed. These are spans of kind ``term``, beside the base ones: every place of the term outside them, in every
document that holds the entity.

Scale: entities of a single text can disclose nothing and are left out first, by a bitmap of fixed size. Pairs of the others
and the terms of their documents are aggregated before any shuffle, so an entity in a third of all rows costs one row per
task and term. That also tells in how many of the entities' documents a term is; the other documents are counted per slice before
they are shuffled, and, but for the misses of a bitmap, only for candidates, in growing parts of them: the first ones are enough
to drop common words, so that the terms handed on from the rest are few. Places are read from the texts in a last pass, for disclosed pairs (a bitmap, then an exact join), so no
entity's terms are multiplied with its documents. Texts are never shuffled by detection. A document with e repeated entities
and t terms has e * t pairs, which are handed on a bounded number at a time.

Defined results: null or empty text has no spans. Repeated rows get the same spans each. Overlapping spans of
different kinds are all reported; sanitising masks their union, each run by the first kind in it.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import as_bytes, ascii_words, map_texts, prepare, slices, stored, text_hash, whole_row

#: The contract's patterns. The look-behind only spares scanning a run of digits again.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
KINDS = ("email", "ip", "card", "phone", "term")

#: Different texts that make evidence; told by the least and the greatest text hash.
MIN_TEXTS = 2
GENERALISE = 0.75
REMOVE = 0.9
PREFIX = 3
#: Stands for all entities (their hashes are not negative).
ANY = -1
#: Distinct terms, or pairs, that a task counts before it hands them on.
COUNTER_TERMS = 200_000
#: Ends of the parts in which the documents are counted, out of the last.
PARTS = (1, 6, 32)
#: Bits of a map (4 MB) that tells which entities, terms or pairs cannot be candidates; a power of two.
FILTER_BITS = 1 << 25

#: The word class of ``common.ascii_words``, for terms with their places.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from their at sign: the run before it, the domain after it."""
    spans, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        m = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if m:
            spans.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return spans


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """``(kind, start, end, value)`` by kind as listed, then start; the value is normalised."""
    out = [("email", a, b, text[a:b].translate(_LOWER)) for a, b in _emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
            if all(len(p) < 4 and int(p) <= 255 for p in parts):
                out.append(("ip", m.start(), m.end(), ".".join(parts)))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end(), d))
        for m in PHONE.finditer(text):
            if 9 <= len(d := _digits(m[0])) <= 15:
                out.append(("phone", m.start(), m.end(), d))
    return out


def entities_of(spans: list[tuple[str, int, int, str]]) -> list[int]:
    """A 63-bit hash of each distinct value."""
    return sorted({int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "big") >> 1
                   for kind, _, _, value in spans})


def terms_of(text: str) -> dict[str, list[int]]:
    """The places of each term of a text."""
    out: dict[str, list[int]] = {}
    for m in TERM.finditer(text):
        out.setdefault(m[0].translate(_LOWER), []).append(m.start())
    return {w: at for w, at in out.items() if any(c.isalnum() for c in w)}


def contexts(text: str, spans: list[tuple[str, int, int, str]]) -> list[tuple[int, str, int, int]]:
    """``(entity, term, start, end)`` for all terms of a text with these spans; the entity is a 63-bit hash."""
    terms = terms_of(text) if spans else {}
    return [(x, w, a, a + len(w)) for x in entities_of(spans) for w, at in terms.items() for a in at]


def outside(places: list[int], size: int, taken: list[tuple[int, int]]) -> list[int]:
    """The places whose ``size`` characters touch none of the disjoint sorted ``taken``."""
    out = []
    for a in places:
        k = bisect_left(taken, a + size, key=lambda t: t[0])
        if not k or taken[k - 1][1] <= a:
            out.append(a)
    return out


def merged(spans: list[tuple[str, int, int, str]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for _, a, b, _ in spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                   T.StructField("end", T.LongType())]))
_PA_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _find(texts: pa.Array) -> list[pa.Array]:
    spans, entities = [], []
    for text in texts.to_pylist():
        base = base_spans(text)
        spans.append([{"kind": k, "start": a, "end": b} for k, a, b, _ in base])
        entities.append(entities_of(base))
    return [pa.array(spans, _PA_SPANS), pa.array(entities, pa.list_(pa.int64()))]


def bitmap(df: DataFrame, value) -> np.ndarray:
    """``FILTER_BITS`` bits, one set per value (a non-negative long, modulo the size). Its size does not depend on their number."""
    bit = value.bitwiseAND(F.lit(FILTER_BITS - 1))
    words = (df.select(F.shiftright(bit, 5).cast("int").alias("w"), bit.bitwiseAND(F.lit(31)).cast("int").alias("i"))
             .select("w", F.expr("shiftleft(1L, i)").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")))
    out = np.zeros(FILTER_BITS // 32, "<u4")
    for batch in words.toArrow().to_batches():
        out[batch.column("w").to_numpy()] = batch.column("b").to_numpy()
    return out


def candidate_bits(candidates: DataFrame) -> np.ndarray:
    """The bitmap of the candidates' checksums."""
    return bitmap(candidates, F.crc32("term"))


def _has(bits: np.ndarray, value: int) -> bool:
    at = value & (FILTER_BITS - 1)
    return bool(int(bits[at >> 5]) >> (at & 31) & 1)


def pair_counts(docs: DataFrame, shared) -> DataFrame:
    """``(entity, term, n_both)``: documents with both, for pairs in ``MIN_TEXTS`` texts or more; shared: the broadcast bitmap of
    the entities. Under the entity ``ANY``, the documents of all of them with the term."""

    def run(batches):
        bits = shared.value
        counts: dict[tuple[int, str], list[int]] = {}

        def flush():
            pairs = list(counts)
            cols = [pa.array([x for x, _ in pairs], pa.int64()), pa.array([w for _, w in pairs], pa.string())]
            cols += [pa.array([v[k] for v in counts.values()], pa.int64()) for k in range(3)]
            counts.clear()
            return pa.RecordBatch.from_arrays(cols, names=["entity", "term", "n", "lo", "hi"])

        for batch in batches:
            for part in slices(batch, "text"):
                for text, th in zip(part.column("text").to_pylist(), part.column("__th").to_pylist()):
                    entities = [x for x in entities_of(base_spans(text)) if _has(bits, x)]
                    terms = terms_of(text) if entities else {}
                    for x in [ANY, *entities] if entities else ():
                        for w in terms:
                            seen = counts.get((x, w))
                            if seen is None:
                                counts[x, w] = [1, th, th]
                            else:
                                seen[0] += 1
                                seen[1] = min(seen[1], th)
                                seen[2] = max(seen[2], th)
                        if len(counts) > COUNTER_TERMS:
                            yield flush()
        if counts:
            yield flush()

    part = (docs.select(F.coalesce("text", F.lit("")).alias("text"), text_hash().alias("__th"))
            .mapInArrow(run, "entity long, term string, n long, lo long, hi long"))
    return (part.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .filter((F.col("entity") == ANY) | (F.col("lo") != F.col("hi"))).select("entity", "term", "n_both"))


def task_counts(docs: DataFrame, candidates: DataFrame, shared) -> DataFrame:
    """``(term, n)`` per task: its documents without a repeated entity that hold a term whose bit is set in the candidates' bitmap;
    shared as for ``pair_counts``, so that the two share out the documents. Other terms are dropped as often as the task has
    ``COUNTER_TERMS`` of them, so a term is handed on once a task, unless the task has that many candidates."""
    wanted = docs.sparkSession.sparkContext.broadcast(candidate_bits(candidates))

    def run(batches):
        known, bits = shared.value, wanted.value
        fresh: Counter = Counter()
        kept: Counter = Counter()

        def sift():
            words = [w for w in fresh if w not in kept]
            at = np.fromiter((zlib.crc32(w) % FILTER_BITS for w in words), np.int64, len(words))
            kept.update(dict.fromkeys((words[i] for i in np.flatnonzero(bits[at >> 5] >> (at & 31).astype(np.uint32) & 1)), 0))
            for w in fresh.keys() & kept.keys():
                kept[w] += fresh[w]
            fresh.clear()

        def out():
            rows = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in kept], pa.string()), pa.array(list(kept.values()), pa.int64())],
                                              names=["term", "n"])
            kept.clear()
            return rows

        for batch in batches:
            for part in slices(batch, "text"):
                for text, data in zip(part.column("text").to_pylist(), as_bytes(part.column("text"))):
                    if not any(_has(known, x) for x in entities_of(base_spans(text))):
                        fresh.update(set(ascii_words(data)))
                if len(fresh) > COUNTER_TERMS:
                    sift()
                if len(kept) > COUNTER_TERMS:
                    yield out()
        sift()
        if kept:
            yield out()

    return docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "term string, n long")


def term_counts(docs: DataFrame, candidates: DataFrame, shared) -> DataFrame:
    """``(term, n)``: documents without a repeated entity that hold each candidate term, over all these texts. The bitmap keeps most
    other terms out of the shuffle; the join is exact."""
    # summed first, so that the join has one row a term and not one for each task's
    return (task_counts(docs, candidates, shared).groupBy("term").agg(F.sum("n").alias("n"))
            .join(candidates.select("term"), "term", "left_semi"))


def whole_counts(docs: DataFrame, candidates: DataFrame, shared) -> DataFrame:
    """``(term, n)``: documents with each candidate term, for the candidates that can still disclose something; candidates:
    ``(term, n, most)``, the documents that ``pair_counts`` has counted and the most that a disclosing term can have.
    The documents are counted in growing parts (``PARTS``); terms that are beyond ``most`` with the parts so far (common words, as a rule)
    are dropped, which loses nothing, and are not handed on from the documents to come."""
    share = F.pmod(F.xxhash64("doc_id", text_hash()), F.lit(PARTS[-1]))
    left = candidates
    for lo, hi in zip((0, *PARTS), PARTS):
        part = docs.filter((share >= lo) & (share < hi))
        more = term_counts(part, left, shared).withColumnRenamed("n", "more")
        left = stored(left.join(more, "term", "left").select("term", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n"), "most")
                      .filter(F.col("n") <= F.col("most")), "pii-left")
    return left.select("term", "n")


def detect(docs: DataFrame, carry: dict[str, object]) -> DataFrame:
    """``carry`` columns plus ``spans`` (base kinds) and ``entities`` (their values' hashes), stored as a table."""
    prepare(docs.sparkSession)
    return stored(map_texts(docs, _find, [("spans", _SPANS), ("entities", T.ArrayType(T.LongType()))],
                            carry | {"__id": F.col("doc_id"), "__th": text_hash()}), "pii")


def disclosures(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``(entity, term, action)`` of the terms that disclose an entity; found: from ``detect``."""
    entities = stored(found.select("__th", F.explode("entities").alias("entity")).groupBy("entity")
                      .agg(F.count(F.lit(1)).alias("n_entity"), F.min("__th").alias("lo"), F.max("__th").alias("hi"))
                      .filter(F.col("lo") != F.col("hi")).select("entity", "n_entity"), "pii-entities")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(entities, F.col("entity")))
    pairs = stored(pair_counts(docs, shared), "pii-pairs")
    # the one row with the corpus size, joined on a constant key
    total = found.agg(F.count(F.lit(1)).alias("n_all")).withColumn("one", F.lit(1))
    ic = F.log2(F.col("n_all") / F.col("n_entity"))

    def pmi(n: str):
        return F.log2(F.col("n_both") * F.col("n_all") / (F.col("n_entity") * F.col(n)))

    # a term is in the entities' documents at least, so pairs that fail with this count fail with the whole one too
    least = pairs.filter(F.col("entity") == ANY).select("term", F.col("n_both").alias("n_least"))
    met = stored(pairs.filter(F.col("entity") != ANY).join(entities, "entity").join(least, "term").withColumn("one", F.lit(1))
                 .join(F.broadcast(total), "one").filter((ic > 0) & (pmi("n_least") >= GENERALISE * ic))
                 .select("entity", "term", "n_both", "n_entity", "n_all", "n_least"), "pii-met")
    # the count at which PMI = GENERALISE * IC, with room for rounding
    most = F.col("n_both") * F.col("n_all") / F.col("n_entity") / F.pow(F.lit(2.0), GENERALISE * ic) * (1 + 1e-6)
    candidates = stored(met.groupBy("term").agg(F.max("n_least").alias("n"), F.max(most).alias("most")), "pii-candidates")
    counts = stored(whole_counts(docs, candidates, shared), "pii-counts")
    return met.join(counts, "term").filter(pmi("n") >= GENERALISE * ic).select(
        "entity", "term", F.when((pmi("n") >= REMOVE * ic) | (F.length("term") <= PREFIX), "remove").otherwise("generalise").alias("action"))


def places(docs: DataFrame, told: DataFrame) -> DataFrame:
    """``(__id, __th, entity, term, at)``: the places outside base spans of terms whose pair may be in ``told``, once per
    document; a bitmap keeps most other pairs out."""
    key = F.crc32("term").bitwiseXOR(F.col("entity").bitwiseAND(F.lit(0xFFFFFFFF)))
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((bitmap(told, F.col("entity")), bitmap(told, key)))
    src = docs.select(F.col("doc_id").alias("__id"), text_hash().alias("__th"), F.coalesce("text", F.lit("")).alias("text"))
    schema = T.StructType([src.schema["__id"], src.schema["__th"], T.StructField("entity", T.LongType()),
                           T.StructField("term", T.StringType()), T.StructField("at", T.ArrayType(T.LongType()))])

    def run(batches):
        known, bits = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                rows: list[tuple] = []

                def flush():
                    row, x, w, at = zip(*rows)
                    take = pa.array(row, pa.int64())
                    rows.clear()
                    return pa.RecordBatch.from_arrays(
                        [part.column("__id").take(take), part.column("__th").take(take), pa.array(x, pa.int64()),
                         pa.array(w, pa.string()), pa.array(at, pa.list_(pa.int64()))], names=schema.names)

                for i, text in enumerate(part.column("text").to_pylist()):
                    base = base_spans(text)
                    entities = [x for x in entities_of(base) if _has(known, x)]
                    if not entities:
                        continue
                    taken = merged(base)
                    terms = [(w, zlib.crc32(w.encode()), at) for w, p in terms_of(text).items() if (at := outside(p, len(w), taken))]
                    for x in entities:
                        low = x & 0xFFFFFFFF
                        rows.extend((i, x, w, at) for w, crc, at in terms if _has(bits, crc ^ low))
                        if len(rows) > COUNTER_TERMS:
                            yield flush()
                if rows:
                    yield flush()

    return src.mapInArrow(run, schema).groupBy("__id", "__th", "entity", "term").agg(F.first("at").alias("at"))


def term_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``(__id, __th, terms)``: the spans of disclosing terms, for the documents that have any."""
    told = stored(disclosures(docs, found), "pii-terms")
    hit = places(docs, told).join(told, ["entity", "term"])
    at = hit.select("__id", "__th", "action", F.explode("at").alias("start"), F.length("term").alias("size"))
    # a term with two entities is removed if either says so
    worst = at.groupBy("__id", "__th", "start", (F.col("start") + F.col("size")).alias("end")).agg(F.max("action").alias("action"))
    return worst.groupBy("__id", "__th").agg(F.array_sort(F.collect_list(F.struct("start", "end", "action"))).alias("terms"))


def _with_terms(docs: DataFrame, found: DataFrame, near: DataFrame) -> DataFrame:
    """``found`` with the column ``terms``; rows without any entity are not joined."""
    terms = near.withColumnsRenamed({"__id": "__i", "__th": "__h"})
    some = found.filter(F.size("entities") > 0).join(
        terms, F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__th") == F.col("__h")), "left").drop("__i", "__h")
    none = F.lit(None).cast("array<struct<start:bigint,end:bigint,action:string>>")
    return some.unionByName(found.filter(F.size("entities") == 0).withColumn("terms", none)).withColumn(
        "terms", F.coalesce("terms", F.array().cast("array<struct<start:bigint,end:bigint,action:string>>")))


def personal_data(docs: DataFrame, carry: dict[str, object]) -> DataFrame:
    """``carry`` columns plus ``spans`` (base kinds as listed, by start) and ``terms`` (by start)."""
    found = detect(docs, carry)
    return _with_terms(docs, found, term_spans(docs, found)).select(*carry, "spans", "terms")


def joined(spans, kind: str | None = None):
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"] if kind is None else F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(text: str, spans: list[dict], terms: list[dict]) -> str:
    """The text with each base span replaced by its kind, removed terms blanked and others cut short."""
    cuts = [(s["start"], s["end"], f"[{s['kind'].upper()}]") for s in spans]
    cuts += [(s["start"], s["end"], "[TERM]" if s["action"] == "remove" else text[s["start"]:s["start"] + PREFIX] + "*") for s in terms]
    out, at = [], 0
    for a, b, put in sorted(cuts, key=lambda c: c[:2]):
        if a >= at:
            out += [text[at:a], put]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked and ``n_chars`` (if there) counted anew."""
    found = detect(docs, {"row": whole_row(docs)})
    plain = docs.columns
    both = _with_terms(docs, found, term_spans(docs, found))
    dirty = both.filter(F.size("spans") > 0).select("row", F.col("row.text").alias("text"), "spans", "terms")
    schema = T.StructType([T.StructField("row", found.schema["row"].dataType), T.StructField("clean", T.StringType())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                clean = [mask(t, s, w) for t, s, w in zip(*(part.column(c).to_pylist() for c in ("text", "spans", "terms")))]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(clean, pa.string())], names=["row", "clean"])

    clean = dirty.mapInArrow(run, schema)
    same = found.filter(F.size("spans") == 0).select("row", F.col("row.text").alias("clean"))

    def value(c: str):
        if c == "text":
            return F.col("clean")
        if c == "n_chars":
            kind = docs.schema["n_chars"].dataType
            changed = F.length("clean").cast(kind)
            return F.when(F.col("clean").eqNullSafe(F.col("row.text")), F.col("row.n_chars")).otherwise(changed)
        return F.col("row")[c]

    return clean.unionByName(same).select(*[value(c).alias(c) for c in plain])
