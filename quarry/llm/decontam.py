"""Operator 10, benchmark decontamination: one Aho-Corasick automaton over the test items.

The windows of all items (13 consecutive normalised words; an item of fewer words is one window) become
the patterns of one automaton over word ids. Each text is normalised once and scanned once; a match ends
at a word index, which maps to the words it covers and, through word spans, to offsets in the original.

Bounds: the pattern table grows with the benchmark, not with the corpus. It is read to the driver in blocks
of at most ``MAX_WINDOWS`` windows (about 40 MB of automaton each); a benchmark beyond that is scanned
by one automaton per block, block after block, with the hits united, so no window is left out.

Defined results: a null or wordless text has n_words 0 and no hit. A null ``item_id`` or item text, or an
item without words, has no window. Repeated items and items that share windows count once per item id.
Repeated document rows each get their own result row.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import as_bytes, ascii_words, map_texts, prepare, unwrap, whole_row

WINDOW = 13
MAX_WINDOWS = 100_000
#: A document is contaminated if at least one in this many of its words is hit.
HIT_SHARE = 20

#: The same words with their places in the original, where A-Z are still upper case.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_AUTOMATA: dict[str, tuple] = {}


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows ``(words, item_ids)`` of the items; words are joined by one space."""
    def of(texts: pa.Array) -> list[pa.Array]:
        out = []
        for data in as_bytes(texts):
            w = ascii_words(data)
            out.append([b" ".join(w[i:i + window]).decode() for i in range(max(1, len(w) - window + 1))] if w else [])
        return [pa.array(out, pa.list_(pa.string()))]

    item = map_texts(benchmark.filter("item_id IS NOT NULL"), of, [("windows", T.ArrayType(T.StringType()))],
                     {"item_id": F.col("item_id").cast("long")})
    return (item.select("item_id", F.explode("windows").alias("words"))
            .groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")))


def _blocks(wins: DataFrame, limit: int) -> list[list[tuple[str, list[int]]]]:
    """The windows in blocks of at most ``limit``, streamed to the driver one partition at a time."""
    blocks: list[list[tuple[str, list[int]]]] = [[]]
    for row in wins.orderBy("words").toLocalIterator():
        if len(blocks[-1]) == limit:
            blocks.append([])
        blocks[-1].append((row["words"], list(row["item_ids"])))
    return blocks


def _automaton(key: str, shared):
    """Word ids and the automaton of a broadcast block, built once per worker process."""
    if key not in _AUTOMATA:
        import ahocorasick

        ids: dict[bytes, int] = {}
        machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for words, items in shared.value:
            seq = tuple(ids.setdefault(w, len(ids) + 1) for w in words.encode().split(b" "))
            machine.add_word(seq, (len(seq), items))
        machine.make_automaton()
        while len(_AUTOMATA) > 1:
            del _AUTOMATA[next(iter(_AUTOMATA))]
        _AUTOMATA[key] = ids, machine
    return _AUTOMATA[key]


def _scan(data: bytes, ids: dict[bytes, int], machine) -> tuple[int, set[int], set[int]]:
    """Words, indices of hit words and ids of the items found in a text."""
    words = ascii_words(data)
    hit: set[int] = set()
    items: set[int] = set()
    if words and ids:
        get = ids.get
        for end, (length, found) in machine.iter(tuple([get(w, 0) for w in words])):
            hit.update(range(end - length + 1, end + 1))
            items.update(found)
    return len(words), hit, items


def _merge_spans(hit: set[int], text: str) -> list[dict]:
    """Hit word runs as half-open code-point spans of the original text."""
    if not hit:
        return []
    spans, last = [], None
    for i, m in enumerate(WORD.finditer(text)):
        if i in hit:
            if last == i - 1:
                spans[-1]["end"] = m.end()
            else:
                spans.append({"start": m.start(), "end": m.end()})
            last = i
    return spans


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def contamination(docs: DataFrame, benchmark: DataFrame, carry: dict[str, object], window: int = WINDOW,
                  max_windows: int = MAX_WINDOWS, text: str = "text") -> DataFrame:
    """``carry`` columns plus n_words, n_hit, item_ids (sorted), spans and contaminated, per document."""
    prepare(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    blocks = _blocks(windows(benchmark, window), max_windows)
    long_list = T.ArrayType(T.LongType())
    fields = [("__words", T.LongType()), ("__hit", long_list), ("__items", long_list), ("__spans", _SPAN)]
    frame, held = docs, carry
    for number, block in enumerate(blocks):
        key = hashlib.sha256(repr(block).encode()).hexdigest()
        shared = sc.broadcast(block)

        def scan(texts: pa.Array, key=key, shared=shared) -> list[pa.Array]:
            ids, machine = _automaton(key, shared)
            found = [_scan(data, ids, machine) for data in as_bytes(texts)]
            spans = [_merge_spans(hit, texts[i].as_py()) if hit else [] for i, (_, hit, _) in enumerate(found)]
            return [pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([sorted(h) for _, h, _ in found], pa.list_(pa.int64())),
                    pa.array([sorted(x) for _, _, x in found], pa.list_(pa.int64())),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]

        more = len(blocks) > 1
        out = map_texts(frame, scan, fields, held | ({"__t": F.col(text)} if more else {}), text)
        if number:
            out = (out.withColumn("__hit", F.array_union("__hit", "__was_hit"))
                   .withColumn("__items", F.array_sort(F.array_union("__items", "__was_items")))
                   .withColumn("__spans", F.array_sort(F.array_union("__spans", "__was_spans"))))
        if more:
            frame, text = out, "__t"
            held = {c: F.col(c) for c in carry} | {f"__was_{c}": F.col(f"__{c}") for c in ("hit", "items", "spans")}
    n_hit = F.size("__hit").cast("long")
    return out.select(*carry, F.col("__words").alias("n_words"), n_hit.alias("n_hit"),
                      F.col("__items").alias("item_ids"), F.col("__spans").alias("spans"),
                      ((n_hit > 0) & (n_hit * HIT_SHARE >= F.col("__words"))).alias("contaminated"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    found = contamination(docs, benchmark, {"row": whole_row(docs)})
    return unwrap(found.filter(~F.col("contaminated")), docs)
