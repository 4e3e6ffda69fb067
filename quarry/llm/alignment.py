"""Operator 13, cross-tokenizer alignment of a byte-level BPE (A) and a SentencePiece model (B) on the same bytes.

Both tokenizers encode a space and the text (B adds the space itself). The spans that they report are the coarse cuts: A's
character offsets and B's proto spans, as byte offsets. A token whose span is not as long as its decoded bytes (a part of a
multi-byte character, a byte-fallback piece, the added space) is placed by its decoded bytes from the last such cut on. If the
decoded bytes of A or B are not those of the text, the text has no tokens. Offsets at which both end cut the tokens into groups; a
link is a pair of token occurrences whose byte ranges overlap.

Chunks: no token of A joins a character that is not white space with a space after it (its pre-tokenizer is checked), nor
does a piece of B (its pieces and normaliser are checked), so text is cut there, and both tokenizers end at every cut. A
worker aligns each distinct chunk once, many in one call, and puts texts together from chunks; it keeps ``CACHE_CHUNKS`` of
them and then gathers them anew, which changes no result. Tokenizers that fail the checks get whole texts. Long texts are
put together ``PIECE_CHARS`` at a time.

Corpus counts: the table of texts holds the distinct id pairs of each text with their numbers of links. Tasks add up
how many texts hold each pair (a bounded number of pairs at a time), Spark adds up the tasks. The counts go back in blocks of at
most ``BLOCK_PAIRS`` pairs and those of one A id, each a broadcast of that bound and a pass over the stored pairs, so texts
and links are never shuffled.

Defined results: null, empty and not reproducible texts have zero counts and the empty string for the groups. Rows that repeat count as
documents each. An empty table gives an empty result. The input's other columns are carried or not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import map_texts, prepare, stored

MARK = "▁"
CACHE_CHUNKS = 600_000
#: Chunks that are aligned in one call of the tokenizers.
JOINED = 4096
PIECE_CHARS = 4 << 20
#: Distinct pairs that a task counts before it hands them on, and pairs of a broadcast block.
HELD_PAIRS = 2_000_000
BLOCK_PAIRS = 1 << 22
#: Where white space is followed by a space, no cut is made there.
_BLANK_BEFORE = re.compile(r"\s ")

_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def byte_symbols() -> dict[str, int]:
    """The characters by which byte-level BPE files write bytes: printable ones stand for themselves, the others are
    numbered from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def refine(begin: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Byte ends of consecutive tokens: those of spans as long as the decoded bytes stand; the others follow from the
    last of these by the decoded bytes."""
    exact = end - begin == size
    run = np.cumsum(size)
    last = np.maximum.accumulate(np.where(exact, np.arange(len(size)), -1))
    base = np.where(last >= 0, end[last] - run[last], 0)
    return run + base


class Growing:
    """A flat array that grows by doubling."""

    def __init__(self, dtype=np.int64):
        self.data, self.n = np.zeros(1024, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        while self.n + len(values) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        self.data[self.n:self.n + len(values)] = values
        self.n += len(values)


class Aligner:
    """Two tokenizer files, and the alignment of distinct chunks."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        symbols = byte_symbols()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values(), default=-1) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.size_a, self.size_b = (np.array([len(x) for x in xs], np.int64) for xs in (self.bytes_a, self.bytes_b))
        self.name_a, self.name_b = ([str(i) for i in range(len(xs))] for xs in (self.bytes_a, self.bytes_b))
        spec = sentencepiece_model_pb2.ModelProto()
        with open(path_b, "rb") as f:
            spec.ParseFromString(f.read())
        with open(path_a, encoding="utf-8") as f:
            pre = json.load(f)
        norm, first = spec.normalizer_spec, pre.get("pre_tokenizer") or {}
        self.cuts = (norm.name == "identity" and norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
                     and not any(MARK in p.piece.lstrip(MARK) for p in spec.pieces)
                     and pre.get("normalizer") is None and first.get("type") == "ByteLevel" and first.get("use_regex")
                     and not first.get("add_prefix_space"))
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.stats = Growing()  # per chunk: n_a, n_b, n_groups, n_links (-1: not reproduced), start of its links
        self.links = Growing()

    def _spans_a(self, text: str, char_at: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A and their byte ends."""
        e = self.a.encode(text, add_special_tokens=False)
        ids, spans = np.array(e.ids, np.int64), np.array(e.offsets, np.int64).reshape(-1, 2)
        if char_at is not None:
            spans = char_at[spans]
        return ids, refine(spans[:, 0], spans[:, 1], self.size_a[ids])

    def _spans_b(self, text: str, char_at: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of B and their byte ends; ``text`` starts with the space that B adds."""
        try:
            found, in_bytes = self.b.encode(text[1:], return_type="proto"), True
        except TypeError:  # releases before return_type; their spans count characters
            found, in_bytes = self.b.encode(text[1:], out_type="immutable_proto"), False
        rows = np.array([(p.id, p.begin, p.end) for p in found.pieces], np.int64).reshape(-1, 3)
        spans = rows[:, 1:] + 1
        if not in_bytes and char_at is not None:
            spans = char_at[spans]
        return rows[:, 0], refine(spans[:, 0], spans[:, 1], self.size_b[rows[:, 0]])

    def align(self, text: str, cuts: np.ndarray):
        """``(per chunk: n_a, n_b, n_groups, n_links; group strings; pairs)`` of a text that is cut into chunks at the
        byte offsets ``cuts`` (the last is its length), or None if A or B does not reproduce it."""
        data = text.encode()
        char_at = None
        if len(data) != len(text):
            raw = np.frombuffer(data, np.uint8)
            char_at = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))
        a, end_a = self._spans_a(text, char_at)
        b, end_b = self._spans_b(text, char_at)
        if b"".join([self.bytes_a[i] for i in a.tolist()]) != data or b"".join([self.bytes_b[i] for i in b.tolist()]) != data:
            return None
        for end, ids, size in ((end_a, a, self.size_a), (end_b, b, self.size_b)):
            if not np.array_equal(np.diff(end, prepend=0), size[ids]) or not np.isin(cuts, end).all():
                return None
        start_a, start_b = end_a - self.size_a[a], end_b - self.size_b[b]
        first, last = np.searchsorted(end_b, start_a, "right"), np.searchsorted(start_b, end_a, "left")
        met = last - first
        at = np.arange(met.sum()) - np.repeat(np.cumsum(met) - met, met) + np.repeat(first, met)
        pairs = np.repeat(a, met) * len(self.bytes_b) + b[at]
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        to_a, to_b = np.searchsorted(end_a, both, "right").tolist(), np.searchsorted(end_b, both, "right").tolist()
        names_a, names_b = [self.name_a[i] for i in a.tolist()], [self.name_b[i] for i in b.tolist()]
        i = j = 0
        text_of = []
        for x, y in zip(to_a, to_b):
            text_of.append(f"{','.join(names_a[i:x])}|{','.join(names_b[j:y])}")
            i, j = x, y
        upto = [np.searchsorted(x, cuts, "right") for x in (end_a, end_b, both)]
        upto.append(np.append(0, np.cumsum(met))[upto[0]])
        counts = np.diff(np.stack(upto, axis=1), axis=0, prepend=0)
        ends = upto[2].tolist()
        return counts, [";".join(text_of[g:h]).encode() for g, h in zip([0, *ends], ends)], pairs

    def _keep(self, chunks: list[str], found) -> None:
        counts, groups, pairs = found
        for k, c in enumerate(chunks):
            self.index[c] = len(self.groups) + k
        self.groups.extend(groups)
        starts = self.links.n + np.cumsum(counts[:, 3]) - counts[:, 3]
        self.stats.extend(np.column_stack([counts, starts]).ravel())
        self.links.extend(pairs)

    def learn(self, chunks: list[str]) -> None:
        """Align distinct chunks, many in one call; chunks that end in white space, and those of a call in which
        something is not reproduced, one by one."""
        alone = [c for c in chunks if not self.cuts or c[-1].isspace()]
        chunks = [c for c in chunks if self.cuts and not c[-1].isspace()]
        for lo in range(0, len(chunks), JOINED):
            part = chunks[lo:lo + JOINED]
            found = self.align("".join(part), np.cumsum([len(c.encode()) for c in part]))
            if found is None:
                alone += part
            else:
                self._keep(part, found)
        for c in alone:
            found = self.align(c, np.array([len(c.encode())]))
            self._keep([c], found or (np.array([[0, 0, 0, -1]]), [b""], np.zeros(0, np.int64)))

    def chunks(self, text: str) -> list[str]:
        """A space and the text, cut where a space follows what is not white space; no chunk is a space alone."""
        if not self.cuts:
            return [" " + text]
        parts = text.split(" ")
        if text[-1] != " " and text[0] != " " and not _BLANK_BEFORE.search(text):
            return [" " + p for p in parts]
        out: list[str] = []
        for p in parts:
            if out and (out[-1][-1].isspace() or not p):
                out[-1] += " " + p
            else:
                out.append(" " + p)  # runs of spaces, and spaces at the end, stay inside a chunk
        return out

    def texts(self, texts: list[str | None]):
        """Arrays n_a, n_b, n_groups, n_links and lists of group digests, pairs and link counts, one per text."""
        n = len(texts)
        stats, digests = np.zeros((n, 4), np.int64), [""] * n
        pairs, times = [np.zeros(0, np.int64)] * n, [np.zeros(0, np.int64)] * n
        for lo, hi in _runs(texts):
            if hi - lo == 1 and len(texts[lo] or "") > PIECE_CHARS:
                stats[lo], digests[lo], pairs[lo], times[lo] = self._long(texts[lo])
                continue
            split = [self.chunks(t) if t else [] for t in texts[lo:hi]]
            for k, (s, d, p, m) in enumerate(self._short(split)):
                stats[lo + k], digests[lo + k], pairs[lo + k], times[lo + k] = s, d, p, m
        return stats, digests, pairs, times

    def _numbers(self, split: list[list[str]]) -> list[list[int]]:
        if len(self.index) > CACHE_CHUNKS:
            self.clear()
        get = self.index.get
        found = [[get(c, -1) for c in chunks] for chunks in split]
        new = dict.fromkeys(c for chunks, ids in zip(split, found) if -1 in ids for c, i in zip(chunks, ids) if i < 0)
        if new:
            self.learn(list(new))
            for chunks, ids in zip(split, found):
                if -1 in ids:
                    ids[:] = [self.index[c] if i < 0 else i for c, i in zip(chunks, ids)]
        return found

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per chunk its row of counts and links, and all its pairs in order."""
        rows = self.stats.data[:self.stats.n].reshape(-1, 5)[numbers]
        held = np.maximum(rows[:, 3], 0)
        at = np.arange(held.sum()) + np.repeat(rows[:, 4] - (np.cumsum(held) - held), held)
        return rows[:, :4], held, self.links.data[at]

    def _short(self, split: list[list[str]]):
        found = self._numbers(split)
        sizes = np.array([len(x) for x in found], np.int64)
        rows, held, pairs = self._gather(np.fromiter((i for ids in found for i in ids), np.int64, int(sizes.sum())))
        doc = np.repeat(np.arange(len(found)), sizes)
        good = np.ones(len(found), bool)
        good[doc[rows[:, 3] < 0]] = False
        sums = np.stack([np.bincount(doc, rows[:, c], len(found)).astype(np.int64) for c in range(4)], axis=1)
        space = len(self.bytes_a) * len(self.bytes_b)
        keys, times = np.unique(np.repeat(doc, held) * space + pairs, return_counts=True)
        ends = np.searchsorted(keys, np.arange(len(found) + 1) * space)
        keys %= space
        groups, none = self.groups, np.zeros(0, np.int64)
        for k, ids in enumerate(found):
            if not ids or not good[k]:
                yield np.zeros(4, np.int64), "", none, none
                continue
            digest = hashlib.sha256(b";".join([groups[i] for i in ids])).hexdigest()
            yield sums[k], digest, keys[ends[k]:ends[k + 1]], times[ends[k]:ends[k + 1]]

    def _long(self, text: str):
        total, sha = np.zeros(4, np.int64), hashlib.sha256()
        keys = times = none = np.zeros(0, np.int64)
        for number, part in enumerate(_batches(self.chunks(text))):
            ids = self._numbers([part])[0]
            rows, _, pairs = self._gather(np.array(ids, np.int64))
            if (rows[:, 3] < 0).any():
                return np.zeros(4, np.int64), "", none, none
            total += rows.sum(axis=0)
            sha.update((b";" if number else b"") + b";".join([self.groups[i] for i in ids]))
            keys, times = add_counts(keys, times, *np.unique(pairs, return_counts=True))
        return total, sha.hexdigest(), keys, times


def _batches(chunks: list[str]):
    """Chunks of about ``PIECE_CHARS`` characters at a time."""
    lo = size = 0
    for k, c in enumerate(chunks):
        size += len(c)
        if size >= PIECE_CHARS:
            yield chunks[lo:k + 1]
            lo, size = k + 1, 0
    if lo < len(chunks):
        yield chunks[lo:]


def _runs(texts: list[str | None]):
    """Ranges of texts: a long one alone, the others together."""
    lo = 0
    for k, t in enumerate(texts):
        if len(t or "") > PIECE_CHARS:
            if lo < k:
                yield lo, k
            yield k, k + 1
            lo = k + 1
    if lo < len(texts):
        yield lo, len(texts)


def add_counts(keys: np.ndarray, counts: np.ndarray, more: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of two counted sets of keys."""
    every, at = np.unique(np.concatenate([keys, more]), return_inverse=True)
    return every, np.bincount(at, np.concatenate([counts, n]), len(every)).astype(np.int64)


def aligner(path_a: str, path_b: str) -> Aligner:
    key = path_a, path_b
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(path_a, path_b)
    return _ALIGNERS[key]


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64)).cast(kind))


def aligned(docs: DataFrame, carry: dict[str, object], tokenizers: tuple[str, str]) -> DataFrame:
    """``carry`` columns plus n_a, n_b, n_groups, n_links, groups_sha256, and the distinct ``pairs`` (A id times the size of B, plus B id)
    with their numbers of links, ``times``; stored as a table."""
    def of(texts: pa.Array) -> list[pa.Array]:
        stats, digests, pairs, times = aligner(*tokenizers).texts(texts.to_pylist())
        return [*(pa.array(stats[:, c]) for c in range(4)), pa.array(digests, pa.string()), _lists(pairs, pa.int64()), _lists(times, pa.int32())]

    fields = [(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    fields += [("groups_sha256", T.StringType()), ("pairs", T.ArrayType(T.LongType())), ("times", T.ArrayType(T.IntegerType()))]
    return stored(map_texts(docs, of, fields, carry), "alignment")


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """``(a, pair, n, best)``: documents that hold the pair linked, and whether no pair of its A id is in more; found: from ``aligned``."""
    def run(batches):
        keys = counts = np.zeros(0, np.int64)
        waiting, size = [], 0

        def merge():
            flat = np.concatenate(waiting)
            waiting.clear()
            return add_counts(keys, counts, *np.unique(flat, return_counts=True))

        def out():
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])

        for batch in batches:
            flat = batch.column("pairs").flatten().to_numpy()
            waiting.append(flat)
            size += len(flat)
            if size > HELD_PAIRS:
                keys, counts = merge()
                size = 0
                if len(keys) > HELD_PAIRS:
                    yield out()
                    keys = counts = np.zeros(0, np.int64)
        if waiting:
            keys, counts = merge()
        if len(keys):
            yield out()

    part = found.filter("n_links > 0").select("pairs").mapInArrow(run, "pair long, n long")
    counts = stored(part.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"pair div {size_b}")), "alignment-pairs")
    # one row per A id: bounded by the tokenizer
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return counts.join(F.broadcast(top), "a").select("a", "pair", "n", (F.col("n") == F.col("top")).alias("best"))


def id_blocks(counts: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges of A ids with at most ``most`` pairs each (or one id); reads one number per A id."""
    out: list[list[int]] = []
    size = 0
    for a, n in sorted(tuple(r) for r in counts.groupBy("a").count().collect()):
        if not out or size + n > most:
            out.append([a, a])
            size = 0
        out[-1][1] = a
        size += n
    return [(lo, hi) for lo, hi in out]


def with_counts(found: DataFrame, counts: DataFrame, most: int = BLOCK_PAIRS) -> DataFrame:
    """``found`` with ``n_best`` and ``count_sum``, block by block."""
    sc = found.sparkSession.sparkContext
    zero = F.lit(0).cast("long")
    out = found.withColumns({"n_best": zero, "count_sum": zero})
    for number, (lo, hi) in enumerate(id_blocks(counts, most)):
        block = counts.filter(F.col("a").between(lo, hi)).select("pair", "n", "best").toArrow().sort_by("pair")
        shared = sc.broadcast(tuple(block.column(c).to_numpy() for c in ("pair", "n", "best")))
        names = out.columns

        def run(batches, shared=shared, names=names):
            keys, n, best = shared.value
            for batch in batches:
                lists = batch.column("pairs")
                flat, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy().astype(np.int64)
                ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
                there = keys[at] == flat
                sums = {"count_sum": np.where(there, n[at], 0) * times, "n_best": (there & best[at]) * times}
                cols = []
                for c in names:
                    col = batch.column(c)
                    if c in sums:
                        run_up = np.append(0, np.cumsum(sums[c]))
                        col = pa.array(col.to_numpy() + run_up[ends[1:]] - run_up[ends[:-1]])
                    cols.append(col)
                yield pa.RecordBatch.from_arrays(cols, names=names)

        if number:
            out = stored(out, "alignment-block")
        out = out.mapInArrow(run, out.schema)
    return out


def alignment(docs: DataFrame, carry: dict[str, object], tokenizers: tuple[str, str], most: int = BLOCK_PAIRS) -> DataFrame:
    """``carry`` columns plus n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    prepare(docs.sparkSession)
    found = aligned(docs, carry, tokenizers)
    counts = stored(pair_counts(found, len(aligner(*tokenizers).bytes_b)), "alignment-counts")
    return with_counts(found, counts, most).select(
        *carry, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
