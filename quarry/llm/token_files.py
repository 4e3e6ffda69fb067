"""Operator 4, token ids in wavelet-matrix shards.

Documents are range-partitioned by ``doc_id``, sorted, encoded with a tokenizer file (a parameter), ended by an
end id, and packed into shards of about ``SHARD_TOKENS`` ids (a document is never cut). A shard is one row of a
Parquet table: document ids and lengths, and ``payload``, the succinct form of all its ids:

    "WVM1", u64 ids, u32 alphabet size, u32 planes, u32 alphabet[], then per bit plane from the highest bit:
    u64 zeros, u64 bits[] (first id in the lowest bit), u32 ones before every 512th bit

Ids are numbered by the shard's sorted alphabet, so a shard has no more planes than its distinct ids need. A plane
holds one bit per id, in the order left by a stable split on the planes above. ``WaveletMatrix`` answers access, rank,
select, count and locate from these bytes alone, and decodes them in bulk.

Tokenizing works on the distinct space-separated words of a slice, which is exact for tokenizers that drop white
space and never join text across it; a worker keeps at most ``CACHE_WORDS`` words and then gathers them anew.

Defined results: null text is empty and has only its end id. Null ids come first. Rows that repeat an id stay
together in text-hash order. An empty table gives an empty shard table.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quarry.llm.common import as_bytes, prepare, slices, text_hash

SHARD_TOKENS = 1 << 20
CACHE_WORDS = 1_600_000
BLOCK = 512
MAGIC = b"WVM1"

SHARD_SCHEMA = ("part int, seq int, n_docs long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
                "payload binary")

_ENCODERS: dict[str, Encoder] = {}


#: What keeps a text from being lowered first: a character that may combine with the one before (U+0300 and above, known
#: by its first byte), and the start of a special token.
_SPECIAL = "<|"
_MARKS = re.compile(b"[\xcc-\xff]|" + re.escape(_SPECIAL.encode()))
#: A line break becomes a space; the second table lowers A-Z too.
_SPACED = bytes(0x20 if b == 0x0A else b for b in range(256))
_LOWERED = bytes(0x20 if b == 0x0A else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
#: The normaliser, units and end mark of a tokenizer file whose texts may be encoded by words.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_UNITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_END = "</w>"


def by_words(path: str) -> bool:
    """Whether a tokenizer file drops white space, lowers case and marks the ends of units in the way that ``Encoder`` relies on."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    norm, pre, model = (spec.get(k) or {} for k in ("normalizer", "pre_tokenizer", "model"))
    split = (pre.get("pretokenizers") or [{}])[0]
    return ([n.get("type") for n in norm.get("normalizers", [])] == _NORMALIZERS
            and norm["normalizers"][1].get("pattern") == {"Regex": r"\s+"} and norm["normalizers"][1].get("content") == " "
            and [p.get("type") for p in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"]
            and split.get("pattern") == {"Regex": _UNITS} and split.get("behavior") == "Removed" and split.get("invert") is True
            and all(t.get("content", "").startswith(_SPECIAL) for t in spec.get("added_tokens", []))
            and not pre["pretokenizers"][1].get("use_regex") and not pre["pretokenizers"][1].get("add_prefix_space")
            and model.get("type") == "BPE" and model.get("end_of_word_suffix") == _END and model.get("dropout") is None)


class Encoder:
    """Ids of UTF-8 texts as little-endian 32-bit integers, by way of their distinct words.

    A word of letters, maybe followed by points or commas, is encoded as its lower-case letters (if they are
    ASCII; the tokenizer lower-cases them anyway) and its tail. Distinct letter words are encoded many at a time in
    one text: each is one unit of the tokenizer, and the last id of a unit carries the end-of-word mark. If the
    marks do not add up to the words, the words are encoded one by one. In a text without combining characters and special
    tokens A-Z are lowered first. A tokenizer file that ``by_words`` does not know gets whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = by_words(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(_END)]] = True
        self.known: dict[bytes, bytes] = {b"": b""}

    def _ids(self, texts: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def one_by_one(self, words: list[bytes]) -> None:
        self.known.update(zip(words, self._ids(words)))

    def letters(self, words: list[bytes]) -> None:
        """Encode distinct words of letters only."""
        for lo in range(0, len(words), 4096):
            part = words[lo:lo + 4096]
            data = self._ids([b" ".join(part)])[0]
            ids = np.frombuffer(data, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part) or (len(ends) and ends[-1] != len(ids)):
                self.one_by_one(part)
                continue
            at = 0
            for word, end in zip(part, (ends * 4).tolist()):
                self.known[word] = data[at:end]
                at = end

    def learn(self, words: set[bytes]) -> None:
        """Add the ids of new words to ``known``."""
        known = self.known
        bodies, tails, other, made = set(), set(), [], []
        for word in words:
            body = word.rstrip(b".,")
            if body.isalpha():  # ASCII letters
                low = body.lower()
            else:
                letters = body.decode()
                if not letters.isalpha() or not letters.lower().isalpha():  # a letter may lower to a letter and a mark
                    other.append(word)
                    continue
                low = body
            if low not in known:
                bodies.add(low)
            if low != word:
                tail = word[len(body):]
                if tail not in known:
                    tails.add(tail)
                made.append((word, low, tail))
        self.letters(sorted(bodies))
        self.one_by_one(other + sorted(tails))
        for word, low, tail in made:
            known[word] = known[low] + known[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encode_bytes([t.encode() for t in texts])

    def encode_bytes(self, texts: list[bytes]) -> list[bytes]:
        """The distinct words of the texts are found by Arrow and looked up once each; their ids are put together by Arrow too."""
        if not self.words:
            return self._ids(texts)
        if len(self.known) > CACHE_WORDS:
            self.known = {b"": b""}
        plain = [t.translate(_SPACED if _MARKS.search(t) else _LOWERED) for t in texts]
        ends = np.cumsum([0, *map(len, plain)], dtype=np.int64)
        whole = pa.Array.from_buffers(pa.large_binary(), len(plain), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(plain))])
        lists = pc.split_pattern(whole, b" ")
        codes = lists.flatten().dictionary_encode()
        words = codes.dictionary.to_pylist()
        ids = list(map(self.known.get, words))
        if None in ids:
            self.learn({w for w, x in zip(words, ids) if x is None})
            ids = list(map(self.known.__getitem__, words))
        flat = pa.array(ids, pa.large_binary()).take(codes.indices)
        if not len(flat):
            return [b""] * len(texts)
        at = np.frombuffer(flat.buffers()[1], np.int64)[lists.offsets.to_numpy()].tolist()
        data = flat.buffers()[2]
        return [data[a:b].to_pybytes() for a, b in zip(at, at[1:])]


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pack(ids: np.ndarray) -> bytes:
    """The wavelet matrix of an array of ids, as bytes."""
    n = len(ids)
    top = int(ids.max()) + 1 if n else 0
    if top <= 1 << 22:  # number the ids by a table; larger ones by sorting
        there = np.zeros(top, bool)
        there[ids] = True
        alphabet, number = np.flatnonzero(there), (np.cumsum(there) - 1)
        seq = number.astype(np.uint32)[ids]
    else:
        alphabet, seq = np.unique(ids, return_inverse=True)
    alphabet = alphabet.astype("<u4")
    planes = max(1, int(len(alphabet) - 1).bit_length()) if n else 0
    seq = seq.astype(np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
    out = [MAGIC, struct.pack("<QII", n, len(alphabet), planes), alphabet.tobytes()]
    for p in range(planes - 1, -1, -1):
        bits = (seq >> p & 1).astype(bool)
        words = np.zeros(-(-n // BLOCK) * (BLOCK // 8), np.uint8)
        packed = np.packbits(bits, bitorder="little")
        words[:len(packed)] = packed
        ones = np.bitwise_count(words.view("<u8")).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        before = np.r_[np.uint32(0), np.cumsum(ones, dtype=np.uint32)].astype("<u4")
        out += [struct.pack("<Q", n - int(before[-1])), words.tobytes(), before.tobytes()]
        seq = np.concatenate([np.compress(~bits, seq), np.compress(bits, seq)])
    return b"".join(out)


class WaveletMatrix:
    """Queries on a packed array of ids. Positions and occurrence numbers start at 0."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        self.n, size, self.depth = struct.unpack_from("<QII", data, 4)
        at = 20
        self.alphabet = np.frombuffer(data, "<u4", size, at)
        at += 4 * size
        words, blocks = -(-self.n // BLOCK) * (BLOCK // 64), -(-self.n // BLOCK) + 1
        self.planes: list[tuple[int, np.ndarray, np.ndarray]] = []
        for _ in range(self.depth):
            zeros = struct.unpack_from("<Q", data, at)[0]
            bits = np.frombuffer(data, "<u8", words, at + 8)
            at += 8 + 8 * words
            self.planes.append((zeros, bits, np.frombuffer(data, "<u4", blocks, at)))
            at += 4 * blocks

    def _ones(self, plane: int, i: np.ndarray) -> np.ndarray:
        """Ones before each position, from the block's count and at most eight words."""
        _, bits, before = self.planes[plane]
        word = i >> 6
        total = before[i >> 9].astype(np.int64)
        for k in range(BLOCK // 64):
            w = (i >> 9) * (BLOCK // 64) + k
            value = bits[np.minimum(w, len(bits) - 1)] if len(bits) else np.zeros(len(i), np.uint64)
            part = np.where(w < word, value, np.where(w == word, value & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)), np.uint64(0)))
            total += np.bitwise_count(part)
        return total

    def _find(self, plane: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero or one of a plane, by bisection on the counts."""
        lo, hi = np.zeros(len(k), np.int64), np.full(len(k), self.n, np.int64)
        while (lo < hi).any():
            mid = (lo + hi) >> 1
            ones = self._ones(plane, mid + 1)
            enough = (ones if bit else mid + 1 - ones) > k
            hi, lo = np.where(enough, mid, hi), np.where(enough, lo, np.minimum(mid + 1, hi))
        return lo

    def _code(self, token: int) -> int | None:
        k = int(np.searchsorted(self.alphabet, token))
        return k if k < len(self.alphabet) and self.alphabet[k] == token else None

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, code = np.array([i], np.int64), 0
        for p, (zeros, _, _) in enumerate(self.planes):
            a, b = self._ones(p, at), self._ones(p, at + 1)
            bit = int(b[0] - a[0])
            code = code << 1 | bit
            at = zeros + a if bit else at - a
        return int(self.alphabet[code])

    def _range(self, code: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a code among the first ``end`` ids lie below the last plane."""
        at = np.array([0, end], np.int64)
        for p, (zeros, _, _) in enumerate(self.planes):
            ones = self._ones(p, at)
            at = zeros + ones if code >> (self.depth - 1 - p) & 1 else at - ones
        return int(at[0]), int(at[1])

    def rank(self, token: int, end: int) -> int:
        """Occurrences of a token among the first ``end`` ids."""
        code = self._code(token)
        if code is None:
            return 0
        lo, hi = self._range(code, min(max(end, 0), self.n))
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _up(self, code: int, at: np.ndarray) -> np.ndarray:
        for p in range(self.depth - 1, -1, -1):
            bit = code >> (self.depth - 1 - p) & 1
            at = self._find(p, bit, at - self.planes[p][0] if bit else at)
        return at

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence of a token."""
        code = self._code(token)
        lo, hi = self._range(code, self.n) if code is not None else (0, 0)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        return int(self._up(code, np.array([lo + k], np.int64))[0])

    def locate(self, token: int) -> np.ndarray:
        """Positions of all occurrences of a token."""
        code = self._code(token)
        if code is None:
            return np.empty(0, np.int64)
        return self._up(code, np.arange(*self._range(code, self.n)))

    def decode(self) -> np.ndarray:
        """All ids, by undoing the splits from the lowest plane up."""
        codes = np.zeros(self.n, np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32)
        for p in range(self.depth - 1, -1, -1):
            zeros, bits, _ = self.planes[p]
            one = np.unpackbits(bits.view(np.uint8), count=self.n, bitorder="little").view(bool)
            above = np.empty_like(codes)
            above[~one] = codes[:zeros]
            above[one] = codes[zeros:] | codes.dtype.type(1 << (self.depth - 1 - p))
            codes = above
        return self.alphabet[codes]


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``(doc_id, text)`` and write the shard table."""
    prepare(docs.sparkSession)
    # hash and scan order only spread rows that repeat an id
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                           text_hash().alias("h"), F.monotonically_increasing_id().alias("u"))
               .repartitionByRange("doc_id", "h", "u").sortWithinPartitions("doc_id", "h", "u").select("doc_id", "text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        ids: list = []
        raw: list[bytes] = []
        size = 0
        encode = encoder(tokenizer).encode_bytes

        def shard():
            tokens = np.frombuffer(b"".join(raw), "<u4")
            row = [part, seq, len(ids), len(tokens), ids, [len(x) // 4 for x in raw], pack(tokens)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (
                pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()))],
                names=["part", "seq", "n_docs", "n_tokens", "doc_ids", "doc_tokens", "payload"])

        for batch in batches:
            for piece in slices(batch, "text"):
                for doc, data in zip(piece.column("doc_id").to_pylist(), encode(as_bytes(piece.column("text")))):
                    ids.append(doc)
                    raw.append(data + end)
                    size += len(data) // 4 + 1
                    if size >= shard_tokens:
                        yield shard()
                        seq += 1
                        ids, raw, size = [], [], 0
        if ids:
            yield shard()

    ordered.mapInArrow(run, SHARD_SCHEMA).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """``(part, seq, base)``: ids before each shard. Sums run within a part, then over the parts (one row each)."""
    sums = shards.select("part", "seq", "n_tokens")
    inner = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    parts = sums.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    outer = F.sum("t").over(Window.orderBy("part")) - F.col("t")
    return (sums.select("part", "seq", inner.alias("inner"))
            .join(parts.select("part", outer.alias("outer")), "part")
            .select("part", "seq", (F.col("inner") + F.col("outer")).alias("base")))


def documents(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the decoded shards."""
    prepare(shards.sparkSession)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids = WaveletMatrix(row.column("payload")[0].as_py()).decode().astype("<u4", copy=False)
                lengths = np.array(row.column("doc_tokens")[0].as_py(), np.int64)
                starts = np.cumsum(lengths) - lengths
                crc = [zlib.crc32(ids[a:a + n].tobytes()) for a, n in zip(starts, lengths)]
                m = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row.column("part")[0].as_py()] * m, pa.int32()), pa.array([row.column("seq")[0].as_py()] * m, pa.int32()),
                     pa.array(row.column("doc_ids")[0].as_py(), pa.int64()), pa.array(starts), pa.array(lengths), pa.array(crc, pa.int64())],
                    names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    decoded = shards.select("part", "seq", "doc_ids", "doc_tokens", "payload").mapInArrow(
        run, "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return decoded.join(shard_starts(shards), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """``(part, seq, position)`` of a token in the shards, without decoding them."""
    prepare(shards.sparkSession)

    def run(batches):
        for batch in batches:
            for part, seq, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "payload"))):
                at = WaveletMatrix(payload).locate(token)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(at), pa.int32()), pa.array([seq] * len(at), pa.int32()), pa.array(at, pa.int64())],
                    names=["part", "seq", "position"])

    return shards.select("part", "seq", "payload").mapInArrow(run, "part int, seq int, position long")


def token_counts(shards: DataFrame, token: int) -> DataFrame:
    """One row: how often the token occurs in all shards."""
    prepare(shards.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([WaveletMatrix(x).count(token) for x in batch.column("payload").to_pylist()], pa.int64())], names=["n"])

    return shards.select("payload").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
