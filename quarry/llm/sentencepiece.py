"""Operator 2, SentencePiece encoding and decoding by shared-prefix Viterbi.

The model's pieces and scores are read from its file (a parameter). The best segmentation maximises the sum of the
pieces' scores; on equal sums the longer last piece wins. A character that is no piece is encoded by its byte
pieces (or the unknown piece). No piece has a mark after another character, nor a line break in it (both
checked when the model is read), so a text is a sequence of marked words: a run of marks and what follows. Per slice of a task, the distinct marked words that are not known yet are sorted, which
lays out their trie, and walked depth-first: the forward scores and live piece starts of the common prefix with the word
before stay on the stack, only the rest is computed. Texts are then put together from the words' ids.

Memory: a worker keeps the model (about 32k pieces) and at most ``CACHE_WORDS`` words; beyond that the
kept words are dropped and gathered anew, which changes no result.

Defined results: null and empty texts have no ids and decode to the empty text. U+2581 in a text is a space to the
format, so it decodes to a space; every other text decodes to itself.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import map_texts, prepare, unwrap, whole_row

MARK = "▁"
CACHE_WORDS = 300_000
#: Characters up to which a common prefix of words is reused.
SHARED = 64
#: Fixed value of the format: an unknown character scores this much below the lowest piece.
UNKNOWN_PENALTY = 10.0

_MODELS: dict[str, Model] = {}


class Model:
    """Pieces as a trie of dictionaries (a node's piece is under the empty string), bytes and unknowns."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.trie: dict = {}
        self.pieces: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        self.unknown = sp.unk_id()
        self.breaks = True  # a line break is in no longer piece, so words may be cut there
        cuts = True  # nor is a mark after another character
        low = 0.0
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.pieces.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.pieces.append(b"" if not sp.is_unknown(i) else " ⁇ ".encode())
            else:
                node = self.trie
                for c in piece:
                    node = node.setdefault(c, {})
                node[""] = (i, sp.get_score(i))
                low = min(low, sp.get_score(i))
                self.breaks &= not ("\n" in piece and len(piece) > 1)
                cuts &= MARK not in piece.lstrip(MARK)
                self.pieces.append(piece.replace(MARK, " ").encode())
        if not cuts:
            raise ValueError("the model has pieces that span words")
        self.unknown_score = low - UNKNOWN_PENALTY
        self.known: dict[str, bytes] = {}

    def unknown_ids(self, c: str) -> list[int]:
        if len(self.byte_ids) == 256:
            return [self.byte_ids[b] for b in c.encode()]
        return [self.unknown]

    def segment(self, words: list[str]) -> None:
        """Add the ids of sorted distinct words to ``known``."""
        root, known = self.trie, self.known
        best, back, live = [0.0], [None], [[]]  # by depth: score, (start, piece id or None), live (start, node)
        last = ""
        for word in words:
            depth = 0
            for a, b in zip(last, word):
                if a != b:
                    break
                depth += 1
            depth = min(depth, SHARED)
            del best[depth + 1:], back[depth + 1:], live[depth + 1:]
            for d in range(depth, len(word)):
                c = word[d]
                top, link, alive = None, None, []
                for s, node in live[d]:
                    node = node.get(c)
                    if node is not None:
                        alive.append((s, node))
                        found = node.get("")
                        if found is not None:
                            score = best[s] + found[1]
                            if top is None or score > top:
                                top, link = score, (s, found[0])
                node = root.get(c)
                found = None
                if node is not None:
                    alive.append((d, node))
                    found = node.get("")
                score = best[d] + (found[1] if found is not None else self.unknown_score)
                if top is None or score > top:
                    top, link = score, (d, found[0] if found is not None else None)
                if d > SHARED:
                    live[d] = []  # so deep a prefix is not shared, and long words stay small
                best.append(top)
                back.append(link)
                live.append(alive)
            last = word
            ids: list[int] = []
            at = len(word)
            while at:
                start, piece = back[at]
                if piece is None:
                    ids.extend(reversed(self.unknown_ids(word[start:at])))
                else:
                    ids.append(piece)
                at = start
            ids.reverse()
            known[word] = np.array(ids, np.int32).tobytes()

    def words(self, text: str) -> list[str]:
        """The marked words of a text: a run of marks with what follows it, and line breaks of their own."""
        out: list[str] = []
        if not text:
            return out
        whole = text.replace(MARK, " ")
        for k, line in enumerate(whole.split("\n") if self.breaks else [whole]):
            if k:
                out.append("\n")
            # the text starts with a mark, a later line does not
            parts = line.split(" ")
            if k and parts[0]:
                out.append(parts[0])
            rest = parts[1:] if k else parts
            if all(rest):
                out.extend([MARK + p for p in rest])
                continue
            marks = 0
            for p in rest:
                marks += 1
                if p:
                    out.append(MARK * marks + p)
                    marks = 0
            if marks:
                out.append(MARK * marks)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        fresh: set[str] = set()
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        split = [self.words(text) for text in texts]
        for words in split:
            fresh.update(words)
        missing = sorted(w for w in fresh if w not in known)
        self.segment(missing)
        return [b"".join([known[w] for w in words]) for words in split]

    def decode(self, ids: list[int]) -> str:
        pieces = self.pieces
        out = b"".join([pieces[i] for i in ids])
        return (out[1:] if out[:1] == b" " else out).decode("utf-8", "replace")


def model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def _lists(raw: list[bytes]) -> pa.Array:
    """Arrow lists of 32-bit ids without a Python object per id."""
    ends = np.cumsum([0] + [len(x) // 4 for x in raw]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), np.int32)))


def encode(docs: DataFrame, carry: dict[str, object], model_path: str, text: str = "text") -> DataFrame:
    """``carry`` columns plus ``ids`` and ``ids_crc32``, the checksum of the ids as 32-bit integers."""
    def of(texts: pa.Array) -> list[pa.Array]:
        raw = model(model_path).encode(texts.to_pylist())
        return [_lists(raw), pa.array([zlib.crc32(x) for x in raw], pa.int64())]

    return map_texts(docs, of, [("ids", T.ArrayType(T.IntegerType())), ("ids_crc32", T.LongType())], carry, text)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``; other columns are kept."""
    prepare(encoded.sparkSession)
    schema = T.StructType([*encoded.schema, T.StructField("decoded", T.StringType())])

    def run(batches):
        m = model(model_path)
        for batch in batches:
            ids = batch.column("ids")
            for lo in range(0, batch.num_rows, 64):
                part = ids.slice(lo, 64)
                text = pa.array([m.decode(x.as_py()) for x in part], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, 64).columns, text], names=schema.names)

    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, carry: dict[str, object], model_path: str) -> DataFrame:
    """Encodes every text, decodes the ids and compares: ``carry`` columns plus n_pieces, ids_crc32, the
    SHA-256 of the decoded text, and whether it is the text again."""
    seen = F.sha2(F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit(MARK), F.lit(" ")), 256)
    both = decode(encode(docs, carry | {"__sha": seen}, model_path), model_path)
    got = F.sha2("decoded", 256)
    return both.select(*carry, F.size("ids").cast("long").alias("n_pieces"), "ids_crc32",
                       got.alias("decoded_sha256"), (got == F.col("__sha")).alias("round_trip"))


def tokenize_rows(docs: DataFrame, model_path: str) -> DataFrame:
    """The documents with piece counts and the ids, checked by decoding them (the pipeline's last stage)."""
    seen = F.sha2(F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit(MARK), F.lit(" ")), 256)
    both = decode(encode(docs, {"row": whole_row(docs), "__sha": seen}, model_path), model_path)
    taken = set(docs.columns)
    extra = {"ids": F.col("ids"), "n_pieces": F.size("ids").cast("long"), "ids_crc32": F.col("ids_crc32"),
             "round_trip": F.sha2("decoded", 256) == F.col("__sha")}
    return both.select(*[F.col("row")[c].alias(c) for c in docs.columns],
                       *[e.alias(n) for n, e in extra.items() if n not in taken])
