import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import sentencepiece as sp
from tests.llm.helpers import awkward, docs_of, prose

PATH = sp.default_model()


def plain_viterbi(m, text):
    """Segmentation of a whole text at once, without words, tries or shared prefixes."""
    if not text:
        return []
    table = {}

    def walk(node, prefix):
        for c, child in node.items():
            if c == "":
                table[prefix] = child
            else:
                walk(child, prefix + c)

    walk(m.trie, "")
    longest = max(map(len, table))
    s = sp.MARK + text.replace(" ", sp.MARK)
    best, back = [0.0] + [None] * len(s), [None] * (len(s) + 1)
    for end in range(1, len(s) + 1):
        for start in range(max(0, end - longest), end):
            piece = s[start:end]
            if piece in table:
                score, link = best[start] + table[piece][1], (start, [table[piece][0]])
            elif end - start == 1:
                score, link = best[start] + m.unknown_score, (start, m.unknown_ids(piece))
            else:
                continue
            if best[end] is None or score > best[end]:
                best[end], back[end] = score, link
    ids, at = [], len(s)
    while at:
        at, piece = back[at]
        ids = piece + ids
    return ids


def texts():
    rng = random.Random(3)
    return ["Hello world", " lead", "trail ", "a  b   c", "line\nbreak\n\n x", "\n", "tab\tx", "naïve çedilla 漢字 \U0001F600",
            prose(rng, 40), "The thatonthe ththen.\nOf. Erre!", "a", "   "]


def test_words_with_shared_prefixes_equal_one_viterbi():
    m = sp.Model(PATH)
    raw = m.encode(texts())
    for text, ids in zip(texts(), raw):
        assert np.frombuffer(ids, np.int32).tolist() == plain_viterbi(m, text)


def test_scores_as_well_as_the_library_with_a_unigram_model(tmp_path):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece
    proto = pb.ModelProto()
    proto.ParseFromString(open(PATH, "rb").read())
    proto.trainer_spec.model_type = 1  # the same pieces and scores, segmented by the library's Viterbi
    (tmp_path / "u.model").write_bytes(proto.SerializeToString())
    own, other = sp.Model(PATH), sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "u.model"))
    rng, same = random.Random(4), 0
    cases = ["Hello", "thatonthe", "ererst"] + [prose(rng, 3) for _ in range(200)]
    for text in cases:
        mine, theirs = np.frombuffer(own.encode([text])[0], np.int32).tolist(), other.encode(text)
        same += mine == theirs
        assert sum(map(other.get_score, mine)) >= sum(map(other.get_score, theirs))
        assert other.decode(mine) == text
    assert same >= 0.9 * len(cases)


def test_cache_limit_changes_nothing(monkeypatch):
    m = sp.Model(PATH)
    want = m.encode(texts())
    monkeypatch.setattr(sp, "CACHE_WORDS", 3)
    small = sp.Model(PATH)
    assert [small.encode([t])[0] for t in texts()] == want


def test_words_that_share_a_long_prefix_encode_the_same_together_and_apart():
    start = "https://www.example.com/archive/documents/internationalisation/"
    cases = ["=" * n for n in range(60, 72)] + ["-" * 65, "-" * 130, "-" * 64, "-" * 200]
    cases += [start + tail for tail in ("configuration", "configurations", "conference", "international", "internationally")]
    cases += ["a" * n + "thing" for n in range(58, 68)] + ["a" * n + "ther" for n in range(58, 68)]
    m = sp.Model(PATH)
    for text, together in zip(cases, m.encode(cases)):
        want = plain_viterbi(m, text)
        assert np.frombuffer(together, np.int32).tolist() == want, text
        m.known.clear()
        assert np.frombuffer(m.encode([text])[0], np.int32).tolist() == want, text


def test_round_trip_on_awkward_rows(spark):
    docs = awkward() + [(50 + i, t) for i, t in enumerate(texts())] + [(90, "mark ▁ inside")]
    got = sp.round_trip(docs_of(spark, docs), {"doc_id": F.col("doc_id")}, PATH).collect()
    assert len(got) == len(docs) and all(r.round_trip for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].n_pieces == by[2].n_pieces == 0 and by[1].ids_crc32 == zlib.crc32(b"")
    m = sp.Model(PATH)
    assert all(by[50 + i].ids_crc32 == zlib.crc32(np.array(plain_viterbi(m, t), np.int32).tobytes()) for i, t in enumerate(texts()))


def test_rows_keep_their_columns(spark):
    frame = docs_of(spark, [(1, "one two"), (1, "one two"), (2, None)]).withColumn("n_pieces", F.lit("mine"))
    out = sp.tokenize_rows(frame, PATH)
    assert out.columns == [*frame.columns, "ids", "ids_crc32", "round_trip"]
    assert out.count() == 3 and {r.n_pieces for r in out.collect()} == {"mine"}
    assert sp.tokenize_rows(docs_of(spark, []), PATH).count() == 0
