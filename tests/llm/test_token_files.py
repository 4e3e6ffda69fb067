import random
import zlib

import numpy as np
import pytest

from quarry.llm import token_files as tf
from tests.llm.helpers import awkward, docs_of, prose

PATH = tf.default_tokenizer()


def arrays():
    rng = np.random.default_rng(1)
    return [np.array(a, np.uint32) for a in ([], [7], [5, 5, 5], [0, 49407, 3, 0], rng.integers(0, 70_000, 3000), rng.integers(0, 9, 1025),
                                             rng.integers(0, 2**32, 100_000, dtype=np.uint32))]


@pytest.mark.parametrize("k", range(7))
def test_wavelet_matrix_answers_like_the_array(k):
    ids = arrays()[k]
    w = tf.WaveletMatrix(tf.pack(ids))
    assert (w.decode() == ids).all() and w.n == len(ids)
    rng = random.Random(k)
    for i in rng.sample(range(len(ids)), min(40, len(ids))):
        assert w.access(i) == ids[i]
        t = int(ids[i])
        at = np.flatnonzero(ids == t)
        assert w.count(t) == len(at) and (w.locate(t) == at).all()
        assert w.rank(t, i) == (ids[:i] == t).sum() and w.rank(t, len(ids) + 9) == len(at)
        j = rng.randrange(len(at))
        assert w.select(t, j) == at[j]
    assert w.count(123_456_789 % 2**31) == int((ids == 123_456_789 % 2**31).sum()) and len(w.locate(4_000_000_001)) == int((ids == 4_000_000_001).sum())
    with pytest.raises(IndexError):
        w.access(len(ids))
    with pytest.raises(IndexError):
        w.select(1, len(ids) + 1)


def reference(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_words_encode_like_whole_texts():
    texts = ["", "Hello  world\nthis's  it\t\tx", "Ünïcode ťext — 漢字 \U0001F600", "á ́b c d\x1ce", "x<|endoftext|>y <|startoftext|>",
             "ΑΣ ΣΑΣ. I'LL we're 3.14", "Word, word. WORD.. word., a,b,c. (x). \u212a\u0130. e\u0301, \u0fb2\u0f71. ªº¹ a's 's. don't, ﬁ. ǅ,",
             "<|endoftext|>. <|ENDOFTEXT|>, x.<|endoftext|>", " ".join(map(chr, range(0x21, 0x3000))), prose(random.Random(1), 200)]
    got = tf.Encoder(PATH).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [reference(t) for t in texts]


def test_shards_hold_the_documents_in_order(spark, tmp_path):
    rng = random.Random(2)
    rows = awkward() + [(i, prose(rng, rng.randrange(0, 60))) for i in range(100, 160)]
    tf.write_shards(docs_of(spark, rows), f"{tmp_path}/t", PATH, 1, shard_tokens=500)
    shards = tf.read_shards(spark, f"{tmp_path}/t")
    assert shards.count() > 3
    got = tf.documents(shards).collect()
    key = lambda d: (d is not None, d or 0)
    start, want = 0, []
    for doc, text in sorted(rows, key=lambda r: key(r[0])):
        ids = reference(text) + [1]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in sorted(got, key=lambda r: r.start)] == want
    token = reference("the and")[0] if reference("the and") else 1
    whole = np.concatenate([np.array(reference(t) + [1]) for _, t in sorted(rows, key=lambda r: key(r[0]))])
    assert tf.token_counts(shards, 1).first().n == (whole == 1).sum() and tf.occurrences(shards, token).count() == (whole == token).sum()


def test_empty_table(spark, tmp_path):
    tf.write_shards(docs_of(spark, []), f"{tmp_path}/t", PATH, 1)
    shards = tf.read_shards(spark, f"{tmp_path}/t")
    assert tf.documents(shards).count() == 0 and tf.token_counts(shards, 1).first().n == 0
