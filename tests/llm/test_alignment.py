import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import alignment
from tests.llm.helpers import awkward, docs_of, prose

A, B = alignment.default_tokenizers()


class Plain:
    """Whole texts, tokens placed by their decoded bytes alone, one pair at a time."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.sp = sentencepiece.SentencePieceProcessor(model_file=B)
        # the printable bytes stand for themselves, the rest follow from 256 on
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in plain]
        self.symbols = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    def spans(self, pieces):
        out, at = [], 0
        for i, data in pieces:
            out.append((i, at, at + len(data)))
            at += len(data)
        return out, b"".join(d for _, d in pieces)

    def one(self, text):
        if not text:
            return None
        whole = (" " + text).encode()
        e = self.a.encode(" " + text, add_special_tokens=False)
        a, da = self.spans([(i, bytes(self.symbols[c] for c in t)) for i, t in zip(e.ids, e.tokens)])
        b, db = self.spans([(i, bytes([int(self.sp.id_to_piece(i)[3:5], 16)]) if self.sp.is_byte(i)
                             else self.sp.id_to_piece(i).replace("▁", " ").encode()) for i in self.sp.encode(text)])
        if da != whole or db != whole:
            return None
        links, low = [], 0
        for x, s, t in a:
            while low < len(b) and b[low][2] <= s:
                low += 1
            k = low
            while k < len(b) and b[k][1] < t:
                links.append((x, b[k][0]))
                k += 1
        cuts = sorted({t for _, _, t in a} & {t for _, _, t in b})
        groups, lo = [], 0
        for c in cuts:
            groups.append(",".join(str(x) for x, _, t in a if lo < t <= c) + "|" + ",".join(str(x) for x, _, t in b if lo < t <= c))
            lo = c
        return len(a), len(b), groups, links


def brute(rows):
    plain = Plain()
    found = [(d, plain.one(t)) for d, t in rows]
    counts = defaultdict(int)
    for _, f in found:
        for pair in set(f[3]) if f else ():
            counts[pair] += 1
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    out = []
    for d, f in found:
        if not f:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((d, f[0], f[1], len(f[2]), len(f[3]), sum(counts[p] == top[p[0]] for p in f[3]), sum(counts[p] for p in f[3]),
                        hashlib.sha256(";".join(f[2]).encode()).hexdigest()))
    return sorted(out, key=repr)


def texts():
    rng = random.Random(13)
    odd = ["<|endoftext|> x", "<s>a</s>", "a▁b", " ", "   ", "trailing  ", " leading", "a \n b", "tabs\t\tand\r\n lines \n", "日本語 \U0001F600\U0001F468‍\U0001F469 é ﬁ",
           "x y　z  w", "don't we'll  it's", "zero\x00byte", "ends here\n", "\n\n  \n x", "́combining é", "123 4567.89", "\x1c a \x85 b", "aa   bb    cc"]
    return [(i, t) for i, t in enumerate(odd)] + [(100 + i, prose(rng, rng.randrange(1, 300))) for i in range(30)]


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_alignment_matches_whole_texts_by_brute_force(spark, monkeypatch):
    rows = texts() + [(i, t if len(t or "") < 20_000 else t[:20_000]) for i, t in awkward()]
    docs = docs_of(spark, rows).withColumn("n_a", F.lit("clash")).withColumn("pairs", F.lit(0))
    expected = brute(rows)
    assert rows_of(alignment.alignment(docs, {"doc_id": F.col("doc_id")}, (A, B))) == expected
    # several broadcast blocks
    assert rows_of(alignment.alignment(docs, {"doc_id": F.col("doc_id")}, (A, B), most=40)) == expected


def test_long_texts_small_caches_and_whole_texts_change_nothing(monkeypatch):
    rows = [t for _, t in texts()] + [prose(random.Random(3), 3000)]
    want = alignment.Aligner(A, B).texts(rows)

    def same(got):
        assert (got[0] == want[0]).all() and got[1] == want[1]
        assert all((x == y).all() for k in (2, 3) for x, y in zip(got[k], want[k]))

    whole = alignment.Aligner(A, B)
    assert whole.cuts
    whole.cuts = False
    same(whole.texts(rows))
    monkeypatch.setattr(alignment, "CACHE_CHUNKS", 5)
    monkeypatch.setattr(alignment, "JOINED", 3)
    monkeypatch.setattr(alignment, "PIECE_CHARS", 50)
    same(alignment.Aligner(A, B).texts(rows))


def test_spans_are_refined_by_decoded_bytes():
    import numpy as np

    # a two-byte character in two tokens with one span, then a token with an exact span
    assert alignment.refine(np.array([0, 0, 2]), np.array([2, 2, 5]), np.array([1, 1, 3])).tolist() == [1, 2, 5]
    # an added first byte that the span leaves out
    assert alignment.refine(np.array([1, 3]), np.array([3, 4]), np.array([3, 1])).tolist() == [3, 4]


@pytest.mark.parametrize("rows", [[], [(1, None), (2, ""), (None, "a b")]])
def test_empty_tables_and_texts(spark, rows):
    assert rows_of(alignment.alignment(docs_of(spark, rows), {"doc_id": F.col("doc_id")}, (A, B))) == brute(rows)
