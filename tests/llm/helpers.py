"""Rows that every operator must cope with, and small builders."""

import random

DOC_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def docs_of(spark, rows):
    """rows: (doc_id, text) or full rows."""
    full = [r if len(r) == 5 else (r[0], r[1], "en", "src0", len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA).repartition(3)


def prose(rng: random.Random, n: int, words: int = 300) -> str:
    vocabulary = [a + b for a in ("an", "be", "to", "re", "ing", "ou", "st") for b in ("er", "on", "ly", "ha", "ti", "nd", "es")]
    return " ".join(rng.choice(vocabulary) + (str(rng.randrange(words)) if rng.random() < 0.3 else "") for _ in range(n))


def awkward():
    """Null and empty texts, a null id, repeated rows, a very long text, white space only, non-ASCII text."""
    long = prose(random.Random(5), 60_000)
    return [(1, None), (2, ""), (3, " \t\n "), (None, "null id text with some words in it"), (4, "same"), (4, "same"),
            (5, long), (6, "Ünïcode ťext — ñandú 漢字 \U0001F600 x"), (7, "a"), (8, "a b c")]
