"""Operator 11, line dedup: lines that many documents share stay in one of them only. Column functions throughout.

A text is split at line breaks. A line's key is the line without white space at both ends, A-Z lower-cased. Keys of
``min_chars`` code points or more are hashed (128 bits: two 64-bit hashes with different seeds). Per hash the distinct
documents and the smallest one are found; from ``min_docs`` documents on, every document but the smallest loses its lines
with that key. The other lines are put together again by position.

Scale: the texts are split and hashed once, into a table of one row per (document, line) with hashes and numbers, never text; counts
and verdicts shuffle only that. Hashes are counted per ``SALT`` groups of documents first and summed then, and the verdict goes
back to the groups in which the hash occurs, so that a line in a third of all rows is spread over ``SALT`` tasks both ways. The
texts are joined once with the positions that each loses. Inside a row all steps are linear in the number of lines.

Defined results: a null or empty text is one empty line. Rows with a null doc_id are no documents to the counts and lose
nothing. Rows that repeat a doc_id are one document; each loses its own lines. The smallest document keeps every
copy of a line that it holds. An empty table gives an empty result. Columns of the input that are not carried are ignored,
and names like those of the result do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import prepare, stored, text_hash, unwrap, whole_row

MIN_CHARS = 10
MIN_DOCS = 2
#: Groups of documents by which a hash is counted first.
SALT = 64
#: Fixed values of the key: white space at both ends goes, A-Z become lower case.
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line):
    return F.translate(F.btrim(line, F.lit(BLANK)), UPPER, LOWER)


def hashed_lines(rows: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``(id, th, pos, h1, h2, salt)`` of the lines long enough to count; rows: ``(id, th, text)``."""
    lines = rows.filter(F.col("id").isNotNull()).select("id", "th", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keyed = lines.select("id", "th", "pos", key_of(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    return keyed.select("id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
                        F.pmod(F.xxhash64("id"), F.lit(SALT)).alias("salt"))


def dropped_positions(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(id, th, gone)``: the positions that a text loses; lines: from ``hashed_lines``."""
    dealt = lines.repartition("h1", "h2", "salt")
    per_salt = (dealt.groupBy("h1", "h2", "salt", "id").agg(F.lit(1).alias("one"))
                .groupBy("h1", "h2", "salt").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low")))
    shared = (per_salt.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.min("low").alias("low"))
              .filter(F.col("n") >= min_docs).select("h1", "h2", F.col("low").alias("first")))
    verdict = per_salt.select("h1", "h2", "salt").join(shared, ["h1", "h2"])
    lost = dealt.join(verdict, ["h1", "h2", "salt"]).filter(F.col("id") != F.col("first"))
    return lost.groupBy("id", "th").agg(F.collect_set("pos").alias("gone"))


def dedup(docs: DataFrame, carry: dict[str, object], min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``carry`` columns plus ``n_lines`` (before), ``n_dropped`` and ``kept``, the text that is left."""
    prepare(docs.sparkSession)
    lines = stored(hashed_lines(docs.select(F.col("doc_id").alias("id"), text_hash().alias("th"), "text"), min_chars), "lines")
    gone = dropped_positions(lines, min_docs)
    rows = docs.select(F.struct(*[c.alias(n) for n, c in carry.items()]).alias("carry"), F.col("doc_id").alias("__id"),
                       text_hash().alias("__th"), F.coalesce("text", F.lit("")).alias("text"))
    # split once per row, below the expression that picks lines by position
    joined = rows.join(gone, (F.col("__id") == F.col("id")) & (F.col("__th") == F.col("th")), "left").select(
        "carry", "text", "gone", lines_of(F.col("text")).alias("lines"))
    staying = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(staying, lambda i: F.get(F.col("lines"), i)), "\n"))
    return joined.select(*[F.col("carry")[n].alias(n) for n in carry], F.size("lines").cast("long").alias("n_lines"),
                         F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"), kept.alias("kept"))


def dedup_rows(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with the shared lines taken out of ``text``; the other columns as they are."""
    found = dedup(docs, {"row": whole_row(docs)}, min_chars, min_docs)
    return unwrap(found.select(F.struct(*[
        (F.when(F.col("row.text").isNotNull(), F.col("kept")) if c == "text" else F.col("row")[c]).alias(c)
        for c in docs.columns]).alias("row")), docs)
