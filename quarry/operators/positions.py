"""Token occurrences with positions.

Positions are 1-based over *raw* tokens and run on across the pages of a document, so a token never
spans pages and tokens dropped later still use up a position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.tokenize import token_array
from quarry.session import written

# Width of a page bucket in the two-level running offset: a document with very many pages is split
# into buckets of at most this many pages, so no window ever holds one whole document.
PAGE_BUCKET = 4096
# Characters of a page beyond which it is tokenized in pieces.
PIECE_CHARS = 1 << 16


def tokenize_docs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id BIGINT, pos BIGINT, token STRING)`` for one-page documents. Narrow: no shuffle."""
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.posexplode(token_array(text_col)).alias("p0", "token"))
            .select("doc_id", (F.col("p0") + 1).cast("bigint").alias("pos"), "token"))


def tokenize_docs_marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``tokenize_docs`` plus one marker row per document with at least one token: position 0,
    a null token (no real token is null) and ``__m`` true. The marker lets one pass over the text
    yield both the postings and the list of non-empty documents."""
    arr = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), token_array(text_col).alias("__t"))
    marked = F.when(F.size("__t") > 0, F.concat(F.array(F.lit(None).cast("string")), F.col("__t")))
    return (arr.select("doc_id", F.posexplode(marked).alias("p0", "token"))
            .select("doc_id", F.col("p0").cast("bigint").alias("pos"), "token",
                    (F.col("p0") == 0).alias("__m")))


def page_pieces(pages: DataFrame, text_col: str = "text", piece_chars: int = PIECE_CHARS) -> DataFrame:
    """The rows of ``pages`` without their text, in pieces: ``piece`` (from 0) and ``part``. A page beyond ``piece_chars`` characters
    is cut before white space, which is in no token, so the pieces' tokens in order are the page's. A run without
    white space stays whole."""
    text = F.col(text_col)
    cut = F.regexp_extract_all(text, F.lit(r"(?s).{1,%d}\S*" % piece_chars), F.lit(0))
    parts = F.when(F.length(text) > piece_chars, cut).otherwise(F.array(F.coalesce(text, F.lit(""))))
    return pages.select(*[c for c in pages.columns if c != text_col], F.posexplode(parts).alias("piece", "part"))


def tokenize_pages(pages: DataFrame, doc_col: str = "doc_id", page_col: str = "page_no", text_col: str = "text",
                   piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``(doc_id, pos, token)`` for multi-page documents with positions running across pages.

    Pages are cut into pieces of bounded length and stored with a number per page row, so pages that repeat a number
    (ordered by their text) or have none (first) keep their own tokens and positions. Only numbers go through windows: the
    token counts of pieces are summed in buckets of ``PAGE_BUCKET`` pages and the buckets' totals over the document. The sums
    then go back to the pieces by row and piece, which no document or page can make uneven, and each piece is tokenized
    by itself: no row holds the tokens of a whole long page, and no group the text of two pages unless they repeat a number.
    """
    rows = pages.select(F.col(doc_col).cast("bigint").alias("doc_id"), F.col(page_col).cast("bigint").alias("page_no"),
                        F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("rid"))
    cut = page_pieces(rows, "text", piece_chars)
    pieces = written(cut.withColumn("n", F.size(token_array("part")).cast("bigint")), "pieces")
    # copies of a page number are put in the order of their texts; only these texts are looked at
    heads = pieces.filter(F.col("piece") == 0).select("doc_id", "page_no", "rid")
    twice = heads.groupBy("doc_id", "page_no").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > 1)
    copies = heads.alias("h").join(twice.alias("t"), F.col("h.doc_id").eqNullSafe(F.col("t.doc_id")) &
                                   F.col("h.page_no").eqNullSafe(F.col("t.page_no")), "left_semi").select("h.rid")
    texts = (pieces.join(copies, "rid", "left_semi").groupBy("rid", "doc_id", "page_no")
             .agg(F.array_sort(F.collect_list(F.struct("piece", "part"))).alias("p"))
             .select("rid", "doc_id", "page_no", F.array_join(F.col("p.part"), "").alias("text")))
    ranks = texts.select("rid", F.row_number().over(Window.partitionBy("doc_id", "page_no").orderBy("text", "rid")).alias("copy"))
    counts = (pieces.select("doc_id", "page_no", "rid", "piece", "n").join(ranks, "rid", "left")
              .withColumn("copy", F.coalesce("copy", F.lit(1))).withColumn("bucket", F.floor(F.col("page_no") / F.lit(PAGE_BUCKET))))
    totals = counts.groupBy("doc_id", "bucket").agg(F.sum("n").alias("bn"))
    before = totals.select(
        F.col("doc_id").alias("d"), F.col("bucket").alias("b"),
        F.coalesce(F.sum("bn").over(Window.partitionBy("doc_id").orderBy("bucket")
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    order = Window.partitionBy("doc_id", "bucket").orderBy("page_no", "copy", "piece").rowsBetween(Window.unboundedPreceding, -1)
    within = counts.withColumn("inner", F.coalesce(F.sum("n").over(order), F.lit(0)))
    offsets = within.filter("n > 0").join(
        before, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("bucket").eqNullSafe(F.col("b"))).select(
        "rid", "piece", (F.col("base") + F.col("inner")).alias("offset"))
    placed = pieces.filter("n > 0").select("rid", "piece", "doc_id", "part").join(offsets, ["rid", "piece"])
    toks = placed.select("doc_id", "offset", F.posexplode(token_array("part")).alias("p0", "token"))
    return toks.select("doc_id", (F.col("offset") + F.col("p0") + 1).cast("bigint").alias("pos"), "token")
