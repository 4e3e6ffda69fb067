"""Plain-text formats (S2-S5): the raw token log and the link manifest, written and read back.

Token log line: ``{token} / Doc ID: {doc_id} / Pos: {pos}``. Manifest line: ``{doc_id}) {url}``.
Readers use one anchored regex per line; the token group is greedy, so a token that itself contains
`` / `` parses correctly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The line formats and their parsing patterns.
TOKEN_LOG_FORMAT = "%s / Doc ID: %d / Pos: %d"
TOKEN_LOG_PATTERN = r"(?s)^(.*) / Doc ID: (\d+) / Pos: (\d+)$"
MANIFEST_FORMAT = "%d) %s"
MANIFEST_PATTERN = r"(?s)^(\d+)\) (.*)$"


def token_log_lines(tokens: DataFrame) -> DataFrame:
    """``(doc_id, pos, line)`` per raw token."""
    return tokens.select("doc_id", "pos",
                         F.format_string(TOKEN_LOG_FORMAT, F.col("token"), F.col("doc_id"), F.col("pos"))
                         .alias("line"))


def write_token_log(tokens: DataFrame, path: str, per_document: bool = False, in_order: bool = False) -> None:
    """Write the token log; lines of a document are in position order. ``per_document`` writes one
    folder per document (a file-per-document layout; only for modest collections). With ``in_order`` the tokens come
    in the order of the log already (see ``ordered_texts``) and do not move. The log as a whole is compressed: its lines
    are many times as long as the words."""
    lines = token_log_lines(tokens)
    if per_document:
        (lines.repartition("doc_id").sortWithinPartitions("doc_id", "pos")
         .select("doc_id", "line").write.mode("overwrite").partitionBy("doc_id").text(path))
    else:
        if not in_order:
            lines = lines.repartitionByRange("doc_id", "pos").sortWithinPartitions("doc_id", "pos")
        lines.select("line").write.mode("overwrite").text(path, compression="gzip")


def ordered_texts(docs: DataFrame) -> DataFrame:
    """Documents by ranges of ids, in order: the tokens of what this gives are in the order of the log if no id comes twice."""
    return docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")


def read_token_log(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``(token, doc_id, pos)`` parsed from token-log text files. Lines that do not parse are
    listed by ``read_rejected_lines``."""
    raw = spark.read.text(path).select(F.col("value"))
    ok = raw.filter(F.col("value").rlike(TOKEN_LOG_PATTERN))
    return ok.select(F.regexp_extract("value", TOKEN_LOG_PATTERN, 1).alias("token"),
                     F.regexp_extract("value", TOKEN_LOG_PATTERN, 2).cast("bigint").alias("doc_id"),
                     F.regexp_extract("value", TOKEN_LOG_PATTERN, 3).cast("bigint").alias("pos"))


def read_rejected_lines(spark: SparkSession, path: str, pattern: str = TOKEN_LOG_PATTERN) -> DataFrame:
    """``(file, line)``: the lines of a token log (or, with its pattern, a manifest) that do not parse."""
    raw = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line"))
    return raw.filter(~F.col("line").rlike(pattern))


def manifest_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, line)`` for ``(doc_id, url)`` rows."""
    return docs.select("doc_id", F.format_string(MANIFEST_FORMAT, F.col("doc_id"), F.col("url")).alias("line"))


def write_manifest(docs: DataFrame, path: str, append: bool = True) -> None:
    manifest_lines(docs).orderBy("doc_id").select("line").write.mode("append" if append else "overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, url)`` parsed from manifest files."""
    raw = spark.read.text(path).filter(F.col("value").rlike(MANIFEST_PATTERN))
    return raw.select(F.regexp_extract("value", MANIFEST_PATTERN, 1).cast("bigint").alias("doc_id"),
                      F.regexp_extract("value", MANIFEST_PATTERN, 2).alias("url"))


# ---------------------------------------------------------------------------------------------
# Report sinks (S6-S10). Each writes one text line per row in the report's order; ordering uses a
# range-partitioned sort, so the files are ordered across parts without a single-task sort.

def write_index_dump(dump: DataFrame, path: str) -> None:
    """``(term, df, line)`` from ``render.index_dump`` written in term order."""
    dump.orderBy("term").select("line").write.mode("overwrite").text(path)


def show_index_dump(dump: DataFrame, n: int = 20) -> None:
    """Print the first ``n`` lines of the dump in term order."""
    dump.orderBy("term").select("line").show(n, truncate=False)


def write_session(session_line: DataFrame, path: str) -> None:
    """The one-line session file."""
    session_line.select("line").coalesce(1).write.mode("overwrite").text(path)


def write_results(result_lines: DataFrame, path: str) -> None:
    """``(query_id, line)`` in query order."""
    result_lines.orderBy("query_id").select("line").write.mode("overwrite").text(path)


def write_cluster_report(report: DataFrame, path: str) -> None:
    """``(k, section, cluster, line)`` in report order."""
    report.orderBy("k", "section", "cluster").select("line").write.mode("overwrite").text(path)
