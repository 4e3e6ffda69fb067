"""Readers for the input tables.

Tables are read with only the columns used (the scan's ``ReadSchema`` is pruned).

A table is read as the scan splits it; only a scan with fewer splits than cores (one small file) is
hash-spread over its key. The index build aggregates within each split first, so what it shuffles is
one row per (term, document), on that composite key: no document and no frequent term is one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def cores_and_splits(df: DataFrame) -> tuple[int, int]:
    """(default parallelism, partitions of ``df``'s plan); falls back to the shuffle-partition
    setting where the session exposes no SparkContext (Spark Connect)."""
    spark = df.sparkSession
    try:
        return spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    except Exception:   # noqa: BLE001 - no RDD API on this session
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return n, n


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread ``df`` by ``keys`` only when its scan has fewer partitions than cores."""
    cores, splits = cores_and_splits(df)
    return df.repartition(cores, *keys) if splits < cores else df


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """``(doc_id BIGINT, text STRING)``: one page per document."""
    df = read_table(spark, sf_dir, table).select(F.col("doc_id").cast("bigint"), "text")
    return spread(df, "doc_id")


def conversation_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, page_no, text)``: each conversation is a document, each turn a page. Spread by page,
    as one document may hold a third of all pages."""
    df = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint").alias("doc_id"),
        F.col("turn").cast("bigint").alias("page_no"), "text")
    return spread(df, "doc_id", "page_no")


def web_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(page_id, url, html)`` stored web pages."""
    df = read_table(spark, sf_dir, "pages").select(F.col("page_id").cast("bigint"), "url", "html")
    return spread(df, "page_id")
