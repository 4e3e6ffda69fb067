"""The operators as queries ``(spark, sf_dir) -> DataFrame`` over whole tables, with their production parameters.

Each query is thin: it reads its table, applies the operator and derives the digest columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    alignment, decontam, langid, lexical, licenses, line_dedup, pii, quality, secret_scan, sentencepiece, simhash, token_files, toxicity,
)
from quarry.llm.common import prepare, table
from quarry.llm.sql import SQL  # noqa: F401  (registered beside the queries)
from quarry.session import shared_scratch_path


#: The id that ends a document in the token files.
END_ID = 1


def _id() -> dict[str, object]:
    return {"doc_id": F.col("doc_id")}


def _digest(text):
    return F.sha2(text, 256)


def _count(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.round_trip(table(spark, sf_dir, "documents"), _id(), sentencepiece.default_model())


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = shared_scratch_path(spark, f"tokens-{uuid.uuid4().hex}")
    token_files.write_shards(table(spark, sf_dir, "documents"), path, token_files.default_tokenizer(), END_ID)
    return token_files.documents(token_files.read_shards(spark, path))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(table(spark, sf_dir, "documents"), _id())
    s = F.col("spans")
    return found.select(
        "doc_id", *[_count(s, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        _digest(pii.joined(secret_scan.base_only(s))).alias("base_sha256"), pii.joined(s).alias("spans"),
        *[_count(s, k).alias(f"n_{k}") for k in ("der", "ssh", "jwt")])


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.verdicts(table(spark, sf_dir, "documents"), _id())
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept", "host_bad")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.licenses(table(spark, sf_dir, "documents"), licenses.template_table(spark), _id())
    spans = F.array_join(F.transform("finds", lambda x: F.concat_ws(
        ":", x["license"], x["start"].cast("string"), x["end"].cast("string"), F.format_string("%.4f", x["coverage"]))), ",")
    return found.select("doc_id", F.size("finds").cast("long").alias("n_finds"),
                        F.array_join(F.sort_array(F.array_distinct("finds.license")), ",").alias("licenses"), spans.alias("spans"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"), _id())
    base, terms = pii.joined(F.col("spans")), pii.joined(F.col("terms"), "term")
    every = F.array_join(F.filter(F.array(base, terms), lambda x: x != ""), ",")
    return found.select("doc_id", *[_count(F.col("spans"), k).alias(f"n_{k}") for k in pii.KINDS[:4]],
                        _digest(base).alias("base_sha256"), every.alias("spans"),
                        F.size("terms").cast("long").alias("n_term"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), _id())
    ids = F.sort_array(F.transform("item_ids", lambda x: x.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        _digest(F.array_join(ids, ",")).alias("items_sha256"), "contaminated")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(table(spark, sf_dir, "documents"), _id())
    return found.select("doc_id", "n_lines", "n_dropped", _digest(F.col("kept")).alias("kept_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), _id(), alignment.default_tokenizers())


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_language": op3_language,
    "op4_token_files": op4_token_files,
    "op5_secrets": op5_secrets,
    "op6_quality": op6_quality,
    "op7_licenses": op7_licenses,
    "op8_pii": op8_pii,
    "op9_simhash": op9_simhash,
    "op10_decontamination": op10_decontamination,
    "op11_line_dedup": op11_line_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_alignment": op13_alignment,
    "pipeline": pipeline,
}
