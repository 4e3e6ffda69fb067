"""Operator 6, quality rules with host-level verdicts; native column expressions only.

Per document: word and symbol counts, repeated lines, and words in repeated 3-word windows. A text whose
windows are all different is settled by one hash-set pass; only others sort their windows within the row.
Nothing is exploded, so no text or word is shuffled.

Per host (``source``): the share of documents failing any rule, shrunk towards the corpus by a beta prior
fitted to the hosts' rates (method of moments, each host counted once). The verdict joins back: a document goes
if it fails a base rule or is symbol-heavy; on a host whose shrunk rate exceeds ``HOST_LIMIT``, one soft failure
(repeated lines, odd word lengths) suffices. A document that fails no rule stays, whatever its host.

Defined results: null text has no words and fails for its length. A null host is a host of its own. With
fewer than two hosts or equal rates the prior falls back to ``PRIOR_WEIGHT`` documents at the corpus rate.
A document that repeats ids or rows keeps each row. The hosts table is joined as the planner sees fit (it is small
unless hosts are as many as documents); a host with a third of all rows is pre-aggregated before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import prepare, stored, unwrap, whole_row

#: The white space between words, and the symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOL_PERCENT = 10
DUP_LINE_PERCENT = 30
WORD_LENGTHS = (2, 12)
HOST_LIMIT = 0.5
PRIOR_WEIGHT = 20.0


def measures(docs: DataFrame, carry: dict[str, object], text: str = "text") -> DataFrame:
    """``carry`` columns plus n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(*[c.alias(n) for n, c in carry.items()], t.alias("__t"))
    body = F.btrim("__t", F.lit(SPACES))
    a = base.select(
        *carry,
        F.when(F.length(body) == 0, F.array().cast("array<string>")).otherwise(
            F.split(body, r"[\x20\x09-\x0D]+")).alias("__w"),
        F.length(F.translate("__t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("__t", "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0).alias("__l"))
    b = a.select(
        *carry, "word_chars", "n_symbols", F.size("__w").cast("long").alias("n_words"),
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("__w") < 3, F.array().cast("array<string>")).otherwise(F.transform(
            F.slice(F.col("__w"), F.lit(1), F.size("__w") - 2),
            lambda x, i: F.concat_ws(" ", x, F.get("__w", i + 1), F.get("__w", i + 2)))).alias("__win"))
    counts = ["word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines"]
    nothing = F.array().cast("array<struct<w:string,i:int>>")
    c = b.select(*carry, *counts, F.when(
        F.size(F.array_distinct("__win")) == F.size("__win"), nothing).otherwise(F.sort_array(F.transform(
            "__win", lambda x, i: F.struct(x.alias("w"), i.cast("int").alias("i"))))).alias("__s"))
    # equal neighbours of the sorted windows, the last compared with nothing
    d = c.select(*carry, *counts, "__s", F.zip_with(
        "__s", F.slice("__s", F.lit(2), F.size("__s")), lambda x, y: F.coalesce(x["w"] == y["w"], F.lit(False))).alias("__e"))
    e = d.select(*carry, *counts, F.sort_array(F.array_compact(F.zip_with(
        "__s", F.zip_with("__e", F.concat(F.array(F.lit(False)), F.col("__e")), lambda x, y: F.coalesce(x, F.lit(False)) | y),
        lambda x, hit: F.when(hit, x["i"])))).alias("__p"))
    # windows at sorted starts cover three words each, less where the next one begins earlier
    return e.select(*carry, *counts, F.aggregate(
        F.zip_with("__p", F.slice("__p", F.lit(2), F.size("__p")), lambda x, y: F.least(F.lit(3), y - x)),
        F.lit(0).cast("long"), lambda s, x: s + x).alias("n_repeat_words"))


def rules(m: DataFrame) -> DataFrame:
    """Adds base_failed, symbol_heavy, soft_failed and any_failed."""
    mean = F.col("word_chars") / F.greatest("n_words", F.lit(1))
    return m.withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
        "symbol_heavy": 100 * F.col("n_symbols") > SYMBOL_PERCENT * F.col("n_words"),
        "soft_failed": (100 * F.col("n_dup_lines") > DUP_LINE_PERCENT * F.col("n_lines"))
                       | (mean < WORD_LENGTHS[0]) | (mean > WORD_LENGTHS[1]),
    }).withColumn("any_failed", F.col("base_failed") | F.col("symbol_heavy") | F.col("soft_failed"))


def host_rates(judged: DataFrame, host: str) -> DataFrame:
    """``(host, n_docs, n_failed, rate)``: the failure rate of each host, shrunk by the beta prior."""
    hosts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("any_failed").cast("long")).alias("n_failed"))
    raw = F.col("n_failed") / F.col("n_docs")
    prior = hosts.agg(F.avg(raw).alias("m"), F.var_pop(raw).alias("v"),
                      (F.sum("n_failed") / F.sum("n_docs")).alias("p"), F.count(F.lit(1)).alias("n"))
    spread = F.col("m") * (1 - F.col("m"))
    usable = (F.col("n") > 1) & (F.col("v") > 0) & (F.col("v") < spread)
    prior = prior.select(F.when(usable, F.col("m")).otherwise(F.col("p")).alias("m"),
                         F.when(usable, spread / F.col("v") - 1).otherwise(F.lit(PRIOR_WEIGHT)).alias("s"))
    # the one row of the prior, joined on a constant key
    return hosts.withColumn("one", F.lit(1)).join(F.broadcast(prior.withColumn("one", F.lit(1))), "one").select(
        "host", "n_docs", "n_failed", ((F.col("n_failed") + F.col("m") * F.col("s")) / (F.col("n_docs") + F.col("s"))).alias("rate"))


def verdicts(docs: DataFrame, carry: dict[str, object], host: str = "source") -> DataFrame:
    """``carry`` columns, the measures, base_failed, host_rate, host_bad and kept, per document."""
    prepare(docs.sparkSession)
    judged = stored(rules(measures(docs, carry | {"__host": F.col(host)})), "quality")
    # stored, so that the planner knows its size before it would shuffle the documents by host
    rates = stored(host_rates(judged, "__host").select("host", F.col("rate").alias("host_rate")), "quality-hosts")
    out = judged.join(rates, F.col("__host").eqNullSafe(F.col("host")))
    bad = F.col("host_rate") > HOST_LIMIT
    return out.select(*carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "host_rate", bad.alias("host_bad"),
                      (~F.col("base_failed") & ~F.col("symbol_heavy") & ~(bad & F.col("soft_failed"))).alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their columns."""
    return unwrap(verdicts(docs.withColumn("__row", whole_row(docs)), {"row": F.col("__row")}).filter("kept"), docs)
