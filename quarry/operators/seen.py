"""URLs that earlier deliveries have taken (I4 across deliveries): a set in partitions, with a filter of fixed size in front.

Layout below ``path``: ``urls/{id}/bucket=..`` the URLs of a delivery by hash bucket, ``filter/{id}`` the merged filter, and manifests as in
``operators.store``, the last step of a delivery. The filter is a blocked Bloom filter of ``WORDS`` words of 64 bits: a URL's hash picks a
word, a second one ``BITS`` of its bits. Filters of deliveries are merged by or-ing words, so there is one table of at most
``WORDS`` rows, which may be broadcast at any size of the set. A URL whose bits are not all set was never seen; only the others are
compared exactly, with the buckets that they fall in. A replayed batch changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.links import dedupe_urls
from quarry.operators.store import publish, read_manifest
from quarry.session import delete_path, ensure_checkpoint_dir, written

WORDS = 1 << 18
BITS = 4
BUCKETS = 64
_URLS = "url string, page_id bigint, link_no bigint, bucket int"
_FILTER = "word bigint, bits bigint"


def _place(url):
    """The word and the bits of a URL."""
    h = F.xxhash64(F.lit(7), url)
    mask = F.lit(0).cast("bigint")
    for k in range(BITS):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.call_function("shiftright", h, F.lit(6 * k)).bitwiseAND(F.lit(63)).cast("int")))
    return F.pmod(F.xxhash64(url), F.lit(WORDS)).alias("word"), mask.alias("mask")


def seen_urls(spark: SparkSession, path: str) -> DataFrame:
    """``(url, page_id, link_no, bucket)`` of all committed deliveries: every URL once, where it was first met."""
    parts = read_manifest(spark, path).get("urls", [])
    if not parts:
        return spark.createDataFrame([], _URLS)
    frames = [spark.read.schema(_URLS).parquet(f"{path}/urls/{p}") for p in parts]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def take(spark: SparkSession, path: str, links: DataFrame, batch_id: int) -> dict:
    """Commit the URLs of ``(page_id, link_no, url)`` that no earlier delivery had. Returns the manifest; its ``checked`` counts the URLs
    of this delivery that the filter let through, ``found`` those of them that were really there."""
    ensure_checkpoint_dir(spark)
    m = read_manifest(spark, path)
    if batch_id <= m["sources"].get("urls", -1):
        return m
    new = json.loads(json.dumps(m))
    new["generation"] += 1
    new["sources"]["urls"] = batch_id
    name = f"{new['generation']:012d}-{uuid.uuid4().hex[:8]}"
    word, mask = _place(F.col("url"))
    once = dedupe_urls(links.filter(F.col("url").isNotNull())).select("url", "page_id", "link_no")
    batch = written(once.select("*", F.pmod(F.xxhash64("url"), F.lit(BUCKETS)).cast("int").alias("bucket"), word, mask), "urls")
    known = spark.read.schema(_FILTER).parquet(f"{path}/filter/{m['filter']}") if m.get("filter") else spark.createDataFrame([], _FILTER)
    # at most WORDS rows of 16 bytes
    judged = batch.join(F.broadcast(known), "word", "left").withColumn(
        "maybe", F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))).drop("bits")
    judged = written(judged, "judged")
    maybe = judged.filter("maybe")
    buckets = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]    # at most BUCKETS
    old = seen_urls(spark, path).filter(F.col("bucket").isin(buckets)).select("url", "bucket")
    fresh = written(judged.filter("not maybe").unionByName(maybe.join(old, ["url", "bucket"], "left_anti")), "fresh")
    new["checked"], n = maybe.count(), judged.count()
    new["found"] = n - fresh.count()
    fresh.select("url", "page_id", "link_no", "bucket").repartition("bucket").sortWithinPartitions("bucket", "url").write.partitionBy("bucket").parquet(f"{path}/urls/{name}")
    bits = known.unionByName(fresh.select("word", F.col("mask").alias("bits"))).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    bits.write.parquet(f"{path}/filter/{name}")
    new["urls"] = m.get("urls", []) + [name]
    new["filter"] = name
    publish(spark, path, new)
    if m.get("filter") and m["generation"] > 1:
        # a reader of the generation before has its filter still; the one before that is of no use
        older = read_manifest(spark, path, m["generation"] - 1).get("filter")
        if older:
            delete_path(spark, f"{path}/filter/{older}")
    return new
