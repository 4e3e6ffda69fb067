"""Helpers shared by the operators: table access, Arrow batch mapping, stored intermediates.

Conventions of every operator: a null text counts as empty, a null ``doc_id`` keeps its row, repeated
rows keep their count, extra columns of the input are carried or ignored but never read by name clash.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import ensure_checkpoint_dir, shared_scratch_path

#: Bytes of text that a task turns into Python objects at a time, and rows of an Arrow batch.
SLICE_BYTES = 4 << 20
BATCH_ROWS = 1000

#: Fixed byte table of the word class [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z: letters,
#: digits and every byte of a multi-byte character stay, A-Z become a-z, all else becomes a space.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256))


def prepare(spark: SparkSession) -> None:
    """Make the session ready: checkpoint folder, moderate Arrow batches, and the package on executors
    that do not have it (shipped once per application through Spark's own file distribution)."""
    ensure_checkpoint_dir(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_quarry_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    fd, archive = tempfile.mkstemp(suffix=".zip", prefix="quarry-")
    with os.fdopen(fd, "wb") as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(root, "quarry")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(archive)
    sc._quarry_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back: cuts the lineage
    with files that survive the loss of any executor."""
    spark = df.sparkSession
    path = shared_scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def text_hash(column: str = "text"):
    """64-bit hash that, with ``doc_id``, identifies a row up to exact repetition."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")), F.col(column).isNull())


def crc_of_id(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string"))


def slices(batch: pa.RecordBatch, name: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive pieces of about ``limit`` bytes of text (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < n:
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def map_texts(docs: DataFrame, fn: Callable[[pa.Array], list[pa.Array]], fields: list[tuple[str, T.DataType]],
              carry: dict[str, object], text: str = "text") -> DataFrame:
    """One row in, one row out: ``carry`` columns (name -> expression) plus what ``fn`` computes.

    ``fn`` gets the texts of a slice as an Arrow string array (nulls as empty strings) and returns one
    Arrow array per field.
    """
    prepare(docs.sparkSession)
    src = docs.select(*[c.alias(n) for n, c in carry.items()],
                      F.coalesce(F.col(text), F.lit("")).alias("__text"))
    schema = T.StructType([f for f in src.schema if f.name != "__text"] + [T.StructField(n, t) for n, t in fields])
    names = [f.name for f in schema]
    kept = list(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + fn(part.column("__text")), names=names)

    return src.mapInArrow(run, schema)


def as_bytes(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.binary()).to_pylist()


def ascii_words(data: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 text after lower-casing A-Z."""
    return data.translate(_WORD_BYTES).split()


def whole_row(docs: DataFrame):
    """The input row as one struct column, so that results never clash with its columns."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def unwrap(df: DataFrame, docs: DataFrame, struct: str = "row") -> DataFrame:
    return df.select(*[F.col(struct)[c].alias(c) for c in docs.columns])
