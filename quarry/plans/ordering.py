"""Dense 1..n numbering in a global order without a single-partition window.

Rows are range partitioned on the order key, sorted inside each partition and checkpointed to the
shared checkpoint folder (range bounds are sampled, and the sample depends on row arrival order, so
the partitioning must be fixed once). A first pass counts rows per partition (one number per
partition reaches the driver), a second pass adds each partition's offset to the row's index inside
its partition. Both passes read the same checkpoint, so the numbering is stable across passes and
after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import reliable_checkpoint


def dense_index(df: DataFrame, order_cols: list[str], out_col: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 1-based index of each row in ``order_cols`` order (keys must be unique)."""
    return dense_index_with_total(df, order_cols, out_col, num_partitions)[0]


def dense_index_with_total(df: DataFrame, order_cols: list[str], out_col: str = "rank",
                           num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """``dense_index`` plus the number of rows (known from the per-partition counts)."""
    spark = df.sparkSession
    n = num_partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = reliable_checkpoint(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols))
    tagged = ranged.select("*", F.spark_partition_id().alias("__pid"),
                           F.monotonically_increasing_id().alias("__mid"))
    counts = {r["__pid"]: r["count"] for r in tagged.groupBy("__pid").count().collect()}
    offsets, running = [], 0
    for pid in range(n):
        offsets.append(running)
        running += counts.get(pid, 0)
    starts = spark.createDataFrame(list(enumerate(offsets)), "__part INT, __start BIGINT")
    local_index = F.col("__mid") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    # one row per partition
    out = tagged.join(F.broadcast(starts), F.col("__pid") == F.col("__part")).select(
        *[F.col(c) for c in df.columns], (F.col("__start") + local_index + 1).alias(out_col))
    return out, running


def nth_smallest(df: DataFrame, order_cols: list[str], n: int) -> tuple | None:
    """Values of ``order_cols`` at the n-th row in ascending order (keys unique), or ``None`` when
    ``df`` has fewer than n rows. The keys are range partitioned and counted per partition; only the
    partition that holds the n-th is looked at. One row reaches the driver."""
    if n < 1:
        raise ValueError("n must be at least 1")
    ranked = dense_index(df.select(*order_cols), order_cols, "__rank")
    rows = ranked.filter(F.col("__rank") == n).select(*order_cols).collect()
    return tuple(rows[0]) if rows else None
