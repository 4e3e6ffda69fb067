"""Session helpers.

``get_session`` is for tests, the bench and local use. On a cluster the session already exists and
carries its own settings; the library reads from it and only fills in what is unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry") -> SparkSession:
    builder = (
        SparkSession.builder.master(master or "local[*]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # remove checkpoint files of checkpointed data that is no longer referenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        # The fused token pipeline (tokenize, filters, Porter steps) compiles to one large method;
        # HotSpot skips JIT for methods over 8000 bytes unless told otherwise.
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session has none and runs in local mode (tests) is a scratch folder created and
    set; on a cluster an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors (e.g. on the "
                           "cluster's distributed file system); a machine-local folder does not "
                           "survive executor loss")
    local = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("QUARRY_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def tune_codegen(spark: SparkSession) -> None:
    """Sessions whose JVMs lack ``JIT_OPTIONS`` compile operators separately where the fused token pipeline
    would be too large a method for the JIT."""
    conf = spark.sparkContext.getConf()
    options = conf.get("spark.executor.extraJavaOptions", "") + conf.get("spark.driver.extraJavaOptions", "")
    if JIT_OPTIONS not in options:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def shared_scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def written(df, name: str):
    """``df`` written as Parquet below the shared checkpoint folder and read back: what is read later is what was computed
    once, also after an executor is lost."""
    path = shared_scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files and broadcasts of jobs whose frames are gone: it does so when the driver collects its garbage,
    which a loop of many small jobs may not bring about before the disks are full."""
    spark.sparkContext._jvm.System.gc()


def reliable_checkpoint(df):
    """``df.checkpoint()`` (eager, reliable) into the session's checkpoint folder, making sure the
    SparkContext knows that folder first. Never a local checkpoint: the data must survive the loss
    of the executor that computed it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
