"""Session helpers: a local session for tests and bench, shared-folder checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Rows of a vocabulary that may be broadcast to Python tasks (about 100 bytes each).
# Larger vocabularies go through joins instead.
MAX_BROADCAST_ROWS = 1_000_000
# Bytes of an Arrow batch.
BATCH_BYTES = 8 << 20


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session; on a cluster, pass your own session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vocabspark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named by the session.

    Only a local session may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="vocabspark-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a written table in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives losses."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like :func:`checkpoint`, but compressed, and readers take only the columns they need; for tables of plain rows.

    A table that Parquet can't hold is checkpointed.
    """
    kinds = [kind for _, kind in df.dtypes]
    if any(word in kind for kind in kinds for word in ("void", "interval", "variant")) or len({c.lower() for c in df.columns}) < len(kinds):
        return checkpoint(df)
    path = scratch_path(df.sparkSession, "rows")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep(df: DataFrame) -> DataFrame:
    """Persist with spill to disk; lost blocks are recomputed."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def task_count(df: DataFrame, rows_per_task: int) -> int:
    """Tasks for work that costs more than its bytes suggest: by rows, at least one per core."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a corpus of fewer input partitions than that.

    A corpus of many files has far more partitions than there are cores and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether a table is small enough to send to every task; counts at most one row more."""
    bound = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    return df.limit(bound + 1).count() <= bound


def limit_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of a session that has Spark's own bound: eight times as much for every task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":
        spark.conf.set(key, BATCH_BYTES)
