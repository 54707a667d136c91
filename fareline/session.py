"""Session settings and the shared scratch folder."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Largest estimated size of a side that may be broadcast by hint.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def build_session(master: str | None = None, partitions: int | None = None) -> SparkSession:
    """Session with AQE, UTC and the RocksDB state store. On a cluster the partition count is
    left to the submit settings and AQE coalescing."""
    b = (
        SparkSession.builder.appName("fareline")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master).config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g")
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def ensure_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


_local_root: str | None = None


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``. Only a local session
    may leave the setting out; it then uses a temporary folder of this machine."""
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="fareline-")
            atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
        root = _local_root
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, label: str, *parts: str) -> DataFrame:
    """Write to the shared folder and read back: survives executor loss, unlike a local copy. With
    ``parts``, folders by these columns, so that a condition on them reads its folders alone."""
    path = scratch(df.sparkSession, label)
    df.write.partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of a plan; runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small_side(df: DataFrame, expand: int = 1, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint only where the estimated size is within the limit; otherwise the plain
    frame, so that the join falls back to a shuffle (with AQE skew handling).

    The optimizer does not count the rows an ``explode`` adds: pass that factor as ``expand``."""
    return F.broadcast(df) if estimated_bytes(df) * expand <= limit else df


#: Rows that one task of per-row work (parsing, draws) takes; a table of more rows gets more tasks.
ROWS_PER_TASK = 100_000


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a narrow input so that every core has a task and no task has more than about
    ``ROWS_PER_TASK`` rows. Files are split by their bytes, which says little about the work: a small
    file or a large row group is one task. Meant for projections of a table, which the file footers
    count; inputs that already have as many partitions pass unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(cores, -(-df.count() // ROWS_PER_TASK))
    return df.repartition(parts, key) if df.rdd.getNumPartitions() < parts else df
