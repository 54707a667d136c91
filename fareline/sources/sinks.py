"""Writers: partitioned files, keyed upserts, archives."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareline import constants as K


def write_partitioned(df: DataFrame, path: str, by: str, salt: int = 1) -> None:
    """Partition folders overwritten one by one. Rows are shuffled by the partition key so that a
    folder gets few files; ``salt`` spreads a hot key over that many writers."""
    spread = [F.col(by)] if salt == 1 else [F.col(by), F.pmod(F.xxhash64(*df.columns), F.lit(salt))]
    df.repartition(*spread).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_small(df: DataFrame, path: str, files: int = 1) -> None:
    """A report-sized result in ``files`` files."""
    df.coalesce(files).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def last_write_wins(rows: DataFrame, keys: list[str], *newest_first: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if fs.exists(target) else None


def upsert(batch: DataFrame, path: str, keys: list[str], part: str, version: str) -> None:
    """Merge a batch into a table by key, the higher ``version`` winning.

    Only partitions that the batch touches are read and rewritten. The merged rows are written to a
    side folder first, because a partition cannot be overwritten while it is being read; a failed
    task can then be repeated from that folder.
    """
    spark = batch.sparkSession
    old = _existing(spark, path)
    if old is not None:
        touched = [r[0] for r in batch.select(part).distinct().collect()]
        batch = old.where(F.col(part).isin(touched)).unionByName(batch)
    merged = last_write_wins(batch, keys, F.desc(version))
    from fareline.session import cut_lineage

    write_partitioned(cut_lineage(merged, "upsert"), path, part)


def insert_absent(batch: DataFrame, path: str, keys: list[str], order: list[Column], part: str | None = None) -> None:
    """Add rows whose key is not in the table yet; within a batch the first row wins. With ``part``
    (one of the keys) the table is partitioned by it and only the batch's partitions are looked at.
    Running a batch twice adds nothing, so a retried micro-batch is harmless."""
    first = last_write_wins(batch, keys, *order)
    old = _existing(batch.sparkSession, path)
    if old is not None:
        if part:
            old = old.where(F.col(part).isin([r[0] for r in batch.select(part).distinct().collect()]))
        first = first.join(old.select(*keys), keys, "left_anti")
    writer = first.write.mode("append")
    (writer.partitionBy(part) if part else writer).parquet(path)


def ttl_view(df: DataFrame, ts: str, ttl_s: int, as_of: Column) -> DataFrame:
    """Rows still alive at ``as_of``."""
    return df.where(F.col(ts) > as_of - F.expr(f"INTERVAL {ttl_s} SECONDS"))


def archive_columns(df: DataFrame, ts: str = "event_time", zone: str = K.ARCHIVE_ZONE) -> DataFrame:
    """Partition columns year/month/day/hour of the event in local time."""
    local = F.from_utc_timestamp(ts, zone)
    return df.withColumns({k: F.date_format(local, f) for k, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))})


def write_archive(df: DataFrame, path: str, ts: str = "event_time") -> None:
    archive_columns(df, ts).write.mode("append").partitionBy("year", "month", "day", "hour").json(path)
