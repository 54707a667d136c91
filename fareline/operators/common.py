"""Small relational helpers shared by the operators. All are built to hold up when one key owns a
large share of the rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def dedupe(df: DataFrame, key: str | list[str], *order: Column) -> DataFrame:
    """First row per key in a fixed order. ``row_number = 1`` is planned with a group limit before
    the shuffle, so a key with very many copies is cut down on the map side."""
    keys = [key] if isinstance(key, str) else key
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_n(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """Top ``n`` rows per key; same map-side limit as :func:`dedupe`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def enrich(df: DataFrame, dim: DataFrame, key: str, require: bool = False) -> DataFrame:
    """Left lookup; ``require`` turns a missing dimension row into an error at run time."""
    from fareline.session import small_side

    marked = dim.withColumn("_hit", F.lit(True))
    out = df.join(small_side(marked), key, "left")
    if require:
        ok = F.when(F.col("_hit").isNull(), F.raise_error(F.concat(F.lit(f"no {key} row for "), F.col(key).cast("string")))).otherwise(F.lit(True))
        out = out.where(ok)
    return out.drop("_hit")


def missing_keys(spine: DataFrame, df: DataFrame, key: str) -> DataFrame:
    return spine.join(df.select(key).distinct(), key, "left_anti")


def fill_spine(df: DataFrame, spine: DataFrame, keys: list[str], fill: int | float = 0) -> DataFrame:
    """Every spine row, measures missing in ``df`` filled."""
    measures = [c for c in df.columns if c not in keys]
    return spine.join(df, keys, "left").fillna(fill, subset=measures)


def share(df: DataFrame, value: str, by: list[str] | None = None, out: str = "share") -> DataFrame:
    """Value over its total, overall or within ``by``. For aggregated (small) inputs."""
    w = Window.partitionBy(*(by or [F.lit(0)]))
    return df.withColumn(out, F.col(value) / F.sum(value).over(w))


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """How often two assignments of the same rows agree, where both are known."""
    both = (F.coalesce(F.col(a), F.lit(0)) > 0) & (F.coalesce(F.col(b), F.lit(0)) > 0)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(both).alias("both_known"),
        F.count_if(both & (F.col(a) == F.col(b))).alias("same"),
    ).withColumn("agree_pct", F.col("same") / F.greatest("both_known", F.lit(1)) * 100)


def ranked(df: DataFrame, time: str, tie: str, out: str = "position", slots: int = 64) -> DataFrame:
    """Global 0-based position by (time in whole seconds, hash of the tie key, tie key) without
    sorting the table in one task.

    Counts are taken per (second, hash slot) and turned into offsets by three small running sums
    (days, seconds of a day, slots of a second); only rows of one slot of one second are numbered
    together. A second that holds a large share of the rows is spread over ``slots`` tasks.
    """
    from fareline.functions.geo import hash32

    h = hash32(F.col(tie).cast("string"))
    keyed = (
        df.withColumn("_h", h)
        .withColumn("_sec", F.unix_timestamp(time))
        .withColumn("_slot", F.floor(F.col("_h") / F.lit(4294967296.0 / slots)))
    )
    counts = keyed.groupBy("_sec", "_slot").agg(F.count("*").alias("_n")).withColumn("_day", F.floor(F.col("_sec") / 86400))
    before = (Window.unboundedPreceding, -1)

    def running(frame, part, order):
        w = Window.partitionBy(*part).orderBy(order).rowsBetween(*before)
        return frame.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))

    days = running(counts.groupBy("_day").agg(F.sum("_n").alias("_n")), [F.lit(0)], "_day").select("_day", F.col("_off").alias("_o1"))
    secs = running(counts.groupBy("_day", "_sec").agg(F.sum("_n").alias("_n")), ["_day"], "_sec").select("_sec", F.col("_off").alias("_o2"))
    slot = running(counts, ["_sec"], "_slot").select("_day", "_sec", "_slot", F.col("_off").alias("_o3"))
    offsets = (
        slot.join(secs, "_sec").join(days, "_day")
        .select("_sec", "_slot", (F.col("_o1") + F.col("_o2") + F.col("_o3")).alias("_base"))
    )
    w = Window.partitionBy("_sec", "_slot").orderBy("_h", tie)
    return (
        keyed.join(offsets, ["_sec", "_slot"])
        .withColumn(out, F.col("_base") + F.row_number().over(w) - 1)
        .drop("_h", "_sec", "_slot", "_base")
    )


def running_max_before(df: DataFrame, key: str, value: str, order: list[str], bucket: Column, out: str) -> DataFrame:
    """Maximum of ``value`` over all earlier rows of the key, as a two-level prefix scan.

    Rows are windowed within (key, bucket); the maxima of earlier buckets come from a small
    aggregate. A key owning much of the table is spread over its buckets.
    """
    keyed = df.withColumn("_b", bucket)
    before = (Window.unboundedPreceding, -1)
    carry = (
        keyed.groupBy(key, "_b").agg(F.max(value).alias("_m"))
        .withColumn("_carry", F.max("_m").over(Window.partitionBy(key).orderBy("_b").rowsBetween(*before)))
        .select(key, "_b", "_carry")
    )
    inner = F.max(value).over(Window.partitionBy(key, "_b").orderBy(*order).rowsBetween(*before))
    return (
        keyed.join(carry, [key, "_b"])
        .withColumn(out, F.greatest(inner, F.col("_carry")))
        .drop("_b", "_carry")
    )


def ordered_counts(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """(by..., value, n, before, total) per distinct value: its rows, the group's rows with smaller
    values, and all of the group's rows. Null values do not count.

    Equal values are one counted row before anything is shuffled by value, so a value that most rows
    have is no hot spot. The counts are range-partitioned and written with their partition's number;
    the partitions' totals, one row each, give the offsets that are joined back. No task sees more
    of a group than a partition's part of its distinct values."""
    from fareline.session import cut_lineage, small_side

    by = by or []
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    placed = cut_lineage(counts.repartitionByRange(*by, "value").withColumn("_part", F.spark_partition_id()), "ordered")
    parts = placed.groupBy(*by, "_part").agg(F.sum("n").alias("_n"))
    group = Window.partitionBy(*(by or [F.lit(0)]))
    off = F.coalesce(F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = cut_lineage(parts.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_part").alias("_at"), off.alias("_off"), F.sum("_n").over(group).alias("total")), "offsets")
    same = F.col("_part") == F.col("_at")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    inner = F.sum("n").over(Window.partitionBy(*by, "_part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("_in", F.coalesce(inner, F.lit(0))).join(small_side(offsets), same).select(*by, "value", "n", (F.col("_off") + F.col("_in")).alias("before"), "total")


def percentiles(df: DataFrame, value: str, points: list[float], by: list[str] | None = None) -> DataFrame:
    """Exact linear-interpolated percentiles, long form (by..., p, value), for any value domain: the
    counted values that hold the wanted ranks, from one scan and one distributed prefix sum."""
    by = by or []
    values = ordered_counts(df.select(*by, F.col(value).cast("double").alias("_v")), "_v", by)
    want = values.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in points]))).withColumn("_pos", F.col("p") * (F.col("total") - 1))
    holds = lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n"))
    at = lambda r: F.max(F.when(holds(r), F.col("value")))
    low, high = F.floor("_pos"), F.ceil("_pos")
    picked = want.where(holds(low) | holds(high)).groupBy(*by, "p", "_pos").agg(at(low).alias("_a"), at(high).alias("_z"))
    return picked.select(*by, "p", (F.col("_a") + (F.col("_z") - F.col("_a")) * (F.col("_pos") - F.floor("_pos"))).alias("value"))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, spread, extremes and quartiles per column, one row each."""
    rows = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_x")) for c in cols])))
    basic = rows.groupBy("column_name").agg(
        F.count("_x").alias("n"), F.avg("_x").alias("mean"), F.stddev_samp("_x").alias("std"), F.min("_x").alias("low"), F.max("_x").alias("high"))
    q = percentiles(rows, "_x", [0.25, 0.5, 0.75], ["column_name"])
    wide = q.groupBy("column_name").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(f"q{int(p * 100)}") for p in (0.25, 0.5, 0.75)])
    return basic.join(wide, "column_name")
