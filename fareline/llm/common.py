"""Shared helpers of the training-data operators: word hashing, stored steps, components."""

import ctypes
import gc
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.session import scratch, small_side

_MUL = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a step to the shared folder and read it back; the path allows removing it later."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete stored steps that no later plan reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of steps that are written: Spark deletes them when the driver
    collects its garbage, which a busy job with a large heap may put off for long."""
    gc.collect()
    spark._jvm.System.gc()


class WordHashes(dict):
    """64-bit hash of a word's bytes, remembered by one task. `trim` keeps the memory bounded."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def trim(self, most: int = 1 << 17) -> None:
        if len(self) > most:
            self.clear()

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ascii_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased; other letters as they are."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation separates words."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of every run of n words, in order; a shorter text is one run."""
    m = min(n, len(hashes))
    if not m:
        return np.empty(0, np.uint64)
    acc = np.full(len(hashes) - m + 1, m, np.uint64)
    for j in range(m):
        acc = acc * _MUL + hashes[j : j + len(acc)]
        acc ^= acc >> np.uint64(29)
    return mix64(acc)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def give_back() -> None:
    """Return what a finished task has freed to the system: Spark keeps its Python workers."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, fn, schema: str, state=None) -> DataFrame:
    """mapInArrow for a function from one record batch to a dict of columns (or None). With `state`,
    a task makes one by state() and gives it to the function; it ends with the task."""
    names = [p.split()[0] for p in re.split(r",(?![^<]*>)", schema.replace(", ", ","))]

    def run(batches):
        own = (state(),) if state else ()
        for batch in batches:
            cols = fn(batch, *own)
            if cols is not None:
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in (cols[n] for n in names)], names)
            del batch, cols
        del own
        give_back()

    return df.mapInArrow(run, schema)


def count_and_check(df: DataFrame, *cols: str) -> tuple[int, int]:
    """Row count and an order-free checksum, to see whether a step still changes."""
    r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*cols).bitwiseAND(0xFFFFFFFF))).head()
    return int(r[0]), int(r[1] or 0)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, comp): smallest node reachable, for every node of an edge table (a, b).

    A round links every node with the least node among its neighbours and itself, and all its
    neighbours with that node too, instead of with each other. Neighbours are never gathered. The
    rounds are written to the shared folder, the one before is removed. When all edges lead to a
    least node of its own, nothing changes any more: each node's edge then names its component."""
    spark = edges.sparkSession
    cur, path = store(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    seen = count_and_check(cur, "u", "v")
    while seen[0]:
        both = cur.union(cur.select("v", "u"))
        low = both.groupBy(F.col("u").alias("k")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        ends = F.explode(F.array("u", "v")).alias("w")
        star = both.join(small_side(low), F.col("u") == F.col("k")).select(ends, "m").where("w <> m")
        new, p = store(star.select(F.greatest("w", "m").alias("u"), F.least("w", "m").alias("v")).distinct(), label)
        remove(spark, path)
        cur, path, now = new, p, count_and_check(new, "u", "v")
        if now == seen:
            break
        seen = now
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(roots)
