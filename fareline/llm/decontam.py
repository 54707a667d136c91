"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

One pass over the documents looks every word run up in a bit set of the benchmark's runs (fixed
size, whatever the benchmark's) and keeps, around the hits, passages long enough for any
alignment through a hit. Corpus counts of the hits tell which runs are rare; passages meet items
only through rare ones. The local alignment of item and passage, on words, gives the score.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareline.llm.common import WordHashes, arrow_map, grams, plain_words, remove, signed, store

SEED_WORDS = 3
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1

#: A seed is rare if at most this share of the documents has it (or 16 of them). The rarer half of
#: an item's seeds is used however common they are, so a passage that floods the corpus is found.
RARE_SHARE = 0.0005

#: 2^22 bits, half a megabyte: the only thing sent to all tasks.
FILTER_BITS = 22


def _slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64), ((h >> np.uint64(20)) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences, and the passage position after its end."""
    gaps = np.arange(len(passage) + 1, dtype=np.int64) * -GAP
    row, best, at = np.zeros(len(passage) + 1, np.int64), 0, 0
    for w in item:
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(passage == w, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + gaps) - gaps
        top = int(row.argmax())
        if row[top] > best:
            best, at = int(row[top]), top
    return best, at


def _seed_rows(items: DataFrame, n: int) -> DataFrame:
    def run(batch, hashes):
        item, h = [], []
        for i, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            g = np.unique(grams(hashes.of(plain_words(text)), n))
            item += [i] * len(g)
            h.append(signed(g))
        return {"key": pa.array(item, pa.int64()), "h": pa.array(np.concatenate([*h, np.empty(0, np.int64)]))}

    return arrow_map(items.select("key", "text"), run, "key long, h long", WordHashes)


def _filter_bits(seeds: DataFrame) -> bytes:
    """The bit set, built on the executors and combined by slot."""
    slot = lambda shift: F.shiftrightunsigned("h", shift).bitwiseAND((1 << FILTER_BITS) - 1)
    both = seeds.select(slot(64 - FILTER_BITS).alias("s")).union(seeds.select(slot(20)))
    word = both.select(F.shiftright("s", 5).alias("w"), F.col("s").bitwiseAND(31).cast("int").alias("b"))
    packed = word.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[packed["w"].to_numpy(np.int64)] = packed["bits"].to_numpy(np.int64).astype(np.uint32)
    return out.tobytes()


def _passages(docs: DataFrame, bits: bytes, reach: int, lengths: list[int]) -> DataFrame:
    """(doc_id, th, pid, at, text, hits): passages around hits. at: first word's position."""

    def run(batch, hashes):
        table = np.frombuffer(bits, np.uint32)
        has = lambda s: (table[s >> 5] >> (s & 31).astype(np.uint32)) & np.uint32(1)
        hashes.trim()
        out = {c: [] for c in ("row", "pid", "at", "text", "hits")}
        for row, text in enumerate(batch.column("text").to_pylist()):
            words = plain_words(text)
            if not words:
                continue
            h = hashes.of(words)
            found = []
            for n in lengths:
                if len(h) < n:
                    continue
                g = grams(h, n)
                s1, s2 = _slots(g)
                at = np.flatnonzero(has(s1))
                at = at[has(s2[at]) > 0]
                found.append((at, g[at]))
            at = np.concatenate([a for a, _ in found]) if found else np.empty(0, np.int64)
            if not len(at):
                continue
            hits, order = np.concatenate([x for _, x in found]), np.argsort(at, kind="stable")
            at, hits = at[order], hits[order]
            for pid, part in enumerate(np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > 2 * reach) + 1)):
                lo, hi = max(0, int(at[part[0]]) - reach), int(at[part[-1]]) + reach
                out["row"].append(row)
                out["pid"].append(pid)
                out["at"].append(lo)
                out["text"].append(b" ".join(words[lo:hi]))
                out["hits"].append(signed(np.unique(hits[part])))
        rows = pa.array(out["row"], pa.int64())
        ends = np.cumsum([0, *map(len, out["hits"])]).astype(np.int32)
        return {
            "doc_id": batch.column("doc_id").take(rows), "th": batch.column("th").take(rows), "pid": pa.array(out["pid"], pa.int32()), "at": pa.array(out["at"], pa.int64()),
            "text": pa.array(out["text"], pa.binary()), "hits": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*out["hits"], np.empty(0, np.int64)]))),
        }

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    return arrow_map(src, run, "doc_id long, th long, pid int, at long, text binary, hits array<bigint>", WordHashes)


def _scores(pairs: DataFrame) -> DataFrame:
    def run(batch, hashes):
        hashes.trim()
        score, end, start = [], [], []
        for p, t, at in zip(batch.column("text").to_pylist(), batch.column("item").to_pylist(), batch.column("at").to_pylist()):
            passage, item = hashes.of(p.split()), hashes.of(plain_words(t))
            best, stop = align(item, passage)
            score.append(best / (MATCH * len(item)))
            end.append(at + stop)
            start.append(at + stop - align(item[::-1], passage[:stop][::-1])[1] if best else at)
        cols = {c: batch.column(c) for c in ("doc_id", "th", "key")}
        return cols | {"score": pa.array(score, pa.float64()), "start_word": pa.array(start, pa.int64()), "end_word": pa.array(end, pa.int64())}

    return arrow_map(pairs.select("doc_id", "th", "key", "text", "item", "at"), run, "doc_id long, th long, key long, score double, start_word long, end_word long", WordHashes)


def contaminated(docs: DataFrame, items: DataFrame, n: int = SEED_WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word, th): documents that hold a copy of an item.

    score is the best alignment's score over that of a perfect copy; pairs of at least `threshold`
    are returned, once per document text. Words are lower-cased runs without ASCII punctuation;
    positions count them. Items of fewer than n words are their own only seed. Null or wordless
    texts and items give nothing; a null doc_id or item_id is carried as null."""
    spark = docs.sparkSession
    named, p_items = store(items.select(F.col("item_id").cast("long").alias("item_id"), "text", F.monotonically_increasing_id().alias("key")).where("text is not null"), "op2-items")
    seeds, p_seeds = store(_seed_rows(named, n), "op2-seeds")
    sizes = arrow_map(named.select("text"), lambda b: {"n": pa.array([len(plain_words(t)) for t in b.column("text").to_pylist()], pa.int64())}, "n long").where("n > 0")
    reach, lengths = sizes.agg(F.max("n"), F.collect_set(F.least("n", F.lit(n)))).head()
    hits, p_hits = store(_passages(docs, _filter_bits(seeds), (reach or 0) + n, sorted(lengths)), "op2-passages")
    each = hits.select("doc_id", "th", "pid", F.explode("hits").alias("h"))
    counts, p_counts = store(each.groupBy("h").agg(F.count(F.lit(1)).alias("df")), "op2-counts")
    rare = max(16, math.ceil(RARE_SHARE * docs.count()))
    w = Window.partitionBy("key")
    used = seeds.join(counts, "h").withColumn("r", F.row_number().over(w.orderBy("df", "h"))).withColumn("m", F.count(F.lit(1)).over(w))
    used, p_used = store(used.where((F.col("df") <= rare) | (2 * F.col("r") <= F.col("m") + 1)).select("h", "key"), "op2-used")
    found, p_found = store(each.join(used, "h").select("doc_id", "th", "pid", "key").distinct(), "op2-candidates")
    same = (F.col("x.th") == F.col("y.th")) & F.col("x.doc_id").eqNullSafe(F.col("y.doc_id")) & (F.col("x.pid") == F.col("y.pid"))
    pairs = found.alias("x").join(hits.dropDuplicates(["doc_id", "th", "pid"]).alias("y"), same).select("x.*", "y.text", "y.at")
    pairs = pairs.join(named.select("key", F.col("text").alias("item")), "key")
    best = _scores(pairs).where(F.col("score") >= threshold).groupBy("doc_id", "th", "key").agg(F.max(F.struct("score", F.col("start_word").alias("s"), F.col("end_word").alias("e"))).alias("b"))
    out, _ = store(best.join(named.select("key", "item_id"), "key").select("doc_id", "item_id", F.col("b.score").alias("score"), F.col("b.s").alias("start_word"), F.col("b.e").alias("end_word"), "th"), "op2-out")
    remove(spark, p_items, p_seeds, p_hits, p_counts, p_used, p_found)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, n: int = SEED_WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those that hold a copy of an item."""
    bad, _ = store(contaminated(docs, items, n, threshold).select(F.col("th").alias("__th")).distinct(), "op2-bad")
    return docs.withColumn("__th", F.xxhash64("text")).join(bad, "__th", "left_anti").select(*docs.columns)
