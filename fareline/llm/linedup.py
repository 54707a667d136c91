"""Line dedup: repeated runs of lines, found on suffixes of the corpus' line-ID sequence.

The corpus is one sequence of line IDs, cut at document ends. Prefix doubling ranks suffixes by
their first 1, 2, 4, ... lines; suffixes of equal rank form an interval of the suffix array whose
longest common prefix has at least that many lines. A suffix whose rank no other shares is unique
and leaves, so the tables shrink to repeated text. Any length L is decided by two overlapping
ranks of the largest power of two within L.

A run counts if it has at least `min_words` words. For every line the shortest such run that
starts or ends there is looked up; the union of those with an earlier occurrence is exactly the
union of all maximal repeated runs, and is deleted. The first copy stays.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareline.llm.common import arrow_map, remove, store

MIN_WORDS = 50


def _line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """A row per non-blank line: hash, words, and the number of lines that reach `min_words`
    from here on (lf) or up to here (lb), 0 if the document has too few."""

    def run(batch):
        rid, did, line, h1, h2, wc, lf, lb = ([] for _ in range(8))
        for r, d, text in zip(batch.column("rid").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            own = [(i, s) for i, s in enumerate(map(str.strip, text.split("\n"))) if s] if text else []
            if not own:
                continue
            n = len(own)
            w = np.fromiter((len(s.split()) for _, s in own), np.int64, n)
            sums = np.r_[0, np.cumsum(w)]
            first = np.searchsorted(sums, sums[:-1] + min_words)
            last = np.searchsorted(sums, sums[1:] - min_words, side="right")
            at = np.arange(n)
            rid += [r] * n
            did += [d] * n
            line += [i for i, _ in own]
            wc.append(w)
            lf.append(np.where(first <= n, first - at, 0))
            lb.append(np.where(last > 0, at + 2 - last, 0))
            for _, s in own:
                h = xxhash.xxh3_128_digest(s.encode("utf-8", "surrogatepass"))
                h1.append(h[:8])
                h2.append(h[8:])
        whole = lambda x: pa.array(np.frombuffer(b"".join(x), np.int64))
        flat = lambda x: pa.array(np.concatenate([*x, np.empty(0, np.int64)]))
        return {"rid": pa.array(rid, pa.int64()), "doc_id": pa.array(did, pa.int64()), "line": pa.array(line, pa.int64()), "h1": whole(h1), "h2": whole(h2), "words": flat(wc), "lf": flat(lf), "lb": flat(lb)}

    return arrow_map(docs, run, "rid long, doc_id long, line long, h1 long, h2 long, words long, lf long, lb long")


def _ranked(rows: DataFrame, keys: list[str], label: str) -> tuple[DataFrame, str]:
    """Rows of keys that occur more than once, with the rank of the key in key order. Counting is
    combined before the shuffle; only the distinct keys are sorted."""
    keys_, p1 = store(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(*keys), label)
    ranks, p2 = store(keys_.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("rank", F.monotonically_increasing_id()), label)
    out, p3 = store(rows.join(ranks, keys).drop(*keys), label)
    remove(rows.sparkSession, p1, p2)
    return out, p3


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, keep_lines: bool = False) -> DataFrame:
    """(rid, doc_id, start_line, n_lines, n_words, keep_doc_id, keep_line): maximal runs of lines to
    delete, with the place of an earlier copy of the run's beginning. `docs` has rid (unique),
    doc_id and text; "earlier" is by doc_id, nulls last, then rid, then line.

    Lines are compared without outer white space; blank lines are skipped and never deleted. Null
    and empty texts have no lines. Of equal documents the first stays whole."""
    spark = docs.sparkSession
    rows, p_rows = store(_line_rows(docs.select("rid", F.col("doc_id").cast("long").alias("doc_id"), "text"), min_words), "op10-rows")
    order = [F.col("doc_id").asc_nulls_last(), "rid"]
    lines, p_lines = store(rows.repartitionByRange(*order).sortWithinPartitions(*order, "line").withColumn("p", F.monotonically_increasing_id()), "op10-lines")
    remove(spark, p_rows)
    level, p_level = _ranked(lines.select("rid", "p", "lf", "lb", "h1", "h2"), ["h1", "h2"], "op10-rank")
    size = lambda c: F.floor(F.log2(F.col(c).cast("double"))).cast("int")
    forth = level.where("lf > 0").select("rid", F.col("p").alias("start"), F.col("lf").alias("n"))
    back = level.where("lb > 0").select("rid", (F.col("p") - F.col("lb") + 1).alias("start"), F.col("lb").alias("n"))
    wanted, p_wanted = store(forth.union(back).distinct().withColumn("k", size("n")), "op10-windows")
    deepest = wanted.agg(F.max("k")).head()[0]
    level = level.select("rid", "p", "rank")
    levels, paths = [level.withColumn("k", F.lit(0))], [p_level]
    for k in range(deepest or 0):
        step = 1 << k
        ahead = level.select("rid", (F.col("p") - step).alias("p"), F.col("rank").alias("r2"))
        pairs, p_pairs = store(level.select("rid", "p", F.col("rank").alias("r1")).join(ahead, ["rid", "p"]), "op10-pairs")
        level, p_level = _ranked(pairs, ["r1", "r2"], "op10-rank")
        remove(spark, p_pairs)
        levels.append(level.select("rid", "p", "rank").withColumn("k", F.lit(k + 1)))
        paths.append(p_level)
    ranks = levels[0]
    for x in levels[1:]:
        ranks = ranks.unionByName(x)
    end = F.col("start") + F.col("n") - F.pow(F.lit(2.0), F.col("k")).cast("long")
    head = ranks.select("rid", "k", F.col("p").alias("start"), F.col("rank").alias("r1"))
    tail = ranks.select("rid", "k", F.col("p").alias("end"), F.col("rank").alias("r2"))
    known, p_known = store(wanted.withColumn("end", end).join(head, ["rid", "k", "start"]).join(tail, ["rid", "k", "end"]).select("rid", "start", "n", "r1", "r2"), "op10-known")
    firsts, p_firsts = store(known.groupBy("n", "r1", "r2").agg(F.count(F.lit(1)).alias("c"), F.min("start").alias("first")).where("c > 1").drop("c"), "op10-first")
    again = known.join(firsts, ["n", "r1", "r2"]).where("start > first")
    gone = again.select("rid", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("p"), (F.col("first") - F.col("start")).alias("shift"))
    gone, p_gone = store(gone.groupBy("rid", "p").agg(F.min("shift").alias("shift")), "op10-gone")
    marked, p_marked = store(gone.join(lines.select("rid", "p", "doc_id", "line", "words"), ["rid", "p"]), "op10-marked")
    remove(spark, p_wanted, p_known, p_firsts, p_gone, *paths)
    if keep_lines:
        return marked.select("rid", "line")
    own = Window.partitionBy("rid").orderBy("p")
    runs = marked.withColumn("run", F.col("p") - F.row_number().over(own)).groupBy("rid", "doc_id", "run").agg(
        F.min("line").alias("start_line"), F.count(F.lit(1)).alias("n_lines"), F.sum("words").alias("n_words"), F.min(F.struct("p", (F.col("p") + F.col("shift")).alias("src"))).alias("at")
    )
    place = lines.select(F.col("p").alias("src"), F.col("doc_id").alias("keep_doc_id"), F.col("line").alias("keep_line"))
    return runs.withColumn("src", F.col("at.src")).join(place, "src").select("rid", "doc_id", "start_line", "n_lines", "n_words", "keep_doc_id", "keep_line")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with later copies of repeated line runs cut out of `text`; other columns and
    rows stay. A document that consists of copies alone keeps an empty text."""
    rid = "__rid"
    stored, _ = store(docs.withColumn(rid, F.monotonically_increasing_id()), "op10-docs")
    cut = repeated_runs(stored.select(F.col(rid).alias("rid"), "doc_id", "text"), min_words, keep_lines=True)
    cut, _ = store(cut.groupBy("rid").agg(F.collect_set(F.col("line").cast("int")).alias("__cut")).withColumnRenamed("rid", rid), "op10-cut")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("__cut", i))
    out = stored.join(cut, rid, "left")
    return out.withColumn("text", F.when(F.col("__cut").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))).select(*docs.columns)
