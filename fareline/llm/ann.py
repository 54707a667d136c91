"""Approximate nearest neighbours by largest inner product: a forest of long hash strings.

A tree's hash string has four digits of seven bits; a digit is the signed axis nearest to the
randomly rotated vector. Vectors get one more coordinate, so that the largest inner product is the
nearest direction whatever the lengths. A tree's rows of one first digit form a cell, kept as a
sorted array of strings and split into parts of bounded size. A query descends by binary search to
its longest prefixes; all trees then ascend together, digit by digit, until they hold enough
candidates. If even the first digits give too few, the query is compared with every row, in
blocks. Candidates are ranked on 8-bit codes; the best go to exact inner products. Trees are ranked in
a few steps: later trees give only what may still enter a query's best so far.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareline.llm.common import remove, store

TREES, DIGITS, AXES, BITS = 40, 4, 64, 7

#: Trees after which a query's best so far bounds what the next ones give.
STEPS = (2, 8, TREES)

#: Candidates, counted once per tree, at which the ascent stops.
ENOUGH = 8192

#: Rows and queries of a cell that one group holds; larger cells are split.
PART_ROWS, PART_QUERIES = 2048, 1024

#: Ranked by code beyond the number asked for, in a group and in all.
SLACK = 8


@lru_cache(maxsize=4)
def _axes(dim: int) -> np.ndarray:
    rng = np.random.default_rng(dim)
    return rng.standard_normal((dim + 1, TREES * DIGITS * AXES)).astype(np.float32)


def hash_strings(x: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """(rows, trees) hash strings as integers, first digit highest."""
    y = (np.c_[x, extra].astype(np.float32) @ _axes(x.shape[1])).reshape(len(x), TREES, DIGITS, AXES)
    top = np.abs(y).argmax(axis=3)
    digit = 2 * top + (np.take_along_axis(y, top[..., None], 3)[..., 0] > 0)
    out = np.zeros((len(x), TREES), np.int64)
    for j in range(DIGITS):
        out = (out << BITS) | digit[:, :, j]
    return out


def codes(x: np.ndarray) -> np.ndarray:
    """Unit-free 8-bit codes: four bytes of scale, then a signed byte per component."""
    scale = np.abs(x).max(axis=1, keepdims=True) / 127
    raw = np.rint(x / scale).astype(np.int8)
    return np.concatenate([scale.astype(np.float32).view(np.int8).reshape(len(x), 4), raw], axis=1)


def decode(raw: list[bytes]) -> np.ndarray:
    c = np.frombuffer(b"".join(raw), np.int8).reshape(len(raw), -1)
    return c[:, 4:].astype(np.float32) * np.ascontiguousarray(c[:, :4]).view(np.float32)


def ranges(strings: np.ndarray, queries: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the sorted strings that share the first `level` digits with each query."""
    shift = np.int64(BITS * (DIGITS - level))
    low = (queries >> shift) << shift
    return np.searchsorted(strings, low), np.searchsorted(strings, low + (np.int64(1) << shift))


def _forest(vectors: DataFrame, longest: float, query: bool) -> DataFrame:
    """Rows (rid, dim, tree, s, code) of every vector in every tree. A query's extra coordinate is 0."""

    def run(batches):
        for batch in batches:
            rid = batch.column("rid").to_numpy()
            flat = batch.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            dims = np.diff(batch.column("vec").offsets.to_numpy())
            starts = np.r_[0, np.cumsum(dims)][:-1]
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                for lo in range(0, len(at), 512):
                    own = at[lo : lo + 512]
                    x = flat[starts[own][:, None] + np.arange(dim)] / longest
                    extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
                    n = len(own) * TREES
                    code = codes(x).astype(np.int8)
                    code = pa.array([c.tobytes() for c in code], pa.binary()).take(pa.array(np.repeat(np.arange(len(own)), TREES)))
                    cols = [pa.array(np.repeat(rid[own], TREES)), pa.array(np.full(n, dim, np.int32)), pa.array(np.tile(np.arange(TREES, dtype=np.int32), len(own))), pa.array(hash_strings(x, extra).reshape(-1)), code]
                    yield pa.RecordBatch.from_arrays(cols, ["rid", "dim", "tree", "s", "code"])

    return vectors.select("rid", "vec").mapInArrow(run, "rid long, dim int, tree int, s long, code binary")


def _groups(batches, keys: list[str]):
    """Tables of equal keys from batches sorted by them; one group is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(c).to_numpy() for c in keys])
        cuts = [0, *(np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(k[:, a])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


KEYS = ["dim", "tree", "cell", "part", "qpart"]


def _meet(rows: DataFrame, asks: DataFrame, cells: DataFrame, fn, schema: str) -> DataFrame:
    """Bring a cell's rows (rid, dim, tree, cell, s[, code]) and queries together, part by part."""
    data = [c for c in ("s", "rid", "code") if c in rows.columns]
    extra = [c for c in ("level", "bound") if c in asks.columns]
    r = rows.join(F.broadcast(cells), ["dim", "tree", "cell"]).withColumn("part", F.pmod(F.xxhash64("rid"), F.col("parts"))).withColumn("qpart", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qparts") - 1)))
    q = asks.join(F.broadcast(cells), ["dim", "tree", "cell"]).withColumn("qpart", F.pmod(F.xxhash64("rid"), F.col("qparts"))).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    cols = lambda df, kind: df.select(*KEYS, F.lit(kind).alias("kind"), *data, *[F.col(c) if kind else F.lit(0).alias(c) for c in extra])
    both = cols(r, 0).union(cols(q, 1)).repartition(*KEYS).sortWithinPartitions(*KEYS, "kind", "s", "rid")

    def run(batches):
        for group in _groups(batches, KEYS):
            kind = group.column("kind").to_numpy()
            split = int(np.searchsorted(kind, 1))
            if 0 < split < len(kind):
                yield from fn(group.slice(0, split), group.slice(split))

    return both.mapInArrow(run, schema)


def _count(rows: pa.Table, asks: pa.Table):
    s, q = rows.column("s").to_numpy(), asks.column("s").to_numpy()
    n = []
    for level in range(1, DIGITS + 1):
        lo, hi = ranges(s, q, level)
        n.append(pa.array(hi - lo))
    yield pa.RecordBatch.from_arrays([asks.column("rid").combine_chunks(), *n], ["rid", *(f"n{i}" for i in range(1, DIGITS + 1))])


def _best(most: int):
    def fn(rows: pa.Table, asks: pa.Table):
        s, ids, c = rows.column("s").to_numpy(), rows.column("rid").to_numpy(), decode(rows.column("code").to_pylist())
        q, who, level = asks.column("s").to_numpy(), asks.column("rid").to_numpy(), asks.column("level").to_numpy()
        qc, bound = decode(asks.column("code").to_pylist()), asks.column("bound").to_numpy()
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(s), np.int64)
        for x in np.unique(level[level > 0]):
            own = level == x
            lo[own], hi[own] = ranges(s, q[own], int(x))
        span = lo * (len(s) + 1) + hi
        out = []
        for x in np.unique(span):
            own = np.flatnonzero(span == x)
            a, b = lo[own[0]], hi[own[0]]
            if a == b:
                continue
            for part in np.array_split(own, -(-len(own) // 256)):
                score = qc[part] @ c[a:b].T
                score[who[part][:, None] == ids[a:b]] = -np.inf
                k = min(most, b - a)
                top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                value = np.take_along_axis(score, top, 1)
                keep = np.isfinite(value) & (value >= bound[part][:, None])
                out.append((np.repeat(who[part], k)[keep.reshape(-1)], ids[a:b][top][keep], value[keep].astype(np.float64)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], ["rid", "cand", "near"])

    return fn


def _bounds(found: DataFrame, most: int) -> DataFrame:
    """(rid, bound): nearness of a query's `most`-th different candidate so far, where it has as many."""
    near = found.groupBy("rid", "cand").agg(F.max("near").alias("near"))
    r = F.row_number().over(Window.partitionBy("rid").orderBy(F.col("near").desc(), "cand"))
    return near.withColumn("r", r).where(F.col("r") <= most).where(F.col("r") == most).select("rid", F.col("near").alias("bound"))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of vectors that are not null, empty or zero and hold finite numbers only."""
    vec = F.col(vec_col).cast("array<double>")
    ok = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).where(F.coalesce((F.size("vec") > 0) & F.forall(vec, ok) & F.exists(vec, lambda v: v != 0), F.lit(False)))


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", enough: int = ENOUGH) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where `is_query` (a condition on `id`) holds, the
    k rows found with the largest inner product, ties to the smaller vec_id, then to the earlier row.

    A row is never its own neighbour; equal rows are each other's. Vectors are compared with those
    of their own dimension. Unusable vectors take no part, neither as query nor as candidate."""
    spark = vectors.sparkSession
    base, p_base = store(usable(vectors, id_col, vec_col).withColumn("rid", F.monotonically_increasing_id()), "op8-vectors")
    norm2 = F.aggregate(F.col("vec").cast("array<double>"), F.lit(0.0), lambda a, v: a + v * v)
    longest = float(base.agg(F.max(F.sqrt(norm2))).head()[0] or 1.0)
    forest, p_forest = store(_forest(base, longest, False), "op8-forest")
    asks, p_asks = store(_forest(base.where(is_query), longest, True), "op8-queries")
    cell = F.shiftright("s", BITS * (DIGITS - 1)).cast("int")
    forest, asks = forest.withColumn("cell", cell), asks.withColumn("cell", cell)
    count = lambda df, name: df.groupBy("dim", "tree", "cell").agg(F.count(F.lit(1)).alias(name))
    parts = lambda c, most: F.ceil(F.col(c) / most).alias(f"{c}arts")
    cells, p_cells = store(count(forest, "p").join(count(asks, "qp"), ["dim", "tree", "cell"]).select("dim", "tree", "cell", parts("p", PART_ROWS), parts("qp", PART_QUERIES)), "op8-cells")
    levels = [f"n{i}" for i in range(1, DIGITS + 1)]
    counted = _meet(forest.drop("code"), asks.drop("code"), cells, _count, "rid long, " + ", ".join(f"{n} long" for n in levels))
    sums = asks.select("rid").distinct().join(counted.groupBy("rid").agg(*[F.sum(n).alias(n) for n in levels]), "rid", "left")
    stop = F.coalesce(*[F.when(F.col(n) >= enough, F.lit(i)) for i, n in reversed(list(enumerate(levels, 1)))], F.lit(0))
    stops, p_stops = store(sums.select("rid", stop.alias("level")), "op8-levels")
    schema, most, p_found, found = "rid long, cand long, near double", k + SLACK, [], None
    climbing = stops.where("level > 0").withColumn("bound", F.lit(float("-inf")))
    for first, last in zip((0, *STEPS), STEPS):
        if found is not None:
            climbing = stops.where("level > 0").join(_bounds(found, most), "rid", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
        own = F.col("tree").between(first, last - 1)
        step, path = store(_meet(forest.where(own), asks.where(own).join(climbing, "rid"), cells, _best(most), schema), "op8-found")
        p_found.append(path)
        found = step if found is None else found.union(step)
    if not stops.where("level = 0").isEmpty():
        one = lambda df: df.where("tree = 0").withColumn("tree", F.lit(-1)).withColumn("cell", F.lit(0))
        rest, everything = one(asks).join(stops.where("level = 0").withColumn("bound", F.lit(float("-inf"))), "rid"), one(forest)
        table = count(everything, "p").join(count(rest, "qp"), ["dim", "tree", "cell"]).select("dim", "tree", "cell", parts("p", PART_ROWS), parts("qp", PART_QUERIES))
        found = found.union(_meet(everything, rest, table, _best(most), schema))
    near = found.withColumn("r", F.dense_rank().over(Window.partitionBy("rid").orderBy(F.col("near").desc(), "cand"))).where(F.col("r") <= 2 * most).select("rid", "cand").distinct()
    near, p_near = store(near, "op8-near")
    side = lambda key, name: base.select(F.col("rid").alias(key), F.col("id").alias(f"{name}_id"), F.col("vec").cast("array<double>").alias(f"{name}_v"))
    score = F.aggregate(F.zip_with("query_v", "vec_v", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    exact = near.join(side("cand", "vec"), "cand").join(side("rid", "query"), "rid").select("rid", "cand", "query_id", "vec_id", score.alias("score"))
    rank = F.row_number().over(Window.partitionBy("rid").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "cand"))
    out, _ = store(exact.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "op8-out")
    remove(spark, p_base, p_forest, p_asks, p_cells, p_stops, p_near, *p_found)
    return out
