"""Vector codes: a codebook per part of the vector, nearest entries found in a near-neighbour tree.

The tree (GNAT) of a codebook takes a few far-apart entries as split points, gives every other
entry to its nearest split point and stores, for each split point and each child, the least and
the largest distance between them. A query measures its distances to the split points; a child whose range from some split
point lies strictly beyond the best distance so far goes as a whole. Roots are rounded down on
one side and up on the other, and what remains is compared as integers, ties to the lower index,
so the result is that of comparing everything.

Queries run in blocks: one descent serves all rows of an Arrow batch. Numbers are exact integers
held as doubles while they are far below 2**53, else as Python integers.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import store
from fareline.session import small_side

PARTS, ENTRIES, ROUNDS = 16, 64, 2

#: Split points of a node, entries of a leaf, rows searched at once.
DEGREE, LEAF, BLOCK_ROWS = 8, 12, 4096

#: Sums travel as limbs of so many bits, so that they add up exactly whatever their size.
_LIMB = 40
_FAR = 1 << 63


def _roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the square roots."""
    if squares.dtype == object:
        down = np.frompyfunc(math.isqrt, 1, 1)(squares)
        return down, down + 1
    root = np.sqrt(squares)
    return root * (1 - 2.0**-50), root * (1 + 2.0**-50)


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(rows, entries) squared distances."""
    out = 0
    for k in range(x.shape[1]):
        d = x[:, k, None] - y[None, :, k]
        out = out + d * d
    return out


class Gnat:
    """Nearest entry of one codebook, by exact squared distance and then index."""

    def __init__(self, entries: np.ndarray, which: np.ndarray | None = None):
        self.entries = entries
        which = np.arange(len(entries)) if which is None else which
        if len(which) <= LEAF:
            self.splits, self.children = which, []
            return
        chosen = [0]
        near = _squares(entries[which], entries[which[:1]])[:, 0]
        while len(chosen) < DEGREE:
            near[chosen] = -1
            chosen.append(int(np.argmax(near)))
            near = np.minimum(near, _squares(entries[which], entries[which[chosen[-1:]]])[:, 0])
        self.splits = which[np.sort(chosen)]
        rest = np.setdiff1d(which, self.splits)
        far = _squares(entries[rest], entries[self.splits])
        owner = np.array([int(np.argmin(r)) for r in far])
        used = np.unique(owner)
        self.children = [Gnat(entries, rest[owner == j]) for j in used]
        down, up = _roots(far)
        #: (split, child): least distance rounded down, largest rounded up.
        self.least = np.stack([down[owner == j].min(axis=0) for j in used], axis=1)
        self.most = np.stack([up[owner == j].max(axis=0) for j in used], axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance for each row of x."""
        best, at = np.full(len(x), -1, x.dtype), np.full(len(x), -1, np.int64)
        self._search(x, np.arange(len(x)), best, at)
        return at, best

    def _search(self, x: np.ndarray, rows: np.ndarray, best: np.ndarray, at: np.ndarray) -> None:
        squares = _squares(x[rows], self.entries[self.splits])
        k = np.array([int(np.argmin(r)) for r in squares], np.int64) if squares.dtype == object else squares.argmin(axis=1)
        got, index = squares[np.arange(len(rows)), k], self.splits[k]
        better = (at[rows] < 0) | (got < best[rows]) | ((got == best[rows]) & (index < at[rows]))
        best[rows[better]], at[rows[better]] = got[better], index[better]
        if not self.children:
            return
        down, up = _roots(squares)
        for j, child in enumerate(self.children):
            beyond = np.maximum(down - self.most[:, j], self.least[:, j] - up).max(axis=1)
            left = beyond <= _roots(best[rows])[1]
            if left.any():
                child._search(x, rows[left], best, at)


def integers(flat: np.ndarray) -> np.ndarray:
    """floor(256 x), exactly."""
    if not len(flat) or np.abs(flat).max() < 2.0**18:
        return np.floor(256 * flat)
    return np.array([int(v) * 256 if abs(v) >= 2.0**53 else math.floor(256 * v) for v in flat.tolist()], object)


class Codebooks:
    """Codebooks (parts, entries, width) of exact integers, as numbers of a width-padded vector."""

    def __init__(self, books: np.ndarray, dim: int):
        self.books, self.dim = books, dim
        self.trees: dict = {}

    @property
    def width(self) -> int:
        return self.books.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for v in self.books.ravel()).encode()).hexdigest()

    def __getstate__(self):
        return {"books": self.books, "dim": self.dim, "trees": {}}

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, parts) nearest entries and their squared distances; x is (rows, parts, width)."""
        at = np.zeros(x.shape[:2], np.int64)
        exact = self._fits(x) and self._fits(self.books)
        far = np.zeros(x.shape[:2], np.float64 if exact else object)
        kind = np.float64 if exact else object
        x = x.astype(kind) if exact else _python(x)
        for p in range(x.shape[1]):
            tree = self.trees.get((p, exact))
            if tree is None:
                tree = self.trees[p, exact] = Gnat(self.books[p].astype(kind) if exact else _python(self.books[p]))
            for lo in range(0, len(x), BLOCK_ROWS):
                at[lo : lo + BLOCK_ROWS, p], far[lo : lo + BLOCK_ROWS, p] = tree.nearest(x[lo : lo + BLOCK_ROWS, p])
        return at, far

    def _fits(self, x: np.ndarray) -> bool:
        most = int(max(np.abs(x).max(), 1)) if x.size else 1
        return 4 * self.width * x.shape[-2] * most * most < 1 << 52

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """Integer vectors of (rows, parts) codes."""
        return self.books[np.arange(self.books.shape[0]), codes].reshape(len(codes), -1)[:, : self.dim]


def _python(x: np.ndarray) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(x) if x.size else x.astype(object)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows whose vector is neither null nor empty and holds only
    finite components. Without a column `label` it is null."""
    e = F.col("embedding").cast("array<double>")
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int").alias("label")
    good = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label, e.alias("embedding")).where((F.size("embedding") > 0) & good)


def _blocks(batch: pa.RecordBatch, dim: int, parts: int):
    """(rows, parts, width) integers of a batch's vectors."""
    col = batch.column("embedding")
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = -(-dim // parts)
    x = integers(flat).reshape(batch.num_rows, dim)
    if parts * width > dim:
        x = np.concatenate([x, np.zeros((len(x), parts * width - dim), x.dtype)], axis=1)
    return x.reshape(len(x), parts, width)


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of `vectors` (vec_id, embedding), from all rows.

    They start as the vectors of the smallest ids (nulls last, equal ids by vector; fewer rows give
    fewer entries); a round gives every part to its nearest entry and puts the floor of the mean in
    its place. Only rows with as many components as the first take part; a length that is no
    multiple of `parts` is filled up with zeros. None without usable rows. To the driver come
    entries x components numbers, as the codebook has them."""
    good = usable(vectors)
    first = good.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries).collect()
    if not first:
        return None
    dim = len(first[0].embedding)
    first = [r.embedding for r in first if len(r.embedding) == dim]
    if len(first) < entries:
        first = [r.embedding for r in good.where(F.size("embedding") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries).collect()]
    rows = pa.RecordBatch.from_arrays([pa.array(first, pa.list_(pa.float64()))], ["embedding"])
    books = Codebooks(np.ascontiguousarray(np.transpose(_blocks(rows, dim, parts), (1, 0, 2))), dim)
    same = good.where(F.size("embedding") == dim).select("embedding")
    for _ in range(rounds):
        books = Codebooks(_updated(books, _sums(same, books)), dim)
    return books


def _sums(vectors: DataFrame, books: Codebooks) -> list:
    """(part, entry, position, limb, value) totals; position -1 counts the entry's parts."""
    parts, entries, width = books.books.shape

    def run(batches):
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _blocks(batch, books.dim, parts)
            at, _ = books.assign(x)
            for p in range(parts):
                counts[p] += np.bincount(at[:, p], minlength=entries)
                for k in range(width):
                    if x.dtype == object:
                        np.add.at(sums[p, :, k], at[:, p], x[:, p, k])
                    else:
                        sums[p, :, k] += _python(np.bincount(at[:, p], weights=x[:, p, k], minlength=entries))
        out = []
        for p, e in zip(*(i.tolist() for i in np.nonzero(counts))):
            out.append((p, e, -1, 0, int(counts[p, e])))
            for k in range(width):
                v, limb = sums[p, e, k], 0
                while abs(v) >> _LIMB:
                    out.append((p, e, k, limb, v & (1 << _LIMB) - 1))
                    v, limb = v >> _LIMB, limb + 1
                    if v == -1:
                        break
                out.append((p, e, k, limb, v))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["part", "entry", "position", "limb", "value"])

    each = vectors.mapInArrow(run, "part long, entry long, position long, limb long, value long")
    return each.groupBy("part", "entry", "position", "limb").agg(F.sum("value").alias("value")).collect()


def _updated(books: Codebooks, totals: list) -> np.ndarray:
    counts, sums = {}, {}
    for r in totals:
        if r.position < 0:
            counts[r.part, r.entry] = r.value
        else:
            k = (r.part, r.entry, r.position)
            sums[k] = sums.get(k, 0) + (r.value << _LIMB * r.limb)
    out = _python(books.books)
    for (p, e, k), total in sums.items():
        out[p, e, k] = total // counts[p, e]
    return out if max(abs(int(v)) for v in out.ravel()) >= 1 << 52 else out.astype(np.float64)


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error) per usable row: the nearest entries' indexes in hex, two digits a
    part, and the squared distances' sum (null beyond 2**63 - 1). Repeated rows give repeated rows,
    a null vec_id or label stays, other columns are ignored."""
    parts = books.books.shape[0]
    good = usable(vectors).where(F.size("embedding") == books.dim)
    kind = good.schema["label"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            at, far = books.assign(_blocks(batch, books.dim, parts))
            codes = [r.tobytes().hex() for r in at.astype(np.uint8)]
            error = [int(v) for v in far.sum(axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(codes, pa.string()), pa.array([v if v < _FAR else None for v in error], pa.int64())], ["vec_id", "label", "code", "error"])

    return good.mapInArrow(run, f"vec_id long, label {kind}, code string, error long")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per usable row of `vectors` (vec_id,
    embedding, label). label_error is the errors' sum over rows of an equal label, nulls together
    (null if it, or one of them, is beyond 2**63 - 1). An empty table gives an empty one."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part")
    books = fit(vectors, parts, entries, rounds)
    if books is None:
        return usable(vectors).select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded, _ = store(encode(vectors, books), "op13-codes")
    total = F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(20,0)")))
    sums, _ = store(coded.groupBy(F.col("label").alias("_label")).agg(total.try_cast("long").alias("label_error")), "op13-labels")
    joined = coded.join(small_side(sums), F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
