"""Near-duplicate detection with HyperMinHash sketches.

A text's shingle set is cut into buckets; a bucket keeps only the leading-zero count and ten
mantissa bits of its smallest hash (16 bits). A small set would leave buckets empty, so its registers
are minima of the whole set under one hash function each; sets of middling size have both kinds, and
a pair uses the kind that fits its smaller set. Bands of compressed registers give candidate groups,
whose members meet the group's hub.

What a group's hub has not joined is compared member by member, in blocks of bounded size, by bits
that carry the parity of the elements in a slot. Two sets' bits differ in at most as many places as
the sets do, so this bound loses no pair: with t the threshold, x and y are linked exactly if they
differ in at most (1 - t) / (1 + t) (|x| + |y|) elements. Rows grow with the members of such groups;
only the comparisons of bits, a few words each, grow with the square of one.

A hub's pair goes on if the size bound and the collision-corrected estimate allow the threshold, a
pair of members if the bits do; then both full sets are compared exactly. Equal sets are one node from the start, whatever the
number of copies.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import WordHashes, arrow_map, ascii_words, components, free_shuffles, give_back, grams, mix64, remove, signed, store
from fareline.session import small_side

BANDS, ROWS = 42, 6
BUCKETS = BANDS * ROWS
MANTISSA_BITS = 10
_ORDER = np.random.default_rng(20240229).permutation(BUCKETS)

#: Sets of fewer shingles are sketched as wholes.
SMALL = 384
_SEEDS = np.random.default_rng(20240301).integers(1, 1 << 63, BUCKETS, dtype=np.uint64)

#: Members of a group that one task compares with as many others at a time.
BLOCK = 2048


def shingle_set(text: str | None, words: int, hashes: WordHashes | None = None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word runs; empty without words."""
    return np.unique(grams((WordHashes() if hashes is None else hashes).of(ascii_words(text)), words))


def _compressed(least: np.ndarray) -> np.ndarray:
    """16-bit registers of 56-bit minima: leading zeros (6 bits), then mantissa bits."""
    frac, exp = np.frexp(least.astype(np.float64))
    return np.where(frac > 0, (56 - exp) * 1024 + np.minimum(np.floor((frac - 0.5) * 2048), 1023), 57 * 1024).astype(np.uint16)


def registers(shingles: np.ndarray) -> np.ndarray:
    """One register per bucket of the set; an empty bucket borrows from the next filled one."""
    value = mix64(shingles ^ np.uint64(0xA0761D6478BD642F))
    bucket = (shingles >> np.uint64(20)) % np.uint64(BUCKETS)
    key = np.sort((bucket << np.uint64(56)) | (value >> np.uint64(8)))
    bucket = (key >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    exact = _compressed(key[first] & np.uint64((1 << 56) - 1))
    at = np.searchsorted(bucket[first], np.arange(BUCKETS))
    return exact[np.where(at == len(first), 0, at)]


def whole_registers(shingles: np.ndarray) -> np.ndarray:
    """One register per hash function, each the minimum over the whole set."""
    x = (shingles[None, :] ^ _SEEDS[:, None]) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return _compressed(x.min(axis=1) >> np.uint64(8))


def band_keys(regs: np.ndarray, kind: int = 0) -> np.ndarray:
    """(rows, bands) keys from (rows, buckets) registers; band number and kind are part of the key."""
    parts = regs[:, _ORDER].reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) + np.uint64(kind << 32), parts.shape[:2]) * np.uint64(0xD6E8FEB86659FD93)
    for j in range(ROWS):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j] + np.uint64(1))
    return acc


def expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Chance that registers of two unrelated buckets agree, from the set sizes: the sum over
    octaves of the density product, with cells 2^-mantissa of an octave wide."""
    n, m = np.maximum(n / BUCKETS, 1.0), np.maximum(m / BUCKETS, 1.0)
    s, total = n + m, 0.0
    for lz in range(57):
        lo, hi = 2.0 ** -(lz + 1), 2.0**-lz
        total = total + lo * (np.exp(-s * lo) - np.exp(-s * hi))
    return n * m / s * total * 2.0**-MANTISSA_BITS


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, whole: bool = False) -> np.ndarray:
    """Collision-corrected Jaccard similarity of register rows, bucketed or `whole`."""
    scale = BUCKETS if whole else 1
    same, chance = (a == b).mean(axis=1), expected_collisions(scale * n.astype(float), scale * m.astype(float))
    return np.clip((same - chance) / (1 - chance), 0, 1)


def margin(threshold: float, sigmas: float = 5.0) -> float:
    return sigmas * math.sqrt(threshold * (1 - threshold) / BUCKETS)


def sketches(docs: DataFrame, words: int, threshold: float = 0.8) -> DataFrame:
    """(doc_id, th, node, n, small, regs) per document; node null for an empty set. `th` is the text's
    hash, `node` the set's; `small` holds whole registers, `regs` bucketed ones, each null where the
    set's size rules it out."""
    least, most = SMALL, SMALL / threshold

    def run(batch, hashes):
        rows = {c: [] for c in ("node", "n", "small", "regs")}
        texts = batch.column("text")
        for i in range(batch.num_rows):
            if i % 256 == 0:
                hashes.trim()
            s = shingle_set(texts[i].as_py(), words, hashes)
            rows["n"].append(len(s))
            rows["node"].append(int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None)
            rows["small"].append(whole_registers(s).tobytes() if 0 < len(s) <= most else None)
            rows["regs"].append(registers(s).tobytes() if len(s) >= least else None)
        kinds = {"node": pa.int64(), "n": pa.int64(), "small": pa.binary(), "regs": pa.binary()}
        return {"doc_id": batch.column("doc_id"), "th": batch.column("th")} | {c: pa.array(rows[c], t) for c, t in kinds.items()}

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    return arrow_map(src, run, "doc_id long, th long, node long, n long, small binary, regs binary", WordHashes)


def parity_bits(shingles: np.ndarray) -> bytes:
    """Whether an odd number of the set's elements fall in a slot, for 4 to 8 slots an element."""
    slots = max(256, 1 << max(4 * len(shingles) - 1, 0).bit_length())
    odd = np.bincount((shingles & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Rows of parity bits with fewer slots: both halves taken together until `words` are left."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def within_reach(n: np.ndarray, comp: np.ndarray, bits: list[bytes], block: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of different components whose parity bits leave the threshold possible. With two
    blocks, only pairs across them."""
    plus, minus = 100 + round(100 * threshold), 100 - round(100 * threshold)
    width = np.fromiter(map(len, bits), np.int64, len(bits)) // 8
    first = block == block.min()
    one = bool(first.all())
    left, right = first, first if one else ~first
    rows, cols = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def meet(left: np.ndarray, right: np.ndarray, w: int) -> None:
        x, y = (folded_rows(at, w) for at in (left, right))
        coarse = [folded(v, max(4, w // 4)) for v in (x, y)]
        step = max(1, (1 << 19) // max(1, coarse[1].size))
        for lo in range(0, len(left), step):
            # Among one side's rows, those before have met these.
            i, past = left[lo : lo + step], lo if one else 0
            j = right[past:]
            far = np.bitwise_count(coarse[0][lo : lo + step, None] ^ coarse[1][None, past:]).sum(axis=2, dtype=np.int64)
            at, to = np.nonzero((comp[i][:, None] != comp[j][None]) & (plus * far <= minus * (n[i][:, None] + n[j][None])))
            for k in range(0, len(at), 1 << 12):
                p, q = at[k : k + (1 << 12)], to[k : k + (1 << 12)]
                far = np.bitwise_count(x[lo + p] ^ y[past + q]).sum(axis=1, dtype=np.int64)
                ok = plus * far <= minus * (n[i[p]] + n[j[q]])
                rows.append(i[p[ok]])
                cols.append(j[q[ok]])

    def folded_rows(at: np.ndarray, w: int) -> np.ndarray:
        out = np.empty((len(at), w), np.uint64)
        for wide in np.unique(width[at]):
            own = np.flatnonzero(width[at] == wide)
            out[own] = folded(np.frombuffer(b"".join([bits[k] for k in at[own]]), np.uint64).reshape(len(own), wide), w)
        return out

    # Sets that may be linked have as many slots, or one of them twice as many.
    for w in np.unique(width):
        here, there = (np.flatnonzero(side & (width == w)) for side in (left, right))
        wider, more = (np.flatnonzero(side & (width == 2 * w)) for side in (left, right))
        for i, j in ((here, np.r_[there, more]), *(() if one else ((wider, there),))):
            if len(i) and len(j):
                meet(i, j, int(w))
    return np.concatenate(rows), np.concatenate(cols)


def _bands(nodes: DataFrame) -> DataFrame:
    def run(batch):
        rows, keys = [], []
        for kind, c in enumerate(("small", "regs")):
            col = batch.column(c)
            own = np.flatnonzero(np.asarray(col.is_valid()))
            regs = np.frombuffer(b"".join(col.drop_null().to_pylist()), np.uint16).reshape(-1, BUCKETS)
            rows.append(np.repeat(own, BANDS))
            keys.append(np.ascontiguousarray(band_keys(regs, kind)).reshape(-1))
        rows = pa.array(np.concatenate(rows))
        return {"band": pa.array(signed(np.concatenate(keys))), "node": batch.column("node").take(rows), "n": batch.column("n").take(rows)}

    return arrow_map(nodes.select("node", "n", "small", "regs"), run, "band long, node long, n long")


def _likely(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) that the sketch estimate leaves possible."""
    least = threshold - margin(threshold)

    def run(batch):
        n, m = (batch.column(c).to_numpy() for c in ("na", "nb"))
        small = np.minimum(n, m) < SMALL
        keep = np.zeros(batch.num_rows, bool)
        for whole, kind in ((True, "s"), (False, "r")):
            own = np.flatnonzero(small == whole)
            a, b = (batch.column(f"{kind}{x}").take(pa.array(own)) for x in "ab")
            both = np.flatnonzero(np.asarray(a.is_valid()) & np.asarray(b.is_valid()))
            regs = [np.frombuffer(b"".join(x.take(pa.array(both)).to_pylist()), np.uint16).reshape(-1, BUCKETS) for x in (a, b)]
            keep[own[both]] = estimate(*regs, n[own[both]], m[own[both]], whole) >= least
        return {c: batch.column(c).filter(pa.array(keep)) for c in ("a", "b")}

    return arrow_map(_both(pairs, nodes, {"n": "n", "small": "s", "regs": "r"}), run, "a long, b long")


def _both(pairs: DataFrame, rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Pairs (a, b) with columns of the rows of both nodes. Few pairs go to the rows, each side by
    itself, and only what was found is shuffled; many are joined by node."""
    few = small_side(pairs)
    side = lambda x: rows.select(F.col("node").alias(x), *(F.col(c).alias(f"{k}{x}") for c, k in columns.items()))
    return side("a").join(few, "a").join(side("b").join(few, "b"), ["a", "b"])


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, bits, shingles) of the wanted nodes, each read from one document (th, did)."""

    def run(batch, hashes):
        sets, bits, texts = [], [], batch.column("text")
        for i in range(batch.num_rows):
            if i % 256 == 0:
                hashes.trim()
            s = shingle_set(texts[i].as_py(), words, hashes)
            sets.append(signed(s))
            bits.append(parity_bits(s))
        ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
        return {"node": batch.column("node"), "bits": pa.array(bits, pa.binary()), "shingles": pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*sets, np.empty(0, np.int64)])))}

    did = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 62)))
    src = docs.select(F.xxhash64("text").alias("th"), did.alias("did"), "text").join(small_side(wanted), ["th", "did"])
    return arrow_map(src.select("node", "text"), run, "node long, bits binary, shingles array<bigint>", WordHashes).dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return _both(pairs, sets, {"shingles": "s"}).where(100 * both >= round(100 * threshold) * union).select("a", "b")


def _fits(x, y, threshold: float):
    return 100 * F.least(x, y) >= round(100 * threshold) * F.greatest(x, y)


def _met_in_blocks(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of members (band, node, n, comp, c) of the same band but of different components
    that parity bits leave possible. A band of more than BLOCK members is dealt into blocks, and a
    block meets every block once."""
    names = ("at", "block", "node", "n", "comp", "bits")

    def run(batches):
        held = []

        def pairs(rows: pa.Table) -> pa.RecordBatch:
            at, block, node, n, comp = (rows.column(c).to_numpy() for c in names[:5])
            bits = rows.column("bits").to_pylist()
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            edge = np.r_[0, np.flatnonzero(at[1:] != at[:-1]) + 1, len(at)]
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
                i, j = within_reach(n[lo:hi], comp[lo:hi], bits[lo:hi], block[lo:hi], threshold)
                a.append(node[lo + i])
                b.append(node[lo + j])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b)], ["a", "b"])

        for batch in batches:
            # Rows come sorted; those of the last key may go on in the next batch.
            keys = batch.column("at").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if cut or held and keys[0] != held[0].column("at")[-1].as_py():
                yield pairs(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            if len(keys):
                held.append(batch.slice(cut))
        if held:
            yield pairs(pa.Table.from_batches(held))
        del held
        give_back()

    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = other.withColumn("at", F.xxhash64("band", F.least("block", "other"), F.greatest("block", "other")))
    rows = keyed.select("at", "block", "node", "n", "comp").join(small_side(sets.select("node", "bits")), "node")
    return rows.select(*names).repartition("at").sortWithinPartitions("at").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, node_component, th) per document.

    Two documents are linked if the Jaccard similarity of their word-run sets is at least
    `threshold` (in hundredths); component_id is the smallest doc_id of the component. A null or
    wordless text has an empty set and no link. A null doc_id takes part; a component of only
    null ids has a null component_id and counts as kept. Repeated rows are one node."""
    spark = docs.sparkSession
    all_rows, _ = store(sketches(docs, words, threshold), "op1-sketches")
    did = F.coalesce("doc_id", F.lit(-(1 << 62)))
    nodes, p_nodes = store(
        all_rows.where("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("small").alias("small"), F.first("regs").alias("regs"), F.min("doc_id").alias("first_id"), F.min(F.struct("th", did.alias("did"))).alias("src")),
        "op1-nodes",
    )
    keyed, p_keyed = store(_bands(nodes), "op1-bands")
    hubs = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("node", "n")).alias("h")).where("c > 1")
    groups, p_groups = store(keyed.join(hubs.select("band", "c", F.col("h.node").alias("hub"), F.col("h.n").alias("hub_n")), "band"), "op1-members")
    remove(spark, p_keyed)
    wanted, p_wanted = store(nodes.join(groups.select("node").distinct(), "node", "left_semi").select("node", "src.th", "src.did"), "op1-wanted")
    sets, p_sets = store(_sets(docs, wanted, words), "op1-sets")
    old = [p_groups, p_wanted, p_sets]

    def links(pairs: DataFrame, sketched: bool) -> DataFrame:
        pairs, p1 = store(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "op1-pairs")
        if sketched:
            pairs, p2 = store(_likely(pairs, nodes, threshold), "op1-likely")
            old.append(p2)
        found, p3 = store(_confirmed(pairs, sets, threshold), "op1-links")
        old.extend((p1, p3))
        return found

    by_hub = links(groups.where(_fits(F.col("n"), F.col("hub_n"), threshold)).select(F.col("node").alias("a"), F.col("hub").alias("b")), True)
    linked = components(by_hub).select("node", F.col("comp").alias("to"))
    labels, p_labels = store(nodes.select("node").join(linked, "node", "left").select("node", F.coalesce("to", "node").alias("comp")), "op1-labels")
    old.append(p_labels)
    free_shuffles(spark)
    # Groups of two are done; so are those that the hub has joined.
    several = groups.where("c > 2").select("band", "node", "n", "c").join(labels, "node")
    undone = several.groupBy("band").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1")
    found = links(_met_in_blocks(several.join(undone, "band", "left_semi"), sets, threshold), False)
    # Links between members join components of hubs' links.
    side = lambda x: labels.select(F.col("node").alias(x), F.col("comp").alias(f"c{x}"))
    across = side("b").join(small_side(side("a").join(small_side(found), "a")), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = components(across).select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    labels = labels.join(small_side(joined), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    comp_of = nodes.select("node", "first_id").join(labels, "node")
    lowest = comp_of.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    ids, _ = store(comp_of.join(lowest, "comp").select("node", "comp", "component_id"), "op1-ids")
    remove(spark, p_nodes, *old)
    out = all_rows.select("doc_id", "th", "n", "node").join(ids, "node", "left")
    cid = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), cid.alias("component_id"), F.col("doc_id").eqNullSafe(cid).alias("kept"), F.col("comp").alias("node_component"), "th")


def drop_near_duplicates(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents with one row of each component; texts without words stay as they are."""
    spark = docs.sparkSession
    found = near_duplicates(docs, words, threshold)
    losers = found.where("node_component is not null").groupBy("node_component").agg(F.min(F.when(F.col("kept"), F.struct(F.col("doc_id"), F.col("th")))).alias("keep"))
    marks, _ = store(losers.select("keep.th", F.col("keep.doc_id").alias("keep_id")), "op1-keep")
    loose = docs.withColumn("__th", F.xxhash64("text")).withColumn("__did", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 62))))
    marks = marks.select(F.col("th").alias("__th"), F.coalesce("keep_id", F.lit(-(1 << 62))).alias("__did"))
    kept = loose.join(marks, ["__th", "__did"]).dropDuplicates(["__th", "__did"])
    wordless = loose.where(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return kept.select(*docs.columns).union(wordless.select(*docs.columns))
