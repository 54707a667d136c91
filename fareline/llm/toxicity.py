"""Toxicity: bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is a learned vector of the (hashed) word and the mean of learned vectors of its
(hashed) character n-grams. Windows of words overlap by a third; in a window both directions' states
are pooled by attention into one logit. A document's score is that of its most toxic window. In
training a document is toxic if any window is (noisy or), so labels of whole documents suffice.
Gates are piecewise linear and the other activations x / (1 + |x|): numpy evaluates them several
times faster than exponentials, and every word passes four steps.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import arrow_map, give_back, plain_words

WINDOW, STRIDE = 24, 16
WORD_SLOTS = CHAR_SLOTS = 1 << 16
WORD_DIM, CHAR_DIM, HIDDEN = 8, 16, 8
THRESHOLD = 0.3

#: The fit uses at most so many labelled documents of each label, in hash order, and of those
#: documents of at most this many words: a bounded sample, whatever the table's size.
SAMPLE_DOCS, SAMPLE_WORDS = 1000, 1000
STEPS, BATCH_DOCS, RATE = 300, 16, 3e-3

#: The first coordinate of a word's and a run's vector is fixed: how far its share of toxic sample
#: documents is from the whole sample's, in standard deviations. The others are learned.
#: Words and runs found in fewer sample documents get no vector of their own: they would only name
#: the documents they are in.
LEAST_DOCS = 5


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def gate(x: np.ndarray) -> np.ndarray:
    x = x * np.float32(0.2)
    x += np.float32(0.5)
    np.maximum(x, 0, out=x)
    return np.minimum(x, 1, out=x)


def soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def scatter(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of value rows by target row."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    order = np.argsort(rows, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(rows[order]) != 0])
    out[rows[order[starts]]] = np.add.reduceat(values[order], starts, axis=0)
    return out


def char_slots(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the words' 3- to 5-byte runs, with edges marked, and the number of each word's slots."""
    raw = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    end = np.repeat(np.cumsum(size), size)
    slot, start = [], []
    for n in (3, 4, 5):
        at = np.flatnonzero(np.arange(len(raw)) + n <= end)
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + raw[at + j]
        slot.append((h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % CHAR_SLOTS)
        start.append(at)
    slot, start = np.concatenate(slot), np.concatenate(start)
    order = np.argsort(start, kind="stable")
    return slot[order], np.bincount(np.repeat(np.arange(len(words)), size)[start], minlength=len(words))


def window_starts(n: int) -> np.ndarray:
    """First words of the windows over n words; the last window holds the last word."""
    return np.arange(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


class Net:
    """Parameters and passes. Per direction: gates z, r and candidate h from input and state."""

    def __init__(self, seed: int = 3, params: dict | None = None):
        self.known: dict[str, np.ndarray] = {}
        if params is not None:
            self.p = params
            return
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"word": (0.03 * rng.standard_normal((WORD_SLOTS, WORD_DIM))).astype(np.float32), "char": (0.03 * rng.standard_normal((CHAR_SLOTS, CHAR_DIM))).astype(np.float32)}
        for k in "fb":
            self.p |= {f"W{k}": init(d, 3 * h), f"U{k}": init(h, 3 * h), f"c{k}": np.zeros(3 * h, np.float32)}
        self.p |= {"A": init(2 * h, h), "v": init(h), "o": init(2 * h), "q": np.full(1, -3.0, np.float32)}

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word slots, character slots, the word each character slot belongs to, slots per word."""
        char, n = char_slots(words)
        return np.fromiter((zlib.crc32(w) % WORD_SLOTS for w in words), np.int64, len(words)), char, np.repeat(np.arange(len(words)), n), n

    def embed(self, slots) -> np.ndarray:
        word, char, owner, n = slots
        c = np.add.reduceat(self.p["char"][char], np.r_[0, np.cumsum(n)[:-1]], axis=0) / np.sqrt(n)[:, None] if len(word) else np.zeros((0, CHAR_DIM))
        return np.concatenate([self.p["word"][word], c], axis=1).astype(np.float32)

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Input part of all gates; the last row is the padding."""
        out = {k: x @ self.p[f"W{k}"] + self.p[f"c{k}"] for k in "fb"}
        return {k: np.concatenate([v, np.zeros((1, 3 * HIDDEN), np.float32)]) for k, v in out.items()}

    def forward(self, proj: dict, at: np.ndarray, keep: bool = False):
        """Logits of windows; at: (windows, WINDOW) rows of proj, the padding row where short."""
        b, h, pad = len(at), HIDDEN, len(proj["f"]) - 1
        real = at != pad
        whole = real.all(axis=0)
        states = np.empty((b, WINDOW, 2 * h), np.float32)
        tape = {"f": [], "b": []}
        for k, steps, off in (("f", range(WINDOW), 0), ("b", range(WINDOW - 1, -1, -1), h)):
            s = np.zeros((b, h), np.float32)
            u_zr, u_c = np.ascontiguousarray(self.p[f"U{k}"][:, : 2 * h]), np.ascontiguousarray(self.p[f"U{k}"][:, 2 * h :])
            for t in steps:
                g = proj[k].take(at[:, t], axis=0)
                zr = s @ u_zr
                zr += g[:, : 2 * h]
                zr = gate(zr)
                z, r = zr[:, :h], zr[:, h:]
                c = (r * s) @ u_c
                c += g[:, 2 * h :]
                c = soft(c)
                new = c - s
                new *= z
                new += s
                if not whole[t]:
                    new = np.where(real[:, t : t + 1], new, s)
                if keep:
                    tape[k].append((t, s, z, r, c))
                s = new
                states[:, t, off : off + h] = s
        e = soft((states.reshape(-1, 2 * h) @ self.p["A"]).reshape(b, WINDOW, h))
        a = np.where(real, e @ self.p["v"], np.float32(-1e9))
        a = np.exp(a - a.max(axis=1, keepdims=True))
        a = a / a.sum(axis=1, keepdims=True)
        pooled = (a[:, None, :] @ states)[:, 0]
        logit = pooled @ self.p["o"] + self.p["q"][0]
        return (logit, (at, real, states, e, a, pooled, tape)) if keep else logit

    def backward(self, proj: dict, kept, dlogit: np.ndarray, x: np.ndarray, slots) -> dict[str, np.ndarray]:
        at, real, states, e, a, pooled, tape = kept
        h, p = HIDDEN, self.p
        g = {"o": dlogit @ pooled, "q": np.array([dlogit.sum()], np.float32)}
        dpool = dlogit[:, None] * p["o"]
        dstates = a[:, :, None] * dpool[:, None, :]
        da = np.einsum("bth,bh->bt", states, dpool)
        da = a * (da - (a * da).sum(axis=1, keepdims=True))
        g["v"] = np.einsum("bt,bth->h", da, e)
        de = da[:, :, None] * p["v"] * (1 - np.abs(e)) ** 2
        g["A"] = states.reshape(-1, 2 * h).T @ de.reshape(-1, h)
        dstates += de @ p["A"].T
        dx = np.zeros_like(x)
        for k, off in (("f", 0), ("b", h)):
            u, du, dgates = p[f"U{k}"], np.zeros_like(p[f"U{k}"]), np.empty((len(at), WINDOW, 3 * h), np.float32)
            ds = np.zeros((len(at), h), np.float32)
            for t, s, z, r, c in reversed(tape[k]):
                ds = ds + dstates[:, t, off : off + h]
                live = np.where(real[:, t : t + 1], ds, 0)
                dc = live * z * (1 - np.abs(c)) ** 2
                dz = live * (c - s) * (0.2 * ((z > 0) & (z < 1)))
                drs = dc @ u[:, 2 * h :].T
                dr = drs * s * (0.2 * ((r > 0) & (r < 1)))
                dg = np.concatenate([dz, dr, dc], axis=1)
                du[:, : 2 * h] += s.T @ dg[:, : 2 * h]
                du[:, 2 * h :] += (r * s).T @ dc
                dgates[:, t] = dg
                ds = np.where(real[:, t : t + 1], live * (1 - z) + drs * r + dg[:, : 2 * h] @ u[:, : 2 * h].T, ds)
            dproj = scatter(at.reshape(-1), dgates.reshape(-1, 3 * h), len(proj[k]))[:-1]
            g[f"U{k}"], g[f"W{k}"], g[f"c{k}"] = du, x.T @ dproj, dproj.sum(axis=0)
            dx += dproj @ p[f"W{k}"].T
        word, char, owner, n = slots
        for name, slot, grad in (("word", word, dx[:, :WORD_DIM]), ("char", char, (dx[:, WORD_DIM:] / np.sqrt(n)[:, None])[owner])):
            rows, at = np.unique(slot, return_inverse=True)
            g[name] = (rows, scatter(at, grad, len(rows)))
        return g


def windows_of(docs: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word rows of all windows, and each window's document."""
    at, owner = [], []
    for i, d in enumerate(docs):
        s = window_starts(len(d))
        grid = s[:, None] + np.arange(WINDOW)
        at.append(np.where(grid < len(d), np.r_[d, pad][np.minimum(grid, len(d))], pad))
        owner.append(np.full(len(s), i))
    return np.concatenate(at), np.concatenate(owner)


def train(texts: list[str], labels: list[int], steps: int = STEPS, seed: int = 3) -> Net | None:
    """Fit on labelled texts, half of each batch toxic; None unless both labels occur among texts
    with words. The number of steps is the same for any sample."""
    docs = [(w, y) for t, y in zip(texts, labels) if (w := plain_words(t))]
    if len({y for _, y in docs}) < 2:
        return None
    net, rng = Net(seed), np.random.default_rng(seed)
    adam = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    share = sum(y for _, y in docs) / len(docs)
    for name, size, slots_of in (("word", WORD_SLOTS, 0), ("char", CHAR_SLOTS, 1)):
        seen, toxic = np.zeros(size), np.zeros(size)
        for words, y in docs:
            at = np.unique(net.inputs(list(set(words)))[slots_of])
            seen[at] += 1
            toxic[at] += y
        z = (toxic - share * seen) / np.sqrt(share * (1 - share) * seen + 1)
        net.known[name] = seen >= LEAST_DOCS
        net.p[name][:, 0] = np.clip(z, -6, 6) / 2
        net.p[name][~net.known[name]] = 0
    turns = []
    for y in (0, 1):
        at, need = [i for i, d in enumerate(docs) if d[1] == y], steps * BATCH_DOCS // 2
        turns.append(np.concatenate([rng.permutation(at) for _ in range(-(-need // len(at)))])[:need].reshape(steps, -1))
    for step, batch in enumerate(np.concatenate(turns, axis=1), 1):
        own = [docs[i] for i in batch]
        vocab: dict[bytes, int] = {}
        rows = [np.array([vocab.setdefault(w, len(vocab)) for w in words], np.int64) for words, _ in own]
        slots = net.inputs(list(vocab))
        x = net.embed(slots)
        proj = net.project(x)
        at, owner = windows_of(rows, len(vocab))
        logit, kept = net.forward(proj, at, keep=True)
        p, y = sigmoid(logit), np.array([y for _, y in own])[owner]
        clean = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-6)), len(own))
        doc = np.maximum(1 - np.exp(clean), 1e-6)[owner]
        d = np.where(y == 1, p * (doc - 1) / doc, p) / len(own)
        grads = net.backward(proj, kept, d.astype(np.float32), x, slots)
        rate = RATE * min(1, 4 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            at = slice(None)
            if isinstance(g, tuple):
                own = net.known[k][g[0]]
                at, g = g[0][own], g[1][own]
                g[:, 0] = 0
            m, v = adam[k][0][at], adam[k][1][at]
            m = m + 0.1 * (g - m)
            v = v + 0.01 * (g * g - v)
            adam[k][0][at], adam[k][1][at] = m, v
            net.p[k][at] -= (rate / (1 - 0.9**step) * m / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return net


class _Rows(dict):
    """Row number of each word; words met for the first time are listed in `new`."""

    def __init__(self):
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self)
        self.new.append(word)
        return i


class Scorer:
    """Scores whole texts; remembers the gates' input of words, up to a bound."""

    MOST = 1 << 16

    def __init__(self, net: Net):
        self.net = net
        self.clear()

    def clear(self) -> None:
        self.rows = _Rows()
        self.proj = self.net.project(np.zeros((0, WORD_DIM + CHAR_DIM), np.float32))

    def score(self, texts: list[str | None]) -> np.ndarray:
        if len(self.rows) > self.MOST:
            self.clear()
        words = [plain_words(t) for t in texts]
        look = self.rows.__getitem__
        docs = [np.fromiter(map(look, ws), np.int64, len(ws)) for ws in words]
        if self.rows.new:
            new = self.net.project(self.net.embed(self.net.inputs(self.rows.new)))
            self.proj = {k: np.concatenate([v[:-1], new[k]]) for k, v in self.proj.items()}
            self.rows.new.clear()
        out = np.zeros(len(texts))
        full = [i for i, d in enumerate(docs) if len(d)]
        empty = sigmoid(self.net.p["q"])[0]
        out[[i for i, d in enumerate(docs) if not len(d)]] = empty
        if full:
            at, owner = windows_of([docs[i] for i in full], len(self.rows))
            best = np.full(len(full), -np.inf)
            for lo in range(0, len(at), 2048):
                np.maximum.at(best, owner[lo : lo + 2048], self.net.forward(self.proj, at[lo : lo + 2048]))
            out[full] = sigmoid(best)
        return out


def held_out(doc_id="doc_id"):
    """Rows never learned from: crc32 of the id's text leaves 2 by 4. A null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_words: int = SAMPLE_WORDS, steps: int = STEPS) -> Net | None:
    """Train on a bounded sample of labelled rows outside the held-out fold."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(~held_out() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pick = [usable.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs) for y in (0, 1)]
    chosen = F.broadcast(pick[0].union(pick[1]))  # at most 2 * sample_docs rows of two numbers
    short = F.length("text") <= 7 * sample_words
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(short).join(chosen, "doc_id").orderBy("doc_id", "text").limit(2 * sample_docs).collect()
    return train([r["text"] for r in rows], [r["toxic"] for r in rows], steps)


def _scored(s: "Scorer | None", texts) -> np.ndarray:
    got = [s.score(texts.slice(lo, 512).to_pylist()) for lo in range(0, len(texts), 512)] if s else [np.zeros(len(texts))]
    return np.concatenate([*got, np.zeros(0)])


def score(docs: DataFrame, net: Net | None, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, th) per document. Null, empty and wordless texts get the
    score of no evidence; without a net every score is 0. What a task remembers of words ends with it."""
    shared = net.p if net else None

    def run(batch, s):
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(_scored(s, batch.column("text"))), "th": batch.column("th")}

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), F.xxhash64("text").alias("th"), "text")
    out = arrow_map(src, run, "doc_id long, held_out boolean, score double, th long", lambda: Scorer(Net(params=shared)) if shared else None)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "th")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below the threshold, all columns kept: texts are scored in place.

    Null, empty and wordless texts stay (they score as no evidence), repeated rows get one decision,
    columns besides doc_id and text may have any name. An empty table, or labels without both kinds,
    leave everything as it is."""
    net = fit(docs, labels)
    if net is None:
        return docs
    at, shared = docs.columns.index("text"), net.p

    def run(batches):
        s = Scorer(Net(params=shared))
        for batch in batches:
            yield batch.filter(pa.array(_scored(s, batch.column(at)) < threshold))
        del s
        give_back()

    return docs.mapInArrow(run, docs.schema)
