"""Token ids in binary files with Re-Pair grammar compression and random access.

Documents are range-sorted by id; each partition streams them into files of about a million ids.
In a file, frequent pairs of neighbouring symbols become nonterminals, round after round; rules,
expansion lengths and the documents' positions are stored beside the symbols. No pair holds id 0,
so every document begins at a symbol.
"""

import json
import re
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareline.llm.common import give_back, store
from fareline.llm.files import Committed, read_all, shard_count
from fareline.session import estimated_bytes, scratch

END_ID = 0
FILE_IDS = 1 << 20
LEAST_COUNT = 16
SHORT_RULE = 64
CHUNK_BYTES = 2 << 20
_SLOT_BITS = 18
_MAGIC = b"RPID1\n"
#: A text with white space that is no lone space or newline, at any place, needs the slow cut.
_SPACES = "\t\v\f\r\x1c\x1d\x1e\x1f"
_WIDE_SPACES = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_KINDS = np.zeros(256, np.uint8)
_KINDS[list(b" \n")], _KINDS[list(_SPACES.encode())], _KINDS[sorted({c.encode()[0] for c in _WIDE_SPACES})] = 1, 2, 3
_WIDE_CODES = np.array([int.from_bytes(c.encode()) for c in _WIDE_SPACES])
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CUT = re.compile(r"(?<=\S) (?=\S)")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts with the tokenizers library, remembering those of words.

    A byte-level tokenizer never joins what a single space between two other characters, or a
    single newline, separates, nor a letter or digit and the ASCII punctuation that ends a word.
    So words are encoded once and texts put together from them. Special tokens' strings in a text
    are ordinary text.

    A word's key is the word after the space or newline before it; the first word of a text has a
    newline too, whose id makes room for the end id of the text before. When there are more than
    MOST words (or 16 ids for each of MOST), those met in a single chunk of texts are forgotten, so
    that common words stay."""

    MOST = 1 << 19

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.newline = self._plain("\n")
        pre = json.loads(self.tok.to_str())
        step = pre.get("pre_tokenizer") or {}
        self.by_word = step.get("type") == "ByteLevel" and step.get("use_regex") and not step.get("add_prefix_space") and not pre.get("normalizer") and len(self.newline) == 1
        if self.by_word:
            vocab = self.tok.get_vocab()
            self.after = {" ": np.zeros(max(vocab.values()) + 1, bool), "\n": np.zeros(max(vocab.values()) + 1, bool)}
            self.after[" "][[i for t, i in vocab.items() if t[:1] == "\u0120"]] = True  # the space, as the library writes it
            self.after["\n"][self.newline] = True
            self.clear()

    def _plain(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def clear(self) -> None:
        self.new: list[str] = []
        self.index: dict[str, int] = {"\n": 0}
        self.at, self.n, self.chunks = np.zeros(1, np.int64), np.ones(1, np.int64), np.zeros(1, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 1
        self.ids[0] = self.newline[0]

    def _forget(self) -> None:
        """Keep the words met in two chunks or more since the last time, half of MOST at the most."""
        often = 2
        self.chunks[0] = np.iinfo(np.int32).max
        while (self.chunks >= often).sum() > max(self.MOST // 2, 1):
            often *= 2
        keep = self.chunks >= often
        words = [w for w, k in zip(self.index, keep.tolist()) if k]
        at = np.flatnonzero(keep)
        ids = self._joined([(self.ids, self.at[at], self.n[at])])
        self.index.clear()
        self.index.update(zip(words, range(len(words))))
        self.n, self.chunks = self.n[at], np.ones(len(at), np.int32)
        self.at, self.ids, self.used = np.cumsum(self.n) - self.n, np.r_[ids, np.zeros(1 << 16, np.uint32)], len(ids)
        if self.used > 8 * self.MOST:
            self.clear()

    def _slow_words(self, text: str) -> list[str]:
        first, *rest = _CUT.split(text)
        return ["\n" + first, *[" " + w for w in rest]]

    def _numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of distinct words; new ones get the next numbers and wait to be learnt."""
        out = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(out < 0)
        out[new] = np.arange(len(self.index), len(self.index) + len(new))
        fresh = [words[i] for i in new.tolist()]
        self.index.update(zip(fresh, out[new].tolist()))
        self.new += fresh
        return out

    def _learn(self, spaces: bool) -> None:
        """Encode the words met for the first time, many in one text; `spaces`: some hold white space."""
        base = len(self.n)
        core = [c if len(c) < len(w) and c[-1:].isalnum() else w for w, c in ((w, w.rstrip(_PUNCTUATION)) for w in self.new)]
        tails = {"": 0}
        tail = np.fromiter((tails.setdefault(w[len(c) :], len(tails)) for w, c in zip(self.new, core)), np.int64, len(core))
        apart = np.flatnonzero(tail)
        core = [core[i] for i in apart.tolist()]
        self._numbers(list(dict.fromkeys(core)))
        of_core = np.fromiter(map(self.index.__getitem__, core), np.int64, len(core))
        whole = np.ones(len(self.new), bool)
        whole[apart] = False
        at, n = np.zeros(len(self.new), np.int64), np.zeros(len(self.new), np.int64)
        words, groups, odd = self.new, {" ": [], "\n": []}, []
        for i in np.flatnonzero(whole).tolist():
            w = words[i]
            (odd if spaces and w[1:].split() != [w[1:]] else groups[w[0]]).append(i)
        for lead, group in groups.items():
            for lo in range(0, len(group), 4096):
                part = group[lo : lo + 4096]
                ids = np.array(self.tok.encode_batch_fast(["".join([words[i] for i in part])], add_special_tokens=False)[0].ids, np.uint32)
                edge = np.r_[np.flatnonzero(self.after[lead][ids]), len(ids)]
                if len(edge) != len(part) + 1 or edge[0]:
                    odd += part
                    continue
                at[part], n[part] = self.used + edge[:-1], np.diff(edge)
                self._append(ids)
        for i in odd:
            w = words[i]
            ids = np.array(self._plain(w) if w[0] == " " else [*self.newline, *self._plain(w[1:])], np.uint32)
            at[i], n[i] = self.used, len(ids)
            self._append(ids)
        self.at, self.n = np.r_[self.at, at], np.r_[self.n, n]
        own = [np.array(self._plain(t), np.uint32) for t in tails]
        tail_n = np.fromiter(map(len, own), np.int64, len(own))
        tail = tail[apart]
        flat = self._joined([(self.ids, self.at[of_core], self.n[of_core]), (np.concatenate(own), (np.cumsum(tail_n) - tail_n)[tail], tail_n[tail])])
        n = self.n[of_core] + tail_n[tail]
        self.at[base + apart], self.n[base + apart] = self.used + np.cumsum(n) - n, n
        self._append(flat)
        self.chunks = np.r_[self.chunks, np.zeros(len(self.new), np.int32)]
        self.new = []

    def _append(self, ids: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    @staticmethod
    def _joined(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """Row by row, the pieces (source, start, length) of all parts one after another."""
        total = sum(n for _, _, n in parts)
        out = np.zeros(int(total.sum()), np.uint32)
        to = np.cumsum(total) - total
        for source, start, n in parts:
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(to, n) + inner] = source[np.repeat(start, n) + inner]
            to = to + n
        return out

    @staticmethod
    def _cut(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """All words with the space or newline before them, the place of each text's first word, and
        which texts need the slow cut."""
        data = b"\n".join([b"", *texts, b""])
        raw = np.frombuffer(data, np.uint8)
        begin = np.cumsum([0, *[len(t) + 1 for t in texts]])
        kind = _KINDS[raw]
        gap = np.flatnonzero(kind == 1)
        first = np.searchsorted(gap, begin)
        edge = np.zeros(len(gap), bool)
        edge[first] = True
        close = np.flatnonzero(np.diff(gap) == 1)
        close = close[~(edge[close] & edge[close + 1])]
        wide = np.flatnonzero(kind == 3)
        code = raw[wide].astype(np.int64) << 8 | raw[wide + 1]
        found = np.isin(code, _WIDE_CODES) | np.isin(code << 8 | raw[np.minimum(wide + 2, len(raw) - 1)], _WIDE_CODES)
        spots = np.concatenate([np.where(edge[close + 1], gap[close], gap[close + 1]), wide[found], np.flatnonzero(kind == 2)])
        slow = np.zeros(len(texts), bool)
        slow[np.searchsorted(begin, spots, "right") - 1] = True
        words = pa.Array.from_buffers(pa.large_string(), len(gap) - 1, [None, pa.py_buffer(gap.astype(np.int64)), pa.py_buffer(data)])
        return words, first, slow

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, END_ID after each text, and each text's number of ids."""
        if not self.by_word:
            each = [np.array([*x.ids, END_ID], np.uint32) for x in self.tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
            return np.concatenate([*each, np.zeros(0, np.uint32)]), np.array([len(x) for x in each], np.int64)
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(self.index) > self.MOST or self.used > 16 * self.MOST:
            self._forget()
        words, first, slow = self._cut([(t or "").encode() for t in texts])
        words = words.dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = words.indices.to_numpy()
        if slow.any():
            cut = [self._slow_words(texts[i]) for i in np.flatnonzero(slow).tolist()]
            used = np.unique(places[~np.repeat(slow, np.diff(first))])
            number = np.zeros(len(distinct), np.int64)
            number[used] = self._numbers([distinct[i] for i in used.tolist()])
            self._numbers(list(dict.fromkeys(chain.from_iterable(cut))))
            parts = np.split(number[places], first[1:-1])
            for i, w in zip(np.flatnonzero(slow).tolist(), cut):
                parts[i] = np.fromiter(map(self.index.__getitem__, w), np.int64, len(w))
            at, first = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
            met = np.unique(at)
        else:
            met = self._numbers(distinct)
            at = met[places]
        if self.new:
            self._learn(bool(slow.any()))
        self.chunks[met] += 1
        n = self.n[at]
        sums = np.r_[0, np.cumsum(n)]
        small = np.int32 if sums[-1] < 1 << 31 else np.int64
        spots = np.repeat((self.at[at] - sums[:-1]).astype(small), n)
        spots += np.arange(sums[-1], dtype=small)
        flat, edge = self.ids[spots], sums[first]
        flat[edge[:-1]] = END_ID
        return np.r_[flat[1:], np.uint32(END_ID)], np.diff(edge)


def repair(seq: np.ndarray, first_free: int, most_rules: int, rounds: int | None = None, least: int = LEAST_COUNT) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and rules (left, right). Rule k stands for symbol first_free + k. In a round all pairs
    that occur `least` times or more, most frequent first, are replaced from left to right; rounds
    go on until there is none (or `rounds` are over), or until the symbols are used up."""
    half, kind, mix = (16, np.uint32, 0x9E3779B1) if first_free + most_rules <= 1 << 16 else (32, np.uint64, 0x9E3779B97F4A7C15)
    half, mix, drop = kind(half), kind(mix), kind(2 * half - _SLOT_BITS)
    seq, rules = seq.astype(kind), [np.zeros((0, 2), np.uint32)]
    made = 0
    for _ in range(len(seq) if rounds is None else rounds):
        room = most_rules - made
        if len(seq) < 2 or room <= 0:
            break
        key = seq[:-1] << half | seq[1:]
        slot = (key * mix >> drop).astype(np.int32)
        # Only pairs of slots with enough occurrences can be frequent: few keys are sorted.
        full = np.bincount(slot, minlength=1 << _SLOT_BITS) >= least
        able = np.flatnonzero(full[slot] & (seq[:-1] != END_ID) & (seq[1:] != END_ID))
        order = np.sort(key[able])
        starts = np.flatnonzero(np.r_[True, order[1:] != order[:-1]]) if len(order) else np.zeros(0, np.int64)
        counts = np.diff(np.r_[starts, len(order)])
        often = counts >= least
        pairs, counts = order[starts[often]], counts[often]
        pairs = pairs[np.lexsort((pairs, -counts))]
        of_pair = (pairs * mix >> drop).astype(np.int32)
        _, lead = np.unique(of_pair, return_index=True)
        lead = np.sort(lead)[:room]
        pairs, of_pair = pairs[lead], of_pair[lead]
        if not len(pairs):
            break
        table = np.full(1 << _SLOT_BITS, -1, np.int32)
        table[of_pair] = np.arange(len(pairs))
        which = table[slot[able]]
        hit = np.flatnonzero(which >= 0)
        hit = hit[pairs[which[hit]] == key[able[hit]]]
        at, which = able[hit], which[hit]
        run_start = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) != 1], np.arange(len(at)), 0))
        keep = (np.arange(len(at)) - run_start) % 2 == 0
        at, which = at[keep], which[keep]
        used = np.bincount(which, minlength=len(pairs)) > 0
        number = np.cumsum(used) - 1
        seq[at] = first_free + made + number[which]
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq = seq[stay]
        pairs = pairs[used]
        rules.append(np.stack([pairs >> half, pairs & ((kind(1) << half) - kind(1))], 1).astype(np.uint32))
        made += len(pairs)
    return seq.astype(np.uint32), np.concatenate(rules)


def expansion_lengths(rules: np.ndarray, first_free: int) -> np.ndarray:
    """Number of ids each rule stands for. A rule uses earlier symbols only."""
    out = np.zeros(len(rules), np.int64)
    left = np.ones(len(rules), bool)
    while left.any():
        at = np.flatnonzero(left)
        inner = rules[at].astype(np.int64) - first_free
        n = np.where(inner < 0, 1, out[np.maximum(inner, 0)])
        ok = (n > 0).all(axis=1)
        out[at[ok]] = n[ok].sum(axis=1)
        left[at[ok]] = False
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, first_free: int) -> np.ndarray:
    symbols = symbols.astype(np.uint32)
    while True:
        non = symbols >= first_free
        if not non.any():
            return symbols
        at = np.flatnonzero(non)
        to = np.arange(len(symbols)) + np.r_[0, np.cumsum(non)][:-1]
        out = np.empty(len(symbols) + len(at), np.uint32)
        out[to] = symbols
        pair = rules[symbols[at] - first_free]
        out[to[at]], out[to[at] + 1] = pair[:, 0], pair[:, 1]
        symbols = out


def expand_many(symbols: np.ndarray, rules: np.ndarray, wide: np.ndarray, first_free: int) -> np.ndarray:
    """As `expand`, for many symbols: rules of up to SHORT_RULE ids are expanded once and copied."""
    n = np.r_[np.ones(first_free, np.int64), wide]
    is_long = n > SHORT_RULE
    short = np.flatnonzero(~is_long)
    flat = expand(short, rules, first_free)
    start = np.zeros(len(n), np.int64)
    start[short] = np.cumsum(n[short]) - n[short]
    while True:
        at = np.flatnonzero(is_long[symbols])
        if not len(at):
            break
        pair = rules[symbols[at].astype(np.int64) - first_free]
        symbols = np.insert(symbols.astype(np.uint32), at + 1, pair[:, 1])
        symbols[at + np.arange(len(at))] = pair[:, 0]
    n = n[symbols]
    before = np.cumsum(n) - n
    return flat[np.repeat(start[symbols] - before, n) + np.arange(n.sum())]


def pack(ids: np.ndarray, lengths: np.ndarray, doc_ids: list[int | None], vocab: int) -> bytes:
    most = (1 << 16) - vocab if vocab < 1 << 16 else 1 << 20
    symbols, rules = repair(ids, vocab, most)
    wide = expansion_lengths(rules, vocab)
    kind = np.dtype("<u2") if vocab + len(rules) <= 1 << 16 else np.dtype("<u4")
    sums = np.r_[0, np.cumsum(np.where(symbols >= vocab, np.r_[wide, 1][np.minimum(symbols.astype(np.int64) - vocab, len(wide)) * (symbols >= vocab)], 1))]
    starts = np.r_[0, np.cumsum(lengths)]
    head = {"vocab": vocab, "rules": len(rules), "docs": len(doc_ids), "symbols": len(symbols), "ids": len(ids), "width": kind.itemsize, "null": [i for i, d in enumerate(doc_ids) if d is None]}
    parts = [rules.astype("<u4"), wide.astype("<u4"), np.array([d or 0 for d in doc_ids], "<i8"), starts.astype("<u8"), np.searchsorted(sums, starts).astype("<u8"), symbols.astype(kind)]
    text = json.dumps(head).encode()
    return _MAGIC + len(text).to_bytes(4, "little") + text + b"".join(p.tobytes() for p in parts)


class TokenFile:
    """A file's documents, each decodable by itself."""

    def __init__(self, data: bytes):
        if data[:6] != _MAGIC:
            raise ValueError("not a token file")
        n = int.from_bytes(data[6:10], "little")
        self.head = h = json.loads(data[10 : 10 + n])
        at = 10 + n

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(data, kind, count, at)
            at += x.nbytes
            return x

        self.rules, self.wide = take("<u4", 2 * h["rules"]).reshape(-1, 2), take("<u4", h["rules"])
        null = set(h["null"])
        self.doc_ids = [None if i in null else int(d) for i, d in enumerate(take("<i8", h["docs"]))]
        self.starts, self.symbol_starts = take("<u8", h["docs"] + 1).astype(np.int64), take("<u8", h["docs"] + 1).astype(np.int64)
        self.symbols = take(f"<u{h['width']}", h["symbols"])

    def document(self, i: int) -> np.ndarray:
        return expand(self.symbols[self.symbol_starts[i] : self.symbol_starts[i + 1]], self.rules, self.head["vocab"])

    def all(self) -> np.ndarray:
        return expand_many(self.symbols, self.rules, self.wide, self.head["vocab"])


def write_tokens(docs: DataFrame, uri: str, tokenizer: str | None = None, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode `docs` (doc_id, text) into files below the folder `uri`, in ascending doc_id order
    (nulls first, equal ids by text); returns the stored manifest (name, shard, seq, docs, ids,
    start): start is the number of ids in all files before. A null text is its end id alone."""
    path = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    key = [F.col("doc_id").asc_nulls_first(), "__h"]
    size = estimated_bytes(src)
    if size > 1 << 50:  # the optimizer has no estimate
        size = int(src.agg(F.sum(F.octet_length("text"))).head()[0] or 0)
    shards = shard_count(size, spark.sparkContext.defaultParallelism)

    def run(batches):
        from pyspark import TaskContext

        shard, seq, done = TaskContext.get().partitionId(), 0, []
        enc = Encoder(path)
        vocab = enc.tok.get_vocab_size(with_added_tokens=True)
        held, ids, lengths = [], np.zeros(0, np.uint32), np.zeros(0, np.int64)

        def flush(docs):
            nonlocal seq, held, ids, lengths
            n = int(lengths[:docs].sum())
            out = Committed(uri, f"ids-{shard:06d}-{seq:05d}.bin")
            out.write(pack(ids[:n], lengths[:docs], held[:docs], vocab))
            out.commit()
            done.append((out.name, shard, seq, docs, n))
            seq += 1
            held, ids, lengths = held[docs:], ids[n:], lengths[docs:]

        for batch in batches:
            own, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            # Texts that end in the same CHUNK_BYTES go together: a chunk looks up a common word once.
            size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            edges = np.r_[0, np.flatnonzero(np.diff(size // CHUNK_BYTES)) + 1, len(own)]
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                flat, n = enc.encode(texts.slice(lo, hi - lo).to_pylist())
                held += own[lo:hi]
                ids, lengths = np.r_[ids, flat], np.r_[lengths, n]
                while len(ids) >= file_ids:
                    flush(int(np.searchsorted(np.cumsum(lengths), file_ids)) + 1)
        if held:
            flush(len(held))
        del enc
        give_back()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["name", "shard", "seq", "docs", "ids"])

    sorted_ = src.withColumn("__h", F.xxhash64("text")).repartitionByRange(shards, *key).sortWithinPartitions(*key).drop("__h")
    manifest, _ = store(sorted_.mapInArrow(run, "name string, shard long, seq long, docs long, ids long"), "op6-manifest")
    before = Window.partitionBy(F.lit(0)).orderBy("shard", "seq").rowsBetween(Window.unboundedPreceding, -1)
    manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0))).write.parquet(f"{uri}/manifest")
    return spark.read.schema("name string, shard long, seq long, docs long, ids long, start long").parquet(f"{uri}/manifest")


def read_tokens(manifest: DataFrame, uri: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) per document, decoded from the files."""

    def run(batches):
        for batch in batches:
            for name, start in zip(batch.column("name").to_pylist(), batch.column("start").to_pylist()):
                f = TokenFile(read_all(uri, name))
                ids, s = f.all().astype("<u4"), f.starts
                raw = memoryview(ids.view(np.uint8))
                cols = [pa.array(f.doc_ids, pa.int64()), pa.array(start + s[:-1]), pa.array(np.diff(s)), pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(s[:-1].tolist(), s[1:].tolist())], pa.int64())]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(s.astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    files = max(1, min(manifest.count(), 8 * manifest.sparkSession.sparkContext.defaultParallelism))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return manifest.repartition(files).mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    uri = scratch(docs.sparkSession, "op6-tokens")
    return read_tokens(write_tokens(docs, uri, tokenizer), uri)
