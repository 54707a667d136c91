"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Many words are encoded at once: their symbols lie in one flat array. In a round every word looks
for its best pair (best score, then leftmost); the pairs of that score are merged from left to
right at once, up to the first merge that creates a pair which has to go before the rest. Then the
array is compacted; words without a pair leave it. This gives exactly the library's result, which
merges one pair at a time.

Words are cut only where no piece of the model can reach across. In a word of many symbols a pair
is merged as soon as it is the best within the length of the longest piece on both sides: no chain
of merges from further away can reach it, since its symbol would be longer than any piece.
"""

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_NONE = np.int64(1 << 30)

#: Words of at most so many characters are remembered; a task's memory holds so many words.
REMEMBERED, MOST_WORDS = 32, 1 << 18

#: Characters encoded at once, rows of an output batch.
CHUNK_CHARS, CHUNK_ROWS = 1 << 20, 2048


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A BPE model's tables: symbols, pair look-up, bytes of pieces. Symbols below `size` are
    pieces; `size` + code point is a character that is no piece."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(SentencePieceProcessor(model_file=path).serialized_model_proto())
        spec, kinds = proto.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != proto.trainer_spec.BPE or not proto.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback is needed")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("a model that keeps the text as it is is needed")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in proto.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.size, self.prefix = len(proto.pieces), spec.add_dummy_prefix
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == kinds.NORMAL}
        self.byte_ids = np.zeros(256, np.int64)
        self.surface = [b""] * self.size
        for i, p in enumerate(proto.pieces):
            if p.type == kinds.BYTE:
                b = int(p.piece[3:5], 16)
                self.byte_ids[b], self.surface[i] = i, bytes([b])
            elif p.type == kinds.NORMAL:
                self.surface[i] = p.piece.replace(SPACE, " ").encode()
            elif p.type == kinds.UNKNOWN:
                self.surface[i] = proto.trainer_spec.unk_surface.encode()
        self.is_byte = np.array([p.type == kinds.BYTE for p in proto.pieces])
        self.is_control = np.array([p.type == kinds.CONTROL for p in proto.pieces])
        self.starts_space = np.array([p.type == kinds.NORMAL and p.piece.startswith(SPACE) for p in proto.pieces])
        self.longest = max(map(len, normal))
        self.symbol = np.arange(self.size, self.size + 0x110000, dtype=np.int64)
        for piece, i in normal.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i

        order = {s: r for r, s in enumerate(sorted({-proto.pieces[i].score for i in normal.values()}))}
        known = lambda t: normal.get(t, self.size + ord(t) if len(t) == 1 else None)
        rows = []
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                a, b = known(piece[:cut]), known(piece[cut:])
                if a is not None and b is not None:
                    rows.append((a << 21 | b, order[-proto.pieces[i].score], i))
        table = np.array(sorted(rows), np.int64).reshape(-1, 3)
        self.keys, self.ranks, self.merged = (np.ascontiguousarray(table[:, k]) for k in range(3))

        # Neighbouring characters that occur in some piece; all others can never share a symbol.
        several = [p for p in normal if len(p) > 1]
        chars = sorted(set("".join(several)))
        self.char_class = np.zeros(0x110000, np.int16)
        self.char_class[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.joins = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        number = {c: k for k, c in enumerate(chars, 1)}
        for p in several:
            for a, b in zip(p, p[1:]):
                self.joins[number[a], number[b]] = True

        # Pieces of white space alone that share one score grow from the left to the longest one: a
        # long run begins with that piece, whatever follows. Checked on runs of up to three of them.
        runs = [normal[p] for p in normal if set(p) == {SPACE}]
        most = max((len(proto.pieces[i].piece) for i in runs), default=0)
        self.space_run = 0
        if most > 1 and len({proto.pieces[i].score for i in runs if len(proto.pieces[i].piece) > 1}) == 1:
            flat, n = encode_words(self, [SPACE * k for k in range(1, 3 * most + 1)])
            ids = [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]
            if all(ids[k - 1] == [normal[SPACE * most], *(ids[k - most - 1] if k > most else [])] for k in range(most, 3 * most + 1)):
                self.space_run = most

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (_NONE without a piece) and merged symbol of each pair."""
        key = left << 21 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), self.merged[at]

    def segments(self, word: str) -> list[str]:
        """Parts of a word that no piece joins."""
        codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.char_class[codes]
        cut = ~self.joins[kind[:-1], kind[1:]]
        n = len(word) - len(word.lstrip(SPACE))
        if self.space_run and n > 2 * self.longest:
            whole = (n - self.longest) // self.space_run
            cut[np.arange(1, whole + 1) * self.space_run - 1] = True
        at = [0, *(np.flatnonzero(cut) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(at, at[1:])]


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def _leftmost(m: Pieces, sym: np.ndarray, word: np.ndarray, rank: np.ndarray, into: np.ndarray, at: np.ndarray, group: np.ndarray, blocked: np.ndarray) -> np.ndarray:
    """Of the sorted positions `at`, whose pairs share a score in each group: those from left to
    right that do not overlap, up to the first whose merge makes a pair that must go before the
    next ones, and before the first that is blocked."""
    number = np.arange(len(at))
    run = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) != 1], number, 0))
    keep = (number - run) % 2 == 0
    at, group, blocked, number = at[keep], group[keep], blocked[keep], number[: keep.sum()]
    made, last = into[at], len(sym) - 1
    beside = np.r_[False, np.diff(at) == 2]
    before = np.where(beside, np.r_[0, made[:-1]], sym[np.maximum(at - 1, 0)])
    has_left = (at > 0) & (word[np.maximum(at - 1, 0)] == word[at])
    right = np.minimum(at + 2, last)
    has_right = (at + 2 <= last) & (word[right] == word[at])
    urgent = (has_left & (m.look_up(before, made)[0] <= rank[at])) | (has_right & (m.look_up(made, sym[right])[0] <= rank[at]))
    stops = np.cumsum(urgent) - urgent + np.cumsum(blocked)
    start = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], number, 0))
    return at[stops == (stops - blocked)[start]]


def _windows(x: np.ndarray, back: int, ahead: int) -> np.ndarray:
    """Minimum of x over positions i - back to i + ahead, by doubling."""
    low = np.concatenate([np.full(back, _NONE), x, np.full(ahead, _NONE)])
    size, width = back + ahead + 1, 1
    while 2 * width <= size:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    return np.minimum(low[: len(x)], low[size - width : size - width + len(x)])


def _short_choice(m: Pieces, sym: np.ndarray, word: np.ndarray, rank: np.ndarray, into: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Positions to merge in words: those of the word's best score."""
    at = np.flatnonzero((rank == best) & (rank < _NONE))
    return _leftmost(m, sym, word, rank, into, at, word[at], np.zeros(len(at), bool))


def _long_choice(m: Pieces, sym: np.ndarray, word: np.ndarray, rank: np.ndarray, into: np.ndarray) -> np.ndarray:
    """Positions to merge in words of any length: pairs of the best score within the longest
    piece's length on both sides. One waits if such a pair to its left has to wait."""
    reach = m.longest + 1
    chosen = (rank == _windows(rank, reach, reach)) & (rank < _NONE)
    at = np.flatnonzero(chosen)
    waits = _windows(np.where(chosen, _NONE, rank), reach, 0)[at] == rank[at]
    return _leftmost(m, sym, word, rank, into, at, np.cumsum(np.r_[True, np.diff(at) > reach]), waits)


def _rounds(m: Pieces, sym: np.ndarray, lengths: np.ndarray, long: bool) -> tuple[np.ndarray, np.ndarray]:
    """Final symbols of the words one after another, and each word's number of symbols."""
    count = len(lengths)
    word = np.repeat(np.arange(count), lengths)
    rank, into = np.full(len(sym), _NONE), np.zeros(len(sym), np.int64)

    def refresh(at: np.ndarray) -> None:
        inner = at[(at >= 0) & (at + 1 < len(sym))]
        inner = inner[word[inner] == word[inner + 1]]
        rank[at[at >= 0]] = _NONE
        rank[inner], into[inner] = m.look_up(sym[inner], sym[inner + 1])

    refresh(np.arange(len(sym)))
    done_word, done_sym = [], []
    while len(sym):
        start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = np.minimum.reduceat(rank, start)
        seg = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(sym)]))
        over = (best == _NONE)[seg]
        if over.any():
            done_word.append(word[over])
            done_sym.append(sym[over])
            sym, word, rank, into = (x[~over] for x in (sym, word, rank, into))
            continue
        at = _long_choice(m, sym, word, rank, into) if long else _short_choice(m, sym, word, rank, into, best[seg])
        sym[at] = into[at]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        at = np.cumsum(keep)[at] - 1
        sym, word, rank, into = (x[keep] for x in (sym, word, rank, into))
        refresh(np.concatenate([at, at - 1]))
    words, out = np.concatenate([*done_word, np.zeros(0, np.int64)]), np.concatenate([*done_sym, np.zeros(0, np.int64)])
    order = np.argsort(words, kind="stable")
    return out[order], np.bincount(words, minlength=count)


def encode_words(m: Pieces, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words one after another, and each word's number of ids."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    sym = m.symbol[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)]
    wide = lengths > 4 * m.longest
    out, counts = np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    parts = [(kind, np.flatnonzero(kind)) for kind in (~wide, wide) if kind.any()]
    if len(parts) == 1:
        out, counts = _rounds(m, sym, lengths, bool(wide.any()))
    elif parts:
        both = [_rounds(m, sym[np.repeat(kind, lengths)], lengths[who], k == 1) for k, (kind, who) in enumerate(parts)]
        for (_, who), (_, n) in zip(parts, both):
            counts[who] = n
        out = np.empty(counts.sum(), np.int64)
        for (kind, _), (got, _) in zip(parts, both):
            out[np.repeat(kind, counts)] = got
    # Characters that are no piece become the ids of their UTF-8 bytes.
    code = out - m.size
    odd = code >= 0
    if odd.any():
        n = np.where(odd, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
        sums = np.r_[0, np.cumsum(n)]
        k = np.arange(sums[-1]) - np.repeat(sums[:-1], n)
        width, code = np.repeat(n, n), np.repeat(code, n)
        low = code >> 6 * (width - 1 - k)
        byte = np.where(width == 1, code, np.where(k == 0, low | (0xF00 >> width) & 0xFF, low & 0x3F | 0x80))
        out = np.where(np.repeat(odd, n), m.byte_ids[byte & 0xFF], np.repeat(out, n))
        word = np.repeat(np.arange(len(words)), counts)
        counts = np.bincount(word, weights=n, minlength=len(words)).astype(np.int64)
    return out, counts


class Encoder:
    """Ids of whole texts; the ids of short words are remembered until `clear`."""

    def __init__(self, m: Pieces):
        self.m = m
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.at, self.n, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _parts(self, text: str) -> list[str]:
        text = (SPACE if self.m.prefix else "") + text.replace(" ", SPACE)
        parts = []
        for w in _WORD.findall(text):
            if len(w) <= REMEMBERED:
                parts.append(w)
            else:
                parts += self.m.segments(w)
        return parts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and each text's number of ids."""
        if len(self.index) > MOST_WORDS:
            self.clear()
        parts = [self._parts(t) if t else [] for t in texts]
        index, new, base = self.index, {}, len(self.at)
        number = []
        for p in parts:
            for w in p:
                k = index.get(w)
                if k is None:
                    k = new.get(w)
                    if k is None:
                        k = new[w] = base + len(new)
                number.append(k)
        number = np.array(number, np.int64)
        at, n, ids = self.at, self.n, self.ids
        if new:
            flat, counts = encode_words(self.m, list(new))
            at = np.r_[at, len(ids) + np.r_[0, np.cumsum(counts)][:-1]]
            n, ids = np.r_[n, counts], np.r_[ids, flat]
            if max(map(len, new)) <= REMEMBERED:
                index.update(new)
                self.at, self.n, self.ids = at, n, ids
        count = n[number]
        sums = np.r_[0, np.cumsum(count)]
        out = ids[np.repeat(at[number] - sums[:-1], count) + np.arange(sums[-1])]
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        return out, np.diff(np.r_[0, sums[ends]]) if len(parts) else np.zeros(0, np.int64)


def decode(m: Pieces, ids: np.ndarray) -> str:
    """Text of a sequence of ids: the prefix space goes, bytes form characters, a byte that does
    not belong to one becomes U+FFFD."""
    ids = np.asarray(ids, np.int64)
    ids = ids[~m.is_control[ids]]
    if not len(ids):
        return ""
    raw = b"".join([m.surface[i] for i in ids.tolist()])
    raw = raw[1:] if m.prefix and m.starts_space[ids[0]] else raw
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    edges = np.flatnonzero(np.diff(m.is_byte[ids].astype(np.int8))) + 1
    out = []
    for k, run in enumerate(np.split(ids, edges)):
        part = b"".join([m.surface[i] for i in run.tolist()])
        if k == 0 and m.prefix and m.starts_space[run[0]]:
            part = part[1:]
        out.append(_bytewise(part) if m.is_byte[run[0]] else part.decode())
    return "".join(out)


def _bytewise(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for width in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + width].decode())
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, ids) per document of `docs` (doc_id, text), for whole texts.

    A null or empty text has no ids. A null doc_id stays, repeated rows give repeated rows, other
    columns are ignored, an empty table gives an empty one."""
    return _map(docs, model, lambda m, ids: {"ids": ids}, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids). Null or no ids give an empty text."""
    path = model or default_model()

    def run(batches):
        m = load(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(lo, CHUNK_ROWS)
                ids = part.column("ids")
                texts = [decode(m, ids[i].values.to_numpy(zero_copy_only=False)) if ids[i].is_valid else "" for i in range(len(ids))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of the ids and of the text decoded from them.
    Rows as in `encode`."""

    def of(m: Pieces, ids: list[np.ndarray]) -> dict:
        sha = lambda b: hashlib.sha256(b).hexdigest()
        return {
            "n_tokens": [len(x) for x in ids],
            "ids_sha256": [sha(",".join(map(str, x.tolist())).encode()) for x in ids],
            "decoded_sha256": [sha(decode(m, x).encode()) for x in ids],
        }

    return _map(docs, model, of, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _map(docs: DataFrame, model: str | None, columns, schema: str) -> DataFrame:
    path = model or default_model()

    def run(batches):
        m = load(path)
        enc = Encoder(m)

        def result(owner: list, texts: list) -> pa.RecordBatch:
            flat, n = enc.encode(texts)
            cols = columns(m, np.split(flat, np.cumsum(n)[:-1]) if len(n) else [])
            kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
            return pa.RecordBatch.from_arrays([pa.array(owner, pa.int64()), *(pa.array(c, kinds.get(k, pa.string())) for k, c in cols.items())], ["doc_id", *cols])

        for batch in batches:
            owner, texts, chars = [], [], 0
            for d, t in zip(batch.column("doc_id"), batch.column("text")):
                owner.append(d.as_py())
                texts.append(t.as_py())
                chars += len(texts[-1] or "")
                if chars >= CHUNK_CHARS or len(owner) >= CHUNK_ROWS:
                    yield result(owner, texts)
                    owner, texts, chars = [], [], 0
            if owner:
                yield result(owner, texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
