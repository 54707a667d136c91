"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and the spans of its turns meet the
token spans by binary search. The template's marks are added tokens, so no token reaches over the
edge of a turn; the marks' strings inside a text are escaped reversibly.
"""

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.tokens import default_tokenizer

BEGIN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
_ESCAPE = re.compile(r"\\|<\|")
_UNESCAPE = re.compile(r"\\(\\|\|)")
_TURN = re.compile(re.escape(BEGIN) + "(.*?)" + re.escape(BODY) + "(.*?)" + re.escape(END), re.S)
LOSS_ROLE = "assistant"

#: Text and token bytes after which formatted conversations leave a task.
BATCH_BYTES = 4 << 20


def escape(text: str) -> str:
    """No mark can occur in the result: a backslash is doubled, "<|" becomes "<\\|"."""
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else "<\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and, for each assistant turn, the span of its text."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = BEGIN + escape(role) + BODY, escape(text)
        if role == LOSS_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    turns = [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]
    if sum(len(m[0]) for m in _TURN.finditer(formatted)) != len(formatted):
        raise ValueError("text outside the turns")
    return turns


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """1 for each token that lies in a span. Spans and token starts are sorted: the spans' edges are
    found among the tokens by binary search."""
    mask = np.zeros(len(starts), np.int8)
    for lo, hi in spans:
        a, b = np.searchsorted(starts, lo, "left"), np.searchsorted(starts, hi, "left")
        if a < b and ends[b - 1] > hi:
            raise ValueError("a token reaches over the edge of a turn")
        mask[a:b] = 1
    return mask


def masked_texts(formatted: str, starts, ends, mask) -> list[str]:
    """Text under each run of masked tokens, unescaped; runs are parted by unmasked marks."""
    m = np.r_[0, np.asarray(mask, np.int8), 0]
    edges = np.flatnonzero(np.diff(m))
    return [unescape(formatted[int(starts[a]) : int(np.max(ends[a:b]))]) for a, b in zip(edges[::2], edges[1::2])]


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    tok.add_tokens([AddedToken(t, normalized=False) for t in (BEGIN, BODY, END)])
    return tok


def format_conversations(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(conv_id, n_turns, formatted, ids, starts, ends, mask) per conversation.

    Rows of a conversation are ordered by turn (nulls first), then role and text. Null role and text
    count as empty. ids are token ids, starts/ends their code-point spans, mask 1 where the loss
    counts: on the texts of assistant turns. A null conv_id is a conversation of its own."""
    path = tokenizer or default_tokenizer()
    src = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    names = ["conv_id", "n_turns", "formatted", "ids", "starts", "ends", "mask"]
    kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.int8())]

    def run(batches):
        tok, held, out, last, size = _tokenizer(path), [], [], None, 0

        def close():
            nonlocal size
            text, spans = render(held)
            e = tok.encode(text, add_special_tokens=False)
            offs = np.array(e.offsets, np.int32).reshape(-1, 2)
            out.append((last[0], len(held), text, np.array(e.ids, np.int32), offs[:, 0], offs[:, 1], token_mask(offs[:, 0], offs[:, 1], spans)))
            size += len(text) + 13 * len(offs)
            held.clear()

        def batch_of():
            nonlocal size
            conv, n, text, *lists = zip(*out)
            cols = [pa.array(c, t) for c, t in zip((conv, n, text), kinds)]
            for x, t in zip(lists, kinds[3:]):
                ends = np.cumsum([0, *map(len, x)]).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x), t.value_type)))
            out.clear()
            size = 0
            return pa.RecordBatch.from_arrays(cols, names)

        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                for conv, role, text in zip(*(batch.column(c).slice(lo, 512).to_pylist() for c in ("conv_id", "role", "text"))):
                    if last is not None and last[0] != conv:
                        close()
                        if size >= BATCH_BYTES:
                            yield batch_of()
                    last = (conv,)
                    held.append((role, text))
        if last is not None:
            close()
            yield batch_of()

    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    return src.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, "conv_id long, n_turns long, formatted string, ids array<int>, starts array<int>, ends array<int>, mask array<tinyint>")


def digests(formatted: DataFrame) -> DataFrame:
    """What the stored output says: turns and loss text with their hashes, read back from it.

    One row per conversation of `format_conversations`, a null conv_id included; conversations of
    empty texts have the hash of their roles and an empty loss text; an empty table gives an empty one."""

    def run(batches):
        for batch in batches:
            lists = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column(n) for n in ("starts", "ends", "mask"))]
            rows = []
            for i, conv in enumerate(batch.column("conv_id").to_pylist()):
                text = batch.column("formatted")[i].as_py()
                turns = parse(text)
                loss = "".join(masked_texts(text, *(v[o[i] : o[i + 1]] for o, v in lists)))
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((conv, len(turns), sha(whole), len(loss), sha(loss), len(text)))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", "formatted", "starts", "ends", "mask").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
