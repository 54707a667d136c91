"""Repair of conversation structure: cheapest edits by an auction shortest-path algorithm.

A conversation's rows and the states of the role grammar `(s?(ua)+)?` span a lattice; an arc is an
edit (keep, change role, delete, insert) with an integer cost. Nodes carry prices that never exceed
the cost of an arc plus the price at its end. A path grows from the first node along arcs that are
tight; where none is, the node's price rises and the path gives the node up. When it reaches the
end, the prices on every cheapest path are exact, and the tight arcs, first letter first, spell the
ASCII-least of the cheapest edit sequences.

Long conversations are solved in blocks of rows from the last to the first: the exact prices where
a block ends are all that the rows before it need.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareline.llm.common import store

#: Costs: keep, change role, delete, insert, and what a truncated row adds where it stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3

#: Rows of a block, remembered blocks of a task.
BLOCK, MOST_BLOCKS = 16, 1 << 15

_MARK = r"[^\x20\x09-\x0D]"
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_KEEPS = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}
_NEXT = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
_MOST = (1 << 63) - 1

#: Cheapest edits behind the last row, by state: nothing, or the inserts that complete a pair.
_END_PRICES = (0, 2 * INSERT, INSERT, 0)
_END_EDITS = ("", "II", "I", "")

STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def arcs(code: str, state: int) -> list[tuple[str, int, bool, int]]:
    """(letter, cost, takes the row, next state) in ASCII order. `code` is D for a row that must
    go, else its role's initial (s, u, a, or o for any other), upper case if truncated."""
    out = [("D", DELETE, True, state), ("I", INSERT, False, _NEXT[state])]
    if code != "D":
        more = TRUNCATED if code.isupper() else 0
        kept = _KEEPS.get((state, code.lower()))
        if kept is not None:
            out.append(("K", KEEP + more, True, kept))
        out.append(("R", REROLE + more, True, _NEXT[state]))
    return out


_ARCS = {(code, state): arcs(code, state) for code in "DsuaoSUAO" for state in range(4)}


def auction(codes: str, exits: tuple[int, ...]) -> list[list[int]]:
    """Prices by row and state, exact on every cheapest way from each state before the first row
    to the end. `exits` are the exact prices behind the last row."""
    n, low = len(codes), min(exits)
    price = [[low] * 4 for _ in range(n)] + [list(exits)]
    for first in range(4):
        path = [(0, first)]
        while path[-1][0] < n:
            i, state = path[-1]
            best, to = None, None
            for _, cost, takes, then in _ARCS[codes[i], state]:
                value = cost + price[i + takes][then]
                if best is None or value < best:
                    best, to = value, (i + takes, then)
            if price[i][state] < best:
                price[i][state] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
    return price


def trace(codes: str, price: list[list[int]], state: int) -> tuple[str, int]:
    """The first letters of tight arcs from a state before the first row, and the last state."""
    i, out = 0, []
    while i < len(codes):
        letter, _, takes, then = next(a for a in _ARCS[codes[i], state] if a[1] + price[i + a[2]][a[3]] == price[i][state])
        out.append(letter)
        i, state = i + takes, then
    return "".join(out), state


class Solver:
    """Cost and letters of a conversation's cheapest edits. Solved blocks are remembered."""

    def __init__(self):
        self.known: dict = {}

    def _block(self, codes: str, exits: tuple[int, ...]) -> list[tuple[int, str, int]]:
        low = min(exits)
        key = (codes, *(e - low for e in exits))
        got = self.known.get(key)
        if got is None:
            if len(self.known) >= MOST_BLOCKS:
                self.known.clear()
            price = auction(codes, key[1:])
            got = self.known[key] = [(price[0][q], *trace(codes, price, q)) for q in range(4)]
        return [(p + low, letters, q) for p, letters, q in got]

    def __call__(self, codes: str) -> tuple[int, str]:
        exits, blocks = _END_PRICES, []
        for lo in reversed(range(0, len(codes), BLOCK)):
            blocks.append(self._block(codes[lo : lo + BLOCK], exits))
            exits = tuple(b[0] for b in blocks[-1])
        state, out = _START, []
        for block in reversed(blocks):
            _, letters, state = block[state]
            out.append(letters)
        return exits[_START], "".join(out) + _END_EDITS[state]


def damage(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by crc32 of "conv_id:turn" modulo 20: 0 dropped,
    1 text emptied, 2 text without . ! ?, 3 repeated, 4 role user. Nulls count as one space; conv_id
    and turn themselves stay null."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    at = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"), at.alias("at"))
    text = F.when(F.col("at") == 1, "").when(F.col("at") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("at") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("at") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("at <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _coded(turns: DataFrame) -> DataFrame:
    """Rows with their fingerprint `h` and code. A repeated row of a later turn is a duplicate
    here; copies within one turn are neighbours in the order and found there."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("h", F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))))
    blank = ~F.col("text").rlike(_MARK)
    whole = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return rows.withColumn("code", F.when(blank, "B").when(whole, letter).otherwise(F.upper(letter)))


def _first_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, h, first) of rows that occur more than once: their first turn, nulls first."""
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    many = rows.groupBy("conv_id", "h").agg(F.count(F.lit(1)).alias("c"), F.min(turn).alias("first"))
    return many.where("c > 1").select(F.col("conv_id").alias("_c"), F.col("h").alias("_h"), "first")


def _ordered(df: DataFrame, *more) -> DataFrame:
    order = [F.col("conv_id").asc_nulls_first(), *more, F.col("turn").asc_nulls_first(), "role", "h"]
    return df.repartition("conv_id").sortWithinPartitions(*order)


def edits(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation.

    Rows of a conversation are taken by turn (nulls first; within a turn by role, then by the md5 of
    role and text; equal rows stay neighbours). Null roles and texts count as one space, a null
    conv_id is a conversation. `conversations` (conv_id) names further ones that must have a row;
    without rows they get zeros and an empty audit. Only codes of a byte a row are held."""
    rows = _coded(turns)
    first = _first_turns(rows)
    narrow = rows.select("conv_id", "turn", "role", "h", "code")
    later = F.col("first").isNotNull() & (F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn")) > F.col("first"))
    joined = narrow.join(first, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("h") == F.col("_h")), "left")
    coded = joined.select("conv_id", "turn", "role", "h", F.when((F.col("code") != "B") & F.coalesce(later, F.lit(False)), "C").otherwise(F.col("code")).alias("code"))
    if conversations is not None:
        none = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        coded = coded.unionByName(none.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("h"), F.lit("-").alias("code")))
    return _ordered(coded).mapInArrow(_solve, f"conv_id long, {STATS}")


def _solve(batches):
    solver, out, last = Solver(), [], None

    def close():
        faults = [s["B"], s["C"], s["T"]]
        cost, audit = solver(s["codes"].decode())
        gaps = 0 if s["low"] is None else min(s["high"] - s["low"] + 1 - s["turns"], _MOST)
        out.append((last[0], gaps, *faults, s["illegal"], cost, audit))

    def batch_of():
        kinds = [pa.int64()] * 7 + [pa.string()]
        b = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["conv_id", *(p.split()[0] for p in STATS.split(", "))])
        out.clear()
        return b

    for batch in batches:
        for conv, turn, role, h, code in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "h", "code"))):
            if last is None or last[0] != conv:
                if last is not None:
                    close()
                last = (conv,)
                s = {"codes": bytearray(), "B": 0, "C": 0, "T": 0, "illegal": 0, "turns": 0, "low": None, "high": None, "role": None, "row": None}
                if len(out) >= 1024:
                    yield batch_of()
            if code == "-":
                continue
            if code not in "BC" and s["row"] == (turn, h):
                code = "C"
            if code in "BC":
                s[code] += 1
            elif code.isupper():
                s["T"] += 1
            s["codes"] += b"D" if code in "BC" else code.encode()
            if turn is not None:
                if s["low"] is None:
                    s["low"] = turn
                s["turns"] += turn != s["high"]
                s["high"] = turn
            if s["role"] is not None and s["role"] + role[:1] not in ("su", "ua", "au"):
                s["illegal"] += 1
            s["role"], s["row"] = role[:1], (turn, h)
    if last is not None:
        close()
    if out:
        yield batch_of()


def repaired(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """`edits` and repaired_sha256, the hash of the repaired conversation's `role:text` lines.

    The letters are decided first and stored; then a conversation's letters precede its rows in
    one sorted pass that hashes row by row, so no conversation's texts are held together. A hash and
    the letters are one value per conversation: its rows pass one task, in pieces."""
    plan, _ = store(edits(turns, conversations), "op12-edits")
    rows = _coded(turns).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "h", "text", *(F.lit(None).cast(p.split()[1]).alias(p.split()[0]) for p in STATS.split(", ")))
    head = plan.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("h"), F.lit("").alias("text"), *(p.split()[0] for p in STATS.split(", ")))
    return _ordered(head.unionByName(rows), "kind").drop("h", "turn").mapInArrow(_apply, f"conv_id long, {STATS}, repaired_sha256 string")


class Writer:
    """Applies letters to rows as they come and hashes the result."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.sha, self.first = audit, 0, _START, hashlib.sha256(), True

    def _say(self, role: str, text: str) -> None:
        self.sha.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.first = False

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.state = _NEXT[self.state]
            self._say(_ROLES[self.state], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = _KEEPS[self.state, role[:1]]
            self._say(role, text)
        elif letter == "R":
            self.state = _NEXT[self.state]
            self._say(_ROLES[self.state], text)

    def close(self) -> str:
        self.inserts()
        if self.at != len(self.audit):
            raise ValueError("letters without rows")
        return self.sha.hexdigest()


def _apply(batches):
    names = [p.split()[0] for p in STATS.split(", ")]
    out, writer, head = [], None, None

    def batch_of():
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        b = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["conv_id", *names, "repaired_sha256"])
        out.clear()
        return b

    for batch in batches:
        kinds, roles, texts = (batch.column(c).to_pylist() for c in ("kind", "role", "text"))
        for i, kind in enumerate(kinds):
            if kind == 0:
                if writer:
                    out.append((*head, writer.close()))
                    if len(out) >= 1024:
                        yield batch_of()
                head = [batch.column(c)[i].as_py() for c in ("conv_id", *names)]
                writer = Writer(head[-1])
            else:
                writer.row(roles[i], texts[i])
    if writer:
        out.append((*head, writer.close()))
    if out:
        yield batch_of()
