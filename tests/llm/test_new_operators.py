"""Piece encoding, conversation repair and vector codes against plain versions."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareline.llm import dialogue, gnat, pieces


def _library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=pieces.default_model())


ODD_TEXTS = [
    "", None, " ", "  a", "a" * 3000, "ab" * 2000, " " * 3000 + "the", "▁" * 100, "a b▁", "x\n\ty", "\0a", "中文字的一" * 300, "\U0001F600é" * 50,
    *(" " * k + "the " * 2 for k in (1, 15, 16, 17, 31, 32, 33, 47, 48, 49, 50, 64, 65)),
]


def test_pieces_equal_the_library():
    lib, rng = _library(), random.Random(3)
    sets = ["ab", "abc ", "the quick brown fox ", " \n\t", "▁ a", "中文字的一", "éàü ", "0123456789", "()[]{};= \n", "\0\x01"]
    texts = ODD_TEXTS + ["".join(rng.choices("".join(rng.sample(sets, rng.randint(1, 4))), k=rng.choice([1, 5, 30, 200, 900]))) for _ in range(600)]
    m = pieces.load(pieces.default_model())
    flat, n = pieces.Encoder(m).encode(texts)
    for text, ids in zip(texts, np.split(flat, np.cumsum(n)[:-1])):
        assert ids.tolist() == lib.encode(text or "")
        assert pieces.decode(m, ids) == lib.decode(ids.tolist())


def test_pieces_decode_any_ids():
    lib, rng, m = _library(), random.Random(4), pieces.load(pieces.default_model())
    for _ in range(800):
        ids = [rng.randrange(0, 32000) if rng.random() < 0.5 else rng.randrange(0, 259) for _ in range(rng.randint(0, 10))]
        assert pieces.decode(m, np.array(ids, int)) == lib.decode(ids)


def test_pieces_of_odd_tables(spark):
    lib = _library()
    rows = [(i, t, "x", 1) for i, t in enumerate(ODD_TEXTS)] + [(None, "a b", "x", 1), (1, None, "x", 1), (1, None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 string, n_tokens int")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = sorted((r[0] is not None, r[0] or 0, len(i := lib.encode(r[1] or "")), sha(",".join(map(str, i))), sha(lib.decode(i))) for r in rows)
    assert want == sorted((r[0] is not None, r[0] or 0, *r[1:]) for r in pieces.digests(docs).collect())
    back = pieces.decode_ids(pieces.encode(docs))
    assert sorted((r[0] or 0, r[1]) for r in back.collect()) == sorted((r[0] or 0, (r[1] or "").replace("▁", " ")) for r in rows)
    assert pieces.digests(docs.limit(0)).collect() == []


def _cheapest(codes: str) -> tuple[int, str]:
    """Dynamic programming over whole (cost, letters) pairs, from the last row."""
    keeps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    nexts, never = (2, 2, 3, 2), (10**9, "")

    def inserts(v):
        for _ in range(3):
            v = [min(v[q], (v[nexts[q]][0] + 3, "I" + v[nexts[q]][1])) for q in range(4)]
        return v

    v = inserts([(0, ""), never, never, (0, "")])
    for c in reversed(codes):
        new = []
        for q in range(4):
            ways = [(v[q][0] + 4, "D" + v[q][1])]
            if c != "D":
                more = 3 if c.isupper() else 0
                if (q, c.lower()) in keeps:
                    to = v[keeps[q, c.lower()]]
                    ways.append((to[0] + more, "K" + to[1]))
                ways.append((v[nexts[q]][0] + 3 + more, "R" + v[nexts[q]][1]))
            new.append(min(ways))
        v = inserts(new)
    return v[0]


def test_auction_finds_the_least_of_the_cheapest_edits():
    rng, solver = random.Random(1), dialogue.Solver()
    for _ in range(1500):
        codes = "".join(rng.choices(rng.choice(["DsuaoSUAO", "uaD", "ua", "uuaaS", "sD", "o"]), k=rng.choice([0, 1, 2, 3, 5, 15, 16, 17, 40, 200])))
        assert solver(codes) == _cheapest(codes)


def _repaired(rows, extra):
    """Plain version of the whole repair, row by row."""
    groups = {c: [] for c in extra}
    for c, t, r, x in rows:
        groups.setdefault(c, []).append((t, r if r is not None else " ", x if x is not None else " "))
    space, out = " \t\n\v\f\r", {}
    for c, g in groups.items():
        h = lambda r, x: hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest()
        g.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], h(*t[1:])))
        seen, codes, counts = set(), "", {"B": 0, "C": 0, "T": 0}
        for _, r, x in g:
            kept = x.strip(space)
            if not kept:
                codes, counts["B"] = codes + "D", counts["B"] + 1
            elif (r, x) in seen:
                codes, counts["C"] = codes + "D", counts["C"] + 1
            else:
                letter = r[:1] if r[:1] in ("s", "u", "a") else "o"
                if kept[-1] not in ".!?":
                    letter, counts["T"] = letter.upper(), counts["T"] + 1
                codes += letter
            seen.add((r, x))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(g, g[1:]))
        turns = {t[0] for t in g if t[0] is not None}
        cost, audit = _cheapest(codes)
        lines, state, at = [], 0, 0
        for letter in audit:
            row = None
            if letter != "I":
                row, at = g[at], at + 1
            if letter == "D":
                continue
            if letter == "K":
                role, text = row[1], row[2]
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            else:
                state = 3 if state == 2 else 2
                role, text = ("user", "assistant")[state - 2], row[2] if row else ""
            lines.append(f"{role}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[c] = (gaps, counts["B"], counts["C"], counts["T"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_repair_of_odd_conversations(spark):
    rng = random.Random(7)
    roles, texts = ["system", "user", "assistant", "tool", None, "", "s"], ["Hi.", "ok", "", None, "What?  \n", " ", "Yes!", "é中.", "x" * 5000 + "."]
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, 0, 1, 2, 5, 9]), rng.choice(roles), rng.choice(texts)) for _ in range(120)]
    rows += [(9, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(300)] + [(8, 0, "user", "Hi.")] * 5 + [(7, None, "user", "Hi.")]
    table = spark.createDataFrame([(*r, "x", 5) for r in rows], "conv_id long, turn long, role string, text string, code string, first int")
    more = spark.createDataFrame([(77,), (1,), (None,)], "conv_id long")
    got = dialogue.repaired(table, more).collect()
    want = _repaired(rows, [77, 1, None])
    assert len(got) == len(want)
    assert {r.conv_id: tuple(r)[1:] for r in got} == want
    assert dialogue.repaired(table.limit(0)).collect() == []
    assert dialogue.damage(table.limit(0)).collect() == []


def test_damage_by_crc(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two! Three? 4") for c in (None, 1, 2) for t in (None, *range(40))]
    got = dialogue.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if k == 1 else "One Two Three 4" if k == 2 else x
        want += [(c, t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    key = lambda r: (r[0] or 0, r[1] is not None, r[1] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def _codes(rows, parts, entries):
    """Plain version with Python integers."""
    kept = [(i, v, lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    dim = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dim]
    width = -(-dim // parts)
    exact = lambda x: int(x) * 256 if abs(x) > 2**60 else math.floor(256 * x)
    vecs = [[exact(x) for x in v] + [0] * (parts * width - dim) for _, v, _ in kept]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in vecs]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(2):
        for p in range(parts):
            owner = [near(c[p], books[p])[1] for c in cut]
            for k in range(len(books[p])):
                own = [c[p] for c, o in zip(cut, owner) if o == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    best = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in b) for b in best]
    by = {}
    for (_, _, lab), e in zip(kept, error):
        by[lab] = by.get(lab, 0) + e
    fits = lambda e: e if e < 1 << 63 else None
    return [(r[0], "".join(f"{k:02x}" for _, k in b), fits(e), fits(by[r[2]]), sha) for r, b, e in zip(kept, best, error)]


@pytest.mark.parametrize(("kind", "scale", "dim", "parts", "entries"), [("float", 1.0, 32, 4, 64), ("float", 1.0, 10, 4, 20), ("double", 1e9, 8, 4, 30), ("double", 1e300, 4, 2, 8), ("float", 0.02, 16, 16, 64)])
def test_codes_equal_plain_version(spark, kind, scale, dim, parts, entries):
    rng = np.random.default_rng(dim)
    rows = [(int(i), [float(np.float32(x) if kind == "float" else x) for x in rng.normal(size=dim) * scale], int(i) % 3 if i % 5 else None) for i in rng.permutation(200)]
    rows += [rows[0], rows[1], (None, rows[2][1], 1), (900, None, 1), (901, [], 1), (902, [None] * dim, 1), (903, [math.inf] * dim, 1), (904, [math.nan] * dim, None), (905, [1.0], 2), (906, [0.0] * dim, 2)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id long, embedding array<{kind}>, label int, code string, error long")
    got = sorted(map(tuple, gnat.compress(table, parts, entries).collect()), key=repr)
    assert got == sorted(_codes(rows, parts, entries), key=repr)


def test_codes_of_few_or_no_rows(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted(map(tuple, gnat.compress(table, 2, 64).collect())) == sorted(_codes([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], 2, 64))
    assert gnat.compress(table.limit(0)).collect() == []
    assert gnat.compress(table.where("vec_id > 5").withColumn("embedding", F.lit(None).cast("array<float>"))).collect() == []


def test_tree_equals_all_comparisons():
    rng = np.random.default_rng(2)
    for n, spread in ((1, 3), (13, 2), (64, 3), (64, 200), (250, 5)):
        entries, x = rng.integers(-spread, spread, (n, 3)).astype(float), rng.integers(-spread, spread, (500, 3)).astype(float)
        at, best = gnat.Gnat(entries).nearest(x)
        every = ((x[:, None] - entries[None]) ** 2).sum(2)
        assert (at == every.argmin(1)).all() and (best == every.min(1)).all()
