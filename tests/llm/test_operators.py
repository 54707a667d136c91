"""Training-data operators on small tables: brute force, round trips, and awkward rows."""

import gzip
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareline.llm import ann, chat, decontam, html, linedup, minhash, mixing, tokens, toxicity, warc
from fareline.llm.common import ascii_words, components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew strange potions near old stone bridges every night".split()


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j % 7}" for i, j in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 500, n)))


def docs_of(spark, texts, ids=None, sources=None):
    ids = ids if ids is not None else range(len(texts))
    sources = sources or ["s"] * len(texts)
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in zip(ids, texts, sources)], DOCS)


def awkward(spark):
    """Null id, null text, empty and blank text, repeated rows, one very long text, a clashing column."""
    long = prose(1, 30_000)
    df = docs_of(spark, [None, "", " \n\t", "one", "one", long, long, "x y z"], [1, 2, 3, 4, 4, 5, None, None], [None, "a", "a", "b", "b", "a", None, "a"])
    return df.withColumn("th", F.lit(1)).withColumn("node", F.lit("n")).withColumn("size", F.lit(0)).withColumn("rk", F.lit(0))


def empty(spark):
    return docs_of(spark, ["x"]).where("false")


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 160)} == {100}


def jaccard_components(texts, words, threshold):
    sets = []
    for t in texts:
        w = ascii_words(t)
        m = min(words, len(w))
        sets.append({tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if w else set())
    root = list(range(len(texts)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 100 * threshold * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("words", [2, 5])
def test_minhash_equals_all_pairs(spark, words):
    rng, texts = np.random.default_rng(5), []
    for family in range(6):
        base = prose(family, int(rng.integers(8, 160))).split()
        texts += [" ".join(base)] * 2
        for _ in range(14):
            edit = list(base)
            for k in rng.integers(0, len(base), int(rng.integers(0, max(1, len(base) // 12)) + 1)):
                edit[k] = f"new{rng.integers(0, 9999)}"
            texts.append(" ".join(edit))
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs_of(spark, texts), words, 0.8).collect()}
    comp, sizes = jaccard_components(texts, words, 0.8)
    assert [got[i]["component_id"] for i in range(len(texts))] == comp
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.values())


def test_minhash_estimate_is_near_the_truth():
    a = minhash.shingle_set(prose(1, 2000), 2)
    for share in (0.2, 0.5, 0.8):
        cut = int(len(a) * share)
        b = np.unique(np.concatenate([a[:cut], minhash.shingle_set(prose(9, 2000), 2)[: len(a) - cut]]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        est = minhash.estimate(minhash.registers(a)[None], minhash.registers(b)[None], np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(est - true) < minhash.margin(0.5)


def test_minhash_loses_no_link_of_small_sets(spark):
    """Pairs exactly at the threshold, by sets of few words: 4 of 5, 8 of 10, 16 of 20, 40 of 50 shingles."""
    rng, texts, want = random.Random(6), [], []
    for small, large in ((4, 5), (8, 10), (16, 20), (40, 50)):
        for _ in range(125):
            words = [f"w{rng.randrange(10**9)}" for _ in range(large + 1)]
            want += [len(texts)] * 2
            texts += [" ".join(words), " ".join(words[: small + 1])]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_of(spark, texts), 2, 0.8).collect()}
    ids = sorted(got)
    assert [got[i] for i in ids] == [ids[k] for k in want]


def test_minhash_groups_below_the_threshold(spark):
    """Groups whose members share much but not enough, next to groups of true copies and subgroups."""
    rng, word = random.Random(3), lambda: f"w{rng.randrange(30000)}"
    new = lambda n: [word() for _ in range(n)]

    def edit(words, k):
        words = list(words)
        for _ in range(k):
            words[rng.randrange(len(words))] = word()
        return words

    texts, base = [], new(200)
    texts += [edit(base, 11) for _ in range(70)]
    base = new(300)
    texts += [edit(base, 9) for _ in range(60)]
    base = new(100)
    for _ in range(4):
        part = base + new(60)
        texts += [edit(part, rng.choice([3, 5, 7])) for _ in range(25)]
    texts = [" ".join(t) for t in texts]
    assert_components(spark, texts, 2)


def test_minhash_bits_lose_no_pair_of_a_group():
    """Sets of 3 to 700 elements, many of them near the threshold: whatever the blocks, all linked pairs are left."""
    rng, sets = np.random.default_rng(8), []
    for size in (3, 20, 60, 63, 66, 130, 500, 700):
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        for _ in range(40):
            gone = int(rng.integers(0, size // 5 + 1))
            sets.append(np.unique(np.r_[base[rng.permutation(size)[gone:]], rng.integers(0, 1 << 63, int(rng.integers(0, size // 5 + 1)), dtype=np.uint64)]))
    n, comp, bits = np.array([len(s) for s in sets]), np.arange(len(sets)) // 2, [minhash.parity_bits(s) for s in sets]
    shared = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    linked = (100 * shared >= 80 * (n[:, None] + n[None] - shared)) & (comp[:, None] != comp[None])
    for blocks in (1, 2):
        block = rng.integers(0, blocks, len(sets))
        i, j = minhash.within_reach(n, comp, bits, block, 0.8)
        got = {(min(a, b), max(a, b)) for a, b in zip(i.tolist(), j.tolist())}
        want = {(a, b) for a, b in zip(*(x.tolist() for x in np.nonzero(linked))) if a < b and (blocks == 1 or block[a] != block[b])}
        assert want <= got and len(got) < 1.2 * len(want)


def test_minhash_blocks_of_a_group(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    test_minhash_groups_below_the_threshold(spark)


def test_minhash_steps_do_not_grow_with_a_group(spark, monkeypatch):
    """Copies that are just not near enough take no rounds of their own, however many there are."""
    made, store = [], minhash.store

    def counted(df, label):
        made.append(label)
        return store(df, label)

    monkeypatch.setattr(minhash, "store", counted)
    steps = []
    for size in (2, 90):
        rng, texts = random.Random(4), []
        base = [f"w{rng.randrange(30000)}" for _ in range(200)]
        for _ in range(size):
            words = list(base)
            for _ in range(13):
                words[rng.randrange(200)] = f"w{rng.randrange(30000)}"
            texts.append(" ".join(words))
        made.clear()
        minhash.near_duplicates(docs_of(spark, texts), 2, 0.8)
        steps.append(list(made))
    assert steps[0] == steps[1]


def assert_components(spark, texts, words):
    sets = [frozenset(minhash.shingle_set(t, words).tolist()) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs_of(spark, texts), words, 0.8).collect()}
    ids = sorted(got)
    assert [got[i] for i in ids] == [ids[find(k)] for k in range(len(texts))]


def test_minhash_awkward_rows(spark):
    rows = minhash.near_duplicates(awkward(spark), 2, 0.8).collect()
    got = sorted((r["doc_id"] or -1, r["n_shingles"] > 0, r["component_id"] or -1) for r in rows)
    assert got == [(-1, True, -1), (-1, True, 5), (1, False, 1), (2, False, 2), (3, False, 3), (4, True, 4), (4, True, 4), (5, True, 5)]
    kept = minhash.drop_near_duplicates(awkward(spark), 2, 0.8)
    assert kept.columns == awkward(spark).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "None"]
    assert minhash.near_duplicates(empty(spark)).count() == 0


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if x == y else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_equals_the_full_table():
    rng = np.random.default_rng(2)
    for _ in range(40):
        a, b = rng.integers(0, 5, rng.integers(1, 25)), rng.integers(0, 5, rng.integers(1, 40))
        assert decontam.align(a, b)[0] == smith_waterman(a, b)


def test_decontamination_equals_all_pairs(spark):
    rng = np.random.default_rng(4)
    items = [prose(100 + i, int(rng.integers(2, 50))) for i in range(12)]
    texts = []
    for i, item in enumerate(items):
        w = item.split()
        edited = [x if rng.random() > 0.15 else "edit" for x in w]
        texts += [prose(i, 200) + " " + item + ", " + prose(i + 50, 90), prose(i, 30) + " " + " ".join(edited).upper(), prose(i + 70, 120), " ".join(w[: len(w) // 3])]
    items_df = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): round(r["score"], 9) for r in decontam.contaminated(docs_of(spark, texts), items_df).collect()}
    want = {}
    for d, t in enumerate(texts):
        for k, x in enumerate(items):
            a, b = decontam.plain_words(x), decontam.plain_words(t)
            runs = {tuple(a[i : i + 3]) for i in range(len(a) - 2)} or {tuple(a)}
            n = min(3, len(a))
            if runs & {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} and (s := smith_waterman(a, b) / (2 * len(a))) >= 0.5:
                want[d, k] = round(s, 9)
    assert got == want and len(want) >= 20


def test_decontamination_finds_a_passage_that_floods_the_corpus(spark):
    item = prose(7, 40)
    items = spark.createDataFrame([(1, item), (2, None), (None, "")], "item_id long, text string")
    got = decontam.contaminated(docs_of(spark, [prose(i, 20) + " " + item for i in range(60)]), items)
    assert got.where("item_id = 1").count() == 60
    assert decontam.decontaminate(awkward(spark), items).count() == 8
    assert decontam.contaminated(empty(spark), items).count() == 0
    assert decontam.contaminated(awkward(spark), items.where("false")).count() == 0


def test_toxicity_learns_held_out_words_and_prefixes(spark):
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for i in range(240):
        w = prose(i, int(rng.integers(10, 120))).split()
        y = int(i % 3 == 0)
        if y:
            for k in rng.integers(0, len(w), 3):
                w[k] = rng.choice(["idiot", "scum", f"vequ{rng.integers(0, 99999)}"])
        texts.append(" ".join(w))
        labels.append(y)
    docs = docs_of(spark, texts)
    known = spark.createDataFrame(list(zip(range(240), labels)), "doc_id long, toxic int")
    net = toxicity.fit(docs, known, steps=150)
    rows = toxicity.score(docs, net).where("held_out").collect()
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in rows)
    assert len(rows) > 40 and right >= 0.9 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in toxicity.score(docs, net).collect())
    odd = toxicity.score(awkward(spark), net).collect()
    assert len(odd) == 8 and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score(empty(spark), net).count() == 0
    assert {r["score"] for r in toxicity.score(awkward(spark), toxicity.fit(docs, known.where("toxic = 0"))).collect()} == {0.0}


def test_toxicity_gradient_matches_differences():
    net, rng = toxicity.Net(1), np.random.default_rng(0)
    words = [b"alpha", b"beta", b"gamma", b"delta"]
    slots = net.inputs(words)
    at, _ = toxicity.windows_of([rng.integers(0, 4, 30), rng.integers(0, 4, 5)], 4)

    def loss():
        x = net.embed(slots)
        return net.forward(net.project(x), at).astype(np.float64).sum()

    x = net.embed(slots)
    proj = net.project(x)
    _, kept = net.forward(proj, at, keep=True)
    grads = net.backward(proj, kept, np.ones(len(at), np.float32), x, slots)
    for k in ("Wf", "Ub", "A", "v", "o", "cf"):
        p = net.p[k].reshape(-1)
        for i in rng.integers(0, len(p), 4):
            old = p[i]
            p[i] = old + 1e-2
            up = loss()
            p[i] = old - 1e-2
            down = loss()
            p[i] = old
            assert abs((up - down) / 2e-2 - grads[k].reshape(-1)[i]) < 2e-2 + 0.05 * abs(grads[k].reshape(-1)[i])


def test_every_window_of_a_text_is_scored():
    for n in range(1, 200):
        s = toxicity.window_starts(n)
        assert set(np.concatenate([np.arange(a, min(n, a + toxicity.WINDOW)) for a in s])) == set(range(n))


PAGES = "page_id long, url string, html string"


def test_warc_round_trip_and_rolling(spark, tmp_path):
    body = "<p>" + "é" * 200 + "</p>"
    rows = [(3, "http://a/ b\r\nX: 1", body), (9, None, body), (5, "u", "small"), (6, "u", "small"), (7, "u", None), (9, None, body), (None, "n", body), (None, "n", "only null " * 20)]
    uri = str(tmp_path / "w")
    manifest = warc.write_warc(spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("x")), uri, roll_bytes=1)
    assert manifest.count() == len(rows) and not list((tmp_path / "w").glob(".tmp-*"))
    got = warc.read_warc(manifest, uri, payload=True).collect()
    key = sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got)
    n = len(body.encode())
    assert key == sorted([("3", n, "response", None), ("9", n, "revisit", 3), ("9", n, "revisit", 3), ("5", 5, "response", None), ("6", 5, "response", None), ("7", 0, "response", None), ("None", n, "revisit", 3), ("None", 200, "response", None)])
    assert {r["payload_digest"] for r in got if r["page_id"] == 9} == {hashlib.sha256(body.encode()).hexdigest()}
    assert [r["payload"] for r in got if r["page_id"] == 3] == [body.encode()]
    first = {p.name: p.read_bytes() for p in (tmp_path / "w").glob("*.gz")}
    again = str(tmp_path / "again")
    warc.write_warc(spark.createDataFrame(rows, PAGES), again, roll_bytes=1).collect()
    assert first == {p.name: p.read_bytes() for p in (tmp_path / "again").glob("*.gz")}
    assert all(b"WARC/1.1\r\n" in gzip.decompress(x) for x in first.values())
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_warc_reader_refuses_damage(spark, tmp_path):
    uri = str(tmp_path / "w")
    warc.write_warc(spark.createDataFrame([(1, "u", "hello " * 50)], PAGES), uri).collect()
    path = next((tmp_path / "w").glob("*.gz"))
    good = b"".join(gzip.decompress(path.read_bytes()).partition(b"hello")[i] for i in range(3))
    path.write_bytes(gzip.compress(good.split(b"WARC/1.1")[0] + b"WARC/1.1" + good.split(b"WARC/1.1")[2].replace(b"hello", b"hallo", 1)))
    with pytest.raises(ValueError):
        list(warc.records(uri, path.name))


def test_chat_escape_and_masks(spark):
    nasty = ["", "\\", "<|turn|>", "\\<|end|>\\", "a<", "|b", "<\\|body|>", "é\n\n  ", "\\### Assistant: </turn> ok"]
    assert [chat.unescape(chat.escape(t)) for t in nasty] == nasty
    rows = [(c, i, ["user", "assistant", "assistant", "<|body|>", None][(c + i) % 5], nasty[(c * i + c) % len(nasty)]) for c in range(6) for i in range(9)]
    rows += [(50, None, "assistant", None), (None, 1, "assistant", "null id"), (60, 1, "assistant", "same"), (60, 1, "assistant", "same"), (70, 0, "assistant", prose(3, 20_000))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(df)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        loss = "".join(x[3] for x in own if x[2] == "assistant")
        whole = "".join(f"{x[2]}\n{x[3]}\n" for x in own)
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(own), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.format_conversations(df.where("false"))).count() == 0


def test_repair_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for seq in (np.zeros(0, np.uint32), np.array([5], np.uint32), np.full(999, 7, np.uint32), rng.integers(0, 9, 5000).astype(np.uint32), np.zeros(50, np.uint32)):
        small, rules = tokens.repair(seq, 100, 1000, least=4)
        assert np.array_equal(tokens.expand(small, rules, 100), seq)
        if len(seq) == 5000:
            assert len(small) < 4000 and not (rules == 0).any()
            assert all(len(tokens.expand(np.array([100 + k]), rules, 100)) == n for k, n in enumerate(tokens.expansion_lengths(rules, 100)))
    docs = [rng.integers(1, 12, n) for n in (0, 40, 1, 3000)]
    ids = np.concatenate([np.r_[d, 0] for d in docs]).astype(np.uint32)
    f = tokens.TokenFile(tokens.pack(ids, np.array([len(d) + 1 for d in docs]), [4, None, 0, -3], 100))
    assert f.doc_ids == [4, None, 0, -3]
    assert all(np.array_equal(f.document(i), np.r_[d, 0]) for i, d in enumerate(docs))


def test_encoder_equals_the_library(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.default_tokenizer())
    tok.encode_special_tokens = True
    odd = ["", " ", "a", " a", "a ", "a  b", "a\nb", "a.\nB, c. d", "\n", "\n\na\n \nb", "it's we'll x_. a², b", "tab\there", "nul\0l", "nb sp", "wide　x", "́a. é, z", "<|endoftext|> x", "1. 2, 3.14", "日本 語。", "end.", "...", ". , .", "a. b" * 40, "\x01 \x00", "x.\n\ny", "😀 😀, a"]
    rng = np.random.default_rng(3)
    odd += ["".join(rng.choice(list("ab. ,\n\t'é9_"), 60)) for _ in range(200)]
    enc = tokens.Encoder(tokens.default_tokenizer())
    for part in (odd[:10], odd[10:], odd):
        ids, n = enc.encode(part)
        want = [[*tok.encode(t, add_special_tokens=False).ids, 0] for t in part]
        assert n.tolist() == [len(w) for w in want] and ids.tolist() == [x for w in want for x in w]


class _Counted:
    """A tokenizer that counts the characters of whole batches."""

    def __init__(self, tok):
        self.tok, self.chars = tok, 0

    def encode_batch_fast(self, texts, **options):
        self.chars += sum(map(len, texts))
        return self.tok.encode_batch_fast(texts, **options)

    def __getattr__(self, name):
        return getattr(self.tok, name)


def test_encoder_asks_the_library_once_for_a_word():
    enc = tokens.Encoder(tokens.default_tokenizer())
    plain = enc.tok
    enc.tok = _Counted(plain)
    enc.encode(["x. alpha, beta gamma"])
    before = enc.tok.chars
    enc.encode(["x alpha beta! gamma... alpha?\nx"])
    assert enc.tok.chars == before
    enc.MOST = 40
    for k in range(20):  # rare words come and go, common ones stay
        text = " ".join(["x alpha beta gamma", *(f"w{k}q{j}" for j in range(30))])
        ids, n = enc.encode([text])
        assert ids.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 0] and n.tolist() == [len(ids)]
        assert len(enc.index) <= 40 + 35
    before = enc.tok.chars
    enc.encode(["x alpha beta gamma"])
    assert enc.tok.chars == before


def test_token_files_end_with_the_text_that_fills_them(spark):
    docs = spark.range(0, 1000, 1, 1).selectExpr("id AS doc_id", "concat('a b c ', id) AS text")
    uri = tokens.scratch(spark, "op6-small-files")
    manifest = tokens.write_tokens(docs, uri, file_ids=200)
    files = manifest.orderBy("start").collect()
    assert max(f["ids"] for f in files) < 200 + 20 and len(files) > 1000 * 5 // 220
    assert sum(f["docs"] for f in files) == 1000 and all(b["start"] == a["start"] + a["ids"] for a, b in zip(files, files[1:]))
    assert [r["doc_id"] for r in tokens.read_tokens(manifest, uri).orderBy("start").collect()] == list(range(1000))


def test_expansion_of_long_rules():
    seq = np.r_[np.full(1 << 14, 7), np.tile(np.random.default_rng(2).integers(1, 90, 700), 40)].astype(np.uint32)
    small, rules = tokens.repair(seq, 100, 5000)
    wide = tokens.expansion_lengths(rules, 100)
    assert wide.max() > tokens.SHORT_RULE and np.array_equal(tokens.expand_many(small, rules, wide, 100), seq)
    small, rules = tokens.repair(seq, 100, 1 << 20)  # symbols of more than 16 bits
    assert np.array_equal(tokens.expand(small, rules, 100), seq)


def test_token_files_of_awkward_rows(spark):
    rows = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokens.round_trip(awkward(spark)).collect()), key=lambda r: r[2])
    assert len(rows) == 8 and [r[:2] for r in rows] == sorted(r[:2] for r in rows)
    assert all(b[2] == a[2] + a[3] for a, b in zip(rows, rows[1:]))
    assert [r[3:] for r in rows if r[1] == 2] == [(1, zlib.crc32(bytes(4)))]
    assert tokens.round_trip(empty(spark)).count() == 0


def test_main_text():
    page = (
        "<html><head><title>t</title><style>x{}</style></head><body><header>Top of the page and of the site</header><nav><a href=/>Home</a></nav>"
        "<div class='cookie-notice'>We use the cookies and that is it for you to know and to accept.</div>"
        "<article><h1>A &amp; B</h1><p>The  first\nof the two is in the text that we are to read for the test of it.</p><p>short</p>"
        "<form><p>the name of the one</p></form><aside>of the side and the bar</aside><div id=comments><p>The comment of a reader is not in the text that we want.</p></div>"
        "<ul><li><a href=x>link one</a></li></ul><p>last &#233; &lt;b&gt;</p></article><script>var x = '<p>no</p>'</script><footer>&copy; of the site</footer></body></html>"
    )
    assert html.main_text(page) == "A & B The first of the two is in the text that we are to read for the test of it. short last é <b>"
    plain = "<body><p>The text of a page without an article is in the blocks that are long and in the words of it.</p><p>near</p><div>Xqz wvut prst</div><ul><li><a href=a>one</a><li><a href=b>two</a></ul></body>"
    assert html.main_text(plain).startswith("The text of a page") and "one" not in html.main_text(plain)
    assert html.main_text(None) == html.main_text("") == html.main_text("<p") == html.main_text("<!-- x") == ""
    assert html.main_text("<article><p>cut of") == "cut of"
    assert html.main_text("<article><p title='a>b'>x</p></article>") == "x"


def test_second_pass_takes_the_nearest_neighbour():
    assert html.second_pass([True, None, None, None, False], False) == [True, True, True, False, False]
    assert html.second_pass([None, None], True) == [True, True] and html.second_pass([None], False) == [False]


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, "u", None), (None, None, "<p>" + "of the day and in it " * 30), (2, "u", "x" * 300_000), (2, "u", "x" * 300_000)], PAGES).withColumn("text", F.lit("clash"))
    rows = html.extract(df).collect()
    assert len(rows) == 4 and [r["text"] for r in rows if r["page_id"] == 1] == [""]
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert html.extract(df.where("false")).count() == 0


def test_nearest_by_blocks_is_exact_and_forest_recall_is_high(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((40, 16))
    x = centres[rng.integers(0, 40, 3000)] + 0.35 * rng.standard_normal((3000, 16))
    x *= rng.uniform(0.8, 1.2, (3000, 1))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    for enough, least in ((10**9, 1.0), (600, 0.9)):
        got = ann.nearest(df, F.col("id") % 50 == 0, 10, enough=enough).collect()
        hits = 0
        for q in range(0, 3000, 50):
            own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
            assert [r[0] for r in own] == list(range(1, 11)) and all(abs(r[2] - score[q, r[1]]) < 1e-9 for r in own)
            hits += len({r[1] for r in own} & set(np.argsort(-score[q])[:10]))
        assert hits >= least * 600


def test_nearest_leaves_out_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [0.5, 0.5]), (7, [0.5, 0.5]), (8, [1.0, 1.0, 1.0]), (0, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rid", F.lit(1))
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(df, F.col("id") % 20 == 0, 20).collect())
    assert got == [(0, 1, 0, 1.0)] * 2 + [(0, 2, 6, 0.5)] * 2 + [(0, 3, 7, 0.5)] * 2
    assert ann.nearest(df.where("false"), F.col("id") % 20 == 0, 20).count() == 0


def sainte_lague(votes, seats):
    won = [0] * len(votes)
    for _ in range(seats):
        i = max(range(len(votes)), key=lambda k: (votes[k] / (2 * won[k] + 1), -k))
        won[i] += 1
    return won


@pytest.mark.parametrize("seed", range(3))
def test_apportionment_equals_seat_by_seat(spark, seed):
    rng = np.random.default_rng(seed)
    votes = [float(v) for v in (rng.pareto(1.1, 30) * 100 + 1).round()]
    for seats in (1, 17, 400):
        df = spark.createDataFrame([(i, v, seats) for i, v in enumerate(votes)], "sid long, target double, seats long")
        got = {r["sid"]: r["quota"] for r in mixing.apportion(df, [], "sid", "target", "seats").collect()}
        assert [got[i] for i in range(30)] == sainte_lague(votes, seats)


def test_mixing_targets_and_limits(spark):
    texts = [prose(i, 5 + i % 60) for i in range(400)]
    sources = [["a", "b", None, "c", "d"][min(4, i % 9)] for i in range(400)]
    df = docs_of(spark, texts, None, sources)
    rows = mixing.mix(mixing.sized(df).select("doc_id", "source", "size", "rk"), cell_docs=64).collect()
    by, total = {}, sum(r["size"] for r in rows)
    for r in rows:
        x = by.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        x[0] += r["taken"]
        x[1] += r["size"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["size"] == len(texts[r["doc_id"]].split())
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    target, open_ = {}, set(by)
    while True:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * by[s][1]}
        if not over:
            target |= share
            break
        target |= {s: 3.0 * by[s][1] for s in over}
        open_ -= over
    for s, (taken, size, t, source_size) in by.items():
        assert abs(t - target[s]) < 1e-6 and size == source_size
        assert abs(taken - t) <= 64 * 8
    again = mixing.mix(mixing.sized(df.repartition(7)).select("doc_id", "source", "size", "rk"), cell_docs=64).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mixing_awkward_rows(spark):
    df = awkward(spark)
    sized = df.select("doc_id", "source", mixing.words("text").alias("size"), mixing.order_key(9).alias("rk"))
    rows = mixing.mix(sized).collect()
    assert len(rows) == 8 and all(r["taken"] <= 3 * r["size"] for r in rows)
    out = mixing.mix_documents(df)
    assert out.columns == df.columns and all(r["text"] for r in out.collect())
    assert mixing.mix_documents(empty(spark)).count() == 0


def brute_lines(texts, least):
    first, gone = {}, set()
    for d, t in enumerate(texts):
        own = [(i, s.strip()) for i, s in enumerate((t or "").split("\n")) if s.strip()]
        for a in range(len(own)):
            for b in range(a, len(own)):
                if sum(len(s.split()) for _, s in own[a : b + 1]) >= least:
                    key = tuple(s for _, s in own[a : b + 1])
                    if first.setdefault(key, (d, a)) != (d, a):
                        gone |= {(d, i) for i, _ in own[a : b + 1]}
    return gone


def test_line_dedup_equals_all_runs(spark):
    rng = np.random.default_rng(6)
    pool = [prose(i, int(n)) for i, n in enumerate(rng.integers(1, 12, 14))] + [""]
    texts = ["\n".join(pool[k] for k in rng.integers(0, len(pool), rng.integers(0, 14))) for _ in range(60)]
    texts += [texts[5], None, "", "\n".join([pool[0]] * 30)]
    rows = linedup.repeated_runs(docs_of(spark, texts).withColumn("rid", F.monotonically_increasing_id()), 12).collect()
    got = set()
    for r in rows:
        own = [i for i, s in enumerate(texts[r["doc_id"]].split("\n")) if s.strip()]
        at = own.index(r["start_line"])
        got |= {(r["doc_id"], i) for i in own[at : at + r["n_lines"]]}
    want = brute_lines(texts, 12)
    assert got == want and len(want) > 50
    cleaned = {r["doc_id"]: r["text"] for r in linedup.dedup_lines(docs_of(spark, texts), 12).collect()}
    for d, t in enumerate(texts):
        keep = None if t is None else "\n".join(s for i, s in enumerate(t.split("\n")) if (d, i) not in want)
        assert cleaned[d] == keep


def test_line_dedup_awkward_rows(spark):
    out = linedup.dedup_lines(awkward(spark).withColumn("rid", F.lit(1)), 50).collect()
    assert len(out) == 8 and sum(r["text"] is not None and len(r["text"]) > 1000 for r in out) == 1
    assert linedup.dedup_lines(empty(spark)).count() == 0
