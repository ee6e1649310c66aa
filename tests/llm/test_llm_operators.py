"""Operators against brute force, other libraries, exact round trips and held-out accuracy."""

import collections
import hashlib
import math
import os
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import edge_rows, is_held_out, words

from seqlake.llm import op01_bpe, op02_minhash, op03_chat, op04_packing, op05_warc, op06_toxicity, op07_substring, op08_topk, op09_language, op10_fingerprint
from seqlake.llm.common import slices
from seqlake.llm.components import components
from seqlake.llm.op01_bpe import default_vocabulary


@pytest.fixture(scope="module")
def tokens():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_vocabulary())


# -- op1, op4 ---------------------------------------------------------------------
CODER = []


def coder():
    if not CODER:
        CODER.append(op01_bpe.Encoder(default_vocabulary()))
    return CODER[0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.text("aab thers'\n \t09é日…!", max_size=40), st.just("<|endoftext|>")), max_size=4).map("".join))
def test_bpe_equals_tokenizers(text):
    from tokenizers import Tokenizer
    if len(CODER) < 2:
        coder()
        CODER.append(Tokenizer.from_file(default_vocabulary()))
    want = CODER[1].encode(text, add_special_tokens=False).ids
    n, ids = next(coder().encode_batch([text]))
    assert (n, ids) == (len(want), ",".join(map(str, want)))
    assert coder().decode(ids) == CODER[1].decode(want, skip_special_tokens=False) == text
    packed = op04_packing.tokenizer(default_vocabulary())
    assert packed.encode_to_numpy(text, allowed_special=set(packed.special_tokens_set), disallowed_special=()).tolist() == want


def test_bpe_cache_starts_anew(monkeypatch, tokens):
    monkeypatch.setattr(op01_bpe, "CACHE_WORDS", 20)
    enc = op01_bpe.Encoder(default_vocabulary())
    for k in range(20):
        text = words(k % 7, 15, 30)
        assert next(enc.encode_batch([text]))[1] == ",".join(map(str, tokens.encode(text, add_special_tokens=False).ids))


def test_bpe_encode_decode_frames(spark, edge, tokens):
    coded = op01_bpe.encode(edge, default_vocabulary())
    back = {(r["doc_id"], r["text"]) for r in op01_bpe.decode(coded, default_vocabulary()).collect()}
    assert back == {(r[0], r[1] or "") for r in edge_rows()}


def test_packing_pieces(spark, edge, tokens):
    pieces = op04_packing.pack(edge.where("doc_id < 9 or doc_id > 10"), default_vocabulary(), longest=64).collect()
    assert len({p["sequence_id"] for p in pieces}) == len(pieces)
    by_doc = {}
    for p in sorted(pieces, key=lambda p: p["sequence_id"]):
        assert p["length"] & (p["length"] - 1) == 0 and p["length"] <= 64 and p["offset"] == 0 and 2 ** p["bucket"] == p["length"]
        ids = np.frombuffer(bytes(p["ids"]), "<u4").tolist()
        assert len(ids) == p["length"]
        runs = by_doc.setdefault(p["doc_id"], [])
        if p["start"] == 0:
            runs.append([])
        assert len(runs[-1]) == p["start"]
        runs[-1] += ids
    for r in edge_rows():
        if r[0] is not None and r[0] not in (9, 10):
            want = tokens.encode(r[1] or "", add_special_tokens=False).ids + [1]
            assert want in by_doc[r[0]]


# -- op2 --------------------------------------------------------------------------
def near(text: str, seed: int, edits: int) -> str:
    r, w = random.Random(seed), text.split()
    for _ in range(edits):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return " ".join(w)


def brute_classes(rows: list[tuple], percent: int) -> dict:
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {b" ".join(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({b" ".join(w)} if w else set())
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("percent", [80, 85])
def test_minhash_classes_equal_brute_force(spark, percent, monkeypatch):
    monkeypatch.setattr(op02_minhash, "CHUNK", 4)          # many chunks, so that blocks meet
    base = [words(s, 150) for s in range(4)]
    rows = [(k, near(base[k % 4], k, 1 + k % 7)) for k in range(120)] + [(200 + k, words(900 + k, 3 + k)) for k in range(20)]
    rows += [(300, base[0]), (301, base[0].upper().replace(" ", "\n\t ")), (302, None), (303, " "), (304, "a b"), (305, "A  b"), (306, "a")]
    # a chain: neighbours are alike, the ends are not
    chain = words(77, 200).split()
    rows += [(400 + k, " ".join(chain[6 * k:150 + 6 * k])) for k in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in op02_minhash.classes_of(df, percent).collect()}
    assert got == brute_classes(rows, percent)


def test_minhash_edge_rows(spark, edge_dir):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in op02_minhash.op2_minhash(spark, edge_dir).collect()]
    assert got.count((6, 116, 6, True)) == 4 and (7, 116, 6, False) in got and (8, 117, 6, False) in got
    assert (None, 116, 6, None) in got and (0, 0, 0, True) in got and (2, 0, 2, True) in got and (3, 1, 3, True) in got


def test_min_and_max_are_unbiased():
    r = np.random.default_rng(3)
    a = np.unique(r.integers(1, 1 << 63, 400, dtype=np.uint64))
    b = np.concatenate([a[:300], np.unique(r.integers(1, 1 << 63, 100, dtype=np.uint64))])
    want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    hits = []
    for f, s in zip(op02_minhash._FACTOR, op02_minhash._SHIFT, strict=True):
        x, y = a * f + s, b * f + s
        hits += [x.min() == y.min(), x.max() == y.max()]
    assert abs(np.mean(hits) - want) < 0.17


def test_components(spark):
    r = random.Random(4)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5000, 2000 + k) for k in range(100)] + [(7, 7)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: find(n) for n in root}


# -- op3 --------------------------------------------------------------------------
def test_chat_round_trip(spark, edge_dir):
    turns = spark.read.parquet(f"{edge_dir}/conversations.parquet")
    chats = op03_chat.format_chats(turns)
    back = chats.select("conv_id", "formatted", "segments", op03_chat.parse(chats["formatted"]).alias("turns")).collect()
    source = {}
    for r in sorted(turns.collect(), key=lambda r: (r["turn"] is not None, r["turn"], r["role"] or "", r["text"] or "")):
        source.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    assert {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in back} == source
    for r in back:
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert r["formatted"].count(op03_chat.START) == r["formatted"].count(op03_chat.END) == len(r["turns"])
    plain = [r["formatted"] for r in back if r["conv_id"] == 3][0]
    assert plain == ("<|im_start|>assistant\n" + "z" * 200_000 + "<|im_end|>\n") * 2          # nothing to escape


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<", "|", "\\", "im_end", "im_start", ">", "\n", "a", "<|im_end|>", "<|im_start|>"]), max_size=8).map("".join), min_size=1, max_size=12))
def test_chat_escapes_are_reversible(spark, texts):
    df = spark.createDataFrame([(i, 0, t, t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    chats = op03_chat.format_chats(df)
    got = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in chats.select("conv_id", op03_chat.parse(chats["formatted"]).alias("t")).collect()}
    assert got == {i: [(t, t)] for i, t in enumerate(texts)}


def test_chat_plan_has_no_python(spark, edge_dir, capsys):
    op03_chat.op3_chat(spark, edge_dir).explain()
    assert not any(x in capsys.readouterr().out for x in ("Python", "Pandas", "Arrow"))


# -- op5 --------------------------------------------------------------------------
def test_warc_edge_pages(spark, edge_dir):
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in op05_warc.op5_warc(spark, edge_dir).collect()), key=str)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    a, odd = "a" * 150, "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "é" * 200
    want = [(1, 150, sha(a), "response", None), (2, 150, sha(a), "revisit", 1), (2, 150, sha(a), "revisit", 1), (3, 0, sha(""), "response", None),
            (4, 5, sha("short"), "response", None), (5, 5, sha("short"), "response", None), (6, len(odd.encode()), sha(odd), "response", None),
            (None, 150, sha(a), "revisit", 1)]
    assert got == sorted(want, key=str)


def test_warc_captures(spark, tmp):
    rows = [(k, f"http://h/{k}", f"<p>{k}</p>" * 30) for k in range(50)]
    path = f"{tmp}/warc"
    op05_warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), path)
    records = op05_warc.read_records(spark, path)
    assert {(r["type"], r["count"]) for r in records.groupBy("type").count().collect()} == {("request", 50), ("response", 50), ("metadata", 50)}
    caps = op05_warc.assemble(records).collect()
    assert {(c["uri"], bytes(c["payload"]).decode()) for c in caps} == {(u, h) for _, u, h in rows}
    assert all(c["request"]["http"].startswith("GET http://h/") and c["metadata"]["fields"].startswith("page-id: ") for c in caps)


# -- op6 --------------------------------------------------------------------------
def test_factorization_machine_learns_a_pair():
    """Two terms that are harmless alone and count together: no sum of weights can tell them."""
    r = np.random.default_rng(5)
    rows, labels = [], []
    for _ in range(3000):
        f = set(r.integers(100, 400, 6).tolist())
        a, b = r.random() < 0.5, r.random() < 0.5
        f |= {1} if a else set()
        f |= {2} if b else set()
        rows.append(np.array(sorted(f)))
        labels.append(float(a and b))
    m = op06_toxicity.train(rows[:2500], np.array(labels[:2500]))
    p = op06_toxicity.sigmoid(np.concatenate([m.logits(x, np.array([0, len(x)])) for x in rows[2500:]]))
    y = np.array(labels[2500:])
    assert ((p >= 0.5) == y).mean() > 0.95
    pair = sum(float(m.vector[1, f] * m.vector[2, f]) for f in range(op06_toxicity.FACTORS))
    assert abs(pair) > 0


@pytest.mark.parametrize("rule", ["exclusive or", "insult with a group"])
def test_factorization_machine_learns_neutral_terms(rule):
    """Every single term has the same share of toxic rows as all others; only pairs tell."""
    r = np.random.default_rng(9)
    rows, labels = [], []
    for _ in range(5000):
        f = set(r.integers(100, 400, 30).tolist())
        a, b = r.random() < 0.5, r.random() < 0.5
        f |= ({1} if a else set()) | ({2} if b else set())
        if rule == "exclusive or":
            y = a != b
        else:                                       # an insult is toxic with one group's name and not with the other's
            f |= {3} if (c := r.random() < 0.5) else {4}
            f |= {5} if a else {6}
            y = a == c
        rows.append(np.array(sorted(f)))
        labels.append(float(y))
    y = np.array(labels)
    for t in (1, 2):
        has = np.array([t in x for x in rows])
        assert abs(y[has].mean() - y.mean()) < 0.03
    m = op06_toxicity.train(rows[:4000], y[:4000])
    p = op06_toxicity.sigmoid(np.concatenate([m.logits(x, np.array([0, len(x)])) for x in rows[4000:]]))
    assert ((p >= 0.5) == y[4000:]).mean() > 0.95


def test_pair_counts_find_the_pair_only():
    """The matrix products equal counting by hand: of 60 features only the two that interact are found."""
    r = np.random.default_rng(10)
    rows = [np.flatnonzero(r.random(60) < 0.4) for _ in range(2500)]
    y = np.array([float((7 in x) != (41 in x)) for x in rows])
    assert op06_toxicity.pair_features(rows, y).tolist() == [7, 41]


def test_logits_equal_all_pairs():
    r = np.random.default_rng(6)
    w, v = np.zeros(op06_toxicity.BUCKETS, np.float32), np.zeros((op06_toxicity.BUCKETS, op06_toxicity.FACTORS), np.float32)
    w[:50], v[:50] = r.normal(size=50), r.normal(size=(50, op06_toxicity.FACTORS))
    x = np.array([3, 7, 11, 40, 400])
    m = op06_toxicity.Model(0.25, w, v)
    want = 0.25 + w[x].sum() + sum(float(v[i] @ v[j]) for k, i in enumerate(x) for j in x[k + 1:])
    assert np.allclose(m.logits(x, np.array([0, len(x)])), [want], atol=1e-4)


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = op06_toxicity.op6_toxicity(spark, sf).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    test = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == is_held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    caught = sum(p for p, y in test if y) / sum(y for _, y in test)
    wrong = sum(p for p, y in test if not y) / sum(1 - y for _, y in test)
    assert caught > 0.85 and wrong < 0.02, (caught, wrong)


# -- op7 --------------------------------------------------------------------------
def test_passages_are_found_and_others_left(spark):
    p, q = words(501, 60), words(502, 55)
    fuzzy = q.split()
    fuzzy[20], fuzzy[41] = "changed", "altered"
    del fuzzy[30]
    rows = [(1, f"{words(1, 80)} {p} {words(2, 40)}"), (2, f"{words(3, 30)}\n{p.upper()}\t{words(4, 90)}"), (3, words(5, 200)),
            (4, f"{words(6, 20)} {q}"), (5, f"{' '.join(fuzzy)} {words(7, 70)}"), (6, f"{words(8, 50)} {' '.join(p.split()[:40])}"),
            (7, rows_text := words(9, 130)), (8, rows_text), (9, rows_text), (None, p), (10, None), (11, "")]
    rows += [(100 + k, f"{words(600 + k, 70)} {p} {words(700 + k, 10)}") for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = {(r["doc_id"], r["source_id"]): (r["start_word"], r["end_word"]) for r in op07_substring.passages(df).collect()}
    assert got[2, 1] == (30, 90)
    assert got[8, 7] == got[9, 7] == (0, 130)
    start, end = got[5, 4]
    assert start <= 2 and 52 <= end <= 56
    assert all(got[100 + k, 1] == (70, 130) for k in range(60))
    assert {d for d, _ in got} == {2, 5, 8, 9, *range(100, 160)}


def changed(text: str, at: list[int], tag: str) -> str:
    w = text.split()
    for k in at:
        w[k] = f"{tag}{k}"
    return " ".join(w)


def test_passages_of_the_promised_share_are_found(spark):
    """Passages of 50 to 100 words of which 80 percent match, whatever the pattern of the changed words."""
    r = random.Random(70)
    patterns = [(60, range(4, 60, 5)), (100, range(4, 100, 5)), (60, range(6, 60, 7)), (60, range(9, 60, 10)), (100, range(45, 55)), (60, range(40, 50))]
    patterns += [(n, sorted(r.sample(range(n), n * share // 100))) for n in (50, 60, 100) for share in (5, 10, 15, 20) for _ in range(10)]
    rows = []
    for k, (n, at) in enumerate(patterns):
        p = words(3000 + k, n)
        rows += [(k, f"{words(4000 + k, 30)} {p} {words(5000 + k, 30)}"), (1000 + k, f"{words(6000 + k, 40)} {changed(p, at, f'x{k}y')} {words(7000 + k, 20)}")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {}
    for x in op07_substring.passages(df).collect():
        assert x["match"] >= op07_substring.MIN_MATCH and x["end_word"] - x["start_word"] >= op07_substring.MIN_WORDS
        got.setdefault((x["doc_id"], x["source_id"]), []).append((x["start_word"], x["end_word"]))
    missed = []
    for k, (n, at) in enumerate(patterns):
        # words of the passage between its first and last match that a span of 80 percent and 50 words needs
        kept = [i for i in range(n) if i not in set(at)]
        if kept[-1] - kept[0] + 1 >= 50 and not got.get((1000 + k, k)):
            missed.append((k, n, len(at)))
    assert not missed
    assert {d - 1000 for d, _ in got} == {s for _, s in got}
    assert got[1004, 4] == [(40, 140)] and got[1005, 5] == [(40, 100)]


def test_every_repeated_window_is_covered(spark):
    """Exact 50-word windows of an earlier document lie in passages, also where other documents have parts of them."""
    r = random.Random(71)
    pool = [words(8000 + k, 120).split() for k in range(12)]
    rows = []
    for k in range(300):
        parts = []
        for _ in range(3):
            p = r.choice(pool)
            n = r.choice([25, 35, 45, 49, 50, 55, 70, 98])
            at = r.randrange(len(p) - n)
            parts += [*words(9000 + r.randrange(10**6), r.randrange(1, 30)).split(), *p[at:at + n]]
        rows.append((k, " ".join(parts)))
    z, y, c = pool[0][:40], pool[0][40:80], pool[0][5:75]
    rows += [(1000 + k, f"{words(8500 + k, 20)} {' '.join(t)} {words(8600 + k, 20)}") for k, t in enumerate((z, y, c, z, y, c))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    covered = {}
    for x in op07_substring.passages(df).collect():
        covered.setdefault(x["doc_id"], set()).update(range(x["start_word"], x["end_word"]))
    seen, missed, n = set(), [], op07_substring.MIN_WORDS
    for d, t in sorted(rows):
        w = t.lower().split()
        own = [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
        missed += [(d, i) for i, x in enumerate(own) if x in seen and not set(range(i, i + n)) <= covered.get(d, set())]
        seen.update(own)
    assert not missed


def common_text(n_docs: int, n_pairs: int, share: int, seed: int = 72) -> tuple[list[tuple], dict]:
    """Documents of 200 words from a vocabulary of 2000 with four successors a word, so that four-word windows recur by chance,
    and planted passages of 70 words, the later copy with ``share`` percent of its words changed: rows, {later: (earlier, start)}."""
    r = random.Random(seed)
    after = [[r.randrange(2000) for _ in range(4)] for _ in range(2000)]

    def chain(n: int) -> list[str]:
        w = r.randrange(2000)
        out = []
        for _ in range(n):
            out.append(f"w{w}")
            w = r.choice(after[w])
        return out

    docs = [chain(200) for _ in range(n_docs)]
    ids = r.sample(range(n_docs), 2 * n_pairs)
    planted = {}
    for x, y in zip(ids[::2], ids[1::2], strict=True):
        lo, hi = min(x, y), max(x, y)
        p, a, b = chain(70), r.randrange(130), r.randrange(130)
        docs[lo][a:a + 70] = p
        q = list(p)
        for k in r.sample(range(1, 69), 70 * share // 100):
            q[k] = f"w{r.randrange(2000)}"
        docs[hi][b:b + 70] = q
        planted[hi] = (lo, b)
    return [(k, " ".join(w)) for k, w in enumerate(docs)], planted


@pytest.mark.parametrize("n_docs, share", [(100, 10), (1000, 10), (6000, 10), (6000, 20)])
def test_changed_passages_are_found_where_seeds_are_common(spark, n_docs, share):
    rows, planted = common_text(n_docs, min(n_docs // 4, 150), share)
    got = {}
    for x in op07_substring.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect():
        got.setdefault((x["doc_id"], x["source_id"]), []).append((x["start_word"], x["end_word"]))
    found = sum(any(s < b + 60 and e > b + 10 for s, e in got.get((d, o), [])) for d, (o, b) in planted.items())
    assert found >= 0.9 * len(planted), (found, len(planted))
    assert set(got) <= {(d, o) for d, (o, _) in planted.items()}


def test_every_holder_of_a_common_seed_is_handed_on():
    """Six documents with one seed and other links: all go to the comparison of holders under one number."""
    n = np.arange(6, dtype=np.int64)
    doc, _, owner, _, _ = op07_substring.anchors_of(n * 0 + 5, n * 7 + 1, n * 3 + 60, n * 0, n * 0, n)
    common = owner > doc
    assert set(doc[common].tolist()) == set((n * 7 + 1).tolist()) and len(set((owner - doc)[common].tolist())) == 1
    pairs = [np.arange(90, dtype=np.uint32) + k for k in (0, 61, 62, 30)]
    new = {k: np.ones(90, bool) for k in range(4)}
    assert sorted(op07_substring.alike(np.arange(4), np.arange(4), pairs, new)) == [(1, 0), (2, 1), (3, 0), (3, 1), (3, 2)]


@pytest.mark.parametrize("holders", [12, 0])
def test_changed_passages_are_found_where_all_seeds_have_many_holders(spark, monkeypatch, holders):
    """Two documents share a line of ten words and more around it, but no other four words in a row; sixty others have the line."""
    monkeypatch.setattr(op07_substring, "HOLDERS", holders)
    line, left, right = words(9101, 14), words(9102, 18), words(9103, 18)
    worn = lambda t, tag: changed(t, [k for k in range(18) if k % 4 == 3], tag)
    rows = [(k, f"{words(9200 + k, 40)} {line} {words(9400 + k, 40)}") for k in range(62)]
    rows[30] = (30, f"{words(9501, 30)} {left} {line} {right} {words(9502, 30)}")
    rows[45] = (45, f"{words(9503, 20)} {worn(left, 'x')} {line} {worn(right, 'y')} {words(9504, 30)}")
    rows += [(100, rows[3][1]), (None, line), (101, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [tuple(x) for x in op07_substring.passages(df).collect() if x["doc_id"] != 100]
    assert [(x[0], x[3]) for x in got] == [(45, 30)]
    assert got[0][1] <= 21 and got[0][2] >= 69 and got[0][6] >= op07_substring.MIN_MATCH


def test_runs_of_two_documents_are_aligned_together():
    """Twenty runs on one diagonal are one segment; another diagonal is one of its own, and both are a chain."""
    segs = [x for k in range(20) for x in (100 + 12 * k, 40 + 12 * k, 5)] + [400, 350, 9]
    batch = pa.RecordBatch.from_arrays([pa.array([7]), pa.array([3]), pa.array([segs], pa.list_(pa.int32()))], names=op07_substring.ALIKE)
    got = [tuple(x) for b in op07_substring._chained(batch) for x in b.column(2).to_pylist()]
    assert {(100, 40, 233), (400, 350, 9)} <= set(got) and len(got) <= 3


def test_holders_out_of_step_are_not_aligned():
    """Word pairs of a row are met at the same distance from the seed, up to DRIFT words, not anywhere around it."""
    x = np.arange(96, dtype=np.int64)
    shifted, turned = np.concatenate([x[:50], x[:10] + 900, x[50:86]]), np.concatenate([x[60:], x[:60]])
    got = op07_substring.in_step(0, np.arange(1, 4), [x, shifted, turned, x[10:]], np.array([46, 46, 46, 36]))
    assert got.tolist() == [1, 3]


def test_holders_that_cover_nothing_new_are_not_listed():
    """Forty documents around one seed: a passage of 60 words in all, 30 words after it in every second one, and one without either."""
    rng = np.random.default_rng(6)
    body, tail = rng.integers(0, 1 << 16, 60), rng.integers(0, 1 << 16, 30)
    rows = []
    for k in range(41):
        w = rng.integers(0, 1 << 16, 96).astype("<u2")
        if k != 20:
            w[6:66] = body
            w[66:] = tail if k % 2 else w[66:]
        rows.append((9, 0, 0, k, 100, 100, 0, w.tobytes(), np.packbits(np.ones(96, bool)).tobytes()))
    for parts in (1, 2):
        rows = [(*r[:2], parts - 1, *r[3:6], r[3] // 20 % parts, *r[7:]) for r in rows]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), op07_substring.HOOD_TYPES, strict=True)], names=op07_substring.HOOD)
        got = [r for b in op07_substring._alike(iter([batch.slice(0, 7), batch.slice(7)])) for r in b.to_pylist()]
        # two parts: those of the first have no earlier holder in the second but the last one, which follows them
        asking = [k for k in range(1, 41) if k != 20] if parts == 1 else [k for k in range(21, 40)]
        assert sorted({r["doc_id"] for r in got} - {40}) == [k for k in asking if k != 40] and len(got) <= 2 * len(asking) + 2
        for d in asking:
            mine = [r for r in got if r["doc_id"] == d]
            assert mine and all(r["source_id"] < d and (r["lo"], r["hi"], r["olo"], r["ohi"]) == (54, 150, 54, 150) for r in mine)
            assert d % 2 == 0 or d == 1 or any(r["source_id"] % 2 for r in mine)


def test_held_seeds_and_anchors_are_packed_as_they_were():
    """Blocks give back every row, in the order of documents, whatever the ids; seeds need less than 110 bytes a row in all."""
    rng = np.random.default_rng(5)
    doc, n = np.sort(rng.integers(-1 << 60, 1 << 60, 400)).repeat(50), 20000
    cols = [doc, np.tile(np.arange(50), 400).astype(np.int32), rng.integers(-1 << 62, 1 << 62, n), rng.integers(0, 1 << 32, n).astype(np.uint32), rng.integers(0, 40, n).astype(np.uint8)]
    mixed = rng.permutation(n)
    batch = op07_substring.packed((doc % 7)[mixed], [c[mixed] for c in cols], op07_substring.ANCHOR_BYTES, 0, False)
    got = np.concatenate([op07_substring.unpacked(k, b, op07_substring.ANCHOR_BYTES, 0) for _, k, b in zip(*(c.to_pylist() for c in batch.columns), strict=True)], 1)
    assert sorted(zip(*got.tolist(), strict=True)) == sorted(zip(*(c.astype(np.int64).tolist() for c in cols), strict=True))

    texts = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array([words(7000 + k, 400) for k in range(200)])], names=["doc_id", "text"])
    list(op07_substring._seeds(iter([texts]), 16))
    tracemalloc.start()
    rows = sum(sum(b.column(1).to_pylist()) for b in op07_substring._seeds(iter([texts] * 5), 16))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > 300_000 and peak < 110 * rows


def test_seeds_anchors_and_holders_are_shuffled_in_parts(spark, monkeypatch):
    """Each part of the seeds has its own buckets, together they are all; passages are the same, whatever the parts."""
    texts = pa.RecordBatch.from_arrays([pa.array(range(20)), pa.array([words(7000 + k, 400) for k in range(20)])], names=["doc_id", "text"])

    def seeds(*args):
        return sorted((bucket, r) for b in op07_substring._seeds(iter([texts]), 64, *args) for bucket, n, block in zip(*(c.to_pylist() for c in b.columns), strict=True)
                      for r in zip(*op07_substring.unpacked(n, block, op07_substring.SEED_BYTES, op07_substring.SEED_DOC).tolist(), strict=True))

    parts = [seeds(3, k) for k in range(3)]
    assert all({bucket % 3 for bucket, _ in p} == {k} for k, p in enumerate(parts)) and sorted(sum(parts, [])) == seeds()

    line, own = words(1, 30), [words(100 + k, 40) for k in range(6)]
    rows = [(k, f"{words(200 + k, 60)} {line} {own[k % 6]} {words(300 + k, 60)}") for k in range(18)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    want = sorted(map(tuple, op07_substring.passages(df).collect()))
    names, parts, write = [], [], op07_substring.written

    def noted(df, name):
        names.append(name)
        out = write(df, name)
        parts.extend(f.removeprefix("file://") for f in out.inputFiles() if name == "substring-anchors")
        return out

    monkeypatch.setattr(op07_substring, "written", noted)
    monkeypatch.setattr(op07_substring, "ROUND_WORDS", 0)
    monkeypatch.setattr(op07_substring, "HOOD_BYTES", 10_000)
    assert want and sorted(map(tuple, op07_substring.passages(df).collect())) == want
    assert names.count("substring-anchors") == names.count("substring-chains") == 2 and names.count("substring-holders") > 1
    assert parts and not any(os.path.exists(f) for f in parts)


def test_many_chains_and_holders_are_judged_together(monkeypatch):
    """What is told of a batch or of all pairs of runs at once equals what is told of each alone."""
    rng, op = np.random.default_rng(11), op07_substring
    texts, others = [], []
    for _ in range(400):
        a = rng.integers(0, rng.choice([30, 3000]), rng.integers(0, 200)).astype("<u4")
        texts.append(a)
        others.append(np.where(rng.random(len(a)) < rng.choice([0.5, 0.78, 0.85]), a, 99_999).astype("<u4")[rng.integers(0, 30):])
    alone = [np.isin(a, b) for a, b in zip(texts, others, strict=True)]
    want = [bool(op.may_cover(k[None], k).any()) for k in alone]
    assert op.may_match([a.tobytes() for a in texts], [b.tobytes() for b in others]).tolist() == want and 50 < sum(want) < 350
    assert op.may_match([], []).tolist() == []

    pairs, row = np.array([5, 7, 5, 5, 7, 9]), np.array([0, 0, 0, 1, 1, 1])
    got, bare = op.sets_of(pairs, row, np.array([False, False, True, False, False, True]))
    assert len(set(got[:3].tolist())) == 3 and len(set(got[:3].tolist()) & set(got[3:].tolist())) == 2 and bare.tolist() == [True, True, False, False, False, True]

    spans = []
    for at_once in (op.AT_ONCE, 0):
        monkeypatch.setattr(op, "AT_ONCE", at_once)
        r, found = np.random.default_rng(12), []
        for _ in range(300):
            at = np.flatnonzero(r.random(r.integers(50, 260)) < r.choice([0.7, 0.8, 0.85, 0.95]))
            found.append(op.shared_spans(at, at + np.cumsum(r.random(len(at)) < 0.05)))
        spans.append(found)
    assert spans[0] == spans[1] and sum(map(len, spans[0])) > 100


def test_passages_do_not_depend_on_the_number_of_buckets(spark, monkeypatch):
    df = spark.createDataFrame(common_text(60, 15, 10)[0], "doc_id long, text string").repartition(3).cache()
    few = sorted(op07_substring.passages(df).collect())
    monkeypatch.setattr(op07_substring, "BUCKET_WORDS", 1)
    monkeypatch.setattr(op07_substring, "TASK_WORDS", 1500)
    assert few and sorted(op07_substring.passages(df).collect()) == few


def test_removal(spark, edge):
    p = words(801, 60)
    df = spark.createDataFrame([(1, f"{p} x", 1), (2, f"a  b\n{p} c d", 2), (3, p, 3), (4, None, 4)], "doc_id long, text string, n_chars long")
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in op07_substring.remove(df, op07_substring.passages(df)).collect()}
    assert out == {1: (f"{p} x", 1), 2: ("a  b\nc d", 8), 4: (None, 4)}


def test_chains_are_best():
    """Chain scores equal those of trying every predecessor."""
    r = np.random.default_rng(8)
    c, k = op07_substring.GAP_COST, op07_substring.SEED_WORDS
    for _ in range(40):
        n = int(r.integers(1, 25))
        segs = np.stack([r.integers(0, 300, n), r.integers(0, 300, n), r.integers(k, 40, n), np.full(n, 2)], 1)
        segs = segs[np.lexsort((segs[:, 1], segs[:, 0]))]
        best = segs[:, 2].astype(float)
        for j in range(n):
            for i in range(n):
                end, oend = segs[i, 0] + segs[i, 2], segs[i, 1] + segs[i, 2]
                if end - k < segs[j, 0] and oend - k < segs[j, 1]:
                    best[j] = max(best[j], segs[j, 2] + best[i] - c * (segs[j, 0] - end + segs[j, 1] - oend))
        chain = op07_substring.chains(segs)[0]
        gaps = [(b[0] - a[0] - a[2]) + (b[1] - a[1] - a[2]) for a, b in zip(chain[:-1], chain[1:], strict=True)]
        assert np.isclose(chain[:, 2].sum() - c * sum(gaps), best.max())
        assert sum(len(x) for x in op07_substring.chains(segs)) == n


# -- op8 --------------------------------------------------------------------------
@pytest.mark.parametrize("block", [60, 1 << 15])
def test_topk_equals_brute_force(spark, block):
    r = np.random.default_rng(9)
    base = r.normal(size=(260, 40))
    base[100:180] = base[100]                      # a very common vector
    base[200:230] = base[100] + r.normal(scale=0.3, size=(30, 40))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(base)], "vec_id long, embedding array<float>").repartition(3)
    got = {}
    for x in op08_topk.top_k(df, df.where("vec_id % 50 = 0"), 10, block).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["distance"]))
    bits = base.astype(np.float32) > 0
    for q in range(0, 260, 50):
        d = (bits != bits[q]).sum(1)
        want = sorted((int(d[i]), i) for i in range(260) if i != q)[:10]
        assert sorted(got[q]) == [(k + 1, i, x) for k, (x, i) in enumerate(want)]


# -- op9 --------------------------------------------------------------------------
def test_language_on_held_out_rows(spark):
    rows = op09_language.op9_language(spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    test = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(test) / len(test) > 0.98


def test_language_edges(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr")] * 20)]
    rows += [(100, None, "en"), (101, "12 !? 34", None), (102, "", "fr"), (103, "THE DOG", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = op09_language.fit(df)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in op09_language.identify(df, model).collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0)
    assert got[103][0] == "en" and got[0][0] == "en" and got[1][0] == "fr"


def test_language_equals_naive_bayes_by_hand(spark):
    """Predictions and scores equal those of a naive Bayes over n-grams in dictionaries."""
    r = random.Random(90)
    odds = {"aa": "aaab c", "bb": "abbb c", "cc": "abccc 1"}
    rows = [(k, "".join(r.choice(odds[x]) for _ in range(r.randrange(0, 60))), x) for k, x in enumerate(r.choices(list(odds), [5, 3, 1], k=120))]
    rows += [(200, None, "aa"), (201, "abc", None), rows[3], (202, "12 3", "bb")]

    def ngrams(text: str) -> list[str]:
        t = re.sub(r"[^a-z]+", " ", text.lower())
        return [t[i:i + n] for n in op09_language.ORDERS for i in range(len(t) - n + 1)]

    known = [(t, x) for _, t, x in rows if t is not None and x is not None]
    count = {x: collections.Counter(g for t, y in known if y == x for g in ngrams(t)) for x in odds}
    n_texts = {x: sum(y == x and any(c.isalpha() for c in t) for t, y in known) for x in odds}
    add, buckets = op09_language.SMOOTHING, op09_language.BUCKETS
    expected = []
    for d, t, _ in rows:
        if t is None or not any(c.isalpha() for c in t):
            expected.append((d, "und", 0.0))
            continue
        log_p = {x: math.log((n_texts[x] + add) / sum(v + add for v in n_texts.values()))
                 + sum(math.log((count[x][g] + add) / (sum(count[x].values()) + add * buckets)) for g in ngrams(t)) for x in odds}
        best = max(sorted(odds), key=log_p.get)
        expected.append((d, best, 1 / sum(math.exp(v - log_p[best]) for v in log_p.values())))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = sorted((x["doc_id"], x["lang_pred"], x["score"]) for x in op09_language.identify(df, op09_language.fit(df)).collect())
    for x, y in zip(got, sorted(expected), strict=True):
        assert x[:2] == y[:2] and abs(x[2] - y[2]) < 1e-3, (x, y)


def test_ngrams_stay_within_texts():
    both = pa.array(["ab", "cd"])
    for _, _, data, off in slices(both):
        bucket, doc, n = op09_language.grams(data, off)
    alone = []
    for t in ("ab", "cd"):
        for _, _, data, off in slices(pa.array([t])):
            alone.append(sorted(op09_language.grams(data, off)[0].tolist()))
    assert [sorted(bucket[doc == k].tolist()) for k in (0, 1)] == alone and n.tolist() == [2, 2]


# -- op10 -------------------------------------------------------------------------
@settings(max_examples=60, deadline=None)
@given(st.text("abé日", max_size=300), st.text("abé日", max_size=300), st.integers(0, 300), st.integers(0, 300))
def test_spans_and_extensions(a, b, i, j):
    p, q = op10_fingerprint.Prefixes(a), op10_fingerprint.Prefixes(b)
    i, j = min(i, len(a)), min(j, len(b))
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    assert op10_fingerprint.extension(p, i, q, j) == n
    f = op10_fingerprint.Fingerprint.joined(p, i, q, j)
    whole = op10_fingerprint.Fingerprint.of(op10_fingerprint.Prefixes(a[:i] + b[:j]))
    assert f.text() == whole.text() == op10_fingerprint.Fingerprint.parse(whole.text()).text()
    x = op10_fingerprint.likeness(op10_fingerprint.Fingerprint.of(p), op10_fingerprint.Fingerprint.of(q))
    assert 0 <= x <= 1 and (a != b or x == 1)


def test_fingerprints_of_next_documents(spark, edge, edge_dir):
    rows = [(i * 7 % 50, words(i % 9, 1 + 13 * i)) for i in range(50)] + [(3, ""), (4, None), (4, "tie"), (None, "null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]) for r in op10_fingerprint.fingerprints(df).collect())
    ordered = sorted(((d if d is not None else -1, t or "") for d, t in rows), key=lambda x: (-x[0], x[1]))
    want = []
    for k, (d, t) in enumerate(ordered):
        nxt = ordered[(k + 1) % len(ordered)][1]
        m = len(t) // 3
        want.append((d >= 0, max(d, 0), len(t), hashlib.sha256((t[:len(t) - m] + nxt[:m]).encode()).hexdigest()))
    assert got == sorted(want)
    alike = [r["near_edited"] for r in op10_fingerprint.op10_fingerprint(spark, edge_dir).collect() if r["n_chars"] > 30]
    assert min(alike) > 0.55


# -- pipeline ---------------------------------------------------------------------
def test_pipeline_stages(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, sf), "test-stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert kept["substrings"] <= kept["near_duplicates"] <= kept["toxicity"] <= kept["language"]
    # what is left of two cut documents may be alike if it is shorter than a passage
    texts = [t for r in docs.collect() if len((t := r["text"].lower()).split()) >= op07_substring.MIN_WORDS]
    assert len(set(texts)) == len(texts) > 500
    packed = corpus_pipeline.packing(spark, docs, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == kept["substrings"]


def test_pipeline_rejects_at_the_threshold_alone(spark, monkeypatch):
    import corpus_pipeline
    weight = np.zeros(op06_toxicity.BUCKETS, np.float32)
    for word, x in (("mildly", -0.5), ("kindly", -3), ("badly", 1)):
        for _, _, data, off in slices(pa.array([word])):
            weight[op06_toxicity.features(data, off)[0]] += x / 3
    model = op06_toxicity.Model(1.0, weight, np.zeros((op06_toxicity.BUCKETS, op06_toxicity.FACTORS), np.float32))
    monkeypatch.setattr(op06_toxicity, "fit", lambda docs, labels: model)
    df = spark.createDataFrame([(1, "mildly"), (2, "kindly"), (3, "badly"), (4, "other"), (5, ""), (6, None)], "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.toxicity(spark, df, "/root/testdata/sf0.01").collect()} == {2, 4, 5, 6}


def test_pipeline_keeps_the_unique_text_of_a_repeated_id(spark):
    import corpus_pipeline
    x, y, z = words(9101, 80), words(9102, 80), words(9103, 80)
    rows = [(1, x, "a"), (2, x, "a"), (2, y, "a"), (2, y, "b"), (3, z, "a"), (3, f"{z} more", "a"), (4, None, "a"), (4, " ", "a"), (5, y, "a"), (None, x, "a"), (None, x, "a")]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        out = corpus_pipeline.near_duplicates(spark, df, "")
        assert out.columns == df.columns
        got = [tuple(r) for r in out.collect()]
        assert sorted(got, key=str) == sorted([(1, x, "a"), (2, y, "a"), (3, z, "a"), (4, None, "a"), (None, x, "a"), (None, x, "a")], key=str)


def test_crc_of_the_split():
    assert is_held_out(5) == (zlib.crc32(b"5") % 4 == 2)


# -- op4, long runs ---------------------------------------------------------------
@pytest.mark.parametrize("text", [" " * 1_200_000 + "x", "\n" * 700_000, "\t" * 700_000 + " y", "a" * 300_000, "日本" * 60_000, "x y " * 9 + "!" * 200_000 + "<|endoftext|> z"])
def test_packing_long_runs_equal_tokenizers(tokens, text):
    assert op04_packing.ids_of(text, default_vocabulary()).tolist() == tokens.encode(text, add_special_tokens=False).ids


def test_packing_query_takes_millions_of_blanks(spark, tmp_path):
    spark.createDataFrame([(1, " " * 5_000_000 + "x"), (2, "\n" * 2_000_000), (3, "a b"), (4, "　" * 100_000)], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {}
    for r in op04_packing.op4_packing(spark, str(tmp_path)).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        assert r["doc_tokens"] >= r["start"] + r["length"]
    # the last blank and the letter are one word, and one token; each blank before is a token; then the closing id
    assert got[1] == 4_999_999 + 1 + 1 and got[3] == 3 and set(got) == {1, 2, 3, 4}


def test_toxicity_is_fitted_within_a_few_copies_of_its_sample():
    """The fit holds no widened copies of the whole sample beside it."""
    import tracemalloc
    from seqlake.llm import op06_toxicity as op
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, op.BUCKETS, 1000)).astype(np.int32) for _ in range(10_000)]
    labels = (np.arange(len(rows)) % 20 == 0).astype(float)
    tracemalloc.start()
    try:
        op.train(rows, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 120e6, peak
