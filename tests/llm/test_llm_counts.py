"""Token counts, source divergences and centroids against the library, DuckDB and brute force."""

import hashlib
import random
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import edge_rows, words

from seqlake.llm import op11_tokens, op12_divergence, op13_centroids
from seqlake.llm.op01_bpe import default_vocabulary
from seqlake.llm.queries import ORACLE, QUERIES


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def duck(sql, **tables):
    con = duckdb.connect()
    for name, path in tables.items():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return con.sql(sql)


def same_as_sql(query, directory, table):
    got = QUERIES[query[0]](*query[1:])
    want = duck(ORACLE[query[0]], **{table: f"{directory}/{table}.parquet"}).select(", ".join(got.columns)).fetchall()
    assert rows(got) == sorted(map(repr, want))
    return want


# -- op11 -------------------------------------------------------------------------
@pytest.fixture(scope="module")
def counter():
    return op11_tokens.Counter(default_vocabulary())


PARTS = ["foo", " bar", "\n", "  ", "\t", "123", "a1", "'s", "日本語", "、", "é", "<|endoftext|>", "<|endof", "text|>", "!?", " ", "\x1c", "᠎", "."]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60).map("".join), st.integers(2, 14))
def test_pieces_add_up(counter_cache, text, size):
    c = counter_cache
    want = len(c.library.encode(text, add_special_tokens=False).ids)
    assert "".join(c.pieces(text, size)) == text
    assert c.count(pa.array([text, "", text]), size, 40).tolist() == [want, 0, want]
    assert c.stretch_tokens(text) == want
    assert sum(1 if w in c.added else c.word_tokens(w.encode()) for w in c.words(text)) == want


@pytest.fixture(scope="module")
def counter_cache(counter):
    return counter


@pytest.mark.parametrize("text", [" " * 200_000, "\n" * 100_000 + "x", "\t" * 90_000, "日本" * 60_000, "ab" * 80_000, "a" + "!" * 90_000, "é" * 100_000 + " x"])
def test_long_stretches_without_boundaries(counter, text):
    want = len(counter.library.encode(text, add_special_tokens=False).ids)
    assert counter.count(pa.array([text]), 1 << 14).tolist() == [want]


def test_millions_of_blanks(counter):
    assert counter.count(pa.array([" " * 1_500_000 + "x"])).tolist() == [len(counter.library.encode(" " * 1_500_000 + "x", add_special_tokens=False).ids)]


def test_token_query(spark, edge_dir, counter):
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in QUERIES["op11_tokens"](spark, edge_dir).collect())
    want = []
    for r in edge_rows():
        n = len(counter.library.encode(r[1] or "", add_special_tokens=False).ids)
        want.append((r[0] if r[0] is not None else -1, len((r[1] or "").encode()), n, n > 512))
    assert got == sorted(want)


def test_counts_keep_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a b", "x", 2)], "doc_id int, text string, __text string, lang int")
    out = op11_tokens.count_tokens(df, default_vocabulary(), keep=("doc_id", "__text", "lang"), limit=1)
    assert [tuple(r) for r in out.collect()] == [(1, "x", 2, 3, 2, True)]


# -- op12 -------------------------------------------------------------------------
def brute_audit(docs, min_docs=3, ranks=200):
    """Rows of the audit of (text, lang, source), from dictionaries."""
    import re
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(low)), a or "", s or "") for t, a, s in docs]
    out = []
    for lang in {d[1] for d in docs}:
        mine = [d for d in docs if d[1] == lang]
        df = Counter(t for d in mine for t in set(d[0]))
        kept = [t for t in df if df[t] >= min_docs]
        counts = {s: Counter() for s in {d[2] for d in mine}}
        for ts, _, s in mine:
            counts[s].update(t for t in ts if df[t] >= min_docs)
        whole = sum(counts.values(), Counter())
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept))
        f = lambda p, q: (p - q) ** 2 // q
        for a in counts:
            pair = [(-sum(f(share(counts[a], t), share(counts[b], t)) for t in kept), b.encode()) for x, b in permutations(counts, 2) if x == a]
            term = [(-f(share(counts[a], t), share(whole, t)), t.encode()) for t in kept if counts[a][t] and share(counts[a], t) > share(whole, t)]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:ranks])):
                out += [(lang, a, part, i.decode(), -v, n) for n, (v, i) in enumerate(found, 1)]
    return sorted(map(repr, out))


def odd_documents(seed, n):
    r = random.Random(seed)
    some = ["Alpha", "beta", "GAMMA", "ÉTÉ", "été", "Straße", "x", "日本", "o'clock", "a1b", "_c_", "d-e"] + [f"w{i}" for i in range(30)]
    return [(None if r.random() < .05 else r.choice([" ", "\n", "1"]).join(r.choices(some, k=r.randrange(12))), r.choice([None, "", "en", "en", "en", "fr", "xx"]),
             r.choice([None, "", "s1", "s1", "s1", "s2", "s3", "ß"])) for _ in range(n)] + [("only once", "zz", "s1"), (None, "zz", "s2"), ("", "yy", "s")]


@pytest.mark.parametrize("small", [False, True])
def test_audit_equals_dictionaries(spark, monkeypatch, small):
    """Also with spills after a few entries, texts folded in windows, blocks of single sources and a pass for each language."""
    if small:
        docs = odd_documents(7, 150)
        blocks = op12_divergence.Language.__init__

        def tiny(self, *a):
            blocks(self, *a)
            self.rows = 2
        monkeypatch.setattr(op12_divergence.Language, "__init__", tiny)
        real = op12_divergence.passes
        monkeypatch.setattr(op12_divergence, "passes", lambda g: real(g, 1))
    else:
        docs = odd_documents(8, 400)
    df = spark.createDataFrame(docs, "text string, lang string, source string").repartition(5)
    assert rows(op12_divergence.audit(df, ranks=5 if small else 200)) == brute_audit(docs, ranks=5 if small else 200)


def test_stripes_spill_and_windows(monkeypatch):
    text = "Aa bb ÉÉ bb " * 50
    whole = op12_divergence.terms(text.encode().lower())
    monkeypatch.setattr(op12_divergence, "WINDOW", 7)
    assert op12_divergence.terms(text.encode().lower()) == whole
    monkeypatch.setattr(op12_divergence, "SPILL_ENTRIES", 3)
    s, got = op12_divergence.Stripes(), Counter()
    for k in range(40):
        s.fold("en", f"s{k % 4}", f"t{k % 7} common".encode())
        if s.full() or k == 39:
            for b in s.take(rows=2):
                for term, entries in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    for e in entries:
                        got[term, e["source"], "df"] += e["df"]
                        got[term, e["source"], "n"] += e["n"]
    assert got["common", "s1", "df"] == 10 and got["common", "s1", "n"] == 10 and got["t", "s0", "n"] == 10 and got["", "s3", "df"] == 10


def test_shares_beyond_64_bits():
    c = np.array([0, 5, 20_000_000_000, 7 * 10**13])
    under = 10**14 + 3
    assert op12_divergence.shares(c, under).tolist() == [1 + 10**9 * (int(x) + 1) // under for x in c]


def test_audit_edges(spark, edge_dir):
    same_as_sql(("op12_divergence", spark, edge_dir), edge_dir, "documents")


# -- op13 -------------------------------------------------------------------------
def brute_clusters(vectors, k=16, rounds=3):
    """Rows of the query, from lists of Python integers."""
    kept = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in vectors
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    cents = [list(v) for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, vs in groups.items():
            cents[n] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *near(v)) for i, v in kept]
    inertia = Counter()
    for _, d, n in found:
        inertia[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(repr((i, n, d, inertia[n], sum(inertia.values()), digest[n])) for i, d, n in found)


def odd_vectors(seed, n):
    r = random.Random(seed)
    base = [[r.uniform(-3, 3) for _ in range(64)] for _ in range(9)]
    out = [(i, [x + r.gauss(0, .3) for x in r.choice(base)]) for i in range(n)]
    out += out[:3] + [(None, out[5][1]), (None, out[6][1]), (n, None), (n + 1, []), (n + 2, [1.0] * 63), (n + 3, [1.0] * 65), (n + 4, [float("nan")] + [0.0] * 63),
                      (n + 5, [float("inf")] * 64), (n + 6, [None] + [0.0] * 63), (n + 7, [0.0] * 64), (n + 8, [-0.001] * 64), (n + 9, [1000.0] * 64)]
    return out


@pytest.mark.parametrize("n", [0, 4, 60, 400])
def test_clusters_equal_brute_force(spark, n):
    vectors = odd_vectors(n, max(n, 7))[:n] if n < 10 else odd_vectors(n, n)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(4)
    out = op13_centroids.report(*op13_centroids.cluster(df))
    assert rows(out) == brute_clusters(vectors)


def test_dot_products_are_kept_exact(spark):
    df = spark.createDataFrame([(i, [((i * 37 + j * 101) % 513 - 256) * 4096.0 for j in range(64)]) for i in range(50)], "vec_id long, embedding array<float>")
    state, cents = op13_centroids.cluster(df)
    for r in state.collect():
        x = [int(a) for a in r["v"]]
        assert list(r["dots"]) == [sum(a * int(b) for a, b in zip(x, c)) for c in cents] and r["norm"] == sum(a * a for a in x)


def test_cluster_query_equals_sql(spark, edge_dir):
    assert same_as_sql(("op13_centroids", spark, edge_dir), edge_dir, "embeddings")
