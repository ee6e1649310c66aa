"""Source divergence audit by in-mapper stripes.

Every task folds the whole documents that it reads into stripes, one for
each language and term: how many documents have the term, and how often it
occurs in each source.  Full tables of stripes are handed to Spark and begun
anew; one shuffle by (language, term) brings the parts of a stripe together,
whatever they weigh: a term of all documents has one part a task.  Stripes of
terms in enough documents are written, and each of them gives, once the totals
of the groups are known, what it adds to the divergence of every two sources and
which sources hold it more often than the language does.

All arithmetic is exact.  A group's share of a term is p = 1 + floor(SCALE * (count + 1) / (N + V)),
its distance from another share q is floor((p - q)^2 / q).

Null text, language and source read as ''.  Empty texts and texts without a
term still make their group occur; a very long text is folded in windows;
repeated rows count as often as they come; equal values are ranked by item
in UTF-8 order; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, texts_of, written

#: Documents of a language that a kept term is in, scale of the shares, ranks of the term report.
MIN_DOCS = 3
SCALE = 1_000_000_000
TERM_RANKS = 200
#: (term, source) entries and bytes of terms that a task folds before it hands on its stripes.
SPILL_ENTRIES = 300_000
SPILL_BYTES = 32 << 20
#: Bytes of a text folded at once.
WINDOW = 1 << 20
#: Cells of the matrix of pairs that a task holds; a language with more pairs of sources is worked in blocks of rows.
CELLS = 1 << 22
#: Bytes of group names and totals that are broadcast at once; more are worked in several passes over ranges of languages.
BROADCAST_BYTES = 64 << 20

_TERM = re.compile(rb"[a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^a-z\x80-\xff]")
STRIPE = "lang string, term string, entries array<struct<source:string,df:bigint,n:bigint>>"


def terms(text: bytes) -> Counter:
    """Occurrences of each term of a lower-cased text, counted window by window; windows end between terms."""
    if len(text) <= WINDOW:
        return Counter(_TERM.findall(text))
    out, at = Counter(), 0
    while at < len(text):
        m = _BREAK.search(text, at + WINDOW)
        end = m.start() if m else len(text)
        out.update(_TERM.findall(text, at, end))
        at = end
    return out


class Stripes:
    """Stripes of one task: lang -> term -> source -> [documents, occurrences]."""

    def __init__(self):
        self.by_lang: dict[str, dict[bytes, dict[str, list[int]]]] = {}
        self.entries = self.bytes = 0

    def fold(self, lang: str, source: str, text: bytes) -> None:
        """Add a document.  The empty term says that the group occurs."""
        stripes = self.by_lang.setdefault(lang, {})
        found = terms(text)
        found[b""] = 0
        for term, n in found.items():
            stripe = stripes.get(term)
            if stripe is None:
                stripe = stripes[term] = {}
                self.bytes += len(term)
            entry = stripe.get(source)
            if entry is None:
                stripe[source] = [1, n]
                self.entries += 1
            else:
                entry[0] += 1
                entry[1] += n

    def full(self) -> bool:
        return self.entries >= SPILL_ENTRIES or self.bytes >= SPILL_BYTES

    def take(self, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
        """The stripes as batches; begins anew."""
        for lang, stripes in self.by_lang.items():
            items = list(stripes.items())
            for lo in range(0, len(items), rows):
                part = items[lo:lo + rows]
                flat = [(s, df, n) for _, stripe in part for s, (df, n) in stripe.items()]
                off = np.concatenate([[0], np.cumsum([len(stripe) for _, stripe in part])]).astype(np.int32)
                entries = pa.StructArray.from_arrays([pa.array([f[0] for f in flat], pa.string()), pa.array([f[1] for f in flat], pa.int64()),
                                                      pa.array([f[2] for f in flat], pa.int64())], ["source", "df", "n"])
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([t.decode() for t, _ in part], pa.string()),
                    pa.ListArray.from_arrays(pa.array(off), entries)], names=["lang", "term", "entries"])
        self.by_lang, self.entries, self.bytes = {}, 0, 0


def partial_stripes(docs: DataFrame) -> DataFrame:
    """(lang, term, entries) stripes of every task; a term may have several, one a task and spill."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes = Stripes()
        for b in batches:
            langs, sources = b.column(1).to_pylist(), b.column(2).to_pylist()
            for lang, source, text in zip(langs, sources, texts_of(b)):
                stripes.fold(lang, source, text.as_py().encode().lower())       # of bytes: A-Z only
                if stripes.full():
                    yield from stripes.take()
        yield from stripes.take()

    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select("text", name("lang"), name("source")).mapInArrow(run, STRIPE)


def merged_stripes(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, sources, counts): whole stripes of the terms in at least ``min_docs`` documents of their language, and of the empty term.

    The parts of a stripe meet in one shuffle; sums by source come first, so a stripe is as wide as the language has sources.
    """
    parts = partial_stripes(docs).repartition("lang", "term").select("lang", "term", F.explode("entries").alias("e"))
    by_source = parts.groupBy("lang", "term", "e.source").agg(F.sum("e.df").alias("df"), F.sum("e.n").alias("n"))
    whole = by_source.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("entries"))
    return whole.where((F.col("df") >= min_docs) | (F.col("term") == "")).select("lang", "term", "df", "entries")


def totals(stripes: DataFrame) -> DataFrame:
    """(lang, source, total) of every group, with its occurrences of kept terms."""
    e = stripes.select("lang", "term", F.explode("entries").alias("e"))
    return e.groupBy("lang", F.col("e.source").alias("source")).agg(F.sum("e.n").alias("total"))


class Language:
    """Sources, their totals and the number of kept terms of one language."""

    def __init__(self, sources: list[str], total: list[int], n_terms: int):
        self.sources = sources
        self.place = {s: i for i, s in enumerate(sources)}
        self.under = np.array([t + n_terms for t in total], object)
        self.whole = sum(total) + n_terms
        self.terms = n_terms
        self.none = shares(np.zeros(len(sources), np.int64), self.under) if n_terms else None
        self.rows = max(1, CELLS // len(sources))          # sources of a block

    def blocks(self) -> int:
        return -(-len(self.sources) // self.rows)


def shares(count: np.ndarray, under) -> np.ndarray:
    """p of counts over N + V, exactly; in Python integers where 64 bits would not hold the product."""
    under = np.asarray(under, object)
    if not len(count):
        return np.zeros(0, np.int64)
    if int(count.max()) < 9_000_000_000 and max(under.reshape(-1).tolist()) < 1 << 62:
        return 1 + SCALE * (count + 1) // under.astype(np.int64)
    return (1 + SCALE * (count.astype(object) + 1) // under).astype(np.int64)


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class Pairs:
    """Divergence of the sources of one block of a language from all of them, summed over the terms seen."""

    def __init__(self, language: Language, block: int):
        self.language, self.block = language, block
        self.lo = block * language.rows
        self.hi = min(len(language.sources), self.lo + language.rows)
        self.sums = np.zeros((self.hi - self.lo, len(language.sources)), np.int64)
        self.base = distance(language.none[self.lo:self.hi, None], language.none[None, :])

    def add(self, term: np.ndarray, source: np.ndarray, share: np.ndarray, n_terms: int) -> None:
        """Entries (term, source, share) of ``n_terms`` terms, sorted by term: a term's other sources have the share of none."""
        none, lo, hi = self.language.none, self.lo, self.hi
        self.sums += n_terms * self.base
        # as q: against the share of none of every source of the block
        change = distance(none[lo:hi, None], share[None, :]) - distance(none[lo:hi, None], none[source][None, :])
        order = np.argsort(source, kind="stable")
        heads = np.flatnonzero(np.diff(source[order], prepend=-1))
        self.sums[:, source[order][heads]] += np.add.reduceat(change[:, order], heads, axis=1)
        # as p: against the true shares of all sources
        own = order[(source[order] >= lo) & (source[order] < hi)]
        if len(own):
            q = np.broadcast_to(none, (n_terms, len(none))).copy()
            q[term, source] = share
            q = q[term[own]]
            s = source[own]
            change = distance(share[own][:, None], q) - distance(none[s][:, None], q)
            heads = np.flatnonzero(np.diff(s, prepend=-1))
            self.sums[s[heads] - lo] += np.add.reduceat(change, heads, axis=0)

    def rows(self) -> Iterator[tuple[str, str, int]]:
        names = self.language.sources
        for i in range(self.lo, self.hi):
            for j, other in enumerate(names):
                if i != j:
                    yield names[i], other, int(self.sums[i - self.lo, j])


def _best(held: list[tuple[int, bytes]], ranks: int) -> list[tuple[int, bytes]]:
    """The first entries by falling value, then by item; items are kept as bytes."""
    return sorted(held, key=lambda x: (-x[0], x[1]))[:ranks]


def divergences(stripes: DataFrame, known: dict[str, Language], ranks: int = TERM_RANKS) -> DataFrame:
    """(lang, source, part, item, value): sums of pairs by task, and the terms of each task that may be among the first."""
    shared = stripes.sparkSession.sparkContext.broadcast(known)
    blocks = max([x.blocks() for x in known.values() if x.terms], default=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = shared.value
        pairs: Pairs | None = None
        best: dict[str, list[tuple[int, bytes]]] = {}

        def out(lang: str, part: str, rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([lang] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.string()), pa.array([part] * len(rows), pa.string()),
                pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], names=["lang", "source", "part", "item", "value"])

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            """Sums of the pairs held, in batches, and the terms held."""
            run = []
            for r in pairs.rows():
                run.append(r)
                if len(run) >= 50_000:
                    yield out(lang, "pair", run)
                    run = []
            yield out(lang, "pair", run)
            for source, held in best.items():
                yield out(lang, "term", [(source, t.decode(), v) for v, t in _best(held, ranks)])
            best.clear()

        at = None
        for b in batches:
            lang_of, block_of = b.column(0).to_pylist(), b.column(3).to_pylist()
            lo = 0
            while lo < b.num_rows:
                key = lang_of[lo], block_of[lo]
                language = langs[key[0]]
                # no more terms at once than there is room for their shares against all sources of the block
                step = max(1, CELLS // (len(language.sources) * min(language.rows, len(language.sources))))
                hi = lo + 1
                while hi < min(b.num_rows, lo + step) and (lang_of[hi], block_of[hi]) == key:
                    hi += 1
                if key[1] < language.blocks():
                    if key != at:
                        if at is not None:
                            yield from flush(at[0])
                        pairs, at = Pairs(language, key[1]), key
                    entries = b.column(2).slice(lo, hi - lo)
                    flat, off = entries.flatten(), entries.offsets.to_numpy()
                    off = off - off[0]
                    term = np.repeat(np.arange(hi - lo), np.diff(off))
                    source = np.array([language.place[s] for s in flat.field("source").to_pylist()], np.int64)
                    n = flat.field("n").to_numpy(zero_copy_only=False)
                    share = shares(n, language.under[source])
                    pairs.add(term, source, share, hi - lo)
                    if key[1] == 0:
                        whole = shares(np.add.reduceat(n, off[:-1]), language.whole)
                        more = np.flatnonzero((share > whole[term]) & (n > 0))
                        value = distance(share[more], whole[term[more]])
                        names = b.column(1).slice(lo, hi - lo).to_pylist()
                        for i, v in zip(more.tolist(), value.tolist()):
                            held = best.setdefault(language.sources[source[i]], [])
                            held.append((v, names[term[i]].encode()))
                            if len(held) > 8 * ranks:
                                held[:] = _best(held, ranks)
                lo = hi
        if at is not None:
            yield from flush(at[0])

    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))) if blocks > 1 else F.lit(0)
    rows = stripes.where(F.col("term") != "").select("lang", "term", "entries", block.alias("block")).sortWithinPartitions("lang", "block")
    return rows.mapInArrow(run, "lang string, source string, part string, item string, value bigint")


def passes(groups: DataFrame, limit: int = BROADCAST_BYTES) -> Iterator[dict[str, Language]]:
    """Languages with their groups, as many at once as ``limit`` bytes of names and totals allow (one at least).

    ``groups`` holds (lang, n_terms, source, total), one row a group; the pair report has a row for every two groups of a language.
    """
    held, size, lang, rows = {}, 0, None, []

    def close() -> None:
        if rows:
            held[lang] = Language([r["source"] for r in rows], [r["total"] for r in rows], rows[0]["n_terms"])

    for r in groups.orderBy("lang", "source").toLocalIterator():
        if r["lang"] != lang:
            close()
            lang, rows = r["lang"], []
            if size >= limit:
                yield held
                held, size = {}, 0
        rows.append(r)
        size += 3 * len(r["source"].encode()) + 200
    close()
    if held:
        yield held


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, ranks: int = TERM_RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank) of all groups of documents."""
    spark = docs.sparkSession
    stripes = written(merged_stripes(docs, min_docs), "divergence-stripes")
    n_terms = stripes.groupBy("lang").agg(F.sum((F.col("term") != "").cast("bigint")).alias("n_terms"))
    groups = written(totals(stripes).join(n_terms, "lang"), "divergence-groups")
    found = None
    for known in passes(groups):
        names = list(known)
        part = divergences(stripes.where(F.col("lang").between(names[0], names[-1])), known, ranks)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "lang string, source string, part string, item string, value bigint, rank int")
    found = written(found, "divergence-parts")
    # a language without a kept term has pairs of value 0
    bare = groups.where("n_terms = 0").select("lang", "source")
    none = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").select(
        "lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("bigint").alias("value"))
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).unionByName(none)
    rank = lambda: F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    first = found.where("part = 'term'").withColumn("rank", rank()).where(F.col("rank") <= ranks)
    return pairs.withColumn("rank", rank()).unionByName(first)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


ORACLE_OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT id, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
t AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source),
w AS (SELECT lang, sum(total)::HUGEINT AS total FROM t GROUP BY lang),
p AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (t.total + v.v) AS p
  FROM t JOIN k ON k.lang = t.lang JOIN v ON v.lang = t.lang LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
l AS (
  SELECT p.lang, p.term, 1 + (1000000000::HUGEINT * (sum(p.n)::HUGEINT + 1)) // (any_value(w.total) + any_value(v.v)) AS q
  FROM p JOIN w ON w.lang = p.lang JOIN v ON v.lang = p.lang GROUP BY p.lang, p.term),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source WHERE a.lang NOT IN (SELECT lang FROM v)
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, ((p.p - l.q) * (p.p - l.q)) // l.q FROM p JOIN l ON l.lang = p.lang AND l.term = p.term WHERE p.n > 0 AND p.p > l.q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM f)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 200"""
