"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds the polynomial hash of each of its prefixes,
modulo two primes below 2**31; the hash of any span is the difference of two
entries over a power of the base, so equality of any two spans is one
comparison, and the longest common extension of two positions is found by
binary search.

A fingerprint has the length of the text and the prefix hashes at ``MARKS``
or fewer landmarks, whose step is a power of two; between two fingerprints the
longest common prefix is a binary search over their common landmarks, and the
longest common suffix one over span hashes cut out of the same entries.  Their
likeness is the part of the longer text that these two cover.

Texts are dealt into ranges of doc_id and sorted there, so a text and the next
one stand side by side; the first text of a range also goes to the range that
needs it as its follower.  Only those few texts travel twice.

Null text counts as empty; two empty texts are alike by 1, an empty and another
by 0.  Rows of one doc_id go by text; null ids come last.  A single document is
its own follower.  Repeated rows repeat.  An empty table gives an empty table.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Two primes and a base for each; landmarks of a fingerprint.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
MARKS = 32
#: Ranges of ids for each shuffle partition.
RANGES = 4

_powers = [np.ones(1, np.uint64) for _ in PRIMES]


def powers(k: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo prime k."""
    p = _powers[k]
    while len(p) < n:
        step = np.uint64(pow(BASES[k], len(p), PRIMES[k]))
        p = np.concatenate([p, p * step % np.uint64(PRIMES[k])])
    _powers[k] = p
    return p[:n]


class Prefixes:
    """Prefix arrays of a text: sums of code point * base**position, modulo each prime."""

    def __init__(self, text: str):
        c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        self.n = len(c)
        self.sums = []
        for k, p in enumerate(PRIMES):
            s = np.zeros(self.n + 1, np.uint64)
            if self.n:
                # terms are below 2**31, so a block of 2**32 of them adds up without overflow
                np.cumsum(c * powers(k, self.n) % np.uint64(p), out=s[1:])
            self.sums.append(s % np.uint64(p))

    def at(self, marks: np.ndarray) -> list[np.ndarray]:
        return [s[marks] for s in self.sums]

    def span(self, start: int, end: int) -> tuple[int, ...]:
        """Hash of the span [start, end), the same wherever it stands."""
        return tuple((int(s[end]) - int(s[start])) * pow(BASES[k], -start, PRIMES[k]) % PRIMES[k] for k, s in enumerate(self.sums))


def extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """Length of the longest common extension of position i of one text and j of another."""
    lo, hi = 0, min(a.n - i, b.n - j)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a.span(i, i + mid) == b.span(j, j + mid):
            lo = mid
        else:
            hi = mid - 1
    return lo


def step_of(n: int) -> int:
    """Smallest power of two by which at most MARKS landmarks cover n."""
    return 1 << max(0, (-(-n // MARKS) - 1).bit_length())


class Fingerprint:
    """Length and prefix hashes at multiples of the step, and of the whole text."""

    def __init__(self, n: int, marks: list[np.ndarray]):
        self.n, self.step, self.marks = n, step_of(n), marks

    @classmethod
    def of(cls, p: Prefixes) -> Fingerprint:
        return cls(p.n, p.at(cls.places(p.n)))

    @classmethod
    def joined(cls, a: Prefixes, cut: int, b: Prefixes, size: int) -> Fingerprint:
        """Of the first ``cut`` code points of one text and then the first ``size`` of another, from their prefix arrays."""
        at = cls.places(cut + size)
        head = np.minimum(at, cut)
        rest = at - head
        return cls(cut + size, [(a.sums[k][head] + np.uint64(pow(BASES[k], cut, p)) * b.sums[k][rest]) % np.uint64(p) for k, p in enumerate(PRIMES)])

    @staticmethod
    def places(n: int) -> np.ndarray:
        return np.append(np.arange(step_of(n), n, step_of(n)), n)

    def text(self) -> str:
        raw = np.stack(self.marks, 1).astype(">u4").tobytes()
        return struct.pack(">I", self.n).hex() + raw.hex()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        raw = bytes.fromhex(text)
        both = np.frombuffer(raw[4:], ">u4").reshape(-1, len(PRIMES)).astype(np.uint64)
        return cls(struct.unpack(">I", raw[:4])[0], [both[:, k] for k in range(len(PRIMES))])

    def prefix(self, at: int) -> tuple[int, ...]:
        """Hash of the prefix that ends at a landmark, at 0 or at the end."""
        if at == 0:
            return (0,) * len(PRIMES)
        i = len(self.marks[0]) - 1 if at == self.n else at // self.step - 1
        return tuple(int(m[i]) for m in self.marks)


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Part of the longer text that the common prefix and suffix cover, as far as the landmarks tell."""
    if a.n == b.n and all((x == y).all() for x, y in zip(a.marks, b.marks, strict=True)):
        return 1.0
    most, least = max(a.n, b.n), min(a.n, b.n)
    if least == 0:
        return 0.0
    step = max(a.step, b.step)
    lo, hi = 0, least // step
    while lo < hi:                                   # longest common prefix, in steps
        mid = (lo + hi + 1) // 2
        if a.prefix(mid * step) == b.prefix(mid * step):
            lo = mid
        else:
            hi = mid - 1
    front = lo * step
    back = 0
    if (shift := b.n - a.n) % step == 0:             # landmarks of both lie equally far from the ends
        def same(at: int) -> bool:
            """The text of a from ``at`` on is the end of b."""
            for k, p in enumerate(PRIMES):
                x = (a.prefix(a.n)[k] - a.prefix(at)[k]) * pow(BASES[k], shift, p)
                if (x - (b.prefix(b.n)[k] - b.prefix(at + shift)[k])) % p:
                    return False
            return True
        first = -(-max(front, front - shift) // step) * step
        places = [x for x in range(first, a.n, step) if 0 <= x + shift < b.n]
        lo, hi = 0, len(places)
        while lo < hi:
            mid = (lo + hi) // 2
            if same(places[mid]):
                hi = mid
            else:
                lo = mid + 1
        back = a.n - places[lo] if lo < len(places) else 0
    return min(1.0, (front + back) / most)


def edited(text: str, follower: str) -> tuple[str, int, int]:
    """(edited text, code points kept, code points taken from the next document)."""
    m = len(text) // 3
    return text[:len(text) - m] + follower[:m], len(text) - m, min(m, len(follower))


OUT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), (x.as_py() for x in b.column(3)), strict=True)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, follows, doc_id, text) sorted by range, own rows before the follower: one result per own row."""
    out: list[tuple] = []

    def result(doc: int, text: str, p: Prefixes, f: Fingerprint, nxt: str, q: Prefixes, g: Fingerprint) -> tuple:
        new, cut, size = edited(text, nxt)
        e = Fingerprint.joined(p, cut, q, size)
        # likeness is that of the fingerprints as they are written
        return doc, len(text), hashlib.sha256(new.encode()).hexdigest(), f.text(), e.text(), likeness(f, e), likeness(f, g)

    def flush() -> Iterator[pa.RecordBatch]:
        if out:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                             names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            out.clear()

    held = None
    closed = None
    for part, follows, doc, text in _rows(batches):
        if part == closed:
            continue                                   # further texts of the follower's id
        p = Prefixes(text)
        f = Fingerprint.of(p)
        if held is not None and held[0] == part:
            out.append(result(*held[1:], text, p, f))
        held = (part, doc, text, p, f)
        if follows:
            held, closed = None, part
        if len(out) >= 500:
            yield from flush()
    yield from flush()


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its text edited with the next document, by descending doc_id.

    The borders of the ranges and the first id of each range pass through the driver: a few numbers for each
    shuffle partition.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # null ids come last in descending order: they take part as the smallest number, and keep their null
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")))
    n = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    sketch = rows.agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10 * n).alias("b")).first()[0]
    borders = np.unique(np.array(sketch or [], np.int64))

    @F.pandas_udf("int")
    def part(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(borders, key.to_numpy(), "right").astype(np.int32))

    heads = sorted(((r["part"], r["head"]) for r in rows.groupBy(part("key").alias("part")).agg(F.max("key").alias("head")).collect()), reverse=True)
    own = rows.select(part("key").alias("part"), F.lit(0).alias("follows"), "key", "doc_id", "text")
    # the first text of a range follows the last one of the range above; the first of all follows the last of all
    leads = [(heads[(i + 1) % len(heads)][1], heads[i][0]) for i in range(len(heads))]
    led = F.broadcast(spark.createDataFrame(leads, "key long, part int"))       # one row per range
    extra = rows.join(led, "key").select("part", F.lit(1).alias("follows"), "key", "doc_id", "text")
    dealt = own.unionByName(extra).repartition("part").sortWithinPartitions("part", "follows", F.desc("key"), "text")
    return dealt.select("part", "follows", "doc_id", "text").mapInArrow(_pairs, OUT)


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
