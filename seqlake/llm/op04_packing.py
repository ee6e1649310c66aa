"""Packing by power-of-two decomposition.

A document's ids with the closing id are cut into pieces whose lengths are
powers of two: as many of the longest allowed as fit, then the binary digits
of the rest, largest first.  Every piece is a sequence of its own and equal
lengths share a bucket, so a batch drawn from one bucket has no padding and
no sequence crosses documents.  Nothing is shuffled: a task cuts the
documents that it reads, and a lost task repeats alone.

Ids come from tiktoken over the vocabulary's ranks.  Its pattern backtracks and
its merging takes the square of a word's length, so a text with a run of
``RUN`` bytes or more without a change between blank and other bytes is encoded
by the trie of :mod:`op01_bpe`, whose time is in proportion to a word's length.

Null and empty texts have only the closing id (one piece of length 1);
a very long text has many pieces, whatever runs it holds; repeated rows are packed each on its own;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANK_WORDS, table, texts_of
from .op01_bpe import Vocabulary, default_vocabulary, encoder, groups

# Fixed value: the public byte-level pattern that cuts texts into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longest sequence, a power of two, and the id that closes a document.
MAX_LENGTH = 2048
END_ID = 1
#: Bytes of a run without a change between blank and other bytes that are too many for a backtracking pattern.
RUN = 1 << 14

_tokenizers: dict[str, tiktoken.Encoding] = {}


def tokenizer(path: str) -> tiktoken.Encoding:
    """The vocabulary file as ranks; one per Python worker. Its ids are in order of its merges."""
    if path not in _tokenizers:
        v = Vocabulary(path)
        _tokenizers[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=v.ids, special_tokens=v.added)
    return _tokenizers[path]


def has_long_run(text: str) -> bool:
    """Whether ``RUN`` bytes in a row are all blanks or all other bytes."""
    if len(text) * 4 < RUN:
        return False
    inside = BLANK_WORDS[np.frombuffer(text.encode(), np.uint8)]
    change = np.flatnonzero(inside[1:] != inside[:-1])
    return bool(np.diff(change, prepend=-1, append=len(inside) - 1).max(initial=0) >= RUN)


def ids_of(text: str, path: str) -> np.ndarray:
    """Ids of one text; strings of added tokens count as those."""
    enc = tokenizer(path)
    if has_long_run(text):
        _, ids = next(encoder(path).encode_batch([text]))
        return np.array(ids.split(","), "<u4") if ids else np.zeros(0, "<u4")
    return enc.encode_to_numpy(text, allowed_special=set(enc.special_tokens_set), disallowed_special=())


def lengths(n: int, longest: int = MAX_LENGTH) -> list[int]:
    """Piece lengths of a document of n ids: full pieces, then the binary digits of the rest."""
    full, rest = divmod(n, longest)
    return [longest] * full + [1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, vocabulary: str, longest: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, bucket
    (log2 of the length), sequence_id, offset (0: a piece fills its sequence)."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4")
        rests = {}
        for b in batches:
            at = 0
            for texts in groups(texts_of(b)):
                parts, cut, pieces, totals = [], [], [], []
                for t in texts:
                    ids = ids_of(t, vocabulary)
                    n = len(ids) + 1
                    parts += [ids, end]
                    full, rest = divmod(n, longest)
                    if rest not in rests:
                        rests[rest] = lengths(rest, longest)
                    own = [longest] * full + rests[rest]
                    cut += own
                    pieces.append(len(own))
                    totals.append(n)
                flat = np.concatenate(parts).astype("<u4", copy=False)
                cut = np.array(cut, np.int64)
                ends = np.cumsum(cut)
                doc = np.repeat(np.arange(len(texts)), pieces)
                first = np.concatenate([[0], np.cumsum(totals)[:-1]])
                bounds = np.concatenate([[0], ends * 4]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(at, len(texts)).take(pa.array(doc)), pa.array(ends - cut - first[doc]), pa.array(cut),
                    pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(bounds), pa.py_buffer(flat)]),
                    pa.array(np.array(totals, np.int64)[doc]), pa.array(np.log2(cut).round().astype(np.int32)),
                ], names=["doc_id", "start", "length", "ids", "doc_tokens", "bucket"])
                at += len(texts)

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, bucket int")
    return out.select("*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(pieces: DataFrame, path: str, files_per_bucket: int = 64) -> None:
    """Write the sequences by bucket, each bucket dealt over a number of files, for batches of equal length."""
    deal = F.pmod(F.xxhash64("sequence_id"), F.lit(files_per_bucket))
    pieces.repartition("bucket", deal).write.partitionBy("bucket").parquet(path)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents"), default_vocabulary()))
