"""Token counts: batch encoding in Arrow functions that return lengths only.

Every text is cut into pieces of about ``PIECE`` bytes at safe boundaries,
places where no word of the vocabulary's word pattern and no added token
can reach across, so the counts of the pieces add up to that of the text.
Pieces are handed to the tokenizers library in calls of about ``CALL`` bytes,
whatever the number of texts that makes; nothing but the number of ids is kept.

A stretch without a safe boundary (a long run of blanks or of letters
without blanks) is counted word by word; a word longer than ``WORD`` bytes is
counted from left to right by the last token of each prefix, of which only
as many are kept as the longest token has bytes.  Memory therefore depends
on neither the longest text nor the longest word.

Null text counts as empty: 0 bytes, 0 tokens.  Repeated rows are counted each
on its own, an empty table gives an empty table, other columns are not read.
Strings of added tokens inside a text count as those tokens, as is the
library's default.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType, LongType, BooleanType

from .common import buffers, spare, table, texts_of
from .op01_bpe import WORD_PATTERN, Vocabulary, default_vocabulary

#: Bytes of text per call of the library, characters per piece of a long text, and bytes of a word that is counted by prefixes.
CALL = 1 << 20
PIECE = 1 << 18
WORD = 1 << 16
#: Documents with more tokens are over the limit.
LIMIT = 512

# A word ends before an ASCII blank that follows anything else, where ASCII letters and digits meet, where either meets
# ASCII punctuation, and between common East Asian letters and their punctuation.
_SAFE = regex.compile(
    r"[^\s᠎](?=[ \t\n\r])|[A-Za-z](?=[0-9!-/:-@\[-`{-~])|[0-9](?=[A-Za-z!-/:-@\[-`{-~])"
    r"|[ぁ-ゖァ-ヺ一-龥가-힣](?=[、。！，？])")


class Counter:
    """Counts the tokens of texts by one vocabulary file; one per Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        from tokenizers import Tokenizer
        self.path = path
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            self.added = sorted((t["content"] for t in json.load(f)["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        self.pattern = regex.compile(WORD_PATTERN)
        self._vocabulary: Vocabulary | None = None

    @property
    def vocabulary(self) -> Vocabulary:
        if self._vocabulary is None:
            self._vocabulary = Vocabulary(self.path)
        return self._vocabulary

    def inside_added(self, text: str, at: int) -> bool:
        """Whether an added token reaches across a place of a text."""
        return any(text.find(a, max(0, at - len(a) + 1), at + len(a) - 1) >= 0 for a in self.added)

    def pieces(self, text: str, size: int) -> Iterator[str]:
        """A text in pieces of about ``size`` characters, longer ones where no safe boundary comes."""
        at = 0
        while len(text) - at > size:
            cut = at + size // 2
            while m := _SAFE.search(text, cut):
                cut = m.end()
                if not self.inside_added(text, cut):
                    break
            else:
                break
            yield text[at:cut]
            at = cut
        yield text[at:] if at else text

    def words(self, text: str) -> Iterator[str]:
        """The words of a text one after the other; an added token is a word of its own."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield from (w.group() for w in self.pattern.finditer(text, at, m.start()))
            yield m.group()
            at = m.end()
        yield from (w.group() for w in self.pattern.finditer(text, at))

    def word_tokens(self, word: bytes) -> int:
        """Number of tokens of one word, from the last tokens of its prefixes, kept as far back as a token reaches."""
        v = self.vocabulary
        tails, follow = v.tails, v.follow
        ring = max(map(len, v.reach)) + 1
        last, size, count = [-1] * ring, [0] * ring, [0] * ring
        for d in range(1, len(word) + 1):
            k = size[(d - 1) % ring]            # most often the token before goes on
            for k in (k + 1, *range(1, ring)):
                token = tails.get(word[d - k:d], -2) if k <= d and k < ring else -2
                if token < 0:
                    continue
                left = last[(d - k) % ring] if d > k else -1
                ok = left < 0 or follow_ok(v, follow, left, token)
                if ok:
                    break
            else:
                raise ValueError(f"no token can end {word[max(0, d - 40):d]!r}")
            last[d % ring], size[d % ring], count[d % ring] = token, k, (count[(d - k) % ring] if d > k else 0) + 1
        return count[len(word) % ring] if word else 0

    def stretch_tokens(self, text: str) -> int:
        """Tokens of a stretch without safe boundaries, word by word."""
        total, run, held = 0, [], 0
        for w in self.words(text):
            n = len(w.encode())
            if n > WORD:
                total += self.word_tokens(w.encode())
                continue
            run.append(w)
            held += n
            if held >= CALL or len(run) >= CALL >> 6:
                total += sum(self.lengths(run))
                run, held = [], 0
        return total + sum(self.lengths(run))

    def lengths(self, texts: list[str]) -> list[int]:
        """Numbers of ids of texts, by one call of the library."""
        return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def count(self, texts: pa.Array, size: int = PIECE, call: int = CALL) -> np.ndarray:
        """Number of tokens of every text of a string array."""
        out = np.zeros(len(texts), np.int64)
        run, owner, held = [], [], 0

        def flush() -> None:
            np.add.at(out, owner, self.lengths(run))
            run.clear(), owner.clear()

        for i in range(len(texts)):
            for piece in self.pieces(texts[i].as_py(), size):
                if len(piece) > 4 * size:
                    out[i] += self.stretch_tokens(piece)
                    continue
                n = len(piece) if piece.isascii() else len(piece.encode())
                if held + n > call and run:
                    flush()
                    held = 0
                run.append(piece)
                owner.append(i)
                held += n
        flush()
        return out


def follow_ok(v: Vocabulary, follow: list[dict[int, bool]], left: int, token: int) -> bool:
    """Whether a token may come after another one, worked out once."""
    known = follow[token].get(left)
    return v.learn_pair(left, token) if known is None else known


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, vocabulary: str, keep: tuple[str, ...] = ("doc_id",), limit: int = LIMIT) -> DataFrame:
    """The columns ``keep`` of documents with n_bytes (UTF-8), n_tokens and over_limit (more tokens than ``limit``)."""
    schema = StructType([*docs.select(*keep).schema.fields, StructField("n_bytes", LongType()), StructField("n_tokens", LongType()),
                         StructField("over_limit", BooleanType())])
    text = spare(docs, "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary)
        for b in batches:
            if not b.num_rows:
                continue
            texts = texts_of(b, text)
            n = c.count(texts)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.diff(buffers(texts)[1])), pa.array(n), pa.array(n > limit)], names=schema.names)

    return docs.select(*keep, docs["text"].alias(text)).mapInArrow(run, schema)


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), default_vocabulary())
