"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct words of each Arrow batch that the task has not met yet go
into a byte trie.  A depth-first walk gives every node the *last token* of
the encoding of the prefix it stands for: the one vocabulary entry that ends
there and may follow the last token of the prefix before it.  A prefix shared
by many words is worked out once, and a word's ids are read back from its
node to the root.  Known words stay in a cache of bounded size; when it is
full it starts anew, which costs time and changes no result.

Null text counts as empty, an empty text has no ids; very long words cost
time in proportion to their length; repeated rows repeat; an empty table gives
an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import table, texts_of

# Fixed value: the pattern by which the public vocabulary's texts are cut into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Words kept by a task before its cache starts anew.
CACHE_WORDS = 1_500_000
#: Words longer than this many bytes are worked out each time and not kept.
CACHE_BYTES = 256


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in the vocabulary file: printable bytes as themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merge ranks and added tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        raw = lambda t: bytes(letters[c] for c in t)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        self.bytes = {i: t for t, i in self.ids.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes |= {i: t.encode() for t, i in self.added.items()}
        # rank of a merge by its two ids; the first way to make a token is how BPE makes it
        self.merge: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = (raw(x) for x in (m if isinstance(m, list) else m.split(" ")))
            pair, made = (self.ids[a], self.ids[b]), self.ids[a + b]
            self.merge.setdefault(pair, r)
            if made not in self.parts:
                self.parts[made], self.rank[made] = pair, r
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self._whole()
        self.follow: list[dict[int, bool]] = [{} for _ in range(max(self.bytes) + 1)]      # of a token: may it follow this one

    def _whole(self) -> None:
        """Keep as possible last tokens those that BPE makes of their own bytes; other endings of them map to -1."""
        self.reach = {t: i for t, i in self.ids.items() if len(t) == 1 or i in self.parts and self._fits(*self.parts[i], below=self.rank[i])}
        self.tails = {t[k:]: -1 for t in self.reach for k in range(len(t))} | self.reach

    def _fits(self, left: int, right: int, below: float = float("inf")) -> bool:
        """No merge across the border of two tokens comes before the merges that made them (or before ``below``).

        The tokens that touch the border while ``left`` grows are its
        right-hand parts, those of ``right`` its left-hand parts.  A token is
        there until the merge that takes it in, at whose rank the pair
        further left goes first.
        """
        spine_l, gone_l = [left], [below]
        while spine_l[-1] in self.parts:
            gone_l.append(self.rank[spine_l[-1]])
            spine_l.append(self.parts[spine_l[-1]][1])
        spine_r, gone_r = [right], [below]
        while spine_r[-1] in self.parts:
            gone_r.append(self.rank[spine_r[-1]])
            spine_r.append(self.parts[spine_r[-1]][0])
        for a, until_a in zip(spine_l, gone_l, strict=True):
            for b, until_b in zip(spine_r, gone_r, strict=True):
                r = self.merge.get((a, b))
                if r is not None and r < until_a and (r <= until_b if until_b != below else r < below):
                    return False
        return True

    def learn_pair(self, left: int, right: int) -> bool:
        known = self.follow[right]
        if len(known) > 4096:
            known.clear()
        known[left] = ok = self._fits(left, right)
        return ok


class TrieEncoder:
    """Encodes words through one trie per call of :meth:`encode_words`.

    The trie is held in its depth-first order, as the sorted words: a word
    branches off the one before it where their common prefix ends, and the walk
    keeps the states of the nodes from the root to where it is.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary

    def encode_words(self, words: Iterable[bytes]) -> dict[bytes, list[int]]:
        """Ids of distinct words; each node's last token is found once, when the walk reaches it."""
        out: dict[bytes, list[int]] = {}
        tails, follow, fits = self.v.tails, self.v.follow, self.v.learn_pair
        last = [-1]                     # last[d]: last token of the prefix of length d
        size = [0]                      # its length in bytes
        before = b""
        for w in sorted(words):
            m = min(len(before), len(w))
            differ = int.from_bytes(before[:m], "big") ^ int.from_bytes(w[:m], "big")
            shared = m - (differ.bit_length() + 7) // 8
            del last[shared + 1:], size[shared + 1:]
            for d in range(shared + 1, len(w) + 1):
                k = size[d - 1] + 1                     # most often the token before goes on
                token = tails.get(w[d - k:d], -1)
                if token >= 0:
                    left = last[d - k]
                    ok = True if left < 0 else follow[token].get(left)
                    if ok is None:
                        ok = fits(left, token)
                if token < 0 or not ok:
                    k = 0
                    while True:
                        k += 1
                        token = tails.get(w[d - k:d], -2) if k <= d else -2
                        if token == -2:
                            raise ValueError(f"no token can end {w[:d]!r}")
                        if token >= 0:
                            left = last[d - k]
                            ok = True if left < 0 else follow[token].get(left)
                            if ok is None:
                                ok = fits(left, token)
                            if ok:
                                break
                last.append(token)
                size.append(k)
            ids, d = [], len(w)
            while d:
                ids.append(last[d])
                d -= size[d]
            ids.reverse()
            out[w] = ids
            before = w
        return out


class Encoder:
    """Whole texts to ids; keeps the vocabulary and the word cache of one Python worker."""

    def __init__(self, path: str):
        self.v = Vocabulary(path)
        self.trie = TrieEncoder(self.v)
        self.pattern = regex.compile(WORD_PATTERN)
        self.cache: dict[str, str] = {}
        self.token = {str(i): t for i, t in self.v.bytes.items()}

    def words(self, text: str) -> list[str]:
        """The words of a text; an added token is a word of its own."""
        if self.v.special is None or not any(t in text for t in self.v.added):
            return self.pattern.findall(text)
        out, at = [], 0
        for m in self.v.special.finditer(text):
            out += self.pattern.findall(text[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + self.pattern.findall(text[at:])

    def learn(self, used: set[str]) -> None:
        """Put the words of a batch into the cache."""
        new = used - self.cache.keys()
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = used
        coded = self.trie.encode_words({w.encode() for w in new if w not in self.v.added})
        for w in new:
            ids = [self.v.added[w]] if w in self.v.added else coded[w.encode()]
            self.cache[w] = ",".join(map(str, ids))

    def encode_batch(self, texts: list[str]) -> Iterator[tuple[int, str]]:
        """(number of ids, ids as decimal text joined by commas) of each text."""
        split = [self.words(t) for t in texts]
        self.learn(set().union(*split))
        for ws in split:
            ids = ",".join(map(self.cache.__getitem__, ws))
            yield (ids.count(",") + 1 if ids else 0), ids
        for w in [w for ws in split for w in ws if len(w) > CACHE_BYTES]:
            self.cache.pop(w, None)

    def decode(self, ids: str) -> str:
        """Text of ids given as decimal text; bytes that are no UTF-8 become the replacement character."""
        return b"".join(map(self.token.__getitem__, ids.split(","))).decode("utf-8", "replace") if ids else ""


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def groups(texts: pa.Array, limit: int = 2 << 20) -> Iterator[list[str]]:
    """Texts in runs of about ``limit`` characters."""
    run, size = [], 0
    for t in texts:
        t = t.as_py()
        run.append(t)
        size += len(t)
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            at = 0
            for texts in groups(texts_of(b)):
                ids = [np.array(s.split(","), np.int32) if s else np.zeros(0, np.int32) for _, s in enc.encode_batch(texts)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
                at += len(texts)

    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return src.mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids give an empty text."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            texts = [enc.decode(",".join(map(str, ids or ()))) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Digest columns of every text's ids and of the text decoded from them, made in one pass over the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            at = 0
            for texts in groups(texts_of(b)):
                n, one, two = [], [], []
                for k, ids in enc.encode_batch(texts):
                    n.append(k)
                    one.append(hashlib.sha256(ids.encode()).hexdigest())
                    two.append(hashlib.sha256(enc.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(one), pa.array(two)],
                                                 names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                at += len(texts)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def default_vocabulary() -> str:
    """The public 50k byte-level vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), default_vocabulary())
