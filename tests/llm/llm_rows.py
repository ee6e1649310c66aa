"""Rows that the tests of the training-data operators share."""

import random
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, cls string, block int, __text string"


def words(seed: int, n: int, vocabulary: int = 4000) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x" for _ in range(n))


def is_held_out(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4 == 2


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows, a hot text."""
    hot = words(1, 120)
    long = words(2, 30_000, 50_000)
    texts = [None, "", " \t\n", "one", "one two three", "Straße NAÏVE 日本語 <|endoftext|> x\x1cy", hot, hot, hot + " tail", long, "12 34 !!", words(3, 200)]
    rows = [(i, t, None if i % 3 == 0 else "en", None, None if t is None else len(t), 0.5, "c", 1, "t") for i, t in enumerate(texts)]
    rows += [rows[6]] * 3 + [rows[11]] + [(None, hot, "en", "s", 1, None, None, None, None), (None, None, None, None, None, None, None, None, None),
                                        (None, words(9, 60), "fr", None, None, None, None, None, None)]
    return rows
