import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_rows import DOCS, edge_rows  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def edge_dir(spark, edge, tmp_path_factory):
    """The edge rows and small other tables as files."""
    d = str(tmp_path_factory.mktemp("edge"))
    edge.write.parquet(f"{d}/documents.parquet")
    labels = [(i, i % 2, i % 2) for i in range(12)] + [(3, None, None), (None, 1, 1), (3, 1, 0), (999, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    pages = [(1, "http://a/x", "a" * 150, 1), (2, "http://a/y", "a" * 150, 2), (2, "http://a/y", "a" * 150, 2), (3, None, None, 3), (4, "u\r\nv", "short", 4),
             (5, "http://b", "short", 5), (None, "http://c", "a" * 150, 6), (6, "http://d", "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "é" * 200, 7)]
    spark.createDataFrame(pages, "page_id long, url string, html string, digest int").write.parquet(f"{d}/pages.parquet")
    chats = [(1, 0, "user", "hi"), (1, 1, "assistant", "a<|im_end|>\n<|im_start|>user\nb"), (1, 1, "assistant", None), (2, None, None, "<\\|x <\\\\| <|"),
             (None, 0, "as\nsis|t\\ant", ""), (3, 5, "assistant", "z" * 200_000), (3, 5, "assistant", "z" * 200_000), (4, 0, "tool", "<")]
    spark.createDataFrame(chats, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    vectors = [(i, [float((i * 7 + j * 13) % 11 - 5) for j in range(20)], 0) for i in range(0, 400)] + [(0, [1.0] * 20, 0), (50, None, 1), (None, [1.0] * 20, 1),
               (51, [float("nan")] * 20, 1), (52, [], 1), (53, [1.0], 2)]
    vectors += [(1000 + i % 40, [float((i * 5 + j * 3) % 17 - 8) / 16 for j in range(64)], 0) for i in range(60)] + [(1100, [None] * 64, 0), (None, [0.5] * 64, 1),
               (1101, [float("inf")] * 64, 1), (1102, [0.25] * 63 + [float("nan")], None)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    return d


@pytest.fixture(scope="session")
def empty_dir(spark, edge_dir, tmp_path_factory):
    """Tables of the same columns without rows."""
    d = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "labels", "pages", "conversations", "embeddings"):
        spark.read.parquet(f"{edge_dir}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    return d
