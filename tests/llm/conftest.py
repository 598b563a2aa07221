from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark, tmp_path):
    """A documents table of (doc_id, text), or wider rows, that lies in a file."""

    def make(rows, schema="doc_id long, text string"):
        path = f"{tmp_path}/{len(list(tmp_path.iterdir()))}.parquet"
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.parquet(path)

    return make


#: Nulls in every column, empty, blank and very long texts, ties and repeated rows.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog again and again"),
    (1, "The quick brown fox jumps over the lazy dog again and again"),
    (1, "another text under the same id"),
    (None, "The quick brown fox jumps over the lazy dog again and again"),
    (None, None),
    (2, None),
    (3, ""),
    (4, " \n\t \n\n"),
    (5, "x" * 30_000),
    (6, "word " * 20_000),
    (7, "\n".join(f"line {i % 7}" for i in range(5000))),
    (8, "日本語 テキスト 😀 é à ñ"),
    (9, "one"),
]

#: Columns whose names operators might use themselves.
CLASHING = (
    "doc_id long, text string, key long, sid long, n long, list long, pos int, root long, hits string, spans string, "
    "row string, stats string, digest string, keeper string, length int, start int, rank int, _key long, _hash long, "
    "text_hash long, _id long, _gone long, _first int, _left string, _dots string, hot string, k1 long, label double, words string, marks string, score double, kind int, value string, lines string"
)


@pytest.fixture
def odd():
    return list(ODD)


@pytest.fixture
def clashing(docs):
    width = CLASHING.count(",")
    return lambda rows: docs([(a, b, *[None] * (width - 1)) for a, b in rows], CLASHING)
