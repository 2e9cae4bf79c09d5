"""Documents with the awkward cases of every operator: nulls, empty and very long texts, ties,
repeated rows, clashing column names."""

import random

import duckdb
import pytest

from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"
# "key", "block", "node", "row" and "lost" are names the operators use inside
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("key", T.StringType()),
                     T.StructField("block", T.LongType()), T.StructField("node", T.StringType()),
                     T.StructField("row", T.StringType()), T.StructField("lost", T.LongType()),
                     T.StructField("n_chars", T.LongType())])


def odd_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    words = [f"w{i}x" for i in range(300)] + ["the", "of", "Zürich", "naïve", "日本", "😀"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long = prose(30_000)
    passage = prose(60)
    near = prose(120).split(" ")
    edited = near.copy()
    edited[60] = "changed"
    far = near.copy()
    for i in (10, 40, 70, 100):
        far[i] = f"other{i}"
    body = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "one"), (5, "one two three four"), (6, "One TWO three four"),
            (7, long), (8, prose(80) + "\n" + passage), (9, passage + " " + prose(70)),
            (10, prose(40) + "\n" + passage + "\n" + passage), (11, " ".join(near)), (12, " ".join(edited)),
            (13, " ".join(far)), (14, " ".join(near)), (15, "a" * 200), (16, "a" * 120 + "b"), (17, "\x00\x1f.é" * 40),
            (18, "same line of a few words here\n" * 6 + prose(30)), (19, "same line of a few words here"),
            (20, prose(30) + "\n\n\n" + prose(9)), (None, " ".join(near)), (None, None), (21, prose(200)),
            (21, prose(200)), (-3, prose(60) + " " + passage), (8, prose(80))]
    return body + [body[8], body[4], body[-1], (30, long[:5000]), (31, long[2000:9000])]


@pytest.fixture(scope="session")
def odd():
    return odd_texts()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "k", 1, "n", "r", 2, None if t is None else len(t)) for i, t in rows],
                                 DOCS)


@pytest.fixture(scope="session")
def odd_docs(spark, odd):
    return frame(spark, odd)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small():
    """(doc_id, text) of the smallest table."""
    return duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY 1").fetchall()


def words(text):
    return (text or "").encode().split()


def tally(rows, *cols):
    """Rows as a sorted list of tuples, so repeated rows count."""
    return sorted((tuple(r[c] for c in cols) for r in rows), key=repr)
