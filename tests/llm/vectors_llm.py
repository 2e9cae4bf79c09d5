"""Rows of vectors with the awkward cases, and their integer form, for the vector operators."""

import math
import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("score", T.StringType()),
                       T.StructField("z", T.StringType()), T.StructField("slice", T.LongType())])


def odd_vectors(n=600, width=9, seed=4):
    """(vec_id, embedding, label): a vector that a third of the rows share, ties, nulls, non-finite values,
    repeated rows, one id with two vectors, an empty vector, short ones."""
    rng = random.Random(seed)
    hot = [rng.uniform(-1, 1) for _ in range(width)]
    rows = []
    for i in range(n):
        v = hot if i % 3 == 0 else [round(rng.uniform(-1, 1), rng.choice([1, 3])) for _ in range(width)]
        rows.append((i, list(v), rng.choice([0, 1, 1, 1, 2, 9])))
    rows += [rows[40], rows[100], rows[100], rows[7]]                     # repeated rows
    rows += [(50, [0.5] * width, 1), (100, [0.25] * width, 2)]           # one id, two vectors
    rows += [(1000, None, 1), (1020, [None] + [1.0] * (width - 1), 1), (1040, [math.nan] * width, 2),
             (1050, [math.inf] + [0.0] * (width - 1), 0), (1060, [], 1), (1100, [0.5, -0.5], 2),
             (1150, [0.1] * width, None), (None, hot, 1), (-20, hot, 1), (-50, [0.3] * width, 9)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "z", 1) for r in rows], SCHEMA)


def integers(rows, scale, width):
    """Rows that take part, once each: (vec_id, integer vector, label); components are 32-bit floats."""
    import numpy as np

    seen = set()
    for i, v, label in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        z = [math.floor(scale * float(np.float32(x))) for x in v]
        seen.add((i, tuple(z + [0] * (width - len(z))), label))
    return sorted(seen, key=repr)


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))
