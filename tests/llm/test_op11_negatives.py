import duckdb
import numpy as np
import pytest
from conftest_llm import SMALL, tally
from vectors_llm import dot, frame, integers, odd_vectors

from pyspark.sql import functions as F

from racelake.llm import _vectors as V
from racelake.llm import op11_negatives as op

COLS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows):
    out = []
    for a in rows:
        if a[0] % 50:
            continue
        near = sorted((-dot(a[1], p[1]), p[0]) for p in rows if p[2] == a[2] and p != a)[:5]
        far = sorted((-dot(a[1], n[1]), n[0]) for n in rows if n[2] != a[2])
        for ps, pid in near:
            hit = [(s, i) for s, i in far if -50 * ps <= -100 * s <= -95 * ps][:3]
            out += [(a[0], pid, r + 1, i, -ps, -s) for r, (s, i) in enumerate(hit)]
    return sorted(out, key=repr)


def moved(rows):
    return sorted({(i, z, (label + 1) % 10 if i % 7 == 0 else label) for i, z, label in rows if label is not None}, key=repr)


def mined(spark, df, **how):
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return op.mine(spark, V.integer_vectors(df, op.SCALE, label=label), F.col("vec_id") % 50 == 0, **how).collect()


@pytest.mark.parametrize("seed", [4, 5])
def test_odd_vectors_over_many_blocks_equal_brute_force(spark, seed):
    rows = odd_vectors(seed=seed, width=20)
    got = mined(spark, frame(spark, rows), anchor_rows=5, stripe_rows=90)
    want = brute(moved(integers(rows, 256, 20)))
    assert len(want) > 50
    assert tally(got, *COLS) == want


def test_huge_components_equal_brute_force(spark):
    for size in (1e4, 4e5):
        rows = [(10 * i, [size * x for x in v], i % 2) for i, v, _ in odd_vectors(120, 20, 6)[:60]]
        assert tally(mined(spark, frame(spark, rows)), *COLS) == brute(moved(integers(rows, 256, 20)))


def test_small_table_equals_brute_force_and_sql(spark):
    got = op.op11_negatives(spark, SMALL)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
                          ("positive_score", "bigint"), ("negative_score", "bigint")]
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SMALL}/embeddings.parquet'").fetchall()
    got = tally(got.collect(), *COLS)
    assert got == brute(moved(integers(rows, 256, 64)))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
        assert got == sorted(con.sql(op.ORACLE).fetchall(), key=repr)


def test_empty_table_single_rows_and_lone_labels(spark):
    assert mined(spark, frame(spark, [])) == []
    assert mined(spark, frame(spark, [(50, [1.0, 2.0], 3)])) == []
    assert mined(spark, frame(spark, [(50, [1.0, 2.0], 3), (51, [1.0, 1.0], 3)])) == []


def test_the_bitmap_shrinks_before_all_columns_are_read():
    """A candidate far off goes after the anchor's largest components alone."""
    rng = np.random.default_rng(2)
    rows = rng.integers(-3, 4, (400, 64)).astype("<i2")
    rows[:6, :4] = 90
    shape = V.Shape(400, 64, "<i2", "<f4")
    stripe = op.Stripe(shape, {"r_ids": np.arange(400, dtype="<i8").tobytes(), "r_labels": bytes(3200),
                               "r_data": rows.tobytes(), "r_n": 400})
    a = rows[0].astype("<f4")
    sizes = []

    def watched(part, least, most, alive):
        kept = op.best_rows(5)(part, least, most, alive)
        sizes.append(int((alive & kept).sum()))
        return kept

    at, score = stripe.scan(a, np.ones(400, bool), watched)
    exact = rows.astype(int) @ rows[0].astype(int)
    assert sizes[0] < 400 and len(sizes) == 8
    assert set(np.argsort(-exact, kind="stable")[:5]) <= set(at) and (exact[at] == score).all()
