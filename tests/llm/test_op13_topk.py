import duckdb
import numpy as np
import pytest
from conftest_llm import SMALL, tally
from vectors_llm import dot, frame, integers, odd_vectors

from pyspark.sql import functions as F

from racelake.llm import _vectors as V
from racelake.llm import op13_topk as op

COLS = ("query_id", "rank", "vec_id", "score")


def brute(rows, k=20, step=20):
    out = []
    for q in rows:
        if q[0] % step == 0:
            found = sorted((-dot(q[1], c[1]), c[0]) for c in rows if c[:2] != q[:2])[:k]
            out += [(q[0], r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out, key=repr)


def search(spark, df, **how):
    return op.top_k(spark, V.integer_vectors(df, op.SCALE), F.col("vec_id") % 20 == 0, **how).collect()


def plain(rows):
    return sorted({(i, z) for i, z, _ in rows}, key=repr)


@pytest.mark.parametrize("slices", [1, 2, 3])
def test_odd_vectors_over_many_blocks_equal_brute_force(spark, slices):
    rows = odd_vectors()
    got = search(spark, frame(spark, rows), slices=slices, query_rows=16, stripe_rows=90)
    assert tally(got, *COLS) == brute(plain(integers(rows, 64, 9)))


def test_fewer_rows_than_k_and_huge_components(spark):
    rows = [(20 * i, [float(i), 1e6 * i, -3.0], 0) for i in range(6)]     # sums beyond 2**24
    got = search(spark, frame(spark, rows))
    assert tally(got, *COLS) == brute(plain(integers(rows, 64, 3)))
    rows = [(20 * i, [float(i), 4e6 * i, -1e7], 0) for i in range(6)]     # beyond 2**53
    got = search(spark, frame(spark, rows))
    assert tally(got, *COLS) == brute(plain(integers(rows, 64, 3)))


def test_small_table_equals_brute_force_and_sql(spark):
    got = op.op13_topk(spark, SMALL)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SMALL}/embeddings.parquet'").fetchall()
    got = tally(got.collect(), *COLS)
    assert got == brute(plain(integers(rows, 64, 64)))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
        assert got == sorted(con.sql(op.ORACLE).fetchall(), key=repr)


def test_empty_tables_and_no_queries(spark):
    assert search(spark, frame(spark, [])) == []
    assert search(spark, frame(spark, [(3, [1.0], 0), (4, [2.0], 0)])) == []
    assert search(spark, frame(spark, [(20, [], 0), (4, [2.0], 0)]))[0]["score"] == 0


def test_uniform_cutoff_leaves_out_only_rows_that_cannot_be_among_the_best(spark):
    """Phase 2 sends a part of the entries; no row of the answer is missing from them."""
    rows = [(i, v, label) for i, v, label in odd_vectors(400, 16, 8) if i is not None and i >= 0]
    vectors = V.integer_vectors(frame(spark, rows), 64).select("vec_id", "label", "z").dropDuplicates(["vec_id"])
    vectors = vectors.dropDuplicates(["z"])
    shape, n = V.Shape.of(vectors), vectors.count()
    stripes = V.blocks(spark, vectors, shape, n, 50, "stripes", 2)
    queries = V.blocks(spark, vectors.filter("vec_id % 20 = 0"), shape, 20, 8, "queries", 2)
    s = op.Search(spark, queries, stripes, shape, 5, 2)
    cutoffs = s.cutoffs(s.named(s.lists())).cache()
    entries = s.entries(cutoffs).collect()
    sent = sum(len(r["q"]) // 4 for r in entries)
    n_queries = vectors.filter("vec_id % 20 = 0").count()
    assert 5 * n_queries <= sent < 2 * n * n_queries


@pytest.mark.parametrize("slices", [1, 2])
def test_lists_merged_over_runs_of_stripes_and_chunks_of_queries_equal_brute_force(spark, monkeypatch, slices):
    """No group holds the lists of more than ``FAN`` stripes or runs of them, nor entries of more than one chunk."""
    monkeypatch.setattr(op, "FAN", 2), monkeypatch.setattr(op, "CHUNK", 4)
    met, held = [], []
    by_runs, candidates = op.Search.by_runs, op.Search.candidates

    def runs(self, lists, merge, schema):
        out = by_runs(self, lists, merge, schema).cache()
        runs_left = out.groupBy("q_block", "chunk", "slice").agg(F.sum(F.length("q") / 4).alias("n"))
        met.append((runs_left.agg(F.max("n")).first()[0], self.rows.count, self.k))
        return out

    def kept(self, entries, cutoffs):
        out = candidates(self, entries, cutoffs).cache()
        held.extend((r["chunk"], r["q"]) for r in out.select("chunk", "q").collect())
        return out

    monkeypatch.setattr(op.Search, "by_runs", runs)
    monkeypatch.setattr(op.Search, "candidates", kept)
    rows = odd_vectors()
    got = search(spark, frame(spark, rows), k=5, slices=slices, query_rows=16, stripe_rows=20)
    assert tally(got, *COLS) == brute(plain(integers(rows, 64, 9)), k=5)
    assert len(met) == 2 and all(stripes > 8 and n <= op.FAN * op.CHUNK * k for n, stripes, k in met)
    assert {c for c, _ in held} > {0}
    assert all((np.frombuffer(q, "<i4") // op.CHUNK == c).all() for c, q in held)
