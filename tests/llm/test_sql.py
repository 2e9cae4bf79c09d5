import duckdb
import pytest
from conftest_llm import SMALL, frame

from racelake.llm import op1_suffix, op2_repetition, op8_jaccard, registry

JOBS = {"op1_suffix": op1_suffix.remove_earlier_matches, "op2_repetition": op2_repetition.repetition,
        "op8_jaccard": op8_jaccard.jaccard_components}


def same(df, con, sql):
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(got.fetchall(), key=repr)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr) == want and want


@pytest.mark.parametrize("name", JOBS)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    same(registry.QUERIES[name](spark, SMALL), con, registry.ORACLES[name])


@pytest.mark.parametrize("name", JOBS)
def test_odd_texts_equal_the_sql(spark, odd, name):
    # in the SQL an id names a document: rows without an id and repeated ids are tested beside the operators
    rows = list({i: (i, t) for i, t in odd if i is not None}.values())
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    job = JOBS[name]
    same(job(spark, frame(spark, rows)), con, registry.ORACLES[name])
