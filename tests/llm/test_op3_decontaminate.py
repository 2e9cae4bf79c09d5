import numpy as np
import pytest
from conftest_llm import SMALL, frame, tally

from racelake.llm import op3_decontaminate as op

ITEMS = [(1, "What is the colour of the seventh stone under the old bridge near Lund? It is a pale green one."),
         (2, "Alpha beta gamma delta epsilon zeta. Eta theta iota kappa lambda mu nu xi."),
         (3, "tiny"), (4, None), (5, ""), (6, " ?! "), (None, "name every river that runs north through three old towns")]


def filler(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(f"v{x}" for x in rng.integers(0, 5000, n))


def items(spark, rows=None):
    return spark.createDataFrame([(i, t, "x") for i, t in rows or ITEMS], "item_id long, text string, doc_id string")


def test_query_finds_every_verbatim_item(spark, small):
    import duckdb
    bench = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id) for r in op.op3_decontaminate(spark, SMALL).collect()}
    want = {(i, k) for i, t in small for k, x in bench if x in t}
    assert want <= got
    texts, bench = dict(small), dict(bench)
    norm = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    for i, k in got - want:  # the rest are the same words in other spelling
        assert " ".join(norm(bench[k])) in " ".join(norm(texts[i]))


def test_planted_and_clean_documents(spark, odd):
    q1, q2, q7 = ITEMS[0][1], ITEMS[1][1], ITEMS[-1][1]
    docs = [(100, filler(500, 1) + " " + q1 + " " + filler(300, 2)), (101, q2.upper()), (102, q7 + filler(90, 3)),
            (103, q1.split("?")[0] + " " + filler(200, 4)),              # the question without its answer
            (104, " ".join(reversed(q2.split()))),                        # the words in another order
            (105, filler(3000, 5)), (106, "tiny"), (None, q1), (107, q1 + " " + q2)]
    got = tally(op.contaminated(frame(spark, odd + docs), items(spark)).collect(), "doc_id", "item_id")
    assert got == sorted([(100, 1), (101, 2), (102, None), (106, 3), (None, 1), (107, 1), (107, 2)], key=repr)
    kept = op.clean(frame(spark, odd + docs), items(spark))
    assert kept.schema == frame(spark, odd).schema and kept.count() == len(odd) + 3


def test_bounds_lose_nothing():
    """Retrieval equals scoring every (passage, item) pair."""
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [(k, " ".join(rng.choice(vocabulary, rng.integers(3, 30)))) for k in range(70)]
    index = op.Index(texts)
    dense = np.zeros((len(index.terms), index.n))
    for key, a, b in zip(index.keys, index.at, index.at[1:]):
        dense[key // index.blocks, index.item[a:b]] = index.impact[a:b]
    passages = [np.unique(rng.integers(0, len(index.terms), rng.integers(1, 40))) for _ in range(200)]
    got = index.retrieve(np.repeat(np.arange(200), [len(p) for p in passages]), np.concatenate(passages))
    score = np.stack([dense[p].sum(0) for p in passages])
    want = np.argwhere(score >= index.cutoff)  # at most ``THRESHOLD``
    assert index.cutoff.max() == op.THRESHOLD
    assert want.tolist() == np.stack(got[:2], axis=1).tolist() and len(want)
    np.testing.assert_allclose(got[2], score[tuple(want.T)])


def test_shards_and_empty_tables(spark, no_docs, monkeypatch):
    assert op.contaminated(no_docs, items(spark)).collect() == []
    empty = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, [(1, ITEMS[0][1]), (2, ITEMS[1][1])])
    assert op.contaminated(docs, empty).collect() == [] and op.clean(docs, empty).count() == 2
    monkeypatch.setattr(op, "SHARD_ITEMS", 2)
    assert tally(op.contaminated(docs, items(spark)).collect(), "doc_id", "item_id") == [(1, 1), (2, 2)]
    assert op.clean(docs, items(spark)).count() == 0


def test_hits_and_scores_do_not_depend_on_the_shards(spark, monkeypatch):
    rng = np.random.default_rng(8)
    common = [f"c{i}" for i in range(40)]
    bench = []
    for k in range(60):
        q = " ".join([*rng.choice(common, 20), f"rare{k}", f"seldom{k}", *rng.choice(common, 6)])
        bench.append((k, f"What {q}? The answer {k} is {' '.join(rng.choice(common, 8))}."))
    docs = [(k, filler(40, k) + " " + t.replace(f"seldom{k}", "other") + " " + filler(60, 99 + k)) for k, t in bench]
    got = []
    for size, n in ((60, 60), (15, 60), (5, 5), (1, 5)):
        monkeypatch.setattr(op, "SHARD_ITEMS", size)
        rows = op.contaminated(frame(spark, docs[:12]), items(spark, bench[:n])).collect()
        got.append(sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in rows))
    assert got[0] == got[1] and got[2] == got[3] and len(got[0]) == 12 and len(got[2]) == 5


def test_retrieval_loses_nothing_that_the_verification_accepts():
    """Words missing in turn from every item, heaviest first: whatever verifies is retrieved."""
    rng = np.random.default_rng(21)
    common = [f"c{i}" for i in range(30)]
    bench = []
    for k in range(40):
        n = int(rng.integers(3, 40))
        q = [f"r{k}x{j}" if rng.random() < 0.15 else str(rng.choice(common)) for j in range(n)]
        if k % 8 == 0:
            q = (q[:7] * 6)[:40]  # shingles that repeat
        bench.append((k, " ".join(q) + "? " + " ".join(rng.choice(common, rng.integers(1, 12)))))
    index = op.Index(bench)
    accepted = low = 0
    for k, text in bench:
        words = text.replace("?", " ?").split(" ")
        impact = {int(index.terms[key // index.blocks]): index.impact[a + np.flatnonzero(index.item[a:b] == k)]
                  for key, a, b in zip(index.keys, index.at, index.at[1:]) if (index.item[a:b] == k).any()}
        weight = lambda w: float(impact.get(int(op._hashes(w)[0]), [0])[0]) if len(op._hashes(w)) else 0
        for trial in range(60):
            gone = set(sorted(set(words), key=lambda w: -weight(w) * (1 if trial < 8 else rng.random()))[:1 + trial % 8])
            passage = op._hashes(" ".join("zz" if w in gone else w for w in words))
            q = np.isin(index.question[k], op._all_shingles(passage, index.question[k])).mean()
            a = np.isin(index.answer[k], passage).mean()
            if q >= op.OVERLAP and a >= op.OVERLAP:
                at = np.searchsorted(index.terms, passage)
                known = np.unique(at[index.terms[np.minimum(at, len(index.terms) - 1)] == passage])
                _, item, score = index.retrieve(np.zeros(len(known), np.int64), known)
                assert k in item
                accepted += 1
                low += score[list(item).index(k)] < op.THRESHOLD
    assert accepted > 100


@pytest.mark.parametrize("text,parts", [("A b? C d.", ("A b?", " C d.")), ("One two.", ("One two.", "One two.")),
                                        ("A b. C d. E f.", ("A b. C d.", "E f.")), ("Why?", ("Why?", "Why?"))])
def test_split_item(text, parts):
    assert op.split_item(text) == parts
