import random

from conftest_llm import SMALL, frame, tally, words

from racelake.llm import _components
from racelake.llm import op8_jaccard as op

COLS = ("doc_id", "n_shingles", "component_id")


def brute(docs):
    sets = []
    for _, t in docs:
        w = [bytes(c + 32 if 65 <= c <= 90 else c for c in x) for x in words(t)]
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    groups = {}
    for k, (i, _) in enumerate(docs):
        groups.setdefault(root(k), []).append(i)
    low = {r: min((i for i in g if i is not None), default=None) for r, g in groups.items()}
    return sorted(((i, len(sets[k]), low[root(k)]) for k, (i, _) in enumerate(docs)), key=repr)


def test_query_matches_brute_force(spark, small):
    assert tally(op.op8_jaccard(spark, SMALL).collect(), *COLS) == brute(small)


def test_odd_documents(spark, odd, odd_docs):
    assert tally(op.jaccard_components(spark, odd_docs).collect(), *COLS) == brute(odd)


def test_chains_whose_ends_are_not_linked(spark):
    """Each text is linked to the next only; a group's centre cannot reach all of them."""
    rng = random.Random(3)
    base = [f"t{rng.randrange(10**6)}" for _ in range(200)]
    rows = [(100 - k, " ".join(base[8 * k:8 * k + 100])) for k in range(12)]
    rows += [(200 + k, " ".join([*base[:100], *(f"u{k}v{j}" for j in range(14))])) for k in range(30)]
    assert tally(op.jaccard_components(spark, frame(spark, rows)).collect(), *COLS) == brute(rows)


def test_empty_table(spark, no_docs):
    assert op.jaccard_components(spark, no_docs).collect() == []


def test_no_table_that_grows_with_the_documents_is_broadcast(spark, monkeypatch):
    plans = []
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    for module in (op.B, _components):
        store = module.store
        monkeypatch.setattr(module, "store", lambda spark, df, *a, store=store, **k: plan(df) or store(spark, df, *a, **k))
    rng = random.Random(3)
    base = [f"t{rng.randrange(10**6)}" for _ in range(200)]
    rows = [(100 - k, " ".join(base[8 * k:8 * k + 100])) for k in range(12)]
    rows += [(200 + k, " ".join([*base[:100], *(f"u{k}v{j}" for j in range(14))])) for k in range(30)]
    found = op.jaccard_components(spark, frame(spark, rows))
    assert tally(found.collect(), *COLS) == brute(rows)
    plan(found)
    assert sum("SortMergeJoin" in p for p in plans) >= 6
    assert not [p for p in plans if "Broadcast" in p]
