import collections
import math
import zlib

import numpy as np
from conftest_llm import SMALL, frame, words

from racelake.llm import op10_hmm as op


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def tokens(t):
    return [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words(t)] + ["end"]


def check_base(rows, docs):
    c = collections.Counter()
    for i, t in docs:
        if not held(i):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(tokens(t)), sum(c[x] > 0 for x in tokens(t)), n,
                    round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in tokens(t)), 6)) for i, t in docs), key=repr)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows),
                 key=repr)
    assert got == want


def test_query_base_matches_and_model_beats_it_on_held_out(spark, small):
    rows = op.op10_hmm(spark, SMALL).collect()
    check_base(rows, small)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_odd_documents(spark, odd, odd_docs):
    rows = op.score(spark, odd_docs).collect()
    check_base(rows, odd)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_only_held_out_rows(spark):
    ids = [i for i in range(60) if held(i)]
    rows = op.score(spark, frame(spark, [(i, "a b c") for i in ids])).collect()
    check_base(rows, [(i, "a b c") for i in ids])


def params(seed=0, k=3, classes=7):
    rng = np.random.default_rng(seed)
    return (rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k),
            rng.dirichlet(np.ones(classes), k))


def test_likelihood_is_the_sum_over_all_paths_also_across_segments(monkeypatch):
    start, _, trans, emit = params()
    rng = np.random.default_rng(1)
    lens = np.array([1, 9, 4, 23, 5])
    seq = rng.integers(0, 7, lens.sum()).astype(np.uint16)
    want, at = [], 0
    for n in lens:
        a = start * emit[:, seq[at]]
        for o in seq[at + 1:at + n]:
            a = (a @ trans) * emit[:, o]
        want.append(math.log(a.sum()))
        at += n
    for size in (256, 4, 5, 1):
        monkeypatch.setattr(op, "SEGMENT", size)
        np.testing.assert_allclose(op.log_likelihood(seq, lens, start, trans, emit), want, rtol=1e-10)


def test_baum_welch_counts_match_enumeration():
    start, stationary, trans, emit = params(2)
    seq, lens = np.array([1, 4, 2, 2, 0, 6, 3], np.uint16), np.array([4, 3])
    got = op.expected_counts(seq, lens, start, stationary, trans, emit)
    import itertools
    first, pair, shown = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 7))
    for s in (seq[:4], seq[4:]):
        paths = {}
        for p in itertools.product(range(3), repeat=len(s)):
            w = start[p[0]] * emit[p[0], s[0]]
            for a, b, o in zip(p, p[1:], s[1:]):
                w *= trans[a, b] * emit[b, o]
            paths[p] = w
        total = sum(paths.values())
        for p, w in paths.items():
            first[p[0]] += w / total
            for a, b in zip(p, p[1:]):
                pair[a, b] += w / total
            for a, o in zip(p, s):
                shown[a, o] += w / total
    np.testing.assert_allclose(got, np.concatenate([first, pair.ravel(), shown.ravel()]), rtol=1e-10)


def test_empty_table(spark, no_docs):
    assert op.score(spark, no_docs).collect() == []
