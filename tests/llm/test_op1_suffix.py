import hashlib

from conftest_llm import SMALL, frame, tally

from racelake.llm import op1_suffix as op

COLS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def brute(docs, n=50):
    order = lambda i: (1, 0) if i is None else (0, i)
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - n + 1):
            s = b[p:p + n]
            if s not in first or order(i) < first[s]:
                first[s] = order(i)
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if first[b[p:p + n]] < order(i):
                gone[p:p + n] = b"\1" * n
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def test_query_matches_brute_force(spark, small):
    assert tally(op.op1_suffix(spark, SMALL).collect(), *COLS) == brute(small)


def test_odd_documents(spark, odd, odd_docs):
    got = op.remove_earlier_matches(spark, odd_docs)
    assert tally(got.collect(), *COLS) == brute(odd)


def test_other_lengths(spark):
    rows = [(3, "abcabcabcabc" * 5), (1, "xxabcabcab"), (2, "zabcabcabzz"), (2, "abcabcab")]
    got = op.remove_earlier_matches(spark, frame(spark, rows), n=8, k=4)
    assert tally(got.collect(), *COLS) == brute(rows, 8)


def test_empty_table(spark, no_docs):
    assert op.remove_earlier_matches(spark, no_docs).collect() == []
