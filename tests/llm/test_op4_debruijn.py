import collections
import hashlib

from conftest_llm import SMALL, frame, tally, words

from racelake.llm import op4_debruijn as op

COLS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def brute(docs, n=35):
    count = collections.Counter(tuple(w[i:i + n]) for _, t in docs for w in [words(t)] for i in range(len(w) - n + 1))
    out = []
    for i, t in docs:
        w = words(t)
        gone = bytearray(len(w))
        for p in range(len(w) - n + 1):
            if count[tuple(w[p:p + n])] > 1:
                gone[p:p + n] = b"\1" * n
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def test_query_matches_brute_force(spark, small):
    assert tally(op.op4_debruijn(spark, SMALL).collect(), *COLS) == brute(small)


def test_odd_documents(spark, odd, odd_docs):
    assert tally(op.remove_repeated_spans(spark, odd_docs).collect(), *COLS) == brute(odd)


def test_repeats_inside_one_document(spark):
    rows = [(1, "a b c d e f " * 9), (2, "q a b c d e f a b c d e f z"), (3, "x " * 40)]
    got = op.remove_repeated_spans(spark, frame(spark, rows), n=8, k=3)
    assert tally(got.collect(), *COLS) == brute(rows, 8)


def test_empty_table(spark, no_docs):
    assert op.remove_repeated_spans(spark, no_docs).collect() == []


def test_nonbranching_paths_are_compacted(spark):
    """One passage, whole in two documents and in part in a third, is one path; a fork ends paths."""
    word = lambda tag, n: [f"{tag}{i}" for i in range(n)]
    passage = word("p", 60)
    rows = [(1, word("a", 20) + passage + word("b", 9)), (2, passage + word("c", 30)), (3, word("d", 5) + passage[10:50]),
            (4, word("e", 80)), (5, word("f", 40) + word("g", 40)), (6, word("f", 40) + word("g", 40)),
            (7, word("f", 40) + word("h", 40)), (8, word("f", 40) + word("h", 40))]
    got = {r.doc_id: (r.n_paths, r.longest_path) for r in
           op.remove_repeated_spans(spark, frame(spark, [(i, " ".join(w)) for i, w in rows])).collect()}
    assert got[1] == got[2] == got[3] == (1, 60) and got[4] == (0, 0)
    assert got[5] == got[6] == got[7] == got[8] == (2, 74)  # the common 40 words, and 34 of them with what follows


def longest_paths(spark, docs):
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    return [(r.n_paths, r.longest_path) for r in
            sorted(op.remove_repeated_spans(spark, frame(spark, rows)).collect(), key=lambda r: r.doc_id)]


def test_forks_are_cut_whatever_the_counts(spark):
    """A fork in a large group, and a node with two ways in and out that are equally frequent."""
    word = lambda tag, n: [f"{tag}{i}" for i in range(n)]
    f, g, h, x = word("f", 40), word("g", 40), word("h", 40), word("x", 34)
    assert set(longest_paths(spark, [f + g, f + h] * 300)) == {(2, 74)}
    # a X b, a X c and d X b, twice each: a X and d X enter the node X, b and c leave it
    a, b, c, d = word("a", 40), word("b", 40), word("c", 40), word("d", 40)
    assert set(longest_paths(spark, [a + x + b, a + x + c, d + x + b] * 2)) == {(2, 74)}
    assert set(longest_paths(spark, [a + x + b, d + x + c] * 2)) == {(2, 74)}
