import collections
import re

from conftest_llm import SMALL, frame, tally, words

from racelake.llm import op2_repetition as op

COLS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def covered(w, n, first_too):
    c = collections.Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    seen, out = set(), set()
    for i in range(len(w) - n + 1):
        g = tuple(w[i:i + n])
        if c[g] > 1 and (first_too or g in seen):
            out |= set(range(i, i + n))
        seen.add(g)
    return out


def brute(docs):
    out = []
    for i, t in docs:
        t = t or ""
        w = [x.decode() for x in words(t)]
        chars = sum(map(len, w))
        total = max(chars, 1)
        seen, dup, dup_chars = set(), 0, 0
        for line in t.split("\n"):
            if words(line):
                if line in seen:
                    dup += 1
                    dup_chars += sum(len(x.decode()) for x in words(line))
                seen.add(line)
        repeat = len(covered(w, 5, True))
        passes = dup_chars / total <= op.LINE_LIMIT
        for n, most in op.COVER_LIMITS.items():
            passes &= sum(len(w[k]) for k in covered(w, n, False)) / total <= most
        for n, most in op.TOP_LIMITS.items():
            c = collections.Counter(tuple(w[k:k + n]) for k in range(len(w) - n + 1))
            passes &= max([sum(map(len, g)) * m for g, m in c.items() if m >= 3], default=0) / total <= most
        failed = len(w) < 10 or 100 * repeat > 20 * len(w)
        out.append((i, len(w), chars, len(re.findall(r"[#*$%&|<>]", t)), dup, repeat, failed, passes and not failed))
    return sorted(out, key=repr)


def test_query_matches_brute_force(spark, small):
    assert tally(op.op2_repetition(spark, SMALL).collect(), *COLS) == brute(small)


def test_odd_documents(spark, odd, odd_docs):
    assert tally(op.repetition(spark, odd_docs).collect(), *COLS) == brute(odd)


def test_verdict_rejects_repetition_and_keeps_prose(spark):
    prose = " ".join(f"word{i}" for i in range(400))
    chant = " ".join(f"a{i}" for i in range(60)) + " again and again we say so" * 5 + " " + " ".join(
        f"b{i}" for i in range(60))
    got = {r.doc_id: r.kept for r in op.repetition(spark, frame(spark, [(1, prose), (2, chant)])).collect()}
    assert got == {1: True, 2: False}


def test_keep_filters_rows_with_all_columns(spark, odd, odd_docs):
    kept = op.keep(odd_docs)
    assert kept.schema == odd_docs.schema
    want = [(r[0]) for r in brute(odd) if r[-1]]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark, no_docs):
    assert op.repetition(spark, no_docs).collect() == [] and op.keep(no_docs).collect() == []


def test_structured_lines_and_words_are_told_apart(spark):
    """The Thue-Morse word and its complement: equal under any polynomial modulo 2**64."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    one, two = "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)
    docs = [(1, f"{one}\n{two}"), (2, f"{one}\n{two}\n{one}"), (3, " ".join([one, two] * 5))]
    got = {r.doc_id: r for r in op.repetition(spark, frame(spark, docs)).collect()}
    assert [got[k].n_dup_lines for k in (1, 2, 3)] == [0, 1, 0]
    assert got[3].n_repeat_words == 10  # a b a b a at two and more starts
    assert tally(got.values(), *COLS[:6]) == sorted((r[:6] for r in brute(docs)), key=repr)
