import hashlib
import random
import re

from conftest_llm import frame, tally

from racelake.llm import op12_fim as op

COLS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    hexed = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[i:i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def digest(docs):
    done = op.restore(op.fim(docs))
    return done.selectExpr("doc_id", "n", "form", "prefix_chars", "middle_chars", "sha2(output, 256) output_sha256",
                           "sha2(restored, 256) restored_sha256").collect()


def expected(rows):
    out = []
    for i, t in rows:
        *head, output = brute(i, t)
        out.append((i, *head, hashlib.sha256(output.encode()).hexdigest(),
                    hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_rotation_exchanges_neighbouring_segments_in_place():
    rng = random.Random(3)
    for _ in range(300):
        data = bytes(rng.randrange(256) for _ in range(rng.randrange(40)))
        i, j, k = sorted(rng.randrange(len(data) + 1) for _ in range(3))
        buf = bytearray(data)
        op.rotate(buf, i, j, k)
        assert bytes(buf) == data[:i] + data[j:k] + data[i:j] + data[k:]
        op.rotate(buf, i, i + k - j, k)
        assert bytes(buf) == data


def test_every_form_is_restored_from_output_and_form():
    forms = set()
    for i in range(400):
        text = f"ä{i} bb\t\ncc  😀d e   " * (i % 5)
        n, form, p, m, out = op.transform(i, text.encode())
        assert (n, form, p, m, out.decode()) == brute(i, text)
        assert op.invert(out, form) == text.encode()
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}


def test_odd_documents_equal_brute_force(spark, odd, odd_docs):
    more = [(40 + k, t) for k, t in enumerate(["a <P> b", "x<S>", "<M>", "<P", " ", "\n\n", "one ", " one", "<P<S <M> >"])]
    more += [(i, "the quick brown fox " * 3) for i in range(100, 160)]
    got = digest(odd_docs.unionByName(frame(spark, more)))
    assert tally(got, *COLS) == expected([*odd, *more])


def test_columns_pass_through_and_clashing_ones_are_replaced(spark):
    docs = spark.createDataFrame([(5, "a b c d", 1, "old", [1, 2])],
                                 "doc_id int, text string, n int, form string, `my.col` array<int>")
    done = op.fim(docs)
    assert done.columns == ["doc_id", "text", "my.col", "n", "form", "prefix_chars", "middle_chars", "output"]
    row = done.first()
    assert (row["n"], row["my.col"], row["text"]) == (4, [1, 2], "a b c d")


def test_small_table_and_empty_table(spark, small, no_docs):
    got = op.op12_fim(spark, "/root/testdata/sf0.001").collect()
    assert tally(got, *COLS) == expected(small)
    assert digest(no_docs) == []
