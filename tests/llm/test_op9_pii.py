import hashlib
import math
import random
import re
import time

from conftest_llm import SMALL, frame

from racelake.llm import op9_pii as op

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def base(text):
    out = []
    for rank, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "phone" and not 10 <= len(digits) <= 15
                    or kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits))):
                continue
            out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def check(rows, docs):
    want = []
    for i, t in docs:
        found = base(t)
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in found)
        want.append((i, *(sum(x[2] == k for x in found) for k in KINDS), hashlib.sha256(joined.encode()).hexdigest()))
    got = [(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query_matches_the_patterns(spark, small):
    check(op.op9_pii(spark, SMALL).collect(), small)


def test_odd_documents(spark, odd):
    texts = ["a@b.c_d@e.f x@y.z.w@q.r a@b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 1.2.3",
             "4111 1111 1111 1111, 4111-1111-1111-1111 41111111111111112", "+1 (555) 123-4567 +44 20 7946 0958. +1-2 +(1)",
             "é😀 a@b.co é 192.168.0.1 😀 +15551234567 4111111111111111", "9" * 50_000, "a" * 50_000, "1 " * 20_000,
             "+1" + "(" * 20_000, "a." * 20_000 + "@", "x@y" + ".z" * 9000, "\n".join(f"u{i}@h.io" for i in range(800))]
    docs = odd + list(enumerate(texts, 500))
    check(op.digest(spark, frame(spark, docs)).collect(), docs)


def test_terms_that_reveal_an_entity_are_added(spark):
    """``Quillfeather`` stands only with one address; ``office`` with all of them and elsewhere."""
    docs = [(k, f"note {k} office of Quillfeather, bob@x.io thanks{k}") for k in range(6)]
    docs += [(10 + k, f"letter {k} office mail u{k}@y.io ok") for k in range(6)]
    docs += [(100 + k, f"note {k} of the office with chairs") for k in range(200)]
    rows = {r.doc_id: r for r in op.digest(spark, frame(spark, docs)).collect()}
    check(rows.values(), docs)
    for k in range(6):
        text = docs[k][1]
        terms = [text[int(s):int(e)] for kind, s, e in (x.split(":") for x in rows[k].spans.split(",")) if kind == "term"]
        assert terms == ["Quillfeather,"]
        assert rows[10 + k].spans.count(":") == 2 and rows[10 + k].n_email == 1
    assert all(rows[100 + k].spans == "" for k in range(200))
    df = frame(spark, docs + [(None, None)])
    clean = op.sanitise(spark, df)
    assert clean.schema.names == df.schema.names
    assert {r.text for r in clean.collect() if r.doc_id == 3} == {"note 3 office of [TERM] [EMAIL] thanks3"}


def brute_terms(docs):
    """(disclosing terms, spans of terms per document) by the definitions, over whole documents."""
    found = [base(t) for _, t in docs]
    words = [[(m.start(), m.end(), re.sub(r"^[^\w]+|[^\w]+$", "", m[0].lower())) for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")]
             for _, t in docs]
    has = [{w for _, _, w in ws if len(w) > 1} for ws in words]
    values = [{(t[s:e].lower(), t[max(s - 60, 0):s][-60:], t[e:e + 60]) for s, _, _, e in f} for f, (_, t) in zip(found, docs)]
    total, told = len(docs), set()
    for e in {v for vs in values for v, _, _ in vs}:
        of = [k for k, vs in enumerate(values) if any(v == e for v, _, _ in vs)]
        for term in set().union(*(has[k] for k in of)):
            both = [k for k in of if term in has[k]]
            contexts = {next(x[1:] for x in sorted(values[k]) if x[0] == e) for k in both}
            n_term = sum(term in h for h in has)
            if len(contexts) < 3 or len(of) == total:
                continue
            pmi = math.log(len(both) * total / (n_term * len(of)))
            if pmi / -math.log(len(of) / total) >= 0.8 - 1e-12:
                told.add(term)
    spans = [[(s, e) for s, e, w in ws if w in told and not any(b[0] < e and b[3] > s for b in f)]
             for ws, f in zip(words, found)]
    return told, spans


def test_terms_equal_brute_force_over_whole_documents(spark):
    """Names far from the entity, and in documents without it, are spans too."""
    rng = random.Random(9)
    filler = [f"word{k}" for k in range(40)]
    prose = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    docs = []
    for k in range(8):
        docs.append((k, f"{prose(3)} Quillfeather {prose(40)} bob@x.io {prose(9)}"))
        docs.append((100 + k, f"{prose(9)} +1 555 123 4567{k % 2} {prose(20)} (Marrowby) {prose(5)} Marrowby."))
    docs += [(200, f"only {prose(30)} quillfeather, {prose(5)} Quillfeather"), (201, prose(60)), (202, None), (203, "")]
    docs += [(300 + k, prose(50)) for k in range(150)]
    told, spans = brute_terms(docs)
    assert {"quillfeather", "marrowby"} <= told
    rows = {r.doc_id: r for r in op.digest(spark, frame(spark, docs)).collect()}
    check(rows.values(), docs)
    for (i, _), want in zip(docs, spans):
        got = [tuple(map(int, x.split(":")[1:])) for x in rows[i].spans.split(",") if x.startswith("term")]
        assert got == want, i
    assert rows[200].spans.count("term") == 2 and len(spans[0]) >= 1


def test_many_matches_in_one_text_take_seconds(spark):
    text = " ".join(f"u{k}@h{k % 7}.io {k}" for k in range(100_000))
    start = time.time()
    row = op.digest(spark, frame(spark, [(1, text), (2, "1 2 " * 100_000)])).filter("doc_id = 1").first()
    assert row.n_email == 100_000 and time.time() - start < 120
    joined = ",".join(f"email:{m.start()}:{m.end()}" for m in re.finditer(r"[a-z0-9]+@[a-z0-9.]+", text))
    assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_copies_of_one_passage_are_no_support(spark):
    docs = [(k, "call Quillfeather at bob@x.io") for k in range(9)] + [(50 + k, f"other text {k}") for k in range(50)]
    assert not any("term" in r.spans for r in op.digest(spark, frame(spark, docs)).collect())


def test_native_plan_and_empty_table(spark, no_docs):
    df = op.op9_pii(spark, SMALL)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
    assert op.digest(spark, no_docs).collect() == [] and op.sanitise(spark, no_docs).collect() == []
