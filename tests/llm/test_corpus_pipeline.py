import __spark_entry__ as entry
import corpus_pipeline
import test_op2_repetition as quality
import test_op8_jaccard as near
from conftest_llm import SMALL, frame, tally

from racelake.llm import _blocks as B
from racelake.llm import registry, stages


def test_registered():
    assert list(entry.queries())[-1] == "pipeline" or "pipeline" in entry.queries()
    assert [n.split("_")[0] for n in registry.QUERIES] == [f"op{k}" for k in range(1, 14)]


def test_each_stage_on_its_own_input(spark, small):
    docs = B.table(spark, SMALL, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    first = B.store(spark, stages.quality_rules(spark, docs, SMALL), "t1")
    assert tally(first.collect(), "doc_id") == sorted(((r[0],) for r in quality.brute(small) if r[-1]), key=repr)
    second = B.store(spark, stages.line_dedup(spark, first, SMALL), "t2")
    texts = {r.doc_id: r for r in second.collect()}
    assert second.schema == docs.schema and len(texts) == first.count()
    for i, r in texts.items():  # lines are only removed
        own = iter(rows[i].text.split("\n"))
        assert not r.text or all(line in own for line in r.text.split("\n"))
        assert r.n_chars == len(r.text)
    third = B.store(spark, stages.jaccard_join(spark, second, SMALL), "t3")
    want = [(i,) for i, _, c in near.brute([(i, r.text) for i, r in texts.items()]) if i == c]
    assert tally(third.collect(), "doc_id") == sorted(want, key=repr) and third.schema == docs.schema
    fourth = B.store(spark, stages.decontamination(spark, third, SMALL), "t4")
    bench = [r.text for r in B.table(spark, SMALL, "benchmark").collect()]
    left = {r.doc_id for r in fourth.collect()}
    assert all((i in left) == (not any(b.lower() in texts[i].text.lower() for b in bench)) for (i,) in want)
    fifth = stages.packing(spark, fourth, SMALL).collect()
    assert {r.doc_id for r in fifth} == left


def test_run_and_odd_rows(spark, odd):
    docs = frame(spark, odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = B.store(spark, stage(spark, docs, SMALL), "odd")
        assert docs.schema == frame(spark, odd).schema
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() >= docs.count()
    assert corpus_pipeline.run(spark, SMALL).count() > 0


def test_empty_documents(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = B.store(spark, stage(spark, docs, SMALL), "empty")
    assert docs.count() == 0
