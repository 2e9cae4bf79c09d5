import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from conftest_llm import SMALL, tally

from racelake.llm import _blocks as B
from racelake.llm import op7_packing as op


def tokens(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(op.tokenizer_path())
    return [t.encode(x or "", add_special_tokens=False).ids + [op.END_ID] for x in texts]


def check(rows, docs, seq_len):
    """Every id is in exactly one piece; sequences are gapless and within the limit."""
    want = sorted(((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for (i, _), ids in
                   zip(docs, tokens(t for _, t in docs)) if len(ids) <= seq_len), key=repr)
    assert tally([r for r in rows if r.doc_tokens <= seq_len], "doc_id", "length", "ids_crc32") == want
    parts = [(i, s, min(seq_len, len(ids) - s), zlib.crc32(np.array(ids[s:s + seq_len], "<u4").tobytes()))
             for (i, _), ids in zip(docs, tokens(t for _, t in docs)) if len(ids) > seq_len
             for s in range(0, len(ids), seq_len)]
    assert tally([r for r in rows if r.doc_tokens > seq_len], "doc_id", "start", "length", "ids_crc32") == sorted(
        parts, key=repr)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= seq_len
    assert sorted(sequences) == list(range(len(sequences)))
    return sum(r.length for r in rows) / (len(sequences) * seq_len)


def test_query_round_trip(spark, small):
    assert check(op.op7_packing(spark, SMALL).collect(), small, op.SEQ_LEN) > 0.9


def test_odd_documents_and_short_sequences(spark, odd, odd_docs):
    check(op.pack(spark, odd_docs, seq_len=64).collect(), odd, 64)


def test_tokenizer_equals_the_whole_text():
    odd = ["don't I'll we've 'S", "<|endoftext|> a<|startoftext|>b <|x", "naïve ÀÉ×÷ ﬁ İstanbul ΣΑΣ",
           "a\x1cb\x1f c\x00d \x7f e f\u0085g", "日本語 x²½ ªº", "ÆØÅ ß ẞ 12345 a1b2 !!??'d'", "́abc ́"]
    encoder = op.WordEncoder(op.tokenizer_path())
    for text, ids in zip(odd, tokens(odd)):
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == ids[:-1]


def test_histogram_packing_places_everything_once():
    histogram = {4096: 3, 3000: 5, 1096: 2, 700: 40, 10: 1000, 1: 7}
    patterns = op.shortest_pack_first(histogram)
    placed = {}
    for count, lengths in patterns:
        assert sum(lengths) <= op.SEQ_LEN and count > 0
        for n in lengths:
            placed[n] = placed.get(n, 0) + count
    assert placed == histogram


def test_rows_of_a_batch_become_objects_a_few_at_a_time():
    """A batch of 32 MB and a cache of rare words do not fill a worker."""
    rows = [(i, f"{i} ü".encode() + b"x" * 8000) for i in range(4000)] + [(None, None)]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array(
        [None if t is None else t.decode() for _, t in rows], pa.string())], names=["doc_id", "text"])
    want = hash(tuple(rows))
    del rows
    tracemalloc.start()
    at = tracemalloc.get_traced_memory()[0]
    n = sum(1 for _ in B.id_bytes(iter([batch])))
    most = tracemalloc.get_traced_memory()[1] - at
    tracemalloc.stop()
    assert n == 4001 and most < 8 << 20
    assert hash(tuple(B.id_bytes(iter([batch])))) == want


def test_a_full_cache_is_emptied_and_changes_nothing(monkeypatch):
    assert op.CACHE_WORDS <= 200_000
    words = [f"w{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(600)]
    texts = [" ".join(words[n:n + 40]) for n in range(0, 600, 20)]
    encoder = op.WordEncoder(op.tokenizer_path())
    monkeypatch.setattr(op, "CACHE_WORDS", 50)
    for text, ids in zip(texts, tokens(texts)):
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == ids[:-1] and len(encoder.known) <= 50


def test_empty_table(spark, no_docs):
    assert op.pack(spark, no_docs).collect() == []
