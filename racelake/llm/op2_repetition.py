"""Quality rules: repetition coverage.

For every document the characters inside repeated n-grams and lines are measured by
rolling hashes of several n-gram lengths, vectorised over a block of documents (the
document's index is part of every key, so texts never meet).  For 2 to 4 words the most
frequent n-gram found three times or more is measured, for 5 to 10 words the copies
(without the first occurrence) of all repeated n-grams, each as the share of the
document's word characters they cover; likewise the characters of lines that repeat an
earlier line.  A document passes the verdict if no share is above
its limit.  The limits are those published for repetition filters of web text.

Cases: null, empty and blank texts have no words (``base_failed``); a text of any length
is read whole; repeated rows give one row each; an empty table gives an empty result; a
null ``doc_id`` stays null; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from racelake.llm import _blocks as B

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
# Published limits, as shares of a document's word characters.
TOP_LIMITS = {2: 0.20, 3: 0.18, 4: 0.16}
COVER_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "top_share double, cover_share double, line_share double, base_failed boolean, kept boolean")


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return c[ends] - c[starts]


#: From this length on spans are hashed byte by byte: the polynomial of ``span_hash`` is modulo 2**64, where
#: structured texts of 1,024 characters and more can share a hash.
LONG = 256


def _hashes(data: np.ndarray, pre: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans."""
    out = B.span_hash(pre, starts, ends)
    for k in np.flatnonzero(ends - starts >= LONG):
        out[k] = xxhash.xxh3_64_intdigest(data[starts[k]:ends[k]])
    return out


def measure(block: B.Block) -> pa.Table:
    data, n_docs = block.data, len(block.ids)
    ws, we = B.words(data)
    first_word = np.searchsorted(ws, block.starts)
    last_word = np.searchsorted(ws, block.ends)
    n_words = last_word - first_word
    doc = np.repeat(np.arange(n_docs), n_words)
    salt = B.mix(np.arange(1, n_docs + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    lead = ~B.CONTINUES[data]
    points = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])
    chars = points[we] - points[ws]
    symbol = B._lut(SYMBOLS)[data]
    n_symbols = _sums(symbol, block.starts, block.ends)
    word_chars = _sums(chars, first_word, last_word)

    pre = B.bytes_prefix(data)
    # lines that hold a word, equal to an earlier line of the same document
    le = np.flatnonzero(data == 10)
    ls = np.concatenate([[0], le[:-1] + 1]) if len(le) else le
    line_doc = B.per_doc(ls, block)
    w0, w1 = np.searchsorted(ws, ls), np.searchsorted(ws, le)
    has = w1 > w0
    ls, le, line_doc, w0, w1 = ls[has], le[has], line_doc[has], w0[has], w1[has]
    at, opens = B.groups(_hashes(data, pre, ls, le) ^ salt[line_doc])
    later = at[~opens]
    n_dup_lines = np.bincount(line_doc[later], minlength=n_docs)
    line_chars = np.bincount(line_doc[later], weights=_sums(chars, w0[later], w1[later]), minlength=n_docs)

    word_hash = _hashes(data, pre, ws, we)
    word_pre = B.prefix(word_hash)
    total = np.maximum(word_chars, 1)
    top, cover = np.zeros(n_docs), np.zeros(n_docs)
    passes = np.ones(n_docs, bool)
    n_repeat = np.zeros(n_docs, np.int64)
    for n in (*TOP_LIMITS, *COVER_LIMITS):
        h = B.rolling(word_pre, n)
        m = len(h)
        if m <= 0:
            continue
        here = np.flatnonzero(doc[:m] == doc[n - 1:])
        at, opens = B.groups(h[here] ^ salt[doc[here]])
        at = here[at]
        if n in TOP_LIMITS:
            if len(at):
                group = np.cumsum(opens) - 1
                heads = at[opens]
                times = np.bincount(group)
                gram_chars = _sums(chars, heads, heads + n) * np.where(times >= 3, times, 0)
                share = np.zeros(n_docs)
                np.maximum.at(share, doc[heads], gram_chars)
                share /= total
                top = np.maximum(top, share)
                passes &= share <= TOP_LIMITS[n]
            continue
        flags = np.zeros(len(ws), bool)
        flags[at] = True
        if n == 5:
            n_repeat = _sums(B.slide_max(flags, n), first_word, last_word)
        flags[at[opens]] = False
        covered = B.slide_max(flags, n)
        share = _sums(np.where(covered, chars, 0), first_word, last_word) / total
        cover = np.maximum(cover, share)
        passes &= share <= COVER_LIMITS[n]
    line_share = line_chars / total
    passes &= line_share <= LINE_LIMIT

    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_PERCENT * n_words)
    long = lambda a: pa.array(a.astype(np.int64), pa.int64())
    return pa.table([block.out_ids(), long(n_words), long(word_chars), long(n_symbols), long(n_dup_lines),
                     long(n_repeat), pa.array(top), pa.array(cover), pa.array(line_share),
                     pa.array(failed), pa.array(~failed & passes)],
                    names=[c.split(" ")[0] for c in SCHEMA.split(", ")])


def repetition(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of measures and verdict per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in B.batched(batches):
            yield from measure(held).to_batches()

    return B.id_text(docs).mapInArrow(run, SCHEMA)


def keep(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the documents that the rules reject."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            two = pa.RecordBatch.from_arrays(
                [pa.array(np.arange(batch.num_rows)), batch.column("text").cast(pa.string())], names=["i", "text"])
            verdict = [measure(block).column("kept") for block in B.batched(iter([two]))]
            yield batch.filter(pa.concat_arrays([c for v in verdict for c in v.chunks]))

    return docs.mapInArrow(run, docs.schema)


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(spark, B.table(spark, sf_dir, "documents"))
