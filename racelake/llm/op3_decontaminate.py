"""Benchmark decontamination: BM25 inverted index of the test items with block-max WAND.

The items are indexed (BM25 impacts, divided by the item's score for its own text, so 1 means
"all of the item is there").  Every passage of every training text, windows of twice the
longest item with half a window of overlap, is a query, and all items that reach their cutoff
are retrieved.  The cutoff is ``THRESHOLD``, or less for an item whose heaviest words may be missing
from a passage that the verification accepts (``_cutoff``), so retrieval loses no such passage.
Block-max WAND runs on a batch of passages at a time: a passage whose terms' largest impacts cannot
sum to the cutoff is skipped; for the others the largest impacts per block of items bound each block,
and only blocks that can reach the cutoff are scored.  The bounds are exact.

A hit is then verified: 80 % of the 5-word shingles of the question and 80 % of the words of the
answer must be in the passage.  The question is the text up to its last question mark (without
one, all but the last sentence; a text of one sentence is both).

The index of about ``SHARD_ITEMS`` items or ``SHARD_BYTES`` text goes to the tasks; a larger
benchmark is split by a hash of the item and the shards are queried one after the other.  Document
frequencies, mean length and window are those of the whole benchmark, counted by Spark, so scores and
hits do not depend on the shards.  Documents are never shuffled: a passage is compared where its text is read.

Cases: null or empty texts have no passage, null, empty and blank items match nothing; a text
of any length is covered whole; repeated rows are reported each, repeated items each; null ids
stay null; an empty table of documents or items gives no hit; only ``doc_id``, ``text`` and
``item_id``, ``text`` are read, other columns pass through ``clean`` unchanged.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm import _blocks as B

K1, BETA = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
SHINGLE = 5
ITEMS_PER_BLOCK = 8
MIN_STRIDE = 32
SHARD_ITEMS = 2048
SHARD_BYTES = 2 << 20
SLACK = 1e-9  # of sums of doubles
STEP = 1 << 20
SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"

_GAP = ~(B._lut(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123))) | (np.arange(256) > 127))


def _terms(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each lower-cased run of letters and digits."""
    gap = _GAP[data]
    edge = np.diff(gap.astype(np.int8), prepend=1, append=1)
    s, e = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return B.span_hash(B.bytes_prefix(B.LOWER[data]), s, e), s


def _hashes(text: str) -> np.ndarray:
    return _terms(np.frombuffer(text.encode("utf-8", "replace") + b"\n", np.uint8))[0]


def split_item(text: str) -> tuple[str, str]:
    """Question and answer of an item."""
    at = text.rfind("?")
    if at >= 0 and text[at + 1:].strip():
        return text[:at + 1], text[at + 1:]
    parts = [p for p in re.split(r"(?<=[.!?])\s+", text.strip()) if p]
    return (text, text) if len(parts) < 2 else (" ".join(parts[:-1]), parts[-1])


def _shingles(h: np.ndarray) -> np.ndarray:
    """Distinct hashes of the 5-word shingles, or of the whole shorter sequence."""
    if not len(h):
        return h
    return B.distinct(np.sort(B.rolling(B.prefix(h), min(SHINGLE, len(h)))))


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, term, length of the item at its first term) of every item."""
    for batch in batches:
        shard, term, length = [], [], []
        for k, text in zip(batch.column("shard").to_pylist(), batch.column("text").to_pylist()):
            h = _hashes(text or "")
            u = B.distinct(np.sort(h))
            shard.append(np.full(len(u), k, np.int64))
            term.append(u.view(np.int64))
            length.append(np.where(np.arange(len(u)) == 0, len(h), 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in (shard, term, length)],
            names=["shard", "term", "length"])


def _expand(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the ranges, and the range each belongs to."""
    n = end - begin
    row = np.repeat(np.arange(len(n)), n)
    return np.arange(len(row)) + (begin - (np.cumsum(n) - n))[row], row


class Corpus:
    """What BM25 needs of all items: their number, mean and largest length, and the frequency of terms."""

    def __init__(self, n: int, mean: float, longest: int, terms: np.ndarray, df: np.ndarray):
        self.n, self.mean, self.longest, self.terms, self.df = n, mean, longest, terms, df

    @classmethod
    def of(cls, hashes: list[np.ndarray]) -> Corpus:
        """The statistics of items held at hand."""
        hashes = [h for h in hashes if len(h)]
        every = np.sort(np.concatenate([B.distinct(np.sort(h)) for h in hashes] or [np.empty(0, np.uint64)]))
        terms = B.distinct(every)
        df = np.diff(np.append(np.searchsorted(every, terms), len(every)))
        return cls(len(hashes), sum(map(len, hashes)) / max(1, len(hashes)), max(map(len, hashes), default=0), terms, df)


def _cutoff(impact: np.ndarray, term: np.ndarray, question: np.ndarray, answer: np.ndarray) -> float:
    """The smallest score of a passage that the verification accepts, from below.

    A passage may miss a fifth of the question's shingles.  Each word it misses takes a shingle of its
    own (two may share one if shingles repeat) and all the shingles that hold it; of the other words, those
    of the answer, it may miss a fifth.  What is left of the item's score, without the heaviest words that
    can be missing, is the cutoff.
    """
    n = min(SHINGLE, len(question))
    windows = np.lib.stride_tricks.sliding_window_view(question, n)
    distinct = np.unique(windows, axis=0)
    spare = int(len(distinct) * (1 - OVERLAP) + 1e-9)
    held = np.sort(np.concatenate([np.unique(w) for w in distinct]))
    own = B.distinct(held)
    times = np.diff(np.append(np.searchsorted(held, own), len(held)))
    asked = np.isin(term, own)
    free = np.sort(impact[np.isin(term, own[times <= spare])])[::-1]
    lost = free[:spare * (1 if len(distinct) == len(windows) else 2)].sum()
    spare = int(len(B.distinct(np.sort(answer))) * (1 - OVERLAP) + 1e-9)
    lost += np.sort(impact[~asked])[::-1][:spare].sum()
    return max(min(THRESHOLD, 1 - lost - 1e-9), 1e-6)


class Index:
    """BM25 postings of one shard of items, with the largest impacts per block of items."""

    def __init__(self, items: list[tuple[int | None, str | None]], corpus: Corpus | None = None):
        texts = [(i, t, _hashes(t)) for i, t in items if t]
        texts = [x for x in texts if len(x[2])]
        corpus = corpus or Corpus.of([h for _, _, h in texts])
        self.ids = [i for i, _, _ in texts]
        self.n = len(texts)
        self.stride = max(MIN_STRIDE, corpus.longest)
        parts = [tuple(p if len(p) else h for p in map(_hashes, split_item(t))) for _, t, h in texts]
        self.question = [_shingles(q) for q, _ in parts]
        self.answer = [B.distinct(np.sort(a)) for _, a in parts]
        self.terms = B.distinct(np.sort(np.concatenate([h for _, _, h in texts] or [np.empty(0, np.uint64)])))
        lengths = np.array([len(h) for _, _, h in texts], float)
        item, term, tf = [], [], []
        for k, (_, _, h) in enumerate(texts):
            u = B.distinct(np.sort(h))
            item.append(np.full(len(u), k))
            term.append(np.searchsorted(self.terms, u))
            tf.append(np.diff(np.append(np.searchsorted(np.sort(h), u), len(h))))
        if not self.n:
            return
        first = np.cumsum([0] + [len(t) for t in term])
        item, term, tf = np.concatenate(item), np.concatenate(term), np.concatenate(tf).astype(float)
        df = corpus.df[np.searchsorted(corpus.terms, self.terms)]
        idf = np.log1p((corpus.n - df + 0.5) / (df + 0.5))
        impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - BETA + BETA * lengths[item] / corpus.mean))
        impact /= np.bincount(item, weights=impact, minlength=self.n)[item]
        self.cutoff = np.array([_cutoff(impact[a:b], self.terms[term[a:b]], q, w)
                                for a, b, (q, w) in zip(first, first[1:], parts)])
        self.block_cutoff = np.minimum.reduceat(self.cutoff, np.arange(0, self.n, ITEMS_PER_BLOCK))
        order = np.lexsort((item, term))
        self.item, self.impact = item[order], impact[order]
        self.blocks = -(-self.n // ITEMS_PER_BLOCK)
        key = term[order] * self.blocks + self.item // ITEMS_PER_BLOCK
        self.keys = B.distinct(key)  # (term, block) lists, where their postings begin, and their largest impact
        self.at = np.append(np.searchsorted(key, self.keys), len(key))
        self.block_max = np.maximum.reduceat(self.impact, self.at[:-1])
        self.lists = np.searchsorted(self.keys, np.arange(len(self.terms) + 1) * self.blocks)  # those of a term
        self.term_max = np.maximum.reduceat(self.block_max, self.lists[:-1])

    def retrieve(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, item, score) of all items that reach their cutoff; the pairs are distinct and sorted."""
        found = [(passage[:0], passage[:0], np.empty(0))]
        heads = np.flatnonzero(np.diff(passage, prepend=-1))
        if not len(heads):
            return found[0]
        size = np.diff(np.append(heads, len(passage)))
        live = np.add.reduceat(self.term_max[term], heads) >= self.cutoff.min() - SLACK
        keep = np.repeat(live, size)
        passage, term = passage[keep], term[keep]
        # as many passages at a time as have about ``STEP`` lists
        lists = np.cumsum(self.lists[term + 1] - self.lists[term])
        heads = np.append(np.flatnonzero(np.diff(passage, prepend=-1)), len(passage))
        begin = 0
        while begin < len(heads) - 1:
            done = lists[heads[begin] - 1] if heads[begin] else 0
            end = max(begin + 1, int(np.searchsorted(lists[heads[1:] - 1], done + STEP, side="right")))
            part = slice(heads[begin], heads[end])
            found.append(self._score(passage[part], term[part]))
            begin = end
        return tuple(np.concatenate(x) for x in zip(*found))

    def _score(self, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        which, row = _expand(self.lists[term], self.lists[term + 1])  # the lists of each passage's terms
        cell = passage[row] * self.blocks + self.keys[which] % self.blocks
        order = np.argsort(cell, kind="stable")
        cell, which = cell[order], which[order]
        new = np.flatnonzero(np.diff(cell, prepend=-1))
        bound = np.add.reduceat(self.block_max[which], new)
        able = bound >= self.block_cutoff[cell[new] % self.blocks] - SLACK
        able = np.repeat(able, np.diff(np.append(new, len(cell))))
        cell, which = cell[able], which[able]
        # the surviving (passage, block) pairs in full
        post, row = _expand(self.at[which], self.at[which + 1])
        cell = cell[row] // self.blocks * self.n + self.item[post]
        order = np.argsort(cell, kind="stable")
        cell, value = cell[order], self.impact[post][order]
        new = np.flatnonzero(np.diff(cell, prepend=-1))
        if not len(new):
            return passage[:0], passage[:0], np.empty(0)
        score = np.add.reduceat(value, new)
        cell = cell[new]
        hit = score >= self.cutoff[cell % self.n] - SLACK
        return cell[hit] // self.n, cell[hit] % self.n, score[hit]

    def hits(self, block: B.Block) -> list[tuple[int, int, float, float, float]]:
        """(document, item, score, question overlap, answer overlap) of verified hits of a block."""
        if not self.n:
            return []
        h, at = _terms(block.data)
        first, last = np.searchsorted(at, block.starts), np.searchsorted(at, block.ends)
        n_terms = last - first
        windows = np.maximum(1, -(-n_terms // self.stride) - 1)  # the last one ends the text
        base = np.cumsum(windows) - windows
        doc = np.repeat(np.arange(len(n_terms)), n_terms)
        chunk = (np.arange(len(h)) - first[doc]) // self.stride
        k = np.searchsorted(self.terms, h)
        known = np.flatnonzero(self.terms[np.minimum(k, len(self.terms) - 1)] == h)
        d, c, k = doc[known], chunk[known], k[known]
        early, late = c < windows[d], c > 0
        passage = np.concatenate([(base[d] + c)[early], (base[d] + c - 1)[late]])
        pairs = B.distinct(np.sort(passage * len(self.terms) + np.concatenate([k[early], k[late]])))
        found: dict[tuple[int, int], tuple[float, float, float]] = {}
        for p, item, score in zip(*self.retrieve(pairs // len(self.terms), pairs % len(self.terms))):
            i = int(np.searchsorted(base, p, side="right")) - 1
            begin = first[i] + (p - base[i]) * self.stride
            text = h[begin:min(begin + 2 * self.stride, last[i])]
            q = float(np.isin(self.question[item], _all_shingles(text, self.question[item])).mean())
            a = float(np.isin(self.answer[item], text).mean())
            if q >= OVERLAP and a >= OVERLAP:
                found[i, int(item)] = max(found.get((i, int(item)), (0.0, 0.0, 0.0)), (float(score), q, a))
        return [(i, item, *v) for (i, item), v in sorted(found.items())]


def _all_shingles(text: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Shingles of a passage of every length that ``wanted`` may have (1 to 5 words)."""
    pre = B.prefix(text)
    sizes = [SHINGLE] if len(wanted) > 1 else range(1, SHINGLE + 1)
    return np.concatenate([B.rolling(pre, n) for n in sizes])


def indexes(items: DataFrame) -> Iterator[Index]:
    """One index per shard, all with the statistics of the whole benchmark.

    The driver and a task hold one shard's items and the frequencies of its terms, no more.
    """
    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    n, size = own.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    shards = max(1, -(-n // SHARD_ITEMS), -(-(size or 0) // SHARD_BYTES))
    own = own.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    terms = own.select("shard", "text").mapInArrow(_terms_of, "shard long, term long, length long")
    count, total, longest = terms.agg(
        F.count(F.when(F.col("length") > 0, 1)), F.sum("length"), F.max("length")).first()
    # the terms of each shard with their frequency in the benchmark
    frequency = terms.groupBy("term", "shard").agg(F.count(F.lit(1)).alias("n"))
    frequency = B.store(items.sparkSession, frequency.join(
        frequency.groupBy("term").agg(F.sum("n").alias("df")), "term"), "item-terms", free=False)
    for k in range(shards):
        rows = own.filter(F.col("shard") == k).select("item_id", "text").collect()  # bounded by the number of shards
        known = frequency.filter(F.col("shard") == k).select("term", "df").toArrow()
        term = known.column("term").to_numpy().view(np.uint64)
        order = np.argsort(term)
        corpus = Corpus(count, (total or 0) / max(1, count), longest or 0, term[order], known.column("df").to_numpy()[order])
        yield Index(sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")), corpus)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per (document, item) whose question and answer are in the text."""
    out = None
    for index in indexes(items):
        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for block in B.batched(batches):
                found = index.hits(block)
                cols = list(zip(*found)) if found else [()] * 5
                ids = block.ids[list(cols[0])] if found else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64(), mask=ids == B.NULL_ID),
                     pa.array([index.ids[k] for k in cols[1]], pa.int64()),
                     *(pa.array(c, pa.float64()) for c in cols[2:])], names=[c.split(" ")[0] for c in SCHEMA.split(", ")])

        part = B.id_text(docs).mapInArrow(run, SCHEMA)
        out = part if out is None else out.union(part)
    return out


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the documents that contain an item."""
    for index in indexes(items):
        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                two = pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(batch.num_rows)), batch.column("text").cast(pa.string())], names=["i", "text"])
                bad = defaultdict(bool)
                for block in B.batched(iter([two])):
                    for i, *_ in index.hits(block):
                        bad[int(block.ids[i])] = True
                yield batch.filter(pa.array([not bad[i] for i in range(batch.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(B.table(spark, sf_dir, "documents"), B.table(spark, sf_dir, "benchmark"))
