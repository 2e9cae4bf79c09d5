"""Suffix-array dedup: earlier matches from longest-previous-factor arrays.

A byte is removed if a string of ``n`` (50) bytes that covers it also starts in a document
with a smaller id.  A text's suffixes must meet the equal suffixes of all other texts, so
the suffix array is cut into buckets that hold whole runs of equal ``n``-byte prefixes:

1. Every ``n``-byte window has an anchor, the k-gram in it with the smallest hash (the
   leftmost one at a tie).  Equal windows have equal anchors.  About one position in 13 is
   an anchor; 4-byte fingerprints of the anchors go through the block exchange, and only
   windows whose anchor is in two documents or more go on.
2. The surviving stretches (all windows of one anchor, with their text) are sent to the
   bucket of the anchor, equal stretches of a block once, with their smallest id.
3. A bucket sorts the suffixes of its distinct stretches.  Where neighbours in suffix order
   share ``n`` bytes or more, a previous or next smaller value (of the id) within the run
   is an earlier match: the longest previous factor of that suffix reaches ``n``.
4. The answers, a bit per window, meet the block again, which removes the covered bytes.

Copies of one text are merged per block before the shuffle; a bucket holds distinct text.

Cases: null and empty texts have nothing to remove; texts under ``n`` bytes stay whole;
rows with equal ids are one id (they remove nothing from each other); a null ``doc_id``
counts as the largest id and comes out null; an empty table gives an empty result;
columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from racelake.llm import _blocks as B

N = 50
K = 24
BUCKET_BYTES = 2 << 20
ALL = (1 << 64) - 1
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


class Stretches:
    """Runs of windows with one anchor: window starts ``begin..end`` (inclusive)."""

    def __init__(self, block: B.Block, n: int = N, k: int = K):
        data = block.data
        self.block, self.n = block, n
        self.pre = B.bytes_prefix(data)
        grams = B.rolling(self.pre, k)
        m = len(data) - n + 1
        if m <= 0:
            self.begin = self.end = self.doc = np.empty(0, np.int64)
            self.anchor = np.empty(0, np.uint64)
            return
        where = B.lowest(grams, n - k + 1)
        inside = np.zeros(len(data) + 1, np.int32)
        long = block.lens >= n
        np.add.at(inside, block.starts[long], 1)
        np.add.at(inside, block.ends[long] - n + 1, -1)
        valid = np.cumsum(inside[:m]) > 0
        change = np.ones(m, bool)
        change[1:] = where[1:] != where[:-1]
        change[1:] |= valid[1:] != valid[:-1]
        begin = np.flatnonzero(change)
        end = np.append(begin[1:], m) - 1
        ok = valid[begin]
        self.begin, self.end = begin[ok], end[ok]
        self.doc = B.per_doc(self.begin, block)
        # a run that spans two documents cannot be: the windows between them are not valid
        self.anchor = B.mix(grams[where[self.begin]])  # minima are small numbers: spread them over the buckets

    def shared(self, got: dict[int, bytes], buckets: int) -> np.ndarray:
        """Which stretches have an anchor that two documents hold."""
        keys = B.distinct(np.sort(self.anchor))
        return B.bits_of(keys, got, buckets)[np.searchsorted(keys, self.anchor)]

    def entries(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Stretches ``keep`` by (anchor, content, id): their order, which are the first of
        their content, and the entry of each."""
        at = np.flatnonzero(keep)
        content = B.span_hash(self.pre, self.begin[at], self.end[at] + self.n)
        order = np.lexsort((self.block.ids[self.doc[at]], content, self.anchor[at]))
        at, content = at[order], content[order]
        first = np.ones(len(at), bool)
        first[1:] = content[1:] != content[:-1]
        return at, first, np.cumsum(first) - 1


def _send_anchors(buckets: int, n: int, k: int):
    def make(block: B.Block) -> Iterator[tuple[int, bytes, bytes]]:
        s = Stretches(block, n, k)
        order = np.lexsort((s.doc, s.anchor))
        a, d = s.anchor[order], s.doc[order]
        new = np.ones(len(a), bool)
        new[1:] = a[1:] != a[:-1]
        keys = a[new]
        heads = np.flatnonzero(new)
        ids = block.ids[d]
        if len(heads):
            many = np.minimum.reduceat(ids, heads) != np.maximum.reduceat(ids, heads)
        else:
            many = np.empty(0, bool)
        edges = B.bucket_edges(keys, buckets)
        low = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
        for b in np.flatnonzero(np.diff(edges)):
            at = slice(edges[b], edges[b + 1])
            yield int(b), low[at].tobytes(), np.packbits(many[at]).tobytes()
    return make


def _zip(a: bytes) -> bytes:
    return pa.compress(a, codec="zstd", asbytes=True)


def _unzip(a: bytes, size: int) -> bytes:
    return pa.decompress(a, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _send_text(blocks: DataFrame, answers: DataFrame, buckets: int, n: int, k: int) -> DataFrame:
    def make(block: B.Block, got: dict[int, bytes]) -> pa.Table:
        s = Stretches(block, n, k)
        at, first, _ = s.entries(s.shared(got, buckets))
        at = at[first]
        length = s.end[at] - s.begin[at] + n
        ids = block.ids[s.doc[at]]
        edges = B.bucket_edges(s.anchor[at], buckets)
        rows: list[tuple] = []
        for b in np.flatnonzero(np.diff(edges)):
            x = slice(edges[b], edges[b + 1])
            rows.append((int(b), block.block, _zip(B.gather_spans(block.data, s.begin[at][x], length[x]).tobytes()),
                         _zip(ids[x].tobytes() + length[x].astype("<u4").tobytes()) +
                         len(ids[x]).to_bytes(8, "little")))
        cols = list(zip(*rows)) if rows else [()] * 4
        return pa.table([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                         pa.array(cols[3], pa.binary())], names=["bucket", "block", "keys", "counts"])

    return B.meet(blocks, answers, make, B.SENT)


def suffix_order(text: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``starts`` by the first ``n`` bytes, eight at a time, refining ties only;
    and the run of each place: neighbours in one run share all ``n`` bytes."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.zeros(len(text), np.uint64)
    for j in range(8):
        eight = (eight << np.uint64(8)) | padded[j:j + len(text)]
    order = np.arange(len(starts))
    run = np.zeros(len(starts), np.int64)
    tied = np.arange(len(starts))
    for j in range(0, n, 8):
        if not len(tied):
            break
        at, group = order[tied], run[tied]
        word = eight[starts[at] + j] >> np.uint64(8 * max(0, j + 8 - n))
        by = np.argsort(word, kind="stable") if j == 0 else np.lexsort((word, group))
        order[tied], word = at[by], word[by]
        new = np.zeros(len(order), bool)
        new[1:] = run[1:] != run[:-1]
        new[tied[1:]] |= (word[1:] != word[:-1]) & (group[1:] == group[:-1])
        run = np.cumsum(new)
        alone = np.ones(len(order), bool)
        alone[1:] &= run[1:] != run[:-1]
        alone[:-1] &= run[1:] != run[:-1]
        tied = np.flatnonzero(~alone)
    return order, run


def earlier_match(order: np.ndarray, run: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For suffixes in suffix ``order``, with ``run`` numbering the stretches of neighbours
    that share the full length: whether a previous or next smaller id lies in the run."""
    rank = np.searchsorted(B.distinct(np.sort(ids)), ids[order])
    wide = int(rank.max(initial=0)) + 1
    out = np.zeros(len(order), bool)
    for step in (1, -1):  # from the left: previous smaller; from the right: next smaller
        r = rank[::step]
        g = run if step == 1 else run.max(initial=0) - run[::-1]
        v = r - g * wide  # a later run lies below every earlier one, so the minimum starts anew
        low = np.minimum.accumulate(v)
        smaller = np.zeros(len(v), bool)
        smaller[1:] = (low[:-1] < v[1:]) & (g[:-1] == g[1:])
        out |= smaller[::step]
    back = np.empty(len(order), bool)
    back[order] = out
    return back


def _merge_text(n: int):
    def merge(keys: list[bytes], counts: list[bytes]) -> list[bytes]:
        ids, length = [], []
        for c in counts:
            m = int.from_bytes(c[-8:], "little")
            raw = _unzip(c[:-8], 12 * m)
            ids.append(np.frombuffer(raw[:8 * m], np.int64))
            length.append(np.frombuffer(raw[8 * m:], "<u4").astype(np.int64))
        sizes = [len(i) for i in ids]
        text = np.frombuffer(b"".join(_unzip(k, int(x.sum())) for k, x in zip(keys, length)), np.uint8)
        ids, length = np.concatenate(ids), np.concatenate(length)
        begin = np.cumsum(length) - length
        # equal stretches of several blocks: one of them, the smallest id, goes into the suffix array
        content = B.span_hash(B.bytes_prefix(text), begin, begin + length)
        order = np.lexsort((ids, content))
        new = np.ones(len(order), bool)
        new[1:] = content[order][1:] != content[order][:-1]
        head, group = order[new], np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        windows = length[head] - n + 1
        before = np.cumsum(windows) - windows
        owner = np.repeat(np.arange(len(head)), windows)
        bit = np.arange(len(owner)) - before[owner]
        order, run = suffix_order(text, begin[head][owner] + bit, n)
        hit = earlier_match(order, run, ids[head][owner])
        mask = np.zeros(len(head), np.uint64)
        np.bitwise_or.at(mask, owner[hit], np.uint64(1) << bit[hit].astype(np.uint64))
        out = np.where(ids > ids[head][group], np.uint64(ALL), mask[group])
        ends = np.cumsum([0] + sizes)
        return [out[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
    return merge


def _remove(buckets: int, n: int, k: int):
    def make(block: B.Block, got: dict[int, bytes]) -> pa.Table:
        s = Stretches(block, n, k)
        at, first, entry = s.entries(s.shared(got, buckets))
        heads = at[first]
        edges = B.bucket_edges(s.anchor[heads], buckets)
        mask = np.concatenate([np.frombuffer(got[buckets + int(b)], np.uint64)
                               for b in np.flatnonzero(np.diff(edges))] or [np.empty(0, np.uint64)])
        ids = block.ids[s.doc[at]]
        mine = np.where(ids > ids[first][entry], np.uint64(ALL), mask[entry])
        length = s.end[at] - s.begin[at] + 1
        own = np.repeat(np.arange(len(at)), length)
        bit = np.arange(len(own)) - np.repeat(np.cumsum(length) - length, length)
        hit = (mine[own] >> bit.astype(np.uint64)) & np.uint64(1) > 0
        starts = (s.begin[at][own] + bit)[hit]
        step = np.zeros(len(block.data) + 1, np.int32)
        np.add.at(step, starts, 1)
        np.add.at(step, starts + n, -1)
        gone = np.cumsum(step[:-1]) > 0
        count = np.concatenate([[0], np.cumsum(gone, dtype=np.int64)])
        opens = np.concatenate([[0], np.cumsum(gone & ~np.concatenate([[False], gone[:-1]]), dtype=np.int64)])
        digest = []
        for a, b in zip(block.starts.tolist(), block.ends.tolist()):
            part = block.data[a:b]
            digest.append(hashlib.sha256((part[~gone[a:b]] if count[b] > count[a] else part).tobytes()).hexdigest())
        return pa.table([block.out_ids(), pa.array(block.lens), pa.array(count[block.ends] - count[block.starts]),
                         pa.array(opens[block.ends] - opens[block.starts]), pa.array(digest)],
                        names=[c.split(" ")[0] for c in SCHEMA.split(", ")])

    return make


def remove_earlier_matches(spark: SparkSession, docs: DataFrame, n: int = N, k: int = K) -> DataFrame:
    """Digest of every text without the bytes an earlier document already has."""
    if not 0 <= n - k < 64:
        raise ValueError("the k-gram must be at most 63 bytes shorter than the window")
    blocks = B.to_blocks(spark, docs)
    buckets = B.n_buckets(spark, blocks, BUCKET_BYTES)
    shared = B.store(spark, B.answer(B.send(blocks, _send_anchors(buckets, n, k)), B.merge_shared), "anchors")
    matched = B.answer(_send_text(blocks, shared, buckets, n, k), _merge_text(n))
    matched = B.store(spark, matched.withColumn("bucket", matched.bucket + buckets), "matches")
    return B.meet(blocks, shared.union(matched), _remove(buckets, n, k), SCHEMA)


def op1_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_earlier_matches(spark, B.table(spark, sf_dir, "documents"))
