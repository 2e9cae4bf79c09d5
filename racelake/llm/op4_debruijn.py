"""Substring dedup: De Bruijn graph of token k-mers, compacted.

Every run of ``n`` (35) words is an edge of a De Bruijn graph between its first and its last
``n - 1`` words; an edge that the corpus has twice or more is a repeated span.  Edges are
never shuffled one by one:

1. The minimizer of an edge is the k-gram of words in it with the smallest hash; consecutive
   edges mostly share it.  Fingerprints of the minimizers go through the block exchange, and
   runs of edges whose minimizer occurs once in the corpus are left out.
2. The edges of the other runs, each block's distinct ones with their number, go to the bucket
   of their hash and are counted there; the answer has the count of each (up to ``MOST``, as
   only "twice or more" matters).
3. Each block turns the counts into spans in source coordinates, whose words are removed.  The
   ``n - 1`` words between two repeated edges are a node; each block's distinct nodes, with the
   edges by which their occurrences come and go, meet in the bucket of the node's hash.  Spans
   are cut into pieces at every node that not all of its occurrences pass by the same two edges.
4. The graph is compacted through Spark joins: a node where exactly one distinct piece ends and
   one begins joins the two, and nonbranching chains become one path (alternating star steps).
   Joined back by source coordinates, each document reports the number of paths it holds and
   the words of the longest one.

Cases: null and empty texts have no words; texts under ``n`` words stay whole; repeated rows
are repeats of each other and all lose the words (every occurrence is removed); a null
``doc_id`` stays null; an empty table gives an empty result; columns other than ``doc_id``
and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm import _blocks as B
from racelake.llm._components import components

N = 35
K = 10
MOST = 255
FOUND = ("block long, place long, doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string, "
         "piece long, left long, right long, edges long")


class Runs:
    """Runs of edges with one minimizer: edge starts ``begin..end`` (inclusive), in words."""

    def __init__(self, block: B.Block, n: int = N, k: int = K):
        self.block, self.n = block, n
        self.ws, self.we = B.words(block.data)
        self.first = np.searchsorted(self.ws, block.starts)
        self.last = np.searchsorted(self.ws, block.ends)
        pre = B.prefix(B.span_hash(B.bytes_prefix(block.data), self.ws, self.we))
        self.edge = B.rolling(pre, n)
        self.node = B.rolling(pre, n - 1)
        m = len(self.edge)
        if not m:
            self.begin = self.end = np.empty(0, np.int64)
            self.minimizer = np.empty(0, np.uint64)
            return
        doc = np.repeat(np.arange(len(block.ids)), self.last - self.first)
        grams = B.rolling(pre, k)
        where = B.lowest(grams, n - k + 1)
        valid = doc[:m] == doc[n - 1:]
        change = np.ones(m, bool)
        change[1:] = (where[1:] != where[:-1]) | (valid[1:] != valid[:-1])
        begin = np.flatnonzero(change)
        end = np.append(begin[1:], m) - 1
        ok = valid[begin]
        self.begin, self.end = begin[ok], end[ok]
        # minima are small numbers: spread them over the buckets
        self.minimizer = B.mix(grams[where[self.begin]])
    def kept(self, got: dict[int, bytes], buckets: int) -> np.ndarray:
        """The edges whose minimizer occurs twice or more, by start."""
        keys = B.distinct(np.sort(self.minimizer))
        at = B.bits_of(keys, got, buckets)[np.searchsorted(keys, self.minimizer)]
        begin, length = self.begin[at], (self.end - self.begin + 1)[at]
        return np.repeat(begin - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))

    def repeated(self, got: dict[int, bytes], buckets: int) -> np.ndarray:
        """Whether the corpus has the edge that starts at a word twice or more."""
        at = self.kept(got, buckets)
        keys = B.distinct(np.sort(self.edge[at]))
        times = np.concatenate([np.frombuffer(got[b], "u1") for b in sorted(got) if buckets <= b < 2 * buckets]
                               or [np.empty(0, "u1")])
        out = np.zeros(len(self.ws), bool)
        out[at] = times[np.searchsorted(keys, self.edge[at])] > 1
        return out

    def ends(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where nodes of repeated edges start, and the edges before and after each (0: not both repeated)."""
        came = np.concatenate([[False], repeated])
        goes = np.append(repeated, False)
        at = np.flatnonzero(came | goes)
        through = came[at] & goes[at]
        way = np.zeros(len(at), np.uint64)
        p = at[through]
        way[through] = B.mix(self.edge[p - 1] + B.mix(self.edge[p]) * np.uint64(3))
        return at, way


def _send_minimizers(buckets: int, n: int, k: int):
    def make(block: B.Block) -> Iterator[tuple[int, bytes, bytes]]:
        a = np.sort(Runs(block, n, k).minimizer)
        keys = B.distinct(a)
        many = np.diff(np.append(np.searchsorted(a, keys), len(a))) > 1
        edges = B.bucket_edges(keys, buckets)
        low = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
        for b in np.flatnonzero(np.diff(edges)):
            at = slice(edges[b], edges[b + 1])
            yield int(b), low[at].tobytes(), np.packbits(many[at]).tobytes()
    return make


def _send_edges(blocks: DataFrame, answers: DataFrame, buckets: int, n: int, k: int) -> DataFrame:
    def make(block: B.Block, got: dict[int, bytes]) -> pa.Table:
        s = Runs(block, n, k)
        a = np.sort(s.edge[s.kept(got, buckets)])
        keys = B.distinct(a)
        times = np.minimum(np.diff(np.append(np.searchsorted(a, keys), len(a))), MOST).astype("u1")
        edges = B.bucket_edges(keys, buckets)
        rows = [(int(b), block.block, keys[edges[b]:edges[b + 1]].tobytes(), times[edges[b]:edges[b + 1]].tobytes())
                for b in np.flatnonzero(np.diff(edges))]
        cols = list(zip(*rows)) if rows else [()] * 4
        return pa.table([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                         pa.array(cols[3], pa.binary())], names=["bucket", "block", "keys", "counts"])

    return B.meet(blocks, answers, make, B.SENT)


def _count_edges(keys: list[bytes], counts: list[bytes]) -> list[bytes]:
    """Per sent edge how often the corpus has it, ``MOST`` for more."""
    times = np.concatenate([np.frombuffer(c, "u1") for c in counts]).astype(np.int64)
    at, opens = B.groups(np.concatenate([np.frombuffer(k, np.uint64) for k in keys]))
    if len(at):
        heads = np.flatnonzero(opens)
        times[at] = np.repeat(np.add.reduceat(times[at], heads), np.diff(np.append(heads, len(at))))
    times = np.minimum(times, MOST).astype("u1")
    ends = np.cumsum([0] + [len(c) for c in counts])
    return [times[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]


def _one_way(nodes: np.ndarray, way: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes in order, and the way of those that all occurrences pass alike, else 0."""
    order = np.argsort(nodes, kind="stable")
    nodes, way = nodes[order], way[order]
    if not len(nodes):
        return nodes, way
    heads = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1]))
    low, high = np.minimum.reduceat(way, heads), np.maximum.reduceat(way, heads)
    return nodes[heads], np.where(low == high, low, np.uint64(0))


def _send_nodes(blocks: DataFrame, answers: DataFrame, buckets: int, n: int, k: int) -> DataFrame:
    def make(block: B.Block, got: dict[int, bytes]) -> pa.Table:
        s = Runs(block, n, k)
        at, way = s.ends(s.repeated(got, buckets))
        keys, way = _one_way(s.node[at], way)
        edges = B.bucket_edges(keys, buckets)
        rows = [(int(b), block.block, keys[edges[b]:edges[b + 1]].tobytes(), way[edges[b]:edges[b + 1]].tobytes())
                for b in np.flatnonzero(np.diff(edges))]
        cols = list(zip(*rows)) if rows else [()] * 4
        return pa.table([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()),
                         pa.array(cols[3], pa.binary())], names=["bucket", "block", "keys", "counts"])

    return B.meet(blocks, answers, make, B.SENT)


def _passed(keys: list[bytes], ways: list[bytes]) -> list[bytes]:
    """Per sent node a bit: whether all of its occurrences pass it by the same two edges."""
    own = [np.frombuffer(k, np.uint64) for k in keys]
    nodes, way = _one_way(np.concatenate(own), np.concatenate([np.frombuffer(w, np.uint64) for w in ways]))
    return [np.packbits(way[np.searchsorted(nodes, k)] != 0).tobytes() for k in own]


def _remove(buckets: int, n: int, k: int):
    def make(block: B.Block, got: dict[int, bytes]) -> pa.Table:
        s = Runs(block, n, k)
        repeated = s.repeated(got, buckets)
        gone = B.slide_max(repeated, n)
        count = np.concatenate([[0], np.cumsum(gone, dtype=np.int64)])
        start = gone.copy()
        start[1:] &= ~gone[:-1]
        at_first = s.first[s.last > s.first]
        start[at_first] = gone[at_first]
        opens = np.concatenate([[0], np.cumsum(start, dtype=np.int64)])
        kept = np.flatnonzero(~gone)
        length = s.we[kept] - s.ws[kept] + 1
        text = B.gather_spans(block.data, s.ws[kept], length)
        text[np.cumsum(length) - 1] = 32
        ends = np.concatenate([[0], np.cumsum(length)])
        low, high = np.searchsorted(kept, s.first), np.searchsorted(kept, s.last)
        digest = [hashlib.sha256(text[ends[a]:max(ends[b] - 1, ends[a])].tobytes()).hexdigest()
                  for a, b in zip(low, high)]
        # repeated pieces: runs of repeated edges between nodes where the ways part, begin or end
        at, _ = s.ends(repeated)
        keys = B.distinct(np.sort(s.node[at]))
        passed = B.bits_of(keys, {b - 2 * buckets: a for b, a in got.items() if b >= 2 * buckets}, buckets)
        cut = np.zeros(len(repeated) + 1, bool)
        cut[at] = ~passed[np.searchsorted(keys, s.node[at])]
        head = np.flatnonzero(repeated & cut[:-1])
        ends = np.flatnonzero(cut)
        end = ends[np.searchsorted(ends, head, side="right")]
        piece = B.mix(s.edge[head] + B.mix(s.edge[end - 1]) * np.uint64(3) + (end - head).astype(np.uint64)).view(np.int64)
        place = np.searchsorted(s.last, head, side="right")
        docs, pieces = len(block.ids), len(head)
        none = lambda size, kind: pa.nulls(size, kind)
        digests = pa.table([pa.array(np.full(docs, block.block)), pa.array(np.arange(docs)), block.out_ids(),
                            pa.array(s.last - s.first), pa.array(count[s.last] - count[s.first]),
                            pa.array(opens[s.last] - opens[s.first]), pa.array(digest, pa.string()),
                            *[none(docs, pa.int64())] * 4], names=[c.split(" ")[0] for c in FOUND.split(", ")])
        parts = pa.table([pa.array(np.full(pieces, block.block)), pa.array(place),
                          *[none(pieces, pa.int64())] * 4, none(pieces, pa.string()), pa.array(piece),
                          pa.array(s.node[head].view(np.int64)), pa.array(s.node[end].view(np.int64)),
                          pa.array(end - head)], names=digests.column_names)
        return pa.concat_tables([digests, parts])

    return make


def paths(spark: SparkSession, pieces: DataFrame, n: int) -> DataFrame:
    """Compacted paths per document: (block, place, n_paths, longest_path)."""
    ends = B.store(spark, pieces.select("piece", "left", "right").distinct(), "piece-ends")
    # nodes by their real degree: the distinct pieces that end there and begin there
    single = lambda c, name: (ends.groupBy(c).agg(F.count(F.lit(1)).alias("ways"), F.min("piece").alias(name))
                              .filter("ways = 1").select(F.col(c).alias("node"), name))
    chain = single("right", "before").join(single("left", "piece"), "node")
    label = components(spark, chain.select(F.col("before").alias("a"), F.col("piece").alias("b")))
    named = (pieces.join(label, pieces["piece"] == label["node"], "left")
             .select("block", "place", "piece", "edges", F.coalesce("label", "piece").alias("path")))
    named = B.store(spark, named, "piece-paths")
    length = (named.groupBy("path", "piece").agg(F.first("edges").alias("edges"))
              .groupBy("path").agg((F.sum("edges") + n - 1).alias("words")))
    return (named.select("block", "place", "path").distinct().join(length, "path").groupBy("block", "place")
            .agg(F.count(F.lit(1)).alias("n_paths"), F.max("words").alias("longest_path")))


def remove_repeated_spans(spark: SparkSession, docs: DataFrame, n: int = N, k: int = K) -> DataFrame:
    """Digest of every text without the words of its repeated spans, and its compacted paths."""
    blocks = B.to_blocks(spark, docs)
    buckets = B.n_buckets(spark, blocks)
    shared = B.store(spark, B.answer(B.send(blocks, _send_minimizers(buckets, n, k)), B.merge_shared), "minimizers")
    counted = B.answer(_send_edges(blocks, shared, buckets, n, k), _count_edges)
    counted = B.store(spark, counted.withColumn("bucket", counted.bucket + buckets), "edges")
    passed = B.answer(_send_nodes(blocks, shared.union(counted), buckets, n, k), _passed)
    passed = B.store(spark, passed.withColumn("bucket", passed.bucket + 2 * buckets), "nodes")
    found = B.store(spark, B.meet(blocks, shared.union(counted).union(passed), _remove(buckets, n, k), FOUND), "spans")
    B.drop(spark, blocks)
    held = paths(spark, found.filter("piece is not null").select("block", "place", "piece", "left", "right", "edges"), n)
    return (found.filter("piece is null").join(held, ["block", "place"], "left")
            .select("doc_id", "n_words", "n_removed", "n_spans", "kept_sha256",
                    F.coalesce("n_paths", F.lit(0)).cast("long").alias("n_paths"),
                    F.coalesce("longest_path", F.lit(0)).cast("long").alias("longest_path")))


def op4_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_spans(spark, B.table(spark, sf_dir, "documents"))
