"""N-gram Jaccard join by vertical partitioning.

A document is the set of its distinct 5-word shingles (64-bit hashes).  The exact join
``100 * |A & B| >= 80 * |A | B|`` runs in these steps.

1. Document frequencies of all shingles by the block exchange (4-byte fingerprints, answers
   of one byte: the size class of the frequency).  A shingle found in one document only can
   be in no intersection, so a document with fewer than 80 % other shingles has no partner.
2. The global n-gram order is (frequency class, hash), rare first.  Two linked sets share a
   shingle among the first ``n - ceil(0.8 n) + 1`` of each (prefix filter); documents meet
   on these.  Equal sets are one node from here on.
3. Per prefix shingle one centre, the set with the smallest share of unshared shingles, is
   compared with the others (no all-pairs output inside a group).  A set not linked to its
   group's centre is then compared with the rest of that group unless both already are in
   one component, so no connection is lost.
4. Overlaps are counted by vertical partitioning: every set is cut into fragments of the hash
   order, partial overlaps are counted per (pair, fragment) in different tasks, and summed
   per pair.

Cases: null text, empty text and text without words: no shingle, a component of its own;
fewer than five words: one shingle of the whole sequence; repeated rows have equal sets; a
null ``doc_id`` counts as the largest id and comes out null; an empty table gives an empty
result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm import _blocks as B
from racelake.llm._components import components

N = 5
PERCENT = 80
FRAGMENTS = 4
SETS = "doc_id long, n_shingles long, node long, shared long, grams binary"


def _shingles(block: B.Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, shingle hash) pairs of a block, by document."""
    low = B.LOWER[block.data]
    ws, we = B.words(low)
    h = B.span_hash(B.bytes_prefix(low), ws, we)
    n = np.searchsorted(ws, block.ends) - np.searchsorted(ws, block.starts)
    doc = np.repeat(np.arange(len(n)), n)
    pre = B.prefix(h)
    grams = B.rolling(pre, N)
    here = np.flatnonzero(doc[:len(grams)] == doc[N - 1:]) if len(grams) else np.empty(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < N))
    first = np.searchsorted(ws, block.starts[short])
    d = np.concatenate([doc[here], short])
    g = np.concatenate([grams[here], B.span_hash(pre, first, first + n[short])])
    salt = B.mix(np.arange(1, len(n) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    at, opens = B.groups(g ^ salt[d])
    keep = np.ones(len(g), bool)
    keep[at[~opens]] = False
    return d[keep], g[keep]


def _send(buckets: int):
    def make(block: B.Block) -> Iterator[tuple[int, bytes, bytes]]:
        _, g = _shingles(block)
        g.sort()
        keys = B.distinct(g)
        times = np.diff(np.append(np.searchsorted(g, keys), len(g)))
        edges = B.bucket_edges(keys, buckets)
        low = (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
        times = np.minimum(times, 65535).astype("<u2")
        for b in np.flatnonzero(np.diff(edges)):
            s = slice(edges[b], edges[b + 1])
            yield int(b), low[s].tobytes(), times[s].tobytes()
    return make


def _merge(keys: list[bytes], counts: list[bytes]) -> list[bytes]:
    """Per sent key the bit length of (documents with the key - 1): 0 for one document."""
    k = np.concatenate([np.frombuffer(x, "<u4") for x in keys]).astype(np.uint64)
    c = np.concatenate([np.frombuffer(x, "<u2") for x in counts]).astype(np.int64)
    key = (k << np.uint64(32)) | np.arange(len(k), dtype=np.uint64)
    key.sort()
    at = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fp = key >> np.uint64(32)
    new = np.ones(len(fp), bool)
    new[1:] = fp[1:] != fp[:-1]
    heads = np.flatnonzero(new)
    total = np.add.reduceat(c[at], heads)
    size = np.frexp((total - 1).astype(np.float64))[1].astype(np.uint8)
    out = np.empty(len(k), np.uint8)
    out[at] = np.repeat(size, np.diff(np.append(heads, len(fp))))
    ends = np.cumsum([0] + [len(x) // 4 for x in keys])
    return [out[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]


def _sets(block: B.Block, got: dict[int, bytes]) -> pa.Table:
    """Per document its shared shingles in the global order, if they can reach the threshold."""
    d, g = _shingles(block)
    keys = B.distinct(np.sort(g))
    size = np.concatenate([np.frombuffer(got[b], np.uint8) for b in sorted(got)] or [np.empty(0, np.uint8)])
    kind = size[np.searchsorted(keys, g)]
    docs = len(block.ids)
    n = np.bincount(d, minlength=docs)
    shared = np.bincount(d[kind > 0], minlength=docs)
    live = (shared > 0) & (100 * shared >= PERCENT * n)
    total, parity = np.zeros(docs, np.uint64), np.zeros(docs, np.uint64)
    np.add.at(total, d, g)
    np.bitwise_xor.at(parity, d, g)
    sign = B.mix(B.mix(total) + B.mix(parity + np.uint64(1)) * np.uint64(3) + n.astype(np.uint64))
    keep = (kind > 0) & live[d]
    d, g, kind = d[keep], g[keep], kind[keep]
    order = np.lexsort((g, kind, d))
    d, g = d[order], g[order]
    grams: list[bytes | None] = [None] * docs
    at = np.searchsorted(d, np.arange(docs + 1))
    for i in np.flatnonzero(live):
        grams[i] = g[at[i]:at[i + 1]].tobytes()
    return pa.table([block.out_ids(), pa.array(n.astype(np.int64)), pa.array(sign.view(np.int64), mask=~live),
                     pa.array(shared.astype(np.int64)), pa.array(grams, pa.binary())],
                    names=["doc_id", "n_shingles", "node", "shared", "grams"])


def _prefixes(sets: DataFrame) -> DataFrame:
    """(shingle, node, n, unshared, place) of the prefix shingles that another document may share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for r in batch.to_pylist():
                g = np.frombuffer(r["grams"], np.int64)
                n, lone = r["n_shingles"], r["n_shingles"] - r["shared"]
                take = max(0, n - -(-PERCENT * n // 100) + 1 - lone)
                g = g[:take]
                for col, v in zip(out, (g, r["node"], n, lone, lone + np.arange(len(g)))):
                    col.append(np.broadcast_to(np.asarray(v, np.int64), len(g)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else np.empty(0, np.int64)) for c in out],
                names=["gram", "node", "n", "lone", "place"])

    return sets.mapInArrow(run, "gram long, node long, n long, lone long, place long")


def _fragments(sets: DataFrame) -> DataFrame:
    """Vertical partitions: (node, fragment, shingles of this range of the hash order)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                g = np.sort(np.frombuffer(r["grams"], np.uint64))
                edges = B.bucket_edges(g, FRAGMENTS)
                rows += [(r["node"], r["n_shingles"], f, g[edges[f]:edges[f + 1]].tobytes())
                         for f in range(FRAGMENTS)]
            cols = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.binary())], names=["node", "n", "fragment", "part"])

    return sets.mapInArrow(run, "node long, n long, fragment int, part binary")


def _linked(parts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) that reach the threshold: partial overlaps per fragment, summed per pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = []
            for x, y in zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist()):
                z = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                z.sort()
                both.append(int((z[1:] == z[:-1]).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(both, pa.int64())],
                                             names=["a", "b", "na", "nb", "both"])

    left = parts.select(F.col("node").alias("a"), "fragment", F.col("n").alias("na"), F.col("part").alias("pa"))
    right = parts.select(F.col("node").alias("b"), "fragment", F.col("n").alias("nb"), F.col("part").alias("pb"))
    rows = (pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))))
            .join(B.merged(right), ["b", "fragment"]).join(B.merged(left), ["a", "fragment"])
            .select("a", "b", "na", "nb", "pa", "pb"))
    return (rows.mapInArrow(run, "a long, b long, na long, nb long, both long")
            .groupBy("a", "b", "na", "nb").agg(F.sum("both").alias("both"))
            .filter(100 * F.col("both") >= PERCENT * (F.col("na") + F.col("nb") - F.col("both")))
            .select("a", "b"))


def _possible(x: str, y: str):
    """Length and position bounds of two prefix rows that share a shingle as their first one."""
    nx, ny = F.col(f"{x}.n"), F.col(f"{y}.n")
    most = F.least(nx - F.col(f"{x}.place"), ny - F.col(f"{y}.place"))
    return (100 * F.least(nx, ny) >= PERCENT * F.greatest(nx, ny)) & (
        (100 + PERCENT) * most >= PERCENT * (nx + ny))


def jaccard_components(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and the smallest ``doc_id`` reachable by links."""
    blocks = B.to_blocks(spark, docs)
    answers = B.answer(B.send(blocks, _send(B.n_buckets(spark, blocks))), _merge)
    sets = B.store(spark, B.meet(blocks, answers, _sets, SETS), "sets")
    del answers
    B.drop(spark, blocks)
    live = sets.filter("node is not null")
    nodes = B.store(spark, live.groupBy("node").agg(F.first("n_shingles").alias("n_shingles"),
                                                    F.first("shared").alias("shared"),
                                                    F.first("grams").alias("grams")), "nodes")
    parts = B.store(spark, _fragments(nodes), "fragments")
    prefix = _prefixes(nodes)
    best = (prefix.groupBy("gram").agg(F.count(F.lit(1)).alias("times"),
                                       F.min(F.struct((F.col("lone") / F.col("n")).alias("share"), "node", "n", "place"))
                                       .alias("c")).filter("times > 1")
            .select("gram", F.col("c.node").alias("node"), F.col("c.n").alias("n"), F.col("c.place").alias("place")))
    prefix = B.store(spark, prefix.join(B.merged(best.select("gram", F.col("node").alias("centre"))), "gram"), "prefixes")
    centres = prefix.filter("node = centre").select("gram", "node", "n", "place")
    pairs = B.store(spark, prefix.alias("x").join(B.merged(centres.alias("y")), "gram")
                    .filter("x.node <> y.node").filter(_possible("x", "y"))
                    .select(F.col("y.node").alias("a"), F.col("x.node").alias("b")).distinct(), "pairs")
    links = B.store(spark, _linked(parts, pairs), "star-links")

    # Sets that did not link to the centre of a group: compare them with the group's other components.
    label = components(spark, links)
    linked = links.select(F.col("a").alias("centre"), F.col("b").alias("node"), F.lit(1).alias("ok"))
    member = (prefix.join(B.merged(linked), ["centre", "node"], "left").join(B.merged(label), "node", "left")
              .select("gram", "node", "n", "place", "centre",
                      ((F.col("node") == F.col("centre")) | F.col("ok").isNotNull()).alias("ok"),
                      F.coalesce("label", "node").alias("label")))
    member = B.store(spark, member, "members")
    apart = member.filter("not ok")
    more = (apart.alias("x").join(B.merged(member.filter("node <> centre").alias("y")), "gram")
            .filter("x.label <> y.label").filter(_possible("x", "y"))
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct())
    met = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = B.store(spark, more.join(B.merged(met), ["a", "b"], "left_anti"), "more-pairs")
    if not more.isEmpty():
        label = components(spark, links.union(B.store(spark, _linked(parts, more), "more-links")))

    lowest = live.groupBy("node").agg(F.min(F.coalesce("doc_id", F.lit(B.NULL_ID))).alias("low"))
    group = (lowest.join(B.merged(label), "node", "left").select("node", "low", F.coalesce("label", "node").alias("label")))
    head = group.groupBy("label").agg(F.min("low").alias("head"))
    head = group.join(B.merged(head), "label").select("node", "head")
    return (sets.select("doc_id", "n_shingles", "node").join(B.merged(head), "node", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("head") == B.NULL_ID, F.lit(None)).otherwise(F.coalesce("head", "doc_id"))
                    .cast("long").alias("component_id")))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, B.table(spark, sf_dir, "documents"))
