"""LM scoring: a hidden Markov language model trained by Baum-Welch.

The hidden states emit word *classes*, and a class emits its words, so the parameters
that travel to every task have a fixed size (``STATES`` x ``CLASSES`` numbers) whatever
the vocabulary: the ``TOP_WORDS`` most frequent training words and the end token are
classes of their own, every other word belongs to the class of its ending.  Word counts
are summed over the whole corpus through the block exchange, which also brings each block
the counts of its own words.

Training: each task runs scaled forward-backward over its class sequences, cut into
segments, and the expected counts are summed across partitions by Spark (as integers, so
the order of summation does not matter).  Scoring: the scaled forward recursion over the
whole text.  Long texts are cut into segments whose transfer matrices are multiplied in
order, which is the same recursion, so the likelihood is exact.

Log10 probability of a text = forward probability of its classes + sum of
log10 P(word | class), with P(word | class) = (c + 1) / (n + v + 1) for class totals n and
distinct words v: every class keeps mass for one unseen word.

Cases: a null or empty text is the end token alone; a null ``doc_id`` counts as empty id
text (training) and stays null; repeated rows are counted and scored each; without any
training row the model is uniform; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm import _blocks as B

STATES = 8
TOP_WORDS = 511
END_CLASS = 511
SUFFIX_CLASSES = 512
CLASSES = TOP_WORDS + 1 + SUFFIX_CLASSES
ITERATIONS = 4
SEGMENT = 256
BLOCK_BYTES = 2 << 20  # larger blocks repeat fewer words
FOLDS, HELD_FOLD = 7, 2
SCALE = 1 << 20  # expected counts travel as integers of this resolution

CODED = ("block long, ids binary, lens binary, held binary, known binary, base binary, rest binary, classes binary")
SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


def held_out(ids: np.ndarray) -> np.ndarray:
    text = ["" if i == B.NULL_ID else str(i) for i in ids.tolist()]
    return np.array([zlib.crc32(t.encode()) % FOLDS == HELD_FOLD for t in text], bool)


def _tokens(block: B.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, suffix class (from 0) and number per document of the lower-cased words."""
    low = B.LOWER[block.data]
    ws, we = B.words(low)
    pre = B.bytes_prefix(low)
    h = B.span_hash(pre, ws, we)
    ending = B.span_hash(pre, np.maximum(ws, we - 3), we)
    n = np.searchsorted(ws, block.ends) - np.searchsorted(ws, block.starts)
    return h, (ending % np.uint64(SUFFIX_CLASSES)).astype(np.uint16), n


def _distinct_words(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes, and for each value its place there."""
    order = np.argsort(h)
    s = h[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    place = np.empty(len(h), np.int64)
    place[order] = np.cumsum(new) - 1
    return s[new], place


def _send(buckets: int):
    def make(block: B.Block) -> Iterator[tuple[int, bytes, bytes]]:
        h, suffix, n = _tokens(block)
        keys, place = _distinct_words(h)
        train = np.repeat(~held_out(block.ids), n)
        counts = np.bincount(place, weights=train, minlength=len(keys)).astype(np.int64)
        kind = np.zeros(len(keys), np.int64)
        kind[place] = suffix
        edges = B.bucket_edges(keys, buckets)
        for b in np.flatnonzero(np.diff(edges)):
            s = slice(edges[b], edges[b + 1])
            yield int(b), keys[s].tobytes(), np.stack([counts[s], kind[s]]).astype("<u4").tobytes()
    return make


TOTALS = -1  # block number of a bucket's own table


def _count(sent: DataFrame) -> DataFrame:
    """Answers with the training count of every sent word; and per bucket a ``TOTALS`` row: its
    most frequent words, and the words and distinct words per suffix class."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        keys, counts = t.column("keys").to_pylist(), t.column("counts").to_pylist()
        k = np.concatenate([np.frombuffer(x, np.uint64) for x in keys])
        c = np.concatenate([np.frombuffer(x, "<u4").reshape(2, -1) for x in counts], axis=1)
        u, place = _distinct_words(k)
        total = np.bincount(place, weights=c[0], minlength=len(u)).astype(np.int64)
        got = total[place]
        ends = np.cumsum([0] + [len(x) // 8 for x in keys])
        kind = np.zeros(len(u), np.int64)
        kind[place] = c[1]
        top = np.argsort(-total, kind="stable")[:TOP_WORDS]
        top = top[total[top] > 0]
        n = np.bincount(kind, weights=total, minlength=SUFFIX_CLASSES).astype(np.int64)
        v = np.bincount(kind[total > 0], minlength=SUFFIX_CLASSES)
        has = np.flatnonzero(v)
        own = np.concatenate([np.stack([u[top].view(np.int64), kind[top], total[top], np.zeros(len(top), np.int64)]),
                              np.stack([np.zeros(len(has), np.int64), has, n[has], v[has]])], axis=1)
        return pa.table([pa.array([*t.column("block").to_pylist(), TOTALS], pa.int64()),
                         pa.array([*t.column("bucket").to_pylist(), t.column("bucket")[0].as_py()], pa.int32()),
                         pa.array([*(got[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])), own.tobytes()],
                                  pa.binary())], names=["block", "bucket", "answer"])

    return sent.groupBy("bucket").applyInArrow(run, B.ANSWER)


def _vocabulary(answers: DataFrame) -> DataFrame:
    """The buckets' tables as rows, merged within each task: a frequent word with its count, or a
    class (v > 0) with its totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = np.empty((4, 0), np.int64)
        n, v = np.zeros(SUFFIX_CLASSES, np.int64), np.zeros(SUFFIX_CLASSES, np.int64)
        for batch in batches:
            for x in batch.column("answer").to_pylist():
                own = np.frombuffer(x, np.int64).reshape(4, -1)
                classes = own[:, own[3] > 0]
                n[classes[1]] += classes[2]
                v[classes[1]] += classes[3]
                top = np.concatenate([top, own[:, own[3] == 0]], axis=1)
                top = top[:, np.lexsort((top[0], -top[2]))[:TOP_WORDS]]
        has = np.flatnonzero(v)
        rows = np.concatenate([top, np.stack([np.zeros(len(has), np.int64), has, n[has], v[has]])], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], names=["word", "kind", "n", "v"])

    return answers.filter(F.col("block") == TOTALS).mapInArrow(run, "word long, kind long, n long, v long")


class Model:
    """Bounded parameters: class totals, top words, start, transition and emission."""

    def __init__(self, top: np.ndarray, totals: np.ndarray, kinds: np.ndarray, train_docs: int, tokens: int, size: int):
        self.top, self.totals, self.kinds = top, totals, kinds
        self.train_docs, self.tokens, self.size = train_docs, tokens, size


def _code(model: Model):
    order = np.argsort(model.top)
    top_sorted = model.top[order]
    n, v = model.totals, model.kinds
    per_class = np.log10(n + v + 1.0)
    denominator = np.log10(model.tokens + model.size + 1.0)

    def make(block: B.Block, got: dict[int, bytes]) -> pa.Table:
        h, suffix, count = _tokens(block)
        keys, place = _distinct_words(h)
        total = np.concatenate([np.frombuffer(got[b], np.int64) for b in sorted(got)] or [np.empty(0, np.int64)])
        c = total[place]
        klass = suffix.astype(np.int64) + END_CLASS + 1
        log_c = np.log10(c + 1.0)
        rest = log_c - per_class[suffix]
        if len(top_sorted):
            k = np.minimum(np.searchsorted(top_sorted, keys), len(top_sorted) - 1)
            is_top = (top_sorted[k] == keys)[place]
            klass[is_top] = order[k][place][is_top]
            rest[is_top] = 0.0
        ends = np.cumsum(count)
        add = lambda a: np.diff(np.concatenate([[0.0], np.cumsum(a)])[np.concatenate([[0], ends])])
        by_doc = lambda a: np.array([x.sum() for x in np.split(a, ends[:-1])]) if len(ends) else np.empty(0)
        known = add(c > 0).astype(np.int64) + (model.train_docs > 0)
        base = by_doc(log_c) + np.log10(model.train_docs + 1.0) - (count + 1) * denominator
        seq = np.insert(klass, ends, END_CLASS).astype(np.uint16)
        return pa.table({
            "block": pa.array([block.block], pa.int64()), "ids": [block.ids.tobytes()],
            "lens": [(count + 1).astype(np.int64).tobytes()], "held": [held_out(block.ids).tobytes()],
            "known": [known.tobytes()], "base": [base.tobytes()], "rest": [by_doc(rest).tobytes()],
            "classes": [pa.compress(seq.tobytes(), codec="zstd", asbytes=True)],
        })

    return make


def _decode(row: dict) -> dict:
    lens = np.frombuffer(row["lens"], np.int64)
    n = int(lens.sum())
    raw = pa.decompress(row["classes"], decompressed_size=2 * n, codec="zstd", asbytes=True) if n else b""
    return {"ids": np.frombuffer(row["ids"], np.int64), "lens": lens, "held": np.frombuffer(row["held"], bool),
            "known": np.frombuffer(row["known"], np.int64), "base": np.frombuffer(row["base"], np.float64),
            "rest": np.frombuffer(row["rest"], np.float64), "classes": np.frombuffer(raw, np.uint16)}


def _segments(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, offset in the block, length) of each segment, documents in order."""
    pieces = -(-lens // SEGMENT)
    doc = np.repeat(np.arange(len(lens)), pieces)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(np.cumsum(lens) - lens, pieces) + k * SEGMENT
    return doc, begin, np.minimum(SEGMENT, lens[doc] - k * SEGMENT)


def _grid(classes: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    at = begin[None, :] + np.arange(length.max() if len(length) else 0)[:, None]
    return classes[np.minimum(at, len(classes) - 1)].astype(np.int64)


def expected_counts(classes: np.ndarray, lens: np.ndarray, start, stationary, trans, emit) -> np.ndarray:
    """Baum-Welch counts of one block: start, transition and emission, flattened."""
    doc, begin, length = _segments(lens)
    opening = np.ones(len(doc), bool)
    opening[1:] = doc[1:] != doc[:-1]
    order = np.argsort(-length, kind="stable")
    begin, length, opening = begin[order], length[order], opening[order]
    obs = _grid(classes, begin, length)
    steps, k = len(obs), len(start)
    active = np.searchsorted(-length, -np.arange(steps), side="left")  # segments longer than t
    e = np.ascontiguousarray(emit.T)
    alpha, scale, seen = [], [], []
    for t in range(steps):
        n = active[t]
        p = e[obs[t, :n]]
        a = np.where(opening[:n, None], start, stationary) * p if t == 0 else (alpha[-1][:n] @ trans) * p
        c = a.sum(1)
        a /= c[:, None]
        alpha.append(a), scale.append(c), seen.append(p)
    begin_counts, pair = np.zeros(k), np.zeros((k, k))
    beta = np.ones((active[-1] if steps else 0, k))
    gammas = [None] * steps
    for t in range(steps - 1, -1, -1):
        n = active[t]
        if len(beta) < n:
            beta = np.concatenate([beta, np.ones((n - len(beta), k))])
        gammas[t] = alpha[t] * beta
        if t:
            after = seen[t] * beta / scale[t][:, None]
            pair += alpha[t - 1][:n].T @ after
            beta = after @ trans.T
    if steps:
        begin_counts = gammas[0][opening].sum(0)
    flat = np.concatenate([obs[t, :active[t]] for t in range(steps)]) if steps else np.empty(0, np.int64)
    gamma = np.concatenate(gammas) if steps else np.empty((0, k))
    shown = np.stack([np.bincount(flat, weights=gamma[:, j], minlength=emit.shape[1]) for j in range(k)])
    return np.concatenate([begin_counts, (pair * trans).ravel(), shown.ravel()])


def log_likelihood(classes: np.ndarray, lens: np.ndarray, start, trans, emit) -> np.ndarray:
    """Natural log of the exact forward probability of each whole sequence."""
    k = len(start)
    doc, begin, length = _segments(lens)
    opening = np.ones(len(doc), bool)
    opening[1:] = doc[1:] != doc[:-1]
    e = np.ascontiguousarray(emit.T)

    def run(sel: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """Forward vectors (first segments) or transfer matrices, scaled, with the log scale."""
        order = sel[np.argsort(-length[sel], kind="stable")]
        obs = _grid(classes, begin[order], length[order])
        active = np.searchsorted(-length[order], -np.arange(len(obs)), side="left")
        rows = 1 if first else k
        state = np.broadcast_to(start if first else np.eye(k), (len(order), rows, k)).copy()
        log = np.zeros(len(order))
        for t in range(len(obs)):
            n = active[t]
            s = state[:n]
            if t or not first:
                s = (s.reshape(-1, k) @ trans).reshape(n, rows, k)
            s = s * e[obs[t, :n]][:, None, :]
            c = s.sum((1, 2))
            state[:n] = s / c[:, None, None]
            log[:n] += np.log(c)
        out_state, out_log = np.empty_like(state), np.empty_like(log)
        back = np.argsort(np.argsort(-length[sel], kind="stable"))
        out_state[:], out_log[:] = state[back], log[back]
        return out_state, out_log

    if not len(doc):
        return np.empty(0)
    vector, total = run(np.flatnonzero(opening), True)
    vector = vector[:, 0, :]
    later = np.flatnonzero(~opening)
    if len(later):
        matrix, log = run(later, False)
        d = doc[later]
        rank = later - np.searchsorted(doc, d) - 1
        by_rank = np.argsort(rank, kind="stable")
        edge = np.searchsorted(rank[by_rank], np.arange(rank.max() + 2))
        for r in range(rank.max() + 1):
            i = by_rank[edge[r]:edge[r + 1]]
            v = np.einsum("dk,dkj->dj", vector[d[i]], matrix[i])
            c = v.sum(1)
            vector[d[i]] = v / c[:, None]
            total[d[i]] += np.log(c) + log[i]
    return total


def _normalise(counts: np.ndarray, k: int, background: np.ndarray) -> tuple[np.ndarray, ...]:
    start = counts[:k] + 1.0 / k
    trans = counts[k:k + k * k].reshape(k, k) + 1.0 / k
    shown = counts[k + k * k:].reshape(k, -1)
    stationary = shown.sum(1) + 1.0 / k
    emit = shown + background
    return (start / start.sum(), stationary / stationary.sum(), trans / trans.sum(1, keepdims=True),
            emit / emit.sum(1, keepdims=True))


def train_step(coded: DataFrame, params: tuple[np.ndarray, ...]) -> np.ndarray:
    size = sum(p.size for p in params) - len(params[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for row in batch.to_pylist():
                d = _decode(row)
                keep = ~d["held"]
                tokens = np.repeat(keep, d["lens"])
                if keep.any():
                    total += expected_counts(d["classes"][tokens], d["lens"][keep], *params)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()),
                                          pa.array(np.rint(total[hit] * SCALE).astype(np.int64))], names=["at", "n"])

    rows = coded.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # fixed size
    out = np.zeros(size)
    for r in rows:
        out[r["at"]] = r["n"] / SCALE
    return out


def score(spark: SparkSession, docs: DataFrame, states: int = STATES, iterations: int = ITERATIONS) -> DataFrame:
    """Base score and hidden Markov score of every document."""
    blocks = B.to_blocks(spark, docs, BLOCK_BYTES)
    answers = B.store(spark, _count(B.send(blocks, _send(B.n_buckets(spark, blocks)))), "word-counts")
    train_docs = (docs.select(F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary"))
                              .alias("c")).filter(F.pmod("c", F.lit(FOLDS)) != HELD_FOLD).count())
    words = _vocabulary(answers)
    top = words.filter("v = 0").orderBy(F.desc("n"), "word").limit(TOP_WORDS).collect()  # fixed size
    totals, kinds = np.zeros(SUFFIX_CLASSES), np.zeros(SUFFIX_CLASSES)
    for r in (words.filter("v > 0").groupBy("kind").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
              .collect()):  # one row per class
        totals[r["kind"]], kinds[r["kind"]] = r["n"], r["v"]
    tokens, size = int(totals.sum()) + train_docs, int(kinds.sum()) + (train_docs > 0)
    for r in top:
        totals[r["kind"]] -= r["n"]
        kinds[r["kind"]] -= 1
    model = Model(np.array([r["word"] for r in top], np.int64).view(np.uint64), totals, kinds, train_docs, tokens, size)
    coded = B.store(spark, B.meet(blocks, answers.filter(F.col("block") != TOTALS), _code(model), CODED), "classes")

    seen = np.zeros(CLASSES)
    seen[:len(top)] = [r["n"] for r in top]
    seen[END_CLASS] = train_docs
    seen[END_CLASS + 1:] = totals
    background = (seen + 1) / (seen + 1).sum()
    rng = np.random.default_rng(7)
    params = (np.full(states, 1 / states), np.full(states, 1 / states),
              rng.dirichlet(np.full(states, 5.0), states), background * rng.uniform(0.2, 1.8, (states, CLASSES)))
    params = (*params[:3], params[3] / params[3].sum(1, keepdims=True))
    for _ in range(iterations):
        params = _normalise(train_step(coded, params), states, background)
    start, _, trans, emit = params

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                d = _decode(row)
                total = log_likelihood(d["classes"], d["lens"], start, trans, emit) / np.log(10)
                n = len(d["ids"])
                yield pa.RecordBatch.from_arrays([
                    pa.array(d["ids"], pa.int64(), mask=d["ids"] == B.NULL_ID), pa.array(d["held"]),
                    pa.array(d["lens"]), pa.array(d["known"]), pa.array(np.full(n, tokens, np.int64)),
                    pa.array(d["base"]), pa.array(total + d["rest"])],
                    names=[c.split(" ")[0] for c in SCHEMA.split(", ")])

    return coded.mapInArrow(run, SCHEMA)


def op10_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark, B.table(spark, sf_dir, "documents"))
