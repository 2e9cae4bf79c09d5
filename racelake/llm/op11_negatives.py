"""Hard-negative mining by a vertical scan of bounded candidates (BOND).

A stripe of rows is held by columns.  For each anchor its columns are read in the order of the
anchor's descending magnitudes, a few at a time, and every candidate's partial score grows.  The
columns' smallest and largest values bound what the columns not yet read can still add, so a
candidate's score lies in an interval; the bitmap of candidates shrinks as the intervals do:

* positives: a row of the anchor's label stays while its upper bound reaches the k-th best lower
  bound, until the best remain exactly;
* negatives: with the positives' windows known, a row of another label stays while its interval
  meets a window of which fewer than the wanted rows are certainly inside and above it.

Once few candidates are left, later columns are read for these alone.  Each stripe gives its own
best rows (at most ``positives`` or ``negatives`` for each window), Spark ranks them over all
stripes.  Anchors and rows meet in blocks (``_vectors.tiles``) dealt evenly, so neither a hot
label nor a hot vector gathers anywhere.

Cases: rows with a null id, a null label, a null vector or a null or non-finite component take no
part; a repeated row (id, label and vector) counts once, while one id with two vectors or labels is
two rows; an empty vector is one of zeros, and shorter vectors are continued by zeros; ties go to
the smaller id; an empty table gives an empty result; columns other than ``vec_id``, ``embedding``
and ``label`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelake.llm import _blocks as B
from racelake.llm import _vectors as V

SCALE = 256
ANCHOR_STEP = 50
MOVED_STEP = 7       # the rows whose label first moves on
LABELS = 10
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95   # percent of the positive's score
ANCHOR_ROWS = 512
STRIPE_ROWS = 8192
STEP = 8             # columns read between two prunings
SHRINK = 0.5         # share of candidates under which columns are read for the rest alone

FOUND = "q_block long, anchor int, anchor_id long, vec_id long, score long"
WITHIN = ("q_block long, anchor int, anchor_id long, positive int, positive_id long, positive_score long, "
          "negative_id long, negative_score long")
Narrow = Callable[[np.ndarray, float, float, np.ndarray], np.ndarray]


class Stripe:
    """Rows by columns, with the bounds of each column."""

    def __init__(self, shape: V.Shape, row: dict):
        self.ids = np.frombuffer(row["r_ids"], "<i8")
        self.labels = np.frombuffer(row["r_labels"], "<i8")
        self.columns = np.ascontiguousarray(shape.matrix(row["r_data"], row["r_n"]).T)
        self.low, self.high = self.columns.min(1), self.columns.max(1)

    def own(self, anchor_id: int, label: int, a: np.ndarray) -> np.ndarray:
        """Where the anchor's own row stands."""
        at = np.flatnonzero((self.ids == anchor_id) & (self.labels == label))
        return at[(self.columns[:, at] == a[:, None]).all(0)]

    def scan(self, a: np.ndarray, alive: np.ndarray, narrow: Narrow) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the bitmap ``alive`` that ``narrow`` keeps to the end, and their exact scores.

        ``narrow`` gets the partial scores, the least and the most that the columns not yet read can
        add, and the bitmap; it gives the rows that may stay."""
        if a.dtype == np.int64:  # bounds could overflow: every column is read
            at = np.flatnonzero(alive)
            part = a @ self.columns[:, at]
            keep = narrow(part, 0, 0, np.ones(len(at), bool))
            return at[keep], part[keep]
        order = np.argsort(-np.abs(a), kind="stable")
        edges = np.stack([a[order].astype(float) * self.low[order], a[order].astype(float) * self.high[order]])
        rest = np.zeros((2, len(a) + 1))
        rest[:, :-1] = np.stack([edges.min(0), edges.max(0)])[:, ::-1].cumsum(1)[:, ::-1]
        slack = np.abs(edges).sum() * 1e-12  # rounding of the bounds' own sums
        at, part = None, np.zeros(len(alive), a.dtype)
        for s in range(0, len(a), STEP):
            dims = order[s:s + STEP]
            part += a[dims] @ (self.columns[dims] if at is None else self.columns[np.ix_(dims, at)])
            done = min(s + STEP, len(a))
            least, most = (rest[:, done] + [-slack, slack]) if done < len(a) else (0, 0)
            alive &= narrow(part, float(least), float(most), alive)
            left = int(np.count_nonzero(alive))
            if not left:
                return np.empty(0, np.int64), part[:0]
            if left < SHRINK * len(alive):
                keep = np.flatnonzero(alive)
                at, part, alive = keep if at is None else at[keep], part[keep], np.ones(left, bool)
        keep = np.flatnonzero(alive)
        return keep if at is None else at[keep], part[keep]


def best_rows(k: int) -> Narrow:
    """Rows whose upper bound reaches the k-th best lower bound."""

    def narrow(part: np.ndarray, least: float, most: float, alive: np.ndarray) -> np.ndarray:
        known = part[alive]
        if len(known) <= k:
            return alive
        kth = float(np.partition(known, len(known) - k)[len(known) - k])
        return part >= kth + least - most

    return narrow


def in_windows(windows: list[tuple[int, int]], k: int) -> Narrow:
    """Rows that can be among the first ``k`` of a window (lowest and highest score)."""

    def narrow(part: np.ndarray, least: float, most: float, alive: np.ndarray) -> np.ndarray:
        stays = np.zeros(len(part), bool)
        for low, high in windows:
            floor = low - most
            under = part <= high - least
            inside = part[alive & (part >= low - least) & (part <= high - most)]
            if len(inside) >= k:
                floor = max(floor, float(np.partition(inside, len(inside) - k)[len(inside) - k]) + least - most)
            stays |= under & (part >= floor)
        return stays

    return narrow


def first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def _anchors(shape: V.Shape, row: dict) -> list[tuple[int, int, int, np.ndarray]]:
    """(place, id, label, vector) of a block's anchors."""
    m = shape.matrix(row["q_data"], row["q_n"])
    ids, labels = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["q_labels"], "<i8")
    return [(k, int(ids[k]), int(labels[k]), m[k]) for k in range(len(ids))]


def _rows(rows: list[tuple], schema: str) -> pa.Table:
    names = [c.split(" ")[0] for c in schema.split(", ")]
    kinds = [pa.int32() if c.endswith(" int") else pa.int64() for c in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def positives(anchors: V.Blocks, stripes: V.Blocks, shape: V.Shape, k: int) -> DataFrame:
    """The ``k`` best other rows of each anchor's label: (q_block, anchor, anchor_id, positive, positive_id,
    positive_score), ``positive`` their rank."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        out = []
        for row in t.to_pylist():
            stripe = Stripe(shape, row)
            for place, anchor_id, label, a in _anchors(shape, row):
                alive = stripe.labels == label
                alive[stripe.own(anchor_id, label, a)] = False
                at, score = stripe.scan(a, alive, best_rows(k))
                score = score.astype(np.int64)
                out += [(row["q_block"], place, anchor_id, int(stripe.ids[at[i]]), int(score[i]))
                        for i in first(score, stripe.ids[at], k)]
        return _rows(out, FOUND)

    order = Window.partitionBy("q_block", "anchor").orderBy(F.desc("score"), "vec_id")
    return (V.tiles(anchors, stripes).applyInArrow(run, FOUND)
            .withColumn("positive", F.row_number().over(order)).filter(F.col("positive") <= k)
            .select("q_block", "anchor", "anchor_id", "positive", F.col("vec_id").alias("positive_id"),
                    F.col("score").alias("positive_score")))


def negatives(anchors: V.Blocks, stripes: V.Blocks, shape: V.Shape, chosen: DataFrame, k: int, low: int,
              high: int) -> DataFrame:
    """The first ``k`` rows of other labels whose score lies between ``low`` and ``high`` percent of the positive's."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        windows: dict[int, list[dict]] = {}
        for p in right.to_pylist():
            windows.setdefault(p["anchor"], []).append(p)
        out = []
        for row in left.to_pylist():
            stripe = Stripe(shape, row)
            for place, anchor_id, label, a in _anchors(shape, row):
                asked = [(p, -(-low * p["positive_score"] // 100), high * p["positive_score"] // 100)
                         for p in windows.get(place, ())]
                asked = [w for w in asked if w[1] <= w[2]]
                if not asked:
                    continue
                at, score = stripe.scan(a, stripe.labels != label, in_windows([w[1:] for w in asked], k))
                score, ids = score.astype(np.int64), stripe.ids[at]
                for p, least, most in asked:
                    here = np.flatnonzero((score >= least) & (score <= most))
                    out += [(row["q_block"], place, anchor_id, p["positive"], p["positive_id"], p["positive_score"],
                             int(ids[i]), int(score[i])) for i in here[first(score[here], ids[here], k)]]
        return _rows(out, WITHIN)

    sent = V.beside(chosen, "r_block", stripes.count).withColumn("slice", F.lit(0))
    order = (Window.partitionBy("q_block", "anchor", "positive").orderBy(F.desc("negative_score"), "negative_id"))
    return (V.tiles(anchors, stripes).cogroup(sent.groupBy(*V.PAIR)).applyInArrow(run, WITHIN)
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def mine(spark: SparkSession, vectors: DataFrame, is_anchor: Column, n_positives: int = POSITIVES,
         n_negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, anchor_rows: int = ANCHOR_ROWS,
         stripe_rows: int = STRIPE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the integer
    ``vectors`` (vec_id, label, z)."""
    shape = V.Shape.of(vectors)
    rows = vectors.withColumn("z", F.col("z").cast(f"array<{shape.kind}>")).distinct()
    rows = B.store(spark, rows, "labelled", free=False)
    chosen = rows.filter(is_anchor)
    stripes = V.blocks(spark, rows, shape, rows.count(), stripe_rows, "stripes")
    anchors = V.blocks(spark, chosen, shape, chosen.count(), anchor_rows, "anchors")
    best = B.store(spark, positives(anchors, stripes, shape, n_positives), "positives", free=False)
    return negatives(anchors, stripes, shape, best, n_negatives, low, high)


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % MOVED_STEP == 0, (label + 1) % LABELS).otherwise(label)
    vectors = V.integer_vectors(B.table(spark, sf_dir, "embeddings"), SCALE, label=moved)
    return mine(spark, vectors, F.col("vec_id") % ANCHOR_STEP == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, label, unnest(z) AS x, generate_subscripts(z, 1) AS d FROM v),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same, CAST(sum(a.x * c.x) AS BIGINT) AS score
  FROM u a JOIN u c ON a.d = c.d
  WHERE a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
  GROUP BY 1, 2, 3),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
