"""Exact top-k search by inner product: three-phase uniform threshold over column slices.

The score of a row is the sum of its partial scores over ``slices`` runs of components, and each
slice is searched apart, as a list of its own.

1. Every slice gives its k best partial scores of each query (stripe by stripe, then merged).
   The rows that these lists name are scored in full; the k-th best full score is a score that
   the answer certainly reaches.
2. That score divided by the number of slices is the uniform cutoff: a row below it in every
   slice is below the score in total.  It is sent to every slice, which returns all its entries
   at or above it.  Entries of one row meet: known parts plus the cutoff for each missing part
   bound its score, and rows that cannot reach the best known scores go.
3. The missing parts of the remaining rows are computed in their slices and added; the totals
   are exact, and the k best, ties to the smaller id, are merged over the stripes.

Queries and rows meet in blocks (``_vectors.tiles``); nothing is collected.  Equal vectors are
one object with its k + 1 smallest ids, which is all that any answer can name, so a vector that
a third of the rows share is searched once, and its queries share one search.

Cases: rows with a null id, a null vector or a null or non-finite component take no part; a
repeated row (id and vector) counts once, while one id with two vectors is two rows, each a query
of its own; an empty vector is one of zeros, and shorter vectors are continued by zeros; with
fewer than k other rows all are returned; an empty table gives an empty result; columns other than
``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelake.llm import _blocks as B
from racelake.llm import _vectors as V

K = 20
SCALE = 64
QUERY_STEP = 20
SLICES = 2
QUERY_ROWS = 2048
STRIPE_ROWS = 8192
CHUNK = 256  # queries of a block whose lists are merged in one group
FAN = 16  # stripes, or merged runs of stripes, whose lists are merged at once: bounds the memory of a group, no result

LIST = "q_block long, chunk int, r_block long, slice int, q binary, r binary, part binary"
_NAMES = [c.split(" ")[0] for c in LIST.split(", ")]
_SCHEMA = pa.schema([("q_block", pa.int64()), ("chunk", pa.int32()), ("r_block", pa.int64()), ("slice", pa.int32()),
                     ("q", pa.binary()), ("r", pa.binary()), ("part", pa.binary())])
LOWEST = np.iinfo(np.int64).min


def _row(q_block: int, chunk: int, r_block: int, part_of: int, q: np.ndarray, r: np.ndarray, part: np.ndarray) -> dict:
    """One packed list of (query, row, value): query and row by their place in their blocks."""
    return dict(zip(_NAMES, (q_block, chunk, r_block, part_of, q.astype("<i4").tobytes(), r.astype("<i4").tobytes(),
                             part.astype("<i8").tobytes())))


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["q"], "<i4"), np.frombuffer(row["r"], "<i4"), np.frombuffer(row["part"], "<i8")


def _table(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, _SCHEMA)


def _best(q: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Indices of each query's ``k`` best scores (ties to the smaller ``tie``), by query and rank."""
    order = np.lexsort((tie, -score, q))
    sorted_q = q[order]
    start = np.searchsorted(sorted_q, sorted_q, side="left")
    return order[np.arange(len(order)) - start < k]


def _kth(q: np.ndarray, score: np.ndarray, k: int, n: int, offset: int = 0) -> np.ndarray:
    """Each query's k-th best score (queries ``offset`` to ``offset + n - 1``); the lowest number if it has fewer."""
    out = np.full(n, LOWEST)
    best = _best(q, score, np.zeros(len(q), np.int8), k)
    of, at, size = np.unique(q[best], return_index=True, return_counts=True)
    full = size == k
    out[of[full] - offset] = score[best][at[full] + k - 1]
    return out


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the sums of their values and how often each came."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    times = np.diff(np.append(head, len(keys)))
    return keys[head], (np.add.reduceat(values, head) if len(head) else values), times


class Search:
    """The three phases over stored query blocks and stripes."""

    def __init__(self, spark: SparkSession, queries: V.Blocks, rows: V.Blocks, shape: V.Shape, k: int, slices: int):
        self.spark, self.queries, self.rows = spark, queries, rows
        self.shape, self.k, self.slices = shape, k, slices

    def tiles(self):
        return V.tiles(self.queries, self.rows, self.slices)

    def lists(self) -> DataFrame:
        """Phase 1: the k best entries of each query in each slice and stripe."""
        shape, k = self.shape, self.k

        def run(key: tuple, t: pa.Table) -> pa.Table:
            out = []
            for row in t.to_pylist():
                queries = shape.matrix(row["q_data"], row["q_n"])
                stripe = shape.matrix(row["r_data"], row["r_n"])
                most = min(k, len(stripe))
                for a in range(0, len(queries), CHUNK):
                    part = queries[a:a + CHUNK] @ stripe.T
                    at = np.argpartition(-part, most - 1, axis=1)[:, :most] if most < len(stripe) else (
                        np.broadcast_to(np.arange(most), part.shape))
                    q = np.repeat(np.arange(a, a + len(part)), most)
                    out.append(_row(row["q_block"], a // CHUNK, row["r_block"], row["slice"], q, at.ravel(),
                                    np.take_along_axis(part, at, 1).ravel()))
            return _table(out)

        return self.tiles().applyInArrow(run, LIST)

    def by_runs(self, lists: DataFrame, merge, schema: str) -> DataFrame:
        """``lists`` merged over ``FAN`` stripes, then over ``FAN`` such runs and so on, until at most ``FAN`` are left."""
        span = FAN
        while span < self.rows.count:
            run = F.expr(f"r_block div {span}").alias("run")
            lists, span = lists.groupBy("q_block", "chunk", run).applyInArrow(merge, schema), span * FAN
        return lists

    def named(self, lists: DataFrame) -> DataFrame:
        """The rows on the merged list of any slice, without repeats."""
        k = self.k

        def best_of(rows: list[dict]) -> dict[int, tuple[np.ndarray, ...]]:
            """By slice the stripe, query, row and value of each query's k best entries."""
            found = {}
            for part_of in sorted({r["slice"] for r in rows}):
                mine = [r for r in rows if r["slice"] == part_of]
                q, r, part = (np.concatenate(x) for x in zip(*map(_read, mine)))
                of = np.repeat(np.array([x["r_block"] for x in mine]), [len(x["q"]) // 4 for x in mine])
                best = _best(q, part, (of << 32) + r, k)
                found[part_of] = of[best], q[best], r[best], part[best]
            return found

        def merge(t: pa.Table) -> pa.Table:
            rows, out = t.to_pylist(), []
            for part_of, (of, q, r, part) in best_of(rows).items():
                for block in np.unique(of):
                    at = of == block
                    out.append(_row(rows[0]["q_block"], rows[0]["chunk"], int(block), part_of, q[at], r[at], part[at]))
            return _table(out)

        def run(t: pa.Table) -> pa.Table:
            rows = t.to_pylist()
            found = np.unique(np.concatenate([np.stack(x[:3], 1) for x in best_of(rows).values()]), axis=0)
            first = rows[0]
            out = []
            for block in np.unique(found[:, 0]):
                mine = found[found[:, 0] == block]
                out.append(_row(first["q_block"], first["chunk"], int(block), 0, mine[:, 1], mine[:, 2],
                                np.zeros(len(mine))))
            return _table(out)

        return self.by_runs(lists, merge, LIST).groupBy("q_block", "chunk").applyInArrow(run, LIST)

    def resolve(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (lists whose ``slice`` is the one to compute) with the partial scores added to ``part``."""
        shape = self.shape

        def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            if not right.num_rows:
                return _table([])
            row = left.to_pylist()[0]
            queries = shape.matrix(row["q_data"], row["q_n"])
            stripe = shape.matrix(row["r_data"], row["r_n"])
            out = []
            for i in range(right.num_rows):
                want = right.slice(i, 1).to_pylist()[0]
                q, r, part = _read(want)
                got = np.empty(len(q), np.int64)
                for a in range(0, len(q), 1 << 18):
                    b = slice(a, a + (1 << 18))
                    got[b] = np.einsum("ij,ij->i", queries[q[b]], stripe[r[b]])
                out.append(_row(*(want[c] for c in ("q_block", "chunk", "r_block", "slice")), q, r, part + got))
            return _table(out)

        return self.tiles().cogroup(wanted.groupBy(*V.PAIR)).applyInArrow(run, LIST)

    def cutoffs(self, named: DataFrame) -> DataFrame:
        """(q_block, chunk, first, score): each query's k-th best full score among the named rows."""
        k, slices = self.k, self.slices
        every = named.drop("slice").withColumn("slice", F.explode(F.array(*(F.lit(s) for s in range(slices)))))

        def run(t: pa.Table) -> pa.Table:
            rows = t.to_pylist()
            q, r, part = (np.concatenate(x) for x in zip(*map(_read, rows)))
            of = np.repeat(np.array([x["r_block"] for x in rows]), [len(x["q"]) // 4 for x in rows])
            first = rows[0]["chunk"] * CHUNK
            order = np.lexsort((r, of, q))
            same = np.stack([q, of, r], 1)[order]
            head = np.flatnonzero(np.append(True, (same[1:] != same[:-1]).any(1)))
            total = np.add.reduceat(part[order], head)
            kth = _kth(same[head, 0], total, k, int(q.max()) + 1 - first, first)
            return pa.table({"q_block": pa.array([rows[0]["q_block"]], pa.int64()),
                             "chunk": pa.array([rows[0]["chunk"]], pa.int32()),
                             "score": pa.array([kth.astype("<i8").tobytes()], pa.binary())})

        return (self.resolve(every.select(*_NAMES)).groupBy("q_block", "chunk")
                .applyInArrow(run, "q_block long, chunk int, score binary"))

    def entries(self, cutoffs: DataFrame) -> DataFrame:
        """Phase 2: every entry at or above the uniform cutoff."""
        shape, slices = self.shape, self.slices

        def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            out = []
            scores = {r["chunk"]: np.frombuffer(r["score"], "<i8") for r in right.to_pylist()}
            for row in left.to_pylist():
                queries = shape.matrix(row["q_data"], row["q_n"])
                stripe = shape.matrix(row["r_data"], row["r_n"])
                for chunk, score in scores.items():
                    a = chunk * CHUNK
                    part = queries[a:a + CHUNK] @ stripe.T
                    q, r = np.nonzero(part >= uniform(score, slices).astype(part.dtype)[:, None])
                    out.append(_row(row["q_block"], chunk, row["r_block"], row["slice"], q + a, r, part[q, r]))
            return _table(out)

        sent = V.beside(cutoffs, "r_block", self.rows.count)
        sent = sent.withColumn("slice", F.explode(F.array(*(F.lit(s) for s in range(slices)))))
        return self.tiles().cogroup(sent.groupBy(*V.PAIR)).applyInArrow(run, LIST)

    def candidates(self, entries: DataFrame, cutoffs: DataFrame) -> DataFrame:
        """The rows that can still be among the k best: the known parts (``slice`` -1) and a request for each missing one."""
        k, slices = self.k, self.slices

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            rows = left.to_pylist()
            if not rows:
                return _table([])
            first, wide = rows[0], np.int64(1) << 32
            lists = [_read(x) for x in rows]
            keys = np.concatenate([q * wide + r for q, r, _ in lists])
            mask = np.repeat([1 << x["slice"] for x in rows], [len(q) for q, _, _ in lists])
            known, total, times = _sums(keys, np.concatenate([p for _, _, p in lists]))
            _, seen, _ = _sums(keys, mask)
            q = known // wide
            reach = np.full(int(q.max(initial=-1)) + 1, LOWEST)
            for x in right.to_pylist():
                score, a = np.frombuffer(x["score"], "<i8"), x["chunk"] * CHUNK
                m = max(0, min(len(score), len(reach) - a))
                reach[a:a + m] = score[:m]
            whole = times == slices
            best = np.maximum(reach, _kth(q[whole], total[whole], k, len(reach)))
            # a missing part lies below the cutoff
            most = total + (slices - times) * (uniform(reach, slices)[q] - 1)
            stays = whole | (reach[q] == LOWEST) | (most >= best[q])
            known, total, seen, whole, q = known[stays], total[stays], seen[stays], whole[stays], q[stays]
            r = known % wide
            out = [_row(first["q_block"], first["chunk"], first["r_block"], -1, q, r, total)]
            for part_of in range(slices):
                lacks = (seen >> part_of & 1) == 0
                if lacks.any():
                    out.append(_row(first["q_block"], first["chunk"], first["r_block"], part_of, q[lacks], r[lacks],
                                    np.zeros(int(lacks.sum()))))
            return _table(out)

        pair = ["q_block", "r_block", "chunk"]
        sent = V.beside(cutoffs, "r_block", self.rows.count)
        return entries.groupBy(*pair).cogroup(sent.groupBy(*pair)).applyInArrow(run, LIST)

    def answer(self, candidates: DataFrame) -> DataFrame:
        """Phase 3: (query, rank, object, score) of the k best objects of each query, by their numbers."""
        k = self.k
        parts = candidates.filter("slice = -1").unionByName(self.resolve(candidates.filter("slice >= 0")))
        names = self.rows.df.filter("slice = 0").select(F.col("block").alias("r_block"), "ids", "labels")
        names = V.beside(names, "q_block", self.queries.count)

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out, objects = [], []
            wide = np.int64(1) << 32
            for chunk in pc.unique(left.column("chunk")).to_pylist():  # one chunk's entries at a time
                rows = left.filter(pc.equal(left.column("chunk"), chunk)).to_pylist()
                lists = [_read(x) for x in rows]
                known, total, _ = _sums(np.concatenate([q * wide + r for q, r, _ in lists]),
                                        np.concatenate([p for _, _, p in lists]))
                tie = np.frombuffer(right.column("labels")[0].as_py(), "<i8")
                number = np.frombuffer(right.column("ids")[0].as_py(), "<i8")
                best = _best(known // wide, total, tie[known % wide], k)
                r = known[best] % wide
                out.append(_row(rows[0]["q_block"], chunk, rows[0]["r_block"], 0, known[best] // wide, r, total[best]))
                objects.append(np.stack([number[r], tie[r]]).astype("<i8").tobytes())
            return _table(out).append_column("object", pa.array(objects, pa.binary()))

        def best_of(rows: list[dict]) -> tuple[np.ndarray, ...]:
            """The query, row, score and object (number, tie) of each query's k best entries."""
            q, r, score = (np.concatenate(x) for x in zip(*map(_read, rows)))
            objects = np.concatenate([np.frombuffer(x["object"], "<i8").reshape(2, -1) for x in rows], 1)
            best = _best(q, score, objects[1], k)
            return q[best], r[best], score[best], objects[:, best]

        def shorten(t: pa.Table) -> pa.Table:
            rows = t.to_pylist()
            *entries, objects = best_of(rows)
            first = rows[0]
            out = [_row(first["q_block"], first["chunk"], min(x["r_block"] for x in rows), 0, *entries)]
            return _table(out).append_column("object", pa.array([objects.tobytes()], pa.binary()))

        pair = ["q_block", "r_block"]
        local = parts.groupBy(*pair).cogroup(names.groupBy(*pair)).applyInArrow(run, LIST + ", object binary")
        local = self.by_runs(local, shorten, LIST + ", object binary")
        queries = self.queries.df.filter("slice = 0").select(
            F.col("block").alias("q_block"), F.col("ids").alias("q_ids"),
            F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {CHUNK}").cast("int"))).alias("chunk"))

        def merge(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return ANSWER.empty_table()
            rows = left.to_pylist()
            q, _, score, (number, _) = best_of(rows)
            ids = np.frombuffer(right.column("q_ids")[0].as_py(), "<i8")
            return pa.table([ids[q], number, score], schema=ANSWER)

        return (local.groupBy("q_block", "chunk").cogroup(queries.groupBy("q_block", "chunk"))
                .applyInArrow(merge, "query long, object long, score long"))


ANSWER = pa.schema([("query", pa.int64()), ("object", pa.int64()), ("score", pa.int64())])


def uniform(score: np.ndarray, slices: int) -> np.ndarray:
    """The smallest partial score that one slice at least must have for a total of ``score``."""
    return np.where(score == LOWEST, LOWEST, -(-score // slices))


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = K, slices: int = SLICES,
          query_rows: int = QUERY_ROWS, stripe_rows: int = STRIPE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other rows of each query row.

    ``vectors`` has ``vec_id`` and the integer components ``z``; ``is_query`` tells the query rows."""
    shape = V.Shape.of(vectors)
    slices = min(slices, shape.width)
    rows = vectors.select("vec_id", F.col("z").cast(f"array<{shape.kind}>").alias("z")).distinct()
    rank = F.row_number().over(Window.partitionBy("z").orderBy("vec_id"))
    objects = (rows.withColumn("r", rank).filter(F.col("r") <= k + 1)
               .groupBy("z").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
               .select(F.monotonically_increasing_id().alias("object"), "z", "ids"))
    objects = B.store(spark, objects, "objects", free=False)
    asked = B.store(spark, rows.filter(is_query).join(objects.select("object", "z"), "z")
                    .select(F.col("vec_id").alias("query_id"), F.col("object").alias("query")), "asked", free=False)

    named = objects.select(F.col("object").alias("vec_id"), F.col("ids")[0].alias("label"), "z")
    sought = named.join(asked.select("query").distinct(), F.col("vec_id") == F.col("query"), "left_semi")
    stripes = V.blocks(spark, named, shape, objects.count(), stripe_rows, "stripes", slices)
    queries = V.blocks(spark, sought, shape, sought.count(), query_rows, "queries", slices)

    search = Search(spark, queries, stripes, shape, k + 1, slices)
    cutoffs = B.store(spark, search.cutoffs(search.named(search.lists())), "cutoffs", free=False)
    held = B.store(spark, search.candidates(search.entries(cutoffs), cutoffs), "candidates", free=False)
    found = search.answer(held)

    # objects to rows: the k + 1 best objects name the k best rows, the query's own left out
    member = F.explode(F.transform("ids", lambda i: F.struct((-F.col("score")).alias("down"), i.alias("vec_id"),
                                                             F.col("object").alias("object"))))
    listed = (found.join(objects.select("object", "ids"), "object").select("query", member.alias("m"))
              .groupBy("query").agg(F.slice(F.sort_array(F.collect_list("m")), 1, k + 1).alias("best")))
    others = F.slice(F.filter("best", lambda m: (m["vec_id"] != F.col("query_id")) | (m["object"] != F.col("query"))), 1, k)
    return (asked.join(listed, "query").select("query_id", F.posexplode(others).alias("pos", "m"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("m.vec_id").alias("vec_id"),
                    (-F.col("m.down")).alias("score")))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = V.integer_vectors(B.table(spark, sf_dir, "embeddings"), SCALE)
    return top_k(spark, vectors, F.col("vec_id") % QUERY_STEP == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT vec_id, unnest(z) AS x, generate_subscripts(z, 1) AS d FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM u q JOIN u c ON q.d = c.d
  WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
  GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
