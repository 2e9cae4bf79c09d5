"""Integer vectors as stored blocks, and the pairing of query blocks with row stripes.

``integer_vectors`` scales and floors the components.  ``blocks`` deals the rows evenly (round
robin, so no key can be hot) into blocks of bounded size, written once to the shared folder.
``tiles`` pairs every block of a stated query set with every block of rows (a stripe) by an
equi-join on the pair's own numbers: each pair is a key of its own, so the work spreads over
all tasks.

Arithmetic is that of 64-bit integers.  Where the largest squared length proves that every sum
is an integer below 2**24 (or 2**53), the same sums are taken in 32-bit (or 64-bit) floating
point, which is exact there; beyond that in integers, whose components saturate and whose sums
wrap around at 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from racelake.llm._blocks import shuffle_partitions, store

BLOCK = "block long, n int, ids binary, labels binary, data binary"


def integer_vectors(df: DataFrame, scale: int, id_col: str = "vec_id", vec_col: str = "embedding",
                    label: Column | None = None) -> DataFrame:
    """(vec_id, label, z): z holds floor(scale * component).

    Rows with a null id, a null vector or a null or non-finite component are left out, and with
    ``label`` given those whose label is null."""
    x = F.col(vec_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.filter(F.col(id_col).isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)))
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"),
                      (F.lit(0) if label is None else label).cast("long").alias("label"),
                      F.transform(x, lambda v: F.floor(v * scale)).alias("z"))
    return out if label is None else out.filter("label is not null")


@dataclass(frozen=True)
class Shape:
    """What the blocks of a table share: rows, width, dtype stored and dtype summed in."""

    rows: int
    width: int
    stored: str
    summed: str

    @classmethod
    def of(cls, vectors: DataFrame) -> Shape:
        square = F.aggregate("z", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
        n, width, norm, most = vectors.agg(
            F.count(F.lit(1)), F.max(F.size("z")), F.max(square),
            F.max(F.array_max(F.transform("z", lambda v: F.abs(v.cast("double")))))).first()
        norm, most = norm or 0.0, most or 0.0
        stored = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
        return cls(n, max(1, width or 0), stored, "<f4" if norm < 1 << 24 else "<f8" if norm < 1 << 53 else "<i8")

    @property
    def kind(self) -> str:
        """The SQL type that holds a stored component."""
        return {"<i2": "short", "<i4": "int", "<i8": "long"}[self.stored]

    def matrix(self, data: bytes, n: int) -> np.ndarray:
        """Rows by components of a stored block, in the dtype that sums are taken in."""
        return np.frombuffer(data, self.stored).reshape(n, -1).astype(self.summed)


@dataclass(frozen=True)
class Blocks:
    """Stored blocks, numbered from 0 to ``count`` - 1 (a number without rows has no block)."""

    df: DataFrame
    count: int


def blocks(spark: SparkSession, vectors: DataFrame, shape: Shape, n: int, rows: int, name: str,
           slices: int = 1) -> Blocks:
    """The ``n`` rows of ``vectors`` in stored blocks of about ``rows`` rows, one row per (block, slice).

    A slice is a run of consecutive components; shorter vectors are continued by zeros."""
    cuts = np.array_split(np.arange(shape.width), slices)
    count = max(1, -(-n // rows))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, parts = [], [], []
        for batch in batches:
            z = batch.column("z")
            size = np.diff(z.offsets.to_numpy())
            m = np.zeros((batch.num_rows, shape.width), shape.stored)
            m[np.arange(shape.width) < size[:, None]] = z.flatten().to_numpy(zero_copy_only=False)
            ids.append(batch.column("vec_id").to_numpy(zero_copy_only=False))
            labels.append(batch.column("label").to_numpy(zero_copy_only=False))
            parts.append(m)
        if sum(map(len, ids)):
            i, lab, m = np.concatenate(ids), np.concatenate(labels), np.concatenate(parts)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([TaskContext.get().partitionId()] * slices, pa.int64()),
                "n": pa.array([len(i)] * slices, pa.int32()),
                "ids": [i.tobytes()] * slices, "labels": [lab.tobytes()] * slices,
                "data": pa.array([np.ascontiguousarray(m[:, c]).tobytes() for c in cuts], pa.binary()),
                "slice": pa.array(range(slices), pa.int32())})

    dealt = vectors.select("vec_id", "label", "z").repartition(count)
    return Blocks(store(spark, dealt.mapInArrow(pack, BLOCK + ", slice int"), name, free=False), count)


PAIR = ["q_block", "r_block", "slice"]


def tiles(queries: Blocks, rows: Blocks, slices: int = 1) -> GroupedData:
    """Every query block beside every stripe, slice by slice, grouped by ``PAIR`` (one row a group):
    columns ``q_*`` of the query block and ``r_*`` of the stripe."""
    spark = queries.df.sparkSession
    # so many partitions that the pairs spread, whatever their size in bytes
    parts = max(shuffle_partitions(spark), min(4096, queries.count * rows.count * slices))
    prefixed = lambda df, p: df.select(*(F.col(c).alias(c if c == "slice" else p + c) for c in df.columns))
    q = beside(prefixed(queries.df, "q_"), "r_block", rows.count).repartition(parts, *PAIR)
    r = beside(prefixed(rows.df, "r_"), "q_block", queries.count).repartition(parts, *PAIR)
    return q.join(r, PAIR).groupBy(*PAIR)


def beside(df: DataFrame, name: str, count: int) -> DataFrame:
    """``df`` once for each block number 0 to ``count`` - 1, in column ``name``."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))
