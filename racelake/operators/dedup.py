"""Duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_results(df: DataFrame, cols) -> DataFrame:
    """Drop rows repeating the given columns.

    When every other column is a function of ``cols`` (true for the silver
    table, whose derived columns all come from the deduplicated source
    columns) the surviving row is fully determined.  Batch: a hash aggregate
    with map-side partial dedup.  Stream: a state store keyed by ``cols``.
    """
    return df.dropDuplicates(list(cols))


def one_row_per_key(df: DataFrame, key: str, order_by, descending=()) -> DataFrame:
    """Keep, for every key, the row that sorts first by ``order_by``.

    ``order_by`` lists columns compared in turn; names in ``descending`` sort
    high-to-low and must be numeric or date, ascending ones may be of any orderable type.

    Where the first column is a number or a date, its best value per key comes from a hash
    aggregate (Spark sorts for buffers of text or structs), and only the rows holding that
    value are compared in full.  The comparison is a grouped ``min_by`` over a struct (no
    window): one candidate per key and task goes through the shuffle, so a key holding a
    third of all rows still ships one row per map task.  NULLs in the first column lose.
    """
    kinds = dict(df.dtypes)
    values = [c for c in df.columns if c != key]
    first = order_by[0]
    if kinds[first] in ("date", "int", "bigint", "double"):
        best = F.max(first) if first in descending else F.min(first)
        best = df.groupBy(F.col(key).alias("__key")).agg(best.alias("__best"))
        same = df[key].eqNullSafe(F.col("__key")) & df[first].eqNullSafe(F.col("__best"))
        df = df.join(best, same, "left_semi")
    order_terms = []
    for c in order_by:
        col = F.col(c)
        if c in descending:
            col = F.unix_date(col) if kinds[c] == "date" else col
            col = -col
        order_terms.append(col.alias(f"k{len(order_terms)}"))
    picked = F.min_by(F.struct(*[F.col(c) for c in values]), F.struct(*order_terms))
    return df.groupBy(key).agg(picked.alias("__row")).select(key, *[f"__row.{c}" for c in values])
