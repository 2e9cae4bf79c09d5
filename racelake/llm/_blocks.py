"""Documents as blocks, and the exchange of packed keys between blocks and buckets.

A *block* is one row holding about ``BLOCK_BYTES`` of whole texts (a longer text is a
block of its own): the ids, the lengths and the concatenated UTF-8 bytes, compressed.
Blocks are written once to the shared folder, so their content never depends on task
timing and a lost executor only repeats a task.

Corpus-wide questions ("does this key occur anywhere else?", "how often?") are asked
in bulk.  Each block sends its distinct keys, packed as numpy arrays, to buckets chosen
by the key (``groupBy("bucket").applyInArrow``); a bucket merges the arrays of all
blocks and answers each block with an array aligned to what it sent; the answers meet
the block again in a cogroup.  A key is sent once per block however often the block has
it, so the copies of a hot key are aggregated before the shuffle, and a bucket holds a
share of the *distinct* keys.  All merging is done by Spark's shuffles; numpy only
works on one block or one bucket at a time.

Null texts are empty texts.  A null id is carried as the largest 64-bit integer (it
counts as the largest id) and comes out as null again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.session import checkpoint_dir, delete, release

BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20  # text bytes per bucket: keeps a bucket's arrays small at any input size
NULL_ID = np.iinfo(np.int64).max
BLOCK_SCHEMA = "block long, n_bytes long, ids binary, lens binary, data binary"


def store(spark: SparkSession, df: DataFrame, name: str, free: bool = True) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage durably).

    ``free`` lets Spark delete the shuffle files behind it at once; small steps leave that to a later one."""
    path = f"{checkpoint_dir(spark)}/racelake-llm/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    del df
    if free:
        release(spark)
    return spark.read.schema(schema).parquet(path)


def drop(spark: SparkSession, df: DataFrame) -> None:
    """Delete a stored intermediate table that no later step reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
        delete(spark, folder)


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a side of a sort-merge join: never broadcast, as its rows grow with the data.

    Spark judges a stored table by the bytes of its files; on the driver its rows take many times that, and an exploded
    side many times more."""
    return df.hint("merge")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Block:
    """One decoded block: ``ids``, ``lens`` and ``data`` with a newline after each text."""

    def __init__(self, block: int, ids: bytes, lens: bytes, data: bytes):
        self.block = block
        self.ids = np.frombuffer(ids, np.int64)
        self.lens = np.frombuffer(lens, np.int64)
        size = int(self.lens.sum()) + len(self.lens)
        raw = pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True) if size else b""
        self.data = np.frombuffer(raw, np.uint8)
        self.ends = np.cumsum(self.lens + 1) - 1      # position of the closing newline
        self.starts = self.ends - self.lens

    @classmethod
    def of(cls, row: dict) -> Block:
        return cls(row["block"], row["ids"], row["lens"], row["data"])

    @classmethod
    def packed(cls, block: int, ids: list[int], texts: list[bytes]) -> dict:
        """The stored row of a block."""
        data = b"".join(t + b"\n" for t in texts)
        return {"block": block, "n_bytes": len(data), "ids": np.array(ids, np.int64).tobytes(),
                "lens": np.array([len(t) for t in texts], np.int64).tobytes(),
                "data": pa.compress(data, codec="zstd", asbytes=True)}

    def out_ids(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=self.ids == NULL_ID)


ROW = pa.schema([("block", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.binary()), ("lens", pa.binary()),
                 ("data", pa.binary())])


def id_bytes(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[tuple[int | None, bytes | None]]:
    """The rows of (doc_id, text) batches; only ``rows`` of a batch are Python objects at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            part = batch.slice(k, rows)
            yield from zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist())


def gather(batches: Iterator[pa.RecordBatch], block_bytes: int = BLOCK_BYTES
           ) -> Iterator[tuple[list[int], list[bytes]]]:
    """Ids and texts of (doc_id, text) batches, by blocks."""
    ids: list[int] = []
    texts: list[bytes] = []
    held = 0
    for i, t in id_bytes(batches):
        ids.append(NULL_ID if i is None else i)
        texts.append(t or b"")
        held += len(texts[-1]) + 1
        if held >= block_bytes:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def batched(batches: Iterator[pa.RecordBatch], block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks made inside a task, where no other task has to know them."""
    for ids, texts in gather(batches, block_bytes):
        yield Block.of(Block.packed(0, ids, texts))


def id_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def to_blocks(spark: SparkSession, docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The stored blocks of ``docs`` (columns ``doc_id`` and ``text``; others are not read)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for k, (ids, texts) in enumerate(gather(batches, block_bytes)):
            yield pa.RecordBatch.from_pylist([Block.packed(base + k, ids, texts)], schema=ROW)

    return store(spark, id_text(docs).mapInArrow(pack, BLOCK_SCHEMA), "blocks")


def n_buckets(spark: SparkSession, blocks: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """So many buckets that each gets the keys of about ``bucket_bytes`` of text."""
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    return max(shuffle_partitions(spark), -(-total // bucket_bytes))


# ------------------------------------------------------------------ numpy helpers

def _lut(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SPACE = _lut(b" \t\n\v\f\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUES = (np.arange(256) & 0xC0) == 0x80  # second and later bytes of a code point

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["p"]) < n:
        size = max(n, BLOCK_BYTES + (1 << 18))
        for name, base in (("p", _BASE), ("q", _BASE_INV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POWERS[name] = np.cumprod(a)
    return _POWERS["p"][:n], _POWERS["q"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial over ``values`` (uint64, modulo 2**64), from 0."""
    p, _ = _powers(len(values))
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * p, out=out[1:])
    return out


def span_hash(pre: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[starts:ends]`` from their prefix sums."""
    _, q = _powers(len(pre))
    return mix((pre[ends] - pre[starts]) * q[starts] + (ends - starts).astype(np.uint64) * _BASE)


def rolling(pre: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive values, by start."""
    m = len(pre) - n
    if m <= 0:
        return np.empty(0, np.uint64)
    _, q = _powers(len(pre))
    return mix((pre[n:] - pre[:m]) * q[:m] + np.uint64(n * int(_BASE) % (1 << 64)))


def bytes_prefix(data: np.ndarray) -> np.ndarray:
    return prefix(data.astype(np.uint64) + np.uint64(1))


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each word ``[^\\x20\\x09-\\x0D]+``."""
    gap = SPACE[data]
    edge = np.diff(gap.astype(np.int8), prepend=1, append=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def per_doc(positions: np.ndarray, block: Block) -> np.ndarray:
    """Index of the document that holds each byte position."""
    return np.searchsorted(block.ends, positions, side="left")


def groups(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the values that occur at least twice, sorted by value then index,
    and for each whether it opens its group.

    One sort of (top hash bits, index) finds the candidates; only those are compared in full.
    """
    n = len(h)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, bool)
    bits = np.uint64(max(1, n.bit_length()))
    key = (h >> bits << bits) | np.arange(n, dtype=np.uint64)
    key.sort()
    top = key >> bits
    same = top[1:] == top[:-1]
    hit = np.zeros(n, bool)
    hit[1:] = same
    hit[:-1] |= same
    at = np.sort((key[hit] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64))
    if not len(at):
        return at, np.empty(0, bool)
    at = at[np.argsort(h[at], kind="stable")]
    v = h[at]
    first = np.ones(len(v), bool)
    first[1:] = v[1:] != v[:-1]
    last = np.ones(len(v), bool)
    last[:-1] = first[1:]
    keep = ~(first & last)
    return at[keep], first[keep]


def distinct(sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return sorted_values
    keep = np.ones(len(sorted_values), bool)
    keep[1:] = sorted_values[1:] != sorted_values[:-1]
    return sorted_values[keep]


def bucket_edges(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of ``buckets`` equal ranges of the 64-bit hashes begins, and the end."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)
    return np.append(np.searchsorted(sorted_hashes, edges, side="left"), len(sorted_hashes))


def bits_of(keys: np.ndarray, got: dict[int, bytes], buckets: int) -> np.ndarray:
    """The bits answered for sorted distinct ``keys``."""
    edges = bucket_edges(keys, buckets)
    flag = np.zeros(len(keys), bool)
    for b in np.flatnonzero(np.diff(edges)):
        flag[edges[b]:edges[b + 1]] = np.unpackbits(np.frombuffer(got[int(b)], np.uint8),
                                                    count=edges[b + 1] - edges[b])
    return flag


def slide_max(flags: np.ndarray, n: int) -> np.ndarray:
    """Whether any of ``flags[i - n + 1 : i + 1]`` is set: positions covered by flagged
    windows of ``n`` (``flags`` by window start, the result as long as ``flags``)."""
    c = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    i = np.arange(len(flags))
    return c[i + 1] > c[np.maximum(i + 1 - n, 0)]


def lowest(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` hashes the index of the smallest (by their top bits, the
    first one at a tie)."""
    bits = np.uint64(max(1, len(h).bit_length()))
    low = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    have = 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[:len(low) - (width - have)], low[width - have:])
    return (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def gather_spans(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The concatenated slices of ``data``."""
    skip = np.cumsum(length) - length
    return data[np.repeat(begin - skip, length) + np.arange(int(length.sum()))]


# ------------------------------------------------------------------ the exchange

SENT = "bucket int, block long, keys binary, counts binary"
ANSWER = "block long, bucket int, answer binary"


def send(blocks: DataFrame, make: Callable[[Block], Iterator[tuple[int, bytes, bytes | None]]]) -> DataFrame:
    """One row per (block, bucket): what ``make`` gives for the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = list(make(Block.of(row)))
                if out:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([o[0] for o in out], pa.int32()), pa.array([row["block"]] * len(out), pa.int64()),
                        pa.array([o[1] for o in out], pa.binary()), pa.array([o[2] for o in out], pa.binary()),
                    ], names=["bucket", "block", "keys", "counts"])

    return blocks.mapInArrow(run, SENT)


def answer(sent: DataFrame, merge: Callable[[list[bytes], list[bytes | None]], list[bytes]]) -> DataFrame:
    """Merge each bucket over all blocks; ``merge`` gives one answer per sent row."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        out = merge(t.column("keys").to_pylist(), t.column("counts").to_pylist())
        return pa.table([t.column("block"), t.column("bucket"), pa.array(out, pa.binary())],
                        names=["block", "bucket", "answer"])

    return sent.groupBy("bucket").applyInArrow(run, ANSWER)


def meet(blocks: DataFrame, answers: DataFrame,
         make: Callable[[Block, dict[int, bytes]], pa.Table | list[pa.Table]], schema: str) -> DataFrame:
    """Bring the answers back to their blocks."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = dict(zip(right.column("bucket").to_pylist(), right.column("answer").to_pylist()))
        return pa.concat_tables([make(Block.of(row), got) for row in left.to_pylist()])

    return (blocks.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(run, schema))


def merge_shared(keys: list[bytes], counts: list[bytes]) -> list[bytes]:
    """Per sent key a bit: more than one block has it, or one block says so itself."""
    k = np.concatenate([np.frombuffer(x, "<u4") for x in keys]).astype(np.uint64)
    many = np.concatenate([np.unpackbits(np.frombuffer(c, np.uint8), count=len(x) // 4)
                           for x, c in zip(keys, counts)]).astype(np.int64)
    key = (k << np.uint64(32)) | np.arange(len(k), dtype=np.uint64)
    key.sort()
    at = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fp = key >> np.uint64(32)
    new = np.ones(len(fp), bool)
    new[1:] = fp[1:] != fp[:-1]
    heads = np.flatnonzero(new)
    size = np.diff(np.append(heads, len(fp)))
    flag = (size > 1) | (np.add.reduceat(many[at], heads) > 0)
    out = np.empty(len(k), bool)
    out[at] = np.repeat(flag, size)
    ends = np.cumsum([0] + [len(x) // 4 for x in keys])
    return [np.packbits(out[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
