"""Packing: shortest-pack-first over the length histogram.

Documents are tokenised, cut at multiples of the sequence length, and the pieces are
packed.  Only the histogram of piece lengths (at most ``seq_len`` rows) reaches the
driver: lengths are placed longest first, each into the open packing pattern with the
shortest total that still has room, so the work depends on the number of distinct
lengths and patterns, never on the number of documents.  A pattern is a list of lengths
with a count; the pieces of one length take the pattern's places in order of their rank.

Ranks are made without gathering a length in one task: pieces of a length are spread
over salt buckets, counted per (length, bucket), numbered inside the bucket and shifted
by the counts of the buckets before it.

Cases: null or empty text is one piece holding the end id alone; a text of any length is
cut and no id is lost; repeated rows are packed once each; a null ``doc_id`` is kept; an
empty table gives an empty result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelake.llm._blocks import id_bytes, id_text, shuffle_partitions, store, table

SEQ_LEN = 4096
END_ID = 2
CACHE_WORDS = 200_000  # distinct pieces remembered by a worker; a full cache is emptied, results stay the same
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


PLAIN = re.compile("[\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")  # here every step below is certain
# The tokenizer's own split, for lower-cased plain text.
SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]"
                   "|[^\x09-\x0d\x20a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordEncoder:
    """Ids of a text as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and merges inside the pieces of its split only, so each
    distinct piece is encoded once and a text is the join of its pieces' ids.  Words with
    characters outside ``PLAIN``, or that may hold a special token, go through the whole
    tokenizer.  A worker keeps its encoder from task to task.
    """

    shared: dict[str, WordEncoder] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls.shared:
            cls.shared[path] = cls(path)
        return cls.shared[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = dict(enumerate(_byte_letters()))
        self.known: dict[str, bytes] = {}  # plain pieces are lower case; " " begins any other word

    def _split(self, text: str) -> list[str]:
        if PLAIN.fullmatch(text) and "<|" not in text:
            return SPLIT.findall(text.lower())
        out = []
        for word in re.findall("[^\x09-\x0d\x20]+", text):
            out += SPLIT.findall(word.lower()) if PLAIN.fullmatch(word) and "<|" not in word else [" " + word]
        return out

    def _ids(self, piece: str) -> bytes:
        if piece[0] == " ":
            ids = self.tokenizer.encode(piece[1:], add_special_tokens=False).ids
        else:
            letters = piece if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(
                self.letters)
            ids = [t.id for t in self.tokenize(letters)]
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: bytes) -> bytes:
        parts = self._split(text.decode("utf-8", "replace"))
        new = set(parts).difference(self.known)
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known = {}
            new = set(parts)
        for piece in new:
            self.known[piece] = self._ids(piece)
        return b"".join(map(self.known.__getitem__, parts))


def pieces(docs: DataFrame, path: str, seq_len: int = SEQ_LEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece of at most ``seq_len`` ids, with the checksum of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.of(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for i, t in id_bytes(iter([batch])):
                ids = encoder.encode(t or b"") + end
                n = len(ids) // 4
                for s in range(0, n, seq_len):
                    part = ids[4 * s:4 * (s + seq_len)]
                    out.append((i, s, len(part) // 4, zlib.crc32(part), n))
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return id_text(docs).mapInArrow(run, PIECES)


def shortest_pack_first(histogram: dict[int, int], seq_len: int = SEQ_LEN) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns as (count, lengths), from a histogram of lengths."""
    room: dict[int, list[list]] = defaultdict(list)  # free ids -> [count, lengths]
    most = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while most >= length and not room.get(most):
                most -= 1
            if most < length:  # nowhere to go: open packs of this length
                room[seq_len - length].append([left, (length,)])
                most = max(most, seq_len - length)
                break
            count, lengths = room[most].pop()
            take = min(left, count)
            if count > take:
                room[most].append([count - take, lengths])
            room[most - length].append([take, (*lengths, length)])
            left -= take
    return [(c, p) for free in sorted(room) for c, p in room[free]]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset): the places of each pattern."""
    rank: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for n in lengths:
            rows.append((n, rank[n], sequence, offset))
            rank[n] += count
            offset += n
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(spark: SparkSession, docs: DataFrame, seq_len: int = SEQ_LEN, end_id: int = END_ID,
         path: str | None = None) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``."""
    cut = store(spark, pieces(docs, path or tokenizer_path(), seq_len, end_id), "pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most seq_len rows
    places = slots(shortest_pack_first(histogram, seq_len))
    wide = 1 << 40  # ranks of one length lie below this
    keys = places[:, 0] * wide + places[:, 1]

    salts = shuffle_partitions(spark)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = (salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
             .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "start")
    ranked = (salted.withColumn("r", F.row_number().over(inside) - 1)
              .join(shift, ["length", "salt"])
              .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                      (F.col("r") + F.col("shift")).alias("rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.column("length").to_numpy() * wide + b.column("rank").to_numpy()
            k = np.searchsorted(keys, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(places[k, 2] + at - keys[k], pa.int64()), pa.array(places[k, 3], pa.int64())],
                names=[*PIECES.replace(" long", "").split(", "), "sequence_id", "offset"])

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"))
