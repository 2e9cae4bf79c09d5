"""Fill-in-middle transformation by in-place block rotation.

A document's two cuts are found by scanning its UTF-8 bytes for token ends (the units are
delimited by ASCII white space, so bytes and code points agree).  The sentinels are inserted at
the cuts of a bytearray, which then holds the blocks prefix, middle and suffix, each behind its
sentinel; the form's order comes from one exchange of two neighbouring segments, done in place
by three reversals (each segment, then both together).  ``restore`` finds the sentinels, rotates
back and deletes them, which rebuilds the text from output and form alone.  A plain text is
never changed; texts that contain a sentinel are plain, so the three found are the ones inserted.

Each document is a row of its own: no shuffle, and a lost executor repeats a task.

Cases: a null text is an empty one (plain); a text of white space is one unit; a text of any
length is read whole; a null ``doc_id`` is hashed as empty decimals and stays null; repeated rows
give one row each; an empty table gives an empty result; columns besides ``doc_id`` and ``text``
pass through ``fim`` untouched, but for ``n``, ``form``, ``output``, ``prefix_chars`` and
``middle_chars`` (and ``restored`` of ``restore``), whose columns of the same name are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from racelake.llm import _blocks as B

SEED = 42
PLAIN_PERCENT = 50  # of all documents
SPM_PERCENT = 80    # of the others
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The order in which a form's sentinels stand.
ORDERS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
_UNIT = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")

ADDED = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                   ("middle_chars", pa.int64()), ("output", pa.binary())])
RESTORED = pa.schema([("restored", pa.binary())])
RUN_BYTES = 1 << 22


def _reverse(v: np.ndarray) -> None:
    """Reverse in place."""
    half = len(v) // 2
    head = v[:half].copy()
    v[:half] = v[len(v) - half:][::-1]
    v[len(v) - half:] = head[::-1]


def rotate(buf: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange the segments ``buf[start:cut]`` and ``buf[cut:end]`` in place by three reversals."""
    v = np.frombuffer(buf, np.uint8)
    _reverse(v[start:cut])
    _reverse(v[cut:end])
    _reverse(v[start:end])


def chars(data: bytes | bytearray) -> int:
    """Code points of UTF-8 bytes."""
    return len(data) - int(np.count_nonzero(B.CONTINUES[np.frombuffer(data, np.uint8)]))


def choose(doc_id: int | None, seed: int) -> list[int]:
    """Four 32-bit numbers of a document."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]


def transform(doc_id: int | None, text: bytes, seed: int = SEED
              ) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of prefix and of middle, output) of one text."""
    ends = [m.end() for m in _UNIT.finditer(text)]
    h1, h2, h3, h4 = choose(doc_id, seed)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= PLAIN_PERCENT:
        return len(ends), "plain", None, None, text
    cuts = [0, *ends]
    a, b = sorted((cuts[h1 % len(cuts)], cuts[h2 % len(cuts)]))
    prefix_chars, middle_chars = chars(text[:a]), chars(text[a:b])
    buf = bytearray(text)
    for at, sentinel in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):  # from the back, so cuts stay valid
        buf[at:at] = sentinel
    middle, suffix = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)
    form = "spm" if h4 % 100 < SPM_PERCENT else "psm"
    rotate(buf, 0 if form == "spm" else middle, suffix, len(buf))
    return len(ends), form, prefix_chars, middle_chars, bytes(buf)


def invert(output: bytes, form: str) -> bytes:
    """The text behind an output."""
    if form == "plain":
        return output
    buf = bytearray(output)
    if form == "spm":  # suffix | prefix, middle
        start, cut = 0, output.index(PREFIX)
    else:              # suffix | middle, behind the prefix
        start, cut = output.index(SUFFIX), output.index(MIDDLE)
    rotate(buf, start, cut, len(buf))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buf.rindex(sentinel)
        del buf[at:at + len(sentinel)]
    return bytes(buf)


def _append(df: DataFrame, read: list[Column], added: pa.Schema, make: Callable[..., tuple]) -> DataFrame:
    """``df`` with the columns ``added`` that ``make`` gives for each row's ``read`` values; rows leave
    in runs of about ``RUN_BYTES``."""
    plain = [f"c{k}" for k in range(len(df.columns))]  # Arrow stages take no names with dots
    rows = df.select(*[F.col(f"`{c}`").alias(p) for c, p in zip(df.columns, plain)],
                     *[c.alias(f"read{k}") for k, c in enumerate(read)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns[len(plain):]
            first, held, rows = 0, 0, []
            for k in range(batch.num_rows):
                rows.append(make(*(c[k].as_py() for c in columns)))
                held += len(rows[-1][-1])
                if held >= RUN_BYTES or k + 1 == batch.num_rows:
                    new = [pa.array(v, f.type) for v, f in zip(zip(*rows), added)]
                    passed = batch.slice(first, len(rows)).columns[:len(plain)]
                    yield pa.RecordBatch.from_arrays([*passed, *new], names=[*plain, *added.names])
                    first, held, rows = k + 1, 0, []

    schema = T.StructType([*(T.StructField(p, f.dataType, True) for p, f in zip(plain, df.schema.fields)),
                           *(T.StructField(f.name, from_arrow_type(f.type)) for f in added)])
    return rows.mapInArrow(run, schema).toDF(*df.columns, *added.names)


def fim(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with the units, form and output (UTF-8 bytes) of each text."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", *ADDED.names)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[F.col(f"`{c}`") for c in rest])
    utf8 = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return _append(rows, [F.col("doc_id"), utf8], ADDED, lambda i, t: transform(i, t, seed))


def restore(outputs: DataFrame) -> DataFrame:
    """``outputs`` with ``restored``: the exact UTF-8 bytes behind each ``output`` and ``form``."""
    rows = outputs.drop("restored")
    return _append(rows, [F.col("output"), F.col("form")], RESTORED, lambda out, form: (invert(out, form),))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = restore(fim(B.id_text(B.table(spark, sf_dir, "documents"))).drop("text"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
  FROM documents),
h AS (
  SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || substr(hex, 1, 8) AS BIGINT) % (len(units) + 1) AS c1,
         CAST('0x' || substr(hex, 9, 8) AS BIGINT) % (len(units) + 1) AS c2,
         CAST('0x' || substr(hex, 17, 8) AS BIGINT) % 100 AS v3,
         CAST('0x' || substr(hex, 25, 8) AS BIGINT) % 100 AS v4
  FROM d),
p AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR v3 >= 50
              THEN 'plain' WHEN v4 < 80 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1:least(c1, c2)], '') AS pre,
         array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
         array_to_string(units[greatest(c1, c2) + 1:], '') AS suf
  FROM h)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(coalesce(pre, '')) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(coalesce(mid, '')) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || coalesce(pre, '') || '<S>' || coalesce(suf, '') || '<M>' || coalesce(mid, '')
                        ELSE '<S>' || coalesce(suf, '') || '<P>' || coalesce(pre, '') || '<M>' || coalesce(mid, '') END
             ) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
