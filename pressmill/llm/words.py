"""Words of whole Arrow batches as numpy arrays.

Texts reach Python as UTF-8 bytes. One table look-up per byte lower-cases A-Z and blanks separators, so that a
word is a run of bytes other than blank; bytes of non-ASCII characters are never separators.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANK = 32
#: bytes of text worked on at once: what numpy holds for them is some fifty times as much
SLAB_BYTES = 512 << 10


def _table(is_word) -> np.ndarray:
    codes = np.arange(256)
    lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    return np.where([is_word(c) for c in lower], lower, BLANK).astype(np.uint8)


#: words of letters and digits: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = _table(lambda c: 48 <= c <= 57 or 97 <= c <= 122 or c >= 128)
#: words between ASCII white space: [^\x20\x09-\x0D]+ after lower-casing A-Z
SPACED = _table(lambda c: c != 32 and not 9 <= c <= 13)


#: bytes of rows that go to Python, or come from it, at once
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches bounded by bytes and rows, for long texts: a worker holds a few batches at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def quoted(name: str) -> str:
    """A column name as a reference, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(docs: DataFrame, *without: str) -> Column:
    """All columns as one struct."""
    return F.struct(*[F.col(quoted(c)) for c in docs.columns if c not in without] or [F.lit(1).alias("_")])


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, or one like it that no column has."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def schema(*fields: tuple[str, T.DataType | str]) -> T.StructType:
    """A schema of types as they are, so that odd names of nested columns need no parsing."""
    out = T.StructType()
    for name, kind in fields:
        out = out.add(name, kind)
    return out


def utf8(column: str) -> Column:
    """The bytes of a text column, null as empty: what the functions here read."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary Arrow column and the n + 1 bounds of its values, without a copy."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if offsets is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in runs of a few rows, so that Python holds few copies of texts at once."""
    for low in range(0, batch.num_rows, rows):
        yield batch.slice(low, rows)


def slabs(column: pa.Array, size: int = SLAB_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) of runs of whole values of about ``size`` bytes; one longer value is its own run."""
    data, bounds = bytes_of(column)
    low, n = 0, len(bounds) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + size, "right")) - 1)
        yield low, high, data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low]
        low = high


def split_words(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes after the table, word starts, word ends, for each value the number of its first word, n + 1 of them)."""
    body = table[data]
    word = body != BLANK
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(word))]
    begins[inner] = word[inner]  # values that touch are not one word
    ends[inner - 1] = word[inner - 1]
    starts = np.flatnonzero(begins)
    return body, starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, bounds)


_BYTE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLAB_BYTES) + 1, base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.cumprod(have, dtype=np.uint64)
    return have


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_words(body: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word, the same for equal words in any batch: differences of one running polynomial sum."""
    n = len(body)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[body] * _power(_BASE, n)[:n], out=total[1:])
    return mixed((total[ends] - total[starts]) * _power(_INVERSE, n)[starts])


def hashed(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, for each value the number of its first word)."""
    body, starts, ends, first = split_words(data, bounds, table)
    return hash_words(body, starts, ends), first


def hash_texts(texts: list[str], table: np.ndarray) -> list[np.ndarray]:
    """Word hashes of a few texts."""
    column = pa.array([t.encode("utf-8", "replace") for t in texts], pa.large_binary())
    h, first = hashed(*bytes_of(column), table)
    return [h[a:b] for a, b in zip(first[:-1], first[1:])]


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column of flat values and n + 1 bounds."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def list_of(column: pa.Array, row: int) -> np.ndarray:
    """Row ``row`` of a list column of numbers."""
    return column.slice(row, 1).flatten().to_numpy(zero_copy_only=False)
