"""Helpers shared by the training-data operators: plumbing, byte-level words, vectorised hashing.

Conventions of every operator in this subpackage:

* input columns are named by parameters; all other columns of the input are ignored or passed
  through untouched, so clashing names of extra columns do no harm (working columns are selected
  into a narrow frame first);
* texts are handled whole, as UTF-8 bytes, inside Arrow batches cut into slices of bounded size;
* white space is ``[\\x20\\x09-\\x0D]`` (what ``bytes.split()`` uses) and lower-casing is A-Z only
  (what ``bytes.lower()`` does).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from skein.session import ensure_checkpoint_dir, ship_code

#: Bytes of text handled at once by the vectorised helpers (a longer text forms a slice alone).
SLICE_BYTES = 1 << 20

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = " \t\n\x0b\x0c\r"


_BATCH_KEY, _BATCH_DEFAULT, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers, make sure a reliable checkpoint folder is set, and hand texts to
    the workers in Arrow batches of 8 MB (unless the session has a size of its own)."""
    ship_code(spark)
    ensure_checkpoint_dir(spark)
    if spark.conf.get(_BATCH_KEY, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, _BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (survives lost executors, cuts the lineage)."""
    prepare(df.sparkSession)
    return df.checkpoint()


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column (None stays None)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary()).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], text_at: int, limit: int = SLICE_BYTES
           ) -> Iterator[tuple[list[list], list[bytes | None]]]:
    """Cut Arrow batches into slices of at most ``limit`` text bytes (a long text stands alone).

    Yields (other columns as lists, in order without the text column; texts).
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_pylist()
        lo = size = 0
        for hi, n in enumerate([*sizes, None]):
            if hi > lo and (n is None or size + n > limit):
                part = batch.slice(lo, hi - lo)  # bytes are copied a slice at a time
                yield ([part.column(i).to_pylist() for i in range(part.num_columns) if i != text_at],
                       as_bytes(part.column(text_at)))
                lo, size = hi, 0
            size += n or 0


# --- vectorised polynomial hashing over bytes -------------------------------------------------

_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1024), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 4 * SLICE_BYTES:  # powers for one huge text are not kept
            _POWERS[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a polynomial hash are usable."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


class Prefix:
    """Prefix sums of a polynomial hash; ``raw(start, end)`` hashes any byte ranges at once."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(_MULT, n), out=self.sums[1:])
        self.inverse = _powers(_INV, n + 1)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the maximal runs of bytes other than a blank (0x20)."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = data != 32
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` consecutive word hashes (order matters)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + h[j:j + n]
    return mix(out + np.uint64(width))


def bit_filter(words: Iterable[tuple[int, int]], bits: int) -> np.ndarray:
    """A bit array of 2**bits bits from (64-bit word index, word value) pairs."""
    out = np.zeros(1 << (bits - 6), np.uint64)
    for i, v in words:
        out[i] |= np.uint64(v & 0xFFFFFFFFFFFFFFFF)
    return out


def in_filter(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    """Which hashes have their bit (addressed by the top ``bits`` bits) set."""
    at = h >> np.uint64(64 - bits)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
