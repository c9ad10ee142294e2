"""What the operators share: word arithmetic over byte buffers, shared storage, small helpers."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import shared_dir, stash, tidy, unstash  # noqa: F401

#: A word is a run of bytes other than these six (space, tab, line feed, vertical tab, form feed, return).
WORD = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACE_BYTES)] = True

_MULT = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_MULT, -1, 1 << 64)
_RANDOM = np.random.default_rng(20240229)
#: Every byte stands for an odd 64-bit number in the polynomial hashes below.
_BYTE_CODE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unit_hash(*columns: Column | str, seed: int = 0) -> Column:
    """A reproducible number in (0, 1) from the columns' values."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return (bits.cast("double") + 0.5) / float(1 << 53)


def words_of(text: str | None) -> list[bytes]:
    """The words of one text, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_MULT**i and its inverse modulo 2**64 for i < n."""
    up, down = np.full(n, _MULT, np.uint64), np.full(n, _INVERSE, np.uint64)
    up[:1] = down[:1] = 1
    with np.errstate(over="ignore"):
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xFF51AFD7ED558CCD)
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


class Rolling:
    """Hashes of any substrings of one buffer of bytes (or code points, as uint32), each from two look-ups in a
    prefix sum."""

    def __init__(self, data: np.ndarray):
        up, self._down = powers(len(data) + 1)
        with np.errstate(over="ignore"):
            code = _BYTE_CODE[data] if data.dtype == np.uint8 else mix(data.astype(np.uint64) + np.uint64(_MULT)) | np.uint64(1)
            self._sum = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * up[:-1], dtype=np.uint64)])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self._sum[end] - self._sum[start]) * self._down[start] + (end - start).astype(np.uint64))

    def windows(self, width: int) -> np.ndarray:
        """One hash for each place where ``width`` bytes begin."""
        n = len(self._sum) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            return mix((self._sum[width:] - self._sum[:n]) * self._down[:n] + np.uint64(width))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte buffer."""
    space = np.concatenate([[True], _IS_SPACE[data], [True]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[::2], edge[1::2]


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes stay."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def blocks(texts, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs of texts (an Arrow array) of about ``limit`` bytes, or of one longer text."""
    size = pc.fill_null(pc.binary_length(texts.cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(size + 1)
    at = 0
    while at < len(size):
        upto = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + limit, side="right")))
        yield at, upto - at
        at = upto


def text_blocks(texts, limit: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, ends) of such runs: the texts one after the other, each closed by a line feed;
    null texts are empty."""
    for at, n in blocks(texts, limit):
        part = [t or b"" for t in texts.slice(at, n).cast(pa.large_binary()).to_pylist()]
        yield at, n, np.frombuffer(b"\n".join([*part, b""]), np.uint8), np.cumsum([len(t) + 1 for t in part])


def trim() -> None:
    """Give back what a task is done with: Python workers outlive it, and so does memory that their allocators hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
