"""Records that travel as packed arrays: a row holds very many, dealt to parts by a number."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

ROWS = "part int, kind int, src int, packed binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("src", pa.int32()), ("packed", pa.binary())])

Row = tuple[int, int, int, bytes]


def batch(rows: list[Row]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_SCHEMA.types)], schema=_SCHEMA)


def unbatch(table: pa.Table) -> list[Row]:
    return list(zip(*(table[n].to_pylist() for n in _SCHEMA.names), strict=True))


def home(ids: np.ndarray, parts: int) -> np.ndarray:
    """The part that a document belongs to: the same as home_column.  Odd numbers of parts spread ids best."""
    return np.mod(ids ^ (ids >> 15) ^ (ids >> 31), parts)


def home_column(ids: Column, parts: int) -> Column:
    return F.pmod(ids.bitwiseXOR(F.shiftright(ids, 15)).bitwiseXOR(F.shiftright(ids, 31)), F.lit(parts)).cast("int")


def pack(*columns: tuple[np.ndarray, int]) -> bytes:
    """Columns of 64-bit numbers, each cut to its lowest bytes; the first value of a signed column is its base."""
    n = len(columns[0][0])
    out = [np.array([n], np.int64).tobytes()]
    for column, width in columns:
        if width == 0:  # ids: a base and as few bytes as their range needs
            base = column.min() if n else np.int64(0)
            column = (column.view(np.uint64) - np.array(base, np.int64).view(np.uint64)) if n else column.view(np.uint64)
            width = 4 if not n or int(column.max()) < 1 << 32 else 8
            out += [np.array([base], np.int64).tobytes(), bytes([width])]
        out.append(np.ascontiguousarray(column.astype(np.uint64)).view(np.uint8).reshape(n, 8)[:, :width].tobytes())
    return b"".join(out)


def unpack(blob: bytes, *widths: int) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    at, out = 8, []
    for width in widths:
        base = 0
        is_id = width == 0
        if is_id:
            base, width = np.frombuffer(blob[at : at + 8], np.int64)[0], blob[at + 8]
            at += 9
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(blob, np.uint8, n * width, at).reshape(n, width)
        column = wide.view(np.uint64).ravel()
        out.append((column + np.array(base, np.int64).view(np.uint64)).view(np.int64) if is_id else column)
        at += n * width
    return out


def gather(blobs: list[bytes], *widths: int) -> list[np.ndarray]:
    if not blobs:
        return [np.zeros(0, np.int64 if w == 0 else np.uint64) for w in widths]
    return [np.concatenate(x) for x in zip(*(unpack(b, *widths) for b in blobs), strict=True)]


def deal(kind: int, part: np.ndarray, *columns: tuple[np.ndarray, int], src: int = 0) -> Iterator[Row]:
    """Packed rows, one a part."""
    order = np.argsort(part, kind="stable")
    cut = np.concatenate([[0], np.flatnonzero(np.diff(part[order])) + 1, [len(order)]])
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if b > a:
            rows = order[a:b]
            yield int(part[rows[0]]), kind, src, pack(*[(c[rows], w) for c, w in columns])


def owner(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that a hash belongs to: parts are ranges of hashes, so sorted hashes have sorted owners."""
    return (((keys >> np.uint64(40)) * np.uint64(parts)) >> np.uint64(24)).astype(np.int64)


def small(x: np.ndarray) -> bytes:
    """Numbers from 0, mostly small: a byte each, 255 for those that follow at full length."""
    wide = np.ascontiguousarray(x, np.int64)
    return b"".join([np.array([len(wide)], np.int64).tobytes(), np.minimum(wide, 255).astype(np.uint8).tobytes(), wide[wide >= 255].tobytes()])


def unsmall(blob: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    """The numbers written at a place, and the place after them."""
    n = int(np.frombuffer(blob, np.int64, 1, at)[0])
    x = np.frombuffer(blob, np.uint8, n, at + 8).astype(np.int64)
    long = np.flatnonzero(x == 255)
    x[long] = np.frombuffer(blob, np.int64, len(long), at + 8 + n)
    return x, at + 8 + n + 8 * len(long)


def deal_sorted(kind: int, keys: np.ndarray, columns: list[np.ndarray], parts: int, src: int) -> Iterator[Row]:
    """Packed rows, one an owner, of sorted hashes (their lowest six bytes travel) and columns of small numbers."""
    part = owner(keys, parts)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    low = keys.view(np.uint8).reshape(-1, 8)[:, :6]
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        if b > a:
            yield int(part[a]), kind, src, b"".join([np.array([b - a], np.int64).tobytes(), low[a:b].tobytes(), *(small(c[a:b]) for c in columns)])


def undeal(blob: bytes, columns: int) -> list[np.ndarray]:
    """Keys and columns of a row of deal_sorted."""
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, 8).reshape(n, 6)
    out, at = [wide.view(np.uint64).ravel()], 8 + 6 * n
    for _ in range(columns):
        column, at = unsmall(blob, at)
        out.append(column)
    return out
