"""Helpers for numpy work inside tasks: text batches as flat byte blocks, 64-bit
mixing, and packed array blobs that keep shuffles small (one row per task and
bucket instead of one row per element)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

U64 = np.uint64
PAD = 128
_LEVEL = 3


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche on uint64 arrays (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def bounds(keys: np.ndarray) -> np.ndarray:
    """Start index of every run of equal values in a sorted array."""
    if len(keys) == 0:
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ranges ``[start, start + length)``."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts.astype(np.int64) - ends + lengths, lengths)


def text_blocks(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int,
                max_rows: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into pieces of about ``max_bytes`` text bytes.

    Yields ``(rows, data, offsets)``: ``data`` is the piece's text as bytes with
    ``PAD`` zero bytes behind it, ``offsets`` the row boundaries in it.
    """
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
        if len(col) == 0:
            continue
        off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
        raw = col.buffers()[2]
        flat = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(col):
            hi = int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1
            hi = min(max(hi, lo + 1), lo + max_rows, len(col))
            part = np.zeros(int(off[hi] - off[lo]) + PAD, np.uint8)
            part[:len(part) - PAD] = flat[off[lo]:off[hi]]
            yield batch.slice(lo, hi - lo), part, off[lo:hi + 1] - off[lo]
            lo = hi


def words8(data: np.ndarray, big: bool = False) -> np.ndarray:
    """The 8 bytes at every position (but the last 7) as uint64, without a copy."""
    return np.ndarray((max(0, len(data) - 7),), ">u8" if big else "<u8", data.tobytes() if not
                      data.flags.c_contiguous else data, 0, (1,))


def pack(arrays: list[np.ndarray], level: int = _LEVEL) -> bytes:
    """Arrays (at most 8 byte items) as one compressed blob."""
    head = [np.array([len(arrays)], "<i8")]
    for a in arrays:
        head.append(np.frombuffer(np.dtype(a.dtype).str.ljust(8).encode(), "<i8"))
        head.append(np.array([a.nbytes], "<i8"))
    body = b"".join(np.ascontiguousarray(x).tobytes() for x in [np.concatenate(head), *arrays])
    return zstandard.ZstdCompressor(level=level).compress(body)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head, at, out = np.frombuffer(raw, "<i8", 2 * n, 8), 8 + 16 * n, []
    for i in range(n):
        kind, size = head[2 * i:2 * i + 1].tobytes().decode().strip(), int(head[2 * i + 1])
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out
