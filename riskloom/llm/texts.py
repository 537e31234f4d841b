"""Arrow string columns as flat byte arrays, so that work on texts is array work.

A batch is walked in chunks of whole texts of about ``CHUNK_BYTES``; a longer text is a chunk of
its own. What a task holds beside a batch is thus a few times the larger of the two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
#: For work that holds dozens of bytes per byte of a chunk.
SMALL_CHUNK = 1 << 18


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the n + 1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8)[first:last] if data is not None and last > first else np.zeros(0, np.uint8)
    return raw, offsets.astype(np.int64) - first


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of whole texts."""
    raw, offsets = flat(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, raw[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def compressed(column: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each text's UTF-8 bytes by Zstandard, and how many bytes it has; null is empty."""
    raw, offsets = flat(column)
    codec, whole = pa.Codec("zstd", compression_level=1), pa.py_buffer(np.ascontiguousarray(raw))
    small = [codec.compress(whole.slice(a, b - a), asbytes=True) if b > a else b"" for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    return pa.array(small, pa.binary()), pa.array(np.diff(offsets), pa.int64())


def restored(column: pa.Array, sizes: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """What ``chunks`` gives of the texts that ``compressed`` made so small; a chunk at a time is restored."""
    codec = pa.Codec("zstd")
    ends = np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)])
    n, at = len(column), 0
    while at < n:
        end = min(max(int(np.searchsorted(ends, ends[at] + size, side="right")) - 1, at + 1), n)
        offsets = ends[at:end + 1] - ends[at]
        parts = [codec.decompress(column[i].as_buffer(), int(ends[i + 1] - ends[i])) for i in range(at, end) if ends[i + 1] > ends[i]]
        yield at, end, np.frombuffer(b"".join(parts), np.uint8), offsets
        at = end


def packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary per row: the bytes of ``values[offsets[i]:offsets[i + 1]]``."""
    width = values.dtype.itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer((offsets.astype(np.int64) * width).tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())]
    ).cast(pa.binary())


def is_space(raw: np.ndarray) -> np.ndarray:
    """The six ASCII blanks: space and 0x09 to 0x0D."""
    return (raw == 32) | ((raw >= 9) & (raw <= 13))


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, maximal runs without blanks inside one text, and how many
    words come before each text's end (n + 1 counts, the first 0)."""
    n = len(raw)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~is_space(raw)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.empty(n, bool)
    before[0] = True
    np.logical_not(inside[:-1], out=before[1:])
    starts = np.flatnonzero(inside & (before | cut[:n]))
    after = np.empty(n, bool)
    after[-1] = True
    np.logical_not(inside[1:], out=after[:-1])
    ends = np.flatnonzero(inside & (after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, back: bool = False) -> np.ndarray:
    """step ** i (or its inverse) modulo 2 ** 64 for i < n, kept between calls."""
    key = "back" if back else "step"
    have = _POWERS.get(key)
    if have is None or len(have) < n:
        grown = np.full(max(n + n // 4, 2 * SMALL_CHUNK), _BACK if back else _STEP)
        grown[0] = 1
        np.multiply.accumulate(grown, out=grown)
        if len(grown) > 4 * CHUNK_BYTES:  # for one very long text: not kept
            return grown[:n]
        _POWERS[key] = have = grown
    return have[:n]


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Running polynomial sums: entry i covers the first i bytes."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * powers(len(raw)), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans; equal bytes have equal hashes wherever they stand."""
    h = (sums[ends] - sums[starts]) * powers(len(sums), back=True)[starts]
    return mix(h + np.uint64(0x9E3779B97F4A7C15) * (ends - starts).astype(np.uint64))
