"""Words of Arrow text columns with NumPy: places, 64-bit hashes, and packed counts for exchanges.

A batch of texts is one byte buffer with offsets. Words are found by a byte table and hashed by a
polynomial over the bytes (one running sum for the whole buffer), so no Python object is made for a
word. Nulls are empty texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: White space of the contracts: \\x20 and \\x09-\\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BLOCK = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers (one to one)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_POWERS: list[np.ndarray] = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        for base in (_BASE, _INVERSE):
            p = np.full(_BLOCK + 1, base, np.uint64)
            p[0] = 1
            _POWERS.append(np.cumprod(p, dtype=np.uint64))
    return _POWERS[0], _POWERS[1]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts together, and where each one starts (with the end of the last)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    large = pa.types.is_large_string(column.type)
    kind = np.int64 if large else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def spans(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of the first word of each text (and of all)."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~between[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    closes = inside[:-1] & (~inside[1:] | begins[1:])
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; it depends on the word's bytes alone."""
    power, inverse = _powers()
    out = np.empty(len(starts), np.uint64)
    size = ends - starts
    long = np.flatnonzero(size > _BLOCK)
    i = 0
    stops = [*long.tolist(), len(starts)]
    for stop in stops:
        while i < stop:
            base = starts[i]
            j = min(int(np.searchsorted(ends, base + _BLOCK, "right")), stop)
            span = data[base : ends[j - 1]]
            total = np.zeros(len(span) + 1, np.uint64)
            np.cumsum(_BYTE[span] * power[: len(span)], dtype=np.uint64, out=total[1:])
            a, b = starts[i:j] - base, ends[i:j] - base
            out[i:j] = (total[b] - total[a]) * inverse[a]
            i = j
        if stop < len(starts):
            import xxhash

            out[stop] = xxhash.xxh3_64_intdigest(data[starts[stop] : ends[stop]].tobytes())
            i = stop + 1
    return mix(out + size.astype(np.uint64))


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their weights (1 each if not given)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if weights is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(weights[order], first)


def pack(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted distinct keys and their counts as compressed bytes (differences, bytes by place)."""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T)
    big = np.minimum(counts, 255).astype(np.uint8)
    rest = counts[counts >= 255].astype("<i8")
    codec = pa.Codec("zstd", compression_level=1)
    raw = big.tobytes() + rest.tobytes()
    return (
        codec.compress(planes.tobytes(), asbytes=True),
        len(keys).to_bytes(8, "little") + codec.compress(raw, asbytes=True)
        if len(keys)
        else (0).to_bytes(8, "little"),
    )


def unpack(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    n = int.from_bytes(counts[:8], "little")
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    d = zstandard.ZstdDecompressor()
    planes = np.frombuffer(d.decompressobj().decompress(keys), np.uint8).reshape(8, n)
    gaps = np.ascontiguousarray(planes.T).view("<u8").ravel()
    raw = d.decompressobj().decompress(counts[8:])
    out = np.frombuffer(raw[:n], np.uint8).astype(np.int64)
    out[out == 255] = np.frombuffer(raw[n:], "<i8")
    return np.cumsum(gaps, dtype=np.uint64), out


def merged(parts: Iterable[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum of packed counts."""
    pairs = [unpack(*p) for p in parts]
    if not pairs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return counted(np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]))


def pieces(batches: Iterator[pa.RecordBatch], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of data; a longer row is a batch."""
    for b in batches:
        if b.num_rows == 0:
            continue
        per = max(1, int(b.num_rows * most / max(1, b.nbytes)))
        for i in range(0, b.num_rows, per):
            yield b.slice(i, per)
