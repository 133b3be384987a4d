"""Numbers and words in packed form, long texts in parts, sums by rows of numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

#: Bytes of a text that are cut into words at once.
CHUNK_BYTES = 1 << 20


def chunks(body: bytes, size: int | None = None) -> Iterator[bytes]:
    """A text in parts that end between words, at a blank or a line end."""
    size, start = size or CHUNK_BYTES, 0
    while start < len(body):
        end = start + size
        if end < len(body):
            at = max(body.rfind(b" ", start, end), body.rfind(b"\n", start, end))
            if at <= start:
                later = [p for p in (body.find(b" ", end), body.find(b"\n", end)) if p >= 0]
                at = min(later, default=len(body))
            end = at
        yield body[start:end]
        start = end


def pack(values: np.ndarray) -> bytes:
    """Numbers as bytes, those of one weight together, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def pack_list(words: list[bytes]) -> tuple[bytes, bytes]:
    """Words as one compressed text and their lengths."""
    lengths = np.fromiter(map(len, words), np.int32, len(words))
    return zstandard.ZstdCompressor(level=1).compress(b"".join(words)), pack(lengths)


def pack_words(words: pa.Array) -> tuple[bytes, bytes]:
    """Binary values as one compressed text and their lengths."""
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int32)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(words.to_pylist())), pack(lengths)


def unpack_words(words: bytes, lengths: bytes) -> pa.Array:
    sizes = unpack(lengths, np.int32)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    data = zstandard.ZstdDecompressor().decompress(words)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def firsts(code: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    return np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)


def tally(columns: list[np.ndarray], width: int, weights: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns of numbers below ``width``, in order, and the sum of each one's weights."""
    code, room, packed = columns[0].astype(np.int64), width, True
    for column in columns[1:]:
        if room * width >= 1 << 62:  # numbered anew, in the same order
            distinct, code = np.unique(code, return_inverse=True)
            room, packed = len(distinct), False
        code = code * width + column
        room *= width
    if weights is None and packed:
        code.sort()
        first = firsts(code)
        sums, code = np.diff(first, append=len(code)), code[first]
        rows = []
        for _ in columns:
            code, last = np.divmod(code, width)
            rows.insert(0, last.astype(np.int32))
        return rows, sums
    order = np.argsort(code, kind="stable")
    first = firsts(code[order])
    if weights is None:
        sums = np.diff(first, append=len(code))
    else:
        sums = np.add.reduceat(weights[order], first) if len(first) else np.zeros(0, np.int64)
    return [column[order[first]] for column in columns], sums
