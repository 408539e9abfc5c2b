"""Hash-keyed arrays cut into chunks by the leading bits of the hash, for a shuffle in few rows."""

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text for each chunk; chunks grow in number with the text, not in size.
CHUNK_CHARS = 1 << 20


def chunk_bits(docs: DataFrame, text_col: str) -> int:
    """Leading hash bits that number the chunks, from the length of all texts."""
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    return max(1, int(np.ceil(np.log2(max(chars / CHUNK_CHARS, 1)))))


def chunks(h: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """(chunk, slice) of every chunk that the sorted hashes ``h`` reach."""
    number = (h >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(h) else []
    for a, b in zip(starts, [*starts[1:], len(h)]):
        yield int(number[a]), slice(int(a), int(b))


def planes(x: np.ndarray) -> bytes:
    """The first byte of every number, then the second of every number and so on: where they are alike the shuffle packs them."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def from_planes(raw: bytes, dtype) -> np.ndarray:
    kind = np.dtype(dtype)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, len(raw) // kind.itemsize).T).view(kind).ravel()


def gaps(h: np.ndarray) -> bytes:
    """The ascending unsigned numbers ``h`` as planes of their differences."""
    return planes(np.diff(h, prepend=h.dtype.type(0)))


def from_gaps(raw: bytes, dtype) -> np.ndarray:
    return np.cumsum(from_planes(raw, dtype), dtype=dtype)


def gather(column, dtype) -> np.ndarray:
    """The arrays whose bytes the rows of ``column`` hold, one after another."""
    return np.frombuffer(b"".join(column), dtype)
