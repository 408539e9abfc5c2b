"""Words, word hashes and window hashes of whole texts, as numpy arrays inside tasks.

A word is a run of characters other than space and U+0009..U+000D; that is what ``bytes.split``
cuts at.  A missing text has no words.  ``bytes.lower`` lower-cases A-Z and nothing else.
"""

import numpy as np
import xxhash

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
WORD_CACHE = 300_000


def words(text: str | None, lower: bool = False) -> list[bytes]:
    raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


class WordHash(dict):
    """word -> 64-bit hash; forgets everything when it holds too many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def array(self, parts: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, parts), np.uint64, len(parts))


def word_hashes(parts: list[bytes]) -> np.ndarray:
    """The hashes that ``WordHash`` gives, each worked out: where most words are rare that is faster, and nothing is held."""
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, parts)), ">u8").astype(np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(31))) * M2
    x = (x ^ (x >> np.uint64(29))) * M1
    return x ^ (x >> np.uint64(32))


def unmix(x: np.ndarray) -> np.ndarray:
    """The integers that ``mix`` scrambled."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(pow(int(M1), -1, 2**64))
    x = (x ^ (x >> np.uint64(29)) ^ (x >> np.uint64(58))) * np.uint64(pow(int(M2), -1, 2**64))
    return x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))


def join_hash(left: np.ndarray, right: np.ndarray, salt: int = 0) -> np.ndarray:
    """Hash of a sequence from the hashes of its two parts; the order of the parts matters."""
    return mix(left * M1 + mix(right + np.uint64(salt)) * M2)


def window_hashes(h: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """Hash of the ``length`` items from each place, by doubling; empty if there are fewer items."""
    if len(h) < length:
        return h[:0]
    out, done, power, size = None, 0, h, 1
    while True:
        if length & size:
            piece = power[done:]
            out = piece if out is None else join_hash(out[:len(piece)], piece[:len(out)], salt)
            done += size
        if size * 2 > length:
            return out[:len(h) - length + 1]
        power = join_hash(power[:-size], power[size:], salt + size)
        size *= 2


def sliding(x: np.ndarray, width: int, op=np.minimum) -> np.ndarray:
    """``op`` over each ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = op(x[:-step], x[step:])
        done += step
    return x


def bounds(lengths: list[int]) -> np.ndarray:
    """Start of each of the concatenated parts, and the end of the last."""
    return np.concatenate([[0], np.cumsum(np.asarray(lengths, np.int64))]).astype(np.int64)
