"""Sets of word n-grams as sorted 64-bit numbers, and their signatures."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

_U = np.uint64
#: Odd multipliers, one for each word of a shingle.
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], _U
)


class _Words(dict):
    """Hash of each word met; emptied by its user when large."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingler:
    """Distinct shingles of texts: ``size`` consecutive words, or all words if there are fewer.

    Words are what white space (``[ \\t-\\r]``) separates, A-Z in lower case.
    """

    def __init__(self, size: int, limit: int = 400_000):
        self.size, self._limit, self._words = size, limit, _Words()
        powers = [int(_FACTORS[i % 4]) * pow(0x9E3779B1, i // 4, 1 << 64) for i in range(size)]
        self._factors = np.array([(p % (1 << 64)) | 1 for p in powers], _U)

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """A sorted array for each text."""
        if len(self._words) > self._limit:
            self._words = _Words()
        words = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        look = self._words.__getitem__
        hashed = np.fromiter((look(w) for ws in words for w in ws), _U, int(counts.sum()))
        ends = np.cumsum(counts)
        starts = ends - counts
        out = []
        with np.errstate(over="ignore"):
            if len(hashed) >= self.size:
                last = len(hashed) - self.size + 1
                rolled = np.zeros(last, _U)
                for i, factor in enumerate(self._factors):
                    rolled += hashed[i : i + last] * factor
                rolled = _mixed(rolled)
            for start, n in zip(starts.tolist(), counts.tolist()):
                if n >= self.size:
                    out.append(np.unique(rolled[start : start + n - self.size + 1]))
                elif n:
                    whole = (hashed[start : start + n] * self._factors[:n]).sum(dtype=_U)
                    out.append(_mixed(np.array([whole + _U(n)])))
                else:
                    out.append(np.zeros(0, _U))
        return out


def identity(tokens: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def bitmap_width(size: int) -> int:
    """Bits of the bitmap of a set: a power of two of at least its size, and 64."""
    return max(64, 1 << (int(size) - 1).bit_length())


def bitmap(tokens: np.ndarray, width: int | None = None) -> np.ndarray:
    """One bit for each token, as 64-bit words. Tokens share bits; halves of a bitmap combined
    by OR are the bitmap of half the width."""
    width = width or bitmap_width(len(tokens))
    at = tokens & _U(width - 1)
    out = np.zeros(width // 64, _U)
    np.bitwise_or.at(out, (at >> _U(6)).astype(np.int64), _U(1) << (at & _U(63)))
    return out


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows) brought to ``words`` 64-bit words."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits
