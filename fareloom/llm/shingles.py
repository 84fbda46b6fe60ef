"""Word shingles of whole texts as sorted sets of 64-bit hashes, made with numpy."""

import numpy as np

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as a text has needed them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up), 1 << 16)
            with np.errstate(over="ignore"):
                up, down = np.full(size, _BASE, np.uint64), np.full(size, _BASE_INVERSE, np.uint64)
                up[0] = down[0] = 1
                self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up, self.down


def word_hashes(text: bytes, powers: Powers) -> np.ndarray:
    """A hash a word, in order. Words are runs of anything but ASCII white space; A-Z is lowered."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    white = np.concatenate(([True], _WHITE[data], [True]))
    edges = np.flatnonzero(white[1:] != white[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = powers.upto(len(data))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str | None, width: int, powers: Powers) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of a text.

    A text of fewer words is one shingle as a whole; a text without words has none.
    """
    words = word_hashes((text or "").encode(), powers)
    if not len(words):
        return words
    size = min(width, len(words))
    with np.errstate(over="ignore"):
        out = np.full(len(words) - size + 1, size, np.uint64)
        for k in range(size):
            out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words[k : len(words) - size + 1 + k])
    return np.unique(out)
