"""Hashes of words, word shingles and word windows, a text at a time in numpy.

A word is a run of bytes other than space and ``\\t \\n \\v \\f \\r``.  A word's hash
is a polynomial over a table of random numbers, one for each byte; prefix sums
give the hashes of all words of a text at once.  All arithmetic is modulo 2**64
and the same on every machine.
"""

import numpy as np

U64 = np.uint64
PIECE = 1 << 20  # bytes of text hashed at a time
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Scramble 64-bit numbers, one to one; another order for each seed."""
    x = x + U64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % 2**64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTES = mix(np.arange(256, dtype=U64), 11)


class Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, U64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * U64(pow(self.base, size, 2**64))])
            self.down = np.concatenate([self.down, self.down * U64(pow(self.inverse, size, 2**64))])
        return self.up[:n], self.down[:n]


_LETTERS = Powers(0x9FB21C651E98DF25)
_FIRST, _SECOND = Powers(0xD6E8FEB86659FD93), Powers(0xC2B2AE3D27D4EB4F)


def distinct(x: np.ndarray) -> np.ndarray:
    """The different numbers in ascending order; sorting is faster here than hashing."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def encoded(text: str | None, lower: bool) -> bytes:
    raw = (text or "").encode("utf-8", "replace")
    return raw.translate(LOWER) if lower else raw


def _pieces(raw: bytes):
    start = 0
    while start < len(raw):
        end = start + PIECE
        if end < len(raw):
            while end < len(raw) and not _SPACE[raw[end]]:
                end += 1
        yield raw[start:end]
        start = end


def _piece_hashes(raw: bytes, most: int | None = None) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    if not len(edge):
        return np.empty(0, U64)
    starts, ends = edge[::2], edge[1::2]
    if most:
        ends = np.minimum(ends, starts + most)
    up, down = _LETTERS.to(len(data))
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTES[data] * up, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64))


def word_hashes(raw: bytes, most: int | None = None) -> np.ndarray:
    """The hash of each word, or of its first ``most`` bytes, in order."""
    if len(raw) <= PIECE:
        return _piece_hashes(raw, most)
    return np.concatenate([_piece_hashes(piece, most) for piece in _pieces(raw)])


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """The hash of every run of ``size`` words; of the whole if it is shorter; none without words."""
    n = len(words)
    if not n:
        return np.empty(0, U64)
    length = min(n, size)
    total = np.full(n - length + 1, length, U64)
    for place in range(length):
        total += mix(words[place : n - length + 1 + place], 100 + place)
    return mix(total, 7)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """The distinct shingles of a text with A-Z lower-cased, as sorted signed numbers."""
    return distinct(shingle_hashes(word_hashes(encoded(text, True)), size).view(np.int64))


def set_hash(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    values = shingles.view(U64)
    return tuple(int(mix(values, seed).sum(dtype=U64).view(np.int64)) for seed in (21, 22))


def _windows(words: np.ndarray, size: int, powers: Powers) -> np.ndarray:
    up, down = powers.to(len(words))
    total = np.zeros(len(words) + 1, U64)
    np.cumsum(words * up, out=total[1:])
    return (total[size:] - total[:-size]) * down[: len(words) - size + 1]


def window_hashes(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every window of ``size`` words."""
    if len(words) < size:
        return np.empty(0, U64), np.empty(0, U64)
    return mix(_windows(words, size, _FIRST), 3), mix(_windows(mix(words, 4), size, _SECOND), 5)


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every run of ``size`` numbers."""
    width = 1
    while 2 * width <= size:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[: len(x) - (size - width)], x[size - width :])
