"""Many texts as one byte array, for numpy work on all words at once."""

from __future__ import annotations

import numpy as np

from vaultmart.llm.common import pieces

CHUNK = 1 << 20          # bytes worked on at once
_RADIX = np.uint64(0x9E3779B97F4A7C15)                       # odd: has an inverse mod 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def chunks(texts):
    """(bytes of several texts, each followed by a newline; offsets; text numbers):
    texts longer than CHUNK come in pieces cut at white space.  Where CHUNK bytes and
    more hold none, the piece is cut into windows of CHUNK bytes, whole characters
    each: a word of such a size counts as several, and memory stays bounded."""
    held, number, size = [], [], 0
    for n, text in enumerate(texts):
        for piece in (w for p in pieces(text.encode("utf-8"), CHUNK) for w in _windows(p)):
            if size and size + len(piece) > CHUNK:
                yield _joined(held, number)
                held, number, size = [], [], 0
            held.append(piece)
            number.append(n)
            size += len(piece) + 1
    if held:
        yield _joined(held, number)


def _windows(piece: bytes):
    start = 0
    while len(piece) - start > 2 * CHUNK:
        end = start + CHUNK
        while piece[end] & 0xC0 == 0x80:       # inside a character
            end -= 1
        yield piece[start:end]
        start = end
    yield piece[start:]


def _joined(held, number):
    sizes = np.array([len(h) + 1 for h in held])
    data = np.frombuffer(b"\n".join(held) + b"\n", np.uint8)
    return data, np.cumsum(sizes) - sizes, np.array(number)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return edge[::2], edge[1::2]


class SpanHash:
    """Hashes of any spans of a byte array, equal for equal bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(_powers.get("up", ())) < n:
            _powers["up"] = np.cumprod(np.full(n, _RADIX))
            _powers["down"] = np.cumprod(np.full(n, _INVERSE))
        self.sums = np.concatenate([np.zeros(1, np.uint64),
                                    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers["up"][:n - 1])])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        x = (self.sums[ends] - self.sums[starts]) * _powers["down"][starts]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def hash_of(words) -> np.ndarray:
    """The SpanHash of each of some byte strings."""
    data = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    ends = np.cumsum(sizes)
    return SpanHash(data)(ends - sizes, ends)


def member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each value is in the small sorted array ``of``."""
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values
