"""Words and word shingles of whole texts as 64-bit hashes, in numpy.

Words are the maximal runs of bytes other than space and ``\\x09``-``\\x0D``; A-Z
counts as a-z.  A word's hash is a polynomial over its bytes modulo 2**64 with
random byte values, scaled to start at position 0, and mixed; a text is hashed
in pieces of about ``PIECE`` bytes that end at white space, so memory does not
grow with the text beyond the hashes themselves (a single word longer than that
is taken whole).
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.default_rng(20240611)
_VALUE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[ord("A"):ord("Z") + 1] = _VALUE[ord("a"):ord("z") + 1]
_STEP = int(_rng.integers(1 << 40, 1 << 62)) * 2 + 1
_BACK = pow(_STEP, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of the step and of its inverse, up to ``n`` at least."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((_STEP, _BACK)):
            p = np.full(max(n, PIECE) + 1, base, dtype=np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _hash_piece(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions of the words in a byte array."""
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = ~SPACE[buf]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = powers(len(buf))
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[buf] * up[:len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """The word hashes of each text, in order."""
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(texts)
    batch: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if batch:
            buf = np.frombuffer(b" ".join(texts[i] for i in batch), np.uint8)
            hashes, starts = _hash_piece(buf)
            ends = np.cumsum([len(texts[i]) + 1 for i in batch])
            for i, part in zip(batch, np.split(hashes, np.searchsorted(starts, ends[:-1])), strict=True):
                out[i] = part
        batch.clear()
        size = 0

    for i, t in enumerate(texts):
        if len(t) > PIECE:
            out[i] = _hash_long(t)
            continue
        if size + len(t) > PIECE:
            flush()
        batch.append(i)
        size += len(t) + 1
    flush()
    return out


def _hash_long(text: bytes) -> np.ndarray:
    buf, at, parts = np.frombuffer(text, np.uint8), 0, []
    while at < len(buf):
        end = min(at + PIECE, len(buf))
        while end < len(buf) and not SPACE[buf[end]]:  # up to the end of the word
            step = SPACE[buf[end:end + PIECE]]
            end += int(np.argmax(step)) if step.any() else len(step)
        parts.append(_hash_piece(buf[at:end])[0])
        at = end
    return np.concatenate(parts)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; of fewer words, the whole sequence as one."""
    if not len(words):
        return words
    width = min(n, len(words))
    h = np.full(len(words) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[i:len(words) - width + 1 + i])
    return np.unique(h)
