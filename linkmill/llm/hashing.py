"""Hashes of words and shingles for batches of texts, in numpy.

A word is a maximal run of bytes other than white space, compared after
lower-casing A-Z.  Its hash is a polynomial over table values of its bytes,
mixed at the end; a shingle's is a weighted sum of its words' hashes, mixed.
Everything is arithmetic modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
WORDS = 5
#: bytes hashed at once; a longer text is hashed piece by piece
PIECE = 1 << 20

_draw = np.random.default_rng(20240229)
_BYTE = _draw.integers(0, 2**63, 256, dtype=U) * U(2) + U(1)
_BYTE[65:91] = _BYTE[97:123]
_PLACE = _draw.integers(0, 2**63, WORDS, dtype=U) * U(2) + U(1)
_BASE = int(_draw.integers(2**62, 2**63)) * 2 + 1
_UNBASE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PIECE + 4096)
        _POWERS[:] = [
            np.multiply.accumulate(np.concatenate([[U(1)], np.full(size - 1, U(base))]))
            for base in (_BASE, _UNBASE)
        ]
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _words_of(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of ``data``."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    powers, back = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum(_BYTE[raw] * powers[:-1], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * back[starts])


def _cuts(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces of about PIECE bytes that end at white space."""
    at = 0
    while len(data) - at > PIECE:
        end = at + PIECE
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and the number of words of each text."""
    counts = np.zeros(len(texts), np.int64)
    hashes, group, size = [], [], 0

    def flush() -> None:
        nonlocal group, size
        if group:
            joined = b"\n".join(piece for _, piece in group)
            starts, found = _words_of(joined)
            begins = np.cumsum([0] + [len(piece) + 1 for _, piece in group[:-1]])
            owner = np.array([i for i, _ in group])
            np.add.at(counts, owner[np.searchsorted(begins, starts, "right") - 1], 1)
            hashes.append(found)
        group, size = [], 0

    for i, text in enumerate(texts):
        for piece in _cuts(text):
            if size + len(piece) > PIECE:
                flush()
            group.append((i, piece))
            size += len(piece) + 1
    flush()
    return (np.concatenate(hashes) if hashes else np.zeros(0, U)), counts


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text one after another, and how many each has.

    A text of fewer than WORDS words, but not none, has its whole word
    sequence as its only shingle; a text without words has none.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    total = np.zeros(max(len(words) - WORDS + 1, 0), U)
    for k in range(WORDS):
        total += words[k : k + len(total)] * _PLACE[k]
    total = mix(total)
    sets = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        start = end - n
        if n >= WORDS:
            row = np.sort(total[start : end - WORDS + 1])
            keep = np.ones(len(row), bool)
            np.not_equal(row[1:], row[:-1], out=keep[1:])
            sets.append(row[keep])
        elif n:
            short = (words[start:end] * _PLACE[:n]).sum(dtype=U, keepdims=True) + U(n)
            sets.append(mix(short ^ U(0x5851F42D4C957F2D)))
        else:
            sets.append(words[:0])
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, U)), sizes
