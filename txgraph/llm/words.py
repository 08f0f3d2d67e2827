"""Words of many texts at once, as 64-bit hashes.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage
return. Its hash is multilinear in its bytes (A-Z lowered) and then mixed, so that different
words agree with a chance of about 2^-57.
"""

from __future__ import annotations

import numpy as np

_PLACES = 4096
_R = np.random.default_rng(20240607).integers(0, 1 << 63, _PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_CODE = np.arange(1, 257, dtype=np.uint64)  # of a byte, A-Z lowered
_CODE[65:91] += np.uint64(32)
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words before each text and in all.

    ``offsets`` has the start of each text in ``data`` and the end; words never cross texts.
    """
    none = np.zeros(len(offsets), dtype=np.int64)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), none
    kept = _CODE[data[inside]]
    first = np.cumsum(inside)[starts] - 1  # where each word starts among the kept bytes
    lengths = np.diff(np.append(first, len(kept)))
    place = np.arange(len(kept)) - np.repeat(first, lengths)
    if lengths.max() > _PLACES:
        kept *= _R[place & (_PLACES - 1)] * (2 * (place >> 12) + 1).astype(np.uint64)
    else:
        kept *= _R[place]
    sums = np.add.reduceat(kept, first)
    return mix(sums + lengths.astype(np.uint64)), np.searchsorted(starts, offsets).astype(np.int64)


def block_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``word_hashes``, with other hashes: multilinear in mixed blocks of eight bytes.

    Words are read a block at a time, so the work goes with the words and not with the bytes.
    """
    inside = (data != 0x20) & (data - np.uint8(0x09) > 4)
    last = np.zeros(len(data), dtype=bool)
    last[:-1] = inside[:-1] & ~inside[1:]
    last[-1:] = inside[-1:]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = offsets[:-1][(offsets[:-1] > 0) & (offsets[:-1] < len(data))]
    begins[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    lengths = np.flatnonzero(last) + 1 - starts
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[:-8] = data | ((data - np.uint8(0x41) < 26).view(np.uint8) << 5)  # A-Z lowered
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    sums = mix(eight[starts] & _LOW_BYTES[np.minimum(lengths, 8)]) * _R[0]
    more = np.flatnonzero(lengths > 8)
    if len(more):
        n = (lengths[more] - 1) // 8  # blocks after the first
        before = np.cumsum(n) - n
        block = np.arange(1, n.sum() + 1) - np.repeat(before, n)
        left = np.repeat(lengths[more], n) - 8 * block
        part = eight[np.repeat(starts[more], n) + 8 * block] & _LOW_BYTES[np.minimum(left, 8)]
        turn = _R[block & (_PLACES - 1)] * (2 * (block // _PLACES) + 1).astype(np.uint64)
        sums[more] += np.add.reduceat(mix(part + block.astype(np.uint64)) * turn, before)
    return mix(sums + lengths.astype(np.uint64)), np.searchsorted(starts, offsets).astype(np.int64)


def shingles(words: np.ndarray, before: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words in order, and the number of them before each text.

    A text with fewer words has its whole sequence as the only one; without words, none.
    """
    sizes = np.diff(before)
    counts = np.where(sizes >= n, sizes - n + 1, (sizes > 0).astype(np.int64))
    upto = np.concatenate([[0], np.cumsum(counts)])
    if not upto[-1]:
        return np.zeros(0, dtype=np.uint64), upto
    full = np.zeros(len(words), dtype=np.uint64)
    span = max(0, len(words) - n + 1)
    for i in range(n):
        full[:span] += words[i : i + span] * _R[i]
    at = np.arange(upto[-1]) - np.repeat(upto[:-1], counts) + np.repeat(before[:-1], counts)
    out = full[at]
    for row in np.flatnonzero((sizes > 0) & (sizes < n)):
        held = words[before[row] : before[row + 1]]
        out[upto[row]] = (held * _R[: len(held)]).sum(dtype=np.uint64) + np.uint64(len(held))
    return mix(out), upto
