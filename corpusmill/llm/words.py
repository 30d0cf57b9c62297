"""Words of byte strings as 64-bit hashes, computed for whole arrays at a time, A-Z as a-z.

Two of n distinct words share a hash with a probability of about n * n / 4e19.
"""

from __future__ import annotations

import hashlib

import numpy as np

#: Bytes that are hashed at a time; words of more bytes than ``LONG_WORD`` are hashed one by one.
CHUNK, LONG_WORD = 1 << 18, 4096
#: What stands for the end of a text.
END = np.uint64(0x5851F42D4C957F2D)

_rng = np.random.default_rng(17)
_LETTER = _rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B]
_PLACE = _rng.integers(0, 1 << 63, LONG_WORD, np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(data: np.ndarray, separates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some bytes start, and their hashes."""
    inside = ~separates[data]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    values = _LETTER[data[inside]] * _PLACE[np.minimum(place, LONG_WORD - 1)]
    out = mix(np.add.reduceat(values, first))
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        word = data[starts[i] : ends[i]].tobytes().translate(_FOLD)
        out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return starts, out


def hashed_words(texts: list[bytes], separates: np.ndarray, end: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some texts, one after the other, and how many each text has.

    ``separates`` tells of each byte whether it separates words; the space must.
    With ``end`` each text ends with ``END``, which counts.
    """
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    cuts, at = [0], CHUNK
    if len(data) > CHUNK:
        gaps = np.flatnonzero(separates[data])
        while at < len(data):
            cuts.append(int(gaps[np.searchsorted(gaps, at)]))
            at = cuts[-1] + CHUNK
    cuts.append(len(data))
    found = [(starts + a, ids) for a, b in zip(cuts, cuts[1:]) for starts, ids in [_words(data[a:b], separates)]]
    starts, ids = (np.concatenate(x) for x in zip(*found))
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    text = np.searchsorted(ends, starts, "right")
    n = np.bincount(text, minlength=len(texts)) + end
    if not end:
        return ids, n
    out = np.full(len(ids) + len(texts), END)
    out[np.arange(len(ids)) + text] = ids
    return out, n
