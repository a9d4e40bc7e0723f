"""Word shingles as 64-bit hashes, and sketches of their sets."""

from __future__ import annotations

import numpy as np
import xxhash

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = 0x9E3779B97F4A7C15
_LOW = (1 << 64) - 1


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _M1
    values = (values ^ (values >> np.uint64(27))) * _M2
    return values ^ (values >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` consecutive word hashes."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = hashes[:count].copy()
    for i in range(1, size):
        total = total * np.uint64(_STEP) + hashes[i : i + count]
    return mix(total + np.uint64(size))


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text: A-Z lower-cased, words cut at ASCII white space.

    A text of fewer words is one shingle; without words the set is empty.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = word_hashes(words)
    return np.unique(windows(hashes, min(size, len(words))))


def sketch(members: np.ndarray, size: int) -> np.ndarray:
    """Fast similarity sketch of a set: ``size`` coordinates, equal in two sets with the chance of their similarity.

    In round i of the first ``size`` rounds every member falls into one hashed
    bin; a bin keeps its earliest round and the smallest hash of that round.
    Later rounds put every member into bin i - size, so that no bin stays empty.
    Rounds stop when all bins are filled; a set much larger than the sketch needs
    one or two.
    """
    best = np.full(size, _LOW, dtype=np.uint64)
    filled = np.zeros(size, dtype=bool)
    at = 0
    while at < size and not filled.all():
        rounds = min(size - at, max(1, -(-4 * size // len(members))))
        seeds = mix((np.arange(at, at + rounds, dtype=np.uint64) + np.uint64(1)) * np.uint64(_STEP))
        hashes = mix(members[None, :] ^ seeds[:, None])
        bins = (hashes % np.uint64(size)).astype(np.int64)
        # Earlier rounds sort first; within a round the smaller hash.
        order = (np.arange(at, at + rounds, dtype=np.uint64)[:, None] << np.uint64(48)) | (hashes >> np.uint64(16))
        found = np.full(size, _LOW, dtype=np.uint64)
        np.minimum.at(found, bins.ravel(), order.ravel())
        take = ~filled & (found != _LOW)
        best[take] = found[take]
        filled |= take
        at += rounds
    rest = np.flatnonzero(~filled).astype(np.uint64) + np.uint64(size)
    if len(rest):  # only for a handful of members
        seeds = mix((rest + np.uint64(1)) * np.uint64(_STEP))
        least = mix(members[None, :] ^ seeds[:, None]).min(axis=1)
        best[~filled] = (rest << np.uint64(48)) | (least >> np.uint64(16))
    return mix(best)


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` coordinates; keys of different bands differ."""
    table = coordinates[: bands * rows].reshape(bands, rows)
    keys = mix((np.arange(bands, dtype=np.uint64) + np.uint64(1)) * np.uint64(_STEP))
    for i in range(rows):
        keys = mix(keys * np.uint64(_STEP) + table[:, i])
    return keys
