"""Shingle sets and SuperMinHash signatures of texts, for use inside tasks."""

from __future__ import annotations

from functools import reduce

import numpy as np
import xxhash

_ODD, _STEP, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_CACHE_WORDS = 500_000
_FULL = np.uint32(0xFFFFFFFF)


class WordHashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = made = xxhash.xxh3_64_intdigest(word)
        return made


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; a bijection."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, length: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``length`` words; the whole sequence if there are fewer.

    Words are separated by ASCII blanks, and A-Z is lower-cased.
    """
    split = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(cache.__getitem__, split), np.uint64, len(split))
    wide = min(length, len(split))
    count = len(split) - wide + 1
    runs = reduce(lambda acc, i: mixed(acc * _ODD + hashes[i : i + count]), range(wide), np.full(count, wide, np.uint64))
    return np.unique(runs)


def set_key(shingles: np.ndarray) -> int:
    """A signed 64-bit key of a set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def super_min_hash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """One row of ``slots`` uint32 values per non-empty set.

    Every element ranks the slots by a random permutation of its own: its first slot gets a
    value of level 0, the second one of level 1, and so on. A slot holds the smallest
    value of all elements, level first. Levels go on only for sets that still have an
    unfilled slot; no later level can lower a filled one.
    """
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = np.full(len(sets) * slots, _FULL, np.uint32)
    ranks = None
    for level in range(slots):
        draw = mixed(elements + np.uint64((level + 1) * int(_STEP) % (1 << 64)))
        pick = (level + ((draw >> np.uint64(40)) * np.uint64(slots - level) >> np.uint64(24))).astype(np.intp)
        value = (np.uint64(level << 24) | (draw & np.uint64(0xFFFFFF))).astype(np.uint32)
        if ranks is None:
            slot = pick
        else:
            rows = np.arange(len(elements))
            slot = ranks[rows, pick].astype(np.intp)
            ranks[rows, pick] = ranks[:, level]
        np.minimum.at(out, owner * slots + slot, value)
        unfilled = (out.reshape(-1, slots) == _FULL).any(axis=1)
        stay = unfilled[owner]
        if not stay.any():
            break
        elements, owner = elements[stay], owner[stay]
        if ranks is None:
            ranks = np.tile(np.arange(slots, dtype=np.uint16), (len(elements), 1))
            ranks[np.arange(len(elements)), pick[stay]] = 0
        else:
            ranks = ranks[stay]
    return out.reshape(-1, slots)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed 64-bit key per band of ``rows`` values; the band's number is part of it."""
    parts = signatures[:, : bands * rows].astype(np.uint64).reshape(-1, bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for i in range(rows):
        keys = mixed(keys * _ODD + parts[:, :, i])
    return keys.view(np.int64)


def one_bit(signatures: np.ndarray) -> np.ndarray:
    """The lowest bit of every slot, 64 in a signed long; slots must be a multiple of 64."""
    bits = (signatures & np.uint32(1)).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64)
