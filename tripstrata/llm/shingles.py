"""Word shingles of texts as sorted arrays of 64-bit hashes, computed on byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tripstrata.llm.quality import in_steps, power_tables

#: Odd multipliers for the places of a shingle, and one for the length of a text with fewer words.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                   0xFF51AFD7ED558CCD], np.uint64)
SHORT = np.uint64(0xA0761D6478BD642F)


def byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Whether a byte is white space (blank, tab to carriage return), and each byte with A-Z in lower case."""
    code = np.arange(256)
    return (code == 32) | ((code >= 9) & (code <= 13)), np.where((code >= 65) & (code <= 90), code + 32, code).astype(np.uint8)


SPACE, LOWERED = byte_tables()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and for each text the number of its first word (with the total at the end)."""
    space = SPACE[data]
    before = np.concatenate(([True], space[:-1]))
    begin, stop = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    powers, inverse = power_tables(len(data))
    values = (LOWERED[data].astype(np.uint64) + np.uint64(1)) * powers[:len(data)]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values)))
    words = mix((sums[stop] - sums[begin]) * inverse[begin] + (stop - begin).astype(np.uint64))
    return words, np.append(np.searchsorted(begin, starts), len(begin))


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles; an empty array without words."""
    for _, _, data, starts, _ in in_steps(texts):
        words, cuts = word_hashes(data, starts)
        if len(words) >= size:
            rolled = sum(words[i:len(words) - size + 1 + i] * PLACES[i] for i in range(size))
            rolled = mix(rolled)
        else:
            rolled = np.zeros(0, np.uint64)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a >= size:
                own = np.sort(rolled[a:b - size + 1])
                yield own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif b > a:
                yield mix((words[a:b] * PLACES[:b - a]).sum(keepdims=True) + np.array([b - a], np.uint64) * SHORT)
            else:
                yield np.zeros(0, np.uint64)


def signature(own: np.ndarray) -> bytes:
    """16 bytes that stand for a set of hashes."""
    return np.array([mix(own * PLACES[1]).sum(dtype=np.uint64),
                     mix(own + PLACES[2]).sum(dtype=np.uint64) + np.uint64(len(own))], "<u8").tobytes()
