"""64-bit names of byte strings and word shingles, computed for many at a time."""

from __future__ import annotations

import numpy as np

# Fixed odd multipliers that spread the bits of a name.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SHIFT = np.uint64(32)


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The name of a pair of names. The two places count differently, and no step loses bits
    before both have entered."""
    name = left * MIX_A
    name ^= name >> SHIFT
    name += right
    name *= MIX_B
    name ^= name >> SHIFT
    return name


def numbers(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random odd numbers."""
    counter = np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 32)
    return pair(counter, counter * MIX_B) | np.uint64(1)


BYTE = numbers(256, 1)
BYTE[65:91] = BYTE[97:123]  # A-Z count as a-z
PLACE = numbers(1024, 2)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_names(data: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte after the last, name) of every word, with A-Z as a-z. Words are runs of
    bytes that ``blank`` (a flag for every byte value) does not mark, by default ASCII white
    space. The buffer may hold many texts with white space between them."""
    inside = ~blank[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    place = np.arange(len(data)) - starts[np.maximum(np.cumsum(begins) - 1, 0)]
    values = BYTE[data] * PLACE[place & 1023]
    values[~inside] = 0
    lengths = np.add.reduceat(inside.astype(np.uint64), starts)
    names = pair(np.add.reduceat(values, starts), lengths)
    return starts, starts + lengths.astype(np.int64), names


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle name), sorted and without repetitions, for all texts.

    A text of fewer words than ``width`` has one shingle of all its words; one without words has
    none.
    """
    sizes = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(sizes)
    starts, _, words = word_names(np.frombuffer(b"\n".join(texts) + b"\n", np.uint8))
    owner = np.searchsorted(ends, starts, side="right")
    count = np.bincount(owner, minlength=len(texts))
    names, whole = words, np.ones(len(words), bool)
    for k in range(1, width):
        # A window that would leave its text keeps the name it has so far.
        whole[-k:] = False
        whole[: len(words) - k] &= owner[: len(words) - k] == owner[k:]
        longer = pair(names[: len(words) - k], words[k:])
        names = np.where(whole, np.append(longer, np.zeros(k, np.uint64))[: len(words)], names)
    first = np.ones(len(words), bool)
    first[1:] = owner[1:] != owner[:-1]
    wanted = whole | (first & (count[owner] < width))
    owner, names = owner[wanted], names[wanted]
    order = np.lexsort((names, owner))
    owner, names = owner[order], names[order]
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], names[new]
