"""Suffix arrays by induced sorting, and permuted common prefixes, of one shard of text.

The byte level is induced bucket by bucket with numpy: all suffixes of a bucket that are known at one
moment pass their predecessors on together. The reduced strings of the recursion have as many letters
as names, so there the scan goes suffix by suffix.
"""

from __future__ import annotations

import numpy as np

# Up to this many letters the bucketwise scan is used.
_BUCKETWISE = 1024


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Sorted starts of all suffixes of an array of small integers >= 0."""
    if len(text) == 0:
        return np.zeros(0, np.int64)
    closed = np.append(text.astype(np.int64) + 1, 0)
    return _induced(closed, int(closed.max()) + 1)[1:]


def _smaller_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S type); the last letter is the sentinel."""
    step = np.sign(np.diff(text))
    last = len(step)
    # Equal neighbours take the type of the next unequal pair.
    place = np.where(step != 0, np.arange(last), last)
    following = np.minimum.accumulate(place[::-1])[::-1]
    types = np.ones(len(text), bool)
    known = following < last
    types[:-1][known] = step[following[known]] > 0
    return types


def _induced(text: np.ndarray, letters: int) -> np.ndarray:
    if letters > _BUCKETWISE:
        return np.array(_induced_one_by_one(text.tolist(), letters), np.int64)
    types = _smaller_types(text)
    leftmost = np.flatnonzero(types[1:] & ~types[:-1]) + 1
    if len(leftmost) == 1:
        return _induce(text, types, leftmost, letters)
    roughly = _induce(text, types, leftmost, letters)
    is_leftmost = np.zeros(len(text), bool)
    is_leftmost[leftmost] = True
    ordered = roughly[is_leftmost[roughly]]
    names = _names(text, leftmost, ordered)
    count = int(names.max()) + 1
    if count == len(leftmost):
        order = np.argsort(names)
    else:
        order = _induced(names, count)
    return _induce(text, types, leftmost[order], letters)


def _names(text: np.ndarray, leftmost: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """The rank of each substring between leftmost-smaller positions, in text order."""
    length = np.zeros(len(text), np.int64)
    length[leftmost] = np.append(np.diff(leftmost), 0) + 1
    one, two = ordered[:-1], ordered[1:]
    same = length[one] == length[two]
    left = np.flatnonzero(same)
    depth = 0
    while len(left):
        left = left[depth < length[one[left]]]
        equal = text[one[left] + depth] == text[two[left] + depth]
        same[left[~equal]] = False
        left = left[equal]
        depth += 1
    rank = np.zeros(len(text), np.int64)
    rank[ordered] = np.concatenate([[0], np.cumsum(~same)])
    return rank[leftmost]


def _induce(
    text: np.ndarray, types: np.ndarray, leftmost: np.ndarray, letters: int
) -> np.ndarray:
    """Induce the order of all suffixes from that of the leftmost-smaller ones."""
    sizes = np.bincount(text, minlength=letters)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    larger = np.bincount(text[~types], minlength=letters)
    array = np.full(len(text), -1, np.int64)

    first = text[leftmost]
    order = np.argsort(first, kind="stable")
    counts = np.bincount(first, minlength=letters)
    before = np.cumsum(counts) - counts
    array[(ends - counts)[first[order]] + np.arange(len(first)) - before[first[order]]] = leftmost[
        order
    ]

    heads = starts.copy()

    def pass_on(batch: np.ndarray, slots: np.ndarray, smaller: bool, step: int) -> None:
        previous = batch[batch > 0] - 1
        previous = previous[types[previous] == smaller]
        if len(previous) == 0:
            return
        letter = text[previous]
        by = np.argsort(letter, kind="stable")
        letter = letter[by]
        found = np.bincount(letter, minlength=letters)
        nth = np.arange(len(letter)) - (np.cumsum(found) - found)[letter]
        if step > 0:
            array[slots[letter] + nth] = previous[by]
        else:
            array[slots[letter] - 1 - nth] = previous[by]
        slots += step * found

    present = np.flatnonzero(sizes)
    for letter in present:
        done = starts[letter]
        while done < heads[letter]:
            batch = array[done : heads[letter]]
            done = heads[letter]
            pass_on(batch, heads, False, 1)
        if counts[letter]:
            pass_on(array[ends[letter] - counts[letter] : ends[letter]], heads, False, 1)

    tails = ends.copy()
    for letter in present[::-1]:
        done = ends[letter]
        while done > tails[letter]:
            batch = array[tails[letter] : done][::-1]
            done = tails[letter]
            pass_on(batch, tails, True, -1)
        if larger[letter]:
            pass_on(
                array[starts[letter] : starts[letter] + larger[letter]][::-1], tails, True, -1
            )
    array[0] = len(text) - 1
    return array


def _induced_one_by_one(text: list[int], letters: int) -> list[int]:
    """The same for many letters; the text ends with its only 0."""
    size = len(text)
    if size == 1:
        return [0]
    types = _smaller_types(np.array(text)).tolist()
    sizes = np.bincount(text, minlength=letters)
    ends = np.cumsum(sizes).tolist()
    starts = (np.cumsum(sizes) - sizes).tolist()
    leftmost = [i for i in range(1, size) if types[i] and not types[i - 1]]

    def induce(sorted_leftmost: list[int]) -> list[int]:
        array = [-1] * size
        slots = ends.copy()
        for i in reversed(sorted_leftmost):
            slots[text[i]] -= 1
            array[slots[text[i]]] = i
        slots = starts.copy()
        for at in array:  # grows rightwards while it is scanned
            if at > 0 and not types[at - 1]:
                letter = text[at - 1]
                array[slots[letter]] = at - 1
                slots[letter] += 1
        slots = ends.copy()
        for k in range(size - 1, -1, -1):
            at = array[k]
            if at > 0 and types[at - 1]:
                letter = text[at - 1]
                slots[letter] -= 1
                array[slots[letter]] = at - 1
        return array

    if len(leftmost) == 1:
        return induce(leftmost)
    ordered = [i for i in induce(leftmost) if i > 0 and types[i] and not types[i - 1]]
    names = _names(np.array(text), np.array(leftmost), np.array(ordered))
    count = int(names.max()) + 1
    if count == len(leftmost):
        order = np.argsort(names).tolist()
    else:
        order = _induced(names, count).tolist()
    return induce([leftmost[i] for i in order])


def common_prefixes(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """For each suffix in sorted order, what it shares with the one before it.

    Permuted common prefixes: in text order the value drops by at most one from each position to the
    next, and by exactly one where the letters before both suffixes agree. Only the others are
    compared letter by letter, all of them side by side.
    """
    size = len(array)
    before = np.full(size, -1, np.int64)
    before[array[1:]] = array[:-1]
    at = np.arange(size)
    fresh = (before <= 0) | (at == 0)
    inner = ~fresh
    fresh[inner] = text[at[inner] - 1] != text[before[inner] - 1]
    # A suffix whose predecessor has none before it starts anew as well.
    fresh[1:] |= before[:-1] < 0
    left = np.flatnonzero(fresh & (before >= 0))
    found = np.zeros(size, np.int64)
    depth = 0
    while len(left):
        inside = (left + depth < size) & (before[left] + depth < size)
        left = left[inside]
        equal = text[left + depth] == text[before[left] + depth]
        left = left[equal]
        depth += 1
        found[left] = depth
    reach = np.where(fresh, found + at, 0)
    permuted = np.maximum.accumulate(reach) - at
    permuted[before < 0] = 0
    return permuted[array]
