"""Suffix arrays by induced sorting, and common prefixes by span hashes, over arrays of small numbers.

Suffixes are classified as smaller or larger than their successor. Where a smaller one
follows a larger one (leftmost smaller), a substring begins. Sorting these substrings
sorts everything: each other suffix differs by one symbol from its successor, so one
pass over the symbols in ascending order places the larger ones and one in descending
order the smaller ones. A pass takes all suffixes of one symbol at a time.
"""

from __future__ import annotations

import numpy as np

from granary.llm import texts


def _types(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is smaller than the next one, and the leftmost smaller positions.

    The last suffix counts as smaller: a symbol below all others is thought to follow it
    nowhere, so `text` has to end in its one and only smallest symbol.
    """
    n = len(text)
    changes = text[:-1] != text[1:]
    differs = np.flatnonzero(changes)
    following = np.concatenate([[0], np.cumsum(changes)])
    smaller = np.ones(n, dtype=bool)
    inner = following < len(differs)
    at = differs[following[inner]]
    smaller[inner] = text[at] < text[at + 1]
    return smaller, np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


class _Buckets:
    """Suffixes of each symbol, filled from the front by larger ones and from the back by smaller ones."""

    def __init__(self, text: np.ndarray):
        self.text = text
        sizes = np.bincount(text)
        self.symbols = np.flatnonzero(sizes)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.order = np.full(len(text), -1, dtype=np.int64)

    def put(self, positions: np.ndarray, fill: np.ndarray, step: int) -> None:
        """Append positions to the buckets of their symbols, in the order given."""
        if not len(positions):
            return
        symbols = self.text[positions]
        by = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[by]
        new = np.ones(len(by), dtype=bool)
        new[1:] = sorted_symbols[1:] != sorted_symbols[:-1]
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(by)))
        within = np.arange(len(by)) - np.repeat(first, counts)
        self.order[fill[sorted_symbols] + step * within] = positions[by]
        fill[sorted_symbols[first]] += step * counts


def _induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from the order of the leftmost smaller ones."""
    buckets = _Buckets(text)
    order, starts = buckets.order, buckets.starts
    tail = starts[1:] - 1
    seeded = seeds[np.argsort(text[seeds], kind="stable")]
    seed_at = np.searchsorted(text[seeded], np.arange(len(starts)))
    head = starts[:-1].copy()
    for symbol in buckets.symbols:
        low, done = starts[symbol], starts[symbol]
        # Larger suffixes whose predecessor has the same symbol add to this bucket as it is read.
        while done < head[symbol]:
            before = order[done : head[symbol]] - 1
            done = head[symbol]
            before = before[before >= 0]
            before = before[(text[before] == symbol) & ~smaller[before]]
            buckets.put(before, head, 1)
        reached = np.concatenate([order[low : head[symbol]], seeded[seed_at[symbol] : seed_at[symbol + 1]]]) - 1
        reached = reached[reached >= 0]
        buckets.put(reached[(text[reached] > symbol) & ~smaller[reached]], head, 1)
    end = tail.copy()
    for symbol in buckets.symbols[::-1]:
        done = tail[symbol]
        # Smaller suffixes whose predecessor has the same symbol add to this bucket from the back.
        while done > end[symbol]:
            before = order[end[symbol] + 1 : done + 1][::-1] - 1
            done = end[symbol]
            before = before[before >= 0]
            before = before[(text[before] == symbol) & smaller[before]]
            buckets.put(before, end, -1)
        placed = order[end[symbol] + 1 : tail[symbol] + 1][::-1]
        reached = np.concatenate([placed, order[starts[symbol] : head[symbol]][::-1]]) - 1
        reached = reached[reached >= 0]
        buckets.put(reached[(text[reached] < symbol) & smaller[reached]], end, -1)
    order[0] = len(text) - 1
    return order


def _ranked(names: np.ndarray) -> np.ndarray:
    """The order of all suffixes of a string of names: pairs of names are ranked, then pairs of pairs.

    Only places that still share their rank with others are sorted again.
    """
    n, reach = len(names), 1
    counts = np.bincount(names)
    rank = (np.cumsum(counts) - counts)[names]
    tied = np.flatnonzero(counts[names] > 1)
    while len(tied):
        after = tied + reach
        second = np.zeros(len(tied), dtype=np.int64)
        inside = after < n
        second[inside] = rank[after[inside]] + 1
        pairs = rank[tied] * (n + 1) + second
        order = np.argsort(pairs)
        tied, pairs = tied[order], pairs[order]
        own = rank[tied]
        place = np.arange(len(tied))
        new = np.ones(len(tied), dtype=bool)
        new[1:] = pairs[1:] != pairs[:-1]
        group = np.ones(len(tied), dtype=bool)
        group[1:] = own[1:] != own[:-1]
        first = np.maximum.accumulate(np.where(new, place, 0))
        rank[tied] = own + first - np.maximum.accumulate(np.where(group, place, 0))
        alone = new & np.append(new[1:], True)
        tied = tied[~alone]
        reach *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order


def suffix_array(text: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in ascending order.

    `text` ends in 0, which stands nowhere else; `total` are its prefix sums for span hashes.
    """
    if len(text) < 2:
        return np.arange(len(text))
    smaller, leftmost = _types(text)
    order = _induce(text, smaller, leftmost)
    is_leftmost = np.zeros(len(text), dtype=bool)
    is_leftmost[leftmost] = True
    substrings = order[is_leftmost[order]]
    ends = np.minimum(np.append(leftmost[1:], len(text) - 1) + 1, len(text))
    end_of = np.zeros(len(text), dtype=np.int64)
    end_of[leftmost] = ends
    hashes = texts.span_hashes(total, substrings, end_of[substrings])
    names = np.zeros(len(text), dtype=np.int64)
    names[substrings] = np.cumsum(np.append(False, hashes[1:] != hashes[:-1]))
    return _induce(text, smaller, leftmost[_ranked(names[leftmost])])


def common_prefixes(total: np.ndarray, positions: np.ndarray, limit: int) -> np.ndarray:
    """For each of some suffixes in ascending order, what it shares with the one before, up to `limit`."""
    shared = np.zeros(len(positions), dtype=np.int64)
    here, before = positions[1:], positions[:-1]
    longest = len(total) - 1 - np.maximum(here, before)
    found = np.zeros(len(here), dtype=np.int64)
    step = 1 << max(0, int(limit).bit_length() - 1)
    while step:
        fits = np.flatnonzero((found + step <= longest) & (found + step <= limit))
        a, b = here[fits] + found[fits], before[fits] + found[fits]
        same = texts.span_hashes(total, a, a + step) == texts.span_hashes(total, b, b + step)
        found[fits[same]] += step
        step >>= 1
    shared[1:] = found
    return shared
