"""Suffix arrays by induced sorting, and longest common prefixes in text order.

Over a small alphabet (bytes) a whole bucket is induced at once by array operations: what a bucket
holds is known when its turn comes, but for what its own members induce into it, which follows in
waves. The recursion ends at a reduced text of names with a large alphabet: there the suffixes, which separators
end within a slice or two, are ranked by doubling.
"""

from __future__ import annotations

import numpy as np

_BUCKETS_AT_ONCE = 1024          # up to so many symbols, buckets are worked on as arrays


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. `text`: small non-negative integers; its last symbol is 0 and occurs only there."""
    n = len(text)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    size = int(text.max()) + 1
    if size > _BUCKETS_AT_ONCE and size > n // 64:
        return _by_doubling(text)
    small = _smaller(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    order = _induced(text, small, lms, size)                       # sorts the leftmost-smaller substrings
    marked = np.zeros(n, bool)
    marked[lms] = True
    by_substring = order[marked[order]]
    names, distinct = _named(text, by_substring, lms)
    if distinct < len(lms):
        by_substring = lms[suffix_array(names)]                    # equal substrings are told apart by what follows
    return _induced(text, small, by_substring, size)


def _smaller(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one."""
    n = len(text)
    differs = text[:-1] != text[1:]
    at = np.where(differs, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]              # the next place where neighbours differ
    small = np.ones(n, bool)
    small[:-1] = text[following] < text[following + 1]
    return small


def _dealt(places: np.ndarray, symbols: np.ndarray, to: list[list[np.ndarray]]) -> None:
    """Append places to the buckets of their symbols, in order."""
    order = np.argsort(symbols, kind="stable")
    places, symbols = places[order], symbols[order]
    cuts = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    starts = [0, *cuts.tolist(), len(places)]
    for s, e in zip(starts[:-1], starts[1:], strict=True):
        to[int(symbols[s])].append(places[s:e])


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _induced(text: np.ndarray, small: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """All suffixes, induced from the leftmost-smaller ones as ordered in `lms` (within equal first symbols)."""
    n = len(text)
    seeds: list[list[np.ndarray]] = [[] for _ in range(size)]
    _dealt(lms, text[lms], seeds)
    larger: list[list[np.ndarray]] = [[] for _ in range(size)]
    done_larger: list[np.ndarray] = []
    for symbol in range(size):
        own, sent = [], []
        wave = _joined(larger[symbol])
        while len(wave):
            own.append(wave)
            before = wave[wave > 0] - 1
            before = before[~small[before]]
            symbols = text[before]
            here = symbols == symbol
            sent.append(before[~here])
            wave = before[here]
        for part in seeds[symbol]:
            sent.append(part - 1)
        places = _joined(sent)
        if len(places):
            _dealt(places, text[places], larger)
        done_larger.append(_joined(own))
    smaller: list[list[np.ndarray]] = [[] for _ in range(size)]
    smaller[0].append(np.array([n - 1]))
    done_smaller: list[np.ndarray] = [np.zeros(0, np.int64)] * size
    for symbol in range(size - 1, -1, -1):                         # from the largest down, each bucket from its end
        own, sent = [], []
        wave = _joined(smaller[symbol])
        while len(wave):
            own.append(wave)
            before = wave[wave > 0] - 1
            before = before[small[before]]
            symbols = text[before]
            here = symbols == symbol
            sent.append(before[~here])
            wave = before[here]
        rest = done_larger[symbol][::-1]
        before = rest[rest > 0] - 1
        sent.append(before[small[before]])
        places = _joined(sent)
        if len(places):
            _dealt(places, text[places], smaller)
        done_smaller[symbol] = _joined(own)
    return np.concatenate([x for s in range(size) for x in (done_larger[s], done_smaller[s][::-1])])


def _named(text: np.ndarray, by_substring: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """(the text of names, in text order; number of names). Neighbours in order with equal substrings share a name."""
    length = np.zeros(len(text), np.int64)
    length[lms] = np.r_[lms[1:] - lms[:-1] + 1, 1]
    first, second = by_substring[:-1], by_substring[1:]
    same = length[first] == length[second]
    open_ = np.flatnonzero(same)
    step = 0
    while len(open_):                                              # symbol by symbol, those that are still equal
        equal = text[first[open_] + step] == text[second[open_] + step]
        same[open_[~equal]] = False
        step += 1
        open_ = open_[equal]
        open_ = open_[length[first[open_]] > step]
    names = np.zeros(len(text), np.int64)
    names[by_substring] = np.r_[0, np.cumsum(~same)]
    return names[lms], int(names[by_substring[-1]]) + 1


def _by_doubling(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, for a large alphabet. The last symbol occurs only there.

    The end of the recursion: suffixes that begin with equal symbols are told apart by the ranks of what follows, 1, 2, 4, ...
    symbols on, and only those still equal are sorted again. Separators end what slices have in common, so few rounds do."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    first = np.flatnonzero(np.r_[True, text[order][1:] != text[order][:-1]])
    size = np.diff(np.r_[first, n])
    rank[order] = np.repeat(first, size)
    at = np.repeat(first, size)[np.repeat(size, size) > 1]          # where groups that are still equal begin, for each member
    places = np.flatnonzero(np.repeat(size, size) > 1)             # the members' places in the order
    step = 1
    while len(places):
        members = order[places]
        then = rank[np.minimum(members + step, n - 1)]             # of equal suffixes none ends here: the last symbol is alone
        new_order = np.lexsort((then, at))
        members, then = members[new_order], then[new_order]
        order[places] = members
        new = np.r_[True, (at[1:] != at[:-1]) | (then[1:] != then[:-1])]
        begin = np.flatnonzero(new)
        size = np.diff(np.r_[begin, len(places)])
        group = np.repeat(places[begin], size)
        rank[members] = group
        open_ = np.repeat(size, size) > 1
        at, places = group[open_], places[open_]
        step *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """In text order: how many symbols each suffix shares with the one before it in `order`.

    Only where the symbols before both suffixes differ are prefixes compared; elsewhere the value
    is the preceding suffix's less one.
    """
    n = len(text)
    previous = np.full(n, -1, np.int64)
    previous[order[1:]] = order[:-1]
    at = np.arange(n)
    has = previous >= 0
    derived = has & (at > 0) & (previous > 0)
    derived[derived] = text[at[derived] - 1] == text[previous[derived] - 1]
    open_ = np.flatnonzero(has & ~derived)
    shared = np.zeros(n, np.int64)
    padded = np.r_[text.astype(np.uint64), np.zeros(4, np.uint64)]
    packed = padded[:n] | padded[1:n + 1] << np.uint64(16) | padded[2:n + 2] << np.uint64(32) | padded[3:n + 3] << np.uint64(48)
    one, two = open_.copy(), previous[open_]
    while len(open_):                                              # four symbols at a time
        differs = packed[one] ^ packed[two]
        equal = differs == 0
        lowest = differs & (~differs + np.uint64(1))
        same = np.where(equal, 4, np.where(lowest < np.uint64(1 << 16), 0, np.where(lowest < np.uint64(1 << 32), 1, np.where(lowest < np.uint64(1 << 48), 2, 3))))
        shared[open_] += same
        open_, one, two = open_[equal], one[equal] + 4, two[equal] + 4
        inside = (one < n) & (two < n)
        open_, one, two = open_[inside], one[inside], two[inside]
    reach = np.where(has & ~derived, shared + at, -1)
    return np.where(has, np.maximum(np.maximum.accumulate(reach) - at, 0), 0)
