"""Suffix arrays by grouping: linear-time construction over Lyndon prefixes, and what is read off them."""

from __future__ import annotations


def suffix_array(s: list[int]) -> list[int]:
    """Start positions of the suffixes of ``s`` in ascending order.

    First all suffixes are put into groups of equal Lyndon prefixes: groups are taken in
    descending order, every member finds the previous smaller suffix, and a suffix that is
    found k times is extended by k copies of the group's prefix, so it leaves its group for a
    later one, the further back the larger k.  Then the groups' order is emitted: the suffixes of a group are
    ordered as their next smaller suffixes are, which come earlier; nothing is renamed or sorted again.
    """
    n = len(s)
    at = sorted(range(n), key=s.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * (n + 1)
    first = 0
    for x, i in enumerate(at):
        if s[i] != s[at[first]]:
            first = x
        place[i], group[i] = x, first
        size[first] += 1
    previous = [-1] * n
    end = n
    while end > 0:
        start = group[at[end - 1]]
        found: dict[int, int] = {}
        members = at[start:end]
        if end - start > 1:
            members.sort()
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                found[j] = found.get(j, 0) + 1
        by_count: dict[int, list[int]] = {}
        for j, k in found.items():
            by_count.setdefault(k, []).append(j)
        for k in sorted(by_count, reverse=True):
            left: dict[int, list[int]] = {}
            for j in by_count[k]:
                g = group[j]
                size[g] -= 1
                last = g + size[g]
                other, x = at[last], place[j]
                at[x], at[last] = other, j
                place[other], place[j] = x, last
                left.setdefault(g, []).append(j)
            for g, moved in left.items():
                fresh = g + size[g]
                if fresh != g:
                    for j in moved:
                        group[j] = fresh
                size[fresh] = len(moved)
        end = start
    out, filled, done = [0] * (n + 1), [0] * (n + 1), bytearray(n)
    out[0] = n
    for x in range(n + 1):
        j = out[x] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[1 + g + filled[g]] = j
            filled[g] += 1
            done[j] = 1
            j = previous[j]
    return out[1:]


def common_prefixes(s: list[int], order: list[int]) -> list[int]:
    """For each place in ``order`` the length of the common prefix with the suffix before it (0 for the first)."""
    n = len(s)
    rank = [0] * n
    for x, i in enumerate(order):
        rank[i] = x
    lcp, h = [0] * n, 0
    for i in range(n):
        x = rank[i]
        if x == 0:
            h = 0
            continue
        j = order[x - 1]
        while i + h < n and j + h < n and s[i + h] == s[j + h]:
            h += 1
        lcp[x] = h
        if h:
            h -= 1
    return lcp


def repeated_starts(strings: list[bytes], starts: list[int], length: int, cores: list[tuple[int, int]] | None = None) -> list[list[bool]]:
    """For each string which of its first ``starts[k]`` positions begin ``length`` letters that another of these positions also begins.

    The strings are one text with a separator of its own after each, so no match crosses two of them.  With ``cores``, the bytes
    [start, end) of each string are the same in all of them and count as one letter; positions lie before them or at their start.
    """
    m = len(strings)
    text: list[int] = []
    owner: list[tuple[int, int]] = []
    for k, b in enumerate(strings):
        letters = [x + m for x in b]
        if cores is not None:
            letters[cores[k][0]:cores[k][1]] = [m + 256]
        text += letters
        text.append(k)
        owner += [(k, x) for x in range(len(letters) + 1)]
    order = suffix_array(text)
    lcp = common_prefixes(text, order)
    out = [[False] * n for n in starts]
    last, least = None, 0
    for x, i in enumerate(order):
        least = min(least, lcp[x])
        k, offset = owner[i]
        if offset < starts[k]:
            if last is not None and least >= length:
                out[k][offset] = out[last[0]][last[1]] = True
            last, least = (k, offset), len(text)
    return out
