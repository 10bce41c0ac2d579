"""Suffix order by linear grouping: groups of equal Lyndon prefixes, processed from the greatest down."""


def lyndon_groups(symbols: list):
    """(order by group, first place of each suffix's group, previous smaller pointers).

    Suffixes start grouped by their first symbol. The groups are taken in descending order; the pointer of a suffix leads to
    the nearest suffix before it in a lower group. The suffixes pointed to have their Lyndon prefix extended by the group's, as often as
    they are pointed to, and move to the end of their own group as groups of their own, the more extended the higher.
    """
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    place, link, size, prev = [0] * n, [0] * n, [0] * (n + 1), [-1] * n
    first = 0
    for at, i in enumerate(order):
        if symbols[i] != symbols[order[first]]:
            first = at
        place[i], link[i] = at, first
        size[first] += 1
    end = n - 1
    while end >= 0:
        group = link[order[end]]
        pointed = {}
        for i in sorted(order[group:end + 1]) if end > group else order[end:end + 1]:
            p = i - 1
            while p >= 0 and link[p] >= group:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        by_count = {}
        for p, times in pointed.items():
            by_count.setdefault(times, []).append(p)
        for times in sorted(by_count, reverse=True):
            own = {}
            for p in by_count[times]:
                h = link[p]
                size[h] -= 1
                last, at = h + size[h], place[p]
                other = order[last]
                order[at], place[other], order[last], place[p] = other, at, p, last
                own[h] = own.get(h, 0) + 1
            moved = {h: h + size[h] for h in own}
            for p in by_count[times]:
                link[p] = moved[link[p]]
            for h, count in own.items():
                size[moved[h]] = count
        end = group - 1
    return order, link, prev


def suffix_order(symbols: list) -> list:
    """All suffixes of a list of integers in order; the last symbol must be unique and the smallest.

    Suffixes are emitted from the smallest on: the suffix before an emitted one, and those its pointers lead to, take
    the next free place of their groups.
    """
    n = len(symbols)
    if n < 2:
        return list(range(n))
    _, link, prev = lyndon_groups(symbols)
    out, placed, free = [-1] * n, [False] * n, list(range(n + 1))
    out[0], placed[n - 1] = n - 1, True
    for at in range(n):
        p = out[at] - 1
        while p >= 0 and not placed[p]:
            group = link[p]
            out[free[group]], placed[p] = p, True
            free[group] += 1
            p = prev[p]
    return out
