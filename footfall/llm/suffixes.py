"""Suffix arrays by grouping suffixes on their Lyndon prefixes.

Phase one puts suffixes into groups, first by their first symbol. Groups are taken in descending
order. For each suffix of a group the pointer to the nearest suffix to the left that is in a
lower group is found; what these pointers reach is prolonged by the group's own prefix and
so moves to new groups right after its old one: the most often reached first, those from one
group together. In the end a group holds the suffixes with one Lyndon prefix. Phase two
goes through the array from its smallest suffix and puts the left neighbour, and what its
chain of pointers reaches, at the front of their groups. No step names substrings anew or recurses.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes in ascending order; a suffix is smaller than its extensions."""
    size = len(text)
    if size == 0:
        return []
    # An end mark below all symbols takes place 0.
    symbols = [*(s + 1 for s in text), 0]
    size += 1
    order, group, room = _by_first_symbol(symbols)
    before = _group_by_lyndon_prefix(order, group, room)
    return _emit(group, before, size)[1:]


def _by_first_symbol(symbols: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffixes by first symbol; each suffix's group, named by its first place; group sizes."""
    order = sorted(range(len(symbols)), key=symbols.__getitem__)
    group, room = [0] * len(symbols), [0] * len(symbols)
    first, held = 0, -1
    for place, suffix in enumerate(order):
        if symbols[suffix] != held:
            first, held = place, symbols[suffix]
        group[suffix] = first
        room[first] += 1
    return order, group, room


def _group_by_lyndon_prefix(order: list[int], group: list[int], room: list[int]) -> list[int]:
    """Refine the groups in place; gives the previous-smaller pointer of each suffix."""
    place = [0] * len(order)
    for at, suffix in enumerate(order):
        place[suffix] = at
    before = [-1] * len(order)
    high = len(order)
    while high:
        low = group[order[high - 1]]
        if high - low == 1:
            suffix = order[low]
            target = suffix - 1
            while target >= 0 and group[target] >= low:
                target = before[target]
            before[suffix] = target
            if target >= 0:
                own = group[target]
                count = room[own]
                if count > 1:  # goes to the last place of its group, a group of its own
                    last = own + count - 1
                    at = place[target]
                    other = order[last]
                    order[at], place[other] = other, at
                    order[last], place[target] = target, last
                    group[target] = last
                    room[own] = count - 1
                    room[last] = 1
        else:
            reached: dict[int, int] = {}
            for suffix in sorted(order[low:high]):
                target = suffix - 1
                while target >= 0 and group[target] >= low:
                    target = before[target]
                before[suffix] = target
                if target >= 0:
                    reached[target] = reached.get(target, 0) + 1
            by_count: dict[int, dict[int, list[int]]] = {}
            for target, count in reached.items():
                by_count.setdefault(count, {}).setdefault(group[target], []).append(target)
            for count in sorted(by_count, reverse=True):
                for own, targets in by_count[count].items():
                    left = room[own] - len(targets)
                    if not left:
                        continue
                    fresh = last = own + room[own] - 1
                    for target in targets:
                        at, other = place[target], order[last]
                        order[at], place[other] = other, at
                        order[last], place[target] = target, last
                        last -= 1
                    fresh = own + left
                    for target in targets:
                        group[target] = fresh
                    room[own], room[fresh] = left, len(targets)
        high = low
    return before


def _emit(group: list[int], before: list[int], size: int) -> list[int]:
    """Place every suffix at the front of its group, in the order in which it is reached."""
    out = [-1] * size
    out[0] = size - 1
    front = list(range(size))
    placed = bytearray(size)
    placed[size - 1] = 1
    for at in range(size):
        suffix = out[at] - 1
        while suffix >= 0 and not placed[suffix]:
            own = group[suffix]
            out[front[own]] = suffix
            front[own] += 1
            placed[suffix] = 1
            suffix = before[suffix]
    return out
