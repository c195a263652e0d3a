"""Bin completion: branch and bound over a table of lengths and their counts.

Items of one length are alike, so a packing is a list of runs: a filling and the number of bins
that hold it. The work depends on the number of different lengths, at most the capacity,
and not on the number of items.

The first incumbent is the best-fit packing. The search takes the largest length left,
enumerates undominated fillings around it, gives as many bins as possible (or a single one)
to a filling, and goes back as soon as the waste so far leaves no packing of the asked size. The
asked sizes halve the gap between the lower bound and the incumbent, which every packing that
is found replaces, until the two meet or the steps are used up.
"""
from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np

#: Nodes of all searches together.
STEPS = 30_000
FILLINGS = 12
LOOKS = 160
SHARES = 6

Filling = tuple[tuple[int, int], ...]
Run = tuple[Filling, int]


def bins(runs: list[Run]) -> int:
    return sum(times for _, times in runs)


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """The best of the lower bounds by dual feasible functions.

    Lengths below a cut count nothing and those above ``capacity - cut`` a whole bin; what
    is left is rounded to so many ``1 / share`` that no bin can hold more than ``share``.
    """
    lengths = np.array(sorted(counts), np.int64)
    number = np.array([counts[n] for n in lengths.tolist()], np.float64)
    best = 0
    for cut in [0, *lengths[2 * lengths <= capacity].tolist()]:
        value = np.where(lengths > capacity - cut, capacity, np.where(lengths < cut, 0, lengths))
        for share in range(SHARES + 1):
            part = value / capacity if not share else np.where(
                (share + 1) * value % capacity == 0, value / capacity,
                (share + 1) * value // capacity / share)
            volume = float(part @ number)
            best = max(best, math.ceil(volume - 1e-9 * max(1.0, volume)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best fit over falling lengths; bins that look alike are kept as one group."""
    groups: dict[int, list[tuple[Filling, int]]] = {}
    rooms: list[int] = []

    def put(room: int, filling: Filling, times: int) -> None:
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append((filling, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                full, over = divmod(left, each)
                if full:
                    put(capacity - each * length, ((length, each),), full)
                if over:
                    put(capacity - over * length, ((length, over),), 1)
                break
            room = rooms[at]
            filling, times = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[at]
            each = min(room // length, left)
            used = min(times, left // each)
            put(room - each * length, (*filling, (length, each)), used)
            if times > used:
                put(room, filling, times - used)
            left -= used * each
    return [run for room in sorted(groups) for run in groups[room]]


class Stock:
    """What is left of every length, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {n: c for n, c in counts.items() if c}
        self.lengths = sorted(self.counts)

    def take(self, filling: Filling, times: int) -> None:
        for length, use in filling:
            self.counts[length] -= use * times
            if not self.counts[length]:
                del self.counts[length]
                del self.lengths[bisect_left(self.lengths, length)]

    def give(self, filling: Filling, times: int) -> None:
        for length, use in filling:
            if length not in self.counts:
                self.counts[length] = 0
                insort(self.lengths, length)
            self.counts[length] += use * times

    def times(self, filling: Filling) -> int:
        return min(self.counts[length] // use for length, use in filling)


def fillings(stock: Stock, capacity: int, most_waste: int) -> list[tuple[int, Filling]]:
    """Undominated fillings around the largest length, those of least waste and fewest items first."""
    first = stock.lengths[-1]
    found: list[tuple[int, int, Filling]] = []
    seen: set[Filling] = set()
    looks = exact = 0
    stack: list[tuple[int, int, Filling]] = [(capacity - first, first, ((first, 1),))]
    while stack and looks < LOOKS and exact < FILLINGS:
        room, top, used = stack.pop()
        looks += 1
        at = bisect_right(stock.lengths, min(room, top)) - 1
        own = dict(used)
        while at >= 0 and own.get(stock.lengths[at], 0) >= stock.counts[stock.lengths[at]]:
            at -= 1
        if at < 0:
            if room <= most_waste and used not in seen and not dominated(stock, used, own, room):
                seen.add(used)
                exact += room == 0
                found.append((room, sum(u for _, u in used), used))
            continue
        length = stock.lengths[at]
        if at:
            stack.append((room, stock.lengths[at - 1], used))
        stack.append((room - length, length, (*used[:-1], (length, own[length] + 1))
                      if length in own else (*used, (length, 1))))
    found.sort(key=lambda f: f[:2])
    return [(waste, used) for waste, _, used in found[:FILLINGS]]


def dominated(stock: Stock, used: Filling, own: dict[int, int], room: int) -> bool:
    """True if an unused length could stand for one or two of the used ones and waste less,
    or still fits beside them."""
    def unused(low: int, high: int) -> bool:
        for at in range(bisect_right(stock.lengths, low), bisect_right(stock.lengths, high)):
            n = stock.lengths[at]
            if stock.counts[n] > own.get(n, 0):
                return True
        return False

    if unused(0, room):
        return True
    if not room:
        return False
    rest = [n for n, u in used[1:] for _ in range(min(u, 2))]
    if used[0][1] > 1:
        rest.insert(0, used[0][0])
    if any(unused(n, n + room) for n in set(rest)):
        return True
    pairs = {a + b for i, a in enumerate(rest[:12]) for b in rest[i + 1:12]}
    return any(unused(s - 1, s + room) for s in pairs)


def moves(stock: Stock, capacity: int, spare: int) -> Iterator[tuple[int, Filling, int]]:
    """Waste, filling and number of bins: all that are possible, then a single one."""
    for waste, filling in fillings(stock, capacity, spare):
        most = stock.times(filling)
        if waste:
            most = min(most, spare // waste)
        for times in dict.fromkeys((most, 1)):
            yield waste * times, filling, times


def completed(counts: dict[int, int], capacity: int, size: int, steps: int) -> list[Run] | None:
    """A packing of at most ``size`` bins, None if none was found within ``steps`` nodes."""
    stock = Stock(counts)
    spare = size * capacity - sum(n * c for n, c in counts.items())
    if spare < 0:
        return None
    runs: list[Run] = []
    wasted: list[int] = []
    open_ = [moves(stock, capacity, spare)]
    for _ in range(steps):
        step = next(open_[-1], None)
        if step is None:
            open_.pop()
            if not open_:
                return None
            stock.give(*runs.pop())
            spare += wasted.pop()
            continue
        waste, filling, times = step
        stock.take(filling, times)
        runs.append((filling, times))
        wasted.append(waste)
        spare -= waste
        if not stock.lengths:
            return runs
        open_.append(moves(stock, capacity, spare))
    return None


def pack(counts: dict[int, int], capacity: int, steps: int = STEPS) -> list[Run]:
    """Runs of the fewest bins that were found for items up to ``capacity`` long."""
    incumbent = best_fit(counts, capacity)
    low = least_bins(counts, capacity)
    while steps > 0 and low < bins(incumbent):
        gap = bins(incumbent) - low
        share = steps // gap.bit_length()
        size = low + (gap - 1) // 2
        better = completed(counts, capacity, size, share)
        steps -= max(share, 1)
        if better is None:
            low = size + 1
        else:
            incumbent = better
    return incumbent
