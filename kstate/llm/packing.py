"""Containers of fixed capacity filled with items of varying length.

Items count only by their length, so the plan of a run is made from its histogram, and everything here works
on runs of equal items and of equal containers: the work grows with the number of different lengths, at
most the capacity, and not with the number of items. Lengths are grouped; shallow combinations of up to
three groups that fill a container to within a window (or to its item limit) become columns; non-negative least
squares finds how often each is to be used against the histogram; the counts are rounded; every use is made
up of exact lengths, the last of which closes the gap; what is left over is packed greedily. Only if greedy packing
of the whole histogram takes fewer containers is that taken instead.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kstate.runtime import cut

#: Groups of lengths at most, whatever the histogram.
GROUPS = 24
#: Ranks are taken within this many parts of a length, so one frequent length never meets in one task.
SALTS = 64
#: Ranks of a length that meet the plan together.
BLOCK = 16
#: What filling in turn keeps free for each open place, in average lengths.
RESERVES = (0.2, 0.3, 0.14, 0.45, 0.08, 0.65, 0.0)
#: A container of a combination is good when it is this full, or has no place left; and the remainder of a count from which it
#: is rounded up. The pair that needs the fewest containers is taken.
ROUNDINGS = ((0.995, 0.05), (0.98, 0.5), (0.998, 0.5), (0.95, 0.05), (0.995, 1.0))

Histogram = dict[int, int]
#: lengths with their numbers in one container, and how many containers are filled so
Filled = tuple[dict[int, int], int]


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Non-negative least squares by an active set: min |a x - b|, x >= 0."""
    n = a.shape[1]
    x = np.zeros(n)
    active = np.zeros(n, dtype=bool)
    at = a.T
    tol = 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(3 * a.shape[0]):
        w = at @ (b - a @ x)
        w[active] = -1
        k = int(np.argmax(w))
        if w[k] <= tol * 1e3:
            break
        active[k] = True
        while True:
            idx = np.flatnonzero(active)
            s = np.linalg.lstsq(a[:, idx], b, rcond=None)[0]
            if (s > 1e-12).all():
                x[:] = 0
                x[idx] = s
                break
            old = x[idx]
            bad = s <= 1e-12
            step = np.min(old[bad] / np.maximum(old[bad] - s[bad], 1e-300))
            x[idx] = old + step * (s - old)
            drop = idx[(x[idx] <= 1e-12)]
            x[drop] = 0
            active[drop] = False
            if not len(drop):
                break
    return x


def combinations_filling(reps: np.ndarray, capacity: int, limit: int, window: int) -> np.ndarray:
    """Columns: how many items of each group (representative lengths, falling) one container takes."""
    g = len(reps)
    r = np.maximum(reps, 0)

    def most(room: np.ndarray, slots: np.ndarray, size: np.ndarray) -> np.ndarray:
        return np.minimum(np.where(size > 0, room // np.maximum(size, 1), slots), slots)

    i, ki, j, part, m = (x.ravel() for x in np.meshgrid(np.arange(g), np.arange(1, 7), np.arange(g), np.arange(1, 4), np.arange(g), indexing="ij"))
    ok = (i <= j) & (j <= m)
    i, ki, j, part, m = i[ok], ki[ok], j[ok], part[ok], m[ok]
    whole = most(np.full(len(i), capacity), np.full(len(i), limit), r[i])
    # one, two or three of the longest group, or a third, two thirds, all of what a container holds of it
    ki = np.where(ki <= 3, ki, whole * (ki - 3) // 3)
    room, slots = capacity - ki * r[i], limit - ki
    ok = (room >= 0) & (slots >= 0) & (ki > 0)
    i, ki, j, part, m, room, slots = (x[ok] for x in (i, ki, j, part, m, room, slots))
    kj = most(room, slots, r[j]) * (part - 1) // 2
    room, slots = room - kj * r[j], slots - kj
    km = most(room, slots, r[m])
    room, slots = room - km * r[m], slots - km
    ok = (room <= window) | (slots == 0)
    cols = np.zeros((int(ok.sum()), g), dtype=np.int64)
    at = np.arange(len(cols))
    for k, n in ((i, ki), (j, kj), (m, km)):
        np.add.at(cols, (at, k[ok]), n[ok])
    return np.unique(cols, axis=0).T


def lower_bound(sizes: list[int], counts: list[int], capacity: int, limit: int) -> int:
    """No packing has fewer containers. A full one leaves room for empty items only."""
    full = sum(c for s, c in zip(sizes, counts) if s == capacity)
    empty = sum(c for s, c in zip(sizes, counts) if s == 0)
    n, total = sum(counts) - full - empty, sum(s * c for s, c in zip(sizes, counts) if s < capacity)
    half = sum(c for s, c in zip(sizes, counts) if 2 * s > capacity)
    return max(full + max(-(-total // capacity), -(-n // limit)), -(-sum(counts) // limit), half)


class Stock:
    """Items left, by length."""

    def __init__(self, h: Histogram) -> None:
        self.left = {s: c for s, c in h.items() if c}
        self.sizes = sorted(self.left)

    def pick(self, used: dict[int, int], most: float, least: float = 0) -> int | None:
        """Longest length in [least, most] of which ``used`` leaves an item."""
        k = bisect_right(self.sizes, most) - 1
        while k >= 0 and self.sizes[k] >= least:
            s = self.sizes[k]
            if self.left[s] > used.get(s, 0):
                return s
            k -= 1
        return None

    def shortest(self, used: dict[int, int], least: float, most: float) -> int | None:
        """Shortest length in [least, most] of which ``used`` leaves an item."""
        for s in self.sizes[bisect_left(self.sizes, least) : bisect_right(self.sizes, most)]:
            if self.left[s] > used.get(s, 0):
                return s
        return None

    def take(self, used: dict[int, int], times: int | None = None) -> int:
        """Takes the items of as many equal containers as there are items for (or at most ``times``)."""
        n = min(self.left[s] // u for s, u in used.items())
        n = n if times is None else min(n, times)
        for s, u in used.items():
            self.left[s] -= n * u
            if not self.left[s]:
                del self.left[s]
                del self.sizes[bisect_left(self.sizes, s)]
        return n


def fill_in_turn(h: Histogram, capacity: int, limit: int, reserve: float) -> list[Filled]:
    """Containers filled one after another, each with the longest item that leaves ``reserve`` for every open place."""
    stock = Stock(h)
    out = []
    while stock.sizes:
        room, slots, used = capacity, limit, {}
        while slots:
            s = stock.pick(used, room - (slots - 1) * reserve)
            if s is None:
                s = stock.pick(used, room) if reserve and not used else stock.shortest(used, 0, room)
                if s is None:
                    break
            n = 1 if reserve else min(stock.left[s] - used.get(s, 0), slots, room // s if s else slots)
            used[s] = used.get(s, 0) + n
            room -= n * s
            slots -= n
        out.append((used, stock.take(used)))
    return out


def spread(h: Histogram, capacity: int, limit: int, bins: int) -> list[Filled] | None:
    """Longest first into the emptiest of a given number of containers; None if an item finds no room."""
    heap: list[tuple[int, int, tuple, int]] = [(-capacity, -limit, (), bins)]
    done: list[tuple[tuple, int]] = []
    for s, c in sorted(h.items(), reverse=True):
        while c:
            if not heap or -heap[0][0] < s:
                return None
            room, slots, own, n = heapq.heappop(heap)
            k = min(n, c)
            c -= k
            if k < n:
                heapq.heappush(heap, (room, slots, own, n - k))
            new = (*own, s)
            if slots + 1 < 0:
                heapq.heappush(heap, (room + s, slots + 1, new, k))
            else:
                done.append((new, k))
    return [({s: own.count(s) for s in own}, n) for own, n in [*done, *((own, n) for _, _, own, n in heap)] if own]


def best_fit(h: Histogram, capacity: int, limit: int) -> list[Filled]:
    """Longest first into the fullest container with room and a free place."""
    open_: list[tuple[int, int, tuple, int]] = []
    done: list[tuple[tuple, int]] = []

    def put(room: int, slots: int, own: tuple, n: int) -> None:
        if n:
            insort(open_, (room, slots, own, n)) if slots else done.append((own, n))

    for s, c in sorted(h.items(), reverse=True):
        while c:
            k = bisect_left(open_, (s,))
            room, slots, own, n = open_.pop(k) if k < len(open_) else (capacity, limit, (), c)
            q = min(room // s if s else slots, slots)
            b = min(n, c // q)
            rest = min(c - b * q, q) if b < n else 0
            put(room - q * s, slots - q, (*own, (s, q)), b)
            if rest:
                put(room - rest * s, slots - rest, (*own, (s, rest)), 1)
            if own:
                put(room, slots, own, n - b - (rest > 0))
            c -= b * q + rest
    return [(dict(own), n) for own, n in [*done, *((own, n) for _, _, own, n in open_)]]


def total(filled: list[Filled]) -> int:
    return sum(n for _, n in filled)


def greedy(h: Histogram, capacity: int, limit: int) -> list[Filled]:
    """The fewest containers of several greedy ways; stops at the lower bound."""
    h = {s: c for s, c in h.items() if c}
    if not h:
        return []
    least = lower_bound(list(h), list(h.values()), capacity, limit)
    mean = sum(s * c for s, c in h.items()) / sum(h.values())
    best = best_fit(h, capacity, limit)
    for part in RESERVES:
        if total(best) <= least:
            return best
        best = min(best, fill_in_turn(h, capacity, limit, mean * part), key=total)
    for b in {least, (least + total(best)) // 2}:
        if b < total(best) and (got := spread(h, capacity, limit, b)) is not None:
            best = got
    return best


def grouped(h: Histogram, capacity: int, limit: int) -> list[tuple[int, int, float, int]]:
    """(shortest, longest, mean length, items) of each group of neighbouring lengths, longest first.

    Groups use up about the same part of the containers, by length or by places; there are about as many as the
    square root of the containers, so that a combination is used several times.
    """
    size = np.array(sorted(h, reverse=True))
    count = np.array([h[int(s)] for s in size])
    share = count * (size / capacity + 1 / limit)
    parts = int(min(GROUPS, len(size), max(3, 2 * (share.sum() / 2) ** 0.5)))
    at = np.minimum((np.cumsum(share) - share / 2) * parts / share.sum(), parts - 1).astype(int)
    out = []
    for k in np.unique(at):
        s, c = size[at == k], count[at == k]
        out.append((int(s[-1]), int(s[0]), float((s * c).sum() / c.sum()), int(c.sum())))
    return out


def combinations_used(h: Histogram, capacity: int, limit: int) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and their numbers of items, the columns, and how often least squares uses each."""
    groups = grouped(h, capacity, limit)
    means = np.array([m for _, _, m, _ in groups])
    have = np.array([n for *_, n in groups], dtype=float)
    reps = np.maximum(np.round(means).astype(np.int64), (means > 0).astype(np.int64))
    cols = combinations_filling(reps, capacity, limit, max(int(reps[reps > 0].min(initial=capacity)) - 1, capacity // 50))
    # what a group weighs is what it takes of a container
    weight = (means / capacity + 1 / limit)[:, None]
    return groups, have, cols, nnls(cols * weight, have * weight[:, 0]) if cols.shape[1] else np.zeros(0)


def combined(h: Histogram, used: tuple, capacity: int, limit: int, fill: float, up: float) -> tuple[list[Filled], Stock]:
    """Containers of the least-squares solution, and what they leave over."""
    groups, have, cols, x = used
    stock = Stock(h)
    times = np.floor(x + 1e-9).astype(np.int64)
    # largest remainders are rounded up as long as items are left
    free = have - cols @ times
    for k in np.argsort(times - x, kind="stable"):
        if x[k] - times[k] >= up and (free >= cols[:, k]).all():
            times[k] += 1
            free -= cols[:, k]
    out: list[Filled] = []
    for k in sorted(np.flatnonzero(times), key=lambda k: (-int(np.flatnonzero(cols[:, k])[0] == 0), -x[k])):
        n = int(times[k])
        while n:
            own = _exact(stock, groups, cols[:, k], capacity, limit, fill)
            if own is None:
                break
            done = stock.take(own, n)
            out.append((own, done))
            n -= done
    return out, stock


def _exact(stock: Stock, groups: list, need: np.ndarray, capacity: int, limit: int, fill: float) -> dict[int, int] | None:
    """One container of a combination in exact lengths: the longest first, then what keeps to the plan, the last one closes the gap."""
    places = [g for g in np.flatnonzero(need) for _ in range(int(need[g]))]
    room, slots, used = capacity, limit, {}
    rest = sum(groups[g][2] for g in places)
    for i, g in enumerate(places):
        lo, hi, mean, _ = groups[g]
        rest -= mean
        want = min(hi if i == 0 else room - rest, room)
        s = stock.pick(used, want, lo)
        if s is None:
            s = stock.shortest(used, max(lo, want), min(hi, room))
            if s is None:
                continue
        used[s] = used.get(s, 0) + 1
        room -= s
        slots -= 1
    while slots and room and (s := stock.pick(used, room, 1)) is not None:
        used[s] = used.get(s, 0) + 1
        room -= s
        slots -= 1
    return used if used and (room <= (1 - fill) * capacity or not slots) else None


def cut_pieces(h: Histogram, capacity: int, piece: int) -> Histogram:
    """Histogram with every length over the capacity divided into pieces of the given length and a rest."""
    out: Histogram = {}
    for s, c in h.items():
        if s > capacity:
            out[piece] = out.get(piece, 0) + c * (s // piece)
            s %= piece
            if not s:
                continue
        out[s] = out.get(s, 0) + c
    return out


def piece_length(h: Histogram, capacity: int, limit: int) -> int:
    """Length of the pieces of what is too long: shorter ones leave room beside them for many short items."""
    if max(h) <= capacity:
        return capacity
    n, all_ = sum(h.values()), sum(s * c for s, c in h.items())
    least = max(-(-all_ // capacity), -(-n // limit))
    best, piece = None, capacity
    for p in (capacity, max(1, capacity * 3 // 4), max(1, capacity // 2)):
        small = cut_pieces(h, capacity, p)
        mean = all_ / sum(small.values())
        got = min(total(fill_in_turn(small, capacity, limit, mean * part)) for part in RESERVES[:3])
        if best is None or got < best:
            best, piece = got, p
        if best <= least:
            break
    return piece


def plan(sizes: np.ndarray, counts: np.ndarray, capacity: int, limit: int) -> tuple[list[tuple[int, int, int, int, int]], int, int]:
    """(size, first rank, last rank + 1, first container, containers), the number of containers, and how many least squares gave.

    Ranks count the items of a size from 0. A row spreads its ranks over its containers in turn. The
    containers of the least-squares solution come first.
    """
    h = {int(s): int(c) for s, c in zip(sizes, counts) if c}
    if not h:
        return [], 0, 0
    least, how = lower_bound(list(h), list(h.values()), capacity, limit), combinations_used(h, capacity, limit)
    filled, solved = None, 0
    for fill, up in ROUNDINGS:
        own, stock = combined(h, how, capacity, limit, fill, up)
        whole = own + greedy(stock.left, capacity, limit)
        if filled is None or (total(whole), -total(own)) < (total(filled), -solved):
            filled, solved = whole, total(own)
        if total(filled) <= least and 2 * solved > least:
            break
    if total(filled) > least and total(plain := greedy(h, capacity, limit)) < total(filled):
        filled, solved = plain, 0
    rows, bins, taken = [], 0, dict.fromkeys(h, 0)
    for own, n in filled:
        for s, u in own.items():
            rows.append((s, taken[s], taken[s] + u * n, bins, n))
            taken[s] += u * n
        bins += n
    return rows, bins, solved


def _planner(t: pa.Table) -> pa.Table:
    h = dict(zip(t["whole"].to_pylist(), t["n"].to_pylist()))
    capacity, limit, run = t["capacity"][0].as_py(), t["slots"][0].as_py(), t["run"][0].as_py()
    cut_at = piece_length(h, capacity, limit)
    h = cut_pieces(h, capacity, cut_at)
    rows, _, solved = plan(np.array(list(h), dtype=np.int64), np.array(list(h.values()), dtype=np.int64), capacity, limit)
    cols = list(zip(*rows)) or [[]] * 5
    out = {"run": pa.array([run] * len(rows), pa.string()), "cut": pa.array([cut_at] * len(rows), pa.int64()), "solved": pa.array([solved] * len(rows), pa.int64())}
    return pa.table(out | {n: pa.array(c, pa.int64()) for n, c in zip(("size", "lo", "hi", "first", "wide"), cols)})


def salted_rank(df: DataFrame, keys: list[str], unique: Column) -> DataFrame:
    """Adds rank: 0, 1, ... within the keys, in no special order; a frequent key is ranked in SALTS parts."""
    d = df.withColumn("salt", F.pmod(F.xxhash64(unique), F.lit(SALTS)).cast("int"))
    inner = d.withColumn("r", F.row_number().over(Window.partitionBy(*keys, "salt").orderBy(unique)) - 1)
    sizes = d.groupBy(*keys, "salt").agg(F.count("*").alias("c"))
    off = sizes.withColumn("off", F.sum("c").over(Window.partitionBy(*keys).orderBy("salt")) - F.col("c")).drop("c")
    return inner.join(off, [*keys, "salt"]).withColumn("rank", F.col("r") + F.col("off")).drop("salt", "r", "off")


def place(ranked: DataFrame, how: DataFrame) -> DataFrame:
    """Adds container to rows (run, size, rank) by plan rows (run, size, lo, hi, first, wide).

    Both sides meet in blocks of BLOCK ranks: a plan row stands once in each block it touches, so a row
    meets at most BLOCK plan rows, however many a length has.
    """
    blocks = F.sequence(F.floor(F.col("lo") / BLOCK), F.floor((F.col("hi") - 1) / BLOCK))
    how = how.select("run", "size", "lo", "hi", "first", "wide", F.explode(blocks).alias("block"))
    met = ranked.withColumn("block", F.floor(F.col("rank") / BLOCK)).join(how, ["run", "size", "block"]).filter("rank >= lo and rank < hi")
    return met.withColumn("container", F.col("first") + F.pmod(F.col("rank") - F.col("lo"), F.col("wide"))).drop("block", "lo", "hi", "first", "wide")


def pack(items: DataFrame, runs: DataFrame) -> DataFrame:
    """(run, item, piece, pieces, start, size, container, solved): every item of every run in a container.

    ``items`` has (bag, item, size), ``runs`` (run, bag, capacity, slots): a run packs the items of its bag. A
    container holds at most capacity of size and slots of pieces; only an item longer than the capacity is
    divided: into pieces of one length a run, chosen so that short items fit beside them, and a rest. Null size counts as 0, an item delivered
    twice once; runs with a null or non-positive limit and items with a null bag or id are left out;
    a run without items has no containers. Containers are numbered from 0 in each run; solved says whether the
    container comes from the least-squares solution or from the greedy rest.
    """
    r = runs.select("run", "bag", "capacity", "slots").filter("run is not null and capacity > 0 and slots > 0").distinct()
    it = items.select("bag", "item", F.coalesce("size", F.lit(0)).cast("long").alias("whole")).filter("bag is not null and item is not null").distinct()
    x = cut(it.join(r, "bag").select("run", "item", "whole", "capacity", "slots"))
    hist = x.groupBy("run", "whole", "capacity", "slots").agg(F.count("*").alias("n"))
    how = cut(hist.groupBy("run").applyInArrow(_planner, "run string, cut long, solved long, size long, lo long, hi long, first long, wide long"))
    x = x.join(how.select("run", "cut", F.col("solved").alias("least")).distinct(), "run")
    x = x.withColumn("pieces", F.when(F.col("whole") > F.col("capacity"), F.ceil(F.col("whole") / F.col("cut"))).otherwise(1).cast("int"))
    x = x.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    x = x.withColumn("start", F.when(F.col("pieces") > 1, F.col("piece") * F.col("cut")).otherwise(0))
    x = x.withColumn("size", F.when(F.col("pieces") > 1, F.least("cut", F.col("whole") - F.col("start"))).otherwise(F.col("whole")))
    x = x.select("run", "item", "piece", "pieces", "start", "size", "least")
    placed = place(salted_rank(x, ["run", "size"], F.struct("item", "piece")), how)
    return placed.select("run", "item", "piece", "pieces", "start", "size", "container", (F.col("container") < F.col("least")).alias("solved"))
