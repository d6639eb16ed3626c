"""Positions of a figure: swarms of dots in lanes, labels, ticks, arrows."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import deque
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class Swarm(NamedTuple):
    """Radius of a dot, distance of two rungs, farthest rung, and the air between two dots."""

    radius: float = 2.7
    step: float = 5.6
    most: float = 52
    air: float = 0.6

    @property
    def reach(self) -> float:
        """Centres nearer than this, across and along, touch."""
        return 2 * self.radius + self.air

    def rungs(self) -> Iterator[float]:
        """The offsets to try: the middle, then outwards, below and above in turn; the first beyond ``most`` is the last."""
        yield 0.0
        n = 1
        while n * self.step <= self.most:
            yield n * self.step
            yield -n * self.step
            n += 1
        yield n * self.step

    @property
    def capacity(self) -> int:
        """How many dots at one place can find a rung within ``most``; all further ones stand on the last."""
        return 2 * math.floor(self.most / self.step) + 1


DOTS, BIG = Swarm(), Swarm(7, 12, 42)


def swarm(xs: Iterable[float], size: Swarm = DOTS) -> list[float]:
    """Vertical offsets for dots at ascending ``xs``, each on the first rung that touches no dot placed before it.

    Only dots whose place is still in reach are kept, their offsets sorted, so a rung is judged by its two neighbours.
    """
    window: deque[tuple[float, float]] = deque()
    out = []
    for x in xs:
        while window and x - window[0][0] >= size.reach:
            window.popleft()
        taken = sorted({offset for _, offset in window})
        for rung in size.rungs():
            k = bisect_left(taken, rung)
            above, below = taken[k] - rung if k < len(taken) else math.inf, rung - taken[k - 1] if k else math.inf
            if min(above, below) >= size.reach:
                break
        window.append((x, rung))
        out.append(rung)
    return out


def beeswarm(points: DataFrame, lane: str, x: str, tie: str, size: Swarm = DOTS) -> DataFrame:
    """(lane, tie, x, offset): each lane laid out for itself in order of x, then of the tie column.

    What one place can hold is bounded, so only the first ``capacity`` dots of each (lane, x) are laid out in Python, a lane in
    one task; all others stand on the last rung without being moved there.
    """
    schema = f"{lane} string, {tie} string, {x} double, offset double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([x, tie], kind="stable")
        return pdf.assign(offset=swarm(pdf[x], size))[[lane, tie, x, "offset"]]

    typed = points.selectExpr(f"cast({lane} as string) {lane}", f"cast({tie} as string) {tie}", f"cast({x} as double) {x}")
    place = typed.withColumn("_n", F.row_number().over(Window.partitionBy(lane, x).orderBy(tie)))
    laid = place.where(F.col("_n") <= size.capacity).drop("_n").groupBy(lane).applyInPandas(run, schema)
    *_, last = size.rungs()
    return laid.unionByName(place.where(F.col("_n") > size.capacity).drop("_n").withColumn("offset", F.lit(last)))


#: Distances of a label from its dot, nearest first, above and below in turn.
TIERS = (-18, 19, -33, 34, -49, 50, -66, 67, -84, 85, -103, 104)


#: Width of a letter, the label's own margin, its height above and below its line, and the room a big dot needs.
LETTER, MARGIN, ABOVE, BELOW, ROOM = 6.2, 8, 8, 6, 11


class Box(NamedTuple):
    left: float
    right: float
    top: float
    bottom: float

    def meets(self, other: Box) -> bool:
        """Whether the boxes share a point, edges included."""
        return max(self.left, other.left) <= min(self.right, other.right) and max(self.top, other.top) <= min(self.bottom, other.bottom)


def _label_box(x: float, y: float, text: str, tier: float) -> Box:
    half = (len(text) * LETTER + MARGIN) / 2
    return Box(x - half, x + half, y + tier - ABOVE, y + tier + BELOW)


def place_labels(dots: list[tuple[float, float, str]], others: list[tuple[float, float]] = ()) -> list[int]:
    """For each labelled dot (x, y, text), lane by lane and from left to right, the first tier whose box is free; the last if none is.

    Labels placed before and the room around every big dot at another place are taken.
    """
    rooms = {(x, y): Box(x - ROOM, x + ROOM, y - ROOM, y + ROOM) for x, y in [*(d[:2] for d in dots), *others]}
    labels: list[Box] = []
    out = []
    for x, y, text in dots:
        taken = labels + [room for place, room in rooms.items() if math.dist(place, (x, y)) >= 0.5]
        choices = {tier: _label_box(x, y, text, tier) for tier in TIERS}
        tier = next((t for t, box in choices.items() if not any(map(box.meets, taken))), TIERS[-1])
        labels.append(choices[tier])
        out.append(tier)
    return out


def ticks(lo: int, hi: int, at, warped: bool, gap: float = 34) -> list[int]:
    """The years of an axis: every fifth (tenth over long linear spans), those too near their left neighbour left out. ``at`` gives a year's place."""
    step = 5 if warped or hi - lo <= 40 else 10
    out: list[int] = []
    for year in range(-(-lo // step) * step, hi + 1, step):
        if not out or at(year) - at(out[-1]) >= gap:
            out.append(year)
    return out


def big_dots(points: DataFrame, lane: str, x: str, tie: str, spread: bool) -> DataFrame:
    """Labelled dots: on the middle of their lane, or as a wide swarm where a source is emphasised."""
    if spread:
        return beeswarm(points, lane, x, tie, BIG)
    return points.select(F.col(lane).cast("string"), F.col(tie).cast("string"), F.col(x).cast("double"), F.lit(0.0).alias("offset"))


def arrows(spec: DataFrame, positions: DataFrame) -> DataFrame:
    """Editorial arrows with the places of both ends; one whose end isn't drawn is left out. ``spec`` has from, to, color, label; ``positions`` ref, x, y."""
    a = positions.selectExpr("ref as `from`", "x as x1", "y as y1")
    b = positions.selectExpr("ref as `to`", "x as x2", "y as y2")
    return spec.join(a, "from").join(b, "to")
