"""Recursive averages, where each value needs the one before it.

No window frame expresses y[t] = a·x[t] + (1-a)·y[t-1]. Here the bars of a symbol (at
most one per day, see ``series``) are folded in order by Spark's own array functions.
``scan`` keeps every state; it works in chunks, because appending to one ever longer
array would copy it at each step.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 64


def smoothing(span: int) -> float:
    return 2.0 / (span + 1.0)


def ema_step(previous: Column, value: Column, span: int) -> Column:
    alpha = smoothing(span)
    return value * alpha + previous * (1.0 - alpha)


def scan(
    points: Column,
    first: Callable[[Column], Column],
    step: Callable[[Column, Column], Column],
) -> Column:
    """Array of states: ``first(point)`` for the first point, then ``step(state, point)``."""
    last_chunk = F.floor((F.size(points) - 2) / CHUNK).cast("int")
    chunks = F.transform(
        F.sequence(F.lit(0), F.greatest(last_chunk, F.lit(0))),
        lambda c: F.slice(points, c * CHUNK + 2, F.lit(CHUNK)),
    )

    def extend(done: Column, chunk: Column) -> Column:
        carried = F.element_at(F.element_at(done, -1), -1)
        states = F.aggregate(
            chunk,
            F.array(carried),
            lambda acc, point: F.concat(acc, F.array(step(F.element_at(acc, -1), point))),
        )
        return F.concat(done, F.array(F.slice(states, 2, CHUNK)))

    start = F.array(F.array(first(F.element_at(points, 1))))
    # A series of one point has one empty chunk, which must not be extended from.
    folded = F.aggregate(F.filter(chunks, lambda c: F.size(c) > 0), start, extend)
    return F.flatten(folded)
