"""Which shards a set of ranges or keys can touch, as a predicate that prunes directories.

Any number of times or shard numbers is first summed up in a fixed number of cells, so what
reaches the driver is bounded, and distant spans leave what lies between them unread.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import floor_div, micros
from tidemark.schema import quoted

# Cells that an extent is cut into, single numbers in one predicate, and intervals in one.
CELLS, NUMBERS, INTERVALS = 65_536, 100_000, 1_000

Intervals = list[tuple[int, int]]  # both ends included


def joined(intervals: Intervals) -> Intervals:
    """Sorted intervals; those that overlap or touch become one."""
    out: Intervals = []
    for low, high in sorted(intervals):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def cut(intervals: Intervals, step: int | None) -> list[Intervals]:
    """Sorted intervals in parts of at most ``step`` numbers (None: one part)."""
    if not intervals or step is None:
        return [intervals] if intervals else []
    parts: list[Intervals] = []
    room = 0
    for low, high in intervals:
        while low <= high:
            if not room:
                parts.append([])
                room = step
            end = min(high, low + room - 1)
            parts[-1].append((low, end))
            room -= end - low + 1
            low = end + 1
    return parts


def covered_times(ranges: DataFrame) -> Intervals:
    """Microseconds that ranges (begin, end; ends excluded) cover, widened to whole cells."""
    bounds = ranges.select(micros(F.col("begin")).alias("b"), (micros(F.col("end")) - 1).alias("e")).where("b <= e")
    low, high = bounds.agg(F.min("b"), F.max("e")).first()
    if low is None:
        return []
    width = -(-(high - low + 1) // CELLS)
    cell = lambda c: floor_div(F.col(c) - low, width)
    # One more range is open from a first cell on, one less after a last one.
    marks = bounds.select(F.explode(F.array(
        F.struct(cell("b").alias("cell"), F.lit(1).alias("step")), F.struct((cell("e") + 1).alias("cell"), F.lit(-1).alias("step"))
    )).alias("m")).groupBy("m.cell").agg(F.sum("m.step").alias("step"))
    out, depth, start = [], 0, 0
    for at, step in sorted(marks.collect()):
        start = at if depth == 0 else start
        depth += step
        if depth == 0 and at > start:
            out.append((low + start * width, min(high, low + at * width - 1)))
    return joined(out)


def covered_numbers(df: DataFrame, column: str) -> Intervals:
    """Intervals that hold all numbers of a column, and few others."""
    number = F.col(quoted(column))
    low, high = df.agg(F.min(number), F.max(number)).first()
    if low is None:
        return []
    width = -(-(high - low + 1) // CELLS)
    cells = df.groupBy(floor_div(number - low, width)).agg(F.min(number), F.max(number))
    return joined([(a, b) for _, a, b in cells.collect()])


def within(column: Column, intervals: Intervals) -> Column:
    """Whether an integer lies in one of sorted intervals; if there are too many, the smallest gaps are closed."""
    if not intervals:
        return F.lit(False)
    if len(intervals) > 8 and sum(b - a + 1 for a, b in intervals) <= NUMBERS:
        return column.isin([n for a, b in intervals for n in range(a, b + 1)])
    if len(intervals) > INTERVALS:
        gaps = sorted(range(1, len(intervals)), key=lambda i: intervals[i - 1][1] - intervals[i][0])
        ends = [0, *sorted(gaps[: INTERVALS - 1]), len(intervals)]
        intervals = [(intervals[a][0], intervals[b - 1][1]) for a, b in zip(ends, ends[1:])]
    parts = [column.between(a, b) for a, b in intervals]
    while len(parts) > 1:  # a flat tree, whatever their number
        parts = [reduce(Column.__or__, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]
