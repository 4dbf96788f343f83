"""Many-to-many joins on a key of which a few values hold a large share of the rows. Id: JOI-03.

Frequent values are found by a frequent-items sketch, taken while a side is written. Rows of
a frequent value are dealt to a grid: a row of one side goes to one line of it and is copied
along the line, a row of the other goes to one column. So every pair meets in exactly one cell,
a cell is as small as asked for, and rows of other values go once, as in a plain join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annofold.storage import settled_with

#: Frequent values that are looked for on a side, and counters of the sketch. A value with
#: more than (rows / 3,000) rows is always among them.
FREQUENT = 1_000
TRACKED = 4_096
#: Rows of a value that one cell takes.
CELL_ROWS = 1_000_000


def with_frequent(df: DataFrame, key: str, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, dict[str, int]]:
    """``df``, settled, and the cells that each value of ``key`` with more than ``cell_rows`` rows asks for."""
    sketch = F.expr(f"approx_top_k(`{key}`, {FREQUENT}, {TRACKED})").alias("top")
    held, told = settled_with(df, sketch)
    counts = {item["item"]: item["count"] for item in told["top"] or []}
    return held, {str(k): -(-n // cell_rows) for k, n in counts.items() if k is not None and n > cell_rows}


def skew_join(left: DataFrame, right: DataFrame, key: str, spread: tuple[Sequence[str], Sequence[str]], cell_rows: int = CELL_ROWS) -> DataFrame:
    """Inner join of ``left`` and ``right`` on the string column ``key``, as ``left.join(right, key)``.

    ``spread`` names columns of each side that tell the rows of a value apart. Both sides are
    settled. The frequent values, at most ``FREQUENT`` a side, are a broadcast table.
    """
    sides = []
    cells: dict[str, list[int]] = {}
    for at, side in enumerate((left, right)):
        held, frequent = with_frequent(side, key, cell_rows)
        sides.append(held)
        for value, n in frequent.items():
            cells.setdefault(value, [1, 1])[at] = n
    if not cells:
        return sides[0].join(sides[1], key)
    spark = left.sparkSession
    grid = F.broadcast(spark.createDataFrame([(k, *n) for k, n in cells.items()], "__value string, __lines int, __columns int"))
    dealt = []
    for side, columns, own, other, line, copied in (
        (sides[0], spread[0], "__lines", "__columns", "__line", "__column"),
        (sides[1], spread[1], "__columns", "__lines", "__column", "__line"),
    ):
        placed = side.join(grid, F.col(key) == F.col("__value"), "left")
        mine = F.pmod(F.xxhash64(*columns), F.coalesce(F.col(own), F.lit(1))).cast("int")
        along = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        dealt.append(placed.withColumn(line, mine).withColumn(copied, along).drop("__value", "__lines", "__columns"))
    return dealt[0].join(dealt[1], [key, "__line", "__column"]).drop("__line", "__column")
