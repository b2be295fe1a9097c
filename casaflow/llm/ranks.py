"""Numbering rows in a global order without a window over one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casaflow.llm.links import fresh
from casaflow.session import materialize

#: Rows that one task sorts and numbers.
ROWS_PER_TASK = 1 << 20


def number_rows(rows: DataFrame, order: list[Column], by: list[str] = (), out: str = "rank") -> DataFrame:
    """``rows`` with ``out``: 0, 1, 2, ... in ``order`` among the rows equal in
    the (non-null) columns ``by``.

    ``rows`` should be stored: it is read to count it, to find ranges and to deal
    it. Rows are sorted into ranges, so a frequent value of ``by`` is spread over
    tasks (give ``order`` a unique last column); each range counts its rows, and
    only those counts, a row for each range and value it holds, meet in a window
    and are broadcast: at most one row for ROWS_PER_TASK rows and one more for
    each value of ``by``.
    """
    place, part = fresh(rows, "_place"), fresh(rows, "_part")
    tasks = max(1, -(-rows.count() // ROWS_PER_TASK))
    keys = [F.col(c).asc() for c in by] + list(order)
    dealt = materialize(rows.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
                        .withColumn(place, F.monotonically_increasing_id()), "ranges")
    dealt = dealt.withColumn(part, F.shiftright(place, 33))
    counts = dealt.groupBy(*by, part).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, part, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    return (dealt.join(F.broadcast(starts), [*by, part]).withColumn(out, F.col(place) + F.col("_start"))
            .select(*[F.col(f"`{c}`") for c in rows.columns], out))
