"""Linear interpolation of interior gaps along a series.

Spacing is by position (column index in the wide file), not by calendar
distance; leading and trailing gaps stay null; a series with fewer than two
values is unchanged.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casaflow.session import ship_package


def interpolate_linear(df: DataFrame, series_cols: list[str], pos_col: str,
                       value_col: str, out_col: str | None = None) -> DataFrame:
    """Fill interior gaps (nulls and NaN) of ``value_col`` by straight lines between the
    nearest known neighbours in ``pos_col`` order.

    Two frames over one window specification — last known value at or before
    the row, first known value at or after it — share one shuffle on the series
    key and one sort. A series is one wide-file row, so a window partition is
    bounded by the number of measure columns. The expression is
    ``slope * (pos - p0) + v0`` with ``slope = (v1 - v0) / (p1 - p0)``, the
    same arithmetic as numpy's ``interp``.
    """
    out_col = out_col or value_col
    v, p = F.nanvl(F.col(value_col).cast("double"), F.lit(None).cast("double")), F.col(pos_col)
    known = F.when(v.isNotNull(), F.struct(p.cast("double").alias("p"), v.alias("v")))
    spec = Window.partitionBy(*series_cols).orderBy(pos_col)
    prev = F.last(known, ignorenulls=True).over(
        spec.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nxt = F.first(known, ignorenulls=True).over(
        spec.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    out = (df.withColumn("_prev", prev).withColumn("_next", nxt))
    slope = (F.col("_next.v") - F.col("_prev.v")) / (F.col("_next.p") - F.col("_prev.p"))
    filled = (F.when(v.isNotNull(), v)
              .when(F.col("_prev").isNotNull() & F.col("_next").isNotNull(),
                    slope * (p.cast("double") - F.col("_prev.p")) + F.col("_prev.v")))
    return out.withColumn(out_col, filled).drop("_prev", "_next")


# --- wide form: one row holds the whole series ------------------------------

def interpolate_rows(vals):
    """Interior linear fill along axis 1 of a 2-D float array (NaN = missing),
    vectorised over all rows: nearest known position to the left and to the
    right come from running max/min of the known positions."""
    import numpy as np

    n, k = vals.shape
    if n == 0 or k == 0:
        return vals
    known = ~np.isnan(vals)
    pos = np.arange(k)
    left = np.maximum.accumulate(np.where(known, pos, -1), axis=1)
    right = np.minimum.accumulate(np.where(known, pos, k)[:, ::-1], axis=1)[:, ::-1]
    r, c = np.nonzero(~known & (left >= 0) & (right < k))
    p0, p1 = left[r, c], right[r, c]
    v0, v1 = vals[r, p0], vals[r, p1]
    out = vals.copy()
    out[r, c] = (v1 - v0) / (p1 - p0).astype("float64") * (c - p0).astype("float64") + v0
    return out


def _interp_udf():
    import numpy as np
    from pyspark.sql import types as T

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def interp(arrays: pd.Series, bad: pd.Series) -> pd.Series:
        if len(arrays) == 0:
            return arrays
        vals = interpolate_rows(np.vstack([np.asarray(a, dtype="float64") for a in arrays]))
        for row, at in zip(vals, bad):
            row[np.asarray(at, dtype="int64")] = np.nan
        return pd.Series(list(vals))

    return interp


def interpolate_wide(df: DataFrame, value_cols: list[str],
                     value_sql: str = "CAST({c} AS DOUBLE)", bad_sql: str | None = None,
                     n_bad: str | None = None) -> DataFrame:
    """Fill interior gaps along each row of a wide frame (one column per
    position), with no shuffle.

    A wide row already holds its whole series in one task, so the values go
    as one array to an Arrow-batched pandas UDF that fills a whole batch of
    rows with vectorised numpy; identifiers stay in the JVM. Same arithmetic
    as ``interpolate_linear``; NaN comes back as null. ``value_sql`` turns a
    (quoted) column into its double value inside the array expression, so
    parsing and casting happen in the same narrow projection; cells for which
    ``bad_sql`` holds stay null, and ``n_bad`` names a column for their number. Projections are sent as SQL-expression lists
    (two calls, not several per column).
    """
    def q(c):
        return "`" + c.replace("`", "``") + "`"

    # one array and a lambda: an expression per column would outgrow generated code
    cells = "array(" + ", ".join(q(c) for c in value_cols) + ")"
    arr = F.expr(f"transform({cells}, x -> {value_sql.replace('{c}', 'x')})")
    bad = (F.expr("CAST(array() AS array<int>)") if bad_sql is None else
           F.expr(f"filter(transform({cells}, (x, i) -> CASE WHEN {bad_sql.replace('{c}', 'x')} THEN i END), i -> i IS NOT NULL)"))
    keep = [q(c) for c in df.columns if c not in set(value_cols)]
    ship_package(df.sparkSession)
    with_arr = df.select(*[F.col(c) for c in keep], arr.alias("_cells"), bad.alias("_bad"))
    count = [F.size("_bad").alias(n_bad)] if n_bad else []
    with_arr = with_arr.select(*[F.col(c) for c in keep], *count, _interp_udf()("_cells", "_bad").alias("_filled"))
    filled = {c: f"CASE WHEN isnan(_filled[{i}]) THEN CAST(NULL AS DOUBLE) "
                 f"ELSE _filled[{i}] END AS {q(c)}" for i, c in enumerate(value_cols)}
    out = [filled.get(c, q(c)) for c in df.columns] + ([q(n_bad)] if n_bad else [])
    return with_arr.selectExpr(*out)
