"""Reshaping: wide <-> long, melt with display labels, column-name rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casaflow.functions import replace_values, snake_case


def month_ends(df: DataFrame, col: str) -> list[dt.date]:
    """Every month end from the column's first month to its last: the header of
    a wide file. Only the two ends reach the driver."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None:
        return []
    months = range(lo.year * 12 + lo.month, hi.year * 12 + hi.month + 1)      # the next month's number
    return [dt.date(m // 12, m % 12 + 1, 1) - dt.timedelta(days=1) for m in months]


def split_columns(columns: list[str], id_cols=None, n_ids: int | None = None):
    """Identifiers vs measure columns: by name list, or by leading position."""
    if id_cols is not None:
        ids = [c for c in columns if c in set(id_cols)]
        return ids, [c for c in columns if c not in set(id_cols)]
    return list(columns[:n_ids]), list(columns[n_ids:])


def _q(name: str) -> str:
    """Quote a column name for a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def unpivot_wide(df: DataFrame, id_cols: list[str],
                 value_cols: list[tuple[str, dt.date | None, int]],
                 value_name: str = "value", generate: bool = False) -> DataFrame:
    """Wide -> long: one row per (row, measure column), nulls kept.

    ``value_cols`` holds (column, parsed header date, column position). The
    date and position are parsed once per column on the driver, so no per-row
    date parsing remains. Planned as a single ``Expand`` — a narrow operator,
    no shuffle. Output: ids, ``date_str`` (header text), ``metric_date``,
    ``pos``, ``value_name``.

    The measure columns are unpivoted under their position number, and date
    and header text are looked up by position in constant arrays (O(1) per
    row). The unpivot output stays flat and narrow, so it stays inside
    whole-stage code generation however many month columns the file has.
    ``generate`` explodes an array of the columns instead (``Generate``, narrow as
    well), whose code doesn't grow with the columns; they must be of one type.
    """
    if not value_cols:
        raise ValueError("no measure columns")
    if generate:
        cells = ", ".join(_q(c) for c, _, _ in value_cols)
        long = df.selectExpr(*[_q(c) for c in id_cols], f"posexplode(array({cells})) AS (__cf_slot, {_q(value_name)})")
        slot = "(__cf_slot + 1)"
    else:
        prefix = "__cf_slot_"
        pos_names = [f"{prefix}{i}" for i in range(len(value_cols))]
        renamed = df.selectExpr(*[_q(c) for c in id_cols],
                                *[f"{_q(c)} AS {n}" for (c, _, _), n in zip(value_cols, pos_names)])
        long = renamed.unpivot([_q(c) for c in id_cols], pos_names, "__cf_slot", value_name)
        slot = f"(CAST(substr(__cf_slot, {len(prefix) + 1}) AS INT) + 1)"
    dates = ", ".join(f"DATE'{d.isoformat()}'" if d is not None else "CAST(NULL AS DATE)"
                      for _, d, _ in value_cols)
    texts = ", ".join(_sql_literal(c) for c, _, _ in value_cols)
    positions = ", ".join(str(int(p)) for _, _, p in value_cols)
    return long.selectExpr(
        *[_q(c) for c in id_cols],
        f"element_at(array({texts}), {slot}) AS date_str",
        f"element_at(array({dates}), {slot}) AS metric_date",
        f"element_at(array({positions}), {slot}) AS pos",
        _q(value_name))


def _sql_literal(v) -> str:
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP_NTZ'{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE'{v.isoformat()}'"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, bool):
        return "true" if v else "false"
    return repr(v)


#: Columns that one aggregate of a pivot fills.
PIVOT_BLOCK = 12


def to_wide(long: DataFrame, series_cols: list[str], pivot_col: str,
            pivot_values: list, value_col: str) -> DataFrame:
    """Long -> wide with an explicit column list (no extra distinct job).

    A conditional ``first`` per cell and column would cost rows times columns, so
    the columns are dealt to blocks of PIVOT_BLOCK in the order of their values:
    a row is compared with one column of each block, then put in its place by an
    aggregate per series and block, and a second one sets the blocks of a series
    side by side. Both combine on the map side. Each cell is the series' value in
    that column, null when absent; (series, column) is expected unique.
    """
    first = lambda cond, value, name: F.expr(f"first(CASE WHEN {cond} THEN {value} END, true) AS {_q(name)}")     # noqa: E731
    pivot, value = _q(pivot_col), _q(value_col)
    if len(pivot_values) <= PIVOT_BLOCK:
        return long.groupBy(*series_cols).agg(*[first(f"{pivot} = {_sql_literal(v)}", value, str(v)) for v in pivot_values])
    ordered = sorted(set(pivot_values))
    blocks = [ordered[i:i + PIVOT_BLOCK] for i in range(0, len(ordered), PIVOT_BLOCK)]
    block = " + ".join(f"CAST({pivot} >= {_sql_literal(b[0])} AS INT)" for b in blocks[1:])
    at = [", ".join(_sql_literal(b[i]) if i < len(b) else "NULL" for b in blocks) for i in range(PIVOT_BLOCK)]
    parts = long.withColumn("__cf_block", F.expr(block)).groupBy(*series_cols, "__cf_block").agg(
        *[first(f"{pivot} = get(array({vs}), __cf_block)", value, f"__cf_at_{i}") for i, vs in enumerate(at)])
    whole = "struct(" + ", ".join(f"__cf_at_{i}" for i in range(PIVOT_BLOCK)) + ")"
    wide = parts.groupBy(*series_cols).agg(*[first(f"__cf_block = {n}", whole, f"__cf_block_{n}") for n in range(len(blocks))])
    place = {v: (n, i) for n, b in enumerate(blocks) for i, v in enumerate(b)}
    return wide.selectExpr(*[_q(c) for c in series_cols],
                           *["__cf_block_{}.__cf_at_{}".format(*place[v]) + f" AS {_q(str(v))}" for v in pivot_values])


def melt(df: DataFrame, id_cols: list[str], value_cols: list[str],
         var_name: str, value_name: str, labels: dict[str, str] | None = None) -> DataFrame:
    """Unpivot measures to (var_name, value_name) and relabel them for display."""
    out = df.unpivot(id_cols, value_cols, var_name, value_name)
    if labels:
        out = out.withColumn(var_name, replace_values(var_name, labels))
    return out


def rename_snake(df: DataFrame) -> DataFrame:
    """All column names CamelCase -> snake_case, in one projection."""
    return df.toDF(*[snake_case(c) for c in df.columns])
