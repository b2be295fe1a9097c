"""Cleaning job: trim identifier text, turn NA tokens into nulls and fill
interior gaps of every wide-file row by linear interpolation along the row.

The source did this one file at a time in a single pandas process. Here the
file-to-file job (``clean_files``) stays in wide form: scan -> trim / cast ->
row-wise fill -> CSV write, a single narrow stage with no shuffle, because a
wide row already holds its whole series. ``clean_cells`` gives the same values
in long form (window over the row's cells) for callers that continue in long
form; there each wide row is tagged with a row id before the unpivot, so a
series is exactly one input row even when identifier values repeat.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from casaflow.functions import header_date
from casaflow.operators.gapfill import interpolate_linear, interpolate_wide
from casaflow.plans.landing import is_malformed, long_cells
from casaflow.schemas import CLEANING_REPORT, PANDAS_NA_TOKENS
from casaflow.sinks.writers import remove_folder, replace_folders
from casaflow.sources.wide_csv import WideGroup, bad_ids, has_files, scan_wide, typed_id

ROW_KEY = ["source_file", "_row"]


def with_row_ids(groups: list[WideGroup]) -> list[WideGroup]:
    """Tag rows with a per-relation unique id (deterministic for a file scan,
    so a recomputed partition gets the same ids)."""
    return [WideGroup(g.files, g.header, [*g.id_cols, "_row"], g.measure_cols,
                      g.df.withColumn("_row", F.monotonically_increasing_id()))
            for g in groups]


def clean_cells(spark: SparkSession, pattern: str | list[str], id_cols=None,
                n_ids: int | None = None, na_tokens=PANDAS_NA_TOKENS) -> DataFrame:
    """Long form of the cleaned files: ids, source_file, _row, date_str,
    metric_date, pos, raw, value (interpolated)."""
    groups = with_row_ids(scan_wide(spark, pattern, id_cols=id_cols, n_ids=n_ids))
    cells = long_cells(groups, na_tokens=na_tokens, trim=True)
    filled = interpolate_linear(cells.withColumn("_bad", is_malformed()), ROW_KEY, "pos", "value")
    return filled.withColumn("value", F.when(~F.col("_bad"), F.col("value"))).drop("_bad")


def input_name(path_col: str) -> F.Column:
    """Name of the input a row came from: the file name, or for a directory
    of part files the directory's name (without a ``key=`` prefix)."""
    return F.regexp_extract(F.col(path_col), r"(?:[^/=]*=)?([^/]+?)(?:/part-[^/]*)?$", 1)


def clean_wide(group: WideGroup, na_tokens=PANDAS_NA_TOKENS, counts: bool = False) -> DataFrame:
    """One header group cleaned in wide form: identifiers trimmed, NA tokens
    null everywhere, measures as doubles with interior gaps filled; plus
    ``file``. A malformed cell is no gap: it stays null. ``counts`` adds
    ``_n_bad`` and ``_n_bad_id``, a row's malformed cells and integer identifiers.

    Token check, trim and cast are folded into the array handed to the fill,
    so no intermediate projection carries all measure columns."""
    df = group.df
    types = dict(df.dtypes)
    ids = [typed_id(c, na_tokens, trim=True) if types[c] == "string" else F.col(f"`{c}`")
           for c in group.id_cols]
    base = df.select(*ids, *[F.col(f"`{c}`") for c in group.measure_cols],
                     input_name("source_file").alias("file"),
                     *([bad_ids(group, na_tokens).alias("_n_bad_id")] if counts else []))
    if na_tokens:
        tokens = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"
                           for t in na_tokens)
        text = f"trim(CASE WHEN {{c}} IN ({tokens}) THEN NULL ELSE {{c}} END)"
    else:
        text = "trim({c})"
    value_sql = f"try_cast({text} AS DOUBLE)"
    return interpolate_wide(base, list(group.measure_cols), value_sql,
                            bad_sql=f"{text} <> '' AND {value_sql} IS NULL", n_bad="_n_bad" if counts else None)


def clean_files(spark: SparkSession, raw_dir: str, out_dir: str, files,
                fmt: str = "csv") -> list[tuple]:
    """Clean the configured (identifier count, input, output) files, each into
    the folder ``out_dir/<output>`` of part files (header order kept), as CSV
    or Parquet, and return a row of ``CLEANING_REPORT`` for each input.

    One narrow stage per header group, which also counts its rows and malformed
    cells (``observe``), so the report needs no second scan; groups of one input
    share its folder, which readers split by header again. An input that is
    absent fails the job before anything is written. All outputs are written
    aside and take their places when the last one is complete: a run that fails
    leaves the former outputs as they were.
    """
    absent = sorted(src for _, src, _ in files if not has_files(spark, os.path.join(raw_dir, src)))
    if absent:
        raise FileNotFoundError(f"no input in {raw_dir} for {', '.join(absent)}")
    out_dir = out_dir.rstrip("/")
    staging = f"{out_dir}/_cleaning-{uuid.uuid4().hex[:12]}"
    report, written = [], []
    try:
        for n_ids, src, dst in files:
            totals = [0] * 5
            for g in scan_wide(spark, os.path.join(raw_dir, src), n_ids=n_ids):
                seen = Observation()
                counted = clean_wide(g, counts=True).drop("file").observe(
                    seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_n_bad"), F.lit(0)).alias("bad"),
                    F.coalesce(F.sum("_n_bad_id"), F.lit(0)).alias("bad_id"))
                w = counted.drop("_n_bad", "_n_bad_id").write.mode("append")
                if fmt == "parquet":
                    w.parquet(f"{staging}/{dst}")
                else:
                    w.option("header", True).option("escape", '"').csv(f"{staging}/{dst}")
                got = seen.get
                no_date = sum(header_date(c) is None for c in g.measure_cols)
                new = (got["rows"], got["rows"] * len(g.measure_cols), got["bad"], got["rows"] * no_date, got["bad_id"])
                totals = [a + b for a, b in zip(totals, new)]
                written.append(dst)
            report.append((src, dst, *totals))
        replace_folders(spark, staging, out_dir, list(dict.fromkeys(written)))
    finally:
        remove_folder(spark, staging)
    return report


def cleaning_report(spark: SparkSession, report: list[tuple]) -> DataFrame:
    return spark.createDataFrame(report, CLEANING_REPORT)
