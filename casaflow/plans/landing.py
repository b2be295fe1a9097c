"""Landing job: wide monthly CSVs -> one row per region and month.

One parameterised job (``LandingSpec``) replaces three near-identical copies.
The plan is a single narrow stage: scan -> Expand (unpivot) -> projections ->
filter; no shuffle. Date headers are parsed once on the driver; with a cut-off
the columns at or before it are never unpivoted (nor converted), which the
optimizer cannot do through an unpivot by itself.

``land`` returns the landing frame alone. ``write_landing`` is the job's form: the
same pass writes what it landed, every cell it rejected and a record of every wide
row, in three folders of one write, so the report of each file needs no second
look at the files.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casaflow.functions import header_date, snake_case, tier_from_path
from casaflow.operators.reshape import rename_snake, unpivot_wide
from casaflow.schemas import BAD_DATE, BAD_VALUE, FILE_REPORT, INT_ID_COLS, REJECTS, LandingSpec
from casaflow.sinks.publish import Publication
from casaflow.sources.wide_csv import WideGroup, bad_ids, scan_wide, typed_id


def long_cells(groups: list[WideGroup], value_name: str = "raw",
               min_date=None, na_tokens=None, trim: bool = False) -> DataFrame:
    """Unpivot every header group and union them by name.

    Output: identifiers, ``source_file``, ``date_str``, ``metric_date``,
    ``pos`` (column position), ``raw`` (cell text) and ``value`` (double or
    null). ``min_date`` prunes columns on the driver (unparseable headers go
    with them, as a date filter would drop them). ``na_tokens`` turns the
    listed cell and identifier texts into nulls; ``trim`` strips identifier text.
    """
    parts = []
    for g in groups:
        cols = [(c, header_date(c), i) for i, c in enumerate(g.measure_cols)]
        if min_date is not None:
            cols = [x for x in cols if x[1] is not None and x[1] > min_date]
        if not cols:
            continue
        text = dict(g.df.dtypes)
        df = g.df.withColumns({c: typed_id(c, na_tokens, trim) for c in g.id_cols if text[c] == "string"})
        parts.append(unpivot_wide(df, [*g.id_cols, "source_file"], cols, value_name))
    if not parts:
        raise ValueError("no measure columns to land")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    raw = F.col(value_name)
    if na_tokens:
        raw = F.when(raw.isin(list(na_tokens)), F.lit(None)).otherwise(raw)
    return out.withColumns({value_name: raw,
                            "value": F.trim(raw).try_cast("double")})


def landing_columns(spec: LandingSpec, id_cols: list[str]) -> list[Column]:
    """Identifiers, tier, date, measure, year and audit time of long cells."""
    tier = [tier_from_path("source_file").alias("home_tier")] if spec.with_tier else []
    return [*[F.col(f"`{c}`") for c in id_cols], *tier, F.col("metric_date"), F.col("value").alias(spec.name),
            F.year("metric_date").alias("year"), F.current_timestamp().alias("inserted_at")]


def finish_landing(cells: DataFrame, spec: LandingSpec, id_cols: list[str]) -> DataFrame:
    """Measure column, tier, null drop, year, audit time, snake_case names."""
    return rename_snake(cells.select(*landing_columns(spec, id_cols)).dropna(subset=[spec.name]))


def land(spark: SparkSession, spec: LandingSpec, pattern: str | list[str],
         min_date="spec", na_tokens=None) -> DataFrame:
    """Read all files of one family and return the landing frame."""
    cut = spec.min_date if min_date == "spec" else min_date
    groups = scan_wide(spark, pattern, id_cols=list(spec.id_cols))
    cells = long_cells(groups, min_date=cut, na_tokens=na_tokens)
    return finish_landing(cells, spec, [c for c in spec.id_cols])


def is_malformed(raw: str = "raw", value: str = "value") -> Column:
    """A cell that holds text but no number."""
    return F.coalesce((F.trim(raw) != "") & F.col(value).isNull(), F.lit(False))


LANDED, REJECT, FILE = "landed", "reject", "file"
ROW_SLOT = "__cf_row"
#: Shares into which the wide rows of one partition value are dealt, and their column.
SHARES, SHARE = 4, "__cf_share"


def landing_schema(spec: LandingSpec) -> T.StructType:
    """The landing table of a family, as ``land`` returns it."""
    text, whole = T.StringType(), T.IntegerType()
    fields = [(snake_case(c), whole if c in INT_ID_COLS else text) for c in spec.id_cols]
    fields += [("home_tier", text)] if spec.with_tier else []
    fields += [("metric_date", T.DateType()), (spec.name, T.DoubleType()), ("year", whole), ("inserted_at", T.TimestampType())]
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


def landing_log(spark: SparkSession, spec: LandingSpec, pattern: str | list[str], min_date="spec", na_tokens=None) -> DataFrame:
    """All that one pass over a family's files has to say, by ``kind``:

    * ``landed``: the rows of ``land``;
    * ``reject``: a cell of a month that is landed whose text is no number
      (``bad_value``), or a number under a header that is no date
      (``bad_date``; such a cell lands as well where there is no cut-off);
    * ``file``: a wide row, with the number of its cells, of those under headers
      that are no date, and of its malformed integer identifiers.

    Landing columns (null where they don't apply), kind, family, source_file,
    date_str, raw, reason, n_cells, n_bad_date, n_bad_id. Wide rows are dealt by
    the family's first partition column before they are unpivoted: then the
    shuffle moves each value once, not once with every identifier. A value of
    that column is dealt in SHARES shares, as the few values there are would
    leave most cores without work; small shares are put together again (AQE).
    """
    cut = spec.min_date if min_date == "spec" else min_date
    parts = []
    for g in scan_wide(spark, pattern, id_cols=list(spec.id_cols)):
        cols = [(c, header_date(c), i) for i, c in enumerate(g.measure_cols)]
        kept = [x for x in cols if cut is None or (x[1] is not None and x[1] > cut)]
        ids = {c: typed_id(c, na_tokens) if c in g.id_cols else F.lit(None).cast("int" if c in INT_ID_COLS else "string").alias(c)
               for c in spec.id_cols}
        deal = [c for c in g.id_cols if snake_case(c) in spec.partition_cols]
        share = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in g.id_cols]), F.lit(SHARES))
        wide = g.df.withColumn(SHARE, share).hint("rebalance", *deal, SHARE) if deal else g.df
        wide = wide.select(*ids.values(), "source_file", bad_ids(g, na_tokens).alias("n_bad_id"),
                           *[F.col(f"`{c}`") for c, _, _ in kept], F.lit(None).cast("string").alias(ROW_SLOT))
        long = unpivot_wide(wide, [*spec.id_cols, "source_file", "n_bad_id"], [*kept, (ROW_SLOT, None, -1)], "raw", generate=True)
        parts.append(long.withColumns({"n_cells": F.lit(len(cols)), "n_bad_date": F.lit(sum(d is None for _, d, _ in cols))}))
    if not parts:
        raise ValueError("no measure columns to land")
    cells = functools.reduce(DataFrame.unionByName, parts)
    raw = F.when(~F.col("raw").isin(list(na_tokens)), F.col("raw")) if na_tokens else F.col("raw")
    cells = cells.withColumns({"raw": raw, "value": F.trim(raw).try_cast("double")})
    number = F.col("value").isNotNull() & ~F.isnan("value")
    reason = F.when(is_malformed(), BAD_VALUE).when(number & F.col("metric_date").isNull(), BAD_DATE)
    # no lambda over an array: that would be interpreted, cell by cell
    kinds = (F.when(F.col("pos") < 0, F.array(F.lit(FILE)))
             .when(number & reason.isNotNull(), F.array(F.lit(LANDED), F.lit(REJECT)))
             .when(number, F.array(F.lit(LANDED))).when(reason.isNotNull(), F.array(F.lit(REJECT))))
    log = cells.withColumn("kind", F.explode(kinds))
    note = [F.when(F.col("kind") == REJECT, F.col(c)).alias(c) for c in ("date_str", "raw")]
    note += [F.when(F.col("kind") == REJECT, reason).alias("reason")]
    note += [F.when(F.col("kind") == FILE, F.col(c)).alias(c) for c in ("n_cells", "n_bad_date", "n_bad_id")]
    return rename_snake(log.select(*landing_columns(spec, list(spec.id_cols)), "kind", F.lit(spec.name).alias("family"), "source_file", *note))


def file_report(log: DataFrame) -> DataFrame:
    """Per source file of a (stored) log: wide rows, cells, landed cells,
    rejected values, cells under headers that are no date, malformed integer
    identifiers."""
    is_file = F.col("kind") == FILE
    rejected = lambda why: F.count(F.when(F.col("reason") == why, 1))        # noqa: E731
    return log.groupBy("family", "source_file").agg(
        F.count(F.when(is_file, 1)).alias("n_rows"), F.coalesce(F.sum("n_cells"), F.lit(0)).cast("long").alias("n_cells"),
        F.count(F.when(F.col("kind") == LANDED, 1)).alias("n_landed"), rejected(BAD_VALUE).alias("n_bad_value"),
        F.coalesce(F.sum("n_bad_date"), F.lit(0)).cast("long").alias("n_bad_date"),
        F.coalesce(F.sum("n_bad_id"), F.lit(0)).cast("long").alias("n_bad_id")).select(*FILE_REPORT.names)


def write_landing(spark: SparkSession, pub: Publication, spec: LandingSpec, pattern: str | list[str], min_date="spec",
                  na_tokens=None) -> DataFrame:
    """Land one family into a publication: its landing table (partitioned by
    the family's columns), ``rejects_<family>`` and ``files_<family>`` (the
    report), from one pass over the files. Returns the landing table. What the
    publication's ledger has is not done again."""
    rejects, files = f"rejects_{spec.name}", f"files_{spec.name}"
    if pub.done(files) is None:
        path = pub.fresh_path(spec.table)
        log = landing_log(spark, spec, pattern, min_date, na_tokens)
        log.write.mode("errorifexists").partitionBy("kind", *spec.partition_cols).parquet(path)
        pub.adopt(spec.table, f"{path}/kind={LANDED}", landing_schema(spec), spec.partition_cols)
        pub.adopt(rejects, f"{path}/kind={REJECT}", REJECTS)
        pub.write(files, file_report(spark.read.schema(log.schema).parquet(path)))
    return pub.read(spec.table)


def file_rejects(groups: list[WideGroup], na_tokens=None) -> DataFrame:
    """The reject report of scanned files: per source file its cells, filled
    cells, malformed measures, cells under unparseable date headers, and
    malformed integer identifiers."""
    cells = reject_report(long_cells(groups, na_tokens=na_tokens))
    ids = [g.df.groupBy("source_file").agg(F.sum(bad_ids(g, na_tokens)).alias("n_bad_id")) for g in groups]
    return cells.join(functools.reduce(DataFrame.unionByName, ids), "source_file")


def reject_report(cells: DataFrame, group_col: str = "source_file") -> DataFrame:
    """Per source: cells, filled cells, malformed measures, unparseable dates."""
    filled = F.col("raw").isNotNull()
    return (cells.groupBy(group_col)
            .agg(F.count(F.lit(1)).alias("n_cells"),
                 F.count(F.when(filled, 1)).alias("n_filled"),
                 F.count(F.when(is_malformed(), 1)).alias("n_bad_value"),
                 F.count(F.when(F.col("metric_date").isNull(), 1)).alias("n_bad_date")))
