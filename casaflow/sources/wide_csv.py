"""Wide monthly CSV scan: N identifier columns, then one column per month.

Files matched by one glob may carry different date headers (one file starts a
month later, another has an extra month). Spark's CSV reader maps columns by
position, so reading them as one relation would silently give values the
wrong dates. The scan therefore first runs a job in which each task reads the header
line of one file, groups files with identical headers, and builds one
relation per group with an explicit schema. Measures are read as text and
converted after the unpivot with ``try_cast``, so a malformed cell becomes a
counted reject instead of a failed job or a silently inferred string column.
"""

from __future__ import annotations

import csv
import functools
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casaflow.functions import trim_all
from casaflow.schemas import INT_ID_COLS
from casaflow.session import ship_package


@dataclass
class WideGroup:
    files: list[str]
    header: list[str]
    id_cols: list[str]
    measure_cols: list[str]
    df: DataFrame


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Files matching a glob on any file system, those of matched folders
    included; Spark lists them and no file is opened."""
    try:
        found = spark.read.format("binaryFile").load(pattern).select("path")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(r["path"] for r in found.collect())


def has_files(spark: SparkSession, pattern: str) -> bool:
    """Whether a glob matches anything (one call)."""
    fs, p = _fs_and_path(spark, pattern)
    found = fs.globStatus(p)
    return bool(found) and len(found) > 0


#: One file a task, and few rows a batch: a task reads the start of its file.
HEADER_CONF = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50),
               "spark.sql.execution.arrow.maxRecordsPerBatch": "16"}
#: Batches that a task takes so that a short file ends (its worker is then used again).
DRAINED = 64


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = False
    for n, batch in enumerate(batches):
        if not found and batch.num_rows:
            found = True
            yield batch.slice(0, 1)
        if n >= DRAINED:
            return


def parse_header(line: str) -> list[str]:
    return next(csv.reader(io.StringIO(line.lstrip("\ufeff"))), [])


def header_groups(spark: SparkSession, pattern: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files grouped by identical header, in one Spark job: every task reads the
    first line of one file, and the driver gets each distinct header once with
    the paths (as ``_metadata.file_path`` spells them) that have it. Files
    without a line and globs without files give nothing. Works for any file
    system that Spark reads."""
    ship_package(spark)
    own = spark.newSession()
    for k, v in HEADER_CONF.items():
        own.conf.set(k, v)
    try:
        lines = own.read.text(pattern).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    firsts = lines.mapInArrow(_first_line, "path string, line string")
    found = firsts.groupBy("line").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for r in found:
        groups.setdefault(tuple(parse_header(r["line"])), []).extend(r["paths"])
    return {h: sorted(p) for h, p in groups.items()}


def read_header(spark: SparkSession, path: str) -> list[str]:
    """The header of one file."""
    return list(next(iter(header_groups(spark, path)), []))


def wide_schema(header: list[str], id_cols: list[str] | None, n_ids: int | None,
                ) -> tuple[T.StructType, list[str], list[str]]:
    """Every column text; identifiers get their types from ``typed_id``, so a
    padded or malformed integer is seen instead of read as null."""
    if id_cols is not None:
        ids = [c for c in header if c in set(id_cols)]
    else:
        ids = list(header[:n_ids])
    measures = [c for c in header if c not in set(ids)]
    return T.StructType([T.StructField(c, T.StringType(), True) for c in header]), ids, measures


def _id_text(name: str, na_tokens=None) -> Column:
    text = F.col(f"`{name}`")
    return F.when(~text.isin(list(na_tokens)), text) if na_tokens else text


def typed_id(name: str, na_tokens=None, trim: bool = False, int_ids=INT_ID_COLS) -> Column:
    """An identifier column: the id and rank columns as integers (padding is
    fine, null when malformed), the others as text (ZIP codes keep leading
    zeros), trimmed on request; NA tokens are null."""
    text = _id_text(name, na_tokens)
    if name in int_ids:
        return trim_all(text).try_cast("int").alias(name)
    return (trim_all(text) if trim else text).alias(name)


def bad_ids(group: "WideGroup", na_tokens=None, int_ids=INT_ID_COLS) -> Column:
    """How many of a row's integer identifiers hold text that is no integer."""
    bad = [F.when((trim_all(_id_text(c, na_tokens)) != "") & typed_id(c, na_tokens).isNull(), 1).otherwise(0)
           for c in group.id_cols if c in int_ids]
    return functools.reduce(lambda a, b: a + b, bad, F.lit(0))


def scan_wide(spark: SparkSession, pattern: str | list[str], id_cols=None,
              n_ids: int | None = None) -> list[WideGroup]:
    """One ``WideGroup`` per distinct header among the files matched.

    Each group's frame has the identifiers, the measure columns (text) and
    ``source_file`` (the full path, from the scan's file metadata). With several
    headers a group is the same glob with a filter on the file's path, which
    Spark applies when it lists files: other groups' files are not opened.
    """
    groups = sorted(header_groups(spark, pattern).items())
    out = []
    for header, files in groups:
        schema, ids, measures = wide_schema(list(header), id_cols, n_ids)
        df = (spark.read.schema(schema)
              .option("header", True).option("enforceSchema", False)
              .option("quote", '"').option("escape", '"')      # doubled quotes, as in the header
              .option("mode", "PERMISSIVE").csv(pattern)
              .withColumn("source_file", F.col("_metadata.file_path")))
        if len(groups) > 1:
            names = ", ".join("'" + f.replace("\\", "\\\\").replace("'", "\\'") + "'" for f in files)
            df = df.where(f"source_file IN ({names})")
        out.append(WideGroup(files, list(header), ids, measures, df))
    return out
