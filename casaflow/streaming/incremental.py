"""Structured Streaming form of the landing job.

New wide files dropped into a folder are landed as they arrive, with the same
unpivot / parse / filter steps as the batch job. A stream has one schema, so
the header is declared up front (``header``); files whose header differs
fail the ``enforceSchema=False`` check instead of being mis-mapped.

Two sinks:
* ``stream_to_lake`` appends to a (state, year)-partitioned Parquet table
  with exactly-once file commits from the checkpoint;
* ``stream_upsert`` keeps a keyed table (region_id, metric_date) current as
  an append-only change log, resolved on read (newest row per key) and
  periodically compacted into a published snapshot — each micro-batch writes
  only its own rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casaflow.plans.landing import finish_landing, long_cells
from casaflow.schemas import LandingSpec
from casaflow.sinks.publish import Publication, current_version, read_current
from casaflow.sources.wide_csv import WideGroup, wide_schema
from casaflow.operators.merge import assert_unique


def landing_stream(spark: SparkSession, spec: LandingSpec, source_dir: str,
                   header: list[str], max_files_per_trigger: int = 100) -> DataFrame:
    schema, ids, measures = wide_schema(header, list(spec.id_cols), None)
    raw = (spark.readStream.schema(schema).option("header", True)
           .option("enforceSchema", False).option("maxFilesPerTrigger", max_files_per_trigger)
           .option("pathGlobFilter", spec.file_glob)
           .csv(source_dir)
           .withColumn("source_file", F.col("_metadata.file_path")))
    cells = long_cells([WideGroup([], header, ids, measures, raw)], min_date=spec.min_date)
    return finish_landing(cells, spec, ids)


def stream_to_lake(stream: DataFrame, path: str, checkpoint: str,
                   partition_cols=("state", "year")) -> StreamingQuery:
    return (stream.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).partitionBy(*partition_cols)
            .trigger(availableNow=True).start())


def stream_upsert(stream: DataFrame, log_root: str, checkpoint: str,
                  keys=("region_id", "metric_date")) -> StreamingQuery:
    """Upsert micro-batches as an append-only change log (merge on read).

    Each micro-batch writes only its own rows to ``log_root/batch=<id>``;
    a replayed batch overwrites its own folder, so the log is exactly-once.
    Write cost is proportional to the batch, not to the table; the current
    table is resolved by ``read_upserted`` and folded into a snapshot by
    ``compact``. Duplicate keys inside one batch fail it.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # checked and written: compute the micro-batch once
        try:
            assert_unique(batch, list(keys), "micro-batch")
            (batch.write.mode("overwrite")
             .parquet(f"{log_root.rstrip('/')}/batch={batch_id:012d}"))
        finally:
            batch.unpersist()

    return (stream.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _latest(rows: DataFrame, keys: list[str], first_cols=("inserted_at",)) -> DataFrame:
    """Newest row per key by ``batch``; ``first_cols`` keep their first value
    (e.g. the first insertion time). A plain aggregate with map-side
    combine: a key's group is the number of batches that touched it. A row
    with a null key part has no key, as in a unique index, and stays."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    keyless = rows.where(~whole).drop("batch")
    rows = rows.where(whole)
    cols = [c for c in rows.columns if c not in keys and c != "batch"]
    later = [c for c in cols if c not in first_cols]
    aggs = [F.max_by(F.struct(*[F.col(c) for c in later]), F.col("batch")).alias("_last")]
    aggs += [F.min(c).alias(c) for c in cols if c in first_cols]
    out = rows.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in later],
                      *[c for c in cols if c in first_cols]).unionByName(keyless)


def _log(spark: SparkSession, log_root: str, after: int | None) -> DataFrame | None:
    from casaflow.sources.wide_csv import _fs_and_path
    fs, p = _fs_and_path(spark, log_root)
    if not fs.exists(p):
        return None
    batches = [st.getPath().getName() for st in fs.listStatus(p)
               if st.getPath().getName().startswith("batch=")]
    if after is not None:
        batches = [b for b in batches if int(b.split("=")[1]) > after]
    if not batches:
        return None
    return (spark.read.option("basePath", log_root)
            .parquet(*[f"{log_root.rstrip('/')}/{b}" for b in batches])
            .withColumn("batch", F.col("batch").cast("long")))


def read_upserted(spark: SparkSession, log_root: str, keys=("region_id", "metric_date"),
                  snapshot_root: str | None = None, table: str = "upserted") -> DataFrame | None:
    """The current keyed table: the newest published snapshot (if any) plus
    the log batches after it, newest row per key."""
    base, upto = None, None
    if snapshot_root:
        version = current_version(spark, snapshot_root)
        if version is not None:
            upto = int(version.split("-")[1])
            base = (read_current(spark, snapshot_root, [table])[table]
                    .withColumn("batch", F.lit(-1).cast("long")))
    log = _log(spark, log_root, upto)
    parts = [d for d in (base, log) if d is not None]
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _latest(rows, list(keys))


def compact(spark: SparkSession, log_root: str, snapshot_root: str,
            keys=("region_id", "metric_date"), table: str = "upserted") -> str | None:
    """Fold the log up to its newest batch into a published snapshot
    ``v=<snapshot>-<last batch>``; later reads start from it."""
    from casaflow.sources.wide_csv import _fs_and_path
    fs, p = _fs_and_path(spark, log_root)
    if not fs.exists(p):
        return None
    ids = [int(st.getPath().getName().split("=")[1]) for st in fs.listStatus(p)
           if st.getPath().getName().startswith("batch=")]
    if not ids:
        return None
    last = max(ids)
    done = current_version(spark, snapshot_root)
    if done is not None and int(done.split("-")[1]) >= last:
        return done         # nothing new since the last snapshot
    merged = read_upserted(spark, log_root, keys, snapshot_root, table)
    # batches newer than `last` that land while compacting stay in the log
    pub = Publication(spark, snapshot_root, f"snapshot-{last:012d}-{uuid.uuid4().hex[:8]}")
    pub.write(table, merged)
    return pub.commit()
