"""Session construction and the shared scratch location.

Lineage is cut by writing to the folder the cluster names in
``spark.checkpoint.dir``; a private temporary folder is only created when the
setting is absent (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "casaflow", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on, UTC time and no UI."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a private one only when none is configured."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not (sc.master or "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="casaflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``casaflow`` importable in the Python workers: the package's sources
    go out once per application as a zip (Spark serves it to the executors)."""
    sc = spark.sparkContext
    with _SHIPPING:         # landings run in threads
        if getattr(sc, "_casaflow_shipped", False):
            return
        package = os.path.dirname(os.path.abspath(__file__))
        if os.path.isdir(package):      # already a zip on sys.path under spark-submit --py-files
            path = os.path.join(tempfile.mkdtemp(prefix="casaflow-py-"), "casaflow_src.zip")
            with zipfile.ZipFile(path, "w") as z:
                for folder, _, names in os.walk(package):
                    for name in names:
                        if name.endswith(".py"):
                            full = os.path.join(folder, name)
                            z.write(full, os.path.relpath(full, os.path.dirname(package)))
            sc.addPyFile(path)
        sc._casaflow_shipped = True


_SCOPES = threading.local()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared scratch root and read it back:
    lineage ends at files that survive executors, and later plans get column
    pruning, pushed filters and size statistics."""
    path = scratch_path(df.sparkSession, name)
    for made in _SCOPES.__dict__.get("open", []):
        made.append((name, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, keep: set[str]) -> Iterator[None]:
    """Tables that this thread materialises inside are deleted at the end but
    for those named in ``keep``. For steps whose result is stored itself: nothing
    that is still to be computed may read the others."""
    scopes = _SCOPES.__dict__.setdefault("open", [])
    made: list[tuple[str, str]] = []
    scopes.append(made)
    try:
        yield
    finally:
        scopes.remove(made)
        path = spark._jvm.org.apache.hadoop.fs.Path
        for name, where in made:
            if name not in keep:
                path(where).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(where), True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


MB = 1 << 20


def sizing(input_bytes: int, total_cores: int, target_split: int = 256 * MB,
           target_shuffle: int = 200 * MB, shuffle_fraction: float = 1.0) -> dict[str, str]:
    """Partition settings for an input of ``input_bytes`` on ``total_cores``.

    Scan splits aim at ``target_split`` but shrink so every core gets at
    least ~3 splits (and never below 32 MB). The shuffle partition count aims
    at ``target_shuffle`` bytes per partition and at least 3 waves of the
    cores; AQE coalesces small partitions and splits skewed ones toward the
    advisory size.
    """
    cores = max(1, total_cores)
    split = min(target_split, max(32 * MB, input_bytes // (3 * cores) or 32 * MB))
    shuffled = int(input_bytes * shuffle_fraction)
    partitions = max(3 * cores, -(-shuffled // target_shuffle))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
    }


def input_size(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path`` from file-system metadata (no data read)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def apply_sizing(spark: SparkSession, path: str) -> dict[str, str]:
    """Size the session's partitions for the data under ``path``."""
    cores = spark.sparkContext.defaultParallelism
    conf = sizing(input_size(spark, path), cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
