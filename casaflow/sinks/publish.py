"""All-or-nothing publication of a set of tables.

Each publication is a fresh version directory ``v=<sortable id>``. Every table
written into it leaves an entry in the version's ledger (``_DONE/<table>``), so a
run that is repeated under the same version finds what is finished. The commit
writes a manifest of all entries and then an empty marker (file creation is
atomic on HDFS and object stores alike). Readers take the newest version that has
the marker, so a failure part-way leaves the previous version visible and nothing
is renamed or overwritten in place.

A manifest entry names the folders that make up a table. A table partitioned by
columns may take over single partitions of an older version: they are listed by
the older folder and neither read nor copied. ``retire`` deletes versions that
neither a kept version nor a reader of the last hours can need.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MARKER, MANIFEST, LEDGER = "_PUBLISHED", "_MANIFEST", "_DONE"
#: Beside the versions: what was computed from each and stored for later readers.
PANELS = "_panels"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of what a folder holds."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), int(s.getModificationTime())) for s in fs.listStatus(p)]


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def new_version() -> str:
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{now}-{uuid.uuid4().hex[:8]}"


def versions(spark: SparkSession, root: str) -> list[str]:
    """Published versions, oldest first."""
    root = root.rstrip("/")
    return sorted(n[2:] for n, _ in _children(spark, root) if n.startswith("v=") and _exists(spark, f"{root}/{n}/{MARKER}"))


def current_version(spark: SparkSession, root: str) -> str | None:
    vs = versions(spark, root)
    return vs[-1] if vs else None


def manifest(spark: SparkSession, root: str, version: str) -> dict[str, dict]:
    """The tables of a version: {name: entry}."""
    text = _read_text(spark, f"{root.rstrip('/')}/v={version}/{MANIFEST}")
    return json.loads(text) if text else {}


def read_entry(spark: SparkSession, root: str, entry: dict) -> DataFrame:
    """The table of a manifest entry: one scan for each folder it lies in, so a
    filter on partition columns leaves files unread in every one of them."""
    schema = T.StructType.fromJson(entry["schema"])
    reader = lambda: spark.read.schema(schema)      # noqa: E731
    scans = []
    for folder, parts in sorted(entry["folders"].items()):
        base = f"{root.rstrip('/')}/{folder}"
        scans.append(reader().parquet(base) if parts is None else
                     reader().option("basePath", base).parquet(*[f"{base}/{p}" for p in sorted(parts)]))
    if not scans:
        return spark.createDataFrame([], schema)
    return functools.reduce(DataFrame.unionByName, scans).select(*schema.names)


class Publication:
    """One new version: stage tables, read them back, then commit. Given the
    version of a run that failed, it goes on where that one stopped."""

    def __init__(self, spark: SparkSession, root: str, version: str | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.version = version or new_version()
        self.base = f"{self.root}/v={self.version}"
        if _exists(spark, f"{self.base}/{MARKER}"):
            raise ValueError(f"version {self.version} is already published")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def done(self, name: str) -> dict | None:
        """The ledger's entry of a finished table."""
        text = _read_text(self.spark, f"{self.base}/{LEDGER}/{name}")
        return json.loads(text) if text else None

    def read(self, name: str) -> DataFrame:
        return read_entry(self.spark, self.root, self.done(name))

    def written(self, name: str) -> DataFrame:
        """The part of a table that lies in this version."""
        entry = self.done(name)
        own = {f: p for f, p in entry["folders"].items() if f.startswith(f"v={self.version}/")}
        return read_entry(self.spark, self.root, {**entry, "folders": own})

    def _enter(self, name: str, entry: dict) -> DataFrame:
        _write_text(self.spark, f"{self.base}/{LEDGER}/{name}", json.dumps(entry))
        return read_entry(self.spark, self.root, entry)

    def fresh_path(self, name: str) -> str:
        """A folder of this version that no attempt has written to."""
        path = self.path(name)
        return f"{path}-{uuid.uuid4().hex[:8]}" if _exists(self.spark, path) else path

    def adopt(self, name: str, path: str, schema: T.StructType, partition_cols=()) -> DataFrame:
        """Enter files written under this version by other means as a table;
        a folder that is absent is an empty table."""
        folders = {path[len(self.root) + 1:]: None} if _exists(self.spark, path) else {}
        return self._enter(name, {"schema": json.loads(schema.json()), "partition_cols": list(partition_cols), "folders": folders})

    def write(self, name: str, df: DataFrame, partition_cols=(), carried: dict[str, list[str]] | None = None) -> DataFrame:
        """Write a table of this version and return it read back (lineage cut).

        With ``partition_cols`` rows are dealt by them first, so that a
        partition is few files and a hot one is split by size. A table of one
        partition column can be carried over by partition: ``carried`` adds
        partitions of older versions (folder -> partition folders)."""
        path = self.fresh_path(name)
        w = df.hint("rebalance", *partition_cols).write.partitionBy(*partition_cols) if partition_cols else df.write
        w.mode("errorifexists").parquet(path)
        folder = path[len(self.root) + 1:]
        parts = [n for n, _ in _children(self.spark, path) if "=" in n] if len(partition_cols) == 1 else None
        folders = {folder: parts} if parts is None or parts else {}
        folders |= {f: sorted(p) for f, p in (carried or {}).items() if p}
        return self._enter(name, {"schema": json.loads(df.schema.json()), "partition_cols": list(partition_cols), "folders": folders})

    def based_on(self, version: str | None) -> bool:
        """Note which published version this one's merges start from; True if an
        earlier attempt noted another one."""
        note = f"{self.base}/_BASE"
        former = _read_text(self.spark, note)
        _write_text(self.spark, note, version or "")
        return former is not None and former != (version or "")

    def forget(self, names: list[str]) -> None:
        """Strike tables from the ledger, so that they are written anew."""
        fs, _, jvm = _fs(self.spark, self.base)
        for name in names:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.base}/{LEDGER}/{name}"), False)

    def commit(self) -> str:
        entries = {n: self.done(n) for n, _ in _children(self.spark, f"{self.base}/{LEDGER}") if not n.startswith(".")}
        _write_text(self.spark, f"{self.base}/{MANIFEST}", json.dumps(entries))
        fs, _, jvm = _fs(self.spark, self.base)
        fs.create(jvm.org.apache.hadoop.fs.Path(f"{self.base}/{MARKER}"), False).close()
        return self.version


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame],
            version: str | None = None, partition_cols: dict[str, tuple[str, ...]] | None = None) -> str:
    """Write all ``tables`` under a new version, then mark it published."""
    pub = Publication(spark, root, version)
    for name, df in tables.items():
        pub.write(name, df, (partition_cols or {}).get(name, ()))
    return pub.commit()


def read_current(spark: SparkSession, root: str, names: list[str], version: str | None = None) -> dict[str, DataFrame]:
    """The tables of the newest published (or the given) version ({} before the first one)."""
    version = version or current_version(spark, root)
    if version is None:
        return {}
    entries = manifest(spark, root, version)
    return {n: read_entry(spark, root, entries[n]) for n in names if n in entries}


def unfinished(spark: SparkSession, root: str) -> str | None:
    """The newest version without a marker, if it is newer than every published one."""
    found = sorted(n[2:] for n, _ in _children(spark, root) if n.startswith("v="))
    return found[-1] if found and found[-1] != current_version(spark, root) else None


def retire(spark: SparkSession, root: str, keep: int = 2, grace_hours: float = 24.0, now: dt.datetime | None = None) -> list[str]:
    """Delete what no reader can need and return the versions touched.

    Kept are the newest ``keep`` published versions, every version a newer one
    replaced less than ``grace_hours`` ago (a reader may still be in it), all
    folders that a kept manifest names, and unpublished versions newer than the
    newest published one or younger than that (a run may be writing). Of the
    others the marker goes first, so no reader opens a version that is being
    deleted, then all folders that no kept manifest names.
    """
    root = root.rstrip("/")
    limit = ((now or dt.datetime.now(dt.timezone.utc)) - dt.timedelta(hours=grace_hours)).timestamp() * 1000
    published = versions(spark, root)
    age = {n[2:]: t for n, t in _children(spark, root) if n.startswith("v=")}
    marked = {v: dict(_children(spark, f"{root}/v={v}"))[MARKER] for v in published}
    kept = set(published[-max(1, keep):])
    kept |= {v for v, later in zip(published, published[1:]) if marked[later] > limit}
    kept |= {v for v in age if v not in published and (not published or v > published[-1] or age[v] > limit)}
    needed: dict[str, set[str] | None] = {}       # folder -> its partitions, or None for all of it
    for v in kept:
        for entry in manifest(spark, root, v).values():
            for folder, parts in entry["folders"].items():
                known = needed.get(folder, set())
                needed[folder] = None if parts is None or known is None else known | set(parts)
    fs, _, jvm = _fs(spark, root)
    remove = lambda path: fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)      # noqa: E731
    gone = sorted(set(age) - kept)
    for v in gone:
        base = f"{root}/v={v}"
        remove(f"{base}/{MARKER}")
        for name, _ in _children(spark, base):
            folder = f"v={v}/{name}"
            if folder not in needed and not any(f.startswith(f"{folder}/") for f in needed):
                remove(f"{base}/{name}")
            elif needed.get(folder) is not None:
                for part, _ in _children(spark, f"{base}/{name}"):
                    if "=" in part and part not in needed[folder]:
                        remove(f"{base}/{name}/{part}")
        if not _children(spark, base):
            remove(base)
        remove(f"{root}/{PANELS}/{v}")
    return gone
