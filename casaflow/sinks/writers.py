"""Writers. Every write goes to a directory of part files, one per task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header row, no index; output is a directory of part files."""
    df.write.mode(mode).option("header", True).csv(path)


def write_lake(df: DataFrame, path: str, partition_cols=("state", "year"),
               mode: str = "overwrite", dynamic: bool = False) -> None:
    """Parquet lake partitioned by e.g. (state, year).

    A ``rebalance`` hint clusters rows by the partition columns, so each task
    writes into few directories (not every task into every directory), and
    lets AQE split an oversized (hot) partition value across several tasks
    instead of one task writing it alone. An overwrite replaces the whole lake;
    with ``dynamic`` only the partitions present in ``df``.
    """
    w = (df.hint("rebalance", *partition_cols).write.mode(mode)
         .option("partitionOverwriteMode", "dynamic" if dynamic else "static"))
    w.partitionBy(*partition_cols).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, *, user: str | None = None,
               password: str | None = None, driver: str | None = None,
               mode: str = "overwrite", num_partitions: int | None = None,
               batchsize: int = 10000, truncate: bool = False) -> None:
    """JDBC write; ``num_partitions`` caps concurrent connections so a large
    cluster does not open one connection per task against the database. The
    cap is a repartition, not a coalesce, so the stage computing ``df`` keeps
    its full parallelism and only the write narrows."""
    out = df.repartition(num_partitions) if num_partitions else df
    w = (out.write.format("jdbc").mode(mode).option("url", url)
         .option("dbtable", table).option("batchsize", batchsize)
         .option("truncate", str(truncate).lower()))
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            w = w.option(k, v)
    w.save()


def ensure_jdbc_schema(spark, url: str, schema: str, *, user: str | None = None,
                       password: str | None = None, driver: str | None = None) -> None:
    """Create a database schema if it is absent (JDBC writes create tables,
    not schemas). Runs one statement on the driver through the JVM's JDBC
    ``DriverManager``; "already exists" is not an error."""
    jvm = spark._jvm
    if driver:
        jvm.java.lang.Class.forName(driver)
    props = jvm.java.util.Properties()
    if user is not None:
        props.setProperty("user", user)
    if password is not None:
        props.setProperty("password", password)
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        meta = conn.getMetaData().getSchemas()
        names = set()
        while meta.next():
            names.add(meta.getString(1).lower())
        if schema.lower() not in names:
            conn.createStatement().execute(f"CREATE SCHEMA {schema}")
    finally:
        conn.close()


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def replace_folders(spark: SparkSession, staging: str, target: str, names: list[str]) -> None:
    """Put the folders ``staging/<name>`` in the places ``target/<name>``. What
    stood there moves into ``staging`` first; if a move fails, all moves made are
    taken back and the error is raised."""
    fs, _ = _path(spark, staging)
    path = spark._jvm.org.apache.hadoop.fs.Path
    moved: list[tuple[str, str]] = []

    def move(a: str, b: str) -> None:
        if not fs.rename(path(a), path(b)):
            raise OSError(f"could not move {a} to {b}")
        moved.append((a, b))

    try:
        for name in names:
            if fs.exists(path(f"{target}/{name}")):
                move(f"{target}/{name}", f"{staging}/_former-{name}")
            move(f"{staging}/{name}", f"{target}/{name}")
    except Exception:
        for a, b in reversed(moved):
            fs.rename(path(b), path(a))
        raise
