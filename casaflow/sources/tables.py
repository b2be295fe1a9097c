"""Relational scans of landing / dimension / fact tables (Parquet or JDBC)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``root/name.parquet`` if present as a file/dir name, else ``root/name``."""
    path = f"{root.rstrip('/')}/{name}"
    named = spark._jvm.org.apache.hadoop.fs.Path(path + ".parquet")
    there = named.getFileSystem(spark._jsc.hadoopConfiguration()).exists(named)
    return spark.read.parquet(path + ".parquet" if there else path)


def read_jdbc(spark: SparkSession, url: str, table: str, *, user: str | None = None,
              password: str | None = None, driver: str | None = None,
              partition_column: str | None = None, lower_bound=None,
              upper_bound=None, num_partitions: int | None = None,
              fetchsize: int = 10000) -> DataFrame:
    """Parallel JDBC scan; give a numeric partition column for large tables so
    each executor reads its own range instead of one connection reading all."""
    r = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
         .option("fetchsize", fetchsize))
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", lower_bound).option("upperBound", upper_bound)
             .option("numPartitions", num_partitions or 8))
    return r.load()
