"""The whole batch: clean -> three landings in parallel -> final load ->
all-or-nothing publication. Also a ``spark-submit`` entry point.

Every stage leaves its tables in the ledger of the version it writes. A run that
failed is taken up again by its version (``resume``): finished landings are read
from their files and not computed again.

    spark-submit --py-files casaflow.zip casaflow_submit.py --raw s3://bucket/raw \
        --store s3://bucket/warehouse [--lake s3://bucket/processed] \
        [--jdbc-url ... --jdbc-user ... --jdbc-password-env VAR]
"""

from __future__ import annotations

import argparse
import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from casaflow.plans.cleaning import clean_files, cleaning_report
from casaflow.plans.dashboard import export_feeds, stored_panel
from casaflow.plans.final import publish_final, publish_legacy
from casaflow.plans.landing import write_landing
from casaflow.schemas import CLEANING_FILES, DEFAULT_STATE, LANDING_SPECS, METRO_ALIASES
from casaflow.sinks.publish import Publication, current_version, manifest, retire, unfinished
from casaflow.sinks.writers import ensure_jdbc_schema, write_jdbc, write_lake

FINAL_TABLES = ["dim_geography", "fact_house_value", "fact_monthly_payment",
                "fact_rental_income"]
LEGACY_TABLES = ["house_value", "monthly_payment", "rental_income"]


@dataclass
class PipelineConfig:
    raw_dir: str                       # wide CSVs
    store_root: str                    # versioned warehouse
    cleaned_dir: str | None = None     # write cleaned CSVs here when set
    source: str = "raw"                # land from "raw" or "cleaned" files
    lake_root: str | None = None       # optional (state, year) Parquet lake
    jdbc: dict = field(default_factory=dict)  # url, user, password, driver, schema, connections
    aliases: dict = field(default_factory=lambda: dict(METRO_ALIASES))
    alias_house_value: bool = False
    legacy: bool = True
    collation: str | None = None       # e.g. "UNICODE" for the distinct-on order
    feeds_dir: str | None = None       # export dashboard feeds here when set
    state: str | None = DEFAULT_STATE  # dashboard state filter
    cleaning_files: tuple = CLEANING_FILES  # (identifier count, input, output)
    specs: dict = field(default_factory=lambda: dict(LANDING_SPECS))
    keep_versions: int | None = None   # retire older versions after a run when set
    grace_hours: float = 24.0          # a replaced version stays for readers so long


def _landing_job(spark: SparkSession, cfg: PipelineConfig, pub: Publication, spec) -> DataFrame:
    # one scheduler pool per landing (effective with spark.scheduler.mode=FAIR)
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"landing_{spec.name}")
    base = cfg.cleaned_dir if cfg.source == "cleaned" else cfg.raw_dir
    pattern = f"{base.rstrip('/')}/{spec.file_glob}"
    staged = write_landing(spark, pub, spec, pattern)
    if cfg.lake_root:
        write_lake(staged, f"{cfg.lake_root.rstrip('/')}/{spec.name}", spec.partition_cols)
    if cfg.jdbc.get("url"):
        schema = cfg.jdbc.get("schema", "landing")
        table = f"{schema}.{spec.table}" if schema else spec.table
        write_jdbc(staged, cfg.jdbc["url"], table,
                   user=cfg.jdbc.get("user"), password=cfg.jdbc.get("password"),
                   driver=cfg.jdbc.get("driver"), num_partitions=cfg.jdbc.get("connections"))
    return staged


def run(spark: SparkSession, cfg: PipelineConfig, resume: str | None = None) -> str:
    """Run every stage; return the published version. The first failure
    aborts before the commit, so readers keep seeing the previous version.

    ``resume`` is the version of a run that failed, or "last" for the newest one
    (a new run if there is none). What its ledger has is kept: the inputs are
    taken to be the same. A version published since then is merged with; the
    facts and finals of the failed run are dropped for that, its landings stay.
    """
    if cfg.jdbc.get("url") and cfg.jdbc.get("schema", "landing"):
        ensure_jdbc_schema(spark, cfg.jdbc["url"], cfg.jdbc.get("schema", "landing"),
                           user=cfg.jdbc.get("user"), password=cfg.jdbc.get("password"),
                           driver=cfg.jdbc.get("driver"))
    pub = Publication(spark, cfg.store_root, unfinished(spark, cfg.store_root) if resume == "last" else resume)
    if cfg.cleaned_dir and pub.done("files_cleaned") is None:
        report = clean_files(spark, cfg.raw_dir, cfg.cleaned_dir, cfg.cleaning_files)
        pub.write("files_cleaned", cleaning_report(spark, report))
    tag, sc = f"landing-{pub.version}", spark.sparkContext

    def job(spec):
        sc.addJobTag(tag)       # this thread's jobs
        try:
            return _landing_job(spark, cfg, pub, spec)
        except BaseException:
            sc.cancelJobsWithTag(tag)       # the first failure stops the others
            raise
        finally:
            sc.removeJobTag(tag)

    with ThreadPoolExecutor(max_workers=3) as pool:
        futures = {name: pool.submit(job, spec) for name, spec in cfg.specs.items()}
        landings = {name: f.result() for name, f in futures.items()}
    before = current_version(spark, cfg.store_root)
    if before and before > pub.version:
        raise ValueError(f"version {before} was published since {pub.version} began: start a new run")
    if pub.based_on(before):
        pub.forget(FINAL_TABLES + LEGACY_TABLES)
    old = manifest(spark, cfg.store_root, before) if before else {}
    publish_final(spark, pub, landings, old, cfg.aliases, cfg.alias_house_value, cfg.collation)
    if cfg.legacy:
        publish_legacy(spark, pub, landings, old)
    version = pub.commit()
    if cfg.feeds_dir:
        panel = stored_panel(spark, cfg.store_root, cfg.state, version)
        export_feeds(None, None, f"{cfg.feeds_dir.rstrip('/')}/v={version}", cfg.state, panel=panel)
    if cfg.keep_versions:
        retire(spark, cfg.store_root, cfg.keep_versions, cfg.grace_hours)
    return version


def main(argv: list[str] | None = None) -> str:
    ap = argparse.ArgumentParser(description="property-investment batch pipeline")
    ap.add_argument("--raw", required=True)
    ap.add_argument("--store", required=True)
    ap.add_argument("--cleaned")
    ap.add_argument("--source", choices=["raw", "cleaned"], default="raw")
    ap.add_argument("--lake")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-user")
    ap.add_argument("--jdbc-schema", default="landing", help="schema of the landing tables")
    ap.add_argument("--jdbc-connections", type=int, help="most connections a write opens")
    ap.add_argument("--jdbc-driver")
    ap.add_argument("--jdbc-password-env", help="environment variable holding the password")
    ap.add_argument("--alias-house-value", action="store_true")
    ap.add_argument("--feeds", help="export dashboard feeds under this folder")
    ap.add_argument("--state", default=DEFAULT_STATE, help="dashboard state filter")
    ap.add_argument("--collation", help="string order for the dimension's distinct-on")
    ap.add_argument("--resume", help="version of a failed run to go on with, or 'last'")
    ap.add_argument("--keep-versions", type=int, help="retire all but so many published versions after the run")
    ap.add_argument("--grace-hours", type=float, default=24.0, help="time a replaced version is kept for its readers")
    args = ap.parse_args(argv)
    jdbc = {}
    if args.jdbc_url:
        jdbc = {"url": args.jdbc_url, "user": args.jdbc_user, "driver": args.jdbc_driver,
                "schema": args.jdbc_schema, "connections": args.jdbc_connections,
                "password": os.environ.get(args.jdbc_password_env or "", None)}
    from casaflow.session import apply_sizing, get_session
    spark = get_session("casaflow-pipeline")
    apply_sizing(spark, args.raw)
    cfg = PipelineConfig(args.raw, args.store, args.cleaned, args.source, args.lake, jdbc,
                         alias_house_value=args.alias_house_value, feeds_dir=args.feeds,
                         state=args.state, collation=args.collation, keep_versions=args.keep_versions,
                         grace_hours=args.grace_hours)
    return run(spark, cfg, args.resume)


if __name__ == "__main__":
    print(main())
