"""File ingest: raw CSV to raw_events, quarantine and pipeline_logs.

The files are parsed once. Accepted rows, rejected rows and reasons land in one table partitioned
by run and source file. The run's log is one file, written after all its rows: that is the commit.
raw_events and quarantine follow the log, so they show a run as a whole or not at all, and a run
that breaks off leaves what was there before.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from clickloom.operators import validate
from clickloom.schema import EVENT_COLUMNS
from clickloom.sources import csv_files, storage
from clickloom.sources.tables import TableFolder

LANDED = "landed_events"
LOGS = "pipeline_logs"
QUARANTINE_CSV = "quarantine_csv"


_LANDED_SCHEMA = ", ".join(
    [f"`{c}` {'timestamp_ntz' if c == 'timestamp' else 'string'}" for c in EVENT_COLUMNS]
    + [f"`raw_{c}` string" for c in EVENT_COLUMNS]
    + ["error_reason string", "is_valid boolean", "run_id string", "source_file string"]
)
_LOG_SCHEMA = (
    "run_id string, filename string, run_timestamp timestamp_ntz, rows_read bigint, rows_inserted bigint, "
    "rows_quarantined bigint, status string, load_mode string, load_no bigint"
)


def land(annotated: DataFrame, run_id: str) -> DataFrame:
    """Layout of the landed table: typed columns for accepted rows, raw cells for rejected ones."""
    ok = F.col("is_valid")
    return annotated.select(
        *[F.when(ok, F.col(c)).alias(c) for c in EVENT_COLUMNS],
        *[F.when(~ok, F.col(f"raw_{c}")).alias(f"raw_{c}") for c in EVENT_COLUMNS],
        F.when(~ok, F.array_join("errors", " | ")).alias("error_reason"),
        "is_valid",
        F.lit(run_id).alias("run_id"),
        "source_file",
    )


def _partitions(tables: TableFolder, run_id: str | None = None) -> DataFrame:
    """All landed rows, or those of one run, committed or not."""
    # the schema is given, as file names in partition values must stay text
    path = tables.path(LANDED)
    reader = tables.spark.read.schema(_LANDED_SCHEMA).option("basePath", path)
    if run_id is None:
        return reader.parquet(path)
    own = f"{path}/run_id={run_id}"  # only this folder is listed, however long the history
    return reader.parquet(own if storage.exists(tables.spark, own) else path).where(F.col("run_id") == run_id)


def log(tables: TableFolder) -> DataFrame:
    """One row per committed run and file; none before the first commit."""
    return tables[LOGS] if LOGS in tables else tables.spark.createDataFrame([], _LOG_SCHEMA)


def current(runs: DataFrame) -> DataFrame:
    """The (run_id, source_file) whose rows count: a file's runs from the last on that replaced it."""
    at = F.struct("load_no", "run_id")
    last = runs.groupBy("filename").agg(F.max(F.when(F.col("load_mode") == "replace", at)).alias("since"))
    return runs.join(last, "filename").where(F.col("since").isNull() | (at >= F.col("since"))).select(
        "run_id", F.col("filename").alias("source_file"))


def landed(tables: TableFolder) -> DataFrame:
    return _partitions(tables).join(current(log(tables)), ["run_id", "source_file"], "left_semi")


def raw_events(tables: TableFolder) -> DataFrame:
    return validate.valid_events(landed(tables), "source_file")


def _rejected(rows: DataFrame) -> DataFrame:
    return rows.where("NOT is_valid").select(
        "source_file", *[F.col(f"raw_{c}").alias(c) for c in EVENT_COLUMNS], "error_reason"
    )


def quarantine(tables: TableFolder) -> DataFrame:
    return _rejected(landed(tables))


def write_quarantine_csv(rejected: DataFrame, path: str) -> None:
    """Rejected rows as CSV, one folder per source file, replacing that file's earlier output."""
    (
        rejected.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("escape", '"')
        .partitionBy("source_file")
        .csv(path)
    )


def ingest(spark: SparkSession, pattern: str, base: str, *, mode: str = "replace",
           run_timestamp: datetime | None = None) -> DataFrame:
    """Validate the files of a glob into the tables under ``base``; returns this run's log.

    ``mode="replace"`` makes a second run over the same files a no-op for the data: the files'
    earlier rows stop to count with this run's commit and are deleted after it. ``mode="append"``
    adds the rows again. The quarantine CSV is written last, from committed rows; if that breaks
    off, another run of the files makes it anew.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode must be 'replace' or 'append', not {mode!r}")
    run_timestamp = run_timestamp or datetime.now(timezone.utc).replace(tzinfo=None)
    run_id = uuid.uuid4().hex
    tables = TableFolder(spark, base)

    files = csv_files.discover(spark, pattern)
    annotated = validate.annotate(csv_files.read_events(spark, files))
    land(annotated, run_id).write.mode("append").partitionBy("run_id", "source_file").parquet(tables.path(LANDED))

    mine = _partitions(tables, run_id)
    before = log(tables)
    load_no = before.agg(F.coalesce(F.max("load_no"), F.lit(0)) + 1).first()[0]
    rows = validate.file_log(mine, run_timestamp, run_id, csv_files.file_list(spark, files)).withColumns(
        {"load_mode": F.lit(mode), "load_no": F.lit(load_no).cast("bigint")})
    # one file, no longer than the list of files, so that it appears at once: the commit
    tables.append(LOGS, rows.repartition(1))
    written = log(tables).where(F.col("run_id") == run_id)

    if mode == "replace":
        older = current(log(tables).where(F.col("load_no") < load_no))
        _delete(spark, tables, older.join(written.select(F.col("filename").alias("source_file")), "source_file", "left_semi"))
    # the CSV files hold this run's rejected rows only
    csv_path = tables.path(QUARANTINE_CSV)
    _drop(spark, (f"{csv_path}/source_file={_escaped(spark, row['filename'])}"
                  for row in written.where("rows_quarantined = 0").select("filename").toLocalIterator()))
    write_quarantine_csv(_rejected(mine), csv_path)
    return written


def vacuum(spark: SparkSession, base: str) -> None:
    """Deletes landed rows that no longer count or never did, as of runs that broke off; while no ingest runs."""
    tables = TableFolder(spark, base)
    there = _partitions(tables).select("run_id", "source_file").distinct()
    _delete(spark, tables, there.join(current(log(tables)), ["run_id", "source_file"], "left_anti"))


def _escaped(spark: SparkSession, value: str) -> str:
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def _delete(spark: SparkSession, tables: TableFolder, gone: DataFrame) -> None:
    _drop(spark, (f"{tables.path(LANDED)}/run_id={row['run_id']}/source_file={_escaped(spark, row['source_file'])}"
                  for row in gone.select("run_id", "source_file").toLocalIterator()))


def _drop(spark: SparkSession, paths: Iterable[str], threads: int = 16) -> None:
    with ThreadPoolExecutor(threads) as pool:
        for _ in pool.map(lambda path: storage.delete(spark, path), paths):
            pass


def dry_run(spark: SparkSession, pattern: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Validation without loading: header report, totals, most frequent messages."""
    files = csv_files.discover(spark, pattern)
    annotated = validate.annotate(csv_files.read_events(spark, files))
    per_file = csv_files.file_list(spark, files).join(
        annotated.groupBy("source_file").agg(
            F.count_if("is_valid").alias("passed"), F.count_if(~F.col("is_valid")).alias("failed")
        ),
        "source_file", "left",
    )
    return (
        csv_files.header_report(spark, files),
        validate.totals(per_file),
        validate.top_errors(annotated),
    )
