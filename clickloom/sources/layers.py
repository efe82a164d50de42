"""Derived tables shared by the registered queries of one session.

Raw cells, accepted and staged events and the tables built from them are written once under the shared scratch
folder and read back, as a warehouse keeps them: several branches of a query and many queries
read them, each pruned to the columns it needs. A table is made again when the input changes.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from clickloom.operators import (
    attribution, identity, matching, orders, sessions as session_ops, stage, validate,
)
from clickloom.session import scratch_path
from clickloom.sources import csv_files, recipe, storage
from clickloom.sources.tables import TableFolder

_made: dict[tuple, str] = {}
_schemas: dict[str, StructType] = {}
_lock = threading.Lock()
_locks: dict[tuple, threading.Lock] = {}


def _write_csv_shapes(raw: DataFrame, path: str) -> None:
    """Rows by event_id % 3: plain headers and an extra column; camel case; split date and time."""
    camel = {
        "client_id": "clientId", "page_url": "pageUrl", "referrer": "Referrer", "timestamp": "timestamp",
        "event_name": "eventName", "event_data": "eventData", "user_agent": "userAgent",
    }
    plain = ["client_id", "page_url", "referrer", "timestamp", "event_name", "event_data", "user_agent"]
    part = [raw.where(F.col("event_id") % 3 == number) for number in range(3)]
    shapes = [
        part[0].select(*reversed(plain), F.col("event_id").alias("row_no")),
        part[1].select(*[F.col(c).alias(camel[c]) for c in plain]),
        part[2].select(
            "client_id", "page_url", F.substring("timestamp", 1, 10).alias("Date"),
            F.expr("substring(timestamp, 12)").alias("Time"), "event_name", "event_data", "user_agent",
        ),
    ]
    for number, shape in enumerate(shapes):
        (
            shape.write.option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(f"{path}/shape{number}")
        )


class Layers:
    """Lazy and written layers over ``<sf_dir>/events.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._input = storage.version(spark, f"{sf_dir}/events.parquet")

    def _folder(self, name: str, write) -> str:
        """Path of a folder that ``write(path)`` fills, unless this session did so before."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self._input, name)
        with _lock:
            making = _locks.setdefault(key, threading.Lock())
        with making:  # who comes second waits, rather than make it twice
            path = _made.get(key)
            if path is None or not storage.exists(self.spark, path):
                path = scratch_path(self.spark, name)
                write(path)
                _made[key] = path
        return path

    def _written(self, name: str, make) -> DataFrame:
        def write(path: str) -> None:
            df = make()
            df.write.parquet(path)
            _schemas[path] = df.schema

        path = self._folder(name, write)
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def raw(self) -> DataFrame:
        """Raw clickstream cells: what the event files would hold."""
        return self._written("raw", lambda: recipe.raw_clickstream(self.spark, self.sf_dir))

    def csv_pattern(self) -> str:
        """The raw cells as CSV files of three header shapes, written once."""
        raw = self.raw()
        return self._folder("raw_csv", lambda target: _write_csv_shapes(raw, target)) + "/*/part-*.csv"

    def csv_files(self) -> list[csv_files.SourceFile]:
        return csv_files.discover(self.spark, self.csv_pattern())

    def tables(self, name: str, fill: Callable[[str], None]) -> TableFolder:
        """A table folder that ``fill`` makes, once."""
        return TableFolder(self.spark, self._folder(name, fill))

    def annotated(self) -> DataFrame:
        return validate.annotate(self.raw())

    def valid(self) -> DataFrame:
        """Accepted events, as ingest stores them."""
        return self._written(
            "raw_events", lambda: validate.valid_events(self.annotated(), "event_id")
        )

    def log(self, run_timestamp: datetime) -> DataFrame:
        """Audit log of one ingest run over the source files."""
        return self._written(
            f"pipeline_logs_{run_timestamp:%Y%m%d%H%M%S}",
            lambda: validate.file_log(self.annotated(), run_timestamp),
        )

    def stg(self) -> DataFrame:
        return self._written("stg_events", lambda: stage.stage_events(self.valid(), "event_id"))

    def user_map(self) -> DataFrame:
        return self._written("dim_user_map", lambda: identity.stitch_identity(self.stg()))

    def sessions(self, gap_minutes: int) -> DataFrame:
        return self._written(
            f"dim_sessions_{gap_minutes}",
            lambda: session_ops.session_rollup(self.stg(), self.user_map(), gap_minutes),
        )

    def purchases(self) -> DataFrame:
        return self._written(
            "purchases", lambda: attribution.purchases(self.stg(), self.user_map())
        )

    def attribution(self, gap_minutes: int) -> DataFrame:
        return self._written(
            f"fct_attribution_{gap_minutes}",
            lambda: attribution.attribute(self.purchases(), self.sessions(gap_minutes)),
        )

    def order_items(self) -> DataFrame:
        return self._written("fct_order_items", lambda: orders.order_items(self.stg()))

    def session_minutes(self, gap_minutes: int) -> DataFrame:
        return self._written(
            f"session_minutes_{gap_minutes}",
            lambda: matching.session_minutes(self.stg(), self.sessions(gap_minutes)),
        )
