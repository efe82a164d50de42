"""Reading the given tables and keeping intermediate ones."""

from __future__ import annotations

import gc
import tempfile
import time
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import broadcast

import clickloom
from clickloom.session import scratch_path

Batches = Iterator[pa.RecordBatch]


#: bytes of an Arrow batch: documents are long, and a worker holds a few copies of a batch
BATCH_BYTES = 2 << 20
_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Makes a session ready for these operators, once: tasks can import the package, and Arrow batches are bounded."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(clickloom.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="clickloom-")) / "clickloom.zip"  # the driver's; Spark hands it to executors
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(application)
    if int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: lineage ends here, lost executors cost no rework."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidied(spark: SparkSession) -> None:
    """Lets shuffle files of finished jobs go: Spark deletes them when the driver collects garbage, which may be late.

    What Python drops is let go in the JVM by a thread of its own; a collection before that finds it still held.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(0.5)
        spark._jvm.System.gc()


def dropped(df: DataFrame) -> None:
    """Deletes a stored table that nothing reads any more."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent() if df.inputFiles() else None
    if folder:
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def hinted(df: DataFrame, rows: int = 50_000) -> DataFrame:
    """A stored table of narrow rows, with a broadcast hint if it has few; else a join shuffles, and splits hot keys."""
    return broadcast(df) if df.limit(rows + 1).count() <= rows else df


def by_batch(work: Callable[..., Iterable[dict]], names: list[str], *args) -> Callable[[Batches], Batches]:
    """A function for mapInArrow: ``work(batch, *args)`` yields dicts of columns."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for columns in work(batch, *args):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c) for c in (columns[n] for n in names)], names)

    return run


def gathered(batches: Batches, limit: int) -> Batches:
    """Small batches joined to some of up to ``limit`` bytes."""
    parts, size = [], 0
    for batch in batches:
        if parts and size + batch.nbytes > limit:
            yield from pa.Table.from_batches(parts).combine_chunks().to_batches()
            parts, size = [], 0
        parts.append(batch)
        size += batch.nbytes
    if parts:
        yield from pa.Table.from_batches(parts).combine_chunks().to_batches()


def names_of(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have yet."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
