"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def local_session(app: str = "clickloom", cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g") -> SparkSession:
    """A session for tests and single-machine runs; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset, a cluster's checkpoint or
    warehouse folder is taken, but no warehouse on a local disk, which every worker would have for
    itself; only a local session falls back to a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not root and context._jsc.sc().getCheckpointDir().isDefined():
        root = context._jsc.sc().getCheckpointDir().get()
    if not root and not context.master.startswith("local"):
        root = spark.conf.get("spark.sql.warehouse.dir")
        if root.startswith(("file:", "/")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="clickloom-")
        root = _local_roots[context.applicationId]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder; never reused, so no stale data can be read."""
    return f"{scratch_root(spark)}/clickloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Lets tasks import this package, once per application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="clickloom-")) / "clickloom.zip"  # the driver's; Spark hands it to executors
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(application)


def derived(spark: SparkSession, settings: dict[str, object]) -> SparkSession:
    """A session of the same application with this one's settings and some of its own; the given one stays as it is."""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if other.conf.get(key, None) != value:
            other.conf.set(key, value)
    for key, value in settings.items():
        other.conf.set(key, value)
    return other
