"""Named tables, in one folder or in the session catalog."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from clickloom.sources import storage


class TableFolder(Mapping):
    """Parquet tables under ``base``; reading gives DataFrames, ``put`` creates or replaces."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self[name]

    def append(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("append").parquet(self.path(name))
        return self[name]

    def view(self, name: str, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(name)
        return df

    def register(self) -> None:
        """Expose every table of the folder as a temp view of its name."""
        for name in self:
            self[name].createOrReplaceTempView(name)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self:
            raise KeyError(name)
        return self.spark.read.parquet(self.path(name))

    def __contains__(self, name: object) -> bool:
        return storage.exists(self.spark, f"{self.path(str(name))}/_SUCCESS")

    def __iter__(self) -> Iterator[str]:
        hits = storage.list_files(self.spark, f"{self.base}/*/_SUCCESS")
        return iter(sorted(path.rsplit("/", 2)[1] for path, _, _ in hits))

    def __len__(self) -> int:
        return sum(1 for _ in self)


class CatalogTables(Mapping):
    """Tables and views of the session catalog by name, read only."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self:
            raise KeyError(name)
        return self.spark.table(name)

    def __contains__(self, name: object) -> bool:
        return self.spark.catalog.tableExists(str(name))

    def __iter__(self) -> Iterator[str]:
        return iter([t.name for t in self.spark.catalog.listTables()])

    def __len__(self) -> int:
        return len(self.spark.catalog.listTables())
