"""Relational databases through Spark's JDBC source; the caller supplies the driver."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Ranges of a numeric or date column, one task each; rows beyond the bounds go to the
    first and the last of them."""

    column: str
    lower: object
    upper: object
    parts: int


@dataclass(frozen=True)
class JdbcDatabase:
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)

    def table(
        self, spark: SparkSession, name: str, split: Split | None = None
    ) -> DataFrame:
        """A whole table; with ``split`` read by several tasks, else by one."""
        reader = spark.read.format("jdbc").options(**self.read_options(name, split))
        return reader.load()

    def read_options(self, name: str, split: Split | None = None) -> dict[str, str]:
        options = {**self.properties, "url": self.url, "dbtable": name}
        if split is not None:
            options |= {
                "partitionColumn": split.column, "lowerBound": str(split.lower),
                "upperBound": str(split.upper), "numPartitions": str(split.parts),
            }
        return options

    def query(self, spark: SparkSession, sql: str) -> DataFrame:
        reader = spark.read.format("jdbc").options(**self.properties)
        return reader.option("url", self.url).option("query", sql).load()

    def append(self, rows: DataFrame, table: str) -> None:
        rows.write.mode("append").jdbc(self.url, table, properties=dict(self.properties))
