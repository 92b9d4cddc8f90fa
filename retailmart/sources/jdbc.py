"""Relational databases over JDBC: partitioned scans, appends and refreshes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """Where a database is, and how hard to load it."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)  # holds the password
    connections: int = 8
    rows_per_batch: int = 10_000

    def scan_options(self, table: str, column: str | None = None, lower: int = 0, upper: int = 0) -> dict[str, str]:
        options = {"url": self.url, "dbtable": table, "fetchsize": str(self.rows_per_batch), **self.properties}
        if column is not None:
            options |= {
                "partitionColumn": column,
                "lowerBound": str(lower),
                "upperBound": str(upper),
                "numPartitions": str(self.connections),
            }
        return options

    def write_options(self, table: str) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": table,
            "numPartitions": str(self.connections),
            "batchsize": str(self.rows_per_batch),
            **self.properties,
        }

    def scan(self, spark: SparkSession, table: str, column: str | None = None) -> DataFrame:
        """The table; split by ranges of a numeric ``column`` into one task per connection.

        The database gives the bounds, one row. Rows outside them are still read.
        """
        if column is None:
            return spark.read.format("jdbc").options(**self.scan_options(table)).load()
        bounds = f"(select min({column}) as low, max({column}) as high from {table}) bounds"
        found = spark.read.format("jdbc").options(**self.scan_options(bounds)).load().first()
        low, high = (int(found[0] or 0), int(found[1] or 0))
        return spark.read.format("jdbc").options(**self.scan_options(table, column, low, high + 1)).load()

    def append(self, df: DataFrame, table: str) -> None:
        """Insert from the executors; columns the table fills itself are left out of ``df``."""
        df.write.format("jdbc").options(**self.write_options(table)).mode("append").save()

    def refresh(self, df: DataFrame, table: str, cascade: bool = False) -> None:
        """Empty the table, keep its definition, and insert from the executors.

        ``cascade`` also empties the tables that refer to it, where the database knows how:
        for refreshes that go on to refill those tables.
        """
        writer = df.write.format("jdbc").options(**self.write_options(table))
        writer.option("truncate", True).option("cascadeTruncate", cascade).mode("overwrite").save()
