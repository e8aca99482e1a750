"""Stored results that later joins read without an exchange."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Colocated:
    """Tables bucketed alike by one key, one file a bucket.

    Joins and aggregates on the key then find their rows in place.  ``prefix``
    names the tables (``prefix_name``) and ``path`` their common folder; a
    table that is there already is replaced.
    """

    spark: SparkSession
    prefix: str
    key: str
    path: str | None = None
    buckets: int = 64
    names: list[str] = field(default_factory=list)

    def store(self, name: str, rows: DataFrame) -> DataFrame:
        """Write ``rows`` once; returns the table."""
        table = f"{self.prefix}_{name}"
        # One task a bucket writes one sorted file, so the buckets' order counts.
        dealt = rows.repartition(self.buckets, self.key).sortWithinPartitions(self.key)
        writer = (dealt.write.mode("overwrite").format("parquet")
                  .bucketBy(self.buckets, self.key).sortBy(self.key))
        (writer.option("path", f"{self.path}/{name}") if self.path else writer).saveAsTable(table)
        if table not in self.names:
            self.names.append(table)
        return self.spark.table(table)

    def drop(self) -> None:
        for table in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.names.clear()
