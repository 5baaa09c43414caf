"""A stored set of keys in buckets, against which new rows are compared without moving it.

The keys lie in a fixed number of buckets by their hash. A join on the key reads them bucket by bucket: only the new rows are shuffled,
into as many partitions. The number of buckets is kept beside the keys; a session that opens the set declares the table over its
folder again.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import md5

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from articleloom.operators.quality import keep_first

BUCKETS = 200


@dataclass
class KeySet:
    """The keys stored below ``path``, and the name under which this session knows their table."""

    spark: SparkSession
    path: str
    key: str
    buckets: int
    table: str

    @staticmethod
    def open(spark: SparkSession, path: str, key: str = "pmid", buckets: int = BUCKETS) -> KeySet:
        """Open the set, or create it with so many buckets; a set that is there keeps the number it was created with."""
        path = path.rstrip("/")
        try:
            key, buckets = spark.read.schema("key string, buckets int").json(f"{path}/layout").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            spark.createDataFrame([(key, buckets)], "key string, buckets int").coalesce(1).write.json(f"{path}/layout")
        table = f"keys_{md5(path.encode(), usedforsecurity=False).hexdigest()}"
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (`{key}` STRING) USING parquet "
            f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{quoted}/keys'")
        return KeySet(spark, path, key, buckets, table)

    def keys(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, rows: DataFrame) -> None:
        """Add the keys of these rows, which must not be in the set: one file for each bucket they fall in."""
        keys = rows.select(F.col(self.key).cast("string").alias(self.key)).distinct().repartition(self.buckets, self.key)
        keys.write.mode("append").insertInto(self.table)

    def unknown(self, rows: DataFrame) -> DataFrame:
        """Rows whose key is not in the set. The set is not shuffled; rows with a null key stay."""
        return rows.join(self.keys(), self.key, "left_anti")


def keep_unknown(rows: DataFrame, known: KeySet, order: list[Column]) -> DataFrame:
    """The first row, in the given order, of each key that no earlier run had: one shuffle of the new rows by key, none of the set."""
    return keep_first(known.unknown(rows), [known.key], order)
