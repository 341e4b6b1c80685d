"""A stored table of one row per key that changes in place, a few buckets at a time."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

_BUCKET = "_bucket"


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class KeyedTable:
    """Rows in buckets by a hash of their key, each a partition of a Parquet table below ``folder``.

    A merge reads and replaces only the buckets that its changes fall in; take as many buckets as keep one in the size
    of a few files. The new buckets are written to a journal first and then put in place. A merge that broke off while
    it put them in place is repeated from the journal if it is called again with the same ``batch``. One writer at a
    time; a reader should not read while buckets are being put in place.
    """

    def __init__(self, folder: str, keys: list[str], schema: StructType, buckets: int = 64):
        self.folder, self.keys, self.schema, self.buckets = folder, keys, schema, buckets
        self.stored = StructType([*schema.fields, StructField(_BUCKET, IntegerType())])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _read(self, spark: SparkSession) -> DataFrame:
        path = f"{self.folder}/table"
        if not exists(spark, path):
            return spark.createDataFrame([], self.stored)
        return spark.read.schema(self.stored).parquet(path)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The table as it stands; empty before the first merge."""
        return self._read(spark).drop(_BUCKET)

    def _touched(self, changes: DataFrame) -> list[int]:
        """No more numbers than there are buckets; as literals they prune the partitions that are read."""
        return [r[0] for r in changes.select(self.bucket()).distinct().collect()]

    def rows_of(self, changes: DataFrame) -> DataFrame:
        """The rows of the changes' keys, read from their buckets only."""
        held = self._read(changes.sparkSession).filter(F.col(_BUCKET).isin(self._touched(changes)))
        return held.drop(_BUCKET).join(changes.select(self.keys), self.keys, "left_semi")

    def merge(
        self,
        changes: DataFrame,
        combine: Callable[[DataFrame, DataFrame], DataFrame],
        batch: int | None = None,
    ) -> None:
        """Replace the buckets of the changes' keys by ``combine`` of their rows and the changes.

        ``changes`` has the key columns, and is read twice. ``combine`` works key by key, and gives the table's columns.
        """
        spark = changes.sparkSession
        journal = f"{self.folder}/journal/{uuid.uuid4().hex if batch is None else f'batch={batch}'}"
        if batch is None or not exists(spark, f"{journal}/_SUCCESS"):
            held = self._read(spark).filter(F.col(_BUCKET).isin(self._touched(changes))).drop(_BUCKET)
            merged = combine(held, changes).select(self.schema.names).withColumn(_BUCKET, self.bucket())
            merged.repartition(_BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(journal)
            if batch is not None:
                delete(spark, f"{self.folder}/journal/batch={batch - 1}")
        new = spark.read.schema(self.stored).parquet(journal)
        (
            new.repartition(_BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(_BUCKET)
            .parquet(f"{self.folder}/table")
        )
        if batch is None:
            delete(spark, journal)


def replace(held: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """``held`` with the rows of the changes' keys replaced."""
    return held.join(changes.select(keys), keys, "left_anti").unionByName(changes)
