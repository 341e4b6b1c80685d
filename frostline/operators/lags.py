"""The rows before each row, without sorting a hot key in one task.

A plain window puts all rows of a key into one task. That is what happens to keys of so many rows at most; only the rows of
hotter keys are written in ranges of key and order, so that a range holds about as many rows as any other, whatever
the keys, the clocks and their gaps are. Each key's rows in a range are sorted apart, and get the last rows of the key's
ranges before. The result is the one the plain window gives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from frostline.sinks.tables import work_folder, write_mart

# About so many rows make a range, however many ranges that takes.
ROWS_PER_CHUNK = 5_000_000


def chunked(df: DataFrame, key: str, order: list[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """``df`` with ``_chunk``: ranges of key and order, numbered upwards.

    The split is by position among all rows, found by Spark's sampling range partitioner, so a burst within one second
    or rows without a clock are split like any others. Only rows that agree in key and whole order stay together.
    The table is written, as a second run of the partitioner might draw other borders.
    """
    spark = df.sparkSession
    chunks = max(-(-df.count() // rows_per_chunk), int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = df.repartitionByRange(chunks, key, *order).withColumn("_chunk", F.spark_partition_id())
    return write_mart(cut, work_folder(spark, "chunks"))


def with_previous(
    df: DataFrame,
    key: str,
    order: list[str],
    columns: list[str],
    count: int,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add ``previous_1`` .. ``previous_<count>``: structs of the rows before, nearest first.

    Rows of one key come by ``order``, nulls first. Keys of more than ``rows_per_chunk`` rows are found when the plan is
    built, by counting the key column; there are at most as many as the table has times so many rows.
    """
    found = df.groupBy(key).count().filter(F.col("count") > rows_per_chunk).select(key).collect()
    hot = [r[0] for r in found]
    if not hot:
        return _in_key(df, key, order, columns, count)
    is_hot = F.coalesce(F.col(key).isin([k for k in hot if k is not None]), F.lit(False))
    if None in hot:
        is_hot = is_hot | F.col(key).isNull()
    rest = _in_key(df.filter(~is_hot), key, order, columns, count)
    return rest.unionByName(_over_chunks(df.filter(is_hot), key, order, columns, count, rows_per_chunk))


def _in_key(df: DataFrame, key: str, order: list[str], columns: list[str], count: int) -> DataFrame:
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumns({f"previous_{i}": F.lag(F.struct(*columns), i).over(window) for i in range(1, count + 1)})


def _over_chunks(df: DataFrame, key: str, order: list[str], columns: list[str], count: int, rows_per_chunk: int) -> DataFrame:
    group = [key, "_chunk"]
    row = F.struct(*columns)
    cut = chunked(df, key, order, rows_per_chunk)

    tail_order = Window.partitionBy(*group).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        cut.select(*group, *order, row.alias("_row"))
        .withColumn("_place", F.row_number().over(tail_order))
        .filter(F.col("_place") <= count)
        .groupBy(*group)
        .agg(F.sort_array(F.collect_list(F.struct("_place", "_row")))["_row"].alias("_tail"))
    )
    # Each chunk has a row at least, so `count` chunks back reach far enough.
    back = Window.partitionBy(key).orderBy("_chunk").rowsBetween(-count, -1)
    halos = tails.select(
        F.col(key).alias("_halo_key"),
        F.col("_chunk").alias("_halo_chunk"),
        F.flatten(F.reverse(F.collect_list("_tail").over(back))).alias("_halo"),
    )
    same = F.col(key).eqNullSafe(F.col("_halo_key")) & (F.col("_chunk") == F.col("_halo_chunk"))

    window = Window.partitionBy(*group).orderBy(*order)
    lagged = cut.withColumns(
        {
            "_place": F.row_number().over(window),
            **{f"_lag_{i}": F.lag(row, i).over(window) for i in range(1, count + 1)},
        }
    ).join(halos, same, "left")

    def previous(i: int) -> Column:
        before = F.get("_halo", F.lit(i) - F.col("_place"))
        return F.when(F.col("_place") > i, F.col(f"_lag_{i}")).otherwise(before)

    helpers = ["_chunk", "_place", "_halo", "_halo_key", "_halo_chunk", *[f"_lag_{i}" for i in range(1, count + 1)]]
    return lagged.withColumns({f"previous_{i}": previous(i) for i in range(1, count + 1)}).drop(*helpers)
