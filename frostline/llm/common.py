"""Working tables and column helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def work_root(spark: SparkSession) -> str:
    """The session's folder for working tables, below ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local session without it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="frostline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/frostline-llm-{spark.sparkContext.applicationId}"


def bounded_batches(spark: SparkSession) -> None:
    """Let Python tasks get their rows in batches that stay small even where texts are long."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1000), ("spark.sql.execution.arrow.maxBytesPerBatch", 1 << 24)):
        if not 0 < int(spark.conf.get(key).rstrip("b")) <= most:
            spark.conf.set(key, most)


#: Where the paths of new working tables are noted, while someone wants to know them.
_NOTED: list[list[str]] = []


@contextmanager
def noted_tables() -> Iterator[list[str]]:
    """The paths of the working tables that are written meanwhile."""
    _NOTED.append([])
    try:
        yield _NOTED[-1]
    finally:
        _NOTED.pop()


def drop_tables(spark: SparkSession, paths: list[str], docs: DataFrame) -> None:
    """Delete working tables, unless ``docs`` still reads any of them."""
    if paths and not any(path.rpartition("/")[2] in file for file in docs.inputFiles() for path in paths):
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a working table and return it as read back: lineage ends here, and a lost executor costs nothing."""
    bounded_batches(df.sparkSession)
    path = f"{work_root(df.sparkSession)}/{purpose}-{uuid.uuid4().hex}"
    for paths in _NOTED:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_work(spark: SparkSession) -> None:
    """Delete the session's working tables, once no result that reads them is needed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A top-level column, even if its name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def blocks_of(rows: int, per_block: int) -> int:
    return max(1, -(-rows // per_block))


def letters_lower(text: Column) -> Column:
    """``text`` with A to Z lower-cased and all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
