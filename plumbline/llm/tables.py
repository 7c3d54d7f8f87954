"""Reading, writing and naming of tables that the operators share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.session import scratch_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """``rows`` written to the folder that all executors share, and read back.

    Cuts the lineage: a lost executor costs no more than the files' next read.
    The files stay until the owner of ``spark.checkpoint.dir`` clears it.
    """
    folder = scratch_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def free_shuffles(spark: SparkSession) -> None:
    """Lets go of the shuffle files of steps that are over.

    Spark deletes them once the driver has collected the frames they belong
    to, which it puts off while its heap has room. A long chain of stored
    steps would keep them all on the executors' disks.
    """
    gc.collect()
    spark._jvm.System.gc()


def row_hash(*columns: Column | str, seed: int = 0) -> Column:
    """64-bit hash of columns that tells a NULL from an empty value and from a missing one."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(F.lit(seed), *[x for c in parts for x in (c.isNull(), c)])


def in_small_batches(rows: DataFrame, most: int = 1024) -> DataFrame:
    """``rows`` for Arrow functions, at most ``most`` in a batch.

    Sets the session's batch size. The default of 10,000 rows is made for
    numbers; with texts and sets of shingles it fills an executor's memory.
    """
    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(most))
    return rows
