"""Row numbers within a key that may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def number_within(
    rows: DataFrame,
    key: str,
    buckets: Mapping[str, Column],
    order: Sequence[Column],
    name: str,
) -> DataFrame:
    """``row_number()`` per ``key``, without sorting all rows of a key in one task.

    ``buckets`` are expressions that cut a key's rows into pieces that follow
    one another in ``order``; a NULL bucket comes last. Rows are numbered
    within (key, buckets) and each bucket starts after the summed sizes of the
    earlier ones. One task sees the rows of one bucket, or one count per bucket
    of a key.
    """
    cut = rows.withColumns(dict(buckets))
    columns = [key, *buckets]
    # Two plain columns per key, so that windows, counts and the join agree on
    # the partitioning and NULL keys still meet.
    for column in columns:
        cut = cut.withColumn(f"_of_{column}", F.coalesce(F.col(column).cast("string"), F.lit("")))
        cut = cut.withColumn(f"_no_{column}", F.col(column).isNull())
    plain = {column: [f"_of_{column}", f"_no_{column}"] for column in columns}
    every = [name for names in plain.values() for name in names]
    sizes = cut.groupBy(*every).agg(
        F.count("*").alias("_size"), *[F.first(bucket).alias(bucket) for bucket in buckets]
    )
    earlier = (
        Window.partitionBy(*plain[key])
        .orderBy(*[F.asc_nulls_last(bucket) for bucket in buckets])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select(*every, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    position = F.row_number().over(Window.partitionBy(*every).orderBy(*order))
    return (
        cut.withColumn("_position", position)
        .join(starts, every)
        .withColumn(name, F.col("_start") + F.col("_position"))
        .drop(*buckets, *every, "_start", "_position")
    )
