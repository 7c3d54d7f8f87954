"""Type-2 history: merge a delivery into it, look it up, compare its versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from plumbline.operators.salting import HOT_ROWS, HotKeys, dealt, repeated

HISTORY_COLUMNS = ["scd_id", "updated_at", "valid_from", "valid_to"]


def _run_time(run_time: str) -> Column:
    return F.lit(run_time).cast("timestamp_ntz")


def _opened(key: str, run_time: str) -> dict[str, Column]:
    return {
        "scd_id": F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(run_time))),
        "updated_at": _run_time(run_time),
        "valid_from": _run_time(run_time),
        "valid_to": F.lit(None).cast("timestamp_ntz"),
    }


def initial_history(source: DataFrame, key: str, run_time: str) -> DataFrame:
    """Every source row as an open version."""
    return source.withColumns(_opened(key, run_time))


def merge_open(
    open_rows: DataFrame,
    source: DataFrame,
    key: str,
    check: Sequence[str],
    run_time: str,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """The open versions after ``source`` was delivered at ``run_time``, and those it closed.

    A key whose ``check`` columns differ (NULL equals NULL) closes its open
    version and opens a new one; a key gone from the source closes; a key not
    open, new or seen before, opens. ``key`` must be unique and not NULL in the
    source, which the caller checks first.

    Open and delivered rows meet in one full outer join on the unique key, so
    no key can be hot, and a change yields both of its rows from that join.
    """
    names = [*source.columns, *HISTORY_COLUMNS]
    old_rows = open_rows.select(F.col(key).alias("_old_key"), F.struct(*names).alias("old"))
    new_rows = initial_history(source, key, run_time).select(
        F.col(key).alias("_new_key"), F.struct(*names).alias("new")
    )
    old, new = F.col("old"), F.col("new")
    closed = old.withField("valid_to", _run_time(run_time))
    same = F.lit(True)
    for name in check:
        same = same & old[name].eqNullSafe(new[name])
    versions = (
        F.when(F.col("_old_key").isNull(), F.array(new))
        .when(F.col("_new_key").isNull(), F.array(closed if invalidate_hard_deletes else old))
        .when(same, F.array(old))
        .otherwise(F.array(closed, new))
    )
    return (
        old_rows.join(new_rows, F.col("_old_key") == F.col("_new_key"), "full_outer")
        .select(F.explode(versions).alias("version"))
        .select(*[F.col(f"version.{name}").alias(name) for name in names])
    )


def merge_history(
    history: DataFrame,
    source: DataFrame,
    key: str,
    check: Sequence[str],
    run_time: str,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """A whole history after a delivery: its closed versions, and ``merge_open`` of the others."""
    history = history.select(*source.columns, *HISTORY_COLUMNS)
    is_open = F.col("valid_to").isNull()
    merged = merge_open(
        history.where(is_open), source, key, check, run_time, invalidate_hard_deletes
    )
    return history.where(~is_open).unionByName(merged)


def as_of(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    at: str,
    columns: Sequence[str],
    hot: HotKeys | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every fact with the version of its key that was valid at its time, or NULLs.

    Versions hold from ``valid_from`` up to but not including ``valid_to``, and
    those of a key do not overlap. Facts and versions are laid in one line per
    key, ordered by time, and every fact takes the last version before it: each
    row is looked at once, however many versions a key has. The facts of a key
    that is ``hot`` (see ``HotKeys.find``) are dealt to several lines of about
    ``hot_rows`` by their hash, with the key's versions in each. Facts without
    key or time have no version.
    """
    taken = ["valid_from", *columns]
    own = [F.col(f"`{name}`") for name in facts.columns]
    usable = F.col(f"`{key}`").isNotNull() & F.col(f"`{at}`").isNotNull()
    marks = facts.where(usable).select(
        F.col(f"`{key}`").alias("_key"),
        F.col(f"`{at}`").alias("_time"),
        F.lit(None).cast(_version_type(history, taken)).alias("_version"),
        F.struct(*own).alias("_fact"),
    )
    fact_type = marks.schema["_fact"].dataType
    versions = history.select(
        F.col(key).alias("_key"),
        F.col("valid_from").alias("_time"),
        _version(taken).alias("_version"),
        F.lit(None).cast(fact_type).alias("_fact"),
    )
    marks = dealt(marks, "_key", F.col("_fact"), "_line", hot, hot_rows)
    versions = repeated(versions, "_key", "_line", hot, hot_rows)
    names = ["_key", "_line", "_time", "_version", "_fact"]
    # A version that begins at the time of a fact counts, so it stands before the fact.
    in_time = Window.partitionBy("_key", "_line").orderBy("_time", F.col("_fact").isNotNull())
    so_far = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = versions.select(*names).unionByName(marks.select(*names)).withColumn(
        "_version", F.last("_version", ignorenulls=True).over(so_far)
    )
    valid = F.col("_version.valid_to").isNull() | (F.col("_time") < F.col("_version.valid_to"))
    found = held.where(F.col("_fact").isNotNull()).select(
        "_fact.*", *[F.when(valid, F.col(f"_version.{name}")).alias(name) for name in taken]
    )
    types = history.select(*taken).schema
    without = facts.where(~usable).select(
        *own, *[F.lit(None).cast(field.dataType).alias(field.name) for field in types]
    )
    return found.unionByName(without)


def _version(taken: Sequence[str]) -> Column:
    return F.struct("valid_to", *taken)


def _version_type(history: DataFrame, taken: Sequence[str]) -> T.DataType:
    return history.select(_version(taken).alias("v")).schema["v"].dataType


def changes(history: DataFrame, key: str, value: str) -> DataFrame:
    """Each version's ``value`` beside the one before it.

    A key has at most one version per run, so its window is as long as the
    number of runs.
    """
    in_time = Window.partitionBy(key).orderBy("valid_from")
    return history.withColumns(
        {
            "version_number": F.row_number().over(in_time),
            f"previous_{value}": F.lag(value).over(in_time),
        }
    )
