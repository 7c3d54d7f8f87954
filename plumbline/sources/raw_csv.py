"""Raw tables as CSV: write them out, read them back with their schema.

``read_csv`` is strict: a value that does not fit stops the job. ``read_checked``
keeps going: every line comes back, with the reasons against it if there are any.
"""

from __future__ import annotations

import logging
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plumbline.schemas import RAW_TABLES, raw_schema
from plumbline.session import path_exists

log = logging.getLogger(__name__)

_FORMAT = {
    "header": "true",
    "dateFormat": "yyyy-MM-dd",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    # One row per line, so that a large file can be read in pieces.
    "multiLine": "false",
}
# Text of a table is several times its size as Parquet, so it is written packed.
# A packed file cannot be read in pieces; many files of a bounded length can.
ROWS_PER_FILE = 500_000
_PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(ROWS_PER_FILE)}
# Nullable keys that a producer may have written as floating point (12.0).
_LOOSE_KEYS = {"qa_reviews": ["page_id", "takeoff_id"]}


def path_of(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{table}.csv"


def write_csv(rows: DataFrame, folder: str, table: str) -> None:
    """Columns in schema order, one header per part file; the files are packed by gzip."""
    rows.select(*raw_schema(table).names).write.mode("overwrite").options(**_FORMAT, **_PACKED).csv(
        path_of(folder, table)
    )


def as_lines(rows: DataFrame, table: str) -> DataFrame:
    """``rows`` with their CSV text as ``line``."""
    options = {name: value for name, value in _FORMAT.items() if name not in ("header", "multiLine")}
    return rows.withColumn("line", F.to_csv(F.struct(*raw_schema(table).names), options))


def write_lines(rows: DataFrame, folder: str, table: str) -> None:
    """Ready-made lines (column ``line``) below the header of a raw table."""
    header = F.col("line").alias(",".join(raw_schema(table).names))
    # No separator and no quote of its own, so that each line is written as it is.
    rows.select(header).write.mode("overwrite").options(
        header="true", sep="\u0001", quote="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false",
        **_PACKED,
    ).csv(path_of(folder, table))


def _whole_number(name: str) -> Column:
    # Through decimal, since a double would lose digits of a large key.
    return F.col(name).cast("decimal(38,1)").cast("bigint").alias(name)


def _there(spark: SparkSession, folder: str, table: str) -> bool:
    found = path_exists(spark, path_of(folder, table))
    if not found:
        log.warning("no CSV for raw table %s in %s", table, folder)
    return found


def read_csv(spark: SparkSession, folder: str, table: str, **overrides: str) -> DataFrame | None:
    """One raw table, or None where the file is missing.

    A value that does not fit its type stops the job instead of turning NULL;
    empty text is NULL.
    ``overrides`` replace column types, such as ``takeoff_id="string"``.
    """
    target = raw_schema(table, **overrides)
    loose = [
        name for name in _LOOSE_KEYS.get(table, []) if target[name].dataType == T.LongType()
    ]
    as_text = raw_schema(table, **overrides, **{name: "string" for name in loose})
    if not _there(spark, folder, table):
        return None
    rows = (
        spark.read.schema(as_text)
        .options(**_FORMAT, mode="FAILFAST", enforceSchema="false")
        .csv(path_of(folder, table))
    )
    return rows.select(*[_whole_number(n) if n in loose else F.col(n) for n in target.names])


# What a value of each type looks like; text always fits.
_LOOKS = {
    "bigint": r"[+-]?[0-9]{1,19}",
    "double": r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|NaN|[+-]?Infinity",
    "date": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "timestamp_ntz": r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?",
    "boolean": r"(?i)true|false",
}
_LOOSE_LOOKS = r"[+-]?[0-9]{1,19}(\.0*)?"
LINE, REASONS = "_line", "_reasons"


def read_checked(spark: SparkSession, folder: str, table: str, **overrides: str) -> DataFrame | None:
    """Every line of one raw table, or None where the file is missing.

    Adds ``_reasons``, an array that is empty for a good line and else says what
    does not fit: a wrong number of fields, or a field that is no value of its
    type (those come back as NULL); and ``_line``, the text of a line with
    reasons. Empty text is NULL and fits.
    """
    target = raw_schema(table, **overrides)
    loose = [name for name in _LOOSE_KEYS.get(table, []) if target[name].dataType == T.LongType()]
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in target.names])
    if not _there(spark, folder, table):
        return None
    rows = (
        spark.read.schema(as_text.add("_corrupt", T.StringType()))
        .options(**_FORMAT, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", enforceSchema="true")
        .csv(path_of(folder, table))
    )

    def typed(name: str) -> Column:
        kind = target[name].dataType.simpleString()
        if kind == "string":
            return F.col(name)
        looks = _LOOSE_LOOKS if name in loose else _LOOKS[kind]
        value = F.when(F.col(name).rlike(f"^(?:{looks})$"), F.col(name))
        if name in loose:
            value = value.try_cast("decimal(38,1)")
        return value.try_cast(kind)

    # Values first and what is wrong from them, so that each text is matched and cast once.
    tested = [name for name in target.names if target[name].dataType != T.StringType()]
    text = {name: f"_text_{name}" if name in tested else name for name in target.names}
    values = rows.select(
        "_corrupt",
        *[typed(name).alias(name) for name in target.names],
        *[F.col(name).alias(text[name]) for name in tested],
    )

    def bad(name: str) -> Column:
        return F.col(text[name]).isNotNull() & F.col(name).isNull()

    def reason(name: str) -> Column:
        return F.when(bad(name), F.lit(f"{name} is no {target[name].dataType.simpleString()}"))

    wrong = F.col("_corrupt").isNotNull()
    any_bad = reduce(or_, [bad(name) for name in tested], F.lit(False))
    reasons = (
        F.when(wrong, F.array(F.lit("wrong number of fields")))
        .when(any_bad, F.array_compact(F.array(*[reason(name) for name in tested])))
        .otherwise(F.array().cast("array<string>"))
    )
    line = F.coalesce("_corrupt", F.to_csv(F.struct(*text.values())))
    return values.select(*target.names, F.when(wrong | any_bad, line).alias(LINE), reasons.alias(REASONS))


def read_all(
    spark: SparkSession,
    folder: str,
    overrides: dict[str, dict[str, str]] | None = None,
    reader=read_csv,
) -> dict[str, DataFrame]:
    """Every raw table that is there, by ``read_csv`` or ``read_checked``."""
    overrides = overrides or {}
    found = {table: reader(spark, folder, table, **overrides.get(table, {})) for table in RAW_TABLES}
    return {table: rows for table, rows in found.items() if rows is not None}
