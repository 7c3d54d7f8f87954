"""Joins in which some keys carry very many rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

# A key with more rows than this is spread over several shuffle groups.
HOT_ROWS = 1_000_000
# So many hot keys are sent to every task at most; more are joined by a shuffle.
SENT_KEYS = 1_000_000

# Stores a frame under a name and gives it back with what was measured while writing it.
Save = Callable[[str, DataFrame, Mapping[str, Column]], tuple[DataFrame, Row]]


@dataclass(frozen=True)
class HotKeys:
    """Stored counts of the keys above a bound: (key, rows), and how many there are.

    They are found once, with the table they describe, and serve every join on
    that key. There are no more of them than rows / bound.
    """

    counts: DataFrame
    number: int | None  # None where they were not counted

    @classmethod
    def find(cls, rows: DataFrame, key: str, save: Save, name: str, hot_rows: int = HOT_ROWS) -> HotKeys:
        counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
        counts = counts.where(F.col("rows") > hot_rows)
        stored, found = save(name, counts.select(F.col(key).alias("key"), "rows"), {"number": F.count("*")})
        return cls(stored, found["number"])


def _beside(frame: DataFrame, hot: DataFrame, key: str, number: int | None) -> DataFrame:
    """``frame`` with the columns of the hot keys (``_hot`` is the key), NULL for all other rows."""
    small = F.broadcast(hot) if number is not None and number <= SENT_KEYS else hot
    return frame.join(small, F.col(key) == F.col("_hot"), "left")


def _with_salts(frame: DataFrame, key: str, hot: HotKeys, hot_rows: int) -> tuple[DataFrame, Column]:
    """``frame`` with a helper for the number of salts of each row's key."""
    salts_of = hot.counts.select(
        F.col("key").alias("_hot"), F.ceil(F.col("rows") / F.lit(hot_rows)).alias("_salts")
    )
    return _beside(frame, salts_of, key, hot.number), F.coalesce(F.col("_salts"), F.lit(1))


def dealt(rows: DataFrame, key: str, by: Column, salt: str, hot: HotKeys | None, hot_rows: int) -> DataFrame:
    """``rows`` with ``salt``: 0, but for hot keys one of as many numbers as they have ``hot_rows``.

    Rows without a key meet nothing and may be anywhere.
    """
    if hot is None or hot.number == 0:
        return rows.withColumn(salt, F.lit(0).cast("bigint"))
    counted, salts = _with_salts(rows, key, hot, hot_rows)
    salts = F.when(F.col(key).isNull(), 1024).otherwise(salts)
    return counted.withColumn(salt, F.pmod(F.xxhash64(by), salts)).drop("_hot", "_salts")


def repeated(rows: DataFrame, key: str, salt: str, hot: HotKeys | None, hot_rows: int) -> DataFrame:
    """``rows`` with ``salt``, once for each number that ``dealt`` gives their key."""
    if hot is None or hot.number == 0:
        return rows.withColumn(salt, F.lit(0).cast("bigint"))
    counted, salts = _with_salts(rows, key, hot, hot_rows)
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))
    return counted.withColumn(salt, every).drop("_hot", "_salts")


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: Column,
    how: str = "inner",
    hot: HotKeys | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``rows`` to a ``lookup`` with few rows per ``key``, cutting hot keys into pieces.

    Adaptive skew handling needs a plain shuffle on both sides of a join; this
    serves the joins whose lookup side is an aggregate on the join key. A key
    with ``n > hot_rows`` rows gets ``ceil(n / hot_rows)`` salts: its rows are
    dealt out by the hash of ``spread_by``, its lookup row is repeated once per
    salt. All other keys have the single salt 0.

    ``hot`` brings the hot keys as found before; if there are none the join is a
    plain one. If they are not given, ``rows`` are counted by key for each side.
    """
    if hot is None:
        counts = rows.groupBy(key).agg(F.count("*").alias("rows")).where(F.col("rows") > hot_rows)
        hot = HotKeys(counts.withColumnRenamed(key, "key"), None)
    if hot.number == 0:
        return rows.join(lookup, key, how)
    left = dealt(rows, key, spread_by, "_salt", hot, hot_rows)
    return left.join(repeated(lookup, key, "_salt", hot, hot_rows), [key, "_salt"], how).drop("_salt")


def grid_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_by: Column,
    right_by: Column,
    save: Save,
    name: str,
    cell_rows: int = HOT_ROWS,
) -> DataFrame:
    """Inner join of two sides that may both have many rows of a key.

    A key with ``a`` rows left and ``b`` right yields ``a * b``. Where that
    exceeds ``cell_rows``, the left rows are cut into A parts and the right ones
    into B, by the hashes of ``left_by`` and ``right_by``, and each pair of
    parts is a group of its own in the shuffle: no task gets more of the key
    than a part of either side, and of its result about ``cell_rows``. A and B
    follow the sizes, so that the rows that are repeated, ``a * B + b * A``,
    are about as few as the cells allow. Either side should be cheap to read
    twice; the sizes of the hot keys, a row each, are stored and sent out.
    """
    counted = left.groupBy(key).agg(F.count("*").alias("a")).join(
        right.groupBy(key).agg(F.count("*").alias("b")), key
    )
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    cells = F.ceil(a * b / F.lit(cell_rows)).cast("double")
    parts = F.least(a, F.greatest(F.lit(1.0), F.round(F.sqrt(cells * a / b))))
    hot = (
        counted.where(a * b > cell_rows)
        .select(F.col(key).alias("_hot"), parts.cast("bigint").alias("_a"), cells.alias("_cells"), "b")
        .select("_hot", "_a", F.least(F.ceil(F.col("_cells") / F.col("_a")), F.col("b")).cast("bigint").alias("_b"))
    )
    hot, found = save(name, hot, {"number": F.count("*")})
    if found["number"] == 0:
        return left.join(right, key)

    def one(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(1))

    def every(column: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), one(column) - 1))

    def dealt(by: Column, column: str) -> Column:
        return F.pmod(F.xxhash64(by), one(column))

    lefts = _beside(left, hot, key, found["number"]).withColumn("_i", dealt(left_by, "_a")).withColumn("_j", every("_b"))
    rights = _beside(right, hot, key, found["number"]).withColumn("_j", dealt(right_by, "_b")).withColumn("_i", every("_a"))
    helpers = ("_hot", "_a", "_b")
    return lefts.drop(*helpers).join(rights.drop(*helpers), [key, "_i", "_j"]).drop("_i", "_j")
