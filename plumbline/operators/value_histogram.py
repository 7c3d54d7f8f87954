"""A stored histogram of a decimal column: each value, its rows and the rows before it.

Built from one pass over the rows, it answers counts, sums, means and any exact
percentile by range lookups, without touching the rows again. The built-in exact
percentile keeps every distinct value of a group in one buffer; here values stay
rows, sorted by one range exchange.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

# Stores a frame under a name and gives it back with what was measured while writing it.
Save = Callable[[str, DataFrame, Mapping[str, Column]], tuple[DataFrame, Row]]


def value_counts(rows: DataFrame, column: str, scale: int = 2) -> DataFrame:
    """Distinct values of a decimal column, as whole units of it, and their rows."""
    units = (F.col(column) * F.lit(10**scale)).cast("bigint")
    return rows.groupBy(units.alias("units")).agg(F.count("*").alias("rows"))


@dataclass(frozen=True)
class ValueHistogram:
    """``values`` has (units, rows, rows_before, rows_through) for every value that is not NULL."""

    values: DataFrame
    rows: int
    valued: int
    unit_sum: int
    scale: int

    @classmethod
    def build(cls, rows: DataFrame, column: str, save: Save, name: str, scale: int = 2) -> ValueHistogram:
        """Counts each value once, stores the counts in order, and adds up what lies before them.

        A task of the range exchange holds one run of values. The sizes of the
        runs, one row each, say where a run starts; a window counts within it.
        """
        counts = value_counts(rows, column, scale)
        runs = counts.repartitionByRange("units").sortWithinPartitions("units")
        valued = F.when(F.col("units").isNotNull(), F.col("rows")).otherwise(0)
        measures = {
            "rows": F.coalesce(F.sum("rows"), F.lit(0)),
            "valued": F.coalesce(F.sum(valued), F.lit(0)),
            "unit_sum": F.coalesce(F.sum(F.col("units").cast("decimal(20,0)") * F.col("rows")), F.lit(0)),
        }
        runs, found = save(f"{name}_counts", runs.withColumn("run", F.spark_partition_id()), measures)
        runs = runs.where("units IS NOT NULL")
        before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
        starts = runs.groupBy("run").agg(F.sum("rows").alias("size")).select(
            "run", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
        )
        within = Window.partitionBy("run").orderBy("units").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        through = F.col("start") + F.sum("rows").over(within)
        values = runs.join(starts, "run").select(
            "units", "rows", (through - F.col("rows")).alias("rows_before"), through.alias("rows_through")
        )
        values, _ = save(name, values, {})
        return cls(values, *cls._totals(found), scale)

    @classmethod
    def of(cls, values: DataFrame, totals: Row, scale: int = 2) -> ValueHistogram:
        """A histogram that was stored before, with the measures of its counts."""
        return cls(values, *cls._totals(totals), scale)

    @staticmethod
    def _totals(found: Row) -> tuple[int, int, int]:
        return int(found["rows"]), int(found["valued"]), int(found["unit_sum"])

    def total(self) -> float:
        return float(self.unit_sum) / 10**self.scale

    def mean(self) -> float | None:
        return float(self.unit_sum) / (self.valued * 10**self.scale) if self.valued else None

    def percentiles(self, points: Mapping[str, float]) -> DataFrame:
        """One row with a linearly interpolated percentile per entry; NULL where there is no value.

        The wanted ranks are numbers by now, so the lookups are filters that
        reach the stored table, and two values per point leave it.
        """
        places = {name: point * float(self.valued - 1) for name, point in points.items()}

        def holds(rank: int) -> Column:
            return (F.col("rows_before") <= rank) & (F.col("rows_through") > rank)

        def value_at(rank: int) -> Column:
            return F.max(F.when(holds(rank), F.col("units"))) / F.lit(float(10**self.scale))

        ranks = {rank for at in places.values() for rank in (math.floor(at), math.ceil(at))}
        wanted = F.lit(False)
        for rank in sorted(ranks):
            wanted = wanted | holds(rank)
        return self.values.where(wanted).agg(
            *[
                (
                    value_at(math.floor(at))
                    + (value_at(math.ceil(at)) - value_at(math.floor(at))) * F.lit(at - math.floor(at))
                ).alias(name)
                for name, at in places.items()
            ]
        )
