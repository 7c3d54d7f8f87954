"""The seven raw tables, derived from the test tables.

``FIXTURES.md`` section 2 lists the mapping. Lookups are left joins to unique
keys, so a caller that does not need a looked-up column can leave the join out
without changing the rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plumbline.functions import label
from plumbline.operators.numbering import number_within

# Schemas of the test tables, so that opening one reads no file.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz""",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}

# Fixed values of the mapping.
SEGMENT_TYPES = {
    "BUILDING": "residential",
    "AUTOMOBILE": "commercial",
    "MACHINERY": "industrial",
    "HOUSEHOLD": "mixed_use",
}
STATUS_BY_REMAINDER = {0: "pending", 1: "in_progress", 2: "completed", 3: "on_hold"}
UOM_BY_REMAINDER = {0: "EA", 1: "SF", 2: "LF"}
METHOD_BY_RETURN_FLAG = {"A": "ai", "N": "manual", "R": "hybrid"}
METHOD_BY_ORDER_STATUS = {"F": "ai", "O": "manual", "P": "hybrid"}
ISSUE_BY_EVENT = {
    "view": "missing_item",
    "click": "quantity_mismatch",
    "purchase": "cost_outlier",
    "signup": "duplicate",
    "error": "low_confidence",
}
ESTIMATE_PRIORITY = "1-URGENT"
FIRST_DAY = "2024-01-01"
REPRICED_DIVISION = "Brand#7"
WITHDRAWN_DIVISION = "Brand#11"
RELABELLED_DIVISION = "Brand#13"
RUN_TIMES = [
    "1995-07-01 00:00:00",
    "1997-01-01 00:00:00",
    "1999-01-01 00:00:00",
    "2000-07-01 00:00:00",
]
# Order keys per numbering bucket; see DriverTables.estimates.
KEY_BLOCK = 1 << 26


def _days_after_first(days: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), days.cast("int"))


class DriverTables:
    """Raw tables as lazy DataFrames over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self._spark.read.schema(SCHEMAS[name]).parquet(
                f"{self._folder}/{name}.parquet"
            )
        return self._read[name]

    @cached_property
    def projects(self) -> DataFrame:
        key = F.col("c_custkey")
        bid_date = _days_after_first(key % 300)
        return (
            self._table("customer")
            .join(self._table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                key.alias("project_id"),
                F.col("c_name").alias("client_name"),
                F.col("c_name").alias("project_name"),
                label(F.col("c_mktsegment"), SEGMENT_TYPES, "other").alias("project_type"),
                F.lower("n_name").alias("location_state"),
                bid_date.alias("bid_date"),
                F.concat(F.lit("v"), (key % 5 + 1).cast("string"), F.lit(".0")).alias(
                    "plan_set_version"
                ),
                label(key % 4, STATUS_BY_REMAINDER, None).alias("status"),
                F.date_sub(bid_date, 7).cast("timestamp_ntz").alias("created_at"),
            )
        )

    @cached_property
    def blueprint_pages(self) -> DataFrame:
        key = F.col("o_orderkey")
        letter = F.substring(F.lit("ASCMEP"), (key % 6 + 1).cast("int"), F.lit(1))
        sheet = key % 15 + 1
        pages = self._table("orders").select(
            "*",
            F.when(key % 97 == 0, F.lower(letter)).otherwise(letter).alias("discipline"),
            F.lpad(sheet.cast("string"), 2, "0").alias("sheet"),
        )
        sheet_number = F.concat("discipline", "sheet")
        return pages.select(
            key.alias("page_id"),
            F.col("o_custkey").alias("project_id"),
            sheet_number.alias("sheet_number"),
            "discipline",
            F.concat("discipline", F.lit(" sheet "), sheet.cast("string")).alias("page_title"),
            F.concat(
                F.lit("/plans/"), F.col("o_custkey").cast("string"), F.lit("/"), sheet_number,
                F.lit(".pdf"),
            ).alias("image_path"),
            (key % 3 + 1).alias("page_version"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def _items(self) -> DataFrame:
        """Parts with their cost code, unit and prices."""
        mid = F.col("p_retailprice") / (F.col("p_size") % 20 + 1)
        return self._table("part").select(
            "p_partkey",
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("cost_code"),
            F.col("p_brand").alias("division"),
            F.col("p_type").alias("division_name"),
            F.col("p_name").alias("item_type"),
            label(F.col("p_size") % 3, UOM_BY_REMAINDER, None).alias("uom"),
            (mid * 0.75).alias("unit_cost_low"),
            mid.alias("unit_cost_mid"),
            (mid * 1.35).alias("unit_cost_high"),
            _days_after_first(F.col("p_partkey") % 90).alias("last_updated"),
        )

    @cached_property
    def cost_library(self) -> DataFrame:
        return self._items.drop("p_partkey")

    @cached_property
    def takeoff_lines(self) -> DataFrame:
        """Takeoffs as they travel through joins: plain keys and measures, of which
        ``as_takeoffs`` makes the columns of a raw takeoff where the joins are done."""
        return self._table("lineitem").select(
            F.col("l_orderkey").alias("page_id"),
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("cost_code"),
            "l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_returnflag", "l_shipdate",
        )

    def as_takeoffs(self, lines: DataFrame) -> DataFrame:
        """``takeoff_lines``, with whatever was joined to them, as raw takeoffs."""
        part = F.substring("cost_code", 2, 20)
        made = {
            "takeoff_id": F.concat_ws("-", "page_id", "l_linenumber", part, "l_suppkey"),
            "quantity": F.col("l_quantity"),
            "confidence": 1 - F.col("l_discount") * 5,
            "extraction_method": label(F.col("l_returnflag"), METHOD_BY_RETURN_FLAG, None),
            "created_at": F.col("l_shipdate"),
        }
        own = ("page_id", "cost_code", "l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_returnflag", "l_shipdate")
        return lines.select(
            "page_id",
            made["takeoff_id"].alias("takeoff_id"),
            "cost_code",
            *[made[name].alias(name) for name in ("quantity", "confidence", "extraction_method", "created_at")],
            *[name for name in lines.columns if name not in own],
        )

    @cached_property
    def described_codes(self) -> DataFrame:
        """What takeoffs take from the item of their cost code."""
        return self._items.select("cost_code", "item_type", "uom")

    @cached_property
    def page_owners(self) -> DataFrame:
        """Pages and the project that their takeoffs belong to."""
        return self._table("orders").select(
            F.col("o_orderkey").alias("page_id"), F.col("o_custkey").alias("project_id")
        )

    def takeoff_items(self, project: bool = True, item: bool = True) -> DataFrame:
        """Takeoffs; ``project`` and ``item`` say whether the looked-up columns are needed."""
        lines = self.takeoff_lines
        if item:
            lines = lines.join(self.described_codes, "cost_code", "left")
        if project:
            # Last, so a join to pages that follows finds the rows placed by page.
            lines = lines.join(self.page_owners, "page_id", "left")
        return self.as_takeoffs(lines)

    @cached_property
    def _estimate_orders(self) -> DataFrame:
        return self._table("orders").where(F.col("o_orderpriority") == ESTIMATE_PRIORITY)

    def estimates(self, version: bool = True) -> DataFrame:
        """Estimates, versioned by order date and key within their project.

        A bucket is one date and one block of order keys, so a project has at
        most (days x blocks) buckets and a bucket at most ``KEY_BLOCK`` rows.
        ``version`` says whether the version is needed.
        """
        key = F.col("o_orderkey")
        mid = F.when(key % 50 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice") * (key % 8 + 1))
        orders = self._estimate_orders
        if version:
            orders = number_within(
                orders,
                "o_custkey",
                {
                    "_day": F.col("o_orderdate").cast("date"),
                    "_block": F.expr(f"o_orderkey div {KEY_BLOCK}"),
                },
                [F.asc_nulls_last("o_orderdate"), F.asc("o_orderkey")],
                "estimate_version",
            )
        return orders.withColumn("mid", mid).select(
            key.alias("estimate_id"),
            F.col("o_custkey").alias("project_id"),
            *(["estimate_version"] if version else []),
            (F.col("mid") * 0.7125).alias("estimate_total_low"),
            F.col("mid").alias("estimate_total_mid"),
            (F.col("mid") * 1.4175).alias("estimate_total_high"),
            F.col("o_orderdate").alias("generated_at"),
            label(F.col("o_orderstatus"), METHOD_BY_ORDER_STATUS, None).alias("estimation_method"),
        )

    @cached_property
    def estimate_line_items(self) -> DataFrame:
        estimates = self._estimate_orders.select(F.col("o_orderkey").alias("l_orderkey"))
        quantities = (
            self._table("lineitem")
            .join(estimates, "l_orderkey")
            .groupBy("l_orderkey", "l_partkey")
            .agg(F.sum("l_quantity").alias("quantity"))
        )
        return quantities.join(
            self._items, F.col("l_partkey") == F.col("p_partkey")
        ).select(
            F.concat_ws("-", "l_orderkey", "l_partkey").alias("line_item_id"),
            F.col("l_orderkey").alias("estimate_id"),
            "cost_code",
            "item_type",
            "quantity",
            "uom",
            "unit_cost_mid",
            (F.col("quantity") * F.col("unit_cost_mid")).alias("extended_cost_mid"),
        )

    @cached_property
    def qa_reviews(self) -> DataFrame:
        key = F.col("event_id")
        value = F.col("value")
        return self._table("events").select(
            key.alias("review_id"),
            F.col("user_id").alias("project_id"),
            F.when(key % 3 != 0, key).alias("page_id"),
            F.lit(None).cast("bigint").alias("takeoff_id"),
            label(F.col("event_type"), ISSUE_BY_EVENT, None).alias("issue_type"),
            F.when(value < 20, "low")
            .when(value < 50, "medium")
            .when(value < 120, "high")
            .otherwise("critical")
            .alias("severity"),
            (key % 4 != 0).alias("resolved"),
            F.col("ts").alias("reviewed_at"),
        )

    @cached_property
    def cost_library_versions(self) -> list[tuple[str, DataFrame]]:
        """Four deliveries of the cost library, each with its run time.

        The second reprices one division, withdraws another, changes only the
        unit of a third and adds a new code beside each code of that division;
        the third brings the withdrawn division back; the fourth equals it.
        """
        first = self.cost_library
        division = F.col("division")
        repriced = division == REPRICED_DIVISION
        added = first.where(division == RELABELLED_DIVISION).withColumn(
            "cost_code", F.concat(F.col("cost_code"), F.lit("N"))
        )
        changed = first.withColumns(
            {
                **{
                    name: F.when(repriced, F.col(name) * 1.1).otherwise(F.col(name))
                    for name in ("unit_cost_low", "unit_cost_mid", "unit_cost_high")
                },
                "uom": F.when(division == RELABELLED_DIVISION, F.lit("LOT")).otherwise(F.col("uom")),
            }
        ).unionByName(added)
        second = changed.where(division != WITHDRAWN_DIVISION)
        return list(zip(RUN_TIMES, [first, second, changed, changed]))


class DisputedTables(DriverTables):
    """The same tables with offences that data tests and checks should find.

    The cost library is the second delivery, which lacks a division, so codes
    of takeoffs and line items are orphans. Hybrid takeoffs have negative
    quantities, manual ones a confidence up to 1.25. Line items in LF have
    forty times the quantity, and critical reviews are about a wrong unit.
    """

    @cached_property
    def cost_library(self) -> DataFrame:
        return DriverTables(self._spark, self._folder).cost_library_versions[1][1]

    def as_takeoffs(self, lines: DataFrame) -> DataFrame:
        method, quantity, confidence = (
            F.col(name) for name in ("extraction_method", "quantity", "confidence")
        )
        return super().as_takeoffs(lines).withColumns(
            {
                "quantity": F.when(method == "hybrid", -quantity).otherwise(quantity),
                "confidence": F.when(method == "manual", confidence + 0.25).otherwise(confidence),
            }
        )

    @cached_property
    def estimate_line_items(self) -> DataFrame:
        factor = F.when(F.col("uom") == "LF", F.lit(40.0)).otherwise(F.lit(1.0))
        return super().estimate_line_items.withColumns(
            {name: F.col(name) * factor for name in ("quantity", "extended_cost_mid")}
        )

    @cached_property
    def qa_reviews(self) -> DataFrame:
        issue = F.when(F.col("severity") == "critical", "wrong_uom").otherwise(F.col("issue_type"))
        return super().qa_reviews.withColumn("issue_type", issue)
