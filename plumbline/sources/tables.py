"""Stored tables: Parquet folders under one root, measured while they are written."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

from plumbline.session import one_row, path_exists, scratch_folder

COMMITS = (
    T.StructType()
    .add("number", T.LongType())
    .add("schema", T.StringType())
    .add("apart", T.BooleanType())
    .add("buckets", T.IntegerType())
    .add("bucket_by", T.StringType())
)
APART = "_apart"


def observed(rows: DataFrame, measures: Mapping[str, Column], write: Callable[[DataFrame], None]) -> DataFrame:
    """Writes ``rows`` and returns one row of aggregates over what was written.

    The aggregates ride on the tasks that write, so nothing is read again, and
    they count a task once however often it was tried.
    """
    columns = [measure.alias(name) for name, measure in measures.items()]
    shape = rows.agg(*columns)
    seen = Observation()
    write(rows.observe(seen, *columns))
    found = seen.get
    if set(found) != set(measures):  # the optimizer drops the observation of a table that is empty by its plan
        return shape
    return one_row(rows.sparkSession, shape.schema, [found[name] for name in measures])


class TableStore:
    """Tables named ``schema.table`` or ``table``, one folder each.

    A table has two sides that take turns, and one small commit row for each
    time it was written. A write goes to the side that is not live and the
    commit, appended last, makes it so; a job that fails before leaves the
    table as it was. A frame that was read stays valid through one further
    write. A catalog is not needed; ``register`` makes the tables visible to
    SQL.

    Every write counts its rows, and further ``measures`` if given, while it
    writes. Rows for which ``apart`` holds are kept beside the table in the
    same write; ``read`` leaves them out and ``read_apart`` gives them.

    A table may be stored in buckets of some columns; joins and groups on these
    then need no shuffle. Spark takes buckets from its catalog only, so such a
    table is declared there as an external one, anew in each session that reads
    it; the commit row says how.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _commit(self, name: str) -> Row | None:
        """The last write, or None before the first."""
        commits = self.spark.read.schema(COMMITS).json(f"{self.path(name)}/commits")
        return commits.agg(F.max_by(F.struct("*"), "number").alias("last")).first()["last"]

    def _side(self, name: str, number: int) -> str:
        return f"{self.path(name)}/{number % 2}"

    def replace(
        self,
        name: str,
        rows: DataFrame,
        measures: Mapping[str, Column] | None = None,
        apart: Column | None = None,
        buckets: int | None = None,
        bucket_by: Sequence[str] = (),
    ) -> DataFrame:
        """Write a table anew and return it as stored. ``rows`` may read the same table.

        With ``buckets`` the rows are shuffled by ``bucket_by`` once, into one file for each.
        """
        if buckets is not None and apart is not None:
            raise ValueError("a table in buckets keeps no rows apart")
        number = self._commit(name)["number"] + 1 if self.exists(name) else 1
        side = self._side(name, number)
        counted = {"row_count": F.count("*"), **(measures or {})}
        if apart is not None:
            rows = rows.withColumn(APART, F.coalesce(apart, F.lit(False)))
            counted["row_count"] = F.count_if(~F.col(APART))
            counted["apart_count"] = F.count_if(F.col(APART))

        def write(frame: DataFrame) -> None:
            if buckets is not None:
                declared = self._declare(name, number, rows.schema, buckets, bucket_by)
                frame.repartition(buckets, *bucket_by).write.insertInto(declared, overwrite=True)
                return
            writer = frame.write.mode("overwrite")
            (writer if apart is None else writer.partitionBy(APART)).parquet(side)

        found = observed(rows, counted, write)
        found.write.mode("overwrite").parquet(f"{side}-measures")
        by = json.dumps(list(bucket_by))
        commit = one_row(self.spark, COMMITS, (number, rows.schema.json(), apart is not None, buckets, by))
        commit.write.mode("append").json(f"{self.path(name)}/commits")
        return self.read(name)

    def _declare(self, name: str, number: int, schema: T.StructType, buckets: int, by: Sequence[str]) -> str:
        """Tells the catalog of a side in buckets and returns the table's name there."""
        side = self._side(name, number)
        declared = f"plumbline_{uuid.uuid5(uuid.NAMESPACE_URL, side).hex}"

        def quoted(column: str) -> str:
            return "`" + column.replace("`", "``") + "`"

        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        place = side.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"DROP TABLE IF EXISTS {declared}")  # the name only; the files of an external table stay
        self.spark.sql(
            f"CREATE TABLE {declared} ({columns}) USING parquet"
            f" CLUSTERED BY ({', '.join(map(quoted, by))}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        return declared

    def _stored(self, name: str) -> tuple[DataFrame, bool]:
        last = self._commit(name)
        schema = T.StructType.fromJson(json.loads(last["schema"]))
        if last["buckets"] is not None:
            by = json.loads(last["bucket_by"])
            return self.spark.table(self._declare(name, last["number"], schema, last["buckets"], by)), False
        return self.spark.read.schema(schema).parquet(self._side(name, last["number"])), last["apart"]

    def read(self, name: str) -> DataFrame:
        rows, apart = self._stored(name)
        return rows.where(~F.col(APART)).drop(APART) if apart else rows

    def read_apart(self, name: str) -> DataFrame:
        """The rows that the last write kept beside the table."""
        rows, apart = self._stored(name)
        return rows.where(APART).drop(APART) if apart else rows.limit(0)

    def exists(self, name: str) -> bool:
        return path_exists(self.spark, f"{self.path(name)}/commits") and self._commit(name) is not None

    def measures(self, name: str) -> DataFrame:
        """One row: ``row_count`` and what else the last write measured."""
        return self.spark.read.parquet(f"{self._side(name, self._commit(name)['number'])}-measures")

    def row_count(self, name: str) -> int:
        """Rows of a table, from its last write."""
        return self.measures(name).first()["row_count"]

    def keep(self, name: str, rows: DataFrame, measures: Mapping[str, Column]) -> tuple[DataFrame, Row]:
        """``replace``, and what was measured."""
        return self.replace(name, rows, measures), self.measures(name).first()

    def register(self, name: str) -> None:
        self.read(name).createOrReplaceTempView(name.replace(".", "_"))

    def inventory(self, names: Sequence[str]) -> DataFrame:
        """Whether each table exists and how many rows its last write had."""
        there = {name: self.exists(name) for name in names}
        rows = [(name, found, self.row_count(name) if found else None) for name, found in there.items()]
        return self.spark.createDataFrame(rows, "table_name string, table_exists boolean, row_count bigint")


def scratch_keep(spark: SparkSession):
    """Like ``TableStore.keep``, into new scratch folders that no later run reads."""

    def keep(name: str, rows: DataFrame, measures: Mapping[str, Column]) -> tuple[DataFrame, Row]:
        folder = scratch_folder(spark, name)
        found = observed(rows, {"row_count": F.count("*"), **measures}, lambda frame: frame.write.parquet(folder))
        return spark.read.schema(rows.schema).parquet(folder), found.first()

    return keep


def table_exists(spark: SparkSession, table: str, schema: str = "default") -> bool:
    """Whether the catalog knows the table."""
    return spark.catalog.tableExists(f"{schema}.{table}")


def row_count(spark: SparkSession, table: str) -> int:
    """Rows of a catalog table or view."""
    return spark.table(table).count()


def load_audit(spark: SparkSession, counts: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Rows loaded and rejected per table, and a ``total`` row with their sums and the number of tables."""
    rows = [(name, kept, 1, rejected) for name, (kept, rejected) in counts.items()]
    rows.append(("total", sum(r[1] for r in rows), len(rows), sum(r[3] for r in rows)))
    return spark.createDataFrame(
        rows, "table_name string, row_count bigint, tables_loaded bigint, rejected_rows bigint"
    )


def column_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and non-null values per column, from one pass over each table."""
    frames = []
    for name, rows in tables.items():
        counts = rows.agg(
            F.count("*").alias("_rows"), *[F.count(column).alias(column) for column in rows.columns]
        )
        entries = [
            F.struct(F.lit(column).alias("column_name"), F.col(column).alias("values"))
            for column in rows.columns
        ]
        frames.append(
            counts.select("_rows", F.explode(F.array(*entries)).alias("entry")).select(
                F.lit(name).alias("table_name"),
                "entry.column_name",
                F.col("_rows").alias("row_count"),
                F.col("entry.values").alias("non_null_values"),
            )
        )
    return reduce(DataFrame.unionByName, frames)
