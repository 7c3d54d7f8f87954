"""A type-2 history stored by its changes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from plumbline.session import one_row, path_exists

COMMITS = T.StructType().add("sequence", T.IntegerType()).add("run", T.StringType()).add("schema", T.StringType())


class HistoryStore:
    """One folder with the versions that each run closed, the open versions, and its commits.

    * ``open/0`` and ``open/1`` take turns: a run writes what it merged to the
      one that is not live, its open and closed versions apart.
    * ``closed/<run>-<sequence>`` has what that run closed and is written once.
      The history grows by its changes, not by its runs.
    * ``commits`` has one small row per run, appended last: it makes the two
      others live. A run that fails before leaves the history as it was.

    The last run may be repeated, which needs no older copy: what it closed is
    opened again and what it opened is left out. An earlier run is refused.
    A frame that was read stays valid through one further run.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def commits(self) -> list[Row]:
        """One row per run, with the last of its tries; as many as there are runs."""
        if not path_exists(self.spark, f"{self.root}/commits"):
            return []
        rows = self.spark.read.schema(COMMITS).json(f"{self.root}/commits").collect()
        last = {row["run"]: row for row in sorted(rows, key=lambda row: row["sequence"])}
        return [last[run] for run in sorted(last)]

    def _merged(self, commit: Row) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(commit["schema"]))
        return self.spark.read.schema(schema.add("_closed", T.IntegerType())).parquet(
            f"{self.root}/open/{commit['sequence'] % 2}"
        )

    def _open(self, commit: Row) -> DataFrame:
        return self._merged(commit).where("_closed = 0").drop("_closed")

    def _closed(self, commits: list[Row]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(commits[-1]["schema"]))
        return self.spark.read.schema(schema).parquet(*[self._closed_path(c) for c in commits])

    def _closed_path(self, commit: Row) -> str:
        return f"{self.root}/closed/{commit['run']}-{commit['sequence']}"

    def read(self) -> DataFrame | None:
        """All versions after the last run."""
        commits = self.commits()
        if not commits:
            return None
        return self._closed(commits).unionByName(self._open(commits[-1]))

    def open_before(self, run_time: str) -> DataFrame | None:
        """Versions that were open before a run, the next one or the last one again.

        None if that run is the first.
        """
        run, commits = run_name(run_time), self.commits()
        if commits and run < commits[-1]["run"]:
            raise ValueError(f"a run after {run_time} is stored")
        if not [commit for commit in commits if commit["run"] < run]:
            return None
        before = self._open(commits[-1])
        if commits[-1]["run"] == run:
            started = F.lit(run_time).cast("timestamp_ntz")
            reopened = self._closed(commits[-1:]).withColumn(
                "valid_to", F.lit(None).cast("timestamp_ntz")
            )
            before = before.where(F.col("valid_from") < started).unionByName(reopened)
        return before

    def add(self, run_time: str, merged: DataFrame) -> DataFrame:
        """Store the open versions after a run with those it closed; returns the history."""
        commits = self.commits()
        sequence = max((row["sequence"] for row in commits), default=-1) + 1
        commit = Row(sequence=sequence, run=run_name(run_time), schema=merged.schema.json())
        side = f"{self.root}/open/{sequence % 2}"
        is_closed = F.col("valid_to").isNotNull().cast("int")
        merged.withColumn("_closed", is_closed).write.partitionBy("_closed").mode(
            "overwrite"
        ).parquet(side)
        self._merged(commit).where("_closed = 1").drop("_closed").write.mode("overwrite").parquet(
            self._closed_path(commit)
        )
        one_row(self.spark, COMMITS, commit).write.mode("append").json(f"{self.root}/commits")
        return self.read()


def run_name(run_time: str) -> str:
    return "t" + "".join(mark for mark in run_time if mark.isdigit())
