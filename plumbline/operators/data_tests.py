"""Declared data tests from one keyed state: each yields how many failures it found.

Every table is read once. A row gives one entry for each of its tested keys and
for each of its offences; the entries of all tables are counted together per
(domain, key). That state answers ``unique``, both sides of ``relationships``
and the distinct values of ``accepted_values``, so all tests share one shuffle,
and a key or an offence that a third of all rows have reaches it as one row per
task. States of several deliveries add up.

Result columns: test, table_name, column_name, severity, failures, passed.
A failing test is a row, never an exception.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.fixed_values import TEST_SEVERITY

# Gives the frame of a table by its name.
Tables = Callable[[str], DataFrame]
# Tables made row by row from another: their name, the other's and how. The maker
# keeps columns it does not know.
Derived = Mapping[str, tuple[str, Callable[[DataFrame], DataFrame]]]


ENTRIES = "_entries"


class RowTest(NamedTuple):
    """A test that every row must pass: ``offends`` is true for one that does not."""

    test: str
    table: str
    column: str
    offends: Column


@dataclass(frozen=True)
class Declared:
    """What is to be tested, by table name; relationships are (child, column, parent, parent column)."""

    unique: Mapping[str, Sequence[str]] = field(default_factory=dict)
    not_null: Mapping[str, Sequence[str]] = field(default_factory=dict)
    accepted_values: Mapping[str, Mapping[str, Sequence[str]]] = field(default_factory=dict)
    relationships: Sequence[tuple[str, str, str, str]] = ()
    row_tests: Sequence[RowTest] = ()


class _Entry(NamedTuple):
    """What a row of ``table`` adds to the state: ``key`` in ``domain``, counted in ``slot``; NULL adds nothing."""

    table: str
    domain: int
    slot: int
    key: Column


class _Answer(NamedTuple):
    test: str
    table: str
    column: str
    domain: int
    measure: str


def _plan(declared: Declared, derived: Derived = {}) -> tuple[list[_Entry], list[_Answer], int]:
    """Entries that the tests need, where each test finds its answer, and the number of slots.

    A parent key and its children share a domain, the parent in slot 0; any
    other key and any offence has a domain of its own. A key of a derived table is
    counted beside that of its origin, in a slot of its own, so that the two
    travel as one row where they are equal.
    """
    entries: list[_Entry] = []
    answers: list[_Answer] = []
    parents: dict[tuple[str, str], int] = {}  # (table, column) -> domain in which it has slot 0
    children: dict[tuple[str, str], tuple[int, int]] = {}  # -> any domain and slot it is counted in
    used: dict[int, int] = {}
    domains, slots = 0, 1

    def own_domain(table: str, column: str) -> int:
        nonlocal domains
        if (table, column) not in parents:
            parents[table, column] = domains
            entries.append(_Entry(table, domains, 0, F.col(column).cast("string")))
            domains += 1
        return parents[table, column]

    for child, column, parent, parent_column in declared.relationships:
        domain = own_domain(parent, parent_column)
        slot = used[domain] = used.get(domain, 0) + 1
        slots = max(slots, slot + 1)
        children.setdefault((child, column), (domain, slot))
        entries.append(_Entry(child, domain, slot, F.col(column).cast("string")))
        answers.append(_Answer("relationships", child, column, domain, f"orphans_{slot}"))
    for table, columns in declared.unique.items():
        for column in columns:
            origin = (derived[table][0], column) if table in derived else None
            if (table, column) in children and (table, column) not in parents:
                domain, slot = children[table, column]
            elif (table, column) not in parents and (origin in parents or origin in children):
                domain = parents[origin] if origin in parents else children[origin][0]
                slot = used[domain] = used.get(domain, 0) + 1
                slots = max(slots, slot + 1)
                children[table, column] = domain, slot
                entries.append(_Entry(table, domain, slot, F.col(column).cast("string")))
            else:
                domain, slot = own_domain(table, column), 0
            answers.append(_Answer("unique", table, column, domain, f"repeated_{slot}"))

    def offence(test: str, table: str, column: str, key: Column, measure: str) -> None:
        nonlocal domains
        entries.append(_Entry(table, domains, 0, key))
        answers.append(_Answer(test, table, column, domains, measure))
        domains += 1

    for table, columns in declared.not_null.items():
        for column in columns:
            offence("not_null", table, column, F.when(F.col(column).isNull(), ""), "rows_0")
    for table, accepted in declared.accepted_values.items():
        for column, values in accepted.items():
            value = F.col(column)
            foreign = F.when(~value.isin(list(values)), value.cast("string"))
            offence("accepted_values", table, column, foreign, "keys")
    for test, table, column, offends in declared.row_tests:
        offence(test, table, column, F.when(offends, ""), "rows_0")
    return entries, answers, slots


def _state(tables: Tables, entries: Sequence[_Entry], slots: int, derived: Derived = {}) -> DataFrame:
    """(domain, key) with the rows of each slot, from one pass over every table.

    A derived table shares the pass over its origin, if that is tested too.
    """
    by_table: dict[str, list[Column]] = {}
    for table, domain, slot, key in entries:
        found = F.struct(F.lit(domain).alias("domain"), F.lit(slot).alias("slot"), key.alias("key"))
        by_table.setdefault(table, []).append(F.when(key.isNotNull(), found))
    every = {table: F.array_compact(F.array(*found)) for table, found in by_table.items()}
    # At most one derived table joins the pass of an origin; a second one is read by itself.
    beside = {derived[table][0]: table for table in every if table in derived and derived[table][0] in every}
    parts = []
    for table, found in every.items():
        if table in beside.values():
            continue
        rows = tables(table).withColumn(ENTRIES, found)
        if table in beside:
            other = beside[table]
            rows = derived[other][1](rows).withColumn(ENTRIES, F.concat(F.col(ENTRIES), every[other]))
        parts.append(rows.select(F.explode(ENTRIES).alias("entry")).select("entry.*"))
    counts = [F.count_if(F.col("slot") == slot).alias(f"n_{slot}") for slot in range(slots)]
    return reduce(DataFrame.unionByName, parts).groupBy("domain", "key").agg(*counts)


def results(tables: Tables, declared: Declared, derived: Derived = {}) -> DataFrame:
    """One row per declared test.

    ``unique``: non-null values that occur more than once. ``not_null``: rows
    without a value. ``accepted_values``: distinct non-null values outside the
    list. ``relationships``: rows whose non-null key no parent has. Row tests:
    offending rows. Keys are compared as text, so a key and its parent must be
    of one type. Empty tables fail nothing. ``derived`` names tables that are read with their origin.
    """
    entries, answers, slots = _plan(declared, derived)
    measures = [F.count("*").alias("keys"), F.sum("n_0").alias("rows_0")]
    measures += [F.count_if(F.col(f"n_{slot}") > 1).alias(f"repeated_{slot}") for slot in range(slots)]
    measures += [
        F.sum(F.when(F.col("n_0") == 0, F.col(f"n_{slot}")).otherwise(0)).alias(f"orphans_{slot}")
        for slot in range(1, slots)
    ]
    found = _state(tables, entries, slots, derived).groupBy("domain").agg(*measures)
    names = [name for name in found.columns if name != "domain"]
    asked = found.sparkSession.createDataFrame(
        answers, "test string, table_name string, column_name string, domain int, measure string"
    )
    # The measures are one row per domain at most, so their size is that of the declaration.
    failures = F.coalesce(
        *[F.when(F.col("measure") == name, F.col(name).cast("bigint")) for name in names], F.lit(0)
    )
    return (
        asked.join(F.broadcast(found), "domain", "left")
        .withColumn("failures", failures)
        .select(
            "test", "table_name", "column_name", F.lit(TEST_SEVERITY).alias("severity"),
            "failures", (F.col("failures") == 0).alias("passed"),
        )
    )


def unusable_keys(rows: DataFrame, column: str) -> DataFrame:
    """One row with the number of repeated and of NULL keys."""
    keys = rows.groupBy(column).count()
    missing = F.col(column).isNull()
    return keys.agg(
        F.count_if(~missing & (F.col("count") > 1)).alias("repeated"),
        F.count_if(missing).alias("missing"),
    )


def orphan_keys(
    tables: Tables, relationships: Sequence[tuple[str, str, str, str]]
) -> DataFrame:
    """Keys of children that no parent has: child_table, column_name, parent_table, missing_key, rows.

    From the same state, for all relationships at once. NULL keys do not count.
    """
    entries, answers, slots = _plan(Declared(relationships=relationships))
    cases = [
        F.when(
            (F.col("domain") == answer.domain) & (F.col(f"n_{slot}") > 0),
            F.struct(
                F.lit(answer.table).alias("child_table"),
                F.lit(answer.column).alias("column_name"),
                F.lit(parent).alias("parent_table"),
                F.col("key").alias("missing_key"),
                F.col(f"n_{slot}").alias("rows"),
            ),
        )
        for answer, (_, _, parent, _) in zip(answers, relationships)
        for slot in [int(answer.measure.removeprefix("orphans_"))]
    ]
    missing = _state(tables, entries, slots).where("n_0 = 0")
    return missing.select(F.explode(F.array_compact(F.array(*cases))).alias("orphan")).select("orphan.*")
