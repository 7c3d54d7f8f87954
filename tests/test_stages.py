"""CSV, stored tables and the stages of a full refresh."""

import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from rows import DEFAULTS, table

from plumbline.plans import stages
from plumbline.session import side_by_side
from plumbline.sources import raw_csv
from plumbline.sources.tables import TableStore, load_audit, row_count, table_exists

RUN = "2024-06-01 00:00:00"


def test_round_trip_keeps_values(spark, tmp_path):
    rows = table(
        spark, "projects",
        dict(client_name='He said "hi", twice', project_name=None),
        dict(created_at=datetime(2024, 1, 2, 3, 4, 5, 678901), client_name=" padded "),
    )
    raw_csv.write_csv(rows, str(tmp_path), "projects")
    back = raw_csv.read_csv(spark, str(tmp_path), "projects")
    assert back.schema.simpleString() == rows.schema.simpleString()
    assert sorted(back.collect()) == sorted(rows.collect())


def test_empty_text_is_read_as_null(spark, tmp_path):
    raw_csv.write_csv(table(spark, "projects", dict(project_name="")), str(tmp_path), "projects")
    assert raw_csv.read_csv(spark, str(tmp_path), "projects").first()["project_name"] is None


def test_division_keeps_its_zero(spark, tmp_path):
    raw_csv.write_csv(table(spark, "cost_library", {}), str(tmp_path), "cost_library")
    assert raw_csv.read_csv(spark, str(tmp_path), "cost_library").first()["division"] == "03"


def test_keys_written_as_floats_are_read_exactly(spark, tmp_path):
    header = "review_id,project_id,page_id,takeoff_id,issue_type,severity,resolved,reviewed_at"
    (tmp_path / "qa_reviews.csv").write_text(
        f"{header}\n1,1,12.0,,duplicate,low,True,2024-01-01 10:00:00\n"
        "2,1,,9007199254740993,duplicate,low,False,2024-01-01 10:00:00\n"
    )
    rows = {row["review_id"]: row for row in raw_csv.read_csv(spark, str(tmp_path), "qa_reviews").collect()}
    assert (rows[1]["page_id"], rows[1]["takeoff_id"]) == (12, None)
    assert (rows[2]["page_id"], rows[2]["takeoff_id"]) == (None, 9007199254740993)
    assert rows[1]["resolved"] is True


def test_a_bad_value_stops_the_load(spark, tmp_path):
    (tmp_path / "cost_library.csv").write_text(
        "cost_code,division,division_name,item_type,uom,unit_cost_low,unit_cost_mid,"
        "unit_cost_high,last_updated\nA,03,C,f,EA,cheap,1,2,2024-01-01\n"
    )
    with pytest.raises(Exception, match="cheap|MALFORMED"):
        raw_csv.read_csv(spark, str(tmp_path), "cost_library").collect()


def test_missing_files_are_skipped(spark, tmp_path):
    stages.extract({"projects": table(spark, "projects", {}, {})}, str(tmp_path / "csv"))
    store = TableStore(spark, str(tmp_path / "tables"))
    audit = {row["table_name"]: row for row in stages.load(spark, str(tmp_path / "csv"), store).collect()}
    assert set(audit) == {"projects", "total"}
    assert audit["total"]["row_count"] == 2 and audit["total"]["tables_loaded"] == 1
    assert store.exists("raw.projects") and not store.exists("raw.estimates")
    assert store.row_count("raw.projects") == 2


def test_a_failed_write_keeps_the_table(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    assert not store.exists("raw.t")
    broken = spark.range(5).selectExpr("if(id = 4, raise_error('broken'), id) AS id")
    with pytest.raises(Exception, match="broken"):
        store.replace("raw.t", broken).count()
    assert not store.exists("raw.t")
    for size in (3, 4):
        before = store.replace("raw.t", spark.range(size))
        with pytest.raises(Exception, match="broken"):
            store.replace("raw.t", broken)
        assert store.row_count("raw.t") == before.count() == size
    assert store.replace("raw.t", store.read("raw.t").where("id > 0")).count() == 3
    assert store.row_count("raw.t") == 3


def test_catalog_helpers(spark):
    table(spark, "projects", {}).createOrReplaceTempView("some_projects")
    assert row_count(spark, "some_projects") == 1
    assert not table_exists(spark, "no_such_table")


def test_load_audit(spark):
    audit = load_audit(spark, {"a": (3, 0), "b": (4, 2), "c": (0, 0)}).collect()
    assert {r["table_name"]: (r["row_count"], r["tables_loaded"], r["rejected_rows"]) for r in audit} == {
        "a": (3, 1, 0), "b": (4, 1, 2), "c": (0, 1, 0), "total": (7, 3, 2),
    }


def test_measures_come_with_the_write(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    measures = {"most": F.max("id"), "even": F.count_if(F.col("id") % 2 == 0)}
    for rows, want in [
        (spark.range(7).repartition(3), (7, 6, 4)),
        (spark.range(7).where("id > 10"), (0, None, 0)),
        (spark.createDataFrame([], "id bigint"), (0, None, 0)),
        (spark.range(7).where("false"), (0, None, 0)),
    ]:
        stored = store.replace("t", rows, measures)
        assert tuple(store.measures("t").first()) == want and store.row_count("t") == stored.count() == want[0]
    assert {tuple(r) for r in store.inventory(["t", "u"]).collect()} == {("t", True, 0), ("u", False, None)}


def test_rows_kept_apart(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    for limit, kept in ((2, 2), (0, 0), (9, 5)):
        stored = store.replace("t", spark.range(5), apart=F.col("id") >= limit)
        assert stored.columns == ["id"] and sorted(r["id"] for r in stored.collect()) == list(range(kept))
        assert sorted(r["id"] for r in store.read_apart("t").collect()) == list(range(kept, 5))
        assert tuple(store.measures("t").first()) == (kept, 5 - kept)
    store.replace("t", spark.range(3))
    assert store.read("t").count() == 3 and store.read_apart("t").count() == 0


HEADER = "cost_code,division,division_name,item_type,uom,unit_cost_low,unit_cost_mid,unit_cost_high,last_updated"


def test_bad_lines_are_kept_beside_the_table(spark, tmp_path):
    lines = {
        "A,03,C,f,EA,1,2,3,2024-01-01": None,
        "B,03,C,f,EA,cheap,2,1d,2024-01-01": ["unit_cost_low is no double", "unit_cost_high is no double"],
        "C,03,C,f,EA,1,2,3,2024-13-45": ["last_updated is no date"],
        "D,03,C": ["wrong number of fields"],
        "E,03,C,f,EA,1,2,3,2024-01-01,more": ["wrong number of fields"],
        'F,03,"C, two",f,EA,,1e3,.5,': None,
        "G,03,C,f,EA,1,2,3,2024": ["last_updated is no date"],
    }
    (tmp_path / "cost_library.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    store = TableStore(spark, str(tmp_path / "tables"))
    audit = {r["table_name"]: r for r in stages.load(spark, str(tmp_path), store).collect()}
    assert (audit["cost_library"]["row_count"], audit["cost_library"]["rejected_rows"]) == (2, 5)
    good = {r["cost_code"]: r for r in stages.raw_table(store, "cost_library").collect()}
    assert set(good) == {"A", "F"} and good["F"]["division_name"] == "C, two"
    assert (good["F"]["unit_cost_low"], good["F"]["unit_cost_mid"], good["F"]["unit_cost_high"]) == (None, 1000.0, 0.5)
    found = {r["line"]: r["reasons"] for r in stages.rejects(store, "cost_library").collect()}
    assert found == {line: reasons for line, reasons in lines.items() if reasons}
    assert stages.raw_table(store, "cost_library").schema == raw_csv.read_csv(spark, str(tmp_path), "cost_library").schema
    with pytest.raises(Exception, match="cheap|MALFORMED"):
        stages.load(spark, str(tmp_path), store, strict=True)
    assert stages.raw_table(store, "cost_library").count() == 2


def test_checked_values_equal_strict_ones(spark, tmp_path):
    for name in DEFAULTS:
        raw_csv.write_csv(table(spark, name, {}, {}), str(tmp_path), name)
        strict = raw_csv.read_csv(spark, str(tmp_path), name)
        checked = raw_csv.read_checked(spark, str(tmp_path), name)
        assert checked.where(F.size(raw_csv.REASONS) > 0).count() == 0
        assert checked.drop(raw_csv.LINE, raw_csv.REASONS).collect() == strict.collect()
    header = "review_id,project_id,page_id,takeoff_id,issue_type,severity,resolved,reviewed_at"
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "qa_reviews.csv").write_text(
        f"{header}\n1,1,12.0,9007199254740993,x,low,True,2024-01-01 10:00:00\n2,1,12.5,,x,low,yes,2024-01-01\n"
    )
    good, bad = raw_csv.read_checked(spark, str(tmp_path / "q"), "qa_reviews").orderBy("review_id").collect()
    assert (good["page_id"], good["takeoff_id"], good["resolved"]) == (12, 9007199254740993, True)
    assert bad["_reasons"] == ["page_id is no bigint", "resolved is no boolean", "reviewed_at is no timestamp_ntz"]


def test_full_refresh_and_partial_runs(spark, tmp_path):
    raw = {name: table(spark, name, {}) for name in DEFAULTS}
    store = TableStore(spark, str(tmp_path / "tables"))
    report = stages.run_all(spark, raw, str(tmp_path / "csv"), store, RUN)
    values = {(row["section"], row["metric"]): row["value"] for row in report.collect()}
    assert values["summary", "project_count"] == 1
    assert values["takeoffs", "pct_ai"] == 100.0
    assert values["estimates", "p90_mid"] == 1000.0
    assert values["readiness", "Ready"] == 1
    assert values["quality", "all_checks_passed"] == 1
    results = store.read("dq_test_results")
    assert results.count() == 90 and results.where("NOT passed").count() == 0
    assert store.read("mart_estimation_dashboard").count() == 1
    assert stages.history(store).read().count() == 1

    # Stages run alone on what the earlier ones stored, as often as wanted.
    raw["takeoff_items"] = table(spark, "takeoff_items", {}, dict(quantity=0.0))
    stages.extract(raw, str(tmp_path / "csv"))
    stages.load(spark, str(tmp_path / "csv"), store)
    stages.transform(store, RUN)
    stages.transform(store, RUN)
    assert stages.history(store).read().count() == 1
    checks = {row["check"]: row for row in stages.check(store).collect()}
    assert checks["invalid_quantities"]["value"] == 1
    values = {row["metric"]: row["value"] for row in stages.publish(store).collect()}
    assert values["all_checks_passed"] == 0


def test_csv_is_written_packed(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 2).select(F.col("id").alias("n"))
    pages = table(spark, "blueprint_pages", {}).drop("page_id").crossJoin(rows).withColumnRenamed("n", "page_id")
    raw_csv.write_csv(pages, str(tmp_path), "blueprint_pages")
    lines = pages.select(F.concat_ws(",", *[F.col(c).cast("string") for c in pages.columns]).alias("line"))
    raw_csv.write_lines(lines, str(tmp_path), "projects")
    plain = lines.agg(F.sum(F.length("line") + 1)).first()[0]
    for name in ("blueprint_pages", "projects"):
        files = list((tmp_path / f"{name}.csv").glob("part-*"))
        assert files and all(f.name.endswith(".csv.gz") for f in files)
        assert sum(f.stat().st_size for f in files) < plain / 4
    back = raw_csv.read_csv(spark, str(tmp_path), "blueprint_pages")
    assert back.exceptAll(pages.select(*back.columns)).count() == 0 and back.count() == 20_000


def test_each_text_is_matched_once(spark, tmp_path):
    raw_csv.write_csv(table(spark, "takeoff_items", {}), str(tmp_path), "takeoff_items")
    checked = raw_csv.read_checked(spark, str(tmp_path), "takeoff_items").withColumn("bad", F.size(raw_csv.REASONS) > 0)
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    typed = [f for f in raw_csv.raw_schema("takeoff_items") if f.dataType.simpleString() != "string"]
    assert plan.upper().count("RLIKE(") == len(typed)


def test_tables_are_written_side_by_side(spark):
    both = threading.Barrier(2, timeout=30)  # breaks unless the two meet
    spark.sparkContext.setLocalProperty("plumbline.test", "kept")
    work = lambda name: (name, both.wait() < 2, spark.sparkContext.getLocalProperty("plumbline.test"))
    assert side_by_side(spark, work, ["a", "b"]) == [("a", True, "kept"), ("b", True, "kept")]
    with pytest.raises(KeyError):
        side_by_side(spark, {}.__getitem__, ["a"])
    assert side_by_side(spark, work, []) == []
    spark.sparkContext.setLocalProperty("plumbline.test", None)
