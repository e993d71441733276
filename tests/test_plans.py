import dataclasses

import pytest

from fixtures_files import write_customer_sources, write_employee_sources
from recordloom.operators import profile
from recordloom.operators.quality import QualityGateError
from recordloom.plans.customers import integrate_customers
from recordloom.plans.employees import EmployeeJob
from recordloom.sinks import files
from recordloom.sources.readers import read_golden


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    import datetime as dt

    from recordloom.config import EmployeeRules

    root = tmp_path_factory.mktemp("job")
    rules = EmployeeRules(as_of=dt.date(2026, 1, 1), max_failed_checks=15)
    job = EmployeeJob(spark, write_employee_sources(root, spark), str(root / "out"), rules)
    return job, job.run()


def test_golden_table(spark, finished):
    job, out = finished
    golden = read_golden(spark, out["golden_employees"])
    rows = {r.employee_id: r for r in golden.collect()}
    assert set(rows) == {"GT-000001", "GT-000002", "GT-000004", "AC-000001", "AC-000002", "AC-000007"}
    assert len(golden.columns) == 35
    one = rows["GT-000001"]
    # the first row of the file wins, its gaps are filled from the second, payroll from the newest known values
    assert (one.first_name, one.last_name, one.email, one.department, one.dedup_method) == ("José", "O'Brien", "Jo@Example.com", "Sales", "exact_id")
    assert (one.salary_usd_annual, one.base_salary, one.benefit_plans, one.benefit_coverage_level) == (120000.0, "$10,000", "Dental,Vision", "N/A,Family")
    assert one.source_systems == "globaltech_hris,payroll,benefits"
    merged = rows["AC-000001"]
    assert (merged.dedup_method, merged.source_systems) == ("email_match", "acquiredco_hris,globaltech_hris,payroll")
    assert rows["AC-000002"].first_name == "Canonical" and rows["AC-000002"].last_name == "Row"
    assert read_golden(spark, out["golden_employees"], "AcquiredCo").count() == 3


def test_review_files(spark, finished):
    job, out = finished
    ghosts = spark.read.csv(out["ghost_employees"], header=True)
    assert [(r.payroll_employee_id, r.salary_usd_annual, r.name) for r in ghosts.collect()] == [("GT-000999", "2180.0", None)]
    matches = spark.read.csv(out["probable_matches"], header=True)
    assert matches.columns[:5] == ["record_1_id", "record_2_id", "similarity_score", "hire_date_diff_days", "recommended_action"]
    assert [{r.record_1_name, r.record_2_name} for r in matches.collect()] == [{"Ann Lee", "Ann Leed"}]
    unmapped = spark.read.csv(f"{job.output}/unmapped_departments", header=True)
    assert unmapped.columns == list(files.UNMAPPED_COLUMNS)
    report = spark.read.csv(f"{job.output}/quality_report", header=True)
    assert report.count() == 15


def test_run_summary(spark, finished):
    job, out = finished
    lines = {r.metric: int(r.value) for r in spark.read.csv(out["run_summary"], header=True).collect()}
    assert (lines["globaltech_hris"], lines["acquiredco_hris"], lines["payroll"], lines["benefits"]) == (6, 4, 5, 2)
    assert (lines["golden_employees"], lines["ghost_employees"], lines["probable_matches"]) == (6, 1, 1)
    assert lines["method:email_match"] == 1 and sum(v for k, v in lines.items() if k.startswith("checks:")) == 15
    ((warning, actual),) = [(k, v) for k, v in lines.items() if k.startswith("warning:")]
    assert warning.startswith("warning:stated 99 records in ") and actual == 9


def test_dead_letters(spark, finished):
    job, _ = finished
    letters = files.read_dead_letters(spark, f"{job.output}/dead_letters")
    counts = {r.source_system: r.recorded_failures for r in profile.dead_letter_summary(letters).collect()}
    assert counts == {"globaltech_hris": 4, "acquiredco_hris": 5, "payroll": 3, "benefits": 3}
    assert letters.where("reason = 'Unformattable employee id'").count() == 1


def test_rerun_replaces_golden_and_appends_dead_letters(spark, finished):
    job, out = finished
    before = files.read_dead_letters(spark, f"{job.output}/dead_letters").count()
    again = dataclasses.replace(job, stage="")
    again.run()
    assert read_golden(spark, out["golden_employees"]).count() == 6
    assert files.read_dead_letters(spark, f"{job.output}/dead_letters").count() == 2 * before


def test_gate_stops_before_golden(spark, rules, tmp_path):
    job = EmployeeJob(spark, write_employee_sources(tmp_path, spark), str(tmp_path / "out"), dataclasses.replace(rules, max_failed_checks=0))
    with pytest.raises(QualityGateError):
        job.run()
    assert (tmp_path / "out" / "quality_report").exists() and not (tmp_path / "out" / "golden_employees").exists()


def test_stage_folder_follows_the_session():
    from types import SimpleNamespace

    from recordloom.plans.staging import stage_folder

    def session_with(conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)))

    assert stage_folder(session_with({"spark.checkpoint.dir": "/shared/ck/"}), "x").startswith("/shared/ck/recordloom-")
    assert stage_folder(session_with({}), "/out/_stage").startswith("/out/_stage/recordloom-")


def test_stages_take_frames(spark, finished):
    job, _ = finished
    frames = job.ingest()
    cleaned = job.clean(frames)
    summary = {r.source_system: r for r in profile.stage_summary(frames, cleaned, job.rules).collect()}
    assert summary["payroll"].ingested_records == 5 and summary["globaltech_hris"].canonical_employee_ids == 5
    dates = profile.date_summary(cleaned).collect()
    assert {(r.source_system, r.column) for r in dates} == {
        ("globaltech_hris", "hire_date"), ("acquiredco_hris", "hire_date"), ("payroll", "payroll_effective_date"), ("benefits", "benefit_enrollment_date")}
    got = {r.source_system: tuple(r)[1:] for r in profile.ingestion_summary(frames).collect()}
    assert got["payroll"] == (5, 26, 5, "AcquiredCo, GlobalTech") and got["benefits"] == (2, 26, 2, "GlobalTech")


def test_empty_review_files_have_headers(spark, tmp_path):
    empty = spark.createDataFrame([], "payroll_employee_id string, name string, salary_usd_annual double, ghost_flag_reason string, ghost_employee boolean, company_origin string, source_system string")
    path = files.write_ghosts(empty, str(tmp_path / "g"))
    assert spark.read.csv(path, header=True).columns == list(files.GHOST_COLUMNS)


def test_golden_needs_its_partition_column(spark, tmp_path):
    with pytest.raises(KeyError):
        files.write_golden(spark.range(1), str(tmp_path / "x"))
    path = files.write_golden(spark.createDataFrame([(1, None), (2, "A")], "i int, company_origin string"), str(tmp_path / "y"))
    assert {r.company_origin for r in read_golden(spark, path).collect()} == {"Unknown", "A"}


def test_golden_table_is_replaced_as_a_whole(spark, tmp_path):
    path, rows = str(tmp_path / "g"), lambda n: spark.range(n).selectExpr("id", "'A' AS company_origin")
    with pytest.raises(FileNotFoundError):
        read_golden(spark, path)
    files.write_golden(rows(3), path)
    at_work = read_golden(spark, path)
    # a writer that is killed leaves a folder without a line that names it
    rows(9).write.partitionBy("company_origin").parquet(f"{path}/version=2-killed")
    assert read_golden(spark, path).count() == 3
    with pytest.raises(Exception, match="(?i)broken row"):
        files.write_golden(spark.range(5).selectExpr("if(id = 4, raise_error('broken row'), id) AS id", "'A' AS company_origin"), path)
    assert read_golden(spark, path).count() == 3
    files.write_golden(rows(5), path)
    assert read_golden(spark, path, "A").count() == 5 and at_work.count() == 3


def test_customer_job(spark, customer_rules, tmp_path):
    out = integrate_customers(spark, write_customer_sources(tmp_path), str(tmp_path / "out"), customer_rules)
    rows = {r.email: r for r in spark.read.parquet(out["parquet"]).collect()}
    assert set(rows) == {"al@example.com", "solo@example.com", "mono@example.com", "wide@example.com", "bad", None}
    al = rows["al@example.com"]
    assert (al.first_name, al.last_name, al.region, al.phone, al.opt_out, al.sources, al.source_count) == (
        "Al", "Bee", "US", "+15551234567", True, "crm,website,erp", 3)
    assert spark.read.csv(out["quality_report"], header=True).count() == 7
    assert spark.read.csv(out["csv"], header=True).count() == 6
    lines = {r.metric: int(r.value) for r in spark.read.csv(out["run_summary"], header=True).collect()}
    assert {k: v for k, v in lines.items() if not k.startswith("checks:")} == {
        "website": 3, "crm": 2, "erp": 3, "customer_records": 8, "golden_customers": 6, "test_accounts_removed": 1}
    assert sum(v for k, v in lines.items() if k.startswith("checks:")) == 7


def test_clean_runs_on_a_stream(spark, customer_rules, tmp_path):
    from recordloom.operators.clean import clean_customers

    ddl = "email string, first_name string, last_name string, phone string, region string, registration_date string, opt_out int, source string"
    spark.createDataFrame([("A@X.com", "al", "b", None, "us", "2020-01-01", 0, "crm")], ddl).write.json(str(tmp_path / "in"))
    stream = clean_customers(spark.readStream.schema(ddl).json(str(tmp_path / "in")), customer_rules)
    run = stream.writeStream.format("memory").queryName("cleaned").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    run.awaitTermination(60)
    assert [(r.email, r.region, r.first_name) for r in spark.table("cleaned").collect()] == [("a@x.com", "US", "Al")]
