import json

import pytest
from pyspark.sql import functions as F

from fixtures_files import write_customer_sources, write_employee_sources
from recordloom.config import CUSTOMER_SCHEMA, EMPLOYEE_SCHEMA, POSITION
from recordloom.sources import align, readers


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    return write_employee_sources(tmp_path_factory.mktemp("hr"), spark)


@pytest.fixture(scope="module")
def customer_paths(tmp_path_factory):
    return write_customer_sources(tmp_path_factory.mktemp("shop"))


def reasons(rejects):
    return [(r.reason, json.loads(r.raw_record)) for r in rejects.collect()]


def test_hris_csv(spark, paths):
    got = readers.read_hris_csv(spark, paths["globaltech_hris"])
    assert [c for c in got.frame.columns if c != POSITION] == list(EMPLOYEE_SCHEMA)
    rows = {r.employee_id: r for r in got.frame.collect()}
    assert set(rows) == {"1", "2", "4", "1234567", "6", "GT-1"}
    assert rows["1"].job_title == 'Lead, "A"\nteam'
    assert rows["1"].manager_id is None and rows["2"].country is None
    assert rows["4"].last_name is None and rows["4"].source_system == "globaltech_hris"
    assert rows["2"].company_origin == "GlobalTech" and rows["2"].currency is None
    bad = reasons(got.rejects)
    assert sorted(r for r, _ in bad) == ["Malformed CSV row", "Malformed CSV row", "Missing required identity field: employee_id"]
    assert any(rec.get("line", "").startswith("GT003") for _, rec in bad)
    assert any(rec.get("line", "").startswith("5,Sam") for _, rec in bad)
    assert all("manager_id" in rec for _, rec in bad)


def test_hris_csv_file_order(spark, paths):
    frame = readers.read_hris_csv(spark, paths["globaltech_hris"]).frame
    assert [r.employee_id for r in frame.orderBy(POSITION).collect()] == ["1", "2", "4", "1234567", "6", "GT-1"]


def test_missing_columns_and_file(spark, tmp_path):
    (tmp_path / "x.csv").write_text("employee_id,first_name\n1,A\n")
    got = readers.read_hris_csv(spark, str(tmp_path / "x.csv"))
    assert got.frame.isEmpty() and list(got.frame.columns) == list(EMPLOYEE_SCHEMA)
    ((reason, record),) = reasons(got.rejects)
    assert reason.startswith("Missing required columns: ['country', 'department'")
    assert record == {"available_columns": ["employee_id", "first_name"]}
    gone = readers.read_payroll(spark, str(tmp_path / "none"), None)
    ((reason, record),) = reasons(gone.rejects)
    assert gone.frame.isEmpty() and "PATH_NOT_FOUND" in reason and record["filepath"].endswith("none")


def test_hris_json(spark, paths):
    got = readers.read_hris_json(spark, paths["acquiredco_hris"])
    rows = {r.employee_id: r for r in got.frame.collect()}
    assert set(rows) == {"ACQ_00001", "ACQ_DUP_00002", "ACQ_00002", "7"}
    assert rows["7"].first_name == "Ann" and rows["7"].country == "UK" and rows["7"].job_title == "Clerk"
    assert rows["7"].hire_date == "2021-03-20T00:00:00Z" and rows["7"].company_origin == "AcquiredCo"
    bad = reasons(got.rejects)
    assert len(bad) == 5
    assert {r["raw_value"] for _, r in bad if "raw_value" in r} == {"just text", 5, None}


def test_json_document_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "cut.json").write_text('{"employees": [{"employee_identifier": "1"')
    got = readers.read_hris_json(spark, str(tmp_path / "cut.json"))
    assert got.frame.isEmpty() and got.rejects.count() == 1


def test_json_without_required_fields(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"employees": [{"employee_identifier": "1", "name": {"first": "A"}}]}')
    got = readers.read_hris_json(spark, str(tmp_path / "x.json"))
    assert got.frame.isEmpty()
    assert reasons(got.rejects)[0][0] == "Missing required columns: ['contact_email', 'name_last']"


def test_json_count(spark, paths):
    stated = readers.read_hris_json(spark, paths["acquiredco_hris"]).stated
    assert [tuple(r)[1:] for r in stated.collect()] == [(99, 9)]


def test_payroll(spark, paths, rules):
    got = readers.read_payroll(spark, paths["payroll"], rules)
    assert sorted(r.employee_id for r in got.frame.collect()) == ["1", "1", "999", "999", "ACQ_00001"]
    assert sorted(r for r, _ in reasons(got.rejects)) == [
        "Missing required identity field: employee_id", "Unknown payroll company source", "Unknown payroll company source"]


PAY_HEADER = "employee_id,source,base_salary,currency,pay_frequency,bonus_target_pct,effective_date\n"


def test_payroll_csv_keeps_over_long_lines_as_rejects(spark, rules, tmp_path):
    (tmp_path / "p.csv").write_text(PAY_HEADER + "8,GlobalTech,70,EUR,Annual,1,2024-01-01\n9,GlobalTech,80,EUR,Annual,1,2024-01-01,x,y\n")
    got = readers.read_payroll(spark, str(tmp_path / "p.csv"), rules, "csv")
    assert [r.employee_id for r in got.frame.collect()] == ["8"]
    ((reason, record),) = reasons(got.rejects)
    assert reason == "Malformed CSV row" and record["line"].endswith(",x,y")


def test_files_with_another_column_order_fail(spark, rules, tmp_path):
    (tmp_path / "a.csv").write_text(PAY_HEADER + "8,GlobalTech,70,EUR,Annual,1,2024-01-01\n")
    (tmp_path / "b.csv").write_text(PAY_HEADER.replace("base_salary,currency", "currency,base_salary") + "9,GlobalTech,EUR,7,Annual,1,2024-01-01\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_payroll(spark, str(tmp_path), rules, "csv").frame.collect()


def test_website_keeps_over_long_lines_as_rejects(spark, customer_rules, tmp_path):
    (tmp_path / "w.csv").write_text(
        "CustomerEmail,First Name,Last Name,Phone,Region,Registration Date,OptOut\n"
        "kim@here.example,Kim,Oh,1,US,2020-01-05,0\nlou@here.example,Lou,Ek,1,US,2020-01-05,0,more,cells\n")
    got = readers.read_website(spark, str(tmp_path / "w.csv"), customer_rules)
    assert [r.first_name for r in got.frame.collect()] == ["Kim"]
    ((reason, record),) = reasons(got.rejects)
    assert reason == "Malformed CSV row" and record["line"].startswith("lou@")


def test_benefits(spark, paths):
    got = readers.read_benefits_xml(spark, paths["benefits"])
    rows = got.frame.orderBy("benefit_plans").collect()
    assert [(r.employee_id, r.benefit_plans, r.benefit_coverage_level, r.benefits_enrolled, r.benefit_plan_count) for r in rows] == [
        ("1", "Dental", None, True, 1), ("1", "Vision", "Family", True, 1)]
    assert float(rows[0].premium_employer) == 50.5
    bad = reasons(got.rejects)
    assert sorted(r for r, _ in bad) == [
        "Malformed enrollment or missing employee_id/plan_type", "Malformed enrollment or missing employee_id/plan_type",
        "ParseError: malformed XML document"]


def test_benefits_without_required_tags(spark, tmp_path):
    one = "<enrollment><employee_id>{}</employee_id><plan_type>Dental</plan_type><coverage_level/></enrollment>"
    (tmp_path / "few.xml").write_text("<benefits>" + one.format("1") + one.format("") + "</benefits>")
    got = readers.read_benefits_xml(spark, str(tmp_path / "few.xml"))
    assert got.frame.isEmpty() and list(got.frame.columns) == list(EMPLOYEE_SCHEMA)
    by = dict(reasons(got.rejects))
    assert set(by) == {"Malformed enrollment or missing employee_id/plan_type",
                       "Missing required columns: ['enrollment_date', 'premium_employee', 'premium_employer']"}
    assert {"available_columns": ["coverage_level", "employee_id", "plan_type"]} in [
        {k: sorted(v) for k, v in r.items()} for r in by.values() if "available_columns" in r]
    (tmp_path / "none.xml").write_text("<benefits></benefits>")
    none = readers.read_benefits_xml(spark, str(tmp_path / "none.xml"))
    assert none.frame.isEmpty() and none.rejects.isEmpty()


def test_align(spark):
    df = spark.createDataFrame([("42", "Ada", "Lovelace")], "employee_id string, first_name string, last_name string")
    got = align.align_employees(df, "globaltech_hris")
    assert got.columns == list(EMPLOYEE_SCHEMA)
    row = got.first()
    assert (row.source_system, row.company_origin, row.currency) == ("globaltech_hris", "GlobalTech", None)
    with pytest.raises(ValueError):
        align.align_employees(df, "elsewhere")
    plans = align.align_employees(spark.createDataFrame([("1", "Dental")], "employee_id string, plan_type string"), "benefits").first()
    assert plans.benefits_enrolled is True and plans.benefit_plan_count == 1


def test_flatten(spark):
    df = spark.sql("select named_struct('b', 1, 'c', named_struct('d', 2)) a, array(3) e")
    assert align.flatten_json(df).columns == ["a_b", "a_c_d", "e"]


def test_customer_sources(spark, customer_paths, customer_rules):
    stacked = readers.ingest_customers(spark, customer_paths, customer_rules)
    rows = stacked.orderBy("source", POSITION).drop(POSITION).collect()
    assert list(rows[0].asDict()) == list(CUSTOMER_SCHEMA)
    web = [r for r in rows if r.source == "website"]
    assert [(r.first_name, r.last_name, r.region) for r in web] == [("josé", None, "usa"), ("Ann", None, None), ("No", "Mail", "EMEA")]
    assert web[2].email is None and web[2].registration_date is None
    crm = [r for r in rows if r.source == "crm"]
    assert [(r.first_name, r.last_name, r.region, r.opt_out) for r in crm] == [("AL", "bee", "NA", "1"), ("solo", None, "??", "0")]
    erp = [r for r in rows if r.source == "erp"]
    assert [(r.first_name, r.last_name, r.region) for r in erp] == [("Al", "van Bee", "EU"), ("Mono", None, "APAC"), ("Wide", "Region", "unite")]
    assert erp[2].registration_date is None


def page(root, n, size, total=None):
    doc = {"customers": [{"email": f"p{n}_{i}@x.com"} for i in range(size)]}
    if total is not None:
        doc["total_pages"] = total
    (root / f"page_{n}.json").write_text(json.dumps(doc))


def emails(df):
    return sorted(r.email for r in df.collect())


def test_paged_stop_rules(spark, tmp_path):
    empty = tmp_path / "a"
    empty.mkdir()
    for n, size in [(1, 2), (2, 1), (3, 0), (4, 1)]:
        page(empty, n, size, 9)
    assert emails(readers.read_paged_json(spark, str(empty))) == ["p1_0@x.com", "p1_1@x.com", "p2_0@x.com"]
    total = tmp_path / "b"
    total.mkdir()
    for n in (1, 2, 3):
        page(total, n, 1, 2)
    assert emails(readers.read_paged_json(spark, str(total))) == ["p1_0@x.com", "p2_0@x.com"]
    unstated = tmp_path / "c"
    unstated.mkdir()
    page(unstated, 1, 1)
    page(unstated, 2, 1)
    assert emails(readers.read_paged_json(spark, str(unstated))) == ["p1_0@x.com"]


@pytest.mark.parametrize("line,expected", [("a,b", False), ("a", False), ("a,b,c", True), ("a,b,", True), ('a,"b,c"', False),
                                           ('a,"b"",c"', False), ("a,b,,x", True), (None, False)])
def test_over_long(spark, line, expected):
    df = spark.createDataFrame([(line,)], "l string")
    assert df.select(readers.over_long(F.col("l"), 2)).first()[0] is expected


def test_spread_only_when_tasks_are_missing(spark):
    from recordloom.sources.spread import spread

    assert spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(9)
    assert spread(many) is many
