"""Small source files with one of every defect."""

import json


def write_employee_sources(root, spark):
    (root / "hris.csv").write_text(
        "employee_id,first_name,last_name,email,department,job_title,hire_date,country,employment_type,manager_id\n"
        '1, josé ,"O\'BRIEN",Jo@Example.com,sales,"Lead, ""A""\nteam",2020-01-02,US,FT,\n'
        "2,Ann,Lee,ann@example.com,ENG-01,Dev,03/04/2021,NA,pt,1\n"
        "GT003,Bob,Ray,,Mystery,Dev,1960-01-01,DE,temp,1,extra\n"
        "4,Cy\n"
        " ,No,Id,x@example.com,Sales,Dev,2020-01-01,US,FT,1\n"
        "1234567,Too,Long,t@example.com,Sales,Dev,2020-01-01,US,FT,1\n"
        "5,Sam,Poe,sam@example.com,Sales,Dev,2020-02-01,US,FT,1,\n"
        "6,Sam,Poe,SHARED@example.com,Legal,Dev,05-May-2022,US,CONTRACTOR,2\n"
        "GT-1,Later,Copy,late@example.com,Legal,Boss,2019-01-01,FR,FT,\n",
        encoding="utf-8",
    )
    employee = lambda i, first, last, email, when, **more: {
        "employee_identifier": i,
        "name": {"first": first, "last": last},
        "contact": {"email": email},
        "assignment": {"department": "Finance", "role": "Clerk", "hire_timestamp": when, "location": "UK"},
        "employment_type": "Full Time",
        "employment_status": "active",
        "manager_employee_id": "ACQ_00001",
        **more,
    }
    elements = [
        employee("ACQ_00001", "Sam", "Poe", " shared@EXAMPLE.com ", "2022-05-10T08:00:00Z"),
        employee("ACQ_DUP_00002", "Duplicate", "Row", None, "2021-01-01T00:00:00Z"),
        employee("ACQ_00002", "Canonical", None, "can@example.com", "2021-01-01T00:00:00Z"),
        employee(7, "Ann", "Leed","lea@example.com", "2021-03-20T00:00:00Z"),
        employee("", "No", "Id", None, None),
        employee(0, "Zero", "Id", None, None),
        "just text",
        5,
        None,
    ]
    (root / "api.json").write_text(json.dumps({"employees": elements, "total_records": 99}), encoding="utf-8")
    pay = [
        ("1", "GlobalTech", "$10,000", "usd", "Monthly", 5.0, "2023-01-01"),
        ("1", "GlobalTech", None, "usd", "monthly", None, "2024-01-01"),
        ("ACQ_00001", "AcquiredCo", "(1,000)", "EUR", "Annual", 1.0, "2024-01-01"),
        ("999", "GlobalTech", "€1,000", "EUR", "Annual", 1.0, "2023-01-01"),
        ("999", "GlobalTech", "€2,000", "EUR", "Annual", 1.0, "2024-01-01"),
        (None, "GlobalTech", "1", "USD", "Annual", 1.0, "2024-01-01"),
        ("2", " GlobalTech", "1", "USD", "Annual", 1.0, "2024-01-01"),
        ("2", None, "1", "USD", "Annual", 1.0, "2024-01-01"),
    ]
    spark.createDataFrame(
        pay, "employee_id string, source string, base_salary string, currency string, pay_frequency string, "
        "bonus_target_pct double, effective_date string"
    ).write.parquet(str(root / "payroll"))
    enrolment = lambda i, plan, level, when, a, b: (
        f"<enrollment><employee_id>{i}</employee_id><plan_type>{plan}</plan_type><coverage_level>{level}</coverage_level>"
        f"<enrollment_date>{when}</enrollment_date><premium_employee>{a}</premium_employee>"
        f"<premium_employer>{b}</premium_employer></enrollment>"
    )
    (root / "benefits").mkdir()
    (root / "benefits" / "good.xml").write_text(
        "<benefits>"
        + enrolment("1", " Vision ", "Family", "2024-02-01", "20", "60")
        + enrolment("1", "Dental", " ", "2024-01-01", "10", "50.5")
        + enrolment(" ", "Dental", "Family", "2024-01-01", "1", "1")
        + enrolment("2", "", "Family", "2024-01-01", "1", "1")
        + "</benefits>"
    )
    (root / "benefits" / "cut.xml").write_text(
        "<benefits>" + enrolment("6", "Dental", "Family", "2024-01-01", "1", "1") + "<enrollment><employee_id>4</empl"
    )
    return {
        "globaltech_hris": str(root / "hris.csv"),
        "acquiredco_hris": str(root / "api.json"),
        "payroll": str(root / "payroll"),
        "benefits": str(root / "benefits"),
    }


def write_customer_sources(root):
    (root / "web.csv").write_bytes(
        "CustomerEmail,First Name,Last Name,Phone,Region,Registration Date,OptOut\n"
        "Al@Example.com,josé,none,+1 (555) 123-4567,usa,2020-01-05,0\n"
        "x1@TEST.shopstream.com,Test,Account,,US,2023-01-01,0\n"
        "bad,Ann,N/A,123,NA,2020-03-05,1\n"
        ",No,Mail,555.123.4567,EMEA,not a date,1\n".encode("iso-8859-1")
    )
    (root / "crm.json").write_text(json.dumps({"customers": [
        {"id": "c1", "email": "AL@example.com", "profile": {"first_name": "AL", "last_name": "bee"}, "phone": None,
         "region": "NA", "registration_date": "2021-02-01", "opt_out": True, "lifetime_value": 1.5},
        {"id": "c2", "email": "solo@example.com", "profile": {"first_name": "solo"}, "region": "??",
         "registration_date": "bad", "opt_out": False},
    ]}))
    line = lambda i, name, email, phone, region, date, status: (
        f"{i:>10}{name:<50}{email:<60}{phone:<20}{region:<5}{date:<10}{status:<5}")
    (root / "erp.txt").write_text("\n".join([
        line("1", "Al van Bee", "al@example.com", "5551112222", "EU", "2019-05-01", "ACTIV"),
        line("2", "Mono", "mono@example.com", "", "APAC", "2019-06-01", "INACT"),
        line("3", "Wide Region", "wide@example.com", "555", "united states", "2019-06-01", "ACTIV"),
        "",
    ]))
    return {"website": str(root / "web.csv"), "crm": str(root / "crm.json"), "erp": str(root / "erp.txt")}
