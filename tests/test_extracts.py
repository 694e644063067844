"""E2 eligibility rules, including the fields the driver tables do not carry."""

import datetime as dt

from rxlens.config import Eligibility, ReportConfig
from rxlens.sources.extracts import eligibility_filter, extract_dispensations


def test_eligibility_rules(spark):
    rows = [
        # ahfs, refill, state, days, role, location, treatment, schedule
        ("OPIOID AGONISTS", False, "AZ", 30, "MD", "HOME", None, 2),
        ("OPIOID AGONISTS", True, "AZ", 30, "MD", "HOME", None, 2),            # refill
        ("OPIOID AGONISTS", False, "NM", 30, "MD", "HOME", None, 2),           # state
        ("OPIOID AGONISTS", False, "AZ", 0, "MD", "HOME", None, 2),            # days supply
        ("OPIOID AGONISTS", False, "AZ", 30, "RESIDENT", "HOME", None, 2),     # role
        ("OPIOID AGONISTS", False, "AZ", 30, "MD", "INPATIENT", None, 2),      # location
        ("OPIOID AGONISTS", False, "AZ", 30, "MD", "HOME", "Hospice", 2),      # treatment
        ("OPIOID AGONISTS", False, "AZ", 30, "MD", "HOME", None, 5),           # schedule
        ("AMPHETAMINES", False, "AZ", 30, "MD", "HOME", None, 2),              # class
        ("OPIOID AGONISTS", None, "AZ", 30, None, None, None, 3),              # nulls kept
    ]
    df = spark.createDataFrame(rows, "ahfs string, refill boolean, state string, days_supply int, "
                                     "prescriber_role string, patient_location string, treatment_type string, "
                                     "drug_schedule int")
    rules = Eligibility(ahfs_in=("OPIOID AGONISTS",), include_refills=False, states=("AZ",), min_days_supply=1,
                        excluded_roles=("RESIDENT",), excluded_locations=("INPATIENT",),
                        excluded_treatment_types=("Hospice",), schedules=(2, 3, 4))
    kept = df.filter(eligibility_filter(rules)).collect()
    assert len(kept) == 2 and {r["drug_schedule"] for r in kept} == {2, 3}
    assert df.filter(eligibility_filter(Eligibility())).count() == len(rows)


def test_extract_period_is_closed(spark):
    d = dt.date
    rows = [(d(2024, 3, 31),), (d(2024, 4, 1),), (d(2024, 4, 30),), (d(2024, 5, 1),)]
    df = spark.createDataFrame(rows, "written_date date")
    cfg = ReportConfig(first_date=d(2024, 4, 1), last_date=d(2024, 4, 30))
    got = sorted(r["written_date"] for r in extract_dispensations(df, cfg).collect())
    assert got == [d(2024, 4, 1), d(2024, 4, 30)]
