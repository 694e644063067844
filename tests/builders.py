"""Tiny literal inputs for the report operators (clean extract layouts)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

D = dt.date
OPI = "OPIOID AGONISTS"
BZD = "BENZODIAZEPINES (ANXIOLYTIC, SEDATIV/HYP)"

DISP_SCHEMA = T.StructType([
    T.StructField("animal_name", T.StringType()), T.StructField("prescriber_dea", T.StringType()),
    T.StructField("rx_number", T.LongType()), T.StructField("ahfs", T.StringType()),
    T.StructField("patient_first_name", T.StringType()), T.StructField("patient_last_name", T.StringType()),
    T.StructField("prescriber_first_name", T.StringType()), T.StructField("prescriber_last_name", T.StringType()),
    T.StructField("written_date", T.DateType()), T.StructField("filled_date", T.DateType()),
    T.StructField("disp_created_date", T.DateType()), T.StructField("disp_dob", T.DateType()),
    T.StructField("days_supply", T.IntegerType()), T.StructField("mme", T.DoubleType()),
])
SEARCH_SCHEMA = T.StructType([
    T.StructField("true_id", T.LongType()), T.StructField("created_date", T.DateType()),
    T.StructField("search_dob", T.DateType()), T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()), T.StructField("partial_first", T.BooleanType()),
    T.StructField("partial_last", T.BooleanType()),
])
USER_SCHEMA = T.StructType([
    T.StructField("true_id", T.LongType()), T.StructField("user_full_name", T.StringType()),
    T.StructField("dea_number(s)", T.StringType()), T.StructField("license_number", T.StringType()),
    T.StructField("specialty_1", T.StringType()), T.StructField("specialty_2", T.StringType()),
    T.StructField("specialty_3", T.StringType()),
])
ACTIVE_SCHEMA = T.StructType([
    T.StructField("animal_name", T.StringType()), T.StructField("dea", T.StringType()),
    T.StructField("ahfs", T.StringType()), T.StructField("dob", T.DateType()),
    T.StructField("patient_first_name", T.StringType()), T.StructField("patient_last_name", T.StringType()),
    T.StructField("create_date", T.DateType()), T.StructField("written_date", T.DateType()),
    T.StructField("filled_date", T.DateType()), T.StructField("rx_end", T.DateType()),
])
NAIVE_SCHEMA = T.StructType([
    T.StructField("animal_name", T.StringType()), T.StructField("dob", T.DateType()),
    T.StructField("patient_first_name", T.StringType()), T.StructField("patient_last_name", T.StringType()),
    T.StructField("naive_filled_date", T.DateType()), T.StructField("naive_end", T.DateType()),
])

DOB = D(1980, 5, 5)
WRITTEN = D(2024, 4, 10)


def disp(rx=1, dea="AB1234567", ahfs=OPI, first="JOHN", last="SMITH", written=WRITTEN, filled=None,
         dob=DOB, days=30, mme=30.0, animal="~"):
    filled = filled or written
    return (animal, dea, rx, ahfs, first, last, "DOC", "ONE", written, filled,
            filled + dt.timedelta(days=1), dob, days, mme)


def search(true_id=1, created=WRITTEN, dob=DOB, first="JOHN", last="SMITH", pf=False, pl=False):
    return (true_id, created, dob, first, last, pf, pl)


def user(true_id=1, deas="AB1234567", name="DR ONE"):
    return (true_id, name, deas, f"LIC{true_id}", "SPEC", None, None)


def active(dea="AB1234567", ahfs=OPI, written=WRITTEN, filled=None, create=None, days=30, dob=DOB,
           first="JOHN", last="SMITH", animal="~"):
    filled = filled or written
    create = create or filled + dt.timedelta(days=1)
    return (animal, dea, ahfs, dob, first, last, create, written, filled, filled + dt.timedelta(days=days))


def naive(first="JOHN", last="SMITH", filled=WRITTEN, end=None, dob=DOB, animal="~"):
    return (animal, dob, first, last, filled, end or filled + dt.timedelta(days=90))


def inputs(spark, disps=(), searches=(), users=(), actives=(), naives=()):
    return {
        "dispensations": spark.createDataFrame(list(disps), DISP_SCHEMA),
        "searches": spark.createDataFrame(list(searches), SEARCH_SCHEMA),
        "users": spark.createDataFrame(list(users), USER_SCHEMA),
        "active_rx": spark.createDataFrame(list(actives), ACTIVE_SCHEMA),
        "naive_rx": spark.createDataFrame(list(naives), NAIVE_SCHEMA),
    }
