"""Row-literal cases for the semantics that are easy to get wrong (FIXTURES §C)."""

import datetime as dt

import builders as B
from rxlens.config import ReportConfig
from rxlens.functions.similarity import jaro_winkler_scalar
from rxlens.plans.report import ReportPlan

CFG = ReportConfig(first_date=dt.date(2024, 4, 1), last_date=dt.date(2024, 4, 30))
ONE = B.user(1, "AB1234567")


def plan(spark, cfg=CFG, **kw):
    return ReportPlan(B.inputs(spark, **kw), cfg, land_stages=False)


def flags(p):
    return {r["rx_number"]: r["search"] for r in p.final.collect()}


def by_id(df):
    return {r["final_id"]: r.asDict() for r in df.collect()}


def test_search_window_edges(spark):
    offsets = [-8, -7, 0, 1, 2]
    disps, searches = [], []
    for i, off in enumerate(offsets):
        dob = B.DOB + dt.timedelta(days=i)
        disps.append(B.disp(rx=i, dob=dob))
        searches.append(B.search(1, created=B.WRITTEN + dt.timedelta(days=off), dob=dob))
    got = flags(plan(spark, disps=disps, searches=searches, users=[ONE]))
    assert [got[i] for i in range(5)] == [False, True, True, True, False]


def test_partial_threshold(spark):
    name = ("JOH", "ZZQQ")
    assert 0.5 < jaro_winkler_scalar("JOH ZZQQ", "JOHN SMITH") < 0.7
    disps = [B.disp(rx=i, dob=B.DOB + dt.timedelta(days=i)) for i in range(3)]
    searches = [B.search(1, dob=B.DOB, first=name[0], last=name[1], pf=True),
                B.search(1, dob=B.DOB + dt.timedelta(days=1), first=name[0], last=name[1], pf=False),
                B.search(1, dob=B.DOB + dt.timedelta(days=2), first=name[0], last=name[1], pf=None)]
    got = flags(plan(spark, disps=disps, searches=searches, users=[ONE]))
    assert got == {0: True, 1: False, 2: False}


def test_partial_or_null(spark):
    p = plan(spark, disps=[B.disp()], searches=[B.search(1, pf=True, pl=None), B.search(1, pf=False, pl=None)],
             users=[ONE])
    got = {(r["partial"], r["ratio_check"]) for r in p.searches.collect()}
    assert got == {(None, None), (True, 0.5)}


def test_flag_by_key_one_survivor(spark):
    disps = [B.disp(rx=7, first="JOHN", last="SMITH"), B.disp(rx=7, first="MARY", last="JONES")]
    p = plan(spark, disps=disps, searches=[B.search(1, first="JOHN", last="SMITH")], users=[ONE])
    rows = p.final.collect()
    assert len(rows) == 1 and rows[0]["search"] is True
    assert rows[0]["patient_name"] == "JOHN SMITH"   # survivor rule: smallest patient name


def test_null_rx_number_never_flagged(spark):
    p = plan(spark, disps=[B.disp(rx=None)], searches=[B.search(1)], users=[ONE])
    rows = p.final.collect()
    assert len(rows) == 1 and rows[0]["search"] is False


def test_shared_dea_credited_to_lowest_id(spark):
    users = [B.user(1, "AB1234567"), B.user(2, "AB7654321, ab1234567 ")]
    p = plan(spark, disps=[B.disp()], searches=[B.search(2)], users=users)
    rows = p.final.collect()
    assert len(rows) == 1 and rows[0]["search"] is True and rows[0]["final_id"] == "1"


def test_unregistered_prescriber(spark):
    p = plan(spark, disps=[B.disp(dea="XY7654321")], users=[ONE])
    r = by_id(p.rates())["XY7654321"]
    assert r["registered"] is False and r["dea_number(s)"] == "XY7654321"
    assert r["prescriber_name"] == "DOC ONE" and r["searches"] == 0 and r["rate"] == 0.0


def test_dea_whitespace_and_case(spark):
    disps = [B.disp(rx=1, dea=" ab1234567\n"), B.disp(rx=2, dea="\tAB1234567 "), B.disp(rx=3, dea="AB12345678")]
    p = plan(spark, disps=disps, users=[ONE])
    assert sorted(r["rx_number"] for r in p.final.collect()) == [1, 2]


def test_vets_filtered_unless_disabled(spark):
    disps = [B.disp(rx=1, animal="Rex"), B.disp(rx=2, animal="Unspecified"), B.disp(rx=3, animal="~"),
             B.disp(rx=4, animal=None)]
    assert sorted(r["rx_number"] for r in plan(spark, disps=disps, users=[ONE]).final.collect()) == [2, 3]
    p = plan(spark, cfg=CFG.with_(filter_vets=False), disps=disps, users=[ONE])
    assert sorted(r["rx_number"] for r in p.final.collect()) == [1, 2, 3, 4]


def _overlap(spark, actives, kind):
    users = [B.user(1, "AB1111111"), B.user(2, "AB2222222")]
    p = plan(spark, disps=[B.disp(dea="AB1111111"), B.disp(rx=2, dea="AB2222222")], users=users,
             actives=actives)
    return {r["final_id"]: r.asDict() for r in p.overlap_counts(kind).collect()}


def test_part_credits_both_prescribers(spark):
    actives = [B.active(dea="AB1111111", ahfs=B.BZD, written=dt.date(2024, 4, 5)),
               B.active(dea="AB2222222", ahfs=B.OPI, written=dt.date(2024, 4, 10))]
    got = _overlap(spark, actives, "part")
    assert got["1"]["overlapping_rx_part"] == 1 and got["2"]["overlapping_rx_part"] == 1


def test_last_same_day_credits_nobody(spark):
    actives = [B.active(dea="AB1111111", ahfs=B.BZD, written=dt.date(2024, 4, 5)),
               B.active(dea="AB2222222", ahfs=B.OPI, written=dt.date(2024, 4, 5))]
    assert _overlap(spark, actives, "last") == {}
    assert len(_overlap(spark, actives, "part")) == 2


def test_last_reporting_lag(spark):
    benzo = B.active(dea="AB1111111", ahfs=B.BZD, written=dt.date(2024, 4, 1), filled=dt.date(2024, 4, 1),
                     create=dt.date(2024, 4, 2))
    on_create = B.active(dea="AB2222222", ahfs=B.OPI, written=dt.date(2024, 4, 2))
    day_after = B.active(dea="AB2222222", ahfs=B.OPI, written=dt.date(2024, 4, 3))
    assert _overlap(spark, [benzo, on_create], "last") == {}
    got = _overlap(spark, [benzo, day_after], "last")
    assert got == {"2": {"final_id": "2", "overlapping_rx_last": 1}}


def test_overlap_name_test(spark):
    actives = [B.active(dea="AB1111111", ahfs=B.BZD, written=dt.date(2024, 4, 5)),
               B.active(dea="AB2222222", ahfs=B.OPI, written=dt.date(2024, 4, 10), first="MARY", last="JONES")]
    assert _overlap(spark, actives, "part") == {}


def test_naive_self_match_and_null_class(spark):
    disps = [B.disp(rx=1, ahfs=B.OPI), B.disp(rx=2, ahfs=None, dob=dt.date(1970, 1, 1)),
             B.disp(rx=3, ahfs=B.OPI, dob=dt.date(1971, 1, 1)), B.disp(rx=4, ahfs=B.BZD)]
    naives = [B.naive(filled=B.WRITTEN)]          # the rx 1 record itself: rx 1 is not naive
    p = plan(spark, disps=disps, users=[ONE], naives=naives)
    assert sorted(r["rx_number"] for r in p.naive_matches().collect()) == [1]
    assert by_id(p.naive_counts())["1"]["opi_to_opi_naive"] == 2   # rx 3 (opioid) and rx 2 (no class)
    full = by_id(p.report(full=True, overlap_type="part"))
    assert full["1"]["opi_to_opi_naive"] == 2 and full["1"]["overlapping_rx_part"] == 0


def test_empty_report_totals(spark):
    p = plan(spark, users=[ONE])
    row = p.totals().collect()[0]
    assert (row["dispensations"], row["searches"], row["rate"]) == (0, 0, None)


def test_report_columns_and_order(spark):
    disps = [B.disp(rx=1), B.disp(rx=2), B.disp(rx=3, dea="XY7654321")]
    p = plan(spark, disps=disps, searches=[B.search(1)], users=[ONE])
    rep = p.report(full=True, overlap_type="both")
    assert rep.columns == ["final_id", "prescriber_name", "dea_number(s)", "license_number", "specialty_1",
                           "specialty_2", "specialty_3", "dispensations", "searches", "rate", "registered",
                           "opi_rx", "benzo_rx", "rx_over_mme_threshold", "overlapping_rx_part",
                           "overlapping_rx_last", "opi_to_opi_naive"]
    rows = rep.collect()
    assert [r["final_id"] for r in rows] == ["XY7654321", "1"]   # fewest searches first
    assert rows[1]["searches"] == 2 and rows[1]["rate"] == 100.0
