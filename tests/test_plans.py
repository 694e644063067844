"""Physical-plan shape: equi-keyed interval joins, no nested loops, pushdown."""

import builders as B
from test_literals import CFG

from rxlens.operators import match
from rxlens.plans.report import ReportPlan


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def small_plan(spark):
    disps = [B.disp(rx=1), B.disp(rx=2, ahfs=B.BZD)]
    actives = [B.active(ahfs=B.BZD), B.active(ahfs=B.OPI)]
    return ReportPlan(B.inputs(spark, disps=disps, searches=[B.search(1)], users=[B.user(1, "AB1234567")],
                               actives=actives, naives=[B.naive()]), CFG, land_stages=False)


def test_no_nested_loops_or_cartesian(spark):
    p = small_plan(spark)
    for df in (p.report(full=True, overlap_type="both"), p.pairs("part"), p.naive_matches()):
        text = plan_text(df)
        assert "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text


def test_search_join_keys(spark):
    p = small_plan(spark)
    cands = match.search_candidates(p.dispensations, p.searches, p.cfg)
    text = cands._jdf.queryExecution().sparkPlan().toString()
    join_line = next(line for line in text.splitlines() if "Join" in line and "Inner" in line)
    # owner id, birth date and time bucket are all equi-keys
    assert join_line.count("#") >= 6, join_line


def test_overlap_join_is_inner(spark):
    p = small_plan(spark)
    text = p.pairs("last")._jdf.queryExecution().sparkPlan().toString()
    joins = [ln for ln in text.splitlines() if "Join" in ln and "dob" in ln]
    assert all("Inner" in ln for ln in joins)
    pair_joins = [ln for ln in joins if "_point_bucket" in ln]
    assert len(pair_joins) == 2, text          # the two disjoint branches
    assert all("SortMergeJoin" in ln for ln in pair_joins)


def test_hot_names_scored_before_prescriptions_meet(spark):
    """Birth dates over ``name_block``: the scorer reads distinct patients, no prescription column lies below it."""
    p = small_plan(spark)
    p.cfg = p.cfg.with_(name_block=1)
    p.inputs["active_rx"] = p.inputs["active_rx"].union(p.inputs["active_rx"])
    lines = p.pairs("last")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda ln: len(ln) - len(ln.lstrip(" :+-|"))
    below = []
    for at in (i for i, ln in enumerate(lines) if "ArrowEvalPython" in ln):
        part = []
        for ln in lines[at + 1:]:
            if depth(ln) <= depth(lines[at]):
                break
            part.append(ln)
        below.append(part)
    by_name = [part for part in below if any("_name_a" in ln for ln in part)]
    assert by_name and not any("_point_bucket" in ln for part in by_name for ln in part)
    assert any("_key_a" in ln for ln in by_name[0])


def test_parquet_pushdown(spark, sf_small):
    from rxlens.plans.queries import q_extract_dispensations
    text = q_extract_dispensations(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(l_orderkey)" in text.split("PushedFilters: [", 1)[1]
    assert "l_extendedprice" not in text   # pruned column never read


def test_dedupe_is_partial_aggregate_not_window(spark):
    """A key holding a large share of rows is reduced map-side, never gathered by a window."""
    p = small_plan(spark)
    text = plan_text(p.final_core)
    assert "partial_min" in text
    assert "Window" not in text


def test_names_skip_owned_deas(spark):
    """Only DEAs without a registered owner reach the name aggregation."""
    p = small_plan(spark)
    assert "LeftAnti" in plan_text(p.names)
    assert p.names.count() == 0                   # the one DEA of the plan has an owner


def test_base_join_shuffles_at_every_size(spark, sf_small):
    from rxlens.sources.fixtures import base_rows
    text = base_rows(spark, sf_small)._jdf.queryExecution().sparkPlan().toString()
    assert any("SortMergeJoin" in ln and "l_orderkey" in ln for ln in text.splitlines()), text


def test_single_extract_queries_start_no_job(spark, sf_small):
    """Building these keys runs nothing but the size check of the owner table."""
    from rxlens.plans import queries as Q
    from rxlens.sources import fixtures
    before = set(fixtures._LANDED)
    for key in ("users", "users_explode", "dispensations", "active_rx", "naive_rx"):
        Q.QUERIES[key](spark, sf_small)
    assert set(fixtures._LANDED) == before


def test_search_window_pairs_every_search_with_its_dispensations(spark, tmp_path):
    """Pairs over the whole range, also outside the report month, and names that will not match; not a scan of searches."""
    import datetime as dt
    from rxlens.plans.queries import CANDIDATE_COLUMNS, QUERIES
    days = [dt.datetime(1996, 3, 1), dt.datetime(1996, 3, 3), dt.datetime(1998, 4, 10)]
    tables = {
        "lineitem": ([(k, 12, 3, 2 if k == 1 else 1, 10.0, "R") for k in (1, 2, 5)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string"),
        "orders": ([(k, 7, d) for k, d in zip((1, 2, 5), days)], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "part": ([(7, "JOHN SMITH")], "p_partkey long, p_name string"),
        "supplier": ([(3, "S3", 1)], "s_suppkey long, s_name string, s_nationkey int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = QUERIES["search_window"](spark, str(tmp_path))
    assert got.columns == list(CANDIDATE_COLUMNS)
    # searches of orders 1, 2 and 5, two days after each: within [written - 7, written + 1] of orders 2 (from 1) alone
    assert sorted((r["rx_number"], r["created_date"].isoformat()) for r in got.collect()) == [(21, "1996-03-03")]
