"""Independent SQL statements (DuckDB dialect) for every registered query.

They restate the report semantics directly in SQL over the same driver
tables (``lineitem orders part supplier`` views), with plain joins,
``row_number`` de-duplication and DuckDB's own ``jaro_winkler_similarity``:
no code is shared with the Spark plans, so agreement is real evidence.
"""

from __future__ import annotations

import datetime as dt

from rxlens.config import BENZO_CLASSES, OPIOID_CLASSES, ReportConfig
from rxlens.sources.fixtures import MONTH, MONTH_KEYS, whole_range_config

WS = r"'^\s+|\s+$'"
DEA_RE = "'[A-Za-z]{2}[0-9]{7}'"


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _awkward(table: str, column: str, tail: str = "", more: str = "") -> str:
    text = f"'\"' || {column} || ' \"the \\ 2nd\", jr\\\"{tail}'"
    return (f"SELECT * REPLACE (CASE WHEN length({column}) % 2 = 0 THEN {text} ELSE {column} END AS {column}{more}) "
            f"FROM {table}")


def _pad(expr: str) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), 7, '0')"


AZ = ("NOT coalesce(refill, false) AND state IN ('AZ') "
      "AND (treatment_type IS NULL OR treatment_type NOT IN ('Hospice', 'Palliative', 'Cancer_Associated')) "
      "AND drug_schedule IN (2, 3, 4)")


def ctes(cfg: ReportConfig, with_nulls: bool = False, from_tables: bool = False) -> str:
    """The shared WITH-list: fixture derivation, then each report stage.

    ``from_tables``: the report inputs are the period's extracts (active accounts,
    attributed searches in the window, eligible dispensations of the period).
    """
    disp_rows, search_id, search_rows, account_rows = "", "true_id", "", ""
    if from_tables:
        disp_rows = f"WHERE written_date BETWEEN {_d(cfg.first_date)} AND {_d(cfg.last_date)} AND {AZ}"
        search_id = "coalesce(delegator_id, requestor_id) AS true_id"
        search_rows = f"WHERE created_date BETWEEN {_d(cfg.search_from)} AND {_d(cfg.search_to)}"
        account_rows = "WHERE active = 'Y'"
    first, last = _d(cfg.first_date), _d(cfg.last_date)
    s_from, s_to = _d(cfg.search_from), _d(cfg.search_to)
    sk, pk = "l_suppkey", "l_partkey"
    ahfs = ("CASE l_returnflag WHEN 'R' THEN 'OPIOID AGONISTS' "
            "WHEN 'A' THEN 'BENZODIAZEPINES (ANXIOLYTIC, SEDATIV/HYP)' ELSE 'AMPHETAMINES' END")
    rx_number = "l_orderkey * 10 + l_linenumber"
    partial_first = f"{pk} % 5 = 0"
    if with_nulls:
        ahfs = f"CASE WHEN {pk} % 29 <> 0 THEN {ahfs} END"
        rx_number = f"CASE WHEN l_orderkey % 97 <> 0 THEN {rx_number} END"
        partial_first = f"CASE WHEN {pk} % 31 <> 0 THEN {partial_first} END"
    human = "animal_name IN ('Unspecified', '~')"
    lag = cfg.report_lag_days
    return f"""
base AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_returnflag,
         o.o_custkey, CAST(o.o_orderdate AS DATE) AS odate, p.p_name
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = o.o_custkey
),
rx AS (
  SELECT
    CASE WHEN l_linenumber % 7 = 0 THEN 'Rex' WHEN l_linenumber % 2 = 0 THEN '~' ELSE 'Unspecified' END AS animal_name,
    CASE WHEN {sk} % 13 = 5 THEN 'zz' || {_pad(sk)}
         WHEN {sk} % 17 = 9 THEN 'BAD'
         WHEN {sk} % 3 = 0 AND {pk} % 2 = 0 THEN 'CD' || {_pad(sk)}
         ELSE ' ab' || {_pad(sk)} || ' ' END AS prescriber_dea,
    CASE WHEN {sk} % 4 = 1 THEN 'ab' || {_pad(sk)} ELSE 'AB' || {_pad(sk)} END AS active_dea,
    {rx_number} AS rx_number,
    {ahfs} AS ahfs,
    split_part(p_name, ' ', 1) AS patient_first_name,
    split_part(p_name, ' ', 2) AS patient_last_name,
    'Doc' AS prescriber_first_name,
    'S' || {_pad(sk)} AS prescriber_last_name,
    odate AS written_date,
    odate + CAST(l_linenumber % 4 AS INTEGER) AS filled_date,
    odate + CAST(l_linenumber % 4 AS INTEGER) + 1 AS disp_created_date,
    DATE '1950-01-01' + CAST(o_custkey % 365 AS INTEGER) AS disp_dob,
    CAST(l_quantity AS INTEGER) AS days_supply,
    l_quantity * 3 AS mme,
    CAST({pk} % 4 + 2 AS INTEGER) AS drug_schedule,
    l_linenumber % 2 = 0 AS refill,
    CASE WHEN {sk} % 9 = 0 THEN 'NM' ELSE 'AZ' END AS state,
    CASE WHEN {pk} % 19 = 0 THEN 'Hospice' END AS treatment_type,
    l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM base
),
disp_extract AS (
  SELECT animal_name, prescriber_dea, rx_number, ahfs, patient_first_name, patient_last_name,
         prescriber_first_name, prescriber_last_name, written_date, filled_date, disp_created_date,
         disp_dob, days_supply, mme
  FROM rx {disp_rows}
),
slog AS (
  SELECT l_suppkey AS true_id,
         CASE WHEN {pk} % 2 = 0 THEN l_suppkey END AS delegator_id,
         l_suppkey + 1 AS requestor_id,
         written_date + CAST(2 - {pk} % 12 AS INTEGER) AS created_date,
         disp_dob AS search_dob,
         CASE WHEN {pk} % 5 = 0 THEN substr(patient_first_name, 1, 2)
              WHEN {pk} % 5 = 1 THEN patient_first_name
              ELSE substr(patient_first_name, 1, 3) || 'x' END AS first_name,
         CASE WHEN {pk} % 5 >= 2 AND {pk} % 11 = 0 THEN 'zzqq' ELSE patient_last_name END AS last_name,
         {partial_first} AS partial_first,
         false AS partial_last
  FROM rx WHERE (l_orderkey + l_linenumber) % 3 = 0
),
search_extract AS (
  SELECT {search_id}, created_date, search_dob, first_name, last_name, partial_first, partial_last
  FROM slog {search_rows}
),
accounts AS (
  SELECT s_suppkey AS true_id, s_name AS user_full_name,
         'AB' || {_pad('s_suppkey')}
           || CASE WHEN s_suppkey % 3 = 0 THEN ', cd' || {_pad('s_suppkey')} ELSE '' END
           || CASE WHEN s_suppkey % 10 = 0 THEN ',AB' || {_pad('s_suppkey + 1')} ELSE '' END AS "dea_number(s)",
         'LIC' || CAST(s_suppkey AS VARCHAR) AS license_number,
         'SPEC' || CAST(s_nationkey AS VARCHAR) AS specialty_1,
         CAST(NULL AS VARCHAR) AS specialty_2,
         CAST(NULL AS VARCHAR) AS specialty_3,
         CASE WHEN s_suppkey % 8 = 7 THEN 'N' ELSE 'Y' END AS active
  FROM supplier
),
users AS (
  SELECT true_id, user_full_name, "dea_number(s)", license_number, specialty_1, specialty_2, specialty_3
  FROM accounts {account_rows}
),
active_extract AS (
  SELECT animal_name, active_dea AS dea, ahfs, disp_dob AS dob, patient_first_name, patient_last_name,
         disp_created_date AS create_date, written_date, filled_date, filled_date + days_supply AS rx_end
  FROM rx
  WHERE filled_date + days_supply >= {first} AND filled_date <= {last}
    AND ahfs IN {_in(OPIOID_CLASSES + BENZO_CLASSES)}
),
naive_extract AS (
  SELECT animal_name, disp_dob AS dob, patient_first_name, patient_last_name,
         filled_date AS naive_filled_date, max(filled_date + days_supply + {cfg.naive_days}) AS naive_end
  FROM rx
  WHERE filled_date + days_supply + {cfg.naive_days} >= {first} AND filled_date <= {last}
    AND ahfs IN {_in(OPIOID_CLASSES)}
  GROUP BY animal_name, disp_dob, patient_first_name, patient_last_name, filled_date
),
ue AS (
  SELECT true_id, regexp_replace(d, {WS}, '', 'g') AS dea_number
  FROM (SELECT true_id,
               unnest(CASE WHEN "dea_number(s)" IS NULL THEN [NULL]
                           ELSE string_split(regexp_replace(upper("dea_number(s)"), {WS}, '', 'g'), ',') END) AS d
        FROM users)
),
d0 AS (
  SELECT animal_name, regexp_replace(upper(prescriber_dea), {WS}, '', 'g') AS prescriber_dea, rx_number, ahfs,
         written_date, filled_date, disp_created_date, disp_dob, days_supply, mme,
         upper(patient_first_name || ' ' || patient_last_name) AS patient_name,
         upper(prescriber_first_name || ' ' || prescriber_last_name) AS prescriber_name
  FROM disp_extract
),
disp AS MATERIALIZED (
  SELECT d0.prescriber_dea, d0.rx_number, d0.ahfs, d0.written_date, d0.filled_date, d0.disp_created_date,
         d0.disp_dob, d0.days_supply, d0.mme, d0.patient_name, d0.prescriber_name, ue.true_id,
         d0.written_date - {cfg.days_before} AS start_date, d0.written_date + 1 AS end_date
  FROM d0 LEFT JOIN ue ON d0.prescriber_dea = ue.dea_number
  WHERE regexp_full_match(d0.prescriber_dea, {DEA_RE}) AND d0.{human}
),
srch AS MATERIALIZED (
  SELECT true_id, created_date, search_dob, upper(first_name || ' ' || last_name) AS full_name,
         (partial_first OR partial_last) AS partial,
         CASE WHEN (partial_first OR partial_last) THEN CAST({cfg.partial_ratio} AS DOUBLE)
              WHEN NOT (partial_first OR partial_last) THEN CAST({cfg.ratio} AS DOUBLE) END AS ratio_check
  FROM search_extract
  WHERE true_id IN (SELECT true_id FROM disp WHERE true_id IS NOT NULL)
    AND created_date BETWEEN {s_from} AND {s_to}
),
cand AS (
  SELECT d.rx_number, d.prescriber_dea, d.written_date, d.true_id, d.disp_dob, d.patient_name,
         s.created_date, s.full_name, s.ratio_check
  FROM disp d JOIN srch s
    ON d.true_id = s.true_id AND d.disp_dob = s.search_dob
   AND s.created_date BETWEEN d.start_date AND d.end_date
),
matched AS (
  SELECT DISTINCT rx_number, prescriber_dea, written_date, true AS search
  FROM cand WHERE round(jaro_winkler_similarity(full_name, patient_name), 9) >= ratio_check
),
ranked AS (
  SELECT disp.*, row_number() OVER (
    PARTITION BY rx_number, prescriber_dea, written_date
    ORDER BY true_id NULLS LAST, patient_name NULLS LAST, disp_dob NULLS LAST, ahfs NULLS LAST,
             mme NULLS LAST, filled_date NULLS LAST, disp_created_date NULLS LAST,
             days_supply NULLS LAST, prescriber_name NULLS LAST, start_date NULLS LAST,
             end_date NULLS LAST) AS rn
  FROM disp
),
final AS MATERIALIZED (
  SELECT r.prescriber_dea, r.rx_number, r.ahfs, r.written_date, r.filled_date, r.disp_created_date,
         r.disp_dob, r.days_supply, r.mme, r.patient_name, r.prescriber_name, r.true_id,
         r.start_date, r.end_date, coalesce(m.search, false) AS search,
         coalesce(CAST(r.true_id AS VARCHAR), r.prescriber_dea) AS final_id
  FROM ranked r LEFT JOIN matched m
    ON r.rx_number = m.rx_number AND r.prescriber_dea = m.prescriber_dea AND r.written_date = m.written_date
  WHERE r.rn = 1
),
cnt AS (
  SELECT final_id, count(*) AS dispensations, CAST(sum(CAST(search AS INTEGER)) AS BIGINT) AS searches,
         count(*) FILTER (WHERE contains(ahfs, '{cfg.opioid_pattern}')) AS opi_rx,
         count(*) FILTER (WHERE contains(ahfs, '{cfg.benzo_pattern}')) AS benzo_rx,
         count(*) FILTER (WHERE mme >= {cfg.mme_threshold}) AS rx_over_mme_threshold
  FROM final GROUP BY final_id
),
uu AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY true_id ORDER BY user_full_name NULLS LAST,
           "dea_number(s)" NULLS LAST, license_number NULLS LAST, specialty_1 NULLS LAST,
           specialty_2 NULLS LAST, specialty_3 NULLS LAST) AS rn
    FROM users) WHERE rn = 1
),
names AS (
  SELECT prescriber_dea AS n_dea, min(prescriber_name) AS dea_prescriber_name FROM disp GROUP BY prescriber_dea
),
rates AS (
  SELECT c.final_id,
         coalesce(u.user_full_name, n.dea_prescriber_name) AS prescriber_name,
         coalesce(u."dea_number(s)",
                  CASE WHEN regexp_full_match(c.final_id, {DEA_RE}) THEN c.final_id END) AS "dea_number(s)",
         u.license_number, u.specialty_1, u.specialty_2, u.specialty_3,
         c.dispensations, c.searches, c.searches / c.dispensations * 100 AS rate,
         TRY_CAST(c.final_id AS BIGINT) IS NOT NULL AS registered,
         c.opi_rx, c.benzo_rx, c.rx_over_mme_threshold
  FROM cnt c
  LEFT JOIN uu u ON TRY_CAST(c.final_id AS BIGINT) = u.true_id
  LEFT JOIN names n ON (CASE WHEN regexp_full_match(c.final_id, {DEA_RE}) THEN c.final_id END) = n.n_dea
),
act AS MATERIALIZED (
  SELECT a.dea, a.ahfs, a.dob, a.create_date, a.written_date, a.filled_date, a.rx_end,
         coalesce(CAST(ue.true_id AS VARCHAR), a.dea) AS final_id,
         upper(a.patient_first_name || ' ' || a.patient_last_name) AS patient_name
  FROM active_extract a LEFT JOIN ue ON a.dea = ue.dea_number
  WHERE a.{human}
),
benzo AS MATERIALIZED (SELECT * FROM act WHERE contains(ahfs, '{cfg.benzo_pattern}')),
opi AS MATERIALIZED (SELECT * FROM act WHERE contains(ahfs, '{cfg.opioid_pattern}')),
pair_dates AS MATERIALIZED (
  SELECT b.final_id, b.dea, b.ahfs, b.dob, b.patient_name, b.written_date, b.filled_date, b.create_date, b.rx_end,
         o.final_id AS final_id_opi, o.dea AS dea_opi, o.ahfs AS ahfs_opi, o.patient_name AS patient_name_opi,
         o.written_date AS written_date_opi, o.filled_date AS filled_date_opi,
         o.create_date AS create_date_opi, o.rx_end AS rx_end_opi,
         (o.written_date BETWEEN b.filled_date AND b.rx_end)
           OR (b.written_date BETWEEN o.filled_date AND o.rx_end) AS is_part,
         (o.written_date BETWEEN b.create_date + {lag} AND b.rx_end)
           OR (b.written_date BETWEEN o.create_date + {lag} AND o.rx_end) AS is_last
  FROM benzo b JOIN opi o ON b.dob = o.dob
   AND ((o.written_date BETWEEN least(b.filled_date, b.create_date + {lag}) AND b.rx_end)
        OR (b.written_date BETWEEN least(o.filled_date, o.create_date + {lag}) AND o.rx_end))
),
name_scores AS MATERIALIZED (
  SELECT patient_name_opi AS name_opi, patient_name AS name_benzo,
         jaro_winkler_similarity(patient_name_opi, patient_name) AS ratio
  FROM (SELECT DISTINCT patient_name_opi, patient_name FROM pair_dates)
),
pair_cols AS (
  SELECT p.*, n.ratio FROM pair_dates p
  JOIN name_scores n ON p.patient_name_opi = n.name_opi AND p.patient_name = n.name_benzo
),
pairs_part AS (
  SELECT * FROM pair_cols WHERE is_part AND round(ratio, 9) >= {cfg.overlap_ratio}
),
pairs_last AS (
  SELECT * FROM pair_cols WHERE is_last AND round(ratio, 9) >= {cfg.overlap_ratio}
),
credit_part AS (
  SELECT final_id, count(*) AS overlapping_rx_part FROM (
    SELECT final_id FROM pairs_part WHERE written_date BETWEEN {first} AND {last}
    UNION ALL
    SELECT final_id_opi FROM pairs_part WHERE written_date_opi BETWEEN {first} AND {last}
  ) GROUP BY final_id
),
credit_last AS (
  SELECT final_id, count(*) AS overlapping_rx_last FROM (
    SELECT final_id FROM pairs_last
      WHERE written_date BETWEEN {first} AND {last} AND written_date > written_date_opi
    UNION ALL
    SELECT final_id_opi FROM pairs_last
      WHERE written_date_opi BETWEEN {first} AND {last} AND written_date < written_date_opi
  ) GROUP BY final_id
),
nv AS (
  SELECT dob, naive_filled_date, naive_end, upper(patient_first_name || ' ' || patient_last_name) AS naive_patient_name
  FROM naive_extract WHERE {human}
),
nmatch AS (
  SELECT DISTINCT f.final_id, f.rx_number
  FROM final f JOIN nv ON f.disp_dob = nv.dob
  WHERE contains(f.ahfs, '{cfg.opioid_pattern}')
    AND f.written_date BETWEEN nv.naive_filled_date AND nv.naive_end
    AND round(jaro_winkler_similarity(nv.naive_patient_name, f.patient_name), 9) >= {cfg.naive_ratio}
),
naive_cnt AS (
  SELECT f.final_id, count(*) AS opi_to_opi_naive
  FROM final f LEFT JOIN (SELECT final_id, rx_number, false AS opi_naive FROM nmatch) m
    ON f.final_id = m.final_id AND f.rx_number = m.rx_number
  WHERE coalesce(contains(f.ahfs, '{cfg.opioid_pattern}') AND coalesce(m.opi_naive, true), true)
  GROUP BY f.final_id
),
report_base AS (
  SELECT final_id, prescriber_name, "dea_number(s)", license_number, specialty_1, specialty_2, specialty_3,
         dispensations, searches, rate, registered, opi_rx, benzo_rx, rx_over_mme_threshold
  FROM rates
)
"""


RATE_SELECT = ('final_id, prescriber_name, "dea_number(s)", license_number, specialty_1, specialty_2, '
               'specialty_3, dispensations, searches, rate, registered')
PAIR_SELECT = ("final_id, dea, ahfs, dob, patient_name, written_date, filled_date, create_date, rx_end, "
               "final_id_opi, dea_opi, ahfs_opi, patient_name_opi, written_date_opi, filled_date_opi, "
               "create_date_opi, rx_end_opi, round(ratio, 6) AS ratio")


def statements() -> dict[str, str]:
    """One statement per registered key."""
    out = period_statements()
    month = whole_range_config(**MONTH)
    monthly = period_statements(month)
    out |= {f"{k}_month": monthly[k] for k in MONTH_KEYS}
    out["report_full_both_nulls"] = period_statements(with_nulls=True)["report_full_both"]
    out["report_from_tables"] = period_statements(month, from_tables=True)["report_full_both"]
    return out


def period_statements(cfg: ReportConfig | None = None, with_nulls: bool = False,
                      from_tables: bool = False) -> dict[str, str]:
    cfg = cfg or whole_range_config()
    first, last = _d(cfg.first_date), _d(cfg.last_date)
    s_from, s_to = _d(cfg.search_from), _d(cfg.search_to)
    bodies = {
        "users": "SELECT * FROM users",
        "csv_users": _awkward("users", "user_full_name", "\nII"),
        "csv_dispensations": _awkward("disp_extract", "patient_first_name",
                                      more=", CAST(rx_number AS VARCHAR) AS rx_number"),
        "csv_searches": _awkward("search_extract", "first_name"),
        "csv_active_rx": _awkward("active_extract", "patient_first_name"),
        "csv_naive_rx": _awkward("naive_extract", "patient_last_name"),
        "users_explode": "SELECT true_id, dea_number FROM ue",
        "dispensations": "SELECT * FROM disp",
        "searches": "SELECT * FROM srch",
        "active_rx": "SELECT * FROM act",
        "naive_rx": "SELECT * FROM nv",
        "extract_users": ('SELECT true_id, user_full_name, "dea_number(s)", license_number, specialty_1, '
                          "specialty_2, specialty_3 FROM accounts WHERE active = 'Y'"),
        "extract_dispensations": (
            "SELECT animal_name, prescriber_dea, rx_number, ahfs, patient_first_name, patient_last_name, "
            "prescriber_first_name, prescriber_last_name, written_date, filled_date, disp_created_date, "
            f"disp_dob, days_supply, mme FROM rx WHERE written_date BETWEEN {first} AND {last} AND {AZ}"),
        "extract_searches": (
            "SELECT coalesce(delegator_id, requestor_id) AS true_id, created_date, search_dob, first_name, "
            f"last_name, partial_first, partial_last FROM slog WHERE created_date BETWEEN {s_from} AND {s_to}"),
        "extract_active_rx": (
            "SELECT animal_name, prescriber_dea AS dea, ahfs, disp_dob AS dob, patient_first_name, "
            "patient_last_name, disp_created_date AS create_date, written_date, filled_date, "
            f"filled_date + days_supply AS rx_end FROM rx WHERE filled_date + days_supply >= {first} "
            f"AND filled_date <= {last} AND ahfs IN {_in(OPIOID_CLASSES + BENZO_CLASSES)}"),
        "extract_naive_rx": "SELECT * FROM naive_extract",
        "filter_vets": (
            "SELECT prescriber_dea, rx_number, ahfs, patient_first_name, patient_last_name, "
            "prescriber_first_name, prescriber_last_name, written_date, filled_date, disp_created_date, "
            "disp_dob, days_supply, mme FROM disp_extract WHERE animal_name IN ('Unspecified', '~')"),
        "valid_dea": (
            "SELECT DISTINCT prescriber_dea AS raw_dea, n AS prescriber_dea, regexp_full_match(n, "
            f"{DEA_RE}) AS valid FROM (SELECT prescriber_dea, regexp_replace(upper(prescriber_dea), {WS}, '', 'g') "
            "AS n FROM disp_extract)"),
        "search_window": "SELECT * FROM cand",
        "search_scan_month": (f"SELECT * FROM search_extract WHERE created_date BETWEEN "
                              f"{_d(MONTH['first_date'] - dt.timedelta(days=cfg.days_before))} "
                              f"AND {_d(MONTH['last_date'] + dt.timedelta(days=1))}"),
        "search_match": "SELECT * FROM matched",
        "final_dispensations": "SELECT * FROM final",
        "prescriber_rates": f"SELECT {RATE_SELECT} FROM rates",
        "opi_rx": f"SELECT final_id, count(*) AS opi_rx FROM final WHERE contains(ahfs, '{cfg.opioid_pattern}') GROUP BY final_id",
        "benzo_rx": f"SELECT final_id, count(*) AS benzo_rx FROM final WHERE contains(ahfs, '{cfg.benzo_pattern}') GROUP BY final_id",
        "rx_over_mme": (f"SELECT final_id, count(*) AS rx_over_mme_threshold FROM final "
                        f"WHERE mme >= {cfg.mme_threshold} GROUP BY final_id"),
        "report_base": "SELECT * FROM report_base",
        "overlap_pairs_part": f"SELECT {PAIR_SELECT} FROM pairs_part",
        "overlap_pairs_last": f"SELECT {PAIR_SELECT} FROM pairs_last",
        "overlap_part": "SELECT * FROM credit_part",
        "overlap_last": "SELECT * FROM credit_last",
        "naive_match": "SELECT * FROM nmatch",
        "opi_to_opi_naive": "SELECT * FROM naive_cnt",
        "report_full": (
            "SELECT r.*, CAST(coalesce(cl.overlapping_rx_last, 0) AS BIGINT) AS overlapping_rx_last, "
            "CAST(coalesce(n.opi_to_opi_naive, 0) AS BIGINT) AS opi_to_opi_naive FROM report_base r "
            "LEFT JOIN credit_last cl ON r.final_id = cl.final_id "
            "LEFT JOIN naive_cnt n ON r.final_id = n.final_id"),
        "report_full_both": (
            "SELECT r.*, CAST(coalesce(cp.overlapping_rx_part, 0) AS BIGINT) AS overlapping_rx_part, "
            "CAST(coalesce(cl.overlapping_rx_last, 0) AS BIGINT) AS overlapping_rx_last, "
            "CAST(coalesce(n.opi_to_opi_naive, 0) AS BIGINT) AS opi_to_opi_naive FROM report_base r "
            "LEFT JOIN credit_part cp ON r.final_id = cp.final_id "
            "LEFT JOIN credit_last cl ON r.final_id = cl.final_id "
            "LEFT JOIN naive_cnt n ON r.final_id = n.final_id"),
        "grand_totals": (
            "SELECT CAST(coalesce(sum(dispensations), 0) AS BIGINT) AS dispensations, "
            "CAST(coalesce(sum(searches), 0) AS BIGINT) AS searches, "
            "round(sum(searches) / sum(dispensations) * 100, 2) AS rate FROM report_base"),
        "similarity": ("SELECT DISTINCT full_name, patient_name, "
                       "round(jaro_winkler_similarity(full_name, patient_name), 9) AS similarity FROM cand"),
        "parse_dates": (
            "SELECT o_orderkey, long_text, plain_text, short_text, "
            "CAST(strptime(long_text, '%B %d, %Y') AS DATE) AS from_long, "
            "CAST(strptime(plain_text, '%B %d, %Y') AS DATE) AS from_plain, "
            "CAST(strptime(short_text, '%m/%d/%Y') AS DATE) AS from_short, "
            "d + 1 AS day_after, d - 7 AS week_before, d + CAST(o_orderkey % 90 AS INTEGER) AS supply_end "
            "FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, "
            "strftime(CAST(o_orderdate AS DATE), '%B %d, %Y') AS long_text, "
            "strftime(CAST(o_orderdate AS DATE), '%B %-d, %Y') AS plain_text, "
            "strftime(CAST(o_orderdate AS DATE), '%-m/%-d/%Y') AS short_text FROM orders)"),
        "previous_month": (
            "SELECT d, CAST(date_trunc('month', d - INTERVAL 1 MONTH) AS DATE) AS period_first, "
            "CAST(last_day(d - INTERVAL 1 MONTH) AS DATE) AS period_last, lower(monthname(d)) AS month, "
            "lower(monthname(d - INTERVAL 1 MONTH)) || CAST(year(d - INTERVAL 1 MONTH) AS VARCHAR) "
            "|| '_mandatory_use_full.csv' AS file_name "
            "FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"),
        "report_period": (
            "SELECT d, today, CAST(date_trunc('month', today - INTERVAL 1 MONTH) AS DATE) AS first_date, "
            "CAST(last_day(today - INTERVAL 1 MONTH) AS DATE) AS last_date FROM (SELECT DISTINCT "
            "CAST(o_orderdate AS DATE) AS d, CAST(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) - INTERVAL 4 HOUR AS DATE) "
            "AS today FROM orders)"),
    }
    head = "WITH " + ctes(cfg, with_nulls, from_tables).strip() + "\n"
    return {k: head + v for k, v in bodies.items()}
