"""Oracle SQL of the cluster profile and its dashboards."""

from __future__ import annotations

from oracle import rules as r
from oracle.base import PORTFOLIO, SELF, months_between, ratio

_ACTIVE = f"((closed_dt IS NULL OR closed_dt > as_of) AND das IN {PORTFOLIO})"
_SELF = f"lender_id = {SELF}"
_OTHER = f"lender_id <> {SELF}"
_LOAN = r.LOAN
_CLUST = {
    "only_self": f"({_SELF} AND clust_ind = 'ONLY SELF')",
    "with_others": "clust_ind = 'SELF WITH OTHERS'",
    "mixed": "clust_ind IN ('ONLY SELF', 'SELF WITH OTHERS')",
    "others": f"({_OTHER} AND clust_ind = 'OTHER CLUSTERS')",
}
_LENDER = {"self_lender": _SELF, "other_lender": _OTHER}
_KIND = {
    "banks": "lender_kind = 'Banks'", "nonbanks": "lender_kind = 'Non Banks'", "secured": "product = 'Secured'",
    "unsecured": "product = 'Unsecured'", "other_product": "product = 'Others'",
}
_CL = {"cl": "account_type = 'A13'", "noncl": "account_type <> 'A13'"}
ALL = {"all": "TRUE"}


def _profile_exprs() -> dict[str, str]:
    out: dict[str, str] = {}
    for m, fn, col in (("min_disb", "min", "disbursed_dt"), ("max_dpd", "max", "dpd")):
        for s, t in {**ALL, **_CLUST, **_LENDER}.items():
            out[f"{m}_{s}"] = f"{fn}(CASE WHEN {t} THEN {col} END)"
    for s, t in {**ALL, **_CLUST, **_KIND, **_LENDER}.items():
        out[f"clusters_{s}"] = f"count(DISTINCT CASE WHEN {t} THEN clst_id END)"
    for s, t in {**ALL, **_CL, **_CLUST, **_KIND, **_LENDER}.items():
        out[f"loans_{s}"] = f"count(DISTINCT CASE WHEN {t} THEN account_key END)"
        out[f"active_loans_{s}"] = f"count(DISTINCT CASE WHEN {_ACTIVE} AND {t} THEN account_key END)"
        out[f"outstanding_{s}"] = f"sum(CASE WHEN {_ACTIVE} AND {t} THEN current_balance ELSE 0 END)"
    for s, t in {**ALL, **_CLUST, **_KIND, **_LENDER}.items():
        out[f"disb_{s}"] = f"sum({_LOAN})" if s == "all" else f"sum(CASE WHEN {t} THEN {_LOAN} ELSE 0 END)"
        out[f"act_disb_{s}"] = f"sum(CASE WHEN {_ACTIVE} AND {t} THEN {_LOAN} ELSE 0 END)"
    for s, t in {**ALL, **_CLUST, **_LENDER}.items():
        out[f"min_due_{s}"] = "sum(due_fnl)" if s == "all" else f"sum(CASE WHEN {t} THEN due_fnl ELSE 0 END)"
        out[f"annual_income_{s}"] = f"max(CASE WHEN {t} THEN coalesce(annual_fnl, monthly_fnl) END)"
    return out


PROFILE = _profile_exprs()
_PROFILE_MONEY = [c for c in PROFILE if c.startswith(("outstanding_", "disb_", "act_disb_", "min_due_", "annual_income_"))]
_IN_DATES = "as_of IN (DATE '2000-05-31', DATE '2000-06-30')"


def _sum(c: str, whole: bool = False) -> str:
    return f"CAST(sum({c}) AS BIGINT) AS {c}" if whole else f"sum({c}) AS {c}"


_PARTS = ["all", *_CLUST, *_LENDER, *_CL, *_KIND]
_COUNTS = ", ".join([
    "count(DISTINCT clst_id) AS total_clusters",
    "count(DISTINCT CASE WHEN active_loans_all <> 0 THEN clst_id END) AS active_clusters",
    "count(DISTINCT CASE WHEN clust_ind = 'ONLY SELF' THEN clst_id END) AS only_self_clusters",
    "count(DISTINCT CASE WHEN clust_ind = 'SELF WITH OTHERS' THEN clst_id END) AS with_others_clusters",
    "count(DISTINCT CASE WHEN clust_ind = 'OTHER CLUSTERS' THEN clst_id END) AS other_clusters",
] + [
    f"count(DISTINCT CASE WHEN clusters_{s} > 0 THEN clst_id END) AS total_clusters_{s}" for s in [*_LENDER, *_KIND]
])


def _dpd(c: str) -> str:
    return f"{r.ranges(c, r.B_DPD7)} AS {c}_bucket"


def _amt(c: str) -> str:
    return f"{r.ranges(c, r.B_AMOUNT6, None, 'OTHERS')} AS {c}_bucket"


def _cnt(c: str) -> str:
    return f"{r.ranges(c, r.B_COUNT6)} AS {c}_bucket"


def _grouped(source: str, keys: list[str], buckets: list[str], aggs: str, where: str = "") -> str:
    names = [b.rsplit(" AS ", 1)[1] for b in buckets]
    return (f"SELECT {', '.join(keys + names)}, {aggs} FROM (SELECT *, {', '.join(buckets)} FROM {source}) {where} "
            f"GROUP BY {', '.join(keys + names)}")


_DEBT = r.debt("min_due_all", "annual_income_latest", "outstanding_all", "active_loans_all")
_DTI_DPD = [f"max_dpd_{s}" for s in ("all", "only_self", "with_others", "others", "mixed", "self_lender", "other_lender")]
_DTI_SUMS = ["outstanding_all", "disb_all", "act_disb_all", "min_due_all", "min_due_only_self", "min_due_with_others",
             "min_due_others", "annual_income_all", "annual_income_only_self", "annual_income_with_others",
             "annual_income_mixed", "annual_income_others"]

SQL = {
    "v_cluster_rows": f"""
SELECT x.as_of, m.clst_id, x.account_key, x.consumer_key, x.lender_id, x.account_type, x.das, x.das_flag, x.closed_dt,
  x.disbursed_dt, x.reported_dt, abs(x.high_credit) AS high_credit, abs(x.disbursed_amount) AS disbursed_amount,
  abs(x.credit_limit) AS credit_limit, abs(x.current_balance) AS current_balance, {r.NORM_FREQ} AS instal_freq,
  coalesce({r._RAW}, 0) AS days_past_due, {r.DERIVED_DPD} AS dpd,
  CAST(floor({months_between('as_of', 'birth_dt')} / 12) AS INTEGER) AS age,
  CASE WHEN state IS NOT NULL AND district IS NOT NULL AND pin_code IS NOT NULL THEN 1
    WHEN state IS NOT NULL AND district IS NOT NULL THEN 2 WHEN state IS NOT NULL AND pin_code IS NOT NULL THEN 3
    WHEN district IS NOT NULL AND pin_code IS NOT NULL THEN 4 ELSE 5 END AS sdp,
  coalesce(substr(ownership_ind, 3, 1), '9') AS ownership_ind_flag,
  e.annual_income, e.monthly_income, e.min_amount_due, e.suppress_indicator
FROM (
  SELECT d.as_of, o.* FROM macro_open o JOIN v_dates d ON o.disbursed_dt <= d.as_of
  UNION ALL
  SELECT d.as_of, o.* FROM macro_closed o JOIN v_dates d ON (o.closed_dt IS NULL OR o.closed_dt <= d.as_of)
    AND o.reported_dt <= d.as_of + 39 AND o.act_insert_dt <= d.as_of + 39) x
JOIN cluster_map m ON x.consumer_key = m.candidate_id
LEFT JOIN extra_columns e ON e.account_key = x.account_key AND e.consumer_key = x.consumer_key""",
    "v_dates": "SELECT unnest([DATE '2000-03-31', DATE '2000-05-31', DATE '2000-06-30']) AS as_of",
    "derive_account_rows": f"""
SELECT as_of, clst_id, account_key, consumer_key, das_flag, instal_freq, days_past_due, dpd, age, sdp,
  ownership_ind_flag, current_balance, high_credit, annual_income, min_amount_due
FROM v_cluster_rows WHERE {_IN_DATES}""",
    "v_mix": f"""
SELECT as_of, clst_id, count(DISTINCT account_key) AS total_loans,
  count(DISTINCT CASE WHEN {_SELF} THEN account_key END) AS total_loans_self,
  count(DISTINCT CASE WHEN {_ACTIVE} THEN account_key END) AS total_active_loans,
  sum(CASE WHEN {_ACTIVE} THEN current_balance ELSE 0 END) AS active_outstanding,
  CASE WHEN count(CASE WHEN {_SELF} THEN 1 END) = 0 THEN 'OTHER CLUSTERS'
    WHEN count(DISTINCT account_key) = count(DISTINCT CASE WHEN {_SELF} THEN account_key END) THEN 'ONLY SELF'
    ELSE 'SELF WITH OTHERS' END AS clust_ind
FROM v_cluster_rows GROUP BY as_of, clst_id""",
    "cluster_mix": f"SELECT * FROM v_mix WHERE {_IN_DATES}",
    "threshold_caps": "SELECT * FROM threshold",
    "v_cap_rows": """
SELECT mon_yr, unnest([account_type, 'ALL']) AS scope, abs(current_balance) AS balance, abs(disbursed_amount) AS amount,
  abs(min_amount_due) AS due
FROM account, (VALUES (200004), (200005), (200006)) m(mon_yr)
WHERE year(act_reported_dt) * 100 + month(act_reported_dt) <= mon_yr""",
    "caps_by_month": """
SELECT CAST(mon_yr AS INTEGER) AS mon_yr, scope, min(CASE WHEN rb >= (99*nb + 99)//100 THEN balance END) AS balance_cap,
  min(CASE WHEN ra >= (99*na + 99)//100 THEN amount END) AS amount_cap, min(CASE WHEN rd >= (99*nd + 99)//100 THEN due END) AS min_due_cap
FROM (SELECT *, row_number() OVER (w ORDER BY balance NULLS LAST) AS rb, count(balance) OVER w AS nb,
    row_number() OVER (w ORDER BY amount NULLS LAST) AS ra, count(amount) OVER w AS na,
    row_number() OVER (w ORDER BY due NULLS LAST) AS rd, count(due) OVER w AS nd
  FROM v_cap_rows WINDOW w AS (PARTITION BY mon_yr, scope)) GROUP BY 1, 2""",
    "v_flagged": f"""
SELECT c.*, CASE WHEN coalesce(abs(min_amount_due), 0) <= o.min_due_cap THEN 1 ELSE 0 END AS min_amt_threshold,
  CASE WHEN coalesce(current_balance, 0) <= o.balance_cap AND coalesce({_LOAN}, 0) <= o.amount_cap THEN 1 ELSE 0 END
    AS threshold_flag_overall,
  CASE WHEN t.balance_cap IS NULL OR (coalesce(current_balance, 0) <= t.balance_cap AND coalesce({_LOAN}, 0) <= t.amount_cap)
    THEN 1 ELSE 0 END AS threshold_acnt_type
FROM v_cluster_rows c CROSS JOIN overall_threshold o LEFT JOIN threshold t ON c.account_type = t.account_type""",
    "threshold_flags": f"""
SELECT as_of, account_key, consumer_key, min_amt_threshold, threshold_flag_overall, threshold_acnt_type
FROM v_flagged WHERE {_IN_DATES}""",
    "v_ranked": """
SELECT *, CASE WHEN annual_income IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY as_of, clst_id,
    annual_income IS NULL ORDER BY reported_dt DESC, disbursed_dt DESC, annual_income DESC, account_key, consumer_key)
    AS INTEGER) END AS rw,
  CASE WHEN monthly_income IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY as_of, clst_id,
    monthly_income IS NULL ORDER BY reported_dt DESC, disbursed_dt DESC, monthly_income DESC, account_key, consumer_key)
    AS INTEGER) END AS rw_month
FROM v_flagged""",
    "income_row_rank": f"""
SELECT as_of, clst_id, account_key, consumer_key, annual_income, monthly_income, rw, rw_month
FROM v_ranked WHERE {_IN_DATES}""",
    "v_profile": f"""
SELECT as_of, clst_id, clust_ind, {', '.join(f'{e} AS {n}' for n, e in PROFILE.items())}
FROM (SELECT v.*, x.clust_ind, {r.lender_type('lender_id')} AS lender_kind, {r.product_class('account_type', 'profile')} AS product,
    CASE WHEN rw = 1 THEN annual_income END AS annual_fnl, CASE WHEN rw_month = 1 THEN monthly_income * 12 END AS monthly_fnl,
    CASE WHEN min_amt_threshold = 1 AND rw = 1 THEN min_amount_due END AS due_fnl
  FROM v_ranked v JOIN v_mix x ON v.as_of = x.as_of AND v.clst_id = x.clst_id
  WHERE threshold_flag_overall = 1 AND threshold_acnt_type = 1)
GROUP BY as_of, clst_id, clust_ind""",
    "cluster_profile": f"SELECT * FROM v_profile WHERE {_IN_DATES}",
    "account_type_cluster_counts": f"""
SELECT account_type, count(DISTINCT clst_id) AS total_clusters,
  count(DISTINCT CASE WHEN {_ACTIVE} THEN clst_id END) AS total_active_clusters,
  count(DISTINCT account_key) AS total_loans,
  count(DISTINCT CASE WHEN {_ACTIVE} THEN account_key END) AS total_active_loans
FROM v_cluster_rows WHERE as_of = DATE '2000-06-30' GROUP BY account_type""",
    "portfolio_dashboard": _grouped(
        "cluster_profile", ["as_of", "clust_ind"],
        [_dpd("max_dpd_all")] + [_amt(f"outstanding_{s}") for s in ("all", "secured", "unsecured", "other_product")],
        ", ".join([_COUNTS] + [_sum(f"active_loans_{s}", True) for s in _PARTS] + [_sum(f"outstanding_{s}") for s in _PARTS] + [
            ratio("sum(outstanding_all)", "CASE WHEN sum(active_loans_all) = 0 THEN 1 ELSE sum(active_loans_all) END")
            + " AS avg_outstanding"]),
    ),
    "account_count_dashboard": _grouped(
        "cluster_profile", ["as_of", "clust_ind"],
        [_dpd("max_dpd_all")] + [_cnt(f"active_loans_{s}") for s in ("all", "secured", "unsecured")],
        ", ".join([_COUNTS] + [_sum(f"active_loans_{s}", True) for s in ["all", *_KIND]]),
    ),
    "account_dashboard": f"""
SELECT as_of, clust_ind, ticket_size, lender_type, product, loans_all_bucket, active_loans_all_bucket, dpd_bucket,
  count(DISTINCT clst_id) AS total_clusters, count(DISTINCT CASE WHEN {_ACTIVE} THEN clst_id END) AS active_clusters,
  count(DISTINCT account_key) AS total_loans, count(DISTINCT CASE WHEN {_ACTIVE} THEN account_key END) AS total_active_loans,
  sum(CASE WHEN {_ACTIVE} THEN current_balance ELSE 0 END) AS total_act_outstanding_amount,
  sum({_LOAN}) AS total_disb_amount, sum(CASE WHEN {_ACTIVE} THEN {_LOAN} ELSE 0 END) AS total_act_disb_amount,
  sum(CASE WHEN rw = 1 AND min_amt_threshold = 1 THEN min_amount_due END) AS min_amount_due,
  sum(CASE WHEN rw = 1 THEN annual_income END) AS annual_income
FROM (SELECT v.*, p.clust_ind, {r.ranges(_LOAN, r.B_AMOUNT6, None, 'OTHERS')} AS ticket_size,
    CASE WHEN {_SELF} THEN 'Self' ELSE {r.lender_type('lender_id')} END AS lender_type,
    {r.product_class('account_type', 'dashboard')} AS product,
    {r.ranges('loans_all', r.B_COUNT6)} AS loans_all_bucket,
    {r.ranges('active_loans_all', r.B_COUNT6)} AS active_loans_all_bucket, {r.dpd_account('dpd', 'das')} AS dpd_bucket
  FROM v_ranked v JOIN cluster_profile p ON v.as_of = p.as_of AND v.clst_id = p.clst_id
  WHERE threshold_flag_overall = 1 AND threshold_acnt_type = 1)
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""",
    "income_backfill": """
SELECT p.*, CASE WHEN p.annual_income_all = 0 OR p.annual_income_all IS NULL THEN o.old_income
  ELSE p.annual_income_all END AS annual_income_latest
FROM cluster_profile p JOIN (SELECT clst_id, max(annual_income_all) AS old_income FROM v_profile
  WHERE as_of = DATE '2000-03-31' GROUP BY clst_id) o ON p.clst_id = o.clst_id""",
    "v_dti": f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in _DEBT.items())} FROM income_backfill",
    "dti_table": f"""
SELECT as_of, clst_id, clust_ind, min_due_all, annual_income_latest, outstanding_all, active_loans_all,
  {', '.join(_DEBT)} FROM v_dti""",
    "dti_dashboard": _grouped(
        "v_dti", ["as_of", "clust_ind"],
        [_dpd(c) for c in _DTI_DPD] + [
            f"{r.ranges('(debt_income_ratio * 100)', r.B_DTI)} AS debt_income_ratio_bucket",
            f"{r.ranges('debt_to_income_final', r.B_DTI)} AS debt_to_income_final_bucket",
            f"{r.ranges('debt_to_income_active', r.B_DTI)} AS debt_to_income_active_bucket",
            f"{r.ranges('portfolio_to_income', r.B_PTI)} AS portfolio_to_income_bucket",
            f"{r.ranges('min_due_ratio', r.B_DUE_RATIO)} AS min_due_ratio_bucket",
        ],
        ", ".join([_COUNTS, _sum("loans_all", True), _sum("active_loans_all", True)] + [_sum(c) for c in _DTI_SUMS]),
    ),
}

MONEY = {
    "derive_account_rows": ["current_balance", "high_credit", "annual_income", "min_amount_due"],
    "cluster_mix": ["active_outstanding"],
    "threshold_caps": ["balance_cap", "amount_cap"], "caps_by_month": ["balance_cap", "amount_cap", "min_due_cap"],
    "income_row_rank": ["annual_income", "monthly_income"],
    "cluster_profile": _PROFILE_MONEY,
    "portfolio_dashboard": [f"outstanding_{s}" for s in _PARTS],
    "account_dashboard": ["total_act_outstanding_amount", "total_disb_amount", "total_act_disb_amount", "min_amount_due",
                          "annual_income"],
    "income_backfill": _PROFILE_MONEY + ["annual_income_latest"],
    "dti_table": ["min_due_all", "annual_income_latest", "outstanding_all", "annual_income_new", "min_due_annual"],
    "dti_dashboard": _DTI_SUMS,
}
