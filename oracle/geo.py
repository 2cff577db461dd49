"""Oracle SQL of the district exposure and the geography x product cubes."""

from __future__ import annotations

from oracle import rules as r
from oracle.base import BOOK, mob, yyyymm

_LIVE_BOOK = f"((closed_dt IS NULL OR closed_dt > as_of) AND mfi_das IN {BOOK})"
_LIVE = "((closed_dt IS NULL OR closed_dt > as_of) AND mfi_das IN ('S04','S05'))"
_SHOWN = "coalesce(suppress_indicator, 'N') <> 'Y'"


def _profile(source: str, where: str) -> str:
    return f"""SELECT g.rev_state, g.rev_district, clst_id,
  count(DISTINCT CASE WHEN {_LIVE_BOOK} THEN account_key END) AS active_accounts, count(DISTINCT lender_id) AS overall_lenders,
  count(DISTINCT CASE WHEN {_LIVE_BOOK} THEN lender_id END) AS active_lenders, sum(cur_bal) AS total_outstanding_amount,
  sum(CASE WHEN {_LIVE_BOOK} THEN cur_bal ELSE 0 END) AS portfolio_outstanding, max(dpd) AS max_dpd,
  max(CASE WHEN {_LIVE_BOOK} THEN dpd END) AS max_dpd_active, min(disb_dt) AS min_disb,
  min(CASE WHEN {_LIVE_BOOK} THEN disb_dt END) AS min_disb_active
FROM {source} a JOIN geo_dim g ON a.sdp_key = g.sdp_key
WHERE {_SHOWN} AND g.rev_state IS NOT NULL AND g.rev_district IS NOT NULL {where}
GROUP BY g.rev_state, g.rev_district, clst_id"""


def _base(source: str, where: str) -> str:
    return f"""SELECT a.*, g.rev_state, g.rev_district FROM {source} a JOIN geo_dim g ON a.sdp_key = g.sdp_key
WHERE ({_LIVE} OR mfi_das = 'S06') AND {_SHOWN} {where}"""


def _exposure(base: str, profile: str, label: str) -> str:
    return f"""SELECT load_yyyymm, product_ind, rev_state, rev_district, vintage, outstanding_band, dpd_band AS dpd, active_lender_band,
  disbursed_period, count(DISTINCT clst_id) AS unique_clusters,
  count(DISTINCT CASE WHEN {_LIVE} THEN clst_id END) AS active_clusters, count(DISTINCT account_key) AS total_loans,
  count(DISTINCT CASE WHEN {_LIVE} THEN account_key END) AS active_loans, sum(abs(disb_amt)) AS total_disb_amount,
  sum(CASE WHEN {_LIVE} THEN abs(disb_amt) ELSE 0 END) AS active_disb_amount, sum(abs(amt_due)) AS total_overdue_amount,
  sum(abs(cur_bal)) AS total_outstanding_amount, sum(CASE WHEN {_LIVE} THEN abs(cur_bal) ELSE 0 END) AS active_outstanding_amount
FROM (SELECT b.*, {yyyymm('as_of')} AS load_yyyymm, '{label}' AS product_ind,
    {r.ranges(f"({mob('as_of', 'c.min_disb')} + 1)", r.B_VINTAGE)} AS vintage,
    {r.ranges('abs(c.portfolio_outstanding)', r.B_EXPOSURE, 'BLANK', 'NA')} AS outstanding_band,
    {r.dpd_worst('mfi_das', 'c.max_dpd_active', 'amt_due', 'disb_amt')} AS dpd_band,
    {r.ranges('c.active_lenders', r.B_LENDERS5, 'NA', 'NA')} AS active_lender_band, {r.period('disb_dt')} AS disbursed_period
  FROM {base} b JOIN {profile} c ON b.clst_id = c.clst_id AND b.rev_state = c.rev_state AND b.rev_district = c.rev_district)
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9"""


# fixed values: labels of the exposure file and the bands they stand for
FILE_LENDERS = {"1 Lender": ("1",), "2 Lenders": ("2",), "3 Lenders": ("3",), "4 Lenders": ("4",), ">=5 Lenders": (">=5",)}
FILE_EXPOSURES = {
    "<=15": ("0_10K", "10K_15K"), "15K_30K": ("15K_20K", "20K_25K", "25K_30K"), "30K-60K": ("30K_40K", "40K_60K"),
    "60K-80K": ("60K_80K",), "80K-100K": ("80K_100K",), "100K_150K": ("100K_150K",), ">150K": (">150K",),
}
FILE_DPD = {
    "CURRENT": ("Not Deliquent(Good)",), "1-30 DPD": ("1_30",), "31-60 DPD": ("31_60",), "61-90 DPD": ("61_90",),
    "91-180 DPD": ("91_180",), ">180 DPD": (">180",), "Not stipulated": ("Not Stipulated(Bad)",), "Written-Off": ("WRITEOFF",),
}


def _file(source: str) -> str:
    return f"""SELECT closing_as_of, state, district, borrower_vintage, active_lender, credit_exposure, worst_dpd, disbursed_period,
  CAST(sum(unique_clusters) AS BIGINT) AS active_customers, CAST(sum(total_loans) AS BIGINT) AS active_loans,
  sum(total_disb_amount) AS disbursed_amount_active, sum(total_outstanding_amount) AS portfolio_outstanding,
  sum(total_overdue_amount) AS overdue_amount
FROM (SELECT *, '200006' AS closing_as_of, rev_state AS state, rev_district AS district, vintage AS borrower_vintage,
    {r.relabelled('active_lender_band', FILE_LENDERS, "'NA'")} AS active_lender,
    {r.relabelled('outstanding_band', FILE_EXPOSURES, "'NA'")} AS credit_exposure,
    {r.relabelled('dpd', FILE_DPD, "'NA'")} AS worst_dpd
  FROM {source}) GROUP BY ALL"""


_IN = {"current": "loan_dpd_bucket_key = 15", "ns": "loan_dpd_bucket_key = 1",
       **{b: f"overdue_ind = 1 AND loan_dpd_bucket_key {t}" for b, t in {
           "1_30": "= 2", "31_60": "= 3", "61_90": "= 4", "31_180": "BETWEEN 3 AND 7", "91_180": "BETWEEN 5 AND 7",
           "91_120": "= 5", "121_150": "= 6", "151_180": "= 7", "181_360": "BETWEEN 8 AND 13", "gtr_360": "= 14"}.items()}}


def _recent(n: int) -> str:
    day = "strptime(CAST(disb_yyyymm AS VARCHAR), '%Y%m')"
    return f"{day} BETWEEN DATE '2000-06-01' - INTERVAL {n} MONTH AND DATE '2000-06-01'"


_CUBE = {
    "total_loans": "total_accounts", "total_activ_loans": "CASE WHEN live THEN total_accounts ELSE 0 END",
    "total_disb_amount": "total_disbursed_amount",
    "total_activ_disb_amount": "CASE WHEN live THEN total_disbursed_amount ELSE 0 END",
    "total_act_outstanding_amount": "CASE WHEN live THEN total_outstanding_amount ELSE 0 END",
    "total_written_off_loans": "CASE WHEN das_id IN (6,10) THEN total_accounts ELSE 0 END",
    "total_written_off_amount": "CASE WHEN das_id IN (6,10) THEN total_write_off_amount ELSE 0 END",
    **{f"loans_{b}": f"CASE WHEN live AND {t} THEN total_accounts ELSE 0 END" for b, t in _IN.items()},
    **{f"pos_{b}": f"CASE WHEN live AND {t} THEN total_outstanding_amount ELSE 0 END" for b, t in _IN.items()},
    **{f"loans_{n}m": f"CASE WHEN {_recent(n)} THEN total_accounts ELSE 0 END" for n in (6, 12, 24)},
    **{f"amount_{n}m": f"CASE WHEN {_recent(n)} THEN total_disbursed_amount ELSE 0 END" for n in (6, 12, 24)},
}


def _whole(m: str) -> bool:
    return m.startswith("loans_") or m.endswith("_loans")


def _sum(name: str, expr: str) -> str:
    return f"CAST(sum({expr}) AS BIGINT) AS {name}" if _whole(name) else f"sum({expr}) AS {name}"


_GROUP_1 = r.groups("lender_id", [("SELF", ["NBF004"]), ("Peer Group 1", ["PRB000", "NBF005"]),
                                  ("Peer Group 2", ["PRB001", "HFC007"]), ("Peer Group 3", ["PRB002", "SBI010"]),
                                  ("Peer Group 4", ["NBF004", "FRB011"])], "Peer Group 5")
_GROUP_2 = """CASE WHEN lender_id = 'NBF004' THEN 'SELF' WHEN lender_id IN ('NBF005','PRB000') THEN 'SFBs'
  WHEN lender_id IN ('NBF006','HFC007','PRB000') THEN 'NBFC MFI'
  WHEN lender_id LIKE 'PRB%' OR upper(institution_name) LIKE '%BANK%' THEN 'Banks' ELSE 'Others' END"""


def _geo_cube(variant: str, group: str) -> str:
    return f"""SELECT '{variant}' AS rpt_fmt, load_yyyymm AS quarter, rev_state, rev_district, TRY_CAST(pin_code AS INTEGER) AS pin_code,
  {r.ranges('active_lenders', r.B_LENDERS8)} AS active_lender_band,
  {r.ranges("datediff('month', strptime(CAST(min_disb_yyyymm AS VARCHAR), '%Y%m'), DATE '2000-06-01')", r.B_VINTAGE_M)} AS borrower_vintage,
  {group} AS lender_type, 'MFI' AS product, loan_category AS category, category_name,
  {r.ranges('loan_ticket_size_key', r.B_TICKET_KEYS, 'NA', 'NA')} AS ticket_size,
  CASE WHEN disb_yyyymm <= 199603 THEN 'UPTO FY 1995-1996' WHEN disb_yyyymm > 199603 THEN fyq ELSE 'OTHERS' END AS disbursal_period,
  CASE loan_install_freq_key WHEN 1 THEN 'Weekly' WHEN 2 THEN 'BiWeekly' WHEN 3 THEN 'Monthly' WHEN 4 THEN 'Bimonthly'
    ELSE 'Others' END AS loan_install_freq,
  CASE loan_num_instal_bucket_new_key WHEN 1 THEN '0_6' WHEN 2 THEN '7_12' WHEN 3 THEN '13_24' WHEN 4 THEN 'GRTR24' ELSE 'NA' END AS tenure,
  CASE WHEN suppress_ind_key = 1 THEN 1 ELSE 0 END AS suppressed, {', '.join(_sum(m, e) for m, e in _CUBE.items())}
FROM v_geo_rows GROUP BY ALL"""


def _rep(cube: str) -> str:
    out = [("loans_sanctioned", "total_loans"), ("live_loans", "total_activ_loans"),
           ("total_sanctioned_amount", "total_disb_amount"), ("active_sanctioned_amount", "total_activ_disb_amount"),
           ("portfolio_outstanding", "total_act_outstanding_amount"), ("total_written_off_loans", "total_written_off_loans"),
           ("total_written_off_amount", "total_written_off_amount")]
    for m, o in (("loans", "loans"), ("pos", "par")):
        out += [(f"{o}_std", f"{m}_current"), (f"{o}_not_stipulated", f"{m}_ns")]
        out += [(f"{o}_{b}", f"{m}_{b}") for b in ("1_30", "31_60", "61_90", "91_180", "181_360")]
        out += [(f"{o}_31_180", f"{m}_31_60 + {m}_61_90 + {m}_91_180"), (f"{o}_180plus", f"{m}_181_360 + {m}_gtr_360"),
                (f"{o}_360plus", f"{m}_gtr_360")]
    for n in (6, 12, 24):
        out += [(f"loans_{n}m", f"loans_{n}m"), (f"amount_{n}m", f"amount_{n}m")]
    whole = {"loans_sanctioned", "live_loans"}
    sums = ", ".join(
        f"CAST(sum({e}) AS BIGINT) AS {n}" if n in whole or _whole(n) else f"sum({e}) AS {n}" for n, e in out)
    return f"""SELECT '30-Jun-00' AS book_closing_period, rev_state AS state, rev_district AS district, pin_code AS pincode,
  active_lender_band AS active_lenders, borrower_vintage, lender_type, ticket_size, disbursal_period, tenure,
  loan_install_freq AS repayment_frequency, {sums}
FROM {cube} WHERE suppressed <> 1 GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11"""


SQL = {
    "v_district_base": _base("v_step2", ""),
    "district_active_base": "SELECT account_key, clst_id, sdp_key, rev_state, rev_district, mfi_das, cur_bal FROM v_district_base",
    "district_cluster_profile": _profile("v_step2", "AND g.pin_code IS NOT NULL"),
    "district_exposure": _exposure("v_district_base", "district_cluster_profile", "All"),
    "v_self_rows": "SELECT * FROM v_step2 WHERE clst_id IN (SELECT clst_id FROM v_step2 WHERE lender_id = 'NBF004')",
    "v_self_base": _base("v_self_rows", "AND g.rev_state IS NOT NULL AND g.rev_district IS NOT NULL"),
    "v_self_profile": _profile("v_self_rows", ""),
    "district_exposure_self": _exposure("v_self_base", "v_self_profile", "Self"),
    "exposure_file": _file("district_exposure"), "exposure_file_self": _file("district_exposure_self"),
    "active_lender_density": """
SELECT z.sdp_key, z.rev_state, z.rev_district, z.pin_code, count(DISTINCT CASE WHEN c >= 10 AND a > 0 THEN contri_key END) AS active_lenders
FROM (SELECT sdp_key, contri_key, sum(total_consumers) AS c,
    sum(CASE WHEN loan_account_status_key = 1 THEN total_consumers ELSE 0 END) AS a
  FROM fact_keys WHERE load_yyyymm = 200006 GROUP BY sdp_key, contri_key) k JOIN geo_dim z ON k.sdp_key = z.sdp_key AND z.active = 1
GROUP BY z.sdp_key, z.rev_state, z.rev_district, z.pin_code""",
    "v_geo_rows": """
SELECT f.*, d.rev_state, d.rev_district, d.pin_code, d.active_lenders, l.lender_id, l.institution_name, e.fyq, c.loan_category,
  c.category_name, loan_account_status_key = 1 AS live
FROM fact_keys f JOIN active_lender_density d ON f.sdp_key = d.sdp_key
JOIN lender_dim l ON l.active = 1 AND f.contri_key = l.contri_key LEFT JOIN date_dim e ON f.disb_yyyymm = e.yyyymm
LEFT JOIN category_dim c ON f.loan_account_type_key = c.category_key AND c.active = 1
WHERE f.contri_key NOT IN (9) AND f.load_yyyymm = 200006 AND d.rev_state IS NOT NULL""",
    "geo_product_cube_1": _geo_cube("RPT1", _GROUP_1), "geo_product_cube_2": _geo_cube("RPT2", _GROUP_2),
    "geo_report_1": _rep("geo_product_cube_1"), "geo_report_2": _rep("geo_product_cube_2"),
}
_EXP = ["total_disb_amount", "active_disb_amount", "total_overdue_amount", "total_outstanding_amount", "active_outstanding_amount"]
_FILE = ["disbursed_amount_active", "portfolio_outstanding", "overdue_amount"]
_CUBE_MONEY = [m for m in _CUBE if not _whole(m)]
_REP_MONEY = (["total_sanctioned_amount", "active_sanctioned_amount", "portfolio_outstanding", "total_written_off_amount"]
              + [f"par_{b}" for b in ("std", "not_stipulated", "1_30", "31_60", "61_90", "91_180", "181_360", "31_180",
                                      "180plus", "360plus")] + [f"amount_{n}m" for n in (6, 12, 24)])
MONEY = {
    "district_active_base": ["cur_bal"], "district_cluster_profile": ["total_outstanding_amount", "portfolio_outstanding"],
    "district_exposure": _EXP, "district_exposure_self": _EXP, "exposure_file": _FILE, "exposure_file_self": _FILE,
    "geo_product_cube_1": _CUBE_MONEY, "geo_product_cube_2": _CUBE_MONEY, "geo_report_1": _REP_MONEY, "geo_report_2": _REP_MONEY,
    "export_exposure_file": _FILE, "export_geo_report_1": _REP_MONEY,
}
