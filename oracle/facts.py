"""Oracle SQL of the fact table."""

from __future__ import annotations

from oracle import rules as r
from oracle.base import AS_OF, LENDERS, STATUS_KEYS, label_dim, months_between, shift, values, yyyymm

_BIG = "CAST(100000000000 AS DECIMAL(18,2))"
_AGE = (f"CASE WHEN birth_dt IS NOT NULL THEN {months_between('as_of', 'birth_dt')} / 12 WHEN age IS NOT NULL AND "
        f"age_as_on_dt IS NOT NULL THEN {months_between('as_of', 'age_as_on_dt')} / 12 + age END")


def _share(c: str) -> str:
    part = f"CAST(round(CAST(CAST(abs({c}) AS DOUBLE) / members AS DECIMAL(38,8)), 2) AS DECIMAL(18,2))"
    return f"CASE WHEN s.lender_id = 'PRB003' AND s.loan_category = 'T04' THEN coalesce({part}, 0) ELSE abs({c}) END"


_MONEY = ["amount_overdue_total", "chargeoff_amt", "current_balance", "disbursed_amount", "min_amount_due"]
KEYS = ["sdp_key", "contri_key", "load_yyyymm", "disb_yyyymm", "min_disb_yyyymm", "ln_cat", "loan_account_status", "dpd",
        "overdue_ind", "das", "loan_ticket_size", "loan_cycle_id", "loan_cycle_id_new", "num_instal", "new_num_instal",
        "instal_freq", "borrower_income", "gender", "age", "ln_purpose", "occupation", "suppress_indicator",
        "min_amt_due", "min_amt_due_calc", "min_amt_due_both"]
_CALC = r.min_due_calc("disb_amt", "num_installment")
_LABELS = {
    "sdp_key": "sdp_key", "contri_key": "contri_key", "load_yyyymm": yyyymm("as_of"), "disb_yyyymm": yyyymm("disb_dt"),
    "min_disb_yyyymm": yyyymm("min_disb_dt"),
    "ln_cat": "CASE WHEN ln_cat IN (SELECT loan_category FROM category_dim) THEN ln_cat ELSE 'NA' END",
    "loan_account_status": f"""CASE WHEN closed_dt BETWEEN {shift('as_of', -6)} AND as_of THEN 'CLOSED WITHIN 6 MONTHS'
      WHEN closed_dt < {shift('as_of', -6)} THEN 'CLOSED BEFORE 6 MONTHS'
      WHEN (closed_dt IS NULL OR closed_dt > as_of) AND mfi_das IN ('S04','S05') THEN 'ACTIVE'
      WHEN mfi_das IN ('S06','S07') THEN 'CLOSED' ELSE 'NA' END""",
    "dpd": r.dpd14("b.dpd", "amt_due", "disb_amt"), "overdue_ind": r.overdue("b.dpd", "amt_due", "disb_amt"),
    "das": "mfi_das", "loan_ticket_size": r.ranges("abs(disb_amt)", r.B_TICKET, "BLANK", "NA"),
    "loan_cycle_id": r.cycle3("b.loan_cycle_id"), "loan_cycle_id_new": r.cycle9("b.loan_cycle_id"),
    "num_instal": r.ranges("b.num_instal", r.B_INSTAL, "0_6", "NA"),
    "new_num_instal": r.ranges("b.new_num_instal", r.B_INSTAL, "0_6", "NA"), "instal_freq": "instal_freq",
    "borrower_income": r.ranges("monthly_income", r.B_INCOME, "BLANK", "NA"), "gender": "gender",
    "age": r.ranges("b.age", r.B_AGE, None, "NA"), "ln_purpose": r.purpose("b.ln_purpose"),
    "occupation": r.occupation("b.occupation"), "suppress_indicator": r.suppress("b.suppress_indicator"),
    "min_amt_due": r.ranges("min_amount_due", r.B_MIN_DUE, "BLANK", "NA"),
    "min_amt_due_calc": r.ranges(_CALC, r.B_MIN_DUE, "BLANK", "NA"),
    "min_amt_due_both": r.ranges(f"coalesce(min_amount_due, {_CALC})", r.B_MIN_DUE, "BLANK", "NA"),
}
_DPD_LABELS = [
    "Not Stipulated(Bad)", "1_30", "31_60", "61_90", "91_120", "121_150", "151_180",
    "181_210", "211_240", "241_270", "271_300", "301_330", "331_360", ">360", "Not Deliquent(Good)", "NA",
]


def _last(table, *more: str) -> list[str]:
    return [label for _, _, label in table] + list(more)


_DIMS = {
    "d_state": ["ACTIVE", "CLOSED WITHIN 6 MONTHS", "CLOSED BEFORE 6 MONTHS", "CLOSED", "NA"], "d_dpd": _DPD_LABELS,
    "d_ticket": _last(r.B_TICKET, "BLANK", "NA"), "d_cycle": ["01", "02", ">=03"],
    "d_cycle_new": ["01", "02", "03", "04", "05", "06", "07", "8-10", ">10"],
    "d_instal": ["0_6", "7_12", "13_24", "GRTR24", "NA"],
    "d_freq": ["F01", "F02", "F03", "F04", "F05", "F06", "F07", "F08", "F10", "NA"],
    "d_income": _last(r.B_INCOME, "BLANK", "NA"), "d_age": _last(r.B_AGE, "NA"),
    "d_occupation": ["OTHERS", "AGRI", "CONTRACT_EMP", "SELF_EMP", "EMP", "BLANK", "NA"],
    "d_purpose": ["OTHERS", "INCOME", "EDU", "HOUSE", "AUTOMOBILE", "REALESTATE", "NA", "INVALID"],
    "d_suppress": ["1", "0", "BLANK", "NA"], "d_due": _last(r.B_MIN_DUE, "BLANK", "NA"),
}
_FACT = [
    ("JOIN", "d_category", "ln_cat", "loan_account_type_key"), ("JOIN", "d_state", "loan_account_status", "loan_account_status_key"),
    ("JOIN", "d_dpd", "dpd", "loan_dpd_bucket_key"), ("LEFT JOIN", "d_das", "das", "das_id"),
    ("JOIN", "d_ticket", "loan_ticket_size", "loan_ticket_size_key"), ("JOIN", "d_cycle", "loan_cycle_id", "loan_cycle_key"),
    ("LEFT JOIN", "d_cycle_new", "loan_cycle_id_new", "loan_cycle_new_key"),
    ("JOIN", "d_instal", "num_instal", "loan_num_instal_bucket_key"),
    ("LEFT JOIN", "d_instal", "new_num_instal", "loan_num_instal_bucket_new_key"),
    ("JOIN", "d_freq", "instal_freq", "loan_install_freq_key"), ("JOIN", "d_income", "borrower_income", "borrower_income_key"),
    ("LEFT JOIN", "d_age", "age", "borrower_age_key"), ("JOIN", "d_occupation", "occupation", "borrower_occupation_key"),
    ("JOIN", "d_purpose", "ln_purpose", "borrower_loan_purpose_key"),
    ("JOIN", "d_suppress", "suppress_indicator", "suppress_ind_key"), ("LEFT JOIN", "d_due", "min_amt_due", "min_due_key"),
    ("LEFT JOIN", "d_due", "min_amt_due_calc", "min_due_calc_key"), ("LEFT JOIN", "d_due", "min_amt_due_both", "min_due_both_key"),
]
_METRICS = ["total_centres", "total_groups", "total_accounts", "total_consumers", "total_outstanding_amount",
            "total_disbursed_amount", "total_overdue_amount", "total_write_off_amount", "oldest_loan"]
_LIVE = "loan_account_status_key = 1"
_BANDS = {"1_30": "= 2", "31_60": "= 3", "61_90": "= 4", "91_180": "IN (5,6,7)", "181_360": "BETWEEN 8 AND 13", "360_plus": "= 14"}
_PAR = {
    "total_loans": "total_accounts", "total_disb_amount": "total_disbursed_amount",
    "active_loans": f"CASE WHEN {_LIVE} THEN total_accounts ELSE 0 END",
    "active_disb_amount": f"CASE WHEN {_LIVE} THEN total_disbursed_amount ELSE 0 END",
    "active_outstanding": f"CASE WHEN {_LIVE} THEN total_outstanding_amount ELSE 0 END",
    "lar_0": f"CASE WHEN {_LIVE} AND loan_dpd_bucket_key IN (1,15) THEN total_accounts ELSE 0 END",
    "par_0": f"CASE WHEN {_LIVE} AND loan_dpd_bucket_key IN (1,15) THEN total_outstanding_amount ELSE 0 END",
    **{f"lar_{b}": f"CASE WHEN {_LIVE} AND overdue_ind = 1 AND loan_dpd_bucket_key {t} THEN total_accounts ELSE 0 END"
       for b, t in _BANDS.items()},
    **{f"par_{b}": f"CASE WHEN {_LIVE} AND overdue_ind = 1 AND loan_dpd_bucket_key {t} THEN total_outstanding_amount ELSE 0 END"
       for b, t in _BANDS.items()},
    "total_written_off_loans": "CASE WHEN das_id IN (6,10) THEN total_accounts ELSE 0 END",
    "total_written_off_amount": "CASE WHEN das_id IN (6,10) THEN total_write_off_amount ELSE 0 END",
}

SQL = {
    "mfi_step1": """
SELECT s.*, c.gender, c.age, c.age_as_on_dt, c.birth_dt, c.occupation, c.monthly_income, c.state, c.district, c.pin_code,
  coalesce(m.clst_id, s.consumer_key) AS clst_id, d.min_disb_dt
FROM as_of_snapshot s JOIN latest_consumer c ON s.consumer_key = c.consumer_key
LEFT JOIN cluster_map m ON s.consumer_key = m.candidate_id
LEFT JOIN cluster_min_disbursal d ON s.consumer_key = d.consumer_key""",
    "v_members": "SELECT group_id, count(*) AS members FROM v_reportable WHERE lender_id = 'PRB003' AND loan_category = 'T04' GROUP BY 1",
    "group_share": f"""
SELECT s.account_key, s.lender_id, s.loan_category, s.group_id, {', '.join(f'{_share(c)} AS {c}' for c in _MONEY)}
FROM as_of_snapshot s LEFT JOIN (SELECT group_id, count(*) AS members FROM as_of_snapshot
  WHERE lender_id = 'PRB003' AND loan_category = 'T04' GROUP BY group_id) g ON s.group_id = g.group_id""",
    "geo_key_join": """
SELECT c.consumer_key, g.sdp_key FROM consumer c JOIN geo_dim g ON coalesce(c.state, 'A') = coalesce(g.state, 'A')
  AND coalesce(c.district, 'A') = coalesce(g.district, 'A') AND coalesce(c.pin_code, '123456') = coalesce(g.pin_code, '123456')""",
    "v_reportable": f"""
SELECT * FROM mfi_step1 WHERE account_status NOT IN ('S01','S02','S03')
  AND coalesce(abs(disbursed_amount) < {_BIG}, TRUE)""",
    "v_step2": f"""
SELECT s.as_of, s.account_key, s.account_nbr, s.lender_id, g.sdp_key, l.contri_key, s.clst_id, s.min_disb_dt,
  CASE WHEN s.mfi_das IN ('S04','S05') AND (s.closed_dt IS NULL OR s.closed_dt > s.as_of) THEN s.lender_id END AS active_lender,
  s.mfi_das, s.das, s.closed_dt, s.dpd, {_share('s.amount_overdue_total')} AS amt_due, {_share('s.chargeoff_amt')} AS charge_amt,
  {_share('s.current_balance')} AS cur_bal, {_share('s.disbursed_amount')} AS disb_amt, s.disbursed_dt AS disb_dt,
  abs(s.high_credit) AS high_credit, {r.FREQ_NA} AS instal_freq, s.loan_category AS ln_cat,
  CASE WHEN p.loan_purpose IS NULL THEN 'NA' ELSE p.purpose_status END AS ln_purpose,
  CASE WHEN o.occupation IS NULL THEN 'NULL' ELSE o.occupation_category END AS occupation, s.act_reported_dt AS rpt_dt,
  s.consumer_key, s.group_id, s.centre_id, {_AGE} AS age, {r.tenure('round', 's.instal_freq')} AS num_instal,
  {r.tenure('floor', 's.instal_freq')} AS new_num_instal, s.num_installment, s.gender, abs(s.monthly_income) AS monthly_income,
  trim(s.loan_cycle_id) AS loan_cycle_id, s.suppress_indicator, {_share('s.min_amount_due')} AS min_amount_due
FROM (SELECT *, {r.DIGIT_DPD} AS dpd,
    {r.mfi_status(r.DIGIT_DPD, 'amount_overdue_total', 'disbursed_amount', 'as_of')} AS mfi_das FROM v_reportable) s
LEFT JOIN v_members v ON s.group_id = v.group_id
LEFT JOIN lender_dim l ON s.lender_id = l.lender_id AND l.active = 1
LEFT JOIN purpose_dim p ON s.lender_id = p.lender_id AND s.loan_purpose = p.loan_purpose
JOIN geo_dim g ON coalesce(s.state, 'A') = coalesce(g.state, 'A') AND coalesce(s.district, 'A') = coalesce(g.district, 'A')
  AND coalesce(s.pin_code, '123456') = coalesce(g.pin_code, '123456')
LEFT JOIN occupation_dim o ON s.lender_id = o.lender_id AND s.occupation = o.occupation""",
    "mfi_step2": "SELECT * REPLACE (round(age, 4) AS age) FROM v_step2",
    "category_dim": values([(1, "T01", "Group loan", 1), (2, "T02", "Individual loan", 1), (3, "T03", "Housing loan", 1),
                            (4, "T04", "Other loan", 1)],
                           "category_key, loan_category, category_name, active"),
    "fact_rollup": f"""
SELECT {', '.join(KEYS)}, count(DISTINCT centre_id) AS total_centres, count(DISTINCT group_id) AS total_groups,
  count(DISTINCT account_key) AS total_accounts, count(DISTINCT consumer_key) AS total_consumers,
  coalesce(sum(cur_bal), 0) AS total_outstanding_amount, coalesce(sum(disb_amt), 0) AS total_disbursed_amount,
  coalesce(sum(amt_due), 0) AS total_overdue_amount, coalesce(sum(charge_amt), 0) AS total_write_off_amount,
  min(disb_dt) AS oldest_loan
FROM (SELECT {', '.join(f'{e} AS {k}' for k, e in _LABELS.items())}, centre_id, group_id, account_key, consumer_key, cur_bal,
    disb_amt, amt_due, charge_amt, disb_dt FROM v_step2 b) GROUP BY {', '.join(KEYS)}""",
    **{name: label_dim(labels) for name, labels in _DIMS.items()},
    "d_category": "SELECT category_key AS key, loan_category AS label, active FROM category_dim",
    "d_das": values([(k, c, 1) for c, k in STATUS_KEYS.items()], "key, label, active"),
    "fact_keys": "SELECT f.sdp_key, f.contri_key, f.load_yyyymm, f.disb_yyyymm, f.min_disb_yyyymm, f.overdue_ind, f.gender, "
    + ", ".join(f"x{n}.key AS {key}" for n, (_, _, _, key) in enumerate(_FACT)) + ", "
    + ", ".join(f"f.{m}" for m in _METRICS) + " FROM fact_rollup f "
    + " ".join(f"{how} {dim} x{n} ON f.{label} = x{n}.label" for n, (how, dim, label, _) in enumerate(_FACT)),
    "par_report_from_fact": f"""
SELECT DATE '2000-06-01' AS reported_dt, l.lender_id, l.institution_name AS institution, c.loan_category AS account_type,
  {', '.join(f"CAST(sum({e}) AS BIGINT) AS {m}" if (m.startswith('lar_') or m.endswith('loans')) else f"sum({e}) AS {m}" for m, e in _PAR.items())}
FROM fact_keys f JOIN lender_dim l ON l.active = 1 AND f.contri_key = l.contri_key
JOIN category_dim c ON f.loan_account_type_key = c.category_key AND c.active = 1
WHERE f.load_yyyymm = 200006 AND f.suppress_ind_key <> 1 GROUP BY 2, 3, 4""",
}
_FEW = ["load_yyyymm", "contri_key", "ln_cat", "loan_account_status"]
SQL |= {
    "fact_rollup_portfolio": f"""
SELECT {', '.join(_FEW)}, count(DISTINCT centre_id) AS total_centres, count(DISTINCT group_id) AS total_groups,
  count(DISTINCT account_key) AS total_accounts, count(DISTINCT consumer_key) AS total_consumers,
  coalesce(sum(cur_bal), 0) AS total_outstanding_amount, coalesce(sum(disb_amt), 0) AS total_disbursed_amount,
  coalesce(sum(amt_due), 0) AS total_overdue_amount, coalesce(sum(charge_amt), 0) AS total_write_off_amount,
  min(disb_dt) AS oldest_loan
FROM (SELECT {', '.join(f'{_LABELS[k]} AS {k}' for k in _FEW)}, centre_id, group_id, account_key, consumer_key, cur_bal,
    disb_amt, amt_due, charge_amt, disb_dt FROM v_step2 b) GROUP BY {', '.join(_FEW)}""",
    "bucketed_mfi_step1": "SELECT * FROM mfi_step1",
    "stored_fact_months": """
SELECT load_yyyymm, contri_key, count(*) AS facts, CAST(sum(total_accounts) AS BIGINT) AS total_accounts,
  sum(total_outstanding_amount) AS total_outstanding_amount FROM v_fact_two_months GROUP BY 1, 2""",
    "members_by_place": """
SELECT g.rev_state, g.rev_district, count(DISTINCT s.consumer_key) AS consumers, count(DISTINCT s.account_key) AS accounts,
  count(DISTINCT s.clst_id) AS clusters
FROM v_step2_two_months s JOIN geo_dim g ON s.sdp_key = g.sdp_key GROUP BY 1, 2""",
}
_AMOUNTS = ["total_outstanding_amount", "total_disbursed_amount", "total_overdue_amount", "total_write_off_amount"]
MONEY = {
    "mfi_step1": _MONEY + ["high_credit", "monthly_income"], "bucketed_mfi_step1": _MONEY + ["high_credit", "monthly_income"], "group_share": _MONEY,
    "mfi_step2": ["amt_due", "charge_amt", "cur_bal", "disb_amt", "high_credit", "monthly_income", "min_amount_due"],
    "fact_rollup": _AMOUNTS, "fact_rollup_portfolio": _AMOUNTS, "fact_keys": _AMOUNTS, "stored_fact_months": ["total_outstanding_amount"],
    "par_report_from_fact": [m for m in _PAR if not (m.startswith("lar_") or m.endswith("loans"))],
}
del AS_OF, LENDERS
