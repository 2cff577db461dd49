"""Oracle SQL of the snapshot operators."""

from __future__ import annotations

from oracle.base import AS_OF

_T = ("t.act_reported_dt, t.lender_id, t.account_status, t.das, t.amount_overdue_total, t.current_balance, "
      "t.chargeoff_amt, t.closed_dt, t.days_past_due, t.min_amount_due")
_U = ("u.account_nbr, u.disbursed_amount, u.disbursed_dt, u.instal_freq, u.loan_category, u.loan_cycle_id, "
      "u.loan_purpose, u.num_installment, u.suppress_indicator")
_P = "p.consumer_key, p.high_credit, p.centre_id, p.group_id"


def _as_p(text: str) -> str:
    return text.replace("t.", "p.").replace("u.", "p.")


_HIST = ("x.account_key, x.lender_id, x.account_type, x.reported_dt, x.act_reported_dt, x.min_amount_due, "
         "x.current_balance, x.amount_overdue_total, x.days_past_due, x.chargeoff_amt, x.asset_class, x.das")
_STAT = ("p.account_nbr, p.credit_limit, p.disbursed_amount, p.disbursed_dt, p.instal_freq, p.num_installment, "
         "p.suppress_indicator")

SQL = {
    "hanging_accounts": f"""
SELECT account_key, max(act_reported_dt) AS max_rpt_dt FROM account_trend
WHERE act_reported_dt <= {AS_OF}
  AND account_key NOT IN (SELECT account_key FROM account WHERE act_reported_dt <= {AS_OF})
GROUP BY account_key""",
    "latest_update": f"""
SELECT DISTINCT * EXCLUDE (rk) FROM (
  SELECT *, rank() OVER (PARTITION BY account_key ORDER BY act_reported_dt DESC) AS rk
  FROM account_update WHERE act_reported_dt <= {AS_OF}) WHERE rk = 1""",
    "as_of_snapshot": f"""
SELECT {AS_OF} AS as_of, 'T' AS data_ind, t.account_key, {_T}, {_U}, {_P}
FROM hanging_accounts h JOIN account_trend t ON t.account_key = h.account_key AND t.act_reported_dt = h.max_rpt_dt
JOIN latest_update u ON u.account_key = t.account_key LEFT JOIN account p ON p.account_key = t.account_key
UNION ALL
SELECT {AS_OF}, 'P', p.account_key, {_as_p(_T)}, {_as_p(_U)}, {_P}
FROM account p WHERE p.act_reported_dt <= {AS_OF}""",
    "prod_plus_trend": f"""
SELECT h.*, CAST(year(h.act_reported_dt) AS INTEGER) AS year, c.consumer_key, c.state, c.district, c.pin_code, c.birth_dt, c.gender,
  c.ownership_ind
FROM (
  SELECT {_HIST}, {_STAT}, CASE WHEN x.das IN ('S06','S07') THEN p.closed_dt END AS closed_dt, 'T' AS data_ind
  FROM account_trend x JOIN account p ON x.account_key = p.account_key
  UNION ALL
  SELECT {_HIST.replace('x.', 'p.')}, {_STAT}, p.closed_dt, 'P' FROM account p) h
LEFT JOIN latest_consumer c ON c.account_key = h.account_key""",
    "partition_upsert": """
SELECT b.* FROM account_trend b
WHERE b.act_reported_dt IN (SELECT act_reported_dt FROM v_restated)
  AND NOT EXISTS (SELECT 1 FROM v_restated d WHERE d.act_reported_dt = b.act_reported_dt
                  AND d.account_key = b.account_key)
UNION ALL SELECT * FROM v_restated""",
    "v_restated": """
SELECT * REPLACE (CAST(current_balance * CAST(0.90 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS current_balance)
FROM account_trend WHERE das = 'S05' AND month(act_reported_dt) = 12""",
    "open_closed_union": """
SELECT * FROM macro_open UNION ALL
SELECT * FROM macro_closed WHERE (closed_dt IS NULL OR closed_dt <= DATE '2000-06-30')
  AND reported_dt <= DATE '2000-08-08' AND act_insert_dt <= DATE '2000-08-08'""",
    "bucketed_prod_plus_trend": "SELECT * FROM prod_plus_trend",
    "bucketed_snapshot_months": "SELECT * FROM snapshot_months",
    "partition_rewrite": """
SELECT b.* FROM account_trend b ANTI JOIN v_restated d ON d.act_reported_dt = b.act_reported_dt AND d.account_key = b.account_key
UNION ALL SELECT * FROM v_restated""",
    "v_marked": """
SELECT account_key, act_reported_dt, das, asset_class, CASE WHEN lag(act_reported_dt) OVER w IS NOT NULL
    AND das IS NOT DISTINCT FROM lag(das) OVER w AND asset_class IS NOT DISTINCT FROM lag(asset_class) OVER w THEN 0 ELSE 1 END AS changed
FROM account_trend WINDOW w AS (PARTITION BY account_key ORDER BY act_reported_dt)""",
    "v_islands": """
SELECT *, sum(changed) OVER (PARTITION BY account_key ORDER BY act_reported_dt) AS island FROM v_marked""",
    "validity_intervals": """
SELECT account_key, valid_from, lead(valid_from) OVER (PARTITION BY account_key ORDER BY valid_from) AS valid_to, reports, das, asset_class
FROM (SELECT account_key, min(act_reported_dt) AS valid_from, CAST(count(*) AS INTEGER) AS reports, min(das) AS das,
    min(asset_class) AS asset_class FROM v_islands GROUP BY account_key, island)""",
    "read_table": """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE o_orderstatus = 'F'""",
    "read_split": """
SELECT l_linestatus, l_returnflag, count(*) AS line_items, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS quantity
FROM lineitem GROUP BY 1, 2""",
    "load_dims": """
SELECT 'region' AS dim, r_name AS name FROM region UNION ALL SELECT 'nation', n_name FROM nation
UNION ALL SELECT 'supplier', s_name FROM supplier UNION ALL SELECT 'part', p_name FROM part""",
    "load_domain_dims": " UNION ALL ".join(
        f"SELECT '{d}' AS dim, count(*) AS rows FROM {d}_dim" for d in ("geo", "purpose", "occupation", "lender", "account_type", "category", "date")),
    "load_by_period": """
SELECT account_key, act_reported_dt, das, current_balance, CAST(year(act_reported_dt) AS INTEGER) AS year
FROM account_trend WHERE year(act_reported_dt) <= 2000""",
    "write_period": """
SELECT account_key, das, current_balance, CAST(year(act_reported_dt)*100 + month(act_reported_dt) AS INTEGER) AS period
FROM account_trend WHERE das = 'S05' OR month(act_reported_dt) <> 12 OR act_reported_dt NOT IN (
  SELECT act_reported_dt FROM account_trend WHERE das = 'S05')""",
    "named_table": "SELECT account_key, das, current_balance FROM account",
    "export_single_csv": "SELECT * FROM par_report",
    "export_exposure_file": "SELECT * FROM exposure_file",
    "export_geo_report_1": "SELECT * FROM geo_report_1",
    "open_closed_union_uncapped": """
SELECT * FROM macro_open UNION ALL
SELECT * FROM macro_closed WHERE reported_dt <= DATE '2000-08-08'
  AND (closed_dt IS NULL OR (closed_dt <= DATE '2000-06-30' AND act_insert_dt <= DATE '2000-08-08'))""",
}

_BOOK_MONEY = ["amount_overdue_total", "current_balance", "chargeoff_amt", "disbursed_amount", "high_credit"]
MONEY = {
    "latest_update": ["disbursed_amount"],
    "as_of_snapshot": _BOOK_MONEY + ["min_amount_due"],
    "prod_plus_trend": ["min_amount_due", "current_balance", "amount_overdue_total", "chargeoff_amt", "credit_limit",
                        "disbursed_amount"],
    "bucketed_snapshot_months": _BOOK_MONEY + ["min_amount_due"],
    "bucketed_prod_plus_trend": ["min_amount_due", "current_balance", "amount_overdue_total", "chargeoff_amt", "credit_limit",
                                 "disbursed_amount"],
    "snapshot_months": _BOOK_MONEY + ["min_amount_due"],
    "partition_rewrite": ["current_balance", "amount_overdue_total", "chargeoff_amt", "min_amount_due"],
    "partition_upsert": ["current_balance", "amount_overdue_total", "chargeoff_amt", "min_amount_due"],
    "open_closed_union": _BOOK_MONEY + ["credit_limit"],
    "open_closed_union_uncapped": _BOOK_MONEY + ["credit_limit"],
    "load_by_period": ["current_balance"], "write_period": ["current_balance"],
    "named_table": ["current_balance"],
    "export_single_csv": ["total_disb_amount", "active_disb_amount", "active_outstanding", "total_written_off_amount"]
    + [f"par_{b}" for b in ("0", "1_30", "31_60", "61_90", "91_180", "181_360", "360_plus")],
}
