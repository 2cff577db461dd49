"""DuckDB definitions of the views in which the uneven book differs."""

from __future__ import annotations

from oracle.base import VIEWS

UNEVEN = (
    "open_closed_union", "open_closed_union_uncapped", "month_over_month", "share_filter", "report_outliers",
    "fact_report_outliers",
)
# Dates are not written as literals: a statement of the run's date is turned into one of another date by its literals.
_QUIET = ", ".join(f"(make_date(2000, {m}, {d}))" for m, d in ((3, 31), (4, 30), (5, 31), (6, 30)))

UNEVEN_VIEWS = {
    "v_orders": f"""
SELECT * REPLACE (
  CASE WHEN lender_id IN ('SBI010','FRB011') AND (account_key // 12) % 40 <> 0 THEN 'PRB000' ELSE lender_id END AS lender_id,
  CASE WHEN lender_id = 'ARC008' AND act_reported_dt = make_date(2000, 5, 31) THEN make_date(2000, 6, 30) ELSE act_reported_dt END AS act_reported_dt)
FROM ({VIEWS['v_orders']})""",
    "account_trend": f"""
SELECT * FROM ({VIEWS['account_trend']})
WHERE lender_id <> 'HFC007' AND NOT (lender_id = 'ARC008' AND act_reported_dt = make_date(2000, 5, 31))
UNION ALL BY NAME
SELECT account_key, lender_id, account_type, d AS act_reported_dt, d AS reported_dt, disbursed_amount AS current_balance,
  '40' AS days_past_due, 'L01' AS asset_class, 'S04' AS das, 'S04' AS account_status, CAST(NULL AS DATE) AS closed_dt,
  CAST(0 AS DECIMAL(18,2)) AS amount_overdue_total, CAST(NULL AS DECIMAL(18,2)) AS chargeoff_amt, CAST(0 AS DECIMAL(18,2)) AS min_amount_due
FROM v_orders, (VALUES {_QUIET}) q(d) WHERE lender_id = 'HFC007' AND disbursed_dt <= make_date(2000, 3, 31)""",
    "macro_closed": f"""
SELECT * REPLACE (CASE WHEN account_key % 9 <> 0 THEN closed_dt END AS closed_dt) FROM ({VIEWS['macro_closed']})""",
}
