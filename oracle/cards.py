"""Oracle SQL of the card book and the flow rate."""

from __future__ import annotations

from oracle import rules as r
from oracle.base import AS_OF, BOOK, ratio, shift, yyyymm
from oracle.reports import retail_row

_PEER = r.groups("lender_id", r.CARD_GROUPS, "PSBs+OTH", "PRB000")
_LIVE = f"not_closed_ind = 'Y' AND das IN {BOOK}"
_LISTED = "('CCC009','FRB011','PRB000','PRB001','PRB002','PRB003')"
_ELIGIBLE = "b.active = 1 AND b.suppress_indicator IS NULL"
_LOW = "current_balance < 1000"
_UTIL = f"coalesce(CAST({ratio('current_balance', 'sanctioned_amount', 100, 4)} AS DECIMAL(18,4)), 0)"
_YEAR_AGO = shift(AS_OF, -12)


def _avg(total: str, count: str) -> str:
    return ratio(total, count, 1, 4)


def _late(n: int) -> str:
    return f"derived_dpd > {n} AND derived_dpd <= 180"


def _cumulative(column: str, out: str) -> list[tuple[str, str]]:
    return [("No Due", f"{column} = 'No Due'"), ("1+", f"{column} IN ('1_30','30_60','60_90','90_180')"),
            ("30+", f"{column} IN ('30_60','60_90','90_180')"), ("60+", f"{column} IN ('60_90','90_180')"),
            ("90+", f"{column} = '90_180'")]


def _tiers(source: str, column: str, out: str) -> str:
    return " UNION ALL ".join(
        f"SELECT *, '{label}' AS {out} FROM {source} WHERE {test}" for label, test in _cumulative(column, out))


def _mean(part: str, whole: str) -> str:
    share = f"CAST({ratio(f'abs({part})', f'abs({whole})', 100, 6)} AS DECIMAL(18,6))"
    return ratio(f"sum({share})", f"count({share})", 1, 4)


_ROLL_LAGS = (1, 3, 6, 12)


def _roll(name: str, source: str, months: str, lag: int = 12) -> dict[str, str]:
    v = f"v_{name}"
    return {
        f"{v}_base": f"""
SELECT a.act_reported_dt AS reported_dt_from, a.account_key, a.lender_id,
  {r.ranges('a.derived_dpd', r.B_FLOW5, 'No Due')} AS dpd_from, {r.ranges('b.derived_dpd', r.B_FLOW5, 'No Due')} AS dpd_to,
  a.current_balance AS balance_from, b.current_balance AS balance_to
FROM {source} a JOIN {source} b ON a.ind = 'T' AND b.ind = 'T' AND a.account_key = b.account_key
  AND last_day(CAST(a.act_reported_dt + INTERVAL {lag} MONTH AS DATE)) = b.act_reported_dt
WHERE a.act_reported_dt BETWEEN {shift(AS_OF, -60)} AND {AS_OF} {months}
  AND a.not_closed_ind = 'Y' AND a.das IN {BOOK} AND b.not_closed_ind = 'Y' AND b.das IN {BOOK}
  AND a.derived_dpd <= 180 AND b.derived_dpd <= 180""",
        f"{v}_from": _tiers(f"{v}_base", "dpd_from", "new_dpd_from"),
        f"{v}_both": _tiers(f"{v}_from", "dpd_to", "new_dpd_to"),
        f"{v}_sum": f"""
SELECT *, count(account_key) OVER w AS total_dpd, sum(balance_from) OVER w AS total_cb
FROM (SELECT *, {_PEER} AS peer_group FROM {v}_both) WINDOW w AS (PARTITION BY new_dpd_from, reported_dt_from, peer_group)""",
        name: f"""
SELECT reported_dt_from, peer_group, new_dpd_from, new_dpd_to, total_dpd, total_cb, count(account_key) AS active_cards,
  sum(balance_to) AS current_balance_to, {ratio('count(account_key)', 'total_dpd', 100)} AS loans_flow_rate_percent,
  {ratio('sum(balance_to)', 'total_cb', 100)} AS portfolio_flow_rate_percent
FROM {v}_sum GROUP BY 1, 2, 3, 4, 5, 6""",
    }


_SPINE_SUMS = {
    "active_cards_dpd180": "count(CASE WHEN derived_dpd <= 180 THEN account_key END)",
    "total_active_pos_dpd180": "sum(CASE WHEN derived_dpd <= 180 THEN current_balance ELSE 0 END)",
    **{f"loans_dpd_gtr_{n}": f"count(CASE WHEN {_late(n)} THEN account_key END)" for n in (30, 60, 90)},
    **{f"pos_dpd_gtr_{n}": f"sum(CASE WHEN {_late(n)} THEN current_balance ELSE 0 END)" for n in (30, 60, 90)},
    "active_cards": "count(account_key)", "total_active_pos": "sum(current_balance)", "utilisation_sum": f"sum({_UTIL})",
    "credit_limit_sum": "sum(coalesce(sanctioned_amount, 0))",
    "low_utilization_loan": f"count(CASE WHEN {_LOW} THEN account_key END)",
    "low_utilisation_sum": f"sum(CASE WHEN {_LOW} THEN {_UTIL} ELSE 0 END)",
    "low_credit_limit_sum": f"sum(CASE WHEN {_LOW} THEN coalesce(sanctioned_amount, 0) ELSE 0 END)",
}
_WALLET = ["CCC009", "FRB011", "PRB000", "PRB001", "PRB002", "PRB003", "NBF004", "SBI010"]


def _wallet(lender: str) -> str:
    return f"""SELECT a.reported_dt, '{lender}' AS lender_id, sum(current_balance) AS clst_base_cb,
  sum(CASE WHEN lender_id = '{lender}' THEN current_balance ELSE 0 END) AS bank_cb,
  sum(CASE WHEN {_LOW} THEN current_balance ELSE 0 END) AS low_clst_base_cb,
  sum(CASE WHEN {_LOW} AND lender_id = '{lender}' THEN current_balance ELSE 0 END) AS low_bank_cb
FROM v_wallet a JOIN (SELECT DISTINCT clst_id, reported_dt FROM v_wallet WHERE lender_id = '{lender}') b
  ON a.clst_id = b.clst_id AND a.reported_dt = b.reported_dt GROUP BY a.reported_dt"""


_FLOW_BAND = f"CASE WHEN {_LIVE} THEN {r.ranges('derived_dpd', r.B_FLOW9, 'No Due')} END"

def _card_base(types: str) -> str:
    return f"""
SELECT x.*, u.city, coalesce(m.clst_id, u.consumer_key) AS clst_id
FROM ({retail_row('T', 'a', 'b')} FROM account_trend a JOIN account b ON a.account_key = b.account_key
    WHERE {types} AND {_ELIGIBLE} AND a.act_reported_dt <= {AS_OF}
  UNION ALL {retail_row('P', 'b', 'b')} FROM account b WHERE {types} AND {_ELIGIBLE}) x
LEFT JOIN unique_account_row u ON x.account_key = u.account_key LEFT JOIN cluster_map m ON u.consumer_key = m.candidate_id
LEFT JOIN threshold t ON t.account_type = x.account_type AND t.active = 1
WHERE u.ownership_ind <> 'O04' AND (t.balance_cap IS NULL OR coalesce(abs(x.current_balance), 0) <= t.balance_cap)"""


def _flow(name: str, base: str, lapse: int) -> dict[str, str]:
    """Flow rate some months later, and the rows it reads."""
    return {
        base: f"""
SELECT x.*, u.state FROM (
  {retail_row('T1', 'a', 'b')} FROM account_trend a JOIN account b ON a.account_key = b.account_key
  WHERE {_ELIGIBLE} AND last_day(a.act_reported_dt) = {AS_OF} AND b.disbursed_dt <= {AS_OF}
  UNION ALL {retail_row('T2', 'a', 'b')} FROM account_trend a JOIN account b ON a.account_key = b.account_key
  WHERE {_ELIGIBLE} AND last_day(a.act_reported_dt) = {shift(AS_OF, lapse)}) x
LEFT JOIN unique_account_row u ON x.account_key = u.account_key JOIN threshold t ON x.account_type = t.account_type AND t.active = 1
WHERE NOT (x.account_type = 'A15' AND u.ownership_ind = 'O04') AND x.current_balance <= t.balance_cap
  AND x.sanctioned_amount <= t.amount_cap""",
        name: f"""
SELECT account_name AS product, {_PEER} AS lender_type, {r.ranges('sanctioned_amount', r.B_AMOUNT10, None, 'NA')} AS ticket_size_lbop,
  state, loan_book_obs_prd, time_lapsed, dpd_lbop, dpd_tl,
  CASE WHEN disbursed_dt < {shift(AS_OF, -36)} THEN '<36 Months' ELSE fyq END AS origination_period,
  {r.ranges('mob', r.B_MOB)} AS mob_bucket, count(DISTINCT account_key) AS live_loans, sum(balance_tl) AS current_balance_tl,
  sum(chargeoff_tl) AS total_written_off_amount, 'A01-A06-A07-A12-A13-A15-A22|NBF004|200006|{lapse}' AS batch_run
FROM (SELECT a.*, b.time_lapsed, b.dpd_tl, b.balance_tl, b.chargeoff_tl FROM (
    SELECT account_key, account_type, lender_id, state, disbursed_dt, mob, act_reported_dt AS loan_book_obs_prd,
      {_FLOW_BAND} AS dpd_lbop, sanctioned_amount FROM {base} WHERE ind = 'T1') a
  JOIN (SELECT account_key, act_reported_dt AS time_lapsed,
      CASE WHEN {_LIVE} THEN {r.ranges('derived_dpd', r.B_FLOW9, 'No Due')} WHEN das IN ('S06','S13') THEN 'Written Off' END AS dpd_tl,
      current_balance AS balance_tl, chargeoff_amt AS chargeoff_tl FROM {base} WHERE ind = 'T2') b
    ON a.account_key = b.account_key) f
JOIN account_type_dim d ON f.account_type = d.account_type AND d.active = 1
LEFT JOIN date_dim e ON {yyyymm('disbursed_dt')} = e.yyyymm GROUP BY ALL""",
    }


SQL = {
    "card_base": _card_base("b.account_type = 'A15'"),
    "bucketed_card_base": "SELECT * FROM card_base",
    "v_roll_cards": _card_base("b.account_type LIKE 'A%'"),
    "v_quarters": f"""SELECT last_day(CAST(d AS DATE)) AS q FROM (SELECT unnest(generate_series(DATE '1998-06-01', DATE '2000-06-01',
  INTERVAL 3 MONTH)) AS d)""",
    "v_spine_rows": """
SELECT q.q AS reported_dt, 'P' AS data_ind, c.* FROM v_quarters q JOIN card_base c ON c.ind = 'P' AND c.act_reported_dt <= q.q
UNION ALL
SELECT q, 'T', * EXCLUDE (q, rn) FROM (SELECT q.q, c.*, row_number() OVER (PARTITION BY q.q, c.account_key
    ORDER BY c.act_reported_dt DESC) AS rn
  FROM v_quarters q JOIN card_base c ON c.ind = 'T' AND c.act_reported_dt <= q.q
  WHERE NOT EXISTS (SELECT 1 FROM card_base p WHERE p.ind = 'P' AND p.account_key = c.account_key
    AND p.act_reported_dt <= q.q)) WHERE rn = 1""",
    "quarter_spine_agg": f"""
SELECT *, {_avg('utilisation_sum', 'active_cards')} AS average_utilization_percent,
  {_avg('credit_limit_sum', 'active_cards')} AS average_credit_limit,
  {_avg('low_utilisation_sum', 'low_utilization_loan')} AS low_utilization_pf_percent,
  {_avg('low_credit_limit_sum', 'low_utilization_loan')} AS average_low_credit_limit
FROM (SELECT reported_dt, lender_id, data_ind, mob, city, {', '.join(f'{e} AS {n}' for n, e in _SPINE_SUMS.items())}
  FROM v_spine_rows WHERE {_LIVE} GROUP BY reported_dt, lender_id, data_ind, mob, city)""",
    "v_new_cards": f"""
SELECT * FROM card_base WHERE ind = 'P' AND disbursed_on BETWEEN {shift(AS_OF, -24)} AND {AS_OF} AND derived_dpd <= 180
  AND das IN {BOOK}""",
    "cc_acquisitions_rank": f"""
SELECT a.*, CAST(coalesce(b.rk, 0) AS INTEGER) AS rank
FROM (SELECT disbursed_dt, {_PEER} AS peer_group, count(DISTINCT account_key) AS total_cc_acquisitions FROM v_new_cards
  GROUP BY 1, 2) a
LEFT JOIN (SELECT disbursed_dt, 'SELF' AS kind, lender_id, rank() OVER (PARTITION BY disbursed_dt ORDER BY n DESC) AS rk
  FROM (SELECT disbursed_dt, lender_id, count(DISTINCT account_key) AS n FROM v_new_cards WHERE lender_id IN {_LISTED}
    GROUP BY 1, 2)) b ON a.disbursed_dt = b.disbursed_dt AND a.peer_group = b.kind AND b.lender_id = 'PRB000'""",
    "cc_early_delinquency": f"""
SELECT fyq AS financial_qtr, {_PEER} AS peer_group, mob + 1 AS mob, CAST(sum(active_cards_dpd180) AS BIGINT) AS active_cards,
  CAST(sum(loans_dpd_gtr_30) AS BIGINT) AS loans_dpd_gtr_30, CAST(sum(loans_dpd_gtr_90) AS BIGINT) AS loans_dpd_gtr_90,
  sum(total_active_pos) AS total_active_pos, sum(pos_dpd_gtr_30) AS pos_dpd_gtr_30, sum(pos_dpd_gtr_90) AS pos_dpd_gtr_90
FROM quarter_spine_agg JOIN date_dim d ON {yyyymm('reported_dt')} = d.yyyymm WHERE mob IN (2, 5, 11) GROUP BY 1, 2, mob""",
    "v_cities": f"""
SELECT reported_dt, {_PEER} AS peer_group, city, CAST(sum(active_cards) AS BIGINT) AS total_active_cards,
  sum(total_active_pos) AS total_active_pos, {_avg('sum(utilisation_sum)', 'sum(active_cards)')} AS average_utilization_percent,
  {_avg('sum(credit_limit_sum)', 'sum(active_cards)')} AS average_credit_limit
FROM quarter_spine_agg WHERE city IS NOT NULL GROUP BY 1, 2, 3""",
    "v_top": f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY peer_group ORDER BY total_active_cards DESC, city) AS rn
  FROM v_cities WHERE reported_dt = {AS_OF}) WHERE rn <= 50""",
    "cc_top_cities": f"""
SELECT * FROM v_top UNION ALL SELECT c.* FROM v_cities c JOIN v_top t ON c.peer_group = t.peer_group AND c.city = t.city
WHERE c.reported_dt = {_YEAR_AGO}""",
    "cc_portfolio": f"""
SELECT reported_dt, {_PEER} AS peer_group, CAST(sum(active_cards) AS BIGINT) AS active_cards,
  sum(total_active_pos) AS total_active_pos FROM quarter_spine_agg GROUP BY 1, 2""",
    "cc_self_rank": f"""
SELECT reported_dt, lender_id, CAST(rk AS INTEGER) AS rank FROM (SELECT reported_dt, lender_id,
    rank() OVER (PARTITION BY reported_dt ORDER BY sum(active_cards) DESC) AS rk
  FROM quarter_spine_agg WHERE lender_id IN {_LISTED} GROUP BY reported_dt, lender_id) WHERE lender_id = 'PRB000'""",
    "cc_low_utilisation": f"""
SELECT reported_dt, {_PEER} AS peer_group,
  {ratio('sum(low_utilization_loan)', 'sum(active_cards)', 100, 4)} AS low_utilization_percent,
  {_avg('sum(low_utilisation_sum)', 'sum(low_utilization_loan)')} AS low_utilization_pf_percent,
  {_avg('sum(low_credit_limit_sum)', 'sum(low_utilization_loan)')} AS average_low_credit_limit
FROM quarter_spine_agg GROUP BY 1, 2""",
    "cc_delinquency_pct": f"""
SELECT reported_dt, {_PEER} AS peer_group,
  {', '.join(f"{_mean(f'loans_dpd_gtr_{n}', 'active_cards_dpd180')} AS loan_{n}_plus_percent" for n in (30, 60, 90))},
  {', '.join(f"{_mean(f'pos_dpd_gtr_{n}', 'total_active_pos_dpd180')} AS portfolio_{n}_plus_percent" for n in (30, 60, 90))}
FROM quarter_spine_agg GROUP BY 1, 2""",
    **_roll("roll_rate", "card_base", "AND month(a.act_reported_dt) IN (3, 6, 9, 12)"),
    **_roll("roll_rate_all_products", "v_roll_cards", ""),
    **{k: v for n in _ROLL_LAGS for k, v in _roll(f"roll_{n}_months", "v_roll_cards", "", n).items()},
    "roll_rate_lags": " UNION ALL ".join(f"SELECT CAST({n} AS INTEGER) AS lag, * FROM roll_{n}_months" for n in _ROLL_LAGS),
    "v_wallet": f"""
SELECT act_reported_dt AS reported_dt, lender_id, clst_id, current_balance FROM card_base
WHERE ind = 'T' AND act_reported_dt IN ({_YEAR_AGO}, {AS_OF}) AND {_LIVE}
UNION ALL SELECT {_YEAR_AGO}, lender_id, clst_id, current_balance FROM card_base
WHERE ind = 'P' AND act_reported_dt <= {_YEAR_AGO} AND {_LIVE}
UNION ALL SELECT {AS_OF}, lender_id, clst_id, current_balance FROM card_base WHERE ind = 'P' AND act_reported_dt <= {AS_OF} AND {_LIVE}""",
    "share_of_wallet": " UNION ALL ".join(_wallet(x) for x in _WALLET),
    "v_all_rows": f"""
SELECT q.q AS reported_dt, x.* FROM v_quarters q JOIN (
  {retail_row('T', 'a', 'b')} FROM account_trend a JOIN account b ON a.account_key = b.account_key WHERE {_ELIGIBLE}) x
  ON x.act_reported_dt = q.q
UNION ALL SELECT q.q, x.* FROM v_quarters q JOIN (
  {retail_row('P', 'b', 'b')} FROM account b WHERE {_ELIGIBLE}) x ON x.act_reported_dt <= q.q""",
    "all_product_base": f"""
SELECT DISTINCT x.ind AS data_ind, x.reported_dt, m.clst_id, x.account_key, x.lender_id, x.account_type, x.das, x.closed_dt,
  x.not_closed_ind, x.derived_dpd, x.current_balance, x.amount_overdue_total, x.chargeoff_amt, x.sanctioned_amount, x.mob,
  x.disbursed_on AS disbursed_dt
FROM v_all_rows x JOIN (SELECT DISTINCT account_key, clst_id FROM cluster_member) m ON x.account_key = m.account_key
WHERE m.clst_id IN (SELECT clst_id FROM card_base WHERE (ind = 'T' AND act_reported_dt BETWEEN {shift(AS_OF, -24)} AND {AS_OF}
    AND month(act_reported_dt) IN (3, 6, 9, 12)) OR (ind = 'P' AND act_reported_dt <= {AS_OF}))""",
    "new_vs_known": f"""
SELECT reported_dt, peer_group, count(CASE WHEN rw = 1 THEN account_key END) AS ntc,
  count(CASE WHEN rw_peer = 1 THEN account_key END) AS ntb, count(CASE WHEN rw_peer > 1 THEN account_key END) AS etb,
  count(CASE WHEN account_type = 'A15' AND rw_product = 1 THEN account_key END) AS ntp,
  count(CASE WHEN account_type = 'A15' AND rw_product > 1 THEN account_key END) AS ktp
FROM (SELECT *, count(*) OVER (PARTITION BY clst_id, reported_dt) AS rw,
    count(*) OVER (PARTITION BY clst_id, reported_dt, peer_group) AS rw_peer,
    count(*) OVER (PARTITION BY clst_id, reported_dt, account_type) AS rw_product
  FROM (SELECT *, {_PEER} AS peer_group FROM all_product_base)) GROUP BY reported_dt, peer_group""",
    **_flow("flow_rate", "v_flow_base", 12),
    **_flow("v_flow_rate_6", "v_flow_base_6", 6),
    **_flow("flow_rate_next_month", "v_flow_base_1", 1),
    "flow_runs": "SELECT * FROM flow_rate UNION ALL SELECT * FROM v_flow_rate_6",
    "flow_rate_months": "SELECT * FROM flow_runs",
}
_ROW_MONEY = ["current_balance", "amount_overdue_total", "chargeoff_amt", "sanctioned_amount"]
MONEY = {
    "card_base": _ROW_MONEY, "bucketed_card_base": _ROW_MONEY,
    "quarter_spine_agg": [c for c in _SPINE_SUMS if "pos" in c or c.endswith("_sum")],
    "cc_early_delinquency": ["total_active_pos", "pos_dpd_gtr_30", "pos_dpd_gtr_90"],
    "cc_top_cities": ["total_active_pos"], "cc_portfolio": ["total_active_pos"],
    "roll_rate": ["total_cb", "current_balance_to"], "roll_rate_all_products": ["total_cb", "current_balance_to"],
    "share_of_wallet": ["clst_base_cb", "bank_cb", "low_clst_base_cb", "low_bank_cb"],
    "all_product_base": _ROW_MONEY, "flow_rate": ["current_balance_tl", "total_written_off_amount"],
    "flow_runs": ["current_balance_tl", "total_written_off_amount"],
    "flow_rate_next_month": ["current_balance_tl", "total_written_off_amount"],
    "flow_rate_months": ["current_balance_tl", "total_written_off_amount"], "roll_rate_lags": ["total_cb", "current_balance_to"],
}
