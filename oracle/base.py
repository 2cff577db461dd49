"""DuckDB definitions of the loan-book views over the given tables."""

from __future__ import annotations

LENDERS = [
    "PRB000", "PRB001", "PRB002", "PRB003", "NBF004", "NBF005", "NBF006", "HFC007", "ARC008", "CCC009", "SBI010",
    "FRB011",
]
STATUS_KEYS = dict(zip(
    ["S01", "S02", "S03", "S04", "S05", "S06", "S07", "S11", "S12", "S13", "S16", "S18", "S20", "S25"], range(1, 15)
))
AS_OF = "DATE '2000-06-30'"
SELF = "'NBF004'"
PORTFOLIO = "('S04','S05','S20','S25','S18')"
BOOK = "('S04','S05','S11','S12','S16','S18','S20')"


def pick(expr: str, values) -> str:
    arms = " ".join(f"WHEN {n} THEN '{v}'" for n, v in enumerate(values) if v is not None)
    return f"CASE {expr} {arms} END"


def values(rows, columns: str) -> str:
    text = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {text}) v({columns})"


def label_dim(labels) -> str:
    return values([(n, x, 1) for n, x in enumerate(labels, 1)], "key, label, active")


def yyyymm(d: str) -> str:
    return f"CAST(year({d})*100 + month({d}) AS INTEGER)"


def months_between(a: str, b: str) -> str:
    """Calendar months with 31-day fractions; whole when both are month ends or the days agree."""
    whole = f"((year({a})-year({b}))*12 + month({a})-month({b}))"
    return (
        f"(CASE WHEN day({a})=day({b}) OR ({a}=last_day({a}) AND {b}=last_day({b})) THEN {whole}"
        f" ELSE {whole} + (day({a})-day({b}))/31.0 END)"
    )


def mob(a: str, b: str) -> str:
    return f"CAST(datediff('month', {b}, {a}) AS INTEGER)"


def shift(d: str, n: int) -> str:
    moved = f"CAST({d} + INTERVAL ({n}) MONTH AS DATE)"
    return f"(CASE WHEN {d}=last_day({d}) THEN last_day({moved}) ELSE {moved} END)"


def ratio(a: str, b: str, times: int = 1, places: int = 2) -> str:
    return (
        f"CAST(round(CAST(CAST({a} AS DOUBLE)/nullif(CAST({b} AS DOUBLE),0)*{times} AS DECIMAL(38,8)),{places})"
        f" AS DOUBLE)"
    )


K = "o_orderkey"
ORDERED = "CAST(o_orderdate AS DATE)"
REPORTED = f"last_day({ORDERED} + 365)"
CYCLES = ["0", "1", "002", "3", "04", "5", "006", "7", "08", "009", "10", " 12 ", None]
PURPOSES = ["AGRI", "BUSINESS", "SCHOOL", "HOME", "VEHICLE", "LAND", "OTHER", None]
FREQS = ["1", "F02", "f03", None, "9", "ZZ", "F04", "F04"]
TYPES = ["A01", "A06", "A07", "A12", "A13", "A15", "A22"]
DAS = """CASE WHEN o_orderstatus='O' THEN 'S04' WHEN o_orderstatus='P' THEN 'S05'
    WHEN o_orderpriority='1-URGENT' THEN 'S06' ELSE 'S07' END"""

VIEWS = {
    "v_orders": f"""
SELECT o_orderkey AS account_key, o_custkey AS consumer_key, {ORDERED} AS disbursed_dt,
  CAST(o_totalprice AS DECIMAL(18,2)) AS disbursed_amount, {DAS} AS das,
  {pick(f'{K} % 12', LENDERS)} AS lender_id, {pick(f'{K} % 7', TYPES)} AS account_type,
  'AC' || CAST({K} AS VARCHAR) AS account_nbr,
  CASE WHEN o_orderstatus NOT IN ('O','P') THEN {ORDERED} + 400 END AS closed_dt,
  {pick(f'{K} % 8', FREQS)} AS instal_freq, CAST({K} % 49 AS INTEGER) AS num_installment,
  CASE WHEN {K} % 50 = 0 THEN 'Y' END AS suppress_indicator,
  {pick(f'{K} % 4', ['T01', 'T02', 'T03', 'T04'])} AS loan_category,
  {pick(f'{K} % 13', CYCLES)} AS loan_cycle_id, {pick(f'{K} % 8', PURPOSES)} AS loan_purpose,
  'C' || CAST({K} % 23 AS VARCHAR) AS centre_id, 'G' || CAST({K} % 211 AS VARCHAR) AS group_id, 1 AS active,
  {REPORTED} AS act_reported_dt
FROM orders""",
    "account": """
SELECT *,
  CASE account_key % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'XXX'
    WHEN 3 THEN 'DPD ' || CAST(account_key % 400 AS VARCHAR) ELSE CAST(account_key % 400 AS VARCHAR) END AS days_past_due,
  CASE account_key % 9 WHEN 0 THEN 'L01' WHEN 1 THEN 'L02' WHEN 2 THEN 'L03' WHEN 3 THEN 'L04' WHEN 4 THEN 'L05'
    WHEN 5 THEN ' L02 ' END AS asset_class,
  CASE WHEN account_key % 3 <> 0 THEN disbursed_amount END AS high_credit,
  CASE WHEN account_key % 5 = 0 THEN disbursed_amount END AS credit_limit,
  CAST(disbursed_amount * CASE account_key % 4 WHEN 0 THEN CAST(0.15 AS DECIMAL(3,2)) WHEN 1 THEN CAST(0.60 AS DECIMAL(3,2))
    WHEN 2 THEN CAST(-0.35 AS DECIMAL(3,2)) ELSE CAST(1.10 AS DECIMAL(3,2)) END AS DECIMAL(18,2)) AS current_balance,
  CASE WHEN account_key % 6 = 0 THEN CAST(disbursed_amount * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(18,2))
    ELSE CAST(0 AS DECIMAL(18,2)) END AS amount_overdue_total,
  CASE WHEN das = 'S06' THEN disbursed_amount END AS chargeoff_amt,
  CASE WHEN account_key % 8 <> 7 THEN CAST(disbursed_amount * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(18,2)) END AS min_amount_due,
  act_reported_dt AS reported_dt, act_reported_dt + CAST(account_key % 40 AS INTEGER) AS act_insert_dt,
  das AS account_status
FROM v_orders""",
    "account_trend": """
SELECT g.account_key, o.lender_id, o.account_type, g.act_reported_dt, g.act_reported_dt AS reported_dt,
  g.balance AS current_balance, CAST(g.qty * 8 AS VARCHAR) AS days_past_due,
  CASE g.rf WHEN 'A' THEN 'L01' WHEN 'R' THEN 'L02' END AS asset_class,
  CASE WHEN g.ls = 'F' THEN 'S05' ELSE 'S04' END AS das, CASE WHEN g.ls = 'F' THEN 'S05' ELSE 'S04' END AS account_status,
  o.closed_dt,
  CASE WHEN g.account_key % 6 = 0 THEN CAST(g.balance * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(18,2))
    ELSE CAST(0 AS DECIMAL(18,2)) END AS amount_overdue_total,
  CASE WHEN g.account_key % 17 = 0 AND g.ls = 'F' THEN g.balance END AS chargeoff_amt,
  CAST(g.balance * CAST(0.05 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS min_amount_due
FROM (
  SELECT l_orderkey AS account_key, last_day(greatest(CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE))) AS act_reported_dt,
    max(CAST(l_extendedprice AS DECIMAL(18,2))) AS balance, max(CAST(l_quantity AS INTEGER)) AS qty,
    max(l_returnflag) AS rf, max(l_linestatus) AS ls
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2) g JOIN v_orders o USING (account_key)""",
    "account_update": """
SELECT g.account_key, g.act_reported_dt, g.amount AS disbursed_amount, g.qty AS num_installment, o.account_nbr,
  o.disbursed_dt, o.instal_freq, o.loan_category, o.loan_cycle_id, o.loan_purpose, o.suppress_indicator, o.active
FROM (
  SELECT l_orderkey AS account_key, last_day(CAST(l_shipdate AS DATE)) AS act_reported_dt,
    max(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount, max(CAST(l_quantity AS INTEGER)) AS qty
  FROM lineitem GROUP BY 1, 2) g JOIN v_orders o USING (account_key)""",
    "consumer": """
SELECT c_custkey AS consumer_key, DATE '1996-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS insert_dt,
  CASE WHEN c_custkey % 10 <> 0 THEN r_name END AS state, CASE WHEN c_custkey % 7 <> 0 THEN n_name END AS district,
  CASE WHEN c_custkey % 6 <> 0 THEN CAST(100000 + c_nationkey AS VARCHAR) END AS pin_code,
  CASE WHEN c_custkey % 8 <> 0 THEN n_name || '_C' || CAST(c_custkey % 10 AS VARCHAR) END AS city,
  CASE WHEN c_custkey % 9 <> 0 THEN 'LOC' || CAST(c_custkey % 20 AS VARCHAR) END AS locality,
  CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS monthly_income,
  CASE WHEN c_custkey % 3 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 10 AS DECIMAL(18,2)) END AS annual_income,
  CASE WHEN c_custkey % 5 <> 0 THEN DATE '1950-01-01' + CAST((c_custkey * 37) % 18000 AS INTEGER) END AS birth_dt,
  CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender, c_mktsegment AS occupation,
  CASE c_custkey % 5 WHEN 0 THEN 'O01' WHEN 1 THEN 'O02' WHEN 2 THEN 'O04' END AS ownership_ind,
  c_custkey % 13 = 0 AS is_commercial, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 50 + 18 AS INTEGER) END AS age,
  CASE WHEN c_custkey % 4 <> 2 THEN DATE '1999-01-01' + CAST(c_custkey % 300 AS INTEGER) END AS age_as_on_dt
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "geo_fill": """
SELECT c_custkey AS consumer_key, CASE WHEN c_custkey % 2 = 0 THEN r_name END AS state,
  CASE WHEN c_custkey % 2 = 0 THEN n_name END AS district,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(100000 + c_nationkey AS VARCHAR) END AS pin_code
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "account_party": """
SELECT l.account_key, l.lender_id, c.* REPLACE (c.insert_dt + CAST(l.account_key % 700 AS INTEGER) AS insert_dt)
FROM (SELECT account_key, lender_id, consumer_key FROM v_orders
  UNION ALL SELECT account_key, lender_id, consumer_key + 1 FROM v_orders WHERE account_key % 4 = 0) l
JOIN consumer c ON l.consumer_key = c.consumer_key""",
    "cluster_pair": """
SELECT c_custkey AS candidate_id, c_custkey - c_custkey % 3 AS clst_id FROM customer
UNION ALL SELECT c_custkey, c_custkey - c_custkey % 6 FROM customer WHERE c_custkey % 5 = 1""",
    "cluster_member": """
SELECT p.*, coalesce(m.clst_id, p.consumer_key) AS clst_id, a.disbursed_dt, a.reported_dt
FROM account_party p LEFT JOIN cluster_map m ON p.consumer_key = m.candidate_id
JOIN account a ON p.account_key = a.account_key""",
    "v_macro": """
SELECT a.account_key, a.lender_id, a.account_type, a.account_nbr, a.das, a.days_past_due, a.asset_class, a.high_credit,
  a.disbursed_amount, a.credit_limit, a.current_balance, a.amount_overdue_total, a.chargeoff_amt, a.disbursed_dt,
  a.closed_dt, a.reported_dt, a.act_insert_dt, a.instal_freq, p.consumer_key, p.state, p.district, p.pin_code,
  p.ownership_ind, p.birth_dt, p.gender, p.is_commercial
FROM account a JOIN account_party p ON a.account_key = p.account_key""",
    "macro_open": "SELECT *, 1 AS das_flag FROM v_macro WHERE das IN ('S04','S05')",
    "macro_closed": "SELECT *, 0 AS das_flag FROM v_macro WHERE das IN ('S06','S07')",
    "extra_columns": """
SELECT p.account_key, p.consumer_key, p.annual_income, p.monthly_income, a.suppress_indicator, a.min_amount_due
FROM account_party p JOIN account a ON p.account_key = a.account_key""",
    "commercial_account": f"""
SELECT account_key, lender_id AS contributor_id, consumer_key AS borrower_key,
  CASE WHEN account_key % 10 = 0 THEN account_nbr ELSE 'CM' || CAST(account_key AS VARCHAR) END AS account_number,
  {pick('(account_key // 5) % 6', ['9002', '4000', '0200', '0420', '0310', '7777'])} AS credit_type,
  disbursed_dt AS sanctioned_dt, das,
  {pick('(account_key // 5) % 14', ['L01', '0001', '002', '0003', '005', '0010', '011', '0012', '013'])} AS asset_class,
  CASE (account_key // 5) % 10 WHEN 0 THEN 'XXX' WHEN 1 THEN 'DDD' WHEN 2 THEN NULL
    ELSE CAST(account_key % 500 AS VARCHAR) END AS dpd,
  disbursed_amount AS sanctioned_amount, high_credit AS drawing_power, current_balance, amount_overdue_total, closed_dt,
  CASE WHEN account_key % 9 = 0 THEN closed_dt + 30 END AS loan_expiry_dt, reported_dt
FROM account""",
    "commercial_trend": f"""
SELECT account_key, lender_id AS contributor_id,
  {pick('(account_key // 5) % 14', ['L01', '0001', '002', '0003', '005', '0010', '011', '0012', '013'])} AS asset_class,
  das, CASE (account_key // 5) % 10 WHEN 0 THEN 'XXX' WHEN 1 THEN 'DDD' WHEN 2 THEN NULL ELSE days_past_due END AS dpd,
  CASE WHEN account_key % 3 <> 0 THEN current_balance END AS sanctioned_amount,
  CASE WHEN account_key % 2 = 0 THEN current_balance END AS drawing_power,
  current_balance, amount_overdue_total, closed_dt,
  CASE WHEN account_key % 9 = 0 THEN closed_dt + 30 END AS loan_expiry_dt, reported_dt
FROM account_trend""",
    "geo_dim": """
SELECT DISTINCT state, district, pin_code,
  CAST(CASE WHEN state IS NULL THEN 0 ELSE (r_regionkey + 1) * 10000 END
    + CASE WHEN district IS NULL THEN 0 ELSE (c_nationkey + 1) * 100 END
    + CASE WHEN pin_code IS NULL THEN 0 ELSE c_nationkey + 1 END AS INTEGER) AS sdp_key,
  state AS rev_state, district AS rev_district, 1 AS active
FROM consumer JOIN customer ON consumer_key = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""",
    "purpose_dim": """
SELECT DISTINCT lender_id, loan_purpose, CASE loan_purpose WHEN 'AGRI' THEN 'Income' WHEN 'BUSINESS' THEN 'INCOME'
  WHEN 'SCHOOL' THEN 'Education' WHEN 'HOME' THEN 'Housing' WHEN 'VEHICLE' THEN 'Automobile'
  WHEN 'LAND' THEN 'Real Estate' WHEN 'OTHER' THEN 'misc' END AS purpose_status
FROM v_orders WHERE loan_purpose IS NOT NULL""",
    "lender_dim": values(
        [(n, x, f"{x} {'Bank' if x[:3] in ('PRB', 'SBI') else 'Finance'}", 1) for n, x in enumerate(LENDERS, 1)],
        "contri_key, lender_id, institution_name, active",
    ),
    "occupation_dim": """
SELECT lender_id, occupation, occupation_category FROM lender_dim CROSS JOIN (VALUES
  ('AUTOMOBILE','Employed'), ('BUILDING','Self Employed'), ('FURNITURE','Agriculture and Allied'),
  ('HOUSEHOLD','Contract Employee'), ('MACHINERY','Others')) o(occupation, occupation_category)""",
    "account_type_dim": values(
        [(n, x, f"Product {x}", 1) for n, x in enumerate(TYPES, 1)],
        "account_type_key, account_type, account_name, active",
    ),
    "date_dim": """
SELECT CAST(year(d)*100 + month(d) AS INTEGER) AS yyyymm,
  'FY' || CAST(year(d - INTERVAL 3 MONTH) AS VARCHAR) || '-Q' || CAST(quarter(d - INTERVAL 3 MONTH) AS VARCHAR) AS fyq
FROM (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2039-12-01', INTERVAL 1 MONTH)) AS d)""",
    "threshold": """
SELECT account_type, min(CASE WHEN rb >= (99*n + 99)//100 THEN balance END) AS balance_cap,
  min(CASE WHEN ra >= (99*n + 99)//100 THEN amount END) AS amount_cap, 1 AS active
FROM (SELECT account_type, abs(current_balance) AS balance, abs(disbursed_amount) AS amount,
    row_number() OVER (PARTITION BY account_type ORDER BY abs(current_balance)) AS rb,
    row_number() OVER (PARTITION BY account_type ORDER BY abs(disbursed_amount)) AS ra,
    count(*) OVER (PARTITION BY account_type) AS n FROM account) GROUP BY account_type""",
    "overall_threshold": """
SELECT min(CASE WHEN rb >= (99*n + 99)//100 THEN balance END) AS balance_cap,
  min(CASE WHEN ra >= (99*n + 99)//100 THEN amount END) AS amount_cap,
  (SELECT min(due) FROM (SELECT abs(min_amount_due) AS due, row_number() OVER (ORDER BY abs(min_amount_due)) AS r,
     count(*) OVER () AS m FROM account WHERE min_amount_due IS NOT NULL) WHERE r >= (99*m + 99)//100) AS min_due_cap
FROM (SELECT abs(current_balance) AS balance, abs(disbursed_amount) AS amount,
    row_number() OVER (ORDER BY abs(current_balance)) AS rb, row_number() OVER (ORDER BY abs(disbursed_amount)) AS ra,
    count(*) OVER () AS n FROM account)""",
}
