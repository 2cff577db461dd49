"""Oracle SQL of the borrower operators."""

from __future__ import annotations


def _survivor(column: str, extra: str = "") -> str:
    return (
        f"(SELECT {column} FROM cluster_member s WHERE s.clst_id = c.clst_id AND s.{column} IS NOT NULL "
        f"ORDER BY s.reported_dt DESC, s.disbursed_dt DESC, {extra} s.account_key DESC, s.consumer_key DESC LIMIT 1)"
    )


def _survivor_cte(column: str, extra: str = "") -> str:
    return f"""
SELECT clst_id, {column} FROM (SELECT clst_id, {column}, row_number() OVER (PARTITION BY clst_id
  ORDER BY reported_dt DESC, disbursed_dt DESC, {extra} account_key DESC, consumer_key DESC) AS rn
  FROM cluster_member WHERE {column} IS NOT NULL) WHERE rn = 1"""


_ATTRS = {
    "monthly_income": "monthly_income DESC,", "annual_income": "annual_income DESC,", "birth_dt": "", "gender": "",
    "occupation": "",
}

SQL = {
    "cluster_map": "SELECT candidate_id, max(clst_id) AS clst_id FROM cluster_pair GROUP BY candidate_id",
    "attach_cluster": """
SELECT a.account_key, a.consumer_key, a.lender_id, coalesce(m.clst_id, a.consumer_key) AS clst_id
FROM account a LEFT JOIN cluster_map m ON a.consumer_key = m.candidate_id""",
    "same_cluster_universe": """
SELECT DISTINCT a.account_key, a.consumer_key, a.account_type, m.clst_id
FROM account a JOIN cluster_map m ON a.consumer_key = m.candidate_id
WHERE m.clst_id IN (SELECT clst_id FROM cluster_map WHERE candidate_id IN
  (SELECT consumer_key FROM account WHERE account_type = 'A13'))""",
    "latest_consumer": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY consumer_key
  ORDER BY insert_dt DESC, account_key DESC) AS rn FROM account_party) WHERE rn = 1""",
    "unique_account_row": """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY account_key
    ORDER BY sdp, ownership_ind_flag, consumer_key) AS rn
  FROM (SELECT *, CASE WHEN state IS NOT NULL AND district IS NOT NULL AND pin_code IS NOT NULL THEN 1
        WHEN state IS NOT NULL AND district IS NOT NULL THEN 2 WHEN state IS NOT NULL AND pin_code IS NOT NULL THEN 3
        WHEN district IS NOT NULL AND pin_code IS NOT NULL THEN 4 ELSE 5 END AS sdp,
      coalesce(substr(ownership_ind, 3, 1), '9') AS ownership_ind_flag
    FROM (SELECT p.* REPLACE (coalesce(p.state, g.state) AS state, coalesce(p.district, g.district) AS district,
        coalesce(p.pin_code, g.pin_code) AS pin_code)
      FROM account_party p LEFT JOIN geo_fill g ON p.consumer_key = g.consumer_key))) WHERE rn = 1""",
    "cross_bureau_flag": """
SELECT a.account_key, a.lender_id, a.account_nbr, CASE WHEN x.account_key IS NULL THEN 0 ELSE 1 END AS commercial_ind
FROM account a LEFT JOIN (SELECT DISTINCT r.account_key FROM account r JOIN commercial_account c
  ON r.lender_id = c.contributor_id AND r.account_nbr = c.account_number) x ON a.account_key = x.account_key""",
    "v_best_address": """
SELECT clst_id, pin_code, state, locality, city, district FROM (
  SELECT *, row_number() OVER (PARTITION BY clst_id ORDER BY
    CASE (CASE WHEN state IS NULL THEN 1 ELSE 0 END) + (CASE WHEN district IS NULL THEN 1 ELSE 0 END)
       + (CASE WHEN pin_code IS NULL THEN 1 ELSE 0 END) + (CASE WHEN city IS NULL THEN 1 ELSE 0 END)
       + (CASE WHEN locality IS NULL THEN 1 ELSE 0 END)
      WHEN 0 THEN 1
      WHEN 1 THEN CASE WHEN locality IS NULL THEN 2 WHEN city IS NULL THEN 3 WHEN pin_code IS NULL THEN 4
        WHEN district IS NULL THEN 5 ELSE 6 END
      ELSE 7 END, reported_dt DESC, disbursed_dt DESC, account_key DESC, consumer_key DESC) AS rn
  FROM cluster_member) WHERE rn = 1""",
    "golden_address": """
SELECT m.consumer_key, m.account_key, m.lender_id, m.clst_id, m.disbursed_dt, m.reported_dt, b.pin_code, b.state,
  b.locality, b.city, b.district, count(CASE WHEN m.is_commercial THEN 1 END) OVER (PARTITION BY m.clst_id) > 0
    AS is_commercial
FROM cluster_member m LEFT JOIN v_best_address b ON m.clst_id = b.clst_id""",
    **{f"v_last_{c}": _survivor_cte(c, extra) for c, extra in _ATTRS.items()},
    "survivorship": "SELECT c.clst_id, " + ", ".join(_ATTRS) + " FROM (SELECT DISTINCT clst_id FROM cluster_member) c "
    + " ".join(f"LEFT JOIN v_last_{c} ON c.clst_id = v_last_{c}.clst_id" for c in _ATTRS),
    "one_view": """
SELECT g.*, s.monthly_income, s.annual_income, s.birth_dt, s.gender, s.occupation
FROM golden_address g JOIN survivorship s ON g.clst_id = s.clst_id""",
    "market_entry": """
SELECT account_key, consumer_key, clst_id, disbursed_dt,
  CASE WHEN year(disbursed_dt) IN (1998, 1999, 2000) THEN CAST(year(disbursed_dt) AS VARCHAR) ELSE 'Others' END
    AS entry_year
FROM (SELECT *, min(disbursed_dt) OVER (PARTITION BY clst_id) AS first_dt FROM cluster_member)
WHERE disbursed_dt = first_dt""",
    "cluster_min_disbursal": """
SELECT DISTINCT m.clst_id, s.consumer_key, min(s.disbursed_dt) OVER (PARTITION BY m.clst_id) AS min_disb_dt
FROM cluster_map m JOIN as_of_snapshot s ON m.candidate_id = s.consumer_key""",
    "income_extra_cols": """
SELECT p.account_key, p.consumer_key, p.lender_id, p.annual_income, p.monthly_income, m.clst_id, a.min_amount_due,
  a.account_type, a.disbursed_dt, a.suppress_indicator
FROM account_party p JOIN cluster_map m ON p.consumer_key = m.candidate_id
JOIN account a ON p.account_key = a.account_key
  AND upper(trim(' ' || lower(a.account_nbr))) = upper(trim(a.account_nbr))""",
}

_INCOME = ["monthly_income", "annual_income"]
MONEY = {
    "latest_consumer": _INCOME, "unique_account_row": _INCOME, "survivorship": _INCOME, "one_view": _INCOME,
    "income_extra_cols": _INCOME + ["min_amount_due"],
}
