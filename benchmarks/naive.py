"""Plain forms of five reports, as baselines: one expression per metric, one query per step.

They give the same rows as the library's single-plan forms.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanbook import params as P
from loanbook.functions import buckets as B
from loanbook.functions import rules as R
from loanbook.operators import cards, clusters, par, snapshot
from loanbook.plans import catalog
from loanbook.sources import dims
from loanbook.sources.views import Book


def par_report(book: Book, p: P.RunParams) -> DataFrame:
    """Every count as its own count(distinct when ..), per report date and then summed."""
    rows = par.risk_rows(
        snapshot.open_closed_union(book.macro_open(), book.macro_closed(), p.as_of, p.report_cut), p.as_of
    )
    distinct = lambda test: f"count(distinct case when {test} then account_key end)"
    off = "das in ('S06', 'S13')"
    aggs = [
        "count(distinct account_key) as total_loans", "sum(amount) as total_disb_amount",
        f"{distinct('is_live')} as active_loans", "sum(if(is_live, amount, 0)) as active_disb_amount",
        "sum(if(is_live, current_balance, 0)) as active_outstanding",
        f"{distinct(off)} as total_written_off_loans", f"sum(if({off}, chargeoff_amt, 0)) as total_written_off_amount",
    ]
    for band, test in par.BANDS.items():
        aggs.append(f"{distinct('is_live and ' + test)} as lar_{band}")
        aggs.append(f"sum(if(is_live and {test}, current_balance, 0)) as par_{band}")
    per_date = rows.groupBy("lender_id", "account_type", "reported_dt").agg(*[F.expr(a) for a in aggs])
    names = dims.lender_dim(book.spark).where("active = 1").select(
        "lender_id", F.col("institution_name").alias("institution")
    )
    report = per_date.join(names, "lender_id", "left").groupBy("lender_id", "institution", "account_type").agg(
        *[F.sum(m).alias(m) for m in par.METRICS]
    )
    return report.select(
        F.lit(p.as_of).alias("reported_dt"), "lender_id", "institution", "account_type", *par.METRICS
    )


def cluster_profile(book: Book, p: P.RunParams) -> DataFrame:
    """106 expressions in one aggregate over ranked rows joined with their mix; counts as sizes of sets."""
    flagged = catalog._flagged(book, p.dashboard_dates)
    ranked = flagged
    for income, name in (("annual_income", "rw"), ("monthly_income", "rw_month")):
        order = Window.partitionBy("as_of", "clst_id", F.col(income).isNull()).orderBy(
            F.desc("reported_dt"), F.desc("disbursed_dt"), F.desc(income), "account_key", "consumer_key"
        )
        ranked = ranked.withColumn(name, F.when(F.col(income).isNotNull(), F.row_number().over(order)))
    mix = clusters.cluster_mix(flagged, p.self_lender).select("as_of", "clst_id", "clust_ind")
    rows = ranked.join(mix, ["as_of", "clst_id"]).where(
        "threshold_flag_overall = 1 and threshold_acnt_type = 1"
    ).select(
        "*", R.lender_type(F.col("lender_id")).alias("kind"), R.product_class(F.col("account_type")).alias("product"),
        clusters.active().alias("live"), clusters.loan_amount().alias("amount"),
        F.expr("if(rw = 1, annual_income, null)").alias("annual_fnl"),
        F.expr("if(rw_month = 1, monthly_income * 12, null)").alias("monthly_fnl"),
        F.expr("if(min_amt_threshold = 1 and rw = 1, min_amount_due, null)").alias("due_fnl"),
    )
    own, foreign = f"lender_id = '{p.self_lender}'", f"lender_id <> '{p.self_lender}'"
    every = {"all": "true"}
    mixed = {
        "only_self": f"({own} and clust_ind = 'ONLY SELF')", "with_others": "clust_ind = 'SELF WITH OTHERS'",
        "mixed": "clust_ind in ('ONLY SELF', 'SELF WITH OTHERS')",
        "others": f"({foreign} and clust_ind = 'OTHER CLUSTERS')",
    }
    lender = {"self_lender": own, "other_lender": foreign}
    kind = {"banks": "kind = 'Banks'", "nonbanks": "kind = 'Non Banks'", "secured": "product = 'Secured'",
            "unsecured": "product = 'Unsecured'", "other_product": "product = 'Others'"}
    personal = {"cl": "account_type = 'A13'", "noncl": "account_type <> 'A13'"}
    size = lambda test, c: f"cast(size(collect_set(if({test}, {c}, null))) as bigint)"
    out = {}
    for name, fn, c in (("min_disb", "min", "disbursed_dt"), ("max_dpd", "max", "dpd")):
        out.update({f"{name}_{s}": f"{fn}(if({t}, {c}, null))" for s, t in {**every, **mixed, **lender}.items()})
    for s, t in {**every, **mixed, **kind, **lender}.items():
        out[f"clusters_{s}"] = size(t, "clst_id")
        out[f"disb_{s}"] = "sum(amount)" if s == "all" else f"sum(if({t}, amount, 0))"
        out[f"act_disb_{s}"] = f"sum(if(live and {t}, amount, 0))"
    for s, t in {**every, **personal, **mixed, **kind, **lender}.items():
        out[f"loans_{s}"] = size(t, "account_key")
        out[f"active_loans_{s}"] = size(f"live and {t}", "account_key")
        out[f"outstanding_{s}"] = f"sum(if(live and {t}, current_balance, 0))"
    for s, t in {**every, **mixed, **lender}.items():
        out[f"min_due_{s}"] = "sum(due_fnl)" if s == "all" else f"sum(if({t}, due_fnl, 0))"
        out[f"annual_income_{s}"] = f"max(if({t}, coalesce(annual_fnl, monthly_fnl), null))"
    return rows.groupBy("as_of", "clst_id", "clust_ind").agg(*[F.expr(f"{e} as {n}") for n, e in out.items()])


def _live() -> Column:
    return (F.col("not_closed_ind") == "Y") & F.col("das").isin(*P.ACTIVE_BOOK)


def quarter_spine_agg(book: Book, p: P.RunParams) -> DataFrame:
    """One query per quarter end, united."""
    base = catalog._cards(book, p)
    parts = []
    for q in p.quarter_ends:
        known = base.where(F.col("act_reported_dt") <= F.lit(q))
        current = known.where("ind = 'P'")
        last = known.where("ind = 'T'").groupBy("account_key").agg(F.max("act_reported_dt").alias("act_reported_dt"))
        hanging = last.join(current, "account_key", "left_anti")
        past = known.where("ind = 'T'").join(hanging, ["account_key", "act_reported_dt"])
        for rows in (past, current):
            parts.append(cards.quarter_spine_agg(rows.select(*base.columns), (q,), p.low_balance))
    return reduce(DataFrame.unionByName, parts)


def roll_rate(book: Book, p: P.RunParams) -> DataFrame:
    """Cumulative bands by UNION ALL over the card pairs, five times on each side."""
    p = catalog.roll_params(p)
    base = catalog._cards(book, p).where("ind = 'T' and derived_dpd <= 180").where(_live()).withColumn(
        "band", B.bucket(F.col("derived_dpd"), B.DPD_FLOW5)
    )
    start = P.shift_months(p.as_of, -p.roll_back_months)
    a, b = base.alias("a"), base.alias("b")
    pairs = a.join(
        b, F.expr("a.account_key = b.account_key and last_day(add_months(a.act_reported_dt, 12)) = b.act_reported_dt")
    ).where(
        F.col("a.act_reported_dt").between(F.lit(start), F.lit(p.as_of))
        & F.month("a.act_reported_dt").isin(*p.roll_months)
    ).selectExpr(
        "a.account_key", "a.lender_id", "a.act_reported_dt as reported_dt_from", "a.band as dpd_from",
        "b.band as dpd_to", "a.current_balance as b_from", "b.current_balance as b_to",
    )
    tiers = {"No Due": ["No Due"], "1+": ["1_30", "30_60", "60_90", "90_180"], "30+": ["30_60", "60_90", "90_180"],
             "60+": ["60_90", "90_180"], "90+": ["90_180"]}
    for band in ("dpd_from", "dpd_to"):
        pairs = reduce(DataFrame.unionByName, [
            pairs.where(F.col(band).isin(*labels)).withColumn(f"new_{band}", F.lit(tier))
            for tier, labels in tiers.items()
        ])
    peer = R.peer_group(F.col("lender_id"), p.card_groups, p.card_group_default, p.card_lender)
    keys = ["reported_dt_from", "peer_group", "new_dpd_from"]
    whole = Window.partitionBy(*keys)
    totals = pairs.withColumn("peer_group", peer).select(
        "*", F.count("account_key").over(whole).alias("total_dpd"), F.sum("b_from").over(whole).alias("total_cb")
    )
    cells = totals.groupBy(*keys, "new_dpd_to", "total_dpd", "total_cb").agg(
        F.count("account_key").alias("active_cards"), F.sum("b_to").alias("current_balance_to")
    )
    return cells.select(
        "*", R.ratio(F.col("active_cards"), F.col("total_dpd"), 100).alias("loans_flow_rate_percent"),
        R.ratio(F.col("current_balance_to"), F.col("total_cb"), 100).alias("portfolio_flow_rate_percent"),
    )


def share_of_wallet(book: Book, p: P.RunParams) -> DataFrame:
    """One query per lender, united."""
    rows = cards.wallet_rows(catalog._cards(book, p), p)
    low = f"current_balance < {p.low_balance}"
    parts = []
    for lender in p.wallet_lenders:
        own = f"lender_id = '{lender}'"
        customers = rows.where(own).select("clst_id", "reported_dt").distinct()
        parts.append(rows.join(customers, ["clst_id", "reported_dt"]).groupBy("reported_dt").agg(*[F.expr(e) for e in (
            f"'{lender}' as lender_id", "sum(current_balance) as clst_base_cb",
            f"sum(if({own}, current_balance, 0)) as bank_cb", f"sum(if({low}, current_balance, 0)) as low_clst_base_cb",
            f"sum(if({low} and {own}, current_balance, 0)) as low_bank_cb",
        )]))
    return reduce(DataFrame.unionByName, parts)


NAIVE = {
    "par_report": par_report, "cluster_profile": cluster_profile, "quarter_spine_agg": quarter_spine_agg,
    "roll_rate_all_products": roll_rate, "share_of_wallet": share_of_wallet,
}
