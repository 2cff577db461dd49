"""District exposure of borrowers and the geography x product cubes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanbook import params as P
from loanbook.functions import buckets as B
from loanbook.functions import metrics as M
from loanbook.functions import rules as R
from loanbook.plans.skew import skew_join
from loanbook.sources.hot import UNKNOWN, HotKeys

PLACE = ["rev_state", "rev_district"]


# columns of the cleaned grain that the district reports read, with its keys account_key and as_of
EXPOSURE_INPUT = (
    "lender_id", "sdp_key", "clst_id", "mfi_das", "closed_dt", "dpd", "amt_due", "cur_bal", "disb_amt", "disb_dt", "suppress_indicator",
)


def _places(geo: DataFrame) -> DataFrame:
    return geo.where(F.col("active") == 1).select("sdp_key", *PLACE, "pin_code").distinct()


def _shown(step2: DataFrame) -> DataFrame:
    return step2.where(F.coalesce("suppress_indicator", F.lit("N")) != "Y")


def _active(statuses) -> Column:
    return R.is_active(F.col("closed_dt"), F.col("mfi_das"), F.col("as_of"), statuses)


def district_active_base(step2: DataFrame, geo: DataFrame) -> DataFrame:
    """Open or written-off accounts that are not suppressed, with their revised geography."""
    rows = _shown(step2).where(_active(P.ACTIVE_STRICT) | (F.col("mfi_das") == "S06"))
    return rows.join(_places(geo).drop("pin_code"), "sdp_key")


def district_cluster_profile(step2: DataFrame, geo: DataFrame, need_pin: bool = True) -> DataFrame:
    """Per (state, district, cluster): active accounts, lenders, balances, worst DPD, first disbursal.

    Accounts are one row each; lenders are reduced to one row per cluster
    before counting.
    """
    places = _places(geo).where(F.col("rev_state").isNotNull() & F.col("rev_district").isNotNull())
    if need_pin:
        places = places.where(F.col("pin_code").isNotNull())
    rows = _shown(step2).join(places.drop("pin_code"), "sdp_key").withColumn("live", _active(P.ACTIVE_BOOK))
    keys = [*PLACE, "clst_id"]
    per_lender = rows.groupBy(*keys, "lender_id").agg(*[F.expr(e) for e in (
        "count_if(live) as active_accounts", "max(int(live)) as live", "sum(cur_bal) as total_outstanding_amount",
        "sum(if(live, cur_bal, 0)) as portfolio_outstanding", "max(dpd) as max_dpd",
        "max(if(live, dpd, null)) as max_dpd_active", "min(disb_dt) as min_disb",
        "min(if(live, disb_dt, null)) as min_disb_active",
    )])
    return per_lender.groupBy(*keys).agg(*[F.expr(e) for e in (
        "sum(active_accounts) as active_accounts", "count(lender_id) as overall_lenders",
        "sum(live) as active_lenders", "sum(total_outstanding_amount) as total_outstanding_amount",
        "sum(portfolio_outstanding) as portfolio_outstanding", "max(max_dpd) as max_dpd",
        "max(max_dpd_active) as max_dpd_active", "min(min_disb) as min_disb",
        "min(min_disb_active) as min_disb_active",
    )])


EXPOSURE_KEYS = ["load_yyyymm", "product_ind", *PLACE, "vintage", "outstanding_band", "dpd", "active_lender_band",
                 "disbursed_period"]


def _exposure(base: DataFrame, profile: DataFrame, cutoff: date, label: str, hot: HotKeys) -> DataFrame:
    facts = profile.select(*PLACE, "clst_id", "max_dpd_active", "portfolio_outstanding", "active_lenders", "min_disb")
    rows = skew_join(base, facts, [*PLACE, "clst_id"], "inner", "account_key", known=hot.clusters)
    vintage = R.months_on_book(F.col("as_of"), F.col("min_disb"), plus=1)
    keyed = rows.select(
        R.yyyymm(F.col("as_of")).alias("load_yyyymm"), F.lit(label).alias("product_ind"), *PLACE,
        B.bucket(vintage, B.VINTAGE9).alias("vintage"),
        B.bucket(F.abs("portfolio_outstanding"), B.EXPOSURE12).alias("outstanding_band"),
        B.dpd_worst(F.col("mfi_das"), F.col("max_dpd_active"), F.col("amt_due"), F.col("disb_amt")).alias("dpd"),
        B.bucket(F.col("active_lenders"), B.LENDER_COUNT5).alias("active_lender_band"),
        B.disbursed_period(F.col("disb_dt"), cutoff).alias("disbursed_period"),
        "clst_id", _active(P.ACTIVE_STRICT).alias("live"), "disb_amt", "amt_due", "cur_bal",
    )
    per_cluster = keyed.groupBy(*EXPOSURE_KEYS, "clst_id").agg(*[F.expr(e) for e in (
        "max(int(live)) as active_clusters", "count(1) as total_loans", "count_if(live) as active_loans",
        "sum(disb_amt) as total_disb_amount", "sum(if(live, disb_amt, 0)) as active_disb_amount",
        "sum(amt_due) as total_overdue_amount", "sum(cur_bal) as total_outstanding_amount",
        "sum(if(live, cur_bal, 0)) as active_outstanding_amount",
    )])
    return per_cluster.groupBy(*EXPOSURE_KEYS).agg(
        F.count("clst_id").alias("unique_clusters"),
        *[F.expr(f"sum({c}) as {c}") for c in (
            "active_clusters", "total_loans", "active_loans", "total_disb_amount", "active_disb_amount",
            "total_overdue_amount", "total_outstanding_amount", "active_outstanding_amount",
        )],
    )


def district_exposure(step2: DataFrame, geo: DataFrame, cutoff: date, hot: HotKeys = UNKNOWN) -> DataFrame:
    """Clusters and loans by district, vintage, exposure, worst DPD, lender count and period."""
    return _exposure(district_active_base(step2, geo), district_cluster_profile(step2, geo), cutoff, "All", hot)


def district_exposure_self(
    step2: DataFrame, geo: DataFrame, cutoff: date, self_lender: str, hot: HotKeys = UNKNOWN
) -> DataFrame:
    """The same for all loans of clusters that ever had a loan with the self lender."""
    own = step2.where(F.col("lender_id") == self_lender).select("clst_id").distinct()
    rows = skew_join(step2, own, ["clst_id"], "left_semi", "account_key", known=hot.clusters)
    base = district_active_base(rows, geo).where(F.col("rev_state").isNotNull() & F.col("rev_district").isNotNull())
    return _exposure(base, district_cluster_profile(rows, geo, need_pin=False), cutoff, "Self", hot)


def exposure_file(exposure: DataFrame, closing: str) -> DataFrame:
    """Report labels and sums of the district exposure, for export."""
    keyed = exposure.select(
        F.lit(closing).alias("closing_as_of"), F.col("rev_state").alias("state"),
        F.col("rev_district").alias("district"), F.col("vintage").alias("borrower_vintage"),
        B.relabel(F.col("active_lender_band"), B.LENDER_COUNT_RELABEL).alias("active_lender"),
        B.relabel(F.col("outstanding_band"), B.EXPOSURE_RELABEL).alias("credit_exposure"),
        B.relabel(F.col("dpd"), B.DPD_WORST_RELABEL).alias("worst_dpd"), "disbursed_period",
        "unique_clusters", "total_loans", "total_disb_amount", "total_outstanding_amount", "total_overdue_amount",
    )
    keys = ["closing_as_of", "state", "district", "borrower_vintage", "active_lender", "credit_exposure",
            "worst_dpd", "disbursed_period"]
    return keyed.groupBy(*keys).agg(
        F.sum("unique_clusters").alias("active_customers"), F.sum("total_loans").alias("active_loans"),
        F.sum("total_disb_amount").alias("disbursed_amount_active"),
        F.sum("total_outstanding_amount").alias("portfolio_outstanding"),
        F.sum("total_overdue_amount").alias("overdue_amount"),
    )


# --- geography x product ------------------------------------------------------------
def active_lender_density(fact: DataFrame, geo: DataFrame, load_yyyymm: int) -> DataFrame:
    """Lenders with at least ten consumers and some active ones, per geography key."""
    per_lender = fact.where(F.col("load_yyyymm") == load_yyyymm).groupBy("sdp_key", "contri_key").agg(
        F.sum("total_consumers").alias("consumers"),
        M.sum_if(F.col("loan_account_status_key") == 1, F.col("total_consumers"), "active_consumers"),
    )
    present = (F.col("consumers") >= 10) & (F.col("active_consumers") > 0) & F.col("contri_key").isNotNull()
    per_place = per_lender.groupBy("sdp_key").agg(M.count_if(present, "active_lenders"))
    return per_place.join(_places(geo), "sdp_key")


# loan counts and balances of the cube: name -> (test on keys, counts accounts?)
def _dpd_in(*positions: int) -> str:
    return f"loan_dpd_bucket_key in ({', '.join(map(str, positions))})"


CUBE_BANDS = {
    "current": _dpd_in(15), "ns": _dpd_in(1),
    **{name: f"overdue_ind = 1 and {_dpd_in(*keys)}" for name, keys in {
        "1_30": (2,), "31_60": (3,), "61_90": (4,), "31_180": (3, 4, 5, 6, 7), "91_180": (5, 6, 7), "91_120": (5,),
        "121_150": (6,), "151_180": (7,), "181_360": (8, 9, 10, 11, 12, 13), "gtr_360": (14,),
    }.items()},
}
GEO_CUBE_KEYS = ["rpt_fmt", "quarter", "rev_state", "rev_district", "pin_code", "active_lender_band",
                 "borrower_vintage", "lender_type", "product", "category", "category_name", "ticket_size",
                 "disbursal_period", "loan_install_freq", "tenure", "suppressed"]


def _key_labels(key: Column, labels: tuple[str, ...], other: str) -> Column:
    """Label at position `key` (from 1)."""
    arms = None
    for n, label in enumerate(labels, start=1):
        arms = F.when(key == n, F.lit(label)) if arms is None else arms.when(key == n, F.lit(label))
    return arms.otherwise(F.lit(other))


def _lender_group(p: P.RunParams, variant: str) -> Column:
    lender, name = F.col("lender_id"), F.upper(F.col("institution_name"))
    if variant == "RPT1":
        return R.peer_group(lender, p.geo_groups_1, "Peer Group 5")
    named = R.peer_group(lender, p.geo_groups_2, "")
    bank = lender.startswith("PRB") | name.contains("BANK")
    return F.when(named != "", named).when(bank, F.lit("Banks")).otherwise(F.lit("Others"))


def geo_product_cube(
    fact: DataFrame, geo: DataFrame, lenders: DataFrame, quarters: DataFrame, categories: DataFrame,
    p: P.RunParams, load_yyyymm: int, variant: str = "RPT1",
) -> DataFrame:
    """Fact rows by place, lender density, vintage, lender group, product, ticket, period, frequency and tenure.

    RPT1 and RPT2 differ only in the lender groups. Lenders, quarters
    and categories come from configuration; all other work is one aggregate over the fact.
    """
    rows = fact.where(
        (F.col("load_yyyymm") == load_yyyymm) & ~F.col("contri_key").isin(*p.excluded_lender_keys)
    )
    density = active_lender_density(fact, geo, load_yyyymm).where(F.col("rev_state").isNotNull())
    joined = (
        rows.join(density, "sdp_key")
        .join(F.broadcast(lenders.where(F.col("active") == 1).drop("active")), "contri_key")
        .join(F.broadcast(quarters.withColumnRenamed("yyyymm", "disb_yyyymm")), "disb_yyyymm", "left")
        .join(F.broadcast(categories.where(F.col("active") == 1).select(
            F.col("category_key").alias("loan_account_type_key"), F.col("loan_category").alias("category"),
            "category_name")), "loan_account_type_key", "left")
    )
    months = lambda c: F.floor(F.col(c) / 100) * 12 + F.col(c) % 100
    mob = months("load_yyyymm") - months("min_disb_yyyymm")
    disbursed = F.col("disb_yyyymm")
    keyed = joined.select(
        F.lit(variant).alias("rpt_fmt"), F.col("load_yyyymm").alias("quarter"), "rev_state", "rev_district",
        F.col("pin_code").cast("int").alias("pin_code"),
        B.bucket(R.zero_if_null(F.col("active_lenders")), B.LENDER_COUNT8).alias("active_lender_band"),
        B.bucket(mob, B.VINTAGE9_MONTHS).alias("borrower_vintage"),
        _lender_group(p, variant).alias("lender_type"), F.lit("MFI").alias("product"), "category", "category_name",
        B.bucket(F.col("loan_ticket_size_key"), B.TICKET_KEY_GROUPS).alias("ticket_size"),
        F.when(disbursed <= p.old_disbursal_yyyymm, F.lit(p.old_disbursal_label))
        .when(disbursed > p.old_disbursal_yyyymm, F.col("fyq")).otherwise(F.lit("OTHERS")).alias("disbursal_period"),
        _key_labels(F.col("loan_install_freq_key"), ("Weekly", "BiWeekly", "Monthly", "Bimonthly"), "Others").alias(
            "loan_install_freq"
        ),
        _key_labels(F.col("loan_num_instal_bucket_new_key"), ("0_6", "7_12", "13_24", "GRTR24"), "NA").alias("tenure"),
        M.flag(F.col("suppress_ind_key") == 1).alias("suppressed"),
        (months("load_yyyymm") - months("disb_yyyymm")).alias("age_months"),
        (F.col("loan_account_status_key") == 1).alias("live"),
        "loan_dpd_bucket_key", "overdue_ind", "das_id", "total_accounts", "total_disbursed_amount",
        "total_outstanding_amount", "total_write_off_amount",
    )
    off = "das_id in (6, 10)"
    aggs = [
        "sum(total_accounts) as total_loans", "sum(if(live, total_accounts, 0)) as total_activ_loans",
        "sum(total_disbursed_amount) as total_disb_amount",
        "sum(if(live, total_disbursed_amount, 0)) as total_activ_disb_amount",
        "sum(if(live, total_outstanding_amount, 0)) as total_act_outstanding_amount",
        f"sum(if({off}, total_accounts, 0)) as total_written_off_loans",
        f"sum(if({off}, total_write_off_amount, 0)) as total_written_off_amount",
    ]
    for band, test in CUBE_BANDS.items():
        aggs.append(f"sum(if(live and {test}, total_accounts, 0)) as loans_{band}")
        aggs.append(f"sum(if(live and {test}, total_outstanding_amount, 0)) as pos_{band}")
    for n in (6, 12, 24):
        recent = f"age_months between 0 and {n}"
        aggs.append(f"sum(if({recent}, total_accounts, 0)) as loans_{n}m")
        aggs.append(f"sum(if({recent}, total_disbursed_amount, 0)) as amount_{n}m")
    return keyed.groupBy(*GEO_CUBE_KEYS).agg(*[F.expr(a) for a in aggs])


def geo_report(cube: DataFrame) -> DataFrame:
    """Published cube without suppressed loans and without the category, with wider DPD bands."""
    keys = {
        "quarter": "quarter", "rev_state": "state", "rev_district": "district", "pin_code": "pincode",
        "active_lender_band": "active_lenders", "borrower_vintage": "borrower_vintage", "lender_type": "lender_type",
        "ticket_size": "ticket_size", "disbursal_period": "disbursal_period", "tenure": "tenure",
        "loan_install_freq": "repayment_frequency",
    }
    sums = {
        "loans_sanctioned": "total_loans", "live_loans": "total_activ_loans",
        "total_sanctioned_amount": "total_disb_amount", "active_sanctioned_amount": "total_activ_disb_amount",
        "portfolio_outstanding": "total_act_outstanding_amount",
        "total_written_off_loans": "total_written_off_loans", "total_written_off_amount": "total_written_off_amount",
    }
    for measure, out in (("loans", "loans"), ("pos", "par")):
        sums.update({
            f"{out}_std": f"{measure}_current", f"{out}_not_stipulated": f"{measure}_ns",
            **{f"{out}_{b}": f"{measure}_{b}" for b in ("1_30", "31_60", "61_90", "91_180", "181_360")},
            f"{out}_31_180": f"{measure}_31_60 + {measure}_61_90 + {measure}_91_180",
            f"{out}_180plus": f"{measure}_181_360 + {measure}_gtr_360", f"{out}_360plus": f"{measure}_gtr_360",
        })
    for n in (6, 12, 24):
        sums[f"loans_{n}m"], sums[f"amount_{n}m"] = f"loans_{n}m", f"amount_{n}m"
    shown = cube.where(F.col("suppressed") != 1).groupBy(*[F.col(c).alias(n) for c, n in keys.items()])
    report = shown.agg(*[F.expr(f"sum({value}) as {name}") for name, value in sums.items()])
    month = F.make_date(F.floor(F.col("quarter") / 100).cast("int"), F.col("quarter") % 100, F.lit(1))
    return report.select(
        F.date_format(F.last_day(month), "dd-MMM-yy").alias("book_closing_period"),
        *[c for c in report.columns if c != "quarter"],
    )
